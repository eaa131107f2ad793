"""The job runners end to end: bronze parquet -> silver tables -> marts, through the catalog."""

import json

from leadlake.__main__ import run
from leadlake.plans import jobs
from leadlake.sources import read_table


def test_job_chain_through_tables(spark, tmp_path):
    b = tmp_path / "bronze"
    leads = [("1", "o1", "L1", "P1", "S1", json.dumps({"whatsAppNumber": "+91 9000000001"}), '{"date":"d"}'),
             ("2", "o1", "L2", "P1", "S2", json.dumps({"whatsAppNumber": "9000000002"}), None)]
    spark.createDataFrame(leads, "_id string, orgId string, leadId string, projectId string, leadStatus string, "
                                 "profile string, siteVisit string").write.parquet(str(b / "leads"))
    logs = [("g1", "o1", "1", json.dumps({"projectId": "P1", "bookingId": "B1", "prevStatus": "S2"})),
            ("g2", "o1", "1", json.dumps({"projectId": "P1"})),
            ("g3", "o1", "2", json.dumps({"projectId": "P1"}))]
    spark.createDataFrame(logs, "_id string, orgId string, leadId string, payload string").write.parquet(str(b / "logs"))
    spark.createDataFrame([("P1", "o1", "Tower")], "_id string, orgId string, projectName string") \
        .selectExpr("*", "'a' AS projectStatus", "NULL AS projectLogo", "'2025' AS completionDate",
                    "'pub' AS projectPublishStatus").write.parquet(str(b / "projects"))
    spark.createDataFrame([("S1", "o1", "lead", "Booked"), ("S2", "o1", "lead", "New")],
                          "_id string, orgId string, entityName string, labelName string").write.parquet(str(b / "labels"))
    spark.createDataFrame([("c1", "o1", "Launch", "whatsapp")],
                          "_id string, organisationId string, name string, channel string").write.parquet(str(b / "campaigns"))
    wa = [("c1", "o1", "read", json.dumps({"recipient": {"to": "919000000001"}, "events": {"timestamp": 1704067200000},
                                            "projectId": "P1"}), "2024-01-01 00:00:00", "1"),
          ("c1", "o1", "click", json.dumps({"recipient": {"to": "9000000002"}, "events": {"timestamp": 1704067200000},
                                             "projectId": "P1"}), "2024-01-01 00:00:00", "2")]
    spark.createDataFrame(wa, "campaignId string, organisationId string, status string, payload string, "
                              "updatedAt string, profileId string").write.parquet(str(b / "wa"))
    sms = [("s1", "c1", "9000000001", '{"status":{"code":200}}', None, "2024-01-01 10:00:00", "DELIVRD", "2024-01-01 10:00:00",
            "o1", "P1", "1")]
    spark.createDataFrame(sms, "_id string, campaignId string, to string, providerResponse string, type string, "
                               "createdAt string, status string, updatedAt string, organisationId string, "
                               "projectId string, profileId string").write.parquet(str(b / "sms"))
    spark.createDataFrame([("open", "2024-01-01 10:00:00", "o1", "2")],
                          "status string, createdAt string, organisationId string, profileId string").write.parquet(str(b / "email"))

    assert jobs.run_lead_flat(spark, str(b / "leads"), "chain.lead_flat") == {"rows": 2}
    told = jobs.run_communication_logs(spark, str(b / "logs"), "chain.comm_logs")
    assert told == {"rows": 3, "hot_keys": [("1", "o1", "P1")]}        # a lead with two of three logs: salted below
    assert jobs.run_lead_360(spark, "chain.lead_flat", "chain.comm_logs", str(b / "projects"), str(b / "labels"),
                             "chain.lead_360") == {"rows": 3}
    jobs.run_whatsapp_engagement(spark, str(b / "wa"), str(b / "campaigns"), "chain.lead_360", "chain.wa")
    jobs.run_sms_engagement(spark, str(b / "sms"), str(b / "campaigns"), "chain.lead_360", "chain.sms")
    jobs.run_campaign_response(spark, str(b / "sms"), str(b / "wa"), str(b / "email"), "chain.lead_360", "chain.resp")

    l360 = {(r.lead_flat_id, r.communication_log_id): r for r in read_table(spark, "chain.lead_360").collect()}
    assert set(l360) == {("1", "g1"), ("1", "g2"), ("2", "g3")}
    jobs.run_lead_360(spark, "chain.lead_flat", "chain.comm_logs", str(b / "projects"), str(b / "labels"),
                      "chain.lead_360_plain", skew_safe=False)
    assert sorted(map(str, read_table(spark, "chain.lead_360_plain").collect())) == sorted(map(str, l360.values()))
    once = jobs.lead_360_of(spark, "chain.lead_flat", "chain.comm_logs", spark.read.parquet(str(b / "projects")),
                            spark.read.parquet(str(b / "labels")), labels_once=True)
    assert sorted(map(str, once.collect())) == sorted(map(str, l360.values()))
    assert l360[("1", "g1")].booked_flag == 1 and l360[("1", "g1")].previous_lead_status == "New"
    wa_out = read_table(spark, "chain.wa").collect()
    assert [(r.total_unique_leads, r.whatsapp_read_only_unique, r.whatsapp_click_only_unique, r.booked_any_unique)
            for r in wa_out] == [(2, 1, 1, 1)]
    sms_out = read_table(spark, "chain.sms").collect()
    assert [(r.total_unique_leads, r.sms_delivered_unique) for r in sms_out] == [(1, 1)]
    resp = {(r.lead_flat_id, r.projectId): r for r in read_table(spark, "chain.resp").collect()}
    assert set(resp) == {("1", "P1"), ("2", "P1"), ("2", None)}
    assert resp[("1", "P1")].SMS_SENT == 1 and resp[("1", "P1")].WHATSAPP_READ == 1
    assert resp[("2", None)].EMAIL_OPENED == 1 and resp[("2", None)].WHATSAPP_CLICKED is None
    assert resp[("2", "P1")].WHATSAPP_CLICKED == 1

    # options of the jobs, through the command line
    base = ["--lead-360", "chain.lead_360", "--target"]
    run(["campaign_response", "--sms", str(b / "sms"), "--whatsapp", str(b / "wa"), "--email", str(b / "email"), *base,
         "chain.resp_corrected", "--sms-rules", "corrected"], spark)
    corrected = {(r.lead_flat_id, r.projectId): r for r in read_table(spark, "chain.resp_corrected").collect()}
    assert resp[("1", "P1")].SMS_DELIVERED == 0 and corrected[("1", "P1")].SMS_DELIVERED > 0
    run(["campaign_response", "--sms", str(b / "sms"), "--whatsapp", str(b / "wa"), "--email", str(b / "email"), *base,
         "chain.resp_fanned", "--keep-dim-duplicates"], spark)
    assert read_table(spark, "chain.resp_fanned").count() > len(resp)
    run(["whatsapp_engagement", "--whatsapp", str(b / "wa"), "--campaigns", str(b / "campaigns"), *base,
         "chain.wa_stored", "--phone-rule", "as_stored", "--tz", "America/New_York"], spark)
    stored = read_table(spark, "chain.wa_stored").collect()
    assert [(r.total_unique_leads, str(r.event_date)) for r in stored] == [(1, "2023-12-31")]
