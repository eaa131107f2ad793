"""Every flattened column reads the field its spec names: a document whose leaves
hold their own paths must come out with each column equal to its path."""

import json

from pyspark.sql.types import ArrayType, BooleanType, StructType

from leadlake.functions.schemas import payload_schema
from leadlake.plans.comm_logs import OUTPUT_SPEC, communication_logs_flat
from leadlake.plans.lead_flat import lead_flat


def _self_describing(schema: StructType, prefix: str) -> dict:
    doc = {}
    for f in schema.fields:
        path = f"{prefix}.{f.name}"
        if isinstance(f.dataType, StructType):
            doc[f.name] = _self_describing(f.dataType, path)
        elif isinstance(f.dataType, BooleanType):
            doc[f.name] = True
        elif isinstance(f.dataType, ArrayType):
            elem = f.dataType.elementType
            doc[f.name] = [_self_describing(elem, path) if isinstance(elem, StructType) else path]
        else:
            doc[f.name] = path
    return doc


def test_comm_log_spec_reads_the_named_paths(spark):
    payload = _self_describing(payload_schema(), "payload")
    src = spark.createDataFrame([("_id", "orgId", "leadId", json.dumps(payload))],
                                "_id string, orgId string, leadId string, payload string")
    row = communication_logs_flat(src).collect()[0].asDict(recursive=True)
    for out, path in OUTPUT_SPEC:
        got = row[out]
        if isinstance(got, bool):
            assert got is True, out
        elif isinstance(got, list):
            assert got and (got[0] == path or isinstance(got[0], dict)), out
        elif path in ("_id", "orgId", "leadId"):
            assert got == path, out
        else:
            assert got == path, (out, got, path)   # also proves the path exists in the schema


def test_lead_flat_spec_reads_the_named_fields(spark):
    from leadlake.functions import schemas as S

    docs = {
        "profile": {f: f"profile.{f}" for f in S.PROFILE_FIELDS},
        "propertyInterest": {f: f"propertyInterest.{f}" for f in S.PROPERTY_INTEREST_FIELDS},
        "conversionPropensity": {f: f"conversionPropensity.{f}" for f in S.CONVERSION_PROPENSITY_FIELDS},
        "siteVisit": {f: f"siteVisit.{f}" for f in S.SITE_VISIT_FIELDS},
    }
    src = spark.createDataFrame([tuple(json.dumps(d) for d in docs.values())],
                                ", ".join(f"{k} string" for k in docs))
    row = lead_flat(src).collect()[0].asDict()
    checked = 0
    for col, value in row.items():
        for struct in docs:
            prefix = f"{struct}_"
            if col.startswith(prefix):
                assert value == f"{struct}.{col[len(prefix):]}", (col, value)
                checked += 1
    assert checked == 11 + 7 + 2 + 4
    assert row["original_siteVisit_json"] == json.dumps(docs["siteVisit"])


def test_lead_360_renames_carry_their_source_columns(spark):
    from leadlake.plans.lead_360 import COMM_COLUMNS, LEAD_COLUMNS, lead_360

    payload = _self_describing(payload_schema(), "payload")
    payload["projectId"] = "P1"
    logs = communication_logs_flat(spark.createDataFrame(
        [("g1", "o1", "1", json.dumps(payload))], "_id string, orgId string, leadId string, payload string"))
    lead_cols = [src for _, src in LEAD_COLUMNS if src not in ("_id", "orgId", "projectId")]
    leads = spark.createDataFrame([("1", "o1", "P1", *[f"lead.{c}" for c in lead_cols])],
                                  ", ".join(f"{c} string" for c in ["_id", "orgId", "projectId", *lead_cols]))
    leads = lead_flat(leads)
    empty = spark.createDataFrame([], "_id string, orgId string, entityName string, labelName string")
    projects = spark.createDataFrame([], "_id string, orgId string, projectName string, projectStatus string, "
                                         "projectLogo string, completionDate string, projectPublishStatus string")
    out = lead_360(leads, logs, projects, empty).collect()
    assert len(out) == 1
    row, log_row = out[0].asDict(recursive=True), logs.collect()[0].asDict(recursive=True)
    for src, dst in COMM_COLUMNS:
        assert row[dst] == log_row[src], (src, dst)
    lead_row = leads.collect()[0].asDict()
    for dst, src in LEAD_COLUMNS:
        assert row[dst] == lead_row[src], (src, dst)
