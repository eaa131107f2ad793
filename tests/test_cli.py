"""The command line maps arguments to the job runners."""

import pytest

from leadlake.__main__ import _pairs, build_parser


def test_parser_covers_every_job():
    p = build_parser()
    a = p.parse_args(["--conf", "spark.x=1", "lead_360", "--lead-flat", "a", "--logs", "b",
                      "--projects", "c", "--labels", "d", "--target", "t"])
    assert (a.job, a.lead_flat, a.target, _pairs(a.conf)) == ("lead_360", "a", "t", {"spark.x": "1"})
    a = p.parse_args(["sync", "--table", "s.x=y", "--url", "jdbc:x", "--jdbc-password-env", "PW"])
    assert _pairs(a.table) == {"s.x": "y"} and a.jdbc_password_env == "PW"
    for job in ("lead_flat", "comm_logs", "sms_engagement", "whatsapp_engagement", "campaign_response"):
        with pytest.raises(SystemExit):
            p.parse_args([job])  # required inputs are enforced


def test_pairs_rejects_bad_items():
    with pytest.raises(SystemExit):
        _pairs(["novalue"])
