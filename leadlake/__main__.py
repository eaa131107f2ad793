"""Command line: run one job, e.g. from spark-submit.

  python -m leadlake lead_flat --bronze s3a://b/leads --target lake.sales.leads
  spark-submit leadlake/__main__.py lead_360 --lead-flat lake.sales.leads \\
      --logs lake.sales.logs --projects s3a://b/projects --labels s3a://b/labels \\
      --target lake.marts.lead_dim --conf spark.sql.catalog.lake=...

``--conf key=value`` (repeatable) is passed to the session, so catalogs and table
formats are configured by the deployment, not in code.  JDBC credentials for
``sync`` come from ``--jdbc-property key=value`` or the environment variables
named by ``--jdbc-user-env`` / ``--jdbc-password-env``.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession

if __package__ in (None, ""):  # run as a script by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from leadlake.functions.time import LOCAL_TZ  # noqa: E402
from leadlake.plans import jobs  # noqa: E402
from leadlake.plans.engagement import PHONE_RULES  # noqa: E402
from leadlake.session import create_session  # noqa: E402
from leadlake.sources.jdbc import DEFAULT_CONNECTIONS  # noqa: E402


def _pairs(items: list[str]) -> dict[str, str]:
    out = {}
    for item in items or []:
        key, sep, value = item.partition("=")
        if not sep:
            raise SystemExit(f"expected key=value, got {item!r}")
        out[key] = value
    return out


def _engagement_options(s: argparse.ArgumentParser) -> None:
    s.add_argument("--tz", default=LOCAL_TZ, help="time zone of the days")
    s.add_argument("--phone-rule", choices=sorted(PHONE_RULES), default="digits",
                   help="how a log's number finds its lead")


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="leadlake", description=__doc__.splitlines()[0])
    p.add_argument("--conf", action="append", default=[], help="Spark setting key=value (repeatable)")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="job", required=True)

    s = sub.add_parser("lead_flat", help="M1")
    s.add_argument("--bronze", required=True)
    s.add_argument("--target", required=True)

    s = sub.add_parser("comm_logs", help="M2")
    s.add_argument("--bronze", required=True)
    s.add_argument("--target", required=True)

    s = sub.add_parser("lead_360", help="M3")
    for a in ("--lead-flat", "--logs", "--projects", "--labels", "--target"):
        s.add_argument(a, required=True)

    s = sub.add_parser("sms_engagement", help="M4")
    for a in ("--sms", "--campaigns", "--lead-360", "--target"):
        s.add_argument(a, required=True)
    s.add_argument("--org-column", default=None)
    _engagement_options(s)

    s = sub.add_parser("whatsapp_engagement", help="M5")
    for a in ("--whatsapp", "--campaigns", "--lead-360", "--target"):
        s.add_argument(a, required=True)
    _engagement_options(s)

    s = sub.add_parser("campaign_response", help="M6")
    for a in ("--sms", "--whatsapp", "--email", "--lead-360", "--target"):
        s.add_argument(a, required=True)
    s.add_argument("--tz", default=LOCAL_TZ, help="time zone of the days")
    s.add_argument("--sms-rules", choices=sorted(jobs.SMS_RULES), default="shipped")
    s.add_argument("--keep-dim-duplicates", action="store_true",
                   help="join every row of the lead dimension, not one per lead")

    s = sub.add_parser("sync", help="M7: copy tables to a database (full refresh)")
    s.add_argument("--table", action="append", required=True, help="source=target (repeatable)")
    s.add_argument("--url", required=True)
    s.add_argument("--jdbc-property", action="append", default=[])
    s.add_argument("--jdbc-user-env", default=None)
    s.add_argument("--jdbc-password-env", default=None)
    s.add_argument("--truncate", action="store_true")
    s.add_argument("--num-partitions", type=int, default=DEFAULT_CONNECTIONS, help="connections at once")
    return p


def run(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    """Run one job; with ``spark`` in that session, which is left open."""
    args = build_parser().parse_args(argv)
    own = spark is None
    if spark is None:
        spark = create_session(f"leadlake-{args.job}", master=args.master, conf=_pairs(args.conf))
    try:
        if args.job == "lead_flat":
            jobs.run_lead_flat(spark, args.bronze, args.target)
        elif args.job == "comm_logs":
            jobs.run_communication_logs(spark, args.bronze, args.target)
        elif args.job == "lead_360":
            jobs.run_lead_360(spark, args.lead_flat, args.logs, args.projects, args.labels, args.target)
        elif args.job == "sms_engagement":
            jobs.run_sms_engagement(spark, args.sms, args.campaigns, args.lead_360, args.target,
                                    org_column=args.org_column, tz=args.tz, phone_rule=args.phone_rule)
        elif args.job == "whatsapp_engagement":
            jobs.run_whatsapp_engagement(spark, args.whatsapp, args.campaigns, args.lead_360, args.target,
                                         tz=args.tz, phone_rule=args.phone_rule)
        elif args.job == "campaign_response":
            jobs.run_campaign_response(spark, args.sms, args.whatsapp, args.email, args.lead_360, args.target,
                                       tz=args.tz, sms_rules=args.sms_rules,
                                       dedupe_dim=not args.keep_dim_duplicates)
        elif args.job == "sync":
            props = _pairs(args.jdbc_property)
            if args.jdbc_user_env:
                props["user"] = os.environ[args.jdbc_user_env]
            if args.jdbc_password_env:
                props["password"] = os.environ[args.jdbc_password_env]
            counts = jobs.run_sync_to_rdbms(spark, _pairs(args.table), args.url, props,
                                            truncate=args.truncate, num_partitions=args.num_partitions)
            print(json.dumps(counts))
    finally:
        if own:
            spark.stop()


if __name__ == "__main__":
    run()
