"""Run one stage as a Spark application: ``python -m goldleaf.plans {bronze,silver,gold} --lake PATH``.

Exit status 0 when the stage published, 1 when a check blocked it (the report is printed), so a
scheduler sees a failed stage as failed. Sources for bronze are either files (``--source-root`` with
one folder per table) or a JDBC database (``--jdbc-url``; user and password are read from the
environment variables named by ``--user-env`` / ``--password-env``), read in ``--jdbc-slices`` parallel queries
a table. ``--warehouse-url`` or ``--warehouse-root`` gives gold a sink besides the lake.
"""

from __future__ import annotations

import argparse
import os
import sys

from goldleaf.operators.quality import FACT_REQUIRED, QualityGateError
from goldleaf.plans.bronze import BronzeError, bronze_store, run_bronze
from goldleaf.plans.gold import run_gold
from goldleaf.plans.silver import run_silver
from goldleaf.session import build_session
from goldleaf.sources.jdbc import jdbc_tables
from goldleaf.sources.sinks import FolderSink, JdbcSink
from goldleaf.spec import SOURCE_TABLES


def _sources(spark, args):
    if args.jdbc_url:
        props = {"user": os.environ.get(args.user_env, ""), "password": os.environ.get(args.password_env, "")}
        props = {k: v for k, v in props.items() if v}
        if args.jdbc_driver:
            props["driver"] = args.jdbc_driver
        marks = {t: bronze_store(spark, args.lake, t).latest(t) for t in SOURCE_TABLES} if args.jdbc_slices > 1 else {}
        return jdbc_tables(spark, args.jdbc_url, props, SOURCE_TABLES, slices=args.jdbc_slices,
                           marks={t: head[1] for t, head in marks.items() if head and head[1]})
    if not args.source_root:
        raise SystemExit("bronze needs --jdbc-url or --source-root")
    return {t: spark.read.format(args.source_format).load(f"{args.source_root.rstrip('/')}/{t}") for t in SOURCE_TABLES}


def _sink(spark, args):
    if args.warehouse_url:
        props = {"user": os.environ.get(args.user_env, ""), "password": os.environ.get(args.password_env, "")}
        if args.jdbc_driver:
            props["driver"] = args.jdbc_driver
        return JdbcSink(spark, args.warehouse_url, {k: v for k, v in props.items() if v}, rename=args.warehouse_rename)
    return FolderSink(spark, args.warehouse_root, args.warehouse_format) if args.warehouse_root else None


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="python -m goldleaf.plans")
    p.add_argument("stage", choices=["bronze", "silver", "gold"])
    p.add_argument("--lake", required=True, help="root folder of the bronze/silver/gold stores")
    p.add_argument("--source-root")
    p.add_argument("--source-format", default="parquet")
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-driver")
    p.add_argument("--jdbc-slices", type=int, default=1, help="parallel queries a table, by change time")
    p.add_argument("--concurrent", type=int, default=4, help="source tables ingested at a time (bronze)")
    p.add_argument("--quarantine", action="store_true", help="set bad rows aside instead of rejecting the table (bronze)")
    p.add_argument("--warehouse-url", help="JDBC database to publish gold to")
    p.add_argument("--warehouse-rename", default="ALTER TABLE {old} RENAME TO {new}")
    p.add_argument("--warehouse-root", help="folder to publish gold to")
    p.add_argument("--warehouse-format", default="parquet")
    p.add_argument("--user-env", default="SOURCE_DB_USER")
    p.add_argument("--password-env", default="SOURCE_DB_PASSWORD")
    p.add_argument("--optional-fk", action="append", default=[], help="fact key allowed to be NULL (gold)")
    args = p.parse_args(argv)
    spark = build_session(f"goldleaf-{args.stage}")
    try:
        if args.stage == "bronze":
            for r in run_bronze(spark, _sources(spark, args), args.lake, concurrent=args.concurrent, quarantine=args.quarantine):
                print(f"{r.table}: {r.status} rows={r.rows} version={r.version} mark={r.watermark} quarantined={r.quarantined}")
        elif args.stage == "silver":
            report = run_silver(spark, args.lake)
            for r in report.where("NOT passed AND severity = 'warning'").collect():  # at most one row per check
                print(f"warning: {r['check']} on {r['subject']}: observed {r['observed']}, expected {r['expected']}")
        else:
            run_gold(spark, args.lake, [c for c in FACT_REQUIRED if c not in args.optional_fk], _sink(spark, args))
        return 0
    except (QualityGateError, BronzeError) as e:
        print(e, file=sys.stderr)
        return 1


if __name__ == "__main__":
    sys.exit(main())
