"""Silver stage: check the bronze tables, denormalise, check the result, publish."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from goldleaf.operators import quality
from goldleaf.operators.denorm import denormalize
from goldleaf.operators.history import CheckHistory
from goldleaf.sources.lake import VersionedStore, materialize
from goldleaf.spec import AUDIT_COLUMNS, TABLE_KEYS

SILVER_TABLE = "ods_orders"


def silver_store(spark: SparkSession, lake_root: str) -> VersionedStore:
    return VersionedStore(spark, f"{lake_root.rstrip('/')}/silver")


def build_silver(spark: SparkSession, tables: Mapping[str, DataFrame], store: VersionedStore,
                 history: CheckHistory | None = None, run_id: str | None = None) -> DataFrame:
    """Check the sources' keys, stage silver, check the staged table, then commit or raise.

    A repeated key would multiply rows in the joins, so it stops the run before anything wide is written. The
    wide table is then written once to an uncommitted version; the post-join checks read what was written (no
    cache that an executor loss could drop, no second evaluation of the joins). Only when no critical check
    failed is the version committed. Returns the check results; with ``history`` they are kept, whatever
    the outcome, under ``run_id`` (the version, if not given).
    """
    clean = {k: v.drop(*[c for c in AUDIT_COLUMNS if c in v.columns]) for k, v in tables.items()}
    version = store.next_version()

    def checked(report: DataFrame) -> DataFrame:
        report = materialize(report, "silver-report")  # kept, gated and returned: worked out once
        if history is not None:
            history.record(report, "silver", run_id or f"{version:08d}")
        return quality.gate(report, "silver")

    before = quality.duplicate_pk_checks(clean, TABLE_KEYS)
    keys = materialize(before, "silver-keys")
    if keys.where("NOT passed").count():
        checked(keys)
    store.stage(version, {SILVER_TABLE: denormalize(clean)})
    staged = store.read_staged(SILVER_TABLE, version)
    report = checked(quality.union_results([keys, quality.silver_row_report(clean, staged)]))
    store.commit(version, [SILVER_TABLE])
    return report


def silver_history(spark: SparkSession, lake_root: str) -> CheckHistory:
    return CheckHistory(spark, f"{lake_root.rstrip('/')}/checks")


def run_silver(spark: SparkSession, lake_root: str, run_id: str | None = None) -> DataFrame:
    from goldleaf.plans.bronze import read_bronze

    return build_silver(spark, read_bronze(spark, lake_root), silver_store(spark, lake_root),
                        silver_history(spark, lake_root), run_id)
