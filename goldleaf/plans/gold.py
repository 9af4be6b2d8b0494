"""Gold stage: build the star from silver, check it, publish all eight tables in one commit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.operators import quality
from goldleaf.operators.star import build_star
from goldleaf.sources.lake import VersionedStore

GOLD_TABLES = ["dim_pizza", "dim_member", "dim_pizza_type", "dim_date", "dim_branch", "dim_pizza_topping",
               "bridge_pizza_type_topping", "fact_order"]

FILES_A_MONTH = 8  # files of a month of the fact; on a cluster: month bytes / 256 MB


def gold_store(spark: SparkSession, lake_root: str) -> VersionedStore:
    return VersionedStore(spark, f"{lake_root.rstrip('/')}/gold")


def with_month_partitions(fact: DataFrame) -> DataFrame:
    """The fact with ``year`` and ``month`` columns, to be written partitioned by them: marts filtered to
    a period then read only that period's folders (partition pruning)."""
    return fact.withColumn("year", F.year("date")).withColumn("month", F.month("date"))


def build_gold(spark: SparkSession, silver: DataFrame, store: VersionedStore,
               required_fks: Sequence[str] = quality.FACT_REQUIRED,
               partition_by: Mapping[str, Sequence[str]] | None = None,
               partition_fact_by_month: bool = False, sink=None) -> DataFrame:
    """Stage the eight tables, check the staged tables, and commit them together or raise.

    A ``sink`` (:mod:`goldleaf.sources.sinks`) is then given the committed tables: it shows all eight or none.

    Each dimension is computed once (by its write); checks read the written tables. Because all eight
    are committed in one step, readers never see a new fact next to old dimensions. ``required_fks``
    lists the fact keys that must not be NULL (all six by default, as the warehouse requires; leave out
    ``pizza_topping_id`` to accept item types without toppings).
    """
    version = store.next_version()
    frames = build_star(silver)
    if partition_fact_by_month:
        frames["fact_order"] = with_month_partitions(frames["fact_order"]).repartition("year", "month", F.pmod(
            F.xxhash64("order_detail_id"), F.lit(FILES_A_MONTH)))  # else every task writes a file per month
        partition_by = {**(partition_by or {}), "fact_order": ["year", "month"]}
    store.stage(version, frames, partition_by)
    staged = {t: store.read_staged(t, version) for t in GOLD_TABLES}
    report = quality.gold_report(silver, staged, required_fks)
    quality.gate(report, "gold")
    store.commit(version, GOLD_TABLES)
    if sink is not None:
        sink.publish({t: store.read_version(t, version) for t in GOLD_TABLES})
    return report


def run_gold(spark: SparkSession, lake_root: str, required_fks: Sequence[str] = quality.FACT_REQUIRED, sink=None) -> DataFrame:
    from goldleaf.plans.silver import SILVER_TABLE, silver_store

    silver = silver_store(spark, lake_root).read(SILVER_TABLE)
    return build_gold(spark, silver, gold_store(spark, lake_root), required_fks, sink=sink)


def read_gold(spark: SparkSession, lake_root: str) -> dict[str, DataFrame]:
    store = gold_store(spark, lake_root)
    return {t: store.read(t) for t in GOLD_TABLES}
