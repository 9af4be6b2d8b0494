"""The three stages wired together on the micro fixture: bronze -> silver -> gold, with gates."""

import contextlib
import io
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from goldleaf.operators.quality import FACT_REQUIRED, QualityGateError
from goldleaf.plans.bronze import BronzeError, read_bronze, run_bronze
from goldleaf.plans.gold import GOLD_TABLES, gold_store, read_gold, run_gold
from goldleaf.plans.silver import SILVER_TABLE, run_silver, silver_store
from goldleaf.session import scratch_path
from micro import micro_tables

AS_OF = "2024-01-20 00:00:00"


def _sources(spark, drop_lines=()):
    ts = F.lit(datetime(2024, 1, 1)).cast("timestamp")
    return {k: v.withColumn("last_updated_timestamp", ts) for k, v in micro_tables(spark, drop_lines).items()}


def test_end_to_end_publishes_all_gold_tables(spark):
    lake = scratch_path(spark, "test-lake")
    results = run_bronze(spark, _sources(spark, drop_lines=("4",)), lake, as_of=AS_OF)
    assert [r.status for r in results] == ["loaded"] * 8
    assert read_bronze(spark, lake)["orderdetail"].count() == 7
    run_silver(spark, lake)
    assert silver_store(spark, lake).read(SILVER_TABLE).count() == 8  # lines 1, 2, 3, 7 x two toppings
    run_gold(spark, lake)
    gold = read_gold(spark, lake)
    assert set(gold) == set(GOLD_TABLES)
    assert gold["fact_order"].count() == 8 and gold["dim_member"].where("member_id = '0'").count() == 1


def test_gold_gate_blocks_publication(spark):
    lake = scratch_path(spark, "test-lake")
    run_bronze(spark, _sources(spark), lake, as_of=AS_OF)
    run_silver(spark, lake)
    with pytest.raises(QualityGateError, match="pizza_topping_id"):
        run_gold(spark, lake)
    assert gold_store(spark, lake).latest() is None  # staged, never committed
    report = run_gold(spark, lake, required_fks=[c for c in FACT_REQUIRED if c != "pizza_topping_id"])
    assert report.where("NOT passed AND severity = 'fail'").count() == 0  # a NULL optional key is no orphan
    assert gold_store(spark, lake).latest() is not None


def test_bronze_rejects_one_table_and_continues(spark):
    lake = scratch_path(spark, "test-lake")
    src = _sources(spark)
    src["member"] = src["member"].unionByName(src["member"].where("member_id = 'M1'"))  # duplicate key
    with pytest.raises(BronzeError, match="member") as err:
        run_bronze(spark, src, lake, as_of=AS_OF)
    status = {r.table: r.status for r in err.value.results}
    assert status["member"] == "rejected" and status["topping"] == "loaded"


def test_second_bronze_run_is_empty(spark):
    lake = scratch_path(spark, "test-lake")
    src = _sources(spark)
    run_bronze(spark, src, lake, as_of=AS_OF)
    assert {r.status for r in run_bronze(spark, src, lake, as_of=AS_OF)} == {"empty"}


def test_gold_fact_partitioned_by_month_prunes(spark):
    from goldleaf.operators.denorm import denormalize
    from goldleaf.plans.gold import build_gold
    from goldleaf.sources.lake import VersionedStore, write_mart
    silver = denormalize(micro_tables(spark, drop_lines=("4",)))
    store = VersionedStore(spark, scratch_path(spark, "test-gold-month"))
    build_gold(spark, silver, store, partition_fact_by_month=True)
    fact = store.read("fact_order")
    feb = fact.where("year = 2015 AND month = 2")
    assert feb.count() == 2
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        feb.explain()
    assert "PartitionFilters" in buf.getvalue() and "month" in buf.getvalue()
    path = write_mart(spark.createDataFrame([(1,)], "a int"), scratch_path(spark, "mart"), "t")
    assert spark.read.parquet(path).count() == 1


def test_command_line_stages(spark, capsys):
    from goldleaf.plans.__main__ import main
    root = scratch_path(spark, "test-cli")
    for name, df in _sources(spark).items():
        df.write.parquet(f"{root}/src/{name}")
    lake = f"{root}/lake"
    assert main(["bronze", "--lake", lake, "--source-root", f"{root}/src"]) == 0
    assert "orderdetail: loaded rows=8" in capsys.readouterr().out
    assert main(["silver", "--lake", lake]) == 0
    assert main(["gold", "--lake", lake]) == 1  # item type T3 has no topping: strict gate blocks
    assert main(["gold", "--lake", lake, "--optional-fk", "pizza_topping_id"]) == 0


def test_float_price_source_reaches_gold(spark):
    lake = scratch_path(spark, "test-lake")
    src = _sources(spark, drop_lines=("4",))
    src["pizza"] = src["pizza"].withColumn("price", (F.col("price") + F.lit(0.10)).cast("float"))
    run_bronze(spark, src, lake, as_of=AS_OF)
    run_silver(spark, lake)
    run_gold(spark, lake)
    fact = read_gold(spark, lake)["fact_order"]
    assert fact.schema["unit_price"].dataType == fact.sparkSession.read.parquet(
        silver_store(spark, lake).path(SILVER_TABLE, 1)).schema["price"].dataType
    assert fact.where("order_detail_id = '1'").select("unit_price", "total_price").distinct().collect() == [
        (Decimal("10.10"), Decimal("20.20"))]
