"""Catalog tables, warehouse sinks and parallel JDBC reads (embedded Derby: in this process, no port)."""

import os
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from goldleaf.operators.denorm import denormalize
from goldleaf.operators.hwm import read_increment
from goldleaf.operators.star import build_star
from goldleaf.plans.gold import GOLD_TABLES, build_gold
from goldleaf.session import scratch_path
from goldleaf.sources import catalog
from goldleaf.sources.jdbc import change_time_slices, jdbc_source, jdbc_tables, remainder_slices, text_slices, time_slices
from goldleaf.sources.lake import VersionedStore
from goldleaf.sources.sinks import CatalogSink, FolderSink, JdbcSink
from goldleaf.spec import SOURCE_TABLES
from micro import micro_tables

PROPS = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_of(df, cols):
    return sorted(str(tuple(r)) for r in df.select(*cols).collect())


# --- catalog ---------------------------------------------------------------------------------------------

def test_silver_and_gold_from_the_catalog(spark):
    tables = micro_tables(spark)
    bronze, silver, gold = (catalog.scratch_namespace(spark, f"t_{x}") for x in ("bronze", "silver", "gold"))
    catalog.build_bronze_tables(tables, bronze, 4)
    wide = catalog.build_silver_table(spark, bronze, silver, SOURCE_TABLES)
    want = denormalize(tables)
    assert rows_of(wide, want.columns) == rows_of(want, want.columns)
    star = catalog.build_gold_tables(spark, silver, gold)
    assert set(star) == set(GOLD_TABLES)
    for name, df in build_star(want).items():
        assert rows_of(spark.table(f"{gold}.{name}"), df.columns) == rows_of(df, df.columns)


def test_lines_and_orders_join_without_an_exchange(spark):
    namespace = catalog.scratch_namespace(spark, "t_buckets")
    catalog.build_bronze_tables(micro_tables(spark), namespace, 4)
    own = catalog.bronze_tables(spark, namespace, ["orders", "orderdetail"])
    joined = own["orderdetail"].join(own["orders"], "order_id")
    plan = plan_of(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.count() == 6


def test_a_failed_replacement_leaves_the_old_table(spark):
    namespace = catalog.scratch_namespace(spark, "t_replace")
    table = f"{namespace}.numbers"
    catalog.replace_table(spark.range(5), table)
    broken = spark.range(9).withColumn("id", F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("planted"))))
    with pytest.raises(Exception, match="planted"):
        catalog.replace_table(broken, table)
    assert spark.table(table).count() == 5
    catalog.replace_table(spark.range(7), table, bucket_by="id", buckets=2)
    assert spark.table(table).count() == 7
    assert [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {namespace}").collect()] == ["numbers"]


# --- sinks -----------------------------------------------------------------------------------------------

def sinks(spark):
    name = os.urandom(4).hex()
    return [FolderSink(spark, scratch_path(spark, "sink")), CatalogSink(spark, catalog.scratch_namespace(spark, "t_sink")),
            JdbcSink(spark, f"jdbc:derby:memory:sink{name};create=true", PROPS, rename="RENAME TABLE {old} TO {new}")]


@pytest.mark.parametrize("kind", [0, 1, 2], ids=["folder", "catalog", "jdbc"])
def test_all_tables_or_none_are_published(spark, kind):
    sink = sinks(spark)[kind]
    star = build_star(denormalize(micro_tables(spark, drop_lines=("4",))))
    # Derby has no zero-length names or Unicode limits here; the star is published as it is
    sink.publish(star)
    counts = {t: sink.read(t).count() for t in GOLD_TABLES}
    assert counts["fact_order"] == 8 and counts["dim_member"] == star["dim_member"].count()
    more = build_star(denormalize(micro_tables(spark)))
    broken = more | {"dim_branch": more["dim_branch"].withColumn("bran_nm", F.raise_error(F.lit("planted")).cast("string"))}
    with pytest.raises(Exception, match="planted"):
        sink.publish(broken)
    assert {t: sink.read(t).count() for t in GOLD_TABLES} == counts
    sink.publish(more)
    assert sink.read("fact_order").count() == more["fact_order"].count() == 9
    assert sink.read("fact_order").agg(F.sum("total_price")).first()[0] == more["fact_order"].agg(F.sum("total_price")).first()[0]
    if kind == 1:  # nothing staged is left
        names = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {sink.namespace}").collect()]
        assert len(names) == 2 * len(GOLD_TABLES)


def test_views_move_back_when_one_cannot_move(spark, monkeypatch):
    sink = CatalogSink(spark, catalog.scratch_namespace(spark, "t_back"))
    sink.publish({"a": spark.range(1), "b": spark.range(1)})
    real = sink._show

    def show(name, table):
        if name == "b" and spark.table(table).count() == 2:
            raise RuntimeError("planted")
        real(name, table)

    monkeypatch.setattr(sink, "_show", show)
    with pytest.raises(RuntimeError, match="planted"):
        sink.publish({"a": spark.range(2), "b": spark.range(2)})
    assert sink.read("a").count() == 1 and sink.read("b").count() == 1


def test_gold_stage_publishes_to_a_sink(spark):
    sink = sinks(spark)[2]
    silver = denormalize(micro_tables(spark, drop_lines=("4",)))
    build_gold(spark, silver, VersionedStore(spark, scratch_path(spark, "t_gold")), sink=sink)
    fact = {r["order_detail_id"]: r["total_price"] for r in sink.read("fact_order").collect()}
    assert fact["1"] == Decimal("20.00") and len(fact) == 4


# --- parallel reads ---------------------------------------------------------------------------------------

URL = "jdbc:derby:memory:slices;create=true"


def seed(spark, table, rows):
    frame = spark.createDataFrame(rows, "order_detail_id string, quantity int, last_updated_timestamp timestamp")
    frame.coalesce(1).write.format("jdbc").options(
        url=URL, dbtable=table, createTableColumnTypes="order_detail_id VARCHAR(64)", **PROPS).mode("overwrite").save()


def test_slices_cover_each_row_once(spark):
    rows = [(f"L{i:03d}", i, datetime(2024, 1, 1 + i % 25, i % 24)) for i in range(300)] + [("zz", None, None), ("o'x", -7, None)]
    seed(spark, "lines_a", rows)
    whole = rows_of(jdbc_source(spark, URL, "lines_a", PROPS), ["order_detail_id", "quantity", "last_updated_timestamp"])
    spans = change_time_slices(spark, URL, "lines_a", PROPS, 6)
    for slices in (spans, text_slices('"order_detail_id"', ["L050", "L200", "o'x", "L200"]), remainder_slices('"quantity"', 5),
                   time_slices('"last_updated_timestamp"', datetime(2024, 1, 9), datetime(2024, 1, 9), 4)):
        read = jdbc_source(spark, URL, "lines_a", PROPS, slices=slices)
        assert read.rdd.getNumPartitions() == len(slices) > 1
        assert rows_of(read, read.columns) == whole
    assert len(spans) == 6
    increment = read_increment(jdbc_source(spark, URL, "lines_a", PROPS, slices=spans), "last_updated_timestamp", "2024-01-20 00:00:00")
    assert "last_updated_timestamp" in plan_of(increment).split("PushedFilters")[1]
    assert increment.count() == sum(1 for r in rows if r[2] and r[2] > datetime(2024, 1, 20))


def test_slices_after_a_mark_and_of_empty_tables(spark):
    seed(spark, "lines_b", [(str(i), i, datetime(2024, 1, 1 + i)) for i in range(20)])
    seed(spark, "lines_c", [])
    late = change_time_slices(spark, URL, "lines_b", PROPS, 4, after="2024-01-10 00:00:00")
    assert len(late) == 4 and "2024-01-1" in late[0]
    tables = jdbc_tables(spark, URL, PROPS, ["lines_b", "lines_c"], slices=4, marks={"lines_b": "2024-01-10 00:00:00"})
    assert tables["lines_b"].count() == 20 and tables["lines_b"].rdd.getNumPartitions() == 4
    assert tables["lines_c"].count() == 0


def test_command_line_reads_and_publishes_in_parallel(spark, capsys):
    from goldleaf.plans.__main__ import main
    url = "jdbc:derby:memory:cli;create=true"
    for name, df in micro_tables(spark, drop_lines=("4",)).items():
        df.withColumn("last_updated_timestamp", F.lit(datetime(2024, 1, 1)).cast("timestamp")).write.format("jdbc").options(
            url=url, dbtable=name, **PROPS).mode("overwrite").save()
    lake = scratch_path(spark, "t_cli")
    jdbc = ["--jdbc-url", url, "--jdbc-driver", PROPS["driver"]]
    assert main(["bronze", "--lake", lake, *jdbc, "--jdbc-slices", "3"]) == 0
    assert main(["bronze", "--lake", lake, *jdbc, "--jdbc-slices", "3", "--quarantine"]) == 0
    assert "orderdetail: loaded rows=7" in capsys.readouterr().out
    assert main(["silver", "--lake", lake]) == 0
    assert "warning: cardinality" in capsys.readouterr().out
    out = "jdbc:derby:memory:cliout;create=true"
    assert main(["gold", "--lake", lake, "--warehouse-url", out, "--jdbc-driver", PROPS["driver"],
                 "--warehouse-rename", "RENAME TABLE {old} TO {new}"]) == 0
    assert jdbc_source(spark, out, "fact_order", PROPS).count() == 8
