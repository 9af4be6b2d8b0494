"""What stored tables take on disk: compact files, no shuffle files left, buckets that follow the lines."""

import hashlib
import time

import pytest
from pyspark.sql import functions as F

from goldleaf.operators import denorm, quality, star
from goldleaf.plans import registry
from goldleaf.sources import catalog
from goldleaf.sources.lake import FREE_SHUFFLES, materialize
from goldleaf.spec import SILVER_COLUMNS, SOURCE_TABLES
from micro import micro_tables

SF = "/root/testdata/sf0.001"


def _repeated(spark):
    """The micro tables with lines, an order, an item, a member and a pair that come twice, and lines without an item."""
    t = micro_tables(spark)
    for name, cond in (("orderdetail", "order_detail_id IN ('2', '3')"), ("orders", "order_id = 2"), ("pizza", "pizza_id = 'T2_m'"),
                       ("member", "member_id = 'M1'"), ("pizzatypetopping", "pizza_type_id = 'T1' AND pizza_topping_id = 'P1'")):
        t[name] = t[name].unionByName(t[name].where(cond))
    t["orderdetail"] = t["orderdetail"].unionByName(
        t["orderdetail"].where("order_id = 1").withColumn("pizza_id", F.lit(None).cast("string")))
    return t


def _rows(df, cols):
    return sorted(str(tuple(r)) for r in df.select(*cols).collect())


def _shuffle_blocks(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {n for n in (blocks.apply(i).name() for i in range(blocks.size())) if n.startswith("shuffle_")}


def test_a_stored_table_is_compact_and_leaves_no_shuffle_files(spark):
    df = spark.range(1000).withColumn("name", F.md5(F.col("id").cast("string")))
    namespace, before = catalog.scratch_namespace(spark, "t_compact"), _shuffle_blocks(spark)
    kept = (catalog.replace_table(df, f"{namespace}.rows", "id", 3), materialize(df.repartition(3, "id"), "t-compact"))
    for _ in range(50):  # files are removed in the background
        left = _shuffle_blocks(spark) - before
        if not left:
            break
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(FREE_SHUFFLES, "false") == "false"
    for table in kept:
        assert all(".zstd." in f for f in table.inputFiles()) and _rows(table, df.columns) == _rows(df, df.columns)


def test_buckets_follow_the_lines(spark, monkeypatch):
    monkeypatch.setattr(catalog, "BUCKET_ROWS", 3)
    namespace = catalog.scratch_namespace(spark, "t_follow")
    tables = micro_tables(spark)
    catalog.build_bronze_tables(tables, namespace, 1)
    for name in catalog.ORDER_BUCKETED:  # 8 lines
        about = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {namespace}.{name}").collect()}
        assert about["Num Buckets"] == "3"
        assert spark.table(f"{namespace}.{name}").count() == tables[name].count()


@pytest.mark.parametrize("fitting", [set(), {"pizzatypes", "branch"}], ids=["none fits", "two fit"])
def test_bucketed_lines_meet_their_orders_where_they_lie(spark, monkeypatch, fitting):
    tables = _repeated(spark)
    want = _rows(denorm.denormalize(tables), SILVER_COLUMNS)
    namespace = catalog.scratch_namespace(spark, "t_lie")
    catalog.build_bronze_tables(tables, namespace, 4)
    monkeypatch.setattr(denorm, "small_tables", lambda t, *a: fitting & set(t))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = denorm.denormalize(catalog.bronze_tables(spark, namespace, SOURCE_TABLES), by_order=True)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert _rows(out, SILVER_COLUMNS) == want
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = plan[:plan.index(".orderdetail[")].rsplit("SortMergeJoin [order_id", 1)[1]
    assert "Exchange" not in lines  # from the join with the orders down to the scan of the lines


def test_row_parity_stores_compact_rows_and_sums_no_decimals(spark, monkeypatch):
    kept, real = [], registry.materialize
    monkeypatch.setattr(registry, "materialize", lambda *a: (kept.append(real(*a)), kept[-1])[1])
    out = registry.all_queries()["check_row_parity"](spark, SF)
    assert len(kept) == 2 and all(".zstd." in f for table in kept for f in table.inputFiles())
    assert [r["passed"] for r in out.collect()] == [True, True]
    assert "sum(cast" not in quality.content_hash(spark.range(3))._jdf.queryExecution().optimizedPlan().toString().lower()


def test_content_is_the_sum_of_the_rows_digests(spark):
    rows = [(i, None if i % 3 == 0 else "é" * (i % 4)) for i in range(40)]
    text = lambda v: "-" if v is None else f"{len(str(v))}:{v}"
    want = sum(int(hashlib.md5("".join(map(text, r)).encode()).hexdigest()[:quality.HASH_DIGITS], 16) for r in rows)
    found = quality.content_hash(spark.createDataFrame(rows, "k int, v string")).first()
    assert (found["rows"], int(found["content"])) == (40, want)


def test_type_and_topping_tables_share_one_pass_over_silver(spark):
    silver, stored = denorm.denormalize(_repeated(spark)), []
    shared = star.build_star(silver, lambda df: (stored.append(df.columns), materialize(df, "t-shared"))[1])
    assert len(stored) == 1
    for name, df in star.build_star(silver).items():
        assert shared[name].columns == df.columns
        assert _rows(shared[name], df.columns) == _rows(df, df.columns)
    for name in ("dim_pizza_type", "dim_pizza_topping", "bridge_pizza_type_topping"):
        assert "t-shared" in shared[name].inputFiles()[0]
