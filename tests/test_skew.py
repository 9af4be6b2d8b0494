"""Hot keys: one key (or NULL) holding a third of the rows must not change results, and NULL keys must
not reach the shuffle join."""

import contextlib
import io

from pyspark.sql import functions as F

from goldleaf.operators import quality
from goldleaf.operators.denorm import denormalize
from goldleaf.operators.joins import left_lookup
from goldleaf.operators.upsert import latest_per_key
from micro import micro_tables


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_null_member_third_bypasses_shuffle_join(spark):
    orders = spark.range(30_000).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise((F.col("id") % 1000).cast("string")).alias("member_id"))
    members = spark.range(1000).select(F.col("id").cast("string").alias("member_id"),
                                       F.concat(F.lit("m"), F.col("id")).alias("member_nm"))
    out = left_lookup(orders, members, "member_id", broadcast_dim=False)
    plan = _plan(out)
    assert "SortMergeJoin" in plan and "Union" in plan
    row = out.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("member_nm").isNull()).alias("unmatched")).first()
    assert (row.n, row.unmatched) == (30_000, 10_000)


def test_silver_same_with_and_without_broadcasts(spark):
    t = micro_tables(spark)
    shuffled = denormalize(t, max_broadcast_rows=0)
    broadcast = denormalize(t)
    assert "SortMergeJoin" in _plan(shuffled)
    assert sorted(shuffled.collect()) == sorted(broadcast.collect())


def test_hot_key_counts_are_exact(spark):
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(
        F.col("id").cast("string")).alias("k"))
    row = quality.key_group_counts({"t": (df, ["k"])}).first()
    assert (row.dup, row.groups, row.rows) == (1, 40_001, 60_000)
    dups = quality.find_duplicate_keys(df, ["k"]).collect()
    assert [(r.k, r.n) for r in dups] == [("HOT", 20_000)]


def test_latest_per_key_with_hot_key(spark):
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("id"),
        F.col("id").cast("string").alias("v"),
        (F.lit("2024-01-01").cast("timestamp") + F.make_interval(secs=F.col("id"))).alias("ts"))
    out = latest_per_key(df, ["id"], "ts")
    assert out.count() == 40_001
    assert out.where("id = 'HOT'").first().v == "59997"
