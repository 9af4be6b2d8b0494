"""Size-checked broadcast and the NULL-key-safe left lookup."""

from pyspark.sql import functions as F

from goldleaf.operators.denorm import bridge_fanout
from goldleaf.operators.joins import BROADCAST_MAX_ROWS, left_lookup, sized_broadcast, small_result, small_tables


def test_size_check_boundary(spark):
    ten, eleven = spark.range(10), spark.range(11)
    assert small_tables({"ten": ten, "eleven": eleven}, max_rows=10) == {"ten"}
    assert small_tables({}, 10) == set()
    # an aggregate is measured by its result rows, not its input
    agg = spark.range(100_000).groupBy((F.col("id") % 7).alias("k")).count()
    assert small_tables({"agg": agg}, max_rows=7) == {"agg"}
    assert sized_broadcast(eleven, 10) is eleven


def test_size_check_counts_bytes(spark):
    """Few rows may be many bytes: texts, nested values and NULLs are measured, also under odd column names."""
    rows = [(1, "x" * 900, None, [1, 2]), (2, None, b"yy", None)]
    df = spark.createDataFrame(rows, "id int, `a``b.c` string, b binary, n array<int>")
    assert small_tables({"t": df}, 10, max_bytes=940) == {"t"}  # 2 x 16 + 900 + 2 + "[1, 2]"
    assert small_tables({"t": df}, 10, max_bytes=939) == set()
    assert sized_broadcast(df, 10, max_bytes=939) is df
    assert small_tables({"none": df.where("id > 2")}, 0, 0) == {"none"}


def test_multiplied_results_are_not_broadcast(spark):
    """Two small tables with one repeated key make more rows than may be broadcast."""
    n = 500
    bridge = spark.range(n).select(F.lit("t").alias("pizza_type_id"), F.lit("k").alias("pizza_topping_id"))
    topping = spark.range(n).select(F.lit("k").alias("pizza_topping_id"), F.col("id").cast("string").alias("pizza_topping_nm"))
    assert n < BROADCAST_MAX_ROWS < n * n
    tables = {"pizzatypetopping": bridge, "topping": topping,
              "pizza": spark.createDataFrame([("p", "t")], "pizza_id string, pizza_type_id string"),
              "orderdetail": spark.createDataFrame([("1", "p"), ("2", "p")], "order_detail_id string, pizza_id string")}
    wide = bridge_fanout(tables)
    joined = bridge.join(topping, "pizza_topping_id", "left")
    assert small_result(joined, {"pizzatypetopping", "topping"}, {"pizzatypetopping", "topping"}) is joined
    assert wide.count() == 2 * n * n
    assert small_result(topping, {"topping"}, {"topping"}) is not topping
    assert small_result(topping, {"topping", "bridge"}, {"topping"}) is topping


def test_left_lookup_paths_agree(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "zz"), (4, "a")], "id int, k string")
    dim = spark.createDataFrame([("a", "A"), ("b", "B")], "k string, name string")
    shuffled = sorted(left_lookup(df, dim, "k").select("id", "k", "name").collect())
    broadcast = sorted(left_lookup(df, dim, "k", broadcast_dim=True).select("id", "k", "name").collect())
    assert shuffled == broadcast == [(1, "a", "A"), (2, None, None), (3, "zz", None), (4, "a", "A")]
