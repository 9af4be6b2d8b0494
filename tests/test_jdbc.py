"""JDBC source against embedded, in-memory Derby (in-process: no server, no port)."""

import contextlib
import io
from datetime import datetime

from goldleaf.operators.hwm import read_increment
from goldleaf.plans.bronze import ingest_table
from goldleaf.session import scratch_path
from goldleaf.sources.jdbc import jdbc_source
from goldleaf.sources.lake import VersionedStore
from goldleaf.spec import TableSpec

URL = "jdbc:derby:memory:goldleaf_test;create=true"
PROPS = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def _seed(spark, table, rows):
    df = spark.createDataFrame(rows, "order_id int, member_id string, last_updated_timestamp timestamp")
    df.write.format("jdbc").option("url", URL).option("dbtable", table).options(**PROPS).mode("overwrite").save()


def test_partitioned_read_with_pushed_mark(spark):
    rows = [(i, f"M{i % 7}", datetime(2024, 1, 1 + i % 20)) for i in range(200)] + [(500, "M0", None)]
    _seed(spark, "orders_a", rows)
    src = jdbc_source(spark, URL, "orders_a", PROPS, partition_column="order_id", lower_bound=0, upper_bound=200,
                      num_partitions=4)
    assert src.rdd.getNumPartitions() == 4
    inc = read_increment(src, "last_updated_timestamp", "2024-01-15 00:00:00")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        inc.explain()
    plan = buf.getvalue()
    assert "PushedFilters" in plan and "last_updated_timestamp" in plan
    assert inc.count() == sum(1 for r in rows if r[2] is not None and r[2] > datetime(2024, 1, 15))
    assert read_increment(src, "last_updated_timestamp", None).count() == len(rows)  # first load: NULLs too


def test_ingest_from_jdbc_twice(spark):
    _seed(spark, "orders_b", [(1, "M1", datetime(2024, 1, 1)), (2, "M2", datetime(2024, 1, 2))])
    spec = TableSpec("orders", ["order_id"])
    store = VersionedStore(spark, scratch_path(spark, "test-jdbc"))
    src = jdbc_source(spark, URL, "orders_b", PROPS)
    assert ingest_table(spark, spec, src, store, "2024-01-20 00:00:00").rows == 2
    _seed(spark, "orders_b", [(1, "M1", datetime(2024, 1, 1)), (2, "M9", datetime(2024, 1, 3)),
                              (3, "M3", datetime(2024, 1, 3))])
    res = ingest_table(spark, spec, jdbc_source(spark, URL, "orders_b", PROPS), store, "2024-01-20 00:00:00")
    assert res.rows == 2 and res.watermark == "2024-01-03 00:00:00"
    got = sorted((r.order_id, r.member_id) for r in store.read("orders").collect())
    assert got == [(1, "M1"), (2, "M9"), (3, "M3")]


def test_jdbc_tables_with_partitioning(spark):
    from goldleaf.sources.jdbc import jdbc_tables
    _seed(spark, "orders_c", [(i, f"M{i}", datetime(2024, 1, 1)) for i in range(50)])
    _seed(spark, "orders_d", [(1, "M1", None)])
    t = jdbc_tables(spark, URL, PROPS, ["orders_c", "orders_d"], {"orders_c": ("order_id", 0, 50, 5)})
    assert t["orders_c"].rdd.getNumPartitions() == 5 and t["orders_c"].count() == 50
    assert t["orders_d"].count() == 1
