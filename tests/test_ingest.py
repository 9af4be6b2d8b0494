"""Incremental ingest: marks, strict '>' semantics, rejections, idempotence, composite keys."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from goldleaf.operators.hwm import next_hwm, read_increment
from goldleaf.operators.upsert import latest_per_key, merge_rows, upsert
from goldleaf.plans.bronze import ingest_table
from goldleaf.session import scratch_path
from goldleaf.sources.lake import VersionedStore
from goldleaf.spec import LOAD_COLUMN, TableSpec

SCHEMA = "id string, v string, last_updated_timestamp timestamp"
SPEC = TableSpec("items", ["id"])
AS_OF = "2024-01-20 00:00:00"
T = datetime


def _src(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _store(spark):
    return VersionedStore(spark, scratch_path(spark, "test-ingest"))


def _rows(store, table="items"):
    return sorted((r.id, r.v) for r in store.read(table).collect())


def test_first_load_reads_everything_including_null_timestamps(spark):
    store = _store(spark)
    src = _src(spark, [("a", "1", T(2024, 1, 1)), ("b", "1", None), ("c", "1", T(2024, 1, 3))])
    res = ingest_table(spark, SPEC, src, store, AS_OF)
    assert (res.status, res.rows, res.version) == ("loaded", 3, 1)
    assert res.watermark == "2024-01-03 00:00:00"
    assert _rows(store) == [("a", "1"), ("b", "1"), ("c", "1")]
    assert LOAD_COLUMN in store.read("items").columns
    assert "/_landing/" in store.location("items", 1)  # first load committed in place, not rewritten


def test_all_null_timestamps_load_once(spark):
    store = _store(spark)
    src = _src(spark, [("a", "1", None), ("b", "1", None)])
    res = ingest_table(spark, SPEC, src, store, AS_OF)
    assert res.status == "loaded" and res.watermark == "1900-01-01 00:00:01"
    assert ingest_table(spark, SPEC, src, store, AS_OF).status == "empty"


def test_tie_with_mark_is_skipped_unless_overlap(spark):
    store = _store(spark)
    ingest_table(spark, SPEC, _src(spark, [("a", "1", T(2024, 1, 5))]), store, AS_OF)
    late = _src(spark, [("a", "1", T(2024, 1, 5)), ("b", "late", T(2024, 1, 5))])
    assert ingest_table(spark, SPEC, late, store, AS_OF).status == "empty"
    res = ingest_table(spark, SPEC, late, store, AS_OF, overlap=timedelta(hours=1))
    assert res.status == "loaded" and res.watermark == "2024-01-05 00:00:00"
    assert _rows(store) == [("a", "1"), ("b", "late")]


@pytest.mark.parametrize("bad_rows,check", [
    ([("x", "1", T(2024, 1, 9)), (None, "1", T(2024, 1, 9))], "null_key"),
    ([("x", "1", T(2024, 1, 9)), ("x", "2", T(2024, 1, 9))], "duplicate_keys"),
    ([("x", "1", T(2999, 1, 9))], "timestamp_range"),
])
def test_bad_increment_is_rejected_and_nothing_moves(spark, bad_rows, check):
    store = _store(spark)
    ingest_table(spark, SPEC, _src(spark, [("a", "1", T(2024, 1, 5))]), store, AS_OF)
    res = ingest_table(spark, SPEC, _src(spark, bad_rows), store, AS_OF)
    assert res.status == "rejected" and any(p.startswith(check) for p in res.problems)
    assert store.latest("items") == (1, "2024-01-05 00:00:00")
    assert _rows(store) == [("a", "1")]


def test_replayed_increment_changes_nothing_but_load_time(spark):
    store = _store(spark)
    src = _src(spark, [("a", "1", T(2024, 1, 5)), ("b", "2", T(2024, 1, 6))])
    ingest_table(spark, SPEC, src, store, AS_OF)
    before = _rows(store)
    res = ingest_table(spark, SPEC, src, store, AS_OF, overlap=timedelta(days=10))
    assert res.status == "loaded" and res.version == 2
    assert _rows(store) == before and res.watermark == "2024-01-06 00:00:00"


def test_update_insert_and_no_delete(spark):
    store = _store(spark)
    ingest_table(spark, SPEC, _src(spark, [("a", "1", T(2024, 1, 1)), ("b", "1", T(2024, 1, 1))]), store, AS_OF)
    # 'b' deleted at the source, 'a' changed, 'c' new
    ingest_table(spark, SPEC, _src(spark, [("a", "2", T(2024, 1, 2)), ("c", "1", T(2024, 1, 2))]), store, AS_OF)
    assert _rows(store) == [("a", "2"), ("b", "1"), ("c", "1")]


def test_mark_never_moves_back(spark):
    store = _store(spark)
    ingest_table(spark, SPEC, _src(spark, [("a", "1", T(2024, 1, 9))]), store, AS_OF)
    older = _src(spark, [("z", "1", T(2024, 1, 8, 12))])
    res = ingest_table(spark, SPEC, older, store, AS_OF, overlap=timedelta(days=1))
    assert res.status == "loaded" and res.watermark == "2024-01-09 00:00:00"


def test_composite_key_keeps_every_pair(spark):
    spec = TableSpec("pizzatypetopping", ["pizza_type_id", "pizza_topping_id"])
    schema = "pizza_type_id string, pizza_topping_id string, last_updated_timestamp timestamp"
    store = _store(spark)
    first = spark.createDataFrame([("T1", "P1", T(2024, 1, 1)), ("T1", "P2", T(2024, 1, 1))], schema)
    ingest_table(spark, spec, first, store, AS_OF)
    second = spark.createDataFrame([("T1", "P3", T(2024, 1, 2)), ("T2", "P1", T(2024, 1, 2))], schema)
    ingest_table(spark, spec, second, store, AS_OF)
    got = sorted(tuple(r) for r in store.read(spec.name).select(*spec.keys).collect())
    assert got == [("T1", "P1"), ("T1", "P2"), ("T1", "P3"), ("T2", "P1")]


def test_keep_latest_resolves_duplicates(spark):
    store = _store(spark)
    src = _src(spark, [("a", "old", T(2024, 1, 1)), ("a", "new", T(2024, 1, 2)), ("b", "1", T(2024, 1, 1))])
    assert ingest_table(spark, SPEC, src, store, AS_OF).status == "rejected"
    res = ingest_table(spark, SPEC, src, store, AS_OF, keep_latest=True)
    assert res.status == "loaded" and _rows(store) == [("a", "new"), ("b", "1")]


def test_read_increment_pushable_form(spark):
    src = _src(spark, [("a", "1", None), ("b", "1", T(2024, 1, 2))])
    assert read_increment(src, "last_updated_timestamp", None).count() == 2  # first load takes NULLs
    assert read_increment(src, "last_updated_timestamp", "1900-01-01 00:00:01").count() == 1
    row = next_hwm(read_increment(src, "last_updated_timestamp", "2024-01-05"), "last_updated_timestamp",
                   "2024-01-05", "items").collect()[0]
    assert row.watermark_value == T(2024, 1, 5)  # empty increment keeps the mark


def test_merge_rows_broadcast_and_shuffle_agree(spark):
    target = spark.range(0, 1000).select(F.col("id").cast("string").alias("id"), F.lit("t").alias("v"))
    source = spark.range(900, 1100).select(F.col("id").cast("string").alias("id"), F.lit("s").alias("v"))
    a = sorted(merge_rows(target, source, ["id"], True).collect())
    b = sorted(merge_rows(target, source, ["id"], False).collect())
    assert a == b and len(a) == 1100 and sum(r.v == "s" for r in a) == 200


def test_latest_per_key_is_one_row_per_key(spark):
    df = _src(spark, [("a", str(i), T(2024, 1, 1) + timedelta(minutes=i)) for i in range(50)])
    out = latest_per_key(df, ["id"], "last_updated_timestamp").collect()
    assert len(out) == 1 and out[0].v == "49"


def test_upsert_creates_then_merges(spark):
    store = _store(spark)
    assert upsert(store, "items", _src(spark, [("a", "1", None)]), ["id"]) == 1
    assert upsert(store, "items", _src(spark, [("a", "2", None)]), ["id"], source_rows=1) == 2
    assert _rows(store) == [("a", "2")]


def test_upsert_commit_does_not_grow_with_files_and_paths_may_have_spaces(spark):
    store = VersionedStore(spark, scratch_path(spark, "test ingest"))
    target = spark.range(0, 400).repartitionByRange(8, "id").select(
        F.col("id").cast("string").alias("id"), F.lit("t").alias("v"), F.lit(None).cast("timestamp").alias("ts"))
    store.publish({"items": target})
    source = spark.createDataFrame([("5", "s", None), ("7", "s", None), ("new", "s", None)], "id string, v string, ts timestamp")
    assert upsert(store, "items", source, ["id"]) == 2
    assert store.location("items", 2) == store.path("items", 2)  # one folder, whatever the number of files
    got = {r.id: r.v for r in store.read("items").collect()}
    assert len(got) == 401 and got["5"] == got["7"] == got["new"] == "s" and got["6"] == "t"
    assert upsert(store, "items", spark.createDataFrame([("none", "s", None)], source.schema), ["id"]) == 3
    assert store.read("items").count() == 402


def test_upsert_casts_to_the_target_types(spark):
    store = _store(spark)
    upsert(store, "items", spark.createDataFrame([("a", 1), ("b", 2)], "id string, n int"), ["id"])
    upsert(store, "items", spark.createDataFrame([(3, "b"), (4, "c")], "n bigint, id string"), ["id"])
    assert sorted(tuple(r) for r in store.read("items").collect()) == [("a", 1), ("b", 3), ("c", 4)]
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        upsert(store, "items", spark.createDataFrame([("d", 2**40)], "id string, n bigint"), ["id"])
    assert store.latest("items")[0] == 2 and store.read("items").count() == 3


@pytest.mark.parametrize("first,second,later", [
    ("UTC", "America/New_York", ["2024-01-05 12:00:00Z", "2024-01-05 13:00:00Z"]),
    ("America/New_York", "America/New_York", ["2023-11-05 05:30:00Z", "2023-11-05 06:15:00Z"]),  # 01:30, then 01:15 again
    ("Asia/Seoul", "UTC", ["2024-01-05 12:00:00Z", "2024-01-05 12:00:01Z"]),
])
def test_mark_is_an_instant(spark, first, second, later):
    store, zone = _store(spark), spark.conf.get("spark.sql.session.timeZone")

    def source(n):
        rows = [(f"k{i}", "1", t) for i, t in enumerate(later[:n])]
        return spark.createDataFrame(rows, "id string, v string, t string").select(
            "id", "v", F.col("t").cast("timestamp").alias("last_updated_timestamp"))

    try:
        spark.conf.set("spark.sql.session.timeZone", first)
        ingest_table(spark, SPEC, source(1), store, AS_OF)
        spark.conf.set("spark.sql.session.timeZone", second)
        res = ingest_table(spark, SPEC, source(2), store, AS_OF)
        assert (res.status, res.rows, res.watermark) == ("loaded", 1, later[1].rstrip("Z"))
        assert ingest_table(spark, SPEC, source(2), store, AS_OF).status == "empty"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
