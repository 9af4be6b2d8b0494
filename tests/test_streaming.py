"""Streaming bronze ingest: progress kept by the stream checkpoint, late files never win."""

from datetime import datetime as T

import pytest

from goldleaf.operators.quality import QualityGateError
from goldleaf.session import scratch_path
from goldleaf.sources.lake import VersionedStore
from goldleaf.spec import TableSpec
from goldleaf.streaming import stream_ingest

SCHEMA = "id string, v string, last_updated_timestamp timestamp"
SPEC = TableSpec("items", ["id"])


def _land(spark, landing, rows):
    spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(landing)


def _run(spark, landing, store, ckpt):
    from pyspark.sql.types import _parse_datatype_string
    q = stream_ingest(spark, SPEC, landing, _parse_datatype_string(SCHEMA), store, ckpt, as_of="2024-01-20 00:00:00")
    q.awaitTermination(300)
    if q.exception():
        raise q.exception()


def test_stream_batches_upsert_in_order_and_skip_late_rows(spark):
    root = scratch_path(spark, "test-stream")
    landing, ckpt = f"{root}/landing", f"{root}/checkpoint"
    store = VersionedStore(spark, f"{root}/bronze")
    _land(spark, landing, [("a", "1", T(2024, 1, 2)), ("b", "1", T(2024, 1, 2)), ("a", "0", T(2024, 1, 1))])
    _run(spark, landing, store, ckpt)
    assert sorted(tuple(r) for r in store.read("items").select("id", "v").collect()) == [("a", "1"), ("b", "1")]
    # a late file (older change for 'a'), a tie for 'b', a new key
    _land(spark, landing, [("a", "old", T(2024, 1, 1)), ("b", "2", T(2024, 1, 2)), ("c", "1", T(2024, 1, 3))])
    _run(spark, landing, store, ckpt)
    got = sorted(tuple(r) for r in store.read("items").select("id", "v").collect())
    assert got == [("a", "1"), ("b", "2"), ("c", "1")]
    assert store.latest("items")[1] == "2024-01-03 00:00:00"
    _run(spark, landing, store, ckpt)  # nothing new: no new version
    assert store.latest("items")[0] == 2


def test_stream_stops_on_rejected_batch(spark):
    root = scratch_path(spark, "test-stream")
    store = VersionedStore(spark, f"{root}/bronze")
    _land(spark, f"{root}/landing", [(None, "1", T(2024, 1, 2))])
    with pytest.raises(Exception, match="null_key"):
        _run(spark, f"{root}/landing", store, f"{root}/checkpoint")
    assert store.latest("items") is None
