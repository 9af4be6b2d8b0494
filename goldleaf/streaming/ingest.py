"""Bronze ingest as a Structured Streaming query over a landing folder.

The file source remembers, in its checkpoint, which files it has consumed: that replaces the stored
high-water mark, so no change-time filter is applied and rows with equal or late timestamps are not
lost. Each micro-batch goes through the same steps as a batch increment (``foreachBatch``):

1. duplicates of a key inside the batch are resolved to the newest change (partial aggregation);
2. the bronze checks run on the batch; a blocking failure raises, which stops the query before its
   checkpoint records the batch, so the files are delivered again after the data is fixed;
3. rows older than the target's current row for their key are dropped (late files never overwrite
   newer data), the rest are upserted and committed with the newest change time as mark.

A replayed batch (after a failure between commit and checkpoint) rewrites identical rows: the upsert
is idempotent.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from goldleaf.operators.hwm import advance, newest_change
from goldleaf.operators.joins import BROADCAST_MAX_ROWS
from goldleaf.operators.quality import bronze_checks, gate
from goldleaf.operators.upsert import latest_per_key, newer_rows, upsert
from goldleaf.sources.lake import VersionedStore
from goldleaf.spec import LOAD_COLUMN, TableSpec


def _process(spark: SparkSession, spec: TableSpec, store: VersionedStore, as_of: str | None):
    def run(batch: DataFrame, batch_id: int) -> None:
        landing = f"{store.root}/_landing/batch-{batch_id}-{uuid.uuid4().hex[:8]}"  # next to the table, as in batch ingest
        batch.withColumn(LOAD_COLUMN, F.current_timestamp()).write.mode("errorifexists").parquet(landing)
        landed = spark.read.parquet(landing)
        stats = landed.agg(F.count(F.lit(1)).alias("rows"),
                           newest_change(landed, spec.change_col).alias("newest")).first()
        if not stats["rows"]:
            return
        gate(bronze_checks(landed, spec.name, spec.keys, spec.change_col, as_of,
                           checks=("null_key", "timestamp_range")), f"bronze stream {spec.name}")
        fresh = latest_per_key(landed, spec.keys, spec.change_col)
        small = stats["rows"] <= BROADCAST_MAX_ROWS  # the batch's keys may be broadcast
        head = store.latest(spec.name)
        if head is not None:
            fresh = newer_rows(store.read_version(spec.name, head[0]), fresh, spec.keys, spec.change_col, small)
        mark = advance(head[1] if head else None, stats["newest"])
        upsert(store, spec.name, fresh, spec.keys, mark, source_rows=stats["rows"], head=head)
    return run


def stream_ingest(spark: SparkSession, spec: TableSpec, landing: str, schema: T.StructType, store: VersionedStore,
                  checkpoint: str, fmt: str = "parquet", as_of: str | None = None,
                  available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the ingest query; with ``available_now`` it processes what has landed and stops."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    writer = (reader.load(landing).writeStream.foreachBatch(_process(spark, spec, store, as_of))
              .option("checkpointLocation", checkpoint).queryName(f"bronze_{spec.name}"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
