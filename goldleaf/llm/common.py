"""Helpers shared by the operators: worker imports, written intermediate tables, Arrow text batches, folds."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import goldleaf
from goldleaf.session import scratch_path

# Rows whose crc32(doc_id as text) leaves this remainder are never learned from.
FOLDS, HELD_OUT_FOLD = 4, 2
KEYS_BROADCAST = 500_000


def importable_on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it.

    On a cluster the package is shipped as any library is (``--py-files`` or an environment); a path
    that does not exist there is ignored by Python.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(goldleaf.__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the cluster's shared folder, and read back.

    Cuts the lineage and fixes generated ids: later reads, and retries after a lost executor, see the
    same rows.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove the files of tables that :func:`written` made and nothing reads any more."""
    for df in tables:
        jvm = df.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


_NARROW = {"Project", "Filter", "SubqueryAlias"}


def _place_in_file(df: DataFrame) -> DataFrame | None:
    """``_file, _row`` of each row if ``df`` is a plain scan of files that number their rows, else None.

    Joins, unions and the like are none: rows that they repeat would share a place.
    """
    plan = df._jdf.queryExecution().analyzed()
    while plan.getClass().getSimpleName() in _NARROW:
        plan = plan.children().head()
    if plan.getClass().getSimpleName() != "LogicalRelation":
        return None
    try:
        place = df.metadataColumn("_metadata")  # whatever columns the table has
        return df.select(place["file_path"].alias("_file"), place["row_index"].alias("_row"))
    except AnalysisException:  # a source without files, or whose files do not number their rows
        return None


def stored(df: DataFrame) -> DataFrame:
    """``df`` itself if its rows have a place in stored files, else a written copy of it."""
    return written(df, "stored") if _place_in_file(df) is None else df


def row_numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a number ``name`` (from 0, 63 bits) per row that every scan of it repeats.

    The number is made of the row's file and its place in it, not of partitions: those move when the number
    of cores does, between two scans, or between a task and its retry. Files are told apart by a hash of
    their path in the bits that the longest file leaves over, under the first seed that gives all files
    different hashes. Only counts reach the driver. A frame that is no plain scan is written first: frames
    made from the same source then get different numbers, so pass :func:`stored` ones where that matters.
    """
    df = stored(df)
    place = _place_in_file(df)
    longest = (place.agg(F.max("_row")).first()[0] or 0) + 1
    row_bits = longest.bit_length()
    file_of = lambda path, seed: F.shiftrightunsigned(F.xxhash64(path, F.lit(seed)), row_bits + 1)
    files = place.groupBy("_file").agg(F.lit(1).alias("_"))
    for seed in range(0, 64, 8):
        n, *different = files.agg(F.count(F.lit(1)), *[
            F.count_distinct(file_of(F.col("_file"), s)) for s in range(seed, seed + 8)]).first()
        if n in different:
            chosen = seed + different.index(n)
            own = df.metadataColumn("_metadata")
            number = F.shiftleft(file_of(own["file_path"], chosen), row_bits).bitwiseOR(own["row_index"])
            return df.select("*", number.alias(name))
    raise ValueError(f"{n} files with up to {longest} rows cannot be told apart in 63 bits")


def broadcast_if_few(keys: DataFrame, max_rows: int = KEYS_BROADCAST) -> DataFrame:
    """``keys`` (a written table of one or two long columns) marked for broadcast if it has at most
    ``max_rows`` rows, a few MB; beyond that unchanged, and the join shuffles both sides."""
    return F.broadcast(keys) if keys.count() <= max_rows else keys


def free_name(df: DataFrame, name: str) -> str:
    """A column name derived from ``name`` that ``df`` does not use (case-insensitively)."""
    used = {c.lower() for c in df.columns}
    while name.lower() in used:
        name += "_"
    return name


def utf8(column: pa.Array) -> list[bytes | None]:
    """The texts of an Arrow string column as UTF-8 bytes, nulls kept."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        return column.cast(pa.large_binary()).to_pylist()
    return column.cast(pa.binary()).to_pylist()


def text_of(data: bytes | None) -> str:
    """The text of UTF-8 bytes, empty for null; bytes that are not valid become U+FFFD."""
    return (data or b"").decode(errors="replace")


_KEPT: dict[str, dict] = {}  # per Python worker, by operator


def kept_by(operator: str) -> dict:
    """What a Python worker keeps for an operator's next tasks (caches only), until another operator's task
    that :func:`tidied` wraps runs in it."""
    return _KEPT.setdefault(operator, {})


def let_go_of_others(operator: str) -> None:
    for name, cache in _KEPT.items():
        if name != operator:
            cache.clear()


def release_memory() -> None:
    """Give back to the system what this Python worker has freed: it idles until a later stage needs it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def tidied(operator: str, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``function`` of batches for ``mapInArrow``. Workers are reused by all stages of an application, so what other
    operators keep in this one goes before the task, and what the task has freed goes back after it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go_of_others(operator)
        try:
            yield from function(batches)
        finally:
            release_memory()

    return run


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that Python objects exist for a few texts at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def held_out(doc_id: Column) -> Column:
    """True for rows of the held-out fold; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT_FOLD, F.lit(False))
