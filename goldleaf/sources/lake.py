"""Lake tables: plain reads and writes, and versioned snapshots for formats without MERGE.

A :class:`VersionedStore` keeps each table as a series of complete snapshot folders
``{root}/{table}/v={n}`` and an append-only commit log ``{root}/_commits``. A version becomes visible
only when its commit row is appended, after every snapshot of that version is fully written, so a job
that dies mid-write leaves the previous version intact and the half-written folder invisible. One commit
can publish several tables together (the gold star), and carries the table's high-water mark, so data
and mark move in a single step. Everything is written through Spark into the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMIT_SCHEMA = T.StructType([
    T.StructField("version", T.LongType(), False),
    T.StructField("tables", T.ArrayType(T.StringType()), False),
    T.StructField("watermark_value", T.StringType()),  # text, typed on use by the change column
    T.StructField("committed_at", T.StringType()),
    # table -> folder, for versions whose data was written elsewhere first (e.g. a landed increment)
    T.StructField("locations", T.MapType(T.StringType(), T.StringType())),
])


# Rows that repeat most of the row before (a line's toppings) take about half the room that snappy needs, and less time.
COMPACT_PARQUET = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """A write in this block removes its shuffle files when it ends; they would stay until the driver collects garbage."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", options: Mapping[str, str] | None = None) -> DataFrame:
    return spark.read.format(fmt).options(**(options or {})).load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: Sequence[str] | None = None, options: Mapping[str, str] | None = None) -> None:
    """Write a table. For Delta, schema replacement on overwrite is requested explicitly."""
    w = df.write.format(fmt).mode(mode).options(**(options or {}))
    if fmt == "delta" and mode == "overwrite":
        w = w.option("overwriteSchema", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def _missing_path(e: AnalysisException) -> bool:
    cls = getattr(e, "getCondition", None) or getattr(e, "getErrorClass", None)
    name = cls() if cls else None
    return name == "PATH_NOT_FOUND" or "Path does not exist" in str(e)


class VersionedStore:
    """Snapshot-per-version tables under one root with an append-only commit log."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt

    # -- commit log -------------------------------------------------------------------------------
    def _log(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(COMMIT_SCHEMA).json(f"{self.root}/_commits")
        except AnalysisException as e:
            if _missing_path(e):
                return None
            raise

    def latest(self, table: str | None = None) -> tuple[int, str | None] | None:
        """(version, watermark) of the newest commit (that includes ``table``), or None."""
        log = self._log()
        if log is None:
            return None
        if table is not None:
            log = log.where(F.array_contains("tables", table))
        row = log.orderBy(F.col("version").desc()).select("version", "watermark_value").first()
        return None if row is None else (row["version"], row["watermark_value"])

    def exists(self, table: str) -> bool:
        return self.latest(table) is not None

    def path(self, table: str, version: int) -> str:
        return f"{self.root}/{table}/v={version:08d}"

    def location(self, table: str, version: int) -> str:
        """Folder holding ``table`` at a committed ``version``."""
        log = self._log()
        row = None if log is None else log.where(F.col("version") == version).select(
            F.col("locations")[table].alias("loc")).first()
        return row["loc"] if row is not None and row["loc"] else self.path(table, version)

    # -- data -------------------------------------------------------------------------------------
    def read_version(self, table: str, version: int) -> DataFrame:
        return read_table(self.spark, self.location(table, version), self.fmt)

    def read(self, table: str) -> DataFrame:
        log = self._log()
        row = None if log is None else (
            log.where(F.array_contains("tables", table)).orderBy(F.col("version").desc())
            .select("version", F.col("locations")[table].alias("loc")).first())
        if row is None:
            raise FileNotFoundError(f"no committed version of {table} under {self.root}")
        return read_table(self.spark, row["loc"] or self.path(table, row["version"]), self.fmt)

    def read_staged(self, table: str, version: int) -> DataFrame:
        """A table of a version that is written but not committed."""
        return read_table(self.spark, self.path(table, version), self.fmt)

    def next_version(self) -> int:
        log = self._log()
        if log is None:
            return 1
        row = log.agg(F.max("version").alias("v")).first()
        return 1 if row is None or row["v"] is None else row["v"] + 1

    def stage(self, version: int, frames: Mapping[str, DataFrame],
              partition_by: Mapping[str, Sequence[str]] | None = None) -> None:
        """Write the snapshot folders of ``version`` (invisible until :meth:`commit`).

        The writes are independent jobs and are submitted together, so small dimension writes share the
        cluster with the large one instead of queueing behind it.
        """
        def write(item):
            name, df = item
            write_table(df, self.path(name, version), self.fmt, "overwrite", (partition_by or {}).get(name))

        with ThreadPoolExecutor(max_workers=max(1, min(8, len(frames)))) as pool:
            # threads take the caller's job properties with them; the first failure is raised
            list(pool.map(inheritable_thread_target(self.spark)(write), frames.items()))

    def commit(self, version: int, tables: Sequence[str], watermark: str | None = None,
               locations: Mapping[str, str] | None = None) -> None:
        row = self.spark.createDataFrame(
            [(version, list(tables), watermark, dict(locations) if locations else None)],
            "version bigint, tables array<string>, watermark_value string, locations map<string,string>",
        ).withColumn("committed_at", F.current_timestamp().cast("string"))
        row.select(*COMMIT_SCHEMA.fieldNames()).coalesce(1).write.mode("append").json(f"{self.root}/_commits")

    def adopt(self, table: str, folder: str, watermark: str | None = None, version: int | None = None) -> int:
        """Commit an already written, complete folder as the next version of ``table`` (no copy)."""
        version = version or self.next_version()
        self.commit(version, [table], watermark, {table: folder})
        return version

    def publish(self, frames: Mapping[str, DataFrame], watermark: str | None = None,
                partition_by: Mapping[str, Sequence[str]] | None = None, version: int | None = None) -> int:
        """Stage all frames as one new version, then commit them together. Returns the version.

        ``version`` may be passed by a caller that has just read the log (one writer per store)."""
        version = version or self.next_version()
        self.stage(version, frames, partition_by)
        self.commit(version, list(frames), watermark)
        return version


def write_mart(df: DataFrame, root: str, name: str, fmt: str = "parquet", options: Mapping[str, str] | None = None,
               partition_by: Sequence[str] | None = None) -> str:
    """Full overwrite of one warehouse table ``{root}/{name}`` through any ``DataFrameWriter`` format
    (parquet by default; a warehouse connector's format name and options where one is installed)."""
    path = f"{root.rstrip('/')}/{name}"
    write_table(df, path, fmt, "overwrite", partition_by, options)
    return path


def materialize(df: DataFrame, name: str = "stage", partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once as Parquet to a new folder under the shared root and return a reader of it.

    For a plan with several consumers: each reads the written columns it needs instead of re-running
    the plan, and the lineage is cut (a lost executor re-reads files, it does not recompute joins).
    """
    from goldleaf.session import scratch_path

    spark = df.sparkSession
    path = scratch_path(spark, name)
    with shuffles_freed(spark):
        df.write.mode("errorifexists").options(**COMPACT_PARQUET).partitionBy(*partition_by).parquet(path)
    return (spark.read.schema(df.schema) if partition_by else spark.read).parquet(path)  # no rows: no partition to read it from


def snapshot_copy(tables: Mapping[str, DataFrame], store: VersionedStore) -> int:
    """Full copy of every source table into a staging store, published as one version."""
    return store.publish(dict(tables))
