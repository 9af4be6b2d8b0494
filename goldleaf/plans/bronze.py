"""Bronze stage: incremental ingest of each source table into a versioned lake table."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import timedelta

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from goldleaf.operators.hwm import advance, newest_change, read_increment
from goldleaf.operators.quality import BLOCKING, bronze_checks
from goldleaf.operators.quarantine import judged, keep_rejected
from goldleaf.operators.upsert import latest_per_key, upsert
from goldleaf.sources.lake import VersionedStore
from goldleaf.spec import HWM_FLOOR, LOAD_COLUMN, SOURCE_TABLES, TABLE_SPECS, TableSpec


@dataclass
class IngestResult:
    table: str
    status: str  # loaded | empty | rejected | failed
    rows: int = 0
    version: int | None = None
    watermark: str | None = None
    problems: tuple[str, ...] = ()
    quarantined: int = 0


class BronzeError(RuntimeError):
    """At least one table was rejected or failed; the other tables were still processed."""

    def __init__(self, results: Sequence[IngestResult]):
        self.results = list(results)
        bad = [f"{r.table} {r.status}: {'; '.join(r.problems)}" for r in self.results if r.status in ("rejected", "failed")]
        super().__init__("bronze ingest did not load all tables:\n" + "\n".join(bad))


def bronze_store(spark: SparkSession, lake_root: str, table: str) -> VersionedStore:
    return VersionedStore(spark, f"{lake_root.rstrip('/')}/bronze/{table}")


def declared_types(source: DataFrame, spec: TableSpec) -> DataFrame:
    """``source`` with the columns that the spec's schema declares cast to their types."""
    declared = {f.name: f.dataType for f in spec.schema.fields} if spec.schema else {}
    changed = [f.name for f in source.schema.fields if f.name in declared and f.dataType != declared[f.name]]
    return source.withColumns({c: F.col(f"`{c}`").cast(declared[c]) for c in changed}) if changed else source


def ingest_table(spark: SparkSession, spec: TableSpec, source: DataFrame, store: VersionedStore,
                 as_of: str | None = None, overlap: timedelta | None = None, keep_latest: bool = False,
                 quarantine: bool = False) -> IngestResult:
    """Read the increment after the stored mark, check it, upsert it and advance the mark.

    Columns of ``spec.schema`` are read with their declared types (a floating-point price becomes a decimal).

    1. mark: the watermark of the table's last commit (1900-01-01 00:00:00 when there is none);
    2. increment: rows changed after the mark (NULL change time counts as 1900-01-01 00:00:01);
    3. the increment is stamped with the load time and landed once in the shared folder — the only
       read of the source; its row count and newest change time are observed during that write;
    4. empty increment: nothing else happens;
    5. checks on the landed rows (keys present, non-NULL and unique; change times plausible); any
       rejection leaves target and mark unchanged. With ``quarantine`` rows are judged one by one instead: bad
       ones are kept, with their reasons, in the store's quarantine table, and the good ones go on; the mark
       then follows the good rows, so a bad row newer than them is read again until it is mended;
    6. keyed upsert on all key columns, published together with the new mark (never moving back).
    Replaying a run is safe: the upsert is idempotent and the mark only moves forward.
    """
    source = declared_types(source, spec)
    head = store.latest(spec.name)
    last = head[1] if head and head[1] else HWM_FLOOR
    has_change = spec.change_col in source.columns
    inc = read_increment(source, spec.change_col, last, overlap=overlap) if has_change else source
    stamped = inc.withColumn(LOAD_COLUMN, F.current_timestamp())

    obs = Observation(f"increment_{spec.name}")
    metrics = [F.count(F.lit(1)).alias("rows")]
    if has_change:
        metrics.append(newest_change(source, spec.change_col).alias("newest"))
    landing = f"{store.root}/_landing/{uuid.uuid4().hex}"
    stamped.observe(obs, *metrics).write.mode("errorifexists").parquet(landing)
    observed = obs.get
    rows = int(observed["rows"])
    if rows == 0:
        return IngestResult(spec.name, "empty", 0, head[0] if head else None, last)

    landed = spark.read.parquet(landing)
    if keep_latest and has_change:
        landed = latest_per_key(landed, spec.keys, spec.change_col)
    rejected, newest = 0, observed["newest"] if has_change else None
    if quarantine:
        verdicts = judged(spark, landed, spec.keys, spec.change_col if has_change else None, as_of, f"{store.root}/_judged")
        rejected = keep_rejected(store, verdicts)
        landed = verdicts.where("size(reasons) = 0").drop("reasons")
        if rejected == rows:
            return IngestResult(spec.name, "empty", 0, head[0] if head else None, last, quarantined=rejected)
        if rejected and has_change:
            newest = landed.agg(newest_change(landed, spec.change_col)).first()[0]
    checks = bronze_checks(landed, spec.name, spec.keys, spec.change_col if has_change else None, as_of)
    failed = checks.where(F.col("severity").isin(*BLOCKING) & ~F.coalesce("passed", F.lit(False))).collect()
    if failed:
        problems = tuple(f"{r['check']} {r['subject']}: {r['observed']}" for r in failed)
        return IngestResult(spec.name, "rejected", rows, head[0] if head else None, last, problems)

    mark = advance(last, newest) if has_change else last
    if head is None and not keep_latest and not rejected:
        # first load: the landed folder is already the complete table; commit it without a rewrite
        return IngestResult(spec.name, "loaded", rows, store.adopt(spec.name, landing, mark), mark)
    version = upsert(store, spec.name, landed, spec.keys, mark, source_rows=rows, head=head)
    return IngestResult(spec.name, "loaded", rows - rejected, version, mark, quarantined=rejected)


def run_bronze(spark: SparkSession, sources: Mapping[str, DataFrame], lake_root: str,
               specs: Mapping[str, TableSpec] = TABLE_SPECS, tables: Sequence[str] = SOURCE_TABLES,
               as_of: str | None = None, raise_on_reject: bool = True, concurrent: int = 4,
               quarantine: bool = False) -> list[IngestResult]:
    """Ingest every table, ``concurrent`` at a time; one that is rejected or fails does not stop the others.

    Each table's jobs run in a scheduler pool of their own (the session's mode is FAIR), so a small table does
    not wait behind a large one. Results come in the order of ``tables``. Raises :class:`BronzeError` at the end
    when any table was not loaded (a non-zero exit for the scheduler).
    """
    def ingest(table: str) -> IngestResult:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"bronze-{table}")
        try:
            return ingest_table(spark, specs[table], sources[table], bronze_store(spark, lake_root, table), as_of,
                                quarantine=quarantine)
        except Exception as e:  # an unreadable source, a schema that does not fit, a failed job
            return IngestResult(table, "failed", problems=(f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}",))
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=max(1, concurrent)) as pool:
        results = list(pool.map(inheritable_thread_target(spark)(ingest), tables))
    if raise_on_reject and any(r.status in ("rejected", "failed") for r in results):
        raise BronzeError(results)
    return results


def read_bronze(spark: SparkSession, lake_root: str, tables: Sequence[str] = SOURCE_TABLES) -> dict[str, DataFrame]:
    return {t: bronze_store(spark, lake_root, t).read(t) for t in tables}
