"""Quarantine: an increment's bad rows are set aside with their reasons, its good rows go on.

Reasons: ``null_key`` (a key is NULL or NaN), ``timestamp_range`` (the change time is before 1900 or after the
run), ``duplicate_key`` (several rows of the increment hold the key; none of them is taken, since none is known
to be the right one). A row may have several.

Rejected rows are kept once, however often they are read again: the quarantine table is keyed by a digest of
the row and its reasons.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.operators.joins import small_tables
from goldleaf.operators.quality import find_duplicate_keys, null_or_nan, out_of_range
from goldleaf.operators.schemas import conformed, evolved
from goldleaf.operators.upsert import merge_rows
from goldleaf.sources.lake import VersionedStore
from goldleaf.spec import LOAD_COLUMN

DIGEST = "row_digest"


def reasons(df: DataFrame, keys: Sequence[str], change_col: str | None = None, as_of: str | None = None) -> DataFrame:
    """``df`` with ``reasons``, an array of text, empty for good rows.

    Duplicates are found by a count per key that is reduced map-side, and told to their rows by a join with the
    repeated keys only; rows without a key take no part in it.
    """
    missing = [null_or_nan(df, k) for k in keys]
    no_key = F.array_contains(F.array(*missing), True)
    checks = [F.when(no_key, F.lit("null_key"))]
    if change_col:
        checks.append(F.when(F.coalesce(out_of_range(df, change_col, as_of), F.lit(False)), F.lit("timestamp_range")))
    twice = find_duplicate_keys(df.where(~no_key), keys).select(*keys, F.lit(True).alias("_twice"))
    few = "twice" in small_tables({"twice": twice})
    marked = df.join(F.broadcast(twice) if few else twice, list(keys), "left").select(*[df[c] for c in df.columns], "_twice")
    checks.append(F.when(F.col("_twice"), F.lit("duplicate_key")))
    return marked.withColumn("reasons", F.array_compact(F.array(*checks))).drop("_twice")


def judged(spark: SparkSession, landed: DataFrame, keys: Sequence[str], change_col: str | None, as_of: str | None,
           root: str) -> DataFrame:
    """The landed increment with its reasons, written once: good and rejected rows are both read from it."""
    import uuid

    path = f"{root}/{uuid.uuid4().hex}"
    reasons(landed, keys, change_col, as_of).write.parquet(path)
    return spark.read.parquet(path)


def quarantine_store(store: VersionedStore) -> VersionedStore:
    return VersionedStore(store.spark, f"{store.root}/_quarantine", store.fmt)


def keep_rejected(store: VersionedStore, verdicts: DataFrame) -> int:
    """Add the rejected rows to the store's quarantine table ``rejected``; returns how many there were."""
    cols = [c for c in verdicts.columns if c != LOAD_COLUMN]  # the load time differs each time a row is read again
    bad = verdicts.where("size(reasons) > 0").withColumn(DIGEST, F.sha2(F.to_json(F.struct(*cols)), 256))
    n = bad.count()
    if n:
        bad = bad.groupBy(DIGEST).agg(F.max(F.struct(*verdicts.columns)).alias("_row")).select("_row.*", DIGEST)
        kept = quarantine_store(store)
        head = kept.latest("rejected")
        if head is not None:
            before = kept.read_version("rejected", head[0])
            schema = evolved(before.schema, bad.schema, [DIGEST], "union")
            bad = merge_rows(conformed(bad, schema), conformed(before, schema), [DIGEST], False)  # what is known stays as it is
        kept.publish({"rejected": bad})
    return n


def quarantined(store: VersionedStore) -> DataFrame:
    """Rejected rows with ``reasons``, each once."""
    return quarantine_store(store).read("rejected").drop(DIGEST)
