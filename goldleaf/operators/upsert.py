"""Keyed upsert: matched keys are replaced by the source row, new keys are inserted, nothing is deleted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.operators.joins import BROADCAST_MAX_ROWS, small_tables
from goldleaf.operators.schemas import conformed, evolved, with_kept_values
from goldleaf.sources.lake import VersionedStore


def merge_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], source_is_small: bool | None = None,
               max_broadcast_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """The upserted table: target rows whose key is not in the source, plus every source row.

    All key columns take part in the match. When the source (an increment) passes the size check, its
    keys are broadcast and the target is filtered map-side — the target, however large, is not shuffled.
    Otherwise both sides are shuffled on the keys (sort-merge anti join; AQE splits skewed keys).
    """
    keys = list(keys)
    if source_is_small is None:
        source_is_small = "source" in small_tables({"source": source}, max_broadcast_rows)
    src_keys = source.select(*keys)
    kept = target.join(F.broadcast(src_keys) if source_is_small else src_keys, keys, "left_anti")
    return kept.unionByName(source.select(*target.columns))


def newer_rows(target: DataFrame, source: DataFrame, keys: Sequence[str], change_col: str,
               source_is_small: bool | None = None) -> DataFrame:
    """Source rows that are new keys or at least as recent as the target's row for the same key.

    Used when increments can arrive out of order (streamed files): an older change never overwrites a
    newer one. The target is only filtered to the increment's keys (broadcast semi join, map-side).
    """
    keys = list(keys)
    if source_is_small is None:
        source_is_small = "source" in small_tables({"source": source})
    src_keys = source.select(*keys)
    current = target.select(*keys, F.col(change_col).alias("_current")).join(
        F.broadcast(src_keys) if source_is_small else src_keys, keys, "left_semi")
    return (source.join(current, keys, "left")
            .where(F.col("_current").isNull() | (F.col(change_col) >= F.col("_current")))
            .drop("_current"))


def latest_per_key(df: DataFrame, keys: Sequence[str], change_col: str) -> DataFrame:
    """Keep, per key, the row with the newest change time (ties: the greatest whole row).

    A grouped ``max`` over a struct led by the change column: partial aggregation keeps one row per key
    and partition before the shuffle, so a key repeated millions of times does not land whole on one task.
    """
    rest = [c for c in df.columns if c not in keys and c != change_col]
    packed = F.struct(F.col(change_col).alias(change_col), *[F.col(c) for c in rest])
    return df.groupBy(*keys).agg(F.max(packed).alias("_row")).select(*keys, "_row.*").select(*df.columns)


def upsert(store: VersionedStore, table: str, source: DataFrame, keys: Sequence[str], watermark: str | None = None,
           source_rows: int | None = None, max_broadcast_rows: int = BROADCAST_MAX_ROWS,
           head: tuple[int, str | None] | None | bool = False, policy: str = "keep_types") -> int:
    """Create the table from ``source`` on first use, else publish target ⊕ source as a new version.

    Columns that are added, missing or of another type are handled as :mod:`goldleaf.operators.schemas` says for
    ``policy``: nothing is dropped, and a version's files have one schema. The target is read once and filtered map-side when the
    increment's keys pass the size check; a table whose increments touch few of its keys is better kept in
    partitions by key hash (:class:`goldleaf.operators.partitioned.PartitionedTable`).

    The new version is written to its own folder while the current one is read, then committed, so
    readers never see a half-merged table and a failed run can simply be repeated (the merge is
    idempotent). Returns the committed version. ``head`` is the table's latest (version, mark) when the
    caller has just read it (None: no version yet), so the commit log is not read again.
    """
    if head is False:
        head = store.latest(table)
    if head is None:
        return store.publish({table: source}, watermark)
    if source_rows is None:
        small = "source" in small_tables({"source": source}, max_broadcast_rows)
    else:
        small = source_rows <= max_broadcast_rows
    current = store.read_version(table, head[0])
    schema = evolved(current.schema, source.schema, keys, policy)
    typed = conformed(with_kept_values(source, current, keys, small), schema)
    version = head[0] + 1  # an upsert store holds one table, so its next version follows the table's head
    return store.publish({table: merge_rows(conformed(current, schema), typed, keys, small)}, watermark, version=version)

