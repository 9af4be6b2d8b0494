"""Join helpers: size-checked broadcast and a left lookup that keeps NULL keys out of the shuffle."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructField, StructType, VariantType

# Largest dimension broadcast on the strength of an explicit check of its rows and bytes. Above either the
# join stays a shuffle join (AQE may still broadcast it at run time from the measured size).
BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 64 << 20
FIXED_WIDTH = 16  # bytes of a number, date or decimal, at most


def _at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    ``take`` scans partitions incrementally (one, then a growing number) and stops once it holds
    ``max_rows + 1`` rows: a huge table costs a task or two, a small one a short scan, and only a
    one-int column per row travels back.
    """
    return len(df.select(F.lit(1).alias("_")).take(max_rows + 1)) <= max_rows


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: text and binary by their octets, nested values by those of their text, others by a fixed width."""
    def width(field: StructField) -> Column:
        value = F.col("`" + field.name.replace("`", "``") + "`")
        if isinstance(field.dataType, (StringType, BinaryType)):
            return F.coalesce(F.octet_length(value), F.lit(0))
        if isinstance(field.dataType, (ArrayType, MapType, StructType, VariantType)):
            return F.coalesce(F.octet_length(value.cast("string")), F.lit(0))
        return F.lit(FIXED_WIDTH)

    return sum((width(f).cast("bigint") for f in df.schema.fields), F.lit(0).cast("bigint"))


def _fits(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows of together at most ``max_bytes``; a table with more rows
    is not read any further."""
    return _at_most(df, max_rows) and (df.agg(F.sum(_row_bytes(df))).first()[0] or 0) <= max_bytes


def sized_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``broadcast(df)`` when ``df`` fits (:func:`_fits`), else ``df`` unchanged.

    The check works ``df`` out: pass scans of stored tables, or small joins of tables that were found to fit
    (a repeated key may still multiply their rows). For other computed dimensions leave the decision to AQE,
    which measures the finished build side before converting the join.
    """
    return F.broadcast(df) if _fits(df, max_rows, max_bytes) else df


def result_fits(df: DataFrame, inputs: set[str], small: set[str]) -> bool:
    """A join of the tables ``inputs`` can be broadcast: they are small and so is the result, which keys repeated
    on both sides could multiply."""
    return inputs <= small and _fits(df, BROADCAST_MAX_ROWS, BROADCAST_MAX_BYTES)


def small_result(df: DataFrame, inputs: set[str], small: set[str]) -> DataFrame:
    """A join of the tables ``inputs``, marked for broadcast when it fits (:func:`result_fits`)."""
    return F.broadcast(df) if result_fits(df, inputs, small) else df


def small_tables(tables: dict[str, DataFrame], max_rows: int = BROADCAST_MAX_ROWS,
                 max_bytes: int = BROADCAST_MAX_BYTES) -> set[str]:
    """Names of the tables with at most ``max_rows`` rows and ``max_bytes`` (see :func:`_fits`).

    The probes are independent Spark jobs, submitted together so that they share the cluster instead of
    queueing one after another.
    """
    if not tables:
        return set()
    with ThreadPoolExecutor(max_workers=min(8, len(tables))) as pool:
        probe = inheritable_thread_target(next(iter(tables.values())).sparkSession)(lambda df: _fits(df, max_rows, max_bytes))
        fits = dict(zip(tables, pool.map(probe, tables.values())))
    return {name for name, ok in fits.items() if ok}


def left_lookup(df: DataFrame, dim: DataFrame, key: str, broadcast_dim: bool = False) -> DataFrame:
    """``df LEFT JOIN dim USING (key)``, safe against a NULL-key hot spot.

    In a shuffle join every row with a NULL key hashes to the same reducer; when many rows lack the
    reference (guest orders) that reducer holds a large share of the data. Rows with a NULL key can
    never match, so they bypass the join and are given NULL lookup columns. A hot non-NULL key is split
    by AQE's skew-join handling, which supports the preserved side of a left outer join.
    """
    if broadcast_dim:
        return df.join(F.broadcast(dim), key, "left")
    extra = [f for f in dim.schema.fields if f.name != key]
    matched = df.where(F.col(key).isNotNull()).join(dim, key, "left")
    unmatched = df.where(F.col(key).isNull()).select(
        F.col(key), *[c for c in df.columns if c != key], *[F.lit(None).cast(f.dataType).alias(f.name) for f in extra])
    return matched.unionByName(unmatched)
