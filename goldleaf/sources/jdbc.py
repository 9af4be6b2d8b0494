"""JDBC sources: parallel reads of relational tables, optionally restricted to an increment.

A table is read in slices, one query each, whose conditions hold for every row exactly once, NULLs included:
ranges of the change time (any table of the warehouse has one), ranges of a text key, or remainders of a
numeric expression. Filters applied later (the high-water mark) are pushed into every slice's query.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from goldleaf.spec import CHANGE_COLUMN


def quoted(spark: SparkSession, url: str, column: str) -> str:
    """A column's name as the database of ``url`` quotes it."""
    return spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url).quoteIdentifier(column)


def range_slices(column: str, bounds: Sequence[str]) -> list[str]:
    """Conditions for the ranges between ``bounds`` (literals of SQL or JDBC, ascending, distinct): below the first,
    from each to the next, from the last on; NULL belongs to the first range. ``column`` is written as the
    database wants it (:func:`quoted`)."""
    if not bounds:
        return ["1 = 1"]
    out = [f"({column} < {bounds[0]} OR {column} IS NULL)"]
    out += [f"({column} >= {a} AND {column} < {b})" for a, b in zip(bounds, bounds[1:])]
    return [*out, f"({column} >= {bounds[-1]})"]


def time_slices(column: str, earliest: datetime, latest: datetime, n: int) -> list[str]:
    """``n`` equal spans of time from ``earliest`` to ``latest``; rows outside fall to the first and last."""
    step = (latest - earliest) / max(n, 1)
    cuts = sorted({(earliest + step * i).replace(microsecond=0) for i in range(1, n)})
    return range_slices(column, [f"{{ts '{c}'}}" for c in cuts])


def text_slices(column: str, keys: Sequence[str]) -> list[str]:
    """Ranges of a text key that begin at the given keys."""
    return range_slices(column, ["'" + k.replace("'", "''") + "'" for k in sorted(set(keys))])


def remainder_slices(expression: str, n: int) -> list[str]:
    """Remainders of a numeric SQL expression, e.g. a key or the database's hash of a text key; NULL goes to 0."""
    out = [f"(ABS(MOD({expression}, {n})) = {i})" for i in range(n)]
    return [f"({out[0]} OR ({expression}) IS NULL)", *out[1:]]


def _reader(spark: SparkSession, url: str, properties: Mapping[str, str] | None, fetch_size: int):
    return spark.read.format("jdbc").options(url=url, fetchsize=fetch_size, **(properties or {}))


def change_time_slices(spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None,
                       n: int = 8, column: str = CHANGE_COLUMN, after: str | None = None) -> list[str]:
    """:func:`time_slices` between a table's first and last change time (after the mark ``after``, if given),
    asked of the database in one query."""
    column = quoted(spark, url, column)
    where = f" WHERE {column} > {{ts '{after}'}}" if after else ""
    query = f"SELECT MIN({column}) AS a, MAX({column}) AS b FROM {table}{where}"
    row = _reader(spark, url, properties, 1).option("query", query).load().first()
    return ["1 = 1"] if row[0] is None else time_slices(column, row[0], row[1], n)


def jdbc_source(spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None,
                partition_column: str | None = None, lower_bound: int | None = None, upper_bound: int | None = None,
                num_partitions: int | None = None, fetch_size: int = 10_000,
                slices: Sequence[str] | None = None) -> DataFrame:
    """A lazy JDBC table. Give ``slices`` (conditions) or a numeric ``partition_column`` with bounds to read in
    parallel queries instead of one; filters applied later (e.g. the high-water mark) are pushed into each
    query. Credentials come from ``properties`` supplied by the caller."""
    if slices is not None:
        options = {**(properties or {}), "fetchsize": str(fetch_size)}
        return spark.read.jdbc(url, table, predicates=list(slices), properties=options)
    reader = _reader(spark, url, properties, fetch_size).option("dbtable", table)
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("a partitioned JDBC read needs lower_bound, upper_bound and num_partitions")
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
                  .option("upperBound", upper_bound).option("numPartitions", num_partitions))
    return reader.load()


def jdbc_tables(spark: SparkSession, url: str, properties: Mapping[str, str], tables: list[str],
                partitioning: Mapping[str, tuple[str, int, int, int]] | None = None, slices: int = 1,
                marks: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """Lazy JDBC frames for several tables of one database. ``slices`` > 1 reads each in so many spans of its
    change time (after its mark in ``marks``); ``partitioning`` maps a table to (numeric column, lower bound,
    upper bound, partitions) instead."""
    out = {}
    for t in tables:
        part = (partitioning or {}).get(t)
        spans = None
        if part is None and slices > 1:
            spans = change_time_slices(spark, url, t, properties, slices, after=(marks or {}).get(t))
        out[t] = jdbc_source(spark, url, t, properties, *(part or ()), slices=spans)
    return out
