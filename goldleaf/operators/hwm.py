"""High-water marks: incremental reads by change timestamp and the advance of the mark.

A mark is text in UTC for a change column that holds instants (``timestamp``), whatever the session's time
zone, so a run in another zone, or in a repeated hour, reads it as the same instant. For a column without a
zone (``timestamp_ntz``, ``date``, text) it is the column's own wall-clock time.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldleaf.spec import HWM_FLOOR, NULL_CHANGE_DEFAULT


def _as_datetime(v: str | int | datetime) -> datetime:
    """A mark as a naive datetime; integers are microseconds since 1970 in UTC."""
    if isinstance(v, int):
        return datetime(1970, 1, 1) + timedelta(microseconds=v)
    d = v if isinstance(v, datetime) else datetime.fromisoformat(str(v))
    return d.astimezone(timezone.utc).replace(tzinfo=None) if d.tzinfo else d


def _is_instant(df: DataFrame, change_col: str) -> bool:
    return isinstance(df.schema[change_col].dataType, T.TimestampType)


def _typed(df: DataFrame, change_col: str, value: str | datetime) -> Column:
    text = str(_as_datetime(value)) + ("+00:00" if _is_instant(df, change_col) else "")
    return F.lit(text).cast(df.schema[change_col].dataType)


def newest_change(df: DataFrame, change_col: str, null_default: str = NULL_CHANGE_DEFAULT) -> Column:
    """Aggregate: the newest change time (NULL counted as ``null_default``) in a form without a session zone,
    as :func:`advance` takes it: microseconds of an instant, else text."""
    newest = F.max(F.coalesce(F.col(change_col), _typed(df, change_col, null_default)))
    return F.unix_micros(newest) if _is_instant(df, change_col) else newest.cast("string")


def read_increment(source: DataFrame, change_col: str, last_hwm: str | datetime | None = None,
                   null_default: str = NULL_CHANGE_DEFAULT, overlap: timedelta | None = None) -> DataFrame:
    """Rows whose change time, NULL counted as ``null_default``, is after the mark.

    Meaning: ``coalesce(change_col, null_default) > last_hwm``. It is written as
    ``change_col > mark [OR change_col IS NULL]`` (the NULL branch only while the mark is below the NULL
    default, i.e. on a first load), a form that Spark pushes down to Parquet and JDBC sources, while a
    ``coalesce`` is not pushed. ``overlap`` re-reads ``(mark - overlap, ...]`` so that rows committed late
    with an already-seen timestamp are not lost; the keyed upsert makes the re-read harmless.
    """
    last = _as_datetime(last_hwm if last_hwm is not None else HWM_FLOOR)
    bound = last - overlap if overlap else last
    cond = F.col(change_col) > _typed(source, change_col, bound)
    if _as_datetime(null_default) > bound:
        cond = cond | F.col(change_col).isNull()
    return source.where(cond)


def next_hwm(increment: DataFrame, change_col: str, last_hwm: str | datetime | None, table_name: str,
             null_default: str = NULL_CHANGE_DEFAULT) -> DataFrame:
    """One row (table_name, watermark_value): the newest change time in the increment (NULL counted as
    ``null_default``), never earlier than the previous mark."""
    last = _typed(increment, change_col, last_hwm if last_hwm is not None else HWM_FLOOR)
    newest = F.max(F.coalesce(F.col(change_col), _typed(increment, change_col, null_default)))
    return increment.agg(newest.alias("_m")).select(
        F.lit(table_name).alias("table_name"),
        F.greatest(F.coalesce(F.col("_m"), last), last).alias("watermark_value"),
    )


def advance(last_hwm: str | datetime | None, newest: str | int | datetime | None) -> str:
    """Driver-side form of :func:`next_hwm` for a value already observed while writing
    (:func:`newest_change`)."""
    last = _as_datetime(last_hwm if last_hwm is not None else HWM_FLOOR)
    return str(max(last, _as_datetime(newest)) if newest is not None else last)
