"""Column expressions used by the operators. All are built-in Spark functions (codegen, no Python)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from goldleaf.spec import DEFAULT_KEY


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: str | Column) -> Column:
    """'YYYY-MM-DD' text -> date; text that is not a date becomes NULL (never fails the job)."""
    return _c(c).try_cast("date")


def weekday_num(d: str | Column) -> Column:
    """Sunday = 1 ... Saturday = 7."""
    return F.dayofweek(_c(d))


def weekday_name(d: str | Column) -> Column:
    """Short English day name: 'Sun' ... 'Sat'."""
    return F.date_format(_c(d), "E")


def is_weekend(d: str | Column) -> Column:
    """1 on Saturday and Sunday, else 0 (NULL date -> 0)."""
    return F.when(F.dayofweek(_c(d)).isin(1, 7), F.lit(1)).otherwise(F.lit(0))


def hour_of_text(t: str | Column) -> Column:
    """Hour of an 'HH:MM:SS' text; NULL when the text is not a time."""
    return F.hour(F.try_to_timestamp(_c(t), F.lit("HH:mm:ss")))


def month_label(year: str | Column, month: str | Column) -> Column:
    """Year and month concatenated without padding: 2015, 1 -> '20151'."""
    return F.concat(_c(year).cast("string"), _c(month).cast("string"))


def default_key(c: str | Column, default: str = DEFAULT_KEY) -> Column:
    """Replace a missing reference by the default member / branch key."""
    return F.coalesce(_c(c), F.lit(default))
