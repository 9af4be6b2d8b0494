"""Schema evolution of keyed tables: which columns a table has after an increment, and in which types.

* A column that only the increment has is added; rows that were there before hold NULL.
* A column that the increment lacks stays; rows that the increment replaces keep their value, new rows hold NULL.
* A column whose type differs: with ``policy="union"`` it takes the wider type if one holds every value of both
  (wider integers, wider decimals, integers included, float to double, an integer of at most 32 bits to double,
  date to timestamp). With ``policy="keep_types"``, the default, the table's type stays and the increment is cast
  to it; under ANSI a value that does not fit raises before anything is committed.
* Anything else (text against number, a key column that is missing; with "union" also long against double)
  raises :class:`SchemaMismatch`, before anything is written.

Names are compared without case, as Spark resolves them. ``policy="strict"`` raises on any difference but a
narrower type in the increment.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGERS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]
DIGITS = dict(zip(["tinyint", "smallint", "int", "bigint"], [3, 5, 10, 19]))  # decimal digits of the integers
POLICIES = ("keep_types", "union", "strict")


class SchemaMismatch(ValueError):
    """The schemas of a table and an increment cannot be brought together."""


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds all values of both, if there is one."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in INTEGERS and b in INTEGERS:
        return max(a, b, key=INTEGERS.index)
    if all(isinstance(t, T.DecimalType) or t in INTEGERS for t in (a, b)):
        parts = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (DIGITS[t.simpleString()], 0) for t in (a, b)]
        whole, scale = (max(x) for x in zip(*parts))
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    one, other = sorted((a, b), key=lambda t: t.simpleString())
    if isinstance(one, T.DoubleType) and (isinstance(other, T.FloatType) or other in INTEGERS[:3]):
        return one
    if isinstance(one, T.DateType) and isinstance(other, (T.TimestampType, T.TimestampNTZType)):
        return other
    return None


def evolved(target: T.StructType, source: T.StructType, keys: Sequence[str], policy: str = "keep_types") -> T.StructType:
    """The schema after the increment: the target's columns, widened where needed, then the new ones."""
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, got {policy!r}")
    have, come = ({f.name.lower(): f for f in s.fields} for s in (target, source))
    problems, fields = [], []
    problems += [f"key column {k} is missing in the increment" for k in keys if k.lower() not in come]
    for name, field in have.items():
        kind = wider_type(field.dataType, come[name].dataType) if name in come else field.dataType
        if policy == "keep_types" and name in come and (kind is not None or all(
                isinstance(t, T.NumericType) for t in (field.dataType, come[name].dataType))):
            kind = field.dataType
        if kind is None:
            problems.append(f"{field.name}: {field.dataType.simpleString()} and {come[name].dataType.simpleString()} have no common type")
        elif policy == "strict" and name not in come:
            problems.append(f"column {field.name} is missing in the increment")
        elif policy == "strict" and kind != field.dataType:
            problems.append(f"{field.name}: {come[name].dataType.simpleString()} does not fit {field.dataType.simpleString()}")
        fields.append(T.StructField(field.name, kind or field.dataType, True))
    added = [f for name, f in come.items() if name not in have]
    if policy == "strict":
        problems += [f"column {f.name} is new" for f in added]
    if problems:
        raise SchemaMismatch("; ".join(problems))
    return T.StructType(fields + [T.StructField(f.name, f.dataType, True) for f in added])


def conformed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns and types of ``schema``; columns that it lacks are NULL."""
    have = {c.lower() for c in df.columns}
    return df.select(*[
        (F.col(f"`{f.name}`") if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def with_kept_values(source: DataFrame, current: DataFrame, keys: Sequence[str], source_is_small: bool) -> DataFrame:
    """``source`` with the columns that only ``current`` has, filled from its row of the same key."""
    come = {c.lower() for c in source.columns}
    missing = [c for c in current.columns if c.lower() not in come]
    if not missing:
        return source
    asked = source.select(*keys)
    known = current.select(*keys, *missing).join(F.broadcast(asked) if source_is_small else asked, list(keys), "left_semi")
    return source.join(known, list(keys), "left")
