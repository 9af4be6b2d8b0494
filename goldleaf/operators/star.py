"""Gold: the star schema built from silver (dimensions with default rows, date dimension, bridge, fact)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldleaf.functions import default_key, is_weekend, parse_date, weekday_name, weekday_num
from goldleaf.operators.denorm import denormalize, topping_lookup, with_toppings
from goldleaf.operators.joins import result_fits, small_tables
from goldleaf.spec import FACT_COLUMNS, GUEST_MEMBER, LINE_TOTAL_TYPE, PRICE_TYPE, UNKNOWN_BRANCH


def literal_rows(spark, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A small in-memory frame with a declared schema (default members, marks)."""
    relaxed = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    return spark.createDataFrame(list(rows), relaxed)


def build_dimension(silver: DataFrame, cols: Sequence[str], default_row: tuple | None = None,
                    drop_null_key: bool = False) -> DataFrame:
    """Distinct ``cols`` of silver, plus an optional default row (one aggregate, combined map-side).

    ``drop_null_key`` removes the (NULL, ...) row that left joins leave in silver; by default it is
    kept, as the fact never points at it (its keys are defaulted) but a NULL-key row is still data.
    """
    dim = silver.select(*cols)
    if drop_null_key:
        dim = dim.where(F.col(cols[0]).isNotNull())
    if default_row is not None:
        dim = dim.unionByName(literal_rows(silver.sparkSession, [default_row], dim.schema))
    return dim.distinct()


def build_date_dimension(df: DataFrame, date_col: str = "date") -> DataFrame:
    """One row per distinct calendar day present in ``date_col`` (no gaps are filled)."""
    days = df.select(parse_date(date_col).alias("date")).distinct()
    return days.select(
        "date",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        weekday_num("date").alias("weekday_num"),
        weekday_name("date").alias("weekday"),
        is_weekend("date").alias("is_weekend"),
    )


def build_fact(silver: DataFrame, distinct: bool = False, keep: Sequence[str] = (),
               columns: Sequence[str] | None = None) -> DataFrame:
    """fact_order at line x topping grain: typed date, defaulted member/branch keys, line total.

    ``distinct=True`` removes exact duplicate fact rows (the SQL variant of the build); ``keep`` names further
    columns of silver to carry along. ``columns``: only these of the fact's, from as much of silver as they need.
    """
    price = F.col("price").cast(PRICE_TYPE)  # a floating-point price would not equal its decimal total
    made = {
        "date": parse_date("date"), "member_id": default_key("member_id"), "bran_id": default_key("bran_id"),
        "unit_price": price, "total_price": (price * F.col("quantity")).cast(LINE_TOTAL_TYPE)}
    fact = silver.select(*[made.get(c, F.col(c)).alias(c) for c in columns or FACT_COLUMNS], *keep)
    return fact.distinct() if distinct else fact


def build_distinct_fact(tables: dict[str, DataFrame]) -> DataFrame:
    """The rows of ``build_fact(denormalize(tables), distinct=True)``, without a shuffle of line x topping rows.

    A fact row is a line and a topping of its type, so distinct lines with the distinct toppings of their type
    are the distinct rows.
    """
    lines = build_fact(denormalize(tables, grain="line")).drop("pizza_topping_id").distinct()
    toppings = topping_lookup(tables).select("pizza_type_id", "pizza_topping_id").distinct()
    small = small_tables({k: tables[k] for k in ("pizzatypetopping", "topping")})
    return with_toppings(lines, toppings, result_fits(toppings, {"pizzatypetopping", "topping"}, small)).select(*FACT_COLUMNS)


def build_star(silver: DataFrame, store: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, DataFrame]:
    """All eight gold frames, lazy. Names are the warehouse table names.

    With ``store``, which writes a frame and returns its reader, the three tables of types and toppings are read from
    the distinct rows of their columns together, so silver is read once for them.
    """
    of_types = silver
    if store:
        of_types = store(silver.select("pizza_type_id", "pizza_nm", "pizza_categ", "pizza_topping_id", "pizza_topping_nm").distinct())
    return {
        "dim_pizza": build_dimension(silver, ["pizza_id", "pizza_type_id", "size", "price"]),
        "dim_member": build_dimension(silver, ["member_id", "member_nm"], GUEST_MEMBER),
        "dim_pizza_type": build_dimension(of_types, ["pizza_type_id", "pizza_nm", "pizza_categ"]),
        "dim_date": build_date_dimension(silver),
        "dim_branch": build_dimension(silver, ["bran_id", "bran_nm"], UNKNOWN_BRANCH),
        "dim_pizza_topping": build_dimension(of_types, ["pizza_topping_id", "pizza_topping_nm"]),
        "bridge_pizza_type_topping": build_dimension(of_types, ["pizza_type_id", "pizza_topping_id"]),
        "fact_order": build_fact(silver),
    }
