"""The five BI marts from order lines, without the line x topping fan-out.

Every column of a mart but the topping is the same on all topping rows of a line, so a sum over fact rows is a
sum over lines, each weighted by the topping rows of its item type. ``mart_lines`` gives the lines with that
weight; the marts then move one row per group and task, never a multiplied row.

Distinct orders are counted by bitmaps over the (dense, not negative) order ids: a bitmap per hour and range of
32,768 ids is built map-side and merged by ``bitmap_or_agg``, so ids themselves are never shuffled, and the
bitmaps of parts of the data (days, say) can be kept and merged later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.functions import hour_of_text, month_label, parse_date, weekday_name
from goldleaf.operators.denorm import item_types, topping_lookup
from goldleaf.operators.joins import small_result, small_tables
from goldleaf.spec import LINE_TOTAL_TYPE, SUM_TYPE

MARTS = ["monthly", "category", "orders_by_hour", "hourly", "type"]


def toppings_per_type(tables: dict[str, DataFrame]) -> DataFrame:
    """``pizza_type_id, n``: rows that the bridge makes of a line of the type. Types without a topping are absent."""
    return topping_lookup(tables).groupBy("pizza_type_id").agg(F.count(F.lit(1)).alias("n"))


def mart_lines(tables: dict[str, DataFrame]) -> DataFrame:
    """``order_id, date, hour, pizza_type_id, pizza_categ, total, n`` of every line of the star.

    ``n`` is the number of the line's fact rows: the toppings of its type, one if it has none.
    """
    small = small_tables({k: tables[k] for k in ("pizza", "pizzatypes", "pizzatypetopping", "topping")})
    counts = toppings_per_type(tables)
    if {"pizzatypetopping", "topping"} <= small:  # one row per type, no more than the bridge has
        counts = F.broadcast(counts)
    items = item_types(tables, small).join(counts, "pizza_type_id", "left").select(
        "pizza_id", "pizza_type_id", "pizza_categ", "price", F.coalesce("n", F.lit(1)).alias("n"))
    orders = tables["orders"].select("order_id", parse_date("date").alias("date"), hour_of_text("time").alias("hour"))
    lines = tables["orderdetail"].select("order_id", "pizza_id", "quantity")
    wide = lines.join(orders, "order_id").join(small_result(items, {"pizza", "pizzatypes"}, small), "pizza_id")
    return wide.select("order_id", "date", "hour", "pizza_type_id", "pizza_categ",
                       (F.col("price") * F.col("quantity")).cast(LINE_TOTAL_TYPE).alias("total"), "n")


def _revenue(grain: str) -> Column:
    of_line = F.col("total") * F.col("n").cast("decimal(10,0)") if grain == "topping" else F.col("total")
    return F.sum(of_line).cast(SUM_TYPE)


def order_bitmaps(lines: DataFrame, *parts: str) -> DataFrame:
    """``hour, bucket, orders``: bitmaps of the orders of an hour, by range of ids, apart for each value of ``parts``.
    Merge by :func:`merged_bitmaps`."""
    return lines.where("order_id IS NOT NULL").groupBy(*parts, "hour", F.bitmap_bucket_number("order_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("order_id")).alias("orders"))


def merged_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """Bitmaps of several parts of the data as one."""
    return bitmaps.groupBy("hour", "bucket").agg(F.bitmap_or_agg("orders").alias("orders"))


def counted_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """``hour, orders``: exact distinct orders per hour."""
    return bitmaps.groupBy("hour").agg(F.sum(F.bitmap_count("orders")).cast("bigint").alias("orders"))


def mart_of_lines(lines: DataFrame, mart: str, grain: str = "topping") -> DataFrame:
    """One mart; columns and rows as in :mod:`goldleaf.operators.marts`. Lines without a valid date take part
    in the marts that do not join the date dimension."""
    dated = lines.where("date IS NOT NULL")
    if mart == "monthly":
        return dated.groupBy(F.year("date").alias("year"), F.month("date").alias("month")).agg(_revenue(grain).alias("revenue")).select(
            month_label("year", "month").alias("month_label"), "year", "month", "revenue").orderBy("year", "month")
    if mart == "category":
        return lines.groupBy(F.col("pizza_categ").alias("category")).agg(_revenue(grain).alias("revenue"))
    if mart == "orders_by_hour":
        if grain == "topping":
            rows = F.sum(F.when(F.col("order_id").isNotNull(), F.col("n")).otherwise(F.lit(0)))
            return dated.groupBy("hour").agg(rows.cast("bigint").alias("orders"))
        return counted_bitmaps(order_bitmaps(dated))
    if mart == "hourly":
        return dated.groupBy("hour", "date").agg(_revenue(grain).alias("revenue")).select(
            "hour", "date", weekday_name("date").alias("weekday"), "revenue")
    if mart == "type":
        return lines.groupBy("pizza_type_id").agg(_revenue(grain).alias("revenue"))
    raise ValueError(f"mart must be one of {MARTS}, got {mart!r}")


def all_marts(lines: DataFrame, grain: str = "topping") -> DataFrame:
    """All five marts from one pass and one exchange: ``mart``, the marts' group columns, ``revenue``, ``orders``.

    ``orders`` counts fact rows (``topping``) or lines (``line``) with an order id, by hour. A mart's group
    columns are NULL on the rows of the other marts.
    """
    cols = ["year", "month", "category", "hour", "date", "weekday", "pizza_type_id"]
    rows = lines.select(
        F.year("date").alias("year"), F.month("date").alias("month"), F.col("pizza_categ").alias("category"), "hour", "date",
        weekday_name("date").alias("weekday"), "pizza_type_id", "total", "n", "order_id", F.col("date").alias("_day"))
    sets = {"monthly": ["year", "month"], "category": ["category"], "orders_by_hour": ["hour"],
            "hourly": ["hour", "date", "weekday"], "type": ["pizza_type_id"]}
    weight = F.col("n") if grain == "topping" else F.lit(1)
    grouped = rows.groupingSets([[F.col(c) for c in s] for s in sets.values()], *cols).agg(
        _revenue(grain).alias("_revenue"), F.count_if(F.col("_day").isNotNull()).alias("_dated"),
        F.sum(F.when(F.col("order_id").isNotNull() & F.col("_day").isNotNull(), weight).otherwise(F.lit(0)))
        .cast("bigint").alias("_orders"), F.grouping_id(*cols).alias("_set"))
    # a set's number: a one for every column that it leaves out, the first column's in the highest place
    number = {mart: sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in s) for mart, s in sets.items()}
    mart = F.coalesce(*[F.when(F.col("_set") == k, F.lit(m)) for m, k in number.items()])
    counts_orders = F.col("mart") == "orders_by_hour"
    return grouped.withColumn("mart", mart).where(
        F.col("mart").isin("category", "type") | (F.col("_dated") > 0)).select(
        "mart", *cols, F.when(~counts_orders, F.col("_revenue")).alias("revenue"),
        F.when(counts_orders, F.col("_orders")).alias("orders"))
