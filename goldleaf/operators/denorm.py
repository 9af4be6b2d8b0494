"""Silver: the wide order table at order-line x topping grain (inner chain, left lookups, bridge fan-out)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.operators.joins import BROADCAST_MAX_ROWS, left_lookup, result_fits, small_tables
from goldleaf.spec import PRICE_TYPE, SILVER_COLUMNS

# Tables that are dimensions or lookups of the line table; each is broadcast when its size check passes.
_LOOKUPS = ["branch", "member", "pizza", "pizzatypes", "pizzatypetopping", "topping"]


def _bc(df: DataFrame, name: str, small: set[str]) -> DataFrame:
    return F.broadcast(df) if name in small else df


def _items(tables: dict[str, DataFrame]) -> DataFrame:
    """Items with the price as an exact decimal, also when the source delivers a floating-point price."""
    return tables["pizza"].select("pizza_id", "pizza_type_id", "size", F.col("price").cast(PRICE_TYPE).alias("price"))


def item_types(tables: dict[str, DataFrame], small: set[str]) -> DataFrame:
    """Items with their type's columns (inner); the types are broadcast when they passed the size check."""
    types = tables["pizzatypes"].select("pizza_type_id", "pizza_nm", "pizza_categ")
    return _items(tables).join(_bc(types, "pizzatypes", small), "pizza_type_id", "inner")


def _with_orders_and_items(lines: DataFrame, orders: DataFrame, tables: dict[str, DataFrame], small: set[str],
                           by_order: bool = False) -> DataFrame:
    """lines JOIN orders JOIN item JOIN item type (all inner), the lines shuffled at most twice and never wide.

    Items that fit are broadcast, so the lines are shuffled by order alone. Others are joined first: what an order
    brings (dates, names) then moves once per order, not once per line, and so do the types' texts, which come last.
    Lines that are stored ``by_order`` meet their orders where they lie, and are shuffled once, by item.
    """
    items = item_types(tables, small)
    if result_fits(items, {"pizza", "pizzatypes"}, small):
        return lines.join(orders, "order_id", "inner").join(F.broadcast(items), "pizza_id", "inner")
    if "pizzatypes" in small:
        items = _items(tables)
    out = lines.join(orders, "order_id", "inner").join(items, "pizza_id", "inner") if by_order else (
        lines.join(items, "pizza_id", "inner").join(orders, "order_id", "inner"))
    if "pizzatypes" not in small:
        return out
    types = F.broadcast(tables["pizzatypes"].select("pizza_type_id", "pizza_nm", "pizza_categ"))
    return out.join(types, "pizza_type_id", "inner")


def inner_chain(tables: dict[str, DataFrame], small: set[str] | None = None) -> DataFrame:
    """lines JOIN orders JOIN item JOIN item type (all inner).

    The lines are shuffled at most twice: by order and, when items are too large to broadcast, by item.
    """
    small = small if small is not None else small_tables({k: tables[k] for k in ("pizza", "pizzatypes")})
    orders = tables["orders"].select("order_id", "date", "time", "member_id", "bran_id")
    lines = tables["orderdetail"].select("order_detail_id", "order_id", "pizza_id", "quantity")
    return _with_orders_and_items(lines, orders, tables, small)


def order_lookups(tables: dict[str, DataFrame], small: set[str] | None = None) -> DataFrame:
    """orders LEFT JOIN member LEFT JOIN branch, keeping the order's own member and branch ids."""
    small = small if small is not None else small_tables({k: tables[k] for k in ("member", "branch")})
    orders = tables["orders"].select("order_id", "date", "time", "member_id", "bran_id")
    member = tables["member"].select("member_id", "member_nm")
    branch = tables["branch"].select("bran_id", "bran_nm")
    out = left_lookup(orders, member, "member_id", broadcast_dim="member" in small)
    return left_lookup(out, branch, "bran_id", broadcast_dim="branch" in small)


def topping_lookup(tables: dict[str, DataFrame]) -> DataFrame:
    """bridge LEFT JOIN topping: every (type, topping) pair with the topping's name or NULL."""
    bridge = tables["pizzatypetopping"].select("pizza_type_id", "pizza_topping_id")
    topping = tables["topping"].select("pizza_topping_id", "pizza_topping_nm")
    return bridge.join(topping, "pizza_topping_id", "left")


def with_toppings(lines: DataFrame, toppings: DataFrame, small: bool) -> DataFrame:
    """Lines LEFT JOIN the toppings of their type (``pizza_type_id`` and any columns).

    Toppings that are ``small`` are broadcast as one array per type, which a line unfolds: a match per line, and
    no copy of the line for each of a join's matches.
    """
    if not small:
        return lines.join(toppings, "pizza_type_id", "left")
    of_type = toppings.groupBy("pizza_type_id").agg(
        F.collect_list(F.struct(*[c for c in toppings.columns if c != "pizza_type_id"])).alias("_toppings"))
    return lines.join(F.broadcast(of_type), "pizza_type_id", "left").select("*", F.inline_outer("_toppings")).drop("_toppings")


def denormalize(tables: dict[str, DataFrame], max_broadcast_rows: int = BROADCAST_MAX_ROWS,
                grain: str = "topping", by_order: bool = False) -> DataFrame:
    """The silver wide table: 17 columns, one row per order line and topping of its type.

    Plan, chosen for a line table far larger than everything else:
      1. member and branch are looked up on the orders (shorter than the lines);
      2. lines meet the items (broadcast with their types when they pass the size check, else a shuffle of
         the still narrow lines on pizza_id) and the enriched orders (shuffle on order_id);
      3. the types of items that were not broadcast follow, as a broadcast when they pass the size check;
      4. the bridge fan-out comes last and is a broadcast join (when bridge and names joined pass the
         size check), so the multiplied rows are never shuffled.
    Inner-join semantics are unchanged by the regrouping: each lookup reads only columns of the table
    it is attached to. A password column never reaches this table.

    ``grain="line"`` leaves step 4 out: one row per order line, the topping columns NULL. Line-grain marts
    are built from it, so no line depends on a topping row and nothing is multiplied and reduced again.

    ``by_order``: the lines are stored bucketed by order id, so large items come after the orders in step 2.
    """
    if grain not in ("topping", "line"):
        raise ValueError(f"grain must be 'topping' or 'line', got {grain!r}")
    lookups = _LOOKUPS if grain == "topping" else [t for t in _LOOKUPS if t not in ("pizzatypetopping", "topping")]
    small = small_tables({k: tables[k] for k in lookups}, max_broadcast_rows)
    orders = order_lookups(tables, small)
    lines = tables["orderdetail"].select("order_detail_id", "order_id", "pizza_id", "quantity")
    wide = _with_orders_and_items(lines, orders, tables, small, by_order)
    toppings = topping_lookup(tables)
    if grain == "line":
        return wide.select(*[F.lit(None).cast(toppings.schema[c].dataType).alias(c) if c.startswith("pizza_topping") else c
                             for c in SILVER_COLUMNS])
    return with_toppings(wide, toppings, result_fits(toppings, {"pizzatypetopping", "topping"}, small)).select(*SILVER_COLUMNS)


def bridge_fanout(tables: dict[str, DataFrame]) -> DataFrame:
    """Lines expanded through the type/topping bridge (line x topping), without the other lookups."""
    small = small_tables({k: tables[k] for k in ("pizza", "pizzatypetopping", "topping")})
    items = tables["pizza"].select("pizza_id", "pizza_type_id")
    lines = tables["orderdetail"].select("order_detail_id", "pizza_id")
    typed = lines.join(_bc(items, "pizza", small), "pizza_id", "inner")
    toppings = topping_lookup(tables)
    return with_toppings(typed, toppings, result_fits(toppings, {"pizzatypetopping", "topping"}, small)).select(
        "order_detail_id", "pizza_type_id", "pizza_topping_id", "pizza_topping_nm")
