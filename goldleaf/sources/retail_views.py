"""The eight retail source tables, derived by fixed rules from the TPC-H-style test tables.

The test data has no NULLs, orphans or missing references, so the rules below plant them: members of one
market segment are absent, every tenth order has no member, every thirtieth has no branch, item types
of one category have no bridge row (every other part contributes its words), and one topping word has no master row. The same
rules are written in SQL in ``oracles.py``; both sides must stay in step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.spec import PRICE_TYPE

# Fixed values of the derivation rules.
ABSENT_MEMBER_SEGMENT = "FURNITURE"  # customers of this segment have no member row
NO_MEMBER_EVERY = 10  # o_custkey % 10 == 0 -> order without member
NO_BRANCH_EVERY = 30  # o_orderkey % 30 == 29 -> order without branch
NO_TOPPING_TYPE = "STANDARD"  # item types of this category have no bridge row
ABSENT_TOPPING = "rod"  # topping word with no master row


def _text(c: Column) -> Column:
    return c.cast("string")


def _day_text(c: Column) -> Column:
    return F.substring(c.cast("string"), 1, 10)


def _type_id() -> Column:
    return F.concat(F.col("p_brand"), F.lit("/"), F.col("p_type"))


def bridge_pairs(parts: DataFrame, word_col: str = "pizza_topping_id") -> DataFrame:
    """Distinct (item type, word) pairs from the first two words of each part name."""
    word = lambda i: F.split_part("p_name", F.lit(" "), F.lit(i))
    return (
        parts.select(_type_id().alias("pizza_type_id"), word(1).alias(word_col))
        .unionByName(parts.select(_type_id().alias("pizza_type_id"), word(2).alias(word_col)))
        .distinct()
    )


def read_test_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def retail_source_views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Return the eight source tables keyed by their names, all lazy."""
    read = lambda name: read_test_table(spark, sf_dir, name)
    nation, customer, part = read("nation"), read("customer"), read("part")
    orders, lineitem = read("orders"), read("lineitem")

    branch = nation.select(_text(F.col("n_nationkey")).alias("bran_id"), F.col("n_name").alias("bran_nm"))
    member = customer.where(F.col("c_mktsegment") != ABSENT_MEMBER_SEGMENT).select(
        _text(F.col("c_custkey")).alias("member_id"), F.col("c_name").alias("member_nm"))
    pizzatypes = part.select(
        _type_id().alias("pizza_type_id"), F.col("p_brand").alias("pizza_nm"), F.col("p_type").alias("pizza_categ"),
    ).distinct()
    pizza = part.select(
        _text(F.col("p_partkey")).alias("pizza_id"),
        _type_id().alias("pizza_type_id"),
        _text(F.col("p_size")).alias("size"),
        F.col("p_retailprice").cast(PRICE_TYPE).alias("price"),
    )
    words = bridge_pairs(part.where(F.col("p_type") != NO_TOPPING_TYPE), "w")
    pizzatypetopping = words.select("pizza_type_id", F.col("w").alias("pizza_topping_id"))
    topping = (
        words.select("w").distinct().where(F.col("w") != ABSENT_TOPPING)
        .select(F.col("w").alias("pizza_topping_id"), F.upper("w").alias("pizza_topping_nm"))
    )
    k = F.col("o_orderkey")
    pad2 = lambda c: F.lpad(_text(c), 2, "0")
    orders_v = orders.select(
        k.alias("order_id"),
        _day_text(F.col("o_orderdate")).alias("date"),
        F.concat(pad2(k % 24), F.lit(":"), pad2(k % 60), F.lit(":00")).alias("time"),
        F.when(F.col("o_custkey") % NO_MEMBER_EVERY == 0, F.lit(None).cast("string"))
        .otherwise(_text(F.col("o_custkey"))).alias("member_id"),
        F.when(k % NO_BRANCH_EVERY == NO_BRANCH_EVERY - 1, F.lit(None).cast("string"))
        .otherwise(_text(k % NO_BRANCH_EVERY)).alias("bran_id"),
    )
    orderdetail = lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", _day_text(F.col("l_shipdate")))
        .alias("order_detail_id"),
        F.col("l_orderkey").alias("order_id"),
        _text(F.col("l_partkey")).alias("pizza_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
    )
    return {
        "branch": branch,
        "member": member,
        "orders": orders_v,
        "orderdetail": orderdetail,
        "pizza": pizza,
        "pizzatypes": pizzatypes,
        "pizzatypetopping": pizzatypetopping,
        "topping": topping,
    }
