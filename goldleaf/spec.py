"""Table specifications, schemas and fixed values of the retail warehouse (one place)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must stay exactly as written for results to match the
# behaviour the warehouse re-implements.
# ---------------------------------------------------------------------------
# Mark used when no high-water mark has been stored yet.
HWM_FLOOR = "1900-01-01 00:00:00"
# Change timestamp assumed for rows whose change column is NULL.
NULL_CHANGE_DEFAULT = "1900-01-01 00:00:01"
# Lower bound of a plausible change timestamp (bronze timestamp check).
TIMESTAMP_LOWER_BOUND = "1900-01-01"
# Key substituted for a missing member / branch reference in the fact table.
DEFAULT_KEY = "0"
# Default dimension rows: the guest member and the unknown branch.
GUEST_MEMBER = ("0", "비회원(Guest)")
UNKNOWN_BRANCH = ("0", "알 수 없는 지점")
# Source tables in load order.
SOURCE_TABLES = ["branch", "member", "orders", "orderdetail", "pizza", "pizzatypes", "pizzatypetopping", "topping"]
# Primary key of every source table.
TABLE_KEYS = {
    "branch": ["bran_id"],
    "member": ["member_id"],
    "orders": ["order_id"],
    "orderdetail": ["order_detail_id"],
    "pizza": ["pizza_id"],
    "pizzatypes": ["pizza_type_id"],
    "pizzatypetopping": ["pizza_type_id", "pizza_topping_id"],
    "topping": ["pizza_topping_id"],
}
# Audit columns carried by every bronze table.
CHANGE_COLUMN = "last_updated_timestamp"
LOAD_COLUMN = "etl_load_timestamp"
AUDIT_COLUMNS = [CHANGE_COLUMN, LOAD_COLUMN]
# Columns of the wide silver table (order line x topping grain).
SILVER_COLUMNS = [
    "order_id", "order_detail_id", "pizza_id", "pizza_type_id", "member_id", "member_nm", "date", "time",
    "quantity", "size", "price", "pizza_nm", "pizza_categ", "bran_id", "bran_nm", "pizza_topping_id",
    "pizza_topping_nm",
]
# Columns of the gold fact table.
FACT_COLUMNS = [
    "order_detail_id", "order_id", "date", "member_id", "pizza_id", "pizza_type_id", "pizza_topping_id",
    "time", "size", "quantity", "unit_price", "bran_id", "total_price",
]
FACT_KEYS = ["order_detail_id", "pizza_topping_id"]
# ---------------------------------------------------------------------------

PRICE_TYPE = T.DecimalType(10, 2)  # unit price (float4 at the source; decimal here so sums are exact)
LINE_TOTAL_TYPE = T.DecimalType(18, 2)  # price x quantity of one line
SUM_TYPE = T.DecimalType(38, 2)  # revenue sums: wide enough for any realistic table size


def _s(name: str, nullable: bool = True) -> T.StructField:
    return T.StructField(name, T.StringType(), nullable)


SOURCE_SCHEMAS: dict[str, T.StructType] = {
    "branch": T.StructType([_s("bran_id", False), _s("bran_nm")]),
    "member": T.StructType([_s("member_id", False), _s("member_pwd"), _s("member_nm")]),
    "orderdetail": T.StructType([
        T.StructField("order_detail_id", T.StringType(), False),
        T.StructField("order_id", T.LongType()),
        _s("pizza_id"),
        T.StructField("quantity", T.IntegerType()),
    ]),
    "orders": T.StructType([
        T.StructField("order_id", T.LongType(), False), _s("date"), _s("time"), _s("member_id"), _s("bran_id"),
    ]),
    "pizza": T.StructType([
        _s("pizza_id", False), _s("pizza_type_id", False), _s("size"), T.StructField("price", PRICE_TYPE),
    ]),
    "pizzatypetopping": T.StructType([_s("pizza_type_id", False), _s("pizza_topping_id", False)]),
    "pizzatypes": T.StructType([_s("pizza_type_id", False), _s("pizza_nm"), _s("pizza_categ"), _s("pizza_img_url")]),
    "topping": T.StructType([_s("pizza_topping_id", False), _s("pizza_topping_nm")]),
}

HWM_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("watermark_value", T.TimestampType()),
])

CHECK_RESULT_SCHEMA = T.StructType([
    T.StructField("check", T.StringType(), False),
    T.StructField("subject", T.StringType(), False),
    T.StructField("observed", T.LongType()),
    T.StructField("expected", T.LongType()),
    T.StructField("severity", T.StringType(), False),
    T.StructField("passed", T.BooleanType()),
])


@dataclass(frozen=True)
class TableSpec:
    """What the bronze stage needs to know about one source table."""

    name: str
    keys: list[str]
    change_col: str = CHANGE_COLUMN
    schema: T.StructType | None = field(default=None, compare=False)


TABLE_SPECS: dict[str, TableSpec] = {
    name: TableSpec(name, TABLE_KEYS[name], CHANGE_COLUMN, SOURCE_SCHEMAS.get(name)) for name in SOURCE_TABLES
}
