"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator of the warehouse.

Every query starts from the test tables under ``sf_dir`` (through the retail source views), so its work
grows with them. Names match the oracle SQL in ``oracles.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.functions import hour_of_text, is_weekend, month_label, parse_date, weekday_name, weekday_num
from goldleaf.operators import derived_checks, marts, quality
from goldleaf.operators.denorm import bridge_fanout, denormalize, inner_chain, order_lookups
from goldleaf.operators.derived_checks import LineStar
from goldleaf.operators.history import CheckHistory
from goldleaf.operators.hwm import next_hwm, read_increment
from goldleaf.operators.line_marts import (all_marts, counted_bitmaps, mart_lines, mart_of_lines, merged_bitmaps,
                                           order_bitmaps)
from goldleaf.operators.partitioned import PartitionedTable
from goldleaf.operators.quarantine import quarantined
from goldleaf.operators.star import build_date_dimension, build_dimension, build_distinct_fact, build_fact, build_star
from goldleaf.operators.upsert import upsert
from goldleaf.plans.bronze import ingest_table
from goldleaf.session import scratch_path
from goldleaf.sources import catalog as catalogs
from goldleaf.sources.lake import VersionedStore, materialize, snapshot_copy
from goldleaf.sources.retail_views import bridge_pairs, read_test_table, retail_source_views
from goldleaf.sources.sinks import FolderSink
from goldleaf.spec import GUEST_MEMBER, LOAD_COLUMN, SOURCE_TABLES, SUM_TYPE, TABLE_KEYS, TableSpec
from goldleaf.streaming import stream_ingest

# Fixed "now" of the timestamp range checks, so that results do not depend on the wall clock.
CHECK_AS_OF = "2024-01-20 00:00:00"

SPLIT_TOTAL = 100_000  # lines below and from this total are the two parts of the merged order counts
FIRST_RUN_BEFORE = "1997-01-01"  # orders that the first run of the check trend has
PARITY_COLUMNS = ["order_detail_id", "order_id", "pizza_id", "pizza_type_id", "pizza_topping_id", "time", "size", "quantity"]

Query = Callable[[SparkSession, str], DataFrame]


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return denormalize(retail_source_views(spark, sf_dir))


def _silver_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver written once, for queries that read it more than once (dimensions, checks, marts)."""
    return materialize(_silver(spark, sf_dir), "silver")


def _star(spark: SparkSession, sf_dir: str, written: bool = False) -> dict[str, DataFrame]:
    return build_star(_silver_written(spark, sf_dir) if written else _silver(spark, sf_dir))


def _star_query(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _star(spark, sf_dir)[name]
    return run


def _bi(kind: str, grain: str) -> Query:
    return lambda s, d: mart_of_lines(mart_lines(retail_source_views(s, d)), kind, grain)


def _line_total_from_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line totals of a source that delivers the price as a four-byte float."""
    views = retail_source_views(spark, sf_dir)
    views["pizza"] = views["pizza"].withColumn("price", F.col("price").cast("float"))
    return build_fact(denormalize(views)).select(
        "order_detail_id", "pizza_topping_id", "unit_price", "quantity", "total_price")


def _dimension(name: str) -> Query:
    """A dimension from lines and toppings: no topping rows of lines are made for it."""
    return lambda s, d: LineStar(retail_source_views(s, d)).dimensions()[name]


def _star_queries() -> dict[str, Query]:
    return {
        "silver_orders": _silver,
        "fact_order": _star_query("fact_order"),
        "fact_order_distinct": lambda s, d: build_distinct_fact(retail_source_views(s, d)),
        "dim_date": _dimension("dim_date"),
        "dim_item": _dimension("dim_pizza"),
        "dim_member": _dimension("dim_member"),
        "dim_item_type": _dimension("dim_pizza_type"),
        "dim_branch": _dimension("dim_branch"),
        "dim_topping": _dimension("dim_pizza_topping"),
        "bridge_type_topping": _dimension("bridge_pizza_type_topping"),
    }


def _bi_queries() -> dict[str, Query]:
    out = {}
    for kind, name in (("monthly", "bi_monthly_revenue"), ("category", "bi_category_revenue"),
                       ("orders_by_hour", "bi_orders_by_hour"), ("hourly", "bi_hourly_revenue"),
                       ("type", "bi_type_revenue")):
        out[name] = _bi(kind, "topping")
        out[f"{name}_line_grain"] = _bi(kind, "line")
    out["bi_all_marts"] = lambda s, d: all_marts(mart_lines(retail_source_views(s, d)))
    out["bi_all_marts_line_grain"] = lambda s, d: all_marts(mart_lines(retail_source_views(s, d)), "line")
    out["bi_orders_by_hour_merged"] = _merged_order_counts
    return out


def _merged_order_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct orders by hour from the bitmaps of two parts of the lines, kept apart and merged."""
    part = F.when(F.col("total") < SPLIT_TOTAL, "below").when(F.col("total") >= SPLIT_TOTAL, "from")
    lines = mart_lines(retail_source_views(spark, sf_dir)).where("date IS NOT NULL").withColumn("part", part)
    kept = materialize(order_bitmaps(lines.where("part IS NOT NULL"), "part"), "order-bitmaps", ["part"])
    parts = [kept.where(F.col("part") == p).drop("part") for p in ("below", "from")]
    return counted_bitmaps(merged_bitmaps(parts[0].unionByName(parts[1])))


def _bronze_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = retail_source_views(spark, sf_dir)
    events = read_test_table(spark, sf_dir, "events")
    return quality.union_results([
        quality.bronze_checks(v["orders"], "orders", TABLE_KEYS["orders"], "last_updated_timestamp", CHECK_AS_OF),
        quality.bronze_checks(v["orderdetail"], "orderdetail", TABLE_KEYS["orderdetail"]),
        quality.bronze_checks(events, "events", ["event_id"], "ts", CHECK_AS_OF),
    ])


def _line_star(tables: dict[str, DataFrame], columns: list[str] | None = None) -> LineStar:
    """The star's parts with the lines (of the columns a report needs) written once, for reports that read them
    several times."""
    return LineStar(tables, lambda lines: materialize(lines, "line-star"), columns, hashed_ids=columns is not None)


def _row_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact as written against silver as written: rows, and the contents of their common columns."""
    silver = _silver_written(spark, sf_dir)
    fact = materialize(build_fact(silver), "fact")
    return quality.row_parity_check(silver, fact).unionByName(quality.content_checks(
        {"silver -> fact_order": (silver, fact)}, {"silver -> fact_order": PARITY_COLUMNS}))


def _trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver checks of two runs, the first before part of the orders had come, and what changed."""
    tables = retail_source_views(spark, sf_dir)
    history = CheckHistory(spark, scratch_path(spark, "check-history"))
    early = {**tables, "orders": tables["orders"].where(F.col("date") < FIRST_RUN_BEFORE)}
    for run, own in (("run-1", early), ("run-2", tables)):
        star = _line_star(own, derived_checks.SILVER_REPORT_COLUMNS)
        history.record(derived_checks.silver_report(own, TABLE_KEYS, star), "silver", run)
    return history.trend("silver")


def _quality_queries() -> dict[str, Query]:
    def lazily(fn):
        return lambda s, d: fn(LineStar(retail_source_views(s, d)))

    def written(fn, columns):
        return lambda s, d: fn(_line_star(retail_source_views(s, d), columns))

    return {
        "timestamp_range_check": lambda s, d: quality.timestamp_range_check(
            read_test_table(s, d, "events"), "events", "ts", CHECK_AS_OF),
        "check_null_keys": lambda s, d: quality.null_key_check(
            retail_source_views(s, d)["orders"], "orders", ["member_id"]),
        "duplicate_keys": lambda s, d: quality.find_duplicate_keys(read_test_table(s, d, "lineitem"), ["l_orderkey"]),
        "duplicate_keys_composite": lambda s, d: quality.find_duplicate_keys(
            read_test_table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"]),
        "bronze_quality_report": _bronze_report,
        "silver_duplicate_pks": lambda s, d: quality.duplicate_pk_checks(retail_source_views(s, d), TABLE_KEYS),
        "null_fk_profile": lambda s, d: (lambda v: quality.null_fk_profile(
            v["orderdetail"], v["orders"], v["pizza"]))(retail_source_views(s, d)),
        "cardinality_check": lambda s, d: (lambda v: derived_checks.cardinality(
            v["orderdetail"], LineStar(v)))(retail_source_views(s, d)),
        "missing_references": lazily(lambda star: derived_checks.reference_counts(star).drop("types_without_topping")),
        "types_without_bridge": lazily(lambda star: derived_checks.reference_counts(star).select("types_without_topping")),
        "silver_quality_report": lambda s, d: derived_checks.silver_report(
            retail_source_views(s, d), TABLE_KEYS, _line_star(retail_source_views(s, d), derived_checks.SILVER_REPORT_COLUMNS)),
        "check_row_parity": _row_parity,
        "check_uniqueness": written(derived_checks.uniqueness_checks, derived_checks.UNIQUENESS_COLUMNS),
        "check_fact_nulls": written(lambda star: derived_checks.fact_row_checks(star).where("check = 'not_null'"), derived_checks.FACT_ROW_COLUMNS),
        "check_referential_integrity": written(derived_checks.referential_integrity_checks, derived_checks.DIMENSION_COLUMNS),
        "check_line_total": lazily(lambda star: quality.line_total_check(star.fact_lines(), "n")),
        "check_positive_quantity": lazily(lambda star: quality.positive_quantity_check(star.fact_lines(), "n")),
        "gold_quality_report": written(derived_checks.gold_report, derived_checks.GOLD_REPORT_COLUMNS),
        "check_trend": _trend,
    }


# --- bronze side: increments, marks, upserts, copies -------------------------------------------------

# Fixed parameters of the registered ingest queries.
INGEST_MARK = "2024-01-15 00:00:00"  # stored mark for the events increment
TARGET_BEFORE = "1999-01-01"  # orders before this date form the existing target
CHANGED_FROM = "1998-01-01"  # orders from this date on carry a changed status in the increment
CHANGED_STATUS = "X"
CATALOG_BUCKETS = 16
NULL_KEY, BAD_TIME, REPEATED = (89, 1), (83, 2), (97, 0)  # divisor and remainder of the order keys with planted faults
BAD_TIME_AT = "2999-01-01"


def _ts(df: DataFrame, col: str, value: str):
    return F.lit(value).cast(df.schema[col].dataType)


def _store(spark: SparkSession, name: str):
    return VersionedStore(spark, scratch_path(spark, name))


def _changed_orders(orders: DataFrame) -> DataFrame:
    changed = F.col("o_orderdate") >= _ts(orders, "o_orderdate", CHANGED_FROM)
    return orders.withColumn("o_orderstatus", F.when(changed, F.lit(CHANGED_STATUS)).otherwise(F.col("o_orderstatus")))


def _touched_orders(orders: DataFrame) -> DataFrame:
    """The changed orders with a newer change time, as a source that stamps its updates."""
    touched = F.col("o_orderdate") >= _ts(orders, "o_orderdate", CHANGED_FROM)
    newer = (F.col("o_orderdate") + F.expr("INTERVAL 730 DAYS")).cast(orders.schema["o_orderdate"].dataType)
    return _changed_orders(orders).withColumn("o_orderdate", F.when(touched, newer).otherwise(F.col("o_orderdate")))


def _bronze_queries() -> dict[str, Query]:
    def incremental_read(s, d):
        return read_increment(read_test_table(s, d, "events"), "ts", INGEST_MARK)

    def hwm_advance(s, d):
        return next_hwm(incremental_read(s, d), "ts", INGEST_MARK, "events")

    def initial_load(s, d):
        store = _store(s, "initial_load")
        upsert(store, "orders", read_test_table(s, d, "orders"), ["o_orderkey"])
        return store.read("orders")

    def copy(s, d):
        store = _store(s, "snapshot_copy")
        views = retail_source_views(s, d)
        snapshot_copy(views, store)
        quality.gate(quality.content_checks({t: (views[t], store.read(t)) for t in views}), "snapshot copy")
        return quality.union_results([
            quality.content_hash(store.read(t)).select(F.lit(t).alias("table_name"), "rows", "content") for t in views])

    def keyed_upsert(s, d):
        orders = read_test_table(s, d, "orders")
        store = _store(s, "keyed_upsert")
        upsert(store, "orders", orders.where(F.col("o_orderdate") < _ts(orders, "o_orderdate", TARGET_BEFORE)),
               ["o_orderkey"])
        changed = _changed_orders(orders).where(F.col("o_orderdate") >= _ts(orders, "o_orderdate", CHANGED_FROM))
        upsert(store, "orders", changed, ["o_orderkey"])
        return store.read("orders")

    def keyed_upsert_partitioned(s, d):
        orders = read_test_table(s, d, "orders")
        table = PartitionedTable(s, scratch_path(s, "keyed_upsert_partitioned"), ["o_orderkey"], 16)
        table.create(orders.where(F.col("o_orderdate") < _ts(orders, "o_orderdate", TARGET_BEFORE)))
        table.upsert(_changed_orders(orders).where(F.col("o_orderdate") >= _ts(orders, "o_orderdate", CHANGED_FROM)))
        return table.read()

    def schema_evolution_upsert(s, d):
        """The target has no priority yet and narrow customer keys; the increment brings priorities, but no prices."""
        orders = read_test_table(s, d, "orders")
        store = _store(s, "schema_evolution_upsert")
        target = orders.where(F.col("o_orderdate") < _ts(orders, "o_orderdate", TARGET_BEFORE))
        upsert(store, "orders", target.drop("o_orderpriority").withColumn("o_custkey", F.col("o_custkey").cast("int")), ["o_orderkey"])
        source = _changed_orders(orders).where(F.col("o_orderdate") >= _ts(orders, "o_orderdate", CHANGED_FROM))
        upsert(store, "orders", source.drop("o_totalprice").withColumn("o_custkey", F.col("o_custkey").cast("bigint")), ["o_orderkey"],
               policy="union")
        return store.read("orders")

    def quarantine(s, d):
        orders = read_test_table(s, d, "orders")
        store = _store(s, "quarantine")
        key = lambda fault: F.col("_key") % fault[0] == fault[1]
        kept = orders.withColumn("_key", F.col("o_orderkey"))
        faulty = kept.unionByName(kept.where(key(REPEATED)).withColumn("o_orderstatus", F.lit("D"))).withColumn(
            "o_orderdate", F.when(key(BAD_TIME), _ts(orders, "o_orderdate", BAD_TIME_AT)).otherwise(F.col("o_orderdate"))).withColumn(
            "o_orderkey", F.when(~key(NULL_KEY), F.col("o_orderkey"))).drop("_key")
        for _ in range(2):  # the second run reads the rows with a time in the future again
            ingest_table(s, TableSpec("orders", ["o_orderkey"], "o_orderdate"), faulty, store, as_of=CHECK_AS_OF, quarantine=True)
        return store

    def quarantined_rows(s, d):
        return quarantined(quarantine(s, d)).drop(LOAD_COLUMN).withColumn("reasons", F.array_join("reasons", ","))

    def warehouse_publish(s, d):
        """Two publications and a third that fails half-way; what readers of the warehouse then see."""
        tables = retail_source_views(s, d)
        sink = FolderSink(s, scratch_path(s, "warehouse"))
        early = {**tables, "orders": tables["orders"].where(F.col("date") < FIRST_RUN_BEFORE)}
        for own in (early, tables):
            star = _line_star(own)  # the eight tables read the joined lines, written once
            sink.publish(star.dimensions() | {"fact_order": star.fact()})
        broken = tables["branch"].select(F.raise_error(F.lit("planted failure")).cast("string").alias("bran_id"))
        try:
            sink.publish({"dim_branch": tables["branch"], "fact_order": broken})
        except Exception as e:
            if "planted failure" not in str(e):
                raise
        return sink.read("fact_order").groupBy("bran_id").agg(F.sum("total_price").cast(SUM_TYPE).alias("revenue")).join(
            sink.read("dim_branch"), "bran_id").select("bran_id", "bran_nm", "revenue")

    def catalog(s, d):
        """Namespaces of bronze (lines and orders bucketed), silver and gold tables; returns silver's and gold's."""
        bronze, silver, gold = (catalogs.scratch_namespace(s, f"goldleaf_{x}") for x in ("bronze", "silver", "gold"))
        catalogs.build_bronze_tables(retail_source_views(s, d), bronze, CATALOG_BUCKETS)
        catalogs.build_silver_table(s, bronze, silver, SOURCE_TABLES)
        return silver, gold

    def catalog_monthly_revenue(s, d):
        star = catalogs.build_gold_tables(s, *catalog(s, d))
        return marts.monthly_revenue(star["fact_order"], star["dim_date"])

    def keyed_upsert_composite(s, d):
        part = read_test_table(s, d, "part")
        keys = ["pizza_type_id", "pizza_topping_id"]
        store = _store(s, "keyed_upsert_composite")
        target = bridge_pairs(part.where("p_partkey % 3 <> 0")).withColumn("flag", F.lit("v1"))
        source = bridge_pairs(part.where("p_partkey % 3 <> 1")).withColumn("flag", F.lit("v2"))
        upsert(store, "pizzatypetopping", target, keys)
        upsert(store, "pizzatypetopping", source, keys)
        return store.read("pizzatypetopping")

    def incremental_ingest(s, d):
        orders = read_test_table(s, d, "orders")
        spec = TableSpec("orders", ["o_orderkey"], "o_orderdate")
        store = _store(s, "incremental_ingest")
        first = orders.where(F.col("o_orderdate") < _ts(orders, "o_orderdate", TARGET_BEFORE))
        for source in (first, _touched_orders(orders)):
            res = ingest_table(s, spec, source, store, as_of=CHECK_AS_OF)
            if res.status == "rejected":
                raise RuntimeError(f"increment rejected: {res.problems}")
        return store.read("orders").drop(LOAD_COLUMN)

    def streaming_ingest(s, d):
        orders = read_test_table(s, d, "orders")
        spec = TableSpec("orders", ["o_orderkey"], "o_orderdate")
        root = scratch_path(s, "streaming_ingest")
        store = VersionedStore(s, f"{root}/bronze")
        drops = (orders.where(F.col("o_orderdate") < _ts(orders, "o_orderdate", TARGET_BEFORE)), _changed_orders(orders))
        for drop in drops:  # each landed drop is picked up by one availableNow run of the stream
            drop.write.mode("append").parquet(f"{root}/landing")
            q = stream_ingest(s, spec, f"{root}/landing", orders.schema, store, f"{root}/checkpoint", as_of=CHECK_AS_OF)
            q.awaitTermination()
            if q.exception() is not None:
                raise RuntimeError(f"stream failed: {q.exception()}")
        return store.read("orders").drop(LOAD_COLUMN)

    return {
        "streaming_ingest": streaming_ingest,
        "incremental_read": incremental_read,
        "hwm_advance": hwm_advance,
        "initial_load": initial_load,
        "snapshot_copy": copy,
        "keyed_upsert": keyed_upsert,
        "keyed_upsert_composite": keyed_upsert_composite,
        "keyed_upsert_partitioned": keyed_upsert_partitioned,
        "schema_evolution_upsert": schema_evolution_upsert,
        "quarantine_ingest": lambda s, d: quarantine(s, d).read("orders").drop(LOAD_COLUMN),
        "quarantined_rows": quarantined_rows,
        "warehouse_publish": warehouse_publish,
        "catalog_silver_orders": lambda s, d: s.table(f"{catalog(s, d)[0]}.{catalogs.SILVER_TABLE}"),
        "catalog_monthly_revenue": catalog_monthly_revenue,
        "incremental_ingest": incremental_ingest,
    }


# --- projections, joins, scalar functions --------------------------------------------------------------

def _relational_queries() -> dict[str, Query]:
    def join_on_date_expr(s, d):
        v = retail_source_views(s, d)
        dim_date = build_date_dimension(denormalize(v, grain="line"))
        per_text = v["orders"].groupBy("date").agg(F.count(F.lit(1)).alias("n"))
        joined = per_text.join(dim_date.select(F.col("date").alias("d")), parse_date(per_text["date"]) == F.col("d"), "inner")
        return joined.groupBy(F.col("d").alias("date")).agg(F.sum("n").cast("bigint").alias("n"))

    def scalar_date_functions(s, d):
        o = retail_source_views(s, d)["orders"]
        day = parse_date("date")
        return o.select(
            "order_id", day.alias("date"), F.year(day).alias("year"), F.month(day).alias("month"),
            F.dayofmonth(day).alias("day"), weekday_num(day).alias("weekday_num"), weekday_name(day).alias("weekday"),
            is_weekend(day).alias("is_weekend"), hour_of_text("time").alias("hour"),
            month_label(F.year(day), F.month(day)).alias("month_label"))

    return {
        "project_columns": lambda s, d: _silver(s, d).select(
            "order_detail_id", "order_id", "date", "time", "pizza_id", "quantity"),
        "distinct_rows": lambda s, d: _silver(s, d).select("order_id", "date", "member_id", "bran_id").distinct(),
        "line_total_from_float": _line_total_from_float,
        "line_total": lambda s, d: _star(s, d)["fact_order"].select(
            "order_detail_id", "pizza_topping_id", "unit_price", "quantity", "total_price"),
        "default_keys": lambda s, d: _star(s, d)["fact_order"].select(
            "order_detail_id", "pizza_topping_id", "member_id", "bran_id"),
        "join_inner_chain": lambda s, d: inner_chain(retail_source_views(s, d)).select(
            "order_detail_id", "order_id", "pizza_id", "pizza_type_id", "date", "quantity", "price", "pizza_categ"),
        "join_left_lookup": lambda s, d: order_lookups(retail_source_views(s, d)).select(
            "order_id", "member_id", "member_nm", "bran_id", "bran_nm"),
        "join_bridge_fanout": lambda s, d: bridge_fanout(retail_source_views(s, d)),
        "orphan_keys_anti_join": lambda s, d: (lambda v: quality.orphan_keys(
            v["orders"], "member_id", v["member"]))(retail_source_views(s, d)),
        "join_on_date_expr": join_on_date_expr,
        "union_distinct_default_row": lambda s, d: build_dimension(
            _silver(s, d), ["member_id", "member_nm"], GUEST_MEMBER, drop_null_key=True),
        "scalar_date_functions": scalar_date_functions,
    }


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for group in (_star_queries, _bi_queries, _quality_queries, _bronze_queries, _relational_queries):
        out.update(group())
    return out
