"""Hand-computed expectations on the micro fixture (every edge case once)."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from goldleaf.operators import marts, quality
from goldleaf.operators.denorm import denormalize
from goldleaf.operators.star import build_fact, build_star
from goldleaf.spec import SILVER_COLUMNS, TABLE_KEYS
from micro import micro_tables


@pytest.fixture(scope="module")
def tables(spark):
    return micro_tables(spark)


@pytest.fixture(scope="module")
def silver(tables):
    return denormalize(tables).cache()


@pytest.fixture(scope="module")
def star(silver):
    return build_star(silver)


def _map(df, k, v):
    return {r[k]: r[v] for r in df.collect()}


def test_silver_shape(silver):
    assert silver.columns == SILVER_COLUMNS
    assert silver.count() == 9
    assert silver.select("order_detail_id").distinct().count() == 5
    assert "member_pwd" not in silver.columns
    # a dangling branch id keeps the order's own id
    assert silver.where("order_detail_id = '7'").select("bran_id", "bran_nm").distinct().collect()[0] == ("B9", None)


def test_cardinality_and_references(tables, silver):
    c = quality.cardinality(tables["orderdetail"], silver).collect()[0]
    assert (c.source_lines, c.silver_lines, c.dropped) == (8, 5, 3)
    m = quality.missing_references(silver).collect()[0]
    assert (m.missing_member, m.missing_branch, m.missing_topping_master) == (1, 2, 2)
    assert quality.types_without_bridge(silver).collect()[0].types_without_topping == 1


def test_dimension_sizes(star):
    sizes = {k: v.count() for k, v in star.items() if k != "fact_order"}
    assert sizes == {"dim_pizza": 4, "dim_member": 5, "dim_pizza_type": 3, "dim_date": 4, "dim_branch": 5,
                     "dim_pizza_topping": 4, "bridge_pizza_type_topping": 5}


def test_date_dimension(star):
    rows = {str(r.date): (r.weekday, r.weekday_num, r.is_weekend) for r in star["dim_date"].collect()}
    assert rows == {"2015-01-03": ("Sat", 7, 1), "2015-01-05": ("Mon", 2, 0), "2015-02-01": ("Sun", 1, 1),
                    "2015-02-02": ("Mon", 2, 0)}


def test_fact_defaults(star):
    fact = star["fact_order"]
    assert fact.where("order_detail_id = '3'").select("member_id", "bran_id").distinct().collect()[0] == ("0", "0")
    assert fact.schema["date"].dataType.simpleString() == "date"
    assert fact.where(F.col("quantity") <= 0).count() == 2


def test_revenue_by_type(star):
    f = star["fact_order"]
    assert _map(marts.type_revenue(f), "pizza_type_id", "revenue") == {"T1": D("71.00"), "T2": D("24.50"), "T3": D("27.00")}
    assert _map(marts.type_revenue(f, "line"), "pizza_type_id", "revenue") == {
        "T1": D("35.50"), "T2": D("12.25"), "T3": D("27.00")}
    assert _map(marts.line_rows_exact(f).groupBy("pizza_type_id").agg(F.sum("total_price").alias("r")),
                "pizza_type_id", "r") == {"T1": D("35.50"), "T2": D("12.25"), "T3": D("27.00")}


def test_line_grain_needs_no_topping_row(spark, star):
    line = build_fact(denormalize(micro_tables(spark), grain="line"))
    cut = star["fact_order"].where("pizza_topping_id IS NULL OR pizza_topping_id <> 'P1'")  # the smallest topping is gone
    expected = {"T1": D("35.50"), "T2": D("12.25"), "T3": D("27.00")}
    assert _map(marts.type_revenue(line, "line_fact"), "pizza_type_id", "revenue") == expected
    assert _map(marts.type_revenue(cut, "line"), "pizza_type_id", "revenue") == expected
    assert line.where("pizza_topping_id IS NOT NULL").count() == 0
    assert line.schema.simpleString() == star["fact_order"].schema.simpleString()


def test_monthly_revenue_sorted(star):
    for grain, expected in (("topping", [("20151", D("95.50")), ("20152", D("27.00"))]),
                            ("line", [("20151", D("47.75")), ("20152", D("27.00"))])):
        rows = marts.monthly_revenue(star["fact_order"], star["dim_date"], grain).collect()
        assert [(r.month_label, r.revenue) for r in rows] == expected


def test_category_and_hour(star):
    f, dd, dt = star["fact_order"], star["dim_date"], star["dim_pizza_type"]
    assert _map(marts.category_revenue(f, dt), "category", "revenue") == {"Classic": D("98.00"), "Veggie": D("24.50")}
    assert _map(marts.category_revenue(f, dt, "line"), "category", "revenue") == {
        "Classic": D("62.50"), "Veggie": D("12.25")}
    assert _map(marts.orders_by_hour(f, dd), "hour", "orders") == {11: 6, 12: 2, 20: 1}
    assert _map(marts.orders_by_hour(f, dd, "line"), "hour", "orders") == {11: 2, 12: 1, 20: 1}
    assert marts.hourly_revenue(f, dd).count() == 4


def test_grain_is_validated(star):
    with pytest.raises(ValueError):
        marts.type_revenue(star["fact_order"], "daily")


def test_gold_gate_fails_on_missing_topping(silver, star):
    report = quality.gold_report(silver, star)
    failed = {(r.check, r.subject, r.observed) for r in report.where("NOT passed").collect()}
    assert ("not_null", "fact_order.pizza_topping_id", 1) in failed
    assert ("referential_integrity", "fact_order.pizza_topping_id -> dim_pizza_topping", 1) in failed
    assert ("positive_quantity", "fact_order", 2) in failed
    with pytest.raises(quality.QualityGateError):
        quality.gate(report, "gold")


def test_gold_gate_passes_without_topping_less_line(spark):
    silver = denormalize(micro_tables(spark, drop_lines=("4",)))
    report = quality.gold_report(silver, build_star(silver))
    quality.gate(report, "gold")  # only the quantity warning remains
    assert {r.check for r in report.where("NOT passed").collect()} == {"positive_quantity"}


def test_silver_report_severities(tables, silver):
    rows = {(r.check, r.subject): (r.observed, r.severity, r.passed)
            for r in quality.silver_report(tables, TABLE_KEYS, silver).collect()}
    assert rows[("cardinality", "orderdetail->silver")] == (3, "warning", False)
    assert rows[("duplicate_pk", "orderdetail(order_detail_id)")] == (0, "critical", True)
    assert rows[("null_fk", "orderdetail.order_id")] == (1, "info", False)
    assert rows[("missing_reference", "types_without_topping")] == (1, "warning", False)
    quality.gate(quality.silver_report(tables, TABLE_KEYS, silver), "silver")  # warnings do not block


def test_silver_gate_blocks_duplicate_keys(spark, tables):
    dup = dict(tables)
    dup["pizza"] = tables["pizza"].unionByName(tables["pizza"].where("pizza_id = 'T1_s'"))
    report = quality.silver_report(dup, TABLE_KEYS, denormalize(dup))
    with pytest.raises(quality.QualityGateError, match="pizza"):
        quality.gate(report, "silver")


def test_duplicate_branch_id_collides_with_default_row(spark, tables):
    t = dict(tables)
    t["branch"] = tables["branch"].unionByName(spark.createDataFrame([("0", "Head office")], tables["branch"].schema))
    t["orders"] = tables["orders"].withColumn("bran_id", F.when(F.col("order_id") == 1, "0").otherwise(F.col("bran_id")))
    silver = denormalize(t)
    rows = {r.subject: r.passed for r in quality.uniqueness_checks({"dim_branch": build_star(silver)["dim_branch"]}).collect()}
    assert rows == {"dim_branch(bran_id)": False}
