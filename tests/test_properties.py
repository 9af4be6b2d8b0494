"""Property tests: upsert laws, mark monotonicity, fan-out arithmetic, mart consistency."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from goldleaf.operators import marts
from goldleaf.operators.hwm import advance
from goldleaf.operators.denorm import denormalize
from goldleaf.operators.star import build_star
from goldleaf.operators.upsert import merge_rows
from micro import micro_tables

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
rows = st.lists(st.tuples(st.integers(0, 30), st.integers(0, 5)), max_size=25)


def _df(spark, pairs):
    return spark.createDataFrame([(str(k), v) for k, v in pairs], "id string, v int")


def _latest(pairs):
    return {str(k): v for k, v in pairs}


@SETTINGS
@given(target=rows, inc=rows)
def test_upsert_is_idempotent(spark, target, inc):
    t, s = _df(spark, _latest(target).items()), _df(spark, _latest(inc).items())
    once = merge_rows(t, s, ["id"], True)
    twice = merge_rows(once, s, ["id"], True)
    assert sorted(once.collect()) == sorted(twice.collect())
    assert {r.id: r.v for r in once.collect()} == {**_latest(target), **_latest(inc)}


@SETTINGS
@given(target=rows, a=rows, b=rows)
def test_split_increments_equal_whole(spark, target, a, b):
    t = _df(spark, _latest(target).items())
    whole = {**_latest(a), **_latest(b)}
    step = merge_rows(merge_rows(t, _df(spark, _latest(a).items()), ["id"], True), _df(spark, _latest(b).items()),
                      ["id"], False)
    one = merge_rows(t, _df(spark, whole.items()), ["id"], False)
    assert sorted(step.collect()) == sorted(one.collect())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(0, 10_000)), min_size=1, max_size=20))
def test_mark_is_monotone(offsets):
    base = datetime(2024, 1, 1)
    mark = None
    for off in offsets:
        new = advance(mark, None if off is None else base + timedelta(minutes=off))
        assert mark is None or datetime.fromisoformat(new) >= datetime.fromisoformat(mark)
        mark = new


def test_silver_rows_equal_sum_of_toppings(spark):
    t = micro_tables(spark)
    silver = denormalize(t)
    per_type = t["pizzatypetopping"].groupBy("pizza_type_id").count()
    lines = (t["orderdetail"].join(t["orders"].select("order_id"), "order_id")
             .join(t["pizza"].select("pizza_id", "pizza_type_id"), "pizza_id")
             .join(t["pizzatypes"].select("pizza_type_id"), "pizza_type_id"))
    expected = lines.join(per_type, "pizza_type_id", "left").agg(
        F.sum(F.greatest(F.coalesce("count", F.lit(0)), F.lit(1)))).first()[0]
    assert silver.count() == expected


def test_month_and_category_totals_agree(spark):
    star = build_star(denormalize(micro_tables(spark)))
    f = star["fact_order"]
    for grain in ("topping", "line"):
        m = marts.monthly_revenue(f, star["dim_date"], grain).agg(F.sum("revenue")).first()[0]
        c = marts.category_revenue(f, star["dim_pizza_type"], grain).agg(F.sum("revenue")).first()[0]
        t = marts.type_revenue(f, grain).agg(F.sum("revenue")).first()[0]
        assert m == c == t
