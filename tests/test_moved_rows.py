"""What the joins, checks and marts move and write: narrow rows, each once, with the same results."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from goldleaf.operators import denorm, derived_checks, quality, star
from goldleaf.operators.derived_checks import LineStar
from goldleaf.plans import registry
from goldleaf.sources.sinks import FolderSink
from goldleaf.spec import TABLE_KEYS
from micro import micro_tables


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def _repeated(spark):
    """The micro tables with a line, an order and a (type, topping) pair that come twice."""
    t = micro_tables(spark)
    for name, cond in (("orderdetail", "order_detail_id = '2'"), ("orders", "order_id = 2"),
                       ("pizzatypetopping", "pizza_type_id = 'T1' AND pizza_topping_id = 'P1'")):
        t[name] = t[name].unionByName(t[name].where(cond))
    return t


def _written_columns(monkeypatch):
    """Columns of every frame that the registry's queries write, in turn."""
    seen, real = [], registry.materialize
    monkeypatch.setattr(registry, "materialize", lambda df, *a: (seen.append(df.columns), real(df, *a))[1])
    return seen


def test_distinct_fact_is_distinct_before_toppings_multiply_it(spark):
    t = _repeated(spark)
    out, expected = star.build_distinct_fact(t), star.build_fact(denorm.denormalize(t), distinct=True)
    assert out.schema.simpleString() == expected.schema.simpleString()
    assert sorted(out.collect(), key=str) == sorted(expected.collect(), key=str)
    plan = _plan(star.build_distinct_fact(micro_tables(spark)))
    assert plan.index("Generate inline") < plan.index("Exchange hashpartitioning")  # the top line is the last step


def test_toppings_unfold_as_a_left_join_would(spark):
    lines = spark.createDataFrame([(1, "T1"), (2, "T3"), (3, None), (1, "T1")], "id int, pizza_type_id string")
    toppings = spark.createDataFrame([("T1", "P1", "Cheese"), ("T1", "P1", "Cheese"), ("T1", None, None), (None, "P2", "Basil")],
                                     "pizza_type_id string, pizza_topping_id string, pizza_topping_nm string")
    columns = ["id", "pizza_type_id", "pizza_topping_id", "pizza_topping_nm"]
    unfolded, joined = (denorm.with_toppings(lines, toppings, small).select(*columns) for small in (True, False))
    assert "Generate inline" in _plan(unfolded)
    assert sorted(unfolded.collect(), key=str) == sorted(joined.collect(), key=str)
    assert unfolded.count() == 8


def test_orders_of_large_items_move_once_an_order(spark):
    late, broadcast = (denorm.inner_chain(_repeated(spark), small).select("order_detail_id", "date", "price", "pizza_nm", "pizza_categ")
                       for small in ({"pizzatypes"}, {"pizza", "pizzatypes"}))
    assert sorted(late.collect(), key=str) == sorted(broadcast.collect(), key=str)
    plan = _plan(denorm.inner_chain(micro_tables(spark), {"pizzatypes"}))
    moved = [part.splitlines()[1] for part in plan.split("Exchange hashpartitioning(pizza_id")[1:]]
    assert moved and not any("date" in x for x in moved)  # lines go to their items before they take their order's columns


@pytest.mark.parametrize("shared_by", [1, 2])
def test_key_counts_are_exact_when_keys_share_hashes(spark, monkeypatch, shared_by):
    keys = spark.createDataFrame([("a", None), ("a", None), ("b", 1), (None, 1), ("1", None), (None, None)], "k string, l int")
    monkeypatch.setattr(quality, "_key_hash", lambda cols: F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in cols]), F.lit(shared_by)))
    counts = {r["_table"]: r for r in quality.key_group_counts(
        {"one": (keys, ["k"]), "two": (keys, ["k", "l"]), "none": (keys.where("false"), ["k"])}).collect()}
    assert [tuple(counts[t])[2:] for t in ("one", "two", "none")] == [(2, 4, 6), (1, 5, 6), (0, 0, 0)]
    assert counts["two"]["_subject"] == "two(k,l)"


def test_reports_on_hashed_line_ids_are_exact(spark, monkeypatch):
    t = _repeated(spark)
    whole = LineStar(t)
    reports = [lambda s: derived_checks.silver_report(t, TABLE_KEYS, s), derived_checks.uniqueness_checks]
    expected = [sorted(map(str, report(whole).collect())) for report in reports]
    monkeypatch.setattr(derived_checks, "_hash_of_id", lambda: F.pmod(F.xxhash64("order_detail_id"), F.lit(2)))
    for report, columns, right in zip(reports, (derived_checks.SILVER_REPORT_COLUMNS, derived_checks.UNIQUENESS_COLUMNS), expected):
        narrow = registry._line_star(t, columns)
        assert narrow.lines.columns == [*columns, "n"]
        assert sorted(map(str, report(narrow).collect())) == right


@pytest.mark.parametrize("query, absent", [
    ("silver_quality_report", {"date", "time", "size", "price", "pizza_nm"}), ("check_trend", {"date", "time", "size", "price", "pizza_nm"}),
    ("check_uniqueness", {"time", "quantity", "order_id"}), ("check_fact_nulls", {"order_detail_id", "member_nm", "time", "order_id"}),
    ("check_referential_integrity", {"order_detail_id", "time", "order_id"}), ("gold_quality_report", {"time", "order_id"})])
def test_reports_write_only_the_columns_they_read(spark, monkeypatch, query, absent):
    class Asked(Exception):
        pass

    def asked(tables, columns=None):
        raise Asked(columns)

    monkeypatch.setattr(registry, "_line_star", asked)
    monkeypatch.setattr(registry, "retail_source_views", lambda s, d: micro_tables(s))
    with pytest.raises(Asked) as e:
        registry.all_queries()[query](spark, "")
    assert e.value.args[0] and not absent & set(e.value.args[0])


def test_merged_order_counts_join_the_lines_once(spark, monkeypatch):
    seen = _written_columns(monkeypatch)
    monkeypatch.setattr(registry, "retail_source_views", lambda s, d: micro_tables(s))
    monkeypatch.setattr(registry, "SPLIT_TOTAL", 15)
    out = {r["hour"]: r["orders"] for r in registry._merged_order_counts(spark, "").collect()}
    assert out == {11: 2, 20: 1, 12: 1}
    assert seen == [["part", "hour", "bucket", "orders"]]  # one pass for both parts, kept apart


def test_publishing_joins_the_lines_once_a_publication(spark, monkeypatch):
    seen, published, real = _written_columns(monkeypatch), [], FolderSink.publish
    monkeypatch.setattr(registry, "retail_source_views", lambda s, d: micro_tables(s))
    monkeypatch.setattr(FolderSink, "publish", lambda self, frames: (published.append(dict(frames)), real(self, frames)))
    registry.all_queries()["warehouse_publish"](spark, "").collect()
    assert len(seen) == 2 and len(published) == 3
    tables = micro_tables(spark)
    expected = {"fact_order": star.build_fact(denorm.denormalize(tables)), "dim_branch": LineStar(tables).dimensions()["dim_branch"]}
    for name, frame in expected.items():
        assert sorted(published[1][name].select(*frame.columns).collect(), key=str) == sorted(frame.collect(), key=str), name
