"""Schema evolution, partitioned upserts, quarantine, concurrent ingest, contents and check history."""

import os
import subprocess
import sys
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldleaf.operators import derived_checks, quality
from goldleaf.operators.denorm import denormalize
from goldleaf.operators.derived_checks import LineStar
from goldleaf.operators.history import CheckHistory
from goldleaf.operators.line_marts import counted_bitmaps, mart_lines, mart_of_lines, merged_bitmaps, order_bitmaps
from goldleaf.operators.partitioned import PART, PartitionedTable
from goldleaf.operators.quarantine import quarantined, reasons
from goldleaf.operators.schemas import SchemaMismatch, evolved, wider_type
from goldleaf.operators.star import build_star
from goldleaf.operators.upsert import upsert
from goldleaf.plans.bronze import BronzeError, ingest_table, run_bronze
from goldleaf.session import scratch_path
from goldleaf.sources.lake import VersionedStore
from goldleaf.spec import SOURCE_TABLES, TABLE_KEYS, TableSpec
from micro import micro_tables

AS_OF = "2024-01-20 00:00:00"
NEW = datetime(2024, 1, 1)


def store_of(spark, name):
    return VersionedStore(spark, scratch_path(spark, name))


# --- schemas ---------------------------------------------------------------------------------------------

@pytest.mark.parametrize("a,b,wide", [
    ("int", "bigint", "bigint"), ("smallint", "tinyint", "smallint"), ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"),
    ("int", "decimal(5,2)", "decimal(12,2)"), ("float", "double", "double"), ("int", "double", "double"), ("bigint", "double", None),
    ("date", "timestamp", "timestamp"), ("string", "int", None), ("decimal(38,0)", "decimal(38,10)", None), ("void", "date", "date"),
])
def test_wider_types(spark, a, b, wide):
    kind = lambda t: T._parse_datatype_string(t)
    for x, y in ((a, b), (b, a)):
        got = wider_type(kind(x), kind(y))
        assert (got.simpleString() if got else None) == wide


def test_columns_are_added_kept_and_widened(spark):
    store = store_of(spark, "t_evolve")
    upsert(store, "t", spark.createDataFrame([(1, 10, "a"), (2, 20, "b")], "k int, n int, old string"), ["k"])
    upsert(store, "t", spark.createDataFrame([(2, 2**40, "x"), (3, 30, "y")], "K bigint, n bigint, fresh string"), ["k"], policy="union")
    got = store.read("t")
    assert got.schema.simpleString() == "struct<k:bigint,n:bigint,old:string,fresh:string>"
    assert sorted(map(tuple, got.collect())) == [(1, 10, "a", None), (2, 2**40, "b", "x"), (3, 30, None, "y")]
    # types stay unless asked otherwise: a narrower one is cast, a value that does not fit raises
    upsert(store, "t", spark.createDataFrame([(1, 5, "z", "w")], "k int, n int, old string, fresh string"), ["k"])
    with pytest.raises(Exception, match="OVERFLOW|OUT_OF_RANGE"):
        upsert(store, "t", spark.createDataFrame([(1, Decimal(10) ** 20)], "k int, n decimal(38,0)"), ["k"])
    assert (1, 5, "z", "w") in set(map(tuple, store.read("t").collect())) and store.read("t").schema == got.schema


def test_schemas_that_do_not_fit_change_nothing(spark):
    store = store_of(spark, "t_mismatch")
    upsert(store, "t", spark.createDataFrame([(1, "a")], "k int, v string"), ["k"])
    for bad, why in (("k int, v int", "no common type"), ("v string", "key column k is missing")):
        with pytest.raises(SchemaMismatch, match=why):
            upsert(store, "t", spark.createDataFrame([], bad), ["k"])
    for other in ("k int", "k int, v string, w int", "k bigint, v string"):
        with pytest.raises(SchemaMismatch):
            evolved(T._parse_datatype_string("k int, v string"), T._parse_datatype_string(other), ["k"], "strict")
    assert evolved(T._parse_datatype_string("k bigint, v string"), T._parse_datatype_string("k int, v string"), ["k"], "strict")
    assert store.latest("t")[0] == 1


# --- partitioned upsert ----------------------------------------------------------------------------------

def test_untouched_partitions_keep_their_files(spark):
    path = scratch_path(spark, "t_parts")
    table = PartitionedTable(spark, path, ["k"], 64)
    table.create(spark.range(4000).selectExpr("id AS k", "id * 2 AS v"))
    files = lambda: {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}
    before = files()
    placed = {r["k"]: r[PART] for r in spark.read.parquet(path).collect()}
    keys = [k for k in range(4000) if placed[k] in (3, 17, 40)][:30]
    touched = table.upsert(spark.createDataFrame([(k, -1) for k in keys], "k bigint, v bigint"))
    assert touched == [3, 17, 40]
    folder = lambda f: int(f.split(f"{PART}=")[1].split("/")[0])
    assert {folder(f) for f in before - files()} == {3, 17, 40} == {folder(f) for f in files() - before}
    assert len({folder(f) for f in before & files()}) == 61
    got = {r["k"]: r["v"] for r in table.read().collect()}
    assert got == {k: -1 if k in keys else 2 * k for k in range(4000)}
    assert table.upsert(spark.createDataFrame([(9001, 1)], "k int, v int")) and table.read().count() == 4001
    assert table.upsert(spark.createDataFrame([], "k bigint, v bigint")) == []
    with pytest.raises(SchemaMismatch):
        table.upsert(spark.createDataFrame([(1, "x")], "k bigint, v string"))


def test_a_failed_upsert_leaves_all_partitions(spark):
    table = PartitionedTable(spark, scratch_path(spark, "t_fail"), ["a", "b"], 4)
    table.create(spark.createDataFrame([(i, None if i == 3 else "x", 0) for i in range(20)], "a int, b string, v int"))
    source = spark.createDataFrame([(1, "x", 0), (3, None, 7)], "a int, b string, v int")
    broken = source.withColumn("v", F.when(F.col("a") == 1, F.raise_error(F.lit("planted")).cast("int")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="planted"):
        table.upsert(broken)
    assert table.read().where("v <> 0").count() == 0 and table.read().count() == 20


# --- quarantine ------------------------------------------------------------------------------------------

def test_bad_rows_are_set_aside_with_reasons(spark):
    rows = [(1, "a", NEW), (None, "b", NEW), (2, "c", datetime(2999, 1, 1)), (3, "d", NEW), (3, "e", NEW), (4, "f", None),
            (None, "g", datetime(2999, 6, 1)), (None, "g", datetime(2999, 6, 1)), (5, "h", datetime(2024, 1, 5))]
    source = spark.createDataFrame(rows, "k int, v string, last_updated_timestamp timestamp")
    store, spec = store_of(spark, "t_quarantine"), TableSpec("t", ["k"])
    first = ingest_table(spark, spec, source, store, AS_OF, quarantine=True)
    assert (first.status, first.rows, first.quarantined) == ("loaded", 3, 6)
    assert first.watermark == "2024-01-05 00:00:00"  # of the good rows
    assert sorted(r["k"] for r in store.read("t").collect()) == [1, 4, 5]
    bad = sorted((str(r["k"]), r["v"], tuple(r["reasons"])) for r in quarantined(store).collect())
    assert bad == [("2", "c", ("timestamp_range",)), ("3", "d", ("duplicate_key",)), ("3", "e", ("duplicate_key",)),
                   ("None", "b", ("null_key",)), ("None", "g", ("null_key", "timestamp_range"))]
    # rows from the future are newer than the mark: read again, kept once; the mended row is taken
    again = ingest_table(spark, spec, source, store, AS_OF, quarantine=True)
    assert (again.status, again.quarantined) == ("empty", 3) and quarantined(store).count() == 5
    mended = source.where("k <> 2").unionByName(spark.createDataFrame([(2, "c", datetime(2024, 1, 6))], source.schema))
    assert ingest_table(spark, spec, mended, store, AS_OF, quarantine=True).rows == 1
    assert sorted(r["k"] for r in store.read("t").collect()) == [1, 2, 4, 5]
    # without quarantine the same increment is refused as a whole
    assert ingest_table(spark, spec, source, store_of(spark, "t_refused"), AS_OF).status == "rejected"


def test_reasons_of_clean_and_empty_increments(spark):
    clean = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    assert [r["reasons"] for r in reasons(clean, ["k"]).collect()] == [[], []]
    assert reasons(clean.where("k > 5"), ["k"], None).collect() == []
    nan = spark.createDataFrame([(float("nan"), 1), (1.0, 2)], "k double, v int")
    assert {r["v"]: r["reasons"] for r in reasons(nan, ["k"]).collect()} == {1: ["null_key"], 2: []}


# --- concurrent ingest -----------------------------------------------------------------------------------

def test_one_failing_table_does_not_stop_the_others(spark):
    sources = {k: v.withColumn("last_updated_timestamp", F.lit(NEW).cast("timestamp")) for k, v in micro_tables(spark).items()}
    sources["member"] = sources["member"].withColumn("member_nm", F.raise_error(F.lit("planted")).cast("string"))
    lake = scratch_path(spark, "t_concurrent")
    with pytest.raises(BronzeError, match="member failed") as err:
        run_bronze(spark, sources, lake, as_of=AS_OF, concurrent=3)
    assert [r.table for r in err.value.results] == SOURCE_TABLES
    assert {r.status for r in err.value.results if r.table != "member"} == {"loaded"}
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_pools_keep_the_callers_job_group(spark):
    spark.sparkContext.setJobGroup("t_group", "probes")
    try:
        denormalize(micro_tables(spark))
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("t_group")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) >= 6  # the size probes of the lookups


# --- contents --------------------------------------------------------------------------------------------

def test_contents_tell_changed_missing_and_doubled_rows(spark):
    rows = [(i, None if i % 5 == 0 else f"v{i % 3}", Decimal(i)) for i in range(50)]
    kind = "k int, v string, d decimal(10,2)"
    whole = spark.createDataFrame(rows, kind)
    others = {
        "same": (rows[::-1], True), "changed": ([(0, "v0", Decimal(0)), *rows[1:]], False), "missing": (rows[1:], False),
        "doubled": ([*rows, rows[7]], False), "swapped": ([(0, None, Decimal(1)), (1, "v1", Decimal(0)), *rows[2:]], False),
        "replaced": ([rows[1], *rows[1:]], False),
    }
    results = quality.content_checks({n: (whole, spark.createDataFrame(r, kind)) for n, (r, _) in others.items()}).collect()
    assert {r["subject"]: r["passed"] for r in results} == {n: ok for n, (_, ok) in others.items()}
    assert quality.content_hash(whole.where("k < 0")).collect()[0].asDict() == {"rows": 0, "content": Decimal(0)}
    near = spark.createDataFrame([("a", "bc"), (None, "-")], "x string, y string"), spark.createDataFrame([("ab", "c"), ("-", None)], "x string, y string")
    assert not quality.content_checks({"n": near}).first()["passed"]


# --- derived checks and marts ----------------------------------------------------------------------------

def results_of(df):
    return sorted(str(tuple(r)) for r in df.select("check", "subject", "observed", "expected", "severity", "passed").collect())


@pytest.mark.parametrize("fault", ["none", "line twice", "pair twice", "type without topping", "zero quantity"])
def test_line_grain_checks_give_the_figures_of_all_rows(spark, fault):
    tables = micro_tables(spark, drop_lines=() if fault == "type without topping" else ("4",))
    if fault == "line twice":
        tables["orderdetail"] = tables["orderdetail"].unionByName(tables["orderdetail"].where("order_detail_id = '1'"))
    if fault == "pair twice":
        tables["pizzatypetopping"] = tables["pizzatypetopping"].unionByName(
            tables["pizzatypetopping"].where("pizza_type_id = 'T1' AND pizza_topping_id = 'P1'"))
    silver = denormalize(tables)
    star, parts = build_star(silver), LineStar(tables)
    assert results_of(derived_checks.gold_report(parts)) == results_of(quality.gold_report(silver, star))
    assert results_of(derived_checks.silver_report(tables, TABLE_KEYS, parts)) == results_of(
        quality.silver_report(tables, TABLE_KEYS, silver))
    for name, df in parts.dimensions().items():
        assert sorted(map(str, df.collect())) == sorted(map(str, star[name].collect()))


def test_order_bitmaps_merge_to_exact_counts(spark):
    lines = spark.range(200_000).selectExpr("id * 7 % 90000 AS order_id", "CAST(id * 7 % 90000 % 24 AS int) AS hour", "id % 3 AS part")
    want = {r["hour"]: r["n"] for r in lines.groupBy("hour").agg(F.count_distinct("order_id").alias("n")).collect()}
    parts = [order_bitmaps(lines.where(F.col("part") == p)) for p in range(3)]
    merged = merged_bitmaps(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert {r["hour"]: r["orders"] for r in counted_bitmaps(merged).collect()} == want
    plan = counted_bitmaps(order_bitmaps(lines))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2 and "order_id" not in plan.split("Exchange hashpartitioning")[1].split("]")[0]


def test_marts_of_lines_shuffle_no_multiplied_rows(spark):
    lines = mart_lines(micro_tables(spark))
    assert lines.count() == 5 and lines.agg(F.sum("n")).first()[0] == denormalize(micro_tables(spark)).count()
    silver = denormalize(micro_tables(spark))
    for grain, rows in (("topping", silver), ("line", denormalize(micro_tables(spark), grain="line"))):
        want = rows.groupBy("pizza_categ").agg(F.sum((F.col("price") * F.col("quantity")).cast("decimal(18,2)")).alias("r"))
        got = {r["category"]: r["revenue"] for r in mart_of_lines(lines, "category", grain).collect()}
        assert got == {r["pizza_categ"]: r["r"] for r in want.collect()}


# --- history ---------------------------------------------------------------------------------------------

def test_history_keeps_runs_and_compares_the_last_two(spark):
    kind = "check string, subject string, observed bigint, expected bigint, severity string, passed boolean"
    history = CheckHistory(spark, scratch_path(spark, "t_history"))
    run = lambda rows: spark.createDataFrame(rows, kind)
    history.record(run([("c", "old", 1, 0, "warning", False)]), "silver", "0")
    history.record(run([("c", "a", 5, 0, "warning", False), ("c", "b", 0, 0, "warning", True), ("c", "gone", 1, 0, "info", False)]), "silver", "1")
    assert {r["trend"] for r in history.trend("silver").collect()} == {"new", "gone"}
    second = [("c", "a", 3, 0, "warning", False), ("c", "b", 2, 0, "critical", False), ("c", "new", 1, None, "skip", True)]
    for _ in range(2):  # a run that is recorded again replaces itself
        history.record(run(second), "silver", "2")
    history.record(run([("c", "a", 9, 0, "fail", False)]), "gold", "9")
    got = {r["subject"]: (r["observed_before"], r["observed_now"], r["change"], r["trend"]) for r in history.trend("silver").collect()}
    assert got == {"a": (5, 3, -2, "better"), "b": (0, 2, 2, "broken"), "gone": (1, None, None, "gone"), "new": (None, 1, None, "new")}
    assert [r["subject"] for r in history.warnings("silver", "2").collect()] == ["a"]
    assert history.read("silver").count() == 7 and history.read().count() == 8


def test_silver_stage_records_and_stops_before_the_wide_write(spark):
    from goldleaf.plans.silver import SILVER_TABLE, build_silver, silver_store
    lake = scratch_path(spark, "t_silver")
    history = CheckHistory(spark, f"{lake}/checks")
    tables = micro_tables(spark)
    tables["member"] = tables["member"].unionByName(tables["member"].where("member_id = 'M1'"))
    store = silver_store(spark, lake)
    with pytest.raises(quality.QualityGateError, match="member"):
        build_silver(spark, tables, store, history, "run-1")
    assert not os.path.exists(store.path(SILVER_TABLE, 1)) and history.read("silver").where("NOT passed").count() == 1
    report = build_silver(spark, micro_tables(spark), store, history, "run-2")
    assert history.read("silver").where("run_id = 'run-2'").count() == report.count()
    assert store.read(SILVER_TABLE).count() == 9


# --- entry point -----------------------------------------------------------------------------------------

@pytest.mark.parametrize("missing", ["ahocorasick", "tokenizers", "goldleaf.llm", "corpus_pipeline"])
def test_entry_survives_a_missing_library(missing):
    code = (f"import sys; sys.modules[{missing!r}] = None\nimport __spark_entry__ as e, oracles\n"
            "assert set(oracles.oracle_queries()) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
