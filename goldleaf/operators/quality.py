"""Data-quality checks as Spark jobs returning rows of ``check_result``.

``check_result(check, subject, observed, expected, severity, passed)``

* ``observed`` / ``expected`` are bigint counts (``expected`` NULL when the test is not an equality).
* ``severity``: ``reject`` (bronze: skip the batch), ``critical`` (silver: stop), ``fail`` (gold: stop),
  ``warning``, ``info`` (reported only) and ``skip`` (an empty increment: nothing to do).
* :func:`gate` raises :class:`QualityGateError` when a blocking check did not pass.

Counts that read the same table are fused into one aggregate (``count_if`` per condition), so a report
costs one scan per table plus one grouped aggregate per key check, instead of one job per check.
Results are assembled on the executors (``inline`` over an array of structs); only :func:`gate` brings
the few result rows to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldleaf.operators.joins import sized_broadcast
from goldleaf.sources.lake import materialize
from goldleaf.spec import CHECK_RESULT_SCHEMA, FACT_KEYS, TIMESTAMP_LOWER_BOUND

BLOCKING = ("reject", "critical", "fail")


class QualityGateError(ValueError):
    """A blocking data-quality check failed."""


def _result(check: str, subject: str, observed: Column, expected: Column | int | None, severity: str | Column,
            passed: Column) -> Column:
    exp = F.lit(expected) if not isinstance(expected, Column) else expected
    sev = F.lit(severity) if isinstance(severity, str) else severity
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(subject).alias("subject"),
        observed.cast("bigint").alias("observed"),
        exp.cast("bigint").alias("expected"),
        sev.alias("severity"),
        passed.alias("passed"),
    )


def _rows(one_row: DataFrame, results: Sequence[Column]) -> DataFrame:
    return one_row.select(F.inline(F.array(*results)))


def result_rows(one_row: DataFrame, check: str, subject: str, observed: Column, expected: Column, severity: str) -> DataFrame:
    """One result of a check that passes when observed equals expected."""
    return _rows(one_row, [_result(check, subject, observed, expected, severity, observed == expected)])


def side_by_side(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two frames of one row each as one row with the columns of both."""
    both = a.unionByName(b, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def union_results(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def _zero(c: str) -> Column:
    return F.col(c) == 0


# --- bronze ----------------------------------------------------------------------------------------

def null_or_nan(df: DataFrame, c: str) -> Column:
    cond = F.col(c).isNull()
    if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
        cond = cond | F.isnan(c)
    return cond


def out_of_range(df: DataFrame, change_col: str, as_of: str | None = None) -> Column:
    """The change time is before 1900 or after ``as_of`` (now, if not given); NULL for a NULL time."""
    t = df.schema[change_col].dataType
    upper = (F.lit(as_of) if as_of else F.current_timestamp()).cast(t)
    return (F.col(change_col) < F.lit(TIMESTAMP_LOWER_BOUND).cast(t)) | (F.col(change_col) > upper)


def find_duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with their row count ``n``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def _duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: ``dup`` = number of key groups with more than one row, ``groups``, ``rows``.

    Partial aggregation combines each key map-side, so a hot key costs one row per partition in the
    shuffle, not one per occurrence.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.count_if(F.col("n") > 1).alias("dup"), F.count(F.lit(1)).alias("groups"),
                       F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))


BRONZE_CHECKS = ("row_count", "null_key", "duplicate_keys", "timestamp_range")


def bronze_checks(df: DataFrame, table: str, keys: Sequence[str], change_col: str | None = None,
                  as_of: str | None = None, checks: Sequence[str] = BRONZE_CHECKS) -> DataFrame:
    """Checks on one increment before it is merged: not empty, keys present and non-NULL, keys
    unique, change timestamp within [1900-01-01, as_of] (skipped when the column is absent).

    ``as_of`` defaults to the current time; pass a literal for reproducible results.
    """
    cols = set(df.columns)
    aggs, results = [], []
    if "row_count" in checks:
        aggs.append(F.count(F.lit(1)).alias("rows"))
        results.append(_result("row_count", table, F.col("rows"), None, "skip", F.col("rows") > 0))
    if "null_key" in checks:
        for k in keys:
            if k in cols:
                aggs.append(F.count_if(null_or_nan(df, k)).alias(f"null_{k}"))
                results.append(_result("null_key", f"{table}.{k}", F.col(f"null_{k}"), 0, "reject",
                                       _zero(f"null_{k}")))
            else:
                results.append(_result("null_key", f"{table}.{k}", F.lit(None), 0, "reject", F.lit(False)))
    if "timestamp_range" in checks and change_col and change_col in cols:
        aggs.append(F.count_if(out_of_range(df, change_col, as_of)).alias("bad_ts"))
        results.append(_result("timestamp_range", f"{table}.{change_col}", F.col("bad_ts"), 0, "reject",
                               _zero("bad_ts")))
    parts = []
    if results:
        parts.append(_rows(df.agg(*aggs) if aggs else df.limit(1).agg(F.count(F.lit(1)).alias("_")), results))
    if "duplicate_keys" in checks and keys and set(keys) <= cols:
        dup = _duplicate_groups(df, keys)
        parts.append(_rows(dup, [_result("duplicate_keys", f"{table}({','.join(keys)})", F.col("dup"), 0, "reject",
                                         _zero("dup"))]))
    if not parts:
        return empty_results(df.sparkSession)
    return union_results(parts)


def null_key_check(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Only the NULL/NaN key part of :func:`bronze_checks`."""
    return bronze_checks(df, table, keys, checks=("null_key",))


def timestamp_range_check(df: DataFrame, table: str, change_col: str, as_of: str | None = None) -> DataFrame:
    """Only the change-timestamp range part of :func:`bronze_checks` (no row if the column is absent)."""
    return bronze_checks(df, table, [], change_col, as_of, checks=("timestamp_range",))


# --- silver ----------------------------------------------------------------------------------------

def key_group_counts(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Per table: ``dup`` (key values on more than one row), ``groups`` (distinct key values, one NULL
    group counting once) and ``rows``, for all tables in one grouped aggregate.

    Every table contributes (table, 64-bit hash of its key as text) to one union; one aggregate per hash with
    map-side combining, then one per table. Many small tables and one large one cost a single shuffle of eight
    bytes a key. A hash that one row has is a key of one row. Only in tables where rows share a hash, as equal
    keys do, the keys of such rows are counted by their values: the figures are exact.
    """
    spark = next(iter(tables.values()))[0].sparkSession
    number = {name: k for k, name in enumerate(tables)}
    hashed = {name: df.select(F.lit(number[name]).alias("_table"), _key_hash(keys).alias("_hash"))
              for name, (df, keys) in tables.items()}
    per_hash = lambda df: df.groupBy("_table", "_hash").agg(F.count(F.lit(1)).alias("n"))
    found = {r["_table"]: r for r in per_hash(union_results([*hashed.values()])).groupBy("_table").agg(
        F.count_if(F.col("n") == 1).alias("single"), F.count_if(F.col("n") > 1).alias("shared")).collect()}  # a row per table
    single = lambda name: found[number[name]]["single"] if number[name] in found else 0
    counts = spark.createDataFrame([(name, f"{name}({','.join(keys)})", 0, single(name), single(name))
                                    for name, (_, keys) in tables.items()],
                                   "_table string, _subject string, dup bigint, groups bigint, rows bigint")
    again = [name for name in tables if number[name] in found and found[number[name]]["shared"]]
    if not again:
        return counts
    exact = union_results([_shared_keys(name, *tables[name], per_hash(hashed[name]).where("n > 1").select("_hash")) for name in again])
    return counts.unionByName(exact, allowMissingColumns=True).groupBy("_table").agg(
        F.max("_subject").alias("_subject"), *[F.sum(c).alias(c) for c in ("dup", "groups", "rows")])


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k).cast("string") for k in keys])


def _shared_keys(name: str, df: DataFrame, keys: Sequence[str], shared: DataFrame) -> DataFrame:
    """``_table, dup, groups, rows`` of the rows whose key has one of the ``shared`` hashes, by the keys' values."""
    rows = df.select(*[F.col(k).cast("string").alias(f"_k{i}") for i, k in enumerate(keys)], _key_hash(keys).alias("_hash"))
    own = rows.join(sized_broadcast(materialize(shared, "shared-hashes")), "_hash", "left_semi")
    per_key = own.groupBy(*[f"_k{i}" for i in range(len(keys))]).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.count_if(F.col("n") > 1).alias("dup"), F.count(F.lit(1)).alias("groups"),
                       F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).select(F.lit(name).alias("_table"), "*")


def duplicate_pk_checks(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]],
                        severity: str = "critical") -> DataFrame:
    """Per table: number of primary-key values held by more than one row (critical when > 0)."""
    counts = key_group_counts({name: (df, list(keys[name])) for name, df in tables.items()})
    return counts.select(
        F.lit("duplicate_pk").alias("check"), F.col("_subject").alias("subject"), F.col("dup").alias("observed"),
        F.lit(0).cast("bigint").alias("expected"), F.lit(severity).alias("severity"), (F.col("dup") == 0).alias("passed"))


def null_fk_profile(orderdetail: DataFrame, orders: DataFrame, pizza: DataFrame) -> DataFrame:
    """NULL foreign keys of the line, order and item tables (informational)."""
    spec = [(orderdetail, "orderdetail", ["order_id", "pizza_id"]),
            (orders, "orders", ["member_id", "bran_id"]),
            (pizza, "pizza", ["pizza_type_id"])]
    parts = []
    for df, name, cols in spec:
        agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        parts.append(_rows(agg, [_result("null_fk", f"{name}.{c}", F.col(c), 0, "info", _zero(c)) for c in cols]))
    return union_results(parts)


def cardinality(orderdetail: DataFrame, silver: DataFrame) -> DataFrame:
    """One row: source_lines, silver_lines (distinct order lines in silver), dropped."""
    return cardinality_of(orderdetail, silver.agg(F.count_distinct("order_detail_id").alias("silver_lines")))


def cardinality_of(orderdetail: DataFrame, silver_lines: DataFrame) -> DataFrame:
    """:func:`cardinality` from one row with the distinct lines of silver."""
    both = side_by_side(orderdetail.agg(F.count(F.lit(1)).alias("source_lines")), silver_lines)
    return both.select("source_lines", "silver_lines", (F.col("source_lines") - F.col("silver_lines")).alias("dropped"))


def cardinality_check(orderdetail: DataFrame, silver: DataFrame) -> DataFrame:
    """Lines lost by the inner joins: warning when > 0, critical when < 0 (silver gained lines)."""
    return cardinality_results(cardinality(orderdetail, silver))


def cardinality_results(c: DataFrame) -> DataFrame:
    """The result of :func:`cardinality_check` from one row of counts."""
    sev = F.when(F.col("dropped") < 0, "critical").when(F.col("dropped") > 0, "warning").otherwise("info")
    return _rows(c, [_result("cardinality", "orderdetail->silver", F.col("dropped"), 0, sev, _zero("dropped"))])


def count_rows(cond: Column, weight: str | None = None) -> Column:
    """Rows that ``cond`` holds for, each counted ``weight`` times."""
    return F.count_if(cond) if weight is None else F.coalesce(F.sum(F.when(cond, F.col(weight))), F.lit(0)).cast("bigint")


def _reference_counts(silver: DataFrame) -> DataFrame:
    return silver.agg(
        F.count_if(F.col("member_id").isNotNull() & F.col("member_nm").isNull()).alias("missing_member"),
        F.count_if(F.col("bran_id").isNotNull() & F.col("bran_nm").isNull()).alias("missing_branch"),
        F.count_if(F.col("pizza_topping_id").isNotNull() & F.col("pizza_topping_nm").isNull())
        .alias("missing_topping_master"),
        F.count_distinct(F.when(F.col("pizza_topping_id").isNull(), F.col("pizza_type_id")))
        .alias("types_without_topping"),
    )


def missing_references(silver: DataFrame) -> DataFrame:
    """One row: silver rows whose member / branch / topping id has no name (the lookup missed)."""
    return _reference_counts(silver).select("missing_member", "missing_branch", "missing_topping_master")


def types_without_bridge(silver: DataFrame) -> DataFrame:
    """One row: number of distinct item types that have no topping."""
    return silver.agg(F.count_distinct(F.when(F.col("pizza_topping_id").isNull(), F.col("pizza_type_id")))
                      .alias("types_without_topping"))


def reference_results(counts: DataFrame) -> DataFrame:
    """Warnings from one row of counts of lookups that missed."""
    names = ["missing_member", "missing_branch", "missing_topping_master", "types_without_topping"]
    return _rows(counts, [_result("missing_reference", n, F.col(n), 0, "warning", _zero(n)) for n in names])


def missing_reference_checks(silver: DataFrame) -> DataFrame:
    return reference_results(_reference_counts(silver))


def silver_report(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]], silver: DataFrame) -> DataFrame:
    """Everything the silver stage checks: duplicate PKs of all sources (critical), NULL foreign keys
    (info), lines dropped by the joins, and lookups that missed (warnings)."""
    return union_results([duplicate_pk_checks(tables, keys), silver_row_report(tables, silver)])


def silver_row_report(tables: Mapping[str, DataFrame], silver: DataFrame) -> DataFrame:
    """The part of :func:`silver_report` that comes after the check of the sources' keys."""
    return union_results([
        null_fk_profile(tables["orderdetail"], tables["orders"], tables["pizza"]),
        cardinality_check(tables["orderdetail"], silver),
        missing_reference_checks(silver),
    ])


def orphan_keys(df: DataFrame, key: str, dim: DataFrame, dim_key: str | None = None) -> DataFrame:
    """Values of ``key`` with no match in ``dim`` (a NULL key never matches), with their row count ``n``.

    Rows are counted per key value first, so the anti join sees one row per distinct value however
    often a value repeats.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    keys = dim.select(F.col(dim_key or key).alias(key))
    return counts.join(keys, key, "left_anti")


# --- gold ------------------------------------------------------------------------------------------

GOLD_KEYS = {
    "dim_pizza": ["pizza_id"],
    "dim_member": ["member_id"],
    "dim_pizza_type": ["pizza_type_id"],
    "dim_date": ["date"],
    "dim_branch": ["bran_id"],
    "dim_pizza_topping": ["pizza_topping_id"],
    "bridge_pizza_type_topping": ["pizza_type_id", "pizza_topping_id"],
    "fact_order": FACT_KEYS,
}
FACT_REQUIRED = ["date", "member_id", "pizza_id", "bran_id", "pizza_type_id", "pizza_topping_id"]
# fact column -> (dimension, dimension key)
FACT_REFERENCES = {
    "pizza_id": ("dim_pizza", "pizza_id"),
    "pizza_type_id": ("dim_pizza_type", "pizza_type_id"),
    "date": ("dim_date", "date"),
    "pizza_topping_id": ("dim_pizza_topping", "pizza_topping_id"),
    "member_id": ("dim_member", "member_id"),
    "bran_id": ("dim_branch", "bran_id"),
}


# --- contents ----------------------------------------------------------------------------------------

HASH_DIGITS = 15  # hex digits of a row's md5 that are summed: 60 bits


def row_digest(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    """A number per row from its values as text; a value's length is part of it, NULL differs from every text."""
    text = lambda c: F.col(f"`{c}`").cast("string")
    parts = [F.coalesce(F.concat(F.length(text(c)).cast("string"), F.lit(":"), text(c)), F.lit("-")) for c in cols or df.columns]
    return F.conv(F.substring(F.md5(F.concat(*parts).cast("binary")), 1, HASH_DIGITS), 16, 10).cast("bigint")


def content_hash(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row, ``rows`` and ``content``: the sum of the rows' digests, exact and free of order.

    Rows that are changed, missing or doubled change it; one sum per task is all that is moved.
    """
    digests = df.select(row_digest(df, cols).alias("_digest"))
    # summed as three numbers of 20 bits, which take far less time than decimals and overflow at no size
    sums = [F.sum(F.shiftright("_digest", 20 * i).bitwiseAND(F.lit((1 << 20) - 1).cast("bigint"))) for i in range(3)]
    parts = [F.coalesce(s, F.lit(0)).cast("decimal(20,0)") * F.lit(1 << 20 * i).cast("decimal(13,0)") for i, s in enumerate(sums)]
    return digests.agg(F.count(F.lit(1)).alias("rows"), sum(parts[1:], parts[0]).cast("decimal(38,0)").alias("content"))


def content_checks(pairs: Mapping[str, tuple[DataFrame, DataFrame]], cols: Mapping[str, Sequence[str]] | None = None,
                   severity: str = "fail") -> DataFrame:
    """Per name: the two frames hold the same rows, in any order and as often. Observed and expected are rows."""
    parts = []
    for name, (expected, observed) in pairs.items():
        own = (cols or {}).get(name) or expected.columns
        both = side_by_side(content_hash(expected, own).select(F.col("rows").alias("a"), F.col("content").alias("x")),
                            content_hash(observed, own).select(F.col("rows").alias("b"), F.col("content").alias("y")))
        parts.append(_rows(both, [_result("content", name, F.col("b"), F.col("a"), severity,
                                          (F.col("a") == F.col("b")) & (F.col("x") == F.col("y")))]))
    return union_results(parts)


def row_parity_check(silver: DataFrame, fact: DataFrame) -> DataFrame:
    """Fact rows = silver rows."""
    a = silver.agg(F.count(F.lit(1)).alias("silver_rows")).select(
        F.lit(None).cast("bigint").alias("fact_rows"), "silver_rows")
    b = fact.agg(F.count(F.lit(1)).alias("fact_rows")).select("fact_rows", F.lit(None).cast("bigint").alias("silver_rows"))
    both = a.unionByName(b).agg(F.max("fact_rows").alias("fact_rows"), F.max("silver_rows").alias("silver_rows"))
    return _rows(both, [_result("row_parity", "fact_order", F.col("fact_rows"), F.col("silver_rows"), "fail",
                                F.col("fact_rows") == F.col("silver_rows"))])


def uniqueness_checks(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]] = GOLD_KEYS) -> DataFrame:
    """Per table: distinct key values (one NULL group counts once) must equal the row count."""
    counts = key_group_counts({name: (df, list(keys[name])) for name, df in tables.items()})
    return counts.select(
        F.lit("key_uniqueness").alias("check"), F.col("_subject").alias("subject"), F.col("groups").alias("observed"),
        F.col("rows").alias("expected"), F.lit("fail").alias("severity"), (F.col("groups") == F.col("rows")).alias("passed"))


def _fact_counts(fact: DataFrame, required: Sequence[str], weight: str | None = None) -> DataFrame:
    return fact.agg(
        *[count_rows(F.col(c).isNull(), weight).alias(f"null_{c}") for c in required],
        count_rows(F.col("total_price") != F.col("unit_price") * F.col("quantity"), weight).alias("bad_total"),
        count_rows(F.col("quantity") <= 0, weight).alias("nonpositive_quantity"),
    )


def fact_null_checks(fact: DataFrame, required: Sequence[str] = FACT_REQUIRED, weight: str | None = None) -> DataFrame:
    return _rows(_fact_counts(fact, required, weight), [
        _result("not_null", f"fact_order.{c}", F.col(f"null_{c}"), 0, "fail", _zero(f"null_{c}")) for c in required])


def line_total_check(fact: DataFrame, weight: str | None = None) -> DataFrame:
    """total_price = unit_price x quantity (a NULL side never counts as a mismatch)."""
    return _rows(_fact_counts(fact, [], weight), [
        _result("line_total", "fact_order", F.col("bad_total"), 0, "fail", _zero("bad_total"))])


def positive_quantity_check(fact: DataFrame, weight: str | None = None) -> DataFrame:
    """quantity <= 0 rows (warning)."""
    return _rows(_fact_counts(fact, [], weight), [
        _result("positive_quantity", "fact_order", F.col("nonpositive_quantity"), 0, "warning",
                _zero("nonpositive_quantity"))])


def fact_row_checks(fact: DataFrame, required: Sequence[str] = FACT_REQUIRED, weight: str | None = None) -> DataFrame:
    """not-NULL, line total and quantity checks from one scan of the fact."""
    results = [_result("not_null", f"fact_order.{c}", F.col(f"null_{c}"), 0, "fail", _zero(f"null_{c}"))
               for c in required]
    results += [_result("line_total", "fact_order", F.col("bad_total"), 0, "fail", _zero("bad_total")),
                _result("positive_quantity", "fact_order", F.col("nonpositive_quantity"), 0, "warning",
                        _zero("nonpositive_quantity"))]
    return _rows(_fact_counts(fact, required, weight), results)


def orphan_counts(fact: DataFrame, dims: Mapping[str, DataFrame],
                  references: Mapping[str, tuple[str, str]] = FACT_REFERENCES,
                  optional: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Fact rows per foreign key whose value is not in the dimension (a NULL key is an orphan).

    All foreign keys are handled by one grouped aggregate and one join: the fact is unpivoted to
    (fk, value) pairs, counted per distinct pair (map-side combine, so a hot key such as the guest
    member costs one row per partition), and the distinct pairs are left-joined to the union of the
    dimension keys. Output: one row per foreign key with ``orphans``. A row of ``fact`` that stands for several
    counts ``weight`` times.
    """
    fks = list(references)
    stack = "stack({n}, {pairs}) as (fk, value)".format(
        n=len(fks), pairs=", ".join(f"'{c}', cast(`{c}` as string)" for c in fks))
    one = F.lit(1) if weight is None else F.col(weight)
    keys = fact.select(one.cast("bigint").alias("_weight"), *fks).selectExpr("_weight", stack).groupBy("fk", "value").agg(
        F.sum("_weight").alias("n"))
    if optional:
        keys = keys.where(~(F.col("fk").isin(*optional) & F.col("value").isNull()))
    dim_keys = union_results([
        dims[d].select(F.lit(c).alias("fk"), F.col(k).cast("string").alias("value")).where(F.col("value").isNotNull())
        for c, (d, k) in references.items()
    ]).distinct().withColumn("hit", F.lit(True))
    joined = keys.join(dim_keys, ["fk", "value"], "left")
    per_fk = joined.groupBy().pivot("fk", fks).agg(F.sum(F.when(F.col("hit").isNull(), F.col("n")).otherwise(0)))
    return per_fk.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("fk"), F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias("orphans")) for c in fks])))


def referential_integrity_checks(fact: DataFrame, dims: Mapping[str, DataFrame],
                                 references: Mapping[str, tuple[str, str]] = FACT_REFERENCES,
                                 optional: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    o = orphan_counts(fact, dims, references, optional, weight)
    subject = F.concat(F.lit("fact_order."), F.col("fk"), F.lit(" -> "),
                       F.create_map(*[x for c, (d, _) in references.items() for x in (F.lit(c), F.lit(d))])[F.col("fk")])
    return o.select(
        F.lit("referential_integrity").alias("check"), subject.alias("subject"), F.col("orphans").alias("observed"),
        F.lit(0).cast("bigint").alias("expected"), F.lit("fail").alias("severity"), (F.col("orphans") == 0).alias("passed"))


def gold_report(silver: DataFrame, star: Mapping[str, DataFrame], required: Sequence[str] = FACT_REQUIRED) -> DataFrame:
    """Everything the gold stage checks, all reported (not only the first failure)."""
    fact = star["fact_order"]
    return union_results([
        row_parity_check(silver, fact),
        uniqueness_checks({k: star[k] for k in GOLD_KEYS}),
        fact_row_checks(fact, required),
        referential_integrity_checks(fact, star, optional=[c for c in FACT_REFERENCES if c not in required]),
    ])


def gate(results: DataFrame, stage: str = "") -> DataFrame:
    """Raise :class:`QualityGateError` when a blocking check failed; return the results otherwise.

    Only the failed blocking rows (at most one per check) are brought to the driver.
    """
    failed = results.where(F.col("severity").isin(*BLOCKING) & ~F.coalesce(F.col("passed"), F.lit(False))).collect()
    if failed:
        lines = [f"{r['severity']}: {r['check']} on {r['subject']}: observed {r['observed']}, expected {r['expected']}"
                 for r in failed]
        raise QualityGateError(f"{stage} quality gate failed ({len(failed)} checks):\n" + "\n".join(lines))
    return results


def empty_results(spark) -> DataFrame:
    return spark.createDataFrame([], CHECK_RESULT_SCHEMA)
