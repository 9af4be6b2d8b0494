"""Silver and gold checks worked out at line grain, without the line x topping rows.

All columns of a fact row but the topping belong to its line, and the toppings belong to the line's item type.
So a count over fact rows is a count over lines, each weighted by the rows that the bridge makes of it, and
whatever concerns toppings is a count over types, weighted by their lines. The figures are those of the checks
on the multiplied rows (:mod:`goldleaf.operators.quality`), from a ninth of the rows or less.

Uniqueness of the fact's key follows from two smaller keys: when order line ids are unique, and (type, topping)
pairs are, every (line, topping) pair occurs once. Only when one of them is not are the fact's keys counted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.operators import quality
from goldleaf.operators.denorm import denormalize, topping_lookup, with_toppings
from goldleaf.operators.joins import result_fits, sized_broadcast, small_tables
from goldleaf.operators.star import build_date_dimension, build_dimension, build_fact
from goldleaf.sources.lake import materialize
from goldleaf.spec import FACT_COLUMNS, GUEST_MEMBER, UNKNOWN_BRANCH

LINE_KEY, TOPPING_KEY = "order_detail_id", "pizza_topping_id"
BRIDGE_TABLES = {"pizzatypetopping", "topping"}
# columns of silver that the checks read
DIMENSION_COLUMNS = ["pizza_id", "pizza_type_id", "size", "price", "member_id", "member_nm", "pizza_nm", "pizza_categ", "date", "bran_id", "bran_nm"]
FACT_ROW_COLUMNS = ["date", "member_id", "pizza_id", "bran_id", "pizza_type_id", "price", "quantity"]
SILVER_REPORT_COLUMNS = [LINE_KEY, "pizza_type_id", "member_id", "member_nm", "bran_id", "bran_nm"]
UNIQUENESS_COLUMNS = [LINE_KEY, *DIMENSION_COLUMNS]
GOLD_REPORT_COLUMNS = [*UNIQUENESS_COLUMNS, "quantity"]
LINE_REFERENCES = {k: v for k, v in quality.FACT_REFERENCES.items() if k != TOPPING_KEY}
TOPPING_REFERENCES = {TOPPING_KEY: quality.FACT_REFERENCES[TOPPING_KEY]}


class LineStar:
    """The star's parts at their own grain.

    ``lines``: silver with one row per line and ``n``, the fact rows it stands for; ``toppings``: one row per
    type of a line and topping (NULL: none) with ``lines``, the lines of the type. ``lines`` is read by several
    checks: give a written one (``materialize``) when more than one is asked for.

    ``columns``: only these of silver's are in ``lines``, for a check that needs no others. With ``hashed_ids``
    ``order_detail_id`` is its 64-bit hash, which moves and is kept in a fifth of the room: lines of different
    hashes are different, and for lines that share one the checks go back to the ids (:meth:`with_ids`).
    """

    def __init__(self, tables: Mapping[str, DataFrame], store=lambda df: df, columns: Sequence[str] | None = None,
                 hashed_ids: bool = False):
        self.tables, self.store, self.columns, self.hashed_ids = dict(tables), store, columns, hashed_ids
        tables = dict(tables)
        if hashed_ids:
            tables["orderdetail"] = tables["orderdetail"].withColumn(LINE_KEY, _hash_of_id())
        self._small = small_tables({k: tables[k] for k in BRIDGE_TABLES})
        small = BRIDGE_TABLES <= self._small
        bridge = topping_lookup(tables)
        rows_of = bridge.groupBy("pizza_type_id").agg(F.count(F.lit(1)).alias("n"))
        silver = denormalize(tables, grain="line").drop(TOPPING_KEY, "pizza_topping_nm")
        silver = silver.join(F.broadcast(rows_of) if small else rows_of, "pizza_type_id", "left").withColumn(
            "n", F.coalesce("n", F.lit(1)))
        self.lines = store(silver.select(*columns, "n") if columns else silver)
        per_type = self.lines.groupBy("pizza_type_id").agg(F.count(F.lit(1)).alias("lines"))
        self.toppings = per_type.join(bridge, "pizza_type_id", "left")
        self.bridge, self.bridge_is_small = bridge, small

    def with_ids(self, orderdetail: DataFrame | None = None) -> LineStar:
        """The same star (of some of the lines, if they are given) with the ids themselves."""
        return LineStar({**self.tables, "orderdetail": orderdetail or self.tables["orderdetail"]}, self.store, self.columns)

    def fact_lines(self, columns: Sequence[str] | None = None) -> DataFrame:
        """The fact's columns (or some of them) but the topping, one row per line, with ``n``."""
        return build_fact(self.lines, keep=["n"], columns=columns or [c for c in FACT_COLUMNS if c != TOPPING_KEY])

    def fact(self) -> DataFrame:
        """The whole fact: every line with the toppings of its type."""
        return build_fact(with_toppings(self.lines, self.bridge, result_fits(self.bridge, BRIDGE_TABLES, self._small)))

    def dimensions(self) -> dict[str, DataFrame]:
        """The seven tables around the fact, from lines and toppings."""
        return {
            "dim_pizza": build_dimension(self.lines, ["pizza_id", "pizza_type_id", "size", "price"]),
            "dim_member": build_dimension(self.lines, ["member_id", "member_nm"], GUEST_MEMBER),
            "dim_pizza_type": build_dimension(self.lines, ["pizza_type_id", "pizza_nm", "pizza_categ"]),
            "dim_date": build_date_dimension(self.lines),
            "dim_branch": build_dimension(self.lines, ["bran_id", "bran_nm"], UNKNOWN_BRANCH),
            "dim_pizza_topping": build_dimension(self.toppings, [TOPPING_KEY, "pizza_topping_nm"]),
            "bridge_pizza_type_topping": build_dimension(self.toppings, ["pizza_type_id", TOPPING_KEY]),
        }

    def fact_keys(self) -> DataFrame:
        """The key of every fact row: lines joined with the toppings of their type."""
        pairs = self.toppings.select("pizza_type_id", TOPPING_KEY)
        return self.lines.select("order_detail_id", "pizza_type_id").join(
            F.broadcast(pairs) if self.bridge_is_small else pairs, "pizza_type_id").select("order_detail_id", TOPPING_KEY)


def _hash_of_id() -> Column:
    return F.when(F.col(LINE_KEY).isNotNull(), F.xxhash64(F.col(LINE_KEY).cast("string")))


def _shared_hashes(star: LineStar) -> DataFrame:
    return star.lines.where(F.col(LINE_KEY).isNotNull()).groupBy(LINE_KEY).agg(F.count(F.lit(1)).alias("_c"))


def distinct_lines(star: LineStar) -> DataFrame:
    """One row: ``silver_lines``, the distinct order lines of the star."""
    if not star.hashed_ids:
        return star.lines.agg(F.count_distinct(LINE_KEY).alias("silver_lines"))
    per_hash = _shared_hashes(star)
    found = per_hash.agg(F.count_if(F.col("_c") == 1).alias("single"), F.count_if(F.col("_c") > 1).alias("shared")).first()
    counted = star.lines.sparkSession.createDataFrame([(found["single"],)], "silver_lines bigint")
    if not found["shared"]:
        return counted
    shared = sized_broadcast(materialize(per_hash.where("_c > 1").select(F.col(LINE_KEY).alias("_hash")), "shared-hashes"))
    own = star.tables["orderdetail"].join(shared, _hash_of_id() == F.col("_hash"), "left_semi")
    return counted.unionByName(star.with_ids(own).lines.agg(F.count_distinct(LINE_KEY).alias("silver_lines"))).agg(
        F.sum("silver_lines").alias("silver_lines"))


def cardinality(orderdetail: DataFrame, star: LineStar) -> DataFrame:
    return quality.cardinality_of(orderdetail, distinct_lines(star))


def reference_counts(star: LineStar) -> DataFrame:
    """One row: as ``quality.missing_references`` and ``types_without_bridge`` count it."""
    missing = lambda key, name: F.col(key).isNotNull() & F.col(name).isNull()
    of_lines = star.lines.agg(
        quality.count_rows(missing("member_id", "member_nm"), "n").alias("missing_member"),
        quality.count_rows(missing("bran_id", "bran_nm"), "n").alias("missing_branch"))
    of_types = star.toppings.agg(
        quality.count_rows(missing(TOPPING_KEY, "pizza_topping_nm"), "lines").alias("missing_topping_master"),
        F.count_distinct(F.when(F.col(TOPPING_KEY).isNull(), F.col("pizza_type_id"))).alias("types_without_topping"))
    return quality.side_by_side(of_lines, of_types)


def silver_report(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]], star: LineStar) -> DataFrame:
    """The rows of ``quality.silver_report``."""
    return quality.union_results([
        quality.duplicate_pk_checks(tables, keys),
        quality.null_fk_profile(tables["orderdetail"], tables["orders"], tables["pizza"]),
        quality.cardinality_results(cardinality(tables["orderdetail"], star)),
        quality.reference_results(reference_counts(star)),
    ])


def uniqueness_checks(star: LineStar) -> DataFrame:
    """The rows of ``quality.uniqueness_checks``."""
    dims = star.dimensions()
    lines = star.lines.groupBy("order_detail_id").agg(F.count(F.lit(1)).alias("_c"), F.sum("n").alias("_n")).agg(
        F.max("_c").alias("most"), F.sum("_n").alias("rows")).first()
    pairs = star.toppings.groupBy("pizza_type_id", TOPPING_KEY).agg(F.count(F.lit(1)).alias("_c")).agg(F.max("_c")).first()[0]
    if (lines["most"] or 1) > 1 or (pairs or 1) > 1:
        if star.hashed_ids:  # equal ids, or different ones of equal hashes
            return uniqueness_checks(star.with_ids())
        return quality.uniqueness_checks({**dims, "fact_order": star.fact_keys()})
    keys = {k: v for k, v in quality.GOLD_KEYS.items() if k != "fact_order"}
    rows = star.lines.sparkSession.createDataFrame([(int(lines["rows"] or 0),)], "rows bigint")
    subject = f"fact_order({','.join(quality.GOLD_KEYS['fact_order'])})"
    return quality.uniqueness_checks({k: dims[k] for k in keys}, keys).unionByName(quality.result_rows(
        rows, "key_uniqueness", subject, F.col("rows"), F.col("rows"), "fail"))


def fact_row_checks(star: LineStar, required: Sequence[str] = quality.FACT_REQUIRED) -> DataFrame:
    """The rows of ``quality.fact_row_checks``."""
    own = [c for c in required if c != TOPPING_KEY]
    of_lines = quality.fact_row_checks(star.fact_lines([*dict.fromkeys([*own, "unit_price", "quantity", "total_price"])]), own, "n")
    if TOPPING_KEY not in required:
        return of_lines
    empty = star.toppings.agg(quality.count_rows(F.col(TOPPING_KEY).isNull(), "lines").alias("c"))
    return of_lines.unionByName(quality.result_rows(
        empty, "not_null", f"fact_order.{TOPPING_KEY}", F.col("c"), F.lit(0), "fail"))


def referential_integrity_checks(star: LineStar, optional: Sequence[str] = ()) -> DataFrame:
    """The rows of ``quality.referential_integrity_checks``."""
    dims = star.dimensions()
    return quality.referential_integrity_checks(star.fact_lines([*LINE_REFERENCES]), dims, LINE_REFERENCES, optional, "n").unionByName(
        quality.referential_integrity_checks(star.toppings, dims, TOPPING_REFERENCES, optional, "lines"))


def row_parity_check(star: LineStar) -> DataFrame:
    """Fact rows (lines joined with toppings) against the rows that the weights add up to."""
    made = star.fact_keys().agg(F.count(F.lit(1)).alias("made"))
    said = star.lines.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("said"))
    return quality.result_rows(quality.side_by_side(made, said), "row_parity", "fact_order", F.col("made"), F.col("said"), "fail")


def gold_report(star: LineStar, required: Sequence[str] = quality.FACT_REQUIRED) -> DataFrame:
    """The rows of ``quality.gold_report``."""
    optional = [c for c in quality.FACT_REFERENCES if c not in required]
    return reduce(DataFrame.unionByName, [
        row_parity_check(star), uniqueness_checks(star), fact_row_checks(star, required),
        referential_integrity_checks(star, optional)])
