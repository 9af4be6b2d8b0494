"""Mixing sources to target weights by iterative proportional fitting, in DataFrame operations only.

Documents fall into cells by source, language and topic. A cell's token mass is raked: its weight is scaled
so that the sources' totals meet their targets, then the languages', then the topics', again and again
until nothing moves. A round is three sums of the weights within a value of a dimension, in one task while the
cells are few, else by grouped sums and joins; several rounds make one job. If the targets contradict each other
(or cells that could meet them are empty), the rest that stays is returned as ``drift`` and warned of. A document is then drawn with probability min(1, scale * weight / mass) of its cell;
the scale is calibrated so that the expected tokens meet the budget although some cells are taken whole.
The draw compares the probability with a hash of the row, so it is the same in every run.

Targets are tables (value, share) per dimension, or by default mass to the power ``flatten``: large sources
keep a larger part than small ones, though less than their own. Documents are reduced to cells map-side, so
a source that holds a third of all rows costs one row per cell and task; all iterations work on cells.

Cases: a null in a dimension is a value of its own; a target value that does not occur is passed over and
the shares are scaled to what does; a value without a target gets none (probability 0); null and empty
texts weigh one token, others their words or a token per four octets, whichever is more; repeated rows share their fate; an empty table gives no rows; further columns are
kept by ``mix`` and may have any names.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldleaf.llm.common import broadcast_if_few, discard, free_name, written

FLATTEN, KEEP_SHARE = 0.7, 0.6
OCTETS_A_TOKEN = 4  # for texts without spaces, and words that are many tokens each
ROUNDS, TOLERANCE = 60, 1e-4  # a round changes no weight by more than this factor's logarithm at the end
ROUNDS_A_JOB = 5
FEW_CELLS = 10_000  # so many are raked in one short task
DIMENSIONS = ["source", "lang", "topic"]

# Signs of a topic in a text, first match wins.
TOPIC_PATTERNS = [
    ("legal", r"(?i)licen[cs]ed? |copyright"),
    ("contact", r"[A-Za-z0-9._-]+@[A-Za-z0-9-]+\.[a-z]"),
    ("table", r" \| .* \| "),
    ("shouting", r"!!"),
]


def topic_of(text: Column) -> Column:
    """Topic by the first pattern that the text matches; prose otherwise."""
    rest = F.lit("prose")
    for name, pattern in reversed(TOPIC_PATTERNS):
        rest = F.when(text.rlike(pattern), F.lit(name)).otherwise(rest)
    return F.when(text.isNull() | (text == ""), F.lit("empty")).otherwise(rest)


def token_weight(text: Column) -> Column:
    """Estimated tokens of a text, at least one: its words, or more if it is long for so few words."""
    by_length = F.ceil(F.octet_length(text) / OCTETS_A_TOKEN)
    return F.greatest(F.lit(1), F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)), F.coalesce(by_length, F.lit(0))).cast("double")


def _with_goals(cells: DataFrame, targets: Mapping[str, DataFrame]) -> DataFrame:
    """``cells`` with ``goal_<dimension>``: the share that the cell's value should have, of the values that occur."""
    for dim, table in targets.items():
        present = cells.select(F.col(dim).alias("_value")).distinct()
        known = written(present.join(table, present["_value"].eqNullSafe(table[dim])).select(
            "_value", table["share"].cast("double").alias("_share")), "op2-target")
        whole = known.agg(F.sum("_share")).first()[0] or 1.0
        cells = cells.join(known, cells[dim].eqNullSafe(known["_value"]), "left").withColumn(
            f"goal_{dim}", F.coalesce(F.col("_share"), F.lit(0.0)) / whole).drop("_value", "_share")
    return cells


def _scaled(cells: DataFrame, dim: str, few: bool) -> DataFrame:
    """One raking step: weights scaled to the goals of one dimension; ``drift`` keeps the largest change."""
    if few:
        summed = cells.withColumn("_now", F.sum("weight").over(Window.partitionBy(dim)))
    else:
        now = cells.groupBy(F.col(dim).alias("_value")).agg(F.sum("weight").alias("_now"))
        summed = cells.join(now, cells[dim].eqNullSafe(now["_value"])).drop("_value")
    rate = F.when(F.col("_now") > 0, F.col(f"goal_{dim}") / F.col("_now")).otherwise(F.lit(0.0))
    stepped = summed.withColumn("_rate", rate)
    step = F.when(F.col("_rate") > 0, F.abs(F.log("_rate"))).otherwise(F.lit(0.0))
    return stepped.withColumn("weight", F.col("weight") * F.col("_rate")).withColumn(
        "drift", F.greatest("drift", step)).drop("_now", "_rate")


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` (dimensions and ``mass``) with ``weight``: shares of the total that meet the targets, and
    ``drift``: the logarithm of the largest factor of its weight in the last round, near 0 if they are met.

    A job is ``ROUNDS_A_JOB`` rounds over few cells, one over many, and is written to the shared folder.
    """
    total = cells.agg(F.sum("mass")).first()[0] or 1.0
    few = cells.count() <= FEW_CELLS
    whole = (lambda df: df.coalesce(1)) if few else (lambda df: df)
    now = written(whole(_with_goals(cells, targets)).withColumn("weight", F.col("mass") / total), "op2-round")
    done, drift = 0, None
    while done < rounds and (drift is None or drift >= tolerance):
        step = whole(now).drop("drift")
        for _ in range(min(ROUNDS_A_JOB if few else 1, rounds - done)):
            step = step.withColumn("drift", F.lit(0.0))
            for dim in targets:
                step = _scaled(step, dim, few)
            done += 1
        before, now = now, written(step, "op2-round")
        discard(before)
        drift = now.agg(F.max("drift")).first()[0] or 0.0
    if drift is not None and drift >= tolerance:
        warnings.warn(f"raking has not met its targets after {done} rounds: weights still change by a factor of up to "
                      f"exp({drift:.3g}) in a round", stacklevel=2)
    return now.drop(*[f"goal_{dim}" for dim in targets])


def probabilities(cells: DataFrame, keep_share: float = KEEP_SHARE) -> DataFrame:
    """``cells`` with ``probability``: min(1, scale * weight / mass), expected tokens = keep_share of all.

    Cells that would be drawn more than whole are taken whole and the rest scaled up, until none is left
    over; every pass takes at least one more cell whole or is the last.
    """
    ratio = F.col("weight") / F.col("mass")
    budget = keep_share * (cells.agg(F.sum("mass")).first()[0] or 0.0)
    bar = float("inf")  # cells with a ratio from here on are taken whole
    while True:
        whole, part = cells.agg(F.sum(F.when(ratio >= bar, F.col("mass"))), F.sum(F.when(ratio < bar, F.col("weight")))).first()
        scale = max(0.0, budget - (whole or 0.0)) / part if part else 0.0
        next_bar = 1 / scale if scale > 0 else float("inf")
        if next_bar >= bar or not part:
            break
        bar = next_bar
    chance = F.when(ratio >= bar, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.lit(scale) * ratio))
    return cells.withColumn("probability", chance)


def flattened(cells: DataFrame, dim: str, power: float = FLATTEN) -> DataFrame:
    """Default targets of a dimension: mass to a power."""
    return cells.groupBy(dim).agg(F.pow(F.sum("mass"), power).alias("share"))


def _described(docs: DataFrame, id_col: str, text_col: str, source_col: str, lang_col: str) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the operator's columns, under names that ``docs`` does not use; all from one pass over the texts."""
    names = {c: free_name(docs, f"_mix_{c}") for c in (*DIMENSIONS, "n_tokens", "draw", "probability", "kept")}
    text = F.col(f"`{text_col}`").cast("string")
    # 53 bits of a hash of the row as a number from 0 to 1
    draw = F.shiftrightunsigned(F.xxhash64(F.col(f"`{id_col}`"), text, F.lit(17)), 11) / F.lit(float(1 << 53))
    return docs.select(
        "*", F.col(f"`{source_col}`").cast("string").alias(names["source"]),
        F.col(f"`{lang_col}`").cast("string").alias(names["lang"]), topic_of(text).alias(names["topic"]),
        token_weight(text).alias(names["n_tokens"]), draw.alias(names["draw"])), names


def _drawn(described: DataFrame, names: Mapping[str, str], targets: Mapping[str, DataFrame] | None, keep_share: float,
           flatten: float) -> DataFrame:
    """``described`` with the probability of its cell and whether the row is drawn."""
    cells = written(described.groupBy(*[F.col(names[d]).alias(d) for d in DIMENSIONS]).agg(
        F.sum(names["n_tokens"]).alias("mass")), "op2-cells")
    goals = {d: (targets or {}).get(d) or flattened(cells, d, flatten) for d in DIMENSIONS}
    chances = written(probabilities(rake(cells, goals), keep_share).select(
        *[F.col(d).alias(f"_cell_{d}") for d in DIMENSIONS], F.col("probability").alias(names["probability"])), "op2-chances")
    found = described.join(broadcast_if_few(chances), reduce(
        lambda a, b: a & b, [F.col(names[d]).eqNullSafe(F.col(f"_cell_{d}")) for d in DIMENSIONS]), "left")
    return found.drop(*[f"_cell_{d}" for d in DIMENSIONS]).withColumn(
        names["kept"], F.col(names["draw"]) < F.coalesce(F.col(names["probability"]), F.lit(0.0)))


def sampling_plan(docs: DataFrame, targets: Mapping[str, DataFrame] | None = None, keep_share: float = KEEP_SHARE,
                  flatten: float = FLATTEN) -> DataFrame:
    """``doc_id, source, lang, topic, n_tokens, probability, kept`` of every document.

    The texts are read once; a few bytes a row are written and used from then on.
    """
    described, names = _described(docs, "doc_id", "text", "source", "lang")
    rows = written(described.select("doc_id", *[names[c] for c in (*DIMENSIONS, "n_tokens", "draw")]), "op2-rows")
    found = _drawn(rows, names, targets, keep_share, flatten)
    return found.select("doc_id", *[F.col(names[c]).alias(c) for c in (*DIMENSIONS, "n_tokens", "probability", "kept")])


def mix(docs: DataFrame, targets: Mapping[str, DataFrame] | None = None, keep_share: float = KEEP_SHARE,
        flatten: float = FLATTEN) -> DataFrame:
    """The drawn rows of ``docs``, with the columns of ``docs``. The texts are read twice, and not moved."""
    described, names = _described(docs, "doc_id", "text", "source", "lang")
    found = _drawn(described, names, targets, keep_share, flatten)
    return found.where(F.col(names["kept"])).select(*docs.columns)
