"""Exact duplicates by deterministic block naming (Karp-Miller-Rosenberg), in DataFrame operations only.

Each normalised text is cut into blocks of a fixed number of characters. The distinct blocks are sorted
and numbered: equal blocks get one integer name, different blocks different ones. Then adjacent pairs of
names are named the same way, level by level, until one name per text is left. Two texts are equal exactly
when they end on the same level with the same name, so the identity has no collisions.

What is shuffled: the text of the blocks once, map-side distinct, to sort and number them. A text's blocks
find their names by a 64-bit fingerprint that was checked to stand for one block only; the blocks whose
fingerprint stands for several are joined on the text itself. Higher levels move integers only. Blocks,
pairs and identities that a large part of the rows share are reduced map-side before they move, and joins
against their names are plain joins of two exchanges, which adaptive execution splits.

Cases: null text counts as empty; empty texts are equal to each other; a null doc_id is smaller than any
other; of rows that repeat a doc_id with equal texts one stays; an empty table gives no rows; further
columns are ignored. Rows are known by their place in the stored files (``row_numbered``), so every scan sees
the same numbers; a frame that is no plain scan is written first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import discard, row_numbered, written

BLOCK_CHARS = 4096
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, nothing else. ``lower`` does just that on pure ASCII and is the faster way there."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def _blocks(text: Column, size: int) -> Column:
    cut = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % size), F.lit(0))
    return F.when(text == "", F.array(F.lit(""))).otherwise(cut)


def fingerprint(block: Column) -> Column:
    return F.xxhash64(block)


def _numbered(distinct: DataFrame, *keys: str) -> DataFrame:
    """The distinct rows sorted (within the partitions that the distinct has made) and numbered."""
    return distinct.sortWithinPartitions(*keys).withColumn("name", F.monotonically_increasing_id())


def _first_names(rows: DataFrame, size: int, made: list[DataFrame]) -> DataFrame:
    """(uid, pos, name): the names of each text's blocks in order."""
    blocks = rows.select(F.explode(_blocks(F.col("_norm"), size)).alias("block")).distinct()
    named = written(_numbered(blocks, "block").withColumn("print", fingerprint(F.col("block"))), "op9-blocks")
    per_print = named.groupBy("print").agg(F.min("name").alias("name"), F.count(F.lit(1)).alias("n"))
    by_print = written(per_print, "op9-prints")
    parts = rows.select("uid", F.posexplode(_blocks(F.col("_norm"), size)).alias("pos", "block"))
    made += [named, by_print]
    several = written(by_print.where("n > 1").select(F.col("print").alias("_shared")), "op9-shared")
    made.append(several)
    found = parts.select("uid", "pos", fingerprint(F.col("block")).alias("print")).join(
        by_print.select("print", F.col("name").alias("_name"), "n"), "print")
    plain = found.where("n = 1").select("uid", "pos", F.col("_name").alias("name"))
    shared = (parts.withColumn("_shared", fingerprint(F.col("block"))).join(several, "_shared", "left_semi")
              .join(named.join(several, F.col("print") == F.col("_shared"), "left_semi").select("block", "name"), "block")
              .select("uid", "pos", "name"))
    return plain.unionByName(shared)


def _next_names(parts: DataFrame, made: list[DataFrame]) -> DataFrame:
    """One level up: adjacent names become pairs, the distinct pairs are sorted and numbered.

    ``a`` is the left name; a last name without a partner pairs with -1.
    """
    pairs = parts.groupBy("uid", F.expr("pos div 2").cast("int").alias("pos")).agg(
        F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
        F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"))
    pairs = written(pairs, "op9-pairs")
    named = written(_numbered(pairs.select("a", "b").distinct(), "a", "b"), "op9-names")
    made += [pairs, named]
    return pairs.join(named, ["a", "b"]).select("uid", "pos", "name")


def name_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   block_chars: int = BLOCK_CHARS, made: list[DataFrame] | None = None) -> DataFrame:
    """``uid, doc_id, text_sha256, level, name``: (level, name) is the identity of the row's text.

    ``made`` is given the written tables that the result reads.
    """
    made = [] if made is None else made
    text = ascii_lower(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    rows = row_numbered(docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("_norm")), "uid")
    heads = written(rows.select(
        "uid", "doc_id", F.sha2(F.col("_norm"), 256).alias("text_sha256"),
        F.greatest(F.lit(1), F.ceil(F.char_length("_norm") / block_chars)).cast("int").alias("n")), "op9-heads")
    parts = written(_first_names(rows, block_chars, made), "op9-level")
    made += [heads, parts]
    identities, level, most = [], 0, heads.agg(F.max("n")).first()[0] or 1
    width = heads.select("uid", "n")
    while True:
        # texts of 2^(level-1) < n <= 2^level blocks are down to one name here
        done = width.where((F.col("n") <= 2 ** level) & (F.col("n") > (2 ** (level - 1) if level else 0)))
        identities.append(parts.join(done.select("uid"), "uid", "left_semi").select(
            "uid", F.lit(level).alias("level"), "name"))
        if 2 ** level >= most:
            break
        parts = written(_next_names(
            parts.join(width.where(F.col("n") > 2 ** level).select("uid"), "uid", "left_semi"), made), "op9-level")
        made.append(parts)
        level += 1
    named = identities[0]
    for more in identities[1:]:
        named = named.unionByName(more)
    return heads.drop("n").join(named, "uid")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256, uid``.

    Of equal texts the row with the largest doc_id stays. ``uid`` numbers the input rows.
    """
    made: list[DataFrame] = []
    named = written(name_documents(docs, id_col, text_col, block_chars, made), "op9-identities")
    discard(*made)
    rank = F.struct(F.col("doc_id"), -F.col("uid"))
    groups = written(named.groupBy("level", "name").agg(
        F.max(rank).alias("_best"), F.count(F.lit(1)).alias("group_size")), "op9-groups")
    return named.join(groups, ["level", "name"]).select(
        "doc_id", F.col("_best.doc_id").alias("keep_id"), "group_size",
        (F.col("_best") == rank).alias("kept"), "text_sha256", "uid")
