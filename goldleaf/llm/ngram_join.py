"""N-gram Jaccard join by a token-group matrix.

A text's tokens are its distinct word shingles. Texts with the same token set form a class. Classes are
put into groups of similar ones, a group's token union is stored by token (the token-group matrix), the
overlap of a class with a group is bounded by the tokens that it shares with the union, and only groups
whose bound reaches the needed overlap are opened: there the exact overlaps with all members are counted.

Exactness. Tokens have one global order. Two sets with 100 * inter >= t * union share at least
o = ceil(t * n / 100) tokens (n: the larger size), so their first n - o + k tokens share at least
min(k, o) of them, k being that of the smaller set. The matrix holds these first tokens only; the bound is never too small. The order goes
by a count of those that hold a token, so a passage that many documents share is rarely among the first
tokens: it decides how much work is done, not what is found.

Where the order comes from. Every token of every class travels once, packed into arrays, to the bucket of its
hash, where the components that hold it are counted. Tokens of one component come first and, as no link leads
through them, go no further; the others travel back to their class, which keeps its first ones. So a class whose
own tokens fill its first places asks nothing, however many texts there are. The few tokens known as common
beforehand come last, by a count taken over runs of texts.

Where the matrix is worked out. A first token travels, packed with its class into arrays, to
the bucket of its hash, where the groups that hold it and the classes that ask them are found; only sums per
(class, group) leave. Of more than ``COMMON_MAX`` tokens none of these is held by more than that part of all
tokens, so a bucket is bounded. The (at most so many) tokens known as common, which one group of copies may
hold a million times, go through joins and sums that are reduced map-side and split by adaptive execution.

Links that only confirm what is known already are saved. First, classes with the same least tokens in two
random orders are compared with a few of them. Links among them make components; tokens that only one
component has drop out of the matrix, so a family of thousands of near copies costs its size, not its square.
Components that are merely alike share a group of the matrix, so thousands of texts that are nearly similar
enough meet a group, not each other. Then one class per (component, group) asks, and in a last round every
remaining class asks every group that holds a member of another component: each link between different
components is looked for.

Tokens are 64-bit hashes of shingles and classes 128-bit hashes of token sets (an accidental equality of
two tokens has probability 2^-64).

Cases: null text counts as empty; a text without words has no tokens, is linked with nothing and is its
own component; with fewer words than a shingle the whole sequence is one token; repeated rows share their
class; a null doc_id takes part, and is a component's id only if it has no other; an empty table gives no
rows; further columns are ignored. Rows are known by their place in the stored files (``row_numbered``), so
further scans and retried tasks see the same numbers; a frame that is no plain scan is written first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import (
    broadcast_if_few, discard, importable_on_workers, release_memory, row_numbered, sliced, tidied, utf8, written)
from goldleaf.llm.components import components

SHINGLE_WORDS, MIN_PERCENT = 5, 80
SHARED, SHARED_PART = 3, 16  # k: of a set's first tokens, 3 or a sixteenth of its size must be shared
COUNT_TOKENS, COMMON_IN_COUNT = 2_000_000, 2  # tokens are counted over so many at a time; kept if in two texts of them
COMMON_MAX = 500_000  # common tokens that are put last, at most (16 bytes each); the order changes no result
LEADS = 4  # turns in which classes with the same leading tokens are compared first
LEAD_ROUNDS = ((0,), (1, 2, 3))  # later turns take one class for all of its component
CROWD = 8  # groups that share the least token of a random order are compared with a few of them, from so many on
ALIKE_PERCENT = 40  # components with so similar members are put into one group; it changes no result
LEADERS = 8  # classes of a group that the others are compared with in a turn
BUCKET_TOKENS = 250_000  # tokens that meet in one bucket of token hashes
PACKED_TOKENS = 1_000_000  # tokens that a task packs at a time
ASKED_AT_ONCE = 2_000_000  # (class, group) pairs of a bucket that are looked at together
GROUP_TOKENS = 250_000  # larger groups, and all that ask one group, are split into parts of about so many tokens

_MIX = [np.uint64(int(xxhash.xxh3_64_intdigest(b"place %d" % i)) | 1) for i in range(64)]
_SALT = np.uint64(0x9E3779B97F4A7C15)


def _scrambled(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads them evenly (finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _distinct(tokens: np.ndarray) -> np.ndarray:
    tokens = np.sort(tokens)
    return tokens[np.concatenate([[True], tokens[1:] != tokens[:-1]])]


class Shingler:
    """Sorted distinct token hashes of a text."""

    def __init__(self, words: int):
        self.words = words

    def tokens(self, data: bytes | None) -> np.ndarray:
        words = (data or b"").lower().split()  # bytes: A-Z only, and white space is x09-x0D and x20
        if not words:
            return np.empty(0, np.uint64)
        if len(words) < self.words:
            return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        n = len(h) - self.words + 1
        out = np.full(n, _SALT)
        for i in range(self.words):  # a sum with one odd factor a place, of hashes that are random already
            out += h[i:i + n] * _MIX[i % 64]
            if i % 64 == 63:  # the factors start again
                out = _scrambled(out)
        return _distinct(_scrambled(out))


def _class_of(tokens: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(tokens.tobytes())


def needed(n: int, percent: int) -> int:
    """Tokens that a set of ``n`` must share with any set it links with."""
    return -(-percent * n // 100)


def overlap(n: int) -> int:
    """k: so many first tokens must be shared with a set that is not smaller."""
    return max(SHARED, n // SHARED_PART)


def linked(shared: np.ndarray, a, b, percent: int):
    return 100 * shared >= percent * (a + b - shared)


def _common_tokens(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that many texts hold, sorted, and their counts, from all texts in runs of a bounded size; bounded itself."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, run, size = Shingler(words), [], 0

        def out() -> pa.RecordBatch:
            tokens, n = np.unique(np.concatenate(run), return_counts=True)
            often = n >= COMMON_IN_COUNT
            return pa.RecordBatch.from_arrays(
                [pa.array(tokens[often].view(np.int64)), pa.array(n[often].astype(np.int64))], ["token", "n"])

        for batch in sliced(batches):
            for data in utf8(batch.column(0)):
                run.append(shingler.tokens(data))
                size += len(run[-1])
                if size >= COUNT_TOKENS:
                    yield out()
                    run, size = [], 0
        if run:
            yield out()

    seen = docs.select("_text").mapInArrow(tidied("ngrams", counted), "token bigint, n bigint")
    counts = written(seen.groupBy("token").agg(F.sum("n").alias("n")), "op5-counts")
    # the least count that at most COMMON_MAX tokens reach; there are few different counts
    bar, total = 0, 0
    for row in counts.groupBy("n").agg(F.count(F.lit(1)).alias("tokens")).orderBy(F.desc("n")).toLocalIterator():
        total += row["tokens"]
        if total > COMMON_MAX:
            bar = row["n"] + 1
            break
    top = counts.where(F.col("n") >= bar).select("token", "n").toArrow()
    tokens, n = top.column("token").to_numpy().view(np.uint64), top.column("n").to_numpy()
    order = np.argsort(tokens)
    discard(counts)
    return tokens[order], n[order]


def _counts(tokens: np.ndarray, ordered: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The known counts of ``tokens``, 0 for those that are not common."""
    if not len(ordered):
        return np.zeros(len(tokens), np.int64)
    at = np.searchsorted(ordered, tokens)
    at[at == len(ordered)] = 0
    return np.where(ordered[at] == tokens, counts[at], 0)


def _leads(tokens: np.ndarray) -> np.ndarray:
    """One value a turn, of the least tokens in two of ``LEADS`` random orders; then the least token in each."""
    least = np.array([(tokens * _MIX[turn]).min() for turn in range(LEADS)], np.uint64)
    return np.concatenate([_scrambled(least + np.roll(least, -1) * _SALT), least]).view(np.int64)


def _heads(docs: DataFrame, shared: Broadcast, words: int, percent: int) -> DataFrame:
    """``uid, doc_id, n_shingles, cls, leads, rare, later, often`` of every text, written.

    ``rare`` is the number of its tokens that are not known as common (``shared``), ``later`` how many of these are
    not among its first tokens in the global order; ``often`` are the common ones that are, by count, then value.
    ``leads`` are its leading tokens of ``LEADS`` turns, by two random orders, then by one.
    """

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, common = Shingler(words), shared.value
        for batch in sliced(batches):
            sizes, classes, rare, later, often, leads = [], [], [], [], [], []
            for data in utf8(batch.column(2)):
                tokens = shingler.tokens(data)
                n = len(tokens)
                counts = _counts(tokens, *common)
                first, common_at = min(n, n - needed(n, percent) + overlap(n)), np.flatnonzero(counts)
                sizes.append(n)
                classes.append(_class_of(tokens) if n else None)
                rare.append(n - len(common_at))
                later.append(max(0, rare[-1] - first))
                by_count = common_at[np.argsort(counts[common_at], kind="stable")]
                often.append(tokens[by_count[:max(0, first - rare[-1])]].view(np.int64))
                leads.append(_leads(tokens).tolist() if n else [])
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in often])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.int64), *often])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()),
                 pa.array(leads, pa.list_(pa.int64())), pa.array(rare, pa.int64()), pa.array(later, pa.int64()), lists],
                ["uid", "doc_id", "n_shingles", "cls", "leads", "rare", "later", "often"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return written(docs.select("uid", "doc_id", "_text").mapInArrow(
        tidied("ngrams", heads), f"uid bigint, doc_id {kind}, n_shingles bigint, cls binary, leads array<bigint>, "
        "rare bigint, later bigint, often array<bigint>"), "op5-heads")


def _sets(docs: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``cid, tokens`` of the wanted classes, from the text of the row that stands for each."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in sliced(batches):
            rows = [shingler.tokens(data).tobytes() for data in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["cid", "tokens"])

    text = docs.select(F.col("uid").alias("cid"), "_text").join(broadcast_if_few(wanted), "cid")
    return text.select("cid", "_text").mapInArrow(tidied("ngrams", sets), "cid bigint, tokens binary")


class _Members:
    """The token sets of a group's members, and overlaps of any set with all of them at once."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets, self.sizes = sets, np.array([len(s) for s in sets], np.int64)
        tokens = np.concatenate([np.empty(0, np.uint64), *sets])
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(tokens, kind="stable")
        self.tokens, self.owner = tokens[order], owner[order]

    def overlaps(self, query: np.ndarray) -> np.ndarray:
        low, high = np.searchsorted(self.tokens, query), np.searchsorted(self.tokens, query, side="right")
        n = high - low
        at = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return np.bincount(self.owner[at], minlength=len(self.sets))

    def linked_with(self, query: np.ndarray, percent: int) -> np.ndarray:
        return np.flatnonzero(linked(self.overlaps(query), self.sizes, len(query), percent))


def _sorted_sets(rows: pd.Series) -> list[np.ndarray]:
    return [np.frombuffer(r, np.uint64) for r in rows]


def _link_members(group: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links (and alike pairs, not ``exact``) of a group's members with a few of them; the token-group matrix
    finds the other links."""
    group = group.sort_values("cid")
    ids, sets = group["cid"].to_numpy(), _sorted_sets(group["tokens"])
    rest, out = list(range(len(sets))), []
    for _ in range(LEADERS):  # near copies of a few leading members go with them; each costs its own size
        if len(rest) < 2:
            break
        lead, others, rest = rest[0], rest[1:], []
        for i in others:
            shared, sizes = len(np.intersect1d(sets[lead], sets[i], assume_unique=True)), (len(sets[lead]), len(sets[i]))
            exact = linked(shared, *sizes, percent)
            if exact or linked(shared, *sizes, ALIKE_PERCENT):
                out.append((ids[i], ids[lead], exact))
            if not exact:
                rest.append(i)
    return pd.DataFrame(out, columns=["a", "b", "exact"]).astype({"a": "int64", "b": "int64", "exact": "bool"})


def _links_with_group(members: pd.DataFrame, queries: pd.DataFrame, percent: int) -> list[tuple[int, int]]:
    """One link, if there is any, of each query with each component among the members."""
    ids, comps = members["cid"].to_numpy(), members["comp"].to_numpy()
    index, out = _Members(_sorted_sets(members["tokens"])), []
    for cid, comp, tokens in zip(queries["cid"], queries["comp"], _sorted_sets(queries["tokens"])):
        found = {comps[j]: ids[j] for j in index.linked_with(tokens, percent)[::-1] if comps[j] != comp}
        out += [(cid, other) for other in found.values()]
    return out


_LINK = "a bigint, b bigint"


def _frame(pairs: list[tuple[int, int]]) -> pd.DataFrame:
    return pd.DataFrame(pairs, columns=["a", "b"], dtype="int64")


def _opened(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Links found by opening groups. ``pairs``: cid, comp, tokens, part; ``members``: cid, comp, tokens, part.

    A part is a group with some of the classes that ask it: both sides of a task are bounded.
    """
    def verify(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _frame(_links_with_group(left, right, percent) if len(left) and len(right) else [])

    renewed = lambda df: df.select(*[F.col(c).alias(c) for c in ("cid", "comp", "tokens", "part")])
    return renewed(members).groupBy("part").cogroup(renewed(pairs).groupBy("part")).applyInPandas(verify, _LINK)


def _with_components(classes: DataFrame, links: DataFrame, name: str = "comp") -> DataFrame:
    comps = components(links)
    return classes.drop(name).join(comps.withColumnRenamed("node", "cid"), "cid", "left").withColumn(
        name, F.coalesce("root", "cid")).drop("root")


def _split(rows: DataFrame, *by: str, key: str = "cid", name: str = "grp") -> DataFrame:
    """``rows`` (with ``size``) and ``name``: one number per value of ``by`` (a single long itself), several when
    its sizes add up to much; rows with the same ``key`` stay together."""
    weight = rows.groupBy(*by).agg(F.sum("size").alias("_weight"), F.count(F.lit(1)).alias("_n"))
    parts = F.expr(f"_weight div {GROUP_TOKENS} + 1")
    whole = F.col(by[0]) if len(by) == 1 else F.xxhash64(*by)
    return rows.join(weight, list(by)).withColumn(name, F.when(parts == 1, whole).otherwise(
        F.xxhash64(*by, F.pmod(F.xxhash64(key), parts)))).drop("_weight")


def _lead_components(docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """``cid, comp, alike`` of the classes that share a turn's leading tokens with another: components of the
    links, and of the alike pairs, found among them.

    In later rounds one class stands for all of its component in a group, so a family of near copies costs
    its size once.
    """
    by_two = F.slice("leads", 1, LEADS)
    leading = classes.select("cid", "size", F.posexplode(by_two).alias("turn", "lead"))
    crowded = leading.groupBy("turn", "lead").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("turn", "lead")
    leading = written(leading.join(crowded, ["turn", "lead"], "left_semi"), "op5-leading")
    wanted = written(leading.select("cid").distinct(), "op5-wanted")
    sets = written(_sets(docs, wanted, words), "op5-sets")
    state = wanted.withColumn("comp", F.col("cid"))
    found = None
    for turns in LEAD_ROUNDS:
        standing = leading.where(F.col("turn").isin(*turns)).join(state, "cid").groupBy("turn", "lead", "comp").agg(
            F.min(F.struct("cid", "size")).alias("one")).select("turn", "lead", "one.cid", "one.size")
        asked = written(_split(standing, "turn", "lead").where("_n > 1").select("cid", "grp"), "op5-asked")
        links = sets.join(broadcast_if_few(asked), "cid").groupBy("grp").applyInPandas(
            lambda group: _link_members(group, percent), f"{_LINK}, exact boolean")
        found = written(links if found is None else found.unionByName(links), "op5-links")
        state = written(_with_components(wanted, found.where("exact")), "op5-comps")
    out = written(_with_components(state, found, "alike"), "op5-alike")
    discard(leading, sets)
    return _gathered(docs, classes, out, found, words, percent)


def _gathered(docs: DataFrame, classes: DataFrame, near: DataFrame, found: DataFrame, words: int, percent: int) -> DataFrame:
    """``near`` (cid, comp, alike) with the groups that are still apart though many of them share a least token.

    A near copy misses its family when own words lead both orders of every turn, so a share of each family is
    left over, and a token that all of it holds would meet every one of these groups. By the least token of one
    order fewer miss it. One class stands for its group, so a family costs what is left over.
    """
    by_one = F.slice("leads", LEADS + 1, LEADS)
    leading = classes.select("cid", "size", F.posexplode(by_one).alias("turn", "lead"))
    crowded = written(leading.groupBy("turn", "lead").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= CROWD).select(
        "turn", "lead"), "op5-crowded")
    standing = leading.join(broadcast_if_few(crowded), ["turn", "lead"], "left_semi").join(
        near.select("cid", "alike"), "cid", "left").withColumn("alike", F.coalesce("alike", "cid")).groupBy(
        "turn", "lead", "alike").agg(F.min(F.struct("cid", "size")).alias("one")).select("turn", "lead", "one.cid", "one.size")
    asked = written(_split(standing, "turn", "lead").where(F.col("_n") >= CROWD).select("cid", "grp"), "op5-asked")
    wanted = written(asked.select("cid").distinct(), "op5-wanted")
    more = _sets(docs, wanted, words).join(broadcast_if_few(asked), "cid").groupBy("grp").applyInPandas(
        lambda group: _link_members(group, percent), f"{_LINK}, exact boolean")
    links = written(found.unionByName(more), "op5-links")
    every = near.select("cid").unionByName(wanted).distinct()
    state = written(_with_components(every, links.where("exact")), "op5-comps")
    out = written(_with_components(state, links, "alike"), "op5-alike")
    discard(found, links)
    return out


def _at_least(size, percent: int):
    """Shared first tokens that a class of ``size`` has with any partner, a smaller one included."""
    partner = F.ceil(size * percent / 100)
    return F.least(F.greatest(F.lit(SHARED), F.floor(partner / SHARED_PART)), partner)


_PACKED = ("token", "cid", "comp", "grp", "size")
_ASKED = "cid bigint, size bigint, grp bigint, shared bigint"


def _packed_first(token: np.ndarray, cid: np.ndarray, comp: np.ndarray, grp: np.ndarray, size: np.ndarray,
                  buckets: int) -> pd.DataFrame:
    """For each bucket of token hashes a row of arrays."""
    bucket = (token.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((cid, bucket))
    ends = np.flatnonzero(np.diff(bucket[order], append=-1)) + 1
    out = {"bucket": bucket[order[ends - 1]]}
    # ids of a component and a group mostly equal the class, so their differences take no room
    for name, values in zip(_PACKED, (token, cid, comp - cid, grp - cid, size.astype(np.int32))):
        out[name] = [part.tobytes() for part in np.split(values[order], ends[:-1])] if len(ends) else []
    return pd.DataFrame(out)


def _packed_tokens(shared: Broadcast, words: int, buckets: int):
    """Packs the tokens of (cid, comp, _text) rows that are not known as common: for a bucket of token hashes one
    row of arrays per run."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, common, run, size = Shingler(words), shared.value, [], 0

        def out() -> pa.RecordBatch:
            tokens, ids, comps = zip(*run)
            lengths = [len(t) for t in tokens]
            token = np.concatenate(tokens)
            bucket = (token % np.uint64(buckets)).astype(np.int32 if buckets > 65_535 else np.uint16)
            order = np.argsort(bucket, kind="stable")
            cid, comp = (np.repeat(np.array(x, np.int64), lengths)[order] for x in (ids, comps))
            starts = np.flatnonzero(np.diff(bucket[order].astype(np.int64), prepend=-1))
            # steps from class to class, and from a class to its component, are mostly small and take little room
            columns = [[np.diff(c, prepend=0).tobytes() for c in np.split(cid, starts[1:])]]
            for values in (token[order], comp - cid):
                columns.append([part.tobytes() for part in np.split(values, starts[1:])])
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket[order][starts], pa.int64()), *[pa.array(c, pa.binary()) for c in columns]],
                ["bucket", "cid", "token", "comp"])

        for batch in sliced(batches):
            ids, comps = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for row, data in enumerate(utf8(batch.column(2))):
                tokens = shingler.tokens(data)
                tokens = tokens[_counts(tokens, *common) == 0]
                if len(tokens):
                    run.append((tokens, ids[row], comps[row]))
                    size += len(tokens)
                if size >= PACKED_TOKENS:
                    yield out()
                    run, size = [], 0
        if run:
            yield out()

    return pack


def _held_by_several(group: pd.DataFrame, homes: int) -> pd.DataFrame:
    """Of a bucket: the tokens that several components hold, with the number of these, for the homes of their classes."""
    cid = np.concatenate([np.cumsum(np.frombuffer(steps, np.int64)) for steps in group["cid"]])
    token, comp = (np.frombuffer(b"".join(group[c]), np.int64) for c in ("token", "comp"))
    comp = comp + cid
    order = np.argsort(token)
    starts = np.flatnonzero(np.diff(token[order], prepend=token[order[0]] - 1))
    several = np.minimum.reduceat(comp[order], starts) < np.maximum.reduceat(comp[order], starts)
    order = order[np.repeat(several, np.diff(starts, append=len(order)))]
    if not len(order):
        return pd.DataFrame({"home": [], "cid": [], "token": [], "held": []})
    order = order[np.lexsort((comp[order], token[order]))]
    token, cid, comp = token[order], cid[order], comp[order]
    begins = np.diff(token, prepend=token[0] - 1) != 0
    starts = np.flatnonzero(begins)
    held = np.add.reduceat((begins | (np.diff(comp, prepend=comp[0]) != 0)).astype(np.int64), starts)
    held = np.repeat(held, np.diff(starts, append=len(token)))
    home = cid % homes
    order = np.argsort(home, kind="stable")
    ends = np.flatnonzero(np.diff(home[order], append=-1)) + 1
    return pd.DataFrame({"home": home[order[ends - 1]]} | {
        name: [part.tobytes() for part in np.split(values[order], ends[:-1])]
        for name, values in (("cid", cid), ("token", token), ("held", held))})


def _first_tokens(classes: pd.DataFrame, tokens: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """Of a home: what classes (cid, comp, grp, size, later) have of several components' tokens among their first ones.

    Tokens of one component come before all of these, so what is not among the first tokens is at their end.
    """
    cid, token, held = (np.frombuffer(b"".join(tokens[c]), np.int64) for c in ("cid", "token", "held"))
    order = np.lexsort((token, held, cid))
    token, cid = token[order], cid[order]
    starts = np.flatnonzero(np.diff(cid, prepend=-1))
    n = np.diff(starts, append=len(cid))
    classes = classes.set_index("cid").loc[cid[starts]]
    first = np.arange(len(cid)) - np.repeat(starts, n) < np.repeat(n - classes["later"].to_numpy(), n)
    comp, grp, size = (np.repeat(classes[c].to_numpy(), n)[first] for c in ("comp", "grp", "size"))
    return _packed_first(token[first], cid[first], comp, grp, size, buckets)


def _asking(group: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Of a bucket: how many tokens each class shares with each group that another component is in."""
    token, cid, comp, grp = (np.frombuffer(b"".join(group[c]), np.int64) for c in _PACKED[:4])
    size = np.frombuffer(b"".join(group["size"]), np.int32).astype(np.int64)
    comp, grp = comp + cid, grp + cid
    order = np.argsort(token, kind="stable")
    # only tokens that several components hold
    starts = np.flatnonzero(np.diff(token[order], prepend=token[order[0]] - 1)) if len(order) else np.empty(0, np.int64)
    several = np.minimum.reduceat(comp[order], starts) < np.maximum.reduceat(comp[order], starts)
    order = order[np.repeat(several, np.diff(starts, append=len(order)))]
    order = order[np.lexsort((grp[order], token[order]))]
    token, cid, comp, grp, size = (x[order] for x in (token, cid, comp, grp, size))
    found = pd.DataFrame({"cid": [], "size": [], "grp": [], "shared": []}, dtype="int64")
    if not len(token):
        return found
    # the matrix: a row per token and group
    cell = np.flatnonzero(np.diff(token, prepend=token[0] - 1) | np.diff(grp, prepend=grp[0]))
    low, high = np.minimum.reduceat(size, cell), np.maximum.reduceat(size, cell)
    least, most = np.minimum.reduceat(comp, cell), np.maximum.reduceat(comp, cell)
    cell_token = token[cell]
    first, last = np.searchsorted(cell_token, token), np.searchsorted(cell_token, token, side="right")
    n, parts = last - first, []
    for run in np.split(np.arange(len(token)), np.flatnonzero(np.diff(np.cumsum(n) // ASKED_AT_ONCE)) + 1):
        asks = np.repeat(run, n[run])
        at = np.repeat(first[run] - np.concatenate([[0], np.cumsum(n[run])[:-1]]), n[run]) + np.arange(len(asks))
        fits = ((least[at] != comp[asks]) | (most[at] != comp[asks])) & (
            100 * high[at] >= percent * size[asks]) & (100 * size[asks] >= percent * low[at])
        asks, at = asks[fits], at[fits]
        asks = asks[by_group := np.lexsort((grp[cell[at]], cid[asks]))]
        asked = grp[cell[at[by_group]]]
        new = np.flatnonzero((np.diff(cid[asks], prepend=0) != 0) | (np.diff(asked, prepend=0) != 0) | (np.arange(len(asks)) == 0))
        parts.append(pd.DataFrame({"cid": cid[asks[new]], "size": size[asks[new]], "grp": asked[new],
                                   "shared": np.diff(new, append=len(asks))}))
    return pd.concat([found, *parts]).astype("int64")


def _asking_common(entries: DataFrame, percent: int) -> DataFrame:
    """The same for the tokens known as common: ``token, cid, comp, grp, size`` as rows."""
    held = written(entries.groupBy("token").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a < b")
                   .select("token"), "op5-held")  # at most COMMON_MAX rows
    shared = written(entries.join(broadcast_if_few(held), "token", "left_semi"), "op5-entries")
    matrix = shared.groupBy("token", "grp").agg(
        F.min("size").alias("low"), F.max("size").alias("high"), F.min("comp").alias("least"), F.max("comp").alias("most"))
    asked = shared.select("token", "cid", "size", F.col("comp").alias("own")).join(matrix, "token").where(
        f"(least <> own OR most <> own) AND 100 * high >= {percent} * size AND 100 * size >= {percent} * low")
    out = written(asked.groupBy("cid", "size", "grp").agg(F.count(F.lit(1)).alias("shared")), "op5-common")
    discard(held, shared)
    return out


def _candidates(docs: DataFrame, heads: DataFrame, shared: Broadcast, grouped: DataFrame, words: int,
                percent: int) -> DataFrame:
    """``cid, size, grp, shared``: classes and the groups that hold enough of their first tokens."""
    of_class = broadcast_if_few(written(grouped.withColumnRenamed("cid", "uid"), "op5-of-class"))
    known = heads.select("uid", "rare", "later", "often").join(of_class, "uid").withColumnRenamed("uid", "cid")
    total = known.agg(F.sum("rare")).first()[0] or 0
    buckets = max(1, -(-total // BUCKET_TOKENS))
    homes = buckets // 4 | 1  # of a million tokens at most, if every token were held by several components

    def several(group: pd.DataFrame) -> pd.DataFrame:
        out = _held_by_several(group, homes)
        release_memory()  # the arrays of a bucket
        return out

    def firsts(classes: pd.DataFrame, tokens: pd.DataFrame) -> pd.DataFrame:
        out = _first_tokens(classes, tokens, buckets)
        release_memory()
        return out

    def asks(group: pd.DataFrame) -> pd.DataFrame:
        out = _asking(group, percent)
        release_memory()
        return out

    held = docs.select("uid", "_text").join(of_class, "uid").select("uid", "comp", "_text").mapInArrow(
        tidied("ngrams", _packed_tokens(shared, words, buckets)), "bucket bigint, cid binary, token binary, comp binary"
    ).groupBy("bucket").applyInPandas(several, "home bigint, cid binary, token binary, held binary")
    at_home = known.select("cid", "comp", "grp", "size", "later", F.pmod("cid", F.lit(homes)).alias("home"))
    packed = at_home.groupBy("home").cogroup(held.groupBy("home")).applyInPandas(
        firsts, "bucket bigint, token binary, cid binary, comp binary, grp binary, size binary")
    asking = packed.groupBy("bucket").applyInPandas(asks, _ASKED)
    common = _asking_common(known.select("cid", "comp", "grp", "size", F.explode("often").alias("token")), percent)
    out = written(asking.unionByName(common).groupBy("cid", "size", "grp").agg(F.sum("shared").alias("shared")).where(
        F.col("shared") >= _at_least(F.col("size"), percent)), "op5-pairs")
    discard(common)
    return out


def link_classes(docs: DataFrame, heads: DataFrame, shared: Broadcast, words: int, percent: int) -> DataFrame:
    """``cid, comp`` of every class. A class is known by the first row (uid) that has it."""
    cids = written(heads.where("n_shingles > 0").groupBy("cls").agg(F.min("uid").alias("uid")).select("uid"), "op5-cids")
    classes = written(heads.select("uid", "leads", F.col("n_shingles").alias("size")).join(
        broadcast_if_few(cids), "uid", "left_semi").withColumnRenamed("uid", "cid"), "op5-classes")
    near = _lead_components(docs, classes, words, percent)
    # a group holds alike components; a large component has groups of its own
    whole = classes.select("cid", "size").join(near, "cid", "left").withColumn(
        "comp", F.coalesce("comp", "cid")).withColumn("alike", F.coalesce("alike", "cid"))
    weight = whole.groupBy("comp").agg((F.sum("size") > GROUP_TOKENS).alias("large"))
    whole = written(whole.join(weight, "comp"), "op5-whole")
    grouped = written(_split(whole.where("large"), "comp").unionByName(
        _split(whole.where("NOT large"), "alike", key="comp")).select("cid", "size", "comp", "grp"), "op5-grouped")
    discard(classes, whole)
    pairs = _candidates(docs, heads, shared, grouped, words, percent)
    opened = pairs.select("grp").distinct()
    members = written(grouped.join(opened, "grp", "left_semi").select("cid", "grp"), "op5-members")
    wanted = written(members.select("cid").unionByName(pairs.select("cid")).distinct(), "op5-wanted")
    sets = written(_sets(docs, wanted, words), "op5-sets")

    start = grouped.select(F.col("cid").alias("a"), F.col("comp").alias("b")).where("a <> b")
    first_asked = None
    found, comps = written(start, "op5-links"), written(grouped.select("cid", "comp"), "op5-comps")
    for last in (False, True):
        kinds = members.join(comps, "cid").groupBy("grp").agg(F.min("comp").alias("least"), F.max("comp").alias("most"))
        open_pairs = pairs.join(comps, "cid").join(kinds, "grp").where("least <> comp OR most <> comp")
        if not last:  # of each component one class, the one that shares most, asks a group
            open_pairs = open_pairs.groupBy("comp", "grp").agg(
                F.max(F.struct("shared", "cid", "size")).alias("best")).select("comp", "grp", "best.cid", "best.size")
        else:  # the answers to the first are known
            open_pairs = open_pairs.join(first_asked.select("cid", "grp"), ["cid", "grp"], "left_anti")
        open_pairs = written(open_pairs.select("cid", "comp", "size", "grp"), "op5-open")
        open_pairs = first_asked = written(_split(open_pairs, "grp", name="part").select("cid", "comp", "grp", "part"), "op5-asked")
        parts = open_pairs.select("grp", "part").distinct()  # a group answers every part of those that ask it
        answers = written(members.join(parts, "grp").join(comps, "cid").select("cid", "comp", "part"), "op5-answers")
        more = _opened(sets.join(broadcast_if_few(open_pairs), "cid"), sets.join(broadcast_if_few(answers), "cid"), percent)
        found = written(found.unionByName(more), "op5-links")
        comps = written(_with_components(grouped.select("cid"), found), "op5-comps")
    discard(sets, pairs, members, found)
    return comps


def similar_documents(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = MIN_PERCENT, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, uid, component`` of every row.

    Rows link when 100 * intersection >= percent * union of their sets of ``words``-word shingles;
    ``component_id`` is the smallest doc_id that links reach, the row's own included. ``component``, the uid
    of one of its rows, tells components apart that have no doc_id or share one.
    """
    importable_on_workers(docs.sparkSession)
    docs = row_numbered(docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                                    F.col(f"`{text_col}`").cast("string").alias("_text")), "uid")
    shared = docs.sparkSession.sparkContext.broadcast(_common_tokens(docs, words))
    heads = _heads(docs, shared, words, percent)
    of_class = link_classes(docs, heads, shared, words, percent)
    shared.destroy()
    rows = written(heads.select("uid", "doc_id", "n_shingles", "cls"), "op5-rows")
    discard(heads)
    classes = rows.where("n_shingles > 0").groupBy("cls").agg(F.min("uid").alias("cid"), F.min("doc_id").alias("least"))
    named = written(classes.join(of_class, "cid").select("cls", "comp", "least"), "op5-named")
    least = named.groupBy("comp").agg(F.min("least").alias("component_id"))
    known = written(named.join(least, "comp").select("cls", "component_id", F.col("comp").alias("component")), "op5-known")
    some = rows.where("n_shingles > 0").select("doc_id", "n_shingles", "cls", "uid").join(known, "cls").select(
        "doc_id", "n_shingles", "component_id", "uid", "component")
    none = rows.where("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "uid", F.col("uid").alias("component"))
    return some.unionByName(none)
