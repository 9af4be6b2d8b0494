"""Alignment of two tokenizers over the same texts, by ``merge_asof`` per batch, keyed by document.

Side A is a byte-level BPE (``tokenizers``), side B a sentencepiece model. Both read space + text (B adds the
space itself). Every token covers a run of bytes, so the tokens of a side tile the document:

1. each A token's start finds, by ``pandas.merge_asof`` within its document, the B token that covers it, and
   each B token's start the covering A token. Two tokens overlap exactly when one of them covers the other's
   start, so the union of both directions, with equal starts counted once, is all overlaps (the links);
2. byte offsets where tokens of both sides end cut the document into groups;
3. a pair of ids counts in how many documents it is linked, over the whole corpus. A batch gives each
   document's distinct pairs with their occurrences, so the corpus count is one grouped sum of (pair), reduced
   map-side, and the documents get their sums by one join with the table of pairs. That table is broadcast if
   it is small (it is bounded by the vocabularies, and its size is checked), else shuffled.

Tokenizing is remembered by chunk (a space and the word behind it): neither side has a token that goes across
a single space, so a chunk's tokens do not depend on its neighbours. Texts in which white space meets white
space are tokenized whole. Batches are cut by bytes, so memory is bounded by a few MB of text or one text.

Cases: a text that is null, empty, not valid UTF-8, or whose joined token bytes differ from space + text on
either side has no tokens: zeros and an empty ``groups_sha256``; strings of special tokens are plain text;
a null doc_id is a document like any other, rows that repeat a doc_id are documents of their own; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.bpe_words import PreTokenIds, byte_symbols, chunks
from goldleaf.llm.common import importable_on_workers, row_numbered, utf8, written

TOKENIZER_A, TOKENIZER_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
BATCH_BYTES = 2 << 20  # of text in one merge
CHUNKS_KEPT, LONGEST_KEPT = 400_000, 64  # remembered chunks, and their characters, per Python worker
PAIRS_BROADCAST = 2_000_000  # rows of (pair, count, best) that may be broadcast: 50 MB

_SIDES: dict[tuple[str, str], "_Sides"] = {}  # per Python worker, by files


class _Sides:
    """Ids of both tokenizers for chunks, and what the ids stand for."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        symbol_bytes = {s: i for i, s in enumerate(byte_symbols())}
        self.ids_a = PreTokenIds(self.a)
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(symbol_bytes[c] for c in token) if all(c in symbol_bytes for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.length = [np.array([len(x) for x in side], np.int64) for side in (self.bytes_a, self.bytes_b)]
        # an id as text with what may follow it: more of its side, the other side, the next group, the end
        self.written = [[b"%d%s" % (i, after) for i in range(len(side)) for after in (b",", b"|", b";", b"")]
                        for side in (self.bytes_a, self.bytes_b)]
        self.reset()

    def reset(self) -> None:
        self.number: dict[str, int] = {}
        self.same = np.empty(0, bool)
        self.ids = [np.empty(0, np.int64), np.empty(0, np.int64)]
        self.first = [np.zeros(1, np.int64), np.zeros(1, np.int64)]  # of a chunk's ids, and where the last ones end

    def learn(self, missing: list[str]) -> None:
        if not missing:
            return
        both = list(map(self.ids_a, missing)), self.b.encode([c[1:] for c in missing], num_threads=1)
        self.number.update(zip(missing, range(len(self.number), len(self.number) + len(missing))))
        ends = []
        for side, of_id in enumerate((self.bytes_a, self.bytes_b)):
            counts = np.fromiter(map(len, both[side]), np.int64, len(missing))
            flat = np.fromiter(chain.from_iterable(both[side]), np.int64, int(counts.sum()))
            self.ids[side] = np.concatenate([self.ids[side], flat])
            self.first[side] = np.concatenate([self.first[side], self.first[side][-1] + np.cumsum(counts)])
            # the joined bytes of all chunks, cut where each one's tokens end
            joined, at = b"".join(map(of_id.__getitem__, flat.tolist())), [0]
            at += np.concatenate([[0], np.cumsum(self.length[side][flat])])[np.cumsum(counts)].tolist()
            ends.append((joined, at))
        (joined_a, at_a), (joined_b, at_b) = ends
        same = [joined_a[at_a[k]:at_a[k + 1]] == data == joined_b[at_b[k]:at_b[k + 1]]
                for k, data in enumerate(map(str.encode, missing))]
        self.same = np.concatenate([self.same, np.array(same, bool)])

    def forget(self, latest: list[str]) -> None:
        """Undo the last :meth:`learn`."""
        for chunk in latest:
            del self.number[chunk]
        kept = len(self.number)
        self.same = self.same[:kept]
        for side in (0, 1):
            self.first[side] = self.first[side][:kept + 1]
            self.ids[side] = self.ids[side][:self.first[side][-1]]

    def tokens(self, side: int, at: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, owner) of all tokens of the chunks numbered ``at``."""
        low, n = self.first[side][at], self.first[side][at + 1] - self.first[side][at]
        place = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        return self.ids[side][place], np.repeat(owner, n)


def _sides(path_a: str, path_b: str) -> _Sides:
    if (path_a, path_b) not in _SIDES:
        _SIDES[path_a, path_b] = _Sides(path_a, path_b)
    return _SIDES[path_a, path_b]


def _text(data: bytes | None) -> str | None:
    try:
        return " " + data.decode() if data else None
    except UnicodeDecodeError:
        return None


def tokenized(sides: _Sides, texts: list[bytes | None]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ids, document) of the tokens of either side; documents without tokens do not occur."""
    parts, owner = [], []
    for doc, text in enumerate(map(_text, texts)):
        if text is not None:
            own = chunks(text, []) or [text]
            parts += own
            owner += [doc] * len(own)
    if len(sides.number) > CHUNKS_KEPT:
        sides.reset()
    missing = set(parts).difference(sides.number)
    long = [c for c in missing if len(c) > LONGEST_KEPT]  # whole texts and the like, for this batch only
    sides.learn(list(missing.difference(long)))
    sides.learn(long)
    at, owner = np.fromiter(map(sides.number.__getitem__, parts), np.int64, len(parts)), np.array(owner, np.int64)
    differ = np.unique(owner[~sides.same[at]])
    if len(differ):
        keep = ~np.isin(owner, differ)
        at, owner = at[keep], owner[keep]
    out = [sides.tokens(side, at, owner) for side in (0, 1)]
    sides.forget(long)
    return out


def overlaps(starts: list[np.ndarray], docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(A token, B token) of every overlap. Starts are byte places in the whole batch."""
    a, b = (pd.DataFrame({"doc": d, "at": s, "token": np.arange(len(s))}) for s, d in zip(starts, docs))
    covering_b = pd.merge_asof(a, b, on="at", by="doc", suffixes=("", "_other"))["token_other"].to_numpy()
    covering_a = pd.merge_asof(b, a, on="at", by="doc", suffixes=("", "_other"))["token_other"].to_numpy()
    fresh = np.flatnonzero(starts[0][covering_a] != starts[1])  # equal starts are in the first direction already
    return np.concatenate([np.arange(len(a)), covering_a[fresh]]), np.concatenate([covering_b, fresh])


def _group_texts(sides: _Sides, ids: list[np.ndarray], groups: list[np.ndarray], docs: list[np.ndarray]) -> dict[int, str]:
    """sha256 of ``a1,a2|b1;a3|b2`` by document. ``groups`` number the batch's groups along the tokens."""
    last = [np.concatenate([g[1:] != g[:-1], [True]]) for g in groups]
    ends_doc = np.concatenate([docs[1][1:] != docs[1][:-1], [True]])
    after_a = np.where(last[0], 1, 0)
    after_b = np.where(ends_doc, 3, np.where(last[1], 2, 0))
    size_a, size_b = np.bincount(groups[0]), np.bincount(groups[1])
    total_a, total_b = np.cumsum(size_a), np.cumsum(size_b)
    place_a = np.arange(len(ids[0])) + (total_b - size_b)[groups[0]]
    place_b = np.arange(len(ids[1])) + total_a[groups[1]]
    text = [b""] * (len(ids[0]) + len(ids[1]))
    pieces = np.empty(len(text), object)
    pieces[place_a] = list(map(sides.written[0].__getitem__, (ids[0] * 4 + after_a).tolist()))
    pieces[place_b] = list(map(sides.written[1].__getitem__, (ids[1] * 4 + after_b).tolist()))
    ends = place_b[ends_doc] + 1
    starts = np.concatenate([[0], ends[:-1]])
    return {int(doc): hashlib.sha256(b"".join(pieces[x:y])).hexdigest()
            for doc, x, y in zip(docs[1][ends_doc], starts, ends)}


def _aligned(sides: _Sides, texts: list[bytes | None]) -> dict[str, list]:
    """Columns of one batch: counts and digest of each text, and its distinct linked pairs with occurrences."""
    n = len(texts)
    (ids_a, docs_a), (ids_b, docs_b) = tokenized(sides, texts)
    out = {"n_a": np.bincount(docs_a, minlength=n), "n_b": np.bincount(docs_b, minlength=n),
           "n_groups": np.zeros(n, np.int64), "n_links": np.zeros(n, np.int64), "groups_sha256": [""] * n,
           "pairs": [[]] * n, "times": [[]] * n}
    if not len(ids_a):
        return out
    ends = [np.cumsum(sides.length[side][ids]) for side, ids in enumerate((ids_a, ids_b))]
    starts = [np.concatenate([[0], e[:-1]]) for e in ends]
    link_a, link_b = overlaps(starts, [docs_a, docs_b])
    common = np.intersect1d(*ends, assume_unique=True)
    groups = [np.searchsorted(common, e) for e in ends]  # the group that a token's end belongs to
    out["n_groups"] = np.bincount(docs_a[np.isin(ends[0], common, assume_unique=True)], minlength=n)
    out["n_links"] = np.bincount(docs_a[link_a], minlength=n)
    for doc, digest in _group_texts(sides, [ids_a, ids_b], groups, [docs_a, docs_b]).items():
        out["groups_sha256"][doc] = digest
    width = len(sides.bytes_b)
    pair = (docs_a[link_a] * len(sides.bytes_a) + ids_a[link_a]) * width + ids_b[link_b]
    pair, times = np.unique(pair, return_counts=True)
    doc, pair = np.divmod(pair, len(sides.bytes_a) * width)
    at = np.searchsorted(doc, np.arange(n + 1))
    out["pairs"] = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(pair, pa.int64()))
    out["times"] = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(times, pa.int64()))
    return out


_KINDS = {"n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(),
          "groups_sha256": pa.string(), "pairs": pa.list_(pa.int64()), "times": pa.list_(pa.int64())}


def _by_bytes(texts: list[bytes | None], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes, or one row."""
    start, size = 0, 0
    for row, data in enumerate(texts):
        if size and size + len(data or b"") > most:
            yield start, row
            start, size = row, 0
        size += len(data or b"")
    if start < len(texts):
        yield start, len(texts)


def linked_documents(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``uid, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times`` of every text. Narrow.

    ``pairs`` are the document's distinct linked pairs (A id * B's vocabulary + B id), ``times`` their links.
    """
    path_a = path_a or public_tokenizers.path(TOKENIZER_A)
    path_b = path_b or public_tokenizers.path(TOKENIZER_B)
    importable_on_workers(docs.sparkSession)

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = _sides(path_a, path_b)
        for batch in batches:
            texts = utf8(batch.column(2))
            for low, high in _by_bytes(texts, BATCH_BYTES):
                columns = _aligned(sides, texts[low:high])
                arrays = [x if isinstance(x, pa.Array) else pa.array(x, _KINDS[name]) for name, x in columns.items()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), batch.column(1).slice(low, high - low), *arrays],
                    ["uid", "doc_id", *columns])

    source = row_numbered(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("_text")),
                          "uid").select("uid", "doc_id", "_text")
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(aligned, f"uid bigint, doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, "
                                      "n_links bigint, groups_sha256 string, pairs array<bigint>, times array<bigint>")


def pair_counts(linked: DataFrame, width: int) -> DataFrame:
    """``pair, n, best``: documents that hold the pair linked, and whether no pair of its A id has more."""
    counts = written(linked.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n")),
                     "op11-counts")
    most = counts.groupBy(F.expr(f"pair div {width}").alias("a")).agg(F.max("n").alias("most"))
    return written(counts.withColumn("a", F.expr(f"pair div {width}")).join(most, "a").select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best")), "op11-pairs")


def align_tokenizers(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every text."""
    import sentencepiece

    width = sentencepiece.SentencePieceProcessor(model_file=path_b or public_tokenizers.path(TOKENIZER_B)).get_piece_size()
    linked = written(linked_documents(docs, path_a, path_b, id_col, text_col), "op11-linked")
    counts = pair_counts(linked, width)
    counts = F.broadcast(counts) if counts.count() <= PAIRS_BROADCAST else counts
    each = linked.select("uid", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select(
        "uid", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    sums = each.join(counts, "pair").groupBy("uid").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(F.lit(0))).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    zero = F.lit(0).cast("bigint")
    return linked.select("uid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(sums, "uid", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
