"""Importance resampling to a target distribution, by hashed n-grams whose CRCs are worked out in matrices.

Every text is a bag of features: its runs of one to three consecutive words. A feature's bucket is the CRC-32
of its bytes modulo ``BUCKETS``. The log ratio of a bucket's share in the target texts to its share in all
texts is its gain, a text's weight the sum of its features' gains, and the draw takes the highest weights
plus Gumbel noise from the document's id (weighted sampling without replacement).

CRCs of a batch. Words become numbers and runs of words pairs of numbers, so the distinct features of a batch
are found without building their strings. Distinct features of equal byte length are laid out as the rows of
one two-dimensional ``uint8`` array, and all CRCs of the array are updated together, column by column; the
results are scattered back to the features and from there to the texts.

On Spark: one pass counts buckets (per task one row a bucket at most, then a grouped sum of at most ``BUCKETS``
rows, which is all that reaches the driver), a second one scores the texts; both are narrow. The ranking sorts
the scored rows by ranges and numbers them range by range, so no task holds all rows.

Cases: a null text has no words; no words: weight 0; of a run's bytes A-Z are lower-cased, nothing else;
bytes that are not valid UTF-8 count as word bytes; ``h`` of a null doc_id is that of the empty string;
equal scores go by doc_id (null first), then by n_features; rows that repeat a doc_id are drawn one by one;
empty tables give no rows, and an empty target gains that only reflect the documents; further columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldleaf.llm.common import importable_on_workers, utf8, written

BUCKETS, LONGEST_RUN = 10_000, 3
LEAST_WORDS, DRAWN_PERCENT = 20, 5
SEED_TEXT = "42:"
BATCH_BYTES = 2 << 20  # of text whose features are worked out together
RANK_ROWS = 1_000_000  # rows of a range when ranking
_WIDE = 1 << 22  # bytes of a matrix, at most (or one row)


def _crc_table() -> np.ndarray:
    """The 256 remainders of CRC-32 (reflected polynomial 0xEDB88320)."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()
_WORD_BYTE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def words_of(data: bytes | None) -> list[bytes]:
    """Runs of ASCII digits and letters (A-Z lower-cased) and of all bytes above 127."""
    return data.translate(_WORD_BYTE).split() if data else []


def crc_of_rows(rows: np.ndarray) -> np.ndarray:
    """CRC-32 of each row of a ``uint8`` matrix, all rows together, column by column."""
    crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
    for column in rows.T:
        crc = _CRC[(crc ^ column) & 0xFF] ^ (crc >> 8)
    return crc ^ np.uint32(0xFFFFFFFF)


def _by_length(length: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(length, members) of the groups of equal length, members in parts that make matrices of bounded size."""
    order = np.argsort(length, kind="stable")
    ends = np.flatnonzero(np.diff(length[order])) + 1
    for members in np.split(order, ends):
        if len(members):
            n = int(length[members[0]])
            step = max(1, _WIDE // max(n, 1))
            for start in range(0, len(members), step):
                yield n, members[start:start + step]


class _Features:
    """Distinct words of a batch and the bytes that their runs are made of."""

    def __init__(self, words: list[bytes]):
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        self.first = np.concatenate([[0], np.cumsum(self.length + 1)[:-1]]) if words else np.empty(0, np.int64)
        self.pool = np.frombuffer(b" ".join([*words, b""]), np.uint8)

    def buckets(self, runs: np.ndarray, buckets: int) -> np.ndarray:
        """Bucket of each run; ``runs`` are rows of word numbers."""
        length = self.length[runs].sum(axis=1) + runs.shape[1] - 1
        out = np.empty(len(runs), np.int64)
        for n, members in _by_length(length):
            rows = np.empty((len(members), n), np.uint8)
            place = np.zeros(len(members), np.int64)
            own = runs[members]
            for word in range(runs.shape[1]):  # words of equal length go in together, each with the space behind it
                for size, same in _by_length(self.length[own[:, word]]):
                    last = word == runs.shape[1] - 1
                    span = np.arange(size + (not last))
                    rows[same[:, None], place[same][:, None] + span] = self.pool[self.first[own[same, word]][:, None] + span]
                    place[same] += size + (not last)
            out[members] = crc_of_rows(rows) % buckets
        return out


def feature_buckets(texts: list[bytes | None], buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> tuple[
        np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, text number) of every feature, repeats included, and the words of each text."""
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    at, counts = [], []
    for data in texts:
        own = words_of(data)
        at += map(number.__getitem__, own)
        counts.append(len(own))
    n_words = np.array(counts, np.int64)
    ids, owner = np.array(at, np.int64), np.repeat(np.arange(len(texts)), n_words)
    features = _Features(list(number))
    found, owners = [], []
    runs = np.arange(len(number))[:, None]  # the distinct runs, as rows of words
    of_place = ids  # number of the run that starts at each place
    starts = np.arange(len(ids))
    for n in range(1, longest + 1):
        if n > 1:
            fits = owner[starts + n - 1] == owner[starts]
            starts, of_place = starts[fits], of_place[fits]
            pair = of_place * max(len(number), 1) + ids[starts + n - 1]
            distinct, of_place = np.unique(pair, return_inverse=True)
            runs = np.concatenate([runs[distinct // max(len(number), 1)], (distinct % max(len(number), 1))[:, None]], axis=1)
        found.append(features.buckets(runs, buckets)[of_place] if len(runs) else np.empty(0, np.int64))
        owners.append(owner[starts])
        inside = starts < len(ids) - n  # a longer run needs a place after this one
        starts, of_place = starts[inside], of_place[inside]
    return np.concatenate(found), np.concatenate(owners), n_words


def _parts(column: pa.Array) -> Iterator[tuple[int, list[bytes | None]]]:
    """(first row, texts) of about ``BATCH_BYTES`` bytes each, or one text."""
    texts, start, size = utf8(column), 0, 0
    for row, data in enumerate(texts):
        if size and size + len(data or b"") > BATCH_BYTES:
            yield start, texts[start:row]
            start, size = row, 0
        size += len(data or b"")
    if start < len(texts):
        yield start, texts[start:]


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket."""
    importable_on_workers(texts.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, part in _parts(batch.column(0)):
                total += np.bincount(feature_buckets(part, buckets)[0], minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], ["bucket", "n"])

    per_task = texts.select(F.col(f"`{text_col}`").cast("string").alias("_text")).mapInArrow(counted, "bucket int, n bigint")
    sums = per_task.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # at most one row per bucket
    out = np.zeros(buckets, np.int64)
    out[sums.column("bucket").to_numpy()] = sums.column("n").to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, rounded down, by bucket."""
    k, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + k) / ((s + 1) * (t_all + k))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def _noise(doc_id: Column) -> Column:
    """Thousandths of a standard Gumbel variable from the id, rounded down."""
    digest = F.sha2(F.concat(F.lit(SEED_TEXT), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


def weighted(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_features, n_words, weight, score`` of every text. Narrow."""
    importable_on_workers(docs.sparkSession)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, part in _parts(batch.column(1)):
                found, owner, n_words = feature_buckets(part, len(gain))
                total = np.zeros(len(part), np.int64)
                np.add.at(total, owner, gain[found])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(part)), pa.array(np.bincount(owner, minlength=len(part)), pa.int64()),
                     pa.array(n_words), pa.array(total)], ["doc_id", "n_features", "n_words", "weight"])

    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    out = source.mapInArrow(weigh, f"doc_id {kind}, n_features bigint, n_words bigint, weight bigint")
    return out.withColumn("score", F.col("weight") + _noise(F.col("doc_id")))


def ranked(rows: DataFrame, n: int, order: list[Column], name: str = "rank") -> DataFrame:
    """``rows`` with their place (from 1) in ``order``, null beyond the first ``n``.

    Rows are sorted into ranges; a row's place is the rows of earlier ranges and its place in its own.
    ``rows`` is read twice: pass a written table.
    """
    ranges = max(1, -(-rows.count() // RANK_ROWS))
    dealt = written(rows.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()), "op12-ranges")
    sizes = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))  # a row per range
    before = sizes.select("_range", (F.coalesce(F.sum("_n").over(
        Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) + F.col("_before")
    return dealt.join(F.broadcast(before), "_range").withColumn(name, place.cast("bigint")).withColumn(
        name, F.when(F.col(name) <= n, F.col(name))).drop("_range", "_before")


def resample(docs: DataFrame, target: DataFrame, least_words: int = LEAST_WORDS, percent: int = DRAWN_PERCENT,
             id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every document; ``rank`` is null for those not drawn.

    Of the documents with at least ``least_words`` words, ``percent`` of a hundred are drawn, rounded down.
    """
    gain = gains(bucket_counts(docs, text_col), bucket_counts(target, target_col))
    scored = written(weighted(docs, gain, id_col, text_col), "op12-scored")
    long_enough = F.col("n_words") >= least_words
    drawn = percent * scored.where(long_enough).count() // 100
    order = [F.desc("score"), F.asc_nulls_first("doc_id"), F.desc("n_features")]
    first = ranked(scored.where(long_enough), drawn, order)
    rest = scored.where(~long_enough).withColumn("rank", F.lit(None).cast("bigint"))
    return first.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
