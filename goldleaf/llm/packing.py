"""Best-fit packing of token sequences by a linear grouping scheme.

1. Every text becomes token ids plus an end token; texts longer than a sequence are cut into full pieces,
   the first piece taking the rest.
2. Linear grouping: the large pieces, longest first, are dealt into groups of equal cardinality; each
   group's lengths are rounded up to its longest. That leaves a few sizes.
3. Configurations: which rounded sizes share a sequence, and how often each combination is used, is worked
   out from the sizes and their counts alone: again and again the longest size left, completed by the
   combination that fills the sequence best with the fewest pieces.
4. Substitution: actual pieces take the places of their group. A piece's place follows from its rank, so
   this is a join with the (bounded) table of configurations, without any ordering of all pieces in one task.
5. Best fit: the small pieces go into the sequences with the least room that still holds them, in
   shards of a bounded number of sequences and small pieces.

What reaches the driver: the histogram of piece lengths, at most one row per length up to the sequence
length. Configurations: at most one per group, each of at most ``length / small`` parts.

Cases: a null or empty text is the end token alone; repeated rows are packed as often as they occur; an
empty table gives no rows; bytes that are not valid UTF-8 count as U+FFFD; further columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldleaf.llm.bpe_words import PRE_TOKEN, ChunkMemo, PreTokenIds, cuttable
from goldleaf.llm.common import importable_on_workers, kept_by, sliced, text_of, tidied, utf8, written

TOKENIZER = "byte_bpe_50k.json"
SEQUENCE, END_ID = 1024, 2
GROUPS = 512  # linear grouping: rounding costs about (longest - small) / GROUPS / 2 tokens a piece
SMALL = 64  # pieces shorter than this are left to best fit
SHARD_SEQUENCES = 20_000  # sequences in one best-fit task
SHARD_PIECES = 200_000  # small pieces in one best-fit task
CHUNKS_KEPT = 500_000  # remembered words of a worker, twice at most; as many other pre-tokens
RUN_CHARS = 4_000_000  # texts of about so many characters are split into words at a time

_ENCODERS: dict[str, "_Encoder"] = kept_by("packing")  # per Python worker, by file


class _Encoder:
    """Ids by the tokenizers library, as little-endian unsigned 32-bit bytes. Remembered are those of words that
    follow a space, and of the other pre-tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ids = PreTokenIds(self.tokenizer)
        self.of_word = ChunkMemo(self._of_word, CHUNKS_KEPT)
        self.of_part = ChunkMemo(self._of_part, CHUNKS_KEPT)

    def _of_part(self, chunk: str) -> bytes:
        ids = self.ids(chunk)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _of_word(self, word: str) -> bytes:
        chunk = " " + word
        if not word.isalpha() and len(parts := PRE_TOKEN.findall(chunk)) > 1:  # the first one holds the space
            return self.of_word[parts[0][1:]] + b"".join([self.of_part[p] for p in parts[1:]])
        return self._of_part(chunk)

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text: a word is looked up once for all of a run's texts that hold it."""
        out, run, size = [], [], 0
        for text in texts:
            run.append(text)
            size += len(text)
            if size >= RUN_CHARS:
                out += self._encode_run(run)
                run, size = [], 0
        return out + self._encode_run(run)

    def _encode_run(self, texts: list[str]) -> list[bytes]:
        cut = [cuttable(text, self.specials) for text in texts]
        words = pc.split_pattern(pa.array([t for t, c in zip(texts, cut) if c], pa.large_string()), " ")
        coded = words.values.dictionary_encode()
        ids = pa.array([self.of_word[w] for w in _spaceless(coded.dictionary)], pa.large_binary())
        ids = ids.take(coded.indices)  # those of a text one after the other
        at, data = np.frombuffer(ids.buffers()[1], np.int64), memoryview(ids.buffers()[2] or b"")
        first = words.offsets.to_numpy()
        begins, ends = iter(at[first[:-1] + 1]), iter(at[first[1:]])
        return [self._of_start(text) + data[next(begins):next(ends)] if c else self._encode(text)
                for text, c in zip(texts, cut)]

    def _of_start(self, text: str) -> bytes:
        start = text.partition(" ")[0]  # no space before it
        return self.of_part[start] if start else b""


def _spaceless(words: pa.Array) -> list[str]:
    """Words without spaces as a list; faster than ``to_pylist``."""
    if not len(words):
        return []
    joined = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), pa.scalar(" ", words.type))
    return joined[0].as_py().split(" ")


def _encoder(path: str) -> _Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = _Encoder(path)
    return _ENCODERS[path]


def cut(n: int, length: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: full ones, the rest first."""
    first = n % length or min(n, length)
    return [(0, first), *((start, length) for start in range(first, n, length))]


def tokenize_pieces(docs: DataFrame, tokenizer_path: str | None = None, length: int = SEQUENCE, end_id: int = END_ID,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``uid, doc_id, piece, start, length, ids_crc32``: the pieces of every text. Narrow."""
    path = tokenizer_path or public_tokenizers.path(TOKENIZER)
    importable_on_workers(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in sliced(batches):
            rows, columns = [], {"piece": [], "start": [], "length": [], "ids_crc32": []}
            texts = [text_of(data) for data in utf8(batch.column(2))]
            for row, ids in enumerate(encoder.encode_all(texts)):
                ids += end
                for k, (start, n) in enumerate(cut(len(ids) // 4, length)):
                    rows.append(row)
                    for name, value in zip(columns, (k, start, n, zlib.crc32(ids[4 * start:4 * (start + n)]))):
                        columns[name].append(value)
            at = pa.array(rows, pa.int64())
            arrays = [pa.array(v, pa.int32() if name == "piece" else pa.int64()) for name, v in columns.items()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), *arrays], ["uid", "doc_id", *columns])

    source = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(f"`{id_col}`").alias("doc_id"),
                         F.col(f"`{text_col}`").cast("string").alias("_text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        tidied("packing", pieces), f"uid bigint, doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")


def rounded_groups(histogram: dict[int, int], groups: int) -> tuple[int, list[tuple[int, int]]]:
    """Linear grouping. Members per group, and (rounded size, members) of each group, longest first."""
    total = sum(histogram.values())
    members = max(1, -(-total // groups))
    out, seen = [], 0
    for size in sorted(histogram, reverse=True):
        seen += histogram[size]
        while len(out) * members < seen:  # the group that begins inside this length is rounded up to it
            out.append((size, min(members, total - len(out) * members)))
    return members, out


def configurations(sizes: list[tuple[int, int]], length: int) -> list[tuple[int, dict[int, int]]]:
    """(times, {group: pieces of it}) of each configuration; together they place every piece.

    Few sizes, so a dynamic program over the room left gives the best completion: the fullest sequence,
    then the fewest pieces.
    """
    left = [n for _, n in sizes]
    out = []
    for first, (size, _) in enumerate(sizes):
        while left[first]:
            left[first] -= 1
            room = length - size
            use = _best_fill([s for s, _ in sizes], left, first, room)
            left[first] += 1
            use[first] = use.get(first, 0) + 1
            times = min(left[g] // k for g, k in use.items())
            for g, k in use.items():
                left[g] -= times * k
            out.append((times, use))
    return out


def _best_fill(sizes: list[int], left: list[int], first: int, room: int) -> dict[int, int]:
    none = 1 << 20
    fewest = np.full(room + 1, none)  # pieces needed to fill exactly so much
    fewest[0] = 0
    steps: list[tuple[int, np.ndarray]] = []
    for g in range(first, len(sizes)):
        size = sizes[g]
        for _ in range(min(left[g], room // size)):
            better = fewest[:-size] + 1 < fewest[size:]
            if not better.any():
                break
            steps.append((g, better))
            target = fewest[size:]
            target[better] = (fewest[:-size] + 1)[better]
        if fewest[room] < none and fewest[room] <= 1:
            break
    filled = int(np.flatnonzero(fewest < none)[-1])
    # walk back through the steps: a place was reached in a step from the state before that step
    use: dict[int, int] = {}
    step = len(steps) - 1
    while filled:
        while not (sizes[steps[step][0]] <= filled and steps[step][1][filled - sizes[steps[step][0]]]):
            step -= 1
        g = steps[step][0]
        use[g] = use.get(g, 0) + 1
        filled -= sizes[g]
        step -= 1
    return use


def _best_fit(shard: pd.DataFrame, length: int) -> pd.DataFrame:
    """Small pieces into the tightest room that holds them, longest first; new sequences when none does."""
    from bisect import bisect_left, insort

    room = sorted((int(r), int(s)) for r, s in zip(shard["room"], shard["sequence"]) if s >= 0)
    small = shard[shard["sequence"] < 0].sort_values(["size", "uid", "piece"], ascending=[False, True, True])
    fresh, out = 0, []
    for uid, piece, size in zip(small["uid"], small["piece"], small["size"]):
        at = bisect_left(room, (int(size), -(1 << 62)))
        if at < len(room):
            left, sequence = room.pop(at)
        else:
            fresh += 1
            left, sequence = length, -fresh
        out.append((uid, piece, sequence, length - left))
        if left > size:
            insort(room, (left - int(size), sequence))
    return pd.DataFrame(out, columns=["uid", "piece", "sequence", "offset"])


def _ranked(large: DataFrame, histogram: dict[int, int], buckets: int) -> DataFrame:
    """``rank`` of every large piece by length, longest first, without ordering all pieces in one task.

    Pieces of a length are dealt into ``buckets``; a piece's rank is the number of longer pieces (from the
    histogram), those of its length in earlier buckets, and its place in its bucket.
    """
    spark = large.sparkSession
    longer, seen = [], 0
    for size in sorted(histogram, reverse=True):
        longer.append((size, seen))
        seen += histogram[size]
    base = spark.createDataFrame(longer, "length bigint, _longer bigint")
    dealt = large.withColumn("_bucket", F.pmod(F.xxhash64("uid", "piece"), F.lit(buckets)))
    counts = dealt.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("length", "_bucket", (F.sum("_n").over(
        Window.partitionBy("length").orderBy("_bucket")) - F.col("_n")).alias("_before"))
    place = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("uid", "piece")) - 1
    return (dealt.withColumn("_place", place).join(before, ["length", "_bucket"])
            .join(F.broadcast(base), "length")
            .withColumn("rank", F.col("_longer") + F.col("_before") + F.col("_place"))
            .drop("_bucket", "_place", "_before", "_longer"))


def pack(pieces: DataFrame, length: int = SEQUENCE, groups: int = GROUPS, small: int = SMALL) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``. ``pieces`` is read several times: pass a written table."""
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in  # at most one row per length
                 pieces.where(F.col("length") < length).groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    big = {size: n for size, n in histogram.items() if size >= small}
    members, sizes = rounded_groups(big, groups)
    plan = configurations(sizes, length)

    # places: of group g, the ranks [low, high) within the group fill a configuration's sequences in turn
    used, places, sequences = [0] * len(sizes), [], 0
    for times, use in plan:
        for g, k in use.items():
            places.append((g, used[g], used[g] + times * k, k, sequences))
            used[g] += times * k
        sequences += times
    table = spark.createDataFrame(places, "group bigint, low bigint, high bigint, each bigint, first bigint")
    pieces_n = sum(histogram.values())
    buckets = max(64, pieces_n // 100_000)
    large = pieces.where((F.col("length") < length) & (F.col("length") >= small)).select("uid", "piece", "length")
    ranked = _ranked(large, big, buckets).select(
        "uid", "piece", "length", F.expr(f"rank div {members}").alias("group"), (F.col("rank") % members).alias("_in"))
    placed = ranked.join(F.broadcast(table), "group").where("_in >= low AND _in < high").select(
        "uid", "piece", "length", "group", "_in", F.expr("first + (_in - low) div each").alias("sequence"))
    in_sequence = Window.partitionBy("sequence").orderBy("group", "_in")
    placed = written(placed.select(
        "uid", "piece", "sequence", "length",
        (F.sum("length").over(in_sequence) - F.col("length")).alias("offset")), "op7-large")

    smalls_n = sum(n for size, n in histogram.items() if size < small)
    shards = max(1, -(-max(sequences, histogram_tokens(histogram, small) // length) // SHARD_SEQUENCES),
                 -(-smalls_n // SHARD_PIECES))
    rooms = placed.groupBy("sequence").agg((F.lit(length) - F.sum("length")).alias("room")).where("room > 0").select(
        F.pmod(F.xxhash64("sequence"), F.lit(shards)).alias("shard"), "sequence", "room",
        F.lit(-1).cast("bigint").alias("uid"), F.lit(-1).alias("piece"), F.lit(0).cast("bigint").alias("size"))
    smalls = pieces.where(F.col("length") < small).select(
        F.pmod(F.xxhash64("uid", "piece"), F.lit(shards)).alias("shard"), F.lit(-1).cast("bigint").alias("sequence"),
        F.lit(0).cast("bigint").alias("room"), "uid", "piece", F.col("length").alias("size"))

    def fit(key: tuple, shard: pd.DataFrame) -> pd.DataFrame:
        out = _best_fit(shard, length)
        fresh = out["sequence"] < 0  # numbered apart from the planned sequences and from other shards
        out.loc[fresh, "sequence"] = sequences + (-out.loc[fresh, "sequence"] - 1) * shards + key[0]
        return out

    fitted = rooms.unionByName(smalls).groupBy("shard").applyInPandas(
        fit, "uid bigint, piece int, sequence bigint, offset bigint")
    places_of = placed.select("uid", "piece", "sequence", "offset").unionByName(fitted)
    rest = pieces.where(F.col("length") < length).join(places_of, ["uid", "piece"])
    full = pieces.where(F.col("length") == length).withColumn("offset", F.lit(0).cast("bigint")).withColumn(
        "sequence_id", -F.monotonically_increasing_id() - 1)
    return full.unionByName(rest.withColumnRenamed("sequence", "sequence_id"))


def histogram_tokens(histogram: dict[int, int], below: int) -> int:
    return sum(size * n for size, n in histogram.items() if size < below)


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, length: int = SEQUENCE, end_id: int = END_ID,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece of every document."""
    pieces = written(tokenize_pieces(docs, tokenizer_path, length, end_id, id_col, text_col), "op7-pieces")
    return pack(pieces, length).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "uid")
