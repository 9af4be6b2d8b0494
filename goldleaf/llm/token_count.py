"""Token counts by heap-and-linked-list byte-pair merging.

The symbols of a pre-token form a doubly linked list; a heap holds the rank of each adjacent pair. The
lowest rank is popped again and again (ties: the leftmost pair), its two symbols become one, and the pairs
with the new neighbours are pushed. The count is the number of initial symbols minus the merges; no token
identifier is made. Chunks that were counted before are remembered per Python worker, in bounded memory.

Cases: a null text counts as empty (0 bytes, 0 tokens); a string of a special token inside a text is one
token; bytes that are not valid UTF-8 count as U+FFFD in the tokens; repeated rows give repeated results; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.bpe_words import PRE_TOKEN, ChunkMemo, chunks, load_merges, segments
from goldleaf.llm.common import importable_on_workers, sliced, text_of, utf8

TOKENIZER = "byte_bpe_50k.json"
CONTEXT = 1024

_COUNTERS: dict[str, "BpeCounter"] = {}  # per Python worker, by file


def count_symbols(symbols: list[int], ranks: dict[int, int], merged: list[int]) -> int:
    """Symbols left after all merges: len(symbols) minus the merges done. ``symbols`` is used up."""
    n = len(symbols)
    bits = n.bit_length()  # a heap entry is rank << bits | place of the left symbol
    heap = []
    for i in range(n - 1):
        rank = ranks.get(symbols[i] << 32 | symbols[i + 1])
        if rank is not None:
            heap.append(rank << bits | i)
    if not heap:
        return n
    heapify(heap)
    right, left = list(range(1, n + 1)), list(range(-1, n - 1))
    place, merges = (1 << bits) - 1, 0
    while heap:
        entry = heappop(heap)
        i = entry & place
        j = right[i]
        # stale if the left symbol went into another one, or the pair there is no longer this one
        if j >= n or symbols[i] < 0 or ranks.get(symbols[i] << 32 | symbols[j]) != entry >> bits:
            continue
        symbols[i] = symbol = merged[entry >> bits]
        symbols[j] = -1
        merges += 1
        right[i] = after = right[j]
        if after < n:
            left[after] = i
            rank = ranks.get(symbol << 32 | symbols[after])
            if rank is not None:
                heappush(heap, rank << bits | i)
        before = left[i]
        if before >= 0:
            rank = ranks.get(symbols[before] << 32 | symbol)
            if rank is not None:
                heappush(heap, rank << bits | before)
    return n - merges


class BpeCounter:
    def __init__(self, path: str):
        self.ranks, self.merged, self.bytes, self.specials = load_merges(path)
        self.of_pre_token = ChunkMemo(self._pre_token)
        self.of_chunk = ChunkMemo(self._chunk)

    def _pre_token(self, word: str) -> int:
        symbols = self.bytes
        return count_symbols([symbols[b] for b in word.encode()], self.ranks, self.merged)

    def _chunk(self, text: str) -> int:
        return sum(self.of_pre_token[w] for w in PRE_TOKEN.findall(text))

    def count(self, text: str) -> int:
        if (parts := chunks(text, self.specials)) is not None:
            return sum(map(self.of_chunk.__getitem__, parts))
        return sum(1 if special else self._chunk(part) for part, special in segments(text, self.specials))


def _counter(path: str) -> BpeCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = BpeCounter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, tokenizer_path: str | None = None, limit: int = CONTEXT, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every text. Narrow: one pass, no shuffle.

    ``tokenizer_path`` is a byte-level BPE file that every executor can read.
    """
    path = tokenizer_path or public_tokenizers.path(TOKENIZER)
    importable_on_workers(docs.sparkSession)

    def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in sliced(batches):
            texts = [data or b"" for data in utf8(batch.column(1))]
            tokens = [counter.count(text_of(data)) for data in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, texts), pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([n > limit for n in tokens], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(count_batches, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
