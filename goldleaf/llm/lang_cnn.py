"""Language identification with a byte convolutional network trained in numpy.

Model: every byte is one of ``SYMBOLS`` classes (ASCII letters without case, digits, white space,
punctuation, and the bytes of other characters), filters of several widths slide over fixed-length
windows, each filter's largest response in a window is kept (max pooling), and a softmax layer gives the
languages. A text's prediction is the mean of its windows' log-probabilities; the windows cover all of it.

Training takes a bounded sample of labelled texts (``TRAIN_DOCS`` per run, chosen by a hash of the id) and
some windows of each, spread over the whole text, and runs on the driver. Prediction runs on the executors.
A filter's responses to two neighbouring bytes are tabulated, so a convolution is a few table look-ups.

All languages are learned. The sample's bound is for the texts of all languages together, at least
``LEAST_DOCS`` of each; the number of languages is taken to be that of human languages, a few thousand at most.

Cases: ``und`` with score 0 for a null text, one without a letter, or if nothing could be learned (no
labelled text outside the held-out fold); a null id is not held out; repeated rows give repeated results;
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import broadcast_if_few, held_out, importable_on_workers, sliced, text_of, utf8, written

TRAIN_DOCS = 4_000  # about so many labelled texts are learned from
LEAST_DOCS = 10  # but at least so many of each language, if there are
WINDOWS_A_DOC = 6
WINDOW = 128  # bytes
SYMBOLS = 64
WIDTHS = {2: 8, 3: 16, 4: 16}  # filters by width
EPOCHS, BATCH, RATE, SEED = 8, 256, 0.01, 7
UNDETERMINED = "und"

_LETTER = regex.compile(r"\p{L}")


def _symbol_table() -> np.ndarray:
    """Class of each byte: 0 padding, 1 white space, 2 digit, 3 other ASCII, 4-29 letters, the rest by value."""
    table = np.full(256, 3, np.uint8)
    for b in b" \t\n\r\x0b\x0c":
        table[b] = 1
    table[48:58] = 2
    for i in range(26):
        table[65 + i] = table[97 + i] = 4 + i
    high = np.arange(128, 256)
    table[128:] = 30 + high % (SYMBOLS - 30)
    return table


SYMBOL_OF = _symbol_table()
WIDEST = max(WIDTHS)


def windows(data: bytes, every: int | None = None) -> np.ndarray:
    """The symbols of a text in rows of ``WINDOW + WIDEST - 1``: windows side by side, the last one padded.

    Each row also sees the first bytes of the next window, so no n-gram at a border is lost. ``every``
    picks at most so many rows, evenly spread over the text.
    """
    n = max(1, -(-len(data) // WINDOW))
    symbols = np.zeros(n * WINDOW + WIDEST - 1, np.uint8)
    symbols[:len(data)] = SYMBOL_OF[np.frombuffer(data, np.uint8)]
    rows = np.lib.stride_tricks.sliding_window_view(symbols, WINDOW + WIDEST - 1)[::WINDOW]
    if every and n > every:
        rows = rows[np.linspace(0, n - 1, every).astype(int)]
    return rows


@dataclass
class ByteCnn:
    languages: list[str]
    filters: np.ndarray  # (WIDEST, SYMBOLS, n): narrower filters have zeros beyond their width
    bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def responses(self, rows: np.ndarray) -> np.ndarray:
        """(rows, WINDOW, n) responses of all filters at all places."""
        first = (self.filters[0][:, None] + self.filters[1][None]).reshape(-1, self.filters.shape[2])
        second = (self.filters[2][:, None] + self.filters[3][None]).reshape(-1, self.filters.shape[2])
        pairs = rows[:, :-1].astype(np.int32) * SYMBOLS + rows[:, 1:]
        out = first.take(pairs[:, :WINDOW], axis=0)
        out += second.take(pairs[:, 2:2 + WINDOW], axis=0)
        return out

    def log_probabilities(self, rows: np.ndarray) -> np.ndarray:
        pooled = np.maximum(self.responses(rows).max(axis=1) + self.bias, 0)
        logits = pooled @ self.dense + self.dense_bias
        logits -= logits.max(axis=1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))

    def predict(self, data: bytes, rows_at_once: int = 256) -> tuple[str, float]:
        rows, total = windows(data), np.zeros(len(self.languages))
        for start in range(0, len(rows), rows_at_once):
            total += self.log_probabilities(rows[start:start + rows_at_once]).sum(axis=0)
        mean = total / len(rows)
        p = np.exp(mean - mean.max())
        best = int(p.argmax())
        return self.languages[best], float(p[best] / p.sum())


def train(rows: np.ndarray, labels: np.ndarray, languages: list[str]) -> ByteCnn:
    """Adam on the cross-entropy of windows; deterministic."""
    rng = np.random.default_rng(SEED)
    n = sum(WIDTHS.values())
    width_of = np.repeat(list(WIDTHS), list(WIDTHS.values()))
    mask = (np.arange(WIDEST)[:, None] < width_of[None])[:, None, :].astype(np.float32)
    p = {
        "filters": (rng.normal(0, 0.3, (WIDEST, SYMBOLS, n)) * mask).astype(np.float32),
        "bias": np.zeros(n, np.float32),
        "dense": rng.normal(0, 0.3, (n, len(languages))).astype(np.float32),
        "dense_bias": np.zeros(len(languages), np.float32),
    }
    m, v, step = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}, 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), BATCH):
            pick = order[start:start + BATCH]
            x, y = rows[pick], labels[pick]
            net = ByteCnn(languages, p["filters"], p["bias"], p["dense"], p["dense_bias"])
            r = net.responses(x)
            at = r.argmax(axis=1)  # place of each filter's largest response
            raw = np.take_along_axis(r, at[:, None], axis=1)[:, 0] + p["bias"]
            pooled = np.maximum(raw, 0)
            logits = pooled @ p["dense"] + p["dense_bias"]
            prob = np.exp(logits - logits.max(axis=1, keepdims=True))
            prob /= prob.sum(axis=1, keepdims=True)
            prob[np.arange(len(y)), y] -= 1
            prob /= len(y)
            grad = {"dense": pooled.T @ prob, "dense_bias": prob.sum(axis=0)}
            back = (prob @ p["dense"].T) * (raw > 0)
            grad["bias"] = back.sum(axis=0)
            grad["filters"] = np.zeros_like(p["filters"])
            for j in range(WIDEST):
                symbols = np.take_along_axis(x, at + j, axis=1)
                np.add.at(grad["filters"][j], (symbols, np.broadcast_to(np.arange(n), symbols.shape)), back)
            grad["filters"] *= mask
            step += 1
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * grad[k]
                v[k] = 0.999 * v[k] + 0.001 * grad[k] ** 2
                p[k] = (p[k] - RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return ByteCnn(languages, p["filters"], p["bias"], p["dense"], p["dense_bias"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        train_docs: int = TRAIN_DOCS) -> ByteCnn | None:
    """Learn from a bounded sample of the rows with a text and a language outside the held-out fold."""
    importable_on_workers(docs.sparkSession)

    def sample_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            langs, rows = [], []
            for lang, data in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                picked = windows(data, WINDOWS_A_DOC)
                langs += [lang] * len(picked)
                rows += [r.tobytes() for r in picked]
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(rows, pa.binary())], ["lang", "row"])

    labelled = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text"),
                           F.col(f"`{lang_col}`").cast("string").alias("_lang")).where(
        F.col("_lang").isNotNull() & F.col("_text").rlike(r"\p{L}") & ~held_out(F.col("_id")))
    # the same number of texts of each language, chosen by a hash; the texts that are not chosen stay behind
    counts = written(labelled.groupBy("_lang").agg(F.count(F.lit(1)).alias("_n")), "op10-counts")
    languages = [r["_lang"] for r in counts.select("_lang").orderBy("_lang").collect()]
    if not languages:
        return None
    share = max(LEAST_DOCS, train_docs / len(languages))
    rates = broadcast_if_few(counts.select("_lang", (F.lit(float(1 << 30)) * share / F.col("_n")).alias("_bar")))
    drawn = F.pmod(F.xxhash64("_id", F.lit(SEED)), F.lit(1 << 30)) < F.col("_bar")
    table = labelled.join(rates, "_lang").where(drawn).select("_lang", "_text").mapInArrow(sample_windows, "lang string, row binary").orderBy(
        "lang", "row").toArrow()
    rows = np.frombuffer(b"".join(table.column("row").to_pylist()), np.uint8).reshape(-1, WINDOW + WIDEST - 1)
    number = {lang: k for k, lang in enumerate(languages)}
    labels = np.array([number[x] for x in table.column("lang").to_pylist()])
    return train(rows, labels, languages)


def predict(docs: DataFrame, net: ByteCnn | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every text. Narrow."""
    spark = docs.sparkSession
    importable_on_workers(spark)
    shared = spark.sparkContext.broadcast(net)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in sliced(batches):
            out = []
            for data in utf8(batch.column(2)):
                known = net is not None and data is not None and _LETTER.search(text_of(data)) is not None
                out.append(net.predict(data) if known else (UNDETERMINED, 0.0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([x[0] for x in out], pa.string()),
                 pa.array([x[1] for x in out], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), held_out(F.col(f"`{id_col}`")).alias("held_out"),
                         F.col(f"`{text_col}`").cast("string").alias("_text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(predicted, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       train_docs: int = TRAIN_DOCS) -> DataFrame:
    """Learn from ``lang`` outside the held-out fold, then predict every row."""
    return predict(docs, fit(docs, id_col, text_col, lang_col, train_docs), id_col, text_col)
