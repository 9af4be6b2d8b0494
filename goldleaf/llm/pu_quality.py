"""Quality classifier by positive-unlabelled learning with the non-negative risk estimator.

Trusted positives are texts labelled 1 outside the held-out fold; the unlabelled side is web text without a
usable label: rows that have none. The class prior, the share of good texts on the unlabelled side, is
estimated from scores of positives and unlabelled rows: where the two densities are compared, the
unlabelled density is at least prior times the positive one, so the smallest ratio over the better part of
the scores is the estimate. A small network g is trained on

    prior * E_pos[l(g)] + max(0, E_unl[l(-g)] - prior * E_pos[l(-g)])

(logistic loss), stepping back along the second term whenever it turns negative. The output is then put on
a probability scale with the labelled rows of the learning folds (two numbers, a slope and an offset).

Features come from the whole text only: shares of kinds of characters and of single signs, word lengths,
repetition of words and of lines. Learning takes bounded samples (``SAMPLE`` rows of each kind, chosen by
a hash) to the driver; features and scores of all rows are computed on the executors.

Cases: null text counts as empty and is scored like any other; without labelled positives every score is
the prior default 0.5; a null id is not held out and finds no label; a label that repeats for an id counts
once, the larger value; null labels are passed over; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import held_out, importable_on_workers, sliced, tidied, utf8, written

SAMPLE = 6_000  # rows of each kind (positive, unlabelled, labelled for the scale) that are learned from
HIDDEN, EPOCHS, BATCH, RATE, SEED = 32, 30, 256, 0.003, 11
ACCEPT = 0.7

SIGNS = b"%*&$#|!?.,;:=<>/\\(){}[]@_-+'\"~^`"


def features(data: bytes) -> np.ndarray:
    """Numbers between about 0 and 10 that describe how a text is written; all zeros but one for no text."""
    n = len(data)
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256) if n else np.zeros(256, np.int64)
    upper, lower, digit = count[65:91].sum(), count[97:123].sum(), count[48:58].sum()
    high, space, line = count[128:].sum(), count[32], count[10]
    signs = count[list(SIGNS)]
    words = data.split()
    w = len(words)
    lengths = np.fromiter(map(len, words), np.int64, w)
    distinct = len(set(words))
    repeats = sum(map(bytes.__eq__, words[1:], words)) if w > 1 else 0
    lines = [x for x in data.split(b"\n") if x.strip()]
    again = len(lines) - len(set(lines))
    total = max(n, 1)
    letters = max(upper + lower + high, 1)
    out = [
        np.log1p(n) / 2, np.log1p(w) / 2, np.log1p(len(lines)),
        upper / letters * 5, lower / total * 5, digit / total * 10, high / letters * 5, space / total * 10,
        line / total * 50, signs.sum() / total * 10,
        lengths.mean() / 5 if w else 0, lengths.std() / 5 if w else 0, (lengths > 20).mean() * 10 if w else 0,
        (lengths == 1).mean() * 5 if w else 0,
        distinct / w * 3 if w else 0, repeats / w * 5 if w else 0, np.log1p(distinct) / 3,
        again / len(lines) * 5 if lines else 0, np.log1p(w / max(len(lines), 1)),
        w / max(count[46], 1) / 10 if w < 100 * max(count[46], 1) else 10,
        *np.minimum(signs / max(w, 1) * 10, 10),
    ]
    return np.asarray(out, np.float32)


N_FEATURES = len(features(b""))


@dataclass
class PuModel:
    mean: np.ndarray
    scale: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum((x - self.mean) / self.scale @ self.hidden + self.hidden_bias, 0)
        return h @ self.out + self.out_bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * self.margin(x) + self.offset)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float, non_negative: bool = True) -> PuModel:
    """Minimise the non-negative unbiased risk with Adam; deterministic.

    ``non_negative=False`` with ``prior`` 0.5 simply tells positives from unlabelled rows (used to
    estimate the prior).
    """
    rng = np.random.default_rng(SEED)
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-3
    k = both.shape[1]
    p = [rng.normal(0, (2 / k) ** 0.5, (k, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.1, HIDDEN), np.zeros(1)]
    m, v, step = [np.zeros_like(x) for x in p], [np.zeros_like(x) for x in p], 0
    pos, unl = np.clip((positive - mean) / scale, -8, 8), np.clip((unlabelled - mean) / scale, -8, 8)
    steps = max(1, len(unl) // BATCH)
    for _ in range(EPOCHS):
        pi, ui = rng.permutation(len(pos)), rng.permutation(len(unl))
        for s in range(steps):
            xp = pos[np.take(pi, np.arange(s * BATCH, (s + 1) * BATCH), mode="wrap")]
            xu = unl[np.take(ui, np.arange(s * BATCH, (s + 1) * BATCH), mode="wrap")]
            x = np.concatenate([xp, xu])
            pre = x @ p[0] + p[1]
            h = np.maximum(pre, 0)
            g = h @ p[2] + p[3][0]
            gp, gu = g[:len(xp)], g[len(xp):]
            # d/dg of l(g) = log(1 + exp(-g)) is sigmoid(g) - 1, of l(-g) it is sigmoid(g)
            d = np.zeros_like(g)
            if non_negative:
                negative_risk = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
                on_p, on_u = -prior * _sigmoid(gp) / len(gp), _sigmoid(gu) / len(gu)
                if negative_risk >= 0:
                    d[:len(xp)] = prior * (_sigmoid(gp) - 1) / len(gp) + on_p
                    d[len(xp):] = on_u
                else:  # the estimate went below what a risk can be: step back along it
                    d[:len(xp)], d[len(xp):] = -on_p, -on_u
            else:
                d[:len(xp)] = prior * (_sigmoid(gp) - 1) / len(gp)
                d[len(xp):] = (1 - prior) * _sigmoid(gu) / len(gu)
            back = d[:, None] * p[2] * (pre > 0)
            grads = [x.T @ back + 1e-4 * p[0], back.sum(axis=0), h.T @ d, np.array([d.sum()])]
            step += 1
            for i, grad in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * grad
                v[i] = 0.999 * v[i] + 0.001 * grad ** 2
                p[i] = p[i] - RATE * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
    return PuModel(mean, scale, p[0], p[1], p[2], float(p[3][0]))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, bins: int = 10) -> float:
    """Share of positives among the unlabelled: the smallest density ratio over score bins that each hold a
    tenth of the positives (the lowest, noisy, tenth left out)."""
    half = len(positive) // 2
    split = train(positive[:half], unlabelled, 0.5, non_negative=False)
    sp, su = split.margin(positive[half:]), split.margin(unlabelled)
    edges = np.quantile(sp, np.linspace(0, 1, bins + 1))[1:-1]
    share_p = np.bincount(np.searchsorted(edges, sp), minlength=bins)[1:] / max(len(sp), 1)
    share_u = np.bincount(np.searchsorted(edges, su), minlength=bins)[1:] / max(len(su), 1)
    ratios = share_u[share_p > 0] / share_p[share_p > 0]
    # two neighbouring bins together keep a single thin bin from deciding
    smooth = np.convolve(ratios, [0.5, 0.5], "valid") if len(ratios) > 1 else ratios
    return float(np.clip(smooth.min() if len(smooth) else 0.5, 0.05, 0.95))


def on_probability_scale(model: PuModel, x: np.ndarray, y: np.ndarray) -> PuModel:
    """Slope and offset by Newton steps on the labelled rows (with a weak pull to slope 1, offset 0)."""
    z = model.margin(x)
    a, b = 1.0, 0.0
    for _ in range(50):
        q = _sigmoid(a * z + b)
        w = q * (1 - q) + 1e-9
        ga, gb = ((q - y) * z).sum() + (a - 1), (q - y).sum() + b
        haa, hab, hbb = (w * z * z).sum() + 1, (w * z).sum(), w.sum() + 1
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        a, b = a - np.clip(da, -1, 1), b - np.clip(db, -1, 1)
        if abs(da) + abs(db) < 1e-9:
            break
    model.slope, model.offset = float(max(a, 1e-3)), float(b)
    return model


def _drawn(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
           sample: int) -> tuple[dict[str, np.ndarray], float]:
    """Features of at most about ``sample`` texts of each kind (twice that of unlabelled ones), chosen by a
    hash of the id, and the share of label 1 among the labelled rows of the learning folds.

    Ids and labels are joined without the texts; the chosen ids, whose number is bounded, then fetch theirs.
    """
    label = labels.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{label_col}`").alias("_label")).where(
        "_id IS NOT NULL AND _label IS NOT NULL").groupBy("_id").agg(F.max("_label").alias("_label"))
    ids = docs.select(F.col(f"`{id_col}`").alias("_id")).where("_id IS NOT NULL").distinct()
    kind = (F.when(F.col("_label").isNull(), "unlabelled")
            .when(held_out(F.col("_id")), None).when(F.col("_label") == 1, "positive").when(F.col("_label") == 0, "negative"))
    kinds = ids.join(label, "_id", "left").select("_id", kind.alias("_kind")).where("_kind IS NOT NULL")
    n = {r["_kind"]: r["n"] for r in kinds.groupBy("_kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    wanted = {"positive": sample, "negative": sample, "unlabelled": 2 * sample}
    bar = F.coalesce(*[F.when(F.col("_kind") == k, F.lit(int(min(1.0, m / max(n.get(k, 1), 1)) * (1 << 30))))
                       for k, m in wanted.items()])
    chosen = written(kinds.where(F.pmod(F.xxhash64("_id", F.lit(SEED)), F.lit(1 << 30)) < bar), "op6-chosen")

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            x = [features(data or b"").tobytes() for data in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(x, pa.binary())], ["kind", "key", "x"])

    texts = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    # an id that repeats brings one of its texts, so the sample stays bounded
    table = texts.join(F.broadcast(chosen), "_id").select("_kind", "_text", F.xxhash64("_id").alias("_key")).mapInArrow(
        tidied("quality", described), "kind string, key bigint, x binary").groupBy("kind", "key").agg(F.min("x").alias("x")).orderBy(
        "kind", "x").select("kind", "x").toArrow().to_pylist()
    out = {k: np.frombuffer(b"".join(r["x"] for r in table if r["kind"] == k), np.float32).reshape(-1, N_FEATURES)
           for k in wanted}
    known = n.get("positive", 0) + n.get("negative", 0)
    return out, n.get("positive", 0) / max(known, 1)


def _thinned(x: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows, evenly spread."""
    return x[np.linspace(0, len(x) - 1, max(1, min(n, len(x)))).astype(int)]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        sample: int = SAMPLE) -> PuModel | None:
    """Learn from positives and unlabelled rows of ``docs``; None without positives."""
    importable_on_workers(docs.sparkSession)
    kinds, share = _drawn(docs, labels, id_col, text_col, label_col, sample)
    positive, negative, unlabelled = kinds["positive"], kinds["negative"], kinds["unlabelled"]
    if not len(positive):
        return None
    if not len(unlabelled):
        unlabelled = np.concatenate([positive, negative])
    model = train(positive, unlabelled, estimate_prior(positive, unlabelled))
    if len(negative):  # positives and negatives in the proportion that the labels have
        odds = share / (1 - share)
        p = _thinned(positive, round(len(negative) * odds))
        n = _thinned(negative, round(len(p) / odds))
        model = on_probability_scale(model, np.concatenate([p, n]), np.repeat([1.0, 0.0], [len(p), len(n)]))
    return model


def score(docs: DataFrame, model: PuModel | None, id_col: str = "doc_id", text_col: str = "text",
          accept: float = ACCEPT) -> DataFrame:
    """Every column of ``docs`` but the text, and ``score`` and ``predicted`` (1 from ``accept`` on). Narrow."""
    spark = docs.sparkSession
    importable_on_workers(spark)
    shared = spark.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in sliced(batches):
            texts = utf8(batch.column(1))
            x = np.stack([features(data or b"") for data in texts]) if texts else np.empty((0, N_FEATURES), np.float32)
            s = model.score(x) if model is not None else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(s.astype(np.float64)), pa.array((s >= accept).astype(np.int32))],
                ["doc_id", "score", "predicted"])

    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(tidied("quality", scored), f"doc_id {kind}, score double, predicted int")


def classify_quality(docs: DataFrame, labels: DataFrame, **names) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    out = score(docs, fit(docs, labels, **names))
    return out.withColumn("held_out", held_out(F.col("doc_id"))).select("doc_id", "held_out", "score", "predicted")


def keep_accepted(docs: DataFrame, labels: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with the columns of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))
    text = docs.columns.index("text")

    def flagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in sliced(batches):
            texts = utf8(batch.column(text))
            x = np.stack([features(data or b"") for data in texts])
            s = model.score(x) if model is not None else np.ones(len(x))
            yield batch.filter(pa.array(s >= accept))

    return docs.mapInArrow(tidied("quality", flagged), docs.schema)
