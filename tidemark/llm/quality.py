"""A quality classifier learned from positives and unlabelled text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.text import apart, documents, raw, sliced

_CLASSES = np.zeros(256, np.int64)
for _n, _bytes in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" ", b"\n", b"\t\r\v\f", bytes(range(128, 256)))):
    _CLASSES[list(_bytes)] = _n + 1
_MARKS = [i for i in range(33, 127) if not chr(i).isalnum()]
_MARK = np.zeros(256, bool)
_MARK[_MARKS] = True


def features(text: bytes) -> np.ndarray:
    """Shares of characters, words and lines of a whole text, on a log scale where they spread over decades."""
    at = np.frombuffer(text, np.uint8)
    words, lines = text.split(), text.split(b"\n")
    size, count = max(len(at), 1), max(len(words), 1)
    hist = np.bincount(at, minlength=256)
    shares = np.bincount(_CLASSES, weights=hist, minlength=8) / size
    doubled = at[1:][(at[1:] == at[:-1]) & _MARK[at[1:]]].size / size
    lengths = np.fromiter(map(len, words), np.float64, len(words))
    full = [x for x in lines if x.strip()]
    rows = max(len(full), 1)
    other = np.array([
        hist[_MARKS].sum() / size,
        doubled,
        len(set(words)) / count,
        len(set(full)) / rows,
        sum(w.isupper() for w in words) / count,
        sum(not w.isalpha() for w in words) / count,
        (lengths > 20).sum() / count,
        (lengths == 1).sum() / count,
    ])
    scale = np.log([len(text) + 1.0, len(words) + 1.0, lengths.mean() + 1 if len(words) else 1.0, size / rows, rows])
    return np.concatenate([np.log(shares + 1e-3), np.log(hist[_MARKS] / size + 1e-3), np.log(other + 1e-3), scale])


@dataclass
class Model:
    """One hidden layer over standardized features; the score is a probability under the class prior."""

    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.tanh(np.clip((x - self.mean) / self.scale, -6, 6) @ w1 + b1) @ w2 + b2[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -40, 40)))


def fit_pu(positive: np.ndarray, unlabelled: np.ndarray, prior: float, hidden: int = 16, steps: int = 600, batch: int = 2048, rate: float = 0.01, decay: float = 1e-4, seed: int = 7) -> Model:
    """Minimise the non-negative unbiased risk (Kiryo et al. 2017) with logistic loss.

    Risk: prior * E_pos[loss(+)] + max(0, E_unl[loss(-)] - prior * E_pos[loss(-)]).
    Where a batch makes the second part negative, the step goes against it
    instead, which keeps the model from fitting the unlabelled rows by heart.
    """
    both = np.concatenate([positive, unlabelled])
    model = Model(both.mean(0), both.std(0) + 1e-6, [])
    shaped = lambda x: np.clip((x - model.mean) / model.scale, -6, 6)
    positive, unlabelled = shaped(positive), shaped(unlabelled)
    draw = np.random.default_rng(seed)
    w = [draw.normal(0, 1 / np.sqrt(both.shape[1]), (both.shape[1], hidden)), np.zeros(hidden), draw.normal(0, 1 / np.sqrt(hidden), hidden), np.array([np.log(prior / (1 - prior))])]
    first, second = [np.zeros_like(v) for v in w], [np.zeros_like(v) for v in w]
    mean = [np.zeros_like(v) for v in w]
    for step in range(1, steps + 1):
        p = positive[draw.integers(0, len(positive), batch)]
        u = unlabelled[draw.integers(0, len(unlabelled), batch)]
        x = np.concatenate([p, u])
        h = np.tanh(x @ w[0] + w[1])
        f = h @ w[2] + w[3][0]
        s = 1 / (1 + np.exp(-np.clip(f, -40, 40)))
        loss_minus = np.logaddexp(0, f)
        negative = loss_minus[batch:].mean() - prior * loss_minus[:batch].mean()
        # Derivatives by f: of loss(+) s - 1, of loss(-) s.
        push = np.concatenate([-prior * s[:batch], s[batch:]]) / batch
        if negative < 0:
            g = -push
        else:
            g = push
            g[:batch] += prior * (s[:batch] - 1) / batch
        back = np.outer(g, w[2]) * (1 - h * h)
        grads = [x.T @ back + decay * w[0], back.sum(0), h.T @ g + decay * w[2], np.array([g.sum()])]
        for i, v in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * v
            second[i] = 0.999 * second[i] + 0.001 * v * v
            lift = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            w[i] = w[i] - lift * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
            if step > steps // 2:
                mean[i] = mean[i] + w[i] / (steps - steps // 2)
    model.weights = mean
    return model


def held_out() -> F.Column:
    """True for the fifth of the documents, by checksum of doc_id, that no label is learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, bound: int = 20_000) -> Model:
    """Fit on about bound trusted positives (quality 1) and about bound documents taken as unlabelled.

    Both samples are drawn by hash from the rows outside the held-out fold, so the
    fit costs the same for any table; bound is the only limit, and the positives'
    ids, bounded by it, are broadcast. The class prior is the share of quality 1
    among all labels outside the fold, which rest on a random part of the
    documents. Null labels and null ids are left out; of repeated labels the mean
    counts. Without a positive label every document scores the prior 0.5.
    """
    known = labels.filter("doc_id is not null and quality is not null").filter(~held_out())
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg((F.avg("quality") >= 0.5).alias("good"))
    total, good = known.agg(F.count("*"), F.coalesce(F.sum(F.col("good").cast("bigint")), F.lit(0))).first()
    unit = lambda seed: F.expr(f"pmod(xxhash64({seed}, doc_id), 1000000) / 1000000D")
    size = docs.count()
    width = len(features(b""))
    if not good or not size:
        return Model(np.zeros(width), np.ones(width), [np.zeros((width, 1)), np.zeros(1), np.zeros(1), np.zeros(1)])
    sample = F.broadcast(known.filter("good").filter(unit(1) < bound / good).select("doc_id", F.lit(True).alias("trusted")))
    rows = documents(docs.filter(~held_out()))
    rows = rows.join(sample, "doc_id", "left").select("doc_id", "text", F.coalesce("trusted", F.lit(False)).alias("trusted"), (unit(2) < bound / size).alias("drawn"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            made = [features(x).astype(np.float32).tobytes() for x in raw(batch.column("text"))]
            yield pa.record_batch([batch.column("doc_id"), batch.column("trusted"), batch.column("drawn"), pa.array(made, pa.binary())], ["doc_id", "trusted", "drawn", "x"])

    found = rows.filter("trusted or drawn").mapInArrow(work, "doc_id bigint, trusted boolean, drawn boolean, x binary").collect()
    found.sort(key=lambda r: (r.doc_id is None, r.doc_id or 0, bytes(r.x)))
    x = np.array([np.frombuffer(r.x, np.float32) for r in found], np.float64).reshape(len(found), width)
    trusted, drawn = (np.array([r[c] for r in found], bool) for c in ("trusted", "drawn"))
    if not trusted.any() or not drawn.any():
        return Model(np.zeros(width), np.ones(width), [np.zeros((width, 1)), np.zeros(1), np.zeros(1), np.zeros(1)])
    prior = min(max(good / total, 0.05), 0.98)
    return fit_pu(x[trusted], x[drawn], prior)


def scored(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """docs with the score of every whole text (null: empty), 0 to 1, higher for quality 1. Nothing but the text is read for it."""
    plain = docs.drop(name)
    schema = T.StructType([*plain.schema.fields, T.StructField(name, T.DoubleType(), False)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            x = np.array([features(t or b"") for t in raw(batch.column("text"))])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.scores(x))], [*batch.schema.names, name])

    return plain.mapInArrow(work, schema)


@apart
def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of docs whose text scores at least threshold, with their columns."""
    name = "quality_score"
    return scored(docs, learn(docs, labels), name).filter(F.col(name) >= threshold).select(docs.columns)
