"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positive examples, documents drawn without
regard to any label the unlabelled ones. A linear model of hashed words and
word beginnings is trained in numpy on the class-prior-corrected risk

    prior * E_P[loss(z)]  +  max(0, E_U[loss(-z)] - prior * E_P[loss(-z)])

with the logistic loss: while the second part, the risk on negatives, is below
zero, a step goes against it instead. The prior is the share of toxic documents
among labelled ones, or given. Words count by the square root of their window's
size, so that texts of all lengths are on one scale; a document's logit is the
mean of its windows' (``WINDOW`` words each, all of the text).

Training reads at most ``POSITIVES`` confirmed and ``UNLABELLED`` other documents
(the first by a hash of doc_id) and a window of each: these bounds are
parameters and do not grow with the corpus. Features that do not tell the two
samples apart by ``MIN_DEVIATIONS`` standard deviations are left out.

Defined results: a document that has any toxic label is confirmed; with no
confirmed document, or a prior of 0, every score is 0; texts without a word score as the bias
says; equal texts have equal scores; a null doc_id or label is not learned from; a repeated
row gets a row each; an empty table gives an empty result; other columns are
kept by ``without_toxic`` and not read by ``predict``.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from daybook.llm.common import arrow_map, kept_by_worker

WORDS = re.compile(r"[^\W\d_]+")
POSITIVES, UNLABELLED = 4000, 8000
WINDOW = 400
FEATURES = 1 << 18
#: Lengths of word beginnings, in characters.
BEGINNINGS = (3, 4, 5, 6)
MIN_DEVIATIONS = 4.0
#: Different words whose weights a worker keeps.
CACHED_WORDS = 300_000


def words_of(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def features_of(word: str) -> list[int]:
    """The hashed word and its beginnings."""
    return [zlib.crc32(f"{word}$".encode()) % FEATURES, *(zlib.crc32(word[:k].encode()) % FEATURES for k in BEGINNINGS if k <= len(word))]


class Model:
    """``bias`` and, by hashed feature, ``weights``; ``bias`` is None where nothing was learned."""

    def __init__(self, weights: np.ndarray, bias: float | None):
        self.weights, self.bias = weights.astype(np.float32), bias


class Samples:
    """Hashed counts of sampled windows in rows: ``feature``, ``value`` and ``row`` of what isn't zero."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]]):
        self.n = len(rows)
        none = np.zeros(0)
        self.feature = np.concatenate([none.astype(np.int64), *(f for f, _ in rows)])
        self.value = np.concatenate([none, *(v for _, v in rows)])
        self.row = np.repeat(np.arange(self.n), [len(f) for f, _ in rows])

    def share(self, size: int) -> np.ndarray:
        """In what share of rows a feature occurs."""
        return np.bincount(self.feature, minlength=size) / max(1, self.n)

    def only(self, names: np.ndarray) -> None:
        """Keep the features that have a name (not -1), under it."""
        new = names[self.feature]
        keep = new >= 0
        self.feature, self.value, self.row = new[keep], self.value[keep], self.row[keep]

    def logits(self, weights: np.ndarray, bias: float) -> np.ndarray:
        return np.bincount(self.row, weights[self.feature] * self.value, self.n) + bias

    def gradient(self, by_row: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.feature, by_row[self.row] * self.value, size)


def telling(positive: Samples, unlabelled: Samples, size: int, min_deviations: float) -> np.ndarray:
    """Features whose share of positive rows is off their share of unlabelled rows by more than chance."""
    p, u = positive.share(size), unlabelled.share(size)
    rate = np.clip(u, 1 / max(1, unlabelled.n), 0.999)
    return np.flatnonzero(np.abs(p - u) > min_deviations * np.sqrt(rate * (1 - rate) * (1 / positive.n + 1 / max(1, unlabelled.n))))


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def train(positive: list[tuple[np.ndarray, np.ndarray]], unlabelled: list[tuple[np.ndarray, np.ndarray]], prior: float, steps: int = 120, rate: float = 1.0, decay: float = 1e-5, min_deviations: float = MIN_DEVIATIONS) -> Model:
    """Minimise the non-negative risk by full-batch Adam; rows are (features, values)."""
    p, u = Samples(positive), Samples(unlabelled)
    full = np.zeros(FEATURES)
    if not p.n or not u.n or not 0 < prior < 1:
        return Model(full, None if not p.n or prior <= 0 else float(np.log(min(prior, 1 - 1e-9) / (1 - min(prior, 1 - 1e-9)))))
    used = telling(p, u, FEATURES, min_deviations)
    names = np.full(FEATURES, -1)
    names[used] = np.arange(len(used))
    p.only(names)
    u.only(names)
    x = np.append(np.zeros(len(used)), np.log(prior / (1 - prior)))  # the bias stands last
    m, v = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, steps + 1):
        zp, zu = p.logits(x[:-1], x[-1]), u.logits(x[:-1], x[-1])
        # gradients of both parts with respect to the logits; loss(z) = softplus(-z)
        on_negatives = softplus(zu).mean() - prior * softplus(zp).mean()
        gp, gu = -prior * sigmoid(zp) / p.n, sigmoid(zu) / u.n
        if on_negatives >= 0:
            gp -= prior * sigmoid(-zp) / p.n
        else:
            gp, gu = -gp, -gu
        g = np.append(p.gradient(gp, len(used)) + u.gradient(gu, len(used)) + decay * x[:-1], gp.sum() + gu.sum())
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        # slower and slower, so that steps against an overfitted risk settle
        x -= rate * (1 - 0.9 * step / steps) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-3)
    full[used] = x[:-1]
    return Model(full, float(x[-1]))


def is_held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _sampled_windows(docs: DataFrame, ids: DataFrame, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features and values of a window of each of at most ``most`` documents whose ids are in ``ids`` (as many at most)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text").join(F.broadcast(ids), "id")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        features, counts, sizes = [], [], []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = words_of(text)
            begin = zlib.crc32(b"%d" % doc_id) % max(1, len(words) - WINDOW + 1)
            words = words[begin : begin + WINDOW]
            found, n = np.unique(np.array([f for w in words for f in features_of(w)], np.int32), return_counts=True)
            features.append(found)
            counts.append(n.astype(np.int32))
            sizes.append(len(words))
        order = pa.array([zlib.crc32(text.encode()) for text in batch.column(1).cast(pa.string()).fill_null("").to_pylist()], pa.int64())
        kind = pa.list_(pa.int32())
        return pa.record_batch([batch.column(0), order, pa.array(features, kind), pa.array(counts, kind), pa.array(sizes, pa.int32())], names=["id", "text_order", "features", "counts", "size"])

    windows = arrow_map(rows, run, "id long, text_order long, features array<int>, counts array<int>, size int")
    # repeated ids: the bound holds all the same
    found = windows.orderBy(F.xxhash64("id"), "id", "text_order").limit(most).toArrow()
    out = []
    for chunk in found.to_batches():
        features, counts, sizes = chunk.column(2), chunk.column(3), chunk.column(4)
        for i in range(chunk.num_rows):
            out.append((features[i].values.to_numpy().astype(np.int64), counts[i].values.to_numpy() / np.sqrt(max(1, sizes[i].as_py()))))
    return out


def fit(docs: DataFrame, labels: DataFrame, prior: float | None = None, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """Learn from ``labels`` (doc_id, toxic) and texts of ``docs``, both without what is held out."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~is_held_out(F.col("doc_id"))).groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("toxic").alias("toxic"))
    first = lambda ids, n: ids.orderBy(F.xxhash64("id"), "id").limit(n)
    if prior is None:
        prior = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
    confirmed = first(known.filter("toxic = 1").select("id"), positives)
    others = docs.filter(F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id"))).select(F.col("doc_id").cast("long").alias("id"))
    drawn = first(others, unlabelled).distinct()
    return train(_sampled_windows(docs, confirmed, positives), _sampled_windows(docs, drawn, unlabelled), prior)


class Scorer:
    """Applies a model to texts; keeps the weights of words it has met."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def score(self, text: str | None) -> float:
        if self.model.bias is None:
            return 0.0
        words, known, weights = words_of(text), self.known, self.model.weights
        fresh = {w for w in words if w not in known}
        if fresh and len(known) + len(fresh) > CACHED_WORDS:
            known.clear()
            fresh = set(words)
        for w in fresh:
            known[w] = float(weights[features_of(w)].sum())
        of_word = np.array([known[w] for w in words])
        begin = np.arange(0, len(words), WINDOW)
        size = np.append(begin[1:], len(words)) - begin if len(begin) else begin
        logit = self.model.bias
        if len(words):
            logit += float((np.add.reduceat(of_word, begin) * np.sqrt(size)).sum() / len(words))
        return float(sigmoid(np.float64(logit)))


def _scorer(docs: DataFrame, model: Model) -> Callable[[], Scorer]:
    key, shared = f"toxicity model {uuid.uuid4().hex}", docs.sparkSession.sparkContext.broadcast(model)
    return lambda: kept_by_worker(key, lambda: Scorer(shared.value))


def predict(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """Per document: ``doc_id, score, predicted`` (1 from ``threshold`` on)."""
    schema = StructType([StructField("doc_id", LongType()), StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    scorer = _scorer(docs, model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = [scorer().score(t) for t in batch.column(1).to_pylist()]
        return pa.record_batch([batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())], names=schema.names)

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, schema)


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``; all columns stay."""
    scorer, text_at = _scorer(docs, model), docs.columns.index("text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array([scorer().score(t) < threshold for t in batch.column(text_at).to_pylist()], pa.bool_()))

    return arrow_map(docs, run, docs.schema)
