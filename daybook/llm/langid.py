"""Language identification with a linear-chain conditional random field.

Words are labelled with languages. Emissions add the weights of a word's
affixes, inner n-grams, itself and its place in the learned lexicon of each
language; learned transitions tie neighbouring words, so a text that switches
language is labelled piece by piece. Forward-backward gives each word's
marginals; a document's language is the one with the largest mean marginal, and
that mean is its score.

Training reads at most ``ROWS_PER_LABEL`` rows of every language (the first by a
hash of doc_id, so that every labelled doc_id has the same chance) and of each a
window of ``TRAIN_WORDS`` words: that bound is a parameter and does not grow with
the corpus. Every label is learned, however many there are. Every third training sequence is spliced from two languages, so that
switches are seen. Only ``text`` is an input of a prediction. Prediction reads
whole texts; chains are windows of ``CHAIN_WORDS`` words, all of which count.

Defined results: null text or text without a letter is ``und`` with score 0;
with no labelled row every document is ``und``; equal texts have equal results;
a null doc_id is not learned from and not held out; other columns are not read.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from daybook.llm.common import arrow_map, beside, kept_by_worker

UNKNOWN = "und"
WORDS = re.compile(r"[^\W\d_]+")
ROWS_PER_LABEL = 400
TRAIN_WORDS = 120
CHAIN_WORDS = 128
#: Steps of the scale on which rows are drawn.
PLACES = 1 << 40
FEATURE_BITS = 17
FEATURES = 1 << FEATURE_BITS
LEXICON_WORDS = 200
#: Words whose emissions a worker keeps, words whose chains are settled at once, and new words that are featurised at once.
CACHED_WORDS, SETTLED_WORDS, FEATURISED_WORDS = 50_000, 20_000, 5_000


def words_of(text: str | None) -> list[str]:
    return [w for w in WORDS.findall((text or "").lower()) if w.isalpha() or any(c.isalpha() for c in w)]


def feature_table(words: list[str], lexicon: dict[str, list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of the words and the word each belongs to.

    The n-grams of 2 to 4 bytes of the bracketed word are affixes where they
    hold a bracket and inner n-grams where they don't; the word itself and the
    lexicons that hold it come on top.
    """
    data = np.frombuffer(f"^{'$^'.join(words)}$".encode(), dtype=np.uint8)
    word_at = np.cumsum(data == ord("^")) - 1
    code, features, owners = data.astype(np.uint64), [], []
    for n in (2, 3, 4):
        code = code[:-1] * np.uint64(257) + data[n - 1 :]
        inside = np.flatnonzero(word_at[: len(code)] == word_at[n - 1 :])
        mixed = (code[inside] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        features.append((mixed >> np.uint64(64 - FEATURE_BITS)).astype(np.int64))
        owners.append(word_at[inside])
    features.append(np.array([zlib.crc32(w.encode()) % FEATURES for w in words], dtype=np.int64))
    owners.append(np.arange(len(words)))
    known = [(i, k) for i, w in enumerate(words) if w in lexicon for k in lexicon[w]]
    features.append(np.array([zlib.crc32(b"#%d" % k) % FEATURES for _, k in known], dtype=np.int64))
    owners.append(np.array([i for i, _ in known], dtype=np.int64))
    return np.concatenate(features), np.concatenate(owners)


def sum_by(owners: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Rows of ``values`` summed by owner."""
    return np.stack([np.bincount(owners, values[:, y], n) for y in range(values.shape[1])], axis=1)


def marginals(emissions: np.ndarray, transitions: np.ndarray, mask: np.ndarray, want_pairs: bool = False):
    """Forward-backward over padded chains (chain, place, label); with pairs, also their expected counts and log Z."""
    n, t, k = emissions.shape
    top = emissions.max(axis=2, keepdims=True)
    psi = np.where(mask[:, :, None], np.exp(emissions - top), 1.0)
    step = np.exp(transitions)
    alpha, beta = np.empty_like(psi), np.ones_like(psi)
    scale = np.ones((n, t))
    alpha[:, 0] = psi[:, 0]
    scale[:, 0] = alpha[:, 0].sum(axis=1)
    alpha[:, 0] /= scale[:, 0, None]
    for i in range(1, t):
        a = (alpha[:, i - 1] @ step) * psi[:, i]
        s = a.sum(axis=1)
        m = mask[:, i]
        scale[:, i] = np.where(m, s, 1.0)
        alpha[:, i] = np.where(m[:, None], a / s[:, None], alpha[:, i - 1])
    for i in range(t - 2, -1, -1):
        b = (psi[:, i + 1] * beta[:, i + 1]) @ step.T
        beta[:, i] = np.where(mask[:, i + 1][:, None], b / scale[:, i + 1][:, None], 1.0)
    post = alpha * beta
    post /= post.sum(axis=2, keepdims=True)
    if not want_pairs:
        return post
    pairs = np.zeros((k, k))
    for i in range(1, t):
        m = mask[:, i]
        if m.any():
            pairs += step * (alpha[m, i - 1].T @ (psi[m, i] * beta[m, i] / scale[m, i][:, None]))
    log_z = (np.log(scale) * mask).sum() + (top[:, :, 0] * mask).sum()
    return post, pairs, log_z


class Model:
    def __init__(self, labels: list[str], lexicon: dict[str, list[int]], weights: np.ndarray, transitions: np.ndarray):
        self.labels, self.lexicon, self.weights, self.transitions = labels, lexicon, weights, transitions

    def emissions(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros((0, len(self.labels)), dtype=np.float32)
        out = np.empty((len(words), len(self.labels)), dtype=np.float32)
        for a in range(0, len(words), FEATURISED_WORDS):
            part = words[a : a + FEATURISED_WORDS]
            features, owners = feature_table(part, self.lexicon)
            out[a : a + len(part)] = sum_by(owners, self.weights[features], len(part))
        return out


def learn_lexicon(texts: list[list[str]], labels: list[int], n_labels: int, size: int) -> dict[str, list[int]]:
    """The most frequent words of each language."""
    from collections import Counter

    counts = [Counter() for _ in range(n_labels)]
    for words, y in zip(texts, labels, strict=True):
        counts[y].update(words)
    lexicon: dict[str, list[int]] = {}
    for y, c in enumerate(counts):
        for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:size]:
            lexicon.setdefault(w, []).append(y)
    return lexicon


def train(texts: list[list[str]], tags: list[str], steps: int = 40, rate: float = 0.15, decay: float = 1e-4, seed: int = 3) -> Model:
    """Fit emissions and transitions by full-batch Adam on the conditional likelihood."""
    labels = sorted(set(tags))
    k = len(labels)
    y_of = [labels.index(t) for t in tags]
    lexicon = learn_lexicon(texts, y_of, k, LEXICON_WORDS)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    chains: list[tuple[list[str], list[int]]] = []
    for j, i in enumerate(order):
        words, ys = texts[i], [y_of[i]] * len(texts[i])
        if j % 3 == 2:
            other = order[rng.integers(len(order))]
            a, b = len(words) // 2, len(texts[other]) // 2
            words, ys = words[:a] + texts[other][b:], ys[:a] + [y_of[other]] * (len(texts[other]) - b)
        for s in range(0, len(words), 40):
            chains.append((words[s : s + 40], ys[s : s + 40]))
    vocabulary = {w: i for i, w in enumerate(sorted({w for c, _ in chains for w in c}))}
    features, owners = feature_table(list(vocabulary), lexicon)
    n, t = len(chains), max(len(c) for c, _ in chains)
    ids, gold, mask = np.zeros((n, t), dtype=np.int64), np.zeros((n, t), dtype=np.int64), np.zeros((n, t), dtype=bool)
    for i, (words, ys) in enumerate(chains):
        ids[i, : len(words)] = [vocabulary[w] for w in words]
        gold[i, : len(words)] = ys
        mask[i, : len(words)] = True
    used, compact = np.unique(features, return_inverse=True)
    weights, trans = np.zeros((len(used), k)), np.zeros((k, k))
    m1, v1, m2, v2 = np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(trans), np.zeros_like(trans)
    both = mask[:, 1:] & mask[:, :-1]
    seen = np.zeros((k, k))
    np.add.at(seen, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    total = mask.sum()
    for step in range(1, steps + 1):
        by_word = sum_by(owners, weights[compact], len(vocabulary))
        post, pairs, _ = marginals(by_word[ids], trans, mask, want_pairs=True)
        diff = -post
        diff[np.arange(n)[:, None], np.arange(t)[None, :], gold] += 1
        diff *= mask[:, :, None]
        word_diff = sum_by(ids.ravel(), diff.reshape(-1, k), len(vocabulary))
        grad = sum_by(compact, word_diff[owners], len(used)) / total - decay * weights
        grad_t = (seen - pairs) / total - decay * trans
        for w, g, m, v in ((weights, grad, m1, v1), (trans, grad_t, m2, v2)):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    full = np.zeros((FEATURES, k), dtype=np.float32)
    full[used] = weights
    return Model(labels, lexicon, full, trans)


class Predictor:
    """Applies a model to texts; keeps the emissions of words it has met."""

    def __init__(self, model: Model):
        self.model = model
        self.index: dict[str, int] = {}
        self.table = np.zeros((0, len(model.labels)), dtype=np.float32)

    def lookup(self, words: list[str]) -> np.ndarray:
        """A row per word; the first ``CACHED_WORDS`` different words met are kept, frequent ones among them."""
        index, kept = self.index, len(self.index)
        fresh = {w: kept + i for i, w in enumerate(w for w in dict.fromkeys(words) if w not in index)}
        rows = np.concatenate([self.table, self.model.emissions(list(fresh))]) if fresh else self.table
        found = rows[[index[w] if w in index else fresh[w] for w in words]]
        if fresh and kept < CACHED_WORDS:
            index.update(fresh)
            self.table = rows
        return found

    def label_sums(self, texts: list[list[str]]) -> np.ndarray:
        """Summed marginals of each text's words."""
        k = len(self.model.labels)
        out = np.zeros((len(texts), k))
        flat = self.lookup([w for words in texts for w in words])
        owner, begin, length, at = [], [], [], 0
        for i, words in enumerate(texts):
            for s in range(0, len(words), CHAIN_WORDS):
                owner.append(i)
                begin.append(at + s)
                length.append(min(CHAIN_WORDS, len(words) - s))
            at += len(words)
        if not owner:
            return out
        owner, begin, length = np.array(owner), np.array(begin), np.array(length)
        order = np.argsort(length, kind="stable")
        for part in np.array_split(order, max(1, len(order) // 1024)):
            t = int(length[part].max())
            mask = np.arange(t)[None, :] < length[part][:, None]
            rows = np.minimum(begin[part][:, None] + np.arange(t)[None, :], len(flat) - 1)
            post = marginals(flat[rows].astype(np.float64), self.model.transitions, mask) * mask[:, :, None]
            np.add.at(out, owner[part], post.sum(axis=1))
        return out

    def predict(self, texts: list[str | None], words_at_once: int = SETTLED_WORDS) -> tuple[list[str], list[float]]:
        langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.model.labels:
            return langs, scores
        held: list[tuple[int, list[str]]] = []
        size = 0

        def settle() -> None:
            sums = self.label_sums([w for _, w in held])
            for (i, words), row in zip(held, sums, strict=True):
                if words:
                    best = int(row.argmax())
                    langs[i], scores[i] = self.model.labels[best], min(1.0, float(row[best] / len(words)))
            held.clear()

        for i, text in enumerate(texts):
            words = words_of(text)
            held.append((i, words))
            size += len(words)
            if size >= words_at_once:
                settle()
                size = 0
        settle()
        return langs, scores


def training_rows(docs: DataFrame, rows_per_label: int = ROWS_PER_LABEL, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> list[tuple[str, str]]:
    """``label, window of the text`` of at most ``rows_per_label`` rows of each label, of those not held out."""
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(text_col).alias("text"))
    rows = rows.filter(~is_held_out(F.col("id")) & F.col("id").isNotNull() & F.col("label").isNotNull() & (F.btrim("text") != ""))
    place = F.pmod(F.xxhash64("id"), F.lit(PLACES))
    counts = rows.groupBy("label").agg(F.count("*").alias("count"), F.min(place).alias("least")).collect()
    if not counts:
        return []
    # some more than are wanted, by chance, and one at least; of these the first by the same hash
    bounds = [(c["label"], max(c["least"], min(PLACES, int(PLACES * 4 * rows_per_label / c["count"])))) for c in counts]
    drawn = rows.withColumn("place", place).join(F.broadcast(docs.sparkSession.createDataFrame(bounds, "label string, bound long")), "label").filter("place <= bound")
    parts = F.split("text", r"\s+")
    first = F.pmod(F.xxhash64(F.col("id"), F.lit(1)), F.greatest(F.size("parts") - TRAIN_WORDS, F.lit(0)) + 1) + 1
    windows = drawn.select("label", "id", "place", parts.alias("parts")).select("label", "id", "place", F.array_join(F.slice("parts", first.cast("int"), F.lit(TRAIN_WORDS)), " ").alias("window"))
    ranked = windows.withColumn("rank", F.row_number().over(Window.partitionBy("label").orderBy("place", "id", "window"))).filter(F.col("rank") <= rows_per_label)
    return [(r["label"], r["window"]) for r in sorted(ranked.collect(), key=lambda r: (r["label"], r["id"], r["window"]))]


def is_held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, rows_per_label: int = ROWS_PER_LABEL, **columns: str) -> Model:
    sample = [(label, words_of(window)) for label, window in training_rows(docs, rows_per_label, **columns)]
    sample = [(label, words) for label, words in sample if words]
    if not sample:
        return Model([], {}, np.zeros((FEATURES, 0), dtype=np.float32), np.zeros((0, 0)))
    return train([w for _, w in sample], [y for y, _ in sample])


def _predictor(docs: DataFrame, model: Model) -> Callable[[], Predictor]:
    """What gives a worker its predictor of the model."""
    key, shared = f"language model {uuid.uuid4().hex}", docs.sparkSession.sparkContext.broadcast(model)
    return lambda: kept_by_worker(key, lambda: Predictor(shared.value))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Per document: ``doc_id, lang_pred, score`` and the columns in ``keep``, of which those with one of these names get ``_given`` behind it."""
    kept_as = [F.col(c).alias(beside(c, ("doc_id", "lang_pred", "score"), keep)) for c in keep]
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *kept_as)
    schema = StructType([rows.schema["doc_id"], *rows.schema.fields[2:], StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    predictor = _predictor(docs, model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, scores = predictor().predict(batch.column(1).to_pylist())
        return pa.record_batch([batch.column(0), *batch.columns[2:], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=schema.names)

    return arrow_map(rows, run, schema)


def accepted(docs: DataFrame, model: Model, min_score: float = 0.4, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is known with a score of ``min_score`` at least; all columns stay."""
    predictor = _predictor(docs, model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, scores = predictor().predict(batch.column(batch.schema.get_field_index(text_col)).to_pylist())
        return batch.filter(pa.array([y != UNKNOWN and s >= min_score for y, s in zip(langs, scores, strict=True)], pa.bool_()))

    return arrow_map(docs, run, docs.schema)
