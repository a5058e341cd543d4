"""Quality classifier: a factorisation machine (operator 10).

score = sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]).
The bracket is the sum-of-squares identity: all pairwise interactions of a
document's features in time linear in their number. Features are hashed words
(logarithmic counts, unit length) and structure statistics of the text; the
size in bytes is the only metadata. Labels, language, source and id are not inputs.

The model is fitted on at most ``TRAIN_ROWS`` labelled rows (those whose hashed
id is smallest: the same rows on every run), whose features Spark computes.
Scoring is one narrow pass over all whole texts.

Defined cases: a null text scores as an empty one; labels that are null, or
whose document is absent, are not used; without any label of a kind every
score is the base rate (0.5 without labels); a null id counts as the empty
text for the fold; other columns are ignored here and kept by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import arrow_batches, stored
from claimlake.llm.textscan import Words, groups, utf8

#: At most so many labelled rows are used to fit the model.
TRAIN_ROWS = 10_000
#: Texts that one Arrow batch brings to a Python worker in training.
TRAIN_SLICE = 512
BUCKETS, RANK, EPOCHS, BATCH, RATE, DECAY, SEED = 4096, 8, 12, 128, 0.02, 1e-4, 5
THRESHOLD = 0.3
_STATS = 16
_CLASSES = {  # bytes by kind
    "upper": [*range(65, 91)], "digit": [*range(48, 58)], "stop": [33, 46, 63], "loud": [33], "bar": [124],
    "other": [c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,!?'|"], "wide": [*range(128, 192)], "line": [10],
}


def fold(id_col: str) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5


def _per_text(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return (sums[end] - sums[start]).astype(np.float64)


def statistics(words: Words) -> np.ndarray:
    """Structure statistics, a row of _STATS numbers of about unit size per text."""
    n, a, b = len(words.text_start), words.text_start, words.text_end
    size = np.maximum(b - a, 1)
    count = np.diff(words.first).astype(np.float64)
    per = np.maximum(count, 1)
    share = {}
    for kind, codes in _CLASSES.items():
        table = np.zeros(256, bool)
        table[codes] = True
        share[kind] = _per_text(table[words.body], a, b)
    order = np.lexsort((words.hash, words.doc))
    h, d = words.hash[order], words.doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(new)
    runs = np.diff(np.append(at, len(h)))
    most = np.zeros(n)
    np.maximum.at(most, d[at], runs)
    distinct = np.bincount(d[at], minlength=n)
    def again(k: int) -> np.ndarray:
        same = (words.hash[k:] == words.hash[:-k]) & (words.doc[k:] == words.doc[:-k])
        return np.bincount(words.doc[k:][same], minlength=n)
    stops = np.union1d(np.flatnonzero(words.body == 10), b)
    begins = np.union1d(a, np.flatnonzero(words.body == 10) + 1)[: len(stops)]
    line_of = np.searchsorted(b, begins)
    line = words.span_hash(begins, stops)
    pairs = np.unique(np.stack((line_of.astype(np.uint64), line)), axis=1)
    lines, own = np.bincount(line_of, minlength=n), np.bincount(pairs[0].astype(np.int64), minlength=n)
    first = words.body[words.start] if len(words.start) else np.zeros(0, np.uint8)
    capital = np.bincount(words.doc[(first >= 65) & (first <= 90)], minlength=n)
    letters = size - share["line"] - share["wide"]
    return np.stack([
        4 * share["upper"] / letters, 4 * share["digit"] / size, 10 * share["stop"] / per, 10 * share["loud"] / per, 5 * share["bar"] / per,
        20 * share["other"] / size, share["wide"] / size, 5 * share["line"] / per, capital / per, distinct / per, most / per,
        again(1) / per if len(words.hash) > 1 else np.zeros(n), again(2) / per if len(words.hash) > 2 else np.zeros(n),
        1 - own / np.maximum(lines, 1), size / per / 8, np.log1p(size) / 8,
    ], axis=1)


def features(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, value) triples; statistics are the features from BUCKETS on."""
    n = len(words.text_start)
    cell, count = np.unique(words.doc.astype(np.int64) * BUCKETS + (words.hash % np.uint64(BUCKETS)).astype(np.int64), return_counts=True)
    doc, value = cell // BUCKETS, np.log1p(count)
    value /= np.sqrt(np.maximum(np.bincount(doc, value * value, n), 1e-12))[doc]
    stats = statistics(words)
    return (np.concatenate((doc, np.repeat(np.arange(n), _STATS))),
            np.concatenate((cell % BUCKETS, np.tile(np.arange(BUCKETS, BUCKETS + _STATS), n))), np.concatenate((value, stats.ravel())))


@dataclass
class Model:
    w0: float
    w: np.ndarray
    v: np.ndarray

    def logits(self, doc: np.ndarray, feature: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        out = self.w0 + np.bincount(doc, self.w[feature] * value, n)
        for f in range(self.v.shape[1]):
            x = self.v[feature, f] * value
            out += 0.5 * (np.bincount(doc, x, n) ** 2 - np.bincount(doc, x * x, n))
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> Model:
    """Adam over mini-batches of (label, features, values); the seed fixes every step."""
    rate = np.mean([y for y, _, _ in rows]) if rows else 0.5
    size = BUCKETS + _STATS
    rng = np.random.default_rng(SEED)
    model = Model(0.0 if not rows else float(np.log(np.clip(rate, 1e-3, 0.999) / (1 - np.clip(rate, 1e-3, 0.999)))), np.zeros(size), np.zeros((size, RANK)))
    if rate in (0.0, 1.0) or not rows:
        return model
    model.v = rng.normal(0, 0.05, (size, RANK))
    flat = np.concatenate((model.w, model.v.ravel(), [model.w0]))
    m, s, step = np.zeros_like(flat), np.zeros_like(flat), 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), BATCH):
            batch = [rows[i] for i in order[at : at + BATCH]]
            y = np.array([b[0] for b in batch], float)
            n = len(batch)
            doc = np.repeat(np.arange(n), [len(b[1]) for b in batch])
            idx, val = np.concatenate([b[1] for b in batch]), np.concatenate([b[2] for b in batch])
            model = Model(flat[-1], flat[:size], flat[size:-1].reshape(size, RANK))
            error = (_sigmoid(model.logits(doc, idx, val, n)) - y) / n
            grad = DECAY * flat
            grad[-1] = error.sum()
            grad[:size] += np.bincount(idx, error[doc] * val, size)
            for f in range(RANK):
                x = model.v[idx, f] * val
                sums = np.bincount(doc, x, n)
                grad[size + f : -1 : RANK] += np.bincount(idx, error[doc] * val * (sums[doc] - x), size)
            step += 1
            m, s = 0.9 * m + 0.1 * grad, 0.999 * s + 0.001 * grad * grad
            flat = flat - RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return Model(float(flat[-1]), flat[:size], flat[size:-1].reshape(size, RANK))


def _scan(batch: pa.RecordBatch):
    body, ends = utf8(batch.column(batch.num_columns - 1))  # the text stands last
    for a, b in groups(np.diff(ends)):
        yield a, b, Words(body[ends[a] : ends[b]], ends[a : b + 1] - ends[a])


def _featurize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, words in _scan(batch):
            doc, feature, value = features(words)
            order = np.argsort(doc, kind="stable")
            cut = np.searchsorted(doc[order], np.arange(b - a + 1))
            parts = [order[cut[i] : cut[i + 1]] for i in range(b - a)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").slice(a, b - a), batch.column("label").slice(a, b - a), pa.array([feature[p].astype(np.int32) for p in parts], pa.list_(pa.int32())),
                 pa.array([value[p].astype(np.float32) for p in parts], pa.list_(pa.float32()))], ["id", "label", "features", "values"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """A model from a bounded sample of the labelled rows outside the held-out fold."""
    sample = labels.where((fold(id_col) != 0) & F.col(label).isNotNull()).select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("label"))
    sample = stored(sample.orderBy(F.xxhash64("id"), "id", "label").limit(TRAIN_ROWS), "training-labels")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(F.broadcast(sample), "id")
    id_type = dict(sample.dtypes)["id"]
    rows = rows.select("id", "label", "text").mapInArrow(_featurize, f"id {id_type}, label int, features array<int>, values array<float>")
    with arrow_batches(docs.sparkSession, TRAIN_SLICE):
        table = rows.orderBy(F.xxhash64("id"), "id", "label", F.size("features")).limit(TRAIN_ROWS).toArrow()
    lists = [table[c].combine_chunks() for c in ("features", "values")]
    # views of the Arrow buffers: lists of Python numbers would take several times the memory of the driver
    parts = [np.split(x.flatten().to_numpy(), np.cumsum(x.value_lengths().to_numpy())[:-1]) for x in lists]
    return fit(list(zip(table["label"].to_pylist(), *parts, strict=True)) if table.num_rows else [])


def score(docs: DataFrame, model: Model, columns: list[str], text: str = "text") -> DataFrame:
    """``columns`` of every document and its ``__score`` (0 to 1); only the text travels to Python."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            body, ends = utf8(texts)
            logits = [np.zeros(0)]
            for a, b in groups(np.diff(ends)):
                logits.append(model.logits(*features(Words(body[ends[a] : ends[b]], ends[a : b + 1] - ends[a])), b - a))
            yield pa.array(_sigmoid(np.concatenate(logits)))

    return docs.select(*columns, F.arrow_udf(run, "double")(F.col(text)).alias("__score"))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    scored = score(docs, train(docs, labels, id_col, text), [id_col], text)
    return scored.select(id_col, (fold(id_col) == 0).alias("held_out"), F.col("__score").alias("score"),
                         (F.col("__score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Whole rows of the documents that the classifier does not reject."""
    return score(docs, train(docs, labels, id_col, text), docs.columns, text).where(F.col("__score") >= THRESHOLD).drop("__score")
