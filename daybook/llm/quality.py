"""Text quality by a generalised additive model with pairwise interactions.

Each text becomes a few numbers (shares of symbols, capitals, repeats and so on), each number a bin.
Cyclic boosting visits the features in turn and adds a shallow tree, fitted to the gradient of the
log-loss over the feature's bins, to that feature's lookup table. The strongest pairs of features
then get tables of their own in the same way. A score is the sum of one table entry for each feature
and pair, put through the logistic function; whole batches are scored by array look-ups.

The fit uses about MOST_LABELLED labelled rows (all, if fewer), chosen by a hash of their id. Null
texts are scored as empty ones; very long texts are read whole. Ids labelled more than once count with
their largest label; rows that repeat an id are learned from as often as they stand there and are all
scored; null labels and ids are not learned from. Of equally good cuts a tree takes the first. Without
labels every score is 0.5; empty tables give no rows. A column named like the score is replaced; others
are left alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import hash_share, held_out, small_parts, table

MOST_LABELLED = 20_000
BINS, PAIR_BINS, PAIRS = 48, 12, 8
ROUNDS, PAIR_ROUNDS, RATE, DEPTH = 120, 60, 0.12, 2
THRESHOLD = 0.3

FEATURES = ("bytes", "words", "word_bytes", "distinct", "repeated_next", "upper", "digits", "symbols", "stops", "bars", "spaces", "high_bytes", "lines", "repeated_lines", "symbol_words", "upper_words", "letters")
_KINDS = np.zeros(256, np.int64)
for _k, _chars in enumerate(("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "!#$%&*+/<=>@[\\]^_`{}~", ".,;:?", "|", " \t\r\n\v\f", "abcdefghijklmnopqrstuvwxyz"), 1):
    _KINDS[[ord(c) for c in _chars]] = _k
_KINDS[128:] = 8
_END = re.compile(rb"[!#$%&*+/<=>@^_~]+(?=\s|$)")
_CAPITALS = re.compile(rb"\b[A-Z][A-Z]+\b")


def features(text: str) -> list[float]:
    """The numbers for one text, in the order of FEATURES."""
    raw = text.encode("utf-8", "replace")
    words, lines = raw.split(), raw.split(b"\n")
    kinds = np.bincount(_KINDS, weights=np.bincount(np.frombuffer(raw, np.uint8), minlength=256), minlength=9)
    n, w = max(1, len(raw)), max(1, len(words))
    filled = [x for x in lines if x.strip()]
    return [
        np.log1p(len(raw)), np.log1p(len(words)), float(n - kinds[6]) / w, len(set(words)) / w, sum(map(eq, words, words[1:])) / w,
        kinds[1] / n, kinds[2] / n, kinds[3] / n, kinds[4] / w, kinds[5] / w, kinds[6] / n, kinds[8] / n,
        len(lines) / w, 1 - len(set(filled)) / max(1, len(filled)), len(_END.findall(raw)) / w, len(_CAPITALS.findall(raw)) / w, (kinds[1] + kinds[7] + kinds[8]) / n,
    ]


def feature_matrix(texts: list[str | None]) -> np.ndarray:
    return np.array([features(t or "") for t in texts], float).reshape(len(texts), len(FEATURES))


@dataclass
class Model:
    edges: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)  # bin -> coarse bin, for pairs
    intercept: float = 0.0
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], 1) if self.edges else np.zeros((len(x), 0), int)

    def scores(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        z = np.full(len(x), self.intercept)
        for j, t in enumerate(self.tables):
            z += t[b[:, j]]
        for (i, j), t in self.pairs.items():
            z += t[self.coarse[i][b[:, i]], self.coarse[j][b[:, j]]]
        return 1 / (1 + np.exp(-z))


def _leaf(g: np.ndarray, h: np.ndarray) -> float:
    return g.sum() / (h.sum() + 1.0)


def _gain(g, h):
    return g * g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """A tree over ordered bins with gradient sums g and curvature sums h: one value for each bin."""
    out = np.full(len(g), _leaf(g, h))
    if depth and len(g) > 1:
        left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gain = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
        gain[(left_h < 1) | (h.sum() - left_h < 1)] = 0
        at = int(gain.argmax()) + 1
        if gain[at - 1] > 1e-6:
            out[:at], out[at:] = _tree(g[:at], h[:at], depth - 1), _tree(g[at:], h[at:], depth - 1)
    return out


def _cross(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """The best cut in two directions of a table of bins: values of its four quarters, and the gain."""
    best, out = 0.0, np.full(g.shape, _leaf(g, h))
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    if min(g.shape) > 1:
        def quarters(c):
            a, row, col, all_ = c[:-1, :-1], c[:-1, -1:], c[-1:, :-1], c[-1, -1]
            return a, row - a, col - a, all_ - row - col + a

        gain = sum(_gain(x, y) for x, y in zip(quarters(cg), quarters(ch))) - _gain(g.sum(), h.sum())
        i, j = np.unravel_index(gain.argmax(), gain.shape)
        best = float(gain[i, j])
        for rows in (slice(None, i + 1), slice(i + 1, None)):
            for cols in (slice(None, j + 1), slice(j + 1, None)):
                out[rows, cols] = _leaf(g[rows, cols], h[rows, cols])
    return out, best


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """x: one row of features for each text; y: labels 0 or 1."""
    model = Model()
    if not len(x) or y.min() == y.max():
        if len(x):
            p = (y.sum() + 1) / (len(y) + 2)
            model.intercept = float(np.log(p / (1 - p)))
        return model
    for j in range(x.shape[1]):
        model.edges.append(np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])))
        n = len(model.edges[j]) + 1
        model.coarse.append(np.arange(n) * PAIR_BINS // max(n, PAIR_BINS))
        model.tables.append(np.zeros(n))
    model.intercept = float(np.log(y.mean() / (1 - y.mean())))
    b = model.bins(x)
    z = np.full(len(y), model.intercept)
    for _ in range(ROUNDS):
        for j, t in enumerate(model.tables):
            p = 1 / (1 + np.exp(-z))
            step = RATE * _tree(np.bincount(b[:, j], y - p, len(t)), np.bincount(b[:, j], p * (1 - p), len(t)), DEPTH)
            t += step
            z += step[b[:, j]]
    c = np.stack([model.coarse[j][b[:, j]] for j in range(x.shape[1])], 1)
    sizes = [int(q.max()) + 1 for q in model.coarse]

    def sums(i: int, j: int):
        p = 1 / (1 + np.exp(-z))
        at = c[:, i] * sizes[j] + c[:, j]
        return tuple(np.bincount(at, v, sizes[i] * sizes[j]).reshape(sizes[i], sizes[j]) for v in (y - p, p * (1 - p)))

    found = sorted(((_cross(*sums(i, j))[1], i, j) for i in range(x.shape[1]) for j in range(i)), reverse=True)[:PAIRS]
    model.pairs = {(i, j): np.zeros((sizes[i], sizes[j])) for gain, i, j in found if gain > 1}
    for _ in range(PAIR_ROUNDS):
        for (i, j), t in model.pairs.items():
            step = RATE * _cross(*sums(i, j))[0]
            t += step
            z += step[c[:, i], c[:, j]]
    return model


def _vectors(df: DataFrame, text: str, name: str) -> DataFrame:
    """Appends the features as an array."""
    at = df.columns.index(text)

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_parts(batches):
            values = feature_matrix(batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(values), pa.list_(pa.float64()))], names=[*batch.schema.names, name])

    from pyspark.sql.types import ArrayType

    return df.mapInArrow(per_batch, StructType([*df.schema.fields, StructField(name, ArrayType(DoubleType()))]))


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", text: str = "text", most: int = MOST_LABELLED) -> Model:
    """Fits the model to the documents that labels has a 0 or 1 for."""
    known = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("doc_id")).agg(F.max(label).cast("int").alias("y"))
    chosen = known.filter(hash_share("doc_id", known.count(), most))
    # About `most` rows of two numbers: small, whatever the size of docs.
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id").select("y", "text")
    seen = _vectors(rows, "text", "x").select("y", "x").toPandas()
    x, y = np.array(seen["x"].tolist(), float).reshape(len(seen), len(FEATURES)), seen["y"].to_numpy(float)
    order = np.lexsort([y, *x.T[::-1]])  # sums do not depend on the order that rows come in
    return fit(x[order], y[order])


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score", keep_text: bool = True) -> DataFrame:
    """Appends the score (0 to 1) to docs; a column of that name is replaced. Without keep_text the texts do not come back."""
    docs = docs.drop(name)
    at = docs.columns.index(text)
    fields = [f for f in docs.schema.fields if keep_text or f.name != text]
    keep = [docs.columns.index(f.name) for f in fields]

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_parts(batches):
            found = model.scores(feature_matrix(batch.column(at).to_pylist()))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(found, pa.float64())], names=[*(f.name for f in fields), name])

    return docs.mapInArrow(per_batch, StructType([*fields, StructField(name, DoubleType())]))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(docs, table(spark, sf_dir, "labels").filter(~held_out()))
    out = score(docs.withColumn("held_out", held_out()), model, keep_text=False)
    return out.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
