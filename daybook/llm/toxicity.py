"""Toxicity by a classifier chain of linear models over terms.

The categories are predicted one after the other. Each category's model is a logistic regression on the
terms of a bounded vocabulary, which are words and beginnings of words (so that inflected words count,
whatever their endings); besides terms it sees the probabilities of the categories before it. In training
these are out-of-fold predictions, so that a later model never learns from a probability that an earlier
one fitted to the same row.

The tables label one category, `toxic`. The two before it in the chain are kinds of toxic texts: the toxic texts of the fit
fall into two clusters (spherical k-means over their terms, the larger one first), and a text is of a kind if it is in that cluster; texts that are not
toxic are of no kind. A text is marked toxic if the last probability reaches the threshold.

Vocabulary: the terms whose presence differs most between the labels, by chi-square over the labelled
texts of the fit, among those in LEAST_TEXTS texts or more; the fit takes about MOST_LABELLED rows (all,
if fewer). A fold is a share of the texts by their hash, so that copies are in one. Every fold has a vocabulary of its own, of the
other folds' texts: models that predict a fold see only that one's terms. The threshold is the one that does best (by F1)
on texts of which nothing was known: for each fold, vocabulary, clusters and a whole chain are learned from the others.

Null texts are empty texts. Very long texts are read whole. Ids labelled more than once count
with their largest label; rows that repeat an id are learned from as often as they stand there and are all
rated; null labels and ids are not learned from. A probability equal to the threshold is toxic; of
equally good thresholds the lowest counts, of equally telling terms the first in the order of bytes.
Without labels all probabilities are 0.5 and nothing is marked. Columns named like the new ones are
replaced; others are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import hash_share, held_out, removed, small_parts, table, written

MOST_LABELLED, VOCABULARY, FOLDS = 20_000, 500, 5
#: Terms in fewer texts of the fit are not in the vocabulary; steps of the clustering.
LEAST_TEXTS, CLUSTER_STEPS = 3, 20
#: Bytes of the beginnings of words that are terms beside the words.
BEGINNINGS = (5, 7)
TARGET = "toxic"
CHAIN = ("abuse_1", "abuse_2", TARGET)
#: ASCII apart from letters and digits parts words; bytes of other characters stay.
_APART = bytes(i if i > 127 or chr(i).isalnum() else 32 for i in range(256))


def words(text: str | None) -> list[bytes]:
    """Words in lower case, without punctuation, as UTF-8."""
    return (text or "").lower().encode("utf-8", "replace").translate(_APART).split()


def beginnings(word: bytes) -> list[bytes]:
    """What longer words share with it; the mark at the end tells them from words."""
    return [word[:n] + b"*" for n in BEGINNINGS if len(word) > n]


@dataclass
class Chain:
    vocabulary: dict[bytes, int] = field(default_factory=dict)
    names: tuple[str, ...] = CHAIN
    weights: list[np.ndarray] = field(default_factory=list)  # terms, then earlier probabilities, then the constant
    threshold: float = 1.0

    def predict(self, at: np.ndarray, values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
        """Probabilities: one row for each of n texts, one column for each category."""
        out = np.zeros((n, len(self.names)))
        for k, w in enumerate(self.weights):
            z = np.bincount(rows, w[at] * values, n) if n else np.zeros(0)
            m = len(self.vocabulary)
            out[:, k] = _logistic(z + out[:, :k] @ w[m : m + k] + w[-1])
        return out

    def sparse(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Vocabulary positions, their values (1 + log count) and the rows they belong to."""
        of_word: dict[bytes, list[int]] = {}
        at, values, rows = [], [], []
        for r, text in enumerate(texts):
            found: list[int] = []
            for w in words(text):
                own = of_word.get(w)
                if own is None:
                    own = of_word[w] = [k for t in (w, *beginnings(w)) if (k := self.vocabulary.get(t)) is not None]
                found += own
            if found:
                k, n = np.unique(np.array(found), return_counts=True)
                at.append(k)
                values.append(1 + np.log(n))
                rows.append(np.full(len(k), r))
        if not at:
            return np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
        return np.concatenate(at), np.concatenate(values), np.concatenate(rows)


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit_linear(at, values, rows, more: np.ndarray, y: np.ndarray, size: int, penalty: float = 1e-4, rounds: int = 200, rate: float = 0.05) -> np.ndarray:
    """Logistic regression with a square penalty; steps have a scale for each weight, as rows differ much in length."""
    n, k = len(y), more.shape[1]
    w = np.zeros(size + k + 1)
    if not n:
        return w
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    w[-1] = np.log(p / (1 - p))
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, rounds + 1):
        z = np.bincount(rows, w[at] * values, n) + more @ w[size : size + k] + w[-1]
        g = _logistic(z) - y
        grad = np.concatenate([np.bincount(at, g[rows] * values, size), more.T @ g, [g.sum()]]) / n
        grad[:-1] += penalty * w[:-1]
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad * grad
        w -= rate * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-9)
    return w


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The least of the multiples of 0.05 that gives the best F1."""
    steps = np.arange(1, 20) / 20
    hits = np.array([((p >= t) & (y > 0)).sum() for t in steps])
    marked = np.array([(p >= t).sum() for t in steps])
    return float(steps[np.argmax(hits / np.maximum(marked + (y > 0).sum(), 1))])


def clusters(x: np.ndarray, k: int) -> np.ndarray:
    """The cluster of each row of x by its direction, 0 for the largest. The first centres are rows far from the mean and from each other."""
    x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    if not len(x):
        return np.zeros(0, np.int64)
    near = x @ x.mean(0)
    centres = np.zeros((k, x.shape[1]))
    for j in range(k):
        centres[j] = x[np.argmin(near)]
        near = np.maximum(near, x @ centres[j]) if j else x @ centres[j]
    for _ in range(CLUSTER_STEPS):
        own = (x @ centres.T).argmax(1)
        centres = np.stack([x[own == j].sum(0) if (own == j).any() else centres[j] for j in range(k)])
        centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)
    own = (x @ centres.T).argmax(1)
    return np.argsort(np.argsort(-np.bincount(own, minlength=k), kind="stable"))[own]


def categories(at, values, rows, y: np.ndarray, size: int, kinds: int) -> np.ndarray:
    """One column for each kind of toxic rows, then y. Terms from `size` on do not count."""
    toxic = np.nonzero(y > 0)[0]
    place = np.full(len(y), -1)
    place[toxic] = np.arange(len(toxic))
    mine = (place[rows] >= 0) & (at < size)
    x = np.zeros((len(toxic), size))
    x[place[rows[mine]], at[mine]] = values[mine]
    own = np.full(len(y), -1)
    own[toxic] = clusters(x, kinds)
    return np.column_stack([*(own == k for k in range(kinds)), y > 0]).astype(float)


def fit_chain(vocabulary: dict[bytes, int], at, values, rows, labels: np.ndarray, folds: np.ndarray, names: tuple[str, ...] = CHAIN, terms: dict[int | None, np.ndarray] | None = None) -> Chain:
    """labels: one column for each category, in the chain's order; folds: the fold of each row; terms: which ones the models that predict a fold see, and under None those of the chain itself (all, if not given)."""
    chain = Chain(vocabulary, names)
    n, size = len(labels), len(vocabulary)
    before = np.zeros((n, 0))
    for k in range(labels.shape[1]):
        seen = terms[None][at] if terms else np.ones(len(at), bool)
        chain.weights.append(fit_linear(at[seen], values[seen], rows[seen], before, labels[:, k], size))
        found = np.zeros(n)  # what the next models see of this one
        for f in np.unique(folds):
            own, out = np.nonzero(folds != f)[0], np.nonzero(folds == f)[0]
            place = np.full(n, -1)
            place[own] = np.arange(len(own))
            seen = terms[f][at] if terms else np.ones(len(at), bool)
            mine = seen & (place[rows] >= 0)
            w = fit_linear(at[mine], values[mine], place[rows[mine]], before[own], labels[own, k], size)
            z = np.bincount(rows[seen], w[at[seen]] * values[seen], n) + before @ w[size : size + k] + w[-1]
            found[out] = _logistic(z[out])
        before = np.column_stack([before, found])
    chain.threshold = best_threshold(before[:, -1], labels[:, -1])
    return chain


def part_of(at, values, rows, chosen: np.ndarray, terms: np.ndarray):
    """Positions (among the terms), values and row numbers (among the chosen) of what is in both."""
    row, term = np.full(len(chosen), -1), np.full(len(terms), -1)
    row[chosen], term[terms] = np.arange(chosen.sum()), np.arange(terms.sum())
    both = chosen[rows] & terms[at]
    return term[at[both]], values[both], row[rows[both]]


def fit_apart(listed: list[bytes], terms: dict[int | None, np.ndarray], at, values, rows, y: np.ndarray, folds: np.ndarray, names: tuple[str, ...] = CHAIN) -> Chain:
    """The chain over the terms under None, which are listed first. Its threshold comes from chains that were learned without the fold that they predict, over that fold's terms."""
    kinds, unseen = len(names) - 1, np.zeros(len(y))
    for f in np.unique(folds):
        chosen, size = folds != f, int(terms[f].sum())
        own = part_of(at, values, rows, chosen, terms[f])
        vocabulary = {listed[t]: k for k, t in enumerate(np.nonzero(terms[f])[0])}
        chain = fit_chain(vocabulary, *own, categories(*own, y[chosen], size, kinds), folds[chosen], names)
        unseen[~chosen] = chain.predict(*part_of(at, values, rows, ~chosen, terms[f]), int((~chosen).sum()))[:, -1]
    size = int(terms[None].sum())
    chain = fit_chain({t: k for k, t in enumerate(listed)}, at, values, rows, categories(at, values, rows, y, size, kinds), folds, names, terms)
    weights = [np.r_[w[:size], w[len(listed) :]] for w in chain.weights]
    return Chain({t: k for k, t in enumerate(listed[:size])}, names, weights, best_threshold(unseen, y))


def telling(counts: DataFrame, sizes: list, most: int) -> DataFrame:
    """fold, word, gain: the `most` terms that tell the labels best, of all folds (fold null) and without each. counts: word, n and p by fold."""
    out = None
    for f in (None, *range(FOLDS)):
        left = [k for k in range(FOLDS) if k != f]
        n, p = (sum((F.col(c)[k] for k in left), F.lit(0)) for c in ("n", "p"))
        share = sum(sizes[k][1] for k in left) / max(1, sum(sizes[k][0] for k in left))
        best = counts.select(F.lit(f).cast("int").alias("fold"), "word", n.alias("n"), ((p - n * share) ** 2 / (n * share + 1)).alias("gain"))
        best = best.filter(F.col("n") >= LEAST_TEXTS).orderBy(F.desc("gain"), "word").limit(most).select("fold", "word", "gain")
        out = best if out is None else out.union(best)
    return out


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", most: int = MOST_LABELLED, vocabulary: int = VOCABULARY) -> Chain:
    known = labels.filter(F.col(key).isNotNull() & F.col(TARGET).isNotNull()).groupBy(F.col(key).alias("doc_id")).agg(F.max(TARGET).cast("int").alias("y"))
    chosen = known.filter(hash_share("doc_id", known.count(), most))
    fold = F.pmod(F.xxhash64(F.lit("fold"), F.col("text")), F.lit(FOLDS)).cast("int")
    # About `most` rows of two numbers: small, whatever the size of docs.
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc_id")
    rows = written(rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "y", fold.alias("fold")), "labelled")  # read twice

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_parts(batches):
            found = [sorted({t for w in set(words(text)) for t in (w, *beginnings(w))}) for text in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(found, pa.list_(pa.binary()))], names=["y", "fold", "words"])

    seen = rows.select("text", "y", "fold").mapInArrow(split, "y int, fold int, words array<binary>")
    held = {r["fold"]: (r["n"], r["p"]) for r in rows.groupBy("fold").agg(F.count("*").alias("n"), F.sum("y").alias("p")).collect()}  # a row a fold
    by_fold = lambda value: F.array(*(F.sum(F.when(F.col("fold") == k, value).otherwise(0)) for k in range(FOLDS)))
    counts = written(seen.select("y", "fold", F.explode("words").alias("word")).groupBy("word").agg(by_fold(F.lit(1)).alias("n"), by_fold(F.col("y")).alias("p")), "terms")
    # At most `vocabulary` terms for each fold and for all.
    best = telling(counts, [held.get(k, (0, 0)) for k in range(FOLDS)], vocabulary).collect()
    listed = list(dict.fromkeys(bytes(r["word"]) for r in sorted(best, key=lambda r: (r["fold"] is not None, r["fold"] or 0, -r["gain"], bytes(r["word"])))))
    place = {t: k for k, t in enumerate(listed)}
    terms: dict[int | None, np.ndarray] = {f: np.zeros(len(listed), bool) for f in (None, *range(FOLDS))}
    for r in best:
        terms[r["fold"]][place[bytes(r["word"])]] = True
    finder = Chain(place)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_parts(batches):
            at, values, of = finder.sparse(b.column(1).to_pylist())
            cuts = np.r_[0, np.cumsum(np.bincount(of, minlength=b.num_rows))].astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(x)) for x in (at.astype(np.int64), values)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), b.column(3), *lists], names=["doc_id", "y", "fold", "at", "v"])

    # At most the listed terms for each of about `most` rows.
    table_ = rows.withColumn("text", F.coalesce("text", F.lit(""))).mapInArrow(count, "doc_id long, y int, fold int, at array<long>, v array<double>").orderBy("doc_id", "fold", "at", "v").toPandas()
    removed(rows)
    removed(counts)
    if not len(table_):
        return Chain(place, weights=[np.zeros(len(place) + k + 1) for k in range(len(CHAIN))])
    sizes = table_["at"].map(len).to_numpy()
    at, values = np.concatenate(table_["at"].tolist()).astype(np.int64), np.concatenate(table_["v"].tolist())
    of = np.repeat(np.arange(len(table_)), sizes)
    return fit_apart(listed, terms, at, values, of, (table_["y"].to_numpy() > 0).astype(float), table_["fold"].to_numpy())


def rate(docs: DataFrame, chain: Chain, text: str = "text", prefix: str = "p_", keep_text: bool = True) -> DataFrame:
    """Appends one probability for each category to docs; without keep_text the texts do not come back."""
    names = [prefix + n for n in chain.names]
    docs = docs.drop(*names)
    at = docs.columns.index(text)
    fields = [f for f in docs.schema.fields if keep_text or f.name != text]
    keep = [docs.columns.index(f.name) for f in fields]

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_parts(batches):
            p = chain.predict(*chain.sparse(b.column(at).to_pylist()), b.num_rows)
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in keep), *(pa.array(np.ascontiguousarray(c)) for c in p.T)], names=[*(f.name for f in fields), *names])

    return docs.mapInArrow(per_batch, StructType([*fields, *(StructField(n, DoubleType()) for n in names)]))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = learn(docs, table(spark, sf_dir, "labels").filter(~held_out()))
    out = rate(docs.withColumn("held_out", held_out()), chain, keep_text=False)
    toxic = F.col("p_toxic") >= chain.threshold
    return out.select("doc_id", "held_out", "p_abuse_1", "p_abuse_2", F.col("p_toxic").alias("score"), toxic.cast("int").alias("predicted"), toxic.alias("toxic"))
