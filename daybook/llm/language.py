"""Language identification by character language models with interpolated Kneser-Ney smoothing.

Texts become letters in lower case with single gaps between words; in counting, a text's end is a gap. For each language the 4-grams of
all its training texts are counted on the cluster, and all of them make its model; lower orders are
continuation counts. Languages whose models together are small form a group: the group's models share
sorted arrays of hashed n-grams with one column of log-probabilities for each of its languages; a
text's positions are looked up together, unseen n-grams back off to shorter ones. The language with the
lowest cross-entropy for a letter wins. A text is accepted if that cross-entropy, measured in the spread
that the language's own training texts show, is within the calibrated limit and the winner's posterior is
at least one half.

Models grow with the corpus, and nothing is cut off them. A group takes at most MODEL_BYTES. A larger language is cut into
ranges of the two symbols in the middle of its 4-grams: what a 4-gram backs off to has them too, or only the second of
them, so each range answers for its positions alone, given the continuation counts of its pairs and single symbols and the
language's discounts, which the cluster counts over all ranges. One group or range at a time passes through the driver and is
broadcast; texts are read once for each, and a text's sums add up over the ranges. So neither a task nor the driver
holds more than one, however many languages there are and however large they are. A language needs some 24 bytes for each of its
different 4-grams. What is not cut: the 4-grams around one pair of symbols, and LEAST_RANGE of them.

Null texts and texts without a letter get `und`, score 0, and are not accepted. Languages whose texts
have no letter are never predicted. Empty training tables give models of no language: all texts get `und`.
Nulls in lang are not learned from; repeated rows count as often as they stand there. Of languages with
equal entropies the first by name wins. Very long texts are read whole, in slices. Columns other than key,
text and lang are not read; those of the appended names are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StringType, StructField, StructType

from .common import free_names, held_out, removed, sliced, small_parts, table, written

ORDER = 4
UNDETERMINED = "und"
#: The most bytes that the models of one group of languages take together; a larger language is cut into ranges.
MODEL_BYTES = 128 << 20
#: Bytes that a 4-gram takes with what it backs off to, in a model of one language; 4-grams that are never cut.
GRAM_BYTES, LEAST_RANGE = 24, 1 << 12
#: Of n training texts of a language, medians and quantiles are off by n / ACCURACY ranks at most.
ACCURACY = 10_000
#: The least limit, in spreads, and the share of a language's own texts that lie within the limit.
LEAST_LIMIT, WITHIN = 10.0, 0.999

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point of the basic plane: its lower-case letter, or 0 if it is none."""
    if not _LETTERS:
        chars = map(chr, range(1 << 16))
        _LETTERS.append(np.fromiter((ord(c.lower()[0]) & 0xFFFF if c.isalpha() else 0 for c in chars), np.uint16))
    return _LETTERS[0]


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of all texts as UTF-16, gaps as 0, each text after ORDER - 1 gaps; and where each text begins."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points & 0xFFFF]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    far = np.nonzero(points > 0xFFFF)[0]
    if len(far):  # a letter beyond the basic plane becomes two symbols, as in UTF-16
        low = np.array([ord(chr(p).lower()[0]) if chr(p).isalpha() else 0 for p in points[far]], np.int64)
        wide = low > 0xFFFF
        letter[far] = np.where(wide, 0xD800 + (low - 0x10000 >> 10), low)
        owner = np.searchsorted(np.cumsum(sizes), far[wide], side="right")
        letter = np.insert(letter, far[wide] + 1, 0xDC00 + (low[wide] - 0x10000 & 0x3FF))
        sizes = sizes + np.bincount(owner, minlength=len(texts))
    starts = np.cumsum(sizes) - sizes
    keep = letter != 0
    keep[1:] |= letter[:-1] != 0
    first = starts[sizes > 0]
    keep[first] = letter[first] != 0
    kept = np.r_[0, np.cumsum(keep)]
    begins = kept[starts] + (ORDER - 1) * (np.arange(len(texts)) + 1)
    at = np.nonzero(keep)[0]
    owner = np.repeat(np.arange(len(texts)), sizes)[at]
    out = np.zeros(len(at) + (ORDER - 1) * (len(texts) + 1), np.uint16)
    out[np.arange(len(at)) + (ORDER - 1) * (owner + 1)] = letter[at]
    return out, begins


def grams(letters: np.ndarray) -> np.ndarray:
    """At each position from the fourth on, the last four symbols as one number."""
    s = letters.astype(np.uint64)
    return (s[:-3] << np.uint64(48)) | (s[1:-2] << np.uint64(32)) | (s[2:-1] << np.uint64(16)) | s[3:]


def count_grams(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, gram, n over all rows with a language."""
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_parts(batches):
            langs, texts = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_pylist()
            for name in set(langs):
                own = [texts[i] for i in np.nonzero(langs == name)[0]]
                for lo, hi in sliced(own):
                    letters, begins = symbols(own[lo:hi])
                    found = grams(letters)
                    found, n = np.unique(found[(found & np.uint64(0xFFFFFFFF)) != 0], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(found), pa.string()), pa.array(found.view(np.int64)), pa.array(n, pa.int64())], names=["lang", "gram", "n"])

    return rows.mapInArrow(per_batch, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _hashed(keys: np.ndarray) -> np.ndarray:
    """A one-to-one hash of n-grams."""
    keys = keys * np.uint64(0x9E3779B97F4A7C15)
    return keys ^ (keys >> np.uint64(32))


@dataclass
class Level:
    """Sorted hashes and one row of values a hash: n-grams' log-probabilities, or contexts' log-weights."""

    hashes: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, keys: np.ndarray, values: np.ndarray) -> Level:
        hashes = _hashed(keys)
        order = np.argsort(hashes)
        return cls(hashes[order], values[order].astype(np.float32))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.hashes):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        hashes = _hashed(keys)
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        return at, self.hashes[at] == hashes


def middles(keys: np.ndarray) -> np.ndarray:
    """The third symbol of 4-grams, then the second."""
    return (keys & np.uint64(0xFFFF0000)) | ((keys >> np.uint64(32)) & np.uint64(0xFFFF))


@dataclass
class Model:
    """The models of a group of languages, or a range of one language's: of the 4-grams whose middles are in span (low, high)."""

    langs: list[str]
    grams: list[Level]  # of orders ORDER..1
    weights: list[Level]  # of contexts of ORDER-1..1 symbols
    floor: np.ndarray
    span: tuple[int, int] | None = None

    def log_probabilities(self, keys: np.ndarray, level: int = 0) -> np.ndarray:
        """One row for each key of order ORDER - level."""
        at, known = self.grams[level].find(keys)
        out = self.grams[level].values[at] if len(self.grams[level].hashes) else np.zeros((len(keys), len(self.langs)), np.float32)
        lost = np.nonzero(~known)[0]
        if len(lost):
            if level == ORDER - 1:
                out[lost] = self.floor
            else:
                rest = keys[lost]
                lower = self.log_probabilities(rest & np.uint64((1 << 16 * (ORDER - 1 - level)) - 1), level + 1)
                where, seen = self.weights[level].find(rest >> np.uint64(16))
                if len(self.weights[level].hashes):
                    lower += np.where(seen[:, None], self.weights[level].values[where], 0)
                out[lost] = lower
        return out

    def at_positions(self, keys: np.ndarray) -> np.ndarray:
        """Log-probabilities; 0 for what is not in the range."""
        if self.span is None:
            return self.log_probabilities(keys)
        out, middle = np.zeros((len(keys), len(self.langs)), np.float32), middles(keys)
        own = np.nonzero((middle >= np.uint64(self.span[0])) & (middle < np.uint64(self.span[1])))[0]
        out[own] = self.log_probabilities(keys[own])
        return out

    def cross_entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Mean negative log-probability for each text and language, and the number of letters and gaps. Those of ranges add up."""
        out, sizes = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64)
        for lo, hi in sliced(texts):
            letters, begins = symbols(texts[lo:hi])
            ends = np.r_[begins[1:] - (ORDER - 1), len(letters) - (ORDER - 1)]
            has = np.zeros(hi - lo, bool)
            some = ends > begins
            sums = np.zeros((hi - lo, len(self.langs)))
            for a in range(0, len(letters) - ORDER + 1, 1 << 18):
                b = min(a + (1 << 18), len(letters) - ORDER + 1)
                logs = self.at_positions(grams(letters[a : b + ORDER - 1]))
                # Positions a..b hold the symbols a+3..b+3; those between texts count for none.
                first, last = np.clip(begins - (ORDER - 1), a, b) - a, np.clip(ends - (ORDER - 1), a, b) - a
                total = np.cumsum(logs, axis=0, dtype=np.float64)
                total = np.concatenate([np.zeros((1, total.shape[1])), total])
                sums += total[last] - total[first]
            letters_before = np.r_[0, np.cumsum(letters != 0)]
            has = (letters_before[ends] - letters_before[begins]) > 0
            sizes[lo:hi] = np.where(some & has, ends - begins, 0)
            out[lo:hi] = -sums / np.maximum(ends - begins, 1)[:, None]
        return out, sizes


@dataclass
class Limits:
    """What tells a text of a language from others."""

    langs: list[str]
    centre: np.ndarray
    spread: np.ndarray
    limit: np.ndarray

    def verdicts(self, entropies: np.ndarray, sizes: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The language, the winner's posterior and whether it is accepted, for each row of entropies."""
        langs = self.langs
        if not langs or not len(entropies):
            return [UNDETERMINED] * len(entropies), np.zeros(len(entropies)), np.zeros(len(entropies), bool)
        best = entropies.argmin(1)
        low = entropies[np.arange(len(best)), best]
        posterior = 1 / np.exp(-(entropies - low[:, None]) * np.minimum(sizes, 100)[:, None]).sum(1)
        away = (low - self.centre[best]) / (self.spread[best] * _slack(sizes))
        some = sizes > 0
        accepted = some & (posterior >= 0.5) & (away <= self.limit[best])
        return [langs[b] if s else UNDETERMINED for b, s in zip(best, some)], np.where(some, posterior, 0.0), accepted


@dataclass
class Part:
    """A group of languages or a range of one language, and how to get its model."""

    langs: list[str]
    build: Callable[[], Model]
    first: bool = True  # of its language's ranges
    last: bool = True


def combined(earlier: np.ndarray, entropies: np.ndarray, part: Part) -> np.ndarray:
    """Entropies of one more part: new languages stand beside the earlier ones, a further range is added to the last."""
    if part.first:
        return np.concatenate([earlier, entropies], 1)
    n = earlier.shape[1] - entropies.shape[1]
    return np.concatenate([earlier[:, :n], earlier[:, n:] + entropies], 1)


@dataclass
class Models(Limits):
    """All languages, in groups and ranges. The driver holds the model of the part that was asked for last."""

    groups: list[Part]
    _held: list = field(default_factory=list)

    def model(self, part: Part) -> Model:
        if not self._held or self._held[0] is not part:
            self._held.clear()
            self._held += [part, part.build()]
        return self._held[1]

    def cross_entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        out, sizes = np.zeros((len(texts), 0)), np.zeros(len(texts), np.int64)
        for part in self.groups:
            entropies, sizes = self.model(part).cross_entropies(texts)
            out = combined(out, entropies, part)
        return out, sizes


def _discount_of(n1: int, n2: int) -> float:
    return float(n1 / (n1 + 2 * n2)) if n1 and n2 else 0.5


def _discount(n: np.ndarray) -> float:
    return _discount_of((n == 1).sum(), (n == 2).sum())


@dataclass
class Whole:
    """What a range of a language takes from the others: discounts of orders 1 to ORDER; symbols and pairs, ascending, with their continuation counts."""

    discounts: dict[int, float]
    counts: dict[int, tuple[np.ndarray, np.ndarray]]


def kneser_ney(langs: list[str], counts: dict[str, tuple[np.ndarray, np.ndarray]], whole: Whole | None = None, span: tuple[int, int] | None = None) -> Model:
    """counts: for each language all its 4-grams (or those of the range), ascending, and their counts."""
    most = 1 << 16
    parts = []  # for each language, the orders' (grams, probabilities) and contexts' (contexts, weights)
    for name in langs:
        keys, n = counts[name]
        orders, contexts = [], []
        tops = []
        for order in range(ORDER, 0, -1):
            if order < ORDER:  # continuation counts: how many symbols stand before
                keys, n = np.unique(keys & np.uint64((1 << 16 * order) - 1), return_counts=True)
            if whole and order in whole.counts:
                keys, n = whole.counts[order]
            discount = whole.discounts[order] if whole else _discount(n)
            context, at = np.unique(keys >> np.uint64(16), return_inverse=True)
            total = np.bincount(at, weights=n)
            kinds = np.bincount(at)
            tops.append((keys, np.maximum(n - discount, 0) / total[at]))
            contexts.append((context, discount * kinds / total))
        floor = 1.0 / most
        lower = None
        for order in range(1, ORDER + 1):
            keys, p = tops[ORDER - order]
            context, weight = contexts[ORDER - order]
            w = weight[np.searchsorted(context, keys >> np.uint64(16))]
            if order == 1:
                p = p + w * floor
                unseen = float(weight[0] * floor) if len(weight) else floor
            else:
                k, q = lower
                p = p + w * q[np.searchsorted(k, keys & np.uint64((1 << 16 * (order - 1)) - 1))]
            lower = (keys, p)
            orders.insert(0, lower)
        parts.append((orders, contexts, unseen))
    levels, weights = [], []
    unseen = np.log([p[2] for p in parts]) if parts else np.zeros(0)
    # From the lowest order up: a gram that one language lacks gets that language's backed-off value.
    model = Model(langs, [Level(np.zeros(0, np.uint64), np.zeros((0, len(langs)), np.float32))] * ORDER, [], unseen.astype(np.float32), span)
    for i in range(ORDER - 1):
        keys = np.unique(np.concatenate([p[1][i][0] for p in parts])) if parts else np.zeros(0, np.uint64)
        values = np.zeros((len(keys), len(langs)))
        for j, p in enumerate(parts):
            values[np.searchsorted(keys, p[1][i][0]), j] = np.log(p[1][i][1])
        weights.append(Level.of(keys, values))
    model.weights = weights
    for level in range(ORDER - 1, -1, -1):
        keys = np.unique(np.concatenate([p[0][level][0] for p in parts])) if parts else np.zeros(0, np.uint64)
        values = model.log_probabilities(keys, level) if len(keys) else np.zeros((0, len(langs)))
        for j, p in enumerate(parts):
            values[np.searchsorted(keys, p[0][level][0]), j] = np.log(p[0][level][1])
        model.grams[level] = Level.of(keys, values)
    return model


def grouped(kinds: dict[str, int], most_bytes: int) -> list[list[str]]:
    """Languages in groups by how many different 4-grams they have."""
    groups: list[list[str]] = []
    held = 0
    for name in sorted(kinds):
        if groups and 2 * (held + kinds[name]) * (8 + 4 * (len(groups[-1]) + 1)) <= most_bytes:
            groups[-1].append(name)
            held += kinds[name]
        else:
            groups.append([name])
            held = kinds[name]
    return groups


def _sorted(held) -> tuple[np.ndarray, np.ndarray]:
    keys = held["gram"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], held["n"].to_numpy()[order]


def _group(counted: DataFrame, names: list[str]) -> Model:
    held = counted.filter(F.col("lang").isin(names)).toPandas()
    return kneser_ney(names, {name: _sorted(own) for name, own in held.groupby("lang")})


def cuts(own: DataFrame, room: int) -> list[int]:
    """Where ranges of about `room` rows begin and end. own: middle. A row for each symbol (at most 65,536) goes to the driver, and for each symbol with too many rows one for each symbol before it."""
    third = F.shiftright("middle", 16)
    ends, held = [0], 0
    for c, n in sorted(own.groupBy(third).count().collect()):
        parts = [(c << 16, n)] if n <= room else sorted(own.filter(third == c).groupBy("middle").count().collect())
        for middle, m in parts:
            if held and held + m > room:
                ends.append(middle)
                held = 0
            held += m
    return [*ends, 1 << 32]


def ranged(counted: DataFrame, names: list[str], room: int) -> dict[str, list[Part]]:
    """Large languages in ranges. Their 4-grams are stored sorted by their middles, so a range is read without the others."""
    orders = {ORDER: counted.filter(F.col("lang").isin(names))}
    for order in range(ORDER - 1, 0, -1):  # continuation counts: how many symbols stand before
        shorter = F.col("gram").bitwiseAND(F.lit((1 << 16 * order) - 1))
        orders[order] = written(orders[order + 1].groupBy("lang", shorter.alias("gram")).agg(F.count("*").alias("n")), "grams")
    discounts: dict[str, dict[int, float]] = {name: {} for name in names}
    for order, rows in orders.items():
        for r in rows.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("one"), F.count_if(F.col("n") == 2).alias("two")).collect():  # a row a language
            discounts[r["lang"]][order] = _discount_of(r["one"], r["two"])
    middle = F.col("gram").bitwiseAND(F.lit(0xFFFF0000)).bitwiseOR(F.shiftright("gram", 32).bitwiseAND(F.lit(0xFFFF)))  # as middles()
    stored = written(orders[ORDER].withColumn("middle", middle).repartitionByRange("lang", "middle").sortWithinPartitions("lang", "middle"), "grams")

    def build(name: str, low: int, high: int) -> Model:
        keys = stored.filter((F.col("lang") == name) & (F.col("middle") >= low) & (F.col("middle") < high)).select("gram", "n").toPandas()
        first = F.shiftright("gram", 16)
        pairs = orders[2].filter((F.col("lang") == name) & (first >= low >> 16) & (first <= high - 1 >> 16)).toPandas()
        single = orders[1].filter(F.col("lang") == name).toPandas()  # at most 65,536
        return kneser_ney([name], {name: _sorted(keys)}, Whole(discounts[name], {2: _sorted(pairs), 1: _sorted(single)}), (low, high))

    out = {}
    for name in names:
        ends = cuts(stored.filter(F.col("lang") == name).select("middle"), room)
        spans = list(zip(ends, ends[1:]))
        out[name] = [Part([name], lambda name=name, span=span: build(name, *span), span is spans[0], span is spans[-1]) for span in spans]
    removed(orders[3])
    return out


def fit(train: DataFrame, text: str = "text", lang: str = "lang", most_bytes: int = MODEL_BYTES) -> Models:
    """Counts all rows of train; the driver holds the counts of one group of languages, or of a range of one, at a time."""
    counted = written(count_grams(train, text, lang), "grams")
    kinds = {r["lang"]: r["n"] for r in counted.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row a language
    room = max(LEAST_RANGE, most_bytes // GRAM_BYTES)
    large = [name for name in sorted(kinds) if kinds[name] > room]
    ranges = ranged(counted, large, room) if large else {}
    parts: list[Part] = []
    for names in grouped(kinds, most_bytes):
        parts += ranges[names[0]] if names[0] in ranges else [Part(names, lambda names=names: _group(counted, names))]
    return calibrate(parts, train, text, lang)


def _between(batch: pa.RecordBatch, entropies: np.ndarray, sizes: np.ndarray) -> list[pa.Array]:
    return [pa.array(list(entropies), pa.list_(pa.float64())), pa.array(sizes)]


def pass_over(rows: DataFrame, models: Models, part: Part | None, text: str, so_far: str, fields: list[StructField], added: list[StructField], finish=_between):
    """The fields of rows and what finish(batch, entropies, sizes) makes of the entropies after one more part, with the part's broadcast."""
    shared = rows.sparkSession.sparkContext.broadcast(part and models.model(part))  # of bounded size, see MODEL_BYTES
    at, before = rows.columns.index(text), rows.columns.index(so_far) if so_far in rows.columns else None
    keep = [rows.columns.index(f.name) for f in fields]
    kind = part and Part(part.langs, None, part.first, part.last)

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_parts(batches):
            texts = [t or "" for t in batch.column(at).to_pylist()]
            entropies, sizes = np.zeros((len(texts), 0)), np.zeros(len(texts), np.int64)
            if before is not None:
                entropies = batch.column(before).flatten().to_numpy(zero_copy_only=False).reshape(len(texts), -1)
            if kind and texts:
                own, sizes = shared.value.cross_entropies(texts)
                entropies = combined(entropies, own, kind)
            out = finish(batch, entropies, sizes)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), *out], names=[f.name for f in (*fields, *added)])

    return rows.mapInArrow(per_batch, StructType([*fields, *added])), shared


def _stored(rows: DataFrame, shared, earlier: DataFrame) -> DataFrame:
    """Rows of a pass, written; what it needed goes."""
    out = written(rows, "entropies")
    shared.destroy()
    removed(earlier)
    return out


def calibrate(parts: list[Part], train: DataFrame, text: str, lang: str) -> Models:
    """Sets each language's centre, spread and limit from all of its own training texts, equal ones once."""
    langs = [name for part in parts if part.first for name in part.langs]
    models = Models(langs, np.zeros(len(langs)), np.ones(len(langs)), np.full(len(langs), LEAST_LIMIT), parts)
    rows = train.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    place = {name: j for j, name in enumerate(langs)}
    added = [StructField("_entropies", ArrayType(DoubleType())), StructField("_length", LongType())]
    seen_fields = [StructField("h", DoubleType()), StructField("n", LongType()), StructField("slack", DoubleType())]
    for part in parts:
        if part.first:
            mine = rows.filter(F.col("lang").isin(part.langs))
        if not part.last:
            mine = _stored(*pass_over(mine, models, part, "text", "_entropies", rows.schema.fields, added), mine)
            continue

        def own_entropy(batch: pa.RecordBatch, entropies: np.ndarray, sizes: np.ndarray, own={name: j for j, name in enumerate(part.langs)}) -> list[pa.Array]:
            h = entropies[np.arange(len(sizes)), [own[name] for name in batch.column(0).to_pylist()]]
            return [pa.array(h, pa.float64()), pa.array(sizes), pa.array(_slack(sizes), pa.float64())]

        last, shared = pass_over(mine, models, part, "text", "_entropies", rows.schema.fields[:1], seen_fields, own_entropy)
        seen = _stored(last.filter("n > 0").distinct(), shared, mine)
        at = lambda value, share: F.percentile_approx(value, share, ACCURACY)
        centres = seen.groupBy("lang").agg(at("h", 0.5).alias("centre"))  # a row a language
        away = (F.col("h") - F.col("centre")) / F.col("slack")
        found = seen.join(F.broadcast(centres), "lang").groupBy("lang", "centre").agg(F.count("*").alias("texts"), at(F.abs(away), 0.5).alias("mad"), at(away, WITHIN).alias("far"))
        for r in found.filter("texts > 1").collect():
            j = place[r["lang"]]
            models.centre[j] = r["centre"]
            models.spread[j] = max(1e-3, 1.4826 * r["mad"])
            models.limit[j] = max(LEAST_LIMIT, 1.5 * r["far"] / models.spread[j])
        removed(seen)
    return models


def _slack(sizes: np.ndarray) -> np.ndarray:
    """Short texts scatter more."""
    return 1 + 8 / np.sqrt(np.maximum(sizes, 1))


def identify(docs: DataFrame, models: Models, text: str = "text", names: tuple[str, str, str] = ("lang_pred", "score", "accepted"), keep_text: bool = True) -> DataFrame:
    """Appends the language, the score (the winner's posterior, 0 to 1) and whether it is accepted to docs.

    Columns of these names are replaced. Without keep_text the texts do not come back.
    """
    docs = docs.drop(*names)
    so_far, length = free_names(docs, "_entropies", "_length")
    verdict = [StructField(n, t) for n, t in zip(names, (StringType(), DoubleType(), BooleanType()))]
    between = [StructField(so_far, ArrayType(DoubleType())), StructField(length, LongType())]
    limits = Limits(models.langs, models.centre, models.spread, models.limit)

    def judge(batch: pa.RecordBatch, entropies: np.ndarray, sizes: np.ndarray) -> list[pa.Array]:
        langs, scores, accepted = limits.verdicts(entropies, sizes)
        return [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_())]

    fields, rows = list(docs.schema.fields), docs
    for part in models.groups[:-1]:
        rows = _stored(*pass_over(rows, models, part, text, so_far, fields, between), rows)
    ends = [f for f in fields if keep_text or f.name != text]
    return pass_over(rows, models, models.groups[-1] if models.groups else None, text, so_far, ends, verdict, judge)[0]


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    models = fit(docs.filter(~held_out()))
    return identify(docs.select("doc_id", "text", held_out().alias("held_out")), models, keep_text=False)
