"""Runs of words that repeat with a period, found in tiles of a scale that fits the period.

A run is a longest stretch of words whose smallest period is q and whose length is at least `least` and
`times` times q. Word i matches for q if word i + q equals it: a run is a stretch of at least
(times - 1) * q matches. Periods are taken by octave, Q <= q < 2 Q. An octave's tiles overlap: each owns a
span of places and sees 2 Q words before and 4 Q after it. Every Q-th place is a boundary. From a boundary
two Z-functions say for all q of the octave at once how far the matches go on forward and back, up to 2 Q
places. A run has at least 3 Q matches, so it holds boundaries; what neighbouring boundaries see overlaps,
and together they see it whole. A tile joins what its own boundaries see and yields fragments of matches; those
of a document and period meet by a shuffle, touching ones are stitched, and stretches that are long enough
are runs. A boundary whose next words (at most 8) do not come again Q to 2 Q words later has nothing to
tell, which one comparison of numbers for the whole tile shows; only the others get Z-functions.

A period that is a multiple of a smaller one is left out in the tile: the q words behind the boundary are
then a repetition themselves, which its Z-function shows.

Octaves whose tiles would be smaller than TILE places share tiles of that size, so that a text of some
thousand words is one tile.

Null texts have no words and no runs. Empty tables give no rows. Very long texts are read whole, and their tiles are rows of
their own. Rows that repeat an id with another text stand on their own; rows that repeat both give equal
rows. Null ids are ids like any other, and are not edited by the query. Columns other than key and text
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from .common import give_back, small_parts, table

LEAST, TIMES = 6, 4
#: Places that a tile owns at least; beyond it owns so many times its octave's Q.
TILE, TILE_PERIODS = 1 << 13, 16
#: Words that must come again at a boundary before its Z-functions are worked out.
GRAM = 8
#: Words of the tiles that are sent at once.
_SENT = 1 << 20

Edit = Callable[[int, int], "tuple[int, int] | None"]


def words_of(text: str | None) -> list[bytes]:
    """The words [^\\x20\\x09-\\x0D]+ of a text."""
    return (text or "").encode("utf-8", "replace").split()


def z_function(s: list[int]) -> list[int]:
    """For each place how many items from there on equal those from the start on."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    low = high = 0
    for i in range(1, n):
        k = min(high - i, z[i - low]) if i < high else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > high:
            low, high = i, i + k
    return z


def octaves(n: int, least: int = LEAST, times: int = TIMES) -> int:
    """How many octaves of periods a text of n words can have runs of."""
    return (n // times).bit_length() if n >= least else 0


def tiles_of(n: int, least: int = LEAST, times: int = TIMES) -> Iterator[tuple[int, int, int, int]]:
    """(first octave, last octave, begin, end) of the tiles of a text of n words: octaves of small periods share theirs."""
    top = octaves(n, least, times)
    shared = min(top, (TILE // TILE_PERIODS).bit_length())
    groups = [(0, shared - 1)] * bool(shared) + [(o, o) for o in range(shared, top)]
    for low, high in groups:
        size = max(TILE, TILE_PERIODS << high)
        for begin in range(0, n, size):
            yield low, high, begin, min(n, begin + size)


def margins(octave: int) -> tuple[int, int]:
    """Words that a tile sees before and after the places it owns."""
    return 2 << octave, 4 << octave


def _grams(words, k: int):
    """A number for each place that equal runs of k words (a power of two) share; places near the end have none."""
    import numpy as np

    g = words.astype(np.uint64)
    size = 1
    while size < k and len(g) > size:
        g = (g[:-size] * np.uint64(0x9E3779B97F4A7C15)) ^ (g[size:] + np.uint64(0x632BE59BD9B4E019) + (g[:-size] >> np.uint64(29)))
        size *= 2
    return g if size >= k else g[:0]


def _prime_divisors(q: int) -> list[int]:
    out, p = [], 2
    while p * p <= q:
        if q % p == 0:
            out.append(p)
            while q % p == 0:
                q //= p
        p += 1
    return out + [q] * (q > 1)


def tile_fragments(words, octave: int, own: tuple[int, int], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(q, begin, end) of the stretches of matches around the boundaries in words[own[0]:own[1]].

    words: numpy integers, equal for equal words. A stretch that ends inside of what the boundaries see and is
    too short for a run is left out; one that goes on beyond is given as far as it is seen.
    """
    import numpy as np

    Q, n = 1 << octave, len(words)
    seen = 2 * Q
    gram = _grams(words, min(Q, GRAM))
    at = np.arange(own[0] + -own[0] % Q, min(own[1], len(gram) - Q), Q)
    if not len(at):
        return []
    after = at[:, None] + np.arange(Q, 2 * Q)
    inside = after < len(gram)
    same = inside & (gram[np.where(inside, after, 0)] == gram[at][:, None])
    found: dict[int, list[list[int]]] = {}
    divisors: dict[int, list[int]] = {}
    for row in np.nonzero(same.any(1))[0]:
        c = int(at[row])
        low = max(0, c - seen)
        z = z_function(words[c : c + 2 * seen].tolist())
        behind = words[low:c][::-1].tolist()
        back = z_function([*behind, -1, *words[low : c + 2 * Q][::-1].tolist()])  # no word is -1
        edge = len(behind) + 1 + min(2 * Q, n - c)
        for q in (np.nonzero(same[row])[0] + Q).tolist():
            if q not in divisors:
                divisors[q] = _prime_divisors(q)
            if any(z[q // p] >= q - q // p for p in divisors[q]):
                continue
            right = min(z[q], seen)
            left = min(back[edge - q], len(behind))
            if right < seen and left < seen and left + right < max((times - 1) * q, least - q):
                continue
            spans = found.setdefault(q, [])
            if spans and spans[-1][1] >= c - left:
                spans[-1][1] = max(spans[-1][1], c + right)
            else:
                spans.append([c - left, c + right])
    return [(q, a, b) for q, spans in found.items() for a, b in spans]


def _tiled(edit: Edit | None, least: int, times: int):
    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        held: list[tuple] = []
        size = 0

        def batch(kind: pa.DataType) -> pa.RecordBatch:
            columns = zip(*held)
            kinds = [kind, pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["doc_id", "text_hash", "low", "high", "first", "own_begin", "own_end", "words"])

        for rows in small_parts(batches):
            for doc, text, hash_, crc in zip(rows.column(0).to_pylist(), rows.column(1), rows.column(2).to_pylist(), rows.column(3).to_pylist()):
                codes: dict[bytes, int] = {}
                words = np.fromiter((codes.setdefault(w, len(codes)) for w in words_of(text.as_py())), np.int32)
                n = len(words)
                if edit and crc is not None and (cut := edit(crc, n)):
                    a, p = cut
                    words[a:] = words[a : a + p][np.arange(n - a) % p]
                for low, high, begin, end in tiles_of(n, least, times):
                    before, after = margins(high)
                    first = max(0, begin - before)
                    part = words[first : end + after]
                    held.append((doc, hash_, low, high, first, begin - first, end - first, part.tobytes()))
                    size += len(part) + 32
                    if size >= _SENT:
                        yield batch(rows.schema.field(0).type)
                        held, size = [], 0
        if held:
            yield batch(rows.schema.field(0).type)

    return per_partition


def _solved(least: int, times: int):
    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for rows in batches:
            out = []
            for k, (doc, hash_, low, high, first, begin, end) in enumerate(zip(*(c.to_pylist() for c in rows.columns[:7]))):
                words = np.frombuffer(rows.column(7)[k].as_buffer(), np.int32)
                for octave in range(low, high + 1):
                    out += [(doc, hash_, q, first + a, first + b) for q, a, b in tile_fragments(words, octave, (begin, end), least, times)]
            kinds = [rows.schema.field(0).type, *[pa.int64()] * 4]
            columns = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["doc_id", "text_hash", "period", "begin", "end"])
        give_back()

    return per_partition


def runs(docs: DataFrame, key: str = "doc_id", text: str = "text", edit: Edit | None = None, crc: Column | None = None, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """doc_id, text_hash, start, length, period of every run of every text; texts are known by their id and xxhash64.

    edit(crc, n): None or (a, p) for a text of n words whose words from a on repeat those from a to a + p instead.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"), (F.lit(None) if crc is None else crc).cast("long").alias("crc"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    tiles = rows.mapInArrow(_tiled(edit, least, times), f"doc_id {kind}, text_hash long, low int, high int, first long, own_begin long, own_end long, words binary")
    fragments = tiles.mapInArrow(_solved(least, times), f"doc_id {kind}, text_hash long, period long, begin long, end long")
    return stitched(fragments.distinct(), least, times)


def stitched(fragments: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """Runs of fragments of matches (doc_id, text_hash, period, begin, end): touching ones are one stretch."""
    own = ["doc_id", "text_hash", "period"]
    order = W.partitionBy(*own).orderBy("begin", "end")
    new = F.coalesce(F.col("begin") > F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(True))
    marked = fragments.withColumn("_new", new.cast("int"))
    whole = marked.withColumn("_stretch", F.sum("_new").over(order)).groupBy(*own, "_stretch").agg(F.min("begin").alias("start"), (F.max("end") - F.min("begin") + F.col("period")).alias("length"))
    return whole.filter((F.col("length") >= least) & (F.col("length") >= times * F.col("period"))).select("doc_id", "text_hash", "start", "length", "period")


def runs_by_document(found: DataFrame) -> DataFrame:
    """doc_id, text_hash, runs: array<struct<start,period,length>> in that order; as many as a text's length allows."""
    return found.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))


def strongest(found: Column) -> Column:
    """Of runs in order of (start, period) the first with the greatest length / period, compared as fractions; null if none."""
    better = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    none = F.lit(None).cast("struct<start:bigint,period:bigint,length:bigint>")
    return F.aggregate(found, none, lambda best, r: F.when(better(best, r), r).otherwise(best))


def collapsed(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text", edit: Edit | None = None, crc: Column | None = None, digest: bool = False) -> DataFrame:
    """key, runs and collapsed of every row: the text's words without those that only repeat (behind the first q words of a run), joined by blanks; or their sha256.

    found: as runs() gives it. An edited text is edited here, too.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"), (F.lit(None) if crc is None else crc).cast("long").alias("crc")).alias("d")
    of = runs_by_document(found).alias("r")
    same = (F.col("d.text_hash") == F.col("r.text_hash")) & F.col("d.doc_id").eqNullSafe(F.col("r.doc_id"))
    none = F.array().cast("array<struct<start:bigint,period:bigint,length:bigint>>")
    joined = rows.join(of, same, "left").select("d.doc_id", "d.text", "d.crc", F.coalesce("r.runs", none).alias("runs"))
    kind = joined.schema["doc_id"].dataType.simpleString()

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_parts(batches):
            out = []
            for body, number, own in zip(b.column(1), b.column(2).to_pylist(), b.column(3)):
                words = words_of(body.as_py())
                n = len(words)
                if edit and number is not None and (cut := edit(number, n)):
                    a, p = cut
                    unit = words[a : a + p]
                    words[a:] = (unit * -(-(n - a) // p))[: n - a]
                if len(own):
                    kept, done = [], 0  # runs come by start: words before `done` are decided
                    for r in sorted(((r["start"] + r["period"], r["start"] + r["length"]) for r in own.as_py())):
                        kept += words[done : max(done, r[0])]
                        done = max(done, r[1])
                    words = kept + words[done:]
                line = b" ".join(words)
                out.append(hashlib.sha256(line).hexdigest() if digest else line.decode())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(3), pa.array(out, pa.string())], names=["doc_id", "runs", "collapsed"])

    return joined.mapInArrow(per_batch, f"doc_id {kind}, runs {none_kind()}, collapsed string").withColumnRenamed("doc_id", key)


def none_kind() -> str:
    return "array<struct<start:bigint,period:bigint,length:bigint>>"


def repeated_tail(crc: int, n: int) -> tuple[int, int] | None:
    """The contract's edit: of each tenth text the words from a on repeat with period p."""
    g = crc // 10
    if crc % 10 or not n:
        return None
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def op11_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    crc = F.crc32(F.col("doc_id").cast("string"))
    out = collapsed(docs, runs(docs, edit=repeated_tail, crc=crc), edit=repeated_tail, crc=crc, digest=True)
    lines = F.array_join(F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])), "")
    out = out.withColumn("_best", strongest(F.col("runs")))
    best = {n: F.col(f"_best.{n}") for n in ("start", "length", "period")}
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *(c.alias(n) for n, c in best.items()), F.expr("(1000 * _best.length) div _best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.col("collapsed").alias("collapsed_sha256"),
    )
