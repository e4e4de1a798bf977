"""Document fingerprints by I-Match over randomised sub-lexicons.

The lexicon is every term whose inverse document frequency lies in a band: terms in at least `least_docs`
documents and in at most `most_share` of them, where documents of equal texts count once. `levels` says
how many sub-lexicons there are and what part of the lexicon, drawn by the terms' hashes, each takes:
those of the first level part the whole lexicon among them, those of the next ones are smaller and
smaller, so that texts of any length have sub-lexicons that an edit leaves alone. A sub-lexicon's part of
the fingerprint is the hash of the document's sorted distinct terms in it; "-" marks a part without
terms. Documents without any lexicon term use the hash of their text for all parts, so that equal texts
always have equal fingerprints. The likeness of two fingerprints is the share of their parts that agree,
among those that either has terms for.

Frequent terms number at most (terms of a document) / most_share on average, so they are found by
counting and then left out by a literal. With least_docs of 1, the default, no term of a document is
exchanged apart from counting; a higher one exchanges the terms of all documents to leave out rare ones.

Terms in at most NEVER_FREQUENT texts are never frequent, so in tables of under 20 texts the band is wider.

Null texts are empty texts. Rows that repeat an id stand on their own; equal ids are ordered by the hash
of their text. Null ids come first. One document is its own next document. Empty tables give no rows.
Very long texts are read whole. Columns other than key and text are not read. Everything here is
DataFrame functions.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from .common import table, written

#: (sub-lexicons, of how many terms each takes one): numbers of terms are powers of two.
LEVELS = ((16, 16), (32, 256), (32, 4096))
LEAST_DOCS, MOST_SHARE = 1, 0.1
#: Terms in up to so many texts are never frequent.
NEVER_FREQUENT = 2
#: Bytes of text that a range of neighbouring documents takes, and how many ranges there are at most: their
#: begins go through the driver, a few numbers each. Beyond, ranges take more bytes and are sorted on disk.
RANGE_BYTES, MOST_RANGES = 16 << 20, 1 << 15
#: How a part without terms is printed, and its number.
NO_TERMS, NO_PART = "-", -1


def let(value: Column, body) -> Column:
    """body(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def literal_array(values: list, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")


def terms_of(text: Column) -> Column:
    """Hashes of the distinct terms of text."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def term_counts(docs: DataFrame, text: str, most_share: float, least_docs: int) -> tuple[list[int], DataFrame | None]:
    """The terms that are in too many different texts; and those in enough of them (None if one is enough)."""
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")).select(F.xxhash64("text").alias("hash"), terms_of(F.col("text")).alias("terms"))
    texts = rows.agg(F.count_distinct("hash").alias("n")).first()["n"]
    limit = max(NEVER_FREQUENT, most_share * texts)
    counted = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    # Copies can only raise a count: terms that are frequent by rows are counted again by texts.
    often = [r["term"] for r in counted.filter(F.col("df") > limit).select("term").collect()]
    once = rows.select("hash", F.array_intersect("terms", literal_array(often, "bigint")).alias("terms")).dropDuplicates(["hash"])
    frequent = once.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).filter(F.col("df") > limit)
    enough = None
    if least_docs > 1:
        enough = rows.dropDuplicates(["hash"]).select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).filter(F.col("df") >= least_docs).select("term")
    return sorted(r["term"] for r in frequent.select("term").collect()), enough


def without_rare_terms(rows: DataFrame, enough: DataFrame, *names: str) -> DataFrame:
    """rows with only the terms of `enough` in the arrays `names`."""
    numbered = written(rows.withColumn("_row", F.monotonically_increasing_id()), "terms")

    def marked(k: int, n: str) -> Column:
        return F.transform(n, lambda t: F.struct(F.lit(k).alias("k"), t.alias("term")))

    held = F.array(*(marked(k, n) for k, n in enumerate(names)))
    found = numbered.select("_row", F.explode(F.flatten(held)).alias("t")).select("_row", "t.*").join(enough, "term")
    found = found.groupBy("_row").agg(*(F.collect_list(F.when(F.col("k") == k, F.col("term"))).alias(f"_{n}") for k, n in enumerate(names)))
    none = F.array().cast("array<bigint>")
    return numbered.drop(*names).join(found, "_row", "left").select("*", *(F.coalesce(f"_{n}", none).alias(n) for n in names)).drop("_row", *(f"_{n}" for n in names))


def place_hash(text: Column) -> Column:
    """The part of a text's hash that ranges are cut by: a number that percentiles, which are doubles, keep whole."""
    return F.shiftright(F.xxhash64(text), 12)


def _range_begins(rows: DataFrame) -> list[tuple[int, int, int]]:
    """Where ranges of about RANGE_BYTES begin in the order of (has an id, id, text hash): rows that occur, the very first before all.

    An id that holds several ranges is cut by the hash of its texts.
    """
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = rows.agg(F.count("*").alias("n"), F.count("doc_id").alias("named"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    if not size["n"]:
        return []
    parts = max(least, min(MOST_RANGES, -(-size["bytes"] // RANGE_BYTES)))
    at = [k / parts for k in range(parts)]
    named = max(1, parts * size["named"] // size["n"])
    ids = rows.agg(F.percentile_approx("doc_id", [k / named for k in range(named)], max(10_000, 10 * named)).alias("q"), F.min("doc_id").alias("low")).first()
    cuts: dict[int | None, int] = {}  # how many ranges begin at or inside an id
    for q in ids["q"] or ():
        cuts[q] = cuts.get(q, 0) + 1
    if ids["low"] is not None:
        cuts.setdefault(ids["low"], 1)
    if size["n"] > size["named"]:
        cuts[None] = max(1, parts - named)
    most = max(cuts.values())
    chosen = F.col("doc_id").isin([c for c in cuts if c is not None]) | F.col("doc_id").isNull()
    spread = F.percentile_approx("hash", [k / most for k in range(most)], 10_000)
    begins = set()
    for r in rows.filter(chosen).groupBy("doc_id").agg(F.min("hash").alias("low"), spread.alias("q")).collect():  # a row a cut
        k = cuts.get(r["doc_id"], 1)
        begins |= {(int(r["doc_id"] is not None), r["doc_id"] or 0, h) for h in (r["low"], *(r["q"][j * most // k] for j in range(1, k)))}
    return sorted(begins)


def with_next(docs: DataFrame, key: str, text: str, own: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text, next_text and the columns `own`, also as next_..., in ascending order of (id, text hash); the last row's next is the first.

    Ranges begin at rows that occur. Such rows also go to the range before, so one exchange of the texts
    brings every row together with its successor.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), *own).withColumn("hash", place_hash(F.col("text")))
    begins = _range_begins(rows) or [(0, 0, 0)]
    kind = "struct<a:int,b:bigint,c:bigint>"
    at_row = F.struct(F.col("doc_id").isNotNull().cast("int").alias("a"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("b"), F.col("hash").alias("c"))
    # A range is found in two steps: a block of ranges, then the range in it.
    width = max(1, int(len(begins) ** 0.5))
    blocks = [begins[k : k + width] for k in range(0, len(begins), width)]
    named = lambda cuts: [dict(zip("abc", c)) for c in cuts]
    firsts, inner = literal_array(named(b[0] for b in blocks), kind), literal_array([named(b) for b in blocks], f"array<{kind}>")

    def place(k: Column) -> Column:
        """struct(range, whether the row begins it)."""
        def inside(block: Column) -> Column:
            return let(F.get(inner, block), lambda cuts: F.struct((block * width + F.size(F.filter(cuts, lambda c: c <= k)) - 1).alias("b"), F.array_contains(cuts, k).alias("begins")))

        return let(F.greatest(F.size(F.filter(firsts, lambda c: c <= k)) - 1, F.lit(0)), inside)

    at = let(at_row, place)
    # (range, lap): lap 1 stands for the way round from the last row to the first.
    lap = F.struct(F.when(F.col("at.b") > 0, F.col("at.b") - 1).otherwise(len(begins) - 1).alias("b"), F.when(F.col("at.b") > 0, 0).otherwise(1).alias("lap"), F.lit(False).alias("own"))
    places = F.array_compact(F.array(F.struct(F.col("at.b").alias("b"), F.lit(0).alias("lap"), F.lit(True).alias("own")), F.when(F.col("at.begins"), lap)))
    dealt = rows.withColumn("at", at).select("doc_id", "text", *own, "hash", F.explode(places).alias("p")).select("doc_id", "text", *own, "hash", "p.*")
    order = W.partitionBy("b").orderBy("lap", F.asc_nulls_first("doc_id"), "hash", F.xxhash64("text"))
    return dealt.select("doc_id", "text", *own, "own", *(F.lead(c).over(order).alias(f"next_{c}") for c in ("text", *own))).filter("own").drop("own")


def edited(text: Column, next_text: Column) -> Column:
    """text with its last floor(n / 2) code points replaced by the first as many of next_text."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), (n - half).cast("int")), F.substring(F.coalesce(next_text, F.lit("")), F.lit(1), half))


def parts_of(terms: Column, text: Column, levels: tuple[tuple[int, int], ...] = LEVELS) -> Column:
    """The parts of the fingerprint as numbers below 2^32: for each sub-lexicon the hash of its sorted terms, or NO_PART."""
    short = lambda h: F.pmod(h, F.lit(1 << 32))

    def level(sorted_terms: Column, k: int) -> Column:
        count, sparsity = levels[k]
        drawn = lambda t: F.shiftright(t, 16 * k).bitwiseAND(F.lit(sparsity - 1).cast("long"))  # noqa: E731  each level by bits of its own
        own = F.filter(sorted_terms, lambda t: drawn(t) < count) if count < sparsity else sorted_terms
        part = lambda held, s: let(F.filter(held, lambda t: drawn(t) == s), lambda t: F.when(F.size(t) == 0, F.lit(NO_PART).cast("long")).otherwise(short(F.xxhash64(t))))
        return let(own, lambda held: F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda s: part(held, s)))

    found = let(F.sort_array(terms), lambda t: F.concat(*(level(t, k) for k in range(len(levels)))))
    return F.when(F.size(terms) == 0, F.array_repeat(short(F.xxhash64(text)), sum(count for count, _ in levels))).otherwise(found)


def printed(parts: Column) -> Column:
    """The parts as one text: eight digits each, NO_TERMS for a part without terms."""
    return F.array_join(F.transform(parts, lambda p: F.when(p == NO_PART, NO_TERMS).otherwise(F.lower(F.lpad(F.hex(p), 8, "0")))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of agreeing parts among those that a or b has terms for."""
    both = F.zip_with(a, b, lambda x, y: F.when((x == NO_PART) & (y == NO_PART), 0).when(x == y, 1).otherwise(2))
    return let(both, lambda kinds: F.when(F.exists(kinds, lambda k: k > 0), F.size(F.filter(kinds, lambda k: k == 1)) / F.size(F.filter(kinds, lambda k: k > 0))).otherwise(0.0))


def fingerprint_edits(docs: DataFrame, key: str = "doc_id", text: str = "text", levels: tuple[tuple[int, int], ...] = LEVELS, least_docs: int = LEAST_DOCS, most_share: float = MOST_SHARE) -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness to each other and to the next document's."""
    frequent, enough = term_counts(docs, text, most_share, least_docs)
    left_out = literal_array(frequent, "bigint")
    own = docs.select(key, F.coalesce(F.col(text), F.lit("")).alias(text))
    own = own.withColumn("terms", F.array_except(terms_of(F.col(text)), left_out))
    if enough is not None:
        own = without_rare_terms(own, enough, "terms")
    own = own.select(key, text, parts_of(F.col("terms"), F.col(text), levels).alias("parts"))
    rows = with_next(own, key, text, ("parts",)).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    rows = rows.withColumn("terms", F.array_except(terms_of(F.col("edited")), left_out))
    if enough is not None:
        rows = without_rare_terms(rows, enough, "terms")
    rows = rows.select(
        F.col("doc_id").alias(key), F.char_length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.col("parts").alias("own"), parts_of(F.col("terms"), F.col("edited"), levels).alias("other"), F.col("next_parts").alias("following"),
    )
    return rows.select(
        key, "n_chars", "edited_sha256", printed(F.col("own")).alias("fingerprint"), printed(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("following")).alias("near_next"),
    )


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))
