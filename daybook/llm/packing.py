"""Packing of tokenised documents into training sequences by cutting-stock column generation.

A document's ids are cut at multiples of the sequence length; each full run is a sequence of its own
and each remainder is an item. Items are counted by length class (lengths rounded up to a multiple of
`grain`). A linear program over patterns, which are ways to fill a sequence with classes, is solved by
column generation: it starts with one-class patterns, and a knapsack dynamic program prices the best
new pattern under the current duals until none improves. The solution is rounded down; what is left
is packed first-fit decreasing, which gives further patterns. Items are then ranked within their class
and the k-th item of a class takes the k-th place that the patterns offer to it.

The program sees only the histogram, of at most length/grain classes, so its cost does not depend on
the number of documents. Ranks come from counts per (partition, class), so no class meets in one task.

Null and empty texts are documents of the one closing id. Repeated rows are packed as often as they
stand there. Empty tables give no pieces. Columns other than key and text are not read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import small_parts, table, written

LENGTH, GRAIN, CLOSING_ID = 2048, 8, 1
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(2)
def loaded_tokenizer(path: str):
    """The tokenizer, once for each worker process, and by id whether a token ends a word."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
    ends = np.zeros(tokenizer.get_vocab_size(), bool)
    if suffix:
        ends[[i for token, i in tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
    return tokenizer, ends


@lru_cache(2)
def splits_at_blanks(path: str) -> bool:
    """Whether the file's tokenizer is of the kind whose texts can be cut at white space: small letters, blanks dropped, words found by a pattern."""
    import json

    with open(path, encoding="utf-8") as file:
        form = json.load(file)
    kinds = [n.get("type") for n in (form.get("normalizer") or {}).get("normalizers", ())]
    cut = ((form.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
    return kinds == ["NFC", "Replace", "Lowercase"] and (cut.get("type"), cut.get("behavior"), cut.get("invert")) == ("Split", "Removed", True)


def _encoded(texts: list[str], path: str) -> list[np.ndarray]:
    tokenizer, _ = loaded_tokenizer(path)
    return [np.array(e.ids, np.uint32) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


#: Characters that split runs here, but that the tokenizer does not take for white space.
_NO_SPACE = "[\\x1c-\\x1f]"
#: Small letters that no normalisation changes; a run of them is one word to the tokenizer.
_LETTERS = "^[a-z\u00df-\u00f6\u00f8-\u00ff]+$"
#: Runs that end in a mark which the tokenizer parts from the letter or digit before it.
_MARKED = "[0-9A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff][,.]$"
#: Begins the strings that the tokenizer takes for special tokens, in this case of letters only.
_SPECIAL = "<|"
#: Stems that the tokenizer gets as one text.
_JOINED = 256


def encode_stems(stems: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of stems one after the other, and how many each stem has.

    Stems of letters only are one word each: they are joined by blanks, encoded as one text, and told
    apart by the tokens that end words. Others are encoded one by one.
    """
    import pyarrow.compute as pc

    ends = loaded_tokenizer(path)[1]
    letters = pc.match_substring_regex(stems, _LETTERS).to_numpy(zero_copy_only=False) & ends.any()
    plain, rest = np.nonzero(letters)[0], np.nonzero(~letters)[0]
    cuts = np.r_[np.arange(0, len(plain), _JOINED), len(plain)].astype(np.int32)
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts), stems.take(pa.array(plain))), " ")
    parts = _encoded(joined.to_pylist(), path)
    last = np.nonzero(ends[np.concatenate(parts)])[0] if parts else np.zeros(0, np.int64)
    if len(last) != len(plain):
        raise ValueError("a word does not end with one token that ends words")
    others = _encoded(stems.take(pa.array(rest)).to_pylist(), path)
    sizes = np.zeros(len(stems), np.int64)
    sizes[plain] = np.diff(np.r_[-1, last])
    sizes[rest] = [len(ids) for ids in others]
    order = np.r_[plain, rest]
    begins = np.zeros(len(stems), np.int64)
    begins[order] = np.cumsum(sizes[order]) - sizes[order]
    return _gathered(np.concatenate([np.zeros(0, np.uint32), *parts, *others]), begins, sizes), sizes


def _gathered(flat: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of flat that begin at `begins`, one after the other."""
    ends = np.cumsum(sizes)
    return flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins - (ends - sizes), sizes)]


def encode_batch(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """All ids of texts (no nulls) one after the other, and how many each text has.

    Runs between white space are told apart and numbered by Arrow, in lower case and without a comma or
    full stop at their end, so that the tokenizer sees each different stem of a batch once; ids are
    gathered by number. Tokenizers of another kind see whole texts.
    """
    import pyarrow.compute as pc

    if not splits_at_blanks(path):
        ids = _encoded(texts.to_pylist(), path)
        return np.concatenate([np.zeros(0, np.uint32), *ids]), np.array([len(i) for i in ids], np.int64)

    runs = pc.utf8_split_whitespace(texts)
    odd = np.nonzero(pc.match_substring_regex(texts, _NO_SPACE).to_numpy(zero_copy_only=False))[0]
    if len(odd):
        lists = runs.to_pylist()
        for i in odd:
            lists[i] = [texts[i].as_py()]
        runs = pa.array(lists, pa.list_(pa.string()))
    coded = runs.flatten().dictionary_encode()
    words = coded.dictionary
    low = pc.if_else(pc.match_substring(words, _SPECIAL), words, pc.ascii_lower(words))
    marked = pc.match_substring_regex(low, _MARKED)
    stems = pc.if_else(marked, pc.utf8_slice_codeunits(low, 0, -1), low).dictionary_encode()
    flat, sizes = encode_stems(stems.dictionary, path)
    begins = np.cumsum(sizes) - sizes
    comma, stop = _encoded([",", "."], path)
    # The marks stand behind all stems; a run has its stem's ids, and those of its mark after them.
    ends_in = np.where(marked.to_numpy(zero_copy_only=False), np.where(pc.ends_with(low, ",").to_numpy(zero_copy_only=False), 1, 2), 0)
    mark_sizes = np.array([0, len(comma), len(stop)])
    mark_begins = len(flat) + np.array([0, 0, len(comma)])
    of = stems.indices.to_numpy()
    pair_begins = np.stack([begins[of], mark_begins[ends_in]], 1).reshape(-1) if len(of) else np.zeros(0, np.int64)
    pair_sizes = np.stack([sizes[of], mark_sizes[ends_in]], 1).reshape(-1) if len(of) else np.zeros(0, np.int64)
    by_word = _gathered(np.concatenate([flat, comma, stop]), pair_begins, pair_sizes)
    word_sizes = sizes[of] + mark_sizes[ends_in]
    at = coded.indices.to_numpy()
    ids = _gathered(by_word, (np.cumsum(word_sizes) - word_sizes)[at], word_sizes[at])
    cuts = np.r_[0, np.cumsum(runs.value_lengths().to_numpy())]
    return ids, np.diff(np.r_[0, np.cumsum(word_sizes[at])][cuts])


def tokenised_pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, tokenizer: str | None = None) -> DataFrame:
    """key, start, length, ids (binary, little-endian 32-bit), doc_tokens of every piece of every document."""
    path = tokenizer or tokenizer_path(TOKENIZER)
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        closing = np.array([CLOSING_ID], "<u4").tobytes()
        for part in small_parts(batches, 750):
            ids, sizes = encode_batch(part.column(1), path)
            packed, end = ids.tobytes(), 0
            at, start, lengths, pieces, totals = [], [], [], [], []
            for row, n in enumerate(sizes.tolist()):
                own = packed[4 * end : 4 * (end + n)] + closing
                end += n
                for s in range(0, len(own), 4 * length):
                    piece = own[s : s + 4 * length]
                    at.append(row)
                    start.append(s // 4)
                    lengths.append(len(piece) // 4)
                    pieces.append(piece)
                    totals.append(n + 1)
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(at, pa.int64())), pa.array(start, pa.int64()), pa.array(lengths, pa.int64()), pa.array(pieces, pa.binary()), pa.array(totals, pa.int64())], names=["doc_id", "start", "length", "ids", "doc_tokens"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(per_batch, f"doc_id {kind}, start long, length long, ids binary, doc_tokens long").withColumnRenamed("doc_id", key)


def best_pattern(values, units: int):
    """Unbounded knapsack: how often to take each of the sizes 1..len(values) within `units`, and its value."""
    sizes = np.arange(1, len(values) + 1)
    best, taken = np.zeros(units + 1), np.zeros(units + 1, np.int64)
    for room in range(1, units + 1):
        gain = best[room - sizes[: min(room, len(sizes))]] + values[: min(room, len(sizes))]
        k = int(gain.argmax())
        if gain[k] > best[room - 1] + 1e-12:
            best[room], taken[room] = gain[k], k + 1
        else:
            best[room] = best[room - 1]
    counts, room = np.zeros(len(values), np.int64), units
    while room > 0:
        if taken[room]:
            counts[taken[room] - 1] += 1
            room -= taken[room]
        else:
            room -= 1
    return counts, float(best[units])


def cutting_stock(demand, units: int, gap: float = 1e-4, most_rounds: int = 3000):
    """Patterns (rows: how many items of size 1..units) and how often to use each, covering demand exactly.

    demand[k] items have size k + 1. The last patterns may be partly filled.
    """
    demand = np.asarray(demand, np.int64)
    live = np.nonzero(demand)[0]
    patterns: dict[tuple, int] = {}

    def use(counts, times: int) -> None:
        if times:
            filled = tuple((int(k), int(counts[k])) for k in np.nonzero(counts)[0])
            patterns[filled] = patterns.get(filled, 0) + int(times)

    left = demand.copy()
    if len(live):
        m = len(live)
        each = units // (live + 1)
        basis = np.diag(each).astype(float)
        inverse = np.diag(1.0 / each)
        amounts = demand[live] / each
        for _ in range(most_rounds):
            duals = inverse.sum(0)
            values = np.full(units, -1.0)
            values[live] = duals
            counts, value = best_pattern(values, units)
            if value <= 1 + gap:
                break
            column = counts[live].astype(float)
            step = inverse @ column
            ratio = np.where(step > 1e-9, amounts / np.where(step > 1e-9, step, 1), np.inf)
            out = int(ratio.argmin())
            if not np.isfinite(ratio[out]):
                break
            amounts = np.maximum(amounts - ratio[out] * step, 0)
            amounts[out] = ratio[out]
            basis[:, out] = column
            row = inverse[out] / step[out]
            inverse -= np.outer(step, row)
            inverse[out] = row
        for j in np.argsort(-amounts, kind="stable"):
            counts = np.zeros(units, np.int64)
            counts[live] = np.rint(basis[:, j]).astype(np.int64)
            used = counts > 0
            times = min(int(np.floor(amounts[j] + 1e-6)), int((left[used] // counts[used]).min()))
            use(counts, times)
            left -= counts * times
    # First fit, largest first, of the few that rounding left; whole copies of a filled sequence at once.
    while left.any():
        counts, room = np.zeros(units, np.int64), units
        for k in np.nonzero(left)[0][::-1]:
            take = min(int(left[k]), room // (k + 1))
            counts[k] = take
            room -= take * (k + 1)
        used = counts > 0
        times = int((left[used] // counts[used]).min())
        use(counts, times)
        left -= counts * times
    return patterns


def pack(pieces: DataFrame, length: int = LENGTH, grain: int = GRAIN, order: tuple[str, ...] = ("doc_id", "start")) -> DataFrame:
    """Appends sequence_id and offset to pieces, a table with a `length` column (1..length).

    `order` ranks items within a class. pieces is read twice and should be a written table.
    """
    units = length // grain
    ranked = written(pieces.withColumns({"_part": F.spark_partition_id(), "_class": F.ceil(F.col("length") / grain).cast("int") - 1}), "pieces")
    counts = written(ranked.groupBy("_part", "_class").agg(F.count("*").alias("_n")), "classes")
    demand = np.zeros(units, np.int64)
    for r in counts.groupBy("_class").agg(F.sum("_n").alias("n")).collect():  # at most `units` rows
        demand[r["_class"]] = r["n"]
    patterns = sorted(cutting_stock(demand, units).items())
    # For each class: where the patterns' places for it begin, how many a sequence has, the pattern's first sequence.
    places: dict[int, list[tuple[int, int, int]]] = {}
    begun = [0] * units
    sequence = 0
    for filled, times in patterns:
        for k, each in filled:
            places.setdefault(k, []).append((begun[k], each, sequence))
            begun[k] += each * times
        sequence += times
    lookup = {k: tuple(np.array(x, np.int64) for x in zip(*v)) for k, v in places.items()}

    earlier = W.partitionBy("_class").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("_part", "_class", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    # Of items that agree in `order` the other columns decide, so that a task that is run again ranks them alike.
    rest = [c for c, kind in pieces.dtypes if c not in order and not kind.startswith(("array", "map", "struct"))]
    local = F.row_number().over(W.partitionBy("_part", "_class").orderBy(*order, *rest)) - 1
    items = ranked.withColumn("_row", local).join(starts, ["_part", "_class"]).withColumn("_rank", (F.col("_row") + F.col("_before")).cast("long")).drop("_row", "_before", "_part")
    at_class, at_rank = items.columns.index("_class"), items.columns.index("_rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, ranks = (batch.column(i).to_numpy(zero_copy_only=False) for i in (at_class, at_rank))
            sequences = np.zeros(len(classes), np.int64)
            for k in np.unique(classes):
                first, each, base = lookup[int(k)]
                mine = np.nonzero(classes == k)[0]
                p = np.searchsorted(first, ranks[mine], side="right") - 1
                sequences[mine] = base[p] + (ranks[mine] - first[p]) // each[p]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequences)], names=[*batch.schema.names, "sequence_id"])

    placed = items.mapInArrow(place, StructType([*items.schema.fields, StructField("sequence_id", LongType())]))
    before = W.partitionBy("sequence_id").orderBy(F.desc("_class"), "_rank").rowsBetween(W.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")).drop("_class", "_rank")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = tokenised_pieces(table(spark, sf_dir, "documents"))
    return pack(pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"))
