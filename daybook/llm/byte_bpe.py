"""Byte-level BPE encoding and decoding with Spark's higher-order functions.

A text is cut into words by the vocabulary's pattern. Each task encodes a different word once: the
word's bytes become a text of one character for each token, and `aggregate` folds the merges over it,
in ascending order of rank: a merge of rank r replaces the two characters of its pair, left to right,
by the one of the merged token. Pairs and merged tokens come from a literal map, indexed by rank.

Only the merges whose token stands somewhere in a word can happen in it. An Aho-Corasick automaton
lists their ranks with each new word, so a fold has as many steps as its word holds different tokens.
Taking ranks in ascending order is exact if each token of the vocabulary is built by merges of lower
rank: until a merge crosses the ends of a token's bytes, they merge as they would alone, so at their
rank they are the pair that makes the token; and after one crossed, they can never be that token. A
vocabulary without that property is refused (see merge_halves).

Words pass to Spark's functions and back in the order of a task's rows: the first step numbers each
new word and lists it with the row that has it first; the last step looks ids up by number. Nothing is
shuffled or broadcast beside the literals. Both steps forget their words when there are most_words;
words that come again are then encoded again, with the same ids. Words of any length are folded.

Decoding concatenates the tokens' binary pieces. Null texts are empty texts: no ids. Repeated rows are
encoded as often as they stand there; null keys stay null. Empty tables give no rows. Columns other
than key and text are not read.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import give_back, table

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Different words that a task keeps at hand.
MOST_WORDS = 400_000


@lru_cache(4)
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def vocabulary_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def merge_halves(ranks: dict[bytes, int]) -> dict[int, tuple[int, int]]:
    """For each token of several bytes the two tokens that its last merge joins, by rank.

    Fails if a token's bytes, merged by lower ranks alone, do not end as two tokens.
    """
    halves = {}
    for token, r in ranks.items():
        if len(token) == 1:
            continue
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            least, i = min((ranks.get(parts[i] + parts[i + 1], r), i) for i in range(len(parts) - 1))
            if least >= r:
                raise ValueError(f"merges of lower rank do not build the token of rank {r}")
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        if max(ranks.get(p, r) for p in parts) >= r and max(map(len, parts)) > 1:
            raise ValueError(f"a half of the token of rank {r} has no lower rank")
        halves[r] = (ranks[parts[0]], ranks[parts[1]])
    return halves


#: A token's character: its id moved past the control characters, and past the code points that are no characters.
_FIRST, _GAP, _GAP_SIZE = 0x20, 0xD800, 0x800


def character(token: int) -> str:
    at = token + _FIRST
    return chr(at if at < _GAP else at + _GAP_SIZE)


def tokens_of(characters: str) -> np.ndarray:
    points = np.frombuffer(characters.encode("utf-32-le"), np.uint32).astype(np.int32)
    return points - _FIRST - np.where(points >= _GAP, _GAP_SIZE, 0)


@lru_cache(4)
def literal_map(path: str) -> tuple[str, str, str]:
    """The characters of the 256 bytes; pairs and merged tokens by rank, as JSON."""
    ranks = read_ranks(path)
    halves = merge_halves(ranks)
    pairs = ["".join(map(character, halves[r])) if r in halves else "" for r in range(max(ranks.values()) + 1)]
    return "".join(character(ranks[bytes([b])]) for b in range(256)), json.dumps(pairs), json.dumps([character(r) for r in range(len(pairs))])


def fold_merges(word: Column, merges: Column, path: str) -> Column:
    """The characters of a word's tokens. merges: ascending ranks, among them all that can happen in the word."""
    singles, pairs, merged = literal_map(path)
    pair_of, token_of = (F.from_json(F.lit(x), "array<string>") for x in (pairs, merged))
    latin = "".join(map(chr, range(256)))
    start = F.translate(F.decode(word.cast("binary"), "ISO-8859-1"), latin, singles)
    return F.aggregate(merges, start, lambda text, r: F.replace(text, F.get(pair_of, r), F.get(token_of, r)))


@lru_cache(2)
def token_finder(path: str):
    """An automaton over the tokens of several bytes, as Latin-1 texts, with their ranks."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for token, r in read_ranks(path).items():
        if len(token) > 1:
            found.add_word(token.decode("latin-1"), r)
    found.make_automaton()
    return found


def candidates(words: list[str], path: str) -> pa.ListArray:
    """For each word, ascending, the ranks of the tokens of several bytes that stand in it."""
    find = token_finder(path).iter
    flat: list[int] = []
    ends = [0]
    for word in words:
        flat += sorted({r for _, r in find(word.encode().decode("latin-1"))})
        ends.append(len(flat))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))


def _numbered(path: str, most_words: int):
    """Numbers the words of each row; lists words that are new to the task, and their merges, with a batch's first row."""

    def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, int] = {}
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                lists = part.column(1)
                sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                coded = lists.flatten().dictionary_encode()
                words = coded.dictionary.to_pylist()
                fresh = len(known) + len(words) > most_words
                if fresh:
                    known.clear()
                new = [w for w in words if w not in known]
                for w in new:
                    known[w] = len(known)
                numbers = np.fromiter((known[w] for w in words), np.int32, len(words))[coded.indices.to_numpy(zero_copy_only=False)]
                cuts = np.r_[0, np.cumsum(sizes)].astype(np.int32)
                n = part.num_rows
                ends = pa.array([0] + [len(new)] * n, pa.int32())  # all with the first row
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(cuts), pa.array(numbers, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(new, pa.string())), pa.ListArray.from_arrays(ends, candidates(new, path)), pa.array([fresh] + [False] * (n - 1), pa.bool_())],
                    names=["doc_id", "numbers", "words", "merges", "fresh"],
                )
        known.clear()
        give_back()

    return per_partition


def _looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """ids of each row, from its words' numbers and the folded words listed so far."""
    import pyarrow.compute as pc

    ids, begins = np.zeros(0, np.int32), np.zeros(1, np.int64)
    for batch in batches:
        doc_id, numbers, folded, fresh = batch.columns
        turns = np.nonzero((folded.value_lengths().to_numpy(zero_copy_only=False) > 0) | fresh.to_numpy(zero_copy_only=False))[0]
        edges = sorted({0, *map(int, turns), *range(0, batch.num_rows, 500), batch.num_rows})
        for lo, hi in zip(edges, edges[1:]):
            if fresh[lo].as_py():
                ids, begins = ids[:0], begins[:1]
            own = folded.slice(lo, 1).flatten()
            if len(own):
                sizes = pc.utf8_length(own).to_numpy(zero_copy_only=False).astype(np.int64)
                ids = np.concatenate([ids, tokens_of("".join(own.to_pylist()))])
                begins = np.concatenate([begins, begins[-1] + np.cumsum(sizes)])
            part = numbers.slice(lo, hi - lo)
            at = part.flatten().to_numpy(zero_copy_only=False)
            sizes = begins[at + 1] - begins[at]
            ends = np.cumsum(sizes)
            out = ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(begins[at] - (ends - sizes), sizes)]
            rows = np.r_[0, np.cumsum(part.value_lengths().to_numpy(zero_copy_only=False))]
            cuts = np.r_[0, ends][rows].astype(np.int32)
            packed = out.astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays(
                [doc_id.slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(cuts), pa.array(out, pa.int32())), pa.array([packed[4 * a : 4 * b] for a, b in zip(cuts, cuts[1:])], pa.binary())],
                names=["doc_id", "ids", "packed"],
            )
    del ids, begins
    give_back()


def encode(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, pattern: str | None = None, most_words: int = MOST_WORDS) -> DataFrame:
    """key, ids (array<int>) and packed (the ids as little-endian unsigned 32-bit numbers) of every row."""
    path, pattern = path or vocabulary_path(), pattern or vocabulary_pattern()
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    # (?U): white space is Unicode's.
    words = rows.select("doc_id", F.regexp_extract_all("text", F.lit(f"(?U){pattern}"), F.lit(0)).alias("words"))
    numbered = words.mapInArrow(_numbered(path, most_words), f"doc_id {kind}, numbers array<int>, words array<string>, merges array<array<int>>, fresh boolean")
    folded = F.zip_with("words", "merges", lambda word, merges: fold_merges(word, merges, path))
    coded = numbered.select("doc_id", "numbers", folded.alias("folded"), "fresh")
    return coded.mapInArrow(_looked_up, f"doc_id {kind}, ids array<int>, packed binary").withColumnRenamed("doc_id", key)


def decode(ids: Column, path: str | None = None) -> Column:
    """The bytes of an array of ids."""
    pieces = [p.decode("latin-1") for p, _ in sorted(read_ranks(path or vocabulary_path()).items(), key=lambda x: x[1])]
    literal = F.from_json(F.lit(json.dumps(pieces)), "array<string>")
    return F.encode(F.array_join(F.transform(ids, lambda i: F.get(literal, i)), ""), "ISO-8859-1")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode(table(spark, sf_dir, "documents"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2("packed", 256).alias("ids_sha256"), F.sha2(decode(F.col("ids")), 256).alias("decoded_sha256"))
