import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import periods


def plain_runs(words, least=6, times=4):
    """Every run by the definition: all periods, all stretches, smallest period by trial."""
    n, found = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            own = words[i : i + length]
            if length >= max(least, times * q) and not any(own[p:] == own[:-p] for p in range(1, q)):
                found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain(doc_id, text):
    words = [w for w in (text or "").encode().split()]
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = plain_runs(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    line = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    own = best or (None, None, None)
    return (doc_id, len(found), *own, 1000 * best[1] // best[2] if best else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(line).hexdigest())


def repeating(rng, n):
    out = []
    while len(out) < n:
        unit = [rng.choice("abc") for _ in range(rng.choice([1, 1, 2, 3, 4, 5, 7, 8, 9, 16, 31, 33, 64, 100]))]
        out += unit * rng.randint(1, 7)
        out = out[: len(out) - rng.randint(0, 3)] + [rng.choice("abcdef") for _ in range(rng.randint(0, 3))]
    return out[:n]


def test_z_function():
    rng = random.Random(1)
    for _ in range(200):
        s = [rng.randint(0, 1) for _ in range(rng.randint(0, 30))]
        assert periods.z_function(s) == [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]


@pytest.mark.parametrize("tile", [8, 64, 1 << 13])
def test_runs_are_those_of_the_definition(spark, monkeypatch, tile):
    """Small tiles make every run cross several of them."""
    monkeypatch.setattr(periods, "TILE", tile)
    monkeypatch.setattr(periods, "TILE_PERIODS", min(16, tile))
    rng = random.Random(tile)
    found = 0
    for _ in range(150):
        letters = repeating(rng, rng.randint(0, 600))
        words = np.array([ord(c) for c in letters], np.int32)
        spans = {}
        for low, high, begin, end in periods.tiles_of(len(words)):
            before, after = periods.margins(high)
            first = max(0, begin - before)
            for octave in range(low, high + 1):
                for q, a, b in periods.tile_fragments(words[first : end + after], octave, (begin - first, end - first)):
                    spans.setdefault(q, []).append((first + a, first + b))
        got = []
        for q, parts in spans.items():
            whole = []
            for a, b in sorted(parts):
                if whole and a <= whole[-1][1]:
                    whole[-1][1] = max(whole[-1][1], b)
                else:
                    whole.append([a, b])
            got += [(a, b - a + q, q) for a, b in whole if b - a + q >= max(6, 4 * q)]
        assert sorted(got, key=lambda r: (r[0], r[2])) == plain_runs(letters)
        found += len(got)
    assert found > 300


def test_query_on_odd_texts(spark, tmp_path):
    rng = random.Random(5)
    rows = [(k, " ".join(repeating(rng, rng.randint(0, 300)))) for k in range(60)]
    edited = [k for k in range(3000) if zlib.crc32(str(k).encode()) % 10 == 0][6:30]
    rows += [(k, " ".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(1, 400)))) for k in edited if k >= 60]
    rows += [(9001, None), (9002, ""), (9003, "é　x " * 9), (9004, "a " * 20_000), (9005, " \t\n\x0b\x0c\r"), (9006, "a\x1cb " * 7), (None, "x y " * 5), (None, "z"), (-3, "one two " * 30), (9007, "b " * 6), (9008, "b " * 5)]
    rows += [(9010, "same text " * 8), (9010, "same text " * 8), (9010, "other text"), (9011, " ".join(f"w{i % 5000}" for i in range(21_000)))]
    path = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string").withColumn("Period", F.lit(1)).withColumn("runs", F.lit("x")).write.parquet(f"{path}/documents.parquet")
    got = sorted((tuple(r) for r in periods.op11_periods(spark, path).collect()), key=repr)
    brute = [r for r in rows if len((r[1] or "").split()) < 5000]
    assert [r for r in got if r[0] not in (9004, 9011)] == sorted((plain(*r) for r in brute), key=repr)
    long = {r[0]: r for r in got if r[0] in (9004, 9011)}
    assert long[9004][1:6] == (1, 0, 20_000, 1, 20_000_000) and long[9011][1:6] == (1, 0, 21_000, 5000, 4200)
    assert long[9004][7] == hashlib.sha256(b"a").hexdigest() and long[9011][7] == hashlib.sha256(b" ".join(b"w%d" % i for i in range(5000))).hexdigest()


def test_no_rows(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = periods.op11_periods(spark, str(tmp_path))
    assert out.collect() == [] and out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
