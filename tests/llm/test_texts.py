import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import public_tokenizers
from daybook.llm import byte_bpe, imatch, packing, shards

ODD = ["", None, "   ", "a", "aaaa" * 200, "x" * 3000, "don't 'S we'll  x1234\n\n\ty", "é" * 300, "日本語テキスト😀 ok", "　 x", "a\x1cb \x85c", "THE.THE, 3.,, ΣΑΣ İ,", "<|endoftext|> z", "word " * 3000, "A<|startoftext|>B. x<|ENDOFTEXT|>, <|endoftext|>, a,b c,, İx. É, Éa. \u212b. e\u0301, \u2028q, 𝒳y, 1. x\u00d7."]


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(texts)], "doc_id long, text string, ids string, length int").repartition(3)


def test_byte_bpe_equals_the_library_and_round_trips(spark):
    e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(byte_bpe.vocabulary_path()), special_tokens={})
    coded = byte_bpe.encode(docs(spark, ODD))
    got = coded.select("doc_id", "ids", "packed", byte_bpe.decode(coded["ids"]).alias("back")).collect()
    assert len(got) == len(ODD)
    for r in got:
        text = ODD[r["doc_id"]] or ""
        assert r["ids"] == e.encode_ordinary(text)
        assert bytes(r["packed"]) == np.array(r["ids"], "<u4").tobytes() and bytes(r["back"]) == text.encode()
    assert byte_bpe.encode(docs(spark, ODD).limit(0)).count() == 0


def plain_merges(word, ranks):
    """Again and again the leftmost pair of least rank."""
    parts = [word[i : i + 1] for i in range(len(word))]
    while len(parts) > 1:
        rank, i = min((ranks.get(parts[i] + parts[i + 1], len(ranks)), i) for i in range(len(parts) - 1))
        if rank == len(ranks):
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


def test_words_of_all_lengths_go_through_the_fold(spark):
    path = byte_bpe.vocabulary_path()
    ranks = byte_bpe.read_ranks(path)
    e = tiktoken.Encoding("own", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    rng = np.random.default_rng(0)
    letters = list("abcdefth éîß日本")
    texts = ["".join(rng.choice(letters, n)) for n in (1, 2, 3, 50, 257, 800, 5000)] + ["x" * n for n in (257, 1000, 5000)] + ["ab" * 900 + "a", "".join(rng.choice(list("ACGT"), 5000))]
    texts += ["".join(rng.choice(list("etaoin shrdlu"), rng.integers(1, 30))) for _ in range(3000)]
    got = {r["doc_id"]: r["ids"] for r in byte_bpe.encode(docs(spark, texts), pattern=r"[\s\S]+").collect()}
    for i, text in enumerate(texts):
        assert got[i] == e.encode_ordinary(text), text[:50]
        if len(text) < 300:
            assert got[i] == plain_merges(text.encode(), ranks)


def test_forgotten_words_are_encoded_again(spark):
    path = byte_bpe.vocabulary_path()
    e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(path), special_tokens={})
    texts = [f"word{i % 7} and{i} some other{i % 3} thing" for i in range(5000)]
    got = byte_bpe.encode(docs(spark, texts).coalesce(1), most_words=50).collect()
    assert all(r["ids"] == e.encode_ordinary(texts[r["doc_id"]]) for r in got)


def test_a_vocabulary_that_ranks_cannot_order_is_refused():
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 256, b"ab": 257}
    with pytest.raises(ValueError):
        byte_bpe.merge_halves(ranks)


def test_packing_covers_every_id_once(spark):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = packing.tokenised_pieces(docs(spark, ODD * 5), length=256)
    got = packing.pack(pieces, length=256).toPandas()
    for i, text in enumerate(ODD * 5):
        own = got[got["doc_id"] == i].sort_values("start")
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        assert b"".join(own["ids"]) == np.array(ids, "<u4").tobytes() and (own["doc_tokens"] == len(ids)).all()
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s["length"].sum() <= 256 and (s["length"].cumsum() - s["length"] == s["offset"]).all()
    assert packing.pack(packing.tokenised_pieces(docs(spark, ODD).limit(0))).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_cutting_stock_meets_demand_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    demand = rng.integers(0, 200, 64) * (rng.random(64) < 0.5)
    patterns = packing.cutting_stock(demand, 64)
    met = np.zeros(64, np.int64)
    for filled, times in patterns.items():
        assert sum((k + 1) * n for k, n in filled) <= 64
        for k, n in filled:
            met[k] += n * times
    assert (met == demand).all()
    rooms: list[int] = []  # first fit, largest first
    for size in range(64, 0, -1):
        for _ in range(demand[size - 1]):
            at = next((i for i, room in enumerate(rooms) if room >= size), None)
            if at is None:
                rooms.append(64)
                at = -1
            rooms[at] -= size
    assert sum(patterns.values()) <= len(rooms) + 1
    assert not packing.cutting_stock(np.zeros(8, np.int64), 8)


def test_words_between_white_space_encode_like_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    texts = [x or "" for x in ODD]
    ids, sizes = packing.encode_batch(pa.array(texts), path)
    at = np.r_[0, np.cumsum(sizes)]
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_shards_are_near_equal_gapless_and_keep_small_groups(spark):
    texts = [f"text {i % 150} " * (1 + i % 7) for i in range(2000)] + ["hot " * 20] * 1000 + [None, "", ""]
    got = shards.shard_by_bytes(docs(spark, texts)).toPandas()
    assert len(got) == len(texts)
    for r in got.itertuples():
        raw = (texts[r.doc_id] or "").encode()
        assert r.size == len(raw) + 1 and r.text_crc32 == zlib.crc32(raw)
    bytes_ = got.groupby("shard")["size"].sum()
    assert len(bytes_) == 8 and bytes_.max() < 1.06 * bytes_.mean() and bytes_.min() > 0.94 * bytes_.mean()
    for _, s in got.groupby("shard"):
        assert sorted(s["slot"]) == list(range(len(s)))
    split = got.groupby(got["doc_id"].map(lambda i: texts[i] or ""))["shard"].nunique()
    assert set(split[split > 1].index) <= {"hot " * 20}
    assert shards.shard_by_bytes(docs(spark, texts).limit(0)).count() == 0
    assert shards.shard_by_bytes(docs(spark, ["one"])).count() == 1


def test_imatch_edits_and_order(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    got = {r["doc_id"]: r for r in imatch.op7_fingerprints(spark, sf_dir).collect()}
    assert len(got) == len(rows)
    prints = {}
    for i, r in enumerate(rows):
        text, following = r["text"] or "", rows[(i + 1) % len(rows)]["text"] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own = got[r["doc_id"]]
        assert own["n_chars"] == len(text) and own["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, own["fingerprint"]) == own["fingerprint"]
        assert 0 <= own["near_edited"] <= 1 and 0 <= own["near_next"] <= 1
    assert np.mean([r["near_edited"] for r in got.values()]) > 5 * np.mean([r["near_next"] for r in got.values()])
    long = [k for k, r in enumerate(rows) if len(set((r["text"] or "").split())) >= 20]
    nearer = [got[rows[k]["doc_id"]]["near_edited"] > got[rows[k]["doc_id"]]["near_next"] for k in long]
    assert len(long) > 0.8 * len(rows) and np.mean(nearer) > 0.97


def plain_prints(spark, texts, levels, least_docs, most_share):
    """Parts of each text's fingerprint by loops over its terms."""
    split = {t: {w for w in re.split(r"[\W_]+", t.lower()) if w} for t in set(texts)}
    words = sorted(set().union(*split.values())) or [""]
    hashed = {r["w"]: r["h"] for r in spark.createDataFrame([(w,) for w in words], "w string").select("w", F.xxhash64("w").alias("h")).collect()}
    known = {t for t in split if t in set(texts)}
    df = {w: sum(w in split[t] for t in known) for w in words}
    band = {w for w in words if least_docs <= df[w] <= max(imatch.NEVER_FREQUENT, most_share * len(known))}
    out = {}
    for t in known:
        own = sorted(hashed[w] for w in split[t] & band)
        out[t] = [tuple(h for h in own if (h >> 16 * k) % sparsity == s) for k, (count, sparsity) in enumerate(levels) for s in range(count)] if own else [("text", t)] * sum(c for c, _ in levels)
    return out


def plain_likeness(a, b):
    seen = [(x, y) for x, y in zip(a, b) if x or y]
    return sum(x == y for x, y in seen) / len(seen) if seen else 0.0


@pytest.mark.parametrize("least_docs, levels", [(1, imatch.LEVELS), (2, ((4, 4), (3, 8)))])
def test_imatch_is_the_plain_one(spark, least_docs, levels):
    rng = np.random.default_rng(5)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    texts = [" ".join(rng.choice(words, rng.integers(0, 60))) + " the" for _ in range(60)]
    texts += [texts[0]] * 30 + ["", "...", "The"]  # copies do not make their words frequent
    got = {r["doc_id"]: r for r in imatch.fingerprint_edits(docs(spark, texts), levels=levels, least_docs=least_docs).collect()}
    prints = plain_prints(spark, texts, levels, least_docs, imatch.MOST_SHARE)
    assert any(() not in p and p[0][0] != "text" for p in prints.values()) or len(levels) == 3
    for i, text in enumerate(texts):
        own, following = prints[text], prints[texts[(i + 1) % len(texts)]]
        assert got[i]["near_next"] == pytest.approx(plain_likeness(own, following))
        cut = re.findall("-|[0-9a-f]{8}", got[i]["fingerprint"])
        assert len(cut) == len(own) and [c == imatch.NO_TERMS for c in cut] == [p == () for p in own]
    covered = sum(count / sparsity for count, sparsity in levels[:1])
    assert covered == 1


def test_imatch_of_an_id_that_many_rows_share(spark, monkeypatch):
    monkeypatch.setattr(imatch, "RANGE_BYTES", 200)
    texts = [f"text number {i}" for i in range(400)]
    rows = [(7 if i % 3 else i if i % 2 else None, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(imatch._range_begins(frame.withColumn("hash", imatch.place_hash(F.col("text"))))) > 20
    sizes = imatch.with_next(frame, "doc_id", "text").collect()
    assert sorted(r["text"] for r in sizes) == sorted(texts) == sorted(r["next_text"] for r in sizes)
    order = [r["text"] for r in frame.orderBy(F.asc_nulls_first("doc_id"), F.xxhash64("text")).collect()]
    assert {r["text"]: r["next_text"] for r in sizes} == dict(zip(order, order[1:] + order[:1]))


def test_imatch_odd_rows(spark):
    got = imatch.fingerprint_edits(docs(spark, [*ODD, "same text here", "same text here"])).collect()
    assert len(got) == len(ODD) + 2
    last = {r["doc_id"]: r for r in got}
    n = len(ODD)
    assert last[n]["near_next"] == 1.0 and last[n]["fingerprint"] == last[n + 1]["fingerprint"]
    assert last[n + 1]["edited_sha256"] == hashlib.sha256(b"same te").hexdigest()
    repeated = spark.createDataFrame([(1, "b"), (1, "a"), (None, "c"), (2, "dd")], "doc_id long, text string")
    assert imatch.fingerprint_edits(repeated).count() == 4
    assert imatch.fingerprint_edits(repeated.limit(0)).count() == 0


def test_shards_equal_their_sql(spark, sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet' UNION ALL SELECT doc_id + 100000, text, lang, source, n_chars FROM '{sf_dir}/documents.parquet' WHERE doc_id % 3 = 0")
    whole = spark.read.parquet(f"{sf_dir}/documents.parquet")
    both = whole.unionByName(whole.filter("doc_id % 3 = 0").withColumn("doc_id", F.col("doc_id") + 100000))
    names = ["doc_id", "size", "text_crc32", "shard", "slot"]
    want = con.execute(f"SELECT {', '.join(names)} FROM ({shards.oracle()}) o").fetchall()
    assert sorted(want) == sorted(tuple(r) for r in shards.shard_by_bytes(both).select(*names).collect())
