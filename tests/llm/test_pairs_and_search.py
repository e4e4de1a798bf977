import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from daybook.llm import components, simhash, topk, url_filter


def flip(f, n, rng):
    for bit in rng.sample(range(64), n):
        f ^= 1 << bit
    return f


def groups(values, radius):
    label = list(range(len(values)))
    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius and label[i] != label[j]:
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    return label


def same(a, b):
    return all((a[i] == a[j]) == (b[i] == b[j]) for i in range(len(a)) for j in range(i))


@pytest.mark.parametrize("radius", [1, 2, 4, 6])
def test_masks_cover_every_pair_within_the_radius(radius):
    masks = simhash.covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    rng = random.Random(radius)
    for _ in range(3000):
        differ = sum(1 << b for b in rng.sample(range(64), radius))
        assert any(not m % (1 << 64) & differ for m in masks)


def test_spanning_links_connect_what_all_pairs_connect():
    rng = random.Random(1)
    for _ in range(120):
        bases = [rng.getrandbits(64) for _ in range(rng.randint(1, 3))]
        values = sorted({flip(rng.choice(bases), rng.randint(0, 8), rng) for _ in range(rng.randint(2, 50))})
        links = simhash.spanning_links(np.array(values, np.uint64), 4)
        assert len(links) < len(values)
        label = list(range(len(values)))
        for i, j in links:
            assert (values[i] ^ values[j]).bit_count() <= 4
            label = [label[j] if x == label[i] else x for x in label]
        assert same(label, groups(values, 4))


@pytest.mark.parametrize("chunk", [3, 4096])
def test_links_of_large_and_small_buckets(spark, chunk):
    rng = random.Random(2)
    values = sorted({flip(0, rng.randint(0, 6), rng) for _ in range(60)} | {rng.getrandbits(64) for _ in range(20)})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    nodes = spark.createDataFrame([(i, [f]) for i, f in enumerate(signed)], "id long, fps array<long>")
    found = {r["node"]: r["component"] for r in components.components(simhash.links(nodes, 4, chunk)).collect()}
    assert same([found.get(i, i) for i in range(len(values))], groups(values, 4))


def test_chunks_part_texts_of_one_fingerprint(spark):
    nodes = spark.range(600).select("id", F.array(F.lit(5).cast("long")).alias("fps"))
    sizes = simhash.dealt_buckets(nodes, 1, 1, 50).groupBy("v", "key", "i", "j").count()
    assert sizes.agg(F.max("count")).first()[0] < 200
    assert {r["component"] for r in components.components(simhash.links(nodes, 1, 50)).collect()} == {0}


def test_components_of_chains_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 30)] + [(5, 5), (None, 3)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(30)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicate_groups_of_odd_rows(spark):
    text = " ".join(f"word{i}" for i in range(300))
    rows = [(3, text, "x"), (1, text, "x"), (1, text, "y"), (2, text + " more", "x"), (9, None, "x"), (8, "", "x"), (7, "\x0b \x1c", "x"), (None, text, "x"), (6, "other words here", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = simhash.near_duplicate_groups(docs).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r["component_id"] for r in got}
    assert by == {3: 1, 1: 1, 2: 1, 9: 8, 8: 8, 7: by[7], None: 1, 6: 6}
    assert simhash.fingerprint("") == 0 == simhash.fingerprint(None) and simhash.fingerprint("A B") == simhash.fingerprint("a\tb")
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    named = sorted(r["doc_id"] for r in kept.filter("doc_id IS NOT NULL").collect())
    assert named == [1, 6, 7, 8] and kept.filter("doc_id IS NULL").count() == 0
    apart = spark.createDataFrame([(1, "a b c d e", 1), (1, "v w x y z", 2), (1, "v w x y z", 3), (None, "a b c d e", 4), (None, "only here", 5)], "doc_id long, text string, _hash int")
    assert sorted((r["doc_id"] or 0, r["text"]) for r in simhash.drop_near_duplicates(apart).collect()) == [(0, "only here"), (1, "a b c d e"), (1, "v w x y z")]
    assert simhash.drop_near_duplicates(docs.limit(0)).count() == 0
    assert simhash.near_duplicate_groups(docs.limit(0)).count() == 0


def test_stage_drops_alike_texts_only(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    base = [[rng.choice(words) for _ in range(250)] for _ in range(12)]
    texts, twin = [], {}
    for k, b in enumerate(base):
        for edits in (0, 2, 60):  # the same, alike (0.9 of shingles), not alike
            w = list(b)
            for at in rng.sample(range(250), edits):
                w[at] = rng.choice(words)
            twin[len(texts)] = (k, edits)
            texts.append(" ".join(w))
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), radius=6, shingle=1, distinct=True).collect()}
    assert all((i in kept) == (edits != 2) for i, (_, edits) in twin.items())


def runs_of(text):
    w = text.split()
    return set(zip(*(w[i:] for i in range(5)))) if len(w) >= 5 else {tuple(w)}


def alike_groups(texts, may_link=lambda i, j: True):
    """For each text the least one that links of 0.8 of five-word runs reach."""
    runs = [runs_of(t) for t in texts]
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if label[i] != label[j] and may_link(i, j) and len(runs[i] & runs[j]) >= 0.8 * len(runs[i] | runs[j]):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


def edited_copies(rng, copies, words):
    base = [f"w{rng.randrange(100000)}" for _ in range(words)]
    texts = []
    for _ in range(copies):  # alike to the original, mostly not to each other
        w = list(base)
        for at in rng.sample(range(words), words // 50):
            w[at] = f"v{rng.randrange(100000)}"
        texts.append(" ".join(w))
    texts.insert(copies // 2, " ".join(base))
    return texts


@pytest.mark.parametrize("copies, words, chunk, count, radius", [(300, 300, 4096, 1, 6), (120, 1500, 50, 1, 6), (200, 200, 60, 16, 2)])
def test_stage_against_brute_force_on_a_dense_group(spark, copies, words, chunk, count, radius):
    texts = edited_copies(random.Random(copies), copies, words)
    prints = [[f % (1 << 64) for f in simhash.fingerprint_set(t, 1, distinct=True, count=count)] for t in texts]
    near = lambda i, j: any((a ^ b).bit_count() <= radius for a, b in zip(prints[i], prints[j]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(docs, radius=radius, shingle=1, distinct=True, count=count, chunk=chunk).collect()}
    assert kept == set(alike_groups(texts, near))


def test_stage_finds_nearly_all_pairs_that_are_just_alike(spark):
    rng = random.Random(9)
    texts = []
    for k in range(250):  # one text and a copy at 0.8 to 0.9, as short as such a copy can be and longer
        n = rng.choice([60, 90, 120, 250, 600])
        base = [f"w{rng.randrange(20000)}" for _ in range(n)]
        copy = list(base)
        for at in rng.sample(range(n), max(1, n // 60)):
            copy[at] = f"v{rng.randrange(20000)}"
        texts += [" ".join(base), " ".join(copy)]
    alike = [k for k in range(250) if alike_groups(texts[2 * k : 2 * k + 2]) == [0, 0]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r["doc_id"] for r in corpus_pipeline.keep_one_of_near_duplicates(spark, docs, "").collect()}
    assert len(alike) > 200 and sum(2 * k + 1 not in kept for k in alike) >= 0.95 * len(alike)
    assert all({2 * k, 2 * k + 1} <= kept for k in range(250) if k not in alike) and all(2 * k in kept for k in range(250))


def test_fingerprint_is_the_plain_one():
    from xxhash import xxh64

    def plain(text):
        words = re.findall(r"[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        runs = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
        hashes = [xxh64(r.encode(), seed=42).intdigest() for r in runs]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    rng = random.Random(4)
    texts = ["", " ", "one", "A b C d", "É É é\u00a0x\x1cy z\x0bq", "a b c d a b c d a b c d"] + [" ".join(rng.choice("ab Ab c\td ée x\u2003y".split(" ")) for _ in range(rng.randint(1, 40))) for _ in range(300)]
    texts.append(" ".join(f"w{rng.randrange(500)}" for _ in range(40_000)))
    assert [simhash.fingerprint(t) % (1 << 64) for t in texts] == list(map(plain, texts))


def test_null_ids_bridge_two_groups(spark):
    """Only a row without an id has the fingerprint between two that are too far from each other."""
    rng = random.Random(6)
    words = [f"w{k}" for k in range(12)]
    while True:
        a, b, c = ([rng.choice(words) for _ in range(4000)] for _ in "abc")
        b = a[:3990] + b[3990:]
        c = b[:3900] + c[3900:]
        texts = [" ".join(x) for x in (a, b, c)]
        f, g, h = (simhash.fingerprint(t) for t in texts)
        apart = lambda x, y: ((x ^ y) % (1 << 64)).bit_count()
        if apart(f, g) <= 4 and apart(g, h) <= 4 < apart(f, h):
            break
    docs = spark.createDataFrame([(1, texts[0]), (None, texts[1]), (2, texts[2])], "doc_id long, text string")
    assert {r["component_id"] for r in simhash.near_duplicate_groups(docs).collect()} == {1}


def test_op3_against_all_pairs(spark, sf_dir):
    got = simhash.op3_simhash(spark, sf_dir).toPandas()
    values = [int(x, 16) for x in got["fingerprint"]]
    label = groups(values, 4)
    least = {}
    for g, d in zip(label, got["doc_id"]):
        least[g] = min(d, least.get(g, d))
    assert [least[g] for g in label] == got["component_id"].tolist()


@pytest.mark.parametrize("shard_bytes, least_rows, fan_in", [(400, 1, 3), (1 << 20, 1000, 16)])
def test_topk_against_all_products(spark, shard_bytes, least_rows, fan_in):
    rng = np.random.default_rng(0)
    v = rng.integers(-3, 4, (400, 5))
    rows = [(i, [float(x) / 64 for x in r]) for i, r in enumerate(v.tolist())]
    rows += [(20, [1.0] * 5), (20, [1.0] * 5), (21, rows[21][1]), (40, rows[40][1])]  # ids and rows that repeat
    odd = [(400, None), (401, [1.0, None, 0.0, 0.0, 0.0]), (402, [float("nan")] * 5), (403, [float("inf")] * 5), (None, [0.0] * 5), (404, [0.5])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows + odd], "vec_id long, embedding array<float>, row string, shard int")
    got = topk.exact_top_k(topk.whole_vectors(df), F.col("id") % 20 == 0, 7, shard_bytes, least_rows, fan_in).collect()
    w = np.array([[round(64 * x) for x in r[1]] for r in rows])
    want = []
    for n, (q, _) in enumerate(rows):
        if q % 20 == 0:
            best = sorted((-int(w[n] @ w[m]), c) for m, (c, _) in enumerate(rows) if m != n)[:7]
            want += [(q, k + 1, c, -s) for k, (s, c) in enumerate(best)]
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == sorted(want)
    assert topk.exact_top_k(topk.whole_vectors(df).limit(0), F.col("id") % 20 == 0).count() == 0


def test_topk_of_one_repeated_id(spark):
    df = spark.createDataFrame([(20, [1.0]), (20, [2.0]), (20, [3.0]), (20, [4.0]), (1, [0.5]), (2, [0.25]), (3, [0.125])], "vec_id long, embedding array<double>")
    got = topk.exact_top_k(topk.whole_vectors(df), F.col("id") % 20 == 0, 3).collect()
    assert len(got) == 12
    assert sorted(r["score"] for r in got if r["rank"] == 1) == [64 * 64 * 4, 64 * 64 * 8, 64 * 64 * 12, 64 * 64 * 12]


def test_topk_ties_at_the_last_place_across_shards(spark):
    df = spark.createDataFrame([(i, [1.0, 1.0]) for i in range(500)], "vec_id long, embedding array<double>")
    got = topk.exact_top_k(topk.whole_vectors(df), F.col("id") % 20 == 0, 4, 320, 1, 2).collect()
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append(r["vec_id"])
    assert len(by) == 25 and all(sorted(found) == [c for c in range(6) if c != q][:4] for q, found in by.items())


def test_urls(spark):
    urls = ["https://a.example.org/es/x", "http://EXAMPLE.org/en/1?x", "http://x.org", "http://x.org/", "https://my-casino.net/", "https://free-bets.net/", "https://freebets.net/", "https://free.net/free", "no host", None, "", "ftp://b.com/de/casino", "http://a.com/fr/casino?q=://b.org/"]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge_urls(df).collect()}
    assert [got[i] for i in range(len(urls))] == [
        ("a.example.org", "/es/x", "example.org/es/", "block"), ("example.org", "/en/1", "example.org/en/1", "block"), ("x.org", "", None, "allow"), ("x.org", "/", "org/", "allow"),
        ("my-casino.net", "/", None, "block"), ("free-bets.net", "/", None, "block"), ("freebets.net", "/", None, "allow"), ("free.net", "/free", None, "allow"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("b.com", "/de/casino", "com/de/", "block"), ("a.com", "/fr/casino", "com/fr/", "allow"),
    ]
    assert url_filter.judge_urls(df.limit(0)).count() == 0


def test_urls_against_plain_search(spark):
    rng = random.Random(7)
    alphabet = ["ab", "-", "/", ".", "1", "é", "пор", "но", "赌场", "b", "AB", "_"]
    weights = {"".join(rng.choice(alphabet).lower() for _ in range(rng.randint(1, 4))): rng.choice([1, 1, 1, 2, 3]) for _ in range(4000)}
    urls = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12))) for _ in range(1500)] + ["ab-" * 100_000, "x" * 300_000, None]
    rows = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)], "page_id long, url string, weight int")
    terms = spark.createDataFrame([*weights.items(), (None, 1), ("", 2), ("ab", None)], "term string, weight int")
    assert url_filter.vocabulary(terms) == weights
    got = {r["page_id"]: (r["strict_hits"], r["soft_hits"], r["weight"], r["verdict"]) for r in url_filter.judge_urls(rows, weights=weights, rules=()).collect()}
    word = lambda c: c.isascii() and c.isalnum()
    for i, url in enumerate(urls[:1500] + [urls[-1]]):
        low = url_filter.lowered(url or "")
        hit = {t: w for t, w in weights.items() for at in range(len(low)) if low.startswith(t, at) and not (at and word(low[at - 1])) and not word(low[at + len(t) : at + len(t) + 1] or "-")}
        strict, total = sum(w >= 2 for w in hit.values()), sum(hit.values())
        assert got[i if i < 1500 else len(urls) - 1] == (strict, len(hit) - strict, total, "block" if total >= 2 else "allow")


@pytest.mark.parametrize("copies", [2_000, 8_000, 32_000])
def test_links_a_row_of_a_dense_group(spark, copies):
    """Near copies of one text of 120 words: a row has a few links at first, however large the group."""
    rng = random.Random(copies)
    base = [f"w{k}" for k in range(120)]
    texts = set()
    while len(texts) < copies:
        w = list(base)
        for at in rng.sample(range(120), 2):
            w[at] = f"v{rng.randrange(100_000)}"
        texts.add(" ".join(w))
    docs = spark.createDataFrame(list(enumerate(sorted(texts))), "doc_id long, text string").repartition(16)
    nodes = simhash.fingerprints(docs, shingle=1, distinct=True, count=2).select(F.col("doc_id").alias("id"), "fps")
    nodes = simhash.written(nodes, "nodes")
    met = simhash.written(simhash.candidates(nodes, 2, 4096, 2), "candidates")
    found = simhash.first_links(met)
    dense = met.filter("b IS NULL").count()
    assert dense > 0.9 * copies and found.count() < 5 * copies
    if copies == 2_000:
        near = simhash.reach_of_dense(met, nodes, 2, 4096, 2)
        prints = {r["id"]: [f % (1 << 64) for f in r["fps"]] for r in near.collect()}
        ids = sorted(prints)
        label = {i: i for i in ids}

        def top(i):
            while label[i] != i:
                i = label[i]
            return i

        for k in range(2):
            own = np.array([prints[i][k] for i in ids], np.uint64)
            for x, i in enumerate(ids):
                for y in np.nonzero(np.bitwise_count(own[:x] ^ own[x]) <= 2)[0]:
                    label[max(top(i), top(ids[y]))] = min(top(i), top(ids[y]))
        got = {}
        for r in near.collect():
            got.setdefault(r["near"], set()).add(r["id"])
        want = {}
        for i in ids:
            want.setdefault(top(i), set()).add(i)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
