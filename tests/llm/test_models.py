import math
import random
import re

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from daybook.llm import language, quality, toxicity

SF = "/root/testdata/sf0.01"


def test_language_is_right_on_held_out_texts(spark):
    got = language.op10_language(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert len(got) > 100 and (got["lang"] == got["lang_pred"]).mean() > 0.98 and got["accepted"].mean() > 0.97


def test_kneser_ney_sums_to_one():
    texts = ["abab ab ba", "aab b a"]
    letters, _ = language.symbols(texts)
    keys, n = np.unique(language.grams(letters), return_counts=True)
    model = language.kneser_ney(["x"], {"x": (keys, n)})
    alphabet = np.unique(letters)
    for context in (keys[0] >> np.uint64(16), keys[-1] >> np.uint64(16), np.uint64(0x007A007A007A)):
        symbols = np.r_[alphabet, 0xFFFF].astype(np.uint64)  # the last one stands for all unseen ones
        p = np.exp(model.log_probabilities((np.uint64(context) << np.uint64(16)) | symbols))[:, 0]
        assert abs(p[:-1].sum() + p[-1] * ((1 << 16) - len(alphabet)) - 1) < 1e-3


def plain_kneser_ney(texts):
    """Log-probabilities of a symbol after three others, in plain dictionaries."""
    from collections import Counter

    def symbols(text):
        return "".join(c.lower()[0] if c.isalpha() else "\0" for c in text)

    counts = [None, None, None, None, Counter()]
    for text in texts:
        s = "\0\0\0" + re.sub("\0+", "\0", symbols(text)).strip("\0") + "\0"  # the end is a gap
        counts[4].update(g for g in (s[i : i + 4] for i in range(len(s) - 3)) if g[2:] != "\0\0")
    for order in (3, 2, 1):
        counts[order] = Counter(g[1:] for g in counts[order + 1])

    def probability(gram):
        own = counts[len(gram)]
        n1, n2 = (sum(n == k for n in own.values()) for k in (1, 2))
        discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        lower = probability(gram[1:]) if len(gram) > 1 else 1 / 65536
        after = [n for g, n in own.items() if g[:-1] == gram[:-1]]
        return (max(own[gram] - discount, 0) + discount * len(after) * lower) / sum(after) if after else lower

    return lambda gram: math.log(probability(gram))


def test_models_of_two_languages_are_the_plain_ones(spark):
    rng = random.Random(3)
    texts = {name: ["".join(rng.choice(letters) for _ in range(rng.randint(3, 60))) for _ in range(25)] for name, letters in (("a", "abcde  A,"), ("b", "bdefé 9 "))}
    train = spark.createDataFrame([(t, name) for name, own in texts.items() for t in own] + [("12 !", "c")], "text string, lang string")
    new = ["abc de bcd", "é bdf", "zz abq e"]
    for most_bytes in (1 << 27, 1):  # one group of all languages; a group for each
        models = language.fit(train, most_bytes=most_bytes)
        assert models.langs == ["a", "b"] and len(models.groups) == (1 if most_bytes > 1 else 2)
        entropies, sizes = models.cross_entropies(new)
        for j, name in enumerate(models.langs):
            plain = plain_kneser_ney(texts[name])
            for i, text in enumerate(new):
                s = "\0\0\0" + text.replace(" ", "\0")
                logs = [plain(s[k : k + 4]) for k in range(len(s) - 3)]
                assert sizes[i] == len(logs) and abs(entropies[i, j] + sum(logs) / len(logs)) < 1e-4
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(sum(texts.values(), []))], "doc_id long, text string")
    one, two = (sorted(map(tuple, language.identify(docs, language.fit(train, most_bytes=m), keep_text=False).collect())) for m in (1 << 27, 1))
    assert [(r[0], r[1], r[3]) for r in one] == [(r[0], r[1], r[3]) for r in two] and all(abs(a[2] - b[2]) < 1e-6 for a, b in zip(one, two))


def test_ranges_of_a_large_language_are_the_whole_model(spark):
    rng = random.Random(5)
    draw = lambda letters, n: "".join(rng.choices(letters, [8] + [1] * (len(letters) - 1), k=n))
    train = [(draw("eabcdfghijklmnopqrs ", 40), "x") for _ in range(6000)] + [(draw("èabc ", 30), "y") for _ in range(40)] + [("12", "z")]
    rows = spark.createDataFrame(train, "text string, lang string")
    whole, cut = language.fit(rows), language.fit(rows, most_bytes=1)
    assert whole.langs == cut.langs == ["x", "y"] and len(whole.groups) == 1
    ranges = [cut.model(part) for part in cut.groups if part.langs == ["x"]]
    spans = [model.span for model in ranges]
    assert len(spans) > 5 and spans[0][0] == 0 and spans[-1][1] == 1 << 32 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert any(low & 0xFFFF for low, _ in spans)  # a symbol with too many is cut by the one before it
    assert max(len(model.grams[0].hashes) for model in ranges) <= language.LEAST_RANGE
    assert sum(len(model.grams[0].hashes) for model in ranges) == len(language.count_grams(rows.filter("lang = 'x'")).collect())
    new = [draw("eabcdfghzé ", 50) for _ in range(30)] + ["", "12", "eee", "èabc " * 400, "\U00020000 ab"]
    a, b = whole.cross_entropies(new), cut.cross_entropies(new)
    assert np.allclose(a[0], b[0], atol=1e-6) and (a[1] == b[1]).all()
    for kept in ("centre", "spread", "limit"):
        assert np.allclose(getattr(whole, kept), getattr(cut, kept), atol=1e-6)
    docs = spark.createDataFrame([(k, t) for k, t in enumerate([*new, None])], "doc_id long, text string")
    one, two = (sorted(map(tuple, language.identify(docs, m, keep_text=False).collect())) for m in (whole, cut))
    assert [(r[0], r[1], r[3]) for r in one] == [(r[0], r[1], r[3]) for r in two] and all(abs(p[2] - q[2]) < 1e-6 for p, q in zip(one, two))


def test_letters_beyond_the_basic_plane():
    letters, begins = language.symbols(["\U00020000", "a\U00010400 \ud400", "\U0001f600", ""])
    assert letters.tolist() == [0, 0, 0, 0xD840, 0xDC00, 0, 0, 0, ord("a"), 0xD801, 0xDC28, 0, 0xD400, 0, 0, 0, 0, 0, 0, 0, 0, 0] and begins.tolist() == [3, 8, 16, 19]


def test_language_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, "un texte", "fr"), (2, "ein text ß", "de"), (3, None, "de"), (4, "123 !?", "fr"), (5, "", None), (6, "ein " * 20000, "de"), (None, "Ünd 𝒳 éé", None), (6, "un", "fr"), (7, "\U00020000 \U00020001", None), (8, "12 3", "xx")], "doc_id long, text string, lang string")
    got = language.identify(docs.select("doc_id", "text", F.lit(1).alias("_entropies")), language.fit(docs)).collect()
    assert len(got) == 10
    assert all((r["lang_pred"] == "und") == (r["doc_id"] in (3, 4, 5, 8)) and 0 <= r["score"] <= 1 and r["_entropies"] == 1 for r in got)
    none = language.identify(docs, language.fit(docs.limit(0)), names=("p", "s", "a"))
    assert {r["p"] for r in none.collect()} == {"und"}
    assert language.identify(docs.limit(0), language.fit(docs)).count() == 0


def test_rare_language_is_calibrated_on_all_its_texts(spark):
    rare = [f"tämä on {w} lause suomeksi ja {w} vielä" for w in ("yksi", "toinen", "kolmas", "neljäs", "viides", "kuudes", "seitsemäs")]
    common = spark.range(60_000).select(F.concat(F.lit("this is text "), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("text"), F.lit("en").alias("lang"))
    model = language.fit(common.union(spark.createDataFrame([(t, "fi") for t in rare], "text string, lang string")))
    j = model.langs.index("fi")
    own = model.cross_entropies(rare)[0][:, j]
    assert abs(model.centre[j] - np.median(own)) < 1e-6 and model.spread[j] < 1
    odd = spark.createDataFrame([("tämä on yksi lause suomeksi",), ("ää öö yy ää öö yy kkkk ääää",)], "text string")
    got = [r["accepted"] for r in language.identify(odd, model).collect()]
    assert got == [True, False]


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    got = quality.op5_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out").toPandas()
    good, bad = got[got["quality"] == 1], got[got["quality"] == 0]
    assert good["predicted"].mean() > 0.99 and bad["predicted"].mean() < 0.05


def test_quality_scores_are_sums_of_table_entries():
    rng = np.random.default_rng(2)
    x = rng.random((500, len(quality.FEATURES))).round(2)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # needs a pair
    model = quality.fit(x, y)
    assert model.pairs
    for row, got in zip(x[:100], model.scores(x[:100])):
        bins = [sum(edge <= value for edge in edges) for edges, value in zip(model.edges, row)]
        z = model.intercept + sum(table[k] for table, k in zip(model.tables, bins))
        for (i, j), table in model.pairs.items():
            z += table[model.coarse[i][bins[i]]][model.coarse[j][bins[j]]]
        assert abs(got - 1 / (1 + math.exp(-z))) < 1e-9


def test_quality_model_and_odd_rows(spark):
    rng = np.random.default_rng(0)
    x = rng.random((800, len(quality.FEATURES)))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)  # needs a pair
    model = quality.fit(x, y)
    assert ((model.scores(x) > 0.5) == y).mean() > 0.9
    assert np.allclose(quality.fit(x[:0], y[:0]).scores(x), 0.5)
    docs = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "a b " * 50000, 5), (3, "x", None)], "doc_id long, text string, quality int")
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 0), (3, 0)], "doc_id long, quality int")
    got = quality.score(docs, quality.learn(docs, labels)).collect()
    assert len(got) == 4 and all(0 <= r["score"] <= 1 for r in got)
    assert quality.score(docs.limit(0), model).count() == 0


def test_toxicity_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    got = toxicity.op1_toxicity(spark, sf).withColumnRenamed("toxic", "flag").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    bad = got[got["toxic"] == 1]
    assert bad["predicted"].mean() > 0.9 and bad[bad["lang"] != "en"]["predicted"].mean() > 0.9 and got[got["toxic"] == 0]["predicted"].mean() < 0.01


def plain_fit(x, y, penalty=1e-4, rounds=200, rate=0.05):
    """Logistic regression of y on the columns of x and a constant, by steps of the same size, row by row."""
    n, m = x.shape
    p = min(max(y.mean(), 1e-3), 1 - 1e-3)
    w, mean, square = np.append(np.zeros(m), math.log(p / (1 - p))), np.zeros(m + 1), np.zeros(m + 1)
    for t in range(1, rounds + 1):
        grad = np.zeros(m + 1)
        for row, label in zip(x, y):
            full = np.append(row, 1.0)
            grad += (1 / (1 + math.exp(-full @ w)) - label) * full / n
        grad[:-1] += penalty * w[:-1]
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad**2
        w = w - rate * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-9)
    return w


def test_chain_is_the_plain_one():
    rng = np.random.default_rng(8)
    n, terms, folds = 60, 6, np.arange(60) % 3
    x = rng.integers(0, 3, (n, terms)) * (rng.random((n, terms)) < 0.5).astype(float)
    labels = np.column_stack([x[:, 0] > 0, x[:, 1] > 0, x[:, 0] + x[:, 2] + rng.random(n) > 1.5]).astype(float)
    rows, at = np.nonzero(x)
    seen = {f: np.arange(terms) != f for f in range(3)} | {None: np.arange(terms) != 5}
    chain = toxicity.fit_chain({bytes([97 + k]): k for k in range(terms)}, at, x[rows, at], rows, labels, folds, terms=seen)
    before = np.zeros((n, 0))
    for k in range(3):
        full = np.column_stack([x * seen[None], before])
        assert np.allclose(chain.weights[k], plain_fit(full, labels[:, k]), atol=1e-6)
        apart = np.zeros(n)
        for f in range(3):
            full = np.column_stack([x * seen[f], before])
            w = plain_fit(full[folds != f], labels[folds != f, k])
            apart[folds == f] = 1 / (1 + np.exp(-(full[folds == f] @ w[:-1] + w[-1])))
        before = np.column_stack([before, apart])
    f1 = lambda t: 2 * ((before[:, 2] >= t) & (labels[:, 2] > 0)).sum() / ((before[:, 2] >= t).sum() + labels[:, 2].sum())
    assert f1(chain.threshold) == max(f1(k / 20) for k in range(1, 20))
    p = chain.predict(at, x[rows, at], rows, n)
    for r in range(n):
        seen: list[float] = []
        for k, w in enumerate(chain.weights):
            z = sum(w[j] * x[r, j] for j in range(terms) if j != 5) + sum(w[terms + j] * q for j, q in enumerate(seen)) + w[-1]
            seen.append(1 / (1 + math.exp(-z)))
        assert np.allclose(p[r], seen, atol=1e-9)


def test_terms_of_a_fold_are_chosen_without_it(spark):
    rng = random.Random(2)
    docs = [(k, " ".join(rng.choices(["good", "fine", "bad", "vile", "day", "night"], k=6)), k % 2) for k in range(200)]
    rows = spark.createDataFrame([(k, t, y, k % 5) for k, t, y in docs], "doc_id long, text string, y int, fold int")
    word = rows.select("y", "fold", F.explode(F.array_distinct(F.split("text", " "))).alias("word")).withColumn("word", F.col("word").cast("binary"))
    by_fold = lambda value: F.array(*(F.sum(F.when(F.col("fold") == k, value).otherwise(0)) for k in range(5)))
    counts = word.groupBy("word").agg(by_fold(F.lit(1)).alias("n"), by_fold(F.col("y")).alias("p"))
    sizes = [(sum(k % 5 == f for k, _, _ in docs), sum(y for k, _, y in docs if k % 5 == f)) for f in range(5)]
    got = {(r["fold"], bytes(r["word"])): r["gain"] for r in toxicity.telling(counts, sizes, 3).collect()}
    assert len(got) == 18
    for fold in (None, *range(5)):
        left = [(set(t.encode().split()), y) for k, t, y in docs if k % 5 != fold]
        gains = {}
        for w in (b"good", b"fine", b"bad", b"vile", b"day", b"night"):
            n, p = sum(w in t for t, _ in left), sum(y for t, y in left if w in t)
            expected = n * sum(y for _, y in left) / len(left)
            gains[w] = (p - expected) ** 2 / (expected + 1)
        best = sorted(gains, key=lambda w: (-gains[w], w))[:3]
        assert all(abs(got[fold, w] - gains[w]) < 1e-9 for w in best)


def test_kinds_of_toxic_texts_are_clusters():
    rng = np.random.default_rng(4)
    y = (np.arange(90) % 3 > 0).astype(float)
    x = np.zeros((90, 6))
    kind = np.arange(90) % 9 // 7  # of the toxic rows 0 mostly, 1 for some
    for r in range(90):
        x[r, (kind[r] * 3 if y[r] else 2) + rng.integers(0, 2, 3)] = rng.random(3) + 1
    rows, at = np.nonzero(x)
    got = toxicity.categories(at, x[rows, at], rows, y, 6, 2)
    assert (got[:, 2] == y).all() and (got[:, :2].sum(1) == y).all() and got[:, 0].sum() > got[:, 1].sum()
    assert (got[y > 0, 1] == kind[y > 0]).all()
    assert toxicity.categories(at[:0], x[:0, 0], rows[:0], np.zeros(3), 6, 2).sum() == 0
    same = toxicity.clusters(np.ones((5, 2)), 2)
    assert same.tolist() == [0] * 5


def test_threshold_comes_from_unseen_folds():
    rng = np.random.default_rng(6)
    n, terms, folds = 80, 5, np.arange(80) % 4
    x = (rng.random((n, terms)) < 0.5) * (1 + rng.random((n, terms)))
    y = (x[:, 0] + x[:, 1] + rng.random(n) > 2).astype(float)
    rows, at = np.nonzero(x)
    listed = [bytes([97 + k]) for k in range(terms)]
    seen = {f: np.arange(terms) != 1 + f for f in range(4)} | {None: np.arange(terms) < 4}
    chain = toxicity.fit_apart(listed, seen, at, x[rows, at], rows, y, folds)
    assert list(chain.vocabulary) == listed[:4] and [len(w) for w in chain.weights] == [5, 6, 7]
    unseen = np.zeros(n)
    for f in range(4):  # dense, each fold for itself
        own, kept = x[:, seen[f]], folds != f
        r, a = np.nonzero(own[kept])
        labels = toxicity.categories(a, own[kept][r, a], r, y[kept], own.shape[1], 2)
        part = toxicity.fit_chain(dict.fromkeys(range(own.shape[1])), a, own[kept][r, a], r, labels, folds[kept])
        r, a = np.nonzero(own[~kept])
        unseen[~kept] = part.predict(a, own[~kept][r, a], r, int((~kept).sum()))[:, 2]
    assert chain.threshold == toxicity.best_threshold(unseen, y)


def test_chain_feeds_earlier_probabilities(spark):
    rng = np.random.default_rng(1)
    n = 600
    word = rng.integers(0, 2, n).astype(float)
    rows = np.nonzero(word)[0]
    labels = np.column_stack([word, word, word])
    chain = toxicity.fit_chain({b"w": 0}, np.zeros(len(rows), np.int64), np.ones(len(rows)), rows, labels, np.arange(n) % 5)
    assert [len(w) for w in chain.weights] == [2, 3, 4] and chain.weights[2][1] != 0
    p = chain.predict(np.array([0]), np.array([1.0]), np.array([0]), 2)
    assert (p[0] > 0.5).all() and (p[1] < 0.5).all()
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "idiot " * 50000), (3, "fine")], "doc_id long, text string")
    labels = spark.createDataFrame([(3, 1), (2, 0), (None, 1), (1, None)], "doc_id long, toxic int")
    assert toxicity.rate(docs, toxicity.learn(docs, labels)).count() == 4
    assert all(r["p_toxic"] == 0.5 for r in toxicity.rate(docs, toxicity.learn(docs, labels.limit(0))).collect())
    assert toxicity.rate(docs.limit(0), toxicity.learn(docs, labels.limit(0))).count() == 0


def test_pipeline_keeps_clean_documents_whole(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("_score", F.lit(1))
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF)
        assert kept.columns == docs.columns
    kept = kept.cache()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = docs.dropDuplicates(["text"]).join(labels.filter("quality = 1"), "doc_id").count()
    held = kept.join(labels.filter("quality = 1"), "doc_id").count()
    assert held > 0.9 * good
    assert kept.count() == kept.select("text").distinct().count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
    assert pieces.select("doc_id").distinct().count() == kept.count()


def test_stages_on_odd_and_on_no_rows(spark):
    extra = "_score double, _accepted boolean, _lang string, _none int, _id int, _hash int, _entropies int, length int, fps string"
    blank = (None,) * 9
    text = "the cat sat on the mat and the dog ran to the old house by the river in the early morning light " * 3
    rows = [(k, f"{text} {k}", "en", "s", 5, *blank) for k in range(8)] + [(1, f"{text} 1", "en", "s", 5, *blank), (2, "another text of the same id", "en", None, None, *blank)]
    rows += [(None, text, None, None, None, *blank), (20, None, "de", "s", None, *blank), (21, "", None, "s", 0, *blank), (22, text * 500, "en", "s", 1, 0.5, True, "x", 1, 1, 1, 1, 1, "f")]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars int, {extra}")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.columns == docs.columns and kept.count() <= docs.count(), name
        assert stage(spark, docs.limit(0), SF).count() == 0, name
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert pieces.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), SF).count() == 0


def _plain_value(g, h):
    return sum(g) / (sum(h) + 1.0)


def _plain_gain(parts, whole):
    one = lambda p: sum(g for g, _ in p) ** 2 / (sum(h for _, h in p) + 1.0)
    return sum(map(one, parts)) - one(whole)


def _plain_tree(bins, depth):
    """Every cut tried, each with its own sums; bins: (gradient, curvature)."""
    best, at = 1e-6, None
    if depth:
        for cut in range(1, len(bins)):
            if min(sum(h for _, h in bins[:cut]), sum(h for _, h in bins[cut:])) >= 1:
                gain = _plain_gain([bins[:cut], bins[cut:]], bins)
                if gain > best + 1e-9:
                    best, at = gain, cut
    if at is None:
        return [_plain_value(*zip(*bins))] * len(bins)
    return _plain_tree(bins[:at], depth - 1) + _plain_tree(bins[at:], depth - 1)


def _plain_cross(cells):
    """Every pair of cuts tried; cells: rows of (gradient, curvature). Values and gain."""
    flat = [c for row in cells for c in row]
    best, found = None, None
    for i in range(1, len(cells)):
        for j in range(1, len(cells[0])):
            quarters = [[c for row in rows for c in row[cols]] for rows in (cells[:i], cells[i:]) for cols in (slice(None, j), slice(j, None))]
            gain = _plain_gain(quarters, flat)
            if best is None or gain > best + 1e-9:
                best, found = gain, (i, j, quarters)
    if best is None:
        return [[_plain_value(*zip(*flat))] * len(cells[0]) for _ in cells], 0.0
    i, j, q = found
    value = [_plain_value(*zip(*x)) for x in q]
    return [[value[2 * (a >= i) + (b >= j)] for b in range(len(cells[0]))] for a in range(len(cells))], best


def test_boosting_steps_are_the_plain_ones():
    rng = np.random.default_rng(8)
    for _ in range(60):
        n, m = rng.integers(1, 9, 2)
        g, h = rng.normal(0, 3, n), rng.random(n) * 4
        assert np.allclose(quality._tree(g, h, 2), _plain_tree(list(zip(g, h)), 2))
        g, h = rng.normal(0, 3, (n, m)), rng.random((n, m)) * 4
        values, gain = quality._cross(g, h)
        want, best = _plain_cross([list(zip(a, b)) for a, b in zip(g, h)])
        assert np.allclose(values, want) and abs(gain - best) < 1e-6


def test_boosting_is_the_plain_one(monkeypatch):
    """The whole fit by loops over rows: tables in turn, the strongest pairs, then their tables."""
    for name, value in (("ROUNDS", 6), ("PAIR_ROUNDS", 4), ("PAIRS", 2), ("BINS", 6), ("PAIR_BINS", 3)):
        monkeypatch.setattr(quality, name, value)
    rng = np.random.default_rng(2)
    x = rng.random((150, 3)).round(2)
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.4) ^ (rng.random(150) < 0.1)).astype(int)  # what only a pair can tell
    model = quality.fit(x, y)
    edges = [sorted(set(np.quantile(x[:, j], np.linspace(0, 1, 7)[1:-1]))) for j in range(3)]
    b = [[sum(e <= v for e in edges[j]) for j, v in enumerate(row)] for row in x]
    size = [len(e) + 1 for e in edges]
    coarse = [[k * 3 // max(n, 3) for k in range(n)] for n in size]
    z = [float(np.log(y.mean() / (1 - y.mean())))] * len(y)
    tables = [[0.0] * n for n in size]

    def slopes():
        p = [1 / (1 + np.exp(-v)) for v in z]
        return [(t - q, q * (1 - q)) for t, q in zip(y, p)]

    def summed(at, n):
        out = [(0.0, 0.0)] * n
        for k, (g, h) in zip(at, slopes()):
            out[k] = (out[k][0] + g, out[k][1] + h)
        return out

    for _ in range(6):
        for j in range(3):
            step = _plain_tree(summed([r[j] for r in b], size[j]), 2)
            tables[j] = [t + 0.12 * s for t, s in zip(tables[j], step)]
            z = [v + 0.12 * step[r[j]] for v, r in zip(z, b)]
    c = [[coarse[j][r[j]] for j in range(3)] for r in b]
    wide = [max(q) + 1 for q in coarse]

    def cells(i, j):
        flat = summed([r[i] * wide[j] + r[j] for r in c], wide[i] * wide[j])
        return [flat[k * wide[j] : (k + 1) * wide[j]] for k in range(wide[i])]

    gains = sorted(((_plain_cross(cells(i, j))[1], i, j) for i in range(3) for j in range(i)), reverse=True)[:2]
    pairs = {(i, j): np.zeros((wide[i], wide[j])) for g, i, j in gains if g > 1}
    assert list(model.pairs) == list(pairs) and (1, 0) in pairs
    for _ in range(4):
        for i, j in pairs:
            step = 0.12 * np.array(_plain_cross(cells(i, j))[0])
            pairs[i, j] += step
            z = [v + step[r[i]][r[j]] for v, r in zip(z, c)]
    assert all(np.allclose(a, t) for a, t in zip(model.tables, tables)) and all(np.allclose(model.pairs[k], t) for k, t in pairs.items())
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(-np.array(z))))
