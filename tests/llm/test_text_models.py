"""Trained operators: held-out accuracy, algebra and brute force."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.llm import ctw, language_nb, quality_rff, toxic_segments
from tabloom.llm.shared import fold


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.01/labels.parquet")


def plain_segments(scores):
    """Maximal segments by the recursive definition: best segment first, then left and right of it."""
    if not scores or max(scores) <= 0:
        return []
    best = max(((sum(scores[a:b]), -(b - a), a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)))
    _, _, a, b = best
    left, right = plain_segments(scores[:a]), plain_segments(scores[b:])
    return [*left, (a, b - 1, sum(scores[a:b])), *[(x + b, y + b, s) for x, y, s in right]]


def test_segments_match_the_definition():
    rng = random.Random(1)
    for _ in range(200):
        scores = [rng.choice([-0.5] * 3 + [1.25, 2.75, -1.125]) for _ in range(rng.randrange(0, 14))]
        hits = [(k, s) for k, s in enumerate(scores) if s != -0.5]
        got = toxic_segments.maximal_segments(hits, 0.5)
        assert math.isclose(max([s for *_, s in got], default=0), max([s for *_, s in plain_segments(scores)], default=0))
        assert all(math.isclose(sum(scores[a : b + 1]), s) for a, b, s in got)
        assert sorted(s for *_, s in got) == pytest.approx(sorted(s for *_, s in plain_segments(scores)))


def test_karlin_lambda_solves_its_equation():
    s, p = np.array([4.0, -1.0]), np.array([0.01, 0.3])
    lam = toxic_segments.karlin_lambda(s, p, 0.5)
    assert lam > 0 and p @ np.exp(lam * s) + 0.69 * math.exp(-0.5 * lam) == pytest.approx(1)


def test_toxicity_held_out(docs, labels):
    got = toxic_segments.score(docs, labels).join(labels, "doc_id").where(fold(F.col("doc_id")) == 0).select("toxicity.score", "toxic", "toxicity.passages").collect()
    assert np.mean([(r["score"] >= 0.5) == (r["toxic"] == 1) for r in got]) > 0.93
    assert any(r["passages"] for r in got if r["toxic"] == 1)


def test_quality_held_out(docs, labels):
    got = quality_rff.score(docs, labels).withColumnRenamed("quality", "score").join(labels, "doc_id").where(fold(F.col("doc_id")) == 0).select("score", "doc_id").collect()
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert all(0 <= r["score"] <= 1 for r in got)
    assert np.mean([(r["score"] >= 0.3) == (truth[r["doc_id"]] == 1) for r in got]) > 0.93


def test_isotonic_pools():
    x, y = quality_rff.pool_adjacent(np.array([0.0, 1, 2, 3]), np.array([0.2, 0.8, 0.4, 0.9]), np.array([1.0, 1, 3, 1]))
    assert x.tolist() == [0, 1.75, 3] and y == pytest.approx([0.2, 0.5, 0.9])


def test_language_held_out(docs):
    found = language_nb.identify(docs, docs.where(fold(F.col("doc_id")) != 0)).where(fold(F.col("doc_id")) == 0)
    assert found.where("language.lang = lang").count() / found.count() > 0.99


def test_language_matches_plain_bayes(spark):
    """The batch form against per-text counting; a piece limit must not change the answer."""
    rows = [("en", "the cat and the hat"), ("fr", "le chat et le chapeau"), ("en", "on the mat!"), ("fr", "à côté")]
    df = spark.createDataFrame(rows, "lang string, text string")
    names, table = language_nb.train(df, F.col("text"), F.col("lang"))
    own = [Counter(language_nb.gram_buckets([t], 16)[0].tolist()) for _, t in rows]
    total = [sum((c for c, (k, _) in zip(own, rows) if k == name), Counter()) for name in names]
    seen = len(set().union(*total))
    for c, counts in enumerate(total):
        for bucket in list(counts)[:20]:
            assert table[bucket, c] == pytest.approx(math.log((counts[bucket] + 0.5) / (sum(counts.values()) + 0.5 * (seen + 1))))
    together = language_nb.gram_buckets([t for _, t in rows], 16)
    assert [Counter(together[0][together[1] == k].tolist()) for k in range(4)] == own


def test_passages_of_texts_that_grow_in_lower_case(spark):
    model = {"scores": {"bad": 9.0, "worse": 9.0}, "lambda": 1.0, "ln_k": 0.0, "flat": 0.5}
    read = toxic_segments._reader(spark.sparkContext.broadcast(model), True)
    texts = ["a b BAD worse c", "\u0130zmir \u0130 BAD worse \u0130", None]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", read("t").alias("x")).orderBy("k").collect()
    found = [[texts[r["k"]][p["start"] : p["end"]] for p in r["x"]["passages"]] for r in rows]
    assert found == [["BAD worse"], ["BAD worse"], []]


def plain_ctw(training, depth=ctw.DEPTH):
    """Recursive context-tree weighting by its definition: (node, context) -> counts, then products over the children."""
    counts = {}
    for text in training:
        whole = b"\0" * depth + text + b"\0"
        for p in range(depth, len(whole)):
            for k in range(8):
                node, bit = (1 << k) | (whole[p] >> (8 - k)), whole[p] >> (7 - k) & 1
                for d in range(depth + 1):
                    counts.setdefault((node, whole[p - d : p]), [0, 0])[bit] += 1
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(node, context):
        if (node, context) not in counts:
            return 0.0
        own = kt(*counts[node, context])
        if len(context) == depth:
            return own
        inner = sum(weighted(node, bytes([c]) + context) for c in range(256) if (node, bytes([c]) + context) in counts)
        return math.log(0.5) + np.logaddexp(own, inner)

    return counts, weighted


def plain_probability(training, text, depth):
    """log10 probability of one more text: ratios of the weighted probabilities with and without each bit."""
    counts, weighted = plain_ctw(training, depth)
    want, whole = 0.0, b"\0" * depth + text + b"\0"
    for p in range(depth, len(whole)):
        for k in range(8):
            node, bit = (1 << k) | (whole[p] >> (8 - k)), whole[p] >> (7 - k) & 1
            before = weighted(node, b"")
            path = [(node, whole[p - d : p]) for d in range(depth + 1)]
            new = [q for q in path if q not in counts]
            for q in path:
                counts.setdefault(q, [0, 0])[bit] += 1
            want += (weighted(node, b"") - before) / math.log(10)
            for q in path:
                counts[q][bit] -= 1
            for q in new:
                del counts[q]
    return want


@pytest.mark.parametrize("depth,heavy_grams,broadcast_rows", [(3, 1 << 20, None), (3, 0, 0), (3, 6, 1), (5, 4, None), (1, 1, None), (0, 3, None)])
def test_scores_match_the_definition(spark, depth, heavy_grams, broadcast_rows):
    """Whole scores against the recursive definition at several depths, with everything broadcast and with nothing."""
    training = [b"abcabcabd", b"abba", b"cab"]
    texts = [b"abx", b"abcabd", b"", b"zzz", b"ab" * 9]
    rows = [(k, t.decode(), True) for k, t in enumerate(training)] + [(10 + k, t.decode(), False) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, teaches boolean")
    got = ctw.score(docs, F.col("teaches"), depth=depth, heavy_grams=heavy_grams, broadcast_rows=broadcast_rows)
    found = {r["doc_id"]: r["score"] for r in got.collect()}
    for k, text in enumerate(texts):
        assert found[10 + k] == pytest.approx(plain_probability(training, text, depth), abs=1e-9)


def test_probabilities_of_a_byte_add_up_to_one(spark):
    training = [b"abcabcabd", b"abba", b"cab"]
    grams = Counter(g for _, _, part in ctw.coded(training) for g in part.tolist())
    tree = ctw.levels(spark.createDataFrame(list(grams.items()), "gram bigint, n bigint"))
    for context in (b"abc", b"aba", b"xyz"):
        every = spark.createDataFrame([(int.from_bytes(context, "big") << 8 | c,) for c in range(256)], "gram bigint")
        assert ctw.log10_of(every, tree).agg(F.sum(F.pow(F.lit(10.0), "lp"))).first()[0] == pytest.approx(1)


def test_limits_do_not_change_scores(spark, docs):
    some = docs.where("doc_id < 120").select("doc_id", "text")
    whole = {r["doc_id"]: r for r in ctw.score(some, fold(F.col("doc_id")) != 1).collect()}
    for r in ctw.score(some, fold(F.col("doc_id")) != 1, heavy_grams=100, heavy=3, broadcast_rows=1).collect():
        assert r["score"] == pytest.approx(whole[r["doc_id"]]["score"]) and r["base_score"] == pytest.approx(whole[r["doc_id"]]["base_score"])


@pytest.mark.parametrize("heavy", [100_000, 3])
def test_base_score_matches_brute_force(spark, docs, heavy):
    some = docs.where("doc_id < 120").select("doc_id", "text")
    rows = {r["doc_id"]: r for r in some.select("*", fold(F.col("doc_id")).alias("f")).collect()}
    words = {k: [*(r["text"] or "").encode().lower().split(), None] for k, r in rows.items()}
    c = Counter(w for k, ws in words.items() if rows[k]["f"] != 1 for w in ws)
    n, v = sum(c.values()), len(c)
    for r in ctw.score(some, fold(F.col("doc_id")) != 1, heavy=heavy).collect():
        ws = words[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(c[w] > 0 for w in ws), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
        assert r["score"] < 0


def test_pieces_do_not_change_scores():
    texts = [b"abc" * 1000, b"", b"x\0y"]
    whole = list(ctw.coded(texts))
    grams = np.concatenate([g for *_, g in whole])
    assert len(grams) == sum(len(t) + 1 for t in texts)
    keys, where = ctw.distinct_grams(np.tile(grams, 20))
    plain = np.unique(np.tile(grams, 20), return_inverse=True)
    assert np.array_equal(keys, plain[0]) and np.array_equal(where, plain[1])


def test_defined_results(spark, odd_docs, odd_labels, no_docs, clashing):
    docs, n = clashing(odd_docs), odd_docs.count()
    none = odd_labels.limit(0)
    for labels in (odd_labels, none):
        tox = toxic_segments.score(docs.drop("score"), labels).select("toxicity.score").collect()
        assert len(tox) == n and all(0 <= r["score"] <= 1 for r in tox)
        good = quality_rff.score(docs, labels).select("quality").collect()
        assert len(good) == n and all(0 <= r["quality"] <= 1 for r in good)
    assert {r["score"] for r in toxic_segments.score(docs.drop("score"), none).select("toxicity.score").collect()} == {0.5}
    lang = {r["doc_id"]: r["language"] for r in language_nb.identify(docs, docs).collect()}
    assert all(lang[k]["lang"] == "und" and lang[k]["score"] == 0 for k in (2, 3, 4, 8)) and lang[5]["lang"] == "en"
    assert language_nb.identify(docs, docs.limit(0)).where("language.lang <> 'und'").count() == 0
    scored = ctw.score(docs, fold(F.col("doc_id")) != 1).collect()
    assert len(scored) == n and all(math.isfinite(r["base_score"]) and math.isfinite(r["score"]) for r in scored)
    assert all(r["n_known"] == 0 and r["base_score"] == 0 for r in ctw.score(docs, F.lit(False)).where("n_tokens = 1").collect())
    for empty in (
        toxic_segments.score(no_docs, odd_labels), quality_rff.score(no_docs, odd_labels), language_nb.identify(no_docs, no_docs), ctw.score(no_docs, F.lit(True)),
    ):
        assert empty.count() == 0


def test_grams_of_cut_texts(monkeypatch):
    """Pieces of any size give the grams of the whole text, across letters, blanks and runs of both."""
    rng = random.Random(6)
    texts = ["".join(rng.choices("abÄσΣ  .1\n", k=n)) for n in (0, 1, 5, 60, 200)] + ["a" * 70, " " * 70 + "x", "x" + "-" * 90]
    whole = [Counter(language_nb.gram_buckets([t.lower()], 16)[0].tolist()) for t in texts]
    for size in (1, 2, 3, 7, 64):
        monkeypatch.setattr(language_nb, "PIECE", size)
        got = [Counter() for _ in texts]
        for index, *part in language_nb.pieces(texts):
            bucket, who = language_nb.gram_buckets(part[0], 16, *part[1:])
            for b, w in zip(bucket.tolist(), who.tolist()):
                got[index[w]][b] += 1
        assert got == whole
