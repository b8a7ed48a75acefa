"""Operators on pairs against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tabloom.llm import components, embedding_pca, simhash_mih


def union(pairs, ids):
    low = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return low


def plain_fingerprint(text, size=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    pairs = [(k, k + 1) for k in range(100, 160)] + [(1000, k) for k in range(1001, 1080)] + [(rng.randrange(300), rng.randrange(300)) for _ in range(80)]
    want = union(pairs, {x for p in pairs for x in p})
    df = spark.createDataFrame([*pairs, (None, 1), (5, 5)], "a bigint, b bigint")
    got = {r["id"]: r["component"] for r in components.connected_components(df).collect()}
    assert got == {k: v for k, v in want.items() if k != v}
    assert components.connected_components(df.limit(0)).count() == 0


@pytest.mark.parametrize("block", [4096, 3])
def test_simhash_matches_brute_force(spark, block):
    """Random words, edited copies and a group of near copies; a tiny block sends every key through the grid."""
    rng = random.Random(5)
    words = ["w%d" % k for k in range(60)]
    texts = [" ".join(rng.choices(words, k=rng.randrange(0, 40))) for _ in range(60)]
    texts += [t + " tail" for t in texts[:20]] + texts[:10] + [None, "", "one"]
    base = rng.choices(words, k=400)
    for k in range(40):
        base[rng.randrange(400)] = "z%d" % k
        texts.append(" ".join(base))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    fp = {k: plain_fingerprint(t) for k, t in enumerate(texts)}
    want = union([(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 4], fp)
    got = {r["id"]: (r["fp"][0] % 2**64, r["component_id"]) for r in simhash_mih.near_duplicates(docs, block=block).collect()}
    assert got == {k: (fp[k], want[k]) for k in fp}
    assert len({v for _, v in got.values()}) < len(fp) - 20


def test_segments_and_balls():
    for n in (2, 3, 4, 7):
        cuts = simhash_mih.segments_of(n)
        assert sum(w for _, w in cuts) == 64 and cuts[0][0] == 0
    assert len(simhash_mih.ball(21, 1)) == 22 and len(simhash_mih.ball(32, 2)) == 529


def test_simhash_defined_results(spark, odd_docs, no_docs, clashing):
    got = simhash_mih.near_duplicates(clashing(odd_docs)).collect()
    assert len(got) == odd_docs.count()
    by_id = {r["id"]: r["component_id"] for r in got}
    assert by_id[None] is None and by_id[5] == by_id[6] == 5 and by_id[2] == by_id[3] == by_id[4] == 2 and by_id[1] == 1
    assert simhash_mih.near_duplicates(no_docs).count() == 0
    kept = simhash_mih.keep_one(clashing(odd_docs))
    assert kept.columns == clashing(odd_docs).columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 2, 5, 7, 8]
    assert simhash_mih.keep_one(no_docs).count() == 0


def test_keep_one_leaves_the_smallest_of_each_component(spark):
    """As by brute force over all fingerprints: copies, near copies in chains, documents that share a passage, rows that share an id."""
    rng = random.Random(9)
    words = ["w%d" % k for k in range(3000)]
    texts = [rng.choices(words, k=300) for _ in range(40)]
    shared = rng.choices(words, k=60)
    texts += [shared + rng.choices(words, k=200) for _ in range(5)]  # a passage in common is no copy
    for k in range(10):
        copy = list(texts[k])
        copy[50 + k] = "changed"
        texts += [copy, list(copy), texts[k] + ["tail"]]
    rows = [(k, " ".join(w)) for k, w in enumerate(texts)] + [(None, "no id"), (None, "no id"), (200, "a text under"), (200, "one id")]
    fp = {k: plain_fingerprint(t) for k, t in rows[: len(texts)]}
    want = union([(a, b) for a in fp for b in fp if a < b and (fp[a] ^ fp[b]).bit_count() <= 4], fp)
    left = [r["doc_id"] for r in simhash_mih.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()]
    assert sorted(left, key=repr) == sorted([k for k in fp if want[k] == k] + [None, None, 200], key=repr)
    assert set(range(45)) <= set(left) and len(fp) - len(set(want.values())) >= 20


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")


@pytest.mark.parametrize("side", [16_384, 60])
def test_near_vectors_match_brute_force(spark, side):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(1500, 24)).astype(np.float32)
    for k in range(300):  # chains of close vectors
        x[k + 1] = x[k] + 0.3 * rng.normal(size=24)
    x[400:450] = x[399]
    x[500:520] = 3 * x[499]
    df = vectors(spark, [(k, [float(c) for c in v], 0) for k, v in enumerate(x)])
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    link = np.triu(u @ u.T >= 0.9, 1)
    want = union(list(zip(*(i.tolist() for i in np.nonzero(link)))), range(1500))
    n = (link | link.T).sum(1)
    got = {r["id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_pca.near_vectors(df, side=side).collect()}
    assert got == {k: (n[k], want[k], want[k] == k) for k in range(1500)}


def test_near_vectors_defined_results(spark, clashing):
    rows = [
        (1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (3, None, 0), (4, [0.0, 0.0], 0), (5, [float("nan"), 1.0], None), (6, [1.0, None], 0),
        (7, [], 0), (8, [1.0, 0.0, 0.0], 0), (None, [1.0, 0.0], 0), (9, [float("inf"), 1.0], 0), (10, [1e-30, 0.0], 0), (1, [1.0, 0.0], 0),
    ]
    df = vectors(spark, rows)
    got = sorted((r["id"] or 0, r["n_links"], r["component_id"] or 0) for r in embedding_pca.near_vectors(clashing(df.drop("label"))).collect())
    alone = [(k, 0, k) for k in (3, 4, 5, 6, 7, 8, 9)]
    assert got == sorted([(0, 0, 0), (1, 3, 1), (1, 3, 1), (2, 3, 1), (10, 3, 1), *alone])
    assert embedding_pca.near_vectors(df.limit(0)).count() == 0
