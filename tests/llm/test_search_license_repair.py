"""Ranked search, license scans and conversation repair against brute force."""

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tabloom.llm import conversation_repair as cr
from tabloom.llm import license_scan, ranked_search
from tabloom.llm.queries import QUERIES

# --- ranked search


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_ranking(docs, items, k):
    terms = [(d, re.findall(ranked_search.TERM, lower(t))) for d, t in docs]
    terms = [(d, w) for d, w in terms if w]
    n, total = len(terms), sum(len(w) for _, w in terms)
    df = Counter(t for _, w in terms for t in set(w))
    out = []
    for item, text in items:
        wanted = Counter(re.findall(ranked_search.TERM, lower(text)))
        scored = []
        for d, w in terms:
            tf, m = Counter(w), 100 - 25 + (25 * len(w) * n) // total
            s = sum(c * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * tf[t]) // (1000 * tf[t] + 12 * m)) for t, c in wanted.items() if t in tf)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def ranking(index, items, k, **how):
    return sorted((tuple(r) for r in ranked_search.search(index, items, k=k, **how).select("item_id", "rank", "doc_id", "score").collect()), key=repr)


@pytest.mark.parametrize("shard_docs,query_bytes", [(1 << 14, 4 << 20), (50, 400)])
def test_search_matches_brute_force(spark, shard_docs, query_bytes):
    """Skewed words, copies (ties), rows without id or text; small shards and query blocks give the same."""
    rng = random.Random(7)
    words = ["w%d" % k for k in range(200)] + ["Ärger", "x1"]
    odds = [1 / (k + 1) for k in range(len(words))]
    texts = [" ".join(rng.choices(words, odds, k=rng.randrange(0, 80))) for _ in range(300)]
    texts += texts[:20] + [None, "", "--- !!", "W5 w7_w9"]
    docs = [(k if k % 40 else None, t) for k, t in enumerate(texts)] + [(5, "w150 w151"), (5, "w150 w151")]
    items = [(k, " ".join(rng.choices(words, k=rng.randrange(1, 12)))) for k in range(30)] + [(30, None), (31, "..."), (0, "w150"), (None, "w3 W3 w4")]
    index = ranked_search.build_index(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3), shard_docs=shard_docs)
    queries = spark.createDataFrame(items, "item_id bigint, text string")
    assert ranking(index, queries, 5, query_bytes=query_bytes) == plain_ranking(docs, items, 5)


def test_search_handles_odd_and_empty_tables(spark, odd_docs, no_docs, clashing):
    items = spark.createDataFrame([(1, "one six Lorem"), (2, "zzz")], "item_id bigint, text string")
    plain = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    index = ranked_search.build_index(clashing(odd_docs))
    assert ranking(index, clashing(items), 4) == plain_ranking(plain, [(1, "one six Lorem"), (2, "zzz")], 4)
    assert ranking(index, items.limit(0), 4) == [] and ranking(ranked_search.build_index(no_docs), items, 4) == []


def test_blocks_are_rejected_before_decompression():
    """One rare term decides; of the frequent term's blocks only those that hold candidates are read."""
    rng = np.random.default_rng(1)
    n = 12_000
    lengths = np.full(n, 100, np.int64)
    lengths[::7] = 900
    corpus = (n, int(lengths.sum()))
    norm = ranked_search.length_norm(lengths, *corpus)

    def postings(docs, tf):
        starts = np.arange(0, len(docs), ranked_search.BLOCK)
        ends = np.append(starts[1:], len(docs))
        block = np.repeat(np.arange(len(starts)), ends - starts)
        best = ranked_search.skyline(block, tf, lengths[docs])
        flat, cuts = ranked_search.compress(docs, tf, starts)
        data = [flat[s:e].tobytes() for s, e in zip([0, *cuts], cuts)]
        return ranked_search.Postings(ends - starts, docs[ends - 1], np.bincount(block[best], minlength=len(starts)), tf[best], lengths[docs[best]], data, norm, corpus)

    common = postings(np.arange(n), rng.integers(1, 9, n))
    rare = postings(np.sort(rng.choice(n, 60, replace=False)), np.full(60, 3, np.int64))
    docs, score = ranked_search.top_documents([(common, 1), (rare, 9000)], n, 20)
    read = len(common.read)
    exact = np.zeros(n, np.int64)
    for p, c in ((common, 1), (rare, 9000)):
        d, q = p.all()
        exact[d] += c * q
    want = np.lexsort((np.arange(n), -exact))[:20]
    assert sorted(zip((-score).tolist(), docs.tolist()))[:20] == [(-int(exact[d]), int(d)) for d in want]
    assert 0 < read < len(common.data) // 2
    for b, (s, top) in enumerate(zip(range(0, n, ranked_search.BLOCK), common.top)):
        assert top == common.all()[1][s : s + ranked_search.BLOCK].max(), b


def test_compression_round_trip():
    """Blocks of all widths, each read back alone."""
    blocks = [([0], [1]), ([5, 300, 70_000], [1, 256, 1 << 33]), (list(range(128)), [7] * 128), ([1 << 33], [1 << 40]), ([255], [65_535])]
    docs, tf = (np.array([x for b in blocks for x in b[k]], np.int64) for k in (0, 1))
    starts = np.cumsum([0, *[len(b[0]) for b in blocks[:-1]]])
    flat, ends = ranked_search.compress(docs, tf, starts)
    for (d, t), s, e in zip(blocks, [0, *ends], ends):
        got = ranked_search.decompress(flat[s:e].tobytes(), len(d))
        assert got[0].tolist() == d and got[1].tolist() == t


def test_long_texts_in_pieces(monkeypatch):
    text = ("alpha Beta gämma  " * 500).encode()
    whole = ranked_search.term_counts(text)
    monkeypatch.setattr(ranked_search, "PIECE", 10)
    assert ranked_search.term_counts(text) == whole == Counter({b"alpha": 500, b"beta": 500, "gämma".encode(): 500})


# --- license scans


def license_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def plain_scan(text):
    w, found, labels, score = license_words(text), [], set(), 0.0
    k = license_scan.K
    for t in license_scan.TEMPLATES:
        tw = license_words(t.text)
        places = len(tw) - k + 1
        at = {}
        for j in range(places):
            at.setdefault(tuple(tw[j : j + k]), []).append(j)
        diagonals = {}
        for p in range(len(w) - k + 1):
            for j in at.get(tuple(w[p : p + k]), []):
                diagonals.setdefault(p - j, set()).add(j)
        if t.phrase:
            full = [d for d, js in diagonals.items() if len(js) == places]
            found += [(d, t.label) for d in full]
            score = max(score, float(bool(full)))
            continue
        slack, regions, last = max(1, min(8, places // 8)), [], None
        for d in sorted(diagonals):
            if last is None or d - last > slack:
                regions.append([])
            regions[-1].append(d)
            last = d
        for ds in regions:
            union = len(set().union(*[diagonals[d] for d in ds]))
            matched = union if ds[-1] - ds[0] <= len(tw) // 2 else max(len(diagonals[d]) for d in ds)
            score = max(score, matched / places)
            if 10 * matched >= 6 * places:
                labels.add(t.label)
    base = sorted({x for _, x in found})
    starts = [d for d, _ in found]
    return len(w), len(found), min(starts, default=None), max(starts, default=None), base, sorted(set(base) | labels), score


def test_scan_matches_brute_force(spark):
    rng = random.Random(11)
    notice = license_scan.NOTICES[0].text.split()
    texts = [None, "", "mit", "CC BY-NC cc by nc", "Under the MIT License under the mit license, apache license version 2", "under the miK license", "CCİ by nc", "MİT under the mit license"]
    for t in license_scan.TEMPLATES:
        texts += [t.text, t.text.upper(), "x " * 30 + t.text + " y" * 5 + " " + t.text, "[" + t.text.replace(" ", "\n * ") + "]"]
    for step in (3, 5, 9, 14):
        texts.append(" ".join(x for k, x in enumerate(notice) if k % step))  # words left out
        texts.append(" ".join(y for k, x in enumerate(notice) for y in ([x, "really"] if k % step == 0 else [x])))  # words put in
        texts.append(" ".join("zzz" if k % step == 0 else x for k, x in enumerate(notice)))  # words changed
    texts.append(" ".join(notice[k : k + 4] and " ".join(notice[k : k + 4]) + " filler" * rng.randrange(9) for k in range(0, len(notice), 4)))
    texts.append("of the software " * 3000 + " ".join(notice))
    rows = [(k, t) for k, t in enumerate(texts)]
    got = {r["doc_id"]: tuple(r)[1:] for r in license_scan.scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for k, t in rows:
        assert got[k] == plain_scan(t), t
    assert got[4][4] == ["apache-2", "mit"] and got[5][1] == 0


def test_scan_handles_odd_and_empty_tables(spark, odd_docs, no_docs, clashing):
    got = sorted((tuple(r) for r in license_scan.scan(clashing(odd_docs)).collect()), key=repr)
    want = sorted(((r["doc_id"], *plain_scan(r["text"])) for r in odd_docs.collect()), key=repr)
    assert got == want and license_scan.scan(no_docs).count() == 0


def test_scan_takes_other_templates_and_refuses_bad_ones(spark):
    docs = spark.createDataFrame([(1, "all rights are reserved by acme corporation of nowhere")], "doc_id bigint, text string")
    mine = [license_scan.Template("acme", "rights are reserved by Acme Corporation")]
    assert license_scan.scan(docs, templates=mine).first()["labels"] == ["acme"]
    with pytest.raises(ValueError):
        license_scan.scan(docs, templates=[license_scan.Template("x", "too short")])


def test_scan_runs_no_python(spark, sf):
    plan = QUERIES["op12_license_diagonals"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- conversation repair


def plain_repair(rows):
    """Cheapest edits by Dijkstra over (place, roles so far as a grammar state), least audit first."""
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[3]))
    seen, faults = set(), []
    for turn, role, text, _ in order:
        body = text.rstrip(cr.SPACE)
        kind = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(kind)
    turns = [t for t, *_ in order if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(order, order[1:]))
    step = {("0", "s"): "1", ("0", "u"): "2", ("1", "u"): "2", ("2", "a"): "3", ("3", "u"): "2"}
    heap, done = [(0, "", 0, "0", ())], set()
    while heap:
        cost, audit, k, q, out = heapq.heappop(heap)
        if k == len(order) and q in "03":
            break
        if (k, q) in done:
            continue
        done.add((k, q))
        for r in ("user", "assistant"):
            if (q, r[0]) in step:
                heapq.heappush(heap, (cost + 3, audit + "I", k, step[q, r[0]], (*out, r + ":")))
        if k < len(order):
            heapq.heappush(heap, (cost + 4, audit + "D", k + 1, q, out))
            if faults[k] not in ("blank", "duplicate"):
                more = 3 * (faults[k] == "truncated")
                if (q, order[k][1][:1]) in step:
                    heapq.heappush(heap, (cost + more, audit + "K", k + 1, step[q, order[k][1][:1]], (*out, order[k][1] + ":" + order[k][2])))
                for r in ("user", "assistant"):
                    if (q, r[0]) in step:
                        heapq.heappush(heap, (cost + 3 + more, audit + "R", k + 1, step[q, r[0]], (*out, r + ":" + order[k][2])))
    return gaps, *(faults.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def plain_same(conv, role, text):
    framed = lambda p: "-" if p is None else f"{len(p.encode())}:{p}"
    return hashlib.md5("".join(framed(p) for p in (None if conv is None else str(conv), role, text)).encode()).hexdigest()


def plain_damage(talks):
    out = {}
    for conv, turn, role, text in talks:
        role, text = " " if role is None else role, " " if text is None else text
        rows = out.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        rows += [(turn, role, text, plain_same(conv, role, text))] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


SHAPE = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def repaired(df):
    return {r["conv_id"]: tuple(r)[1:] for r in cr.damage_and_repair(df).select(*COLUMNS).collect()}


def test_repair_matches_brute_force(spark):
    """Random conversations with faults of all kinds, repeated and missing turns, other roles, nulls."""
    rng = random.Random(2)
    roles, texts = ["system", "user", "assistant", "tool", "", None, "üser"], ["Hi.", "Well", "ok! ", "", " \t", None, "a\nb?", "é…"]
    talks = []
    for conv in [*range(150), None]:
        for turn in range(rng.randrange(0, 9)):
            talks.append((conv, rng.choice([turn, turn, turn, 3, None, turn + 5]), rng.choices(roles, [1, 5, 5, 1, 0.3, 0.3, 0.3])[0], rng.choices(texts, [5, 3, 4, 1, 1, 1, 3, 1])[0]))
    got = repaired(spark.createDataFrame(talks, SHAPE).repartition(3))
    want = {c: plain_repair(rows) for c, rows in plain_damage(talks).items()}
    assert got == want
    assert {x for r in want.values() for x in r[6]} == set("DIKR")


def test_repair_of_the_table(spark, sf):
    talks = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r["conv_id"]: tuple(r)[1:] for r in QUERIES["op13_conversation_dawg"](spark, sf).select(*COLUMNS).collect()}
    assert got == {c: plain_repair(rows) for c, rows in plain_damage(talks).items()}


def test_repair_handles_long_gone_and_empty_conversations(spark, clashing):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    long = [(-1, k, "user" if k % 2 == 0 else "assistant", f"turn {k}.") for k in range(20_000)]
    hot = [(-2, k, "user", "again.") for k in range(5000)]
    df = spark.createDataFrame([(gone, 0, "user", "x"), *long, *hot], SHAPE)
    got = repaired(clashing(df))
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert len(got[-1][6]) >= 19_000 and got[-2][2] > 4000
    assert repaired(df.limit(0)) == {}


def test_path_of_the_shared_suffix_gives_the_same_answers():
    words = sorted({"".join(random.Random(k).choices("suaoUAX", k=k % 7)) + "uaua" * 3 for k in range(60)}, key=lambda w: w[::-1])
    batch = pa.RecordBatch.from_arrays([pa.array([w[::-1] for w in words])], ["back"])
    got = [r for b in cr._solve(iter([batch])) for r in b.to_pylist()]
    for r in got:
        path = [cr.END]
        for letter in r["word"][::-1]:
            path.append(cr.node(letter, path[-1][0]))
        assert (r["cost"], r["audit"]) == (path[-1][0][0], cr.audit_of(r["word"], path))


def test_known_answers(spark):
    words = spark.createDataFrame([("ua",), ("uX",), ("",), ("a",)], "word string")
    got = {r["word"]: (r["cost"], r["audit"]) for r in cr.solve(words).collect()}
    assert got == {"ua": (0, "KK"), "uX": (7, "KDI"), "": (0, ""), "a": (3, "IK")}
