"""Decontamination, personal data, packing and web archives against plain versions."""

import hashlib
import io
import itertools
import re
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabloom.llm import decontaminate, packing, pii_bootstrap, zip_warc
from tabloom.llm.shared import scratch_dir


def plain_hits(text, items, window=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    words, hit, met = split(text), set(), set()
    for item, own in items:
        w = split(own)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            for p in range(len(words) - n + 1):
                if words[p : p + n] == w[k : k + n]:
                    hit |= set(range(p, p + n))
                    met.add(item)
    return len(words), len(hit), sorted(met)


BENCH = [(1, "a b c d e f g h i j k l m"), (2, "Short one"), (3, None), (4, "..."), (None, "q w e r t z u i o p q w"), (2, "Short one"), (12, "b c d e f g h i j k zz")]


@pytest.mark.parametrize("shard", [1 << 20, 10])
def test_scan_matches_plain_search(spark, odd_docs, clashing, shard):
    bench = spark.createDataFrame(BENCH, "item_id bigint, text string")
    texts = ["x A-b c,d e f g h i j k l m y", "a b c d e f g h i", "the short ONE here, short one", "Shorté one", None, "q w e r t z u i o p", "a b c d e f g h i j a b c d e f g h i j"]
    docs = spark.createDataFrame(list(enumerate(texts, 100)), "doc_id bigint, text string").unionByName(odd_docs.where("length(text) < 1000 or text is null").select("doc_id", "text"))
    items = [("" if i is None else str(i), t) for i, t in BENCH if t]
    for r in decontaminate.scan(clashing(docs), bench, shard_bytes=shard).collect():
        c = r["contamination"]
        assert (c["n_words"], c["n_hit"], c["items"]) == plain_hits(r["text"], items)
    assert decontaminate.scan(docs, bench.limit(0)).where("contamination.n_hit > 0").count() == 0
    assert decontaminate.scan(docs.limit(0), bench).count() == 0


def test_removal_cuts_passages_or_documents(spark, odd_docs, clashing):
    bench = spark.createDataFrame(BENCH, "item_id bigint, text string")
    text = "Keep this. É A b c d e f g h i j K! And keep that, all of these words, please; here are some more."
    docs = clashing(odd_docs.unionByName(odd_docs.limit(1).withColumns({"doc_id": F.lit(50).cast("bigint"), "text": F.lit(text)})))
    cut = decontaminate.remove_contamination(docs, bench)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    assert cut.where("doc_id = 50").first()["text"] == "Keep this. É ! And keep that, all of these words, please; here are some more."
    assert decontaminate.remove_contamination(docs, bench, unit="document").count() == docs.count() - 1
    with pytest.raises(ValueError):
        decontaminate.remove_contamination(docs, bench, unit="line")


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = [int(c) for c in m[0] if c.isdigit()]
            check = sum(sum(divmod(2 * d, 10)) if k % 2 else d for k, d in enumerate(reversed(digits)))
            ok = {
                "email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 12 <= len(digits) <= 19 and check % 10 == 0, "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda x: (x[1], pii_bootstrap.KINDS.index(x[0])))


def test_base_spans_match_the_patterns(spark):
    rng = np.random.default_rng(4)
    pieces = ["a.b@c.de", "@", ".", "1.2.3.4", "300.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (974) 555-3436", "x", " ", "é", "12", "-", "a@b", "+", "0"]
    for _ in range(2000):
        text = "".join(rng.choice(pieces, rng.integers(1, 9)))
        assert pii_bootstrap.base_spans(text) == plain_spans(text), text
    for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect():
        assert pii_bootstrap.base_spans(r["text"]) == plain_spans(r["text"])
    long = pii_bootstrap.base_spans("a" * 300_000 + "1." * 100_000 + "@" * 1000 + "7" * 300_000)  # each four numbers are an address
    assert long == [("ip", 300_000 + 8 * k, 300_007 + 8 * k) for k in range(25_000)]


def test_patterns_discover_unseen_identifiers(spark, odd_docs, clashing):
    card = lambda k: next(s for s in (f"4{k:014d}{d}" for d in range(10)) if pii_bootstrap.luhn(s))
    rows = [(k, f"some text{k} here. Card no: {card(k)} thanks") for k in range(30)]
    rows += [(100, "Card no: 4000000000000001 thanks"), (101, "order 4000000000000001x17 of 4000000000000001 units"), (102, "nothing 12 here")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for shard in (100_000, 1):
        found = pii_bootstrap.find(docs, pii_bootstrap.discover(docs), shard=shard)
        added = {r["doc_id"]: r["s"] for r in found.select("doc_id", pii_bootstrap.joined(F.col("pii.added")).alias("s")).collect() if r["s"]}
        assert added == {100: "card:9:25"}
    assert pii_bootstrap.redact(docs).where("doc_id = 100").first()["text"] == "Card no: [CARD] thanks"
    odd = clashing(odd_docs)
    out = pii_bootstrap.redact(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    assert out.where("doc_id = 7").first()["text"] == "É🙂 ünï [PHONE] [EMAIL] [IP]"
    assert pii_bootstrap.redact(odd.limit(0)).count() == 0


def test_boundaries_are_optimal():
    rng = np.random.default_rng(6)
    for _ in range(30):
        lengths = np.sort(rng.choice(50, rng.integers(1, 9), replace=False))
        counts = rng.integers(1, 20, len(lengths))
        for k in (1, 2, 3):
            cost = lambda ends: sum(int(c) * (min(e for e in ends if e >= n) - int(n)) for n, c in zip(lengths, counts))
            least = min(cost([*some, lengths[-1]]) for m in range(k) for some in itertools.combinations(lengths[:-1], m))
            ends, padding = packing.best_boundaries(lengths, counts, k)
            assert padding == least == cost(ends) and len(ends) <= k


@pytest.mark.parametrize("shard_rows", [20_000, 7])
def test_packing_keeps_every_token(spark, odd_docs, no_docs, clashing, shard_rows):
    docs = clashing(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").unionByName(odd_docs))
    got = packing.pack(docs, max_length=64, buckets=5, token_budget=640, shard_rows=shard_rows).toPandas()
    want = sorted(len(re.findall(r"[^ \t\n\x0B\f\r]+", r["text"] or "")) for r in docs.collect())
    assert got.n_tokens.sum() == sum(want) and (got.padding >= 0).all() and (got.n_tokens <= 64).all()
    assert len(got) == sum(max(1, -(-n // 64)) for n in want)
    for (bucket, batch), own in got.groupby(["bucket", "batch"]):
        assert len(own) * max(bucket, 1) <= 640 and sorted(own.slot) == list(range(len(own)))
    for bucket, own in got.groupby("bucket"):
        full = own.groupby("batch").size()
        assert (full.iloc[:-1] == 640 // max(bucket, 1)).all() and list(full.index) == list(range(len(full)))
    ends, counts = np.unique(got.n_tokens, return_counts=True)
    assert got.padding.sum() == packing.best_boundaries(ends, counts, 5)[1]
    assert packing.pack(no_docs).count() == 0


PAGES = "page_id bigint, url string, html string"


@pytest.mark.parametrize("package", [1 << 20, 1000])
def test_archives_round_trip(spark, clashing, package):
    rows = [(5, "http://a/1", "<p>é</p>"), (3, "http://a/2\n", "<p>é</p>"), (9, None, None), (10, "", ""), (3, "http://a/2", "<p>é</p>"), (None, "u", "<p>é</p>"), (None, None, "lonely")]
    rows += [(100 + k, f"http://b/{k}", "x" * k + "\r\n\r\n") for k in range(40)] + [(500, "http://big", "z" * 300_000)]
    pages = spark.createDataFrame(rows, PAGES)
    folder = f"{scratch_dir(spark)}/test-{package}-{np.random.default_rng().integers(1 << 40)}"
    packages = zip_warc.write_packages(clashing(pages), folder, package_bytes=package)
    got = zip_warc.read_packages(packages).collect()
    assert len(got) == len(rows) == packages.agg(F.sum("records")).first()[0]
    kinds = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"]) for r in got if (r["page_id"] or 0) < 100)
    assert kinds == sorted([(0, "response", None), (0, "revisit", 3), (3, "response", None), (3, "response", None), (5, "revisit", 3), (9, "response", None), (10, "revisit", 9)], key=lambda x: (x[0], x[1]))
    for r in got:
        html = next((h or "") for i, _, h in rows if i == r["page_id"] and (i is not None or (h == "lonely") == (r["record_type"] == "response")))
        assert r["payload_bytes"] == len(html.encode()) and r["payload_digest"] == zip_warc.sha1_base32(html.encode())
        assert r["payload"] is None if r["record_type"] == "revisit" else bytes(r["payload"]) == html.encode()
    again = zip_warc.read_packages(zip_warc.write_packages(pages, folder, min_bytes=1), payloads=False).where("page_id in (9, 10)")
    assert {r["record_type"] for r in again.collect()} == {"response"}
    assert zip_warc.archive(pages.limit(0)).count() == 0


def test_zip64_directories(tmp_path):
    """More members than the short directory can count, 64-bit sizes, a comment that looks like an end record."""
    path = tmp_path / "many.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        for k in range(66_000):
            z.writestr(zipfile.ZipInfo(f"m/{k}"), b"")
        with z.open(zipfile.ZipInfo("archive/x"), "w", force_zip64=True) as f:
            f.write(b"payload")
        z.writestr(zipfile.ZipInfo("squeezed"), b"a" * 100, zipfile.ZIP_DEFLATED)
    src = zip_warc.Ranges(str(path))
    members = {m["name"]: m for m in zip_warc.central_directory(src)}
    assert len(members) == 66_002
    x = members["archive/x"]
    assert src.read(zip_warc.member_start(src, x), x["size"]) == b"payload"
    with pytest.raises(ValueError, match="compressed"):
        zip_warc.member_start(src, members["squeezed"])
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a", b"b")
        z.comment = b"PK\x05\x06 comment"
    (tmp_path / "c.zip").write_bytes(out.getvalue())
    assert [m["name"] for m in zip_warc.central_directory(zip_warc.Ranges(str(tmp_path / "c.zip")))] == ["a"]
    (tmp_path / "bad.zip").write_bytes(b"no archive")
    with pytest.raises(ValueError):
        zip_warc.central_directory(zip_warc.Ranges(str(tmp_path / "bad.zip")))


def test_a_changed_payload_is_noticed():
    record = zip_warc.warc_record(1, "http://a", b"<p>x</p>", None, False, "2000-01-01T00:00:00Z")
    assert zip_warc.parse_record(record)["payload"] == b"<p>x</p>"
    with pytest.raises(ValueError, match="digest"):
        zip_warc.parse_record(record.replace(b"<p>x", b"<p>y"))
    assert hashlib.sha1(b"").hexdigest() == "da39a3ee5e6b4b0d3255bfef95601890afd80709"


def test_contexts_are_whole_words_at_any_distance():
    plain = lambda t, s, e: (t[:s].lower().split()[-2:], t[e:].lower().split()[:1])
    long = "w" * 300
    for text in ("Call me now: 12 today", "12", " 12 ", "x 12", "a(12)b c", f"{long} is {long}12{long} end", "far" + " " * 500 + "away" + "\t" * 200 + "12" + " " * 90 + "Behind it"):
        s = text.index("12")
        before, after = plain(text, s, s + 2)
        one, two = pii_bootstrap._short(before[-1]) if before else "^", pii_bootstrap._short(before[-2]) if len(before) > 1 else "^"
        end = pii_bootstrap._short(after[0]) if after else "$"
        assert pii_bootstrap.contexts(text, ("ip", s, s + 2)) == [f"ip|{two} {one} _", f"ip|{one} _ {end}"]
    assert pii_bootstrap._short(long) != pii_bootstrap._short(long + "w") and len(pii_bootstrap._short(long * 9)) < 40


def test_candidates_of_any_length():
    assert pii_bootstrap.candidates("z" * 90 + "@" + "y" * 80, []) == [("email", 0, 171)]
    assert pii_bootstrap.candidates("555 " + " " * 60 + "1234", []) == [("phone", 0, 68)]
