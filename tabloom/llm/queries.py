"""The queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabloom.llm import (
    conversation_repair, ctw, decontaminate, embedding_pca, language_nb, license_scan, packing, pii_bootstrap, quality_rff, ranked_search,
    simhash_mih, toxic_segments, zip_warc,
)
from tabloom.llm.shared import fold



def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _held_out(remainder: int = 0):
    return (fold(F.col("doc_id")) == remainder).alias("held_out")


def op1_quality_rff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document."""
    scored = quality_rff.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    score = F.col("quality")
    return scored.select("doc_id", _held_out(), score.alias("score"), (score >= 0.3).cast("int").alias("predicted"))


def op2_packing_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every piece of every document goes."""
    return packing.pack(_table(spark, sf_dir, "documents"))


def op3_embedding_pca(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return embedding_pca.near_vectors(_table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op4_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document; the counts and the digest are those of the base spans."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii_bootstrap.find(docs, pii_bootstrap.discover(docs))
    base, added = F.col("pii.base"), F.col("pii.added")
    count = lambda kind: F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("bigint")
    n = [count(k).alias(f"n_{k}") for k in pii_bootstrap.KINDS]
    return found.select(
        "doc_id", *n, F.sha2(pii_bootstrap.joined(base), 256).alias("base_sha256"),
        pii_bootstrap.joined(pii_bootstrap.in_order(base, added)).alias("spans"), F.size(added).cast("bigint").alias("n_added"),
    )


def op5_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxic_segments.score(docs, _table(spark, sf_dir, "labels"))
    score = F.col("toxicity.score")
    return scored.select(
        "doc_id", _held_out(), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), F.size("toxicity.passages").alias("n_passages")
    )


def op6_simhash_mih(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash_mih.near_duplicates(_table(spark, sf_dir, "documents"))
    hexed = F.lpad(F.lower(F.hex(F.col("fp")[0])), 16, "0")
    return found.select(F.col("id").alias("doc_id"), hexed.alias("fingerprint"), "component_id")


def op7_language_nb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language_nb.identify(docs.select("doc_id", "text"), docs.where(fold(F.col("doc_id")) != 0))
    return found.select("doc_id", _held_out(), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


def op8_ctw_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model log10 probability of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return ctw.score(docs, fold(F.col("doc_id")) != 1, keep={"held_out": _held_out(1)})


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.scan(docs, _table(spark, sf_dir, "benchmark"))
    items = F.col("contamination.items")
    return found.select(
        "doc_id", F.col("contamination.n_words").alias("n_words"), F.col("contamination.n_hit").alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"), F.sha2(F.array_join(F.array_sort(items), ","), 256).alias("items_sha256"),
        (F.col("contamination.n_hit") > 0).alias("contaminated"),
    )


def op10_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, written to ZIP packages and read back."""
    found = zip_warc.archive(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_maxscore_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every benchmark item."""
    index = ranked_search.build_index(_table(spark, sf_dir, "documents"))
    return ranked_search.search(index, _table(spark, sf_dir, "benchmark"), k=20)


def op12_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses of every document."""
    found = license_scan.scan(_table(spark, sf_dir, "documents"))
    joined = [F.array_join(c, ",").alias(c) for c in ("base_labels", "labels")]
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", *joined, "score")


def op13_conversation_dawg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired text of every conversation."""
    found = conversation_repair.damage_and_repair(_table(spark, sf_dir, "conversations"))
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rff, op2_packing_buckets, op3_embedding_pca, op4_pii_bootstrap, op5_toxic_segments, op6_simhash_mih,
        op7_language_nb, op8_ctw_score, op9_decontaminate, op10_zip_warc, op11_maxscore_search, op12_license_diagonals, op13_conversation_dawg,
    )
}

def _license_sql() -> str:
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.text.lower())
    table = ",\n  ".join(f"({k}, '{t.label}', {t.phrase}, {words(t)})" for k, t in enumerate(license_scan.TEMPLATES))
    return rf"""
WITH tpl(tpl, label, phrase, tw) AS (VALUES
  {table}
), sized AS (SELECT *, len(tw) - 2 AS places, greatest(1, least(8, (len(tw) - 2) // 8)) AS slack FROM tpl),
d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
),
grams AS (SELECT tpl, tpos, tw[tpos + 1] || ' ' || tw[tpos + 2] || ' ' || tw[tpos + 3] AS gram FROM (SELECT tpl, tw, unnest(range(places)) AS tpos FROM sized)),
placed AS (SELECT r, pos, w[pos + 1] || ' ' || w[pos + 2] || ' ' || w[pos + 3] AS gram FROM (SELECT r, w, unnest(range(len(w) - 2)) AS pos FROM d WHERE len(w) > 2)),
hit AS (SELECT r, tpl, pos - tpos AS diag, tpos FROM placed JOIN grams USING (gram)),
vote AS (SELECT r, tpl, diag, count(*) AS v FROM hit GROUP BY ALL),
edge AS (SELECT v.*, s.places, s.phrase, s.label, s.tw, diag - lag(diag, 1, -1000000000) OVER (PARTITION BY r, v.tpl ORDER BY diag) > slack AS new FROM vote v JOIN sized s USING (tpl)),
region AS (SELECT *, sum(new::INT) OVER (PARTITION BY r, tpl ORDER BY diag) AS region FROM edge),
together AS (SELECT r, tpl, region, count(DISTINCT tpos) AS u FROM hit JOIN region USING (r, tpl, diag) GROUP BY ALL),
best AS (
  SELECT r, tpl, region, places, phrase, label, max(v) AS best, max(diag) - min(diag) <= (places + 2) // 2 AS narrow, count(*) FILTER (v = places) AS n_full,
    min(diag) FILTER (v = places) AS first_full, max(diag) FILTER (v = places) AS last_full FROM region GROUP BY r, tpl, region, places, phrase, label
),
span AS (SELECT *, CASE WHEN narrow THEN u ELSE best END AS matched FROM best JOIN together USING (r, tpl, region)),
own AS (
  SELECT r, sum(n_full) FILTER (phrase) AS n_base, min(first_full) FILTER (phrase) AS first_word, max(last_full) FILTER (phrase) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (phrase AND n_full > 0) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (CASE WHEN phrase THEN n_full > 0 ELSE matched * {license_scan.SHARE[1]} >= places * {license_scan.SHARE[0]} END) AS labels,
    max(CASE WHEN phrase THEN (n_full > 0)::INT::DOUBLE ELSE matched::DOUBLE / places END) AS score FROM span GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN own USING (r)
"""


SQL: dict[str, str] = {
    "op3_embedding_pca": """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
  SELECT vec_id AS id, vec_id AS other FROM embeddings
  UNION SELECT r.id, l.b FROM reach r JOIN link l ON r.other = l.a
), component AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id),
degree AS (SELECT a AS id, count(*) AS n FROM link GROUP BY a)
SELECT e.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, c.component_id, c.component_id = e.vec_id AS kept
FROM embeddings e JOIN component c ON c.id = e.vec_id LEFT JOIN degree d ON d.id = e.vec_id
""",
    "op9_decontaminate": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), g AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(list_slice(w, i, i + least(10, len(w)) - 1), ' ') AS s
  FROM (SELECT item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
), p AS (SELECT DISTINCT n FROM g),
windows AS (
  SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, p WHERE len(w) >= n)
), hit AS (SELECT doc_id, i, windows.n, item FROM windows JOIN g ON windows.s = g.s AND windows.n = g.n),
words AS (
  SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS k FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS l FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
  sha256(coalesce(items.l, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON words.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id
""",
    "op10_zip_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS h FROM pages),
s AS (SELECT page_id, octet_length(h) AS n, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(x, 1 + 5 * (k // 4)::INT, 5))::INT >> (15 - 5 * (k % 4)::INT)) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM s
""",
    "op11_maxscore_search": r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), b AS MATERIALIZED (
  SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark
),
c AS (SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS total FROM d WHERE len(w) > 0),
qt AS (SELECT q, term, count(*)::BIGINT AS qtf FROM (SELECT q, unnest(w) AS term FROM b) GROUP BY ALL),
tf AS (
  SELECT r, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT r, doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM qt) GROUP BY ALL
),
df AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM tf, c GROUP BY term, n_docs),
impact AS (
  SELECT r, doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // total))) AS x FROM tf JOIN df USING (term), c
),
scored AS (SELECT q, r, doc_id, sum(x * qtf)::BIGINT AS score FROM qt JOIN impact USING (term) GROUP BY ALL HAVING sum(x * qtf) > 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM scored)
SELECT item_id, rank, doc_id, score FROM ranked JOIN b USING (q) WHERE rank <= 20
""",
    "op12_license_diagonals": _license_sql(),
}
