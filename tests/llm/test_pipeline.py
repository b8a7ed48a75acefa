"""The pipeline's stages and the registered queries."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import check  # noqa: E402
import corpus_pipeline  # noqa: E402

from tabloom.llm import packing, pii_bootstrap, toxic_segments  # noqa: E402
from tabloom.llm.queries import QUERIES, SQL  # noqa: E402


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf, name):
    note = check.compare(QUERIES[name](spark, sf), check.connect(sf), SQL[name])
    assert note.startswith("ok"), note


def test_queries_and_stages():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "pii", "packing"]


def test_stages_do_what_they_say(spark, sf, odd_docs):
    docs = spark.read.parquet(f"{sf}/documents.parquet").unionByName(odd_docs).cache()
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, sf)
    kept = toxic_segments.score(docs, labels).where("toxicity.score < 0.5")
    assert clean.columns == docs.columns and clean.count() == kept.count()
    one = stages["near_dedup"](spark, docs, sf)
    assert one.columns == docs.columns
    texts = [r["text"] for r in one.where("doc_id is not null and text is not null").collect()]
    words = [tuple(t.encode().lower().split()) for t in texts]
    assert len(set(words)) == len(words)  # no exact copy is left
    masked = stages["pii"](spark, docs, sf)
    assert masked.columns == docs.columns and masked.count() == docs.count()
    assert not any(pii_bootstrap.base_spans(r["text"] or "") for r in masked.collect())
    last = stages["packing"](spark, docs, sf)
    assert last.agg({"n_tokens": "sum"}).first()[0] == docs.select(packing.word_count(docs["text"]).alias("n")).agg({"n": "sum"}).first()[0]
    empty = docs.limit(0)
    assert all(stage(spark, empty, sf).count() == 0 for stage in stages.values())


def test_nothing_learned_rejects_nothing(spark, odd_docs, odd_labels):
    toxic = odd_labels.where("toxic = 1")
    for labels in (odd_labels.limit(0), toxic):
        assert toxic_segments.reject_toxic(odd_docs, labels).count() == odd_docs.count()


def test_decontamination_cuts_benchmark_passages(spark, sf):
    item = spark.read.parquet(f"{sf}/benchmark.parquet").where("length(text) > 100").first()["text"]
    clean = "word " * 300
    docs = spark.createDataFrame([(1, clean), (2, clean + item + " " + clean), (3, item)], "doc_id bigint, text string")
    left = {r["doc_id"]: r["text"] for r in dict(corpus_pipeline.STAGES)["decontamination"](spark, docs, sf).collect()}
    assert set(left) == {1, 2} and left[1] == clean and item not in left[2] and left[2].count("word") == 600


def test_run_is_the_stages_in_a_row(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    want = sorted((tuple(r) for r in docs.select("doc_id", "bucket", "batch", "slot").collect()), key=repr)
    out = corpus_pipeline.run(spark, sf)
    assert want and sorted((tuple(r) for r in out.select("doc_id", "bucket", "batch", "slot").collect()), key=repr) == want
