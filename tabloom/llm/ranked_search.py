"""Ranked lexical search by Block-Max MaxScore.

The index is cut into shards of bounded size that a task builds from the documents it reads, without a shuffle. A shard holds a
compressed posting list per term: blocks of ``BLOCK`` postings as narrow gaps and counts, with the block's last document and its
skyline, the (count, document length) pairs that no other posting of the block dominates. The score of a posting rises with the count
and falls with the length, so the skyline gives the exact block maximum once the corpus statistics are known, without decompression.

A query walks a shard's lists by falling bound. Lists are essential while the bounds of those still to come reach the score of the
k-th document so far; they are read whole. From there on no new document can enter: each further list is asked only about the
candidates left, a candidate goes if its score, its block's maximum and the bounds of the rest stay below the k-th score, and only blocks
that still hold a candidate are decompressed. Rejections are strict, so equal scores always reach the final order. Each shard
returns a heap of at most ``k`` documents per query, and a ranked window merges the heaps.

* Terms are the ASCII letters, digits and non-ASCII characters in a row; only A-Z is lower-cased.
* Corpus statistics (documents, terms, document frequencies) are sums over the shards' lists, so they cover all documents.
* Queries go to the shards in blocks of ``QUERY_BYTES``; every block is one bounded broadcast, dropped after its job. Only lists of
  its terms are read.
* A shard holds at most ``SHARD_DOCS`` documents and about ``SHARD_TERMS`` terms (a longer document is a shard's last).

Defined results: texts that are null or without a term take no part; a document row is a document, so rows that share an id are ranked
each; rows without id are ranked, after others of their score; equal scores come by ascending id; each query row is ranked
alone, also where rows share a key; queries without a term have no rows; empty tables give an empty one. Other columns are ignored.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabloom.functions.attach import attach
from tabloom.llm.shared import binaries, scratch_dir, stash

BLOCK = 128
SHARD_DOCS, SHARD_TERMS = 1 << 14, 1 << 21
QUERY_BYTES = 4 << 20
PIECE = 1 << 20
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
INDEX = (
    "shard bigint, term string, df bigint, total bigint, ends array<int>, last array<int>, sky array<int>, sky_tf array<bigint>, "
    "sky_n array<bigint>, data array<binary>"
)


def term_counts(text: bytes) -> Counter:
    """Terms of a UTF-8 text with their counts; long texts in pieces that end between terms."""
    counts: Counter = Counter()
    at = 0
    while at < len(text):
        cut = _GAP.search(text, at + PIECE)
        end = cut.start() if cut else len(text)
        counts.update(_TERM.findall(text[at:end].lower()))
        at = end
    return counts


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def length_norm(n: np.ndarray, docs: int, total: int) -> np.ndarray:
    return 75 + (25 * n * docs) // max(total, 1)


def _wide(data: bytes, n: int) -> tuple[np.ndarray, int]:
    width = data[0]
    return np.frombuffer(data, f"<u{width}", n, 1).astype(np.int64), 1 + n * width


def compress(docs: np.ndarray, tf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of ascending document numbers with counts as (bytes, end of each block): the width of the gaps (1, 2, 4 or 8 bytes), the
    gaps, the width of the counts, the counts. All blocks are laid out by array operations at once."""
    n = np.diff(starts, append=len(docs))
    gaps = np.diff(docs, prepend=0)
    gaps[starts] = docs[starts]
    place = np.arange(len(docs)) - np.repeat(starts, n)
    parts = []
    for x in (gaps, tf):
        top = np.maximum.reduceat(x, starts)
        parts.append((x, np.select([top < 1 << 8, top < 1 << 16, top < 1 << 32], [1, 2, 4], 8)))
    ends = np.cumsum(2 + n * (parts[0][1] + parts[1][1]))
    out = np.zeros(ends[-1], np.uint8)
    head = np.concatenate([[0], ends[:-1]])
    for x, width in parts:
        out[head] = width
        own = np.repeat(width, n)
        at = np.repeat(head + 1, n) + place * own
        for k in range(int(width.max())):
            here = own > k
            out[at[here] + k] = (x[here] >> 8 * k) & 0xFF
        head = head + 1 + n * width
    return out, ends


def decompress(data: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    gaps, end = _wide(data, n)
    return np.cumsum(gaps), _wide(data[end:], n)[0]


def skyline(block: np.ndarray, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Places of the postings of ascending blocks that no posting of their block beats in both count and length."""
    order = np.lexsort((-tf, n, block))
    step = int(tf.max()) + 1 if len(tf) else 1
    top = np.maximum.accumulate(tf[order] + block[order] * step)
    return order[np.concatenate([[True], top[1:] > top[:-1]])] if len(tf) else order


class Shard:
    """Documents of a shard under construction."""

    def __init__(self) -> None:
        self.ids, self.lengths, self.distinct = [], [], []
        self.terms: dict[bytes, int] = {}
        self.where, self.tf = [], []
        self.size = 0

    def add(self, doc: int | None, counts: Counter) -> None:
        number = self.terms
        n = sum(counts.values())
        self.where += [number.setdefault(t, len(number)) for t in counts]
        self.tf += counts.values()
        self.ids.append(doc), self.lengths.append(n), self.distinct.append(len(counts))
        self.size += n

    def lists(self, shard: int) -> pa.RecordBatch:
        """A row per term, and one with the empty term for the documents: ids, validity and lengths."""
        where, tf = np.array(self.where, np.int64), np.array(self.tf, np.int64)
        lengths = np.array(self.lengths, np.int64)
        doc = np.repeat(np.arange(len(lengths)), self.distinct)
        order = np.argsort(where, kind="stable")
        where, tf, doc = where[order], tf[order], doc[order]
        df = np.bincount(where, minlength=len(self.terms))
        place = np.arange(len(where)) - np.repeat(np.cumsum(df) - df, df)
        starts = np.flatnonzero(place % BLOCK == 0)
        ends = np.append(starts[1:], len(where))
        block = np.repeat(np.arange(len(starts)), ends - starts)
        best = skyline(block, tf, lengths[doc])
        data, data_ends = compress(doc, tf, starts)
        blocks = -(-df // BLOCK)  # of each list
        cuts = np.concatenate([[0], np.cumsum(blocks)])
        sky = np.bincount(block[best], minlength=len(starts))
        held = np.concatenate([[0], np.cumsum(sky)])[cuts]  # skyline pairs of each list
        at = lambda cut: pa.array(np.append(cut, cut[-1]), pa.int32())  # noqa: E731  the document row's arrays are empty
        ids = np.array([0 if i is None else i for i in self.ids], np.int64)
        known = np.array([i is not None for i in self.ids])
        own = [np.frombuffer(x.tobytes(), np.uint8) for x in (ids, known, lengths)]
        offsets = np.concatenate([[0], data_ends, data_ends[-1] + np.cumsum([len(x) for x in own])])
        lists = pa.Array.from_buffers(  # the last three are the document row's
            pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.concatenate([data, *own]))]
        ).cast(pa.binary())
        names = pa.array([*self.terms, b""], pa.binary()).cast(pa.string())
        columns = [
            pa.array(np.full(len(names), shard)), names, pa.array(np.append(df, len(ids))),
            pa.array([*[0] * len(df), int(lengths.sum())], pa.int64()),
            pa.ListArray.from_arrays(at(cuts), pa.array(ends - starts, pa.int32())),
            pa.ListArray.from_arrays(at(cuts), pa.array(doc[ends - 1], pa.int32())),
            pa.ListArray.from_arrays(at(cuts), pa.array(sky, pa.int32())),
            pa.ListArray.from_arrays(at(held), pa.array(tf[best], pa.int64())),
            pa.ListArray.from_arrays(at(held), pa.array(lengths[doc[best]], pa.int64())),
            pa.ListArray.from_arrays(pa.array([*cuts.tolist(), len(starts) + 3], pa.int32()), lists),
        ]
        return pa.RecordBatch.from_arrays(columns, ["shard", "term", "df", "total", "ends", "last", "sky", "sky_tf", "sky_n", "data"])


def _builder(shard_docs: int, shard_terms: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        done, shard = 0, Shard()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), binaries(batch.column(1))):
                counts = term_counts(text)
                if not counts:
                    continue
                shard.add(doc, counts)
                if len(shard.ids) >= shard_docs or shard.size >= shard_terms:
                    yield shard.lists(first + done)
                    done, shard = done + 1, Shard()
        if shard.ids:
            yield shard.lists(first + done)

    return build


def build_index(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shard_docs: int = SHARD_DOCS, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """The index of all rows of ``docs`` as a table of the shared folder."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return stash(rows.mapInArrow(_builder(shard_docs, shard_terms), INDEX), "rank-index")


class Postings:
    """A posting list of a shard; blocks are decompressed when asked for and kept for the shard's other queries."""

    def __init__(self, ends, last, sky, sky_tf, sky_n, data, norm, corpus):
        self.ends, self.last, self.data, self.norm = ends, last, data, norm
        starts = np.cumsum(sky) - sky
        self.top = np.maximum.reduceat(impact(sky_tf, length_norm(sky_n, *corpus)), starts)
        self.most = int(self.top.max())
        self.read: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.whole = None

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        if b not in self.read:
            docs, tf = decompress(self.data[b], int(self.ends[b]))
            self.read[b] = docs, impact(tf, self.norm[docs])
        return self.read[b]

    def blocks(self, which: list[int]) -> tuple[np.ndarray, np.ndarray]:
        parts = [self.block(b) for b in which]
        return parts[0] if len(parts) == 1 else tuple(np.concatenate(x) for x in zip(*parts))

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        if self.whole is None:
            self.whole = self.blocks(list(range(len(self.data))))
        return self.whole


def kth(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def top_documents(lists: list[tuple[Postings, int]], n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) that hold the ``k`` best and all their ties at the last place; ``lists`` with the weight of each."""
    lists = sorted(lists, key=lambda x: -x[1] * x[0].most)
    rest = np.zeros(len(lists) + 1, np.int64)
    rest[:-1] = np.cumsum([c * p.most for p, c in reversed(lists)])[::-1]
    score = np.zeros(n_docs, np.int64)
    least, j = 0, 0
    while j < len(lists):  # essential lists
        docs, q = lists[j][0].all()
        score[docs] += lists[j][1] * q
        j += 1
        if j < len(lists) and score.max() > rest[j]:
            least = kth(score, k)
            if rest[j] < least:
                break
    left = np.flatnonzero(score + rest[j] >= max(least, 1)) if j < len(lists) else np.flatnonzero(score)
    while j < len(lists) and len(left):
        postings, c = lists[j]
        b = np.searchsorted(postings.last, left)
        held = b < len(postings.last)
        bound = np.zeros(len(left), np.int64)
        bound[held] = c * postings.top[b[held]]
        keep = score[left] + bound + rest[j + 1] >= least
        left, b = left[keep], b[keep & held] if not keep.all() else b[held]
        wanted = np.unique(b)
        if len(wanted):
            docs, q = postings.blocks(wanted.tolist())
            at = np.minimum(np.searchsorted(docs, left), len(docs) - 1)
            hit = docs[at] == left
            score[left[hit]] += c * q[at[hit]]
        j += 1
        least = max(least, kth(score[left], k))
        left = left[score[left] + rest[j] >= least]
    return left, score[left]


def _searcher(queries, k: int, n_docs: int, total: int):
    """The lists of one shard -> its best documents per query."""

    def search(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        terms = table["term"].to_pylist()
        own = table["data"][terms.index("")].as_py()
        ids, known, lengths = np.frombuffer(own[0], np.int64), np.frombuffer(own[1], bool), np.frombuffer(own[2], np.int64)
        norm = length_norm(lengths, n_docs, total)
        arrays = {c: table[c].chunk(0) for c in ("ends", "last", "sky", "sky_tf", "sky_n")} if len(terms) else {}
        parts = {c: (a.offsets.to_numpy(), a.values.to_numpy()) for c, a in arrays.items()}
        lists, weight = {}, {}
        for r, (term, w) in enumerate(zip(terms, table["w"].to_pylist())):
            if term:
                lists[term] = Postings(*[v[o[r] : o[r + 1]] for o, v in parts.values()], table["data"][r].as_py(), norm, (n_docs, total))
                weight[term] = w
        out: list[tuple[int, int, int, int]] = []
        for q, wanted in queries.value:
            own_lists = [(lists[t], weight[t] * c) for t, c in wanted if t in lists]
            if not own_lists:
                continue
            docs, score = top_documents(own_lists, len(ids), k)
            best = np.lexsort((docs, ids[docs], ~known[docs], -score))[:k]
            out += [(q, int(ids[d]) if known[d] else None, s) for d, s in zip(docs[best].tolist(), score[best].tolist()) if s > 0]
        return pa.table(
            {"q": pa.array([r[0] for r in out], pa.int64()), "doc": pa.array([r[1] for r in out], pa.int64()), "score": pa.array([r[2] for r in out], pa.int64())}
        )

    return search


def query_terms(queries: DataFrame, *, key_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """((q, key) of each query row, (q, term, tf))."""
    low = F.translate(F.col(text_col), _UPPER, _UPPER.lower())
    rows = stash(
        queries.select(F.monotonically_increasing_id().alias("q"), F.col(key_col).alias("key"), F.regexp_extract_all(low, F.lit(TERM), F.lit(0)).alias("t")),
        "rank-queries",
    )
    return rows.select("q", "key"), rows.select("q", F.explode("t").alias("term")).groupBy("q", "term").agg(F.count("*").alias("tf"))


def search(index: DataFrame, queries: DataFrame, *, key_col: str = "item_id", text_col: str = "text", k: int = 20, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """The ``k`` best documents of each query: ``key_col``, rank, doc_id, score."""
    spark = index.sparkSession
    keys, wanted = query_terms(queries, key_col=key_col, text_col=text_col)
    wanted = stash(wanted, "rank-wanted")
    vocabulary = stash(wanted.groupBy("term").agg(F.count("*").alias("n")).withColumn("asked", F.lit(True)), "rank-vocabulary")
    n_docs, total = (int(v or 0) for v in index.where("term = ''").agg(F.sum("df"), F.sum("total")).first())
    met = attach(index.where("term <> ''").select("term", "df"), vocabulary, ["term"], "n").where("asked").groupBy("term").agg(F.sum("df").alias("df"))
    w = F.floor(1000 * F.log((2 * n_docs + 2) / (2 * F.col("df") + 1))).cast("bigint")
    weights = stash(met.withColumn("w", w).where("w > 0"), "rank-weights")
    wanted = stash(
        wanted.join(weights.select("term"), "term").groupBy("q").agg(
            F.collect_list(F.struct("term", "tf")).alias("t"), F.sum(F.octet_length("term") + 24).alias("bytes")
        ),
        "rank-asked",
    )
    size = wanted.agg(F.sum("bytes")).first()[0] or 0
    blocks = -(-size // query_bytes)
    part = F.pmod(F.xxhash64("q"), F.lit(max(blocks, 1)))
    heaps = f"{scratch_dir(spark)}/rank-heaps-{uuid.uuid4().hex[:12]}"
    shape = "q bigint, doc bigint, score bigint"
    spark.createDataFrame([], shape).write.mode("overwrite").parquet(heaps)
    for b in range(blocks):
        mine = stash(wanted.where(part == b), "rank-block")
        asked = [(r["q"], [(t["term"], t["tf"]) for t in r["t"]]) for r in mine.toLocalIterator()]
        terms = stash(mine.select(F.explode("t.term").alias("term")).groupBy("term").agg(F.count("*").alias("n")).join(weights.select("term", "w"), "term"), "rank-terms")
        lists = attach(index, terms, ["term"], "n").where("w is not null or term = ''")
        shared = spark.sparkContext.broadcast(asked)
        found = lists.groupBy("shard").applyInArrow(_searcher(shared, k, n_docs, total), shape)
        found.write.mode("append").parquet(heaps)
        shared.unpersist()
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    best = spark.read.schema(shape).parquet(heaps).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(keys, "q").select(F.col("key").alias(key_col), "rank", F.col("doc").alias("doc_id"), "score")
