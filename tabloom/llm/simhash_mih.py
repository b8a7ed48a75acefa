"""SimHash near-duplicates by multi-index hashing.

A fingerprint holds one bit per column of its shingles' hashes: 1 if set in more than half of them. Two
fingerprints within ``max_bits`` differ in at most ``max_bits // segments`` bits of one of the segments
into which the indexed 64 bits are cut. So each fingerprint is filed in a table under the value of every segment,
and looks up the small Hamming ball around that value; what it meets is verified by the complete distance.

* Equal fingerprints are one node (smallest id, map-side combined), whatever their number.
* Each pair is met once per segment: only ball members with a smaller key are looked up.
* A look-up is a cell (segment, key) of the shuffle. Keys with more than ``block`` fingerprints are cut into
  blocks and their cells into a grid of block pairs, so no task needs more than two blocks of a hot key.
* A batch of cells returns one star edge per linked fingerprint, never all pairs of a group.
* Components are found by star contraction on tables; nothing of data size reaches the driver.

With 3 segments (keys of 21 bits) a cell holds about n / 2^21 fingerprints; beyond some 10^9 distinct ones
take ``segments=2`` (keys of 32 bits, balls of 2 bits).

Defined results: null and wordless texts have fingerprint zero and link like any other; fewer words than the
shingle are one shingle; rows that share an id are one node; a row without id is fingerprinted but links
with nothing (component null); an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.functions.attach import attach
from tabloom.llm.components import connected_components
from tabloom.llm.shared import binaries, star_edges, stash

BLOCK = 4096
CHUNK = 255 * 128
#: odd constants that turn one hash of a shingle into independent further ones
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


def shingle_hashes(words: list[bytes], size: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of the space-joined shingles of ``words``, in bounded pieces."""
    digest = xxhash.xxh64_digest
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts, stops = ends - lengths, ends[min(size, len(words)) - 1 :]
    for k in range(0, len(stops), CHUNK):
        hashes = [digest(joined[s:e], 42) for s, e in zip(starts[k : k + CHUNK].tolist(), stops[k : k + CHUNK].tolist())]
        yield np.frombuffer(b"".join(hashes), ">u8").astype(np.uint64)


def votes(hashes: np.ndarray) -> np.ndarray:
    """In how many hashes each of the 64 bits (lowest first) is set."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    if len(bits) % 255:
        bits = np.concatenate([bits, np.zeros((-len(bits) % 255, 64), np.uint8)])
    # eight counters of a byte each are added at once; 255 rows cannot overflow them
    packed = bits.view(np.uint64).reshape(-1, 255, 8).sum(axis=1, dtype=np.uint64)
    return packed.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)


def fingerprint(text: bytes, size: int, parts: int) -> list[int]:
    """``parts`` words of 64 bits each as signed integers; A-Z is lower-cased, ASCII white space splits words."""
    words = text.lower().split()
    if not words:
        return [0] * parts
    n, count = 0, np.zeros((parts, 64), np.int64)
    for h in shingle_hashes(words, size):
        n += len(h)
        count[0] += votes(h)
        for p in range(1, parts):
            z = h * np.uint64(MIX[(p - 1) % 3]) + np.uint64(p)
            z ^= z >> np.uint64(31)
            z *= np.uint64(MIX[p % 3])
            count[p] += votes(z ^ (z >> np.uint64(29)))
    return np.packbits(2 * count > n, axis=1, bitorder="little").view("<i8").ravel().tolist()


def fingerprints(docs: DataFrame, *, text_col: str = "text", shingle: int = 4, parts: int = 1, into: str = "fp") -> DataFrame:
    """``docs`` with one more column: an array of ``parts`` 64-bit words."""

    def of(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t, shingle, parts) for t in binaries(texts)], pa.list_(pa.int64()))

    return docs.withColumn(into, F.arrow_udf(of, "array<bigint>").asNondeterministic()(F.col(text_col)))


def segments_of(n: int) -> list[tuple[int, int]]:
    """(offset, width) of ``n`` segments of 64 bits."""
    cuts = [round(64 * k / n) for k in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def ball(width: int, radius: int) -> list[int]:
    return [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def _pairs_within(role: np.ndarray, inner: np.ndarray, start: np.ndarray, n: np.ndarray, n_a: np.ndarray) -> Iterator:
    """Index pairs to verify, cell by cell: A x B, and A x A where ``inner``; rows of A come first in a cell."""
    for partner in ("b", "a"):
        other = n - n_a if partner == "b" else np.where(inner[start], n_a, 0)
        work = n_a * other
        first = start + n_a if partner == "b" else start
        small = np.flatnonzero((work > 0) & (work <= 1 << 16))
        for part in np.array_split(small, int(work[small].sum()) // (1 << 21) + 1):
            if not len(part):
                continue
            w = work[part]
            local = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
            cols = np.repeat(other[part], w)
            i, j = np.repeat(start[part], w) + local // cols, np.repeat(first[part], w) + local % cols
            yield (i, j) if partner == "b" else (i[i < j], j[i < j])
        for g in np.flatnonzero(work > 1 << 16).tolist():
            rows = max(1, (1 << 21) // int(other[g]))
            for r in range(0, int(n_a[g]), rows):
                i = np.arange(start[g] + r, start[g] + min(r + rows, int(n_a[g])))
                j = np.arange(first[g], first[g] + other[g])
                yield i, j, partner == "a"


def _verify(max_bits: int, full_bits: int, parts: int):
    """Sorted rows of cells -> star edges of the fingerprints within reach."""

    def links(fp: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        near = np.bitwise_count(fp[0][i] ^ fp[0][j]) <= max_bits
        i, j = i[near], j[near]
        if parts > 1 and len(i):
            far = sum(np.bitwise_count(f[i] ^ f[j]).astype(np.int64) for f in fp)
            i, j = i[far <= full_bits], j[far <= full_bits]
        return i, j

    def cells(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        cell = np.stack([table[c].to_numpy().astype(np.int64) for c in ("seg", "key", "kind", "x", "y")])
        role, inner, ids = (table[c].to_numpy() for c in ("role", "inner", "id"))
        fp = [table[f"f{p}"].to_numpy().view(np.uint64) for p in range(parts)]
        start = np.flatnonzero(np.concatenate([[True], (cell[:, 1:] != cell[:, :-1]).any(axis=0)]))
        n = np.diff(np.concatenate([start, [len(role)]]))
        n_a = np.add.reduceat((role == 0).astype(np.int64), start)
        a, b, held = [], [], 0
        for i, j, *block in _pairs_within(role, inner, start, n, n_a):
            if block:
                near = np.bitwise_count(fp[0][i][:, None] ^ fp[0][j][None, :]) <= max_bits
                if block[0]:
                    near &= i[:, None] < j[None, :]
                x, y = np.nonzero(near)
                i, j = i[x], j[y]
            i, j = links(fp, i, j)
            a.append(ids[i]), b.append(ids[j])
            held += len(i)
            if held > 1 << 20:
                x, y = star_edges(np.concatenate(a), np.concatenate(b))
                a, b, held = [x], [y], len(x)
        return star_edges(np.concatenate(a), np.concatenate(b)) if held else (ids[:0], ids[:0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.Table] = []
        names = ("seg", "key", "kind", "x", "y")
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if not table.num_rows:
                continue
            last = tuple(table[c][-1].as_py() for c in names)
            same = np.ones(table.num_rows, bool)
            for c, v in zip(names, last):
                same &= table[c].to_numpy() == v
            cut = int(np.argmax(same))  # the last cell may go on in the next batch
            if cut:
                yield from edges(pa.concat_tables([*rest, table.slice(0, cut)]))
                rest = []
            elif rest and tuple(rest[-1][c][-1].as_py() for c in names) != last:
                yield from edges(pa.concat_tables(rest))
                rest = []
            rest.append(table.slice(cut))
        if rest:
            yield from edges(pa.concat_tables(rest))

    def edges(table: pa.Table) -> Iterator[pa.RecordBatch]:
        a, b = cells(table.combine_chunks())
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def links_between(
    nodes: DataFrame, *, parts: int = 1, segments: int = 3, max_bits: int = 4, full_bits: int | None = None, block: int = BLOCK
) -> DataFrame:
    """Star edges (a, b) between nodes (id long, f0 .. long, distinct) within ``max_bits`` of f0, and within
    ``full_bits`` of all words together."""
    cuts, radius = segments_of(segments), max_bits // segments
    fps = [f"f{p}" for p in range(parts)]
    value = lambda off, width: F.shiftrightunsigned("f0", off).bitwiseAND((1 << width) - 1)
    filed = nodes.select(
        F.explode(F.array(*[F.struct(F.lit(s).alias("seg"), value(*cuts[s]).alias("key")) for s in range(segments)])).alias("t")
    ).select("t.*")
    hot = stash(filed.groupBy("seg", "key").count().where(F.col("count") > block), "mih-hot")
    masks = [(s, m) for s, (_, width) in enumerate(cuts) for m in ball(width, radius)]
    steps = F.array(*[F.struct(F.lit(s).alias("seg"), F.lit(m).cast("bigint").alias("mask")) for s, m in masks])
    own = F.element_at(F.array(*[value(*c) for c in cuts]), F.col("p.seg") + 1)
    rows = (
        nodes.select("id", *fps, F.explode(steps).alias("p"))
        .select("id", *fps, F.col("p.seg").alias("seg"), own.alias("own"), F.col("p.mask").alias("mask"))
        .withColumn("key", F.col("own").bitwiseXOR(F.col("mask")))
        .where("mask = 0 or key < own")
        .withColumn("role", F.when(F.col("mask") == 0, 0).otherwise(1))
    )
    cell = ["seg", "key", "kind", "x", "y"]
    if not hot.limit(1).count():
        zero = F.lit(0)
        rows = rows.select("seg", "key", zero.alias("kind"), zero.alias("x"), zero.alias("y"), "role", F.lit(True).alias("inner"), "id", *fps)
    else:
        looked = (
            hot.select("seg", "key", "count", F.explode(F.array_distinct(F.transform(F.filter(steps, lambda p: p.seg == F.col("seg")), lambda p: p.mask))).alias("m"))
            .where("m <> 0 and (key ^ m) < key")
            .groupBy("seg", F.col("key").bitwiseXOR(F.col("m")).alias("key"))
            .agg(F.sum("count").alias("probes"))
        )
        blocks = hot.select("seg", "key", F.ceil(F.col("count") / block).cast("int").alias("nt"))
        probes = looked.select("seg", "key", (1 + F.floor(F.col("probes") / block)).cast("int").alias("np"))
        sized = rows.join(blocks, ["seg", "key"], "left").join(probes, ["seg", "key"], "left").fillna(1, ["nt", "np"])
        t, nt, np_ = F.pmod(F.xxhash64("id"), F.col("nt")).cast("int"), F.col("nt"), F.col("np")
        p = F.pmod(F.xxhash64("id", F.lit(1)), np_).cast("int")
        spot = lambda kind, x, y, role, inner: F.struct(
            F.lit(kind).alias("kind"), x.alias("x"), y.alias("y"), F.lit(role).alias("role") if isinstance(role, int) else role.alias("role"), inner.alias("inner")
        )
        zero, no, yes = F.lit(0), F.lit(False), F.lit(True)
        upto = lambda n: F.sequence(F.lit(0), n - 1)
        among = F.transform(upto(nt), lambda j: spot(1, F.least(t, j), F.greatest(t, j), F.when(j < t, 1).otherwise(0), j == t))
        filed_at = F.concat(among, F.transform(upto(np_), lambda j: spot(2, t, j, 0, no)))
        asked_at = F.transform(upto(nt), lambda j: spot(2, j, p, 1, no))
        lone = F.array(spot(0, zero, zero, F.col("role"), yes))
        places = F.when(nt * np_ == 1, lone).when(F.col("role") == 0, filed_at).otherwise(asked_at)
        rows = sized.select("seg", "key", "id", *fps, F.explode(places).alias("c")).select("seg", "key", "c.*", "id", *fps)
    spread = rows.repartition(*cell).sortWithinPartitions(*cell, "role")
    return spread.mapInArrow(_verify(max_bits, 64 * parts if full_bits is None else full_bits, parts), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    parts: int = 1,
    segments: int = 3,
    max_bits: int = 4,
    full_bits: int | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """One row per document: id (long), fp (array of words), component_id (smallest id reachable)."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    fps = [f"f{p}" for p in range(parts)]
    marked = fingerprints(rows, text_col="text", shingle=shingle, parts=parts).select(
        "id", *[F.element_at("fp", p + 1).alias(f) for p, f in enumerate(fps)]
    )
    marked = stash(marked, "mih-docs")
    classes = stash(
        marked.where("id is not null").groupBy(*fps).agg(F.min("id").alias("id"), F.count("*").alias("copies")), "mih-nodes"
    )
    edges = links_between(
        classes, parts=parts, segments=segments, max_bits=max_bits, full_bits=full_bits, block=block
    )
    # an id with several texts ties their classes
    ties = marked.where("id is not null").groupBy("id").agg(*[F.min(f).alias(f) for f in fps], *[F.max(f).alias(f"_{f}") for f in fps])
    ties = ties.where(" or ".join(f"{f} <> _{f}" for f in fps)).select("id")
    if ties.limit(1).count():
        own = marked.join(ties, "id", "left_semi").join(classes.withColumnRenamed("id", "rep"), fps)
        edges = edges.unionByName(own.select(F.col("id").alias("a"), F.col("rep").alias("b")))
    found = connected_components(edges)
    table = stash(
        classes.join(found, "id", "left").select(*fps, "copies", F.coalesce("component", "id").alias("component_id")), "mih-classes"
    )
    out = attach(marked, table, fps, "copies")
    return out.select("id", F.array(*fps).alias("fp"), F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))


def keep_one(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4, segments: int = 3, block: int = BLOCK
) -> DataFrame:
    """``docs`` with one document of each group of ``near_duplicates``: the smallest id. Rows without id stay; of rows that repeat an
    id one stays."""
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, shingle=shingle, max_bits=max_bits, segments=segments, block=block)
    found = stash(found.select("id", "component_id"), "mih-copies")
    key = F.col(id_col).cast("bigint")
    # rows without id match nothing: a second key spreads them
    spread = F.when(key.isNull(), F.xxhash64(text_col)).otherwise(F.lit(0).cast("bigint"))
    met = lambda other: (key == other["__id"]) & (spread == other["__zero"])
    ids = lambda df: df.select(F.col("id").alias("__id"), F.lit(0).cast("bigint").alias("__zero"))
    gone = ids(found.where("id <> component_id")).distinct()
    # documents are shuffled once at every size; the ids that go grow with the corpus and are never broadcast
    left = docs.join(gone.hint("merge"), met(gone), "left_anti")
    again = stash(ids(found.where("id is not null").groupBy("id").count().where("count > 1")), "mih-again")
    if not again.limit(1).count():
        return left
    one = left.join(again, met(again), "left_semi").dropDuplicates([id_col])
    return left.join(again, met(again), "left_anti").unionByName(one)
