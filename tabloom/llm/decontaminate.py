"""Benchmark decontamination: a broadcast hash set of normalised test windows, verified word by word.

``scan`` looks up every window of consecutive words of every whole document among the windows of the
benchmark. The benchmark side is counted in bytes first: within ``shard_bytes`` it is one broadcast,
beyond that it is cut into shards by item, each broadcast and applied in turn to the same rows, so that no
broadcast grows with the benchmark and no document is shuffled.

Defined results: null or wordless texts have no words and no hits; an item of fewer words than the window,
but not none, is one window; items without words are ignored; an item without id goes by the empty id;
repeated items count once; an empty benchmark hits nothing. Other columns, whatever their names, pass through.
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.shared import binaries

SHARD_BYTES = 2 << 20
FOUND = "struct<n_words:bigint,n_hit:bigint,ranges:array<struct<s:int,e:int>>,items:array<string>>"
_ARROW = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("ranges", pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())]))),
        ("items", pa.list_(pa.string())),
    ]
)

#: ASCII letters in lower case, digits and everything beyond ASCII make words
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Windows:
    """The windows of a bounded set of items: word -> number, and by length window -> items."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.vocab: dict[bytes, int] = {}
        self.by_length: dict[int, dict[tuple, set]] = defaultdict(lambda: defaultdict(set))
        for item, text in items:
            ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words_of(text)]
            length = min(window, len(ids))
            for k in range(len(ids) - length + 1 if ids else 0):
                self.by_length[length][tuple(ids[k : k + length])].add(item)
        self.by_length = {n: dict(w) for n, w in self.by_length.items()}
        draw = np.random.default_rng(7)
        self.code = draw.integers(1, 2**63, len(self.vocab) + 1, dtype=np.uint64)
        self.step = draw.integers(1, 2**63, window, dtype=np.uint64) | np.uint64(1)
        self.hashes = {n: np.sort(self._hash(np.array(list(w), dtype=np.int64))) for n, w in self.by_length.items()}

    def _hash(self, rows: np.ndarray) -> np.ndarray:
        return (self.code[rows] * self.step[: rows.shape[1]]).sum(axis=1, dtype=np.uint64)

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Word ranges of all occurrences, and the items they belong to."""
        found, items = [], set()
        ids = np.fromiter(map(self.vocab.get, words, repeat(0)), np.int64, len(words))
        unknown = np.concatenate([[0], np.cumsum(ids == 0)])
        for n, known in self.by_length.items():
            if len(ids) < n:
                continue
            starts = np.flatnonzero(unknown[n:] == unknown[: len(ids) - n + 1])
            for part in np.array_split(starts, len(starts) // 100_000 + 1):
                if not len(part):
                    continue
                rows = ids[part[:, None] + np.arange(n)]
                h, table = self._hash(rows), self.hashes[n]
                at = np.minimum(np.searchsorted(table, h), len(table) - 1)
                for k in np.flatnonzero(table[at] == h).tolist():
                    if hit := known.get(tuple(rows[k].tolist())):  # the hash only proposes
                        found.append((int(part[k]), int(part[k]) + n))
                        items |= hit
        return found, items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(ranges):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _scanner(shared):
    def scan(texts: pa.Array, before: pa.Array) -> pa.Array:
        windows, rows = shared.value, []
        for text, old in zip(binaries(texts), before.to_pylist()):
            words = words_of(text)
            ranges, items = windows.find(words)
            if old:
                ranges += [(r["s"], r["e"]) for r in old["ranges"]]
                items = items | set(old["items"])
            ranges = merged(ranges)
            rows.append(
                {
                    "n_words": len(words),
                    "n_hit": sum(e - s for s, e in ranges),
                    "ranges": [{"s": s, "e": e} for s, e in ranges],
                    "items": sorted(items),
                }
            )
        return pa.array(rows, _ARROW)

    return F.arrow_udf(scan, FOUND).asNondeterministic()


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    shard_bytes: int = SHARD_BYTES,
    into: str = "contamination",
) -> DataFrame:
    """``docs`` with one more column ``into``: n_words, n_hit, hit word ranges (end exclusive) and item ids."""
    spark = docs.sparkSession
    items = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.col(item_text_col).alias("text")
    ).where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = int(size // shard_bytes) + 1
    out = docs.withColumn(into, F.lit(None).cast(FOUND))
    for k in range(shards):
        part = items if shards == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(shards)) == k)
        rows = [(r["item"], r["text"].encode()) for r in part.distinct().toLocalIterator()]
        udf = _scanner(spark.sparkContext.broadcast(Windows(rows, window)))
        out = out.withColumn(into, udf(F.col(text_col), F.col(into)))
    return out


def _cut(texts: pa.Array, ranges: pa.Array) -> pa.Array:
    out = []
    for text, hit in zip(texts.to_pylist(), ranges.to_pylist()):
        if not hit or text is None:
            out.append(text)
            continue
        raw = text.encode()
        words = [m.span() for m in re.finditer(rb"[^ ]+", raw.translate(_FOLD))]
        kept, at = [], 0
        for r in hit:
            kept.append(raw[at : words[r["s"]][0]])
            at = words[r["e"] - 1][1]
        out.append(b"".join([*kept, raw[at:]]).decode())
    return pa.array(out, pa.string())


def remove_contamination(
    docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", unit: str = "span", most: float = 0.5, **options
) -> DataFrame:
    """``docs`` without benchmark passages: ``unit="span"`` cuts the hit words out of the text and drops a document
    only if more than the share ``most`` of its words is hit; ``unit="document"`` drops every document with a hit."""
    if unit not in ("span", "document"):
        raise ValueError(f"unit must be 'span' or 'document', not {unit!r}")
    hit = "__contamination"
    found = scan(docs, benchmark, text_col=text_col, into=hit, **options)
    if unit == "document":
        return found.where(F.col(f"{hit}.n_hit") == 0).drop(hit)
    cut = F.arrow_udf(_cut, "string")
    kept = found.where(F.col(f"{hit}.n_hit") <= most * F.col(f"{hit}.n_words"))
    text = F.when(F.col(f"{hit}.n_hit") > 0, cut(F.col(text_col), F.col(f"{hit}.ranges"))).otherwise(F.col(text_col))
    return kept.withColumn(text_col, text).select(*docs.columns)
