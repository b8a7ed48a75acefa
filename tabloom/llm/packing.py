"""Packing into optimal length buckets.

Texts longer than ``max_length`` tokens are cut into pieces, so that nothing is dropped. The global histogram of piece lengths (at
most ``max_length + 1`` counts) goes through dynamic programming: the ``buckets`` boundaries with the least
padding over all pieces. Within a bucket pieces fill batches of ``token_budget`` tokens, padding included.

Batch numbers need places in a bucket, but a bucket may hold most of the rows. So rows are numbered within hashed shards of
about ``SHARD_ROWS`` and shards are set one after the other by their counts; no window spans a bucket.

Tokens are words between ASCII white space. Defined results: null, empty and blank texts are one piece of 0 tokens; repeated
rows and ids are pieces each; an empty table gives an empty one; other columns are not needed and not returned.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabloom.llm.shared import stash

MAX_LENGTH = 2048
BUCKETS = 16
TOKEN_BUDGET = 32_768
SHARD_ROWS = 20_000


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^ \t\n\x0B\f\r]+")).cast("bigint")


def pieces(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_length: int = MAX_LENGTH, tokens: Column | None = None) -> DataFrame:
    """(id, piece, start, n_tokens): every text as pieces of at most ``max_length`` tokens."""
    counted = docs.select(F.col(id_col).alias("id"), (word_count(F.col(text_col)) if tokens is None else tokens).alias("n"))
    last = F.greatest(F.lit(0), F.ceil(F.col("n") / max_length).cast("int") - 1)
    cut = counted.select("id", "n", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    start = F.col("piece").cast("bigint") * max_length
    return cut.select("id", "piece", start.alias("start"), F.least(F.col("n") - start, F.lit(max_length)).alias("n_tokens"))


def best_boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> tuple[list[int], int]:
    """(upper lengths of at most ``buckets`` buckets, their padding) with the least total padding. cost[j]: padding of the first
    j lengths; a bucket over lengths i..j-1 pads each piece to lengths[j - 1]. Fewer buckets win a tie."""
    order = np.argsort(lengths)
    lengths, counts = lengths[order].astype(np.int64), counts[order].astype(np.int64)
    m = len(lengths)
    if not m:
        return [], 0
    n, total = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(counts * lengths)])
    far = np.iinfo(np.int64).max // 4
    cost = np.full(m + 1, far)
    cost[0] = 0
    best, choice = (far, 0), []
    for k in range(min(buckets, m)):
        new, cut = np.full(m + 1, far), np.zeros(m + 1, np.int64)
        for j in range(1, m + 1):
            with_last = cost[:j] + lengths[j - 1] * (n[j] - n[:j]) - (total[j] - total[:j])
            cut[j] = int(with_last.argmin())
            new[j] = with_last[cut[j]]
        cost = new
        choice.append(cut)
        best = min(best, (int(cost[m]), k + 1))
    ends, j = [], m
    for k in range(best[1] - 1, -1, -1):
        ends.append(int(lengths[j - 1]))
        j = int(choice[k][j])
    return ends[::-1], best[0]


def pack(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_length: int = MAX_LENGTH,
    buckets: int = BUCKETS,
    token_budget: int = TOKEN_BUDGET,
    shard_rows: int = SHARD_ROWS,
    tokens: Column | None = None,
) -> DataFrame:
    """One row per piece: ``id_col``, piece, start_token, n_tokens, bucket (padded length), batch (within the bucket), slot, padding."""
    rows = stash(pieces(docs, id_col=id_col, text_col=text_col, max_length=max_length, tokens=tokens), "pack-pieces")
    histogram = rows.groupBy("n_tokens").count().collect()  # at most max_length + 1 rows
    lengths, counts = (np.array([r[k] for r in histogram], dtype=np.int64) for k in (0, 1))
    ends, _ = best_boundaries(lengths, counts, buckets)
    upper = F.array(*[F.lit(e).cast("bigint") for e in ends or [max_length]])
    bucket = F.element_at(F.filter(upper, lambda e: e >= F.col("n_tokens")), 1)
    shards = int(counts.sum() // shard_rows) + 1
    shard = F.pmod(F.xxhash64("id", "piece"), F.lit(shards)).cast("int")
    dealt = rows.withColumn("bucket", bucket).withColumn("shard", shard)
    sizes = dealt.groupBy("bucket", "shard").count()
    before = F.sum("count").over(W.partitionBy("bucket").orderBy("shard")) - F.col("count")
    offsets = sizes.select("bucket", "shard", before.alias("offset"))
    place = F.row_number().over(W.partitionBy("bucket", "shard").orderBy("id", "piece", "n_tokens"))
    numbered = dealt.withColumn("place", place).join(offsets, ["bucket", "shard"])
    per_batch = F.greatest(F.lit(1), F.floor(F.lit(token_budget) / F.greatest("bucket", F.lit(1))))
    at = F.col("offset") + F.col("place") - 1
    return numbered.select(
        F.col("id").alias(id_col), "piece", F.col("start").alias("start_token"), "n_tokens", "bucket",
        F.floor(at / per_batch).alias("batch"), (at % per_batch).cast("int").alias("slot"), (F.col("bucket") - F.col("n_tokens")).alias("padding"),
    )
