"""Language-model scoring by context-tree weighting over bytes.

Each byte is eight binary decisions; every decision has a context tree over the bytes before it, up to ``depth``.
A node estimates its bits by Krichevsky-Trofimov, and its weighted probability is half its own estimate
plus half the product of its children's. The trained tree predicts a bit by mixing the estimates along its
context path with the weights the data gave to stopping there. Contexts start with NUL bytes and a text ends with one
coded NUL, so the probabilities of texts add up to one; log2 / bytes is the code length per byte.

The same scan counts the words of the training texts for a smoothed unigram base score.

* Counting: each task keeps counted byte grams and words of its texts and sends them when they are many; Spark
  adds them up. What is gathered grows with the corpus, and all of it is used.
* The tree is one table of nodes per depth, written from the deepest up: a node's counts and the product of its children are sums
  over the table below. No table passes through the driver.
* Scoring: the log-probabilities of the ``HEAVY_GRAMS`` most frequent grams and the values of the ``HEAVY`` most frequent words are
  broadcast, at most 16 and about 15 MB. All other grams of a document are looked up in the node tables and come back by
  a join on the gram, all other words by a join with the counted words; heavy keys of both joins are broadcast. The limits move
  work between broadcast and join only: scores are the same with any of them.

Defined results: a null text is the empty text; without training text nothing is known and the tree predicts every bit
with 1/2; repeated rows are scored and counted each; other columns are not needed and not returned.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.functions.attach import attach
from tabloom.llm.shared import batches_of, binaries, stash

DEPTH, MOST_DEPTH = 3, 6  # a gram of seven bytes still fits a signed 64-bit integer
HEAVY_GRAMS = 1 << 20
HEAVY, HEAVY_BYTES = 100_000, 64
PIECE = 1 << 20
FLUSH_WORDS, FLUSH_GRAMS = 200_000, 1_000_000


def coded(texts: list[bytes], depth: int = DEPTH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bounded pieces as (index of the text of each run, start of each run, grams): a gram holds a coded byte in its lowest
    byte and its context above, the runs follow each other."""
    runs, owner = [], []
    for k, text in enumerate(texts):
        whole = b"\0" * depth + text + b"\0"
        for s in range(0, len(whole) - depth, PIECE):
            runs.append(whole[s : s + PIECE + depth]), owner.append(k)
    kind = np.uint32 if depth <= 3 else np.int64
    for a, b in batches_of(map(len, runs), PIECE):
        x = np.frombuffer(b"".join(runs[a:b]), np.uint8).astype(kind)
        sizes = np.array([len(r) for r in runs[a:b]])
        grams = x[depth:].copy()
        for back in range(1, depth + 1):
            grams |= x[depth - back : len(x) - back] << kind(8 * back)
        keep = np.ones(len(grams), bool)  # grams that reach across two runs are left out
        ends = np.cumsum(sizes)[:-1]
        keep[(ends[:, None] - 1 - np.arange(depth)).ravel()] = False
        n = sizes - depth
        yield np.array(owner[a:b]), np.cumsum(n) - n, grams[keep]


def distinct_grams(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct grams ascending, index of each gram among them), by a table over the pairs of halves that occur."""
    if grams.dtype != np.uint32:
        return np.unique(grams, return_inverse=True)
    high, low = grams >> np.uint32(16), grams & np.uint32(0xFFFF)
    seen = [np.zeros(1 << 16, bool), np.zeros(1 << 16, bool)]
    seen[0][high], seen[1][low] = True, True
    values = [np.flatnonzero(s) for s in seen]
    if len(values[0]) * len(values[1]) > 1 << 23 or len(grams) < 50_000:
        return np.unique(grams, return_inverse=True)
    rank = [np.cumsum(s, dtype=np.int32) - 1 for s in seen]
    at = rank[0][high] * np.int32(len(values[1])) + rank[1][low]
    present = np.zeros(len(values[0]) * len(values[1]), bool)
    present[at] = True
    found = np.flatnonzero(present)
    place = np.zeros(len(present), np.int32)
    place[found] = np.arange(len(found), dtype=np.int32)
    keys = (values[0][found // len(values[1])] << 16) | values[1][found % len(values[1])]
    return keys.astype(np.uint32), place[at]


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def _gather(batches: Iterator[pa.RecordBatch], depth: int) -> Iterator[pa.RecordBatch]:
    """Counted words, ends of text (token null, gram -1) and grams of the texts."""
    words: Counter = Counter()
    grams: dict[int, int] = {}
    ends = 0

    def flush() -> pa.RecordBatch:
        w = list(words)
        token = pa.array([*w, *[None] * (len(grams) + 1)], pa.binary()).cast(pa.string())
        gram = pa.array([*[None] * len(w), *grams, -1], pa.int64())
        n = pa.array([*words.values(), *grams.values(), ends], pa.int64())
        words.clear(), grams.clear()
        return pa.RecordBatch.from_arrays([token, gram, n], ["token", "gram", "n"])

    for batch in batches:
        texts = binaries(batch.column(0))
        ends += len(texts)
        for text in texts:
            words.update(words_of(text))
            if len(words) > FLUSH_WORDS:
                yield flush()
                ends = 0
        for _, _, g in coded(texts, depth):
            keys, where = distinct_grams(g)
            for k, n in zip(keys.tolist(), np.bincount(where, minlength=len(keys)).tolist()):
                grams[k] = grams.get(k, 0) + n
            if len(grams) > FLUSH_GRAMS:
                yield flush()
                ends = 0
    yield flush()


def gather(texts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(token, gram, n, kind) of a one-column table of training texts, as a table of the shared folder laid out by
    kind: word, gram or end."""
    count = lambda batches: _gather(batches, depth)
    counted = texts.mapInArrow(count, "token string, gram bigint, n bigint").groupBy("token", "gram").agg(F.sum("n").alias("n"))
    kind = F.when(F.col("token").isNotNull(), "word").when(F.col("gram") >= 0, "gram").otherwise("end")
    return stash(counted.where("n > 0").withColumn("kind", kind), "ctw-counts", by="kind")


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma for positive x: Stirling's series after moving up by eight."""
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    y = x + 8
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7) - shift


def kt_log(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a sequence with these counts."""
    half = np.float64(0.5)
    return _log_gamma(zeros + half) + _log_gamma(ones + half) - _log_gamma(zeros + ones + 1) - math.log(math.pi)


def _decisions(gram: Column, depth: int) -> list[tuple[Column, Column]]:
    """For each of the eight decisions of a byte: (node key at ``depth``, bit). A key is the context above one byte, which holds
    the bits already decided behind a leading one."""
    byte = gram.bitwiseAND(255)
    context = F.shiftleft(F.shiftright(gram, 8).bitwiseAND((1 << 8 * depth) - 1), 8)
    return [(context.bitwiseOR(F.shiftright(byte, 8 - k)).bitwiseOR(1 << k), F.shiftright(byte, 7 - k).bitwiseAND(1)) for k in range(8)]


def _weigh(zeros: pa.Array, ones: pa.Array, inner: pa.Array) -> pa.Array:
    """(ln of the weighted probability, weight of stopping) of nodes; ``inner``: sum over their children, null at the deepest."""
    own = kt_log(zeros.to_numpy(zero_copy_only=False).astype(float), ones.to_numpy(zero_copy_only=False).astype(float))
    below = pc.fill_null(inner, math.nan).to_numpy(zero_copy_only=False)
    leaf = np.isnan(below)
    both = np.logaddexp(own, np.where(leaf, own, below))
    total, stop = np.where(leaf, own, both - math.log(2)), np.where(leaf, 1.0, np.exp(own - both))
    return pa.StructArray.from_arrays([pa.array(total), pa.array(stop)], ["total", "stop"])


def levels(counted: DataFrame, depth: int = DEPTH) -> list[DataFrame]:
    """The trained tree from (gram, n) of all training text: (node, zeros, ones, total, stop) per depth, the root's first."""
    split = F.explode(F.array(*[F.struct(k.alias("node"), b.alias("bit")) for k, b in _decisions(F.col("gram"), depth)])).alias("d")
    seen = counted.select(split, "n").select("d.node", F.when(F.col("d.bit") == 0, F.col("n")).otherwise(0).alias("z"), F.when(F.col("d.bit") == 1, F.col("n")).otherwise(0).alias("o"))
    nodes = seen.groupBy("node").agg(F.sum("z").alias("zeros"), F.sum("o").alias("ones")).withColumn("inner", F.lit(None).cast("double"))
    out: list[DataFrame] = []
    weigh = F.arrow_udf(_weigh, "struct<total:double,stop:double>")
    for d in range(depth, -1, -1):
        weighed = nodes.select("node", "zeros", "ones", weigh("zeros", "ones", "inner").alias("w"))
        out.insert(0, stash(weighed.select("node", "zeros", "ones", "w.total", "w.stop"), f"ctw-level{d}"))
        above = F.col("node").bitwiseAND((1 << 8 * d) - 1)
        sums = [F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("total").alias("inner")]
        nodes = out[0].groupBy(above.alias("node")).agg(*sums)
    return out


def log10_of(grams: DataFrame, tree: list[DataFrame]) -> DataFrame:
    """``grams`` (distinct in ``gram``) with ``lp``: log10 of the probability of each gram's byte after its context, by one join per depth.
    The nodes of the two upper depths, at most 65,280, are broadcast."""
    depth = len(tree) - 1
    steps = [_decisions(F.col("gram"), d) for d in range(depth + 1)]
    path = [F.struct(*[steps[d][k][0].alias(f"k{d}") for d in range(depth + 1)], steps[0][k][1].alias("bit")) for k in range(8)]
    rows = grams.select("*", F.explode(F.array(*path)).alias("_d")).select(*grams.columns, "_d.*").withColumn("p", F.lit(0.5))
    for d in range(depth, -1, -1):
        node = tree[d].select(F.col("node").alias(f"k{d}"), "zeros", "ones", "stop")
        rows = rows.join(F.broadcast(node) if d < 2 else node, f"k{d}", "left")
        own = (F.when(F.col("bit") == 1, F.col("ones")).otherwise(F.col("zeros")) + 0.5) / (F.col("zeros") + F.col("ones") + 1)
        mixed = F.col("stop") * own + (1 - F.col("stop")) * F.col("p")
        rows = rows.withColumn("p", F.coalesce(mixed, F.col("p"))).drop(f"k{d}", "zeros", "ones", "stop")
    return rows.groupBy(*grams.columns).agg(F.sum(F.log10("p")).alias("lp"))


def most_frequent(counted: DataFrame, key: str, most: int) -> DataFrame:
    """``counted`` cut to its most frequent keys: whole classes of equal floor(8 log2 n), as many as fit ``most``. A sort would send
    every task's candidates."""
    classed = counted.withColumn("_class", F.floor(8 * F.log2("n")).cast("int"))
    fit, least = 0, None
    for r in sorted(classed.groupBy("_class").count().collect(), key=lambda r: -r["_class"]):
        fit += r["count"]
        if fit > most:
            break
        least = r["_class"]
    return (classed.where(F.col("_class") >= least) if least is not None else classed.limit(0)).select(key, "n")


def _scorer(heavy_grams, heavy, depth: int):
    rare = pa.list_(pa.struct([("token", pa.string()), ("tf", pa.int32())]))
    rare_grams = pa.list_(pa.struct([("gram", pa.int64()), ("tf", pa.int32())]))
    kind = pa.struct([
        ("n_tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("rare", rare), ("score", pa.float64()), ("rare_grams", rare_grams),
    ])

    def by_grams(texts: list[bytes]) -> tuple[pa.Array, pa.Array]:
        """(sum over the heavy grams of each text, its other grams with their counts)."""
        keys, values = heavy_grams.value
        total, others = np.zeros(len(texts)), []
        for owner, start, grams in coded(texts, depth):
            found, where = distinct_grams(grams)
            at = np.minimum(np.searchsorted(keys, found), max(len(keys) - 1, 0))
            hit = keys[at] == found if len(keys) else np.zeros(len(found), bool)
            lp = np.zeros(len(found))
            lp[hit] = values[at[hit]]
            np.add.at(total, owner, np.add.reduceat(lp[where], start))
            if not hit.all():
                miss = np.flatnonzero(~hit[where])
                text = owner[np.searchsorted(start, miss, "right") - 1]
                pair, tf = np.unique(np.stack([text, where[miss]]), axis=1, return_counts=True)
                others.append((pair[0], found[pair[1]].astype(np.int64), tf))
        text, gram, tf = (np.concatenate(c) for c in zip(*others)) if others else (np.zeros(0, np.int64),) * 3
        order = np.argsort(text, kind="stable")
        ends = np.concatenate([[0], np.cumsum(np.bincount(text.astype(np.int64), minlength=len(texts)))])
        pairs = pa.StructArray.from_arrays([pa.array(gram[order]), pa.array(tf[order], pa.int32())], ["gram", "tf"])
        return pa.array(total), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)

    def part(texts: list[bytes]) -> pa.Array:
        table = heavy.value
        n, known, base, names, tf, ends = [], [], [], [], [], [0]
        for text in texts:
            words = words_of(text)
            total, hit = 0.0, 0
            for w, c in Counter(words).items():
                value = table.get(w)
                if value is None:
                    names.append(w), tf.append(c)
                else:
                    total += c * value
                    hit += c
            n.append(len(words) + 1), known.append(hit), base.append(total), ends.append(len(names))
        pairs = pa.StructArray.from_arrays([pa.array(names, pa.binary()).cast(pa.string()), pa.array(tf, pa.int32())], ["token", "tf"])
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)
        parts = [pa.array(n, pa.int64()), pa.array(known, pa.int64()), pa.array(base, pa.float64()), lists, *by_grams(texts)]
        return pa.StructArray.from_arrays([p.cast(f.type) for p, f in zip(parts, kind)], [f.name for f in kind])

    def score(column: pa.Array) -> pa.Array:
        # a few megabytes of text at a time: the words of a whole batch would be millions of objects
        sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
        done = [part(binaries(column.slice(s, e - s))) for s, e in batches_of(sizes, PIECE)]
        return pa.concat_arrays(done) if done else pa.array([], kind)

    sql = (
        "struct<n_tokens:bigint,known:bigint,base:double,rare:array<struct<token:string,tf:int>>,score:double,"
        "rare_grams:array<struct<gram:bigint,tf:int>>>"
    )
    return F.arrow_udf(score, sql).asNondeterministic()


def score(
    docs: DataFrame, training: Column, *, id_col: str = "doc_id", text_col: str = "text", keep: dict[str, Column] | None = None,
    depth: int = DEPTH, heavy_grams: int = HEAVY_GRAMS, heavy: int = HEAVY, broadcast_rows: int | None = None,
) -> DataFrame:
    """One row per document: ``id_col``, the columns ``keep``, n_tokens, n_known, train_tokens, base_score and score (log10), code length
    in bits per byte. Rows for which ``training`` holds teach. ``heavy_grams``, ``heavy`` and ``broadcast_rows`` bound broadcasts and change
    no result."""
    if not 0 <= depth <= MOST_DEPTH:
        raise ValueError(f"depth must lie between 0 and {MOST_DEPTH}")
    spark = docs.sparkSession
    counts = gather(docs.where(training).select(F.col(text_col).alias("text")), depth)
    grams = counts.where("kind = 'gram'").select("gram", "n")
    tree = levels(grams, depth)
    top_grams = log10_of(most_frequent(grams, "gram", heavy_grams).select("gram"), tree).toArrow().sort_by("gram")
    gram_table = spark.sparkContext.broadcast((top_grams["gram"].to_numpy(), top_grams["lp"].to_numpy()))
    words = counts.where("kind = 'word'").select("token", "n")
    n_ends = counts.where("kind = 'end'").agg(F.sum("n")).first()[0] or 0
    row = words.agg(F.sum("n"), F.count("*")).first()
    n_train, v = (row[0] or 0) + n_ends, row[1] + (n_ends > 0)
    below = n_train + 0.5 * (v + 1)
    value = F.log10((F.col("n") + 0.5) / below)
    top = most_frequent(words.where(F.octet_length("token") <= HEAVY_BYTES), "token", heavy).select("token", value.alias("v"))
    table = spark.sparkContext.broadcast({r["token"].encode(): r["v"] for r in top.collect()})
    kept = keep or {}
    scored = docs.select(
        F.col(id_col), *[c.alias(k) for k, c in kept.items()], F.monotonically_increasing_id().alias("_row"),
        F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).alias("_bytes"), _scorer(gram_table, table, depth)(F.col(text_col)).alias("_s"),
    )
    scored = stash(scored, "ctw-scored")
    rare = scored.select("_row", F.explode("_s.rare").alias("r")).select("_row", "r.token", "r.tf")
    wanted = rare.groupBy("token").agg(F.count("*").alias("rows")).join(words, "token", "left")
    met = attach(rare, stash(wanted, "ctw-words"), ["token"], "rows", broadcast_rows).withColumn("n", F.coalesce("n", F.lit(0)))
    rare_grams = scored.select("_row", F.explode("_s.rare_grams").alias("r")).select("_row", "r.gram", "r.tf")
    deeper = stash(log10_of(rare_grams.groupBy("gram").agg(F.count("*").alias("rows")), tree), "ctw-grams")
    priced = attach(rare_grams, deeper, ["gram"], "rows", broadcast_rows)
    none = F.lit(0.0)
    parts = met.select("_row", (F.col("tf") * value).alias("b"), F.when(F.col("n") > 0, F.col("tf")).otherwise(0).alias("k"), none.alias("s"))
    parts = parts.unionAll(priced.select("_row", none.alias("b"), F.lit(0).alias("k"), (F.col("tf") * F.col("lp")).alias("s")))
    extra = parts.groupBy("_row").agg(F.sum("b").alias("_b"), F.sum("k").alias("_k"), F.sum("s").alias("_more"))
    end = math.log10((n_ends + 0.5) / below)
    own = [F.col(f"_s.{c}").alias(f"_{c}") for c in ("n_tokens", "known", "base", "score")]
    slim = scored.select(id_col, *kept, "_row", "_bytes", *own).join(extra, "_row", "left")
    total = F.col("_score") + F.coalesce("_more", none)
    return slim.select(
        id_col, *kept, F.col("_n_tokens").alias("n_tokens"),
        (F.col("_known") + F.coalesce("_k", F.lit(0)) + (1 if n_ends else 0)).cast("bigint").alias("n_known"),
        F.lit(n_train).cast("bigint").alias("train_tokens"),
        (F.col("_base") + F.coalesce("_b", none) + end).alias("base_score"),
        total.alias("score"),
        (-total / math.log10(2) / F.greatest("_bytes", F.lit(1))).alias("bits_per_byte"),
    )
