"""Toxicity by maximum-scoring segments.

Every token has a log-odds score between toxic and clean training documents under a Dirichlet prior; tokens
whose score is not significant, and all others, cost ``DRIFT``. The linear-time scan of Ruzzo and Tompa finds all
maximal scoring segments of a document. The best segment of n random tokens follows an extreme-value law
with parameters lambda and K (Karlin and Altschul): lambda solves sum p(s) exp(lambda s) = 1 over the clean
token rates, K comes from the clean documents of a calibration fold. A document's evidence is the sum of
lambda * S - ln(K n) over its significant segments (of the best one if none is), and a logistic curve fitted on
the calibration fold turns it into a probability.

Log-odds are learned from the training rows of folds 1 to 3, the calibration from fold 4, so that no document calibrates
its own tokens; fold 0 is held out. Each labelled row teaches, copies too. At most about ``max_labelled`` labelled rows are used.
The model holds every significant token of these rows: significance takes several rows, so their number bounds it at any corpus size.

Defined results: null and empty texts have no segment and get the score of a text without evidence; without labels of
both kinds every score is the share of toxic labels (0.5 without any), and ``reject_toxic`` keeps all documents; other columns pass through.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.shared import fold, stash, training_labels

MAX_LABELLED = 200_000
Z = 3.0
DRIFT = 0.5
PRIOR = 0.5
#: evidence is counted in bins of 1 / STEP between these ends
STEP, LOW, HIGH = 4, -25.0, 75.0
_WORD = re.compile(r"[^\W\d_]+")

Segment = tuple[int, int, float]


def maximal_segments(scored: list[tuple[int, float]], drift: float) -> list[Segment]:
    """All maximal scoring segments (first token, last token, score) of a sequence in which the tokens ``scored`` (place, score)
    have a score and every other token costs ``drift``. Linear in the number of scored tokens."""
    total, at = 0.0, -1
    kept: list[tuple[int, int, float, float]] = []  # first, last, total before, total after
    jump: list[int] = []  # nearest earlier candidate with a smaller total before it, or -1
    for place, score in scored:
        total -= drift * (place - at - 1)
        at = place
        before, total = total, total + score
        if score <= 0:
            continue
        first, left = place, before
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= left:
                j = jump[j]
            if j < 0 or kept[j][3] >= total:
                break
            first, left = kept[j][0], kept[j][2]
            del kept[j:], jump[j:]
        kept.append((first, place, left, total))
        jump.append(j)
    return [(first, last, after - before) for first, last, before, after in kept]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and clean documents each token occurs; texts come as (text, label)."""
    kinds: tuple[Counter, Counter] = (Counter(), Counter())

    def flush() -> pa.RecordBatch:
        words = list(kinds[0].keys() | kinds[1].keys())
        out = pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), *[pa.array([kinds[k][w] for w in words], pa.int64()) for k in (1, 0)]], ["token", "toxic", "clean"]
        )
        kinds[0].clear(), kinds[1].clear()
        return out

    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            kinds[label].update(set(_WORD.findall((text or "").lower())))
            if len(kinds[0]) + len(kinds[1]) > 500_000:
                yield flush()
    yield flush()


def log_odds(counts: DataFrame) -> tuple[dict[str, float], float]:
    """(score of each significant token, share of clean tokens without a score)."""
    n_t, n_c = (float(v or 0) for v in counts.agg(F.sum("toxic"), F.sum("clean")).first())
    t, c = F.col("toxic") + PRIOR, F.col("clean") + PRIOR
    delta = F.log(t / (n_t + 1 - t + PRIOR)) - F.log(c / (n_c + 1 - c + PRIOR))
    scored = counts.withColumn("delta", delta).withColumn("z", F.abs("delta") / F.sqrt(1 / t + 1 / c)).where(F.col("z") >= Z)
    rows = scored.select("token", "delta", "clean").orderBy("token").collect()
    return {r["token"]: (r["delta"], (r["clean"] + PRIOR) / (n_c + 1)) for r in rows}


def karlin_lambda(scores: np.ndarray, rates: np.ndarray, drift: float) -> float:
    """The positive root of sum p(s) exp(lambda s) = 1; 1 where the scores have none."""
    rest = max(0.0, 1 - rates.sum())
    value = lambda x: float(rates @ np.exp(np.minimum(700, x * scores)) + rest * math.exp(-x * drift)) - 1
    if not len(scores) or scores.max() <= 0 or rates @ scores - rest * drift >= 0:
        return 1.0
    low, high = 0.0, 1.0
    while value(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 0 else (low, mid)
    return high


def read_tokens(text: str, scores: dict[str, float]) -> tuple[int, list[tuple[int, float]]]:
    tokens = _WORD.findall(text.lower())
    return len(tokens), [(k, scores[t]) for k, t in enumerate(tokens) if t in scores]


def token_places(text: str) -> list[tuple[int, int]]:
    """Start and end in ``text`` of each token of its lower-cased form, which can be longer."""
    low = text.lower()
    places = [w.span() for w in _WORD.finditer(low)]
    if len(low) == len(text):
        return places
    origin = [k for k, c in enumerate(text) for _ in c.lower()]
    return [(origin[a], origin[b - 1] + 1) for a, b in places]


def evidence(n: int, segments: list[Segment], lam: float, ln_k: float) -> float:
    """Extreme-value evidence of a document of ``n`` tokens."""
    gain = [lam * s - ln_k - math.log(max(n, 1)) for _, _, s in segments]
    good = [g for g in gain if g > 0]
    return sum(good) if good else max(gain, default=LOW)


def fit_logistic(x: np.ndarray, n: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """(slope, intercept) of a ridge-damped logistic curve over counted bins; the slope is never negative."""
    a, b = 0.1, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -40, 40)))
        w = n * p * (1 - p)
        g = np.array([((toxic - n * p) * x).sum() - 0.01 * a, (toxic - n * p).sum() - 0.01 * b])
        h = np.array([[(w * x * x).sum() + 0.01, (w * x).sum()], [(w * x).sum(), w.sum() + 0.01]])
        step = np.linalg.solve(h, g)
        a, b = a + float(np.clip(step[0], -1, 1)), b + float(np.clip(step[1], -5, 5))
        if np.abs(step).max() < 1e-9:
            break
    return max(a, 0.0), b


def _reader(shared, detail: bool):
    """text -> n_tokens and the totals needed for the evidence, or with ``detail`` the verdict and its passages."""
    place = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("e_value", pa.float64())])
    kind = pa.struct([("score", pa.float64()), ("evidence", pa.float64()), ("passages", pa.list_(place))])

    def read(texts: pa.Array) -> pa.Array:
        m, rows = shared.value, []
        for text in texts.to_pylist():
            n, hits = read_tokens(text or "", m["scores"])
            segments = maximal_segments(hits, DRIFT)
            x = min(max(evidence(n, segments, m["lambda"], m["ln_k"]), LOW), HIGH)
            p = 1 / (1 + math.exp(-min(max(m["slope"] * x + m["intercept"], -40), 40))) if "slope" in m else m["flat"]
            row = {"score": p, "evidence": x, "passages": []}
            if detail and segments:
                spans = token_places(text)
                for first, last, s in segments:
                    e = math.exp(min(m["ln_k"] + math.log(n) - m["lambda"] * s, 50))
                    if e < 1:
                        row["passages"].append({"start": spans[first][0], "end": spans[last][1], "score": s, "e_value": e})
            rows.append(row)
        return pa.array(rows, kind)

    sql = "struct<score:double,evidence:double,passages:array<struct<start:int,end:int,score:double,e_value:double>>>"
    return F.arrow_udf(read, sql).asNondeterministic()


def _best(shared):
    kind = pa.struct([("n", pa.int64()), ("best", pa.float64())])

    def best(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts.to_pylist():
            n, hits = read_tokens(text or "", shared.value["scores"])
            rows.append({"n": n, "best": max((s for _, _, s in maximal_segments(hits, DRIFT)), default=0.0)})
        return pa.array(rows, kind)

    return F.arrow_udf(best, "struct<n:bigint,best:double>").asNondeterministic()


def train(docs: DataFrame, labels: DataFrame, *, id_col: str, text_col: str, label_col: str, max_labelled: int) -> dict:
    """The model: token scores, lambda, ln K, slope and intercept; ``flat`` alone if there is nothing to learn from."""
    spark = docs.sparkSession
    known = training_labels(labels, id_col, label_col, max_labelled)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(known, F.col("_id") == F.col("_label_id"))
    share = known.agg(F.avg("_label"), F.min("_label"), F.max("_label")).first()
    model = {"scores": {}, "lambda": 1.0, "ln_k": 0.0, "flat": 0.5 if share[0] is None else float(share[0])}
    if share[1] == share[2]:
        return model
    counts = rows.where(fold(F.col("_id")) != 4).select("text", "_label").mapInArrow(_count, "token string, toxic bigint, clean bigint")
    counts = stash(counts.groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "tox-counts")
    table = log_odds(counts)
    values = np.array(list(table.values()), dtype=float).reshape(-1, 2)
    model["scores"] = {w: s for w, (s, _) in table.items()}
    model["lambda"] = karlin_lambda(values[:, 0], values[:, 1], DRIFT)
    first = _best(spark.sparkContext.broadcast(model))
    held = stash(rows.where(fold(F.col("_id")) == 4).select("_label", first("text").alias("b")).select("_label", "b.*"), "tox-held")
    clean = held.where("_label = 0 and n > 0")
    mean = clean.agg(F.avg(F.lit(model["lambda"]) * F.col("best") - F.log("n"))).first()[0]
    if mean is not None:  # the mean of a Gumbel law lies Euler's constant above its location
        model["ln_k"] = float(mean) - 0.5772156649
    x = F.lit(model["lambda"]) * F.col("best") - F.log(F.greatest("n", F.lit(1))) - model["ln_k"]
    bins = F.round(F.greatest(F.least(F.when(F.col("best") > 0, x).otherwise(LOW), F.lit(HIGH)), F.lit(LOW)) * STEP)
    rows = held.groupBy(bins.alias("bin")).agg(F.count("*").alias("n"), F.sum("_label").alias("toxic")).collect()
    at = np.array([(r["bin"] / STEP, r["n"], r["toxic"]) for r in rows], dtype=float).reshape(-1, 3)
    if len(at):
        model["slope"], model["intercept"] = fit_logistic(at[:, 0], at[:, 1], at[:, 2])
    return model


def score(
    docs: DataFrame,
    labels: DataFrame,
    *,
    training: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_labelled: int = MAX_LABELLED,
    into: str = "toxicity",
) -> DataFrame:
    """``docs`` with a struct column ``into``: score, evidence and significant passages (character places)."""
    model = train(
        docs if training is None else training,
        labels, id_col=id_col, text_col=text_col, label_col=label_col, max_labelled=max_labelled,
    )
    return docs.withColumn(into, _reader(docs.sparkSession.sparkContext.broadcast(model), True)(F.col(text_col)))


def reject_toxic(
    docs: DataFrame,
    labels: DataFrame,
    *,
    threshold: float = 0.5,
    training: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_labelled: int = MAX_LABELLED,
) -> DataFrame:
    """``docs`` without those whose score reaches ``threshold``. A model that has learned nothing (labels of one kind, none, or
    no slope) tells no document from another: all stay."""
    model = train(
        docs if training is None else training,
        labels, id_col=id_col, text_col=text_col, label_col=label_col, max_labelled=max_labelled,
    )
    if not model.get("slope"):
        return docs
    scored = docs.withColumn("__toxicity", _reader(docs.sparkSession.sparkContext.broadcast(model), True)(F.col(text_col)))
    return scored.where(F.col("__toxicity.score") < threshold).select(*docs.columns)
