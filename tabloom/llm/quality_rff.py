"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration.

One pass over the texts turns each into ``len(STATISTICS)`` numbers, kept as a table. Standardised, they are mapped to
``features`` random cosines, whose products approximate a Gaussian kernel. The normal equations are summed per
partition and then by Spark (a model-sized matrix), and solved with a ridge. The raw scores of a calibration fold, counted
in bins, are made monotone by pooling adjacent violators; the score interpolates between the pools.

Folds 1 to 3 of the training rows fit the ridge, fold 4 calibrates, fold 0 is held out. At most about ``max_labelled``
labelled rows are used; every document is scored.

Defined results: a null text counts as the empty text, whose statistics are all zero; without labels of both kinds
every score is the share of good labels (0.5 without any).
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.shared import binaries, fold, stash, sum_cells, training_labels

MAX_LABELLED = 200_000
FEATURES = 256
RIDGE = 1e-3
BINS = 2000
STATISTICS = (
    "log_bytes", "log_words", "word_length", "long_words", "upper", "digits", "space", "beyond_ascii", "bang", "pipe", "symbols",
    "sentence_ends", "commas", "distinct_words", "top_word", "repeated_next", "log_lines", "distinct_lines", "line_length",
    "upper_words", "closed_lines", "bracketed", "compression",
)
_UPPER, _DIGIT = list(range(65, 91)), list(range(48, 58))


def statistics(text: bytes) -> list[float]:
    if not text:
        return [0.0] * len(STATISTICS)
    n = len(text)
    byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    share = lambda chars: float(byte[list(chars)].sum()) / n
    words = text.split()
    count = Counter(words)
    w = max(1, len(words))
    lines = [x for x in text.split(b"\n") if x.strip()]
    m = max(1, len(lines))
    head = text[:65536] if n > 65536 else text
    squeezed = [len(zlib.compress(text[k : k + 65536], 1)) for k in range(0, n, 65536)] if n > 65536 else [len(zlib.compress(head, 1))]
    return [
        math.log1p(n), math.log1p(len(words)), sum(map(len, words)) / w / 10, sum(1 for x in words if len(x) > 12) / w,
        share(_UPPER), share(_DIGIT), share(b" \n\t\r"), float(byte[128:].sum()) / n, share(b"!"), share(b"|"), share(b"#$%&*@^~_=<>\\"),
        share(b".?"), share(b",;:"), len(count) / w, max(count.values(), default=0) / w,
        sum(map(bytes.__eq__, words, words[1:])) / w, math.log1p(len(lines)), len(set(lines)) / m, math.log1p(n / m),
        sum(map(bytes.isupper, words)) / w, sum(1 for x in lines if x.rstrip()[-1:] in b".!?\"'") / m, share(b"()[]{}"),
        sum(squeezed) / n,
    ]


def describe(docs: DataFrame, text_col: str = "text", into: str = "statistics") -> DataFrame:
    """``docs`` with an array column of the statistics of its whole texts."""

    def of(texts: pa.Array) -> pa.Array:
        return pa.array([statistics(t) for t in binaries(texts)], pa.list_(pa.float64()))

    return docs.withColumn(into, F.arrow_udf(of, "array<double>").asNondeterministic()(F.col(text_col)))


def _rows(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def cosines(x: np.ndarray, model: dict) -> np.ndarray:
    """Random Fourier features of standardised statistics, with a constant."""
    z = np.clip((x - model["mean"]) / model["scale"], -8, 8)
    return np.concatenate([np.ones((len(z), 1)), np.cos(z @ model["omega"] + model["phase"]) * math.sqrt(2 / model["omega"].shape[1])], axis=1)


def pool_adjacent(score: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic means: (mean score, mean label) of each pool, for ascending scores."""
    pools: list[list[float]] = []
    for s, y, w in zip(score, label, weight):
        pools.append([s * w, y * w, w])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last)]
    table = np.array(pools)
    return table[:, 0] / table[:, 2], table[:, 1] / table[:, 2]


def _linear(shared):
    def raw(batch: pa.Array) -> pa.Array:
        m = shared.value
        return pa.array(cosines(_rows(batch, len(m["mean"])), m) @ m["weights"])

    return F.arrow_udf(raw, "double").asNondeterministic()


def fit(described: DataFrame, labels: DataFrame, *, id_col: str, label_col: str, features: int, ridge: float, max_labelled: int, seed: int = 11) -> dict:
    """The model from a table (``id_col``, statistics)."""
    spark = described.sparkSession
    known = training_labels(labels, id_col, label_col, max_labelled)
    share = known.agg(F.avg("_label"), F.min("_label"), F.max("_label")).first()
    model: dict = {"flat": 0.5 if share[0] is None else float(share[0])}
    if share[1] == share[2]:
        return model
    rows = described.join(known, F.col(id_col) == F.col("_label_id")).select(
        F.col("_label").cast("double").alias("y"), "statistics", fold(F.col(id_col)).alias("fold")
    )
    rows = stash(rows.repartition(32), "quality-train")  # bounded: numbers of the labelled rows only
    fitted, width = rows.where("fold <> 4"), len(STATISTICS)
    moment = fitted.select(*[F.struct(F.avg(F.col("statistics")[k]), F.stddev_pop(F.col("statistics")[k])) for k in range(width)]).first()
    if moment[0][0] is None:
        return model
    draw = np.random.default_rng(seed)
    model |= {
        "mean": np.array([m[0] for m in moment]),
        "scale": np.array([max(m[1], 1e-6) for m in moment]),
        "omega": draw.normal(size=(width, features)) / math.sqrt(width),
        "phase": draw.uniform(0, 2 * math.pi, features),
    }
    shared, size = spark.sparkContext.broadcast(dict(model)), features + 2

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                z = np.concatenate([cosines(_rows(batch.column(0), width), shared.value), batch.column(1).to_numpy()[:, None]], axis=1)
                total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(total.tolist())], ["r", "v"])

    total = sum_cells(fitted.select("statistics", "y").mapInArrow(normal, "r int, v array<double>"), size)
    a = total[:-1, :-1] + ridge * max(total[0, 0], 1) * np.diag([0.0] + [1.0] * features) + 1e-9 * np.eye(size - 1)
    model["weights"] = np.linalg.solve(a, total[:-1, -1])
    raw = _linear(spark.sparkContext.broadcast(dict(model)))
    held = rows.where("fold = 4").select("y", raw("statistics").alias("s"))
    bins = held.groupBy(F.round(F.greatest(F.least("s", F.lit(2.0)), F.lit(-1.0)) * BINS).alias("b")).agg(F.avg("s").alias("s"), F.avg("y").alias("y"), F.count("*").alias("n"))
    at = sorted((r["b"], r["s"], r["y"], r["n"]) for r in bins.collect())
    if at:
        x = np.array(at)
        model["knots"] = pool_adjacent(x[:, 1], x[:, 2], x[:, 3])
    return model


def _calibrated(shared):
    def score(batch: pa.Array) -> pa.Array:
        m = shared.value
        if "weights" not in m:
            return pa.array(np.full(len(batch), m["flat"]))
        raw = cosines(_rows(batch, len(m["mean"])), m) @ m["weights"]
        return pa.array(np.interp(raw, *m["knots"]) if "knots" in m else np.clip(raw, 0, 1))

    return F.arrow_udf(score, "double").asNondeterministic()


def score(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    features: int = FEATURES,
    ridge: float = RIDGE,
    max_labelled: int = MAX_LABELLED,
) -> DataFrame:
    """One row per document: ``id_col``, statistics, quality (0 to 1)."""
    table = stash(describe(docs.select(id_col, F.col(text_col).alias("text"))).select(id_col, "statistics"), "quality-statistics")
    model = fit(table, labels, id_col=id_col, label_col=label_col, features=features, ridge=ridge, max_labelled=max_labelled)
    return table.withColumn("quality", _calibrated(docs.sparkSession.sparkContext.broadcast(model))(F.col("statistics")))
