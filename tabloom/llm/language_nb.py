"""Language identification: multinomial naive Bayes over hashed character n-grams.

Letters are lower-cased and every run of other characters is one space. All 1- to 3-grams of a text are hashed into
``2 ** bits`` buckets. Counts per language come from all training texts, summed per partition and then by Spark;
the model is a matrix of log-probabilities (buckets x languages, smoothed), whose size is a parameter, broadcast to the
scoring tasks, where each batch gathers and sums its rows of the matrix in numpy.

Defined results: null texts and texts without a letter are ``und`` with score 0; a label that is null teaches nothing;
without any labelled letter everything is ``und``; score is the posterior of the prediction; ties go to the
alphabetically first language; whole texts count, in bounded pieces; other columns pass through.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.shared import batches_of

BITS = 16
#: characters of one numpy piece
PIECE = 1 << 20
_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For every code point, whether it is a letter (computed once per worker)."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1))
    return _LETTERS[0]


def gram_buckets(texts: list[str], bits: int, skip: list[int] | None = None, more: list[bool] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, index of its text) of all 1- to 3-grams that hold a letter. The first ``skip`` characters of a piece are those before
    it, and no end of text follows a piece with ``more``: only grams that end between count."""
    lowered = [t.lower() for t in texts]
    sizes = np.array([len(t) + 1 for t in lowered], np.int64)
    counts = np.ones(sizes.sum() + 1, bool)
    ends = np.cumsum(sizes)
    for k, (n, m) in enumerate(zip(skip or [0] * len(texts), more or [False] * len(texts))):
        counts[ends[k] - sizes[k] + 1 : ends[k] - sizes[k] + 1 + n] = False
        counts[ends[k]] = not m  # (kept or not, an end that does not count is in no gram)
    code = np.frombuffer("".join(["\n", *(t + "\n" for t in lowered)]).encode("utf-32-le", "replace"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), sizes)
    owner = np.concatenate([[-1], owner])[: len(code)]  # the leading separator belongs to no text
    is_letter = letters()[code]
    keep = is_letter | np.concatenate([[True], is_letter[:-1]]) | ~counts  # the first of a run of other characters stays
    code, owner, is_letter, counts = np.where(is_letter, code, 32)[keep].astype(np.uint64), owner[keep], is_letter[keep], counts[keep]
    out, who = [], []
    h = np.zeros(len(code), np.uint64)
    mask = np.zeros(len(code), bool)
    for n in (1, 2, 3):
        if len(code) < n:
            break
        h = (h[: len(code) - n + 1] * np.uint64(0x100000001B3)) ^ code[n - 1 :]
        mask = mask[: len(code) - n + 1] | is_letter[n - 1 :]
        own = owner[: len(code) - n + 1]
        whole = mask & (own == owner[n - 1 :]) & (own >= 0) & counts[n - 1 :]
        mixed = (h[whole] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        out.append((mixed >> np.uint64(64 - bits)).astype(np.int64))
        who.append(own[whole])
    return (np.concatenate(out), np.concatenate(who)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _before(text: str, cut: int) -> str:
    """The last two characters before ``cut`` that grams see: letters, and the first of each run of others."""
    out, at = "", cut
    while at > 0 and len(out) < 2:
        at -= 1
        if text[at].isalpha():
            out = text[at] + out
        elif at and text[at - 1].isalpha():
            out = " " + out
    return out


def pieces(texts: list[str]) -> Iterator[tuple[list[int], list[str], list[int], list[bool]]]:
    """Bounded groups of texts with their indexes; a text beyond ``PIECE`` is cut, and each piece carries the two characters
    before it, so that no gram is lost or counted twice."""
    parts: list[tuple[int, str, int, bool]] = []
    for k, t in enumerate(texts):
        low = t.lower() if len(t) > PIECE else t
        for at in range(0, max(len(low), 1), PIECE):
            before = _before(low, at) if at else ""
            parts.append((k, before + low[at : at + PIECE], len(before), at + PIECE < len(low)))
    for s, e in batches_of([len(p[1]) for p in parts], PIECE):
        yield tuple(list(x) for x in zip(*parts[s:e]))


def train(docs: DataFrame, text: Column, lang: Column, bits: int = BITS) -> tuple[list[str], np.ndarray]:
    """(languages in order, matrix of log-probabilities with the log-prior as its last row)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        docs_of: dict[str, int] = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), dtype=object)
            texts = batch.column(0).to_pylist()
            for name in set(langs.tolist()):
                own = [texts[k] or "" for k in np.flatnonzero(langs == name)]
                docs_of[name] = docs_of.get(name, 0) + len(own)
                grams = total.setdefault(name, np.zeros(1 << bits, np.int64))
                for _, *part in pieces(own):
                    grams += np.bincount(gram_buckets(part[0], bits, *part[1:])[0], minlength=1 << bits)
        for name, grams in total.items():
            at = np.flatnonzero(grams)
            at, n = np.append(at, 1 << bits), np.append(grams[at], docs_of[name])
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at), pa.array(n)], ["lang", "b", "n"])

    rows = docs.select(text.alias("text"), lang.cast("string").alias("lang")).where("lang is not null")
    found = (
        rows.mapInArrow(count, "lang string, b bigint, n bigint").groupBy("lang", "b").agg(F.sum("n").alias("n")).toArrow()
    )
    names = sorted(set(found["lang"].to_pylist()))
    table = np.zeros(((1 << bits) + 1, len(names)))
    if names:
        table[found["b"].to_numpy(), np.searchsorted(names, found["lang"].to_pylist())] = found["n"].to_numpy()
        seen = table[:-1].any(axis=1).sum()
        table[:-1] = np.log((table[:-1] + 0.5) / (table[:-1].sum(axis=0) + 0.5 * (seen + 1)))
        table[-1] = np.log((table[-1] + 1) / (table[-1].sum() + len(names)))
    return names, table


def predict_column(spark, names: list[str], table: np.ndarray, text: Column, bits: int = BITS) -> Column:
    """A struct column (lang string, score double) for ``text``."""
    shared = spark.sparkContext.broadcast((names, table.astype(np.float32)))
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    def predict(column: pa.Array) -> pa.Array:
        langs, logs = shared.value
        texts = [t or "" for t in column.to_pylist()]
        total, grams = np.zeros((len(texts), len(langs))), np.zeros(len(texts), np.int64)
        for index, part, *ends in pieces(texts) if langs else ():
            bucket, who = gram_buckets(part, bits, *ends)
            n = np.bincount(who, minlength=len(part))
            np.add.at(grams, index, n)
            for c in range(len(langs)):
                np.add.at(total[:, c], index, np.bincount(who, logs[bucket, c], len(part)))
        total += logs[-1] if langs else 0
        best = total.argmax(axis=1) if langs else np.zeros(len(texts), np.int64)
        top = total.max(axis=1, keepdims=True) if langs else total
        score = 1 / np.exp(total - top).sum(axis=1) if langs else np.zeros(len(texts))
        rows = [{"lang": langs[b], "score": float(s)} if g else {"lang": "und", "score": 0.0} for b, s, g in zip(best, score, grams)]
        return pa.array(rows, kind)

    return F.arrow_udf(predict, "struct<lang:string,score:double>").asNondeterministic()(text)


def identify(docs: DataFrame, training: DataFrame, *, text_col: str = "text", lang_col: str = "lang", bits: int = BITS, into: str = "language") -> DataFrame:
    """``docs`` with a struct column ``into`` (lang, score), learned from the texts and languages of ``training``."""
    names, table = train(training, F.col(text_col), F.col(lang_col), bits)
    return docs.withColumn(into, predict_column(docs.sparkSession, names, table, F.col(text_col), bits))
