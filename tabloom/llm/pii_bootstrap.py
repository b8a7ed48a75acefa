r"""Personal data by bootstrapped contextual extraction.

Strict patterns (e-mail, IPv4, card number, phone number) find the seed entities. Around each seed and each loosely shaped
candidate (an address without a full domain, digits that fail the checks) the words before and after form lexical
patterns. Patterns and instances are the two sides of a graph that Spark scores in turns: a pattern is as
good as the share of its instances that are good, an instance as good as its best pattern. Patterns
with at least ``MIN_SEEDS`` different seeds and a score of ``CONFIDENCE`` or more discover the candidates that they surround.

The first scan writes the occurrences (texts with digits or ``@`` only); the graph holds no text. The discovered
patterns are counted before they are broadcast: beyond ``shard`` they are applied in shards, one broadcast after the other.
Places are code points, end exclusive.

Defined results: a null text is empty; texts without entities have empty lists; the same entity in many texts is one
instance; an empty table gives an empty one; other columns pass through.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.shared import stash

KINDS = ("email", "ip", "card", "phone")
MIN_SEEDS = 3
CONFIDENCE = 0.8
ROUNDS = 3
SHARD = 100_000
SPAN = "array<struct<kind:string,s:int,e:int>>"
_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("s", pa.int32()), ("e", pa.int32())]))

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOOSE = re.compile(r"\(?[0-9][0-9\x20().-]{5,}[0-9]")
_LOOSE_DOMAIN = re.compile(r"[A-Za-z0-9-]+")
_WORD = re.compile(r"\S+")
_HINT = re.compile(r"[0-9@]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    double = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(double)) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str, domains: re.Pattern = _DOMAIN) -> Iterator[Span]:
    """Leftmost matches: a run of local characters directly before an ``@`` starts one, so each ``@`` is tried once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := domains.match(text, at + 1)):
            done = domain.end()
            yield "email", start, done
        at = text.find("@", max(at + 1, done))


def _dotted(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """Runs of four dotted numbers, leftmost first."""
    for m in _DOTTED.finditer(text):
        parts, at = m[0].split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            own = parts[k : k + 4]
            size = sum(map(len, own)) + 3
            yield at, at + size, own
            at += size + 1


def base_spans(text: str) -> list[Span]:
    """The strict entities by start, then kind as listed."""
    if not _HINT.search(text):
        return []
    out: list[Span] = list(_emails(text))
    out += [("ip", s, e) for s, e, parts in _dotted(text) if all(len(d := p.lstrip("0")) <= 3 and int(d or 0) <= 255 for p in parts)]
    out += [("card", *m.span()) for m in _CARD.finditer(text) if 12 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def candidates(text: str, base: list[Span]) -> list[Span]:
    """Loosely shaped entities that overlap no strict one."""
    if not _HINT.search(text):
        return []
    found: list[Span] = [("ip", s, e) for s, e, _ in _dotted(text)]
    found += _emails(text, _LOOSE_DOMAIN)
    for m in _LOOSE.finditer(text):
        n = len(_digits(m[0]))
        if 12 <= n <= 19:
            found.append(("card", *m.span()))
        elif 7 <= n <= 15:
            found.append(("phone", *m.span()))
    out: list[Span] = []
    taken = [(s, e) for _, s, e in base]
    for kind, s, e in sorted(found, key=lambda x: (x[1], KINDS.index(x[0]))):
        if (not out or s >= out[-1][2]) and not any(a < e and s < b for a, b in taken):
            out.append((kind, s, e))
    return out


LONG = 40


def _short(text: str) -> str:
    """A text itself, or behind a mark its digest where it is long: equal texts stay equal, others differ."""
    return text if len(text) <= LONG else "#" + hashlib.md5(text.encode("utf-8", "surrogatepass")).hexdigest()


def contexts(text: str, span: Span, words: list[tuple[int, int]] | None = None) -> list[str]:
    """Lexical patterns around a span: two words before; one before and one after. A word that the span cuts gives its part.
    ``words``: the places of the text's words, where they are known."""
    kind, s, e = span
    words = [m.span() for m in _WORD.finditer(text)] if words is None else words
    k = bisect.bisect_left(words, (s, -1))  # the words before k begin before the span
    before = [text[a : min(b, s)].lower() for a, b in words[max(0, k - 2) : k]]
    j = bisect.bisect_right(words, (e, -1))
    if j and words[j - 1][1] > e:
        after = text[e : words[j - 1][1]].lower()
    else:
        after = text[slice(*words[j])].lower() if j < len(words) else "$"
    one, two = _short(before[-1]) if before else "^", _short(before[-2]) if len(before) > 1 else "^"
    return [f"{kind}|{two} {one} _", f"{kind}|{one} _ {_short(after)}"]


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["kind", "value", "seed", "pattern"]
    for batch in batches:
        rows: list[tuple] = []
        for text in batch.column(0).to_pylist():
            if not text or not _HINT.search(text):
                continue
            base = base_spans(text)
            loose = candidates(text, base)
            words = [m.span() for m in _WORD.finditer(text)] if base or loose else []
            for seed, spans in ((True, base), (False, loose)):
                for span in spans:
                    rows += [(span[0], _short(text[span[1] : span[2]].lower()), seed, p) for p in contexts(text, span, words)]
        cols = list(zip(*rows)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.string(), pa.bool_(), pa.string()))], names)


def discover(docs: DataFrame, *, text_col: str = "text", min_seeds: int = MIN_SEEDS, confidence: float = CONFIDENCE, rounds: int = ROUNDS) -> DataFrame:
    """Scored patterns (pattern, seeds, score) that qualify, from the whole texts of ``docs``."""
    found = docs.select(F.col(text_col).alias("text")).mapInArrow(_occurrences, "kind string, value string, seed boolean, pattern string")
    graph = stash(found.groupBy("kind", "value", "pattern").agg(F.max("seed").alias("seed")), "pii-graph")
    scored = graph.withColumn("good", F.col("seed").cast("double"))
    for k in range(rounds):
        patterns = scored.groupBy("pattern").agg(
            F.sum(F.col("seed").cast("long")).alias("seeds"), (F.sum("good") / (F.count("*") + 1)).alias("score")
        )
        fit = stash(patterns.where((F.col("seeds") >= min_seeds) & (F.col("score") >= confidence)), "pii-patterns")
        if k + 1 < rounds:
            # instances take the score of their best qualified pattern
            reached = graph.where("not seed").join(fit.select("pattern", "score"), "pattern").groupBy("kind", "value").agg(F.max("score").alias("best"))
            scored = graph.join(reached, ["kind", "value"], "left").withColumn(
                "good", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("best", F.lit(0.0)))
            ).drop("best")
    return fit


def _finder(shared):
    kind = pa.struct([("base", _SPAN), ("added", _SPAN)])
    as_rows = lambda spans: [{"kind": k, "s": s, "e": e} for k, s, e in spans]

    def find(texts: pa.Array, before: pa.Array) -> pa.Array:
        good, rows = shared.value, []
        for text, old in zip(texts.to_pylist(), before.to_pylist()):
            base = base_spans(text or "")
            added = [(x["kind"], x["s"], x["e"]) for x in old["added"]] if old else []
            if good and text:
                fresh = [c for c in candidates(text, base) if c not in added]
                words = [m.span() for m in _WORD.finditer(text)] if fresh else []
                added += [c for c in fresh if any(p in good for p in contexts(text, c, words))]
            rows.append({"base": as_rows(base), "added": as_rows(sorted(added, key=lambda x: (x[1], KINDS.index(x[0]))))})
        return pa.array(rows, kind)

    return F.arrow_udf(find, f"struct<base:{SPAN},added:{SPAN}>").asNondeterministic()


def find(docs: DataFrame, patterns: DataFrame, *, text_col: str = "text", into: str = "pii", shard: int = SHARD) -> DataFrame:
    """``docs`` with a struct column ``into``: base and added spans."""
    spark = docs.sparkSession
    shards = int(patterns.count() // shard) + 1
    out = docs.withColumn(into, F.lit(None).cast(f"struct<base:{SPAN},added:{SPAN}>"))
    for k in range(shards):
        own = patterns.where(F.pmod(F.xxhash64("pattern"), F.lit(shards)) == k) if shards > 1 else patterns
        good = frozenset(r["pattern"] for r in own.select("pattern").toLocalIterator())
        out = out.withColumn(into, _finder(spark.sparkContext.broadcast(good))(F.col(text_col), F.col(into)))
    return out


def joined(spans) -> F.Column:
    """kind:start:end of each span, comma-joined."""
    one = lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def in_order(*spans) -> F.Column:
    """Spans of several lists by start, then kind as listed."""
    rank = F.array(*map(F.lit, KINDS))
    keyed = F.transform(F.concat(*spans), lambda x: F.struct(x["s"].alias("s"), F.array_position(rank, x["kind"]).alias("r"), x["e"].alias("e"), x["kind"].alias("kind")))
    return F.array_sort(keyed)


def _mask(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for text, found in zip(texts.to_pylist(), spans.to_pylist()):
        if text is not None and found:
            parts, at = [], 0
            for x in found:
                if x["e"] <= at:
                    continue
                parts += [text[at : max(at, x["s"])], f"[{x['kind'].upper()}]" if x["s"] >= at else ""]
                at = x["e"]
            text = "".join([*parts, text[at:]])
        out.append(text)
    return pa.array(out, pa.string())


def redact(docs: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with every entity of its texts replaced by its kind in brackets; no document goes."""
    found = find(docs, discover(docs, text_col=text_col, **options), text_col=text_col, into="__pii")
    spans = in_order(F.col("__pii.base"), F.col("__pii.added"))
    mask = F.arrow_udf(_mask, "string")
    changed = F.when((F.size("__pii.base") + F.size("__pii.added")) > 0, mask(F.col(text_col), spans)).otherwise(F.col(text_col))
    return found.withColumn(text_col, changed).select(*docs.columns)
