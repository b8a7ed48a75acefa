"""Repair of conversations with an automaton shared by suffixes.

A row of a conversation is a letter: the first letter of its role if that is s, u or a (o for others), upper-case if its text is
truncated, X if it must go (blank or duplicate). A conversation is the word of its letters, and the cheapest way to bring the rest of
it to the roles ``(s?(ua)+)?`` depends on that rest and on the state of the grammar only. Distinct words are sorted
from their ends: words that share a suffix follow each other, and a pass over the sorted words keeps the automaton's path
of the suffix in hand, extends it by new letters and drops it back to what the next word shares. So each suffix of all
conversations is a node once (once more where it spans two sorted ranges), and holds for each grammar state the cost to go and
the first edit of the best audit; the audit itself is read off along the path. At a node the edits have different letters, so
the least letter among the cheapest ones gives the ASCII-least audit.

Steps: flag faults (duplicates from counted digests, joined skew-safe), stream each conversation's slim rows in order to its word,
solve the distinct words, give each conversation its audit, stream its rows once more behind the audit and digest the repaired text.
Both streams hold one conversation's word, not its rows. The repaired digest needs the rows of a conversation in order, so
a conversation is always one task's work; its texts are never held together.

Edits: Keep 0; Rerole to user or assistant 3; Delete 4, the only edit of a blank or duplicate row; Insert an empty user or assistant row
3; a truncated row that stays costs 3 more.

Defined results: rows of a conversation go by turn, nulls first, then role and a digest of the text, so repeated turns have one order
and copies are adjacent; a null role or text is one space; rows without conversation form one; a conversation without rows has zeros,
an empty audit and the digest of the empty string; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tabloom.functions.attach import attach
from tabloom.llm.shared import stash

SPACE = " \t\n\x0b\x0c\r"
RAISE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: grammar states: nothing yet, after s, after u, after a; the role that may be inserted, and the state behind it
NEXT = (2, 2, 3, 2)
ROLE = ("user", "user", "assistant", "user")
KEEP = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None), "o": (None,) * 4}
FAR = 1 << 60

Node = tuple[tuple[int, ...], str]


def _insertions(costs: list[int], edits: list[str]) -> Node:
    """Allow inserted rows before the rest: costs settle after as many rounds as there are states."""
    base = list(costs)
    for _ in range(3):
        costs = [min(c, INSERT + costs[NEXT[q]]) for q, c in enumerate(costs)]
    for q in range(4):
        if costs[q] == INSERT + costs[NEXT[q]] and (base[q] > costs[q] or "I" < edits[q]):
            edits[q] = "I"
    return tuple(costs), "".join(edits)


END: Node = _insertions([0, FAR, FAR, 0], [" ", " ", " ", " "])


def node(letter: str, costs: tuple[int, ...]) -> Node:
    """Cost to go and first edit per grammar state of a letter before a suffix with ``costs``."""
    out, edits = [], []
    role = letter.lower()
    more = TRUNCATED if letter.isupper() else 0
    for q in range(4):
        options = [(DELETE + costs[q], "D")]
        if letter != "X":
            to = KEEP[role][q]
            if to is not None:
                options.append((more + costs[to], "K"))
            options.append((RAISE + more + costs[NEXT[q]], "R"))
        cost, edit = min(options)
        out.append(cost), edits.append(edit)
    return _insertions(out, edits)


def audit_of(letters: str, path: list[Node]) -> str:
    """The edits of a word from the start; ``path[k]`` is the node of its last k letters."""
    q, out = 0, []
    for left in range(len(letters), -1, -1):
        edits = path[left][1]
        while edits[q] == "I":
            out.append("I")
            q = NEXT[q]
        if left:
            out.append(edits[q])
            if edits[q] == "K":
                q = KEEP[letters[-left].lower()][q]
            elif edits[q] == "R":
                q = NEXT[q]
    return "".join(out)


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reversed words in order -> (word, cost, audit)."""
    path: list[Node] = [END]
    now = ""
    known: dict[tuple[str, tuple[int, ...]], Node] = {}  # costs relative to the first state's: few
    for batch in batches:
        words, costs, audits = [], [], []
        for back in batch.column(0).to_pylist():
            shared = 0
            top = min(len(now), len(back))
            while shared < top and now[shared] == back[shared]:
                shared += 1
            del path[shared + 1 :]
            for letter in back[shared:]:
                below = path[-1][0]
                shape = letter, tuple(c - below[0] for c in below)
                if shape not in known:
                    known[shape] = node(*shape)
                relative, edits = known[shape]
                path.append((tuple(c + below[0] for c in relative), edits))
            now = back
            words.append(back[::-1]), costs.append(path[-1][0][0]), audits.append(audit_of(words[-1], path))
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(costs, pa.int64()), pa.array(audits, pa.string())], ["word", "cost", "audit"])


def solve(words: DataFrame) -> DataFrame:
    """(word, cost, audit) of distinct words."""
    back = words.select(F.reverse("word").alias("back"))
    return back.repartitionByRange("back").sortWithinPartitions("back").mapInArrow(_solve, "word string, cost bigint, audit string")


def damage(talks: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """Rows (conv, turn, role, text, gone) after planted faults; rows that are dropped stay with ``gone``."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(shown(conv_col), F.lit(":"), shown(turn_col))) % 20
    rows = talks.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), shown("role").alias("role"), shown("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    out = rows.select("conv", "turn", role.alias("role"), text.alias("text"), (F.col("kind") == 0).alias("gone"), F.when(F.col("kind") == 3, 2).otherwise(1).alias("times"))
    return out.withColumn("_", F.explode(F.array_repeat(F.lit(0), F.col("times")))).drop("_", "times")


def _digest(*parts: Column) -> Column:
    """MD5 of texts of any content: each goes behind its length; null differs from every text."""
    framed = [F.coalesce(F.concat(F.octet_length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]
    return F.md5(F.concat(*framed))


def flagged(rows: DataFrame) -> DataFrame:
    """Rows (conv, turn, role, text, gone) with ``same`` (digest of conversation, role and text), ``late`` (the same occurs at an
    earlier turn), ``blank`` and ``open`` (truncated)."""
    tail = F.substring(F.rtrim("text", F.lit(SPACE)), -1, 1)
    rows = rows.withColumn("same", _digest(F.col("conv").cast("string"), F.col("role"), F.col("text")))
    rows = rows.withColumn("blank", tail == "").withColumn("open", ~tail.isin(".", "!", "?"))
    at = F.struct(F.col("turn").isNotNull().alias("given"), F.coalesce(F.col("turn").cast("bigint"), F.lit(0)).alias("turn"))
    again = rows.where(~F.col("gone")).groupBy("same").agg(F.count("*").alias("n"), F.min(at).alias("first")).where("n > 1")
    again = stash(again.select("same", "n", "first.given", F.col("first.turn").alias("first_turn")), "conv-again")
    met = attach(rows, again, ["same"], "n")
    late = at > F.struct(F.col("given").alias("given"), F.col("first_turn").alias("turn"))
    return met.withColumn("late", F.when(F.col("given").isNotNull(), late).otherwise(F.lit(False))).drop("given", "first_turn")


#: ascending, nulls first
ORDER = ["conv", "turn", "role", "same"]


def _letters(kind: pa.DataType):
    """Rows of conversations in order -> a word and facts per conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, word, before, same, n_turns, low, high = None, None, "", None, 0, None, None
        count = [0, 0, 0, 0]  # blank, duplicate, truncated, illegal
        done: list[tuple] = []

        def close() -> None:
            gaps = high - low + 1 - n_turns if n_turns else 0
            done.append((own, "".join(word), gaps, *count))

        def flush() -> pa.RecordBatch:
            columns = [pa.array([r[k] for r in done], t) for k, t in enumerate([kind, pa.string(), *[pa.int64()] * 5])]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, ["conv", "word", "gaps", "blank", "duplicate", "truncated", "illegal"])

        for batch in batches:
            for conv, turn, initial, key, gone, blank, open_, late in zip(*[c.to_pylist() for c in batch.columns]):
                if word is None or conv != own:
                    if word is not None:
                        close()
                    own, word, before, same, n_turns, low, high = conv, [], None, None, 0, None, None
                    count[:] = [0, 0, 0, 0]
                if gone:
                    continue
                twin = late or same == (turn, key)  # copies of one turn are adjacent
                same = (turn, key)
                if turn is not None and turn != high:
                    n_turns, low, high = n_turns + 1, turn if low is None else low, turn
                if before is not None and before + initial not in ("su", "ua", "au"):
                    count[3] += 1
                before = initial
                if blank or twin:
                    count[0 if blank else 1] += 1
                    word.append("X")
                else:
                    letter = initial if initial in ("s", "u", "a") else "o"
                    count[2] += open_
                    word.append(letter.upper() if open_ else letter)
            if len(done) > 1000:
                yield flush()
        if word is not None:
            close()
        yield flush()

    return run


def _mend(kind: pa.DataType):
    """Per conversation an audit and its rows in order -> the digest of the repaired text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, audit, at, q, first, sha = None, None, 0, 0, True, None
        ids, hashes = [], []

        def put(line: str) -> None:
            nonlocal first
            sha.update((line if first else "\n" + line).encode())
            first = False

        def inserts() -> None:
            nonlocal at, q
            while at < len(audit) and audit[at] == "I":
                put(ROLE[q] + ":")
                at, q = at + 1, NEXT[q]

        def close() -> None:
            inserts()
            ids.append(own), hashes.append(sha.hexdigest())

        for batch in batches:
            for conv, head, role, text in zip(*[c.to_pylist() for c in batch.columns]):
                if head is not None:
                    if audit is not None:
                        close()
                    own, audit, at, q, first, sha = conv, head, 0, 0, True, hashlib.sha256()
                    continue
                inserts()
                edit = audit[at]
                at += 1
                if edit == "K":
                    put(role + ":" + text)
                    q = KEEP[role[:1] if role[:1] in ("s", "u", "a") else "o"][q]
                elif edit == "R":
                    put(ROLE[q] + ":" + text)
                    q = NEXT[q]
            if len(ids) > 1000:
                yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(hashes)], ["conv", "sha"])
                ids, hashes = [], []
        if audit is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(hashes, pa.string())], ["conv", "sha"])

    return run


def repair(rows: DataFrame) -> DataFrame:
    """Rows (conv, turn, role, text, gone) -> per conversation: conv, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256. A conversation with only ``gone`` rows is one without rows."""
    kind = rows.schema["conv"].dataType
    arrow, sql = to_arrow_type(kind), kind.simpleString()
    rows = flagged(rows)
    slim = rows.select("conv", F.col("turn").cast("bigint").alias("turn"), F.substring("role", 1, 1).alias("initial"), "same", "gone", "blank", "open", "late", "role")
    slim = slim.repartition("conv").sortWithinPartitions(*ORDER).drop("role")
    told = slim.mapInArrow(_letters(arrow), f"conv {sql}, word string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint")
    told = stash(told, "conv-words")
    solved = stash(told.groupBy("word").agg(F.count("*").alias("n")), "conv-distinct")
    answers = solve(solved.select("word")).join(solved, "word")
    told = stash(attach(told, stash(answers, "conv-solved"), ["word"], "n"), "conv-told")
    heads = told.select("conv", F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"), F.lit("").alias("same"), F.lit("").alias("text"), "audit")
    body = rows.where(~F.col("gone")).select("conv", F.col("turn").cast("bigint").alias("turn"), "role", "same", "text", F.lit(None).cast("string").alias("audit"))
    # the head of a conversation stands before its rows
    whole = heads.unionByName(body).repartition("conv").sortWithinPartitions(ORDER[0], F.col("audit").isNull(), *ORDER[1:])
    sums = whole.select("conv", "audit", "role", "text").mapInArrow(_mend(arrow), f"conv {sql}, sha string")
    sums = stash(sums, "conv-sums").select(F.col("conv").alias("_conv"), F.col("sha").alias("repaired_sha256"))
    return told.join(sums, F.col("conv").eqNullSafe(F.col("_conv"))).drop("_conv", "word")


def damage_and_repair(talks: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """``damage`` and ``repair`` of a table of conversations (columns conv_id, turn, role, text)."""
    return repair(damage(talks, conv_col=conv_col, turn_col=turn_col)).withColumnRenamed("conv", conv_col)
