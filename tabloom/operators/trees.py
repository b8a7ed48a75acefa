"""Trees grown level by level, all nodes of all trees in one grouped aggregation.

The rows stay where they are. A pass sends every row down the trees grown so far, adds its statistics to the cells of the open node
it ends in, and Spark sums the cells over the tasks; the driver, which sees at most ``CELLS`` cells at a time, picks the splits.

* ``random``: each open node draws candidate features that vary among its rows and one threshold for each, uniform between
  the node's own ends (one pass for the ends, one for the sums left of the thresholds). Up to ``LOCAL_BYTES`` of training rows a
  forest is one job instead: every task has all rows and grows some of the trees, which are the same ones.
* ``best``: cells are the bins between at most ``BINS - 1`` quantiles of each feature; every edge is a candidate threshold. A feature with
  fewer distinct values than bins has an edge at each of them, so its splits are exact.
* Boosting fits gradient and hessian sums in the same cells. Leaves are taken best first up to ``leaves``: a level's histograms
  give the gains of all its nodes in one reading of the rows, the smaller child of a split is counted and its sibling is the parent
  less it, and a queue then takes the best gains in order. That is leaf-wise growth within ``max_depth`` levels: a node's gain does not
  depend on when it is split.

Samples are drawn by a hash of the row and the tree, so a retried task sees the same ones.
"""

from __future__ import annotations

import heapq
import json
import math
import threading
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.core.broadcast import Broadcast
from pyspark.ml import Estimator, Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabloom.functions.attach import tasks_for
from tabloom.operators import deep_tree
from tabloom.session import cut_lineage, keep

BINS = 64
CELLS = 2_000_000
#: training rows of at most so many bytes are sent to the tasks that grow whole trees, each task with about so many rows times trees
LOCAL_BYTES = 32 << 20
ROWS_TIMES_TREES = 1 << 19
_GATHERING = threading.Lock()  # the driver holds such rows of one frame at a time
CHUNK = 1 << 14
ROWS_OF_TASK = 1 << 13
#: numbers of a piece in which the sums of a task are sent, and up to how many numbers a task sends its sums straight to the driver
PIECE = 1 << 15
DIRECT = 1 << 15
#: boosting rounds whose trees are applied anew in every pass before the margins are written
ROUNDS_KEPT = 10


@dataclass
class Tree:
    """Nodes as parallel lists; a leaf has feature -1."""

    feature: list[int] = field(default_factory=list)
    threshold: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    value: list[float] = field(default_factory=list)
    weight: list[float] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)

    def add(self, value: float, weight: float) -> int:
        for name, v in (("feature", -1), ("threshold", 0.0), ("left", -1), ("right", -1), ("value", float(value)), ("weight", float(weight)), ("gain", 0.0)):
            getattr(self, name).append(v)
        return len(self.feature) - 1

    def extend(self, values: np.ndarray, weights: np.ndarray) -> int:
        """Adds leaves; the number of the first."""
        first, n = len(self.feature), len(values)
        for name, v in (("feature", -1), ("threshold", 0.0), ("left", -1), ("right", -1), ("gain", 0.0)):
            getattr(self, name).extend([v] * n)
        self.value.extend(values.tolist()), self.weight.extend(weights.tolist())
        return first

    def split(self, node: int, feature: int, threshold: float, gain: float, left: int, right: int) -> None:
        self.feature[node], self.threshold[node], self.gain[node] = int(feature), float(threshold), float(gain)
        self.left[node], self.right[node] = left, right

    def arrays(self) -> tuple[np.ndarray, ...]:
        ints = [np.array(x, np.int32) for x in (self.feature, self.left, self.right)]
        return ints[0], np.array(self.threshold), ints[1], ints[2], np.array(self.value)

    def leaves(self, scale: float = 1.0) -> list[dict]:
        """Value, and per path feature (low, high] bounds and the share of the rows that follow the path."""
        out, stack = [], [(0, {})]
        while stack:
            node, bounds = stack.pop()
            f, cut = self.feature[node], self.threshold[node]
            if f < 0:
                out.append({"value": self.value[node] * scale, "bounds": bounds})
                continue
            for child, is_left in ((self.left[node], True), (self.right[node], False)):
                low, high, w = bounds.get(f, (-np.inf, np.inf, 1.0))
                w *= self.weight[child] / self.weight[node]
                stack.append((child, {**bounds, f: (low, min(high, cut), w) if is_left else (max(low, cut), high, w)}))
        return out


@dataclass(frozen=True)
class PackedTree:
    """A grown tree as its task sends it: nothing of it is read or written number by number on the driver."""

    text: str
    nodes: tuple[np.ndarray, ...]
    gain: np.ndarray

    @classmethod
    def of(cls, tree: Tree) -> PackedTree:
        return cls(json.dumps(vars(tree)), tree.arrays(), np.array(tree.gain))

    def tree(self) -> Tree:
        return Tree(**json.loads(self.text))


def descend(tree: tuple[np.ndarray, ...], x: np.ndarray) -> np.ndarray:
    """The leaf of every row: all rows go down together, a leaf is its own child."""
    feature, threshold, left, right, _ = tree
    at = np.zeros(len(x), np.intp)
    if feature[0] < 0:
        return at
    leaf, own = feature < 0, np.arange(len(feature))
    kids = np.stack([np.where(leaf, own, right), np.where(leaf, own, left)], axis=1).ravel()
    f = np.where(leaf, 0, feature).astype(np.intp)
    flat, base, level = x.ravel(), np.arange(len(x)) * x.shape[1], np.zeros(1, int)
    while len(level := level[feature[level] >= 0]):
        at = kids.take(2 * at + (flat.take(base + f.take(at)) <= threshold.take(at)))
        level = np.concatenate([left[level], right[level]])
    return at


def uniform(h: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """Numbers in [0, 1) from row hashes, other ones for each tree."""
    z = h.view(np.uint64) ^ np.uint64((tree * 0x9E3779B97F4A7C15 + seed * 0xC2B2AE3D27D4EB4F) & 0xFFFFFFFFFFFFFFFF)
    for shift, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(odd)
    return (z ^ (z >> np.uint64(31))) / 2.0**64


_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])


def bootstrap(h: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is drawn: Poisson with mean one."""
    return np.searchsorted(_POISSON, uniform(h, tree, seed)).astype(float)


#: (features, label, row hash, margin or nothing, tree) -> statistics per row; rows of weight zero are not in the sample
Stats = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int], np.ndarray]


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """(x, y, h, margin) of a bounded number of rows; ``x`` holds values, or bin numbers where they are packed bytes."""
    for batch in batches:
        for k in range(0, batch.num_rows, CHUNK):
            part = batch.slice(k, CHUNK)
            yield features_of(part), *[part.column(c).to_numpy(zero_copy_only=False) for c in (1, 2, 3)]


def features_of(part: pa.RecordBatch) -> np.ndarray:
    """The features of some rows (one at least)."""
    x = part.column(0)
    if not pa.types.is_binary(x.type):
        return x.flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
    _, ends, data = x.buffers()
    ends = np.frombuffer(ends, np.int32)[x.offset : x.offset + len(x) + 1]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].reshape(len(x), -1)


def packed_rows(codes: np.ndarray) -> pa.Array:
    """Rows of bytes as one binary value each."""
    ends = np.arange(len(codes) + 1, dtype=np.int32) * codes.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(codes), [None, pa.py_buffer(ends), pa.py_buffer(codes.tobytes())])


def binned_rows(rows: DataFrame, edges: list[np.ndarray]) -> DataFrame:
    """``training_rows`` with the bin number of each feature in a byte: ``x <= edges[k]`` holds where the number is at most ``k``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, *others in chunks(batches):
            yield pa.RecordBatch.from_arrays([packed_rows(deep_tree.binned(x, edges)), *map(pa.array, others)], ["x", "y", "h", "m"])

    return rows.mapInArrow(run, "x binary, y double, h bigint, m double")


def training_rows(df: DataFrame, features: str, label: str) -> DataFrame:
    """(x, y, h, m): feature array, label, a hash of the row and the margin 0."""
    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, (T.UserDefinedType, T.MapType))]
    return df.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"), F.xxhash64(*plain).alias("h"), F.lit(0.0).alias("m"))


def dealt(df: DataFrame, features: str, label: str) -> tuple[DataFrame, Callable[[], object]]:
    """(persisted training rows in as many tasks as they are worth, a function that lets go of them)."""
    rows = keep(training_rows(df, features, label))
    return rows.coalesce(tasks_for(rows, rows.count(), ROWS_OF_TASK)), rows.unpersist


class Prepared:
    """Training rows of one frame for any number of fits: dealt out once, edges and bin numbers worked out once per rule.

    ``shared``: more than one fit is to come, also at the same time.
    """

    def __init__(self, df: DataFrame, features: str, label: str, shared: bool = False):
        self._df, self._columns, self._shared = df, (features, label), shared
        self._lock, self._made, self._kept = threading.RLock(), {}, []

    @property
    def spark(self) -> SparkSession:
        return self._df.sparkSession

    def once(self, name: str, make: Callable[[], object]):
        with self._lock:
            if name not in self._made:
                self._made[name] = make()
            return self._made[name]

    @property
    def size(self) -> int:
        return self.once("size", lambda: _size_of(self._df, self._columns[0]))

    @property
    def rows(self) -> DataFrame:
        def make() -> DataFrame:
            rows, done = dealt(self._df, *self._columns)
            self._kept.append(done)
            return rows

        return self.once("rows", make)

    @property
    def n(self) -> int:
        return self.once("n", self.rows.count)

    def edges(self, rule: Callable[[DataFrame, int, int], list[np.ndarray]]) -> list[np.ndarray]:
        return self.once(f"edges {rule.__name__}", lambda: rule(self.rows, self.n, self.size))

    def codes(self, rule: Callable[[DataFrame, int, int], list[np.ndarray]]) -> DataFrame:
        """``binned_rows`` by the edges of ``rule``, persisted where they are read more than once."""

        def make() -> DataFrame:
            codes = binned_rows(self.rows, self.edges(rule))
            if self._shared or self.n > deep_tree.LOCAL_ROWS:
                self._kept.append(keep(codes).unpersist)
            return codes

        return self.once(f"codes {rule.__name__}", make)

    @property
    def local(self) -> LocalRows | None:
        """All rows as one broadcast, where they are few."""

        def make() -> LocalRows | None:
            if self._df.count() * (self.size + 1) * 8 > LOCAL_BYTES:
                return None
            with _GATHERING:
                rows = training_rows(self._df, *self._columns).select("x", "y").toArrow().combine_chunks()
                x = rows["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, self.size)
                shared = self.spark.sparkContext.broadcast((np.ascontiguousarray(x.T), rows["y"].to_numpy()))
                self._kept.append(shared.unpersist)
                return LocalRows(shared, np.arange(self.size), len(x))

        return self.once("local", make)

    def narrowed(self, df: DataFrame, places: Sequence[int]) -> Prepared:
        """The same rows with some of the features, which ``df`` has and which stand at ``places`` here."""
        out, held = Prepared(df, *self._columns), self.local
        out._made |= {"size": len(places), "local": held and LocalRows(held.shared, held.places[list(places)], held.n)}
        return out

    def done(self) -> None:
        while self._kept:
            self._kept.pop()()
        self._made.clear()


@dataclass(frozen=True)
class LocalRows:
    """``shared``: (values by feature, labels) of ``n`` rows; ``places``: the features that count."""

    shared: Broadcast
    places: np.ndarray
    n: int


def grown_edges(rows: DataFrame, _n: int, size: int) -> list[np.ndarray]:
    return feature_edges(rows, size)


def feature_edges(rows: DataFrame, size: int, bins: int = BINS) -> list[np.ndarray]:
    """Ascending candidate thresholds of each feature: its values where they are fewer than the bins, else quantiles."""
    at = [k / bins for k in range(1, bins)]
    one = rows.select(F.posexplode("x").alias("f", "v")).groupBy("f")
    told = one.agg(F.percentile_approx("v", at, 10_000).alias("q"), F.approx_count_distinct("v", 0.02).alias("n")).collect()
    narrow = [r["f"] for r in told if r["n"] <= 1.2 * bins]
    values = rows.agg(*[F.array_sort(F.collect_set(F.col("x")[f])).alias(str(f)) for f in narrow]).first() if narrow else {}
    out: list[np.ndarray] = [np.zeros(0)] * size
    for r in told:
        f = r["f"]
        exact = f in narrow and len(values[str(f)]) <= bins
        out[f] = np.array(values[str(f)][:-1], float) if exact else np.unique(np.array(r["q"], float))
    return out


@dataclass
class Level:
    """The open nodes of some trees: slot of each node (or -1), candidate features of each slot, and their thresholds
    (one per candidate) or the edges of all features."""

    trees: list[tuple[int, tuple[np.ndarray, ...]]]
    slots: list[np.ndarray]
    features: list[np.ndarray]
    cuts: list[np.ndarray] | None
    edges: list[np.ndarray] | None

    @property
    def width(self) -> int:
        return 2 if self.cuts is not None else max(len(e) for e in self.edges) + 1


def combined(rows: DataFrame, one: Callable[[Iterator[pa.RecordBatch]], np.ndarray], length: int, start: float, both: np.ufunc) -> np.ndarray:
    """``both`` over all tasks of the ``length`` numbers ``one`` makes of a task's rows; ``start`` changes nothing.

    A task sends pieces of ``PIECE`` numbers.  Where there are many, they meet in tasks first and the driver sees each piece once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = one(batches)
        for k in range(0, length, PIECE):
            if (mine[k : k + PIECE] != start).any():
                yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([mine[k : k + PIECE].tobytes()], pa.binary())], ["at", "v"])

    def meet(table: pa.Table) -> pa.Table:
        pieces = (np.frombuffer(v.as_buffer()) for v in table.column("v"))
        total = next(pieces).copy()
        for piece in pieces:
            both(total, piece, out=total)
        return pa.table({"at": table.column("at").slice(0, 1), "v": pa.array([total.tobytes()], pa.binary())})

    sent = rows.mapInArrow(run, "at bigint, v binary")
    if length > DIRECT:
        sent = sent.groupBy("at").applyInArrow(meet, sent.schema)
    out = np.full(length, start)
    table = sent.toArrow()
    for k, v in zip(table["at"].to_pylist(), table["v"]):
        both(out[k : k + PIECE], np.frombuffer(v.as_buffer()), out=out[k : k + PIECE])
    return out


def cell_sums(rows: DataFrame, level: Level, stats: Stats, k: int) -> list[np.ndarray]:
    """Per tree an array (slot, candidate, bin, statistic) summed over all rows."""
    shared = rows.sparkSession.sparkContext.broadcast(level)
    width = level.width
    shapes = [(k, f.shape[1], len(f), width) for f in level.features]
    starts = np.concatenate([[0], np.cumsum([math.prod(s) for s in shapes])]).astype(int)

    def run(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        lv = shared.value
        sums = np.zeros(starts[-1])
        blocks = [sums[a:b].reshape(*s[:2], -1) for a, b, s in zip(starts, starts[1:], shapes)]
        by_candidate = [np.ascontiguousarray(f.T).astype(np.intp) for f in lv.features]
        cuts = [np.ascontiguousarray(c.T) for c in lv.cuts] if lv.edges is None else None
        for x, y, h, m in chunks(batches):
            if lv.edges is not None:
                x_bins = x if x.dtype == np.uint8 else np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(lv.edges)], axis=1)
            flat = (x if lv.edges is None else x_bins).ravel()
            for number, ((t, tree), slots, features, block) in enumerate(zip(lv.trees, lv.slots, by_candidate, blocks)):
                slot = slots.take(descend(tree, x))
                v = stats(x, y, h, m, t)
                at = np.flatnonzero((slot >= 0) & (v[:, 0] > 0))
                slot, v = slot.take(at).astype(np.intp), np.ascontiguousarray(v.take(at, axis=0).T)
                first, cell = at * x.shape[1], slot * width
                for j, f in enumerate(features):
                    value = flat.take(first + f.take(slot))
                    at_bin = cell + (value if cuts is None else value > cuts[number][j].take(slot))
                    for c in range(k):
                        block[c, j] += np.bincount(at_bin, v[c], block.shape[2])
        return sums

    flat = combined(rows, run, int(starts[-1]), 0.0, np.add)
    shared.unpersist()
    return [flat[a:b].reshape(s).transpose(2, 1, 3, 0) for a, b, s in zip(starts, starts[1:], shapes)]


def node_ends(rows: DataFrame, trees: list[tuple[int, tuple]], slots: list[np.ndarray], counts: list[int], stats: Stats, size: int) -> list[np.ndarray]:
    """Per tree an array (slot, feature, end): smallest and largest value of each feature among a node's rows."""
    shared = rows.sparkSession.sparkContext.broadcast((trees, slots))
    starts = np.concatenate([[0], np.cumsum(counts)]).astype(int)

    def run(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        ends = np.full((2, starts[-1], size), np.inf)  # the smallest values and the negated largest
        low, high = ends
        grown, places = shared.value
        for x, y, h, m in chunks(batches):
            for (t, tree), place, base, n in zip(grown, places, starts, counts):
                slot = place.take(descend(tree, x))
                at = np.flatnonzero((slot >= 0) & (stats(x, y, h, m, t)[:, 0] > 0))
                if not len(at):
                    continue
                s = slot.take(at)
                order = np.argsort(s.astype(np.uint16) if n < 1 << 16 else s, kind="stable")  # short numbers are sorted by their digits
                s, own_rows = s.take(order), x.take(at.take(order), axis=0)
                first = np.flatnonzero(np.diff(s, prepend=-1))
                own = base + s[first]
                low[own] = np.minimum(low[own], np.minimum.reduceat(own_rows, first))
                high[own] = np.minimum(high[own], -np.maximum.reduceat(own_rows, first))
        return ends.ravel()

    ends = combined(rows, run, int(2 * starts[-1] * size), np.inf, np.minimum).reshape(2, -1, size)
    shared.unpersist()
    out = np.where(np.isfinite(ends), np.stack([ends[0], -ends[1]]), 0.0).transpose(1, 2, 0)
    return [out[a:b] for a, b in zip(starts, starts[1:])]


def subset_size(rule: str | int | None, size: int) -> int:
    if rule in (None, "all"):
        return size
    if rule == "sqrt":
        return max(1, int(math.sqrt(size)))
    if rule == "log2":
        return max(1, int(math.log2(size)))
    return max(1, min(size, int(rule)))


def best_splits(sums: np.ndarray, min_leaf: float, penalty: float = 0.0, min_hessian: float = 0.0) -> tuple[np.ndarray, ...]:
    """Per slot (gain, candidate, bin): the last statistic but the first is the target's sum and the last its weight; gain is the drop
    of the squared error, -inf where no split is allowed. Ties go to the first candidate and bin."""
    left = np.cumsum(sums, axis=2)
    total = left[:, :, -1:, :]
    left = left[:, :, :-1, :]
    right = total - left
    score = lambda v: v[..., 1] ** 2 / np.maximum(v[..., -1 if v.shape[-1] > 2 else 0] + penalty, 1e-300)
    gain = score(left) + score(right) - score(total)
    allowed = (left[..., 0] >= max(min_leaf, 1e-9)) & (right[..., 0] >= max(min_leaf, 1e-9))
    if sums.shape[-1] > 2:
        allowed &= (left[..., 2] >= min_hessian) & (right[..., 2] >= min_hessian)
    gain = np.where(allowed, gain, -np.inf).reshape(len(sums), -1)
    at = gain.argmax(axis=1) if gain.shape[1] else np.zeros(len(sums), int)
    return gain[np.arange(len(sums)), at], at // left.shape[2], at % left.shape[2]


@dataclass(frozen=True)
class Growth:
    """How the trees of a forest grow."""

    n_trees: int = 100
    max_depth: int = 10
    min_samples_split: int = 2
    min_samples_leaf: int = 1
    max_features: str | int | None = "sqrt"
    splitter: str = "random"
    bootstrap: bool = False
    seed: int = 42

    def one_tree(self, size: int) -> bool:
        """Whether nothing is drawn, so that branches of few rows grow in tasks."""
        return self.n_trees == 1 and self.splitter == "best" and not self.bootstrap and subset_size(self.max_features, size) == size


def _groups(sizes: Sequence[int], cells_of_slot: int) -> Iterator[list[int]]:
    """Trees in groups of at most ``CELLS`` cells (one at least)."""
    group, held = [], 0
    for t, n in enumerate(sizes):
        if group and held + n * cells_of_slot > CELLS:
            yield group
            group, held = [], 0
        if n:
            group.append(t)
            held += n * cells_of_slot
    if group:
        yield group


def grow(rows: DataFrame, size: int, how: Growth, edges: list[np.ndarray] | None = None) -> list[Tree]:
    """The trees of a forest over ``training_rows``; the value of a leaf is its mean label."""
    if edges is None and how.splitter == "best":
        edges = feature_edges(rows, size)
    seed, draw = how.seed, how.bootstrap
    m = subset_size(how.max_features, size)
    if how.one_tree(size):
        return [deep_tree.grow_tree(rows, size, edges, deep_tree.Rules(how.max_depth, how.min_samples_leaf, least=how.min_samples_split))]

    def stats(x, y, h, m, t) -> np.ndarray:
        w = bootstrap(h, t, seed) if draw else np.ones(len(y))
        return np.stack([w, w * y], axis=1)

    trees = [Tree() for _ in range(how.n_trees)]
    for t in trees:
        t.add(0.0, 0.0)
    open_nodes: list[list[int]] = [[0] for _ in trees]
    rngs = [np.random.default_rng([how.seed, t]) for t in range(how.n_trees)]
    width = max((len(e) for e in edges), default=0) + 1 if how.splitter == "best" else 2
    for depth in range(how.max_depth + 1):
        cells = max(m * width, size)
        following: list[list[int]] = [[] for _ in trees]
        for group in _groups([len(o) for o in open_nodes], cells):
            grown = [(t, trees[t].arrays()) for t in group]
            slots = []
            for t in group:
                slot = np.full(len(trees[t].feature), -1, np.int32)
                slot[open_nodes[t]] = np.arange(len(open_nodes[t]))
                slots.append(slot)
            counts = [len(open_nodes[t]) for t in group]
            if how.splitter == "random":
                ends = node_ends(rows, grown, slots, counts, stats, size)
                features, cuts = [], []
                for t, e in zip(group, ends):
                    f, c = _draw(rngs[t], e, m)
                    features.append(f), cuts.append(c)
                level = Level(grown, slots, features, cuts, None)
            else:
                features = [np.stack([np.sort(rngs[t].permutation(size)[:m]) for _ in range(n)]) for t, n in zip(group, counts)]
                cuts, level = None, Level(grown, slots, features, None, edges)
            for g, (t, sums) in enumerate(zip(group, cell_sums(rows, level, stats, 2))):
                cut_of = (lambda at, f, j, b: cuts[g][at, j]) if cuts is not None else (lambda at, f, j, b: np.array([edges[k][e] for k, e in zip(f, b)]))  # noqa: B023
                _at, _j, first, able = _split_level(trees[t], open_nodes[t], sums, features[g], cut_of, how, depth)
                following[t] = (first + np.flatnonzero(able)).tolist()
        open_nodes = following
        if not any(open_nodes):
            break
    return trees


def _split_level(tree: Tree, nodes: list[int], sums: np.ndarray, features: np.ndarray, cut_of: Callable, how: Growth, depth: int) -> tuple:
    """Splits the open ``nodes`` by their sums (slot, candidate, bin, statistic): (slots that are split, their candidates, the number of
    the first child, which children stay open); the children of a slot follow each other, the left one first."""
    gain, j, b = best_splits(sums, how.min_samples_leaf)
    n, y = sums[:, 0].sum(axis=1).T
    mean = np.divide(y, n, out=np.zeros(len(n)), where=n != 0)
    for node, w, v in zip(nodes, n.tolist(), mean.tolist()):
        tree.weight[node], tree.value[node] = w, v
    enough = (n >= how.min_samples_split) & (depth < how.max_depth) & (0 < gain)
    at = np.flatnonzero(enough & ~(gain <= 1e-12 * np.maximum(1.0, y * y / np.maximum(n, 1))))
    if not len(at):
        return at, j[at], 0, np.zeros(0, bool)
    f = features[at, j[at]]
    mine = sums[at, j[at]]
    under = np.where(np.arange(mine.shape[1])[:, None] <= b[at, None, None], mine, 0.0).sum(axis=1)
    kids = np.stack([under, np.stack([n, y], axis=1)[at] - under], axis=1).reshape(-1, 2)
    first = tree.extend(kids[:, 1] / kids[:, 0], kids[:, 0])
    for k, (s, one, c, won) in enumerate(zip(at.tolist(), f.tolist(), cut_of(at, f, j[at], b[at]).tolist(), gain[at].tolist())):
        tree.split(nodes[s], one, c, won, first + 2 * k, first + 2 * k + 1)
    return at, j[at], first, (kids[:, 0] >= max(how.min_samples_split, 2 * how.min_samples_leaf)) & (depth + 1 < how.max_depth)


def grow_local(x: np.ndarray, y: np.ndarray, how: Growth, number: int) -> Tree:
    """Tree ``number`` of ``grow`` with random thresholds, from all rows: ``x`` by feature, one row of it for each.

    The rows of a node stand together and its children's are dealt out behind each other, so a level costs as much as there are rows
    in open nodes. Ends are looked up for drawn features only: one that turns out constant is replaced by the next drawn, and is not
    drawn again further down.
    """
    size, n = x.shape
    m, flat = subset_size(how.max_features, size), x.ravel()
    rng, tree = np.random.default_rng([how.seed, number]), Tree()
    tree.add(0.0, 0.0)
    nodes, rows, label, starts = [0], np.arange(n), y, np.zeros(1, int)
    exact = not (y % 1).any()  # sums of whole numbers are the same in any order; others are added row by row, as a pass does
    constant = np.zeros((1, size), bool)
    for depth in range(how.max_depth + 1):
        k, held = len(nodes), np.diff(starts, append=len(rows))
        keys = rng.uniform(size=(k, size))
        drawn, low, high = np.zeros((k, m), int), np.zeros((k, m)), np.zeros((k, m))
        values = [np.zeros(0)] * m
        ask = np.ones(k, bool)
        while True:
            drawn[ask] = np.argsort(keys[ask] + constant[ask], axis=1)[:, :m]
            whole = ask.all()
            some = slice(None) if whole else np.flatnonzero(np.repeat(ask, held))
            own, own_held = rows[some], held[ask]
            own_starts = np.cumsum(own_held) - own_held
            for j in range(m):
                v = flat.take(own + np.repeat(drawn[ask, j] * n, own_held))
                low[ask, j], high[ask, j] = np.minimum.reduceat(v, own_starts), np.maximum.reduceat(v, own_starts)
                if whole:
                    values[j] = v
                else:
                    values[j][some] = v
            low, high = np.where(np.isfinite(low), low, 0.0), np.where(np.isfinite(high), high, 0.0)
            at, j = np.nonzero((high <= low) & ~np.take_along_axis(constant, drawn, 1))
            if not len(at):
                break
            constant[at, drawn[at, j]] = True
            ask = np.zeros(k, bool)
            ask[at] = True
        cuts = np.minimum(low + (high - low) * rng.uniform(size=drawn.shape), np.nextafter(high, low))
        sums = np.zeros((k, m, 2, 2))
        under = np.empty((m, len(rows)), bool)
        for j in range(m):
            np.less_equal(values[j], np.repeat(cuts[:, j], held), out=under[j])
            sums[:, j, 0, 0] = np.add.reduceat(under[j], starts, dtype=np.int64)
            if exact:
                sums[:, j, 0, 1] = np.add.reduceat(label * under[j], starts)
            else:
                sums[:, j, :, 1] = np.bincount(2 * np.repeat(np.arange(k), held) + ~under[j], label, 2 * k).reshape(k, 2)
        sums[:, :, 1, 0] = held[:, None] - sums[:, :, 0, 0]
        if exact:
            sums[:, :, 1, 1] = np.add.reduceat(label, starts)[:, None] - sums[:, :, 0, 1]
        at, j, first, able = _split_level(tree, nodes, sums, drawn, lambda at, f, j, b: cuts[at, j], how, depth)  # noqa: B023
        if not able.any():
            return tree
        nodes = (first + np.flatnonzero(able)).tolist()
        kid = np.full((k, 2), -1)
        kid[at] = np.where(able, np.cumsum(able) - 1, -1).reshape(-1, 2)
        constant = np.repeat(constant[at], 2, axis=0)[able]
        chosen = np.zeros(k, int)
        chosen[at] = j
        left = under.ravel().take(np.repeat(chosen * len(rows), held) + np.arange(len(rows)))
        to = np.where(left, np.repeat(kid[:, 0], held), np.repeat(kid[:, 1], held))
        stay = np.flatnonzero(to >= 0)
        to = to.take(stay)
        stay = stay.take(np.argsort(to.astype(np.uint16) if len(nodes) < 1 << 16 else to, kind="stable"))
        rows, label = rows.take(stay), label.take(stay)
        starts = np.concatenate([[0], np.cumsum(np.bincount(to, minlength=len(nodes)))[:-1]])
    return tree


def grow_in_tasks(spark: SparkSession, held: LocalRows, how: Growth) -> list[PackedTree]:
    """The trees of a forest with random thresholds, each grown whole in a task."""
    shared, places = held.shared, held.places

    def run(numbers: Iterator[int]) -> Iterator[tuple]:
        x, y = shared.value
        own = x if len(places) == len(x) else x[places]
        for t in numbers:
            yield t, PackedTree.of(grow_local(own, y, how, t))

    tasks = max(1, min(how.n_trees, -(-held.n * how.n_trees // ROWS_TIMES_TREES)))
    grown = dict(spark.sparkContext.parallelize(range(how.n_trees), tasks).mapPartitions(run).collect())
    return [grown[t] for t in range(how.n_trees)]


def _draw(rng: np.random.Generator, ends: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Per slot ``m`` of the features that vary among its rows (padded by constant ones, which never split) and a threshold each."""
    low, high = ends[..., 0], ends[..., 1]
    order = np.argsort(rng.uniform(size=low.shape) + (high <= low), axis=1)[:, :m]
    a, b = np.take_along_axis(low, order, 1), np.take_along_axis(high, order, 1)
    return order, np.minimum(a + (b - a) * rng.uniform(size=order.shape), np.nextafter(b, a))


def importances_of(trees: Sequence[tuple[np.ndarray, np.ndarray]], size: int) -> np.ndarray:
    """Mean over the trees (feature and gain of each node) of each feature's share of the gain."""
    total = np.zeros(size)
    for f, g in trees:
        own = np.bincount(f[f >= 0], g[f >= 0], size)
        total += own / own.sum() if own.sum() > 0 else 0
    return total / total.sum() if total.sum() > 0 else total


@dataclass(frozen=True)
class Boosting:
    """Leaf-wise boosting of the logistic or squared loss."""

    rounds: int = 100
    rate: float = 0.1
    max_depth: int = 6
    leaves: int = 31
    min_samples_leaf: int = 20
    min_hessian: float = 1e-3
    penalty: float = 0.0
    subsample: float = 0.8
    colsample: float = 0.8
    seed: int = 42


def _slopes(trees: list[tuple[np.ndarray, ...]], how: Boosting, base: float, logistic: bool, first: int) -> Stats:
    """Count, gradient sum and hessian of a row: the margin so far is ``base``, the written margin and the trees since."""

    def stats(x, y, h, m, t) -> np.ndarray:
        z = base + m
        for tree in trees:
            z = z + tree[4][descend(tree, x)]
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40))) if logistic else z
        w = (uniform(h, first + t, how.seed) < how.subsample).astype(float)
        return np.stack([w, w * (y - p), w * (p * (1 - p) if logistic else 1.0)], axis=1)

    return stats


def first_slopes(start: float, how: Boosting) -> Stats:
    """Slopes of the logistic loss at the start margin."""
    return _slopes([], how, start, True, 0)


def leafwise_tree(rows: DataFrame, size: int, stats: Stats, edges: list[np.ndarray], features: np.ndarray, how: Boosting) -> Tree:
    """One tree of at most ``leaves`` leaves, best gains first. Levels are counted whole, siblings by subtraction."""
    full = Tree()
    full.add(0.0, 0.0)
    sums: dict[int, np.ndarray] = {}
    splits: dict[int, tuple[float, int, float]] = {}
    kids: dict[int, tuple[int, int]] = {}
    ask, rest = [0], {}  # nodes to count, and for each its sibling to subtract for
    for depth in range(how.max_depth):
        slot = np.full(len(full.feature), -1, np.int32)
        slot[ask] = np.arange(len(ask))
        level = Level([(0, full.arrays())], [slot], [np.tile(features, (len(ask), 1))], None, edges)
        counted = cell_sums(rows, level, stats, 3)[0]
        sums.update(zip(ask, counted))
        for node, (parent, sibling) in rest.items():
            sums[sibling] = sums[parent] - sums[node]
        fresh = ask + [s for _p, s in rest.values()]
        gain, j, b = best_splits(np.stack([sums[n] for n in fresh]), how.min_samples_leaf, how.penalty, how.min_hessian)
        for p, _s in rest.values():
            sums.pop(p, None)
        ask, rest = [], {}
        for k, node in enumerate(fresh):
            n, g, w = sums[node][0].sum(axis=0)
            full.weight[node], full.value[node] = float(n), float(how.rate * g / (w + how.penalty)) if w + how.penalty > 0 else 0.0
            if gain[k] <= 1e-12 or not np.isfinite(gain[k]):
                continue
            f = int(features[j[k]])
            splits[node] = float(gain[k]), f, float(edges[f][b[k]])
            pair = []
            under = sums[node][j[k], : b[k] + 1].sum(axis=0)
            for v in (under, sums[node][0].sum(axis=0) - under):
                pair.append(full.add(how.rate * v[1] / (v[2] + how.penalty), v[0]))
            kids[node] = tuple(pair)
            full.split(node, f, splits[node][2], gain[k], *pair)
            if depth + 1 < how.max_depth:
                small, large = pair if full.weight[pair[0]] <= full.weight[pair[1]] else pair[::-1]
                if full.weight[large] >= 2 * how.min_samples_leaf:
                    ask.append(small)
                    rest[small] = node, large
        if not ask:
            break
    return _best_first(full, splits, kids, how.leaves)


def _best_first(full: Tree, splits: dict, kids: dict, leaves: int) -> Tree:
    """The part of a grown tree that a queue of the best gains reaches with ``leaves`` leaves."""
    out = Tree()
    out.add(full.value[0], full.weight[0])
    queue = [(-splits[0][0], 0, 0)] if 0 in splits else []
    n = 1
    while queue and n < leaves:
        gain, node, own = heapq.heappop(queue)
        pair = [out.add(full.value[c], full.weight[c]) for c in kids[node]]
        out.split(own, splits[node][1], splits[node][2], -gain, *pair)
        n += 1
        for child, place in zip(kids[node], pair):
            if child in splits:
                heapq.heappush(queue, (-splits[child][0], child, place))
    return out


def boost(df: DataFrame, features: str, label: str, size: int, how: Boosting, logistic: bool) -> tuple[float, list[Tree]]:
    """(start margin, trees). Margins are written every ``ROUNDS_KEPT`` rounds, so a pass applies few trees and the plan stays short."""
    rows, done = dealt(df, features, label)
    mean = rows.agg(F.avg("y")).first()[0]
    base = float(mean or 0.0)
    if logistic:
        base = math.log(max(base, 1e-9) / max(1 - base, 1e-9))
    edges = feature_edges(rows, size)
    numbers = [np.arange(len(e)) for e in edges]  # the edges of the binned rows
    trees: list[Tree] = []
    recent: list[tuple[np.ndarray, ...]] = []
    rng = np.random.default_rng(how.seed)
    some = max(1, math.ceil(how.colsample * size))
    current = keep(binned_rows(rows, edges))
    for r in range(how.rounds):
        if len(recent) == ROUNDS_KEPT:
            before, current, recent = current, keep(cut_lineage(add_margin(current, recent))), []
            before.unpersist()
        chosen = np.sort(rng.permutation(size)[:some])
        tree = leafwise_tree(current, size, _slopes(recent, how, base, logistic, r), numbers, chosen, how)
        recent = [*recent, tree.arrays()]
        tree.threshold = [float(edges[f][int(k)]) if f >= 0 else 0.0 for f, k in zip(tree.feature, tree.threshold)]
        trees.append(tree)
        if len(tree.feature) == 1 and how.subsample >= 1 and some == size:
            break  # nothing is left to split, and no other sample will come
    current.unpersist()
    done()
    return base, trees


def add_margin(rows: DataFrame, trees: list[tuple[np.ndarray, ...]]) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = features_of(batch)
            m = batch.column(3).to_numpy(zero_copy_only=False).copy()
            for tree in shared.value:
                m += tree[4][descend(tree, x)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(m)], batch.schema.names)

    return rows.mapInArrow(run, rows.schema)


class TreeEnsemble(Transformer, HasFeaturesCol, DefaultParamsReadable, DefaultParamsWritable):
    """Applies grown trees: the mean of their leaves, or ``base`` plus their sum (through the logistic function where there are classes)."""

    trees = Param(Params._dummy(), "trees", "trees as JSON", TypeConverters.toString)
    size = Param(Params._dummy(), "size", "number of features", TypeConverters.toInt)
    problem = Param(Params._dummy(), "problem", "classification or regression", TypeConverters.toString)
    op = Param(Params._dummy(), "op", "mean or sum", TypeConverters.toString)
    base = Param(Params._dummy(), "base", "start of a sum", TypeConverters.toFloat)
    suffix = Param(Params._dummy(), "suffix", "suffix of output columns", TypeConverters.toString)
    _nodes = None

    @keyword_only
    def __init__(self, *, featuresCol="features", trees=None, size=None, problem="classification", op="mean", base=0.0, suffix=""):
        super().__init__()
        self._setDefault(problem="classification", op="mean", base=0.0, suffix="")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @classmethod
    def of(cls, trees: Sequence[Tree | PackedTree], **params) -> TreeEnsemble:
        packed = [t if isinstance(t, PackedTree) else PackedTree.of(t) for t in trees]
        out = cls(trees=f"[{', '.join(t.text for t in packed)}]", **params)
        out._nodes = [(t.nodes, t.gain) for t in packed]
        return out

    def grown(self) -> list[Tree]:
        return [Tree(**t) for t in json.loads(self.getOrDefault("trees"))]

    def nodes(self) -> list[tuple[tuple[np.ndarray, ...], np.ndarray]]:
        """Arrays and gains of each tree; read from the text once where the model was loaded."""
        if self._nodes is None:
            self._nodes = [(t.arrays(), np.array(t.gain)) for t in self.grown()]
        return self._nodes

    @property
    def featureImportances(self) -> DenseVector:
        return DenseVector(importances_of([(nodes[0], gain) for nodes, gain in self.nodes()], self.getOrDefault("size")))

    def leaf_paths(self) -> list[dict]:
        trees = self.grown()
        return [leaf for t in trees for leaf in t.leaves(1.0 / len(trees))]

    def _transform(self, df: DataFrame) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast([nodes for nodes, _gain in self.nodes()])
        op, base, sfx = self.getOrDefault("op"), self.getOrDefault("base"), self.getOrDefault("suffix")

        def score(x: pa.Array) -> pa.Array:
            rows = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
            total = np.zeros(len(x))
            for tree in shared.value:
                total += tree[4][descend(tree, rows)]
            return pa.array(total / len(shared.value) if op == "mean" else base + total)

        told = F.arrow_udf(score, "double")(vector_to_array(self.getFeaturesCol()))
        if self.getOrDefault("problem") == "regression":
            return df.withColumn(f"prediction{sfx}", told)
        if op == "sum":
            told = 1 / (1 + F.exp(-told))
        out = df.withColumn(f"_p{sfx}", told)
        p = F.col(f"_p{sfx}")
        return out.withColumn(f"probability{sfx}", array_to_vector(F.array(1 - p, p))).withColumn(f"prediction{sfx}", (p > 0.5).cast("double")).drop(f"_p{sfx}")


def _size_of(df: DataFrame, features: str) -> int:
    first = df.select(F.size(vector_to_array(features)).alias("n")).first()
    if first is None:
        raise ValueError("trees need rows to learn from")
    return first[0]


class Forest(Estimator, HasFeaturesCol, HasLabelCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """Averaged trees: ``random`` thresholds per node over all rows (extremely randomised trees), or ``best`` thresholds over drawn
    rows (random forest) or all rows (one tree: a decision tree). Labels are numbers, or 0 and 1 for two classes."""

    numTrees = Param(Params._dummy(), "numTrees", "number of trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "maximum depth", TypeConverters.toInt)
    minSamplesSplit = Param(Params._dummy(), "minSamplesSplit", "rows of a node that may be split", TypeConverters.toInt)
    minSamplesLeaf = Param(Params._dummy(), "minSamplesLeaf", "rows of a leaf", TypeConverters.toInt)
    maxFeatures = Param(Params._dummy(), "maxFeatures", "candidate features per node: all, sqrt, log2 or a number", TypeConverters.toString)
    splitter = Param(Params._dummy(), "splitter", "random or best", TypeConverters.toString)
    bootstrap = Param(Params._dummy(), "bootstrap", "draw rows per tree", TypeConverters.toBoolean)
    problem = Param(Params._dummy(), "problem", "classification or regression", TypeConverters.toString)
    suffix = Param(Params._dummy(), "suffix", "suffix of output columns", TypeConverters.toString)

    @keyword_only
    def __init__(
        self, *, featuresCol="features", labelCol="label", numTrees=100, maxDepth=10, minSamplesSplit=2, minSamplesLeaf=1, maxFeatures="sqrt",
        splitter="random", bootstrap=False, problem="classification", suffix="", seed=42,
    ):
        super().__init__()
        self._set(**{**{k: v for k, v in _DEFAULTS.items()}, **self._input_kwargs})

    def _fit(self, df: DataFrame) -> TreeEnsemble:
        prepared = Prepared(df, self.getFeaturesCol(), self.getLabelCol())
        model = self.fit_prepared(prepared)
        prepared.done()
        return model

    def fit_prepared(self, prepared: Prepared) -> TreeEnsemble:
        at, size, rule = self.getOrDefault, prepared.size, self.getOrDefault("maxFeatures")
        how = Growth(at("numTrees"), at("maxDepth"), at("minSamplesSplit"), at("minSamplesLeaf"), int(rule) if rule.isdigit() else rule, at("splitter"), at("bootstrap"), self.getSeed())
        if how.one_tree(size):
            rules = deep_tree.Rules(how.max_depth, how.min_samples_leaf, least=how.min_samples_split)
            trees = [deep_tree.grow_tree(prepared.codes(grown_edges), size, prepared.edges(grown_edges), rules, prepared.n)]
        elif how.splitter == "random" and not how.bootstrap and prepared.local:
            trees = grow_in_tasks(prepared.spark, prepared.local, how)
        else:
            trees = grow(prepared.rows, size, how, prepared.edges(grown_edges) if how.splitter == "best" else None)
        return TreeEnsemble.of(trees, featuresCol=self.getFeaturesCol(), size=size, problem=at("problem"), suffix=at("suffix"))


_DEFAULTS = {
    "featuresCol": "features", "labelCol": "label", "numTrees": 100, "maxDepth": 10, "minSamplesSplit": 2, "minSamplesLeaf": 1, "maxFeatures": "sqrt",
    "splitter": "random", "bootstrap": False, "problem": "classification", "suffix": "", "seed": 42,
}


class LeafwiseBoosting(Estimator, HasFeaturesCol, HasLabelCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """Boosting whose trees grow leaf by leaf (see :class:`Boosting`)."""

    settings = Param(Params._dummy(), "settings", "fields of Boosting as JSON", TypeConverters.toString)
    problem = Param(Params._dummy(), "problem", "classification or regression", TypeConverters.toString)
    suffix = Param(Params._dummy(), "suffix", "suffix of output columns", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", settings="{}", problem="classification", suffix="", seed=42):
        super().__init__()
        self._setDefault(settings="{}", problem="classification", suffix="", seed=42)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> TreeEnsemble:
        size, logistic = _size_of(df, self.getFeaturesCol()), self.getOrDefault("problem") == "classification"
        how = Boosting(**{"seed": self.getSeed(), **json.loads(self.getOrDefault("settings"))})
        base, trees = boost(df, self.getFeaturesCol(), self.getLabelCol(), size, how, logistic)
        return TreeEnsemble.of(trees, featuresCol=self.getFeaturesCol(), size=size, problem=self.getOrDefault("problem"), op="sum", base=base, suffix=self.getOrDefault("suffix"))
