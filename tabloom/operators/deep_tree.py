"""One tree of any depth: its crown grows level by level over all rows, every branch of few rows in a task of its own.

A tree without a depth limit has a node for almost every row.  A pass over the table per level, with all open nodes of a
level on the driver, is paid only for nodes of more than ``LOCAL_ROWS`` rows.  The rows of every other node go to one
task, as bin numbers of one byte, and come back as a packed branch: about 15 bytes per node.

The rules are those of the library's decision tree (bins, gain, leaves, merging of leaves that predict the same), or, with
``least`` rows of a node that may be split, those of :mod:`tabloom.operators.trees`.
"""

from __future__ import annotations

import base64
import io
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOCAL_ROWS = 1 << 16
BATCH_CELLS = 1 << 18
LIBRARY_BINS = 32
EXACT_ROWS = 10_000  # the library takes its bins from so many rows; up to here from all values, beyond from quantiles of all rows
GRID = 1024
EPSILON = 2.0**-52


@dataclass(frozen=True)
class Rules:
    """``classes``: 0 for numbers.  ``least``: rows of a node that may be split, None for the library's rules."""

    max_depth: int
    min_leaf: int = 1
    classes: int = 0
    least: int | None = None

    @property
    def width(self) -> int:
        return self.classes or (3 if self.least is None else 2)

    def of_rows(self, y: np.ndarray) -> np.ndarray:
        """Statistics of single rows."""
        if self.classes:
            return (y[:, None] == np.arange(self.classes)).astype(float)
        return np.stack([np.ones(len(y)), y, y * y][: self.width], axis=1)

    def count(self, v: np.ndarray) -> np.ndarray:
        return v.sum(axis=-1) if self.classes else v[..., 0]

    def impurity(self, v: np.ndarray) -> np.ndarray:
        n = self.count(v)
        some = np.where(n == 0, 1.0, n)
        if self.classes:
            out = np.ones(n.shape)
            for c in range(self.classes):
                share = v[..., c] / some
                out = out - share * share
        else:
            out = (v[..., 2] - (v[..., 1] * v[..., 1]) / some) / some
        return np.where(n == 0, 0.0, out)

    def value(self, v: np.ndarray) -> np.ndarray:
        """What a leaf keeps: rows per class, or the mean."""
        return v if self.classes else (v[..., 1] / np.where(v[..., 0] == 0, 1.0, v[..., 0]))[..., None]

    def told(self, v: np.ndarray) -> np.ndarray:
        return v.argmax(axis=-1) if self.classes else self.value(v)[..., 0]

    def splits(self, hist: np.ndarray, n_edges: np.ndarray, own: np.ndarray | None) -> tuple[np.ndarray, ...]:
        """Per node (gain, feature, bin, statistics left, right, own) from (node, feature, bin, statistic)."""
        left = np.cumsum(hist, axis=2)
        total = left[:, :, -1:, :]
        left = left[:, :, :-1, :]
        right = total - left
        nl, nr = self.count(left), self.count(right)
        ok = (nl >= max(self.min_leaf, 1e-9)) & (nr >= max(self.min_leaf, 1e-9)) & (np.arange(left.shape[2]) < n_edges[:, None])
        if own is None:
            f = int(np.argmax(n_edges > 0))
            own = left[:, f, 0] + right[:, f, 0] if left.shape[2] else total[:, f, 0]
        if self.least is None:
            both = np.where(nl + nr == 0, 1.0, nl + nr)
            gain = self.impurity(own)[:, None, None] - nl / both * self.impurity(left) - nr / both * self.impurity(right)
        else:
            score = lambda v: v[..., 1] ** 2 / np.maximum(v[..., 0], 1e-300)
            gain = score(left) + score(right) - score(total)
        gain = np.where(ok, gain, -np.inf).reshape(len(hist), -1)
        if not gain.shape[1]:
            none = np.zeros(len(hist), int)
            return np.full(len(hist), -np.inf), none, none, own, own, own
        at, every = gain.argmax(axis=1), np.arange(len(hist))
        f, b = at // left.shape[2], at % left.shape[2]
        return gain[every, at], f, b, left[every, f, b], right[every, f, b], own

    def splitting(self, gain: np.ndarray, own: np.ndarray, depth: int) -> np.ndarray:
        if depth >= self.max_depth:
            return np.zeros(len(gain), bool)
        if self.least is None:
            return gain > 0
        n, y = own[:, 0], own[:, 1]
        return (n >= self.least) & (gain > 0) & (gain > 1e-12 * np.maximum(1.0, y * y / np.maximum(n, 1)))

    def opens(self, v: np.ndarray, depth: int) -> np.ndarray:
        """Whether a child at ``depth`` may be split at all."""
        if depth >= self.max_depth:
            return np.zeros(len(v), bool)
        if self.least is None:
            return np.abs(self.impurity(v)) >= EPSILON
        return v[:, 0] >= max(self.least, 2 * self.min_leaf)


@dataclass
class Branch:
    """Nodes as arrays; a leaf has feature -1, the right child follows the left one."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    stats: np.ndarray
    gain: np.ndarray

    def merged(self, rules: Rules) -> Branch:
        """Without the splits below which all leaves predict the same (library's rules only), nodes renumbered."""
        if rules.least is None:
            told, inner = rules.told(self.stats), self.feature >= 0
            for node in np.flatnonzero(inner)[::-1]:
                a = self.left[node]
                if not inner[a] and not inner[a + 1] and told[a] == told[a + 1]:
                    inner[node] = False
            self.feature[~inner] = -1
        keep = np.zeros(len(self.feature), bool)
        keep[0] = True
        for node in np.flatnonzero(self.feature >= 0):
            if keep[node]:
                keep[self.left[node]] = keep[self.left[node] + 1] = True
        place = np.cumsum(keep) - 1
        left = np.where(self.feature >= 0, place[np.minimum(self.left, len(place) - 1)], 0)
        return Branch(self.feature[keep], self.bin[keep], left[keep].astype(np.int32), self.stats[keep], self.gain[keep])

    def importances(self, rules: Rules, size: int) -> np.ndarray:
        inner = self.feature >= 0
        share = rules.count(self.stats) if rules.least is None else np.ones(len(inner))
        return np.bincount(self.feature[inner], (self.gain * share)[inner], size)


def grow_branch(bins: np.ndarray, y: np.ndarray, n_edges: np.ndarray, rules: Rules, depth: int = 0, own: np.ndarray | None = None) -> Branch:
    """The tree over rows in memory, whole levels at a time.  ``own``: the root's statistics, where its parent's split told them."""
    size, k = bins.shape[1], rules.width
    width = int(n_edges.max(initial=0)) + 1
    value = rules.of_rows(y)
    batch = max(1, BATCH_CELLS // (size * width))
    order, starts = np.arange(len(y)), np.array([0, len(y)])
    feature, cut, left, stats, gains = [], [], [], [], []
    known = None if own is None else own[None, :]
    live = np.ones(1, bool) if own is None else rules.opens(known, depth)
    made = 1
    while True:
        n = len(starts) - 1
        f, b, g, at = np.full(n, -1, np.int16), np.zeros(n, np.int16), np.zeros(n), np.zeros(n, np.int32)
        mine = np.zeros((n, k)) if known is None else known
        under, over = np.zeros((n, k)), np.zeros((n, k))
        open_nodes = np.flatnonzero(live)
        for lo in range(0, len(open_nodes), batch):
            part = open_nodes[lo : lo + batch]
            sizes = starts[part + 1] - starts[part]
            slot = np.repeat(np.arange(len(part)), sizes)
            rows = order[np.repeat(starts[part] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(len(slot))]
            cell = (slot[:, None] * size + np.arange(size)) * width + bins[rows]
            hist = np.empty((len(part) * size * width, k))
            flat = cell.ravel()
            for c in range(k):
                hist[:, c] = np.bincount(flat, np.repeat(value[rows, c], size), len(hist))
            gain, pf, pb, pl, pr, told = rules.splits(hist.reshape(len(part), size, width, k), n_edges, None if known is None else known[part])
            mine[part] = told
            yes = rules.splitting(gain, told, depth)
            f[part[yes]], b[part[yes]], g[part[yes]] = pf[yes], pb[yes], gain[yes]
            under[part], over[part] = pl, pr
        inner = np.flatnonzero(f >= 0)
        at[inner] = made + 2 * np.arange(len(inner))
        made += 2 * len(inner)
        for store, new in ((feature, f), (cut, b), (left, at), (stats, mine), (gains, g)):
            store.append(new)
        if not len(inner):
            break
        # rows of the split nodes in the order of the children, each child's rows as they came
        sizes = starts[inner + 1] - starts[inner]
        slot = np.repeat(np.arange(len(inner)), sizes)
        rows = order[np.repeat(starts[inner] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(len(slot))]
        child = 2 * slot + (bins[rows, f[inner][slot]] > b[inner][slot])
        order = rows[np.argsort(child, kind="stable")]
        starts = np.concatenate([[0], np.cumsum(np.bincount(child, minlength=2 * len(inner)))])
        known = np.stack([under[inner], over[inner]], axis=1).reshape(-1, k)
        depth += 1
        live = rules.opens(known, depth)
    return Branch(*[np.concatenate(x) for x in (feature, cut, left, stats, gains)]).merged(rules)


def stride_edges(values: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds between ascending values as the library sets them: midpoints, at about equal weights where there are too many."""
    if len(values) <= bins:
        return (values[:-1] + values[1:]) / 2.0
    stride = weights.sum() / bins
    out, seen, target = [], weights[0], stride
    for k in range(1, len(values)):
        before, seen = seen, seen + weights[k]
        if abs(before - target) < abs(seen - target):
            out.append((values[k - 1] + values[k]) / 2.0)
            target += stride
    return np.array(out)


def library_edges(rows: DataFrame, n: int, size: int) -> list[np.ndarray]:
    """Thresholds of each feature: from all its values within ``EXACT_ROWS`` rows, else from ``GRID`` quantiles over all rows."""
    bins = min(LIBRARY_BINS, n)
    each = rows.select(F.posexplode("x").alias("f", "v"))
    if n <= EXACT_ROWS:
        table = each.select("f", (F.col("v") + 0.0).alias("v")).groupBy("f", "v").agg(F.count(F.lit(1)).alias("n")).toArrow()
        f, v, w = (table[c].to_numpy() for c in ("f", "v", "n"))
        by = np.argsort(v, kind="stable")
        return [stride_edges(v[by][f[by] == k], w[by][f[by] == k].astype(float), bins) for k in range(size)]
    at = [k / GRID for k in range(GRID + 1)]
    told = each.groupBy("f").agg(F.percentile_approx("v", at, 10_000).alias("q"), F.approx_count_distinct("v", 0.02).alias("n")).collect()
    narrow = [r["f"] for r in told if r["n"] <= 1.2 * bins]
    whole = rows.agg(*[F.array_sort(F.collect_set(F.col("x")[f])).alias(str(f)) for f in narrow]).first() if narrow else {}
    out = [np.zeros(0)] * size
    for r in told:
        exact = np.array(whole[str(r["f"])], float) if r["f"] in narrow else None
        if exact is not None and len(exact) <= bins:
            out[r["f"]] = stride_edges(exact, np.ones(len(exact)), bins)
        else:
            out[r["f"]] = stride_edges(*[x.astype(float) for x in np.unique(np.array(r["q"], float), return_counts=True)], bins)
    return out


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], axis=1).astype(np.uint8)


def pack(branch: Branch, rules: Rules, size: int) -> bytes:
    leaf = branch.feature < 0
    left = branch.left.copy()
    left[leaf] = np.arange(leaf.sum())
    out = io.BytesIO()
    np.savez(out, feature=branch.feature, bin=branch.bin.astype(np.uint8), left=left, value=rules.value(branch.stats[leaf]),
             weight=rules.count(branch.stats[leaf]), gains=branch.importances(rules, size), root=branch.stats[0])
    return out.getvalue()


def unpack(packed: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(packed)) as z:
        return {name: z[name] for name in z.files}


def _grow(rows: DataFrame, n: int, size: int, edges: list[np.ndarray], rules: Rules, packer: Callable) -> tuple[list[list], dict[int, bytes]]:
    """The crown, a list of [feature, bin, left, statistics, gain], and by crown node the packed branches that go on there."""
    from tabloom.operators.trees import Level, Tree, cell_sums, chunks, descend, packed_rows

    n_edges = np.array([len(e) for e in edges])
    # rows may come as bin numbers already; the crown's thresholds are bin numbers then
    coded = isinstance(rows.schema["x"].dataType, T.BinaryType)
    cuts = [np.arange(k, dtype=float) for k in n_edges] if coded else edges
    codes = (lambda x: x) if coded else (lambda x: binned(x, edges))
    if n <= LOCAL_ROWS:

        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = [(codes(x), y) for x, y, _h, _m in chunks(batches)]
            if parts:
                bins, y = (np.concatenate(p) for p in zip(*parts))
                yield pa.RecordBatch.from_arrays([pa.array([packer(grow_branch(bins, y, n_edges, rules), rules, size)], pa.binary())], ["packed"])

        return [], {0: bytes(rows.coalesce(1).mapInArrow(whole, "packed binary").first()["packed"])}

    crown, tree = [[-1, 0, 0, None, 0.0]], Tree()  # tree: the crown's splits for the tasks
    tree.add(0.0, 0.0)
    wide, parts, depth = [0], {}, 0  # nodes of many rows; depths of the branches
    stats = lambda x, y, h, m, t: np.concatenate([np.ones((len(y), 1)), rules.of_rows(y)], axis=1)
    while wide:
        slot = np.full(len(tree.feature), -1, np.int32)
        slot[wide] = np.arange(len(wide))
        level = Level([(0, tree.arrays())], [slot], [np.tile(np.arange(size), (len(wide), 1))], None, cuts)
        sums = cell_sums(rows, level, stats, rules.width + 1)[0][..., 1:]
        own = None if depth == 0 else np.stack([crown[node][3] for node in wide])
        gain, f, b, under, over, own = rules.splits(sums, n_edges, own)
        yes, following = rules.splitting(gain, own, depth), []
        for s, node in enumerate(wide):
            crown[node][3] = own[s]
            if not yes[s]:
                continue
            kids = [tree.add(0.0, 0.0), tree.add(0.0, 0.0)]
            tree.split(node, f[s], cuts[f[s]][b[s]], gain[s], *kids)
            crown[node] = [int(f[s]), int(b[s]), kids[0], own[s], float(gain[s])]
            for kid, v in zip(kids, (under[s], over[s])):
                crown.append([-1, 0, 0, v, 0.0])
                if rules.opens(v[None, :], depth + 1)[0]:
                    if rules.count(v) > LOCAL_ROWS:
                        following.append(kid)
                    else:
                        parts[kid] = depth + 1
        wide, depth = following, depth + 1
    arrays, owns = tree.arrays(), {node: crown[node][3] for node in parts}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = np.array(sorted(parts), int)
        for x, y, _h, _m in chunks(batches):
            node = descend(arrays, x)
            at = np.flatnonzero(np.isin(node, mine))
            yield pa.RecordBatch.from_arrays([pa.array(node[at], pa.int32()), packed_rows(codes(x[at])), pa.array(y[at])], ["part", "bins", "y"])

    def local(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        part = int(key[0])
        bins = np.frombuffer(b"".join(pdf["bins"]), np.uint8).reshape(len(pdf), size)
        grown = grow_branch(bins, pdf["y"].to_numpy(), n_edges, rules, parts[part], owns[part])
        return pd.DataFrame({"part": [part], "packed": [packer(grown, rules, size)]})

    told = rows.mapInArrow(deal, "part int, bins binary, y double").groupBy("part").applyInPandas(local, "part int, packed binary").collect() if parts else []
    return crown, {r["part"]: bytes(r["packed"]) for r in told}


def grow_deep(rows: DataFrame, n: int, size: int, edges: list[np.ndarray], rules: Rules) -> dict[str, np.ndarray]:
    """The packed arrays of one tree over ``training_rows``: feature, bin, left (of a leaf: its value), value, weight, gains."""
    crown, branches = _grow(rows, n, size, edges, rules, pack)
    return _joined(crown, branches, rules, size) if crown else unpack(branches[0])


def grow_tree(rows: DataFrame, size: int, edges: list[np.ndarray], rules: Rules, n: int | None = None):
    """One tree with the statistics of all nodes, by the rules of :mod:`tabloom.operators.trees`."""
    from tabloom.operators.trees import Tree

    crown, branches = _grow(rows, rows.count() if n is None else n, size, edges, rules, lambda branch, _r, _s: pickle.dumps(branch))
    tree = Tree()
    for c in crown or [None]:
        v = c[3] if c else np.zeros(2)
        tree.add(v[1] / v[0] if v[0] else 0.0, v[0])
    for node, c in enumerate(crown):
        if c[0] >= 0:
            tree.split(node, c[0], edges[c[0]][c[1]], c[4], c[2], c[2] + 1)
    for at, packed in branches.items():
        branch = pickle.loads(packed)
        place = [at]
        n, y = branch.stats[0]
        tree.weight[at], tree.value[at] = float(n), float(y / n) if n else 0.0
        place += [tree.add(y / n, n) for n, y in branch.stats[1:]]
        for node in np.flatnonzero(branch.feature >= 0):
            f, a = branch.feature[node], branch.left[node]
            tree.split(place[node], f, edges[f][branch.bin[node]], branch.gain[node], place[a], place[a + 1])
    return tree


def _joined(crown: list[list], branches: dict[int, bytes], rules: Rules, size: int) -> dict[str, np.ndarray]:
    """Crown and branches as one packed tree."""
    top = Branch(np.array([c[0] for c in crown], np.int16), np.array([c[1] for c in crown], np.int16), np.array([c[2] for c in crown], np.int32),
                 np.stack([c[3] for c in crown]), np.array([c[4] for c in crown]))
    grown = {node: unpack(p) for node, p in branches.items()}
    deep = {node: z for node, z in grown.items() if len(z["feature"]) > 1}
    # leaves of the crown that predict the same merge too, unless a branch goes on below one of them
    if rules.least is None:
        told, inner = rules.told(top.stats), (top.feature >= 0) | np.isin(np.arange(len(crown)), list(deep))
        for node in np.flatnonzero(top.feature >= 0)[::-1]:
            a = top.left[node]
            if not inner[a] and not inner[a + 1] and told[a] == told[a + 1]:
                inner[node], top.feature[node] = False, -1
    leaf = top.feature < 0
    gains = top.importances(rules, size) + sum((z["gains"] for z in grown.values()), np.zeros(size))
    left, n_nodes, n_values = top.left.copy(), len(crown), int(leaf.sum())
    left[leaf] = np.arange(n_values)
    out = {"feature": [top.feature], "bin": [top.bin.astype(np.uint8)], "left": [left], "value": [rules.value(top.stats[leaf])], "weight": [rules.count(top.stats[leaf])]}
    for node, z in deep.items():
        inner = z["feature"] >= 0
        # the branch's root takes the crown's node, its other nodes follow the ones there are
        moved = np.where(inner, z["left"] + n_nodes - 1, z["left"] + n_values).astype(np.int32)
        top.feature[node], out["bin"][0][node], left[node] = z["feature"][0], z["bin"][0], moved[0]
        for name, v in (("feature", z["feature"][1:]), ("bin", z["bin"][1:]), ("left", moved[1:]), ("value", z["value"]), ("weight", z["weight"])):
            out[name].append(v)
        n_nodes, n_values = n_nodes + len(inner) - 1, n_values + int((~inner).sum())
    return {**{name: np.concatenate(v) for name, v in out.items()}, "gains": gains}


def leaf_values(tree: dict[str, np.ndarray], edges: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    """The value of every row's leaf."""
    bins = binned(x, edges)
    at = np.zeros(len(x), np.int32)
    live = np.arange(len(x)) if tree["feature"][0] >= 0 else np.zeros(0, int)
    while len(live):
        node = at[live]
        at[live] = tree["left"][node] + (bins[live, tree["feature"][node]] > tree["bin"][node])
        live = live[tree["feature"][at[live]] >= 0]
    return tree["value"][tree["left"][at]]


class DeepTreeModel(Transformer, HasFeaturesCol, DefaultParamsReadable, DefaultParamsWritable):
    """Applies a grown tree; ``packed`` holds its arrays and thresholds."""

    packed = Param(Params._dummy(), "packed", "arrays of the tree, base64", TypeConverters.toString)
    classes = Param(Params._dummy(), "classes", "number of classes, 0 for regression", TypeConverters.toInt)
    suffix = Param(Params._dummy(), "suffix", "suffix of output columns", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", packed=None, classes=0, suffix=""):
        super().__init__()
        self._setDefault(classes=0, suffix="")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @classmethod
    def of(cls, tree: dict[str, np.ndarray], edges: list[np.ndarray], **params) -> DeepTreeModel:
        out = io.BytesIO()
        np.savez_compressed(out, ends=np.cumsum([len(e) for e in edges]), edges=np.concatenate(edges), **tree)
        return cls(packed=base64.b64encode(out.getvalue()).decode(), **params)

    def grown(self) -> tuple[dict[str, np.ndarray], list[np.ndarray]]:
        z = unpack(base64.b64decode(self.getOrDefault("packed")))
        return z, np.split(z.pop("edges"), z.pop("ends")[:-1])

    @property
    def featureImportances(self) -> DenseVector:
        gains = self.grown()[0]["gains"]
        return DenseVector(gains / gains.sum() if gains.sum() > 0 else gains)

    def leaf_paths(self) -> list[dict]:
        """Value, and per path feature (low, high] bounds and the share of the rows that follow the path."""
        tree, edges = self.grown()
        inner = tree["feature"] >= 0
        weight = np.zeros(len(inner))
        weight[~inner] = tree["weight"][tree["left"][~inner]]
        order, stack = [], [0]
        while stack:
            node = stack.pop()
            order.append(node)
            if inner[node]:
                stack += [tree["left"][node], tree["left"][node] + 1]
        for node in order[::-1]:
            if inner[node]:
                weight[node] = weight[tree["left"][node]] + weight[tree["left"][node] + 1]
        out, todo = [], [(0, {})]
        while todo:
            node, bounds = todo.pop()
            if not inner[node]:
                v = tree["value"][tree["left"][node]]
                out.append({"value": float(v[1] / v.sum() if len(v) > 1 else v[0]), "bounds": bounds})
                continue
            f = int(tree["feature"][node])
            cut = float(edges[f][tree["bin"][node]])
            for child, is_left in ((tree["left"][node], True), (tree["left"][node] + 1, False)):
                low, high, w = bounds.get(f, (-np.inf, np.inf, 1.0))
                w *= weight[child] / weight[node]
                todo.append((child, {**bounds, f: (low, min(high, cut), w) if is_left else (max(low, cut), high, w)}))
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(self.grown())
        classes, sfx = self.getOrDefault("classes"), self.getOrDefault("suffix")

        def values(x: pa.Array) -> pa.Array:
            rows = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
            found = leaf_values(*shared.value, rows) if len(rows) else np.zeros((0, max(classes, 1)))
            if not classes:
                return pa.array(found[:, 0])
            return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * classes), pa.array(found.ravel()))

        x = vector_to_array(self.getFeaturesCol())
        if not classes:
            return df.withColumn(f"prediction{sfx}", F.arrow_udf(values, "double")(x))
        out = df.withColumn(f"_n{sfx}", F.arrow_udf(values, "array<double>")(x))
        n = F.col(f"_n{sfx}")
        rows = F.aggregate(n, F.lit(0.0), lambda a, v: a + v)
        return (
            out.withColumn(f"rawPrediction{sfx}", array_to_vector(n))
            .withColumn(f"probability{sfx}", array_to_vector(F.transform(n, lambda v: v / rows)))
            .withColumn(f"prediction{sfx}", (F.array_position(n, F.array_max(n)) - 1).cast("double"))
            .drop(f"_n{sfx}")
        )


class DeepTree(Estimator, HasFeaturesCol, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    """A decision tree by the library's rules whose size does not bind the driver's work."""

    maxDepth = Param(Params._dummy(), "maxDepth", "maximum depth", TypeConverters.toInt)
    minSamplesLeaf = Param(Params._dummy(), "minSamplesLeaf", "rows of a leaf", TypeConverters.toInt)
    problem = Param(Params._dummy(), "problem", "classification or regression", TypeConverters.toString)
    suffix = Param(Params._dummy(), "suffix", "suffix of output columns", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", maxDepth=30, minSamplesLeaf=1, problem="classification", suffix=""):
        super().__init__()
        self._setDefault(maxDepth=30, minSamplesLeaf=1, problem="classification", suffix="")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> DeepTreeModel:
        from tabloom.operators.trees import Prepared

        prepared = Prepared(df, self.getFeaturesCol(), self.getLabelCol())
        model = self.fit_prepared(prepared)
        prepared.done()
        return model

    def fit_prepared(self, prepared) -> DeepTreeModel:
        at, size, y = self.getOrDefault, prepared.size, F.col("y")
        n, unfit, top = prepared.once("labels", lambda: prepared.rows.agg(
            F.count(F.lit(1)), F.count_if(y.isNull() | F.isnan(y)),
            F.max(F.when((y < 0) | (y != F.floor(y)), F.lit(float("nan"))).otherwise(y)),
        ).first())
        grouped = at("problem") == "classification"
        if unfit or (grouped and not 0 <= top < 100):
            raise ValueError("labels must be numbers; those of classes whole, from 0 and below 100")
        classes = int(top) + 1 if grouped else 0
        edges = prepared.edges(library_edges)
        tree = grow_deep(prepared.codes(library_edges), n, size, edges, Rules(at("maxDepth"), at("minSamplesLeaf"), classes))
        tree.pop("root", None)
        return DeepTreeModel.of(tree, edges, featuresCol=self.getFeaturesCol(), classes=classes, suffix=at("suffix"))
