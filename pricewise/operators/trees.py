"""Regression trees, forests and boosted trees grown level by level over blocks of binned rows.

MLlib walks each row's object through each level of each tree and shuffles a histogram of every
node from every partition at every depth. Here the rows' bins, a byte each, are packed once into
cached blocks; a level is one pass of NumPy counts over them, whose sums Spark adds up by node, and
nodes that have become small get their rows together, so that a task grows what is below them.

Split candidates, gains, stops and pruning are MLlib's. So are the trees of single and boosted
trees, up to the order of sums (of features that part a node's rows equally well the first is taken).
A forest's draws of rows and features come from the seed too, but from NumPy's generators, so it is
another forest than MLlib draws from that seed. A node's features are drawn for the node, whatever
the depth limit: the tree of a smaller ``maxDepth`` is the upper part of that of a larger one, and
is taken from it."""

from __future__ import annotations

import gc
import json
import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressionModel,
                                   GBTRegressor, RandomForestRegressionModel, RandomForestRegressor)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_path

MODELS = {DecisionTreeRegressor: DecisionTreeRegressionModel, RandomForestRegressor: RandomForestRegressionModel,
          GBTRegressor: GBTRegressionModel}
#: Rows of a block.
BLOCK_ROWS = 16_384
#: Bytes of a level's histograms in a task, beyond which small nodes are left to a single task each.
LEVEL_BYTES = 32 << 20
#: Rows of the nodes that one group of the last step holds.
LOCAL_ROWS = 300_000
#: Nodes of one histogram: in a shuffle, and within a group.
CHUNK, LOCAL_CHUNK = 256, 1024
#: Rows of all trees that meet in one shuffle: its files are gone before the next one.
ROUND_ROWS = 250_000_000
#: Places of a table of the next node by node and bin (8 bytes each).
STEP_ENTRIES = 1 << 20
#: Gains of so little difference (as a share) are equal; smaller ones than this share of the labels'
#: mean square are rounding errors.
TIE, NOISE = 1e-9, 1e-14
MAX_BINS = 256


def by_levels(est, param_map: dict | None, rows: DataFrame) -> bool:
    """Whether ``fit_trees`` fits this estimator on ``rows``; what else there is goes to MLlib."""
    if type(est) not in MODELS:
        return False
    e = est.copy(param_map or {})
    if (e.getMinInstancesPerNode() != 1 or e.getMinWeightFractionPerNode() != 0.0 or e.isDefined("weightCol")
            or not 2 <= e.getMaxBins() <= MAX_BINS or max(_categories(rows, e).values(), default=0) > e.getMaxBins()
            or not ensure_checkpoint_dir(rows.sparkSession)):
        return False
    if isinstance(e, DecisionTreeRegressor):
        return True
    if e.getSubsamplingRate() != 1.0:
        return False
    if isinstance(e, RandomForestRegressor):
        return (e.getBootstrap() and e.getNumTrees() > 1
                and e.getFeatureSubsetStrategy() in ("auto", "all", "onethird"))
    return (e.getLossType() == "squared" and not e.isDefined("validationIndicatorCol")
            and e.getFeatureSubsetStrategy() in ("auto", "all") and e.getMaxIter() <= 100)


def _categories(rows: DataFrame, est) -> dict[int, int]:
    """{slot: number of categories} of the nominal and binary slots."""
    attrs = rows.schema[est.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
    out = {a["idx"]: a.get("num_vals") or len(a.get("vals", [])) for a in attrs.get("nominal", []) if "idx" in a}
    return {**out, **{a["idx"]: 2 for a in attrs.get("binary", []) if "idx" in a}}


# ------------------------------------------------------------------ bins

@dataclass(frozen=True)
class Bins:
    """Per slot the thresholds between its bins, or the number of categories (0: continuous)."""
    thresholds: list
    arity: np.ndarray

    @property
    def splits(self) -> np.ndarray:
        return np.array([a - 1 if a else len(t) for t, a in zip(self.thresholds, self.arity)])

    @property
    def width(self) -> int:
        return int(self.splits.max()) + 1

    def of(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, np.uint8)
        for i, (t, a) in enumerate(zip(self.thresholds, self.arity)):
            if a and len(x) and not 0 <= x[:, i].min() <= x[:, i].max() < a:
                raise ValueError(f"slot {i} holds a category beyond its {a}")
            out[:, i] = x[:, i] if a else np.searchsorted(t, x[:, i], side="left")
        return out


def draw(rows: DataFrame, share: float, seed: int) -> DataFrame:
    """The sample of rows that MLlib takes."""
    session = rows.sparkSession
    drawn = rows._jdf.javaRDD().sample(False, share, seed)
    return DataFrame(session._jsparkSession.createDataFrame(drawn, rows._jdf.schema()), session)


def find_bins(rows: DataFrame, est, n_rows: int, drawn: Callable | None = None) -> Bins:
    """MLlib's split candidates, from the sample of rows that it takes: at most 65,536. ``drawn`` gives
    the sample of a share and seed where ``rows`` need not all be encoded for it."""
    limit = min(est.getMaxBins(), n_rows)
    share = min(1.0, max(limit * limit, 10_000) / n_rows)
    session = rows.sparkSession
    data = rows.select(est.getFeaturesCol())
    if share < 1.0:
        seed = session._jvm.org.apache.spark.util.random.XORShiftRandom(est.getSeed()).nextInt()
        data = drawn(share, seed) if drawn else draw(data, share, seed)
    sample = data.select(vector_to_array(est.getFeaturesCol()).alias("x")).toArrow().column("x").combine_chunks()
    x = sample.flatten().to_numpy(zero_copy_only=False).reshape(len(sample), -1)
    categories = _categories(rows, est)
    arity = np.array([categories.get(i, 0) for i in range(x.shape[1])])
    return Bins([None if a else _thresholds(x[:, i], limit - 1, share * n_rows) for i, a in enumerate(arity)], arity)


def _thresholds(x: np.ndarray, splits: int, expected: float) -> np.ndarray:
    """Candidates for one slot. Zeros count by the expected size of the sample, as in MLlib."""
    values, counts = np.unique(x[x != 0], return_counts=True)
    counts = counts.astype(float)
    zeros = expected - counts.sum()
    if zeros > np.finfo(float).eps * len(x) * 100:
        at = np.searchsorted(values, 0.0)
        values, counts = np.insert(values, at, 0.0), np.insert(counts, at, zeros)
    middles = (values[:-1] + values[1:]) / 2.0
    if len(middles) <= splits:
        return middles
    stride = expected / (splits + 1)
    out, target, so_far = [], stride, counts[0]
    for i in range(1, len(values)):
        before, so_far = so_far, so_far + counts[i]
        if abs(before - target) < abs(so_far - target):
            out.append(middles[i - 1])
            target += stride
    return np.array(out)


def _packer(bins: Sequence[Bins], trees: int, seed: int):
    """Blocks of rows: bins row by row by each of ``bins``, labels, and for a forest how often each tree draws the row."""
    def block(parts: list, draws) -> pa.RecordBatch:
        x, y = (np.concatenate(p) for p in zip(*parts))
        if np.isnan(y).any() or not np.isfinite(x).all():
            raise ValueError("labels and features must be numbers, features finite")
        drawn = draws.poisson(1.0, (len(y), trees)).astype(np.uint8).tobytes() if trees else b""
        fields = [*(b.of(x).tobytes() for b in bins), y.astype("<f8").tobytes(), drawn]
        return pa.RecordBatch.from_arrays([pa.array([f], pa.binary()) for f in fields],
                                          [*(f"x{i}" for i in range(len(bins))), "y", "drawn"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draws = np.random.default_rng([seed & (2 ** 64 - 1), TaskContext.get().partitionId()])
        parts: list = []
        for b in batches:
            if b.num_rows:
                x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                parts.append((x, b.column("y").to_numpy(zero_copy_only=False)))
                if sum(len(y) for _, y in parts) >= BLOCK_ROWS:
                    yield block(parts, draws)
                    parts = []
        if parts:
            yield block(parts, draws)
    return run


def _blocks(rows: DataFrame, est, bins: Sequence[Bins], trees: int) -> RDD:
    """(bins by each of ``bins``, labels, draws) of blocks of rows, cached."""
    packed = rows.select(F.col(est.getLabelCol()).cast("double").alias("y"),
                         vector_to_array(est.getFeaturesCol()).alias("x")) \
        .mapInArrow(_packer(bins, trees, est.getSeed()), "".join(f"x{i} binary, " for i in range(len(bins))) + "y binary, drawn binary")
    return packed.rdd.map(lambda r: tuple(map(bytes, r))).persist(StorageLevel.MEMORY_AND_DISK)


# ------------------------------------------------------------------ trees

@dataclass
class Tree:
    """Nodes by number, the root first, children after their parent and next to each other. ``left``
    is -1 in a leaf; ``right`` packs a bit for each bin that goes right; ``stats`` are the
    number, sum and squares of the labels."""
    left: np.ndarray
    feature: np.ndarray
    right: np.ndarray
    depth: np.ndarray
    gain: np.ndarray
    stats: np.ndarray

    @staticmethod
    def leaves(depth: np.ndarray, width: int) -> Tree:
        n = len(depth)
        return Tree(np.full(n, -1), np.zeros(n, int), np.zeros((n, (width + 7) // 8), np.uint8),
                    np.asarray(depth), np.full(n, -1.0), np.zeros((n, 3)))

    def add(self, other: Tree) -> None:
        for name, value in vars(other).items():
            setattr(self, name, np.concatenate([getattr(self, name), value]))

    def split(self, nodes: np.ndarray, found: Found, width: int) -> np.ndarray:
        """Record what was found for ``nodes``; the numbers of the new children."""
        self.stats[nodes] = found.stats
        cut = nodes[found.gain > 0]
        self.gain[cut] = found.gain[found.gain > 0]
        self.feature[cut] = found.feature[found.gain > 0]
        self.right[cut] = found.right[found.gain > 0]
        self.left[cut] = len(self.left) + 2 * np.arange(len(cut))
        children = len(self.left) + np.arange(2 * len(cut))
        self.add(Tree.leaves(np.repeat(self.depth[cut] + 1, 2), width))
        return children

    def router(self, width: int) -> tuple:
        """Arrays to send rows down: the next node by node and bin, or of a large tree the left child
        and a bit for each bin. A leaf's rows stay."""
        inner = self.left >= 0
        left = np.where(inner, self.left, np.arange(len(inner)))
        right = np.where(inner[:, None], self.right, np.uint8(0))
        depth = int(self.depth.max())
        if len(left) * width > STEP_ENTRIES:
            return left, self.feature, right, depth
        return (left[:, None] + np.unpackbits(right, axis=1, count=width)).ravel(), self.feature, None, depth


def route(x: np.ndarray, router: tuple, width: int, stops: Sequence[int] = ()) -> list[np.ndarray]:
    """Each row's node after every number of steps in ``stops``, or at the end."""
    following, feature, right, depth = router
    flat, start = x.ravel(), np.arange(len(x)) * x.shape[1]
    if right is not None:
        bytes_, byte, bit = right.shape[1], flat >> 3, np.uint8(128) >> (flat & np.uint8(7))
        right = right.ravel()
    node, after = np.zeros(len(x), int), {}
    for step in range(max(stops, default=depth) + 1):
        after[step] = node
        if step < depth:
            at = start + feature.take(node)
            if right is None:
                node = following.take(node * width + flat.take(at))
            else:
                node = following.take(node) + ((right.take(node * bytes_ + byte.take(at)) & bit.take(at)) != 0)
    return [after[k] for k in stops or [depth]]


@dataclass
class Found:
    """Best split of some nodes; gain -1: none."""
    stats: np.ndarray
    gain: np.ndarray
    feature: np.ndarray
    right: np.ndarray
    rows: np.ndarray       # of both children


def count(x, y, w, slot, picked: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Histograms (feature, number or sum, node, bin) and totals of the rows' nodes. ``picked`` holds
    each node's features."""
    m, k = picked.shape
    wy = y if w is None else w * y
    totals = np.column_stack([np.bincount(slot, v, m) for v in (w, wy, wy * y)])
    out = np.empty((k, 2, m, width))
    everyone = k == x.shape[1]
    flat, start = x.ravel(), None if everyone else np.arange(len(x)) * x.shape[1]
    row = slot * width
    for j in range(k):
        at = row + (x[:, j] if everyone else flat.take(start + picked[:, j].take(slot)))
        out[j, 0] = np.bincount(at, w, m * width).reshape(m, width)
        out[j, 1] = np.bincount(at, wy, m * width).reshape(m, width)
    return out, totals


def best_splits(sums: np.ndarray, totals: np.ndarray, picked: np.ndarray, bins: Bins, min_gain: float) -> Found:
    """MLlib's choice: the largest gain over each feature's cuts in the order of its bins, of a
    categorical feature in the order of their mean labels."""
    k, _, m, width = sums.shape
    n, total, squares = totals.T
    n = np.maximum(n, 1.0)   # a forest's tree may draw no row
    best = Found(totals, np.full(m, -1.0), np.zeros(m, int), np.zeros((m, (width + 7) // 8), np.uint8), np.zeros((m, 2)))
    impurity = (squares - total * total / n) / n
    floor = NOISE * squares / n
    open_ = impurity > np.maximum(floor, np.finfo(float).eps)
    splits, place, every = bins.splits, np.arange(width), np.arange(m)
    base = total * total / n
    for j in range(k):
        f = picked[:, j]
        number, labels = sums[j]
        nominal = np.flatnonzero(bins.arity[f] > 0)
        if len(nominal):
            counts, means = number[nominal], labels[nominal]
            with np.errstate(divide="ignore", invalid="ignore"):
                order = np.argsort(np.where(counts > 0, means / counts, np.inf), axis=1, kind="stable")
            number, labels = number.copy(), labels.copy()
            number[nominal] = np.take_along_axis(counts, order, 1)
            labels[nominal] = np.take_along_axis(means, order, 1)
        nl, sl = np.cumsum(number, axis=1), np.cumsum(labels, axis=1)
        nr, sr = n[:, None] - nl, total[:, None] - sl
        closed = nl < 0.5
        closed |= nr < 0.5
        closed |= place >= splits[f][:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            sl *= sl
            sl /= nl
            sr *= sr
            sr /= nr
            sl += sr
            sl -= base[:, None]
        sl[closed] = -np.inf
        cut = sl.argmax(axis=1)
        top = np.maximum(sl[every, cut] / n, -1.0)
        better = np.flatnonzero(open_ & (top > floor) & (top >= min_gain) & (top * (1 - TIE) > best.gain))
        best.gain[better], best.feature[better] = top[better], f[better]
        right = place > cut[better][:, None]
        if len(nominal):
            of = np.full(m, -1)
            of[nominal] = np.arange(len(nominal))
            own = np.flatnonzero(of[better] >= 0)
            moved = np.zeros((len(own), width), bool)
            np.put_along_axis(moved, order[of[better[own]]], right[own], 1)
            right[own] = moved
        best.right[better] = np.packbits(right, axis=1)
        best.rows[better] = np.column_stack([nl[better, cut[better]], nr[better, cut[better]]])
    return best


@dataclass(frozen=True)
class Plan:
    """How trees are grown."""
    bins: Bins
    slots: int             # features
    picks: int             # of them for a node
    depth: int
    min_gain: float
    seed: int

    @property
    def width(self) -> int:
        return self.bins.width

    def pick(self, tree: int, path: np.ndarray) -> np.ndarray:
        """Features of the nodes: all, or as many as drawn by a hash of seed, tree and path."""
        if self.picks == self.slots:
            return np.broadcast_to(np.arange(self.slots), (len(path), self.slots))
        key = _mix(path ^ _mix(np.array([(self.seed * 1_000_003 + tree) % 2 ** 64], np.uint64)))
        key = _mix(key[:, None] + np.arange(self.slots, dtype=np.uint64))
        return np.sort(np.argsort(key, axis=1, kind="stable")[:, :self.picks], axis=1)


def _mix(z: np.ndarray) -> np.ndarray:
    """SplitMix64."""
    z = z + np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _rows_of(block: tuple, plan: Plan, trees: Sequence[int]) -> Iterator[tuple]:
    """(tree, bins, labels, weights or None) of a block, for each of ``trees``."""
    x, y = np.frombuffer(block[0], np.uint8).reshape(-1, plan.slots), np.frombuffer(block[1], "<f8")
    drawn = np.frombuffer(block[2], np.uint8).reshape(len(y), -1) if block[2] else None
    for t in trees:
        if drawn is None:
            yield t, x, y, None
        else:
            times = drawn[:, t]
            own = np.flatnonzero(times)
            yield t, x.take(own, axis=0), y.take(own), times.take(own).astype(float)


def _level(blocks: RDD, plan: Plan, routers: list, opened: list, picked: list) -> dict:
    """{(tree, chunk of its open nodes): Found}: histograms per task, added up by chunk."""
    shared = blocks.ctx.broadcast((plan, routers, opened, picked))

    def sums(part: Iterable[tuple]) -> Iterator[tuple]:
        plan, routers, opened, picked = shared.value
        acc: dict = {}
        for block in part:
            for t, x, y, w in _rows_of(block, plan, [t for t, o in enumerate(opened) if len(o)]):
                slots = np.full(len(routers[t][1]), -1)
                slots[opened[t]] = np.arange(len(opened[t]))
                slot = slots.take(route(x, routers[t], plan.width)[0])
                if slot.min(initial=0) < 0:
                    own = np.flatnonzero(slot >= 0)
                    x, y, slot = x.take(own, axis=0), y.take(own), slot.take(own)
                    w = None if w is None else w.take(own)
                new = count(x, y, w, slot, picked[t], plan.width)
                if t in acc:
                    for a, b in zip(acc[t], new):
                        a += b
                else:
                    acc[t] = new
        for t, (hist, totals) in acc.items():
            for c in range(0, len(totals), CHUNK):
                yield (t, c), (hist[:, :, c:c + CHUNK], totals[c:c + CHUNK])

    def best(item: tuple) -> tuple:
        (t, c), (hist, totals) = item
        plan, _, _, picked = shared.value
        return (t, c), best_splits(hist, totals, picked[t][c:c + CHUNK], plan.bins, plan.min_gain)

    tasks = min(sum(-(-len(o) // CHUNK) for o in opened), blocks.ctx.defaultParallelism)
    try:
        # a row for each chunk of nodes
        return dict(blocks.mapPartitions(sums).reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1]), tasks)
                    .map(best).collect())
    finally:
        shared.unpersist()


def grow(blocks: RDD, plan: Plan, trees: int = 1) -> list[Tree]:
    """Trees on all rows of the blocks, level by level."""
    width = plan.width
    grown = [Tree.leaves(np.zeros(1, int), width) for _ in range(trees)]
    paths = [np.ones(1, np.uint64) for _ in range(trees)]   # 1, then a bit for each step
    opened = [np.zeros(1, int) for _ in range(trees)]
    rows = [np.full(1, np.inf) for _ in range(trees)]
    small: list = [[] for _ in range(trees)]
    while any(len(o) for o in opened):
        if sum(len(o) for o in opened) * plan.picks * width * 16 > LEVEL_BYTES:
            for t in range(trees):
                few = rows[t] <= LOCAL_ROWS
                small[t].append((opened[t][few], rows[t][few]))
                opened[t], rows[t] = opened[t][~few], rows[t][~few]
            if not any(len(o) for o in opened):
                break
        at_end = [bool(len(o)) and grown[t].depth[o[0]] >= plan.depth for t, o in enumerate(opened)]
        picked = [np.empty((len(o), 0), int) if end else plan.pick(t, paths[t][o])
                  for t, (o, end) in enumerate(zip(opened, at_end))]
        found = _level(blocks, plan, [g.router(width) for g in grown], opened, picked)
        for t, o in enumerate(opened):
            children, after = [], []
            for c in range(0, len(o), CHUNK):
                here = found[t, c]
                children.append(grown[t].split(o[c:c + CHUNK], here, width))
                after.append(here.rows[here.gain > 0].ravel())
            opened[t] = np.concatenate(children) if children else o
            rows[t] = np.concatenate(after) if after else np.empty(0)
            paths[t] = _paths(grown[t], paths[t])
    if any(len(nodes) for part in small for nodes, _ in part):
        below = [tuple(np.concatenate(p) for p in zip(*parts)) if parts else (np.empty(0, int), np.empty(0)) for parts in small]
        for own in _rounds([n.sum() for _, n in below]):
            _finish(blocks, plan, grown, paths, below, own)
            # what the round has shuffled is let go of, so that its files are deleted
            gc.collect()
            blocks.ctx._jvm.System.gc()
    return grown


def _rounds(rows: Sequence[float]) -> Iterator[list[int]]:
    """Trees in groups of at most ``ROUND_ROWS`` rows, or one tree of more."""
    own: list[int] = []
    for t, n in enumerate(rows):
        if own and n + sum(rows[i] for i in own) > ROUND_ROWS:
            yield own
            own = []
        if n:
            own.append(t)
    if own:
        yield own


def _paths(tree: Tree, known: np.ndarray) -> np.ndarray:
    """Paths of all nodes, of which the first are known."""
    out = np.concatenate([known, np.zeros(len(tree.left) - len(known), np.uint64)])
    parents = np.flatnonzero(tree.left >= len(known))
    for side in (0, 1):
        out[tree.left[parents] + side] = out[parents] * np.uint64(2) + np.uint64(side)
    return out


def _fields(bins: Bins) -> list[tuple[int, int]] | None:
    """(place, bits) of each slot's bin in a word of 64 bits, if they fit."""
    bits = [max(1, int(n).bit_length()) for n in bins.splits]
    return list(zip(np.cumsum([0, *bits[:-1]]).tolist(), bits)) if sum(bits) <= 64 else None


def _to_words(x: np.ndarray, fields: list | None) -> np.ndarray:
    """Rows' bins in as few bytes as hold them."""
    if fields is None:
        return x
    words = np.zeros(len(x), "<u8")
    for j, (place, _) in enumerate(fields):
        words |= x[:, j].astype("<u8") << np.uint64(place)
    return words.view(np.uint8).reshape(-1, 8)[:, :-(-sum(fields[-1]) // 8)]


def _from_words(x: np.ndarray, fields: list | None) -> np.ndarray:
    if fields is None:
        return x
    words = np.zeros((len(x), 8), np.uint8)
    words[:, :x.shape[1]] = x
    words = words.view("<u8").ravel()
    return np.stack([(words >> np.uint64(place)).astype(np.uint8) & np.uint8((1 << bits) - 1) for place, bits in fields], axis=1)


def _order(keys: np.ndarray) -> np.ndarray:
    """Stable order of numbers from 0 on; of few by radix sort."""
    return np.argsort(keys.astype(np.uint16) if keys.max(initial=0) < 65_536 else keys, kind="stable")


def _finish(blocks: RDD, plan: Plan, grown: list[Tree], paths: list, small: list, trees: list[int]) -> None:
    """Grow what is below the small nodes of ``trees``: their rows meet in groups of about ``LOCAL_ROWS``."""
    group_of, before = {}, 0.0
    for t in trees:
        nodes, rows = small[t]
        own = np.full(len(grown[t].left), -1)
        own[nodes] = (before + np.cumsum(rows) - rows) // LOCAL_ROWS
        before += rows.sum()
        group_of[t] = own
    width, fields = plan.width, _fields(plan.bins)
    shared = blocks.ctx.broadcast((plan, {t: (grown[t].router(width), grown[t].depth, paths[t]) for t in trees}, group_of))

    def scatter(block: tuple) -> Iterator[tuple]:
        plan, known, group_of = shared.value
        for t, x, y, w in _rows_of(block, plan, list(known)):
            node = route(x, known[t][0], plan.width)[0]
            own = np.flatnonzero(group_of[t].take(node) >= 0)
            own = own.take(_order(node.take(own)))
            node, x, y = node.take(own), _to_words(x.take(own, axis=0), fields), y.take(own)
            w = None if w is None else w.take(own).astype(np.uint8)
            # rows by node, and nodes by group
            starts = np.flatnonzero(np.diff(node, prepend=-1))
            sizes, node = np.diff(starts, append=len(own)), node.take(starts)
            group = group_of[t].take(node)
            for g in np.unique(group):
                at = np.flatnonzero(group == g)
                rows = slice(starts[at[0]], starts[at[-1]] + sizes[at[-1]])
                yield int(g), (t, node[at].astype(np.int32), sizes[at].astype(np.int32), x[rows], y[rows], None if w is None else w[rows])

    def below(parts: Iterable[tuple]) -> Iterator[tuple]:
        plan, known, _ = shared.value
        groups: dict = {}
        for g, (t, *arrays) in parts:
            groups.setdefault((g, t), []).append(arrays)
        for key in sorted(groups):
            pieces, t = groups.pop(key), key[1]
            node, sizes, x, y = (np.concatenate(p) for p in list(zip(*pieces))[:4])
            w = np.ones(len(y)) if pieces[0][4] is None else np.concatenate([p[4] for p in pieces]).astype(float)
            roots, slot = np.unique(node, return_inverse=True)
            _, depth, paths = known[t]
            yield t, roots, grow_local(plan, t, _from_words(x, fields), y, w, np.repeat(slot, sizes), depth[roots], paths[roots])

    n_groups = int(before // LOCAL_ROWS) + 1
    tasks = min(n_groups, max(blocks.getNumPartitions(), -(-n_groups // 4)))
    try:
        # nodes of the trees, which are the model
        for t, roots, part in blocks.flatMap(scatter).partitionBy(tasks, int).mapPartitions(below).collect():
            tree, k = grown[t], len(roots)
            left = np.where(part.left < 0, -1, part.left - k + len(tree.left))
            for name in ("feature", "right", "gain", "stats"):
                getattr(tree, name)[roots] = getattr(part, name)[:k]
            tree.left[roots] = left[:k]
            tree.add(Tree(left[k:], *(getattr(part, name)[k:] for name in ("feature", "right", "depth", "gain", "stats"))))
    finally:
        shared.unpersist()


def grow_local(plan: Plan, t: int, x, y, w, slot, depth, paths) -> Tree:
    """What is below some nodes, from all their rows: the nodes themselves come first."""
    width = plan.width
    tree, nodes = Tree.leaves(depth, width), np.arange(len(depth))
    node = slot
    while len(nodes):
        order = _order(node - nodes[0])
        x, y, w, node = x.take(order, axis=0), y.take(order), w.take(order), node.take(order)
        children, kept = [], []
        for c in range(0, len(nodes), LOCAL_CHUNK):
            chunk = nodes[c:c + LOCAL_CHUNK]
            a, b = np.searchsorted(node, [chunk[0], chunk[-1] + 1])
            xs, ys, ws, at = x[a:b], y[a:b], w[a:b], node[a:b]
            local = at - chunk[0]
            over = tree.depth[chunk] >= plan.depth
            found = best_splits(*count(xs, ys, ws, local, (picked := plan.pick(t, paths[chunk])), width), picked,
                                plan.bins, plan.min_gain)
            found.gain[over] = -1.0
            children.append(tree.split(chunk, found, width))
            paths = _paths(tree, paths)
            own = np.flatnonzero((found.gain > 0).take(local))
            local = local.take(own)
            right = np.unpackbits(found.right, axis=1, count=width).ravel()
            bin_ = xs.ravel().take(own * xs.shape[1] + found.feature.take(local))
            kept.append((a + own, tree.left[chunk].take(local) + right.take(local * width + bin_)))
        rows, node = (np.concatenate(p) for p in zip(*kept))
        x, y, w = x.take(rows, axis=0), y.take(rows), w.take(rows)
        nodes = np.concatenate(children)
    return tree


# ------------------------------------------------------------------ boosting

def boost(blocks: RDD, plan: Plan, iterations: int, step: float, first: Tree | None = None, last: bool = False) -> list[Tree]:
    """Trees on the residuals of those before, as MLlib takes them: the first on the labels, with
    weight 1, the others with weight ``step`` on twice the residual. ``first``: that tree, where it is
    known. After the ``last`` use of the blocks they make room."""
    trees, width, state = [], plan.width, blocks
    for i in range(iterations):
        trees += grow(state, plan) if i or first is None else [first]
        if i + 1 == iterations:
            break
        shared = blocks.ctx.broadcast((trees[-1].router(width), _predictions(trees[-1]), 1.0 if i == 0 else step))

        def residuals(block: tuple, shared=shared, first=i == 0) -> tuple:
            router, predicted, weight = shared.value
            x = np.frombuffer(block[0], np.uint8).reshape(-1, plan.slots)
            y = np.frombuffer(block[1], "<f8")
            left = y if first else y / 2.0
            left = left - weight * predicted.take(route(x, router, width)[0])
            return block[0], (2.0 * left).tobytes(), b""
        before, state = state, state.map(residuals).persist(StorageLevel.MEMORY_AND_DISK)
        state.count()
        if before is not blocks or last:
            before.unpersist()
    if state is not blocks:
        state.unpersist()
    return trees


def _predictions(tree: Tree) -> np.ndarray:
    return tree.stats[:, 1] / np.maximum(tree.stats[:, 0], 1.0)   # 0 in a tree that drew no row


# ------------------------------------------------------------------ models

def cut_back(tree: Tree, depth: int) -> Tree:
    """The tree of a smaller depth limit, with sibling leaves of one prediction taken back (as
    MLlib does), its nodes numbered anew."""
    left = np.where(tree.depth < depth, tree.left, -1)
    value = _predictions(tree)
    for d in range(min(depth, int(tree.depth.max())) - 1, -1, -1):
        at = np.flatnonzero((tree.depth == d) & (left >= 0))
        a, b = left[at], left[at] + 1
        left[at[(left[a] < 0) & (left[b] < 0) & (value[a] == value[b])]] = -1
    kept = np.zeros(len(left), bool)
    kept[0] = True
    for d in range(min(depth, int(tree.depth.max()))):
        at = left[np.flatnonzero((tree.depth == d) & kept & (left >= 0))]
        kept[at] = kept[at + 1] = True
    number = np.cumsum(kept) - 1
    left = np.where(left >= 0, number[left], -1)[kept]
    return Tree(left, *(getattr(tree, name)[kept] for name in ("feature", "right", "depth", "gain", "stats")))


def _node_table(trees: Sequence[Tree], bins: Bins) -> pa.Table:
    """MLlib's stored form of nodes."""
    cols: dict = {k: [] for k in ("tree", "left", "feature", "gain", "stats", "cuts", "sizes", "kinds")}
    position, limits = np.arange(bins.width), np.zeros((len(bins.arity), bins.width))
    for i, t in enumerate(bins.thresholds):
        if t is not None:
            limits[i, :len(t)] = t
    for t, tree in enumerate(trees):
        inner = tree.left >= 0
        arity = np.where(inner, bins.arity[tree.feature], 0)[:, None]
        to_left = np.unpackbits(tree.right, axis=1, count=bins.width) == 0
        # the categories that go left, or in the first place the threshold of the last bin that does
        given = np.where(arity > 0, to_left & (position < arity), inner[:, None] & (position == 0))
        limit = limits[tree.feature, to_left.sum(axis=1) - 1]
        own = {"tree": np.full(len(inner), t), "left": tree.left, "feature": np.where(inner, tree.feature, -1),
               "gain": np.where(inner, tree.gain, -1.0), "stats": tree.stats,
               "cuts": np.where(arity > 0, position, limit[:, None])[given], "sizes": given.sum(axis=1),
               "kinds": np.where(arity > 0, arity, -1)[:, 0]}
        for name, values in own.items():
            cols[name].append(values)
    number = np.concatenate([np.arange(len(t.left)) for t in trees])
    tree, left, feature, gain, stats, sizes, kinds = (np.concatenate(cols[k]) for k in (
        "tree", "left", "feature", "gain", "stats", "sizes", "kinds"))
    n, total, squares = stats.T
    ints, right = (lambda v: pa.array(v.astype(np.int32))), np.where(left >= 0, left + 1, -1)
    cuts = pa.ListArray.from_arrays(ints(np.concatenate([[0], np.cumsum(sizes)])), pa.array(np.concatenate(cols["cuts"])))
    some = np.maximum(n, 1.0)
    impurity = np.maximum((squares - total * total / some) / some, 0.0)
    per_node = pa.ListArray.from_arrays(ints(np.arange(len(n) + 1) * 3), pa.array(stats.ravel()))
    split = pa.StructArray.from_arrays([ints(feature), cuts, ints(kinds)],
                                       ["featureIndex", "leftCategoriesOrThreshold", "numCategories"])
    node = {"id": ints(number), "prediction": pa.array(total / some), "impurity": pa.array(impurity),
            "impurityStats": per_node, "rawCount": pa.array(n.astype(np.int64)), "gain": pa.array(gain),
            "leftChild": ints(left), "rightChild": ints(right), "split": split}
    return pa.table({"treeID": ints(tree), "nodeData": pa.StructArray.from_arrays(list(node.values()), list(node))})


def to_model(rows: DataFrame, est, plan: Plan, trees: Sequence[Tree], weights: Sequence[float]):
    """MLlib's model of these trees, by its stored form, which its reader takes from the shared folder."""
    spark = rows.sparkSession
    path = scratch_path(spark, "trees")
    kind = MODELS[type(est)]

    def meta(cls: str, uid: str, **more) -> str:
        return json.dumps({"class": f"org.apache.spark.ml.regression.{cls}", "timestamp": int(time.time() * 1000),
                           "sparkVersion": spark.version, "uid": uid, "paramMap": {}, "defaultParamMap": {"impurity": "variance"},
                           "numFeatures": plan.slots, **more})
    many = kind is not DecisionTreeRegressionModel
    spark.createDataFrame([(meta(kind.__name__, est.uid, **({"numTrees": len(trees)} if many else {})),)], "value string") \
        .coalesce(1).write.text(f"{path}/metadata")
    nodes = spark.createDataFrame(_node_table(trees, plan.bins))
    (nodes if many else nodes.select("nodeData.*")).write.parquet(f"{path}/data")
    if many:
        own = [(t, meta("DecisionTreeRegressionModel", f"{est.uid}_{t}"), float(w)) for t, w in enumerate(weights)]
        spark.createDataFrame(own, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    return est._copyValues(kind.load(path))


# ------------------------------------------------------------------ fits

@dataclass
class Grown:
    """A fitted candidate: its trees, which go down to ``plan.depth`` at least, and their weights."""
    est: object
    plan: Plan
    trees: list
    weights: list

    @property
    def size(self) -> int:
        return sum(len(t.left) for t in self.trees)

    def to_model(self, rows: DataFrame):
        """MLlib's model, which keeps these trees to be scored with (``score_trees``)."""
        model = to_model(rows, self.est, self.plan, [cut_back(t, self.plan.depth) for t in self.trees], self.weights)
        model._grown = self
        return model


def fit_trees(rows: DataFrame, cands: Sequence[tuple]) -> list:
    """The model of every (estimator, map)."""
    return [g.to_model(rows) for g in grow_trees(rows, cands)]


def grow_trees(rows: DataFrame, cands: Sequence[tuple], release: Callable | None = None,
               drawn: Callable | None = None) -> list[Grown]:
    """The trees of every (estimator, map). Bins and blocks are made once for those that share them,
    and of single trees and forests that differ by ``maxDepth`` only the deepest is grown.
    ``release`` is called when ``rows`` are read for the last time; ``drawn``: see ``find_bins``."""
    ests = [est.copy(pm or {}) for est, pm in cands]
    n_rows = rows.count()
    out: list = [None] * len(ests)
    groups: dict = {}
    for i, e in enumerate(ests):
        trees = e.getNumTrees() if isinstance(e, RandomForestRegressor) else 0
        groups.setdefault((e.getSeed(), trees, e.getFeaturesCol(), e.getLabelCol()), []).append(i)
    for left, ((_, trees, _, _), members) in zip(range(len(groups) - 1, -1, -1), groups.items()):
        by_bins = {ests[i].getMaxBins(): ests[i] for i in members}
        found = {m: find_bins(rows, e, n_rows, drawn) for m, e in by_bins.items()}
        blocks = _blocks(rows, ests[members[0]], list(found.values()), trees)
        try:
            if release and not left:
                blocks.count()
                release()
            for at, (max_bins, bins) in enumerate(found.items()):
                own = blocks if len(found) == 1 else blocks.map(lambda r, at=at: (r[at], *r[-2:]))
                for i, grown in _fit_on(own, bins, {i: ests[i] for i in members if ests[i].getMaxBins() == max_bins}, trees,
                                        len(found) == 1):
                    out[i] = grown
        finally:
            blocks.unpersist()
    return out


def _fit_on(blocks: RDD, bins: Bins, ests: dict, trees: int, alone: bool) -> Iterator[tuple]:
    """(key, grown) of estimators that share blocks; ``alone``: nothing else reads these."""
    slots, grown = len(bins.arity), {}
    for left, (i, e) in zip(range(len(ests) - 1, -1, -1), sorted(ests.items(), key=lambda item: -item[1].getMaxDepth())):
        third = trees and e.getFeatureSubsetStrategy() in ("auto", "onethird")
        plan = Plan(bins, slots, -(-slots // 3) if third else slots, e.getMaxDepth(), e.getMinInfoGain(), e.getSeed())
        alike = (type(e), plan.picks, plan.min_gain)
        if isinstance(e, GBTRegressor):
            # the first tree is on the labels: that of a smaller depth is the upper part of a deeper one
            first = cut_back(grown[alike], plan.depth) if alike in grown else None
            own = boost(blocks, plan, e.getMaxIter(), e.getStepSize(), first, alone and not left)
            grown.setdefault(alike, own[0])
            weights = [1.0] + [e.getStepSize()] * (len(own) - 1)
        else:
            if alike not in grown:
                grown[alike] = grow(blocks, plan, trees or 1)
            own, weights = grown[alike], [1.0] * (trees or 1)
        yield i, Grown(e, plan, own, weights)


# ------------------------------------------------------------------ scores

def score_trees(rows: DataFrame, label: str, grown: Sequence[Grown], names: Sequence[str]) -> DataFrame:
    """``label`` and the predictions of ``grown`` in columns of these names. Rows go down a tree that
    candidates of several depths share once."""
    features = grown[0].est.getFeaturesCol()
    sets: dict = {}   # trees that several candidates share, by the bins
    for i, g in enumerate(grown):
        sets.setdefault((id(g.plan.bins), id(g.trees)), []).append(i)
    routes = [(grown[own[0]].plan.bins, [(t.router(grown[own[0]].plan.width), _predictions(t)) for t in grown[own[0]].trees],
               [(i, grown[i].plan.depth, grown[i].weights, isinstance(grown[i].est, RandomForestRegressor)) for i in own])
              for own in sets.values()]
    shared = rows.sparkSession.sparkContext.broadcast(routes)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            out = np.zeros((len(names), len(x)))
            for bins, trees, candidates in shared.value:
                binned = bins.of(x)
                stops = sorted({depth for _, depth, _, _ in candidates})
                for t, (router, predicted) in enumerate(trees):
                    ends = dict(zip(stops, route(binned, router, bins.width, stops)))
                    for i, depth, weights, mean in candidates:
                        out[i] += weights[t] / (len(trees) if mean else 1) * predicted.take(ends[depth])
            yield pa.RecordBatch.from_arrays([b.column("y"), *map(pa.array, out)], ["y", *names])

    scored = rows.select(F.col(label).cast("double").alias("y"), vector_to_array(features).alias("x")) \
        .mapInArrow(run, "y double, " + ", ".join(f"`{n}` double" for n in names))
    return scored.withColumnRenamed("y", label)
