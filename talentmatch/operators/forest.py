"""Random forests and boosted trees that are grown in tasks and never stand on the driver (L2, L3).

A deep forest is large: a tree has about as many nodes as training rows of the rarer class. Here a
task holds the training rows as bins (a byte a feature) and grows whole trees from them, level by
level; a tree is a row of a table under the scratch folder, and stays there. Scoring sends the asked
rows, as bins, to the trees.

The trees are those of ``pyspark.ml``'s forest: Poisson bootstrap, gini, up to 32 bins a feature,
``sqrt`` features drawn for each node, leaves where a drawn split gains nothing, children of equal
class merged. Bins are cut at quantiles of all rows. Equal rows travel once, with their number. The
draws of a tree depend on the seed and on the rows, not on how they are partitioned.

Boosted trees follow one from the other, so one task grows all of a fit; fits run side by side.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talentmatch.operators.vector_index import matrix
from talentmatch.session import checkpoint_root, scratch_path, ship_package

BINS = 32
#: Points by which a task tells the quantiles of a feature.
POINTS = 2000
PACK_ROWS = 4096
#: Bytes of binned rows that a task may hold.
TASK_BYTES = 256 << 20
#: Histogram cells that a task holds at a time.
_CELLS = 1 << 20
#: Leaves' shares are multiples of this, so that sums over trees are exact in any order.
_UNIT = 2.0 ** -40
_ROWS = "x binary, y int, w double, n long"
_TREES = "tree int, feature binary, bin binary, left binary, share binary"


# ---------------------------------------------------------------------------
# Bins
# ---------------------------------------------------------------------------

def _points(values: np.ndarray, weights: np.ndarray, most: int = POINTS) -> tuple[np.ndarray, np.ndarray]:
    """(value, weight) in order, equal values once; beyond ``most`` values those at so many quantiles."""
    order = np.argsort(values, kind="stable")
    values, weights = values[order], weights[order]
    first = np.flatnonzero(np.diff(values, prepend=np.nan) != 0)
    values, weights = values[first], np.add.reduceat(weights, first) if len(first) else weights
    if len(values) <= most:
        return values, weights
    up = np.cumsum(weights)
    at = np.searchsorted(up, up[-1] * (np.arange(most) + 1) / most).clip(max=len(up) - 1)
    at = np.unique(np.append(at, len(up) - 1))
    return values[at], np.diff(up[at], prepend=0)


def _cuts(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """At most ``BINS - 1`` thresholds between the values."""
    middles = (values[:-1] + values[1:]) / 2
    if len(values) <= BINS:
        return middles
    up = np.cumsum(weights)
    at = np.searchsorted(up, up[-1] * np.arange(1, BINS) / BINS)
    return middles[np.unique(at.clip(max=len(middles) - 1))]


def _sketched(batches):
    """One row a feature: the points of a task's rows."""
    held: list = []
    for batch in batches:
        x = matrix(batch.column("v"), len(batch.column("v")[0]) if batch.num_rows else 0)
        w = batch.column("w").to_numpy(zero_copy_only=False)
        for j in range(x.shape[1]):
            mine = ~np.isnan(x[:, j])
            new = x[mine, j], w[mine]
            if j == len(held):
                held.append(_points(*new))
            else:
                held[j] = _points(*(np.concatenate([a, b]) for a, b in zip(held[j], new, strict=True)))
    yield pa.RecordBatch.from_arrays([pa.array(range(len(held)), pa.int32()), pa.array([v for v, _ in held], pa.list_(pa.float64())),
                                      pa.array([w for _, w in held], pa.list_(pa.float64()))], ["feature", "points", "weights"])


def thresholds(rows: DataFrame) -> list[np.ndarray]:
    """The cuts of each feature, by all rows (v array<double>, w)."""
    told = rows.select("v", "w").mapInArrow(_sketched, "feature int, points array<double>, weights array<double>")
    table = told.toArrow()          # POINTS for each feature and task, as arrays
    parts: dict[int, list] = {}
    for i, j in enumerate(table.column("feature").to_pylist()):
        parts.setdefault(j, []).append(tuple(table.column(c)[i].values.to_numpy() for c in ("points", "weights")))
    return [_cuts(*_points(*(np.concatenate(x) for x in zip(*parts[j], strict=True)), POINTS * len(parts[j]))) for j in sorted(parts)]


def _bins(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    out = np.empty(x.shape, np.uint8)
    for j, c in enumerate(cuts):
        out[:, j] = np.searchsorted(c, x[:, j])
    return out


def _fixed(rows: np.ndarray) -> pa.Array:
    """Rows of bytes as a binary column."""
    rows = np.ascontiguousarray(rows)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(rows.shape[1]), len(rows), [None, pa.py_buffer(rows.tobytes())]).cast(pa.binary())


def _binned(cuts: list[np.ndarray]):
    def run(batches):
        for batch in batches:
            x = _bins(matrix(batch.column("v"), len(cuts)), cuts)
            yield pa.RecordBatch.from_arrays([_fixed(x), batch.column("y"), batch.column("w")], ["x", "y", "w"])
    return run


def _packed(columns: list[str]):
    """Rows in packs: a binary column for each of ``columns``."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, PACK_ROWS):
                part = batch.slice(at, PACK_ROWS)
                made = [b"".join(part.column(c).to_pylist()) if pa.types.is_binary(part.column(c).type) else part.column(c).to_numpy(zero_copy_only=False).tobytes()
                        for c in columns]
                yield pa.RecordBatch.from_arrays([pa.array([m], pa.binary()) for m in made], columns)
    return run


def _keys(spark: SparkSession, n: int) -> list[int]:
    """``n`` numbers that a repartition by them into ``n`` deals out one by one."""
    place = F.pmod(F.hash(F.col("id").cast("int")), F.lit(n))
    first = dict(spark.range(0, 64 * n, 1, 1).groupBy(place.alias("p")).agg(F.min("id")).collect())
    free = (i for i in range(64 * n) if i not in set(first.values()))
    return [int(first[p]) if p in first else next(free) for p in range(n)]


# ---------------------------------------------------------------------------
# Growing
# ---------------------------------------------------------------------------

def _best_splits(x: np.ndarray, rows: np.ndarray, node: np.ndarray, y: np.ndarray, w: np.ndarray, drawn: np.ndarray, k: int):
    """(feature, bin) of the best split of each node among its ``drawn`` features; feature -1 where none gains."""
    m = len(drawn)
    best, feature, bin_ = np.zeros(m), np.full(m, -1, np.int16), np.zeros(m, np.uint8)
    flat, at = x.ravel(), rows * x.shape[1]
    for j in range(drawn.shape[1]):
        f = drawn[:, j]
        cell = (y * m + node) * BINS + flat[at + f[node]]
        left = np.bincount(cell, w, k * m * BINS).reshape(k, m, BINS).cumsum(axis=2)
        all_ = left[:, :, -1:]
        left = left[:, :, :-1]
        lw, total = sum(left), sum(all_)
        rw = total - lw
        with np.errstate(divide="ignore", invalid="ignore"):
            # the drop of gini, times the node's weight
            gain = sum(c * c for c in left) / lw + sum((t - c) * (t - c) for t, c in zip(all_, left, strict=True)) / rw - sum(t * t for t in all_) / total
        gain[(lw <= 1e-9 * total) | (rw <= 1e-9 * total)] = -1
        split = gain.argmax(axis=1)
        top = gain[np.arange(m), split]
        better = top > np.maximum(best, 1e-12 * total[:, 0])
        best[better], feature[better], bin_[better] = top[better], f[better], split[better]
    return feature, bin_


def grow_tree(x: np.ndarray, y: np.ndarray, w: np.ndarray, k: int, depth: int, features: int, rng) -> tuple[np.ndarray, ...]:
    """A tree of binned rows: (feature or -1, bin, left child, shares of the ``k`` classes) of each node; what has
    at most ``bin`` goes left, the right child follows the left one."""
    d = x.shape[1]
    rows, node = np.arange(len(y)), np.zeros(len(y), np.int64)
    made, counts, n_nodes = [], np.bincount(y, w, k)[None, :], 1
    for level in range(depth + 1):
        m = len(counts)
        feature, bin_ = np.full(m, -1, np.int16), np.zeros(m, np.uint8)
        # nodes of one class are leaves, and so are all of the last level
        open_ = ((counts > 0).sum(axis=1) > 1) & (level < depth)
        place = np.cumsum(open_) - 1
        mine = open_[node]
        rows, node = rows[mine], place[node[mine]]
        asked = np.flatnonzero(open_)
        order = np.argsort(node, kind="stable")
        rows, node = rows[order], node[order]
        ends = np.searchsorted(node, np.arange(len(asked) + 1))
        step = max(1, _CELLS // (BINS * k))
        for a in range(0, len(asked), step):
            b = min(a + step, len(asked))
            some = slice(ends[a], ends[b])
            drawn = rng.random((b - a, d)).argpartition(features - 1, axis=1)[:, :features] if features < d else np.tile(np.arange(d), (b - a, 1))
            feature[asked[a:b]], bin_[asked[a:b]] = _best_splits(x, rows[some], node[some] - a, y[rows[some]], w[rows[some]], drawn, k)
        split = feature >= 0
        n_split = int(split.sum())
        left = np.full(m, -1, np.int32)
        n_nodes_next = n_nodes + 2 * n_split
        left[split] = n_nodes + 2 * np.arange(n_split)
        made.append((feature, bin_, left, counts))
        if not n_split:
            break
        # rows of split nodes go on to the children
        on = split[asked[node]]
        rows, parent = rows[on], asked[node[on]]
        node = left[parent] - n_nodes + (x[rows, feature[parent]] > bin_[parent])
        counts = np.bincount(node * k + y[rows], w[rows], 2 * n_split * k).reshape(-1, k)
        n_nodes = n_nodes_next
    return _pruned(made)


def _pruned(levels: list[tuple]) -> tuple[np.ndarray, ...]:
    """The nodes of all levels as one table, from the last level up without children of equal class."""
    feature, bin_, left, counts = (np.concatenate([x[i] for x in levels]) for i in range(4))
    at = np.cumsum([0] + [len(x[0]) for x in levels])
    says = counts.argmax(axis=1)
    for a, b in zip(at[-2::-1], at[:0:-1], strict=True):
        s = a + np.flatnonzero(feature[a:b] >= 0)
        l_ = left[s]
        merged = s[(feature[l_] < 0) & (feature[l_ + 1] < 0) & (says[l_] == says[l_ + 1])]
        feature[merged], left[merged] = -1, -1
    kept = np.zeros(len(feature), bool)
    kept[0] = True
    for a, b in zip(at[:-1], at[1:], strict=True):
        s = a + np.flatnonzero(kept[a:b] & (feature[a:b] >= 0))
        kept[left[s]] = kept[left[s] + 1] = True
    place = np.cumsum(kept) - 1
    shares = np.round(counts[kept] / counts[kept].sum(axis=1, keepdims=True) / _UNIT) * _UNIT
    shares[:, 0] = 1 - shares[:, 1:].sum(axis=1)
    return feature[kept], bin_[kept], np.where(left[kept] >= 0, place[left[kept]], -1).astype(np.int32), shares


def tree_shares(x: np.ndarray, tree: tuple[np.ndarray, ...]) -> np.ndarray:
    """The shares of the leaf that each binned row comes to."""
    feature, bin_, left, shares = tree
    node, rows = np.zeros(len(x), np.int64), np.arange(len(x))
    while len(rows):
        at = node[rows]
        on = feature[at] >= 0
        rows, at = rows[on], at[on]
        node[rows] = left[at] + (x[rows, feature[at]] > bin_[at])
    return shares[node]


def boost(x: np.ndarray, y: np.ndarray, w: np.ndarray, rounds: int, depth: int, rate: float) -> list[tuple[np.ndarray, ...]]:
    """Trees of gradient boosting by the log loss, each as of ``grow_tree`` with one share, what it adds to the margin.
    The first fits the classes (-1, 1), the others the gradient, and count ``rate``."""
    columns, sign = np.ascontiguousarray(x.T), 2.0 * y - 1
    root = np.array([np.bincount(c, w, BINS) for c in columns])
    margin, out = np.zeros(len(y)), []
    for i in range(rounds):
        target = sign if i == 0 else 4 * sign / (1 + np.exp(2 * sign * margin))
        feature, bin_, left, value, node = _regression(columns, target, w, depth, root)
        add = np.round(value * (rate if i else 1.0) / _UNIT) * _UNIT
        margin += add[node]
        out.append((feature, bin_, left, add[:, None]))
    return out


def _histograms(columns: np.ndarray, rows: np.ndarray, slot: np.ndarray, m: int, w: np.ndarray, wr: np.ndarray) -> np.ndarray:
    """(2, features, m, BINS): sums of ``w`` and ``wr`` of ``rows`` by slot and bin."""
    out, base, w, wr = np.empty((2, len(columns), m, BINS)), slot * BINS, w[rows], wr[rows]
    for f, column in enumerate(columns):
        cell = base + column[rows]
        out[0, f] = np.bincount(cell, w, m * BINS).reshape(m, BINS)
        out[1, f] = np.bincount(cell, wr, m * BINS).reshape(m, BINS)
    return out


def _regression(columns: np.ndarray, target: np.ndarray, w: np.ndarray, depth: int, root: np.ndarray) -> tuple[np.ndarray, ...]:
    """A regression tree by variance: (feature, bin, left, mean) of its nodes, and the leaf of each row. Of two
    children the lighter one's rows are counted; the other has what is left of the parent."""
    wr = w * target
    hist = np.stack([root, np.array([np.bincount(c, wr, BINS) for c in columns])])[:, :, None, :]
    node, first = np.zeros(len(w), np.int64), 0         # of each row, and the first of the level
    made = []
    for level in range(depth + 1):
        m = hist.shape[2]
        sums = hist[:, 0].sum(axis=2)
        feature, bin_, left = np.full(m, -1, np.int16), np.zeros(m, np.uint8), np.full(m, -1, np.int32)
        made.append((feature, bin_, left, sums[1] / sums[0]))
        if level == depth:
            break
        up = hist.cumsum(axis=3)
        lw, ls = up[0, :, :, :-1], up[1, :, :, :-1]
        rw, rs = sums[0][None, :, None] - lw, sums[1][None, :, None] - ls
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = ls * ls / lw + rs * rs / rw - (sums[1] ** 2 / sums[0])[None, :, None]
        least = 1e-9 * sums[0][None, :, None]
        gain[(lw <= least) | (rw <= least)] = -1
        flat = gain.transpose(1, 0, 2).reshape(m, -1)
        at = flat.argmax(axis=1)
        split = np.flatnonzero(flat[np.arange(m), at] > 1e-12 * sums[0])
        if not len(split):
            break
        f, b = np.divmod(at[split], BINS - 1)
        feature[split], bin_[split], left[split] = f, b, first + m + 2 * np.arange(len(split))
        mine = node - first
        rows = np.flatnonzero((mine >= 0) & (feature[np.maximum(mine, 0)] >= 0))
        parent = mine[rows]
        child = left[parent] + (columns[feature[parent], rows] > bin_[parent])
        node[rows] = child
        child = child - first - m
        heavy = np.bincount(child, minlength=2 * len(split)).reshape(-1, 2)
        light = (heavy[:, 1] < heavy[:, 0]).astype(np.int64)          # which child is counted
        counted = light[child >> 1] == (child & 1)
        found = _histograms(columns, rows[counted], child[counted] >> 1, len(split), w, wr)
        both = np.empty((2, len(columns), len(split), 2, BINS))
        each = np.arange(len(split))
        both[:, :, each, light] = found
        both[:, :, each, 1 - light] = hist[:, :, split] - found
        hist, first = both.reshape(2, len(columns), -1, BINS), first + m
    feature, bin_, left, value = (np.concatenate([x[i] for x in made]) for i in range(4))
    return feature, bin_, left, value, node


def _bagged(x, y, w, n, trees: list[int], k: int, seed: int, depth: int, features: int):
    """The forest's ``trees``, by the rows and their numbers."""
    for t in trees:
        rng = np.random.default_rng([seed, t])
        times = rng.poisson(n)
        bag = np.flatnonzero(times)
        if not len(bag):
            bag, times = np.arange(len(y)), n
        yield t, grow_tree(x[bag], y[bag], w[bag] * times[bag], k, depth, features, rng)


def _boosted(x, y, w, n, trees: list[int], rounds: int, depth: int, rate: float):
    yield from enumerate(boost(x, y, w * n, rounds, depth, rate))


def _grown(width: int, trees: dict[int, list[int]], fit, *sizes):
    """Holds the rows of a group, then has ``fit`` grow its trees: a row for each."""
    def run(batches):
        packs: dict[int, list] = {}
        for batch in batches:
            for g, *pack in zip(batch.column("group").to_pylist(), *(batch.column(c) for c in ("x", "y", "w", "n", "h")), strict=True):
                packs.setdefault(g, []).append([np.frombuffer(c.as_buffer(), t) for c, t in zip(pack, (np.uint8, np.int32, np.float64, np.int64, np.int64), strict=True)])
        for g in sorted(packs):
            x, y, w, n, h = (np.concatenate(c) for c in zip(*packs.pop(g), strict=True))
            order = np.argsort(h, kind="stable")
            x, y, w, n = x.reshape(-1, width)[order], y[order].astype(np.int64), w[order], n[order]
            for t, made in fit(x, y, w, n, trees[g], *sizes):
                yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), *(pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in made)],
                                                 ["tree", "feature", "bin", "left", "share"])
    return run


def _dealt(df: DataFrame, keys: list[int], *order: str) -> DataFrame:
    """``df`` by its column group, a partition for each of ``keys``."""
    return df.repartition(len(keys), "group").sortWithinPartitions("group", *order)


def _sent(train: DataFrame, label: str, weight: str, groups: int):
    """(cuts, number of classes, keys of ``groups``, rows in packs for each); None where they are more than a task may hold."""
    spark = train.sparkSession
    ship_package(spark)
    rows = train.select(vector_to_array("features").alias("v"), F.col(label).cast("int").alias("y"), F.col(weight).cast("double").alias("w")).where("w > 0")
    cuts = thresholds(rows)
    told = scratch_path(spark, "binned")
    equal = rows.mapInArrow(_binned(cuts), "x binary, y int, w double").groupBy("x", "y", "w").agg(F.count(F.lit(1)).alias("n"))
    equal.withColumn("h", F.xxhash64("x", "y", "w")).write.parquet(told)
    binned = spark.read.parquet(told)
    n, top = binned.agg(F.count(F.lit(1)), F.max("y")).first()
    if not n or n * (len(cuts) + 24) > TASK_BYTES:
        return None
    keys = _keys(spark, groups)
    columns = ["x", "y", "w", "n", "h"]
    packs = binned.mapInArrow(_packed(columns), ", ".join(f"{c} binary" for c in columns))
    sent = packs.select(F.explode(F.array(*[F.lit(g) for g in keys])).alias("group"), *columns).repartition(len(keys), "group")
    return cuts, max(2, top + 1), keys, sent


def grow(train: DataFrame, label: str, weight: str, trees: int, depth: int, seed: int, otherwise) -> Model:
    """The forest of ``train`` (``features``, ``label``, ``weight``); of ``otherwise()`` where its rows are more than a task may hold."""
    found = _sent(train, label, weight, min(trees, 2 * train.sparkSession.sparkContext.defaultParallelism))
    if found is None:
        return otherwise()
    cuts, k, keys, sent = found
    mine = {g: list(range(trees))[i::len(keys)] for i, g in enumerate(keys)}
    path = scratch_path(train.sparkSession, "forest")
    sent.mapInArrow(_grown(len(cuts), mine, _bagged, k, seed, depth, max(1, int(np.ceil(np.sqrt(len(cuts)))))), _TREES).write.parquet(path)
    return RandomForestClassificationTrees(path, cuts, k, trees)


def grow_boosted(train: DataFrame, label: str, weight: str, rounds: int, depth: int, rate: float, otherwise) -> Model:
    """Boosted trees of two classes, as ``pyspark.ml`` fits them, in one task: for fits that run side by side."""
    found = _sent(train, label, weight, 1)
    if found is None or found[1] != 2:
        return otherwise()
    cuts, _, keys, sent = found
    path = scratch_path(train.sparkSession, "boosted")
    sent.mapInArrow(_grown(len(cuts), {keys[0]: []}, _boosted, rounds, depth, rate), _TREES).write.parquet(path)
    return GBTClassificationTrees(path, cuts, 2, rounds)


# ---------------------------------------------------------------------------
# The model
# ---------------------------------------------------------------------------

def _asked(cuts: list[np.ndarray]):
    """Asked rows as packs of their bins."""
    def binned(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("row"), _fixed(_bins(matrix(batch.column("v"), len(cuts)), cuts))], ["row", "x"])

    pack = _packed(["row", "x"])
    return lambda batches: pack(binned(batches))


def _scored(width: int, k: int):
    """The sum of a group's trees for each row of a pack. A group's trees come before its packs."""
    def run(batches):
        group, trees = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                cell = lambda c, t: np.frombuffer(batch.column(c)[i].as_buffer(), t)  # noqa: B023, E731
                if (g := batch.column("group")[i].as_py()) != group:
                    group, trees = g, []
                if batch.column("kind")[i].as_py() == 0:
                    trees.append((cell("feature", np.int16), cell("bin", np.uint8), cell("left", np.int32), cell("share", np.float64).reshape(-1, k)))
                    continue
                x = cell("x", np.uint8).reshape(-1, width)
                sums = sum((tree_shares(x, t) for t in trees), np.zeros((len(x), k)))
                yield pa.RecordBatch.from_arrays([pa.array(cell("row", np.int64)), *(pa.array(sums[:, c].copy()) for c in range(k))], ["row", *(f"s{c}" for c in range(k))])
    return run


class _Trees(Model, MLWritable, MLReadable):
    """The table of trees at ``path``, of which the first ``trees`` are taken."""

    def __init__(self, path: str, cuts: list[np.ndarray], n_classes: int, trees: int):
        super().__init__()
        self.path, self.cuts, self.numClasses, self.getNumTrees = path, cuts, n_classes, trees

    def first(self, n: int) -> _Trees:
        return type(self)(self.path, self.cuts, self.numClasses, min(n, self.getNumTrees))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """``dataset`` plus rawPrediction, probability and prediction. Its rows are written once and numbered;
        their bins meet the trees group by group, and the sums are joined back."""
        spark, k, width = dataset.sparkSession, self._sums(), len(self.cuts)
        ship_package(spark)
        checkpoint_root(spark)
        rows = dataset.withColumn("__row", F.monotonically_increasing_id()).checkpoint(eager=True)
        packs = rows.select(F.col("__row").alias("row"), vector_to_array("features").alias("v")).mapInArrow(_asked(self.cuts), "row binary, x binary")
        keys = _keys(spark, min(self.getNumTrees, 2 * spark.sparkContext.defaultParallelism))
        of = F.array(*[F.lit(g) for g in keys])
        held = spark.read.parquet(self.path).where(F.col("tree") < self.getNumTrees).select(
            F.get(of, F.col("tree") % len(keys)).alias("group"), F.lit(0).alias("kind"), "tree", "feature", "bin", "left", "share")
        sent = packs.select(F.explode(of).alias("group"), F.lit(1).alias("kind"), "row", "x")
        dealt = _dealt(held.unionByName(sent, allowMissingColumns=True), keys, "kind", "tree")
        sums = [f"s{c}" for c in range(k)]
        found = dealt.mapInArrow(_scored(width, k), "row long, " + ", ".join(f"{s} double" for s in sums))
        found = found.groupBy(F.col("row").alias("__row")).agg(F.array(*[F.sum(s) for s in sums]).alias("__raw"))
        out = rows.join(found, "__row", "left").withColumns(self._said())
        return out.select(*dataset.columns, "rawPrediction", "probability", "prediction")

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class RandomForestClassificationTrees(_Trees):
    """A forest of ``grow``: the shares of its trees are added up."""

    def _sums(self) -> int:
        return self.numClasses

    def _said(self) -> dict:
        total = F.aggregate("__raw", F.lit(0.0), lambda a, s: a + s)
        return {"rawPrediction": array_to_vector("__raw"), "probability": array_to_vector(F.transform("__raw", lambda s: s / total)),
                "prediction": (F.array_position("__raw", F.array_max("__raw")) - 1).cast("double")}


class GBTClassificationTrees(_Trees):
    """Boosted trees of ``grow_boosted``: their margins are added up."""

    def _sums(self) -> int:
        return 1

    def _said(self) -> dict:
        margin = F.col("__raw")[0]
        p = 1 / (1 + F.exp(-2 * margin))
        return {"rawPrediction": array_to_vector(F.array(-margin, margin)), "probability": array_to_vector(F.array(1 - p, p)),
                "prediction": (margin > 0).cast("double")}


class _Writer(MLWriter):
    def __init__(self, forest: _Trees):
        super().__init__()
        self.forest = forest

    def saveImpl(self, path: str) -> None:
        made = self.forest
        told = {"cuts": json.dumps([c.tolist() for c in made.cuts]), "numClasses": made.numClasses, "numTrees": made.getNumTrees}
        DefaultParamsWriter.saveMetadata(made, path, self.sparkSession, extraMetadata=told)
        self.sparkSession.read.parquet(made.path).where(F.col("tree") < made.getNumTrees).write.parquet(f"{path}/trees")


class _Reader(MLReader):
    def __init__(self, cls: type):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> _Trees:
        told = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        made = self.cls(f"{path}/trees", [np.array(c) for c in json.loads(told["cuts"])], told["numClasses"], told["numTrees"])
        made._resetUid(told["uid"])
        return made
