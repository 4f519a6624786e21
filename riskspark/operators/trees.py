"""Regression trees grown level by level, all fits of a search in the same scans.

Spark's tree estimators keep a Java object for every row of every fit. Here the rows are coded
once, a byte or two for each feature, and written to a work table in blocks; a scan sums the
histograms of all open nodes of all fits and the best splits are found in the tasks. A task holds
one block and its histograms, the driver the trees. Splits, stopping rules, bagging, boosting and
the finished models are those of Spark's estimators; only the random numbers are others, drawn from
a row's place in the table, so they repeat.
"""

from __future__ import annotations

import pickle
import re
from array import array
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from math import ceil, exp, log2, sqrt

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.session import delete_work, work_path

BLOCK = 1 << 14           # rows of a block
# What the writer of a work table holds; the size of a row group is looked at from its first row.
WRITER = {"parquet.block.size": 16 << 20, "parquet.page.size.row.check.min": 1}
HISTOGRAMS = 64 << 20     # bytes of histograms that a task sums in one scan
REBASE = 4                # boosted trees that a scan walks before their sums are written down
NO_FOLD = -(1 << 62)
EPSILON = 2.0 ** -52
BLOCKS = "fold long, first long, n int, bad boolean, codes binary, y binary"


# ---- a fit and its trees ---------------------------------------------------------------------

class Tree:
    """Nodes in the order in which they were made; a leaf or open node is its own child."""

    def __init__(self):
        self.feature, self.code, self.left, self.right = [-1], [0], [0], [0]
        self.depth, self.number = [0], [1]
        self.stats, self.gain, self.valid = [None], [0.0], [True]

    def add(self, parent: int, number: int, stats: tuple) -> int:
        at = len(self.feature)
        for column, value in ((self.feature, -1), (self.code, 0), (self.left, at), (self.right, at),
                              (self.depth, self.depth[parent] + 1), (self.number, number),
                              (self.stats, stats), (self.gain, 0.0), (self.valid, True)):
            column.append(value)
        return at

    def places(self, codes: np.ndarray, levels: int | None = None) -> np.ndarray:
        """The node in which each row lands, after so many levels at most."""
        n = codes.shape[1]
        at = np.zeros(n, np.int64)
        feature, code, left, right = (np.array(c, np.int64) for c in (self.feature, self.code, self.left, self.right))
        rows, flat, starts = np.arange(n), codes.reshape(-1), np.maximum(feature, 0) * n
        for _ in range(max(self.depth) if levels is None else min(levels, max(self.depth))):
            above = flat[starts[at] + rows] > code[at]
            at = np.where(above, right[at], left[at])
        return at

    def values(self, codes: np.ndarray, levels: int | None = None) -> np.ndarray:
        return np.array([mean(s) for s in self.stats])[self.places(codes, levels)]


def mean(stats: tuple) -> float:
    return stats[1] / stats[0] if stats[0] else 0.0


def variance(stats: tuple) -> float:
    return (stats[2] - stats[1] * stats[1] / stats[0]) / stats[0] if stats[0] else 0.0


@dataclass
class Fit:
    """One model to be grown. ``fold`` is left out; without one, all rows take part."""

    fold: int | None
    boosted: bool
    depth: int
    count: int
    max_bins: int
    min_instances: int
    min_weight: float
    min_gain: float
    rate: float
    bootstrap: bool
    subset: str
    step: float
    loss: str
    seed: int
    cuts: list = field(default_factory=list)    # for each feature the codes that may split
    trees: list = field(default_factory=list)

    def sees(self, fold: int) -> bool:
        return sees(self.fold, fold)

    def features_of(self, tree: int, number: int, n: int) -> np.ndarray:
        """The features that a node may split on."""
        k = subset_size(self.subset, n, 1 if self.boosted else self.count)
        if k == n:
            return np.arange(n)
        rng = np.random.default_rng([self.seed & (1 << 63) - 1, tree, number])
        return np.sort(rng.choice(n, k, replace=False))

    def bag(self, tree: int, first: int, n: int) -> np.ndarray | None:
        """How often each row counts for a tree; None if each does once."""
        if not self.bootstrap and self.rate == 1.0:
            return None
        u = uniform(first, n, self.seed * 1_000_003 + tree)
        if not self.bootstrap:
            return (u < self.rate).astype(float)
        term, total, upto = exp(-self.rate), 0.0, []
        while len(upto) < 32:
            total += term
            upto.append(total)
            term *= self.rate / len(upto)
        return np.searchsorted(upto, u, "right").astype(float)

    def target(self, y: np.ndarray, codes: np.ndarray, known: tuple | None) -> np.ndarray:
        """What the next tree is grown on: for a boosted model what the former ones left."""
        if not self.boosted or len(self.trees) == 1:
            return y
        left = y - self.sums(codes, len(self.trees) - 1, known)
        return 2.0 * left if self.loss == "squared" else np.where(left < 0, -1.0, 1.0)

    def sums(self, codes: np.ndarray, count: int, known: tuple | None = None) -> np.ndarray:
        """The weighted sum of a boosted model's first trees; ``known`` has that of some of them."""
        done, total = known or (0, 0.0)
        for t in range(done, count):
            total = total + (1.0 if t == 0 else self.step) * self.trees[t].values(codes)
        return total


def subset_size(strategy: str, n: int, trees: int) -> int:
    """Features for each node, as Spark counts them."""
    if strategy == "auto":
        strategy = "all" if trees == 1 else "onethird"
    named = {"all": n, "sqrt": ceil(sqrt(n)), "log2": max(1, ceil(log2(n))), "onethird": ceil(n / 3.0)}
    if strategy in named:
        return named[strategy]
    if re.fullmatch(r"[1-9][0-9]*", strategy):
        return min(int(strategy), n)
    return min(n, ceil(float(strategy) * n))


def uniform(first: int, n: int, salt: int) -> np.ndarray:
    """Numbers in 0..1 for rows ``first``, ``first + 1``, ..., the same whoever asks."""
    def mixed(z):
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))

    places = np.arange(first + 1, first + 1 + n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    key = mixed(np.array([(salt * 0x9E3779B97F4A7C15 + 1) % (1 << 64)], np.uint64))
    return (mixed(mixed(places) ^ key) >> np.uint64(11)) * 2.0 ** -53


def thresholds(values: np.ndarray, max_bins: int, rows: int) -> np.ndarray:
    """Where a feature may be split, from a sample of its values: Spark's rule."""
    distinct, counts = np.unique(values + 0.0, return_counts=True)
    between = (distinct[1:] + distinct[:-1]) / 2.0
    splits = min(max_bins, rows) - 1
    if len(between) <= splits:
        return between
    stride = len(values) / (splits + 1)
    found, upto, aim = [], int(counts[0]), stride
    for i in range(1, len(distinct)):
        before, upto = upto, upto + int(counts[i])
        if abs(before - aim) < abs(upto - aim):
            found.append(between[i - 1])
            aim += stride
    return np.array(found)


# ---- the coded rows --------------------------------------------------------------------------

@dataclass
class CodedRows:
    """Rows as blocks of codes. Code j of a feature says that the value lies above the first j of
    its ``marks`` and not above the others."""

    blocks: RDD
    path: str
    spark: object
    marks: list[np.ndarray]
    splits: dict[tuple, list[np.ndarray]]
    sizes: dict[int, int]

    @property
    def width(self) -> int:
        return 1 + max(len(m) for m in self.marks)

    def seen(self, fold: int | None) -> int:
        return seen(self.sizes, fold)

    def drop(self) -> None:
        delete_work(self.spark, self.path)


def sees(without: int | None, fold: int) -> bool:
    """Whether a fit that leaves out a fold is made of the rows of another; None leaves out none."""
    return without is None or fold not in (without, NO_FOLD)


def seen(sizes: dict[int, int], without: int | None) -> int:
    """Rows of which a fit is made."""
    return sum(n for k, n in sizes.items() if sees(without, k))


def code_rows(train: DataFrame, values: Column, target: str, folds: Sequence[int | None],
              max_bins: Iterable[int], seed: int, fold: str = "fold") -> CodedRows | None:
    """Write the rows of an array of values, a target and a fold as blocks of codes.

    ``folds`` and ``max_bins`` tell which fits will be asked for. One pass counts, one takes the
    sample in which splits are looked for (as large as Spark's), one codes. None if a fit would
    have no rows, or a value or target is missing or not finite: those rows go the plain way.
    """
    spark, max_bins = train.sparkSession, sorted(set(max_bins))
    rows = train.select(F.coalesce(F.col(fold).cast("long"), F.lit(NO_FOLD)).alias("fold"),
                        values.alias("x"), F.col(target).cast("double").alias("y"))
    sizes = {r["fold"]: r["n"] for r in rows.groupBy("fold").agg(F.count("*").alias("n")).collect()}  # one a fold
    if not all(seen(sizes, k) for k in folds):
        return None
    rates = {k: max(max_bins[-1] ** 2, 10_000) / seen(sizes, k) for k in folds}
    most = F.create_map(*[F.lit(v) for k in sizes for v in (
        k, max([0.0, *[r for without, r in rates.items() if sees(without, k)]]))])[F.col("fold")]
    sample = rows.select("fold", "x", F.rand(seed).alias("u")).where(F.col("u") < most).collect()  # as Spark's
    n = max((len(r["x"] or []) for r in sample), default=0)
    if not n or any(r["x"] is None or len(r["x"]) != n or None in r["x"] for r in sample):
        return None
    x, u = np.array([r["x"] for r in sample], float), np.array([r["u"] for r in sample])
    if not np.isfinite(x).all():
        return None
    splits = {}
    for k in folds:
        mine = x[np.array([sees(k, r["fold"]) for r in sample]) & (u < rates[k])]
        if not len(mine):
            return None
        for bins in max_bins:
            splits[k, bins] = [thresholds(mine[:, f], bins, seen(sizes, k)) for f in range(n)]
    marks = [np.unique(np.concatenate([s[f] for s in splits.values()])) for f in range(n)]
    longest = max(len(m) for m in marks)
    kind = np.uint8 if longest < 1 << 8 else np.uint16 if longest < 1 << 16 else np.uint32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _coded(batches, marks, kind)

    path = work_path(spark, "trees")
    try:
        (rows.mapInArrow(run, BLOCKS).write.options(**WRITER).option("compression", "uncompressed")
         .parquet(path))
        table = spark.read.parquet(path)
        if table.agg(F.max("bad")).first()[0]:
            delete_work(spark, path)
            return None
    except BaseException:
        delete_work(spark, path)
        raise
    blocks = table.select("fold", "first", "codes", "y").rdd.map(lambda r: _opened(r, n, kind))
    return CodedRows(blocks, path, spark, marks, splits, sizes)


def _coded(batches: Iterator[pa.RecordBatch], marks: list[np.ndarray], kind) -> Iterator[pa.RecordBatch]:
    """The rows of a task as blocks of one fold each, numbered through."""
    first = TaskContext.get().partitionId() << 40
    waiting: dict[int, list] = {}
    bad = False

    def block(k):
        nonlocal first
        codes, y = (np.concatenate(a, -1) for a in zip(*waiting.pop(k)))
        first, mine = first + len(y), first
        return pa.RecordBatch.from_pydict({"fold": [k], "first": [mine], "n": pa.array([len(y)], pa.int32()),
                                           "bad": [False], "codes": [codes.tobytes()], "y": [y.tobytes()]})

    for batch in batches:
        if bad or not batch.num_rows:
            continue
        folds, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
        y = batch.column(2).to_numpy(zero_copy_only=False).astype(float)
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(float)
        if (lists.null_count or len(flat) != len(y) * len(marks) or not np.isfinite(flat).all()
                or not np.isfinite(y).all()):
            yield pa.RecordBatch.from_pydict({"fold": [NO_FOLD], "first": [0], "n": pa.array([0], pa.int32()),
                                              "bad": [True], "codes": [b""], "y": [b""]})
            bad = True
            continue
        x = flat.reshape(len(y), -1)
        codes = np.array([np.searchsorted(m, x[:, f]).astype(kind) for f, m in enumerate(marks)])
        for k in np.unique(folds).tolist():
            mine = folds == k
            waiting.setdefault(k, []).append((codes[:, mine], y[mine]))
            if sum(len(t) for _, t in waiting[k]) >= BLOCK:
                yield block(k)
    for k in [] if bad else sorted(waiting):
        yield block(k)


def _opened(row, features: int, kind) -> tuple:
    return (row["fold"], row["first"], np.frombuffer(row["codes"], kind).reshape(features, -1),
            np.frombuffer(row["y"]), {})


# ---- growing ---------------------------------------------------------------------------------

def grow(rows: CodedRows, fits: list[Fit]) -> None:
    """Grow the trees of all fits. Each scan of the blocks serves the open nodes of all of them."""
    n, width = len(rows.marks), rows.width
    todo: list[tuple] = []  # open nodes: fit, tree, node
    for i, fit in enumerate(fits):
        fit.cuts = [np.searchsorted(m, s) for m, s in zip(rows.marks, rows.splits[fit.fold, fit.max_bins])]
        fit.trees = [Tree() for _ in range(1 if fit.boosted else fit.count)]
        todo += [(i, t, 0) for t in range(len(fit.trees))]
    source, stale, based = rows.blocks, None, {}
    try:
        while todo:
            some = max(1, HISTOGRAMS // (3 * 8 * n * width))
            now, todo = todo[:some], todo[some:]
            found = _splits(source, fits, now, n, width)
            if stale is not None:
                stale.unpersist()
                stale = None
            for i, t, node in now:
                todo += [(i, t, child) for child in _split(fits[i], fits[i].trees[t], node, found.get((i, t, node)))]
            busy = {i for i, _, _ in todo}
            for i, fit in enumerate(fits):
                if fit.boosted and i not in busy and len(fit.trees) < fit.count:
                    fit.trees.append(Tree())
                    todo.append((i, len(fit.trees) - 1, 0))
            done = {i: len(fits[i].trees) - 1 for i, _, _ in todo if fits[i].boosted}
            if any(count - based.get(i, 0) >= REBASE for i, count in done.items()):
                based = done
                stale = source if source is not rows.blocks else None
                source = _based(source, fits, based).persist(StorageLevel.DISK_ONLY)
    finally:
        for kept in (stale, source if source is not rows.blocks else None):
            if kept is not None:
                kept.unpersist()


def _split(fit: Fit, tree: Tree, node: int, found: tuple | None) -> list[int]:
    """Set the split that was found for a node, if any; the children that are still open."""
    if found is None:  # no row of the bag came here
        tree.stats[node], tree.valid[node] = tree.stats[node] or (0.0, 0.0, 0.0), False
        return []
    stats, split = found
    tree.stats[node] = tree.stats[node] or stats  # a child keeps those of its parent's split
    if split is None:
        tree.valid[node] = False
        return []
    feature, code, gain, *sides = split
    if gain <= 0 or tree.depth[node] >= fit.depth:
        return []
    children = [tree.add(node, 2 * tree.number[node] + i, s) for i, s in enumerate(sides)]
    tree.feature[node], tree.code[node], tree.gain[node] = feature, code, gain
    tree.left[node], tree.right[node] = children
    return [c for c in children if tree.depth[c] < fit.depth and abs(variance(tree.stats[c])) >= EPSILON]


def _splits(source: RDD, fits: list[Fit], nodes: list[tuple], n: int, width: int) -> dict[tuple, tuple]:
    """The best split of each of the nodes, from one scan: rows summed in the tasks, nodes dealt out."""
    wanted: dict[tuple, list] = {}
    for i, t, node in nodes:
        wanted.setdefault((i, t), []).append((node, fits[i].features_of(t, fits[i].trees[t].number[node], n)))

    def histograms(blocks: Iterable[tuple]) -> Iterator[tuple]:
        yield from _histograms(blocks, fits, wanted, width)

    def best(pair: tuple) -> tuple:
        (i, t, node), sums = pair
        fit = fits[i]
        return (i, t, node), best_split(sums, fit.features_of(t, fit.trees[t].number[node], n), fit)

    parts = max(1, min(len(nodes), source.context.defaultParallelism))
    return dict(source.mapPartitions(histograms).reduceByKey(np.add, parts).map(best).collect())  # one a node


def _histograms(blocks: Iterable[tuple], fits: list[Fit], wanted: dict[tuple, list], width: int) -> Iterator[tuple]:
    """For each wanted node the counts, sums and sums of squares by feature and code."""
    total, plans = {}, {}
    for (i, t), nodes in wanted.items():
        slots = np.full(len(fits[i].trees[t].feature), -1)
        slots[[node for node, _ in nodes]] = range(len(nodes))
        plans.setdefault(i, []).append((t, slots, sorted({int(f) for _, chosen in nodes for f in chosen}), len(nodes)))
    for fold, first, codes, y, known in blocks:
        for i, trees in plans.items():
            fit = fits[i]
            if not fit.sees(fold):
                continue
            goal = fit.target(y, codes, known.get(i))
            for t, slots, features, count in trees:
                place, bag = slots[fit.trees[t].places(codes)], fit.bag(t, first, len(y))
                keep = place >= 0 if bag is None else (place >= 0) & (bag > 0)
                part, aims = codes, goal
                if not keep.all():
                    part, aims, place = codes[:, keep], goal[keep], place[keep]
                    bag = None if bag is None else bag[keep]
                if not len(aims):
                    continue
                weighted = aims if bag is None else aims * bag
                squares, start, cells = weighted * aims, place * width, count * width
                sums = total.setdefault((i, t), np.zeros((3, codes.shape[0], cells)))
                for f in features:
                    at = start + part[f]
                    sums[0, f] += np.bincount(at, bag, cells)
                    sums[1, f] += np.bincount(at, weighted, cells)
                    sums[2, f] += np.bincount(at, squares, cells)
    for (i, t), sums in total.items():
        for slot, (node, chosen) in enumerate(wanted[i, t]):
            yield (i, t, node), sums[:, chosen, slot * width:(slot + 1) * width]


def best_split(sums: np.ndarray, chosen: np.ndarray, fit: Fit) -> tuple | None:
    """``(stats, split)`` of a node; a split is (feature, code, gain, stats of both sides).

    The first of the highest gains counts. There is no split if none leaves enough rows on both
    sides or gains enough.
    """
    upto = sums.cumsum(2)
    stats = tuple(float(v) for v in upto[:, 0, -1])
    if not stats[0]:
        return None
    best = None
    for j, f in enumerate(chosen):
        cuts = fit.cuts[f]
        if not len(cuts):
            continue
        left, whole = upto[:, j, cuts], upto[:, j, -1:]
        right = whole - left
        with np.errstate(divide="ignore", invalid="ignore"):
            spread = [np.where(s[0] > 0, (s[2] - s[1] * s[1] / s[0]) / s[0], 0.0) for s in (whole, left, right)]
        gain = spread[0] - left[0] / whole[0] * spread[1] - right[0] / whole[0] * spread[2]
        fewest = np.minimum(left[0], right[0])
        gain[(fewest < fit.min_instances) | (fewest < fit.min_weight) | (gain < fit.min_gain)] = -np.inf
        k = int(gain.argmax())
        if gain[k] > (-np.inf if best is None else best[2]):
            best = (int(f), int(cuts[k]), float(gain[k]), tuple(map(float, left[:, k])), tuple(map(float, right[:, k])))
    return stats, best


def _based(source: RDD, fits: list[Fit], based: dict[int, int]) -> RDD:
    """The blocks with the sums of the boosted trees grown so far."""
    def run(blocks: Iterable[tuple]) -> Iterator[tuple]:
        for fold, first, codes, y, known in blocks:
            yield fold, first, codes, y, {i: (count, fits[i].sums(codes, count, known.get(i)))
                                          for i, count in based.items() if fits[i].sees(fold) and count}

    return source.mapPartitions(run)


# ---- scores and models -----------------------------------------------------------------------

def fold_errors(rows: CodedRows, wanted: list[tuple]) -> list[float]:
    """RMSE of each ``(fit, depth, trees)`` on the fold it was grown without, from one scan.

    A point of less depth or fewer trees is the top or beginning of a larger fit.
    """
    def run(blocks: Iterable[tuple]) -> Iterator[tuple]:
        found: dict[int, float] = {}
        for fold, _, codes, y, _ in blocks:
            seen_by: dict[tuple, list] = {}
            for j, (fit, depth, count) in enumerate(wanted):
                if fit.fold == fold:
                    seen_by.setdefault((id(fit), depth), []).append((count, j))
            for points in seen_by.values():
                fit, depth, _ = wanted[points[0][1]]
                at, total = 0, 0.0
                for count, j in sorted(points):
                    for t in range(at, min(count, len(fit.trees))):
                        weight = fit.step if fit.boosted and t else 1.0
                        total = total + weight * fit.trees[t].values(codes, depth)
                    at = count
                    errors = y - (total if fit.boosted else total / count)
                    found[j] = found.get(j, 0.0) + float(errors @ errors)
        yield from found.items()

    sums = dict(rows.blocks.mapPartitions(run).reduceByKey(lambda a, b: a + b, 1).collect())  # one a point
    sizes = [rows.sizes.get(fit.fold, 0) for fit, _, _ in wanted]
    return [sqrt(sums[j] / n) if n else float("nan") for j, n in enumerate(sizes)]


def spark_model(rows: CodedRows, fit: Fit, estimator):
    """Spark's model of a grown fit, as if the estimator had been fitted."""
    spark = rows.spark
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    ml = jvm.org.apache.spark.ml
    # Looked up once, as each step of a name is a call to the JVM.
    leaf, inner, split_at = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit
    calculator, load = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator, ml.python.MLSerDe.loads

    def root(tree):
        stats = load(bytearray(pickle.dumps([array("d", s) for s in tree.stats], 2)))
        made: dict[int, tuple] = {}  # node: (Java node, its prediction if it is a leaf)
        for at in reversed(range(len(tree.feature))):  # children come after their parents
            spread, value = variance(tree.stats[at]), mean(tree.stats[at])
            figures = calculator(stats.get(at), round(tree.stats[at][0]))
            if tree.feature[at] < 0:
                made[at] = leaf(value, spread if tree.valid[at] else -1.0, figures), value
                continue
            (below, a), (above, b) = made.pop(tree.left[at]), made.pop(tree.right[at])
            if a is not None and a == b:
                made[at] = leaf(a, spread, figures), a
                continue
            f = tree.feature[at]
            split = split_at(f, float(rows.marks[f][tree.code[at]]))
            made[at] = inner(value, spread, tree.gain[at], below, above, split, figures), None
        return made[0][0]

    n, kind = len(rows.marks), type(estimator).__name__
    if kind == "DecisionTreeRegressor":
        java = ml.regression.DecisionTreeRegressionModel(estimator.uid, root(fit.trees[0]), n)
    else:
        trees = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(fit.trees))
        for j, tree in enumerate(fit.trees):
            trees[j] = ml.regression.DecisionTreeRegressionModel(root(tree), n)
        if kind == "RandomForestRegressor":
            java = ml.regression.RandomForestRegressionModel(estimator.uid, trees, n)
        else:
            weights = gateway.new_array(jvm.double, len(fit.trees))
            for j in range(len(fit.trees)):
                weights[j] = float(fit.step) if j else 1.0
            java = ml.regression.GBTRegressionModel(estimator.uid, trees, weights, n)
    return estimator._copyValues(estimator._create_model(java))
