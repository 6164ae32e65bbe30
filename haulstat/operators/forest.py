"""Random forest classifier, grown level by level from histograms of binned rows.

The parameters, the rules and the fitted model are Spark ML's (``RandomForestClassifier``): bootstrap by Poisson(1)
counts, Gini, the square root of the features drawn anew for each node, at most ``maxBins`` bins a feature, a subtree whose
leaves predict the same merged. The passes differ. Spark ML keeps a count a row and tree beside the rows and leads
every row through all trees of a pass, so that nearly each count it adds misses the processor's cache. Here a row is
stored once as its features' bins (a byte each as a rule), bootstrap counts are drawn again from a seed, and a task takes
one tree at a time over its block of rows, column by column. A pass per level moves one histogram a node and block; nodes
are dealt over the tasks that sum them and choose the splits; only the chosen splits come to the driver.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulstat.session import ensure_checkpoint_dir
from haulstat.sources.snapshots import new_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks bring these functions along

BLOCK_ROWS = 1 << 20  # at most so many rows (and one batch) are one block
NODES_AT_ONCE = 1024  # splits are chosen for so many nodes in one array
_TAIL = [sum(math.exp(-1) / math.factorial(i) for i in range(k + 1)) for k in range(13)]
POISSON = [np.uint32(c * 2**32) for c in _TAIL if c * 2**32 < 2**32 - 1]


def fit_bins(df: DataFrame, features: Sequence[str], max_bins: int = 32) -> list[np.ndarray]:
    """Ascending thresholds per feature; a value belongs to the bin of the first threshold that it does not exceed.

    Midpoints between all values where there are at most ``max_bins``, else quantiles; both over all rows. NaN lies
    above all values, in a bin of its own.
    """
    near = df.agg(*[F.approx_count_distinct(F.col(f)).alias(str(i)) for i, f in enumerate(features)]).first()
    few = [i for i in range(len(features)) if near[i] <= 1.5 * max_bins]  # the estimate is a few percent off
    many = [i for i in range(len(features)) if near[i] > 0.7 * max_bins]
    shares = F.array(*[F.lit(k / max_bins) for k in range(1, max_bins)])
    found = df.agg(F.lit(0).alias("_"), *[F.collect_set(F.col(features[i])).alias(f"v{i}") for i in few],
                   *[F.percentile_approx(F.col(features[i]), shares, 10_000).alias(f"q{i}") for i in many],
                   *[F.max(F.nanvl(F.col(f), F.lit(None).cast("double"))).alias(f"m{i}") for i, f in enumerate(features)],
                   *[F.max(F.isnan(F.col(f))).alias(f"n{i}") for i, f in enumerate(features)]).first()
    out = []
    for i in range(len(features)):
        values = np.unique(found[f"v{i}"]) if i in few else None
        if values is not None and (len(values) <= max_bins or i not in many):
            values = values[~np.isnan(values)]
            cuts = values[:-1] / 2 + values[1:] / 2
        else:
            cuts = np.unique(found[f"q{i}"])
        top = -math.inf if found[f"m{i}"] is None else found[f"m{i}"]
        cuts = cuts[cuts < top]
        out.append(np.append(cuts, top) if found[f"n{i}"] and top > -math.inf else cuts)
    return out


def binned(df: DataFrame, features: Sequence[str], label: str, cuts: Sequence[np.ndarray], classes: int) -> DataFrame:
    """One row per block of a partition: its codes, feature by feature, a code being bin * classes + label. Stored."""
    kind = np.min_scalar_type((max(map(len, cuts), default=0) + 1) * classes - 1)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, n = TaskContext.get().partitionId(), 0, [], 0

        def block() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "n": pa.array([n], pa.int64()),
                "codes": pa.array([np.concatenate(held, axis=1).tobytes()], pa.binary())})

        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            held.append(np.stack([np.searchsorted(c, batch.column(i + 1).to_numpy(zero_copy_only=False)) * classes + y
                                  for i, c in enumerate(cuts)]).astype(kind))
            n += len(y)
            if n >= BLOCK_ROWS:
                yield block()
                seq, held, n = seq + 1, [], 0
        if n:
            yield block()

    rows = df.select(F.col(label).cast("double"), *[F.col(f).cast("double") for f in features])
    ensure_checkpoint_dir(df.sparkSession)
    # the checkpoint keeps the partitions, so each pass finds the same blocks in as many tasks
    return rows.mapInArrow(blocks, "part int, seq int, n long, codes binary").checkpoint(eager=True)


def bootstrap(n: int, *key: int) -> np.ndarray:
    """How often each of ``n`` rows is drawn: independent Poisson(1) counts, the same at every call with this key."""
    u = np.random.Generator(np.random.SFC64([k % 2**64 for k in key])).integers(0, 2**32, n, dtype=np.uint32)
    w = np.zeros(n, np.uint8)
    for c in POISSON:
        w += u >= c
    return w


@dataclass
class Tree:
    """Nodes by number, children after their parent: the left child's number (0: none), split and class counts."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    parent: list[int] = field(default_factory=lambda: [-1])
    gain: list[float] = field(default_factory=lambda: [-1.0])
    stats: list[np.ndarray | None] = field(default_factory=lambda: [None])

    def split(self, node: int, feature: int, at: int, gain: float, left: np.ndarray) -> None:
        self.feature[node], self.bin[node], self.gain[node], self.left[node] = feature, at, gain, len(self.left)
        for stats in (left, self.stats[node] - left):
            for column, value in ((self.feature, -1), (self.bin, 0), (self.left, 0), (self.parent, node),
                                  (self.gain, -1.0), (self.stats, stats)):
                column.append(value)

    def routes(self, asked: dict[int, int]) -> tuple[np.ndarray, ...]:
        """(feature, bin, left child, what to do) per node: the place in ``asked``, -2 on the way there, else -1."""
        do = np.full(len(self.left), -1, np.int32)
        for node, place in asked.items():
            do[node] = place
            while (node := self.parent[node]) >= 0 and do[node] != -2:
                do[node] = -2
        return np.array(self.feature, np.int32), np.array(self.bin, np.int32), np.array(self.left, np.int32), do


@dataclass
class Level:
    """What the tasks of one level need: each tree's routes, the features drawn for each asked node, codes per feature."""

    seed: int
    classes: int
    widths: np.ndarray
    routes: dict[int, tuple[np.ndarray, ...]]
    drawn: np.ndarray
    min_rows: int


def _histograms(level: Level, codes: np.ndarray, tree: int, counts: np.ndarray) -> dict[int, np.ndarray]:
    """Drawn rows per feature and code of each asked node of one tree over one block, by the node's place."""
    feature, at, left, do = (x.tolist() for x in level.routes[tree])
    weights, out = counts.astype(np.float64), {}
    todo = [(0, np.flatnonzero(counts))]
    while todo:
        node, rows = todo.pop()
        if do[node] == -1 or not len(rows):
            continue
        if do[node] >= 0:
            w = weights.take(rows)
            out[do[node]] = np.concatenate([np.bincount(codes[f].take(rows), w, level.widths[f])
                                            for f in level.drawn[do[node]].tolist()])
        else:
            right = codes[feature[node]].take(rows) >= (at[node] + 1) * level.classes
            if do[left[node]] != -1:
                todo.append((left[node], rows[~right]))
            if do[left[node] + 1] != -1:
                todo.append((left[node] + 1, rows[right]))
    return out


def _gini(counts: np.ndarray) -> np.ndarray:
    total = counts.sum(axis=-1)
    return 1 - (np.square(counts).sum(axis=-1)) / np.square(np.maximum(total, 1)) * (total > 0) - (total <= 0)


def choose(hists: np.ndarray, min_rows: int) -> tuple[np.ndarray, ...]:
    """Per node of ``hists`` (node, drawn feature, bin, class): the best split's place and bin, gain, counts, left counts."""
    below = hists.cumsum(axis=2)
    total = below[:, 0, -1]
    left = below[:, :, :-1]
    right = total[:, None, None] - left
    n, nl, nr = total.sum(axis=-1)[:, None, None], left.sum(axis=-1), right.sum(axis=-1)
    gain = _gini(total)[:, None, None] - (nl * _gini(left) + nr * _gini(right)) / np.maximum(n, 1)
    gain = np.where((nl >= min_rows) & (nr >= min_rows), gain, -np.inf).reshape(len(hists), -1)
    best = gain.argmax(axis=1)
    place, at = np.divmod(best, left.shape[2])
    every = np.arange(len(hists))
    return place, at, gain[every, best], total, left[every, place, at]


def _splits(blocks: DataFrame, level: Level) -> pa.Table:
    """The best split of every asked node: a pass over the blocks, then one over the nodes' summed histograms."""
    spark = blocks.sparkSession
    shared = spark.sparkContext.broadcast(vars(level))  # plain values: a broadcast does not bring classes along

    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = Level(**shared.value)
        kind = np.min_scalar_type(int(level.widths.max()) - 1)
        for batch in batches:
            for block in batch.to_pylist():
                codes = np.frombuffer(block["codes"], kind).reshape(len(level.widths), block["n"])
                for tree in level.routes:
                    counts = bootstrap(block["n"], level.seed, tree, block["part"], block["seq"])
                    found = _histograms(level, codes, tree, counts)
                    small = [h.astype("<u2" if h.max() < 2**16 else "<u4").tobytes() for h in found.values()]
                    yield pa.RecordBatch.from_pydict({"node": pa.array(found.keys(), pa.int32()),
                                                      "hist": pa.array(small, pa.binary())})

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, sums = Level(**shared.value), {}
        for batch in batches:
            for node, hist in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                size = int(level.widths[level.drawn[node]].sum())
                h = np.frombuffer(hist, "<u2" if len(hist) == 2 * size else "<u4")
                if node in sums:
                    sums[node] += h
                else:
                    sums[node] = h.astype(np.int64)
        nodes, bins = sorted(sums), max(int(level.widths.max()) // level.classes, 2)
        for start in range(0, len(nodes), NODES_AT_ONCE):
            some = nodes[start:start + NODES_AT_ONCE]
            hists = np.zeros((len(some), level.drawn.shape[1], bins * level.classes))
            for i, node in enumerate(some):
                ends = level.widths[level.drawn[node]].cumsum()
                for j, h in enumerate(np.split(sums[node], ends[:-1])):
                    hists[i, j, :len(h)] = h
            place, at, gain, total, left = choose(hists.reshape(*hists.shape[:2], bins, level.classes), level.min_rows)
            yield pa.RecordBatch.from_pydict({
                "node": pa.array(some, pa.int32()), "bin": pa.array(at, pa.int32()), "gain": pa.array(gain, pa.float64()),
                "feature": pa.array(level.drawn[some, place], pa.int32()),
                "total": pa.array(total.tolist(), pa.list_(pa.float64())),
                "left": pa.array(left.tolist(), pa.list_(pa.float64()))})

    hists = blocks.mapInArrow(taken, "node int, hist binary").repartition(max(blocks.rdd.getNumPartitions(), 1), "node")
    try:
        return hists.mapInArrow(chosen, "node int, bin int, gain double, feature int, total array<double>, "
                                        "left array<double>").toArrow()
    finally:
        shared.destroy()


def grow(blocks: DataFrame, widths: Sequence[int], classes: int, *, num_trees: int, max_depth: int, per_node: int,
         seed: int, min_rows: int = 1, min_gain: float = 0.0) -> list[Tree]:
    """The trees, all of them one level deeper with each pass; pure nodes and nodes without a gain stay leaves."""
    trees = [Tree() for _ in range(num_trees)]
    draw = np.random.Generator(np.random.SFC64([seed % 2**64]))
    asked, depth = [(t, 0) for t in range(num_trees)], 0
    while asked:
        by_tree: dict[int, dict[int, int]] = {}
        for place, (t, node) in enumerate(asked):
            by_tree.setdefault(t, {})[node] = place
        drawn = draw.random((len(asked), len(widths))).argsort(axis=1)[:, :per_node].astype(np.int32)
        found = _splits(blocks, Level(seed, classes, np.array(widths), {t: trees[t].routes(n) for t, n in by_tree.items()},
                                      drawn, min_rows)).sort_by("node")
        deeper = []
        for r in found.to_pylist():
            t, node = asked[r["node"]]
            tree = trees[t]
            tree.stats[node] = np.array(r["total"])
            if depth == max_depth or r["gain"] <= 0 or r["gain"] < min_gain:
                continue
            tree.split(node, r["feature"], r["bin"], r["gain"], np.array(r["left"]))
            first = tree.left[node]
            deeper += [(t, c) for c in (first, first + 1) if depth + 1 < max_depth and np.count_nonzero(tree.stats[c]) > 1]
        asked, depth = deeper, depth + 1
    for tree in trees:
        if tree.stats[0] is None:  # no row was drawn
            tree.stats[0] = np.zeros(classes)
    return trees


def node_rows(number: int, tree: Tree, cuts: Sequence[np.ndarray]) -> list[tuple]:
    """The nodes as Spark ML saves them, a split whose two sides predict the same made a leaf."""
    says = [int(s.argmax()) for s in tree.stats]
    leaf = [not c for c in tree.left]
    for node in reversed(range(len(leaf))):
        if not leaf[node] and (c := tree.left[node]) and leaf[c] and leaf[c + 1] and says[c] == says[c + 1]:
            leaf[node] = True
    place, order = {0: 0}, [0]
    for node in order:
        if not leaf[node]:
            for c in (tree.left[node], tree.left[node] + 1):
                place[c] = len(order)
                order.append(c)
    out = []
    for node in order:
        stats = tree.stats[node]
        split = (-1, [], -1) if leaf[node] else (tree.feature[node], [float(cuts[tree.feature[node]][tree.bin[node]])], -1)
        below = (-1, -1) if leaf[node] else (place[tree.left[node]], place[tree.left[node] + 1])
        out.append((number, (place[node], float(says[node]), float(_gini(stats)), stats.tolist(), int(stats.sum()),
                             -1.0 if leaf[node] else float(tree.gain[node]), *below, split)))
    return out


def fit_forest(df: DataFrame, features: Sequence[str], estimator: RandomForestClassifier) -> RandomForestClassificationModel:
    """``estimator`` fitted on all rows of ``df``; ``features`` are the columns its vector is assembled from.

    A forest of the same parameters is fitted by Spark ML on one row a class and saved; its nodes are replaced by
    the grown ones, in the saved form, and Spark ML loads the model.
    """
    spark, label = df.sparkSession, estimator.getLabelCol()
    y = F.col(label).cast("double")
    bad, top = df.agg(F.count_if(y.isNull() | F.isnan(y) | (y < 0) | (y != F.floor(y))), F.max(y)).first()
    if bad or top is None:
        raise ValueError(f"{label}: {bad} rows without a class 0, 1, ..." if bad else "no rows to train on")
    classes = int(top) + 1
    cuts = fit_bins(df, features, estimator.getMaxBins())
    trees = grow(binned(df, features, label, cuts, classes), [(len(c) + 1) * classes for c in cuts], classes,
                 num_trees=estimator.getNumTrees(), max_depth=estimator.getMaxDepth(),
                 per_node=math.ceil(math.sqrt(len(features))), seed=estimator.getSeed(),
                 min_rows=estimator.getMinInstancesPerNode(), min_gain=estimator.getMinInfoGain())
    path = new_folder(spark, "forest")
    empty = spark.createDataFrame([(float(k), Vectors.dense([float(k)] * len(features))) for k in range(classes)],
                                  [label, estimator.getFeaturesCol()]).coalesce(1)
    estimator.fit(empty).write().save(path)
    schema = spark.read.parquet(f"{path}/data").schema
    rows = [r for number, tree in enumerate(trees) for r in node_rows(number, tree, cuts)]
    spark.createDataFrame(rows, schema, verifySchema=False).write.mode("overwrite").parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)
