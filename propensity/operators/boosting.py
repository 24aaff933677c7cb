"""Gradient-boosted trees (M3) grown from compact rows.

MLlib's learner keeps an int for every slot of the feature vector of every
row and adds each of them to a histogram at every level of every tree,
although of a hashed vector's slots nearly all are zero. Here a row keeps one
small integer for each value that does not fall into its feature's bin of
zero; the bin of zero is what the node's totals leave. So time and memory
follow the non-zero entries instead of the vector's size.

The trees are MLlib's: the same candidate thresholds (from a sample of
``max(maxBins^2, 10000)`` rows, all rows below that), variance gains, stopping
rules, merging of equal leaves, log loss and learning rate; the result is an
MLlib model. Only sums are added in another order.

Rows are kept in blocks of a few arrays. A level is one pass over them, whose
result is (count, sum, sum of squares) by open node and bin; the pass of a
tree's first level also adds the tree before it to the rows' margins, and
these are kept for the other levels. Margins are checkpointed every
``checkpointInterval`` trees, so a lost executor does not replay all rounds.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import PARTITION_BYTES, checkpoint_dir, ship_package

#: Rows of a block, and the most partitions whose sums the driver adds up itself.
BLOCK_ROWS, DIRECT = 1 << 16, 64
#: Impurities below this count as none (MLlib's ``Utils.EPSILON``).
EPSILON = 2.0 ** -52


# ------------------------------------------------------------ rows to codes
@dataclass
class Bins:
    """Thresholds by feature and the code of each (feature, bin): bin ``b`` of
    feature ``f`` is ``first[f] + b``; ``size`` stands for no entry. A feature
    without thresholds has no codes."""
    thresholds: list
    first: np.ndarray = field(init=False)
    zero: np.ndarray = field(init=False)
    size: int = field(init=False)

    def __post_init__(self):
        n = np.array([len(t) + 1 if len(t) else 0 for t in self.thresholds], dtype=np.int64)
        self.first, self.size = np.cumsum(n) - n, int(n.sum())
        self.zero = np.array([np.searchsorted(t, 0.0) for t in self.thresholds], dtype=np.int64)

    @property
    def dtype(self):
        return np.uint16 if self.size < 1 << 16 else np.uint32


def entries(vectors: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value) of the non-zero values of a vector column, sparse or dense."""
    kind, parts = vectors.field("type").to_numpy(zero_copy_only=False), []
    for sparse in (True, False):
        at = np.flatnonzero((kind == 0) == sparse)
        if not len(at):
            continue
        some = vectors.take(pa.array(at))
        sizes = some.field("values").value_lengths().to_numpy(zero_copy_only=False)
        value = some.field("values").flatten().to_numpy(zero_copy_only=False)
        if sparse:
            feature = some.field("indices").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        else:
            feature = np.arange(len(value)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        keep = value != 0.0
        parts.append((np.repeat(at, sizes)[keep], feature[keep], value[keep]))
    if not parts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    return tuple(np.concatenate(p) for p in zip(*parts))


def vector_sizes(vectors: pa.StructArray) -> np.ndarray:
    sizes = vectors.field("size").to_numpy(zero_copy_only=False)
    dense = vectors.field("values").value_lengths().to_numpy(zero_copy_only=False)
    return np.where(vectors.field("type").to_numpy(zero_copy_only=False) == 0, sizes, dense)


def codes_of(vectors: pa.StructArray, bins: Bins) -> np.ndarray:
    """Codes of the values outside their features' bins of zero, (most entries
    of a row, rows), filled up with ``bins.size``."""
    row, feature, value = entries(vectors)
    order = np.argsort(feature, kind="stable")
    row, feature, value = row[order], feature[order], value[order]
    code = np.full(len(row), bins.size, dtype=np.int64)
    ends = np.searchsorted(feature, np.arange(len(bins.thresholds) + 1))
    for f, t in enumerate(bins.thresholds):
        a, b = ends[f], ends[f + 1]
        if a < b and len(t):
            at = np.searchsorted(t, value[a:b], side="left")
            code[a:b] = np.where(at == bins.zero[f], bins.size, bins.first[f] + at)
    order = np.argsort(row, kind="stable")
    order = order[code[order] < bins.size]
    row, code = row[order], code[order]
    per_row = np.bincount(row, minlength=len(vectors))
    out = np.full((int(per_row.max(initial=0)), len(vectors)), bins.size, dtype=bins.dtype)
    out[np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row), row] = code
    return out


def coded_blocks(data: DataFrame, label: str, features: str, bins: Bins) -> RDD:
    """(codes, labels as -1 and 1, margins) of up to about ``BLOCK_ROWS`` rows each, all margins 0."""
    schema = pa.schema([("width", pa.int32()), ("codes", pa.binary()), ("y", pa.binary())])
    dtype = bins.dtype

    def block(held: list) -> pa.RecordBatch:
        most = max(len(c) for c, _ in held)
        codes = np.concatenate([np.vstack([c, np.full((most - len(c), c.shape[1]), bins.size, dtype=dtype)]) for c, _ in held], axis=1)
        return pa.RecordBatch.from_pylist([{"width": most, "codes": codes.tobytes(), "y": np.concatenate([y for _, y in held]).tobytes()}], schema=schema)

    def run(batches):
        held, rows = [], 0
        for b in batches:
            y = b.column(0).to_numpy(zero_copy_only=False)
            if not np.isin(y, (0.0, 1.0)).all():
                raise ValueError("boosted trees take the labels 0 and 1")
            if len(y):
                held.append((codes_of(b.column(1), bins), (2 * y - 1).astype(np.int8)))
                rows += len(y)
            if rows >= BLOCK_ROWS:
                yield block(held)
                held, rows = [], 0
        if held:
            yield block(held)

    def arrays(r):
        y = np.frombuffer(r["y"], dtype=np.int8)
        return np.frombuffer(r["codes"], dtype=dtype).reshape(r["width"], len(y)), y, np.zeros(len(y))
    return data.select(F.col(label).cast("double"), features).mapInArrow(run, "width int, codes binary, y binary").rdd.map(arrays)


# ------------------------------------------------------------ thresholds
def thresholds_of(counts: dict, n_zero: int, n_splits: int) -> np.ndarray:
    """MLlib's candidate thresholds of one feature, from the counts of its
    sampled values without and with 0."""
    if not counts:
        return np.empty(0)
    values = sorted((counts | {0.0: n_zero} if n_zero else counts).items())
    if len(values) - 1 <= n_splits:
        return np.array([(a + b) / 2.0 for (a, _), (b, _) in zip(values, values[1:])])
    out, stride = [], sum(n for _, n in values) / (n_splits + 1)
    current, target = values[0][1], stride
    for (a, _), (b, n) in zip(values, values[1:]):
        before, current = current, current + n
        if abs(before - target) < abs(current - target):
            out.append((a + b) / 2.0)
            target += stride
    return np.array(out)


def candidate_thresholds(rows: DataFrame, prep: PipelineModel, features: str, n_rows: int, max_bins: int, seed: int) -> tuple[list, float]:
    """Candidate thresholds by feature from a sample of ``max(max_bins^2,
    10000)`` rows (the driver gets the distinct values of their non-zero
    entries), and the mean number of such entries a row."""
    wanted = max(max_bins * max_bins, 10000)
    some = rows if n_rows <= wanted else rows.sample(fraction=wanted / n_rows, seed=seed)

    def run(batches):  # feature -1: rows; -2: the vectors' size
        for b in batches:
            if b.num_rows:
                _, feature, value = entries(b.column(0))
                yield pa.RecordBatch.from_arrays([pa.array(np.append(feature, [-1, -2])),
                                                  pa.array(np.append(value, [float(b.num_rows), float(vector_sizes(b.column(0)).max())]))], names=["f", "v"])
    n, size, counts = 0, 0, {}
    found = prep.transform(some).select(features).mapInArrow(run, "f bigint, v double")
    for f, v, k in found.groupBy("f", "v").agg(F.count(F.lit(1)).alias("n")).collect():
        if f == -1:
            n += int(v) * k
        elif f == -2:
            size = max(size, int(v))
        else:
            counts.setdefault(f, {})[v] = k
    seen = {f: sum(c.values()) for f, c in counts.items()}
    n_splits = min(max_bins, n_rows) - 1
    return [thresholds_of(counts.get(f, {}), n - seen.get(f, 0), n_splits) for f in range(size)], sum(seen.values()) / max(1, n)


# ------------------------------------------------------------ trees
@dataclass
class Node:
    """Sums (count, sum, sum of squares) of the rows that reach a node, and its split if any."""
    sums: np.ndarray
    feature: int = -1
    bin: int = -1
    gain: float = 0.0
    left: int = -1
    right: int = -1


def impurity(sums: np.ndarray):
    """Variance, along the first axis (count, sum, sum of squares)."""
    n = np.maximum(sums[0], 1.0)
    return (sums[2] - sums[1] * sums[1] / n) / n


class Router:
    """A (growing) tree as arrays that send rows down: a row goes left where
    one of its codes being within ``width`` of ``low`` differs from ``swap``;
    a node without a split leads to itself."""

    def __init__(self, nodes: list, bins: Bins):
        k = len(nodes)
        self.low, self.width = np.zeros(k, bins.dtype), np.zeros(k, bins.dtype)
        self.swap, self.child = np.zeros(k, bool), np.repeat(np.arange(k), 2)
        self.value = np.array([n.sums[1] / n.sums[0] if n.sums is not None and n.sums[0] else 0.0 for n in nodes])
        for i, n in enumerate(nodes):
            if n.feature < 0:
                continue
            first, last = bins.first[n.feature], bins.first[n.feature] + len(bins.thresholds[n.feature])
            self.swap[i] = bins.zero[n.feature] <= n.bin  # no entry: left
            low, high = (first + n.bin + 1, last) if self.swap[i] else (first, first + n.bin)
            self.low[i], self.width[i] = low, high + 1 - low
            self.child[2 * i], self.child[2 * i + 1] = n.right, n.left

    def reached(self, codes: np.ndarray, steps: int) -> np.ndarray:
        node = np.zeros(codes.shape[1], dtype=np.int64)
        for _ in range(steps):
            low, width, hit = self.low[node], self.width[node], np.zeros(len(node), dtype=bool)
            for c in codes:
                hit |= (c - low) < width  # unsigned: a code below wraps round
            node = self.child[2 * node + (hit ^ self.swap[node])]
        return node


def level_sums(blocks: RDD, router: Router, steps: int, open_nodes: list, size: int, first_tree: bool) -> np.ndarray:
    """(count, sum, sum of squares) of the rows' targets by open node and
    code, the node's totals behind the last code: one pass."""
    slots = np.full(len(router.swap), len(open_nodes))  # rows of other nodes count in a slot behind
    slots[open_nodes] = np.arange(len(open_nodes))
    n_slots, n_codes = len(open_nodes) + 1, size + 1

    def run(part):
        out, totals = np.zeros((3, n_slots * n_codes)), np.zeros((3, n_slots))
        for codes, y, margin in part:
            target = y.astype(np.float64) if first_tree else 4.0 * y / (1.0 + np.exp(2.0 * y * margin))
            at, weights = slots[router.reached(codes, steps)], (None, target, target * target)
            first = at * n_codes
            for i, sums in [(at, totals), *((first + c, out) for c in codes)]:
                for s, w in zip(sums, weights):
                    s += np.bincount(i, w, len(s))
        out = out.reshape(3, n_slots, n_codes)
        out[:, :, size] = totals
        yield out[:, :-1]
    parts = blocks.mapPartitions(run)
    return parts.treeReduce(np.add) if blocks.getNumPartitions() > DIRECT else sum(parts.collect())


def with_tree(blocks: RDD, router: Router, depth: int, weight: float) -> RDD:
    """The blocks with a tree's values added to their margins."""
    def add(block):
        codes, y, margin = block
        return codes, y, margin + weight * router.value[router.reached(codes, depth)]
    return blocks.map(add)


class Splitter:
    """The best split of a node: the highest gain, the first of equals in
    order of features and thresholds."""

    def __init__(self, bins: Bins):
        self.features = np.array([f for f, t in enumerate(bins.thresholds) if len(t)], dtype=np.int64)
        n = np.array([len(bins.thresholds[f]) + 1 for f in self.features], dtype=np.int64)
        b = np.arange(int(n.max(initial=0)))
        self.code = np.where(b < n[:, None], bins.first[self.features][:, None] + b, -1) if len(n) else np.empty((0, 0), np.int64)
        self.zero, self.valid = bins.zero[self.features], b[:-1] < n[:, None] - 1

    def best(self, sums: np.ndarray) -> tuple | None:
        """(feature, bin, gain, sums left, sums right) from a node's ``level_sums``."""
        if not len(self.features):
            return None
        total = sums[:, -1]
        by_bin = np.where(self.code >= 0, sums[:, self.code], 0.0)
        by_bin[:, np.arange(len(self.zero)), self.zero] = total[:, None] - by_bin.sum(axis=2)  # their codes are never used
        left = by_bin.cumsum(axis=2)[:, :, :-1]
        right = total[:, None, None] - left
        gain = impurity(total) - left[0] / total[0] * impurity(left) - right[0] / total[0] * impurity(right)
        gain = np.where(self.valid & (left[0] >= 1) & (right[0] >= 1), gain, -np.inf)
        i, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
        if not gain[i, b] > 0.0:
            return None
        return int(self.features[i]), int(b), float(gain[i, b]), left[:, i, b], right[:, i, b]


def grow(blocks: RDD, bins: Bins, splitter: Splitter, max_depth: int, first_tree: bool) -> list:
    """The nodes of one regression tree on the rows' targets, the root first."""
    nodes, open_nodes = [Node(None)], [0]
    for depth in range(max_depth):
        sums = level_sums(blocks, Router(nodes, bins), depth, open_nodes, bins.size, first_tree)
        nodes[0].sums = sums[:, 0, -1] if depth == 0 else nodes[0].sums
        following = []
        for k, i in enumerate(open_nodes):
            if split := splitter.best(sums[:, k]):
                node = nodes[i]
                node.feature, node.bin, node.gain = split[:3]
                node.left, node.right = len(nodes), len(nodes) + 1
                nodes += [Node(split[3]), Node(split[4])]
                following += [j for j in (node.left, node.right) if abs(impurity(nodes[j].sums)) >= EPSILON]
        if not following:
            break
        open_nodes = following
    return nodes


def java_tree(spark: SparkSession, nodes: list, bins: Bins):
    """MLlib's regression tree of these nodes; leaves of one value are merged, as MLlib does."""
    jvm = spark.sparkContext._jvm
    ml, arrays, new_stats = jvm.org.apache.spark.ml, jvm.java.util.Arrays, jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
    new_split, new_inner, new_leaf = ml.tree.ContinuousSplit, ml.tree.InternalNode, ml.tree.LeafNode  # each lookup asks the JVM
    sums = np.array([n.sums for n in nodes], dtype="<f8")
    flat = spark.sparkContext._gateway.new_array(jvm.double, sums.size)
    jvm.java.nio.ByteBuffer.wrap(bytearray(sums.tobytes())).order(jvm.java.nio.ByteOrder.LITTLE_ENDIAN).asDoubleBuffer().get(flat)

    def built(i: int):
        n = nodes[i]
        value, spread = float(n.sums[1] / n.sums[0]), float(impurity(n.sums))
        low = None
        if n.feature >= 0:
            (low, a), (high, b) = built(n.left), built(n.right)
            low = None if a is not None and a == b else low
        stats = new_stats(arrays.copyOfRange(flat, 3 * i, 3 * i + 3), int(n.sums[0]))
        if low is None:
            return new_leaf(value, spread, stats), value
        return new_inner(value, spread, n.gain, low, high, new_split(n.feature, float(bins.thresholds[n.feature][n.bin])), stats), None
    return ml.regression.DecisionTreeRegressionModel(built(0)[0], len(bins.thresholds))


# ------------------------------------------------------------ boosting
def grows_here(clf, data: DataFrame) -> bool:
    """Whether the trees that ``clf`` asks for are those grown here; others are left to MLlib."""
    if not isinstance(clf, GBTClassifier):
        return False
    plain = {"subsamplingRate": 1.0, "featureSubsetStrategy": "all", "minInstancesPerNode": 1, "minInfoGain": 0.0,
             "minWeightFractionPerNode": 0.0, "lossType": "logistic", "impurity": "variance"}
    other = any(clf.isSet(p) for p in ("weightCol", "validationIndicatorCol", "thresholds"))
    nominal = "nominal" in data.schema[clf.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
    return not other and not nominal and clf.getMaxDepth() > 0 and all(clf.getOrDefault(p) == v for p, v in plain.items())


def fit_boosted(clf: GBTClassifier, rows: DataFrame, prep: PipelineModel) -> GBTClassificationModel:
    """``clf`` fitted on ``prep.transform(rows)``, whose vectors are not kept.
    ``rows`` is read three times (counted, sampled, coded) and should be kept."""
    spark, label, features = rows.sparkSession, clf.getLabelCol(), clf.getFeaturesCol()
    data = prep.transform(rows)
    if not grows_here(clf, data) or not (n_rows := rows.count()):
        kept = data.select(label, features).persist()
        try:
            return clf.fit(kept)
        finally:
            kept.unpersist()
    ship_package(spark)
    checkpoint_dir(spark)
    thresholds, mean_entries = candidate_thresholds(rows, prep, features, n_rows, clf.getMaxBins(), clf.getSeed())
    bins = Bins(thresholds)
    splitter = Splitter(bins)
    row_bytes = mean_entries * bins.dtype().itemsize + 9
    # one wave of tasks: a pass over few rows costs less than the start of its tasks
    parts = max(spark.sparkContext.defaultParallelism, int(n_rows * row_bytes / PARTITION_BYTES) + 1)
    blocks = coded_blocks(data, label, features, bins).coalesce(parts).persist(StorageLevel.MEMORY_AND_DISK)
    trees, weights, every, written = [], [], clf.getCheckpointInterval(), None
    try:
        for m in range(clf.getMaxIter()):
            if m:
                before = blocks
                blocks = with_tree(before, Router(trees[-1], bins), clf.getMaxDepth(), weights[-1]).persist(StorageLevel.MEMORY_AND_DISK)
                if every > 0 and m % every == 0:
                    blocks.checkpoint()
            trees.append(grow(blocks, bins, splitter, clf.getMaxDepth(), first_tree=not m))
            weights.append(clf.getStepSize() if m else 1.0)
            if m:
                before.unpersist()
                if blocks.isCheckpointed():
                    _remove(spark, written)
                    written = blocks.getCheckpointFile()
    finally:
        blocks.unpersist()
        _remove(spark, written)
    ml, gateway = spark.sparkContext._jvm.org.apache.spark.ml, spark.sparkContext._gateway
    grown = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(trees))
    scale = gateway.new_array(gateway.jvm.double, len(trees))
    for i, (nodes, w) in enumerate(zip(trees, weights)):
        grown[i], scale[i] = java_tree(spark, nodes, bins), w
    java = ml.classification.GBTClassificationModel(clf.uid, grown, scale, len(thresholds), 2)
    model = clf._copyValues(GBTClassificationModel(java))
    model._transfer_params_to_java()
    return model


def _remove(spark: SparkSession, path: str | None) -> None:
    if path:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
