"""Large forests for two classes: each tree is grown by one task and kept in a table, away from the driver.

The method is that of Spark's random forest: values are sorted into bins, a tree draws a bootstrap of all rows, a
node tries the square root of the features, and children that decide alike are merged. What differs is who does it.
A fit of Spark sends the statistics of every node to one place and holds all nodes on the driver. Here the rows travel
once, as bins of a byte each, to the tasks, and only finished trees come back.
"""

from __future__ import annotations

import math
import tempfile
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperlane.session import materialize

TREES_PER_TASK = 5
ROWS_PER_PACK = 4096
NODES_AT_ONCE = 4096  # nodes of a level whose counts are held together
SENT_BYTES = 16 << 20  # of the trees that a job is sent with
ODD = 2.0**26  # a sum of weights and, ODD-fold, of those of class 1 fit one double

# Of each node the feature, or -1, and the cut; of each leaf the share of class 1. Nodes stand level by level, so the
# children of the i-th node with a cut are nodes 2 i + 1 and 2 i + 2.
Tree = tuple[np.ndarray, np.ndarray, np.ndarray]
_TYPES = (np.dtype("<i4"), np.dtype("u1"), np.dtype("<f8"))
_NODE_BYTES = 9  # as every other node is a leaf


@dataclass(frozen=True)
class GrownTrees:
    """Some trees of a forest, in the table that the tasks left them in."""

    table: DataFrame
    cuts: np.ndarray
    features: str
    first: int
    sizes: tuple[int, ...]  # nodes of each tree

    @property
    def getNumTrees(self) -> int:  # noqa: N802  as in Spark's models
        return len(self.sizes)

    @property
    def trees(self) -> list[GrownTrees]:
        return [replace(self, first=self.first + i, sizes=(size,)) for i, size in enumerate(self.sizes)]

    def load(self) -> list[Tree]:
        """The trees themselves, to be sent with a job; all of a forest may be more than the driver holds."""
        rows = self.table.filter(F.col("tree").between(self.first, self.first + len(self.sizes) - 1)).collect()
        return [
            tuple(np.frombuffer(row[name], kind) for name, kind in zip(("feature", "cut", "share"), _TYPES, strict=True))
            for row in sorted(rows, key=lambda row: row["tree"])
        ]

    @property
    def toDebugString(self) -> str:  # noqa: N802
        lines = [f"GrownTrees: {len(self.sizes)} trees, {sum(self.sizes)} nodes"]
        for feature, cut, share in self.load():
            inner, leaf = np.cumsum(feature >= 0), np.cumsum(feature < 0) - 1
            for i, (f, c) in enumerate(zip(feature, cut, strict=True)):
                to = 2 * inner[i] - 1
                lines.append(f"{i}: feature {f} <= {self.cuts[f, c]} to {to}, else {to + 1}" if f >= 0 else f"{i}: {share[leaf[i]]}")
        return "\n".join(lines)


def fits(classifier: RandomForestClassifier, df: DataFrame) -> bool:
    """Whether the settings are among those that ``grow`` follows."""
    kinds = str(df.schema[classifier.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {}).keys())
    plain = not classifier.isDefined(classifier.weightCol) and not classifier.getMinWeightFractionPerNode()
    return (
        plain and classifier.getImpurity() == "gini" and classifier.getFeatureSubsetStrategy() == "sqrt"
        and classifier.getBootstrap() and classifier.getMaxBins() <= 256 and "nominal" not in kinds and "binary" not in kinds
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _batches(batches: Iterable[pa.RecordBatch], rows: int = ROWS_PER_PACK) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _survey(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number and range of the values by feature and leading bits, without zeros; labels as feature -1."""
    for batch in _batches(batches):
        x, y = _matrix(batch.column(0)), batch.column(1)
        if y.null_count or not np.isfinite(y.to_numpy()).all():
            raise ValueError("a label is missing")
        values, labels = x[(x != 0) & ~np.isnan(x)], np.unique(y.to_numpy(), return_counts=True)
        bits = values.view(np.int64)
        # in the order of the values: sign, exponent, six digits
        leading = (bits ^ ((bits >> 63) & np.int64(2**63 - 1))) >> 46
        keys = np.nonzero((x != 0) & ~np.isnan(x))[1] * 2**18 + leading + 2**17
        order = np.argsort(keys, kind="stable")
        found, start, n = np.unique(keys[order], return_index=True, return_counts=True)
        low = np.minimum.reduceat(values[order], start) if len(start) else values
        high = np.maximum.reduceat(values[order], start) if len(start) else values
        yield pa.record_batch({
            "feature": pa.array(np.append(found // 2**18, np.full(len(labels[0]), -1)), pa.int32()),
            "bucket": pa.array(np.append(found % 2**18, np.arange(len(labels[0]))), pa.int32()),
            "n": pa.array(np.append(n, labels[1]), pa.int64()),
            "low": np.append(low, labels[0]), "high": np.append(high, labels[0]),
        })


def feature_cuts(n: np.ndarray, low: np.ndarray, high: np.ndarray, zeros: int, bins: int) -> np.ndarray:
    """Values that part a feature into so many bins at most; a value up to a cut lies below it.

    Few distinct values are all told apart. Otherwise zeros have a bin of their own, and the others are parted evenly,
    by linear interpolation between the least and the greatest value of a bucket.
    """
    if np.array_equal(low, high) and len(n) + (zeros > 0) <= bins:
        values = np.sort(np.append(low, [0.0] * (zeros > 0)))
        return values[:-1] + (values[1:] - values[:-1]) / 2
    sides = [side for side in (low[low > 0][:1] / 2, high[high < 0][-1:] / 2) if zeros and len(side)]
    room = bins - 1 - len(sides)
    ends = np.cumsum(n)
    at = ends[-1] * np.arange(1, room + 1) / (room + 1)
    i = np.searchsorted(ends, at)
    inner = low[i] + (at - (ends[i] - n[i])) / n[i] * (high[i] - low[i])
    cuts = np.unique(np.concatenate([*sides, inner]))
    return cuts[~np.isnan(cuts)]


def _cuts(rows: DataFrame, bins: int, features: int) -> tuple[np.ndarray, int] | None:
    """Cuts of all features and the number of rows; None if labels are others than 0 and 1, or rows too many to be summed."""
    kinds = "feature int, bucket int, n bigint, low double, high double"
    surveyed = rows.mapInArrow(_survey, kinds).groupBy("feature", "bucket")
    # a few hundred buckets a feature
    table = surveyed.agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")).toArrow()
    feature, bucket, n, low, high = (table[name].to_numpy() for name in ("feature", "bucket", "n", "low", "high"))
    labels = feature == -1
    if set(low[labels]) | set(high[labels]) != {0.0, 1.0}:
        return None
    total = int(n[labels].sum())
    if total > ODD / 2:
        return None
    cuts = np.full((features, bins - 1), np.inf)
    for f in range(features):
        at = np.flatnonzero(feature == f)
        at = at[np.argsort(bucket[at])]
        found = feature_cuts(n[at], low[at], high[at], total - int(n[at].sum()), bins)
        cuts[f, : len(found)] = found
    return cuts, total


def binned(x: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Number of cuts below each value, a row for each feature; what is no number lies above all."""
    out = np.empty((len(cuts), len(x)), np.uint8)
    for f, own in enumerate(cuts):
        out[f] = np.searchsorted(own, x[:, f])
    return out


def _pack(cuts: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            bins, labels = binned(_matrix(batch.column(0)), cuts), batch.column(1).to_numpy().astype(np.uint8)
            packed = pa.compress(bins.tobytes(), "zstd", asbytes=True)
            yield pa.record_batch({"bins": pa.array([packed], pa.binary()), "labels": pa.array([labels.tobytes()], pa.binary())})

    return run


class _Rows:
    """All rows as a task gets them: bins in a file that is gone with the task, labels, and hashes of both."""

    def __init__(self, features: int, n: int):
        with tempfile.TemporaryFile() as file:
            self.bins = np.memmap(file, np.uint8, "w+", shape=(features, n))
        self.labels, self.hashes, self.n = np.zeros(n, np.uint8), np.zeros(n, np.uint64), 0
        self.factors = np.random.default_rng(7).integers(1, 2**63, features + 1, dtype=np.uint64)

    def add(self, bins: pa.Buffer, labels: pa.Buffer) -> None:
        y = np.frombuffer(labels, np.uint8)
        x = np.frombuffer(pa.decompress(bins, len(self.bins) * len(y), "zstd"), np.uint8).reshape(-1, len(y))
        here = slice(self.n, self.n + len(y))
        self.bins[:, here], self.labels[here] = x, y
        hashes = y * self.factors[-1]
        for row, factor in zip(x, self.factors, strict=False):
            hashes += row * factor
        self.hashes[here] = hashes
        self.n += len(y)


def _drawn(draw: np.random.Generator, nodes: int, features: int, tries: int) -> np.ndarray:
    """So many different features for each node, in order; Floyd's method, by which all sets are equally likely."""
    out = np.full((nodes, tries), -1)
    for i, last in enumerate(range(features - tries, features)):
        pick = draw.integers(0, last + 1, nodes)
        out[:, i] = np.where((out[:, :i] == pick[:, None]).any(1), last, pick)
    return np.sort(out, 1)


def _share_of_squares(some: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Squares by sums, 0 for 0 by 0; both arrays are overwritten."""
    some *= some
    some /= np.maximum(of, 1, out=of)
    return some


def _best_splits(bins, rows, value, sizes, total, ones, tried, width, least):
    """Feature, cut and purity of the best split of each node; rows of a node stand together."""
    k, n = len(sizes), bins.shape[1]
    flat, each = bins.reshape(-1), np.arange(k)
    slot = np.repeat(each * width, sizes)
    best, feature, cut = np.full(k, -np.inf), np.zeros(k, np.int32), np.zeros(k, np.uint8)
    for f in tried.T:
        at = np.repeat(f * n, sizes)
        at += rows
        at = flat.take(at) + slot
        below = np.bincount(at, value, k * width).reshape(k, width)[:, :-1].cumsum(1)
        p = np.floor(below * (1 / ODD))
        t = below
        t -= p * ODD
        above, q = total[:, None] - t, ones[:, None] - p
        # a child without rows gains nothing
        few = (t < least) | (above < least) if least > 1 else None
        # the Gini gain grows with this sum
        purity = _share_of_squares(p, t)
        purity += _share_of_squares(q, above)
        if few is not None:
            purity[few] = -np.inf
        c = purity.argmax(1)
        found = purity[each, c]
        better = found > best
        best[better], feature[better], cut[better] = found[better], f[better], c[better]
    return feature, cut, best


def grow_tree(
    bins: np.ndarray, labels: np.ndarray, weights: np.ndarray, width: int, depth: int, least: int, gain: float,
    draw: np.random.Generator,
) -> Tree:
    """One tree over the rows with a weight, level by level."""
    features, n = bins.shape
    tries = max(1, math.ceil(math.sqrt(features)))
    bins = np.asarray(bins)
    flat = bins.reshape(-1)
    rows = np.flatnonzero(weights)
    value = weights[rows] * (1.0 + ODD * labels[rows])
    sizes, ones = np.array([len(rows)]), np.array([float(weights[labels == 1].sum())])
    total = np.array([float(weights.sum())])
    levels: list[list[np.ndarray]] = []
    for level in range(depth + 1):
        k = len(total)
        feature, cut, left = np.full(k, -1, np.int32), np.zeros(k, np.uint8), np.full(k, -1, np.int64)
        levels.append([feature, cut, left, total, ones])
        mixed = (ones > 0) & (ones < total) & (level < depth)
        kept = np.repeat(mixed, sizes)
        rows, value, sizes, at = rows[kept], value[kept], sizes[mixed], np.flatnonzero(mixed)
        starts = np.append(0, np.cumsum(sizes))
        for a in range(0, len(at), NODES_AT_ONCE):
            b = min(a + NODES_AT_ONCE, len(at))
            here, nodes = slice(starts[a], starts[b]), at[a:b]
            tried = _drawn(draw, b - a, features, tries)
            f, c, purity = _best_splits(bins, rows[here], value[here], sizes[a:b], total[nodes], ones[nodes], tried, width, least)
            whole = ones[nodes] ** 2 / total[nodes]
            split = (purity > whole * (1 + 1e-12)) & (2 * (purity - whole) / total[nodes] >= gain)
            feature[nodes[split]], cut[nodes[split]] = f[split], c[split]
        split = feature[at] >= 0
        if not split.any():
            break
        kept = np.repeat(split, sizes)
        rows, value, sizes, at = rows[kept], value[kept], sizes[split], at[split]
        left[at] = 2 * np.arange(len(at))
        # within each node, rows of the left child come first
        goes = flat[np.repeat(feature[at].astype(np.int64) * n, sizes) + rows] > np.repeat(cut[at], sizes)
        starts = np.append(0, np.cumsum(sizes))
        n_right = np.append(0, np.cumsum(goes))
        to_right = n_right[starts[1:]] - n_right[starts[:-1]]
        before = n_right[:-1] - np.repeat(n_right[starts[:-1]], sizes)
        inside = np.arange(len(rows)) - np.repeat(starts[:-1], sizes)
        place = np.repeat(starts[:-1], sizes) + np.where(goes, np.repeat(sizes - to_right, sizes) + before, inside - before)
        moved, valued = np.empty_like(rows), np.empty_like(value)
        moved[place], valued[place] = rows, value
        rows, value = moved, valued
        sizes = np.stack([sizes - to_right, to_right], 1).reshape(-1)
        sums = np.add.reduceat(value, np.append(0, np.cumsum(sizes)[:-1]))
        ones = np.floor(sums / ODD)
        total = sums - ones * ODD
    return _merged(levels)


def _merged(levels: list[list[np.ndarray]]) -> Tree:
    """The nodes of all levels in one list. Two leaves that decide alike are left to their parent, from the last level up."""
    for (feature, _, left, _, _), (below, _, _, total, ones) in zip(levels[-2::-1], levels[:0:-1], strict=True):
        at = np.flatnonzero(feature >= 0)
        one, other = left[at], left[at] + 1
        decides = 2 * ones > total
        alike = at[(below[one] < 0) & (below[other] < 0) & (decides[one] == decides[other])]
        feature[alike], left[alike] = -1, -1
    kept, out = np.array([0]), []
    for feature, cut, left, total, ones in levels:
        inner = feature[kept] >= 0
        out.append((feature[kept], cut[kept], (ones[kept] / np.maximum(total[kept], 1))[~inner]))
        kept = np.stack([left[kept][inner], left[kept][inner] + 1], 1).reshape(-1)
    return tuple(np.concatenate(x).astype(kind) for x, kind in zip(zip(*out, strict=True), _TYPES, strict=True))


def _grow_some(n: int, features: int, trees: int, settings: dict):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, _Rows] = {}
        for batch in batches:
            for task, bins, labels in zip(*batch.columns, strict=True):
                if task.as_py() not in held:
                    held[task.as_py()] = _Rows(features, n)
                held[task.as_py()].add(bins.as_buffer(), labels.as_buffer())
        for task, rows in held.items():
            if rows.n != n:
                raise ValueError(f"{rows.n} of {n} rows have come")
            # equal rows stand for each other, so a bootstrap does not depend on where rows lie
            order = np.argsort(rows.hashes, kind="stable")
            for tree in range(task * TREES_PER_TASK, min(trees, (task + 1) * TREES_PER_TASK)):
                draw = np.random.default_rng([settings["seed"] % 2**64, tree])
                weights = np.zeros(n, np.uint8)
                weights[order] = draw.poisson(settings["rate"], n)
                grown = grow_tree(
                    rows.bins, rows.labels, weights, settings["bins"], settings["depth"], settings["least"], settings["gain"], draw
                )
                nodes = [pa.array([x.tobytes()], pa.binary()) for x in grown]
                yield pa.record_batch(
                    [pa.array([tree], pa.int32()), pa.array([len(grown[0])], pa.int32()), *nodes],
                    ["tree", "n_nodes", "feature", "cut", "share"],
                )

    return run


def grow(classifier: RandomForestClassifier, df: DataFrame, parts: Sequence[int]) -> list[GrownTrees] | None:
    """Grow a forest in parts of so many trees; None if the labels are others than 0 and 1, or rows more than 33 million.

    A task grows five trees over all rows. It holds the bins of all rows in a file, a byte for each feature, and some
    hundred bytes a row in memory. The same rows give the same forest wherever they lie.
    """
    name, label = classifier.getFeaturesCol(), classifier.getLabelCol()
    rows = df.select(vector_to_array(name).alias("x"), F.col(label).cast("double").alias("y"))
    features = len(rows.select("x").first()["x"])
    bins, trees = classifier.getMaxBins(), classifier.getNumTrees()
    surveyed = _cuts(rows, bins, features)
    if surveyed is None:
        return None
    cuts, n = surveyed
    settings = {
        "seed": classifier.getSeed(), "rate": classifier.getSubsamplingRate(), "bins": bins, "depth": classifier.getMaxDepth(),
        "least": classifier.getMinInstancesPerNode(), "gain": classifier.getMinInfoGain(),
    }
    packs = materialize(rows.mapInArrow(_pack(cuts), "bins binary, labels binary"), "packs")
    tasks = -(-trees // TREES_PER_TASK)
    sent = packs.select(F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("task"), "bins", "labels")
    kinds = "tree int, n_nodes int, feature binary, cut binary, share binary"
    grown = sent.repartitionById(tasks, "task").mapInArrow(_grow_some(n, features, trees, settings), kinds)
    table = materialize(grown, "trees")
    sizes = [row["n_nodes"] for row in table.select("tree", "n_nodes").orderBy("tree").collect()]
    firsts = [sum(parts[:i]) for i in range(len(parts))]
    return [GrownTrees(table, cuts, name, first, tuple(sizes[first : first + part])) for first, part in zip(firsts, parts, strict=True)]


def in_turns(trees: Iterable[GrownTrees], most: int, sent_bytes: int = SENT_BYTES) -> Iterator[list[GrownTrees]]:
    """Single trees, as many together as a job may be sent with."""
    some: list[GrownTrees] = []
    for tree in trees:
        if some and (len(some) == most or sum(sum(x.sizes) for x in [*some, tree]) * _NODE_BYTES > sent_bytes):
            yield some
            some = []
        some.append(tree)
    if some:
        yield some


def shares(bins: np.ndarray, tree: Tree) -> np.ndarray:
    """What a tree says of class 1 for each row; bins have a row for each feature."""
    feature, cut, share = tree
    inner = feature >= 0
    before = np.cumsum(inner, dtype=np.int32) - inner
    at, rows = np.zeros(bins.shape[1], np.int32), np.arange(bins.shape[1])
    while len(rows):
        node = at[rows]
        deeper = inner[node]
        rows, node = rows[deeper], node[deeper]
        at[rows] = 2 * before[node] + 1 + (bins[feature[node], rows] > cut[node])
    return share[at - before[at]]


def asked(spark: SparkSession, some: Sequence[GrownTrees]) -> tuple[Column, object]:
    """Votes of some trees in their order, as an array, and what is to be destroyed once they have been written."""
    first = some[0]
    together = replace(first, sizes=tuple(size for tree in some for size in tree.sizes))
    sent = spark.sparkContext.broadcast((first.cuts, together.load()))

    @F.arrow_udf("array<double>")
    def votes(column: pa.Array) -> pa.Array:
        cuts, trees = sent.value
        bins = binned(_matrix(column), cuts)
        found = np.stack([shares(bins, tree) for tree in trees], 1)
        ends = np.arange(len(column) + 1, dtype=np.int32) * len(trees)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(found.reshape(-1)))

    return votes(vector_to_array(first.features)), sent
