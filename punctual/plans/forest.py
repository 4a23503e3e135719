"""Random forests fitted on the entries of sparse rows, for vectors that are mostly one-hot codes.

``RandomForestClassifier`` keeps a whole number per slot of the vector and one per tree for every row, as objects.
``EntryForest`` grows its trees by the same rules (candidates, a draw of slots per node, Poisson counts per row and tree, gain
by the Gini impurity, two leaves of one class become one) and gives the same kind of model, from rows packed in blocks of
arrays: bin numbers of the entries, labels and a byte per tree. Other rows and slots are drawn than Spark ML would draw.

A pass is one job per level of all trees. A task adds up its blocks, which it spreads out one at a time, in a table per
tree (nodes x the bins of the slots drawn for them); the tables of a tree are summed in a group of its own, where its
splits are picked. So the driver sees nothing but splits, and what is shuffled doesn't depend on the number of rows. Where
the tables of a level need more than ``maxMemoryInMB``, some trees after others have a pass.

Settings that need more (weights, more than two labels, another impurity, other draws) go to ``RandomForestClassifier``.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .boosting import BLOCK_ROWS, EPSILON, NODES, PART_ROWS, Bins, find_bins, in_blocks, packed_bins

BLOCKS = "width INT, bins BINARY, label BINARY, counts BINARY"
_ARROW = pa.schema([("width", pa.int32()), *[(name, pa.binary()) for name in ("bins", "label", "counts")]])
TABLES = "tree INT, sums BINARY"
SPLITS = "tree INT, node INT, gain DOUBLE, slot INT, cut INT, zeros LONG, ones LONG, left_zeros LONG, left_ones LONG"
# A cut that no bin lies beyond: rows stay in a leaf.
NO_CUT = 255


@dataclass
class Tree:
    """Nodes in order of growth; the right child follows the left one, a leaf has itself as left child."""

    left: list[int] = field(default_factory=lambda: [0])
    slot: list[int] = field(default_factory=lambda: [0])
    cut: list[int] = field(default_factory=lambda: [NO_CUT])
    gain: list[float] = field(default_factory=lambda: [-1.0])
    counts: list[tuple[int, int]] = field(default_factory=lambda: [(0, 0)])

    def add(self, counts: tuple[int, int]) -> int:
        at = len(self.left)
        self.left.append(at)
        self.slot.append(0)
        self.cut.append(NO_CUT)
        self.gain.append(-1.0)
        self.counts.append(counts)
        return at


@dataclass(frozen=True)
class Level:
    """What a pass needs of one tree: its nodes, and for each growing one the drawn slots and where their bins are counted.

    ``places`` has the growing nodes twice, for the rows of label 0 and for those of label 1.
    """

    left: np.ndarray
    slot: np.ndarray
    cut: np.ndarray
    group: np.ndarray
    slots: np.ndarray
    places: np.ndarray
    cells: int


def _sizes(bins: Bins) -> np.ndarray:
    return np.array([2 if cuts is None else len(cuts) + 1 for cuts in bins.thresholds], np.intp)


def _level(tree: Tree, growing: list[int], slots: np.ndarray, sizes: np.ndarray) -> Level:
    group = np.full(len(tree.left), -1, np.intp)
    group[growing] = np.arange(len(growing))
    widths = sizes[slots].ravel()
    ends = np.cumsum(widths)
    places = (ends - widths).reshape(slots.shape)
    nodes = [np.array(tree.left, np.intp), np.array(tree.slot, np.intp), np.array(tree.cut, np.uint8)]
    return Level(*nodes, group, slots, np.concatenate([places, places + ends[-1]]), int(ends[-1]))


def _pack(bins: Bins, trees: int, seed: int, bootstrap: bool) -> Callable:
    def run(rows: pa.Table, number: int) -> dict:
        width, packed, label = packed_bins(rows, bins)
        counts = b""
        if bootstrap:
            draw = np.random.default_rng([seed % 2**63, TaskContext.get().partitionId(), number])
            counts = draw.poisson(1.0, (trees, len(label))).astype(np.uint8).tobytes()
        return {"width": width, "bins": packed.tobytes(), "label": label.astype(np.int8).tobytes(), "counts": counts}

    return run


def _tables(levels: dict[int, Level], steps: int, bins: Bins) -> Callable:
    """Per task and tree: rows by drawn bin of a growing node, those of label 0 and then those of label 1."""
    sizes = _sizes(bins)
    width = len(sizes)
    of_bin = np.repeat(np.arange(width), sizes)
    inside = (np.arange(bins.total) - bins.starts[of_bin]).astype(np.uint8)
    empty = (bins.zeros - bins.starts).astype(np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            for block in batch.to_pylist():
                label = np.frombuffer(block["label"], np.int8).astype(np.intp)
                counts = np.frombuffer(block["counts"], np.uint8).reshape(-1, len(label))
                packed = np.frombuffer(block["bins"], bins.kind).reshape(block["width"], len(label))
                entry, row = np.nonzero(packed != bins.total)
                bin_number = packed[entry, row]
                spread = np.tile(empty, (len(label), 1))
                spread[row, of_bin[bin_number]] = inside[bin_number]
                spread = spread.ravel()
                starts = np.arange(len(label)) * width
                for number, level in levels.items():
                    used = np.flatnonzero(counts[number]) if len(counts) else np.arange(len(label))
                    start = starts.take(used)
                    node = np.zeros(len(used), np.intp)
                    for _ in range(steps):
                        beyond = spread.take(start + level.slot.take(node)) > level.cut.take(node)
                        node = level.left.take(node)
                        node += beyond
                    group = level.group.take(node)
                    if group.min(initial=0) < 0:
                        grows = np.flatnonzero(group >= 0)
                        used, start, group = used.take(grows), start.take(grows), group.take(grows)
                    cell = level.slots.take(group, axis=0)
                    cell += start[:, None]
                    key = level.places.take(group + label.take(used) * len(level.slots), axis=0)
                    key += spread.take(cell)
                    times = np.repeat(counts[number].take(used).astype(float), key.shape[1]) if len(counts) else None
                    found = np.bincount(key.ravel(), times, 2 * level.cells)
                    if number in sums:
                        sums[number] += found
                    else:
                        sums[number] = found.astype(float)
        for number, found in sums.items():
            yield pa.RecordBatch.from_pydict({"tree": pa.array([number], pa.int32()), "sums": [found.astype(np.int64).tobytes()]})

    return run


def _impurity(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Gini, in the order of operations of Spark ML, so that gains that are equal there are equal here."""
    total = zeros + ones
    return 1.0 - (zeros / total) ** 2 - (ones / total) ** 2


def _splits(levels: dict[int, Level], growing: dict[int, list[int]], bins: Bins, least: int, least_gain: float) -> Callable:
    """The best split of every growing node of one tree; gain -1 where no split gains."""
    sizes, flags = _sizes(bins), np.array([cuts is None for cuts in bins.thresholds])
    schema = pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("gain", pa.float64()), ("slot", pa.int32()), ("cut", pa.int32())]
                       + [(name, pa.int64()) for name in ("zeros", "ones", "left_zeros", "left_ones")])

    def run(rows: pa.Table) -> pa.Table:
        number = rows["tree"][0].as_py()
        level = levels[number]
        sums = sum(np.frombuffer(part.as_py(), np.int64) for part in rows["sums"]).reshape(2, level.cells)
        widths = sizes[level.slots]
        flat = widths.ravel()
        places = level.places[: len(level.slots)]
        starts = places.ravel()
        upto = np.cumsum(sums, axis=1)
        before = (upto - sums)[:, starts]
        left = upto - np.repeat(before, flat, axis=1)
        firsts = places[:, 0]
        whole = np.add.reduceat(sums, starts, axis=1).reshape(2, *level.slots.shape)[:, :, 0]
        of_cell = np.repeat(np.arange(len(firsts)), widths.sum(axis=1))
        total = whole[:, of_cell]
        right = total - left
        n_left, n_right = left.sum(axis=0), right.sum(axis=0)
        cut = np.arange(level.cells) - np.repeat(starts, flat)
        fits = (np.minimum(n_left, n_right) >= max(least, 1)) & (cut < np.repeat(flat, flat) - 1)
        with np.errstate(divide="ignore", invalid="ignore"):
            parts = np.array([n_left / (n_left + n_right) * _impurity(*left), n_right / (n_left + n_right) * _impurity(*right)])
            # Of two categories the one with fewer ones comes first, as in Spark ML.
            turned = np.repeat(flags[level.slots.ravel()], flat) & (right[1] < left[1])
            gain = _impurity(*whole)[of_cell] - np.where(turned, parts[1], parts[0]) - np.where(turned, parts[0], parts[1])
        gain = np.where(fits & (gain >= least_gain), gain, -1.0)
        best = np.maximum.reduceat(gain, firsts)
        # Equal gains: the first slot and cut win.
        first = np.flatnonzero(gain >= best[of_cell])
        at = first[np.searchsorted(of_cell[first], np.arange(len(firsts)))]
        slot = np.repeat(level.slots.ravel(), flat)[at]
        gained = np.where(best > 0, gain[at], -1.0)
        nodes = np.array(growing[number], np.int32)
        columns = [np.full(len(nodes), number, np.int32), nodes, gained, slot, cut[at].astype(np.int32), *whole, *left[:, at]]
        return pa.Table.from_arrays([pa.array(column, kind.type) for column, kind in zip(columns, schema, strict=True)], schema=schema)

    return run


class EntryForest(RandomForestClassifier):
    """``RandomForestClassifier`` with passes over packed rows; its model is a ``RandomForestClassificationModel``."""

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        described = dataset.schema[self.getFeaturesCol()].metadata.get("ml_attr", {})
        kinds = described.get("attrs", {})
        weighted = self.isDefined("weightCol") and self.getWeightCol()
        other = (
            weighted or self.getSubsamplingRate() != 1 or self.getFeatureSubsetStrategy() not in ("auto", "sqrt", "all")
            or self.getImpurity() != "gini" or self.getMinWeightFractionPerNode() or self.getMaxBins() > NO_CUT or not self.getMaxDepth()
        )
        if other or "nominal" in kinds:
            return super()._fit(dataset)
        rows = dataset.select(F.unwrap_udt(self.getFeaturesCol()).alias("vector"), F.col(self.getLabelCol()).cast("double").alias("label"))
        counts = rows.agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(F.col("label") == 1).alias("ones"),
            F.count_if(~F.coalesce(F.col("label").isin(0.0, 1.0), F.lit(False))).alias("odd_labels"),
        ).first()
        if not counts["ones"] or counts["odd_labels"]:
            return super()._fit(dataset)
        slots = described.get("num_attrs") or dataset.select(self.getFeaturesCol()).first()[0].size
        flags = {slot["idx"] for slot in kinds.get("binary", [])}
        bins = find_bins(self, rows, slots, flags, counts["rows"], counts["rows"])
        trees = self._grow(rows, bins, counts["rows"])
        return self._copyValues(self._model(dataset.sparkSession, trees, bins))

    def _grow(self, rows: DataFrame, bins: Bins, n_rows: int) -> list[Tree]:
        # Blocks are dealt out evenly, a part for each core, or several where a part would be too large to keep.
        cores = rows.sparkSession.sparkContext.defaultParallelism
        parts = min(-(-n_rows // BLOCK_ROWS), cores * -(-n_rows // (cores * PART_ROWS)))
        pack = _pack(bins, self.getNumTrees(), self.getSeed(), self.getBootstrap())
        blocks = rows.mapInArrow(in_blocks(pack, _ARROW), BLOCKS).repartition(parts).persist()
        trees = [Tree() for _ in range(self.getNumTrees())]
        growing = {number: [0] for number in range(len(trees))}
        sizes = _sizes(bins)
        try:
            for depth in range(self.getMaxDepth()):
                levels = {
                    number: _level(trees[number], nodes, self._drawn(number, depth, len(nodes), len(sizes)), sizes)
                    for number, nodes in growing.items()
                }
                splits = []
                for some in self._passes(levels):
                    tables = blocks.mapInArrow(_tables(some, depth, bins), TABLES)
                    best = _splits(some, growing, bins, self.getMinInstancesPerNode(), self.getMinInfoGain())
                    splits += tables.groupBy("tree").applyInArrow(best, SPLITS).collect()
                growing = _children(trees, splits, depth + 1 == self.getMaxDepth())
                if not growing:
                    break
        finally:
            blocks.unpersist()
        return trees

    def _drawn(self, number: int, depth: int, nodes: int, slots: int) -> np.ndarray:
        """The slots that each of some nodes may split at, in order."""
        strategy = self.getFeatureSubsetStrategy()
        if strategy == "all" or (strategy == "auto" and self.getNumTrees() == 1):
            return np.tile(np.arange(slots), (nodes, 1))
        draw = np.random.default_rng([self.getSeed() % 2**63, 1 + number, depth])
        return np.sort(draw.random((nodes, slots)).argsort(axis=1)[:, : int(np.ceil(np.sqrt(slots)))], axis=1)

    def _passes(self, levels: dict[int, Level]) -> Iterator[dict[int, Level]]:
        """Trees together whose tables fit the memory given for them, 16 bytes a cell; one tree at least."""
        some, cells = {}, 0
        for number, level in levels.items():
            if some and 16 * (cells + level.cells) > self.getMaxMemoryInMB() * 2**20:
                yield some
                some, cells = {}, 0
            some[number] = level
            cells += level.cells
        if some:
            yield some

    def _model(self, spark: SparkSession, trees: list[Tree], bins: Bins) -> RandomForestClassificationModel:
        """The trees as a saved model of Spark ML, loaded."""
        path = scratch_path(spark, "forest")
        about = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "defaultParamMap": {}}
        name = "org.apache.spark.ml.classification.RandomForestClassificationModel"
        size = {"numFeatures": len(bins.thresholds), "numClasses": 2}
        whole = about | size | {"class": name, "uid": self.uid, "numTrees": len(trees), "paramMap": {"impurity": "gini", "numTrees": len(trees)}}
        one = about | size | {"paramMap": {"impurity": "gini"}, "class": "org.apache.spark.ml.classification.DecisionTreeClassificationModel"}
        listed = [(at, json.dumps(one | {"uid": f"{self.uid}_{at}"}), 1.0) for at in range(len(trees))]
        nodes = [(at, node) for at, tree in enumerate(trees) for node in _node_rows(tree, bins)]
        spark.createDataFrame([(json.dumps(whole),)], "value STRING").coalesce(1).write.text(f"{path}/metadata")
        spark.createDataFrame(nodes, NODES).coalesce(1).write.parquet(f"{path}/data")
        spark.createDataFrame(listed, "_1 INT, _2 STRING, _3 DOUBLE").coalesce(1).write.parquet(f"{path}/treesMetadata")
        return RandomForestClassificationModel.load(path)


def _children(trees: list[Tree], splits: list, last: bool) -> dict[int, list[int]]:
    """Splits are put into their trees; returns the nodes that may be split further, by tree."""
    growing = {}
    for split in sorted(splits, key=lambda split: (split["tree"], split["node"])):
        tree, node = trees[split["tree"]], split["node"]
        whole = tree.counts[node] = (split["zeros"], split["ones"])
        if not split["gain"] > 0 or _impurity(*whole) < EPSILON:
            continue
        left = (split["left_zeros"], split["left_ones"])
        tree.slot[node], tree.cut[node], tree.gain[node] = split["slot"], split["cut"], split["gain"]
        tree.left[node] = tree.add(left)
        tree.add((whole[0] - left[0], whole[1] - left[1]))
        for child in (tree.left[node], tree.left[node] + 1):
            if not last and _impurity(*tree.counts[child]) >= EPSILON:
                growing.setdefault(split["tree"], []).append(child)
    return growing


def _node_rows(tree: Tree, bins: Bins) -> list[tuple]:
    """Nodes as Spark ML stores them. Two leaves of one class become one, slots of zeros and ones are categories."""
    says = [float(ones > zeros) for zeros, ones in tree.counts]
    left = list(tree.left)
    for node in reversed(range(len(left))):
        first = left[node]
        if first != node and left[first] == first and left[first + 1] == first + 1 and says[first] == says[first + 1]:
            left[node] = node
    numbers, reached = {0: 0}, [0]
    for node in reached:
        if left[node] != node:
            for child in (left[node], left[node] + 1):
                numbers[child] = len(reached)
                reached.append(child)
    rows = []
    for node in reached:
        zeros, ones = tree.counts[node]
        impurity = float(_impurity(zeros, ones)) if zeros + ones else 0.0
        about = (numbers[node], says[node], impurity, [float(zeros), float(ones)], zeros + ones)
        if left[node] == node:
            rows.append((*about, -1.0, -1, -1, (-1, [], -1)))
            continue
        first, second, slot = left[node], left[node] + 1, tree.slot[node]
        cuts = bins.thresholds[slot]
        if cuts is None:
            # The category with fewer ones stands on the left, as in Spark ML.
            sides, category = ((first, second), 0.0) if tree.counts[first][1] <= tree.counts[second][1] else ((second, first), 1.0)
            rows.append((*about, tree.gain[node], *(numbers[side] for side in sides), (slot, [category], 2)))
        else:
            rows.append((*about, tree.gain[node], numbers[first], numbers[second], (slot, [float(cuts[tree.cut[node]])], -1)))
    return rows
