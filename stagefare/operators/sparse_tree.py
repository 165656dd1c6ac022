"""A regression tree on sparse vectors of numbers and one-hot slots, learnt from counts by category.

MLlib's own fit writes out one number for every slot of every row, so its work grows with rows times categories. Here a row
is its numbers and the few slots that are set; for a level of the tree tasks add them up by node, slot and bin (``slot_sums``).
Splits, bins, stopping rules and pruning are MLlib's (a slot of 0 or 1 is a category of two values, the lesser mean goes left), and so
is the model. Two things differ: bins come from all rows where MLlib samples 10,000 of them, and equal gains go to the first slot
where MLlib's depend on the order in which doubles are added.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Estimator
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagefare.operators.features import slot_count
from stagefare.operators.slot_sums import SUMS_SCHEMA, Walk, slot_sums, split_slots
from stagefare.sources.scratch import new_path, remove, written_at
from stagefare.sources.ship import ship_package

# Distinct values of a number from which its bins are cut; of more, as many quantiles stand for them.
VALUES_LIMIT = 10_000
EPSILON = 2.0**-52

_NODE_SCHEMA = (
    "id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint, gain double, leftChild int,"
    " rightChild int, split struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>"
)


@dataclass
class _Node:
    """What a node holds (rows, sum and sum of squares of the label), and its split: ``place`` is that of the number among
    the numbers (-1: a slot of 0 or 1), ``edge`` the last bin that goes left, or the slot's value that does."""

    n: int
    total: float
    squares: float
    depth: int
    slot: int = -1
    place: int = -1
    edge: int = -1
    gain: float = -1.0
    left: int = -1
    right: int = -1

    @property
    def impurity(self) -> float:
        return (self.squares - self.total * self.total / self.n) / self.n if self.n else 0.0


def thresholds(counts: list[tuple[float, int]], bins: int) -> list[float]:
    """Where MLlib cuts a number into at most ``bins`` bins, from its values in order with their rows."""
    middles = [(a[0] + b[0]) / 2.0 for a, b in zip(counts, counts[1:])]
    if len(middles) <= bins - 1:
        return middles
    stride = sum(n for _, n in counts) / bins
    found, seen, target = [], counts[0][1], stride
    for (_, n), middle in zip(counts[1:], middles):
        if abs(seen - target) < abs(seen + n - target):
            found.append(middle)
            target += stride
        seen += n
    return found


class SparseTreeRegressor(Estimator):
    """Estimator of MLlib's tree model; takes the parameters of MLlib's ``DecisionTreeRegressor``."""

    def __init__(self, **params):
        super().__init__()
        self.like = DecisionTreeRegressor(**params)

    def getMaxDepth(self) -> int:
        return self.like.getMaxDepth()

    def _fit(self, dataset: DataFrame) -> DecisionTreeRegressionModel:
        spark, path = dataset.sparkSession, new_path(dataset.sparkSession, "tree-rows")
        vector = F.col(self.like.getFeaturesCol())
        size = dataset.select(slot_count(vector).alias("size")).first()
        if size is None:
            raise ValueError("a tree needs rows to learn from")
        ship_package(spark)
        numbers = self._numbers(dataset, size[0])
        rows = written_at(self._rows(dataset, vector, numbers), path)
        cuts = self._cuts(rows, numbers)
        nodes = self._grow(rows, numbers, cuts, size[0])
        remove(spark, path)
        return self._model(dataset, size[0], nodes, numbers, cuts)

    def _numbers(self, dataset: DataFrame, size: int) -> list[int]:
        """Slots that are not known to hold 0 or 1 alone."""
        attributes = dataset.schema[self.like.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
        if "nominal" in attributes:
            raise ValueError("slots of several categories must be one-hot encoded")
        binary = {a["idx"] for a in attributes.get("binary", [])}
        return [i for i in range(size) if i not in binary]

    def _cuts(self, rows: DataFrame, numbers: list[int]) -> list[list[float]]:
        """Thresholds of each number."""
        cuts = []
        names = {i: f"v{k}" for k, i in enumerate(numbers)}
        entries = F.array(*[F.struct(F.lit(i).alias("slot"), F.col(n).alias("value")) for i, n in names.items()])
        counted = rows.select(F.inline(entries)).groupBy("slot", "value").agg(F.count("*").alias("n")) if numbers else None
        within = Window.partitionBy("slot").orderBy("value")
        listed: dict[int, list[tuple[float, int]]] = {i: [] for i in numbers}
        for r in counted.withColumn("k", F.row_number().over(within)).filter(F.col("k") <= VALUES_LIMIT + 1).collect() if numbers else []:
            listed[r["slot"]].append((r["value"], r["n"]))
        for i in numbers:
            values = sorted(listed[i])
            if len(values) > VALUES_LIMIT:
                probs = [k / (VALUES_LIMIT - 1) for k in range(VALUES_LIMIT)]
                found = rows.approxQuantile(names[i], probs, 0.5 / VALUES_LIMIT)
                values = sorted(Counter(found).items())
            cuts.append(thresholds(values, min(self.like.getMaxBins(), sum(n for _, n in values))))
        return cuts

    def _rows(self, dataset: DataFrame, vector: Column, numbers: list[int]) -> DataFrame:
        """``y, v0, v1, ..., hot``: label, numbers, and slots that are set."""
        plain = F.unwrap_udt(vector)
        y = F.col(self.like.getLabelCol()).cast("double")
        schema = ", ".join(["y double", *[f"v{k} double" for k in range(len(numbers))], "hot array<int>"])
        split = split_slots(numbers, "labels must not be null, NaN or infinite, nor vectors null")
        return dataset.select(y.alias("y"), plain["indices"].alias("indices"), plain["values"].alias("values")).mapInArrow(split, schema)

    def _grow(self, rows: DataFrame, numbers: list[int], cuts: list[list[float]], size: int) -> list[_Node]:
        """The tree level by level; the driver holds its nodes, as it does the model."""
        y = F.col("y")
        whole = rows.agg(F.count("*").alias("n"), F.sum(y).alias("s"), F.sum(y * y).alias("q")).first()
        if not whole["n"]:
            raise ValueError("a tree needs rows to learn from")
        nodes = [_Node(whole["n"], whole["s"], whole["q"], 0)]
        level = [0] if self.like.getMaxDepth() > 0 else []
        while level:
            sums = rows.mapInArrow(slot_sums(self._walk(nodes, level), numbers, cuts, size), SUMS_SCHEMA)
            found = self._best_splits(sums, [nodes[i] for i in level]).collect()
            above, level = level, []
            for r in sorted(found, key=lambda r: r["at"]):
                node = nodes[above[r["at"]]]
                node.slot, node.place, node.edge, node.gain = r["slot"], r["place"], r["edge"], r["gain"]
                left = _Node(r["ln"], r["ls"], r["lq"], node.depth + 1)
                right = _Node(node.n - left.n, node.total - left.total, node.squares - left.squares, node.depth + 1)
                node.left, node.right = len(nodes), len(nodes) + 1
                nodes += [left, right]
                if left.depth < self.like.getMaxDepth():
                    level += [i for i in (node.left, node.right) if abs(nodes[i].impurity) >= EPSILON]
        return nodes

    @staticmethod
    def _walk(nodes: list[_Node], level: list[int]) -> Walk:
        place = np.full(len(nodes), -1)
        place[level] = np.arange(len(level))
        arrays = [np.array([getattr(n, name) for n in nodes]) for name in ("left", "right", "slot", "place", "edge")]
        return Walk(*arrays, place, max(n.depth for n in nodes))

    def _best_splits(self, sums: DataFrame, level: list[_Node]) -> DataFrame:
        """The split of each node of a level that has one: ``at, slot, place, edge, gain`` and what goes left."""

        def of_node(name: str, kind: str) -> Column:
            return F.expr(f"cast(array({', '.join(f'double({getattr(n, name)!r})' for n in level)}) as array<{kind}>)")[F.col("at")]

        # Dealt once for both the sums and what is left of a threshold; a number has at most as many rows as bins.
        dealt = sums.repartition("at", "slot").groupBy("at", "slot", "place", "bin").agg(*[F.sum(c).alias(c) for c in "nsq"])
        upto = Window.partitionBy("at", "slot").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        running = dealt.select("at", "slot", "place", "bin", *[F.sum(c).over(upto).alias(c) for c in "nsq"])
        told = {"wn": ("n", "bigint"), "ws": ("total", "double"), "wq": ("squares", "double"), "impurity": ("impurity", "double")}
        met = running.withColumns({c: of_node(*t) for c, t in told.items()}).filter("place >= 0 or n < wn")
        # Of a slot of 0 or 1, the value of the lesser mean goes left; of a number, all up to a bin.
        rest = {c: F.col(f"w{c}") - F.col(c) for c in "nsq"}
        set_left = (F.col("place") >= 0) | (F.try_divide("s", "n") < F.try_divide(rest["s"], rest["n"]))
        both = met.select(
            "at", "slot", "place", F.when(F.col("place") >= 0, F.col("bin")).otherwise(F.when(set_left, 1).otherwise(0)).alias("edge"),
            *[F.when(set_left, F.col(c)).otherwise(rest[c]).alias(f"l{c}") for c in "nsq"],
            "wn", "ws", "wq", "impurity",
        )
        both = both.withColumns({f"r{c}": F.col(f"w{c}") - F.col(f"l{c}") for c in "nsq"})
        both = both.filter(F.least("ln", "rn") >= max(1, self.like.getMinInstancesPerNode()))

        def share(side: str) -> Column:
            n, s, q = (F.col(f"{side}{c}") for c in "nsq")
            return n / F.col("wn") * F.try_divide(q - F.try_divide(s * s, n), n)

        both = both.withColumn("gain", F.col("impurity") - share("l") - share("r"))
        valid = both.filter((F.col("gain") > 0) & (F.col("gain") >= self.like.getMinInfoGain()))
        # Gains that differ by less than their sums are exact to are equal.
        rank = F.struct(-F.round(F.try_divide("gain", "impurity"), 10), "slot", "edge", "place", "gain", "ln", "ls", "lq")
        best = valid.groupBy("at").agg(F.min(rank).alias("best"))
        return best.select("at", *[f"best.{c}" for c in ("slot", "place", "edge", "gain", "ln", "ls", "lq")])

    def _model(self, dataset: DataFrame, size: int, nodes: list[_Node], numbers: list[int], cuts: list[list[float]]):
        """MLlib's model of these nodes, through its saved form; a fit on two empty vectors gives the rest of that."""
        spark, path = dataset.sparkSession, new_path(dataset.sparkSession, "tree")
        empty = [(Vectors.sparse(size, {}), 0.0)] * 2
        self.like.fit(spark.createDataFrame(empty, [self.like.getFeaturesCol(), self.like.getLabelCol()])).write().save(path)
        data: list[tuple] = []

        def prediction(i: int) -> float:
            return nodes[i].total / nodes[i].n

        def is_leaf(i: int) -> bool:
            """A node without a split, or one whose children are leaves that predict the same."""
            node = nodes[i]
            if node.left < 0:
                return True
            return is_leaf(node.left) and is_leaf(node.right) and prediction(node.left) == prediction(node.right)

        def add(i: int) -> int:
            node, at = nodes[i], len(data)
            held = (prediction(i), node.impurity, [float(node.n), node.total, node.squares], node.n)
            data.append(())
            if is_leaf(i):
                data[at] = (at, *held, -1.0, -1, -1, (-1, [], -1))
                return at
            if node.place >= 0:
                split = (node.slot, [cuts[node.place][node.edge]], -1)
            else:
                split = (node.slot, [float(node.edge)], 2)
            data[at] = (at, *held, node.gain, add(node.left), add(node.right), split)
            return at

        add(0)
        table = spark.createDataFrame(data, _NODE_SCHEMA)
        table.coalesce(1).write.mode("overwrite").parquet(f"{path}/data")
        return DecisionTreeRegressionModel.load(path)
