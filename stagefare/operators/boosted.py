"""Boosted trees of depth 1 or 2, learnt from sums over the bins of two features at a time.

MLlib keeps every row as an object and reads all of them several times a tree. Its splits, however, follow from the rows, labels and
errors in each bin of a feature, and below a first split from those in each pair of bins of two features. Here rows of equal bins are one
row with its number, sum and sum of squares of the label. A tree of depth 2 adds to a row a value that follows from pairs of its bins, so all trees so
far are a table for each pair, and one pass over the binned rows gives all that the next tree is made from, whatever came before.
Bins, stopping rules, pruning and the model are MLlib's; equal gains go to the first feature and threshold, where MLlib's depend on
the order in which doubles are added. Settings that this does not cover are left to MLlib.
"""

from __future__ import annotations

import json
from collections import Counter

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagefare.operators.features import slot_count
from stagefare.operators.pair_sums import Node, Plan, Tables, binned_rows, no_sums, packed, pair_sums
from stagefare.sources.scratch import new_path, remove, written_at
from stagefare.sources.ship import ship_package

EPSILON = 2.0**-52
# Gains that differ by less than this share are equal.
EQUAL = 1e-12
# Rows below which MLlib's own fit is the faster one.
LEAST_ROWS = 1_000_000
# Features up to which sums over their pairs stay small, and bins that fit a byte.
MOST_FEATURES, MOST_BINS = 16, 64


def sampled_thresholds(counts: list[tuple[float, int]], expected: float, bins: int) -> list[float]:
    """Where MLlib cuts a number, from the values of its sample other than 0 with their rows, of which it expected so many."""
    seen = sum(n for _, n in counts)
    if expected - seen > EPSILON * seen * 100:
        counts = sorted([*counts, (0.0, expected - seen)])
    middles = [(a[0] + b[0]) / 2.0 for a, b in zip(counts, counts[1:])]
    if len(middles) <= bins - 1:
        return middles
    stride = expected / bins
    found, so_far, target = [], counts[0][1], stride
    for (_, n), middle in zip(counts[1:], middles):
        if abs(so_far - target) < abs(so_far + n - target):
            found.append(middle)
            target += stride
        so_far += n
    return found


class BoostedRegressor(GBTRegressor):
    """MLlib's estimator, which learns by sums over bins where its settings allow."""

    def _fit(self, dataset: DataFrame) -> GBTRegressionModel:
        size = self._covered(dataset)
        return self._learnt(dataset, size) if size else super()._fit(dataset)

    def _covered(self, dataset: DataFrame) -> int:
        """The number of features, or 0 if the fit is left to MLlib."""
        attributes = dataset.schema[self.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
        covered = (
            self.getMaxDepth() in (1, 2)
            and self.getMaxBins() <= MOST_BINS
            and self.getLossType() == "squared"
            and self.getImpurity() == "variance"
            and self.getSubsamplingRate() == 1.0
            and self.getFeatureSubsetStrategy() in ("auto", "all")
            and self.getMinWeightFractionPerNode() == 0.0
            and not self.isSet("weightCol")
            and not self.isSet("validationIndicatorCol")
            and not {"nominal", "binary"} & set(attributes)
        )
        row = dataset.select(slot_count(F.col(self.getFeaturesCol())).alias("size")).first() if covered else None
        return row["size"] if row and row["size"] and row["size"] <= MOST_FEATURES else 0

    def _learnt(self, dataset: DataFrame, size: int) -> GBTRegressionModel:
        spark = dataset.sparkSession
        ship_package(spark)
        values = vector_to_array(self.getFeaturesCol())
        total = dataset.count()
        if total < LEAST_ROWS:
            return super()._fit(dataset)
        cuts = self._cuts(dataset.select(values.alias("v")), size, total)
        if all(not c for c in cuts):
            return super()._fit(dataset)
        plan = Plan(size, max(2, *[len(c) + 1 for c in cuts]))
        y = F.col(self.getLabelCol()).cast("double")
        words = [f"w{k}" for k in range(-(-size // 8))]
        schema = ", ".join(["y double", *[f"{w} long" for w in words]])
        bad = f"labels and features must not be null or NaN, nor labels infinite: {self.getLabelCol()}, {self.getFeaturesCol()}"
        rows = dataset.select(y.alias("y"), values.alias("v")).mapInArrow(binned_rows(cuts, bad), schema)
        path = new_path(spark, "binned")
        counted = rows.groupBy(*words).agg(F.count("*").alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") * F.col("y")).alias("q"))
        held = counted.mapInArrow(packed, ", ".join(f"{c} binary" for c in counted.columns))
        # Few tasks, as each gives one row of sums however many rows it reads.
        binned = written_at(held, path).coalesce(2 * spark.sparkContext.defaultParallelism)

        def sums(tables: Tables | None, last: Node | None, weight: float, whole: bool) -> tuple[np.ndarray, np.ndarray]:
            pairs, squares = no_sums(plan, last, last is None)
            for row in binned.mapInArrow(pair_sums(plan, tables, last, weight, whole), "pairs binary, squares binary").collect():
                pairs += np.frombuffer(row["pairs"]).reshape(pairs.shape)
                squares += np.frombuffer(row["squares"])
            return pairs, squares

        tables, last, trees, counts = None, None, [], None
        for number in range(self.getMaxIter()):
            pairs, squares = sums(tables, last, self._weight(number - 1), True)
            if last is None:
                counts = self._by_pair(plan, pairs[1])
            else:
                last.hold(squares.tolist())
                tables = tables or Tables(plan)
                tables.add(last, self._weight(number - 1))
            last = self._grown(plan, self._by_pair(plan, pairs[0]), counts, cuts)
            trees.append(last)
        last.hold(sums(tables, last, self._weight(len(trees) - 1), False)[1].tolist())
        remove(spark, path)
        return self._model(dataset, size, trees, cuts)

    @staticmethod
    def _by_pair(plan: Plan, pairs: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
        """Sums over one feature's bins and another's, both ways round; those of one feature alone are the diagonal of a table."""
        square = (plan.bins, plan.bins)
        found = {pair: pairs[k].reshape(square) for k, pair in enumerate(plan.pairs)}
        found |= {(j, i): table.T for (i, j), table in found.items()}
        alone = [found[i, i - 1 if i else 1].sum(axis=1) for i in range(plan.features)] if plan.pairs else [pairs[0][: plan.bins]]
        return found | {(i, i): np.diag(one) for i, one in enumerate(alone)}

    def _weight(self, number: int) -> float:
        return 1.0 if number == 0 else self.getStepSize()

    def _cuts(self, vectors: DataFrame, size: int, total: int) -> list[list[float]]:
        """MLlib's thresholds of each feature, which come from the sample that MLlib takes."""
        spark, jvm = vectors.sparkSession, vectors.sparkSession._jvm
        bins = min(self.getMaxBins(), total)
        share = min(1.0, max(self.getMaxBins() ** 2, 10_000) / total)
        if share < 1.0:
            seed = jvm.org.apache.spark.util.random.XORShiftRandom(self.getSeed()).nextInt()
            drawn = vectors._jdf.toJavaRDD().sample(False, share, seed)
            sample = DataFrame(spark._jsparkSession.createDataFrame(drawn, vectors._jdf.schema()), spark)
        else:
            sample = vectors
        listed = sample.select(F.posexplode("v").alias("slot", "value")).filter("value <> 0")
        counted: list[Counter] = [Counter() for _ in range(size)]
        for r in listed.groupBy("slot", "value").count().collect():
            counted[r["slot"]][r["value"]] = r["count"]
        return [sampled_thresholds(sorted(c.items()), share * total, bins) for c in counted]

    def _best(self, sums: list[np.ndarray], counts: list[np.ndarray], cuts: list[list[float]]) -> tuple[int, int, float]:
        """Feature, last bin of the left side and gain of the split of a node, whose sums are given by feature and bin."""
        found = []
        for i, cut in enumerate(cuts):
            if not cut:
                continue
            ns, ss = np.cumsum(counts[i]), np.cumsum(sums[i])
            n, s = ns[-1], ss[-1]
            ln, ls = ns[: len(cut)], ss[: len(cut)]
            rn, rs = n - ln, s - ls
            least = max(1, self.getMinInstancesPerNode())
            with np.errstate(divide="ignore", invalid="ignore"):
                # What the means of both sides explain of the variance.
                apart = ls / ln - rs / rn
                gain = np.where((ln >= least) & (rn >= least), (ln / n) * (rn / n) * apart * apart, -1.0)
            at = int(np.argmax(gain >= gain.max() * (1 - EQUAL))) if gain.max() > 0 else int(np.argmax(gain))
            found.append((i, at, float(gain[at])))
        most = max(g for *_, g in found)
        return next(x for x in found if x[2] >= most - abs(most) * EQUAL)

    def _grown(self, plan: Plan, errors: dict, counts: dict, cuts: list[list[float]]) -> Node:
        """A tree from sums by pair of bins."""
        by_bin = [[np.diag(sums[i, i]) for i in range(plan.features)] for sums in (errors, counts)]
        root = Node(by_bin[1][0].sum(), by_bin[0][0].sum())
        self._split(root, *by_bin, cuts)
        if root.children and self.getMaxDepth() > 1:
            for child, held in zip(root.children, (slice(0, root.edge + 1), slice(root.edge + 1, None)), strict=True):
                within = [[sums[root.feature, i][held].sum(axis=0) for i in range(plan.features)] for sums in (errors, counts)]
                self._split(child, *within, cuts)
        for node in (*root.children, root):
            if node.children and all(not c.children for c in node.children) and node.children[0].mean == node.children[1].mean:
                node.children = []
        return root

    def _split(self, node: Node, sums: list[np.ndarray], counts: list[np.ndarray], cuts: list[list[float]]) -> None:
        """Give a node its children, if a split gains anything."""
        feature, edge, gain = self._best(sums, counts, cuts)
        if gain <= EPSILON or gain < self.getMinInfoGain():
            return
        n, total = counts[feature][: edge + 1].sum(), sums[feature][: edge + 1].sum()
        node.feature, node.edge, node.gain = feature, edge, gain
        node.children = [Node(n, total), Node(node.n - n, node.total - total)]

    def _model(self, dataset: DataFrame, size: int, trees: list[Node], cuts: list[list[float]]) -> GBTRegressionModel:
        """MLlib's model of these trees, through its saved form; a fit of one tree on two vectors gives the rest of that."""
        spark, path, target = dataset.sparkSession, new_path(dataset.sparkSession, "boosted"), new_path(dataset.sparkSession, "boosted")
        two = spark.createDataFrame([(Vectors.dense([0.0] * size), 0.0)] * 2, [self.getFeaturesCol(), self.getLabelCol()])
        GBTRegressor._fit(self.copy({self.maxIter: 1}), two).write().save(path)
        told = json.loads(spark.read.text(f"{path}/metadata").first()[0])
        told["paramMap"]["maxIter"], told["numTrees"] = self.getMaxIter(), len(trees)
        told["uid"] = self.uid
        data: list[tuple] = []

        def add(tree: int, node: Node, at: int) -> int:
            """The number after the last of this node's."""
            place = len(data)
            data.append(())
            held = (float(node.mean), float(node.impurity), [float(node.n), float(node.total), float(node.squares)], int(node.n))
            if not node.children:
                data[place] = (tree, (at, *held, -1.0, -1, -1, (-1, [], -1)))
                return at + 1
            right = add(tree, node.children[0], at + 1)
            end = add(tree, node.children[1], right)
            split = (node.feature, [float(cuts[node.feature][node.edge])], -1)
            data[place] = (tree, (at, *held, float(node.gain), at + 1, right, split))
            return end

        for number, root in enumerate(trees):
            add(number, root, 0)
        one = spark.read.parquet(f"{path}/treesMetadata")
        weights = [(k, one.first()[1], self._weight(k)) for k in range(len(trees))]
        spark.createDataFrame([(json.dumps(told),)], "value string").coalesce(1).write.text(f"{target}/metadata")
        spark.createDataFrame(weights, one.schema).coalesce(1).write.parquet(f"{target}/treesMetadata")
        spark.createDataFrame(data, spark.read.parquet(f"{path}/data").schema).coalesce(1).write.parquet(f"{target}/data")
        return GBTRegressionModel.load(target)
