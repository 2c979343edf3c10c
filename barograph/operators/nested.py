"""Grid search over the size of tree ensembles with one fit for all sizes.

Boosting adds one tree after another, so the first trees of a long run are the
shorter run. The trees of a forest are drawn independently, so its first trees
are a forest of that size. For every choice of the other parameters only the
largest ensemble is fitted, and all its beginnings are scored in one pass over
the held-out rows.
"""

from __future__ import annotations

import math
import threading
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The parameter that counts the trees, by family.
SIZE = {"rf": "numTrees", "gbt": "maxIter"}


def groups(grid: list[dict], size: str | None) -> list[dict[int, int]]:
    """Grid points that differ in ``size`` only: the number of the point by size, one dict for each group.

    Points without that parameter have the size None, and so each a group.
    """
    found: dict[tuple, dict[int, int]] = {}
    for number, point in enumerate(grid):
        rest = tuple(sorted((name, repr(value)) for name, value in point.items() if name != size))
        found.setdefault(rest, {})[point.get(size)] = number
    return list(found.values())


def shares_depth(estimator, param_maps: list[dict], features: int) -> bool:
    """Whether forests that differ in ``maxDepth`` only are the deepest of them, cut off.

    Trees grow by level, so up to a depth the deeper fit takes the same steps, as
    long as the features drawn for a node do not hang on it: where all nodes of a
    level are handled together, or every node sees all features. A node holds
    some 32 bytes for each feature and bin.
    """
    if not estimator.hasParam("bootstrap"):
        return False
    points = [estimator.copy(params) for params in param_maps]
    deepest = max(one.getMaxDepth() for one in points)
    cut = [one.getMaxDepth() for one in points if one.getMaxDepth() < deepest]
    if not cut or max(cut) > 8:  # what is cut is scored by an expression of 2 ** depth leaves
        return False
    return all(one.getFeatureSubsetStrategy() == "all" or one.getNumTrees() * 2 ** max(cut) * features * one.getMaxBins() * 32
               < one.getMaxMemoryInMB() << 20 for one in points)


def cut_prediction(node, depth: int, features: Column) -> Column:
    """Prediction of a tree cut off ``depth`` levels below ``node``, over an array of features (numbers only)."""
    if depth == 0 or node.getClass().getSimpleName() == "LeafNode":
        return F.lit(node.prediction())
    split = node.split()
    return F.when(F.get(features, F.lit(split.featureIndex())) <= split.threshold(),
                  cut_prediction(node.leftChild(), depth - 1, features)).otherwise(
        cut_prediction(node.rightChild(), depth - 1, features))


def cut_scores(model, rows: DataFrame, sizes: list[int], depth: int) -> list[float]:
    """RMSE of the first trees of a forest, cut off at ``depth``; None stands for all trees."""
    counts = [len(model.trees) if size is None else size for size in sizes]
    values = rows.select("label", vector_to_array(model.getFeaturesCol()).alias("values"))
    trees = values.select("label", *[
        cut_prediction(tree._java_obj.rootNode(), depth, F.col("values")).alias(f"tree_{number}")
        for number, tree in enumerate(model.trees[:max(counts)], 1)])
    measures = []
    for count in counts:
        total = sum((F.col(f"tree_{number}") for number in range(2, count + 1)), F.col("tree_1"))
        measures.append(F.sqrt(F.avg(F.pow(F.col("label") - total / count, 2))))
    return [float(value) for value in trees.agg(*measures).first()]


def prefix_scores(model, rows: DataFrame, sizes: list[int], weighted: bool = False) -> list[float]:
    """RMSE of the first trees of ``model`` on ``rows`` (features, label), for every size, in one pass.

    The size None stands for the whole model, of any kind. With ``weighted``,
    ``rows`` are cells of several rows each, see ``cells``.
    """
    def rmse(prediction: Column) -> Column:
        error = F.pow(F.col("label") - prediction, 2)
        if weighted:
            return F.sqrt(F.sum(F.col("weight") * error + F.col("deviation")) / F.sum("weight"))
        return F.sqrt(F.avg(error))

    if sizes == [None]:
        return [float(model.transform(rows).agg(rmse(F.col("prediction"))).first()[0])]
    boosted = hasattr(model, "evaluateEachIteration")
    if boosted and not weighted:
        errors = model.evaluateEachIteration(rows, "squared")
        return [math.sqrt(errors[size - 1]) for size in sizes]
    kept = ("weight", "deviation") if weighted else ()
    scored, total, measures = rows.select("label", model.getFeaturesCol(), *kept), F.lit(0.0), {}
    for number, (tree, share) in enumerate(zip(model.trees[:max(sizes)], model.treeWeights), 1):
        scored = tree.setPredictionCol(f"tree_{number}").transform(scored)
        total = total + share * F.col(f"tree_{number}")
        if number in sizes:
            measures[number] = rmse(total if boosted else total / number)
    found = scored.agg(*[measures[size] for size in sizes]).first()
    return [float(value) for value in found]


class _Fold:
    """Prepared rows of a fold: made by the first search that needs them, released after the last."""

    def __init__(self, train: DataFrame, held: DataFrame, stages: list, users: int) -> None:
        self.parts, self.stages, self.users = (train, held), stages, users
        self.lock, self.rows = threading.Lock(), None

    def open(self) -> tuple[DataFrame, DataFrame]:
        with self.lock:
            if self.rows is None:
                prepared = Pipeline(stages=self.stages).fit(self.parts[0])
                self.rows = tuple(prepared.transform(part).select("label", "features").persist(
                    StorageLevel.MEMORY_AND_DISK) for part in self.parts)
            return self.rows

    def close(self) -> None:
        with self.lock:
            self.users -= 1
            if self.users == 0:
                for rows in self.rows or ():
                    rows.unpersist()


def idle_share(df: DataFrame) -> int:
    """Fits that the cores can work on at once: small tables leave most of them idle."""
    return max(1, df.sparkSession.sparkContext.defaultParallelism // max(1, df.rdd.getNumPartitions()))


def _by_depth(grid: list[dict], found: list[dict]) -> list[dict]:
    """Groups that differ in depth only as one, whose points are found by size and depth."""
    joined: dict[tuple, dict] = {}
    for group in found:
        point = grid[next(iter(group.values()))]
        rest = tuple(sorted((name, repr(value)) for name, value in point.items() if name != "maxDepth" and (
            len({grid[n].get(name) for n in group.values()}) == 1)))
        joined.setdefault(rest, {}).update({(size, point["maxDepth"]): number for (size, _), number in group.items()})
    return list(joined.values())


def nested_scores(
    folds: list[tuple[DataFrame, DataFrame]], stages: list, estimator, param_maps: list[dict], size: str | None,
    parallelism: int, share_depth: bool = False,
) -> list[float]:
    """Mean RMSE over ``folds`` (train, held out) of every grid point.

    ``stages`` prepare the features and are fitted once a fold. Folds are gone
    through in order, so few of them are prepared at a time. With
    ``share_depth`` the deepest forests are fitted only, see ``shares_depth``.
    """
    grid = [{param.name: value for param, value in point.items()} for point in param_maps]
    found = [{(size, None): number for size, number in group.items()} for group in groups(grid, size)]
    if share_depth:
        found = _by_depth(grid, found)
    scores = [[0.0] * len(folds) for _ in grid]
    opened = [_Fold(train, held, stages, len(found)) for train, held in folds]

    def search(task: tuple[int, dict]) -> None:
        number, group = task
        try:
            train, held = opened[number].open()
            depths = sorted({depth for _, depth in group}) if share_depth else [None]
            sizes = sorted({size for size, _ in group}) if size else [None]
            model = estimator.fit(train, param_maps[group[sizes[-1], depths[-1]]])
            for depth in depths:
                values = (prefix_scores(model, held, sizes) if depth == depths[-1] else cut_scores(model, held, sizes, depth))
                for one, score in zip(sizes, values):
                    scores[group[one, depth]][number] = score
        finally:
            opened[number].close()

    tasks = [(number, group) for number in range(len(folds)) for group in found]
    with ThreadPool(max(1, min(parallelism, len(tasks)))) as pool:
        pool.map(inheritable_thread_target(folds[0][0].sparkSession)(search), tasks, chunksize=1)
    return [sum(of_point) / len(folds) for of_point in scores]
