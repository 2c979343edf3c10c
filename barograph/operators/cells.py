"""Training rows of trees, grouped where their features repeat.

A regression tree sees rows with equal features as one: their number, mean label
and squared deviations give every split the gain, and every leaf the prediction,
that the rows themselves give. Tables whose features have few different values
are so reduced to a table of bounded size by one aggregate, and every fit and
score of a search works on that, and so do the medians that fill gaps, which the
cells give exactly. The bootstrap of a forest stays one of rows: each row is
drawn for every tree on its own, and only the draws are summed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barograph.operators.nested import groups, prefix_scores
from barograph.session import materialize

#: Cells up to which a table counts as one of few, and rows each must stand for on average.
MOST_CELLS, LEAST_ROWS = 1 << 17, 8
#: Rows drawn at once.
_ROWS_AT_ONCE = 1 << 18
_CELLS_AT_ONCE = 1 << 12


def feature_cells(df: DataFrame, numeric: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """``by, numeric, label, weight, deviation`` of every choice of features: mean label, rows, squared deviations.

    A cell with a missing label has none, so that a fit refuses it like the row.
    """
    rows = F.count("*").cast("double")
    return df.groupBy(*by, *numeric).agg(
        F.when(F.count("label") == F.count("*"), F.avg("label")).alias("label"), rows.alias("weight"),
        (F.var_pop("label") * rows).alias("deviation"))


def has_few_cells(df: DataFrame, numeric: list[str], most: int = MOST_CELLS) -> bool:
    """Whether the rows repeat few choices of features (one pass)."""
    row = df.agg(F.count("*").alias("rows"), F.approx_count_distinct(F.struct(*numeric)).alias("cells")).first()
    return row["cells"] <= min(most, row["rows"] / LEAST_ROWS)


def cell_medians(cells: DataFrame, numeric: list[str]) -> dict[str, float | None]:
    """Lower medians of the rows that weighted ``cells`` stand for, NULL and NaN ignored; none for an empty column."""
    values = cells.select("weight", F.inline(F.array(*[
        F.struct(F.lit(name).alias("name"), F.col(name).cast("double").alias("value")) for name in numeric])))
    counts = values.where("value IS NOT NULL AND NOT isnan(value)").groupBy("name", "value").agg(F.sum("weight").alias("rows"))
    below = F.sum("rows").over(Window.partitionBy("name").orderBy("value"))
    ranked = counts.select("name", "value", below.alias("below"), F.sum("rows").over(Window.partitionBy("name")).alias("all"))
    found = dict(ranked.where("2 * below >= all").groupBy("name").agg(F.min("value")).collect())
    return {name: found.get(name) for name in numeric}


def weighs_rows(estimator, param_maps: list[dict]) -> bool:
    """Whether every fit of the search takes a weighted row for so many equal ones.

    Bounds on the rows of a node count cells, and samples other than a
    forest's bootstrap are drawn from cells.
    """
    for params in param_maps:
        one = estimator.copy(params)
        if one.getMinInstancesPerNode() > 1 or one.isSet("weightCol"):
            return False
        if not _bootstraps(one) and one.getSubsamplingRate() != 1.0:
            return False
    return True


def _bootstraps(estimator) -> bool:
    return estimator.hasParam("bootstrap") and estimator.getBootstrap()


def bootstrap_draws(rows: DataFrame, cells: int, trees: int, rate: float, seed: int) -> DataFrame:
    """``cell, weights, means``: for every tree the draws of each cell's rows and the mean label of those drawn.

    ``rows`` holds ``cell`` (below ``cells``) and ``label``. As in Spark's forests
    each row is drawn a Poisson number of times for each tree. A task sums its
    draws over all its rows before any are shuffled.
    """
    arrow = pa.schema([("cell", pa.int64()), ("weights", pa.list_(pa.float64())), ("totals", pa.list_(pa.float64()))])

    def sent(found: np.ndarray, weights: np.ndarray, totals: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(found), _CELLS_AT_ONCE):
            some = found[at:at + _CELLS_AT_ONCE]
            ends = pa.array(np.arange(len(some) + 1, dtype=np.int32) * trees)
            yield pa.RecordBatch.from_arrays([pa.array(some), *[
                pa.ListArray.from_arrays(ends, pa.array(of[:, some].T.ravel())) for of in (weights, totals)]], schema=arrow)

    def draw(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        weights, totals, seen = np.zeros((trees, cells)), np.zeros((trees, cells)), np.zeros(cells, bool)
        held, size = [], 0

        def add() -> None:
            cell, label = (np.concatenate(column) for column in zip(*held))
            seen[cell] = True
            for tree in range(trees):
                drawn = rng.poisson(rate, len(cell)).astype(np.float64)
                weights[tree] += np.bincount(cell, drawn, cells)
                totals[tree] += np.bincount(cell, drawn * label, cells)

        for batch in batches:
            held.append(tuple(column.to_numpy(zero_copy_only=False) for column in batch.columns))
            size += batch.num_rows
            if size >= _ROWS_AT_ONCE:
                add()
                held, size = [], 0
        if size:
            add()
        yield from sent(np.flatnonzero(seen), weights, totals)

    def merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, totals, seen = np.zeros((trees, cells)), np.zeros((trees, cells)), np.zeros(cells, bool)
        for batch in batches:
            cell = batch.column(0).to_numpy()  # once each in a batch, as a task sends each cell once
            order = np.argsort(cell, kind="stable")
            parts = np.split(order, np.flatnonzero(np.diff(cell[order])) + 1) if len(cell) else []
            repeats = max(map(len, parts), default=0)
            values = [column.flatten().to_numpy().reshape(len(cell), trees) for column in batch.columns[1:]]
            for k in range(repeats):
                at = np.array([part[k] for part in parts if len(part) > k])
                for sums, of in zip((weights, totals), values):
                    sums[:, cell[at]] += of[at].T
            seen[cell] = True
        yield from sent(np.flatnonzero(seen), weights, totals)

    tasks = rows.sparkSession.sparkContext.defaultParallelism
    schema = "cell bigint, weights array<double>, totals array<double>"
    summed = rows.select("cell", F.col("label").cast("double")).coalesce(2 * tasks).mapInArrow(draw, schema).repartition(
        tasks, "cell").mapInArrow(merge, schema)
    return summed.select("cell", "weights", F.transform(
        F.arrays_zip("weights", "totals"), lambda x: F.when(x["weights"] > 0, x["totals"] / x["weights"])).alias("means"))


def joined_forest(estimator, trees: list) -> RandomForestRegressionModel:
    """One model of the trees of several forests."""
    sc = SparkSession.active().sparkContext
    kind = sc._jvm.org.apache.spark.ml.regression
    array = sc._gateway.new_array(kind.DecisionTreeRegressionModel, len(trees))
    for number, tree in enumerate(trees):
        array[number] = tree._java_obj
    made = kind.RandomForestRegressionModel(estimator.uid, array, trees[0].numFeatures)
    model = estimator._copyValues(RandomForestRegressionModel(made))
    model._transfer_params_to_java()  # its size is asked for there
    return model


def _strategy(estimator) -> str:
    named = estimator.getFeatureSubsetStrategy()
    if named != "auto":
        return named
    return "all" if estimator.getNumTrees() == 1 else "onethird"


class CellSearch:
    """Fits and scores of a grid on the cells of ``df``."""

    def __init__(self, df: DataFrame, plan, estimator, param_maps: list[dict], part: Column) -> None:
        self.df, self.plan, self.estimator, self.points = df.withColumn("_part", part), plan, estimator, param_maps
        cells = materialize(feature_cells(self.df, list(plan.numeric), ("_part",))).coalesce(1)
        cells = materialize(cells.withColumn("cell", F.monotonically_increasing_id()))  # of one task: 0, 1, 2, ...
        self.first: list[int] = []  # the first tree of every point among the draws
        if _bootstraps(estimator):
            count, keys = cells.count(), ["_part", *plan.numeric]
            trees = 0
            for params in param_maps:
                self.first.append(trees)
                trees += estimator.copy(params).getNumTrees()
            named = F.broadcast(cells.select("cell", *[F.col(key).alias(f"_{key}") for key in keys]))
            on = [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys]
            rows = self.df.join(named, on).select("cell", "label")
            if self.df.rdd.getNumPartitions() < df.sparkSession.sparkContext.defaultParallelism:
                rows = rows.hint("rebalance")  # few files: the draws are to keep all cores busy
            drawn = bootstrap_draws(rows, count, trees,
                                    estimator.getSubsamplingRate(), estimator.getSeed())
            cells = materialize(drawn.join(F.broadcast(cells), "cell"))
        self.cells = cells

    def prepared(self, parts: list | None) -> PipelineModel:
        """The feature stages for all rows of ``parts``: the imputer sees one row, of their medians."""
        names = list(self.plan.imputed)
        if not names:
            return Pipeline(stages=self.plan.stages).fit(self.cells)
        medians = cell_medians(self.of_parts(parts), names)
        row = self.df.sparkSession.createDataFrame([tuple(medians.values())], ", ".join(f"`{n}` double" for n in names))
        return Pipeline(stages=self.plan.stages).fit(row)

    def of_parts(self, parts: list | None) -> DataFrame:
        return self.cells if parts is None else self.cells.where(F.col("_part").isin(parts))

    def of(self, prepared: PipelineModel, parts: list | None) -> DataFrame:
        drawn = ["weights", "means"] if self.first else []
        return prepared.transform(self.of_parts(parts)).select("features", "label", "weight", "deviation", *drawn).persist()

    def fit(self, cells: DataFrame, number: int, pool: ThreadPool):
        """The model of grid point ``number``; trees of a bootstrap are fitted one by one, on their own draws."""
        estimator = self.estimator.copy(self.points[number])
        if not self.first:
            return estimator.fit(cells, {estimator.weightCol: "weight"})

        def tree(k: int):
            at = F.lit(self.first[number] + k)
            rows = cells.select("features", F.get("weights", at).alias("weight"), F.get("means", at).alias("label"))
            return estimator.fit(rows.where("weight > 0"), {
                estimator.numTrees: 1, estimator.bootstrap: False, estimator.subsamplingRate: 1.0,
                estimator.featureSubsetStrategy: _strategy(estimator), estimator.weightCol: "weight",
                estimator.seed: estimator.getSeed() + 1 + self.first[number] + k}).trees[0]

        run = inheritable_thread_target(cells.sparkSession)(tree)
        return joined_forest(estimator, pool.map(run, range(estimator.getNumTrees()), chunksize=1))


def cell_search(
    df: DataFrame, plan, estimator, param_maps: list[dict], part: Column, folds: list[tuple[list, list]],
    size: str | None, parallelism: int,
) -> tuple[PipelineModel, list[float]]:
    """The best model, refitted on all of ``df``, and the mean RMSE over ``folds`` of every grid point.

    ``part`` gives the part of a row, ``folds`` the parts that train and those
    held out. ``df`` is read once, for sampled forests twice; gaps are filled with
    the medians of all rows. ``size`` names the parameter
    whose smaller values are read off the largest fit, see ``nested``.
    """
    search = CellSearch(df, plan, estimator, param_maps, part)
    grid = [{param.name: value for param, value in point.items()} for point in param_maps]
    scores = [[0.0] * len(folds) for _ in grid]
    with ThreadPool(max(1, parallelism)) as pool:
        for fold, (fit, held) in enumerate(folds):
            prepared = search.prepared(fit)
            train, rest = search.of(prepared, fit), search.of(prepared, held)
            for group in groups(grid, size):
                sizes = sorted(group) if size else list(group)
                model = search.fit(train, group[sizes[-1]], pool)
                for one, score in zip(sizes, prefix_scores(model, rest, sizes, weighted=True)):
                    scores[group[one]][fold] = score
            train.unpersist()
            rest.unpersist()
        means = [sum(of_point) / len(folds) for of_point in scores]
        prepared = search.prepared(None)
        whole = search.of(prepared, None)
        best = search.fit(whole, means.index(min(means)), pool)
        whole.unpersist()
    return PipelineModel([*prepared.stages, best]), means
