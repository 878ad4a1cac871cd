"""Exact attributions of tree models, from their trees as arrays."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import DecisionTreeClassificationModel, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from acreage.constants import SEED
from acreage.ml.boosting import HistogramBoosterModel
from acreage.ml.trees import Paths, Tree, expectation, score
from acreage.operators.ranking import sample_rows
from acreage.session import delete, shared_dir, stage

#: Rows a worker explains at once.
ROWS = 256
CLASSIFIERS = (RandomForestClassificationModel, DecisionTreeClassificationModel)
REGRESSORS = (RandomForestRegressionModel, DecisionTreeRegressionModel, GBTRegressionModel)


def is_tree_model(model: Model) -> bool:
    return isinstance(model, (HistogramBoosterModel, *CLASSIFIERS, *REGRESSORS))


def trees_of(model: Model) -> tuple[list[Tree], np.ndarray]:
    """The trees of a boosted model, forest or single tree, and the outputs a row has before any of them.

    A row's outputs are the sum over all trees: margins of a booster, class probabilities of a forest, else the prediction.
    Spark's models are read from the tables they save; splits on unordered categories are refused."""
    if isinstance(model, HistogramBoosterModel):
        return model.trees, model.start
    if not is_tree_model(model):
        raise TypeError(f"{type(model).__name__} has no trees")
    spark = SparkSession.getActiveSession()
    path = f"{shared_dir(spark)}/trees-{uuid.uuid4().hex}"
    model.write().save(path)
    single = isinstance(model, (DecisionTreeClassificationModel, DecisionTreeRegressionModel))
    try:
        nodes = spark.read.parquet(f"{path}/data")
        if single:
            nodes = nodes.select(F.lit(0).alias("treeID"), F.struct("*").alias("nodeData"))
        # a model, whose size its training bounds
        rows = nodes.select("treeID", "nodeData.*").orderBy("treeID", "id").collect()
    finally:
        delete(spark, path)
    weights = [1.0] if single else model.treeWeights
    if isinstance(model, (RandomForestClassificationModel, RandomForestRegressionModel)):
        weights = [1 / len(weights)] * len(weights)
    by_tree: dict[int, list] = {}
    for r in rows:
        by_tree.setdefault(r["treeID"], []).append(r)
    classes = model.numClasses if isinstance(model, CLASSIFIERS) else 0
    return [_tree(by_tree[t], weights[t], classes) for t in sorted(by_tree)], np.zeros(max(1, classes))


def _split(row) -> tuple[int, float, int, int]:
    """Feature, cut and children of a node; of a place that holds only 0 and 1, such as a one-hot one, either may be left."""
    if row["leftChild"] < 0:
        return -1, 0.0, 0, 0
    split, children = row["split"], (row["leftChild"], row["rightChild"])
    values = list(split["leftCategoriesOrThreshold"])
    if split["numCategories"] < 0:
        return split["featureIndex"], values[0], *children
    if split["numCategories"] > 2 or values not in ([0.0], [1.0]):
        raise ValueError("splits on unordered categories have no order to follow")
    return split["featureIndex"], 0.5, *(children if values == [0.0] else children[::-1])


def _tree(rows: list, weight: float, classes: int) -> Tree:
    feature, cut, left, right = (np.array(x) for x in zip(*map(_split, rows)))
    stats = np.array([r["impurityStats"] for r in rows], float)
    if classes:
        cover = stats.sum(axis=1)
        value = weight * stats / np.maximum(cover, 1e-300)[:, None]
    else:
        cover, value = stats[:, 0], weight * np.array([[r["prediction"]] for r in rows])
    return Tree(feature, cut, left, right, value, cover)


def slot_names(df: DataFrame, column: str) -> list[str]:
    """Names of the places of an assembled vector."""
    attributes = df.schema[column].metadata.get("ml_attr", {}).get("attrs", {})
    named = {a["idx"]: a["name"] for kind in attributes.values() for a in kind}
    return [named[i] for i in range(len(named))]


def raw_names(slots: list[str], features: list[str]) -> list[str]:
    """The feature each place was made of: the longest whose name it holds between underscores."""
    out = []
    for slot in slots:
        held = [f for f in features if f"_{f}_" in f"_{slot}_"]
        out.append(max(held, key=len) if held else slot)
    return out


def tree_attributions(
    df: DataFrame, key: str, model: PipelineModel, features: list[str], max_samples: int | None = 500, seed: int = SEED,
) -> tuple[DataFrame, np.ndarray]:
    """`(row_id, output, feature, value)`, the Shapley values of every output of a pipeline that ends in a tree model, and
    the outputs of a row of which nothing is known; the values of a row add up to its outputs less those.

    What is not known of a row follows the training rows down the trees. Places of one raw feature are added up.
    At most `max_samples` rows are explained, the first in digest order; all with None. The rows stay distributed, and
    every task is given the paths of the trees, whose number the model bounds. A null key gives rows with a null
    id, rows that repeat are explained each, and an empty table gives an empty result.
    """
    *head, last = model.stages
    trees, start = trees_of(last)
    rows = stage(sample_rows(df, key, max_samples, seed), "explained") if max_samples is not None else df
    column = last.getOrDefault("featuresCol")
    vectors = PipelineModel(head).transform(rows)
    raw = raw_names(slot_names(vectors, column), features)
    names = sorted(set(raw))
    place = np.array([names.index(r) for r in raw])
    outputs = len(start)
    sent = df.sparkSession.sparkContext.broadcast(Paths(trees))

    def run(batches):
        paths = sent.value
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                part = batch.slice(a, ROWS)
                n = part.num_rows
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
                found = paths.shapley(x, outputs)
                summed = np.zeros((n, len(names), outputs))
                np.add.at(summed, (slice(None), place), found)
                ids = part.column("row_id").take(pa.array(np.repeat(np.arange(n), outputs)))
                values = summed.transpose(0, 2, 1).ravel()
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n * outputs + 1) * len(names), pa.int32()), pa.array(values))
                yield pa.RecordBatch.from_arrays([ids, pa.array(np.tile(np.arange(outputs, dtype=np.int32), n)), lists], ["row_id", "output", "values"])

    kind = df.schema[key].dataType.simpleString()
    found = vectors.select(F.col(key).alias("row_id"), vector_to_array(F.col(column)).alias("x")).mapInArrow(
        run, f"row_id {kind}, output int, values array<double>")
    table = F.array(*[F.lit(n) for n in names])
    out = found.select("row_id", "output", F.posexplode("values").alias("place", "value")).select(
        "row_id", "output", F.get(table, F.col("place")).alias("feature"), "value")
    return out, start + expectation(trees)


def tree_outputs(df: DataFrame, key: str, model: PipelineModel) -> DataFrame:
    """`(row_id, outputs)`: what the attributions of each row add up to, with the mean."""
    *head, last = model.stages
    trees, start = trees_of(last)
    sent = df.sparkSession.sparkContext.broadcast((trees, start))

    @F.arrow_udf("array<double>")
    def outputs(column: pa.Array) -> pa.Array:
        own, first = sent.value
        x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 1))
        out = score(own, x) + first
        return pa.ListArray.from_arrays(pa.array(np.arange(len(column) + 1) * out.shape[1], pa.int32()), pa.array(out.ravel()))

    vectors = PipelineModel(head).transform(df)
    return vectors.select(F.col(key).alias("row_id"), outputs(vector_to_array(F.col(last.getOrDefault("featuresCol")))).alias("outputs"))
