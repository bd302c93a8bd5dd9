"""A fitted tree ensemble as a table of nodes, and its prediction as one column expression.

The table has a row per node: tree, weight, node, feature, threshold, left, right, value. ``feature`` numbers the model's inputs: a flag for
each known category and one for all others, then value and absence of each numeric column. A row goes left where its input is at most
the threshold; a leaf leads to itself. Any engine that reads the table can score with it, and a forecast can
predict all its steps inside one expression.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekloom.operators.features import CATEGORY
from weekloom.operators.model import SENTINEL, DemandModel, ExpressionPredictor

_NODE = "struct<feature:int,threshold:double,left:int,right:int,value:double>"


@dataclass
class TreeEnsemble(ExpressionPredictor):
    """``nodes`` as above; ``categories`` and ``columns`` give the inputs in order; ``depth`` is the longest way to a leaf."""

    nodes: DataFrame
    categories: list[str]
    columns: list[str]
    depth: int
    trees: str = "_trees"

    def attach(self, df: DataFrame) -> DataFrame:
        """All trees as one value beside each row; the table has a bounded number of nodes, whatever the data."""
        node = F.struct("feature", "threshold", "left", "right", "value").cast(_NODE)
        by_tree = self.nodes.groupBy("tree").agg(F.max("weight").alias("weight"), F.sort_array(F.collect_list(F.struct("node", node.alias("n")))).alias("n"))
        tree = F.struct("tree", "weight", F.col("n.n").alias("nodes"))
        return df.withColumn(self.trees, by_tree.agg(F.sort_array(F.collect_list(tree))).scalar())

    def inputs(self, features: Mapping[str, Column]) -> Column:
        """The model's inputs as an array, in order."""
        category = features.get(CATEGORY, F.col(CATEGORY))
        flags = [F.coalesce(category == c, F.lit(False)) for c in self.categories]
        other = ~reduce(lambda a, b: a | b, flags, F.lit(False))
        numbers = []
        for c in self.columns:
            numbers += [F.coalesce(features[c].cast("double"), F.lit(SENTINEL)), features[c].isNull().cast("double")]
        # the last flag is that of MLlib's encoder for an index it has never seen; there is none
        return F.array(*[f.cast("double") for f in (*flags, other)], F.lit(0.0), *numbers)

    def expression(self, features: Mapping[str, Column]) -> Column:
        def leaf(x: Column, tree: Column) -> Column:
            def step(at: Column, _: Column) -> Column:
                node = F.get(tree["nodes"], at)
                return F.when(F.get(x, node["feature"]) <= node["threshold"], node["left"]).otherwise(node["right"])

            return F.get(tree["nodes"], F.aggregate(F.sequence(F.lit(1), F.lit(max(self.depth, 1))), F.lit(0), step))["value"]

        def total(x: Column) -> Column:
            return F.aggregate(F.col(self.trees), F.lit(0.0), lambda sum_, tree: sum_ + tree["weight"] * leaf(x, tree))

        # the inputs are bound once, not computed again in each tree
        return F.element_at(F.transform(F.array(self.inputs(features)), total), 1)

    def predict(self, df: DataFrame) -> DataFrame:
        """The trees join the rows only for this one projection, so nothing moves them with the rows."""
        bare = df.drop(self.trees)
        scored = self.attach(bare).withColumn("prediction", self.expression({c: F.col(c) for c in bare.columns}))
        return scored.drop(self.trees)


def node_table(spark: SparkSession, path: str, model: DemandModel) -> DataFrame:
    """The nodes of a model saved at ``path``, from the files of its tree stage."""
    stages = model.pipeline.stages
    place = f"{len(stages) - 1:0{len(str(len(stages)))}d}_{stages[-1].uid}"
    folder = f"{path}/pipeline/stages/{place}"
    rows = spark.read.parquet(f"{folder}/data").select("treeID", "nodeData.*")
    weights = spark.read.parquet(f"{folder}/treesMetadata").toDF("tree", "settings", "weight").select("tree", "weight")
    split, is_leaf = F.col("split"), F.col("leftChild") < 0
    at = split["leftCategoriesOrThreshold"]
    # a flag has two categories, 0 and 1; the one set that doesn't stand for "at most a half" changes the sides
    flag = split["numCategories"] >= 0
    swapped = flag & F.array_contains(at, 1.0) & ~F.array_contains(at, 0.0)
    side = lambda a, b: F.when(is_leaf, F.col("id")).when(swapped, F.col(b)).otherwise(F.col(a))
    nodes = rows.select(
        F.col("treeID").alias("tree"),
        F.col("id").alias("node"),
        F.when(is_leaf, 0).otherwise(split["featureIndex"]).alias("feature"),
        F.when(is_leaf, 0.0).when(flag, 0.5).otherwise(F.get(at, F.lit(0))).alias("threshold"),
        side("leftChild", "rightChild").alias("left"),
        side("rightChild", "leftChild").alias("right"),
        F.col("prediction").alias("value"),
    )
    return nodes.join(weights, "tree")


def load_ensemble(path: str, model: DemandModel | None = None) -> TreeEnsemble:
    """The trees of the model that ``DemandModel.save`` wrote at ``path``; ``model`` is that model, where it is loaded already."""
    spark = SparkSession.getActiveSession()
    model = model or DemandModel.load(path)
    indexer, trees = model.pipeline.stages[1], model.pipeline.stages[-1]
    return TreeEnsemble(node_table(spark, path, model), list(indexer.labelsArray[0]), model.features, trees.getOrDefault("maxDepth"))
