"""Training on checkpointed vectors; the check of a saved model against its node table: read once, walked by all tasks."""

import glob

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from checks import series
from checks.registry import QUERIES
from weekloom.operators import features, model
from weekloom.operators.ensemble import load_ensemble
from weekloom.session import stage

PARAMS = model.TreeParams(max_iter=4, max_depth=3, feature_subset="0.9")


@pytest.fixture(scope="module")
def table(spark):
    weekly = spark.range(240).select(
        F.expr("date_add(DATE'2020-01-06', cast(id % 80 AS int) * 7)").alias("order_week"),
        F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("id") / 80).cast("int") + 1).alias("category"),
        (F.col("id") * 37 % 101).cast("double").alias("units"),
        (F.col("id") * 53 % 997).cast("double").alias("revenue"),
        (F.col("id") % 9 + 1).cast("double").alias("avg_price"),
        (F.col("id") % 5).cast("double").alias("rev_count"),
        F.expr("CASE WHEN id % 4 > 0 THEN double(id % 6) END").alias("rev_score_avg"),
    )
    return stage(features.time_split(features.warmup_trim(features.weekly_features(weekly))), "own-table")


def test_d2_reads_the_model_once_and_walks_in_all_tasks(spark, table, tmp_path, monkeypatch):
    trained = model.train_demand_model(table, params=PARAMS)
    trained.save(str(tmp_path / "m"))
    monkeypatch.setattr(series, "trained", lambda t, with_revenue=False: (table, trained, str(tmp_path / "m")))
    read, load = [], model.DemandModel.load
    monkeypatch.setattr(model.DemandModel, "load", staticmethod(lambda path: read.append(path) or load(path)))
    scored = QUERIES["d2_score"](spark, "unused")
    assert read == [str(tmp_path / "m")]
    assert scored.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism > 1
    assert scored.count() == table.count() and scored.where("predicted AND same").count() == table.count()


def test_trees_are_fitted_on_a_checkpoint_and_are_those_of_one_pipeline(spark, table, monkeypatch):
    seen, fit = [], GBTRegressor.fit
    monkeypatch.setattr(GBTRegressor, "fit", lambda self, rows, *more: seen.append((self, rows)) or fit(self, rows, *more))
    trained = model.train_demand_model(table, params=PARAMS)
    [(trees, rows)] = seen
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert rows.columns == ["units", "features"] and "LogicalRDD" in plan and "Relation" not in plan and "Project" not in plan
    saved = rows._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get()
    assert not glob.glob(saved.removeprefix("file:"))
    train = table.where("split = 'train'").select("category", "units", *trained.features).repartition(1)
    monkeypatch.undo()
    one = Pipeline(stages=[*trained.pipeline.stages[:-1], trees]).fit(train)
    words = lambda found: found.stages[-1].toDebugString.split("\n", 1)[1]
    assert "If (feature" in words(one) and words(one) == words(trained.pipeline)


def test_rows_of_a_failed_training_do_not_stay(spark, table, monkeypatch):
    seen = []

    def fail(self, rows):
        seen.append(rows._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get().removeprefix("file:"))
        assert glob.glob(seen[0])
        raise KeyError("no trees")

    monkeypatch.setattr(GBTRegressor, "fit", fail)
    with pytest.raises(KeyError):
        model.train_demand_model(table, params=PARAMS)
    assert not glob.glob(seen[0])


def test_forecasts_read_the_saved_nodes_but_not_the_model_again(spark, table, tmp_path, monkeypatch):
    trained = model.train_demand_model(table, params=PARAMS)
    trained.save(str(tmp_path / "m"))
    known = load_ensemble(str(tmp_path / "m"))
    monkeypatch.setattr(series, "trained", lambda t, with_revenue=False: (table, trained, str(tmp_path / "m")))
    monkeypatch.setattr(model.DemandModel, "load", staticmethod(lambda path: pytest.fail("the model is read again")))
    found_table, trees = series.ensemble(None)
    assert found_table is table
    assert (trees.categories, trees.columns, trees.depth) == (known.categories, known.columns, known.depth)
    assert sorted(trees.nodes.collect()) == sorted(known.nodes.collect())
