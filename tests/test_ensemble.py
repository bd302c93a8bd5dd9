"""Trees as a node table: its walk against the library's transform, against SQL, and inside forecasts."""

import duckdb
import pytest
from pyspark.sql import functions as F

from weekloom.operators import features, forecast, model
from weekloom.operators.ensemble import load_ensemble
from weekloom.session import stage
from weekloom.sources.star import StarTables


@pytest.fixture(scope="module")
def fitted(spark, tmp_path_factory):
    """(series, feature table, model, its trees) of a few trees, with missing values and a category that was never seen."""
    star = StarTables(spark, "/root/testdata/sf0.001")
    table = stage(features.time_split(features.warmup_trim(features.weekly_features(star.series, star.holidays))), "small-table")
    trained = model.train_demand_model(table, params=model.TreeParams(max_iter=12, max_depth=4, feature_subset="0.9"))
    path = str(tmp_path_factory.mktemp("model") / "m")
    trained.save(path)
    unseen = table.limit(5).withColumn("category", F.lit("never seen"))
    gone = table.limit(5).withColumns({"units_lag1": F.lit(None).cast("double"), "rev_score_avg": F.lit(None).cast("double"), "category": F.lit(None).cast("string")})
    return star, table.unionByName(unseen).unionByName(gone), trained, load_ensemble(path)


def test_the_walk_equals_the_library(fitted):
    _, table, trained, trees = fitted
    both = model.score(trees, model.score(trained, table).withColumnRenamed("prediction", "known"))
    assert both.columns == [*table.columns, "known", "prediction"]
    off = both.agg(F.max(F.abs(F.col("prediction") - F.col("known"))), F.count("prediction"), F.countDistinct("prediction")).head()
    assert off[0] <= 1e-9 and off[1] == table.count() and off[2] > 50


def test_the_node_table_can_be_walked_in_sql(fitted):
    _, table, _, trees = fitted
    rows = table.withColumn("row", F.monotonically_increasing_id())
    inputs = rows.select("row", trees.inputs({c: F.col(c) for c in rows.columns}).alias("x")).toArrow()
    nodes = trees.nodes.toArrow()
    con = duckdb.connect()
    con.register("inputs", inputs)
    con.register("nodes", nodes)
    found = con.sql("""
        WITH RECURSIVE walk AS (
          SELECT i."row", n.* FROM inputs i, nodes n WHERE n.node = 0
          UNION ALL SELECT w."row", n.* FROM walk w JOIN inputs i USING ("row")
            JOIN nodes n ON n.tree = w.tree AND n.node = CASE WHEN i.x[w.feature + 1] <= w.threshold THEN w."left" ELSE w."right" END
          WHERE w."left" <> w.node)
        SELECT "row", sum(weight * value) FROM walk WHERE "left" = node GROUP BY "row" """).fetchall()
    mine = {r["row"]: r["prediction"] for r in model.score(trees, rows).select("row", "prediction").collect()}
    assert len(found) == len(mine) and all(abs(mine[k] - v) < 1e-9 for k, v in found)


def test_every_tree_is_a_tree(fitted):
    nodes = [r.asDict() for r in fitted[3].nodes.collect()]
    assert len({(n["tree"], n["node"]) for n in nodes}) == len(nodes)
    inner = [n for n in nodes if n["left"] != n["node"]]
    children = [(n["tree"], n[side]) for n in inner for side in ("left", "right")]
    roots = [(n["tree"], n["node"]) for n in nodes if n["node"] == 0]
    assert sorted(children + roots) == sorted((n["tree"], n["node"]) for n in nodes)
    width = len(fitted[3].categories) + 2 + 2 * len(fitted[3].columns)
    assert all(0 <= n["feature"] < width for n in nodes)


@pytest.mark.parametrize("scenarios", [False, True])
def test_forecasts_in_one_pass_equal_step_by_step(spark, fitted, monkeypatch, scenarios):
    star, _, trained, trees = fitted
    history = stage(features.fill_rolling_mean(star.series, "rev_score_avg"), "filled")
    plan = forecast.price_plan(history)
    if scenarios:
        plan = plan.select("*", F.explode(F.array(F.lit(-0.1), F.lit(0.0), F.lit(0.1))).alias("scenario"))
        plan = plan.withColumn("planned_price", F.col("planned_price") * (1 + F.col("scenario")))
    by = ["scenario"] if scenarios else []
    run = lambda predictor: forecast.recursive_forecast(history, plan, predictor, by=by, holidays=star.holidays)
    keys = ["order_week", "category", *by]
    stepwise = {tuple(r[k] for k in keys): (r["avg_price"], r["units"]) for r in run(trained).collect()}
    written = []
    monkeypatch.setattr(forecast, "stage", lambda df, name: written.append(name) or stage(df, name))
    found = {tuple(r[k] for k in keys): (r["avg_price"], r["units"]) for r in run(trees).collect()}
    assert not written and found.keys() == stepwise.keys() and len(found) > 100
    assert all(abs(a - b) <= 1e-9 * (1 + abs(b)) for k in found for a, b in zip(found[k], stepwise[k]))
