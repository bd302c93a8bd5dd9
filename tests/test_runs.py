"""Sets of tables that appear together, and the ledger of values that did not parse."""

import pytest
from pyspark.sql import functions as F

from weekloom import pipeline
from weekloom.sources import runs
from weekloom.sources.tables import read_csv


def shown(spark, folder):
    return {name: sorted(r[0] for r in df.collect()) for name, df in runs.published(spark, folder).items()}


def test_readers_see_whole_runs_only(spark, tmp_path):
    folder = str(tmp_path / "out")
    assert shown(spark, folder) == {}
    first = runs.Run(spark, folder)
    first.put("a", spark.range(2))
    assert shown(spark, folder) == {}
    first.put("b", spark.range(3))
    first.publish()
    assert shown(spark, folder) == {"a": [0, 1], "b": [0, 1, 2]}
    second = runs.Run(spark, folder)
    assert second.put("a", spark.range(5)).count() == 5
    with pytest.raises(ValueError, match="already written"):
        second.put("a", spark.range(1))
    assert shown(spark, folder) == {"a": [0, 1], "b": [0, 1, 2]}
    second.discard()
    third = runs.Run(spark, folder)
    third.put("c", spark.range(1))
    third.publish()
    assert shown(spark, folder) == {"c": [0]} and runs.incomplete(spark, folder) == []
    assert [(r.name, r.rows) for r in runs.manifests(spark, folder).orderBy("run", "name").collect()] == [("a", 2), ("b", 3), ("c", 1)]
    assert runs.expire(spark, folder, keep=1) == [first.name]
    assert shown(spark, folder) == {"c": [0]} and not (tmp_path / "out" / "runs" / first.name).exists()


def test_lost_rows_are_noticed(spark, tmp_path):
    run = runs.Run(spark, str(tmp_path))
    run.put("a", spark.range(40).repartition(4))
    run.publish()
    part = next(p for p in (tmp_path / "runs" / run.name / "a").glob("part-*") if p.stat().st_size)
    part.unlink()
    assert runs.incomplete(spark, str(tmp_path)) == ["a"]


def test_a_failed_job_publishes_nothing(spark, tmp_path, monkeypatch):
    good = runs.Run(spark, str(tmp_path / "out"))
    good.put("forecast", spark.range(1))
    good.publish()
    monkeypatch.setattr(pipeline, "read_raw", lambda spark, folder: ({}, []))
    monkeypatch.setattr(pipeline, "clean", lambda job, raw: job.put("forecast", spark.range(9)))

    def broken(*_):
        raise RuntimeError("no")

    monkeypatch.setattr(pipeline, "train", broken)
    with pytest.raises(RuntimeError):
        pipeline.run(spark, "raw", str(tmp_path / "out"))
    assert shown(spark, str(tmp_path / "out")) == {"forecast": [0]}
    assert [p.name for p in (tmp_path / "out" / "runs").iterdir()] == [good.name]


def test_the_ledger_holds_what_did_not_parse(spark, tmp_path):
    lines = ["order_item_id,price,order_id,product_id,seller_id,freight_value,shipping_limit_date"]
    lines += ["1,10.5,o1,p1,s1,1.0,2018-01-05 10:00:00", "1,ten,o2,p1,s1,2.0,2018-01-05 10:00:00", "1,NaN,o3,p1,s1,,", "1,7,o4,p1,s1,2 EUR,yesterday"]
    lines += ["1,8,o5,p1,s1,3.0,05/13/2018", "1, ,o6,p1,s1,4.0,2018-99-01"]
    (tmp_path / "items.csv").write_text("\n".join(lines) + "\n")
    ledger = []
    kept = read_csv(spark, str(tmp_path / "items.csv"), "order_items", ledger=ledger)
    plain = read_csv(spark, str(tmp_path / "items.csv"), "order_items")
    key = F.col("order_id")
    assert kept.schema.names == plain.schema.names and kept.orderBy(key).collect() == plain.orderBy(key).collect()
    found = sorted((r["column"], r["value"]) for r in ledger[0].collect())
    assert found == [("freight_value", "2 EUR"), ("price", "ten"), ("shipping_limit_date", "05/13/2018"), ("shipping_limit_date", "2018-99-01"), ("shipping_limit_date", "yesterday")]
    raw = {r["value"]: r["raw"] for r in ledger[0].collect()}
    assert '"order_id":"o2"' in raw["ten"] and '"freight_value":"2 EUR"' in raw["yesterday"]
