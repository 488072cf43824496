"""Resumable steps and the batch run."""

import pytest

from checks.registry import _raw_text
from tidemark.operators import churn, clv
from tidemark.plans import batch
from tidemark.plans.steps import Steps, table_digest
from tidemark.sources.bindings import Bound

FOLDER = "/root/testdata/sf0.001"


def test_a_step_runs_again_only_when_something_changed(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.range(5).write.parquet(source)
    steps = Steps(spark, str(tmp_path / "steps"))

    def go(settings=1):
        steps.ran.clear()
        rows = spark.read.parquet(source)
        steps.table("double", lambda: rows.selectExpr("id * 2 AS id"), settings, {"rows": rows})
        return steps.table("sum", lambda: steps.read("double").selectExpr("sum(id) AS s"), needs=["double"]).first().s, list(steps.ran)

    assert go() == (20, ["double", "sum"])
    assert go() == (20, [])
    assert Steps(spark, str(tmp_path / "steps")).manifest("double")["rows"] == 5
    assert go(2) == (20, ["double", "sum"])
    spark.range(5, 6).write.mode("append").parquet(source)
    assert go(2) == (30, ["double", "sum"])


def test_a_stopped_step_leaves_the_published_result(spark, tmp_path):
    steps = Steps(spark, str(tmp_path))
    steps.table("t", lambda: spark.range(3), 1)
    before, reader = steps.manifest("t"), steps.read("t")

    def stop():
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        steps.table("t", stop, 2)
    assert steps.manifest("t") == before and steps.read("t").count() == 3
    steps.table("t", lambda: spark.range(4), 2)
    assert steps.read("t").count() == 4 and reader.count() == 3  # the last result stays for those who read it
    steps.table("t", lambda: spark.range(5), 3)
    with pytest.raises(Exception):
        spark.read.parquet(before["path"]).count()


def test_no_step_begins_in_a_stopped_run(spark, tmp_path):
    steps = Steps(spark, str(tmp_path))
    steps.stop()
    with pytest.raises(RuntimeError, match="not begun"):
        steps.run("t", lambda path: None)
    assert steps.manifest("t") is None and Steps(spark, str(tmp_path)).run("t", lambda path: None)["step"] == "t"


def test_digests_tell_tables_apart(spark, tmp_path):
    rows = [(1, "a"), (2, "b")]
    first = table_digest(spark.createDataFrame(rows, "x int, y string"))
    assert first == table_digest(spark.createDataFrame(rows[::-1], "x int, y string"))
    assert first != table_digest(spark.createDataFrame([(1, "a"), (2, "c")], "x int, y string"))
    assert first != table_digest(spark.createDataFrame(rows, "x long, y string"))
    assert table_digest(Bound(spark, FOLDER)["payments"]) == table_digest(Bound(spark, FOLDER)["payments"])
    assert table_digest(Bound(spark, FOLDER)["payments"]) != table_digest(Bound(spark, FOLDER)["viewing_activity"])


def test_a_stopped_batch_run_goes_on_and_a_finished_one_does_nothing(spark, tmp_path, monkeypatch):
    raw = _raw_text(Bound(spark, FOLDER))
    short = {"churn_settings": churn.ChurnSettings(folds=2, trees=5, rounds=5, iterations=20),
             "clv_settings": clv.ClvSettings(trees=5, rounds=5, kinds=("ridge", "boosted")), "restarts": 2, "ks": [2, 3]}

    def stop(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(batch.segments, "segment_customers", stop)
        with pytest.raises(RuntimeError):
            batch.Batch(spark, str(tmp_path)).run(raw, **short)
    second = batch.Batch(spark, str(tmp_path))
    tables = second.run(raw, **short)
    assert "segmentation" in second.steps.ran and "customer_features" not in second.steps.ran
    assert {"clv_model", "customer_segments", "retention_priorities"} <= set(second.steps.ran)
    assert tables["customer_churn_scores"].count() == tables["customer_segments"].count() == tables["customer_clv_predictions"].count() == 150
    third = batch.Batch(spark, str(tmp_path))
    third.run(raw, **short)
    assert third.steps.ran == []
    again = batch.Batch(spark, str(tmp_path))
    again.run(raw, **{**short, "restarts": 3})
    assert set(again.steps.ran) == {"segmentation", "customer_segments", "segment_profiles", "retention_priorities"}
