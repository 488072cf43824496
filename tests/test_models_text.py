"""Metrics, explanations, retrieval and guarded SQL."""

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from checks.registry import QUERIES
from tidemark.operators import evaluation as ev
from tidemark.operators import explain, policy, retrieval, segments
from tidemark.sources import guarded
from tidemark.sources.bindings import Bound
from tidemark.session import shared_dir

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bound(spark):
    return Bound(spark, FOLDER)


@pytest.fixture(scope="module")
def scored(make):
    return make("label int, score double", (1, .9), (0, .9), (1, .7), (0, .4), (0, .4), (1, .4), (0, .1), (0, .005))


def test_threshold_sweep_takes_the_first_maximum(make):
    df = make("label int, score double", (1, .9), (0, .05))
    best = ev.best_threshold(df).first()
    assert best.threshold == 0.1 and best.f_beta == 1.0
    assert ev.threshold_sweep(df).count() == 161


def test_sweep_counts_scores_on_the_edge(make):
    thresholds = np.linspace(.10, .90, 161)
    df = make("label int, score double", *[(1, float(t)) for t in thresholds])
    rows = ev.threshold_sweep(df).orderBy("threshold").collect()
    assert [r.tp for r in rows] == [int((thresholds >= t).sum()) for t in [r.threshold for r in rows]]


def test_auc_agrees_with_sparks_own(scored):
    mine = ev.roc_auc(scored).first()[0]
    theirs = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0).evaluate(scored.withColumn("label", F.col("label").cast("double")))
    assert mine == pytest.approx(theirs)


def test_average_precision_by_hand(scored):
    # thresholds .9 .7 .4: recall 1/3, 2/3, 3/3 with precision 1/2, 2/3, 3/6
    assert ev.average_precision(scored).first()[0] == pytest.approx((.5 + 2 / 3 + .5) / 3)


def test_metrics_without_positives(make):
    row = ev.metrics_at(make("label int, score double", (0, .1)), .5).first()
    assert (row.precision, row.recall, row.f2, row.accuracy) == (0.0, 0.0, 0.0, 1.0)


def test_risk_bands_are_right_closed(make):
    df = make("s double", (.30,), (.55,), (.75,), (.7500001,))
    assert [r[0] for r in df.select(ev.risk_band("s")).collect()] == ["Low", "Medium", "High", "Critical"]


def test_first_action_wins(make):
    df = make("risk_percentile double, clv_percentile double, failed_payment_rate double, avg_customer_satisfaction double, engagement_score double",
              (.9, .8, .5, 1, 10), (.9, .1, .5, 1, 10), (.9, .1, .1, 1, 10), (.9, .1, .1, 3, 10), (.75, .9, .9, 1, 50), (.1, .8, 0, 3, 50), (.1, .1, 0, 3, 50))
    assert [r[0].split()[0] for r in df.select(policy.action()).collect()] == [
        "Priority", "Payment-recovery", "Senior", "Personalized", "Targeted", "Loyalty/value", "No"]


def test_unknown_customer_is_an_error(spark, bound):
    table = QUERIES["p05_recommendations"](bound)
    with pytest.raises(KeyError):
        policy.recommend(table, -1)
    assert policy.recommend(table, 1).count() == 1


def test_shapley_against_all_subsets():
    """Path-dependent values of a small tree equal the average over all feature orders."""
    from itertools import permutations
    # x0 <= 1 ? (x1 <= 2 ? 10 : 20) : (x0 <= 3 ? 5 : 1), with the share of rows at each step
    paths = [(10.0, [(0, .6, (True, 1, True)), (1, .25, (True, 2, True))]), (20.0, [(0, .6, (True, 1, True)), (1, .75, (True, 2, False))]),
             (5.0, [(0, .4, (True, 1, False)), (0, .5, (True, 3, True))]), (1.0, [(0, .4, (True, 1, False)), (0, .5, (True, 3, False))])]
    x = np.array([[0.0, 3.0], [2.0, 1.0], [9.0, 9.0]])
    values, base = explain.shapley(x, paths)

    def known(row, features):
        total = 0.0
        for leaf, steps in paths:
            weight = 1.0
            for f, share, (_, limit, left) in steps:
                weight *= float((row[f] <= limit) == left) if f in features else share
            total += leaf * weight
        return total

    for row, got in zip(x, values):
        for f in (0, 1):
            want = np.mean([known(row, set(order[:order.index(f) + 1])) - known(row, set(order[:order.index(f)])) for order in permutations((0, 1))])
            assert got[f] == pytest.approx(want)
        assert base + got.sum() == pytest.approx(known(row, {0, 1}))


def test_tree_contributions_add_up(bound):
    rows = QUERIES["p07_tree_contributions"](bound).toPandas()
    assert len(rows) and np.allclose(rows.base + rows.contribution_sum, rows.margin)


def test_model_quality(bound):
    """All folds of all kinds with the full settings, trained once and read by every key."""
    made = {r.kind: r for r in QUERIES["m08_cross_validation"](bound).collect()}
    assert set(made) == {"logistic", "random_forest", "boosted"}
    assert all(0.6 < r.cv_roc_auc_mean <= 1.0 and 0 <= r.cv_roc_auc_std < 0.3 for r in made.values())
    test = QUERIES["m05_logistic"](bound)
    assert test.count() == 30 and test.where("score < 0 OR score > 1").isEmpty()
    folds = QUERIES["m09_out_of_fold"](bound)
    assert folds.count() == 120 and folds.select("customer_id").distinct().count() == 120
    best = max(made.values(), key=lambda r: r.cv_roc_auc_mean)
    assert ev.roc_auc(folds).first()[0] == pytest.approx(best.cv_roc_auc_mean, abs=0.1)
    assert not bound_steps(bound)


def bound_steps(bound):
    """Steps that a second look at the training has to do again: none."""
    from checks import registry
    from tidemark.operators import churn
    again = registry.steps(bound)
    churn.train_churn(registry.feature_table(bound), churn.FULL, again)
    again.ran.clear()
    churn.train_churn(registry.feature_table(bound), churn.FULL, again)
    return again.ran


def test_result_keeps_hold_out_metrics(bound):
    from checks.registry import _trained
    result = _trained(bound)
    held = result.metadata()[result.kind]
    assert held["test_default_0_5"]["threshold"] == 0.5 and held["test_retention_threshold"]["threshold"] == result.threshold
    assert sum(map(sum, held["test_retention_threshold"]["confusion_matrix"])) == 30 == result.test.count()
    assert set(held["classification_report"]) == {"0", "1", "macro avg", "weighted avg"}
    assert held["test_default_0_5"]["roc_auc"] == ev.roc_auc(result.test).first()[0]
    assert {"cv_roc_auc_mean", "cv_roc_auc_std"} <= set(result.metadata()["logistic"])
    reloaded = QUERIES["m16_save_reload"](bound).collect()
    assert len(reloaded) == 30 and {r.threshold for r in reloaded} == {result.threshold}
    assert QUERIES["m15_score_all"](bound).count() == 150


def test_explained_scores_carry_the_factors_of_the_fitted_model(bound):
    rows = QUERIES["p08_explained_scores"](bound).collect()
    assert len(rows) == 150 and all(len(r.top_factors) == 8 for r in rows)
    assert all([f.factor_rank for f in r.top_factors] == list(range(1, 9)) for r in rows)
    linear = QUERIES["p06_fitted_contributions"](bound).toPandas()
    assert len(linear) == 150 * 8 and (linear.direction == np.where(linear.contribution > 0, "increases risk", "reduces risk")).all()


class Asked(Exception):
    """Raised in place of a long job, with its arguments."""


def test_registered_model_jobs_have_the_full_settings(bound, monkeypatch):
    import inspect

    from checks import registry
    from tidemark.operators import churn, clv
    from tidemark.plans import batch

    monkeypatch.setattr(registry, "feature_table", lambda t: t["scored"])

    def asked(module, name, key):
        shape = inspect.signature(getattr(module, name))

        def stop(*args, **kwargs):
            given = shape.bind(*args, **kwargs)
            given.apply_defaults()
            raise Asked(given.arguments)

        with monkeypatch.context() as m, pytest.raises(Asked) as found:
            m.setattr(module, name, stop)
            QUERIES[key](bound)
        return found.value.args[0]

    for key, kind in (("m05_logistic", "logistic"), ("m06_random_forest", "random_forest"), ("m07_boosted_trees", "boosted")):
        got = asked(churn, "kind_step", key)
        assert (got["kind"], got["settings"]) == (kind, churn.FULL)
    for key in ("m08_cross_validation", "m09_out_of_fold"):
        assert asked(churn, "best_kind", key)["settings"] == churn.FULL
    assert asked(churn, "train_churn", "m15_score_all")["settings"] == churn.FULL
    for key in ("m17_clv_models", "m19_predicted_clv"):
        assert asked(clv, "train_clv", key)["settings"] == clv.ClvSettings()
    for key in ("m21_kmeans", "m22_silhouette"):
        got = asked(segments, "segment_customers", key)
        assert (list(got["ks"]), got["restarts"]) == ([2, 3, 4, 5, 6, 7], 30)
    got = asked(batch, "run", "s13_batch_run")
    assert not got["fast"] and got["churn_settings"] in (None, churn.FULL) and got["clv_settings"] in (None, clv.ClvSettings())
    assert got["restarts"] in (None, 30) and list(got["ks"]) == [2, 3, 4, 5, 6, 7]
    assert (churn.FULL.folds, churn.FULL.trees, churn.FULL.tree_depth, churn.FULL.rounds, churn.FULL.step, churn.FULL.l2) == (5, 300, None, 420, 0.035, 2.0)


def test_batch_top_k_is_the_same_both_ways(bound):
    v = bound["vectors"]
    shipped = retrieval.top_k_batch(v, v).toPandas()
    blocked = retrieval.top_k_batch(v, v, broadcast_bytes=0, query_block=100, corpus_block=120).toPandas()
    order = ["query_id", "rank"]
    assert shipped.sort_values(order)[["query_id", "id", "similarity", "rank"]].values.tolist() == blocked.sort_values(order)[["query_id", "id", "similarity", "rank"]].values.tolist()
    assert len(shipped) == v.count() * 8


def test_top_k_ties_and_zero_vectors(spark):
    df = spark.createDataFrame([(3, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0])], "vec_id int, embedding array<double>")
    unit = df.withColumn("embedding", retrieval.normalised("embedding"))
    got = retrieval.top_k(unit, spark.range(1).select(F.array(F.lit(2.0), F.lit(0.0))), k=3).collect()
    assert [(r.vec_id, r.similarity) for r in got] == [(1, 2.0), (3, 2.0), (2, 0.0)]


def test_any_local_encoder(bound):
    docs = retrieval.documents(bound["support_tickets"], bound["customer_feedback"]).limit(600)
    got = retrieval.embed_with(docs, lambda texts: np.array([[len(t), 1.0] for t in texts])).select("vector").collect()
    assert len(got) == 600 and all(abs(np.linalg.norm(r.vector) - 1) < 1e-9 for r in got)


@pytest.mark.parametrize("text, bare", [("```SQL\nselect 1;\n```", "select 1"), ("  select 2;; ", "select 2"), ("```\nselect 3\n```", "select 3")])
def test_strip_fence(spark, text, bare):
    assert guarded.strip_fence(text) == bare
    assert spark.range(1).select(guarded.strip_fence_column(F.lit(text))).first()[0] == bare


@pytest.fixture(scope="module")
def inner(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS tidemark_hidden")
    return guarded.sandbox(spark, lambda s: {"customers": Bound(s, FOLDER)["customers"], "payments": Bound(s, FOLDER)["payments"]})


@pytest.mark.parametrize("text", ["SELECT country, count(*) FROM customers GROUP BY 1", "WITH x AS (SELECT * FROM payments) SELECT sum(amount) s FROM x",
                                  "```sql\nSELECT customer_id FROM customers;\n```"])
def test_guard_lets_queries_pass(inner, text):
    assert guarded.validate_sql(text, inner)


@pytest.mark.parametrize("text", ["DELETE FROM customers", "DROP VIEW customers", "SELECT 1; SELECT 2", "SELECT * FROM secrets", "SELECT nothing FROM customers",
                                  f"SELECT * FROM parquet.`{FOLDER}/customer.parquet`", "INSERT INTO customers SELECT * FROM customers",
                                  "CREATE TABLE x AS SELECT 1", "SELECT 1) AS q; DROP VIEW customers; SELECT (1", "SELECT reflect('java.lang.System','exit')",
                                  "SELECT java_method('java.util.UUID','randomUUID')"])
def test_guard_stops_the_rest(inner, text):
    with pytest.raises(ValueError):
        guarded.validate_sql(text, inner)


def test_guard_does_not_see_other_views_or_saved_tables(spark, inner):
    spark.range(3).createOrReplaceTempView("callers_own")
    spark.range(3).write.mode("overwrite").option("path", f"{shared_dir(spark)}/hidden").saveAsTable("tidemark_hidden.secret")
    for text in ("SELECT * FROM callers_own", "SELECT * FROM tidemark_hidden.secret"):
        with pytest.raises(ValueError):
            guarded.validate_sql(text, inner)


def test_row_cap(inner):
    assert guarded.execute_safe("SELECT * FROM payments", inner, limit=7).count() == 7


def test_audit_records(bound):
    rows = {r.status: r for r in QUERIES["s14_audit"](bound).collect()}
    assert rows["ok"].rows == 25 or rows["ok"].rows > 0
    assert rows["error"].rows == 0 and rows["error"].sql == "DROP TABLE customers"


def test_quality_report_is_one_row(bound):
    rows = QUERIES["s04_quality_report"](bound).collect()
    assert len(rows) == 1 and rows[0].row_counts.customers == 150 and rows[0].orphan_customer_fk_counts.payments == 0


def test_queries_in_slices_shuffle_no_vectors(spark):
    """Many queries, few rows a slice: the same as brute force, and a task gives k rows a query whatever the number of blocks."""
    dice = np.random.default_rng(5)
    points = dice.integers(-3, 4, (300, 4)).astype(float)  # many equal similarities
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "vec_id long, embedding array<double>").repartition(3)
    got = retrieval.top_k_batch(df, df, k=5, broadcast_bytes=0, query_block=40, corpus_block=16)
    assert "CoGroup" not in got._jdf.queryExecution().toString()
    expected = {(q, int(i), rank + 1) for q in range(300) for rank, i in enumerate(np.lexsort((np.arange(300), -points @ points[q]))[:5])}
    assert {(r["query_id"], r["id"], r["rank"]) for r in got.collect()} == expected
    few = retrieval.top_k_batch(df.where("vec_id < 50"), df.where("vec_id < 3"), k=5, broadcast_bytes=0, query_block=20)
    assert few.count() == 150
    v = df.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    one = retrieval._slice_top(df.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("q")), v, 5, 6, 40, 16,
                               "query_id bigint, id bigint, similarity double")
    assert one.count() <= 3 * 300 * 5
