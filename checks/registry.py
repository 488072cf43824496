"""The registered queries: key -> function of the bound tables."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from checks.cleaning import MESSY, WITH_CUSTOMER
from checks.modelsql import AT, CORRELATED, M02_CATEGORICAL, M02_NUMERIC, P06_WEIGHTS
from tidemark.operators import (audience, churn, clv, engagement, evaluation, explain, explore, features, modelling,
                                policy, quality, reports, retrieval, revenue, risk, rootcause, segments, support)
from tidemark.functions.expr import as_literal
from tidemark.functions.intervals import anchored
from tidemark.plans import batch, views
from tidemark.plans.steps import Steps
from tidemark.session import new_path, settle, shared_dir
from tidemark.sources import catalog, files, guarded
from tidemark.sources.bindings import Bound

Query = Callable[[Bound], DataFrame]


def _w03(t: Bound) -> DataFrame:
    raw = views.customer_support_summary(t["customers"], t["support_tickets"])
    return raw.withColumns({c: F.round(raw[c].cast("double"), 6) for c in ("avg_csat", "avg_resolution_hours")})


BUSINESS: dict[str, Query] = {
    "w01_current_subscription": lambda t: views.current_subscription(t["subscriptions"]),
    "w02_customer_clv": lambda t: views.customer_clv(t["customers"], t["payments"]),
    "w03_support_summary": _w03,
    "q01_active_by_country": lambda t: audience.active_by_country(t["customers"], t["subscriptions"]),
    "q02_active_revenue_by_plan": lambda t: revenue.active_revenue_by_plan(t["subscriptions"], t["subscription_plans"]),
    "q03_churn_rate": lambda t: audience.churn_rate(t["churn_labels"]),
    "q04_channel_churn": lambda t: audience.channel_churn(t["customers"], t["churn_labels"]),
    "q05_age_by_plan": lambda t: audience.age_by_plan(t["subscriptions"], t["customers"], t["subscription_plans"]),
    "q06_top_titles": lambda t: engagement.top_titles(t["viewing_activity"], t["content"]),
    "q07_completion_by_genre": lambda t: engagement.completion_by_genre(t["viewing_activity"], t["content"]),
    "q08_failed_payments_by_month": lambda t: revenue.failed_payments_by_month(t["payments"]),
    "q09_resolution_by_category": lambda t: support.resolution_by_category(t["support_tickets"]),
    "q10_csat_distribution": lambda t: support.csat_distribution(t["support_tickets"]),
    "q11_minutes_by_device": lambda t: engagement.minutes_by_device(t["viewing_activity"]),
    "q12_rating_by_sentiment": lambda t: support.rating_by_sentiment(t["customer_feedback"]),
    "q13_signups_by_year": lambda t: audience.signups_by_year(t["customers"]),
    "q14_auto_renew_off": lambda t: revenue.auto_renew_off(t["subscriptions"]),
    "q15_frequent_contacts": lambda t: support.frequent_contacts(t["customers"], t["support_tickets"]),
    "q16_plan_revenue_rank": lambda t: revenue.plan_revenue_rank(t["subscriptions"], t["subscription_plans"]),
    "q17_latest_tickets": lambda t: support.latest_tickets(t["support_tickets"]),
    "q18_registrations_ma": lambda t: audience.registrations_moving_average(t["customers"]),
    "q19_latest_month_declines": lambda t: engagement.latest_month_declines(t["viewing_activity"]),
    "q20_cohort_retention": lambda t: audience.cohort_retention(t["customers"], t["subscriptions"]),
    "q21_top_churn_countries": lambda t: audience.top_churn_countries(t["customers"], t["churn_labels"]),
    "q22_running_spend": lambda t: revenue.running_spend(t["payments"]),
    "q23_three_month_declines": lambda t: engagement.three_month_declines(t["viewing_activity"]),
    "q24_monthly_churn": lambda t: audience.monthly_churn(t["churn_labels"], t["customers"]),
    "q25_channel_retention": lambda t: audience.channel_retention(t["customers"], t["churn_labels"]),
    "q26_spend_quartiles": lambda t: revenue.spend_quartiles(t["customers"], t["payments"]),
    "q27_top_subcategories": lambda t: support.top_subcategories(t["support_tickets"], t["customers"]),
    "q28_payment_risk": lambda t: risk.payment_risk(t["payments"], t["customers"], t["viewing_activity"],
                                                    t["support_tickets"], t["subscriptions"], t["subscription_plans"]),
    "q29_price_change_engagement": lambda t: revenue.price_change_engagement(t["subscriptions"], t["viewing_activity"]),
    "q30_country_profile": lambda t: risk.country_profile(t["customers"], t["churn_labels"], t["payments"]),
    "q31_at_risk_revenue": lambda t: risk.at_risk_revenue(t["customers"], t["subscriptions"], t["viewing_activity"],
                                                          t["payments"], t["support_tickets"]),
    "q32_quarter_complaints": lambda t: support.quarter_complaints(t["support_tickets"], t["customers"]),
    "q33_win_back": lambda t: risk.win_back(t["customers"], t["payments"], t["churn_labels"], t["viewing_activity"]),
    "q34_plan_migrations": lambda t: revenue.plan_migrations(t["subscriptions"], t["subscription_plans"], t["churn_labels"]),
    "q35_stickiness": lambda t: engagement.stickiness(t["viewing_activity"]),
    "q36_negative_near_trouble": lambda t: support.negative_near_trouble(t["customer_feedback"], t["payments"], t["support_tickets"]),
    "q37_health_scores": lambda t: risk.health_scores(t["customers"], t["subscriptions"], t["subscription_plans"],
                                                      t["viewing_activity"], t["payments"], t["support_tickets"]),
}


def _messy(t: Bound, name: str) -> DataFrame:
    return t.spark.sql(MESSY[name], **{used: t[used] for used in re.findall(r"\{(\w+)\}", MESSY[name])})


def _known_ages(t: Bound) -> DataFrame:
    named = quality.canonical(_messy(t, "messy_customers"), "country", quality.COUNTRY_SPELLINGS).fillna({"country": "Unknown"})
    return quality.valid_range(named, "age", 13, 100)


def _resolved(t: Bound) -> DataFrame:
    return quality.resolve_payments(t["payments"], t["subscriptions"])


def _tails(t: Bound) -> DataFrame:
    both = quality.upper_tail(t["viewing_activity"], ["watch_duration_minutes"]).unionByName(
        quality.upper_tail(t["payments"], ["amount"]))
    return both.withColumn("value", F.round("value", 6))


def _completion(t: Bound) -> DataFrame:
    filled = quality.impute_median(t["viewing_activity"].select("viewing_id", "content_id", "completion_percentage"),
                                   "completion_percentage", "content_id")
    return filled.select("viewing_id", F.round("completion_percentage", 6).alias("completion_percentage"))


CLEANING: dict[str, Query] = {
    "c01_keep_first": lambda t: quality.keep_first(t["dup_docs"], "text", "doc_id").select("doc_id", "text", "lang"),
    "c01_duplicates_removed": lambda t: quality.duplicates_removed(t["dup_docs"], "text"),
    "c02_country": lambda t: quality.canonical(_messy(t, "messy_customers"), "country", quality.COUNTRY_SPELLINGS).select(
        "customer_id", "country"),
    "c03_device": lambda t: quality.canonical(t["viewing_activity"], "device_type", quality.DEVICE_SPELLINGS, quality.UNKNOWN).select(
        "viewing_id", "device_type"),
    "c04_fill_unknown": lambda t: _messy(t, "messy_customers").select("customer_id", "country").fillna({"country": quality.UNKNOWN}),
    "c05_valid_age": lambda t: quality.valid_range(_messy(t, "messy_customers"), "age", 13, 100).select("customer_id", "age"),
    "c05_invalid_ages": lambda t: quality.out_of_range(_messy(t, "messy_customers"), "age", 13, 100),
    "c06_impute_age": lambda t: quality.impute_median(_known_ages(t), "age", "country", whole_numbers=True).select(
        "customer_id", "country", "age"),
    "c07_impute_completion": _completion,
    "c08_impute_language": lambda t: quality.impute_mode(_messy(t, "messy_customers"), "preferred_language").select(
        "customer_id", "preferred_language"),
    "c09_parse_dates": lambda t: quality.parse_dates(_messy(t, "messy_tickets"), ["ticket_date"]),
    "c09_bad_dates": lambda t: quality.bad_dates(_messy(t, "messy_tickets"), "ticket_date"),
    "c10_upper_tail": _tails,
    "c11_sentiment_audit": lambda t: quality.sentiment_audit(t["customer_feedback"]).select(
        "feedback_id", "rating", "sentiment_label", "rating_sentiment", "disagrees"),
    "c12_price_mismatches": lambda t: quality.price_mismatches(t["subscriptions"], t["subscription_plans"]),
    "c13_asof_resolve": lambda t: _resolved(t).select("payment_id", "customer_id", "payment_date", "subscription_id", "resolution"),
    "c14_resolution_counts": lambda t: _resolved(t).groupBy("resolution").agg(F.count(F.lit(1)).alias("payments")),
    "c15_orphans": lambda t: quality.orphan_counts(
        {"customers": t["customers"], **{name: t[name] for name in WITH_CUSTOMER}, "messy_facts": _messy(t, "messy_facts")}),
    "c16_row_counts": lambda t: quality.row_counts(t.tables()),
    "c17_rule_violations": lambda t: quality.rule_violations(t.tables()),
    "c18_after_cancellation": lambda t: _resolved(t).where("after_cancellation").select(
        "payment_id", "subscription_id", "after_cancellation"),
}


def _end(t: Bound):
    return features.data_end(t["viewing_activity"], t["payments"], t["support_tickets"], t["customer_feedback"])


def _anchors(t: Bound) -> DataFrame:
    return features.anchors(t["churn_labels"], as_literal(_end(t)))


def _at(t: Bound) -> DataFrame:
    return _anchors(t).select("customer_id", "anchor_date")


def steps(t: Bound) -> Steps:
    """Published intermediate results of a folder of test tables; a step is done again when what it reads has changed."""
    name = hashlib.sha256(t.folder.encode()).hexdigest()[:16]
    return Steps(t.spark, f"{shared_dir(t.spark).rstrip('/')}/steps-{name}")


def feature_table(t: Bound) -> DataFrame:
    """The feature table as published by the step that makes it."""
    names = ("customers", "churn_labels", "subscriptions", "subscription_plans", "content", "viewing_activity", "payments",
             "support_tickets", "customer_feedback")
    return steps(t).table("customer_features", lambda: features.customer_features(t.tables()), None, {n: t[n] for n in names})


FEATURES: dict[str, Query] = {
    "f01_data_end": lambda t: _end(t).withColumnRenamed("day", "data_end"),
    "f02_anchors": _anchors,
    "f03_event_window": lambda t: anchored(t["support_tickets"], _at(t), "ticket_date", 90).select(
        "ticket_id", "customer_id", "anchor_date", "days_before_anchor"),
    "f04_attach_default": lambda t: features.attach(
        t["customers"].select("customer_id"),
        t["support_tickets"].groupBy("customer_id").agg(F.count("ticket_id").alias("tickets")), {"tickets": 0}),
    "f10_tenure": lambda t: features.tenure(t["customers"].join(_anchors(t), "customer_id")).select(
        "customer_id", "customer_tenure_days"),
    "f11_f13_subscription_state": lambda t: features.subscription_state(
        _at(t), _at(t), t["subscriptions"], t["subscription_plans"]).drop("anchor_date"),
    "f14_f25_viewing": lambda t: features.viewing_features(_at(t), _at(t), t["viewing_activity"], t["content"]).drop("anchor_date"),
    "f26_f30_payments": lambda t: features.payment_features(_at(t), _at(t), t["payments"]).drop("anchor_date"),
    "f31_f35_support": lambda t: features.support_features(_at(t), _at(t), t["support_tickets"]).drop("anchor_date"),
    "f36_f38_feedback": lambda t: features.feedback_features(_at(t), _at(t), t["customer_feedback"]).drop("anchor_date"),
    "f39_f41_scores": lambda t: feature_table(t).select(
        "customer_id", "engagement_score", "billing_risk_score", "support_friction_score"),
    "f42_feature_table": feature_table,
}


def _anchor_row(t: Bound) -> DataFrame:
    return reports.report_anchor(t["payments"], t["viewing_activity"], t["churn_labels"])


def _anchor(t: Bound):
    return as_literal(_anchor_row(t))


FACTS: dict[str, Query] = {
    "r01_churn": lambda t: rootcause.churn_fact(t["churn_labels"], t["customers"], at=AT),
    "r02_engagement": lambda t: rootcause.engagement_fact(t["viewing_activity"], t["customers"], at=AT),
    "r03_payments": lambda t: rootcause.payment_fact(t["payments"], t["customers"], at=AT),
    "r04_support": lambda t: rootcause.support_fact(t["support_tickets"], t["customers"], at=AT),
    "r05_plan_mix": lambda t: rootcause.plan_mix(t["subscriptions"], t["customers"], t["subscription_plans"], AT),
    "r05_plan_mix_by_month": lambda t: rootcause.plan_mix_by_month(t["subscriptions"], t["customers"], t["subscription_plans"]),
    "r06_fact_packs": rootcause.fact_packs,
    "r07_anchor": lambda t: _anchor_row(t).withColumnRenamed("day", "anchor"),
    "r08_revenue": lambda t: reports.revenue(t["payments"], _anchor(t)),
    "r09_churned": lambda t: reports.churned(t["churn_labels"], _anchor(t)),
    "r10_new_customers": lambda t: reports.new_customers(t["customers"], _anchor(t)),
    "r11_active_viewers": lambda t: reports.active_viewers(t["viewing_activity"], _anchor(t)),
    "r12_csat": lambda t: reports.csat(t["support_tickets"], _anchor(t)),
    "r13_top_complaints": lambda t: reports.top_complaints(t["support_tickets"], _anchor(t)),
    "r14_report_text": lambda t: reports.render(reports.report_facts(t)),
}


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _kind(t: Bound, kind: str) -> dict:
    """Manifest of the training step of one kind of churn model, with the full settings."""
    return churn.kind_step(steps(t), feature_table(t), kind, churn.FULL)


def _model(t: Bound, kind: str):
    return PipelineModel.load(f"{_kind(t, kind)['path']}/model")


def _scored_by(kind: str) -> Query:
    """Test rows scored by the model of all training rows."""
    return lambda t: t.spark.read.parquet(f"{_kind(t, kind)['path']}/test_scores").select("customer_id", "label", F.round("score", 6).alias("score"))


def _rows_of(t: Bound, rows: list[tuple], shape: str) -> DataFrame:
    """A few computed rows as a table."""
    return t.spark.createDataFrame(rows, shape)


def _columns(t: Bound) -> DataFrame:
    numeric, categorical = churn.inputs(feature_table(t))
    named = [F.struct(F.lit(c).alias("name"), F.lit(kind).alias("kind"))
             for kind, columns in (("numeric", numeric), ("categorical", categorical)) for c in columns]
    known = feature_table(t).agg(*[F.count(c).alias(c) for c in numeric + categorical])
    counts = F.create_map(*[x for c in numeric + categorical for x in (F.lit(c), F.col(c))])
    return known.select(F.explode(F.array(*named)).alias("c"), counts.alias("k")).select(
        "c.*", F.col("k")[F.col("c.name")].alias("known_rows"))


def _preprocessed(t: Bound) -> DataFrame:
    """Filled inputs of the test rows: medians and modes of the training rows."""
    rows = churn.split_step(steps(t), feature_table(t), churn.FULL)
    numeric, categorical = churn.inputs(rows)
    model = modelling.Fill(numeric=numeric, categorical=categorical).fit(rows.where("NOT is_test"))
    filled = model.transform(rows.where("is_test"))
    return filled.select("customer_id", *[F.round(f"num_{c}", 6).alias(c) for c in M02_NUMERIC],
                         *[F.col(f"cat_{c}").alias(c) for c in M02_CATEGORICAL])


def _cross_validated(t: Bound) -> DataFrame:
    _, made = churn.best_kind(steps(t), feature_table(t), churn.FULL)
    return _rows_of(t, [(kind, m["cv_roc_auc_mean"], m["cv_roc_auc_std"]) for kind, m in made.items()],
                    "kind string, cv_roc_auc_mean double, cv_roc_auc_std double")


def _out_of_fold(t: Bound) -> DataFrame:
    best, made = churn.best_kind(steps(t), feature_table(t), churn.FULL)
    return t.spark.read.parquet(f"{made[best]['path']}/fold_scores").drop("fold")


def _trained(t: Bound) -> churn.ChurnResult:
    return churn.train_churn(feature_table(t), churn.FULL, steps(t))


def _reloaded(t: Bound) -> DataFrame:
    """Test rows scored by the selected model after saving it with its metadata and loading it again."""
    result, path = _trained(t), new_path(t.spark, "churn-model")
    modelling.save_model(result.model, path, result.metadata())
    again, metadata = modelling.load_model(t.spark, path)
    test = churn.split_step(steps(t), feature_table(t), churn.FULL).where("is_test")
    return churn.probability(again.transform(test)).select("customer_id", F.round("score", 6).alias("score"),
                                                           F.lit(metadata["retention_threshold"]).alias("threshold"))


def _clv_metrics(t: Bound) -> DataFrame:
    result = clv.train_clv(feature_table(t), clv.ClvSettings(), steps(t))
    return _rows_of(t, [(kind, *(float(v[m]) for m in ("mae", "rmse", "r2"))) for kind, v in result.metrics.items()],
                    "kind string, mae double, rmse double, r2 double")


def _segments(t: Bound):
    return segments.segment_customers(feature_table(t))


def _silhouettes(t: Bound) -> DataFrame:
    return _rows_of(t, [(k, float(s)) for k, s in _segments(t).silhouettes.items()], "k int, silhouette double")


def _plane(t: Bound) -> DataFrame:
    z = settle(segments.z_scores(feature_table(t)), "segment-vectors")
    placed = segments.plane_coordinates(z, segments.loadings(segments.point_blocks(z)))
    return placed.select("customer_id", F.round("pca_1", 6).alias("pca_1"), F.round("pca_2", 6).alias("pca_2"))


def _clustered(t: Bound) -> DataFrame:
    return feature_table(t).join(t["segments"], "customer_id")


def _named(t: Bound) -> DataFrame:
    return segments.name_segments(segments.profiles(_clustered(t)), feature_table(t)).select(
        "cluster_id", "customer_count", "cluster_name")


MODELS: dict[str, Query] = {
    "m01_model_columns": _columns,
    "m02_preprocess": _preprocessed,
    "m03_hold_out": lambda t: evaluation.hold_out(t["scored"], "customer_id").select("customer_id", "is_test"),
    "m04_class_weights": lambda t: evaluation.class_weights(t["scored"]),
    "m05_logistic": _scored_by("logistic"),
    "m06_random_forest": _scored_by("random_forest"),
    "m07_boosted_trees": _scored_by("boosted"),
    "m08_cross_validation": _cross_validated,
    "m09_out_of_fold": _out_of_fold,
    "m10_threshold_sweep": lambda t: _rounded(evaluation.threshold_sweep(t["scored"]), 9, "threshold", "f_beta"),
    "m10_best_threshold": lambda t: _rounded(evaluation.best_threshold(t["scored"]), 9, "threshold", "f_beta"),
    "m11_metrics": lambda t: evaluation.metrics_at(t["scored"], 0.5),
    "m12_roc_auc": lambda t: _rounded(evaluation.roc_auc(t["scored"]), 9, "roc_auc"),
    "m13_average_precision": lambda t: _rounded(evaluation.average_precision(t["scored"]), 9, "average_precision"),
    "m14_classification_report": lambda t: _rounded(evaluation.classification_report(t["scored"], 0.5), 9, "precision", "recall", "f1"),
    "m15_risk_bands": lambda t: t["scored"].select("customer_id", "score", evaluation.risk_band("score").alias("risk_band")),
    "m15_score_all": lambda t: churn.score_all(_trained(t).model, feature_table(t)),
    "m16_save_reload": _reloaded,
    "m17_clv_models": _clv_metrics,
    "m18_regression_metrics": lambda t: _rounded(evaluation.regression_metrics(t["scored"], "label", "score"), 9, "mae", "rmse", "r2"),
    "m19_predicted_clv": lambda t: clv.predict_all(clv.train_clv(feature_table(t), clv.ClvSettings(), steps(t)).model, feature_table(t)),
    "m20_z_scores": lambda t: _rounded(segments.z_scores(feature_table(t)), 6, *segments.INPUTS),
    "m21_kmeans": lambda t: _segments(t).customers.select("customer_id", "cluster_id", "cluster_name"),
    "m22_silhouette": _silhouettes,
    "m23_profiles": lambda t: _rounded(segments.profiles(_clustered(t)), 6, *segments.INPUTS),
    "m24_segment_names": _named,
    "m25_plane": _plane,
    "m26_correlations": lambda t: evaluation.correlations(feature_table(t), "churned", CORRELATED),
}


def _policy_inputs(t: Bound) -> tuple[DataFrame, DataFrame, DataFrame]:
    scores = t["scored"].select("customer_id", F.col("score").alias("churn_probability"), evaluation.risk_band("score").alias("risk_band"))
    named = t["segments"].select("customer_id", F.concat(F.lit("C"), F.col("cluster_id").cast("string")).alias("cluster_name"))
    return feature_table(t), scores, named


def _retention(t: Bound) -> DataFrame:
    return policy.retention_table(*_policy_inputs(t))


def _tree_contributions(t: Bound) -> DataFrame:
    test = churn.split_step(steps(t), feature_table(t), churn.FULL).where("is_test")
    return explain.tree_contributions(test, _model(t, "boosted").stages[-1].ensemble)


def _factors(t: Bound, kind: str) -> DataFrame:
    """Top factors of all customers by the fitted model of a kind."""
    numeric, categorical = churn.inputs(feature_table(t))
    return explain.model_contributions(churn.labelled(feature_table(t)), _model(t, kind), numeric, categorical)


def _explained(t: Bound) -> DataFrame:
    result = _trained(t)
    scored = churn.probability(result.model.transform(churn.labelled(feature_table(t))))
    return explain.explained_scores(scored, result.threshold, explain.model_contributions(
        churn.labelled(feature_table(t)), result.model, result.numeric, result.categorical))


POLICY: dict[str, Query] = {
    "p01_join": lambda t: policy.joined(*_policy_inputs(t)).select("customer_id", "churn_probability", "risk_band", "cluster_name"),
    "p02_percentiles": lambda t: _retention(t).select("customer_id", "clv_percentile", "risk_percentile"),
    "p03_actions": lambda t: _retention(t).select("customer_id", "recommended_action"),
    "p04_priority": lambda t: _retention(t).select("customer_id", "priority_score"),
    "p05_recommendations": lambda t: policy.recommend(_retention(t)),
    "p06_linear_contributions": lambda t: explain.linear_contributions(feature_table(t), P06_WEIGHTS),
    "p07_tree_contributions": _tree_contributions,
    "p06_fitted_contributions": lambda t: _factors(t, "logistic"),
    "p08_explained_scores": _explained,
}


def _documents(t: Bound) -> DataFrame:
    return retrieval.documents(t["support_tickets"], t["customer_feedback"])


def _evidence(t: Bound) -> DataFrame:
    first = Window.partitionBy("subcategory").orderBy("source", "id")
    ranked = _documents(t).withColumn("rank", F.row_number().over(first)).where("rank <= 8")
    return retrieval.evidence_pack(ranked, "subcategory")


def _lengths(t: Bound) -> DataFrame:
    unit = retrieval.normalised("embedding")
    square = F.aggregate(F.col("embedding"), F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    return t["vectors"].select("vec_id", F.round(F.sqrt(square), 6).alias("norm_before"), F.round(unit[0], 6).alias("first_value"))


def _fenced(t: Bound) -> DataFrame:
    return t.spark.sql("""
SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '```SQL' || chr(10) || 'select ' || doc_id || ';' || chr(10) || '```' WHEN 1 THEN '  select * from t; '
 WHEN 2 THEN '```' || chr(10) || 'select lang' || chr(10) || '```  ' ELSE 'select ' || lang || ' from docs;;' END sql FROM {docs}""", docs=t["dup_docs"])


QUESTION = "SELECT country, count(*) AS n FROM customers GROUP BY country ORDER BY n DESC, country"


def _sandbox(t: Bound):
    return guarded.sandbox(t.spark, lambda inner: Bound(inner, t.folder).tables())


def _handed_over(inner_df: DataFrame, t: Bound) -> DataFrame:
    """Bring the capped result back to the caller's session through the shared folder."""
    path = new_path(t.spark, "answer")
    inner_df.write.parquet(path)
    return t.spark.read.parquet(path)


def _guard_verdicts(t: Bound) -> DataFrame:
    inner = _sandbox(t)
    texts = {"select": QUESTION, "with": "WITH c AS (SELECT * FROM churn_labels) SELECT count(*) n FROM c",
             "delete": "DELETE FROM customers", "drop": "DROP VIEW customers", "two": "SELECT 1; SELECT 2",
             "unknown_table": "SELECT * FROM secrets", "unknown_column": "SELECT nothing FROM customers",
             "file": f"SELECT * FROM parquet.`{t.folder}/customer.parquet`"}
    verdicts = []
    for name, text in texts.items():
        try:
            guarded.validate_sql(text, inner)
            verdicts.append((name, True))
        except ValueError:
            verdicts.append((name, False))
    rows = [F.struct(F.lit(n).alias("statement"), F.lit(v).alias("allowed")) for n, v in verdicts]
    total = t["customers"].agg(F.count(F.lit(1)).alias("customers"))
    return total.select(F.explode(F.array(*rows)).alias("v"), "customers").select("v.*", "customers")


def _audited(t: Bound) -> DataFrame:
    path, inner = new_path(t.spark, "audit"), _sandbox(t)
    guarded.ask(t.spark, "Where do customers live?", QUESTION, inner, path)
    try:
        guarded.ask(t.spark, "Remove everything", "DROP TABLE customers", inner, path)
    except ValueError:
        pass
    return t.spark.read.json(path).select("question", "sql", "status", "rows")


TEXT: dict[str, Query] = {
    "t01_documents": _documents,
    "t02_embed": lambda t: retrieval.embed(_documents(t))[0].select("source", "id", F.size("vector").alias("width")),
    "t03_normalise": _lengths,
    "t04_vector_table": lambda t: settle(retrieval.embed(_documents(t))[0], "document-vectors").groupBy("source").agg(
        F.count(F.lit(1)).alias("documents")),
    "t05_topk_similar": lambda t: retrieval.top_k(
        t["vectors"], t["vectors"].agg(F.min_by("embedding", "vec_id")), digits=6).select("vec_id", "label", "similarity"),
    "t05_retrieve_words": lambda t: retrieval.retrieve(_documents(t), "k 69").select("source", "id", "similarity"),
    "t06_topk_batch": lambda t: retrieval.top_k_batch(t["vectors"], t["vectors"]),
    "t07_evidence_pack": _evidence,
    "t07_retrieved_evidence": lambda t: retrieval.evidence_for(_documents(t), "k 69"),
    "t08_strip_fence": lambda t: _fenced(t).select("doc_id", guarded.strip_fence_column("sql").alias("sql")),
    "t09_capped_query": lambda t: _handed_over(guarded.execute_safe(QUESTION, _sandbox(t)), t),
    "t10_sql_guard": _guard_verdicts,
    "t11_csv_preview": lambda t: guarded.csv_preview(t["customers"].select("customer_id", "country", "age").orderBy("customer_id")),
}


def _published_scores(t: Bound) -> DataFrame:
    return t["scored"].select("customer_id", evaluation.risk_band("score").alias("risk_band"))


EXPLORE: dict[str, Query] = {
    "d01_kpis": lambda t: explore.kpis(feature_table(t), t["payments"], _published_scores(t), t["support_tickets"]),
    "d02_churn_by_plan": lambda t: explore.churn_by(features.feature_columns(t), "current_plan"),
    "d03_sample": lambda t: explore.stable_sample(t["customers"], "customer_id", 3000).select("customer_id", "country", "customer_segment"),
    "d04_filtered": lambda t: explore.filtered(features.feature_columns(t), {
        "country": ["NATION_1", "NATION_2", "NATION_3"], "current_plan": ["Premium", "Basic"], "customer_segment": []}).select(
        "customer_id", "country", "current_plan"),
    "d04_options": lambda t: explore.options(features.feature_columns(t), "current_plan"),
    "d05_customer_grid": lambda t: explore.customer_grid(feature_table(t)),
    "d06_age_histogram": lambda t: explore.histogram(t["customers"], "age", 35),
    "d06_tenure_by_churn": lambda t: explore.histogram(feature_table(t), "customer_tenure_days", 30, ["churned"]),
    "d06_age_by_churn": lambda t: explore.histogram(feature_table(t), "age", 35, ["churned"]),
    "d06_watch_histogram": lambda t: explore.histogram(t["viewing_activity"], "watch_duration_minutes", 60),
    "d06_completion_histogram": lambda t: explore.histogram(t["viewing_activity"], "completion_percentage", 40),
    "d06_amount_histogram": lambda t: explore.histogram(t["payments"], "amount", 50, ["payment_status"]),
    "d06_csat_histogram": lambda t: explore.histogram(t["support_tickets"], "customer_satisfaction_score", 5),
    "d07_plan_churn_box": lambda t: explore.box_summary(feature_table(t), ["current_plan", "churned"], "engagement_score"),
    "d07_engagement_box": lambda t: explore.box_summary(feature_table(t), "churned", "engagement_score"),
    "d07_resolution_box": lambda t: explore.box_summary(t["support_tickets"], "issue_category", "resolution_time_hours"),
    "d07_rating_box": lambda t: explore.box_summary(t["customer_feedback"], "sentiment_label", "rating"),
    "d07_failed_rate_box": lambda t: explore.box_summary(feature_table(t), "churned", "failed_payment_rate"),
    "d07_ticket_volume_box": lambda t: explore.box_summary(feature_table(t), "churned", "support_ticket_count"),
    "d08_countries": lambda t: explore.value_counts(t["customers"], "country", 20),
    "d08_subcategories": lambda t: explore.value_counts(t["support_tickets"], "issue_subcategory", 15),
    "d08_channels": lambda t: explore.value_counts(t["customers"], "acquisition_channel"),
    "d08_devices": lambda t: explore.value_counts(t["viewing_activity"], "device_type"),
    "d08_categories": lambda t: explore.value_counts(t["support_tickets"], "issue_category"),
    "d09_segment_mix": lambda t: explore.shares(t["customers"], "customer_segment"),
    "d09_plan_mix": lambda t: explore.shares(features.feature_columns(t), "current_plan"),
    "d10_recurring_revenue": lambda t: explore.recurring_revenue(features.feature_columns(t)),
    "d11_churn_by_country": lambda t: explore.churn_by(features.feature_columns(t), "country", 20),
    "d12_monthly_minutes": lambda t: engagement.monthly_minutes(t["viewing_activity"]),
    "d13_minutes_by_genre": lambda t: engagement.minutes_by_genre(t["viewing_activity"], t["content"]),
    "d14_failed_history": lambda t: revenue.failed_payments_by_month(t["payments"], months=None),
    "d15_cluster_sizes": lambda t: explore.cluster_sizes(t["segments"]),
    "d15_cluster_top": lambda t: explore.cluster_top(t["segments"], feature_table(t)),
    "d16_table_shapes": lambda t: quality.table_shapes(t.tables()),
}


def _raw_text(t: Bound) -> dict[str, DataFrame]:
    """The bound tables as they would be delivered: dates as text, customers in a known order."""
    raw = {name: files.iso_dates(df) for name, df in t.tables().items()}
    raw["customers"] = raw["customers"].withColumn(files.ORDER, F.col("customer_id"))
    return raw


def _delivered(t: Bound, *names: str) -> tuple[str, dict]:
    folder = new_path(t.spark, "csv")
    files.write_csv({name: t[name] for name in names}, folder)
    return folder, {name: t[name].schema for name in names}


def _read_raw(t: Bound) -> DataFrame:
    folder, schemas = _delivered(t, "customers")
    return files.read_raw(t.spark, folder, ["customers"], schemas)["customers"].drop(files.ORDER)


def _read_processed(t: Bound) -> DataFrame:
    folder, schemas = _delivered(t, "churn_labels")
    return files.read_processed(t.spark, folder, ["churn_labels"], schemas)["churn_labels"]


def _written_text(t: Bound) -> DataFrame:
    folder, _ = _delivered(t, "support_tickets")
    return t.spark.read.schema("ticket_id bigint, customer_id bigint, ticket_date string").option("header", True).option(
        "enforceSchema", True).csv(f"{folder}/support_tickets.csv").select("ticket_id", "ticket_date")


def _report(t: Bound) -> DataFrame:
    path = new_path(t.spark, "report")
    files.write_report(quality.clean_all(_raw_text(t))[1], path)
    return t.spark.read.json(path)


def _saved(t: Bound) -> tuple[str, list[str]]:
    database = "tidemark_mart"
    return database, catalog.reload_tables(t.spark, t.tables(), database, new_path(t.spark, "mart"))


def _reload(t: Bound) -> DataFrame:
    _, names = _saved(t)
    return quality.row_counts({name.split(".")[1]: t.spark.table(name) for name in names})


def _score_mart(t: Bound) -> DataFrame:
    path = new_path(t.spark, "scores")
    before = catalog.load_scores(t.spark, path, "tidemark_mart", new_path(t.spark, "mart"))
    t["scored"].write.parquet(path)
    after = catalog.load_scores(t.spark, path, "tidemark_mart", new_path(t.spark, "mart"))
    return t.spark.table("tidemark_mart.ml_customer_scores").agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(before).alias("loaded_before"), F.lit(after).alias("loaded_after"))


def _documents_back(t: Bound) -> DataFrame:
    path, docs = new_path(t.spark, "jsonl"), _documents(t)
    files.write_documents(docs, path)
    return files.read_documents(t.spark, path, docs.schema)


def _dates_as_text(t: Bound) -> DataFrame:
    """The feature table written as CSV with ISO dates, read back as text."""
    folder, table = new_path(t.spark, "features"), feature_table(t)
    files.write_csv({"customer_features": table}, folder)
    shape = ", ".join(f"`{f.name}` {'bigint' if f.name == 'customer_id' else 'string'}" for f in table.schema.fields)
    return t.spark.read.schema(shape).option("header", True).csv(f"{folder}/customer_features.csv").select("customer_id", "anchor_date", "last_view_date")


def _outputs(t: Bound) -> DataFrame:
    folder = new_path(t.spark, "published")
    tables = {"customer_churn_scores": t["scored"], "customer_segments": t["segments"],
              "retention_priorities": policy.recommend(_retention(t))}
    files.write_parquet(tables, folder)
    return quality.row_counts({name: t.spark.read.parquet(f"{folder}/{name}") for name in tables})


def _views(t: Bound) -> DataFrame:
    names = views.create_views(t)
    counted = quality.row_counts({name: t.spark.table(name) for name in names})
    return counted.select(F.col("table_name").alias("view_name"), F.col("row_count").alias("n"))


def _batch(t: Bound) -> DataFrame:
    published = batch.run(t.spark, _raw_text(t), new_path(t.spark, "batch"), index=True)
    return quality.row_counts(published)


SOURCES: dict[str, Query] = {
    "s01_read_raw_csv": _read_raw,
    "s02_read_processed": _read_processed,
    "s03_write_iso_csv": _written_text,
    "s04_quality_report": _report,
    "c19_clean_all": lambda t: quality.row_counts(quality.clean_all(_raw_text(t))[0]),
    "s05_reload_tables": _reload,
    "s06_score_mart": _score_mart,
    "s07_parameterised_query": lambda t: catalog.query_df(
        t.spark, "SELECT country, count(*) n FROM {customers} WHERE age >= :low AND acquisition_channel = :channel GROUP BY country",
        {"low": 40, "channel": "Paid"}, customers=t["customers"]),
    "s08_catalog": lambda t: catalog.schema_text(catalog.schema_catalog(t.spark, _saved(t)[0])),
    "s09_jsonl_documents": _documents_back,
    "s10_feature_dates": _dates_as_text,
    "s11_published_tables": _outputs,
    "s12_views": _views,
    "s13_batch_run": _batch,
    "s14_audit": _audited,
}

QUERIES: dict[str, Query] = {**BUSINESS, **CLEANING, **FACTS, **FEATURES, **MODELS, **POLICY, **TEXT, **EXPLORE, **SOURCES}
