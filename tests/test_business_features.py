"""Edge cases of the business queries and the feature table."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import audience, engagement, features, revenue, risk, support

D = dt.date


def test_moving_average_counts_observed_months(make):
    c = make("customer_id int, registration_date date", (1, "2024-01-05"), (2, "2024-01-09"), (3, "2024-03-01"), (4, "2024-04-01"), (5, "2024-05-01"))
    assert [r.registrations_3m_ma for r in audience.registrations_moving_average(c).collect()] == [2.0, 1.5, 1.33, 1.0]


def test_three_month_declines_ignore_gaps(make):
    v = make("customer_id int, viewing_date date, watch_duration_minutes int", (1, "2024-01-01", 30), (1, "2024-03-01", 20), (1, "2024-07-01", 10))
    assert [(r.month, r.month_n_minus_2) for r in engagement.three_month_declines(v).collect()] == [(D(2024, 7, 1), 30)]


def test_cohort_retention_clamps_month_end(make):
    c = make("customer_id int, registration_date date", (1, "2023-01-31"), (2, "2023-01-31"))
    s = make("customer_id int, subscription_start_date date, subscription_end_date date, cancellation_date date",
             (1, "2023-01-31", "2023-02-28", None), (2, "2023-01-31", "2023-02-27", None))
    row = audience.cohort_retention(c, s).first()
    assert (row.cohort_size, row.retention_1m_pct, row.retention_3m_pct) == (2, 50.0, 0.0)


def test_monthly_churn_on_the_first(make):
    c = make("customer_id int, registration_date date", (1, "2023-12-31"), (2, "2024-05-01"), (3, "2023-01-01"))
    labels = make("customer_id int, churned boolean, churn_date date", (1, True, "2024-05-01"), (2, False, None), (3, False, None))
    rows = audience.monthly_churn(labels, c).collect()
    assert len(rows) == 12 and rows[-1].month_start == D(2024, 5, 1)
    assert (rows[-1].active_at_start, rows[-1].churned_in_month, rows[-1].churn_rate_pct) == (2, 1, 50.0)
    assert rows[0].month_start == D(2023, 6, 1) and rows[0].active_at_start == 1


def test_price_change_of_a_single_subscription(make):
    s = make("customer_id int, subscription_id int, subscription_start_date date, monthly_price decimal(6,2)", (1, 1, "2024-02-01", 9), (2, 2, "2024-01-01", 9), (2, 3, "2024-03-01", 9))
    v = make("customer_id int, viewing_date date, watch_duration_minutes int", (1, "2024-01-02", 10), (1, "2024-01-31", 30), (1, "2024-02-01", 50), (1, "2024-03-02", 50), (1, "2024-03-03", 9))
    rows = {r.customer_id: r for r in revenue.price_change_engagement(s, v).collect()}
    assert rows[1].old_price is None and rows[1].avg_watch_before == 20.0 and rows[1].avg_watch_after == 50.0 and rows[1].pct_change == 150.0
    assert rows[2].change_date == D(2024, 1, 1)


def test_week_across_two_months(make):
    v = make("customer_id int, viewing_date date", (1, "2024-04-30"), (1, "2024-05-01"), (2, "2024-05-01"))
    rows = {r.month: r for r in engagement.stickiness(v).collect()}
    assert rows[D(2024, 4, 1)].avg_wau == 1.0 and rows[D(2024, 5, 1)].avg_wau == 2.0 and rows[D(2024, 5, 1)].mau == 2


def test_negative_feedback_window(make):
    f = make("feedback_id int, customer_id int, feedback_date date, rating int, feedback_text string", (1, 1, "2024-03-15", 1, "x"), (2, 2, "2024-03-15", 2, "y"), (3, 1, "2024-03-15", 3, "z"))
    p = make("customer_id int, payment_date date, payment_status string", (1, "2024-03-29", "Failed"), (2, "2024-03-15", "Success"))
    t = make("customer_id int, ticket_date date, customer_satisfaction_score int", (2, "2024-03-01", 2))
    assert sorted(r.feedback_id for r in support.negative_near_trouble(f, p, t).collect()) == [1, 2]
    later = p.withColumn("payment_date", F.lit("2024-03-30").cast("date"))
    assert [r.feedback_id for r in support.negative_near_trouble(f, later, t.where("false")).collect()] == []


def test_running_spend_of_a_dominant_customer(spark):
    n = 600
    df = spark.range(n).select(
        F.when(F.col("id") < 400, 1).otherwise(F.col("id") % 20 + 2).alias("customer_id"), F.format_string("p%05d", "id").alias("payment_id"),
        F.date_add(F.lit("2024-01-01"), (F.col("id") % 90).cast("int")).alias("payment_date"), F.lit(1.5).cast("decimal(7,2)").alias("amount"),
        F.when(F.col("id") % 4 == 0, "Failed").otherwise("Success").alias("payment_status"))
    got = {r.payment_id: r.running_successful_spend for r in revenue.running_spend(df, cells=6).collect()}
    plain = revenue.running_spend(df).collect()
    assert len(got) == n and all(got[r.payment_id] == r.running_successful_spend for r in plain)


def _tables(make, late=False):
    extra_v = [(9, 1, 7, "2024-07-02", 500, 90, "Mobile")] if late else []
    return {
        "customers": make("customer_id int, country string, registration_date date", (1, "A", "2024-01-01"), (2, "B", "2024-12-31"), (3, "A", "2024-01-01")),
        "churn_labels": make("customer_id int, churned boolean, churn_date date, churn_reason string", (1, True, "2024-07-01", "r"), (2, False, None, None), (3, True, None, None)),
        "subscriptions": make("subscription_id int, customer_id int, subscription_start_date date, plan_id string, subscription_status string, auto_renew boolean, monthly_price decimal(6,2)",
                              (1, 1, "2024-01-01", "p", "Active", None, 5), (2, 1, "2024-07-01", "q", "Active", True, 6), (3, 1, "2024-07-02", "p", "Active", True, 7)),
        "subscription_plans": make("plan_id string, plan_name string", ("p", "Basic"),),
        "content": make("content_id int, genre string", (7, "Drama"),),
        "viewing_activity": make("viewing_id int, customer_id int, content_id int, viewing_date date, watch_duration_minutes int, completion_percentage decimal(5,2), device_type string",
                                 (1, 1, 7, "2024-07-01", 60, 50, "TV"), (2, 1, 8, "2024-06-02", 30, 100, "TV"), (3, 1, 7, "2024-06-01", 6, None, "PC"), (4, 1, 7, "2024-04-03", 1, 10, "PC"),
                                 (5, 1, 7, "2024-04-02", 1, 10, "X"), *extra_v),
        "payments": make("customer_id int, payment_date date, amount decimal(7,2), payment_status string", (1, "2024-07-01", 5, "Success"), (1, "2024-07-02", 99, "Success"),
                         (1, "2024-06-30", 1, "Failed"), (2, "2024-07-09", 4, "Success")),
        "support_tickets": make("customer_id int, ticket_date date, customer_satisfaction_score int, resolution_time_hours decimal(6,1), priority string", (1, "2024-07-01", 2, 4, "High"), (1, "2024-06-30", None, None, "Low"), (1, None, 1, 1, "High")),
        "customer_feedback": make("customer_id int, feedback_date date, rating int", (1, "2024-06-30", 1), (1, "2024-07-01", 5), (1, "2023-06-01", 1)),
    }


def test_feature_windows_and_defaults(make):
    rows = {r.customer_id: r for r in features.customer_features(_tables(make)).collect()}
    one, two, three = rows[1], rows[2], rows[3]
    assert one.anchor_date == D(2024, 7, 1) and two.anchor_date == D(2024, 7, 9) and three.anchor_date == D(2024, 7, 9)
    assert (one.sessions_30d, one.sessions_90d) == (2, 4)  # 0 and 29 days in, 30 out; 89 in, 90 out
    assert (one.watch_minutes_30d, one.watch_minutes_prev30d, one.watch_minutes_change_pct_30d) == (90, 6, 500.0)
    assert (one.active_days_90d, one.device_diversity_90d, one.genre_diversity_90d) == (4, 2, 1)
    assert (one.current_plan_id, one.current_plan, one.plan_changes, one.auto_renew) == ("q", "Unknown", 1, True)
    assert (one.customer_lifetime_value, one.failed_payment_count, one.payment_count_90d) == (5.0, 1, 2)
    assert (one.support_ticket_count_90d, one.low_csat_ticket_rate_180d, one.high_priority_tickets_90d) == (2, 0.5, 1)
    assert (one.feedback_count_180d, one.negative_feedback_rate_180d, one.avg_feedback_rating_180d) == (2, 0.5, 3.0)
    assert one.churned == 1 and two.customer_tenure_days == 0
    assert (two.days_since_last_activity, two.avg_customer_satisfaction, two.current_plan, two.auto_renew) == (999, 3.0, "Unknown", False)
    assert two.watch_minutes_change_pct_30d == 0.0 and two.login_frequency == 0.0
    assert one.login_frequency == 5 / 4 - 0.0 or one.login_frequency == 5 / 3


def test_watch_trend_equals_least_squares(make):
    import numpy as np
    one = {r.customer_id: r for r in features.customer_features(_tables(make)).collect()}[1]
    bins = np.zeros(6)
    for age, minutes in ((0, 60), (29, 30), (30, 6), (89, 1), (90, 1)):
        bins[5 - age // 30] += minutes
    assert abs(one.monthly_watch_time_trend - np.polyfit(range(6), bins, 1)[0]) < 1e-9


def test_nothing_after_the_anchor_counts(make):
    end = F.lit("2024-07-09").cast("date")
    before = {r.customer_id: r for r in features.customer_features(_tables(make), end).collect()}
    after = {r.customer_id: r for r in features.customer_features(_tables(make, late=True), end).collect()}
    assert before[1] == after[1]


def test_engagement_score_matches_pandas(spark, make):
    import pandas as pd
    got = features.customer_features(_tables(make)).toPandas()
    r = lambda c: got[c].rank(pct=True)
    want = 100 * (.35 * (1 - r("days_since_last_activity")) + .30 * r("sessions_90d") + .20 * r("avg_completion_90d") + .15 * r("monthly_watch_time_trend"))
    assert pd.Series(got.engagement_score - want.round(2)).abs().max() < 0.011


def test_win_back_bands(make):
    c = make("customer_id int", *[(i,) for i in range(1, 5)])
    p = make("customer_id int, amount decimal(7,2), payment_status string", (1, 1, "Success"), (2, 2, "Success"), (3, 3, "Success"), (4, 9, "Success"))
    labels = make("customer_id int, churned boolean, churn_date date, churn_reason string", (4, True, "2024-03-31", "r"), (3, True, "2024-03-31", "r"))
    v = make("customer_id int, viewing_date date, watch_duration_minutes int", (4, "2024-03-01", 100), (4, "2024-03-31", 80), (4, "2024-02-29", 900))
    rows = risk.win_back(c, p, labels, v).collect()
    assert [(r.customer_id, r.last30_watch_minutes, r.last_engagement_level) for r in rows] == [(4, 180, "Medium")]
