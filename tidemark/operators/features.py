"""One row per customer, as known at the customer's anchor date.

A churned customer is anchored at the churn date, everyone else at the end of the data. No event after
the anchor is used. Each fact is read once: joined with the anchors, aged in days, and reduced by
conditional aggregates to one row per customer.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import as_literal, count_if, latest_day, month, ratio_even
from tidemark.functions.intervals import anchored
from tidemark.functions.ordering import add_ranks, twice_average_rank
from tidemark.session import settle

NEVER = 999
AGE = "days_before_anchor"


def data_end(viewing: DataFrame, payments: DataFrame, tickets: DataFrame, feedback: DataFrame) -> DataFrame:
    """last event day over the four facts, as one row."""
    return latest_day((viewing, "viewing_date"), (payments, "payment_date"), (tickets, "ticket_date"),
                      (feedback, "feedback_date"))


def anchors(churn_labels: DataFrame, end: Column) -> DataFrame:
    """F02"""
    anchor = F.coalesce(F.when(F.col("churned"), F.col("churn_date")), end)
    return churn_labels.select("customer_id", "churned", "churn_date", "churn_reason", anchor.alias("anchor_date"))


def attach(base: DataFrame, grouped: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """left join per customer, with defaults where nothing was found."""
    joined = base.join(grouped, "customer_id", "left")
    return joined.withColumns({
        c: F.coalesce(F.col(c), F.lit(value).cast(grouped.schema[c].dataType)) for c, value in defaults.items()})


def _within(days: int, value: Column | None = None, start: int = 0) -> Column:
    return F.when(F.col(AGE).between(start, days - 1), F.lit(1) if value is None else value)


def _count(days: int, condition: Column | None = None) -> Column:
    inside = F.col(AGE) < days
    return count_if(inside if condition is None else inside & condition)


def _mean(days: int, c: str) -> Column:
    value = _within(days, F.col(c))
    return F.try_divide(F.sum(value).cast("double"), F.count(value))


def _share(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole)), F.lit(0.0))


def _since(c: str) -> Column:
    return F.greatest(F.coalesce(F.datediff("anchor_date", c), F.lit(NEVER)), F.lit(0))


def subscription_state(base: DataFrame, at: DataFrame, subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    """F11-F13, added to ``base`` (``at`` holds the anchors): last subscription started by the anchor, plan name, plan changes."""
    history = anchored(subscriptions.select(
        "customer_id", "subscription_id", "subscription_start_date", "plan_id", "subscription_status", "auto_renew",
        "monthly_price"), at, "subscription_start_date")
    state = F.struct(F.col("plan_id").alias("current_plan_id"),
                     F.col("subscription_status").alias("current_subscription_status"), F.col("auto_renew"),
                     F.col("monthly_price").cast("double").alias("current_monthly_price"))
    grouped = history.groupBy("customer_id").agg(
        F.max_by(state, F.struct("subscription_start_date", "subscription_id")).alias("_now"),
        (F.count(F.lit(1)) - 1).alias("plan_changes")).select("customer_id", "_now.*", "plan_changes")
    names = plans.select(F.col("plan_id").alias("current_plan_id"), F.col("plan_name").alias("current_plan"))
    known = attach(base, grouped, {"current_plan_id": "Unknown", "current_subscription_status": "Unknown",
                                   "auto_renew": False, "current_monthly_price": 0.0, "plan_changes": 0})
    return known.join(names, "current_plan_id", "left").withColumn(
        "current_plan", F.coalesce("current_plan", F.lit("Unknown")))


def viewing_features(base: DataFrame, at: DataFrame, viewing: DataFrame, content: DataFrame) -> DataFrame:
    """F14-F25. The distinct counts keep sets bounded by the calendar and by the number of devices and genres."""
    events = anchored(viewing.select("customer_id", "content_id", "viewing_date", "watch_duration_minutes",
                                     "completion_percentage", "device_type"), at, "viewing_date")
    events = events.join(content.select("content_id", "genre"), "content_id", "left")
    minutes = F.col("watch_duration_minutes")
    bins = (F.col(AGE) / 30).cast("int")  # 0 is the most recent of six 30-day bins
    grouped = events.groupBy("customer_id").agg(
        _mean(90, "watch_duration_minutes").alias("avg_watch_time_per_session"),
        _count(30).alias("sessions_30d"), _count(90).alias("sessions_90d"),
        F.sum(_within(30, minutes)).alias("watch_minutes_30d"),
        F.sum(_within(60, minutes, 30)).alias("watch_minutes_prev30d"),
        _mean(90, "completion_percentage").alias("avg_completion_90d"),
        F.size(F.collect_set(_within(90, F.col("viewing_date")))).alias("active_days_90d"),
        F.size(F.collect_set(_within(90, F.col("device_type")))).alias("device_diversity_90d"),
        F.size(F.collect_set(_within(90, F.col("genre")))).alias("genre_diversity_90d"),
        F.max("viewing_date").alias("last_view_date"),
        (F.count(F.lit(1)).cast("double") / F.size(F.collect_set(month("viewing_date")))).alias("login_frequency"),
        # least-squares slope over the six bins: the x values are fixed, so one weighted sum is the slope
        (F.sum(_within(180, minutes * (5 - 2 * bins))).cast("double") / 35).alias("monthly_watch_time_trend"))
    known = attach(base, grouped, {
        "avg_watch_time_per_session": 0.0, "sessions_30d": 0, "sessions_90d": 0, "watch_minutes_30d": 0,
        "watch_minutes_prev30d": 0, "avg_completion_90d": 0.0, "active_days_90d": 0, "device_diversity_90d": 0,
        "genre_diversity_90d": 0, "login_frequency": 0.0, "monthly_watch_time_trend": 0.0})
    now, before = F.col("watch_minutes_30d").cast("double"), F.col("watch_minutes_prev30d")
    change = F.coalesce(F.try_divide(now - before, before) * 100, F.lit(0.0))
    return known.withColumns({
        "watch_minutes_change_pct_30d": F.greatest(F.lit(-500.0), F.least(F.lit(500.0), change)),
        "days_since_last_activity": _since("last_view_date")})


def payment_features(base: DataFrame, at: DataFrame, payments: DataFrame) -> DataFrame:
    """F26-F30"""
    events = anchored(payments.select("customer_id", "payment_date", "amount", "payment_status"), at, "payment_date")
    failed, paid = F.col("payment_status") == "Failed", F.col("payment_status") == "Success"
    grouped = events.groupBy("customer_id").agg(
        _count(90).alias("payment_count_90d"), _count(90, failed).alias("failed_payment_count"),
        F.sum(F.when(paid, F.col("amount"))).cast("double").alias("customer_lifetime_value"),
        count_if(paid).alias("successful_payment_count"),
        F.max(F.when(failed, F.col("payment_date"))).alias("last_failed_payment_date"))
    known = attach(base, grouped, {"payment_count_90d": 0, "failed_payment_count": 0, "customer_lifetime_value": 0.0,
                                   "successful_payment_count": 0})
    return known.withColumns({
        "failed_payment_rate": _share("failed_payment_count", "payment_count_90d"),
        "days_since_last_failed_payment": _since("last_failed_payment_date")})


def support_features(base: DataFrame, at: DataFrame, tickets: DataFrame) -> DataFrame:
    """F31-F35. Open tickets without a score stay in the denominator of the low-CSAT rate."""
    events = anchored(tickets.select("customer_id", "ticket_date", "customer_satisfaction_score",
                                     "resolution_time_hours", "priority"), at, "ticket_date")
    grouped = events.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("support_ticket_count"), _count(90).alias("support_ticket_count_90d"),
        _mean(180, "customer_satisfaction_score").alias("avg_customer_satisfaction"),
        _mean(180, "resolution_time_hours").alias("avg_resolution_time_180d"),
        _count(180, F.col("customer_satisfaction_score") <= 2).alias("low_csat_tickets_180d"),
        _count(180).alias("_tickets_180d"),
        _count(90, F.col("priority").isin("High", "Critical")).alias("high_priority_tickets_90d"))
    known = attach(base, grouped, {
        "support_ticket_count": 0, "support_ticket_count_90d": 0, "avg_customer_satisfaction": 3.0,
        "avg_resolution_time_180d": 0.0, "low_csat_tickets_180d": 0, "high_priority_tickets_90d": 0})
    return known.withColumn("low_csat_ticket_rate_180d", _share("low_csat_tickets_180d", "_tickets_180d")).drop("_tickets_180d")


def feedback_features(base: DataFrame, at: DataFrame, feedback: DataFrame) -> DataFrame:
    """F36-F38"""
    events = anchored(feedback.select("customer_id", "feedback_date", "rating"), at, "feedback_date", 180)
    grouped = events.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("feedback_count_180d"), _mean(180, "rating").alias("avg_feedback_rating_180d"),
        count_if(F.col("rating") <= 2).alias("negative_feedback_count_180d"))
    known = attach(base, grouped, {"feedback_count_180d": 0, "avg_feedback_rating_180d": 3.0,
                                   "negative_feedback_count_180d": 0})
    return known.withColumn("negative_feedback_rate_180d", _share("negative_feedback_count_180d", "feedback_count_180d"))


def tenure(base: DataFrame) -> DataFrame:
    """F10"""
    return base.withColumn("customer_tenure_days", F.greatest(F.datediff("anchor_date", "registration_date"), F.lit(0)))


SCORED = ["days_since_last_activity", "sessions_90d", "avg_completion_90d", "monthly_watch_time_trend",
          "failed_payment_rate", "days_since_last_failed_payment", "support_ticket_count_90d",
          "low_csat_ticket_rate_180d", "avg_resolution_time_180d"]


def add_scores(table: DataFrame, **cutting) -> DataFrame:
    """Weighted average-rank percentiles, 0 to 100. All inputs are known for all customers, so the
    row count is common and the scores are exact fractions. ``table`` should be settled."""
    ranked = add_ranks(table.select("customer_id", *SCORED), "customer_id", SCORED, **cutting)
    full = 2 * F.col("sessions_90d_n")

    def r(c: str) -> Column:
        return twice_average_rank(c)

    engagement = (35 * (full - r("days_since_last_activity")) + 30 * r("sessions_90d")
                  + 20 * r("avg_completion_90d") + 15 * r("monthly_watch_time_trend"))
    billing = 70 * r("failed_payment_rate") + 30 * (full - r("days_since_last_failed_payment"))
    friction = (40 * r("support_ticket_count_90d") + 35 * r("low_csat_ticket_rate_180d")
                + 25 * r("avg_resolution_time_180d"))
    scores = ranked.select("customer_id", ratio_even(engagement, full).alias("engagement_score"),
                           ratio_even(billing, full).alias("billing_risk_score"),
                           ratio_even(friction, full).alias("support_friction_score"))
    return table.join(scores, "customer_id")


def finite(table: DataFrame) -> DataFrame:
    """infinities become NULL, churned becomes 0/1."""
    doubles = [f.name for f in table.schema.fields if f.dataType.typeName() == "double"]
    infinite = F.lit(float("inf"))
    cleaned = {c: F.when(F.abs(F.col(c)) != infinite, F.col(c)) for c in doubles}
    return table.withColumns(cleaned).withColumn("churned", F.col("churned").cast("int"))


def feature_columns(tables: Mapping[str, DataFrame], end: Column | None = None) -> DataFrame:
    """All features but the scores, lazily: unused groups are pruned by Spark."""
    t = tables
    if end is None:
        end = as_literal(data_end(t["viewing_activity"], t["payments"], t["support_tickets"], t["customer_feedback"]))
    at = settle(anchors(t["churn_labels"], end), "anchors")  # one row per customer, joined to every fact
    table = tenure(t["customers"].join(at, "customer_id"))
    table = subscription_state(table, at, t["subscriptions"], t["subscription_plans"])
    table = viewing_features(table, at, t["viewing_activity"], t["content"])
    table = payment_features(table, at, t["payments"])
    table = support_features(table, at, t["support_tickets"])
    return feedback_features(table, at, t["customer_feedback"])


def customer_features(tables: Mapping[str, DataFrame], end: Column | None = None, **cutting) -> DataFrame:
    """The whole feature table."""
    return finite(add_scores(settle(feature_columns(tables, end), "feature-columns"), **cutting))
