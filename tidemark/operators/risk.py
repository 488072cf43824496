"""Customers at risk: scores over all customers and target lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.expr import count_if, ratio
from tidemark.functions.ordering import add_ranks, ntile, outranked
from tidemark.plans.views import current_subscription, customer_clv
from tidemark.session import settle


def _failures(payments: DataFrame) -> DataFrame:
    return payments.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("_payments"), count_if(F.col("payment_status") == "Failed").alias("_failed"))


def _last_views(viewing: DataFrame) -> DataFrame:
    return viewing.groupBy("customer_id").agg(F.max("viewing_date").alias("_last_view"))


def payment_risk(payments: DataFrame, customers: DataFrame, viewing: DataFrame, tickets: DataFrame,
                 subscriptions: DataFrame, plans: DataFrame, days: int = 90, idle_days: int = 30) -> DataFrame:
    """Q28: two or more recent failures, and idle or with two or more recent tickets."""
    last = payments.agg(F.max("payment_date")).scalar()
    since = F.date_sub(last, days)
    failed = payments.where((F.col("payment_status") == "Failed") & (F.col("payment_date") > since)).groupBy(
        "customer_id").agg(F.count(F.lit(1)).alias("failed_payment_count")).where("failed_payment_count >= 2")
    recent = tickets.where(F.col("ticket_date") > since).groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("recent_tickets"))
    latest = current_subscription(subscriptions.select(
        "customer_id", "plan_id", "subscription_start_date", "subscription_id")).select("customer_id", "plan_id")
    joined = (failed.join(customers.select("customer_id"), "customer_id")
              .join(_last_views(viewing), "customer_id", "left").join(recent, "customer_id", "left")
              .join(latest, "customer_id").join(plans.select("plan_id", "plan_name"), "plan_id"))
    never = F.lit("1900-01-01").cast("date")
    rows = joined.select(
        "customer_id", "failed_payment_count", F.col("plan_name").alias("current_plan"),
        F.datediff(last, F.coalesce("_last_view", never)).alias("days_since_last_activity"),
        F.coalesce("recent_tickets", F.lit(0)).cast("bigint").alias("recent_tickets"))
    return rows.where((F.col("days_since_last_activity") > idle_days) | (F.col("recent_tickets") >= 2)).orderBy(
        F.desc("failed_payment_count"), F.desc("days_since_last_activity"), "customer_id")


def country_profile(customers: DataFrame, churn_labels: DataFrame, payments: DataFrame) -> DataFrame:
    """Q30: one pass to (country, churned, reason) cells; statistics and the modal reason come from them."""
    base = customers.select("customer_id", "country").join(churn_labels, "customer_id").join(
        customer_clv(customers, payments), "customer_id")
    cells = base.groupBy("country", "churned", "churn_reason").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("customer_lifetime_value").alias("_clv"))
    gone = F.col("churned")
    reason = F.struct(-F.col("_n"), F.col("churn_reason").isNull(), F.col("churn_reason"))
    per_country = cells.groupBy("country").agg(
        F.sum("_n").alias("total_customers"),
        F.sum(F.when(gone, F.col("_n")).otherwise(F.lit(0))).alias("churned_customers"),
        F.sum(F.when(gone, F.col("_clv"))).alias("_clv"),
        F.min(F.when(gone, reason)).getField("churn_reason").alias("top_churn_reason"))
    return per_country.select(
        "country", "total_customers", "churned_customers",
        ratio(100 * F.col("churned_customers"), "total_customers").alias("churn_rate_pct"),
        ratio("_clv", "churned_customers").alias("avg_clv_churned"), "top_churn_reason"
    ).orderBy(F.desc("churn_rate_pct"), "country")


def at_risk_revenue(customers: DataFrame, subscriptions: DataFrame, viewing: DataFrame, payments: DataFrame,
                    tickets: DataFrame, k: int = 50, **cutting) -> DataFrame:
    """Q31: percent ranks over customers whose latest subscription is active; each fact is reduced
    to one row per customer before it is joined."""
    last = F.greatest(viewing.agg(F.max("viewing_date")).scalar(), payments.agg(F.max("payment_date")).scalar())
    latest = current_subscription(subscriptions.select(
        "customer_id", "subscription_status", "monthly_price", "subscription_start_date", "subscription_id"))
    opened = tickets.groupBy("customer_id").agg(F.count("ticket_id").alias("_tickets"))
    raw = (latest.where(F.col("subscription_status") == "Active").select("customer_id", "monthly_price")
           .join(customers.select("customer_id"), "customer_id", "left_semi")
           .join(_last_views(viewing), "customer_id", "left").join(_failures(payments), "customer_id", "left")
           .join(opened, "customer_id", "left"))
    raw = settle(raw.select(
        "customer_id", "monthly_price", F.coalesce(F.datediff(last, "_last_view"), F.lit(999)).alias("recency_days"),
        F.coalesce(F.col("_failed") / F.col("_payments"), F.lit(0.0)).alias("failed_rate"),
        F.coalesce("_tickets", F.lit(0)).cast("bigint").alias("ticket_count")), "at-risk")
    ranked = add_ranks(raw, "customer_id", ["recency_days", "failed_rate", "ticket_count"], **cutting)
    points = (45 * outranked("recency_days") + 35 * outranked("failed_rate") + 20 * outranked("ticket_count"))
    others = F.greatest(F.col("recency_days_n") - 1, F.lit(1))
    return ranked.select(
        "customer_id", "monthly_price", "recency_days", F.round("failed_rate", 6).alias("failed_rate"), "ticket_count",
        ratio(points, others).alias("sql_churn_risk_score"),
        ratio(F.col("monthly_price") * points, 100 * others).alias("at_risk_revenue"),
    ).orderBy(F.desc("at_risk_revenue"), "customer_id").limit(k)


def win_back(customers: DataFrame, payments: DataFrame, churn_labels: DataFrame, viewing: DataFrame,
             days: int = 30, **cutting) -> DataFrame:
    """Q33: churned customers of the top spend quartile with their last watch minutes."""
    clv = settle(customer_clv(customers, payments).withColumnRenamed("customer_lifetime_value", "clv"), "clv")
    top = ntile(clv, 4, ["clv", "customer_id"], "_q", **cutting).where("_q = 4")
    gone = churn_labels.where("churned").select("customer_id", "churn_date", "churn_reason")
    targets = top.join(gone, "customer_id").select("customer_id", "clv", "churn_date", "churn_reason")
    near_end = F.datediff("churn_date", "viewing_date").between(0, days)
    minutes = F.coalesce(F.sum(F.when(near_end, F.col("watch_duration_minutes"))), F.lit(0)).cast("bigint")
    views = viewing.groupBy("customer_id", "viewing_date").agg(F.sum("watch_duration_minutes").alias("watch_duration_minutes"))
    joined = targets.join(views, "customer_id", "left").groupBy("customer_id", "clv", "churn_reason").agg(
        minutes.alias("last30_watch_minutes"))
    watched = F.col("last30_watch_minutes")
    level = F.when(watched >= 600, "High").when(watched >= 180, "Medium").otherwise("Low")
    return joined.withColumn("last_engagement_level", level).orderBy(F.desc("clv"), "customer_id")


def health_scores(customers: DataFrame, subscriptions: DataFrame, plans: DataFrame, viewing: DataFrame,
                  payments: DataFrame, tickets: DataFrame, **cutting) -> DataFrame:
    """Q37: satisfaction and tenure are ranked from high to low."""
    last = viewing.agg(F.max("viewing_date")).scalar()
    latest = current_subscription(subscriptions.select(
        "customer_id", "plan_id", "subscription_start_date", "subscription_id")).select("customer_id", "plan_id")
    csat = tickets.groupBy("customer_id").agg(
        F.sum("customer_satisfaction_score").alias("_cs"), F.count("customer_satisfaction_score").alias("_cn"))
    raw = (customers.select("customer_id", "registration_date").join(latest, "customer_id")
           .join(plans.select("plan_id", "plan_name"), "plan_id")
           .join(_last_views(viewing), "customer_id", "left").join(_failures(payments), "customer_id", "left")
           .join(csat, "customer_id", "left"))
    raw = settle(raw.select(
        "customer_id", "plan_name", F.coalesce(F.datediff(last, "_last_view"), F.lit(999)).alias("recency_days"),
        F.coalesce(F.col("_failed") / F.col("_payments"), F.lit(0.0)).alias("_rate"),
        F.coalesce(F.try_divide("_cs", "_cn"), F.lit(3.0)).alias("_csat"),
        F.datediff(last, "registration_date").alias("tenure_days"),
        "_failed", "_payments", "_cs", "_cn"), "health")
    ranked = add_ranks(raw, "customer_id", ["recency_days", "_rate", "_csat", "tenure_days"], **cutting)
    points = (35 * outranked("recency_days") + 30 * outranked("_rate") + 20 * outranked("_csat", True)
              + 15 * outranked("tenure_days", True))
    return ranked.select(
        "customer_id", "plan_name", "recency_days",
        F.coalesce(ratio("_failed", "_payments", 3), F.lit(0.0)).alias("failed_payment_rate"),
        F.coalesce(ratio("_cs", "_cn"), F.lit(3.0)).alias("avg_support_satisfaction"), "tenure_days",
        ratio(points, F.greatest(F.col("recency_days_n") - 1, F.lit(1))).alias("risk_score_0_100"),
    ).orderBy(F.desc("risk_score_0_100"), "customer_id")
