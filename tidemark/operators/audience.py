"""Who the customers are, who stays and who leaves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expr import count_if, flag, mean, month, pct, ratio
from tidemark.plans.views import current_subscription


def active_by_country(customers: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Q01"""
    active = subscriptions.where(F.col("subscription_status") == "Active").select("customer_id").distinct()
    return (customers.join(active, "customer_id", "left_semi")
            .groupBy("country").agg(F.count(F.lit(1)).alias("active_customers"))
            .orderBy(F.desc("active_customers"), "country"))


def churn_rate(churn_labels: DataFrame) -> DataFrame:
    """Q03"""
    return churn_labels.agg(
        F.count(F.lit(1)).alias("customers"),
        count_if(F.col("churned")).alias("churned_customers"),
        pct(count_if(F.col("churned")), F.count(F.lit(1))).alias("churn_rate_pct"))


def channel_churn(customers: DataFrame, churn_labels: DataFrame) -> DataFrame:
    """Q04"""
    return (customers.join(churn_labels, "customer_id").groupBy("acquisition_channel")
            .agg(F.count(F.lit(1)).alias("customers"),
                 pct(count_if(F.col("churned")), F.count(F.lit(1))).alias("churn_rate_pct"))
            .orderBy(F.desc("customers"), "acquisition_channel"))


def age_by_plan(subscriptions: DataFrame, customers: DataFrame, plans: DataFrame) -> DataFrame:
    """Q05"""
    latest = current_subscription(subscriptions.select(
        "customer_id", "plan_id", "subscription_start_date", "subscription_id"))
    return (latest.join(customers, "customer_id").join(plans, "plan_id")
            .groupBy("plan_name").agg(mean("age").alias("avg_customer_age"))
            .orderBy("avg_customer_age", "plan_name"))


def signups_by_year(customers: DataFrame) -> DataFrame:
    """Q13"""
    return (customers.groupBy(F.year("registration_date").alias("registration_year"), "acquisition_channel")
            .agg(F.count(F.lit(1)).alias("signups"))
            .orderBy("registration_year", F.desc("signups"), "acquisition_channel"))


def registrations_moving_average(customers: DataFrame, window: int = 3) -> DataFrame:
    """Q18: the frame counts observed months, so a calendar gap does not break it."""
    monthly = customers.groupBy(month("registration_date").alias("month")).agg(
        F.count(F.lit(1)).alias("registrations"))
    frame = Window.orderBy("month").rowsBetween(1 - window, 0)  # one row per month: small
    return monthly.select("month", "registrations", ratio(
        F.sum("registrations").over(frame), F.count("registrations").over(frame)).alias("registrations_3m_ma")
    ).orderBy("month")


def cohort_retention(customers: DataFrame, subscriptions: DataFrame, months: Sequence[int] = (1, 3, 6)) -> DataFrame:
    """Q20: a customer is retained at month k if any subscription covers that day, end day included."""
    base = customers.select("customer_id", "registration_date")
    ends = F.coalesce("subscription_end_date", "cancellation_date", F.lit("9999-12-31").cast("date"))
    spans = subscriptions.select("customer_id", F.col("subscription_start_date").alias("_from"), ends.alias("_to"))

    def covered(k: int):
        day = F.add_months("registration_date", k)
        return flag((F.col("_from") <= day) & (F.col("_to") >= day))

    # An inner join, so a customer with very many subscriptions can be split; then one row per customer is attached.
    flags = base.join(spans, "customer_id").groupBy("customer_id").agg(*[F.max(covered(k)).alias(f"r{k}") for k in months])
    per_customer = base.join(flags, "customer_id", "left")
    return (per_customer.groupBy(month("registration_date").alias("cohort_month"))
            .agg(F.count(F.lit(1)).alias("cohort_size"),
                 *[pct(F.sum(f"r{k}"), F.count(F.lit(1))).alias(f"retention_{k}m_pct") for k in months])
            .orderBy("cohort_month"))


def top_churn_countries(customers: DataFrame, churn_labels: DataFrame, k: int = 5) -> DataFrame:
    """Q21: ranked on the exact rate, so ties can give more than k rows."""
    by_country = customers.join(churn_labels, "customer_id").groupBy("country").agg(
        F.count(F.lit(1)).alias("total_customers"), count_if(F.col("churned")).alias("churned_customers"))
    rate = F.col("churned_customers") / F.col("total_customers")
    ranked = by_country.withColumn("churn_rank", F.dense_rank().over(Window.orderBy(rate.desc())))
    return (ranked.where(F.col("churn_rank") <= k)
            .select("country", "total_customers", "churned_customers",
                    pct("churned_customers", "total_customers").alias("churn_rate_pct"), "churn_rank")
            .orderBy("churn_rank", "country"))


def monthly_churn(churn_labels: DataFrame, customers: DataFrame, months: int = 12) -> DataFrame:
    """Q24: customers are first counted per (registration month, churn month); only those counts,
    bounded by the calendar, meet the month spine."""
    counted = (customers.select("customer_id", "registration_date").join(churn_labels, "customer_id")
               .groupBy(month("registration_date").alias("_reg"), month("churn_date").alias("_churn"))
               .agg(F.count(F.lit(1)).alias("_n")))
    last = churn_labels.agg(month(F.max("churn_date")).alias("_last"))
    spine = last.select(F.explode(F.sequence(
        F.add_months("_last", 1 - months), F.col("_last"), F.expr("interval 1 month"))).alias("month_start"))
    active = (F.col("_reg") < F.col("month_start")) & (
        F.col("_churn").isNull() | (F.col("_churn") >= F.col("month_start")))
    left_now = F.col("_churn") == F.col("month_start")
    zero = F.lit(0)
    return (counted.crossJoin(F.broadcast(spine))  # a fixed number of months
            .groupBy("month_start")
            .agg(F.sum(F.when(active, F.col("_n")).otherwise(zero)).alias("active_at_start"),
                 F.sum(F.when(left_now, F.col("_n")).otherwise(zero)).alias("churned_in_month"))
            .select("month_start", "active_at_start", "churned_in_month",
                    pct("churned_in_month", "active_at_start").alias("churn_rate_pct"))
            .orderBy("month_start"))


def channel_retention(customers: DataFrame, churn_labels: DataFrame) -> DataFrame:
    """Q25"""
    kept = count_if(~F.col("churned"))
    return (customers.join(churn_labels, "customer_id").groupBy("acquisition_channel")
            .agg(F.count(F.lit(1)).alias("acquired_customers"), kept.alias("retained_customers"),
                 pct(kept, F.count("churned")).alias("retention_rate_pct"))
            .orderBy(F.desc("retention_rate_pct"), "acquisition_channel"))
