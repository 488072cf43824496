"""What changed in a country between a month and the month before.

Every fact is first reduced to (customer, month) or (customer, day), then joined with the country, so a
country or a customer with most of the rows is spread before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expr import count_if, month, ratio


def _both_periods(monthly: DataFrame) -> DataFrame:
    """Each month's row once as its own 'current' and once as the next month's 'previous'."""
    places = F.array(F.struct(F.lit("current").alias("period"), F.col("_m").alias("month")),
                     F.struct(F.lit("previous").alias("period"), F.add_months("_m", 1).alias("month")))
    return monthly.withColumn("_p", F.explode(places)).select("*", "_p.period", "_p.month").drop("_p", "_m")


def _pick(df: DataFrame, country: str | None, at: str | None) -> DataFrame:
    if country is not None:
        df = df.where(F.col("country") == country)
    return df if at is None else df.where(F.col("month") == F.lit(at).cast("date"))


def _monthly(facts: DataFrame, day: str, customers: DataFrame, sums: Mapping[str, Column]) -> DataFrame:
    per_customer = facts.where(F.col(day).isNotNull()).groupBy("customer_id", month(day).alias("_m")).agg(
        *[c.alias(name) for name, c in sums.items()])
    joined = per_customer.join(customers.select("customer_id", "country"), "customer_id")
    return joined.groupBy("country", "_m").agg(F.count(F.lit(1)).alias("_customers"),
                                               *[F.sum(name).alias(name) for name in sums])


def churn_fact(churn_labels: DataFrame, customers: DataFrame, country: str | None = None, at: str | None = None) -> DataFrame:
    """R01"""
    rows = _monthly(churn_labels.where("churned"), "churn_date", customers, {"n": F.count(F.lit(1))})
    return _pick(_both_periods(rows), country, at).select("country", "month", "period", "n")


def engagement_fact(viewing: DataFrame, customers: DataFrame, country: str | None = None, at: str | None = None) -> DataFrame:
    """One row per viewer and month, so the viewers are counted, not de-duplicated again."""
    minutes = F.col("watch_duration_minutes")
    rows = _monthly(viewing, "viewing_date", customers, {"_s": F.sum(minutes), "_n": F.count(minutes)})
    return _pick(_both_periods(rows), country, at).select(
        "country", "month", "period", ratio("_s", "_n").alias("avg_watch_minutes"), F.col("_customers").alias("viewers"))


def payment_fact(payments: DataFrame, customers: DataFrame, country: str | None = None, at: str | None = None) -> DataFrame:
    """R03"""
    rows = _monthly(payments, "payment_date", customers,
                    {"payments": F.count(F.lit(1)), "_f": count_if(F.col("payment_status") == "Failed")})
    return _pick(_both_periods(rows), country, at).select(
        "country", "month", "period", ratio("_f", "payments", 4).alias("failed_payment_rate"), "payments")


def support_fact(tickets: DataFrame, customers: DataFrame, country: str | None = None, at: str | None = None) -> DataFrame:
    """R04"""
    csat = F.col("customer_satisfaction_score")
    rows = _monthly(tickets, "ticket_date", customers,
                    {"tickets": F.count(F.lit(1)), "_s": F.sum(csat), "_n": F.count(csat)})
    return _pick(_both_periods(rows), country, at).select(
        "country", "month", "period", "tickets", ratio("_s", "_n").alias("avg_csat"))


def plan_mix(subscriptions: DataFrame, customers: DataFrame, plans: DataFrame, at: str,
             country: str | None = None) -> DataFrame:
    """The latest subscription started before the end of the month."""
    end = F.add_months(F.lit(at).cast("date"), 1)
    newest = Window.partitionBy("customer_id").orderBy(F.desc("subscription_start_date"), F.desc("subscription_id"))
    known = subscriptions.where(F.col("subscription_start_date") < end).select(
        "customer_id", "plan_id", "subscription_start_date", "subscription_id")
    latest = known.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").select("customer_id", "plan_id")
    counted = latest.join(customers.select("customer_id", "country"), "customer_id").join(
        plans.select("plan_id", "plan_name"), "plan_id").groupBy("country", "plan_name").agg(F.count(F.lit(1)).alias("customers"))
    if country is not None:
        counted = counted.where(F.col("country") == country)
    return counted.orderBy("country", F.desc("customers"), "plan_name")


def plan_mix_by_month(subscriptions: DataFrame, customers: DataFrame, plans: DataFrame) -> DataFrame:
    """R05 for every month with a change, without a customer-by-month table: a customer's last plan of a
    month adds one there and takes one away in the month of the next."""
    last_of_month = subscriptions.groupBy("customer_id", month("subscription_start_date").alias("_m")).agg(
        F.max_by("plan_id", F.struct("subscription_start_date", "subscription_id")).alias("plan_id"))
    following = F.lead("_m").over(Window.partitionBy("customer_id").orderBy("_m"))
    spans = last_of_month.withColumn("_next", following).join(
        customers.select("customer_id", "country"), "customer_id")
    steps = spans.select("country", "plan_id", F.explode(F.array(
        F.struct(F.col("_m").alias("month"), F.lit(1).alias("d")),
        F.struct(F.col("_next").alias("month"), F.lit(-1).alias("d")))).alias("s")).where("s.month IS NOT NULL")
    moves = steps.groupBy("country", "plan_id", "s.month").agg(F.sum("s.d").alias("_d"))
    so_far = Window.partitionBy("country", "plan_id").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    return moves.join(plans.select("plan_id", "plan_name"), "plan_id").select(
        "country", "plan_name", "month", F.sum("_d").over(so_far).alias("customers"))


def fact_packs(tables: Mapping[str, DataFrame]) -> DataFrame:
    """All countries and months at once, one row per (country, month, fact)."""
    c = tables["customers"]

    def wide(df: DataFrame, values: Mapping[str, str]) -> DataFrame:
        long = df.select("country", "month", "period", F.explode(F.array(*[
            F.struct(F.lit(fact).alias("fact"), F.col(column).cast("double").alias("v"))
            for fact, column in values.items()])).alias("x")).select("country", "month", "period", "x.*")
        return long.groupBy("country", "month", "fact").agg(
            F.max(F.when(F.col("period") == "current", F.col("v"))).alias("current"),
            F.max(F.when(F.col("period") == "previous", F.col("v"))).alias("previous"))

    parts = [
        wide(churn_fact(tables["churn_labels"], c), {"churned": "n"}),
        wide(engagement_fact(tables["viewing_activity"], c), {"avg_watch_minutes": "avg_watch_minutes", "viewers": "viewers"}),
        wide(payment_fact(tables["payments"], c), {"failed_payment_rate": "failed_payment_rate", "payments": "payments"}),
        wide(support_fact(tables["support_tickets"], c), {"tickets": "tickets", "avg_csat": "avg_csat"})]
    packs = parts[0]
    for part in parts[1:]:
        packs = packs.unionByName(part)
    return packs


def packed(packs: DataFrame) -> DataFrame:
    """One nested record per (country, month): at most one entry per fact."""
    entry = F.struct("fact", "current", "previous")
    return packs.groupBy("country", "month").agg(F.sort_array(F.collect_list(entry)).alias("facts"))
