"""Period report: facts of the last 7, 30 and 90 days of the data, and their text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expr import as_literal, latest_day, ratio

PERIODS = {"weekly": 7, "monthly": 30, "quarterly": 90}


def report_anchor(payments: DataFrame, viewing: DataFrame, churn_labels: DataFrame) -> DataFrame:
    """One row."""
    return latest_day((payments, "payment_date"), (viewing, "viewing_date"), (churn_labels, "churn_date"))


def _per_period(df: DataFrame, day: str, anchor: Column, periods: Mapping[str, int], **parts: tuple) -> DataFrame:
    """Aggregates of every period in one pass. ``parts`` maps a name to (aggregate function, column)."""
    longest = max(periods.values())
    recent = df.where(F.col(day) > F.date_sub(anchor, longest)).withColumn("_age", F.datediff(anchor, day))
    wide = recent.agg(*[
        aggregate(F.when(F.col("_age") < days, value)).alias(f"{period}_{name}")
        for period, days in periods.items() for name, (aggregate, value) in parts.items()])
    rows = [F.struct(F.lit(period).alias("period"), *[F.col(f"{period}_{name}").alias(name) for name in parts])
            for period in periods]
    return wide.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def revenue(payments: DataFrame, anchor: Column, periods: Mapping[str, int] = PERIODS) -> DataFrame:
    """R08"""
    paid = payments.where(F.col("payment_status") == "Success")
    return _per_period(paid, "payment_date", anchor, periods, _v=(F.sum, F.col("amount"))).select(
        "period", F.coalesce("_v", F.lit(0)).alias("revenue"))


def churned(churn_labels: DataFrame, anchor: Column, periods: Mapping[str, int] = PERIODS) -> DataFrame:
    """R09"""
    return _per_period(churn_labels.where("churned"), "churn_date", anchor, periods,
                       churned_customers=(F.count, F.lit(1)))


def new_customers(customers: DataFrame, anchor: Column, periods: Mapping[str, int] = PERIODS) -> DataFrame:
    """R10"""
    return _per_period(customers, "registration_date", anchor, periods, new_customers=(F.count, F.lit(1)))


def active_viewers(viewing: DataFrame, anchor: Column, periods: Mapping[str, int] = PERIODS) -> DataFrame:
    """A customer is active in a period when the last view is; one row per customer."""
    last = viewing.groupBy("customer_id").agg(F.max("viewing_date").alias("_last"))
    return _per_period(last, "_last", anchor, periods, active_viewers=(F.count, F.lit(1)))


def csat(tickets: DataFrame, anchor: Column, periods: Mapping[str, int] = PERIODS) -> DataFrame:
    """NULL without scores."""
    score = F.col("customer_satisfaction_score")
    return _per_period(tickets, "ticket_date", anchor, periods, _s=(F.sum, score), _n=(F.count, score)).select(
        "period", ratio("_s", "_n").alias("avg_csat"))


def top_complaints(tickets: DataFrame, anchor: Column, periods: Mapping[str, int] = PERIODS, k: int = 5) -> DataFrame:
    """R13"""
    longest = max(periods.values())
    age = F.datediff(anchor, "ticket_date")
    counts = tickets.where(F.col("ticket_date") > F.date_sub(anchor, longest)).groupBy("issue_subcategory").agg(
        *[F.sum(F.when(age < days, 1).otherwise(0)).alias(period) for period, days in periods.items()])
    long = counts.select("issue_subcategory", F.explode(F.array(*[
        F.struct(F.lit(p).alias("period"), F.col(p).alias("n")) for p in periods])).alias("x")).select(
        "issue_subcategory", "x.*").where("n > 0")
    best = Window.partitionBy("period").orderBy(F.desc("n"), "issue_subcategory")
    return long.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def report_facts(tables: Mapping[str, DataFrame], periods: Mapping[str, int] = PERIODS) -> DataFrame:
    """One row per period."""
    anchor = as_literal(report_anchor(tables["payments"], tables["viewing_activity"], tables["churn_labels"]))
    complaints = top_complaints(tables["support_tickets"], anchor, periods).groupBy("period").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "issue_subcategory", "n"))),  # k entries
                    lambda c: F.struct(c.issue_subcategory.alias("issue_subcategory"), c.n.alias("n"))).alias("top_complaints"))
    parts = [churned(tables["churn_labels"], anchor, periods), new_customers(tables["customers"], anchor, periods),
             active_viewers(tables["viewing_activity"], anchor, periods), csat(tables["support_tickets"], anchor, periods)]
    facts = revenue(tables["payments"], anchor, periods)
    for part in parts:
        facts = facts.join(part, "period")
    days = F.create_map(*[F.lit(x) for item in periods.items() for x in item])
    return facts.join(complaints, "period", "left").withColumns(
        {"period_days": days[F.col("period")], "anchor_date": anchor})


def render(facts: DataFrame) -> DataFrame:
    """The report text, from the facts only."""
    complaints = F.array_join(F.transform(F.coalesce("top_complaints", F.array()), lambda c: F.concat(
        c.issue_subcategory, F.lit(" ("), c.n.cast("string"), F.lit(")"))), ", ")

    def shown(c) -> Column:
        return F.coalesce(c.cast("string"), F.lit("None"))

    lines = [F.concat(F.lit("# "), F.initcap("period"), F.lit(" subscription report")), F.lit(""),
             F.concat(F.lit("- Period ending: "), shown(F.col("anchor_date"))),
             F.concat(F.lit("- Revenue from successful payments: $"), F.format_number("revenue", 2)),
             F.concat(F.lit("- Churned customers: "), shown(F.col("churned_customers"))),
             F.concat(F.lit("- New customers: "), shown(F.col("new_customers"))),
             F.concat(F.lit("- Active viewers: "), shown(F.col("active_viewers"))),
             F.concat(F.lit("- Average CSAT: "), F.coalesce(F.format_number("avg_csat", 2), F.lit("None"))),
             F.concat(F.lit("- Top complaints: "), complaints)]
    return facts.select("period", F.concat_ws("\n", *lines).alias("report"))
