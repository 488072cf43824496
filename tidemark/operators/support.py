"""Tickets, satisfaction and feedback."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expr import mean, pct, quarter, ratio
from tidemark.functions.intervals import near


def _done():
    return F.col("ticket_status").isin("Resolved", "Closed")


def resolution_by_category(tickets: DataFrame) -> DataFrame:
    """Q09"""
    done = tickets.where(_done() & F.col("resolution_time_hours").isNotNull())
    return (done.groupBy("issue_category")
            .agg(mean("resolution_time_hours").alias("avg_resolution_hours"),
                 F.count(F.lit(1)).alias("resolved_tickets"))
            .orderBy(F.desc("avg_resolution_hours"), "issue_category"))


def csat_distribution(tickets: DataFrame) -> DataFrame:
    """Q10: the total is a window over the few score groups."""
    scored = tickets.where(_done() & F.col("customer_satisfaction_score").isNotNull())
    counts = scored.groupBy("customer_satisfaction_score").agg(F.count(F.lit(1)).alias("tickets"))
    everything = Window.partitionBy()
    return counts.withColumn("pct_of_resolved", pct("tickets", F.sum("tickets").over(everything))).orderBy(
        "customer_satisfaction_score")


def rating_by_sentiment(feedback: DataFrame) -> DataFrame:
    """Q12"""
    return (feedback.groupBy("sentiment_label")
            .agg(mean("rating").alias("avg_rating"), F.count(F.lit(1)).alias("feedback_count"))
            .orderBy(F.desc("avg_rating"), "sentiment_label"))


def frequent_contacts(customers: DataFrame, tickets: DataFrame, minimum: int = 3) -> DataFrame:
    """Q15: counted per customer before the join."""
    counts = tickets.groupBy("customer_id").agg(F.count("ticket_id").alias("ticket_count")).where(
        F.col("ticket_count") > minimum)
    names = [c for c in ("customer_id", "first_name", "last_name") if c in customers.columns]
    return customers.select(*names).join(counts, "customer_id").orderBy(F.desc("ticket_count"), "customer_id")


def latest_tickets(tickets: DataFrame) -> DataFrame:
    """Q17"""
    newest = Window.partitionBy("customer_id").orderBy(F.desc_nulls_last("ticket_date"), F.desc("ticket_id"))
    return tickets.withColumn("rn", F.row_number().over(newest)).where("rn = 1")


def _by_country(tickets: DataFrame, customers: DataFrame, **sums) -> DataFrame:
    """Sums per (country, subcategory), reduced per customer before the country is joined."""
    keys = ["customer_id", "issue_subcategory"]
    per_customer = tickets.groupBy(*keys).agg(*[c.alias(name) for name, c in sums.items()])
    return (per_customer.join(customers.select("customer_id", "country"), "customer_id")
            .groupBy("country", "issue_subcategory").agg(*[F.sum(name).alias(name) for name in sums]))


def _top_in_country(counted: DataFrame, k: int, rank: str) -> DataFrame:
    order = Window.partitionBy("country").orderBy(F.desc("ticket_volume"), "issue_subcategory")
    return counted.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= k).orderBy("country", rank)


def top_subcategories(tickets: DataFrame, customers: DataFrame, k: int = 3) -> DataFrame:
    """Q27"""
    return _top_in_country(_by_country(tickets, customers, ticket_volume=F.count(F.lit(1))), k, "country_rank")


def quarter_complaints(tickets: DataFrame, customers: DataFrame, k: int = 5) -> DataFrame:
    """Q32: the quarter before the quarter of the last ticket."""
    current = tickets.agg(quarter(F.max("ticket_date"))).scalar()
    past = tickets.where((F.col("ticket_date") >= F.add_months(current, -3)) & (F.col("ticket_date") < current))
    hours, csat = F.col("resolution_time_hours"), F.col("customer_satisfaction_score")
    counted = _by_country(past, customers, ticket_volume=F.count(F.lit(1)), _h=F.sum(hours), _hn=F.count(hours),
                          _c=F.sum(csat), _cn=F.count(csat))
    return _top_in_country(counted, k, "rn").select(
        "country", "issue_subcategory", "ticket_volume", ratio("_h", "_hn").alias("avg_resolution_hours"),
        ratio("_c", "_cn").alias("avg_csat"), "rn")


def negative_near_trouble(feedback: DataFrame, payments: DataFrame, tickets: DataFrame, days: int = 14) -> DataFrame:
    """Q36: low ratings within some days, before or after, of a failed payment or a low-CSAT ticket."""
    low = feedback.where(F.col("rating") <= 2)
    failed = payments.where(F.col("payment_status") == "Failed").select(
        "customer_id", F.col("payment_date").alias("trouble_date"))
    unhappy = tickets.where(F.col("customer_satisfaction_score") <= 2).select(
        "customer_id", F.col("ticket_date").alias("trouble_date"))
    # either cause qualifies, so the two sets of days merge into one and one ordered pass decides
    hits = near(low, failed.unionByName(unhappy), "customer_id", "feedback_date", "trouble_date", days)
    return hits.select("customer_id", "feedback_id", "feedback_date", "rating", "feedback_text").distinct().orderBy(
        F.desc("feedback_date"), "feedback_id")
