"""What is watched, on what, and how that changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expr import month, pct, ratio, week


def top_titles(viewing: DataFrame, content: DataFrame, k: int = 10) -> DataFrame:
    """Q06"""
    minutes = viewing.groupBy("content_id").agg(F.sum("watch_duration_minutes").alias("total_watch_minutes"))
    return (minutes.join(content.select("content_id", "title"), "content_id")
            .select("content_id", "title", "total_watch_minutes")
            .orderBy(F.desc("total_watch_minutes"), "content_id").limit(k))


def completion_by_genre(viewing: DataFrame, content: DataFrame) -> DataFrame:
    """Q07: summed per title before the join, so a hit title is one row in the shuffle."""
    per_title = viewing.groupBy("content_id").agg(
        F.sum("completion_percentage").alias("_sum"), F.count("completion_percentage").alias("_known"),
        F.count(F.lit(1)).alias("_n"))
    return (per_title.join(content.select("content_id", "content_type", "genre"), "content_id")
            .groupBy("content_type", "genre")
            .agg(ratio(F.sum("_sum"), F.sum("_known")).alias("avg_completion_pct"), F.sum("_n").alias("sessions"))
            .orderBy("content_type", F.desc("avg_completion_pct"), "genre"))


def minutes_by_device(viewing: DataFrame) -> DataFrame:
    """Q11"""
    return (viewing.groupBy("device_type")
            .agg(F.sum("watch_duration_minutes").alias("total_viewing_minutes"), F.count(F.lit(1)).alias("sessions"))
            .orderBy(F.desc("total_viewing_minutes"), "device_type"))


def _monthly_minutes(viewing: DataFrame) -> DataFrame:
    return viewing.groupBy("customer_id", month("viewing_date").alias("month")).agg(
        F.sum("watch_duration_minutes").alias("watch_minutes"))


def latest_month_declines(viewing: DataFrame) -> DataFrame:
    """Q19: the prior month is the prior observed one."""
    by_month = Window.partitionBy("customer_id").orderBy("month")
    newest = Window.partitionBy("customer_id").orderBy(F.desc("month"))
    monthly = _monthly_minutes(viewing).withColumn("prior_month_watch", F.lag("watch_minutes").over(by_month))
    return (monthly.withColumn("_rn", F.row_number().over(newest))
            .where((F.col("_rn") == 1) & (F.col("watch_minutes") < F.col("prior_month_watch")))
            .select("customer_id", "month", "watch_minutes", "prior_month_watch",
                    F.lit(True).alias("mom_decline_flag"))
            .orderBy("customer_id"))


def three_month_declines(viewing: DataFrame) -> DataFrame:
    """Q23"""
    by_month = Window.partitionBy("customer_id").orderBy("month")
    stepped = _monthly_minutes(viewing).select(
        "customer_id", "month", F.col("watch_minutes").alias("month_n"),
        F.lag("watch_minutes", 1).over(by_month).alias("month_n_minus_1"),
        F.lag("watch_minutes", 2).over(by_month).alias("month_n_minus_2"))
    return stepped.where((F.col("month_n") < F.col("month_n_minus_1"))
                         & (F.col("month_n_minus_1") < F.col("month_n_minus_2"))).orderBy("customer_id", "month")


def stickiness(viewing: DataFrame, months: int = 6) -> DataFrame:
    """Q35: a week that spans two months counts in both, as two fragments."""
    last = viewing.agg(month(F.max("viewing_date"))).scalar()
    recent = viewing.where(F.col("viewing_date") >= F.add_months(last, 1 - months))
    seen = recent.select("customer_id", week("viewing_date").alias("_week"),
                         month("viewing_date").alias("month")).distinct()
    weekly = seen.groupBy("_week", "month").agg(F.count(F.lit(1)).alias("_wau"))
    wau = weekly.groupBy("month").agg(F.sum("_wau").alias("_sum"), F.count(F.lit(1)).alias("_weeks"))
    mau = seen.select("customer_id", "month").distinct().groupBy("month").agg(F.count(F.lit(1)).alias("mau"))
    return mau.join(wau, "month").select(
        "month", ratio("_sum", "_weeks").alias("avg_wau"), "mau",
        pct("_sum", F.col("_weeks") * F.col("mau")).alias("wau_mau_stickiness_pct")).orderBy("month")


def monthly_minutes(viewing: DataFrame) -> DataFrame:
    """D12"""
    return (viewing.groupBy(F.date_format("viewing_date", "yyyy-MM").alias("month"))
            .agg(F.sum("watch_duration_minutes").alias("watch_duration_minutes")).orderBy("month"))


def minutes_by_genre(viewing: DataFrame, content: DataFrame) -> DataFrame:
    """D13"""
    per_title = viewing.groupBy("content_id").agg(F.sum("watch_duration_minutes").alias("_m"))
    return (per_title.join(content.select("content_id", "genre"), "content_id").groupBy("genre")
            .agg(F.sum("_m").alias("watch_duration_minutes"))
            .orderBy(F.desc("watch_duration_minutes"), "genre"))
