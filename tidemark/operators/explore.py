"""The tables behind the dashboard charts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expr import count_if, pct, ratio
from tidemark.functions.ordering import percentiles_of_counts
from tidemark.session import settle

GRID = ["customer_id", "country", "current_plan", "customer_segment", "engagement_score", "failed_payment_rate",
        "avg_customer_satisfaction", "customer_lifetime_value", "churned"]


def kpis(features: DataFrame, payments: DataFrame, scores: DataFrame, tickets: DataFrame) -> DataFrame:
    """Five one-row aggregates side by side."""
    revenue = payments.agg(F.coalesce(F.sum(F.when(F.col("payment_status") == "Success", F.col("amount"))), F.lit(0)))
    risky = scores.agg(count_if(F.col("risk_band").isin("High", "Critical")))
    csat = tickets.agg(ratio(F.sum("customer_satisfaction_score"), F.count("customer_satisfaction_score")))
    return features.agg(F.count(F.lit(1)).alias("customers"), pct(F.sum("churned"), F.count(F.lit(1)), 1).alias("churn_pct")).select(
        "customers", "churn_pct", revenue.scalar().alias("successful_revenue"), risky.scalar().alias("high_risk_customers"),
        csat.scalar().alias("avg_csat"))


def churn_by(features: DataFrame, group: str, k: int | None = None) -> DataFrame:
    """Churn share per group, highest first."""
    rates = features.groupBy(group).agg(F.count(F.lit(1)).alias("customers"),
                                        pct(F.sum(F.col("churned").cast("int")), F.count(F.lit(1)), 6).alias("churn_pct"))
    ordered = rates.orderBy(F.desc("churn_pct"), group)
    return ordered if k is None else ordered.limit(k)


def stable_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """N rows in hash order, the same whatever the partitioning."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}")).cast("binary")), key).limit(n)


def filtered(df: DataFrame, choices: Mapping[str, Sequence]) -> DataFrame:
    """An empty choice does not filter."""
    for column, values in choices.items():
        if values:
            df = df.where(F.col(column).isin(*values))
    return df


def options(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def customer_grid(features: DataFrame) -> DataFrame:
    """D05"""
    return features.select(*GRID)


def histogram(df: DataFrame, column: str, bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins over the observed range; the maximum falls in the last bin."""
    x = F.col(column).cast("double")
    edges = df.agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))  # one row
    width = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    number = F.coalesce(F.least(F.floor(F.try_divide(x - F.col("_lo"), width)), F.lit(bins - 1)), F.lit(0)).cast("int")
    known = df.where(F.col(column).isNotNull()).crossJoin(F.broadcast(edges))
    counted = known.groupBy(*by, number.alias("bin"), "_lo", width.alias("_w")).agg(F.count(F.lit(1)).alias("n"))
    low = F.round(F.col("_lo") + F.col("bin") * F.col("_w"), 6)
    return counted.select(*by, "bin", low.alias("bin_start"), "n").orderBy(*by, "bin")


def box_summary(df: DataFrame, group: str | Sequence[str], column: str, **cutting) -> DataFrame:
    """Quartiles, whiskers at 1.5 IQR and outliers per group of one or more levels. Only counts per distinct value are ordered."""
    groups = [group] if isinstance(group, str) else list(group)
    counted = settle(df.where(F.col(column).isNotNull()).groupBy(*groups, F.col(column).cast("double").alias("_v")).agg(
        F.count(F.lit(1)).alias("_c")), "box-counts")
    quartiles = percentiles_of_counts(counted, groups, "_v", {"q1": 0.25, "median": 0.5, "q3": 0.75}, **cutting)
    fences = quartiles.withColumns({"lower_fence": F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")),
                                    "upper_fence": F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))})
    named = fences.withColumnsRenamed({g: f"_g_{g}" for g in groups})
    same = F.lit(True)
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    joined = counted.join(named, same)
    inside = F.col("_v").between(F.col("lower_fence"), F.col("upper_fence"))
    stats = ["q1", "median", "q3", "lower_fence", "upper_fence"]
    return joined.groupBy(*groups, *stats).agg(
        F.min("_v").alias("minimum"), F.max("_v").alias("maximum"),
        F.min(F.when(inside, F.col("_v"))).alias("whisker_low"), F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("_c"))), F.lit(0)).alias("outliers"), F.sum("_c").alias("n")).select(
        *groups, *[F.round(c, 6).alias(c) for c in (*stats, "minimum", "maximum", "whisker_low", "whisker_high")],
        "outliers", "n")


def value_counts(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """D08"""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)
    return counts if n is None else counts.limit(n)


def shares(df: DataFrame, column: str) -> DataFrame:
    """D09"""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share_pct", pct("n", F.sum("n").over(Window.partitionBy()))).orderBy(F.desc("n"), column)


def recurring_revenue(features: DataFrame) -> DataFrame:
    """Prices are whole cents, so the sum is exact."""
    price = F.col("current_monthly_price").cast("decimal(12,2)")
    return features.groupBy("current_plan").agg(F.sum(price).alias("current_monthly_price")).orderBy("current_plan")


def cluster_sizes(segments: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """D15"""
    return segments.groupBy(cluster).agg(F.count(F.lit(1)).alias("customers")).orderBy(cluster)


def cluster_top(segments: DataFrame, features: DataFrame, k: int = 100, cluster: str = "cluster_id") -> DataFrame:
    """The k customers of every cluster with the highest lifetime value."""
    best = Window.partitionBy(cluster).orderBy(F.desc("customer_lifetime_value"), "customer_id")
    joined = segments.select("customer_id", cluster).join(
        features.select("customer_id", "customer_lifetime_value"), "customer_id")
    return joined.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
