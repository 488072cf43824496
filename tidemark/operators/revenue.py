"""Plans, prices, payments and lifetime spend."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.expr import count_if, flag, month, pct, ratio
from tidemark.functions.ordering import neighbour, ntile, running_sum
from tidemark.plans.views import current_subscription, customer_clv
from tidemark.session import settle


def active_revenue_by_plan(subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    """Q02: subscriptions are summed per plan id before the plan names are joined."""
    per_plan = (subscriptions.where(F.col("subscription_status") == "Active").groupBy("plan_id")
                .agg(F.count(F.lit(1)).alias("_n"), F.sum("monthly_price").alias("_sum"),
                     F.count("monthly_price").alias("_priced")))
    return (per_plan.join(plans.select("plan_id", "plan_name"), "plan_id").groupBy("plan_name")
            .agg(F.sum("_n").alias("active_subscriptions"), F.sum("_sum").alias("monthly_revenue"),
                 ratio(F.sum("_sum"), F.sum("_priced"), 6).alias("avg_monthly_revenue_per_subscription"))
            .orderBy(F.desc("monthly_revenue"), "plan_name"))


def failed_payments_by_month(payments: DataFrame, months: int | None = 12) -> DataFrame:
    """Q08: the last months of the data; D14 with ``months=None`` takes the full history."""
    failed = payments.where(F.col("payment_status") == "Failed")
    if months is not None:
        last = payments.agg(month(F.max("payment_date"))).scalar()
        failed = failed.where(F.col("payment_date") >= F.add_months(last, 1 - months))
    return (failed.groupBy(month("payment_date").alias("month"))
            .agg(F.count(F.lit(1)).alias("failed_payments")).orderBy("month"))


def auto_renew_off(subscriptions: DataFrame) -> DataFrame:
    """Q14: an unknown flag counts as not off."""
    latest = current_subscription(subscriptions.select(
        "customer_id", "auto_renew", "subscription_start_date", "subscription_id"))
    off = count_if(~F.col("auto_renew"))
    return latest.agg(F.count(F.lit(1)).alias("customers"), off.alias("auto_renew_off"),
                      pct(off, F.count(F.lit(1))).alias("auto_renew_off_pct"))


def plan_revenue_rank(subscriptions: DataFrame, plans: DataFrame) -> DataFrame:
    """Q16"""
    revenue = active_revenue_by_plan(subscriptions, plans).select(
        "plan_name", F.col("monthly_revenue").alias("total_revenue"))
    return revenue.withColumn("revenue_rank", F.rank().over(Window.orderBy(F.desc("total_revenue")))).orderBy(
        "revenue_rank", "plan_name")


def running_spend(payments: DataFrame, ordered: bool = False, **cutting) -> DataFrame:
    """Q22: every payment with the customer's successful spend so far.

    A customer with a large share of all payments is cut into date ranges. ``ordered`` adds the global
    sort, which at payment grain costs a second full shuffle.
    """
    paid = F.when(F.col("payment_status") == "Success", F.col("amount")).otherwise(F.lit(0))
    kept = payments.select("customer_id", "payment_id", "payment_date", "amount", "payment_status")
    result = running_sum(kept, ["customer_id"], ["payment_date", "payment_id"],
                         {"running_successful_spend": paid}, **cutting)
    return result.orderBy("customer_id", "payment_date", "payment_id") if ordered else result


def spend_quartiles(customers: DataFrame, payments: DataFrame, n: int = 4, **cutting) -> DataFrame:
    """Q26"""
    clv = settle(customer_clv(customers, payments).select(
        "customer_id", F.col("customer_lifetime_value").alias("lifetime_spend")), "lifetime-spend")
    return ntile(clv, n, ["lifetime_spend", "customer_id"], "clv_quartile", **cutting).orderBy(
        F.desc("lifetime_spend"), "customer_id")


def price_change_engagement(subscriptions: DataFrame, viewing: DataFrame, days: int = 30, **cutting) -> DataFrame:
    """Q29: watch time before and after the latest price change; a first subscription is a change."""
    history = subscriptions.select("customer_id", "subscription_start_date", "subscription_id", "monthly_price")
    priced = neighbour(history, ["customer_id"], ["subscription_start_date", "subscription_id"],
                       {"old_price": "monthly_price"}, -1, **cutting)
    changes = priced.where(~F.col("old_price").eqNullSafe(F.col("monthly_price")))
    newest = Window.partitionBy("customer_id").orderBy(F.desc("subscription_start_date"), F.desc("subscription_id"))
    recent = changes.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").select(
        "customer_id", F.col("subscription_start_date").alias("change_date"), "old_price",
        F.col("monthly_price").alias("new_price"))
    views = viewing.groupBy("customer_id", "viewing_date").agg(  # a row per customer and day before the join
        F.sum("watch_duration_minutes").alias("_minutes"), F.count("watch_duration_minutes").alias("_views"))
    offset = F.datediff("viewing_date", "change_date")
    before, after = offset.between(-days, -1), offset.between(0, days - 1)
    keys = ["customer_id", "change_date", "old_price", "new_price"]
    sums = recent.join(views, "customer_id", "left").groupBy(*keys).agg(
        F.sum(F.when(before, F.col("_minutes"))).alias("_sb"), F.sum(F.when(before, F.col("_views")).otherwise(0)).alias("_nb"),
        F.sum(F.when(after, F.col("_minutes"))).alias("_sa"), F.sum(F.when(after, F.col("_views")).otherwise(0)).alias("_na"))
    change = ratio(100 * (F.col("_sa") * F.col("_nb") - F.col("_sb") * F.col("_na")), F.col("_sb") * F.col("_na"))
    return sums.select(*keys, ratio("_sb", "_nb", 6).alias("avg_watch_before"),
                       ratio("_sa", "_na", 6).alias("avg_watch_after"), change.alias("pct_change")
                       ).orderBy(F.asc_nulls_last("pct_change"), "customer_id")


def plan_migrations(subscriptions: DataFrame, plans: DataFrame, churn_labels: DataFrame, **cutting) -> DataFrame:
    """Q34: direction by catalogue price; a renewal of the same plan is Same-price/Other."""
    history = subscriptions.select("customer_id", "subscription_start_date", "subscription_id", "plan_id")
    stepped = neighbour(history, ["customer_id"], ["subscription_start_date", "subscription_id"],
                        {"next_plan_id": "plan_id"}, 1, **cutting).where(F.col("next_plan_id").isNotNull())
    # moves of one customer between the same plans are counted before the labels are joined
    moves = stepped.groupBy("customer_id", "plan_id", "next_plan_id").agg(F.count(F.lit(1)).alias("_n"))
    labelled = moves.join(churn_labels.select("customer_id", "churned"), "customer_id").groupBy(
        "plan_id", "next_plan_id").agg(
        F.sum("_n").alias("_n"), F.sum(F.col("_n") * flag(F.col("churned"))).alias("_churned"))
    old = plans.select("plan_id", F.col("plan_name").alias("from_plan"), F.col("monthly_price").alias("_from"))
    new = plans.select(F.col("plan_id").alias("next_plan_id"), F.col("plan_name").alias("to_plan"),
                       F.col("monthly_price").alias("_to"))
    direction = (F.when(F.col("_to") > F.col("_from"), "Upgrade").when(F.col("_to") < F.col("_from"), "Downgrade")
                 .otherwise("Same-price/Other"))
    return (labelled.join(old, "plan_id").join(new, "next_plan_id").withColumn("direction", direction)
            .groupBy("from_plan", "to_plan", "direction")
            .agg(F.sum("_n").alias("migrations"), pct(F.sum("_churned"), F.sum("_n")).alias("churn_rate_pct"))
            .orderBy(F.desc("migrations"), "from_plan", "to_plan"))
