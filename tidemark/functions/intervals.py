"""Joins in time: as-of, nearest date, anchored windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.ordering import last_known


def _key_days(df: DataFrame, key: str, day: str) -> DataFrame:
    return df.where(F.col(key).isNotNull() & F.col(day).isNotNull()).select(
        F.col(key).alias("_key"), F.col(day).alias("_day")).distinct()


def as_of(events: DataFrame, states: DataFrame, key: str, event_day: str, event_id: str, state_day: str,
          carried: str, **cutting) -> DataFrame:
    """Attach to every event the struct column ``carried`` of the last state at or before its day.

    ``states`` has one row per key and day. Both sides are ordered together in one shuffle of the events; a
    key with a large share of them is cut into day ranges. Events without a state, or a day, get NULL.
    """
    known = states.where(F.col(key).isNotNull() & F.col(state_day).isNotNull())
    starts = known.select(F.col(key), F.col(state_day).alias("_day"), F.lit(0).alias("_kind"),
                          F.lit(None).cast("bigint").alias("_tie"), F.col(carried).alias("_state"))
    marks = events.select("*", F.col(event_day).alias("_day"), F.lit(1).alias("_kind"),
                          F.xxhash64(event_id).alias("_tie"))
    both = marks.unionByName(starts, allowMissingColumns=True)
    found = last_known(both, [key], ["_day", "_kind", "_tie"], "_state", carried, **cutting)
    return found.where(F.col("_kind") == 1).drop("_day", "_kind", "_tie", "_state")


def near(left: DataFrame, right: DataFrame, key: str, left_day: str, right_day: str, days: int) -> DataFrame:
    """Rows of ``left`` with a ``right`` day of the same key at most ``days`` before or after.

    Both sides are first reduced to one row per key and day, so what is ordered for one key is bounded by the
    calendar, whatever the number of its events.
    """
    marks = _key_days(left, key, left_day).withColumn("_kind", F.lit(1))
    events = _key_days(right, key, right_day).withColumn("_kind", F.lit(0))
    both = events.unionByName(marks)
    event = F.when(F.col("_kind") == 0, F.col("_day"))
    order = Window.partitionBy("_key").orderBy("_day", "_kind")
    before = F.last(event, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    reverse = Window.partitionBy("_key").orderBy(F.desc("_day"), "_kind")
    after = F.last(event, ignorenulls=True).over(reverse.rowsBetween(Window.unboundedPreceding, 0))
    close = both.select("_key", "_day", "_kind", before.alias("_before"), after.alias("_after")).where(
        (F.col("_kind") == 1) & ((F.datediff("_day", "_before") <= days) | (F.datediff("_after", "_day") <= days)))
    on = (F.col(key) == F.col("_key")) & (F.col(left_day) == F.col("_day"))
    return left.join(close.select("_key", "_day"), on, "left_semi")


def anchored(events: DataFrame, anchors: DataFrame, day: str, days: int | None = None) -> DataFrame:
    """Events of the anchored customers up to and including their anchor, with their age in days."""
    joined = events.join(anchors.select("customer_id", "anchor_date"), "customer_id")
    age = F.datediff("anchor_date", day)
    kept = joined.where(F.col(day).isNotNull() & (F.col(day) <= F.col("anchor_date"))).withColumn(
        "days_before_anchor", age)
    return kept if days is None else kept.where(F.col("days_before_anchor").between(0, days - 1))
