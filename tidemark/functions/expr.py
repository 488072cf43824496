"""Small column helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, 1).otherwise(0)


def count_if(condition: Column) -> Column:
    return F.coalesce(F.sum(flag(condition)), F.lit(0)).cast("bigint")


def quotient(num: str | Column, den: str | Column) -> Column:
    """Exact decimal division; NULL when the denominator is 0."""
    return col(num).cast("decimal(28,4)") / F.nullif(col(den).cast("decimal(15,0)"), F.lit(0).cast("decimal(15,0)"))


def ratio(num: str | Column, den: str | Column, digits: int = 2) -> Column:
    """num / den rounded half away from zero, as SQL numeric ROUND does."""
    return F.round(quotient(num, den), digits).cast("double")


def ratio_even(num: str | Column, den: str | Column, digits: int = 2) -> Column:
    """num / den rounded half to even, as numpy and pandas do."""
    return F.bround(quotient(num, den), digits).cast("double")


def pct(num: str | Column, den: str | Column, digits: int = 2) -> Column:
    return ratio(col(num).cast("decimal(24,4)") * 100, den, digits)


def mean(c: str | Column, digits: int = 2) -> Column:
    """Average of an exact (integer or decimal) column from its sum and count."""
    return ratio(F.sum(col(c)), F.count(col(c)), digits)


def month(c: str | Column) -> Column:
    return F.trunc(col(c), "month")


def quarter(c: str | Column) -> Column:
    return F.trunc(col(c), "quarter")


def week(c: str | Column) -> Column:
    """Monday of the week."""
    return F.trunc(col(c), "week")


def days_between(later: str | Column, earlier: str | Column) -> Column:
    return F.datediff(col(later), col(earlier))


def latest_day(*dated: tuple[DataFrame, str]) -> DataFrame:
    """One row, one column ``day``: the last day over several tables, each read once."""
    days = None
    for df, c in dated:
        one = df.agg(F.max(c).alias("day"))
        days = one if days is None else days.unionByName(one)
    return days.agg(F.max("day").alias("day"))


def as_literal(one_row: DataFrame) -> Column:
    """The value of a one-row frame as a literal, which filters push down to the scan."""
    return F.lit(one_row.first()[0])
