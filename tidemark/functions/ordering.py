"""Ordered scans that stay parallel: running totals, previous/next values, ranks and ntiles.

A window over one group runs in one task. That is right while groups are small, and wrong for a global rank or for a
customer who owns a third of all rows. So a table of more than ``CELL_ROWS`` rows is first written in ranges of
(group, order), one cell a range, and each window works on one group inside one cell. What a group carries over a cell's
edge follows from one row a cell: the last group of a cell sends its total, the first group of a later cell receives
the sum of what was sent before. It enters the window as a row ahead of the others, so nothing is joined or broadcast.

The number of cells follows from the rows. No key or bound comes to the driver or into the plan, and the cell of a row is
a stored column, so a recomputed task sees the same cells. All orders are ascending, NULLs first; rows with equal
(group, order) are in one cell, so that order should be (nearly) unique.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import settle

CELL, PLACE = "_cell", "_place"
CELL_ROWS = 1_000_000  # rows that a cell is meant to hold
BEFORE, ROW, AFTER = 0, 1, 2  # places of carried rows and of rows proper inside a cell


def cut_cells(df: DataFrame, group: Sequence[str], order: Sequence[str], cells: int | None = None,
              at_rest: bool = False) -> DataFrame:
    """The rows, with their cell when there is more than one.

    ``at_rest`` says that ``df`` only reads a written table: then it is counted from the file footers as it is. Anything
    else is written first, so that its joins run once and not again for the count and the range bounds.
    """
    if cells is None:
        df = df if at_rest else settle(df, "rows")
        cells = -(-df.count() // CELL_ROWS)
    if cells <= 1:
        return df
    ranged = df.repartitionByRange(cells, *group, *order).withColumn(CELL, F.spark_partition_id())
    return settle(ranged, "cells")


def _is(group: Sequence[str], struct: str) -> Column:
    same = F.lit(True)
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"{struct}.{g}"))
    return same


def _carried(rows: DataFrame, group: Sequence[str], sent: Mapping[str, Column], add: Callable[[Column], Column],
             forward: bool = True) -> DataFrame:
    """One row a cell for the group that comes in from other cells: group, cell, place and what is carried to it.

    ``sent`` are aggregates over the rows of the group that leaves a cell, ``add`` puts together what the cells before
    (``forward``) or behind have sent.
    """
    if group:
        leaves, enters = (F.max, F.min) if forward else (F.min, F.max)
        whole = F.struct(*group)
        ends = settle(rows.groupBy(CELL).agg(leaves(whole).alias("_leaves"), enters(whole).alias("_enters")), "cell-ends")
        leaving = rows.join(ends.select(CELL, "_leaves"), CELL).where(_is(group, "_leaves"))
        out = leaving.groupBy(CELL, *group).agg(*[v.alias(n) for n, v in sent.items()])
        asked = ends.select(CELL, "_enters.*")
    else:
        out = settle(rows.groupBy(CELL).agg(*[v.alias(n) for n, v in sent.items()]), "cell-totals")
        asked = out.select(CELL)
    # a cell asks before it sends, in the direction of the scan
    both = asked.withColumn("_asks", F.lit(True)).unionByName(out.withColumn("_asks", F.lit(False)), allowMissingColumns=True)
    along = F.col(CELL).asc() if forward else F.col(CELL).desc()
    before = Window.partitionBy(*group).orderBy(along, F.col("_asks").desc()).rowsBetween(Window.unboundedPreceding, 0)
    return both.select(*group, CELL, "_asks", *[add(F.col(n)).over(before).alias(n) for n in sent]).where("_asks").drop(
        "_asks").withColumn(PLACE, F.lit(BEFORE if forward else AFTER))


def _scan(df: DataFrame, rows: DataFrame, carried: DataFrame, group: Sequence[str], order: Sequence[str],
          out: Mapping[str, Callable], preceding: bool) -> DataFrame:
    """Columns ``out`` by windows inside the cells, over the rows and what is carried to them."""
    within = Window.partitionBy(*group, CELL).orderBy(PLACE, *order)
    if preceding:
        within = within.rowsBetween(Window.unboundedPreceding, 0)
    both = rows.withColumn(PLACE, F.lit(ROW)).unionByName(carried, allowMissingColumns=True)
    done = both.select(*[F.col(f"`{c}`") for c in df.columns], PLACE, *[made(within).alias(n) for n, made in out.items()])
    return done.where(F.col(PLACE) == ROW).drop(PLACE)


def running_sum(df: DataFrame, group: Sequence[str], order: Sequence[str], sums: Mapping[str, Column],
                **cutting) -> DataFrame:
    """Add inclusive running sums per group in the given order; NULL before the first value, as SUM gives it."""
    rows = cut_cells(df, group, order, **cutting)
    if CELL not in rows.columns:
        within = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return rows.select("*", *[F.sum(value).over(within).alias(name) for name, value in sums.items()])
    kinds = {f.name: f.dataType for f in rows.select(*[F.sum(v).alias(n) for n, v in sums.items()]).schema}
    held = {n: f"_v_{n}" for n in sums}
    rows = rows.select("*", *[v.cast(kinds[n]).alias(held[n]) for n, v in sums.items()])
    carried = _carried(rows, group, {held[n]: F.sum(held[n]).cast(kinds[n]) for n in sums}, F.sum)
    carried = carried.withColumns({held[n]: F.col(held[n]).cast(kinds[n]) for n in sums})
    return _scan(df, rows, carried, group, order,
                 {n: lambda w, n=n: F.sum(held[n]).over(w).cast(kinds[n]) for n in sums}, preceding=True)


def neighbour(df: DataFrame, group: Sequence[str], order: Sequence[str], columns: Mapping[str, str],
              step: int, **cutting) -> DataFrame:
    """Add the value of the previous (step -1) or next (step +1) row: ``columns`` maps new name to source."""
    rows = cut_cells(df, group, order, **cutting)
    if CELL not in rows.columns:
        within = Window.partitionBy(*group).orderBy(*order)
        return rows.select("*", *[F.lag(source, -step).over(within).alias(name) for name, source in columns.items()])
    held = {n: f"_v_{n}" for n in columns}
    rows = rows.select("*", *[F.col(source).alias(held[n]) for n, source in columns.items()])
    edge = F.max_by if step < 0 else F.min_by
    sent = {"_sent": edge(F.struct(*held.values()), F.struct(*order))}
    carried = _carried(rows, group, sent, lambda v: F.last(v, ignorenulls=True), forward=step < 0)
    return _scan(df, rows, carried.select("*", "_sent.*").drop("_sent"), group, order,
                 {n: lambda w, n=n: F.lag(held[n], -step).over(w) for n in columns}, preceding=False)


def last_known(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, out: str, **cutting) -> DataFrame:
    """Add the last value so far that is not NULL, the row's own included."""
    rows = cut_cells(df, group, order, **cutting)
    if CELL not in rows.columns:
        within = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return rows.withColumn(out, F.last(value, ignorenulls=True).over(within))
    rows = rows.withColumn("_v", F.col(value))
    latest = F.max_by("_v", F.when(F.col("_v").isNotNull(), F.struct(*order)))
    carried = _carried(rows, group, {"_v": latest}, lambda v: F.last(v, ignorenulls=True))
    return _scan(df, rows, carried, group, order, {out: lambda w: F.last("_v", ignorenulls=True).over(w)}, preceding=True)


def row_position(df: DataFrame, order: Sequence[str], out: str = "position", **cutting) -> DataFrame:
    """Global row number by a unique order."""
    return running_sum(df, [], order, {out: F.lit(1).cast("bigint")}, **cutting)


def ntile(df: DataFrame, k: int, order: Sequence[str], out: str, **cutting) -> DataFrame:
    """NTILE(k) over the whole table; ``order`` must be unique. The first tiles take the remainder."""
    rest = settle(df, "tiled")
    small, extra = divmod(rest.count(), k)
    head, p = extra * (small + 1), F.col("_position")
    tile = F.when(p <= head, F.ceil(p / (small + 1))).otherwise(extra + F.ceil((p - head) / max(small, 1)))
    rows = row_position(rest, order, "_position", **{"at_rest": True, **cutting})
    return rows.withColumn(out, tile.cast("int")).drop("_position")


def value_positions(df: DataFrame, columns: Sequence[str], weights: Mapping[str, Column] | None = None,
                    **cutting) -> DataFrame:
    """For every column and distinct value: rows equal, rows below, rows in all (NULLs left out).

    Ranking distinct values instead of rows means that a value shared by most rows costs one row.
    Extra ``weights`` are summed per value (as ``<name>``) and below it (as ``<name>_below``).
    """
    weights = dict(weights or {})
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value"),
                 *[w.alias(n) for n, w in weights.items()]) for c in columns])).alias("x")).select("x.*")
    counted = settle(long.where(F.col("value").isNotNull()).groupBy("name", "value").agg(
        F.count(F.lit(1)).alias("equal"), *[F.sum(n).alias(n) for n in weights]), "value-counts")
    summed = running_sum(counted, ["name"], ["value"], {"_to": F.col("equal"), **{f"_to_{n}": F.col(n) for n in weights}},
                         **{"at_rest": True, **cutting})
    totals = counted.groupBy("name").agg(F.sum("equal").alias("n"))
    return summed.join(F.broadcast(totals), "name").select(  # one row per ranked column
        "name", "value", "equal", (F.col("_to") - F.col("equal")).alias("below"), "n",
        *weights, *[(F.col(f"_to_{n}") - F.col(n)).alias(f"{n}_below") for n in weights])


def add_ranks(df: DataFrame, key: str, columns: Sequence[str], **cutting) -> DataFrame:
    """Add ``<c>_below``, ``<c>_equal`` and ``<c>_n`` for every ranked column.

    ``df`` is read several times: settle it first when it is costly.
    """
    ranks = value_positions(df, columns, **cutting)
    long = df.select(key, F.explode(F.array(*[
        F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in columns])).alias("x")
    ).select(key, "x.*").where(F.col("value").isNotNull())
    placed = long.join(ranks, ["name", "value"])
    wide = placed.groupBy(key).agg(*[
        F.max(F.when(F.col("name") == c, F.col(part))).alias(f"{c}_{part}")
        for c in columns for part in ("below", "equal", "n")])
    return df.join(wide, key, "left")


def percent_rank(c: str, descending: bool = False) -> Column:
    """SQL PERCENT_RANK from the columns of ``add_ranks``: (rank - 1) / (n - 1), 0 for one row."""
    below = F.col(f"{c}_n") - F.col(f"{c}_below") - F.col(f"{c}_equal") if descending else F.col(f"{c}_below")
    return below / F.greatest(F.col(f"{c}_n") - 1, F.lit(1))


def outranked(c: str, descending: bool = False) -> Column:
    """Numerator of PERCENT_RANK: the number of rows that come before this value."""
    return F.col(f"{c}_n") - F.col(f"{c}_below") - F.col(f"{c}_equal") if descending else F.col(f"{c}_below")


def twice_average_rank(c: str) -> Column:
    """Twice the average rank, an integer: 2 * below + equal + 1."""
    return 2 * F.col(f"{c}_below") + F.col(f"{c}_equal") + 1


def average_rank_pct(c: str) -> Column:
    """Average rank over n, ties sharing the mean rank. NULL values are not ranked."""
    return twice_average_rank(c) / (2 * F.col(f"{c}_n"))


def exact_percentiles(df: DataFrame, group: Sequence[str], value: str, probs: Mapping[str, float],
                      **cutting) -> DataFrame:
    """Interpolated percentiles per group from counts of distinct values: no group is held in memory."""
    counted = settle(df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(
        F.count(F.lit(1)).alias("_c")), "value-counts")
    return percentiles_of_counts(counted, group, value, probs, **{"at_rest": True, **cutting})


def percentiles_of_counts(counted: DataFrame, group: Sequence[str], value: str, probs: Mapping[str, float],
                          **cutting) -> DataFrame:
    """Interpolated percentiles per group of distinct values that stand ``_c`` times each."""
    group = list(group)
    summed = running_sum(counted, group, [value], {"_to": F.col("_c")}, **cutting)
    sizes = counted.groupBy(*group).agg(F.sum("_c").alias("_n"))
    if group:
        named = sizes.select(*[F.col(g).alias(f"_g_{g}") for g in group], "_n")
        same = F.lit(True)
        for g in group:
            same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
        sized = summed.join(named, same)
    else:
        sized = summed.crossJoin(F.broadcast(sizes))  # one row
    picks, outs = [], []
    for name, p in probs.items():
        spot = (F.col("_n") - 1) * F.lit(p)
        picks += [F.min(F.when(F.col("_to") > F.floor(spot), F.col(value))).cast("double").alias(f"_lo_{name}"),
                  F.min(F.when(F.col("_to") > F.ceil(spot), F.col(value))).cast("double").alias(f"_hi_{name}")]
        share = (F.col("_n") - 1) * F.lit(p) - F.floor((F.col("_n") - 1) * F.lit(p))
        outs.append((F.col(f"_lo_{name}") + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * share).alias(name))
    picked = sized.groupBy(*group).agg(F.max("_n").alias("_n"), *picks)
    return picked.select(*group, *outs)
