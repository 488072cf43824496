"""Ordered scans against pandas, on rows where one group or value holds a third of everything."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions import ordering as o

CUT = {"cells": 6}


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(7)
    n = 900
    g = np.where(np.arange(n) < 300, 0, rng.integers(1, 60, n))
    frame = pd.DataFrame({"g": g, "t": rng.permutation(n), "v": rng.integers(0, 9, n), "w": rng.choice([0.0, 0.25, 0.5, 1.0, 2.5], n)})
    frame.loc[:320, "w"] = 0.0
    frame["id"] = rng.permutation(n)
    return frame, spark.createDataFrame(frame).repartition(5).persist()


def sorted_pandas(df, *by):
    return df.toPandas().sort_values(list(by)).reset_index(drop=True)


def test_large_group_is_cut_and_small_table_is_not(skewed, monkeypatch):
    _, df = skewed
    assert o.CELL not in o.cut_cells(df, ["g"], ["t"]).columns
    monkeypatch.setattr(o, "CELL_ROWS", 150)
    per_cell = o.cut_cells(df, ["g"], ["t"]).groupBy("g", o.CELL).count().toPandas()
    assert per_cell[o.CELL].nunique() == 6 and per_cell["count"].sum() == 900
    assert (per_cell.g == 0).sum() > 1 and per_cell.groupby(o.CELL)["count"].sum().max() < 300
    assert (per_cell.groupby("g")[o.CELL].nunique() > 1).sum() <= 6


def test_plan_stays_small_and_nothing_is_broadcast(skewed):
    _, df = skewed
    plans = [len(o.running_sum(df, ["g"], ["t"], {"s": F.col("v")}, cells=k)._jdf.queryExecution().optimizedPlan().toString())
             for k in (4, 200)]
    assert abs(plans[0] - plans[1]) < 50


@pytest.mark.parametrize("cutting", [CUT, {}])
def test_null_groups_and_values_before_the_first(spark, cutting):
    rows = [(None if i % 2 else i % 3, i, None if i < 90 or i % 5 else i) for i in range(400)]
    df = spark.createDataFrame(rows, "g int, t int, v int")
    got = {r.t: r for r in o.last_known(o.neighbour(o.running_sum(df, ["g"], ["t"], {"s": F.col("v")}, **cutting),
                                                    ["g"], ["t"], {"prev": "t", "v1": "v"}, -1, **cutting),
                                        ["g"], ["t"], "v", "seen", **cutting).collect()}
    sums, before, seen = {}, {}, {}
    assert len(got) == 400
    for g, t, v in rows:
        if v is not None:
            sums[g], seen[g] = sums.get(g, 0) + v, v
        assert (got[t].s, got[t].seen) == (sums.get(g), seen.get(g)) and (got[t].prev, got[t].v1) == before.get(g, (None, None))
        before[g] = (t, v)


def test_decimals_keep_their_type_over_cells(make):
    df = make("g int, t int, v decimal(12,2)", *[(1, i, f"{i}.25") for i in range(60)])
    whole, cut = (o.running_sum(df, ["g"], ["t"], {"s": F.col("v")}, **c) for c in ({}, CUT))
    assert whole.schema["s"].dataType == cut.schema["s"].dataType and sorted(whole.collect()) == sorted(cut.collect())


def test_empty_table(spark):
    df = spark.createDataFrame([], "g int, t int, v int")
    for c in (CUT, {}):
        assert o.running_sum(df, ["g"], ["t"], {"s": F.col("v")}, **c).isEmpty() and o.ntile(df, 4, ["t"], "q", **c).isEmpty()


@pytest.mark.parametrize("cutting", [CUT, {}])
def test_running_sum(skewed, cutting):
    frame, df = skewed
    got = sorted_pandas(o.running_sum(df, ["g"], ["t"], {"s": F.col("v")}, **cutting), "g", "t")
    want = frame.sort_values(["g", "t"]).reset_index(drop=True)
    assert (got.s == want.groupby("g").v.cumsum()).all()
    assert o.CELL not in got.columns


@pytest.mark.parametrize("cutting", [CUT, {}])
@pytest.mark.parametrize("step", [-1, 1])
def test_neighbour(skewed, step, cutting):
    frame, df = skewed
    got = sorted_pandas(o.neighbour(df, ["g"], ["t"], {"x": "v"}, step, **cutting), "g", "t")
    want = frame.sort_values(["g", "t"]).reset_index(drop=True).groupby("g").v.shift(-step)
    assert got.x.astype(float).fillna(-1).tolist() == want.fillna(-1).tolist()


@pytest.mark.parametrize("cutting", [CUT, {}])
def test_last_known_crosses_empty_cells(spark, cutting):
    rows = [(1 if i < 260 else i % 40 + 2, i, i if i in (3, 150, 300, 390) else None) for i in range(400)]
    df = spark.createDataFrame(rows, "g int, t int, v int")
    got = o.last_known(df, ["g"], ["t"], "v", "x", **cutting).toPandas().sort_values(["g", "t"]).reset_index(drop=True)
    want = pd.DataFrame(rows, columns=["g", "t", "v"]).sort_values(["g", "t"]).reset_index(drop=True).groupby("g").v.ffill()
    assert got.x.astype(float).fillna(-1).tolist() == want.fillna(-1).tolist()


def test_neighbour_keeps_null_values(spark):
    rows = [(1, i, None if i % 3 == 0 else i) for i in range(200)]
    df = spark.createDataFrame(rows, "g int, t int, v int")
    got = o.neighbour(df, ["g"], ["t"], {"x": "v"}, -1, **CUT).orderBy("t").collect()
    assert [r["x"] for r in got] == [None] + [r[2] for r in rows[:-1]]


@pytest.mark.parametrize("cutting", [CUT, {}])
def test_global_position_and_ntile(skewed, cutting):
    frame, df = skewed
    got = sorted_pandas(o.ntile(o.row_position(df, ["w", "id"], **cutting), 7, ["w", "id"], "tile", **cutting), "w", "id")
    assert got.position.tolist() == list(range(1, 901))
    want = np.concatenate([np.full(len(part), i + 1) for i, part in enumerate(np.array_split(np.arange(900), 7))])
    assert got.tile.tolist() == want.tolist()


def test_ntile_of_fewer_rows_than_tiles(spark):
    df = spark.createDataFrame([(i,) for i in range(3)], "id int")
    assert [r.q for r in o.ntile(df, 4, ["id"], "q").orderBy("id").collect()] == [1, 2, 3]


@pytest.mark.parametrize("cutting", [CUT, {}])
def test_average_rank_and_percent_rank(skewed, cutting):
    frame, df = skewed
    got = sorted_pandas(o.add_ranks(df, "id", ["w", "t"], **cutting).select(
        "*", o.average_rank_pct("w").alias("avg_w"), o.average_rank_pct("t").alias("avg_t"),
        o.percent_rank("w").alias("pr_w"), o.percent_rank("t", True).alias("pr_t_desc")), "id")
    want = frame.sort_values("id").reset_index(drop=True)
    assert np.allclose(got.avg_w, want.w.rank(pct=True)) and np.allclose(got.avg_t, want.t.rank(pct=True))
    assert np.allclose(got.pr_w, (want.w.rank(method="min") - 1) / 899)
    assert np.allclose(got.pr_t_desc, (want.t.rank(method="min", ascending=False) - 1) / 899)


def test_ranks_small_examples(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, 2.0), (4, 3.0), (5, None)], "id int, v double")
    got = {r.id: r for r in o.add_ranks(df, "id", ["v"]).select("id", o.average_rank_pct("v").alias("a"), o.percent_rank("v").alias("p")).collect()}
    assert [got[i].a for i in (1, 2, 3, 4)] == [0.375, 0.375, 0.75, 1.0] and got[5].a is None
    one = o.add_ranks(df.where("id = 4"), "id", ["v"]).select(o.average_rank_pct("v").alias("a"), o.percent_rank("v").alias("p")).first()
    assert (one.a, one.p) == (1.0, 0.0)


@pytest.mark.parametrize("cutting", [CUT, {}])
def test_exact_percentiles(skewed, cutting):
    frame, df = skewed
    got = o.exact_percentiles(df, ["g"], "t", {"a": 0.5, "b": 0.995}, **cutting).toPandas().set_index("g").sort_index()
    want = frame.groupby("g").t
    assert np.allclose(got.a, want.quantile(0.5)) and np.allclose(got.b, want.quantile(0.995))
    overall = o.exact_percentiles(df, [], "t", {"a": 0.25}, **cutting).first()
    assert overall.a == pytest.approx(frame.t.quantile(0.25))
