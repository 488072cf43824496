"""Time joins and cleaning on hand-written rows."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions.intervals import near
from tidemark.operators import quality as q

D = dt.date


@pytest.fixture(scope="module")
def subscriptions(make):
    return make("subscription_id int, customer_id int, subscription_start_date date, subscription_end_date date, cancellation_date date",
                (10, 1, "2024-01-01", None, None), (11, 1, "2024-02-01", None, "2024-03-01"),
                (20, 2, "2024-01-10", None, None), (21, 2, "2024-01-10", "2024-06-30", None), (30, 3, "2024-05-01", None, None))


def test_resolve_payments(make, subscriptions):
    pay = make("payment_id int, customer_id int, payment_date date",
               (1, 1, "2024-02-01"), (2, 1, "2023-12-31"), (3, 1, "2024-03-01"), (4, 1, "2024-03-02"), (5, 2, "2024-01-10"),
               (6, 2, "2024-07-01"), (7, 3, "2099-01-01"), (8, 9, "2024-01-01"), (9, 1, None))
    got = {r.payment_id: (r.subscription_id, r.resolution, r.after_cancellation) for r in q.resolve_payments(pay, subscriptions).collect()}
    assert got == {1: (11, "active", False), 2: (None, "unresolved", False), 3: (11, "active", False), 4: (11, "fallback", True),
                   5: (21, "active", False), 6: (21, "fallback", False), 7: (30, "active", False), 8: (None, "unresolved", False),
                   9: (None, "unresolved", False)}


@pytest.mark.parametrize("cutting", [{}, {"cells": 6}])
def test_resolve_against_interval_join(spark, cutting):
    rng = np.random.default_rng(3)
    start = pd.Timestamp("2024-01-01")
    subs = pd.DataFrame({"subscription_id": range(120), "customer_id": np.where(np.arange(120) < 40, 1, rng.integers(2, 9, 120)),
                         "s": rng.integers(0, 300, 120), "c": rng.integers(0, 300, 120), "has": rng.random(120) < .5})
    pays = pd.DataFrame({"payment_id": range(400), "customer_id": np.where(np.arange(400) < 140, 1, rng.integers(2, 9, 400)), "d": rng.integers(0, 400, 400)})
    want = {}
    for p in pays.itertuples():
        mine = subs[subs.customer_id == p.customer_id].sort_values(["s", "subscription_id"])
        nexts = mine.s.shift(-1)
        ends = nexts.where(nexts.notna(), (mine.s + mine.c + 1).where(mine.has, 10 ** 6))
        live = mine[(mine.s <= p.d) & (p.d < ends)]
        past = mine[mine.s <= p.d]
        want[p.payment_id] = (int(live.iloc[-1].subscription_id), "active") if len(live) else (
            (int(past.iloc[-1].subscription_id), "fallback") if len(past) else (None, "unresolved"))
    s = pd.DataFrame({"subscription_id": subs.subscription_id, "customer_id": subs.customer_id,
                      "subscription_start_date": [(start + pd.Timedelta(days=int(x))).date() for x in subs.s],
                      "cancellation_date": [(start + pd.Timedelta(days=int(a + b))).date() if h else None for a, b, h in zip(subs.s, subs.c, subs.has)]})
    sdf = spark.createDataFrame(s, "subscription_id int, customer_id int, subscription_start_date date, cancellation_date date").withColumn(
        "subscription_end_date", F.lit(None).cast("date"))
    pdf = spark.createDataFrame(pd.DataFrame({"payment_id": pays.payment_id, "customer_id": pays.customer_id,
                                              "payment_date": [(start + pd.Timedelta(days=int(x))).date() for x in pays.d]}),
                                "payment_id int, customer_id int, payment_date date")
    got = {r.payment_id: (r.subscription_id, r.resolution) for r in q.resolve_payments(pdf, sdf, **cutting).collect()}
    assert got == want


def test_near_both_directions(make):
    left = make("id int, k int, d date", (1, 1, "2024-03-15"), (2, 1, "2024-01-01"), (3, 2, "2024-03-15"), (4, 1, None))
    days = ["2024-03-01", "2024-02-29", "2024-03-29", "2024-03-30"]
    for day, hit in zip(days, (True, False, True, False)):
        right = make("k int, e date", (1, day), (1, None))
        found = [r.id for r in near(left, right, "k", "d", "e", 14).collect()]
        assert (1 in found) == hit and 3 not in found and 4 not in found


def test_keep_first_and_count(make):
    df = make("k int, o int, v string", (1, 2, "b"), (1, 1, "a"), (2, 5, "c"))
    assert sorted((r.k, r.v) for r in q.keep_first(df, "k", "o").collect()) == [(1, "a"), (2, "c")]
    assert q.duplicates_removed(df, "k").first()[0] == 1


def test_canonical_names(make):
    df = make("i int, c string, d string", (1, " USA ", "iPad"), (2, "u.k.", "PC"), (3, "Bharat", "fridge"), (4, "atlantis", None), (5, None, " Smart TV "),
              (6, "s.korea o'neil", "PlayStation/Xbox"))
    got = q.canonical(q.canonical(df, "c", q.COUNTRY_SPELLINGS), "d", q.DEVICE_SPELLINGS, q.UNKNOWN).orderBy("i").collect()
    assert [r.c for r in got] == ["United States", "United Kingdom", "India", "Atlantis", None, "S.Korea O'Neil"]
    assert [r.d for r in got] == ["Tablet", "Laptop", "Fridge", "Unknown", "Smart TV", "Gaming Console"]
    assert sum(len(v) for v in q.COUNTRY_SPELLINGS.values()) == 47 and sum(len(v) for v in q.DEVICE_SPELLINGS.values()) == 14


def test_age_imputation(make):
    df = make("i int, country string, age int", (1, "A", 2), (2, "A", 13), (3, "A", 100), (4, "A", None), (5, "B", 145), (6, "B", None), (7, "A", 14))
    valid = q.valid_range(df, "age", 13, 100)
    got = {r.i: r.age for r in q.impute_median(valid, "age", "country", whole_numbers=True).collect()}
    assert got == {1: 14, 2: 13, 3: 100, 4: 14, 5: 14, 6: 14, 7: 14}
    assert q.out_of_range(df, "age", 13, 100).first()[0] == 2


def test_half_even_rounding_of_imputed_ages(make):
    df = make("i int, g string, age int", (1, "A", 20), (2, "A", 21), (3, "A", None))
    assert {r.i: r.age for r in q.impute_median(df, "age", "g", whole_numbers=True).collect()}[3] == 20


def test_mode(make):
    tied = make("i int, l string", (1, "b"), (2, "a"), (3, None))
    assert [r.l for r in q.impute_mode(tied, "l").orderBy("i").collect()] == ["b", "a", "a"]
    empty = make("i int, l string", (1, None))
    assert q.impute_mode(empty, "l").first().l == "English"


def test_dates(make):
    df = make("i int, d string", (1, "2025-13-45"), (2, "2025-02-29"), (3, "2024-02-29"), (4, None))
    assert [r.d for r in q.parse_dates(df, ["d"]).orderBy("i").collect()] == [None, None, D(2024, 2, 29), None]
    assert q.bad_dates(df, "d").first()[0] == 3


def test_sentiment_and_price(make):
    fb = make("i int, rating int, sentiment_label string", (1, 2, "Negative"), (2, 4, "Neutral"), (3, None, "Neutral"), (4, 3, None))
    assert [r.disagrees for r in q.sentiment_audit(fb).orderBy("i").collect()] == [False, True, False, True]
    subs = make("plan_id string, monthly_price decimal(6,2)", ("a", "9.99"), ("a", "9.98"), ("z", "1.00"), ("a", None))
    plans = make("plan_id string, monthly_price decimal(6,2)", ("a", "9.99"))
    assert q.price_mismatches(subs, plans).first()[0] == 3


def test_orphans_and_rules(make):
    c = make("customer_id string", ("a",), ("b",))
    p = make("payment_id string, customer_id string, payment_date date, amount decimal(12,2)", ("1", "a", "2024-01-01", 5), ("1", "x", None, 123456), ("3", None, "2024-01-01", None))
    assert q.orphan_counts({"customers": c, "payments": p}).first().orphans == 2
    found = {(r.column_name, r.rule): r.violations for r in q.rule_violations({"customers": c, "payments": p}).collect() if r.table_name == "payments"}
    assert found[("customer_id", "not_null")] == 1 and found[("payment_date", "not_null")] == 1
    assert found[("amount", "numeric(7,2)")] == 1 and found[("payment_id", "unique")] == 1
    assert found[("customer_id", "references customers")] == 1
