"""Whitening, ranked search and positive-unlabelled quality against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import positive_unlabelled as pu
from tidemark.llm import queries, ranked_search, whitening

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WORDS = [a + b for a in "the re on an in is er".split() for b in "tion ed ing ble sh nd ou wh".split()]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(seed, n):
    dice = random.Random(seed)
    return " ".join(dice.choice(WORDS) for _ in range(n))


def rows(spark, name, folder):
    return [r.asDict() for r in queries.QUERIES[name](spark, folder).collect()]


# --- op11 -------------------------------------------------------------------------------------------------------------

def symmetric(values, seed):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    return q @ np.diag(values) @ q.T


@pytest.mark.parametrize("values", [[3, 2, 1, 0.5], [5, 5, 5, 1, 1], [1e9, 1, 1e-6], [4.0], [0, 0, 0], [2, 2 - 1e-9, 1], [-1, -2, 3, 0],
                                    list(range(40)), [7] * 12])
def test_slicing_finds_and_numbers_eigenvalues(values):
    a = symmetric(np.array(values, float), 3)
    a = (a + a.T) / 2
    want = np.linalg.eigvalsh(a)[::-1]
    k = min(4, len(values))
    got, vectors = whitening.leading_pairs(a, k)
    assert np.allclose(got, want[:k], atol=1e-12 * max(1, np.abs(want).max()))
    assert np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-12)
    assert np.allclose(a @ vectors, vectors * got, atol=1e-9 * max(1, np.abs(want).max()))


def test_leading_pairs_of_constant_dimensions():
    """Eigenvalues as far from the middle of an interval as the wanted one, and blocks that rounding could make singular."""
    x = np.array([[-213.0, 94, -202, 141, 256], [145, -270, -167, 499, 256]])
    for a in (np.diag([3.7, 0]), np.diag([8.0, 4, 0, 0]), np.cov(x.T, bias=True)):
        values, vectors = whitening.leading_pairs(a, min(4, len(a)))
        assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:4], atol=1e-9)
        assert np.allclose(a @ vectors, vectors * values, atol=1e-9)


def test_inertia_counts_eigenvalues_above_a_shift():
    dice = np.random.default_rng(1)
    for _ in range(50):
        a = dice.standard_normal((9, 9))
        a = a + a.T
        values = np.linalg.eigvalsh(a)
        for shift in [*(values[:-1] + values[1:]) / 2, values[0] - 1, values[-1] + 1]:
            assert whitening.count_above(a, shift) == (values > shift).sum()
    assert whitening.count_above(np.array([[0.0, 1.0], [1.0, 0.0]]), 0.0) == 1  # no diagonal pivot at all


def test_whitening(spark, corpus):
    table = spark.read.parquet(f"{corpus}/embeddings.parquet").collect()
    usable = {r["vec_id"]: np.floor(256 * np.asarray(r["embedding"], np.float64)) for r in table
              if r["embedding"] and all(c is not None and math.isfinite(c) for c in r["embedding"])}
    got = {}
    for r in rows(spark, "op11_spectrum_whitening", corpus):
        got.setdefault(r["vec_id"], {})[r["component"]] = r
    assert sorted(got) == sorted(usable)
    for length, count in ((6, 4), (2, 2), (1, 1)):
        mine = {k: v for k, v in usable.items() if len(v) == length}
        distinct = np.unique(np.stack(list(mine.values())), axis=0)
        n, sums = len(distinct), distinct.sum(axis=0)
        values, vectors = np.linalg.eigh(np.atleast_2d(np.cov(distinct.T, bias=True)) if n > 1 else np.zeros((length, length)))
        values, vectors = values[::-1], vectors[:, ::-1]
        ids = sorted(mine)
        for k in range(count):
            shown = [got[i][k + 1] for i in ids]
            assert all(r["n"] == n and r["deviation"] == int(((n * mine[i] - sums) ** 2).sum()) for i, r in zip(ids, shown))
            have = np.array([r["whitened"] for r in shown])
            if values[k] > 1e-9 * values.sum() and values[k] > 0:
                want = (np.stack([mine[i] for i in ids]) - sums / n) @ vectors[:, k] / math.sqrt(values[k])
                assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-9
                assert abs(shown[0]["explained"] / (values[k] / values.sum()) - 1) < 1e-9
            else:
                assert not have.any() and shown[0]["explained"] == 0
            assert shown[0]["identity_error"] < 1e-9
        assert all(len(got[i]) == count for i in ids)


def test_deviation_too_large_for_a_long_is_null():
    model = whitening.Whitening(1 << 30, np.zeros(2, np.int64), np.ones(1), np.ones(1), np.ones((2, 1)))
    assert model.deviations(np.array([[1, 1], [1 << 40, 0]])) == [2 << 60, None]


# --- op13 -------------------------------------------------------------------------------------------------------------

def brute_search(docs, items, k):
    found = [(d, Counter(TERM.findall(t.translate(LOWER)))) for d, t in docs if t]
    found = [(d, c) for d, c in found if c]
    n_docs, words = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    wanted = {}
    for item, t in items:
        wanted.setdefault(item, set()).update(TERM.findall((t or "").translate(LOWER)))
    out = set()
    for item, terms in wanted.items():
        scored = []
        for d, c in found:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // words
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in terms if t in c)
            if s > 0:
                scored.append((-s, d is None, d))
        out |= {(item, rank, d, -s) for rank, (s, _, d) in enumerate(sorted(scored)[:k], 1)}
    return out


def test_ranked_search(spark, corpus):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{corpus}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{corpus}/benchmark.parquet").collect()]
    got = [(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in rows(spark, "op13_k2_treap_search", corpus)]
    assert len(got) == len(set(got)) and set(got) == brute_search(docs, items, 50)


def test_ranked_search_over_many_shards_with_ties(spark, monkeypatch):
    dice = random.Random(5)
    vocabulary = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(dice.choices(vocabulary, [1 / (j + 1) for j in range(60)], k=dice.randrange(1, 40)))) for i in range(400)]
    docs += [(1000 + i, docs[0][1]) for i in range(70)] + [(None, docs[0][1]), (2000, None), (2001, "..."), (2001, "w1 w1"), (2001, "w1 w1")]
    items = [(i, " ".join(dice.choices(vocabulary, k=6))) for i in range(20)] + [(20, docs[0][1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(ranked_search, "ITEM_BYTES", 100)  # several blocks of items
    counts = ranked_search.corpus_counts(frame)
    index = ranked_search.build_index(frame, counts, shard_docs=37, shard_terms=500)
    assert index.count() >= 13
    got = ranked_search.ranked(index, spark.createDataFrame(items, "item_id long, text string"), counts, 5).collect()
    assert {tuple(r) for r in got} == brute_search(docs, items, 5) and len(got) == len(set(got))


def test_grid_returns_every_cell():
    dice = np.random.default_rng(2)
    cells = np.unique(dice.integers(0, 50, (300, 2)), axis=0)
    values = dice.integers(1, 1000, len(cells))
    walk = ranked_search.Walk(ranked_search.Treap.build(cells[:, 0], cells[:, 1], values, 6))
    for row in range(50):
        scores, cols = walk.top(np.array([row]), np.array([3]), 100)
        mine = cells[:, 0] == row
        assert sorted(zip(cols.tolist(), scores.tolist())) == sorted(zip(cells[mine, 1].tolist(), (3 * values[mine]).tolist()))


# --- op12 -------------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def labelled(spark, tmp_path_factory):
    """600 documents, a third of them menus, half of them labelled."""
    folder = str(tmp_path_factory.mktemp("labelled"))
    dice = random.Random(4)
    docs, labels = [], []
    for i in range(600):
        good = dice.random() < 0.65
        text = prose(i, dice.randrange(60, 200)) + "." if good else " | ".join(prose(i, 60).split()) + "%%% &&&"
        docs.append((i, text, "en"))
        if i % 2:
            labels.append((i, int(good), 0))
    docs += [(600, None, "en"), (601, "", "en"), (601, "", "en"), (None, "x", "en"), (602, "y " * 200_000, "en")]
    labels += [(1, None, 0), (601, 0, 0), (601, 1, 0), (None, 1, 0), (77_777, 1, 0)]
    spark.createDataFrame(docs, "doc_id long, text string, score string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_quality_on_held_out_documents(spark, labelled):
    got = rows(spark, "op12_pu_quality", labelled)
    assert len(got) == 605
    truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{labelled}/labels.parquet").collect() if r["doc_id"] is not None and r["doc_id"] < 600 and r["quality"] is not None}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 40 and sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)
    for r in got:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7)
    assert len({r["score"] for r in got if r["doc_id"] in (600, 601)}) == 1


def test_held_out_labels_change_nothing(spark, labelled, tmp_path):
    before = {(r["doc_id"], r["score"]) for r in rows(spark, "op12_pu_quality", labelled)}
    docs, labels = (spark.read.parquet(f"{labelled}/{t}.parquet") for t in ("documents", "labels"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.selectExpr("doc_id", "if(crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2, 1 - quality, quality) quality").write.parquet(f"{tmp_path}/labels.parquet")
    assert {(r["doc_id"], r["score"]) for r in rows(spark, "op12_pu_quality", str(tmp_path))} == before


def test_without_trusted_documents(spark, labelled, tmp_path):
    spark.read.parquet(f"{labelled}/documents.parquet").write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{labelled}/labels.parquet").where("quality = 0").write.parquet(f"{tmp_path}/labels.parquet")
    assert {(r["score"], r["predicted"]) for r in rows(spark, "op12_pu_quality", str(tmp_path))} == {(0.5, 0)}


def test_risk_by_definition_and_slopes_by_differences():
    dice = np.random.default_rng(0)
    p, u = dice.standard_normal(5) + 1, dice.standard_normal(7)
    loss = lambda z: math.log(1 + math.exp(-z))
    first, rest = pu.risk_parts(p, u, 0.4)
    assert first == pytest.approx(0.4 * np.mean([loss(z) for z in p]))
    assert rest == pytest.approx(np.mean([loss(-z) for z in u]) - 0.4 * np.mean([loss(-z) for z in p]))
    for prior in (0.4, 0.95):
        for shift in (0.0, -6.0):
            a, b = p, u + shift
            below = pu.risk_parts(a, b, prior)[1] < 0
            value = lambda x, y: -pu.risk_parts(x, y, prior)[1] if below else sum(pu.risk_parts(x, y, prior))  # noqa: E731,B023
            ga, gb = pu.risk_slopes(a, b, prior)
            step = 1e-6
            for i in range(len(a)):
                assert ga[i] == pytest.approx((value(a + step * (np.arange(5) == i), b) - value(a - step * (np.arange(5) == i), b)) / (2 * step), abs=1e-6)
            for i in range(len(b)):
                assert gb[i] == pytest.approx((value(a, b + step * (np.arange(7) == i)) - value(a, b - step * (np.arange(7) == i))) / (2 * step), abs=1e-6)


def test_best_bin_prior():
    positive = np.zeros(100)
    positive[50:] = 200
    negative = np.zeros(100)
    negative[:60] = 100
    mixed = 0.7 * positive * (20_000 / positive.sum()) + 0.3 * negative * (20_000 / negative.sum())
    assert pu.best_bin_prior(positive, mixed) == pytest.approx(0.7, abs=0.02)
    assert pu.best_bin_prior(np.zeros(100), mixed) == 0.5
