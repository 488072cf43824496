"""Tree ensembles, fills, folds and k-means against definitions written out here."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tidemark.operators import churn, evaluation, explain, modelling, segments, trees


@pytest.fixture(scope="module")
def table(spark):
    dice = np.random.default_rng(3)
    n = 400
    a, b = dice.normal(size=n).round(2), dice.integers(0, 5, n).astype(float)
    c = dice.choice(["x", "y", "z"], n)
    y = ((a + (c == "x") + dice.normal(size=n) * .5) > .6).astype(float)
    frame = pd.DataFrame({"customer_id": np.arange(n), "a": a, "b": b, "c": c, "label": y, "fold": np.arange(n) % 3})
    frame.loc[::7, "a"] = np.nan
    frame.loc[::11, "c"] = None
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in frame.itertuples(index=False)]
    df = spark.createDataFrame([(int(r[0]), r[1], r[2], r[3], float(r[4]), int(r[5])) for r in rows],
                               "customer_id long, a double, b double, c string, label double, fold int").repartition(3)
    return df, frame


@pytest.fixture(scope="module")
def ready(table):
    df, _ = table
    layout = trees.learn_layout(df, ["a", "b"], ["c"])
    fills = modelling.learn_fills(df, ["a", "b"], ["c"], 3)
    return layout, fills, trees.blocks_of(df, layout, "customer_id", fold="fold")


@pytest.fixture(scope="module")
def cut(spark, ready):
    """The same rows in five blocks over three partitions."""
    whole = ready[2].first()
    parts = [trees.Block(whole.key[i::5], whole.y[i::5], whole.fold[i::5], whole.codes[i::5]) for i in range(5)]
    return spark.sparkContext.parallelize(parts, 3)


def shape(tree):
    return [(tree.column[i], tree.bin[i], tree.missing[i], tree.left[i], tree.right[i]) for i in range(len(tree.column))]


def canonical(tree, node=0):
    """A tree without the numbers of its nodes."""
    if tree.column[node] < 0:
        return (round(tree.value[node], 9),)
    return tree.column[node], tree.bin[node], tree.missing[node], canonical(tree, tree.left[node]), canonical(tree, tree.right[node])


def test_fills_are_those_of_each_folds_own_rows(table, ready):
    _, frame = table
    for m, fills in enumerate(ready[1]):
        rows = frame[frame.fold != m] if m < 3 else frame
        assert fills.medians == pytest.approx({c: rows[c].median() for c in "ab"})
        counts = rows.c.value_counts()
        assert fills.modes["c"] == min(counts[counts == counts.max()].index)


def test_fill_stage_is_saved_and_loaded(table, spark, tmp_path):
    df, frame = table
    model = Pipeline(stages=[modelling.Fill(numeric=["a", "b"], categorical=["c"])]).fit(df.where("fold <> 0"))
    model.write().save(str(tmp_path / "m"))
    got = PipelineModel.load(str(tmp_path / "m")).transform(df).toPandas().sort_values("customer_id")
    seen = frame[frame.fold != 0]
    assert np.allclose(got.num_a, frame.a.fillna(seen.a.median())) and list(got.cat_c) == list(frame.c.fillna(seen.c.mode()[0]))


def test_leaves_carry_the_penalty(spark):
    df = spark.createDataFrame([(i, float(i), float(v)) for i, v in enumerate([1, 2, 3, 10, 12, 14])], "customer_id long, a double, label double")
    layout = trees.learn_layout(df, ["a"], [])
    found = trees.boost(trees.blocks_of(df, layout, "customer_id"), layout, [trees.Fills({"a": 0.0}, {})], 0, trees.Boosting(
        rounds=1, step=0.5, depth=1, l2=2.0, rows=1.0, columns=1.0, logistic=False))[0]
    assert found.base == pytest.approx(7.0)
    assert sorted(v for c, v in zip(found.trees[0].column, found.trees[0].value) if c < 0) == pytest.approx([0.5 * -15 / 5, 0.5 * 15 / 5])
    y = [0, 0, 0, 1, 1, 0]
    df = spark.createDataFrame([(i, float(i), float(v)) for i, v in enumerate(y)], "customer_id long, a double, label double")
    found = trees.boost(trees.blocks_of(df, layout, "customer_id"), layout, [trees.Fills({"a": 0.0}, {})], 0, trees.Boosting(
        rounds=1, step=1.0, depth=1, l2=2.0, rows=1.0, columns=1.0, min_cover=0.0))[0]
    # positives weigh 4 / 2 = 2, so the start is even odds: G = w (y - 1/2), H = w / 4; the best cut is below 3
    assert found.base == pytest.approx(0.0)
    assert sorted(v for c, v in zip(found.trees[0].column, found.trees[0].value) if c < 0) == pytest.approx([-1.5 / (0.75 + 2), 1.5 / (1.25 + 2)])


def test_splits_against_enumeration(ready):
    layout, fills, blocks = ready
    b = blocks.first()
    fill = fills[-1].bins(layout)
    codes = np.where(b.codes == layout.bins, fill, b.codes)
    weight = np.random.default_rng(1).random(len(b.y))
    splitter = trees.Splitter(layout, trees.Growth(l2=1.5, min_rows=7))
    sums = trees.histogram(b.codes, np.zeros(len(b.y), int), 1, (np.ones(len(b.y)), weight, weight * b.y), splitter.first, splitter.slots)
    c, k, _, left, right = next(splitter.splits(sums, fill[None], np.zeros((1, splitter.n_drawn), int), False))
    part = lambda m: (weight * b.y)[m].sum() ** 2 / (weight[m].sum() + 1.5)
    best = {}
    for col in range(3):
        for v in range(layout.bins[col]):
            mask = codes[:, col] <= v if col < 2 else codes[:, col] == v
            if mask.sum() >= 7 and (~mask).sum() >= 7:
                best[col, v] = part(mask) + part(~mask)
    assert best[c, k] == pytest.approx(max(best.values()))
    mask = codes[:, c] <= k if c < 2 else codes[:, c] == k
    assert left == pytest.approx([mask.sum(), weight[mask].sum(), (weight * b.y)[mask].sum()])


@pytest.mark.parametrize("logistic", [True, False])
def test_a_job_a_level_and_one_task_grow_the_same_trees(ready, cut, logistic):
    layout, fills, blocks = ready
    rules = trees.Boosting(rounds=trees.REFRESH + 3, step=0.2, depth=3, logistic=logistic, min_cover=1.0)
    one = trees.boost(blocks, layout, fills, 3, rules)
    many = trees.boost(cut, layout, fills, 3, rules)
    assert len(one) == len(many) == 4
    for a, b in zip(one, many):
        assert a.base == pytest.approx(b.base) and [shape(t) for t in a.trees] == [shape(t) for t in b.trees]
        assert np.allclose(np.concatenate([t.value for t in a.trees]), np.concatenate([t.value for t in b.trees]))
    assert len({str([shape(t) for t in e.trees]) for e in one}) == 4  # every fold left out gives another model


def test_boosting_learns(ready):
    layout, fills, blocks = ready
    b = blocks.first()
    e = trees.boost(blocks, layout, fills[-1:], 0, trees.Boosting(rounds=60, step=0.1))[0]
    p = e.of_codes(np.where(b.codes == layout.bins, fills[-1].bins(layout), b.codes))
    assert ((p > 0) == (b.y == 1)).mean() > 0.8


def test_forest_is_the_same_wherever_its_nodes_are_grown(ready, cut):
    layout, fills, blocks = ready
    rules = trees.Forest(5, min_rows=4, columns="sqrt")
    whole = trees.grow_forests(blocks, layout, fills, 3, rules)
    parts = trees.grow_forests(cut, layout, fills, 3, rules, local_rows=60, cells=3000)
    for a, b in zip(whole, parts):
        assert [canonical(t) for t in a.trees] == [canonical(t) for t in b.trees]
    assert max(len(t.column) for t in whole[-1].trees) > 40  # no depth limit


def test_class_weights_are_those_of_each_bootstrap(ready):
    block = ready[2].first()
    seen = set()
    for tree in range(20):
        c = trees.bootstrap_counts(block.key, tree, 42)
        sizes = np.array([c[block.y == 0].sum(), c[block.y == 1].sum()])
        w = trees.bootstrap_weights(c, block.y, sizes)
        for k in (0, 1):
            assert w[block.y == k].sum() == pytest.approx(c.sum() / 2)
        assert np.allclose(w, c * np.where(block.y == 1, sizes.sum() / (2 * sizes[1]), sizes.sum() / (2 * sizes[0])))
        seen.add(tuple(sizes))
        assert abs(c.mean() - 1) < 0.25
    assert len(seen) > 10


@pytest.mark.parametrize("kind", ["boosted", "forest", "regression"])
def test_saved_trees_score_the_same_and_their_contributions_add_up(table, ready, tmp_path, kind):
    df, _ = table
    layout, fills, blocks = ready
    e = (trees.grow_forests(blocks, layout, fills[-1:], 0, trees.Forest(4, 4, 1.0)) if kind == "forest" else
         trees.boost(blocks, layout, fills[-1:], 0, trees.Boosting(rounds=5, step=0.3, logistic=kind == "boosted")))[0]
    PipelineModel([modelling.TreeModel(e, kind)]).write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    unseen = df.withColumn("c", F.when(F.col("customer_id") < 5, F.lit("never seen")).otherwise(F.col("c")))
    a, b = (m.transform(unseen).orderBy("customer_id").collect() for m in (PipelineModel([modelling.TreeModel(e, kind)]), again))
    assert a == b
    rows = explain.tree_contributions(unseen, again.stages[0].ensemble, 100).toPandas()
    assert np.allclose(rows.base + rows.contribution_sum, rows.margin)
    if kind != "regression":
        shown = {r.customer_id: float(r.probability[1]) for r in a}
        margin = rows.groupby("customer_id").margin.first()
        assert all(p == pytest.approx(margin[i] if kind == "forest" else 1 / (1 + np.exp(-margin[i]))) for i, p in shown.items())


def test_hold_out_and_folds_are_stratified(spark):
    df = spark.createDataFrame([(i, None if i % 50 == 0 else float(i % 7 == 0)) for i in range(1003)], "customer_id long, label double")
    marked = evaluation.hold_out(df, "customer_id").toPandas()
    sizes = marked.groupby("label", dropna=False).is_test.agg(["size", "sum"])
    assert sizes["sum"].sum() == 201 and (abs(sizes["sum"] - sizes["size"] * 201 / 1003) < 1).all()
    folds = evaluation.fold_column(df, 5).toPandas()
    counts = folds.groupby(["label", "fold"], dropna=False).size().unstack()
    assert ((counts.max(axis=1) - counts.min(axis=1)) <= 1).all() and folds.groupby("fold").size().sum() == 1003
    again = evaluation.hold_out(df.repartition(7), "customer_id").toPandas()
    assert set(again[again.is_test].customer_id) == set(marked[marked.is_test].customer_id)


def test_auc_of_each_fold(spark):
    rows = [(f, float(y), s) for f, y, s in [(0, 1, .9), (0, 0, .1), (0, 0, .9), (1, 1, .2), (1, 0, .3), (1, 1, .4), (2, 1, .5)]]
    df = spark.createDataFrame(rows, "fold int, label double, score double")
    got = {r.fold: r.roc_auc for r in evaluation.roc_auc_by(df, "fold").collect()}
    assert got == {0: .75, 1: .5, 2: 0.0}


def test_inputs_leave_out_what_training_adds(spark):
    df = spark.createDataFrame([(1, 1, 2.0, 1.0, 0, True, 1.0)], "customer_id long, churned int, age double, label double, fold int, is_test boolean, weight double")
    assert churn.inputs(df) == (["age"], [])


# --- k-means ----------------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def points(spark):
    dice = np.random.default_rng(8)
    x = np.concatenate([dice.normal(m, .4, (60, 10)) for m in (-3, 0, 2, 5)])
    x = (x - x.mean(0)) / x.std(0)
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "customer_id long, " + ", ".join(f"{c} double" for c in segments.INPUTS))
    return df.repartition(4), x


def separate(x, centres, tolerance=segments.TOLERANCE, iterations=segments.ITERATIONS):
    """One model at a time, written out."""
    limit = tolerance * x.var(0).mean()
    for step in range(iterations):
        near = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        new = np.array([x[near == k].mean(0) if (near == k).any() else centres[k] for k in range(len(centres))])
        moved = ((new - centres) ** 2).sum()
        centres = new
        if moved <= limit:
            break
    return centres, ((x[:, None] - centres[None]) ** 2).sum(2).min(1).sum(), step + 1


def test_models_moved_together_end_where_separate_ones_do(points):
    df, x = points
    blocks = segments.point_blocks(df)
    models = [(k, r) for k in range(2, 8) for r in range(6)]
    starts = segments.first_centres(blocks, models, 42)
    assert all(len(np.unique(s, axis=0)) == k for (k, _), s in zip(models, starts))
    assert all((np.abs(s[:, None] - x[None]).max(2).min(1) < 1e-12).all() for s in starts)
    for found, start in zip(segments.lloyd(blocks, models, starts), starts):
        centres, cost, steps = separate(x, start)
        assert found.cost == pytest.approx(cost) and np.allclose(found.points, centres) and found.iterations == steps
    best = segments.fit_kmeans(blocks, [4], 30)[4]
    truth = sum(((x[i:i + 60] - x[i:i + 60].mean(0)) ** 2).sum() for i in range(0, 240, 60))
    assert best.cost == pytest.approx(truth)


def test_first_centres_are_drawn_by_squared_distance(spark):
    """Two points far from the rest: the second centre is nearly always the far group, in proportion to its weight."""
    rows = [(i, *([0.0] * 10)) for i in range(50)] + [(100, *([3.0] + [0.0] * 9)), (101, *([1.0] + [0.0] * 9))]
    df = spark.createDataFrame(rows, "customer_id long, " + ", ".join(f"{c} double" for c in segments.INPUTS))
    starts = segments.first_centres(segments.point_blocks(df), [(2, r) for r in range(400)], 1)
    drawn = [s[1][0] for s in starts if s[0][0] == 0.0]
    assert len(drawn) > 300 and set(drawn) == {1.0, 3.0}
    assert np.mean([d == 3.0 for d in drawn]) == pytest.approx(0.9, abs=0.06)


def test_silhouettes_by_definition(points):
    df, x = points
    models = {k: x[:k] for k in (2, 5)}
    got = segments.silhouettes(df, models)
    for k, centres in models.items():
        y = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        apart = np.linalg.norm(x[:, None] - x[None], axis=2)
        want = []
        for i in range(len(x)):
            own = y == y[i]
            a, b = apart[i, own].sum() / max(own.sum() - 1, 1), min(apart[i, y == c].mean() for c in set(y) - {y[i]})
            want.append((b - a) / max(a, b) if own.sum() > 1 else 0.0)
        assert got[k] == pytest.approx(np.mean(want), abs=1e-6)
    assert set(segments.silhouettes(df, models, size=50)) == {2, 5}


def test_segmentation_is_saved_and_places_new_customers(points, spark, tmp_path):
    df, x = points
    holes = df.withColumn(segments.INPUTS[3], F.when(F.col("customer_id") % 9 > 0, F.col(segments.INPUTS[3])))
    found = segments.segment_customers(holes, [2, 4], 5)
    assert found.best_k == 4 and found.customers.count() == 240
    found.model.save(spark, str(tmp_path / "m"))
    again = segments.SegmentModel.load(spark, str(tmp_path / "m"))
    assert again == found.model
    columns = ["customer_id", "cluster_id", "cluster_name", "pca_1", "pca_2"]
    assert sorted(again.place(holes).select(columns).collect()) == sorted(found.customers.select(columns).collect())
    z = segments.z_scores(holes).toPandas().sort_values("customer_id")[segments.INPUTS]
    frame = holes.toPandas().sort_values("customer_id")[segments.INPUTS]
    filled = frame.fillna(frame.median())
    assert np.allclose(z, (filled - filled.mean()) / filled.std(ddof=0))


def test_naming_rules_in_order(spark):
    medians = dict.fromkeys(segments.INPUTS, 10.0)
    base = dict.fromkeys(segments.INPUTS, 10.0)
    cases = [({}, "High-Value Loyal"), ({"engagement_score": 9.0, "failed_payment_rate": 11.0}, "At-Risk Low-Engagement"),
             ({"engagement_score": 9.0, "avg_customer_satisfaction": 9.0}, "At-Risk Low-Engagement"),
             ({"customer_lifetime_value": 9.0, "customer_tenure_days": 9.0}, "New / Developing"), ({"failed_payment_rate": 11.0}, "Billing-Fragile"),
             ({"customer_lifetime_value": 9.0, "support_ticket_count_90d": 11.0}, "Support-Intensive"), ({"customer_lifetime_value": 9.0}, "Core Mainstream"),
             ({"engagement_score": 9.0, "avg_customer_satisfaction": None}, "Core Mainstream")]
    rows = [(i, *(({**base, **change})[c] for c in segments.INPUTS)) for i, (change, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, "cluster_id int, " + ", ".join(f"{c} double" for c in segments.INPUTS))
    got = {r.cluster_id: r.cluster_name for r in segments.name_segments(df, df, medians=medians).collect()}
    assert got == {i: f"{name} (C{i})" for i, (_, name) in enumerate(cases)}


def test_boosting_in_a_task_of_several_blocks_is_that_of_a_job_a_level(ready, cut):
    layout, fills, _ = ready
    rules = trees.Boosting(rounds=trees.REFRESH + 2, step=0.2, depth=3, min_cover=1.0)
    one = trees.boost(cut, layout, fills, 3, rules)  # few rows, so each model is one task although there are five blocks
    many = trees.boost(cut, layout, fills, 3, rules, one_task=False)
    for a, b in zip(one, many):
        assert [shape(t) for t in a.trees] == [shape(t) for t in b.trees]
        assert np.allclose(np.concatenate([t.value for t in a.trees]), np.concatenate([t.value for t in b.trees]))


def test_forests_of_single_tasks_are_written_and_not_held_by_the_driver(ready, spark, tmp_path):
    layout, fills, blocks = ready
    b = blocks.first()
    for columns, balanced in (("sqrt", True), (0.8, False)):
        e = trees.grow_forests(blocks, layout, fills[-1:], 0, trees.Forest(4, 4, columns, balanced=balanced))[0]
        assert isinstance(e.trees, trees.StoredTrees) and len(e.trees) == 4 and len(e.trees[3].column) > 10
        modelling.TreeModel(e, "forest").write().save(str(tmp_path / str(columns)))
        again = modelling.TreeModel.load(str(tmp_path / str(columns))).ensemble
        assert isinstance(again.trees, trees.StoredTrees)
        assert np.array_equal(again.of_codes(b.codes), e.of_codes(b.codes))
        bare = trees.shared(e, bare=True)  # what is broadcast to score
        assert np.array_equal(bare.of_codes(b.codes), e.of_codes(b.codes)) and sum(map(len, bare.trees.packed)) < sum(map(len, e.trees.held().packed))


def test_a_node_sees_the_sums_of_its_rows_in_every_form(ready):
    """Counts side by side in one number, and plain sums where they do not fit, give the same tree."""
    layout, fills, blocks = ready
    b = blocks.first()
    splitter = trees.Splitter(layout, trees.Growth(min_rows=4, columns_per_node="sqrt"))
    count = trees.bootstrap_counts(b.key, 0, 42)
    sizes = np.array([count[b.y == 0].sum(), count[b.y == 1].sum()])
    grown = []
    for kind in ("classes", "weights"):
        held = trees._Rows(b.y, count, sizes)
        if kind == "weights":
            held.kind, weight = kind, trees.bootstrap_weights(count, b.y, sizes)
            held.held = [np.ones(len(b.y)), weight, weight * b.y]
        grown.append(trees._grow_here(trees._filled(b.codes, splitter, fills[-1].bins(layout)), held, splitter, fills[-1].bins(layout),
                                      lambda paths: splitter.tries((42, 0), paths, "sqrt"), (0.0, 1.0), True))
    assert shape(grown[0]) == shape(grown[1]) and np.allclose(grown[0].cover, grown[1].cover) and len(grown[0].column) > 20


def test_drawn_columns_are_those_of_a_generator_for_each_node(ready):
    splitter = trees.Splitter(ready[0], trees.Growth())
    paths = np.array([1, 2, 3, 1 << 33, (1 << 63) - 5], np.uint64)
    for seed in ((42, 7), (-1, 7)):
        assert np.array_equal(splitter.tries(seed, paths, "sqrt"), [splitter.open_columns([*seed, int(p)], "sqrt") for p in paths])


def test_short_and_long_paths_give_the_same_contributions(monkeypatch):
    dice = np.random.default_rng(1)
    x = dice.integers(0, 5, (60, 4)).astype(float)
    paths = [(dice.normal(), [(int(f), float(dice.uniform(.1, .9)), (True, float(dice.integers(0, 5)), bool(dice.integers(2)))) for f in dice.integers(0, 4, 5)])
             for _ in range(20)]
    short, base = explain.shapley(x, paths)
    monkeypatch.setattr(explain, "PATTERN_FEATURES", 0)
    long, same = explain.shapley(x, paths)
    assert np.allclose(short, long) and base == same


def test_a_block_is_measured_in_slices(monkeypatch, spark):
    x = np.random.default_rng(2).normal(size=(50, 10))
    blocks = spark.sparkContext.parallelize([(np.arange(50, dtype=np.uint64), x)], 1)
    starts = [x[:3], x[5:7]]
    whole = segments.lloyd(blocks, [(3, 0), (2, 0)], starts)
    assert segments.SLICE_ROWS * 810 * 8 < 30e6  # squares of a slice against the centres of 180 models
    monkeypatch.setattr(segments, "SLICE_ROWS", 7)
    for a, b in zip(whole, segments.lloyd(blocks, [(3, 0), (2, 0)], starts)):
        assert np.allclose(a.points, b.points) and a.cost == pytest.approx(b.cost)
