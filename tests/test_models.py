"""Features, split, preprocessing, classifiers and metrics."""

from __future__ import annotations

import math
import random
import statistics

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from orderlens.models import features, forest, metrics, newton, training
from orderlens.operators.storage import store


@pytest.fixture(scope="module")
def table(spark):
    """Label from x with noise; levels of c; z missing in places."""
    rng = random.Random(5)
    rows = []
    for i in range(400):
        x, c = rng.gauss(0, 3), rng.choice("abc")
        p = 1 / (1 + math.exp(-(0.8 * x - 1 + (c == "a"))))
        rows.append((str(i), int(rng.random() < p), x, None if i % 50 == 0 else float(i), c))
    return spark.createDataFrame(rows, "id string, label int, x double, z double, c string").cache()


def test_split_is_stable_and_stratified(table):
    train, test = training.split(table, "id")
    sizes = {r[0]: r[1] for r in table.groupBy("label").count().collect()}
    parts = {r[0]: r[1] for r in test.groupBy("label").count().collect()}
    assert parts == {label: int(0.25 * n + 0.5) for label, n in sizes.items()}
    ids = {r["id"] for r in test.collect()}
    assert ids.isdisjoint(r["id"] for r in train.collect()) and train.count() + len(ids) == 400
    again = {r["id"] for r in training.split(table.repartition(3), "id")[1].collect()}
    assert again == ids
    shares = {r["side"]: r["rows_n"] for r in training.split_shares(table, "id").collect()}
    assert shares == {"train": train.count(), "test": test.count()}


def test_split_of_few_rows(spark):
    few = spark.createDataFrame([("a", 1), ("b", 0), ("c", 0), ("d", None)], "id string, label int")
    train, test = training.split(few, "id")
    assert train.count() == 2 and [r["label"] for r in test.collect()] == [0]


def test_forest_does_not_depend_on_partitions(spark, table):
    name, scores = "spark.sql.shuffle.partitions", []
    before = spark.conf.get(name)
    try:
        for parts in ("8", "16"):
            spark.conf.set(name, parts)
            fitted = training.fit_forest(table.repartition(int(parts)), "id", ["c"], trees=10)
            scores.append({r["id"]: r["probability"] for r in fitted.scores.collect()})
    finally:
        spark.conf.set(name, before)
    assert scores[0] == scores[1]


def test_missing_category_is_a_level(table):
    from pyspark.sql import functions as F

    gaps = table.withColumn("c", F.when(F.col("c") != "b", F.col("c")))
    fitted = training.fit_logistic(gaps, "id", ["c"])
    assert fitted.feature_names[2:] == ["c_(missing)", "c_a", "c_c"]


def test_unknown_text_is_no_feature(table):
    from pyspark.sql import functions as F

    fitted = training.fit_logistic(table.withColumn("city", F.lit("Berlin")), "id", ["c"])
    assert "city" not in fitted.feature_names


def test_weights_balance_the_classes(table):
    sizes = training.class_sizes(table)
    sums = training.with_balance(table, sizes).groupBy("label").sum(training.WEIGHT).collect()
    assert [r[1] for r in sums] == pytest.approx([200, 200])
    with pytest.raises(ValueError):
        training.class_sizes(table.where("label = 1"))


def vectors(train, rows, scaled):
    n = train.count()
    stages = training.preprocessing(["x", "z"], ["c"], n if scaled else None)
    model = Pipeline(stages=stages).fit(train)
    out = model.transform(rows).select("id", vector_to_array("features").alias("v")).collect()
    return model, {r["id"]: r["v"] for r in out}


def test_scaling_uses_population_deviation_and_mean_for_missing(table):
    model, got = vectors(table, table, scaled=True)
    rows = table.collect()
    xs = [r["x"] for r in rows]
    mean, deviation = statistics.fmean(xs), statistics.pstdev(xs)
    for r in rows:
        assert got[r["id"]][0] == pytest.approx((r["x"] - mean) / deviation)
        if r["z"] is None:
            assert got[r["id"]][1] == pytest.approx(0, abs=1e-9)
    assert training.feature_names(model, ["x", "z"], ["c"]) == ["x", "z", "c_a", "c_b", "c_c"]


def test_unseen_level_becomes_zeros(spark, table):
    new = spark.createDataFrame([("n", 0, 1.0, 2.0, "d"), ("m", 0, 1.0, 2.0, None)], table.schema)
    _, got = vectors(table, new, scaled=False)
    assert got == {"n": [1.0, 2.0, 0.0, 0.0, 0.0], "m": [1.0, 2.0, 0.0, 0.0, 0.0]}


def test_logistic_regression_solves_the_penalised_problem(table):
    """The gradient of sum(weight * loss) + |w|^2 / 2 vanishes at the fitted model."""
    fitted = training.fit_logistic(table, "id", ["c"])
    train, _ = training.split(table, "id")
    rows = fitted.stages.transform(training.with_balance(train, training.class_sizes(train)))
    data = rows.select("label", training.WEIGHT, vector_to_array("features").alias("v")).collect()
    x = np.array([r["v"] for r in data])
    y = np.array([r["label"] for r in data])
    weight = np.array([r[training.WEIGHT] for r in data])
    w = fitted.weights
    error = weight * (1 / (1 + np.exp(-(x @ w + fitted.intercept))) - y)
    assert np.abs(x.T @ error + w).max() < 1e-9
    assert abs(error.sum()) < 1e-9
    top = training.coefficients(fitted, 3).collect()
    assert len(top) == 3 and top[0]["feature"] == "x" and top[0]["coefficient"] > 0


def test_scores_repeat(table):
    first = training.fit_logistic(table, "id", ["c"]).scores.orderBy("id").collect()
    second = training.fit_logistic(table, "id", ["c"]).scores.orderBy("id").collect()
    assert [(r["id"], r["prediction"]) for r in first] == [(r["id"], r["prediction"]) for r in second]
    assert [r["probability"] for r in first] == pytest.approx([r["probability"] for r in second])


def test_forest_learns(table):
    fitted = training.fit_forest(table, "id", ["c"], trees=10, max_depth=5)
    row = metrics.summary(fitted.scores, "forest").first()
    assert 0.6 < row["auc"] <= 1 and row["rows_n"] == fitted.scores.count()
    top = training.importances(fitted).collect()
    assert top[0]["feature"] == "x" and sum(r["importance"] for r in top) == pytest.approx(1)


def scored(spark, rows):
    return spark.createDataFrame(rows, "label int, prediction int, probability double")


def test_auc_counts_ties_half(spark):
    rows = [(1, 1, 0.9), (0, 0, 0.5), (1, 0, 0.5), (0, 0, 0.1)]
    assert metrics.roc_auc(scored(spark, rows)) == pytest.approx(3.5 / 4)


def test_auc_against_all_pairs(spark):
    rng = random.Random(2)
    rows = [(int(rng.random() < 0.3), 0, rng.randrange(40) / 40) for _ in range(900)]
    pairs = [(a > b) + (a == b) / 2 for y, _, a in rows if y for z, _, b in rows if not z]
    assert metrics.roc_auc(scored(spark, rows).repartition(6)) == pytest.approx(sum(pairs) / len(pairs), abs=1e-12)
    assert metrics.roc_auc(scored(spark, [(1, 1, 0.5)])) is None
    assert metrics.auc_table(scored(spark, rows).where("label = 7")).first()["auc"] is None


def test_report_with_a_class_never_predicted(spark):
    rows = [(0, 0, 0.1)] * 3 + [(1, 0, 0.2)]
    table = {r["class"]: r for r in metrics.class_report(scored(spark, rows)).collect()}
    assert (table["1"]["precision"], table["1"]["recall"], table["1"]["f1"], table["1"]["support"]) == (0, 0, 0, 1)
    assert (table["0"]["precision"], table["0"]["recall"], table["0"]["f1"]) == (0.75, 1.0, 0.857)
    assert (table["accuracy"]["f1"], table["accuracy"]["support"]) == (0.75, 4)
    assert table["macro avg"]["recall"] == 0.5 and table["weighted avg"]["recall"] == 0.75
    cells = {r["label"]: (r["predicted_0"], r["predicted_1"]) for r in metrics.confusion(scored(spark, rows)).collect()}
    assert cells == {0: (3, 0), 1: (1, 0)}


def test_churn_features_fill_only_order_columns(spark, orders_of):
    customers = spark.createDataFrame(
        [("a", 1, "2023-01-01", 5.0, "F"), ("b", 0, "2023-06-01", 9.0, "M")],
        "customer_id string, churn_label int, registration_date string, lifetime_value double, gender string",
    )
    behavior = spark.createDataFrame(
        [("a", 3.0, 0.5)], "customer_id string, visits double, behavior_churn_signal double"
    )
    orders = orders_of(
        [("1", "a", "2024-01-01", "10"), ("2", "a", "2024-01-11", "20"), ("3", None, "2024-01-31", "1")],
        discount_applied=0.5, shipping_delay_days=2, fraud_label=1,
    )
    got = {r["customer_id"]: r for r in features.churn_features(customers, behavior, orders).collect()}
    assert set(got["a"].asDict()) == {
        "customer_id", "gender", "visits", "reg_tenure_days", "label", *features.ORDER_FEATURES,
    }
    a, b = got["a"], got["b"]
    assert (a["orders_n"], a["aov"], a["recency_days"], a["tenure_days"]) == (2, 15.0, 20, 10)
    assert (b["orders_n"], b["recency_days"], b["visits"]) == (0, 0, None)
    assert b["reg_tenure_days"] == 244
    numbers, listed = features.column_kinds(features.churn_features(customers, behavior, orders), "customer_id", ["gender", "country"])
    assert listed == ["gender"] and "gender" not in numbers and "visits" in numbers


def test_constant_and_equal_features_have_an_optimum(spark):
    """A constant column, one given twice, and classes that one column parts."""
    rows = [(float(k % 2), 1.0, float(k), float(k), 1.0) for k in range(60)]
    df = spark.createDataFrame(rows, "label double, weight double, a double, b double, c double")
    from pyspark.sql import functions as F

    for features in (["a", "b", "c"], ["label", "a"]):
        data = df.select(F.col("label").cast("int").alias("label"), "weight", F.array(*features).alias("features"))
        weights, intercept = newton.fit(data, len(features))
        loss, gradient, _ = newton.sums(data, np.append(weights, intercept))
        assert np.abs(gradient + np.append(weights, 0)).max() < 1e-9 and np.isfinite(loss)


def brute_tree(x, y, times, tree, node, settings, names=()):
    """(feature, threshold bin, left, right) or a probability, by trying every cut of every tried feature."""
    w = settings.weights
    a, b = (times * (y == 0)).sum() * w[0], (times * (y == 1)).sum() * w[1]
    if a == 0 or b == 0 or node.bit_length() - 1 >= settings.max_depth:
        return b / (a + b), {}
    rank = forest.feature_order(tree, np.array([node]), x.shape[1], settings.seed)[0]

    def impurity(part):
        p, q = (times[part] * (y[part] == 0)).sum() * w[0], (times[part] * (y[part] == 1)).sum() * w[1]
        return 2 * p * q / (p + q) if p + q else 0

    for tried in (rank < settings.tried, rank >= settings.tried):
        best = None
        for f in np.flatnonzero(tried):
            for cut in range(forest.BINS - 1):
                left = x[:, f] <= cut
                if times[left].sum() and times[~left].sum():
                    gain = 2 * a * b / (a + b) - impurity(left) - impurity(~left)
                    if best is None or gain > best[0] + 1e-9:
                        best = (gain, f, cut)
        if best:
            gain, f, cut = best
            left = x[:, f] <= cut
            one, g1 = brute_tree(x[left], y[left], times[left], tree, 2 * node, settings)
            two, g2 = brute_tree(x[~left], y[~left], times[~left], tree, 2 * node + 1, settings)
            gains = {k: g1.get(k, 0) + g2.get(k, 0) for k in {*g1, *g2}}
            gains[f] = gains.get(f, 0) + gain
            return (f, cut, one, two), gains
    return b / (a + b), {}


def brute_score(tree, row):
    while isinstance(tree, tuple):
        tree = tree[3] if row[tree[0]] > tree[1] else tree[2]
    return tree


@pytest.mark.parametrize("handed", [3, 40, 10_000])
def test_forest_equals_brute_force_for_any_group_size(spark, handed):
    """Both phases, and every split between them, give the trees that trying all cuts gives."""
    rng = random.Random(8)
    rows = []
    for i in range(240):
        x = [float(rng.randrange(5)), float(rng.randrange(3)), rng.choice([0.0, 1.0]), 7.0, float(i % 2)]
        rows.append((rng.getrandbits(62), int(x[0] + x[2] + rng.random() > 3), x))
    data = store(spark.createDataFrame(rows, "key long, label int, features array<double>").repartition(4), "rows")
    grown = forest.fit(data, 5, 6, (0.75, 1.5), 30, 42, handed)
    assert any(u.splits for u in grown.upper) == (handed < 240)
    x = np.array([[np.searchsorted(e, v) for e, v in zip(grown.edges, r[2])] for r in rows])
    y, keys = np.array([r[1] for r in rows]), np.array([r[0] for r in rows])
    want, shares = np.zeros(len(rows)), np.zeros(5)
    for t in range(6):
        times = forest.bootstrap(keys, t, 42)
        kept = times > 0
        tree, gains = brute_tree(x[kept], y[kept], times[kept], t, 1, grown.settings)
        want += [brute_score(tree, r) for r in x]
        shares += np.array([gains.get(f, 0) for f in range(5)]) / sum(gains.values())
    got = {r["key"]: r["probability"] for r in forest.score(grown, data).collect()}
    assert [got[k] for k in keys.tolist()] == pytest.approx((want / 6).tolist())
    assert grown.importances.tolist() == pytest.approx((shares / 6).tolist()) and grown.importances.sum() == pytest.approx(1)


def test_groups_stay_within_their_bound(spark, monkeypatch):
    """A tree that parts a few rows at a time hands over no group above the bound; equal rows become a leaf."""
    rows = [(k, int(k % 50 == 0), [float(min(k, 60)), 1.0]) for k in range(600)]
    data = store(spark.createDataFrame(rows, "key long, label int, features array<double>"), "rows")
    grown = forest.fit(data, 2, 3, (1.0, 1.0), 30, 1, handed=30)
    k = grown.settings.features
    dealt = forest._dealt(store(forest.binned(data, grown.edges, ["key", "label"]), "b"), grown.upper, ["label"], k, lambda key, tree: forest.bootstrap(key, tree, 1))
    sizes = {}
    for r in dealt.collect():
        sizes[r["tree"], r["node"]] = sizes.get((r["tree"], r["node"]), 0) + sum(r["times"])
    assert sizes and max(sizes.values()) <= 30
    assert any(u.leaves for u in grown.upper)
    assert all(0 <= r["probability"] <= 1 for r in forest.score(grown, data).collect())


def test_subtrees_are_completed_by_many_tasks(spark):
    """Few bytes, much work: the groups are not packed into one task by their size."""
    rows = [(k, int(k % 7 == 0), [float(k % 11), float(k % 5)]) for k in range(300)]
    data = store(spark.createDataFrame(rows, "key long, label int, features array<double>"), "rows")
    grown = forest.fit(data, 2, 24, (1.0, 1.0), 30, 1)
    files = grown.subtrees.select("tree", F.input_file_name().alias("file")).collect()
    assert len(files) == 24 and len({r["file"] for r in files}) > 6


def test_forest_of_one_feature_and_trees_without_rows(spark):
    rows = [(k, k % 2, [float(k)]) for k in range(4)]
    data = store(spark.createDataFrame(rows, "key long, label int, features array<double>"), "rows")
    grown = forest.fit(data, 1, 60, (1.0, 1.0), 30, 1, handed=1)
    empty = [t for t in range(60) if not forest.bootstrap(np.arange(4), t, 1).any()]
    assert empty and all(grown.upper[t].handed == {1} for t in empty)
    assert len(forest.score(grown, data).collect()) == 4


@pytest.mark.parametrize("cached", [1, 50, 10_000])
def test_splits_of_sorted_rows_equal_those_of_full_histograms(monkeypatch, cached):
    monkeypatch.setattr(forest, "CACHED_ROWS", cached)
    rng = np.random.default_rng(4)
    sizes = np.array([1, 40, 3, 200, 2])
    node = np.repeat(np.arange(5), sizes)
    bins = np.stack([rng.integers(0, w, len(node)) for w in (64, 2, 1, 9, 2)], axis=1).astype(np.uint8)
    label, times = rng.integers(0, 2, len(node)), rng.integers(1, 4, len(node)).astype(float)
    both = np.bincount(2 * node + label, times, 10).reshape(5, 2).T
    tried = np.array([[0, 1], [1, 2], [3, 4], [0, 3], [2, 4]])
    got = forest.splits_of(forest.Rows(bins, label, times, sizes, both), tried, np.array([64, 2, 1, 9, 2]), (0.7, 3.0))
    for i in range(5):
        best = (-1.0, -1, 0)
        for f in tried[i]:
            cell = (bins[node == i, f].astype(int)) * 2 + label[node == i]
            counts = np.bincount(cell, times[node == i], forest.BINS * 2).reshape(1, forest.BINS, 2)
            gain, cut = forest.best_splits(counts, (0.7, 3.0))
            if gain[0] > best[0]:
                best = (gain[0], f, cut[0])
        assert (got[0][i], got[1][i], got[2][i]) == best


def mixed_rows(n, wide, narrow, seed=3):
    """Features of many, two and one values, some parting the classes; equal rows in both classes."""
    rng = np.random.default_rng(seed)
    x = np.hstack([rng.integers(0, 90, (n, wide)), rng.integers(0, 2, (n, narrow)), np.full((n, 1), 4)]).astype(float)
    label = (x[:, 0] + 30 * x[:, wide] + rng.integers(0, 60, n) > 110).astype(int)
    x[n // 2 :], label[n // 2 :] = x[: n - n // 2], np.where(rng.random(n - n // 2) < 0.2, 1 - label[: n - n // 2], label[: n - n // 2])
    return [(int(mixed), int(y), row.tolist()) for mixed, y, row in zip(forest.mixed(np.arange(n, dtype=np.uint64)).view(np.int64), label, x)]


@pytest.mark.parametrize("wide,narrow,words", [(2, 3, 2), (9, 70, 4)])
@pytest.mark.parametrize("handed", [90, 10_000])
def test_compiled_subtrees_equal_those_of_numpy(spark, wide, narrow, words, handed):
    rows, k = mixed_rows(700, wide, narrow), wide + narrow + 1
    data = store(spark.createDataFrame(rows, "key long, label int, features array<double>").repartition(3), "rows")
    grown = forest.fit(data, k, 4, (0.7, 2.5), 30, 9, handed)
    assert forest.layout(grown.edges).words == words and any(u.splits for u in grown.upper) == (handed < 700)
    bins = np.array([[np.searchsorted(e, v) for e, v in zip(grown.edges, r[2])] for r in rows]).astype(np.uint8)
    label, keys = np.array([r[1] for r in rows]), np.array([r[0] for r in rows])
    found = {(r["tree"], r["node"]): r for r in grown.subtrees.collect()}
    for tree, top in enumerate(grown.upper):
        times, at = forest.bootstrap(keys, tree, 9), top.nodes(bins)
        assert {node for t, node in found if t == tree} == {*at[times > 0].tolist()} & top.handed
        for node in {*at[times > 0].tolist()} & top.handed:
            own = (at == node) & (times > 0)
            want = forest.grow(bins[own], label[own], times[own], tree, node, grown.settings)
            got = forest.unpacked(found[tree, node]["subtree"])
            assert len(got["feature"]) == len(want["feature"])
            assert (forest.leaf_probability(got, bins) == forest.leaf_probability(want, bins)).all()
            assert found[tree, node]["importance"] == pytest.approx(want["importance"].tolist())


def test_packed_rows_keep_every_bin():
    """A feature of more than two values takes a byte, any other a bit: rows of 51 features are 16 bytes, not 51 and more."""
    rng = np.random.default_rng(2)
    edges = [np.arange(w - 1) + 0.5 for w in [64, 2, 11, 1, 8, 60, 64, 50, 64, *[2] * 42]]
    plan = forest.layout(edges)
    bins = np.stack([rng.integers(0, len(e) + 1, 200) for e in edges], axis=1).astype(np.uint8)
    label = rng.integers(0, 2, 200).astype(np.uint8)
    words = plan.packed(bins, label).view("<u8")
    assert words.shape == (200, 2) and ((words[:, 0] & 255) == label * 128).all()
    for f, place in enumerate(plan.place.tolist()):
        assert ((words[:, place // 64] >> np.uint64(place % 64) & np.uint64(255 if plan.width[f] > 2 else 1)) == bins[:, f]).all()


def test_weights_of_rows_by_whole_numbers():
    """The compiled bootstrap compares with the last number that the divided one lets pass."""
    for share, last in zip(forest._CDF.tolist(), forest._LARGEST.tolist()):
        at = np.array([last, last + 1], dtype=np.uint64) / 2.0**64
        assert at[0] <= share < at[1]


def test_scores_do_not_depend_on_blocks_and_parts(spark, monkeypatch):
    """Rows that ask one subtree in several groups, and a part in several pieces, are each answered once."""
    rows = mixed_rows(500, 2, 3)
    data = store(spark.createDataFrame(rows, "key long, label int, features array<double>").repartition(5), "rows")
    grown = forest.fit(data, 6, 5, (0.7, 2.5), 30, 9, 120)
    want = {r["key"]: r["probability"] for r in forest.score(grown, data).collect()}
    assert len(want) == 500 and any(u.leaves or len(u.handed) > 1 for u in grown.upper)
    monkeypatch.setattr(forest, "ASKED", 20)
    monkeypatch.setattr(forest, "PART_ROWS", 7)
    got = forest.score(grown, data).collect()
    assert len(got) == 500 and {r["key"]: r["probability"] for r in got} == want


@pytest.mark.parametrize("name", ["churn", "fraud"])
def test_registered_forests_are_as_deep_as_those_of_the_jobs(name, monkeypatch):
    from registry import queries

    made = []
    monkeypatch.setattr(queries, f"{name}_table", lambda star: None)
    monkeypatch.setattr(training, "fit_forest", lambda *a, trees, max_depth=30, **b: made.append((trees, max_depth)))
    getattr(queries, f"{name}_trees")(None)
    assert made == [({"churn": 200, "fraud": 100}[name], 30)]
