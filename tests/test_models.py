"""Model fits against closed forms and brute force."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chamberlens.operators.boost import RegularizedBoosting
from chamberlens.operators.explain import forest_dependence, pdp_1d, pdp_2d, tree_nodes
from chamberlens.operators.metrics import regression_metrics
from chamberlens.operators.models import assembler, boost_estimator, fit, forest_estimator, linear_estimator, predict, standardize
from chamberlens.operators.rank import coefficients, feature_importance, pareto
from chamberlens.operators.search import BOOST_GRID, FOREST_GRID, boost_params, draw_params, forest_params, random_search
from chamberlens.operators.select import cumulative_selection
from chamberlens.plans.flows import aligned_exact, alignment_comparison, tuning_comparison
from chamberlens.operators.sample import holdout
from chamberlens.session import discard
from chamberlens.sources.event_sensors import sensor_and_quality

T0 = dt.datetime(2024, 1, 1)
COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 12, size=(300, 3)).astype(float)
    y = 3 * x[:, 0] - 2 * (x[:, 1] > 5) * x[:, 0] + 0.1 * rng.normal(size=300)
    return x, y


@pytest.fixture(scope="module")
def table(spark, data):
    x, y = data
    rows = [(T0 + dt.timedelta(minutes=i), *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "date_time timestamp_ntz, a double, b double, c double, quality double").cache()
    df.count()
    return df


def predictions(model, table):
    return np.array([r.yhat for r in model.transform(table).orderBy("date_time").select("yhat").collect()])


def test_linear_fit_matches_least_squares(table, data):
    x, y = data
    model = fit(linear_estimator(), standardize(table, COLUMNS)[0], COLUMNS).stages[-1]
    z = (x - x.mean(0)) / x.std(0)
    want = np.linalg.lstsq(np.c_[z, np.ones(len(z))], y, rcond=None)[0]
    got = {r.variable: r.coefficient for r in coefficients(model, COLUMNS).collect()}
    assert [got[c] for c in COLUMNS] == pytest.approx(list(want[:3]))
    assert model.intercept == pytest.approx(want[3])
    assert [abs(v) for v in got.values()] == sorted((abs(v) for v in got.values()), reverse=True)


def test_forest_beats_the_mean_and_ranks(table):
    model = fit(forest_estimator(trees=8, depth=5), table, COLUMNS)
    assert regression_metrics(predict(model, table)).first().r2 > 0.9
    importance = {r.variable: r.importance for r in feature_importance(model.stages[-1], COLUMNS).collect()}
    assert sum(importance.values()) == pytest.approx(1.0)
    assert importance["a"] > importance["b"] > importance["c"]
    shares = [r.cumul_pct for r in pareto(feature_importance(model.stages[-1], COLUMNS)).orderBy("position").collect()]
    assert shares == sorted(shares) and shares[-1] == 100.0


def test_gradient_boosting_beats_the_mean(table):
    model = fit(boost_estimator(rounds=8, depth=3, rate=0.3), table, COLUMNS)
    assert regression_metrics(predict(model, table)).first().r2 > 0.5


def brute_boost(x, y, rounds, depth, rate, lam, alpha, gamma, least):
    """Exact greedy boosting by enumeration of all cuts at data values."""
    def shrink(g):
        return math.copysign(max(abs(g) - alpha, 0.0), g)

    def score(g, h):
        return shrink(g) ** 2 / (h + lam)

    def grow(rows, grad, level):
        g, h = grad[rows].sum(), len(rows)
        node = {"w": -shrink(g) / (h + lam), "gain": 0.0}
        if level == depth:
            return node
        best = None
        for f in range(x.shape[1]):
            for cut in np.unique(x[rows, f])[1:]:
                left = rows[x[rows, f] < cut]
                right = rows[x[rows, f] >= cut]
                if min(len(left), len(right)) < least:
                    continue
                gain = score(grad[left].sum(), len(left)) + score(grad[right].sum(), len(right)) - score(g, h)
                if best is None or gain > best[0] + 1e-9:
                    best = gain, f, cut, left, right
        if best is None or best[0] <= 1e-6:
            return node
        gain, f, cut, left, right = best
        node.update(gain=gain, f=f, cut=cut, left=grow(left, grad, level + 1), right=grow(right, grad, level + 1))
        if gain < gamma and all("f" not in c for c in (node["left"], node["right"])):
            del node["f"]
        return node

    def walk(node, row):
        while "f" in node:
            node = node["left"] if row[node["f"]] < node["cut"] else node["right"]
        return node["w"]

    margin = np.full(len(y), y.mean())
    for _ in range(rounds):
        tree = grow(np.arange(len(y)), margin - y, 0)
        margin = margin + rate * np.array([walk(tree, r) for r in x])
    return margin


@pytest.mark.parametrize(
    "options",
    [
        dict(rounds=3, depth=2, rate=0.5, lam=1.0, alpha=0.0, gamma=0.0, least=1),
        dict(rounds=2, depth=3, rate=0.3, lam=5.0, alpha=20.0, gamma=400.0, least=20),
        dict(rounds=2, depth=2, rate=1.0, lam=0.5, alpha=0.0, gamma=1e9, least=1),
    ],
)
def test_boosting_matches_brute_force(table, data, options):
    x, y = data
    boost = RegularizedBoosting(
        inputCols=COLUMNS, rounds=options["rounds"], depth=options["depth"], rate=options["rate"], lam=options["lam"],
        alpha=options["alpha"], gamma=options["gamma"], minChildWeight=options["least"], subsample=1.0, colsample=1.0,
        refreshEvery=2,
    )
    got = predictions(boost.fit(table.repartition(3)), table)
    want = brute_boost(x, y, **options)
    assert got == pytest.approx(want, abs=1e-8)


def test_boosting_does_not_depend_on_partitions(table):
    boost = RegularizedBoosting(inputCols=COLUMNS, rounds=3, depth=3, rate=0.5, refreshEvery=2)
    one, five = (boost.fit(table.repartition(n)) for n in (1, 5))
    assert [(t.feature, t.bin) for t in one.trees] == [(t.feature, t.bin) for t in five.trees]
    assert [w for t in one.trees for w in t.weight] == pytest.approx([w for t in five.trees for w in t.weight], abs=1e-9)


def test_boosting_samples_rows_and_columns(table):
    model = RegularizedBoosting(inputCols=COLUMNS, rounds=3, depth=2, rate=0.5, subsample=0.5, colsample=0.4, refreshEvery=2).fit(table)
    assert all(len({f for f in t.feature if f >= 0}) <= 1 for t in model.trees)
    half = RegularizedBoosting(inputCols=COLUMNS, rounds=1, depth=1, rate=0.5, subsample=0.5, colsample=1.0).fit(table)
    assert len(half.trees) == 1
    assert sum(half.featureImportances) == pytest.approx(1.0)


def test_constant_target_boosts_to_itself(spark):
    df = spark.createDataFrame([(T0, float(i), 4.0) for i in range(20)], "date_time timestamp_ntz, a double, quality double")
    model = RegularizedBoosting(inputCols=["a"], rounds=2, depth=2).fit(df)
    assert set(predictions(model, df)) == {4.0}


def linear(df):
    return df.withColumn("yhat", 1 + 2 * F.col("a") - 3 * F.col("b"))


def test_dependence_of_a_line_is_a_line(table, data):
    x, _ = data
    curve = {r.value: r.pd for r in pdp_1d(linear, table, "a", [0.0, 1.0, 5.0]).collect()}
    base = 1 - 3 * x[:, 1].mean()
    assert curve == {v: pytest.approx(base + 2 * v) for v in (0.0, 1.0, 5.0)}
    plane = {(r.value_1, r.value_2): r.pd for r in pdp_2d(linear, table, "a", "b", ([0.0, 1.0], [2.0, 4.0])).collect()}
    assert plane == {(a, b): pytest.approx(1 + 2 * a - 3 * b) for a in (0.0, 1.0) for b in (2.0, 4.0)}


def test_forest_dependence_follows_the_trees(spark, table):
    model = fit(forest_estimator(trees=4, depth=4), table, COLUMNS)
    forest = model.stages[-1]
    points = [(float(a), float(b), float(c)) for a in range(0, 12, 3) for b in (2, 8) for c in (1, 7)]
    grids = {("a",): [(0.5,), (6.0,), (20.0,)], tuple(COLUMNS): points}
    got = {(r["features"], tuple(r["values"])): r["pd"] for r in forest_dependence(forest, COLUMNS, grids).collect()}

    # with every feature held the curve is the prediction itself
    frame = assembler(COLUMNS).transform(spark.createDataFrame(points, "a double, b double, c double"))
    for r in forest.transform(frame).collect():
        assert got["a,b,c", (r.a, r.b, r.c)] == pytest.approx(r.yhat)

    # with one feature held, a plain recursion over the saved nodes
    nodes, path = tree_nodes(forest)
    by_tree = {}
    for n in nodes.collect():
        by_tree.setdefault(n.tree, {})[n.id] = n
    discard(spark, path)

    def expect(tree, i, value):
        n = tree[i]
        if n.left < 0:
            return n.value
        if n.feature == 0:
            return expect(tree, n.left if value <= n.threshold else n.right, value)
        wl, wr = tree[n.left].weight, tree[n.right].weight
        return (wl * expect(tree, n.left, value) + wr * expect(tree, n.right, value)) / (wl + wr)

    for value in (0.5, 6.0, 20.0):
        want = np.mean([expect(t, 0, value) for t in by_tree.values()])
        assert got["a", (value,)] == pytest.approx(want)


def test_draws_are_different_and_repeatable():
    assert math.prod(map(len, FOREST_GRID.values())) == 1152 and math.prod(map(len, BOOST_GRID.values())) == 768000
    draws = draw_params(FOREST_GRID, 30)
    assert len({tuple(map(str, d.items())) for d in draws}) == 30
    assert draws == draw_params(FOREST_GRID, 30) != draw_params(FOREST_GRID, 30, seed=1)
    assert all(d[k] in FOREST_GRID[k] for d in draws for k in d)
    assert len(draw_params({"a": [1, 2], "b": [3]}, 50)) == 2


def test_drawn_values_reach_the_estimators():
    forest = forest_estimator()
    params = forest_params(forest, {"n_estimators": 7, "max_depth": None, "min_samples_split": 10, "min_samples_leaf": 2, "max_features": None, "bootstrap": False})
    assert {p.name: v for p, v in params.items()} == {
        "numTrees": 7, "maxDepth": 30, "minInstancesPerNode": 5, "featureSubsetStrategy": "all", "bootstrap": False,
    }
    boost = RegularizedBoosting(inputCols=["a"])
    drawn = {p.name for p in boost_params(boost, draw_params(BOOST_GRID, 1)[0])}
    assert drawn == {"rounds", "depth", "rate", "subsample", "colsample", "minChildWeight", "gamma", "alpha", "lam"}


def test_search_picks_the_better_forest(table):
    forest = forest_estimator()
    maps = [{forest.numTrees: 2, forest.maxDepth: 1}, {forest.numTrees: 4, forest.maxDepth: 5}]
    best, scores = random_search(table, forest, maps, COLUMNS, k=3)
    rows = scores.collect()
    assert rows[0].draw == 1 and rows[0].cv_r2 > rows[1].cv_r2
    assert best.stages[-1].getNumTrees == 4


def test_search_runs_the_penalised_boosting(table):
    boost = RegularizedBoosting(inputCols=COLUMNS, rounds=2, depth=2, subsample=1.0, colsample=1.0)
    best, scores = random_search(table, boost, [{boost.rate: 0.01}, {boost.rate: 0.9}], COLUMNS, k=2)
    assert scores.first().draw == 1
    assert regression_metrics(predict(best, table)).first().r2 > 0.5


def test_selection_adds_variables_in_order(table):
    result = cumulative_selection(table, table, ["a", "b", "c"], forest_estimator(trees=3, depth=5)).collect()
    assert [(r.n_vars, r.last_variable) for r in result] == [(1, "a"), (2, "b"), (3, "c")]
    assert result[1].r2 > result[0].r2


def test_selection_by_folds_leaves_the_test_rows_alone(table):
    forest = forest_estimator(trees=3, depth=4)
    result = cumulative_selection(table, None, ["a", "b"], forest, select_on="cv", k=2).collect()
    assert [r.n_vars for r in result] == [1, 2] and result[1].r2 > result[0].r2
    with pytest.raises(ValueError):
        cumulative_selection(table, table, ["a"], forest, select_on="train")


def test_tuning_reports_the_gain(table):
    for estimator, better in (
        (forest_estimator(trees=2, depth=1), lambda e: {e.numTrees: 3, e.maxDepth: 5}),
        (RegularizedBoosting(inputCols=COLUMNS, rounds=1, depth=1, rate=0.1), lambda e: {e.rounds: 3, e.depth: 2, e.rate: 0.8}),
    ):
        tuned, gains, draws = tuning_comparison(table, estimator, [better(estimator)], COLUMNS, k=2)
        rows = {r.metric: r for r in gains.collect()}
        assert set(rows) == {"r2", "mae", "rmse"} and draws.count() == 1
        assert rows["r2"].gain > 0 > rows["rmse"].gain
        assert rows["r2"].gain == pytest.approx(rows["r2"].tuned - rows["r2"].base)
        assert sum(feature_importance(tuned.stages[-1], COLUMNS).toPandas().importance) == pytest.approx(1.0)


def test_both_alignments_are_scored(spark, small):
    x, y = sensor_and_quality(spark, small)
    rows = {r.alignment: r for r in alignment_comparison(x, y, lambda: forest_estimator(trees=2, depth=3)).collect()}
    assert (rows["exact"].n_features, rows["hourly"].n_features) == (16, 64)
    assert (rows["exact"].n_scored, rows["hourly"].n_scored) == (40, 40)
    assert (rows["exact"].n_rows, rows["hourly"].n_rows) == (197, 200)


def test_forest_finds_the_signal_in_the_fixture(spark, medium):
    aligned = aligned_exact(*sensor_and_quality(spark, medium)).cache()
    train, test = holdout(aligned, "date_time")
    model = fit(forest_estimator(trees=5, depth=10), train, ["T_data_3_1", "T_data_3_2", "T_data_3_3", "H_data"])
    assert regression_metrics(predict(model, test)).first().r2 > 0.8
    aligned.unpersist()
