"""Dependence of boosted trees, nested least squares and Pareto shares of many names."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chamberlens.operators.boost import RegularizedBoosting
from chamberlens.operators.explain import boost_dependence, pdp_1d, row_dependence
from chamberlens.operators.linear import Moments, NestedLeastSquares, fold_moments, nested_coefficients
from chamberlens.operators.rank import beyond_cut, pareto
from chamberlens.operators.sample import folds
from chamberlens.operators.select import cumulative_selection

COLUMNS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(12)
    x = np.round(rng.normal(size=(240, 4)) * 3)
    x[:, 3] = x[:, 0] + 2 * x[:, 1]  # told by the others
    return x, 1 + 2 * x[:, 0] - x[:, 1] * (x[:, 2] > 0) + rng.normal(size=240)


@pytest.fixture(scope="module")
def table(spark, data):
    rows = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(*data))]
    return spark.createDataFrame(rows, "date_time long, a double, b double, c double, d double, quality double").repartition(5).cache()


@pytest.fixture(scope="module")
def model(table):
    return RegularizedBoosting(inputCols=COLUMNS, rounds=6, depth=3, rate=0.5).fit(table)


def test_row_dependence_is_the_exploded_one(spark, table, model, conf):
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    points = [-4.0, 0.0, 0.5, 3.0]
    want = {r["value"]: r["pd"] for r in pdp_1d(model.transform, table, "a", points).collect()}
    grids = {("a",): [(v,) for v in points], ("b", "c"): [(1.0, -1.0), (2.0, 2.0)]}
    got = {(r["features"], tuple(r["values"])): r["pd"] for r in row_dependence(model.scorer(), table, COLUMNS, grids).collect()}
    assert {v: got["a", (v,)] for v in points} == pytest.approx(want)
    x = np.array([[r[c] for c in COLUMNS] for r in table.collect()])
    for b, c in grids["b", "c"]:
        x[:, 1], x[:, 2] = b, c
        assert got["b,c", (b, c)] == pytest.approx(model.scorer()(x).mean())
    assert len(got) == 6
    assert row_dependence(model.scorer(), table.where("false"), COLUMNS, grids).where("pd IS NOT NULL").isEmpty()


def test_boost_dependence_follows_covers(model):
    """A plain recursion over each tree, weighing by the rows its nodes were grown on."""

    def expect(tree, k, held):
        f = tree.feature[k]
        if f < 0:
            return tree.weight[k]
        left, right = 2 * k + 1, 2 * k + 2
        if f in held:
            return expect(tree, left if held[f] < model.cuts[f][tree.bin[k]] else right, held)
        total = tree.cover[left] + tree.cover[right]
        return (tree.cover[left] * expect(tree, left, held) + tree.cover[right] * expect(tree, right, held)) / total

    grids = {("a",): [(-2.0,), (0.0,), (5.0,)], ("c", "a"): [(1.0, 2.0), (-1.0, 0.0)], tuple(COLUMNS): [(1.0, 2.0, 3.0, 4.0)]}
    got = {(r["features"], tuple(r["values"])): r["pd"] for r in boost_dependence(model, grids).collect()}
    for names, points in grids.items():
        for point in points:
            held = {COLUMNS.index(n): v for n, v in zip(names, point)}
            want = model.base + model.fitted_rate * sum(expect(t, 0, held) for t in model.trees)
            assert got[",".join(names), point] == pytest.approx(want)
    assert got["a,b,c,d", (1.0, 2.0, 3.0, 4.0)] == pytest.approx(model.scorer()(np.array([[1.0, 2.0, 3.0, 4.0]]))[0])


def test_moments_merge_and_sweep(data):
    x, y = data
    rows = np.c_[x[:, :3], y]
    merged = Moments.of(rows[:50]).with_(Moments.of(rows[50:51])).with_(Moments.of(rows[:0])).with_(Moments.of(rows[51:]))
    whole = Moments.of(rows)
    assert merged.products == pytest.approx(whole.products) and merged.means == pytest.approx(whole.means)
    for n, found in enumerate(nested_coefficients(whole), start=1):
        want = np.linalg.lstsq(np.c_[x[:, :n], np.ones(len(y))], y, rcond=None)[0][:n]
        assert found == pytest.approx([*want, *[0.0] * (3 - n)])


def lstsq_scores(train, test, n):
    x, y = train
    fit = np.linalg.lstsq(np.c_[x[:, :n], np.ones(len(y))], y, rcond=None)[0]
    error = np.c_[test[0][:, :n], np.ones(len(test[1]))] @ fit - test[1]
    return 1 - (error @ error) / ((test[1] - test[1].mean()) ** 2).sum(), np.abs(error).mean(), np.sqrt((error @ error) / len(error))


def test_selection_scores_every_prefix_like_single_fits(table, data):
    train, test = table.where("date_time < 180"), table.where("date_time >= 180")
    got = cumulative_selection(train, test, COLUMNS, NestedLeastSquares()).collect()
    x, y = data
    for r in got:
        want = lstsq_scores((x[:180], y[:180]), (x[180:], y[180:]), r["n_vars"])
        assert (r["r2"], r["mae"], r["rmse"]) == pytest.approx(want)


def test_cross_validated_selection(table, data):
    got = cumulative_selection(table, None, COLUMNS, NestedLeastSquares(), select_on="cv", k=4).collect()
    fold = {r["date_time"]: r["fold"] for r in folds(table, "date_time", 4).collect()}
    of = np.array([fold[i] for i in range(240)])
    x, y = data
    for r in got:
        scores = [lstsq_scores((x[of != i], y[of != i]), (x[of == i], y[of == i]), r["n_vars"]) for i in range(4)]
        assert (r["r2"], r["mae"], r["rmse"]) == pytest.approx(tuple(np.mean(scores, axis=0)))


def test_moments_take_one_pass(spark, table):
    """Counted by an accumulator over the rows."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("array<double>")
    def watched(a, y):
        seen.add(1)
        return [a, y]

    rows = table.select((F.col("date_time") % 3).cast("int").alias("fold"), watched("a", "quality").alias("row"))
    assert sorted(fold_moments(rows)) == [0, 1, 2]
    assert seen.value == 240


def test_pareto_of_many_names_has_no_single_task(spark, conf):
    conf("spark.sql.shuffle.partitions", "6")
    df = spark.range(5000).select(F.concat(F.lit("n"), F.col("id")).alias("variable"), (F.col("id") % 50 + 1).cast("double").alias("importance"))
    shares = pareto(df)
    assert "SinglePartition" not in shares.select("position", "variable")._jdf.queryExecution().executedPlan().toString()
    rows = sorted((r["position"], r["variable"], r["importance"], r["cumul_pct"]) for r in shares.collect())
    want = sorted(((f"n{i}", float(i % 50 + 1)) for i in range(5000)), key=lambda t: (-t[1], t[0]))
    assert [r[1:3] for r in rows] == want and [r[0] for r in rows] == list(range(1, 5001))
    sums = np.cumsum([w for _, w in want])
    assert [r[3] for r in rows] == pytest.approx(np.round(sums / sums[-1] * 100, 1).tolist(), abs=0.1001)
    inside = sum(r[3] <= 80 for r in rows)
    assert sorted(r["position"] for r in beyond_cut(shares).collect()) == list(range(inside + 1, 5001))
