"""The registered queries fit models and search spaces of full size."""

import pytest

from chamberlens.operators.search import BOOST_GRID, FOREST_GRID
from chamberlens.plans import queries


class Reached(Exception):
    pass


@pytest.fixture()
def asked(spark, small, monkeypatch):
    """What a query hands to the first fit or search that it comes to."""

    def of(name):
        def stop(*args, **kwargs):
            raise Reached(args)

        for step in ("fit", "fitted", "random_search", "tuning_comparison"):
            monkeypatch.setattr(queries, step, stop)
        monkeypatch.setattr(queries.RegularizedBoosting, "fit", stop)
        monkeypatch.setattr(queries, "alignment_comparison", lambda x, y, estimator_of: stop(estimator_of()))
        with pytest.raises(Reached) as found:
            queries.QUERIES[name](spark, small)
        return found.value.args[0]

    return of


def model_in(args):
    return next(a for a in args if hasattr(a, "fit"))


@pytest.mark.parametrize(
    "name, trees",
    [("forest_predictions", 200), ("forest_minimal", 100), ("feature_importance", 200), ("cumulative_selection", 200), ("selection_cut", 200), ("alignment_comparison", 200), ("pdp_forest", 200)],
)
def test_forests_are_full(asked, name, trees):
    model = model_in(asked(name))
    if name == "pdp_forest":
        assert (model.getNumTrees(), model.getMaxDepth()) == (trees, 30)
    else:
        assert [model.getOrDefault(p) for p in ("numTrees", "maxDepth")] == [trees, 0]


def test_boosting_is_full(asked):
    model = model_in(asked("boost_predictions"))
    assert (model.getMaxIter(), model.getMaxDepth(), model.getStepSize()) == (300, 5, 0.05)
    model = queries._boosting()
    assert [model.getOrDefault(p) for p in ("rounds", "depth", "rate")] == [300, 5, 0.05]


@pytest.mark.parametrize("name, draws, grid, place", [
    ("random_search_forest", 30, FOREST_GRID, "numTrees"), ("tuning_comparison", 30, FOREST_GRID, "numTrees"),
    ("random_search_boost", 50, BOOST_GRID, "rounds"), ("boost_tuning_comparison", 50, BOOST_GRID, "rounds"),
])
def test_searches_are_full(asked, name, draws, grid, place):
    params = next(a for a in asked(name) if isinstance(a, list) and isinstance(a[0], dict))
    assert len(params) == draws
    assert {v for p in params for k, v in p.items() if k.name == place} == set(grid["n_estimators"])
