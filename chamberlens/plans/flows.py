"""Whole analyses: ingest and clean, align, fit and score, compare."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame

from chamberlens.functions.columns import numeric_columns
from chamberlens.operators.align import exact_join, hourly_join, shift_time
from chamberlens.operators.clean import clean_sensors, normalize, parse_time
from chamberlens.operators.metrics import compare_alignments, compare_models, regression_metrics
from chamberlens.operators.models import fit, predict
from chamberlens.operators.sample import holdout
from chamberlens.operators.search import random_search
from chamberlens.session import stored

KEY, TARGET = "date_time", "quality"


def prepare(x: DataFrame, y: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cleaned sensors, and the scaled quality moved back to the hour it describes."""
    return parse_time(clean_sensors(x), KEY), shift_time(parse_time(normalize(y), KEY), KEY, -1)


def aligned_exact(x: DataFrame, y: DataFrame) -> DataFrame:
    return exact_join(*prepare(x, y), KEY)


def aligned_hourly(x: DataFrame, y: DataFrame) -> DataFrame:
    return hourly_join(*prepare(x, y), KEY)


def fitted(aligned: DataFrame, estimator: Estimator, columns: list[str] | None = None, exact: bool = True) -> tuple[PipelineModel, DataFrame]:
    """Split, fit, and score the hold-out: (model, (date_time, y, yhat))."""
    columns = columns or numeric_columns(aligned, (KEY, TARGET))
    train, test = holdout(aligned, KEY, exact=exact)
    model = fit(estimator, train, columns, TARGET)
    return model, predict(model, test, KEY, TARGET)


def evaluate(aligned: DataFrame, estimator: Estimator, label: str) -> tuple[DataFrame, int]:
    """(metric row, number of features) of one alignment."""
    columns = numeric_columns(aligned, (KEY, TARGET))
    _, scored = fitted(aligned, estimator, columns)
    return regression_metrics(scored, model=label), len(columns)


def alignment_comparison(x: DataFrame, y: DataFrame, estimator_of: Callable[[], Estimator]) -> DataFrame:
    """The same model on the exact join and on hourly features, side by side."""
    sensors, quality = prepare(x, y)
    scores = {}
    for label, aligned in (("exact", exact_join(sensors, quality, KEY)), ("hourly", hourly_join(sensors, quality, KEY))):
        held = stored(aligned)
        scored, n = evaluate(held, estimator_of(), label)
        row = scored.collect()  # one row of metrics
        rows = held.count()
        scores[label] = (x.sparkSession.createDataFrame(row, scored.schema), n, rows)
    return compare_alignments(scores)


def tuning_comparison(
    aligned: DataFrame,
    estimator: Estimator,
    param_maps: list[dict],
    columns: list[str] | None = None,
    k: int = 5,
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """(tuned model, gain table, draws): the estimator as given against the best draw.

    Both are scored on the same hold-out, which the search does not see.
    """
    columns = columns or numeric_columns(aligned, (KEY, TARGET))
    train, test = holdout(aligned, KEY)
    base = fit(estimator, train, columns, TARGET)
    tuned, draws = random_search(train, estimator, param_maps, columns, KEY, TARGET, k)
    scores = {}
    for name, model in (("base", base), ("tuned", tuned)):
        scored = regression_metrics(predict(model, test, KEY, TARGET))
        scores[name] = aligned.sparkSession.createDataFrame(scored.collect(), scored.schema)  # one row of metrics
    return tuned, compare_models(scores, "base", "tuned"), draws
