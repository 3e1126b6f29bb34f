"""The registered queries: every operator over the whole tables of a folder.

Searches, folds, grids, draws, feature lists and models are the full ones: the operators'
own defaults, without a cap on depth.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from chamberlens.functions.columns import numeric_columns, rewritten, with_facts
from chamberlens.operators.align import exact_join, hourly_features, hourly_join, left_align, shift_time
from chamberlens.operators.boost import RegularizedBoosting
from chamberlens.operators.charts import actual_vs_predicted, axis_limits, outside_limits, prediction_examples, residual_histogram
from chamberlens.operators.clean import (
    TRIPLETS,
    anomaly_flags,
    clean_sensors,
    cleaning_audit,
    clip_prefix,
    normalize,
    parse_time,
    repair_triplets,
    selected_features,
)
from chamberlens.operators.explain import boost_dependence, forest_dependence, grid_values, pdp_1d, pdp_2d, row_dependence
from chamberlens.operators.linear import NestedLeastSquares
from chamberlens.operators.metrics import compare_models, regression_metrics, union_all
from chamberlens.operators.models import (
    boost_estimator,
    deep_forest_estimator,
    fit,
    forest_estimator,
    linear_estimator,
    predict,
    standardize,
)
from chamberlens.operators.rank import beyond_cut, coefficients, feature_importance, pareto, pareto_cut, smallest_sufficient
from chamberlens.operators.sample import folds, holdout
from chamberlens.operators.search import BOOST_DRAWS, BOOST_GRID, FOREST_DRAWS, FOREST_GRID, boost_params, draw_params, forest_params, random_search
from chamberlens.operators.select import cumulative_selection
from chamberlens.operators.stats import (
    column_extremes,
    correlation_matrix,
    first_rows,
    numeric_summary,
    target_correlation,
    top_correlated,
)
from chamberlens.plans.flows import (
    KEY,
    TARGET,
    aligned_exact,
    aligned_hourly,
    alignment_comparison,
    fitted,
    prepare,
    tuning_comparison,
)
from chamberlens.session import discard, scratch_path, stored
from chamberlens.sources.event_sensors import sensor_and_quality
from chamberlens.sources.tables import read_pair, scan_counts

Query = Callable[[SparkSession, str], DataFrame]

# The twelve features kept for boosting, best first.
SELECTED = [
    "T_data_3_3", "T_data_3_1", "T_data_3_2", "H_data", "T_data_2_3", "T_data_5_2",
    "T_data_5_1", "T_data_5_3", "T_data_1_3", "T_data_1_2", "T_data_1_1", "T_data_2_2",
]
PROBE_COLUMNS = [p for t in TRIPLETS for p in t]
LINEITEM_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
DIGITS = 6
# Trees of the plainest forest and of those that the selection scores; others have the default.
FEWER_TREES = 100


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round floating columns: sums differ in the last digits between engines."""
    floating = [n for n, kind in df.dtypes if kind == "double"]
    return rewritten(df, {n: f"round(`{n}`, {digits}) + 0.0D" for n in floating})


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned_exact(*sensor_and_quality(spark, sf_dir))


def _stored(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The exact join checkpointed once, when called, for queries that read it many times."""
    aligned = _exact(spark, sf_dir)
    return stored(aligned.select(*columns) if columns else aligned)


def _left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return left_align(*prepare(*sensor_and_quality(spark, sf_dir)))


# --- sources, cleaning, scaling ---------------------------------------------


def scan_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the views written as CSV and read back; the files are gone afterwards."""
    sensors, quality = sensor_and_quality(spark, sf_dir)
    paths = [scratch_path(spark, name) for name in ("sensors-csv", "quality-csv")]
    try:
        for df, path in zip((sensors, quality), paths):
            df.write.option("header", True).csv(path)
        x, y = read_pair(spark, *paths)
        counts = scan_counts({"sensors": x, "quality": y})
        return spark.createDataFrame(counts.collect(), counts.schema)  # one row per table
    finally:
        for path in paths:
            discard(spark, path)


def sensor_anomaly_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = anomaly_flags(sensor_and_quality(spark, sf_dir)[0])
    return flagged.selectExpr(KEY, *[f"CAST(flag_{p} AS INT) AS flag_{p}" for p in PROBE_COLUMNS])


def sensor_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_triplets(sensor_and_quality(spark, sf_dir)[0]).select(KEY, *PROBE_COLUMNS)


def sensor_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clip_prefix(sensor_and_quality(spark, sf_dir)[0]).select(KEY, *PROBE_COLUMNS)


def clean_sensors_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_sensors(sensor_and_quality(spark, sf_dir)[0])


def cleaning_audit_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning_audit(sensor_and_quality(spark, sf_dir)[0])


def selected_features_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(selected_features(_exact(spark, sf_dir), SELECTED, (KEY, TARGET)))


def normalize_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(normalize(sensor_and_quality(spark, sf_dir)[1]))


def parse_time_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "date_format(ts, 'yyyy-MM-dd HH:mm:ss') AS parsed",
        "CASE WHEN event_id % 10 = 0 THEN 'unknown' ELSE date_format(ts, 'dd/MM/yyyy HH:mm') END AS lenient",
    )
    return parse_time(parse_time(texts, "parsed"), "lenient", errors="null", fmt="dd/MM/yyyy HH:mm")


def shift_time_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(shift_time(sensor_and_quality(spark, sf_dir)[1]))


# --- alignment ---------------------------------------------------------------


def exact_lag_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_exact(spark, sf_dir))


def left_align_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_left(spark, sf_dir))


def left_align_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor rows, aligned rows (as many, or the join raises) and those without a measurement."""
    x, y = prepare(*sensor_and_quality(spark, sf_dir))
    sizes = left_align(x, y).agg(F.count("*").alias("n_aligned"), F.count_if(F.col(TARGET).isNull()).alias("n_without"))
    return with_facts(sizes, x.agg(F.count("*").alias("n"))).select(F.col("_facts.n").alias("n_sensors"), "n_aligned", "n_without")


def hourly_features_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(hourly_features(clean_sensors(sensor_and_quality(spark, sf_dir)[0])))


def hourly_join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(aligned_hourly(*sensor_and_quality(spark, sf_dir)))


# --- statistics --------------------------------------------------------------


def column_extremes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(column_extremes(clean_sensors(sensor_and_quality(spark, sf_dir)[0])))


def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(numeric_summary(normalize(sensor_and_quality(spark, sf_dir)[1]), TARGET))


def correlation_matrix_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(correlation_matrix(_left(spark, sf_dir)))


def target_correlation_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(target_correlation(correlation_matrix(_left(spark, sf_dir))))


def top_correlated_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(top_correlated(correlation_matrix(_left(spark, sf_dir))))


def first_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_rows(clean_sensors(sensor_and_quality(spark, sf_dir)[0]))


def lineitem_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(column_extremes(_table(spark, sf_dir, "lineitem"), LINEITEM_COLUMNS))


def lineitem_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(numeric_summary(_table(spark, sf_dir, "lineitem"), "l_extendedprice"), 4)


def lineitem_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(correlation_matrix(_table(spark, sf_dir, "lineitem"), LINEITEM_COLUMNS))


def embedding_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every component with every other, in tiles of 24 columns."""
    vectors = _table(spark, sf_dir, "embeddings")
    width = vectors.agg(F.coalesce(F.max(F.size("embedding")), F.lit(0))).first()[0]
    components = vectors.select(*[F.get("embedding", F.lit(i)).alias(f"e{i}") for i in range(width)])
    return rounded(correlation_matrix(components, tile=24))


# --- split and folds ---------------------------------------------------------


def _labelled(train: DataFrame, test: DataFrame) -> DataFrame:
    return union_all([d.select(KEY, F.lit(part).alias("part")) for d, part in ((train, "train"), (test, "test"))])


def holdout_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(*holdout(_exact(spark, sf_dir), KEY, exact=False))


def holdout_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(*holdout(_exact(spark, sf_dir), KEY, frac=0.015, exact=False))


def holdout_split_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _labelled(*holdout(_stored(spark, sf_dir, KEY), KEY))


def fold_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds(_stored(spark, sf_dir, KEY), KEY)


# --- models ------------------------------------------------------------------


def _features(aligned: DataFrame) -> list[str]:
    return numeric_columns(aligned, (KEY, TARGET))


def standardize_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = _stored(spark, sf_dir)
    train, test = holdout(aligned, KEY)
    return rounded(standardize(train, _features(aligned), test)[1])


def linear_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["T_data_3_1", "H_data"]
    aligned = _stored(spark, sf_dir, KEY, *columns, TARGET)
    train, _ = holdout(aligned, KEY)
    model = fit(linear_estimator(TARGET), standardize(train, columns)[0], columns).stages[-1]
    return rounded(coefficients(model, columns))


def linear_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hold-out predictions of least squares on all standardised features."""
    aligned = _stored(spark, sf_dir)
    columns = _features(aligned)
    train, test = holdout(aligned, KEY)
    train, test = standardize(train, columns, test)
    return predict(fit(linear_estimator(TARGET), train, columns), test)


def linear_predictions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(linear_predictions(spark, sf_dir))


def linear_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(regression_metrics(linear_predictions(spark, sf_dir), model="linear"))


def forest_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fitted(_stored(spark, sf_dir), deep_forest_estimator(TARGET))[1]


def forest_minimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plainest forest: leaves of a single row, no further options."""
    return fitted(_stored(spark, sf_dir), deep_forest_estimator(TARGET, trees=FEWER_TREES, min_leaf=1))[1]


def boost_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fitted(_stored(spark, sf_dir), boost_estimator(TARGET), SELECTED)[1]


def reg_boost_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = _stored(spark, sf_dir)
    train, test = holdout(aligned, KEY)
    stump = RegularizedBoosting(
        inputCols=_features(aligned), labelCol=TARGET, rounds=1, depth=1, rate=0.3, subsample=1.0, colsample=1.0,
        lam=1.0, alpha=0.5,
    )
    model = stump.fit(train)
    return rounded(model.transform(test).select(KEY, "yhat"))


def _boosting() -> RegularizedBoosting:
    return RegularizedBoosting(inputCols=SELECTED, labelCol=TARGET)


def reg_boost_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = holdout(_stored(spark, sf_dir), KEY)
    return predict(_boosting().fit(train), test)


def feature_importance_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = _stored(spark, sf_dir)
    columns = _features(aligned)
    model, _ = fitted(aligned, deep_forest_estimator(TARGET), columns)
    return pareto(feature_importance(model.stages[-1], columns))


def boost_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _ = holdout(_stored(spark, sf_dir), KEY)
    return pareto(feature_importance(_boosting().fit(train), SELECTED))


def boost_importance_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pareto_cut(boost_importance(spark, sf_dir))


def fitted_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Example rows of a fitted model: least squares on all features."""
    return prediction_examples(linear_predictions(spark, sf_dir))


# --- scores and charts of closed-form predictions ----------------------------


def _line(aligned: DataFrame, feature: str) -> DataFrame:
    """(date_time, y, yhat) of the least-squares line on one feature."""
    line = aligned.agg(F.regr_slope(TARGET, feature).alias("a"), F.regr_intercept(TARGET, feature).alias("b"))
    return with_facts(aligned, line).selectExpr(KEY, f"{TARGET} AS y", f"_facts.a * {feature} + _facts.b AS yhat")


def _predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _line(_stored(spark, sf_dir, KEY, "T_data_3_1", TARGET), "T_data_3_1")


def regression_metrics_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(regression_metrics(_predicted(spark, sf_dir), model="line"))


def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = _stored(spark, sf_dir, KEY, "H_data", "T_data_3_1", TARGET)
    scores = {f: regression_metrics(_line(aligned, f)) for f in ("H_data", "T_data_3_1")}
    return rounded(compare_models(scores, "H_data", "T_data_3_1"))


def actual_vs_predicted_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(actual_vs_predicted(_predicted(spark, sf_dir)))


def axis_limits_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(axis_limits(_predicted(spark, sf_dir)))


def fixed_axis_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chart limits that do not depend on the data, and how many points lie outside each."""
    return outside_limits(_predicted(spark, sf_dir))


def residual_histogram_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(residual_histogram(_predicted(spark, sf_dir)))


def prediction_examples_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(prediction_examples(_predicted(spark, sf_dir)))


# --- ranking, selection, search ----------------------------------------------


def _correlation_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = target_correlation(correlation_matrix(_left(spark, sf_dir)))
    return ranked.select("variable", F.abs("r").alias("importance"))


def pareto_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(pareto(_correlation_weights(spark, sf_dir)))


def pareto_cut_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pareto_cut(pareto(_correlation_weights(spark, sf_dir)))


def selection_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-variable lines tried from the weakest correlation up: the first one good enough."""
    weights = _correlation_weights(spark, sf_dir).orderBy("importance", "variable").collect()  # one row per variable
    rows = [(i, r["importance"] ** 2) for i, r in enumerate(weights, start=1)]
    return smallest_sufficient(spark.createDataFrame(rows, "n_vars int, r2 double"))


def _selection(spark: SparkSession, sf_dir: str, estimator) -> DataFrame:
    aligned = _stored(spark, sf_dir)
    columns = _features(aligned)
    train, test = holdout(aligned, KEY)
    full = fit(deep_forest_estimator(TARGET), train, columns).stages[-1]
    ranked = [r["variable"] for r in feature_importance(full, columns).collect()]  # one row per variable
    return cumulative_selection(train, test, ranked, estimator)


def cumulative_selection_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All variables, ranked by a forest, each number of them scored by a smaller forest."""
    return _selection(spark, sf_dir, deep_forest_estimator(TARGET, trees=FEWER_TREES))


def selection_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The smallest number of variables within 99 % of the best fitted score."""
    return smallest_sufficient(cumulative_selection_query(spark, sf_dir))


def _linear_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Least squares on the first n features, in the order of their names."""
    aligned = _stored(spark, sf_dir)
    train, test = holdout(aligned, KEY)
    return cumulative_selection(train, test, sorted(_features(aligned)), NestedLeastSquares(TARGET))


def cumulative_selection_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_linear_selection(spark, sf_dir), 5)


def cv_selection_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, scored by five folds of the training rows: the test rows stay unseen."""
    aligned = _stored(spark, sf_dir)
    train, _ = holdout(aligned, KEY)
    return rounded(cumulative_selection(train, None, sorted(_features(aligned)), NestedLeastSquares(TARGET), select_on="cv"), 5)


def selection_cut_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return smallest_sufficient(_linear_selection(spark, sf_dir))


def random_search_forest(spark: SparkSession, sf_dir: str, draws: int = FOREST_DRAWS) -> DataFrame:
    """The whole search space; all features, five folds."""
    estimator = deep_forest_estimator(TARGET)
    aligned = _stored(spark, sf_dir)
    train, _ = holdout(aligned, KEY)
    params = [forest_params(estimator, d) for d in draw_params(FOREST_GRID, draws)]
    return random_search(train, estimator, params, _features(aligned))[1]


def random_search_boost(spark: SparkSession, sf_dir: str, draws: int = BOOST_DRAWS) -> DataFrame:
    estimator = _boosting()
    train, _ = holdout(_stored(spark, sf_dir), KEY)
    params = [boost_params(estimator, d) for d in draw_params(BOOST_GRID, draws)]
    return random_search(train, estimator, params, SELECTED)[1]


def tuning_comparison_query(spark: SparkSession, sf_dir: str, draws: int = FOREST_DRAWS) -> DataFrame:
    """The forest as the other queries fit it against the best of the draws."""
    estimator = deep_forest_estimator(TARGET)
    aligned = _stored(spark, sf_dir)
    params = [forest_params(estimator, d) for d in draw_params(FOREST_GRID, draws)]
    return tuning_comparison(aligned, estimator, params, _features(aligned))[1]


def boost_tuning_comparison(spark: SparkSession, sf_dir: str, draws: int = BOOST_DRAWS) -> DataFrame:
    estimator = _boosting()
    params = [boost_params(estimator, d) for d in draw_params(BOOST_GRID, draws)]
    return tuning_comparison(_stored(spark, sf_dir), estimator, params, SELECTED)[1]


def alignment_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    sensors, quality = prepare(*sensor_and_quality(spark, sf_dir))
    return scan_counts({"exact": exact_join(sensors, quality), "hourly": hourly_join(sensors, quality)})


def alignment_comparison_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = sensor_and_quality(spark, sf_dir)
    return alignment_comparison(x, y, lambda: deep_forest_estimator(TARGET))


# --- partial dependence ------------------------------------------------------


def _formula(df: DataFrame) -> DataFrame:
    t, h = F.col("T_data_3_1"), F.col("H_data")
    return df.withColumn("yhat", 2 + 0.05 * t + 0.1 * h + 0.001 * t * h)


def _training_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two features of the training rows, stored once: grids and curves read them several times."""
    return holdout(_stored(spark, sf_dir, KEY, "T_data_3_1", "H_data"), KEY)[0]


def pdp_1d_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = _training_pair(spark, sf_dir)
    grids = grid_values(train, ["T_data_3_1", "H_data"])
    return rounded(union_all([pdp_1d(_formula, train, f, points) for f, points in grids.items()]))


def pdp_2d_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(pdp_2d(_formula, _training_pair(spark, sf_dir), "T_data_3_1", "H_data"), 8)


def pdp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = _stored(spark, sf_dir)
    columns = _features(aligned)
    train, _ = holdout(aligned, KEY)
    forest = fit(forest_estimator(TARGET), train, columns).stages[-1]
    points = grid_values(train, columns)
    grids = {(c,): [(v,) for v in values] for c, values in points.items()}
    pair = ("T_data_3_1", "H_data")
    grids[pair] = [(a, b) for a in points[pair[0]] for b in points[pair[1]]]
    return forest_dependence(forest, columns, grids)


def pdp_boost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dependence of the penalised boosting read off its trees, one feature and one pair."""
    train, _ = holdout(_stored(spark, sf_dir), KEY)
    points = grid_values(train, SELECTED)
    grids = {(c,): [(v,) for v in values] for c, values in points.items()}
    pair = ("T_data_3_1", "H_data")
    grids[pair] = [(a, b) for a in points[pair[0]] for b in points[pair[1]]]
    return boost_dependence(_boosting().fit(train), grids)


def pdp_boost_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dependence of the penalised boosting averaged over the training rows themselves."""
    train, _ = holdout(_stored(spark, sf_dir), KEY)
    grids = {(c,): [(v,) for v in values] for c, values in grid_values(train, SELECTED).items()}
    return row_dependence(_boosting().fit(train).scorer(), train, SELECTED, grids)


def _part_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    revenue = (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)")
    sold = _table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.sum(revenue).cast("double").alias("revenue"))
    return pareto(sold, "l_partkey", "revenue")


def part_pareto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts sold by revenue: a name a part, ranked without a task that sees them all."""
    return rounded(_part_shares(spark, sf_dir), 4)


def part_pareto_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts beyond the Pareto share."""
    return beyond_cut(_part_shares(spark, sf_dir)).select("position", "variable", "cumul_pct")


def revenue_pareto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brands by revenue: a fixed and small set of names, whatever the table size."""
    items = _table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue")
    )
    per_part = items.groupBy("p_partkey").agg(F.sum("revenue").alias("revenue"))
    parts = _table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    brands = per_part.join(parts, "p_partkey").groupBy("p_brand").agg(F.sum("revenue").alias("revenue"))
    return rounded(pareto(brands, "p_brand", "revenue"), 2)


QUERIES: dict[str, Query] = {
    "scan_counts": scan_counts_query,
    "sensor_anomaly_flags": sensor_anomaly_flags,
    "sensor_repair": sensor_repair,
    "sensor_clip": sensor_clip,
    "clean_sensors": clean_sensors_query,
    "cleaning_audit": cleaning_audit_query,
    "selected_features": selected_features_query,
    "normalize_quality": normalize_quality,
    "parse_time": parse_time_query,
    "shift_time": shift_time_query,
    "exact_lag_join": exact_lag_join,
    "left_align": left_align_query,
    "left_align_counts": left_align_counts,
    "hourly_features": hourly_features_query,
    "hourly_join": hourly_join_query,
    "column_extremes": column_extremes_query,
    "quality_summary": quality_summary,
    "correlation_matrix": correlation_matrix_query,
    "target_correlation": target_correlation_query,
    "top_correlated": top_correlated_query,
    "first_rows": first_rows_query,
    "lineitem_extremes": lineitem_extremes,
    "lineitem_summary": lineitem_summary,
    "lineitem_correlation": lineitem_correlation,
    "embedding_correlation": embedding_correlation,
    "holdout_split": holdout_split,
    "holdout_fraction": holdout_fraction,
    "holdout_split_exact": holdout_split_exact,
    "fold_assignment": fold_assignment,
    "standardize": standardize_query,
    "linear_fit": linear_fit,
    "linear_metrics": linear_metrics,
    "forest_predictions": forest_predictions,
    "linear_predictions": linear_predictions_query,
    "fitted_examples": fitted_examples,
    "forest_minimal": forest_minimal,
    "boost_predictions": boost_predictions,
    "reg_boost_stump": reg_boost_stump,
    "reg_boost_predictions": reg_boost_predictions,
    "feature_importance": feature_importance_query,
    "boost_importance": boost_importance,
    "boost_importance_cut": boost_importance_cut,
    "regression_metrics": regression_metrics_query,
    "model_comparison": model_comparison,
    "actual_vs_predicted": actual_vs_predicted_query,
    "axis_limits": axis_limits_query,
    "fixed_axis_limits": fixed_axis_limits,
    "residual_histogram": residual_histogram_query,
    "prediction_examples": prediction_examples_query,
    "pareto_share": pareto_share,
    "pareto_cut": pareto_cut_query,
    "revenue_pareto": revenue_pareto,
    "part_pareto": part_pareto,
    "part_pareto_cut": part_pareto_cut,
    "selection_threshold": selection_threshold,
    "cumulative_selection": cumulative_selection_query,
    "selection_cut": selection_cut,
    "cumulative_selection_linear": cumulative_selection_linear,
    "selection_cut_linear": selection_cut_linear,
    "cv_selection_linear": cv_selection_linear,
    "random_search_forest": random_search_forest,
    "random_search_boost": random_search_boost,
    "tuning_comparison": tuning_comparison_query,
    "boost_tuning_comparison": boost_tuning_comparison,
    "alignment_sizes": alignment_sizes,
    "alignment_comparison": alignment_comparison_query,
    "pdp_1d": pdp_1d_query,
    "pdp_2d": pdp_2d_query,
    "pdp_forest": pdp_forest,
    "pdp_boost": pdp_boost,
    "pdp_boost_rows": pdp_boost_rows,
}
