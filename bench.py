"""Time the headline queries: ``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores.

Prints a JSON line after every query; the last one is complete, and a run that is stopped
leaves all figures up to then. Each query runs once over its whole input and is written
to a sink that reads every column. Short queries come first; whole model fits follow, in
``queries`` too but summed apart as ``long``. ``fits`` has fit times alone, of settings that
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from chamberlens.functions.columns import numeric_columns  # noqa: E402
from chamberlens.operators.boost import RegularizedBoosting  # noqa: E402
from chamberlens.operators.models import deep_forest_estimator, fit, linear_estimator  # noqa: E402
from chamberlens.operators.sample import holdout  # noqa: E402
from chamberlens.plans.flows import KEY, TARGET, aligned_exact  # noqa: E402
from chamberlens.plans.queries import QUERIES  # noqa: E402
from chamberlens.session import build_session, stored  # noqa: E402
from chamberlens.sources.event_sensors import sensor_and_quality  # noqa: E402

HEADLINE = [
    "sensor_anomaly_flags",
    "sensor_repair",
    "clean_sensors",
    "cleaning_audit",
    "normalize_quality",
    "exact_lag_join",
    "left_align",
    "hourly_features",
    "hourly_join",
    "column_extremes",
    "quality_summary",
    "correlation_matrix",
    "lineitem_correlation",
    "lineitem_summary",
    "holdout_split_exact",
    "fold_assignment",
    "standardize",
    "linear_metrics",
    "cumulative_selection_linear",
    "cv_selection_linear",
    "regression_metrics",
    "residual_histogram",
    "pareto_cut",
    "revenue_pareto",
    "part_pareto",
    "pdp_1d",
    "pdp_2d",
]
# Queries that fit whole models.
LONG = [
    "reg_boost_predictions",
    "boost_importance_cut",
    "forest_predictions",
    "forest_minimal",
    "feature_importance",
    "alignment_comparison",
    "selection_cut",
    "pdp_boost",
]


def fit_times(spark, sf_dir: str) -> dict[str, float]:
    """Seconds to fit each model on the training rows of the exact join, all features."""
    train, _ = holdout(stored(aligned_exact(*sensor_and_quality(spark, sf_dir))), KEY)
    columns = numeric_columns(train, (KEY, TARGET))
    train = stored(train)
    estimators = {
        "warm-up": linear_estimator(TARGET),
        "linear": linear_estimator(TARGET),
        "forest_20_depth_10": deep_forest_estimator(TARGET, trees=20, maxDepth=10),
        "forest_20_unlimited": deep_forest_estimator(TARGET, trees=20),
        "reg_boost_20_depth_5": RegularizedBoosting(inputCols=columns, labelCol=TARGET, rounds=20, depth=5),
    }
    seconds = {}
    for name, estimator in estimators.items():
        begun = time.perf_counter()
        fit(estimator, train, columns, TARGET) if name[:3] != "reg" else estimator.fit(train)
        seconds[name] = round(time.perf_counter() - begun, 3)
    del seconds["warm-up"]
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", cores, int(cores) if cores.isdigit() else 8)
    QUERIES["exact_lag_join"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds, fits = {}, {}

    def report() -> None:
        line = {
            "metric": "headline_queries_total",
            "value": round(sum(s for n, s in seconds.items() if n not in LONG), 3),
            "unit": "sec",
            "queries": seconds,
            "long": round(sum(s for n, s in seconds.items() if n in LONG), 3),
            "fits": fits,
            "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        }
        print(json.dumps(line), flush=True)

    for name in sys.argv[1:] or HEADLINE + LONG:
        begun = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begun, 3)
        report()
    if not sys.argv[1:]:
        fits.update(fit_times(spark, sf_dir))
        report()
    spark.stop()


if __name__ == "__main__":
    main()
