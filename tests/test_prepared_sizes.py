"""The plans of the sensor view and of partial dependence, and a scorer's sums over a grid."""

import numpy as np
from pyspark.sql import functions as F

from chamberlens.operators.boost import Scorer
from chamberlens.operators.clean import clean_sensors
from chamberlens.operators.explain import pdp_1d
from chamberlens.sources.event_sensors import sensor_and_quality


def test_the_gap_filter_repeats_no_reading(spark, small):
    """The remainders are computed once per row, not again in the filter of every probe."""
    sensors, _ = sensor_and_quality(spark, small)
    plan = clean_sensors(sensors)._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if "Filter" in line]
    assert filters and not any("% 97" in line for line in filters)


def test_rows_are_dealt_over_the_cores_before_they_are_repeated(spark):
    few = spark.range(64).select(F.col("id").cast("double").alias("a")).coalesce(1)
    tasks = []

    def predict(df):
        tasks.extend(df.select(F.spark_partition_id().alias("p")).distinct().collect())
        return df.withColumn("yhat", F.col("a"))

    assert pdp_1d(predict, few, "a", [1.0, 2.0]).count() == 2
    assert len(tasks) > 1


def test_a_scorers_sums_are_those_of_its_scores():
    rng = np.random.default_rng(5)
    feature = rng.integers(-1, 4, (9, 15))
    feature[:, 7:] = -1
    scorer = Scorer(0.25, 0.1, feature, rng.normal(size=(9, 15)), rng.normal(size=(9, 15)))
    rows = rng.normal(size=(50, 4))
    rows[3, 1] = np.nan
    for held in ([0], [3, 1]):
        points = rng.normal(size=(6, len(held)))
        want = []
        for point in points:
            block = rows.copy()
            block[:, held] = point
            want.append(scorer(block).sum())
        np.testing.assert_allclose(scorer.sums(rows, held, points), want, rtol=1e-12)
    assert (scorer.sums(rows[:0], [0], np.zeros((2, 1))) == 0).all()
