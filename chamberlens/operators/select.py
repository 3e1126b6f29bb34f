"""How many of the ranked variables are enough."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator
from pyspark.ml.feature import VectorSlicer
from pyspark.sql import DataFrame, functions as F

from chamberlens.operators.metrics import METRICS, regression_metrics, union_all
from chamberlens.operators.models import FEATURES, assembler
from chamberlens.operators.sample import folds
from chamberlens.session import stored


def cumulative_selection(
    train: DataFrame,
    test: DataFrame,
    ranked: list[str],
    estimator: Estimator,
    target: str = "quality",
    parallelism: int = 2,
    select_on: str = "test",
    key: str = "date_time",
    k: int = 5,
) -> DataFrame:
    """(n_vars, last_variable, r2, mae, rmse) of a model on the first n ranked variables.

    The vectors are assembled once in rank order; each fit takes a prefix of them. An
    estimator that has ``prefix_metrics`` trains the models of all prefixes together; the
    fits of others are separate Spark jobs, submitted from a few driver threads. With
    ``select_on="cv"`` the scores are means over k folds of ``train``, and ``test``
    stays unseen until a size is chosen.
    """
    if select_on not in ("test", "cv"):
        raise ValueError("select_on must be 'test' or 'cv'")
    spark = train.sparkSession
    stage = assembler(ranked).setOutputCol("ranked")
    columns = list(dict.fromkeys([*ranked, target, *([key] if select_on == "cv" else [])]))
    if select_on == "cv":
        divided = stored(stage.transform(folds(train.select(columns), key, k)).select("ranked", target, "fold"))
        left_out = list(range(k))
    else:
        parts = [frame.select(columns).withColumn("fold", F.lit(i)) for i, frame in enumerate((train, test))]
        divided = stored(stage.transform(union_all(parts)).select("ranked", target, "fold"))
        left_out = [1]
    schema = "n_vars int, last_variable string, r2 double, mae double, rmse double"
    if hasattr(estimator, "prefix_metrics"):
        ready = divided.withColumnRenamed("ranked", FEATURES)
        found = estimator.prefix_metrics(ready, "fold", left_out, list(range(1, len(ranked) + 1)))
        rows = [
            (n, ranked[n - 1], *(sum(s[m] for s in scores) / len(scores) for m in METRICS)) for n, scores in enumerate(found, start=1)
        ]
        return spark.createDataFrame(rows, schema).orderBy("n_vars")
    rounds = [(divided.where(F.col("fold") != i), divided.where(F.col("fold") == i)) for i in left_out]

    @inheritable_thread_target(spark)
    def score(n: int) -> tuple:
        prefix = VectorSlicer(inputCol="ranked", outputCol=FEATURES, indices=list(range(n)))
        scores = []
        for fitting, held in rounds:
            model = estimator.fit(prefix.transform(fitting).select(FEATURES, target))
            scores.append(regression_metrics(model.transform(prefix.transform(held)), target, "yhat"))
        means = union_all(scores).agg(*[F.avg(m).alias(m) for m in METRICS]).first()
        return n, ranked[n - 1], *(means[m] for m in METRICS)

    with ThreadPoolExecutor(parallelism) as pool:
        rows = list(pool.map(score, range(1, len(ranked) + 1)))
    return spark.createDataFrame(rows, schema).orderBy("n_vars")
