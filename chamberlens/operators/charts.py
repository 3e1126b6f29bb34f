"""The tables behind the evaluation charts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chamberlens.functions.columns import with_facts

# Chart margin and number of residual bins.
MARGIN = 2
BINS = 40
# Chart limits that hold whatever the data.
FIXED_LIMITS = {"scatter": (-5.0, 105.0), "scale": (0.0, 100.0)}


def actual_vs_predicted(df: DataFrame, key: str = "date_time", y: str = "y", yhat: str = "yhat") -> DataFrame:
    """Scatter points with the residual (actual minus predicted)."""
    return df.select(key, F.col(y).alias("y"), F.col(yhat).alias("yhat"), (F.col(y) - F.col(yhat)).alias("residual"))


def axis_limits(df: DataFrame, y: str = "y", yhat: str = "yhat", margin: float = MARGIN) -> DataFrame:
    """Common limits of both axes: overall extremes widened by the margin."""
    return df.agg(
        (F.least(F.min(y), F.min(yhat)) - margin).alias("low"),
        (F.greatest(F.max(y), F.max(yhat)) + margin).alias("high"),
    )


def outside_limits(df: DataFrame, y: str = "y", yhat: str = "yhat") -> DataFrame:
    """(chart, low, high, n_outside): the fixed limits and the points that a chart with them would not show."""
    rows = [
        F.struct(
            F.lit(chart).alias("chart"),
            F.lit(low).alias("low"),
            F.lit(high).alias("high"),
            F.count_if(~(F.col(y).between(low, high) & F.col(yhat).between(low, high))).alias("n_outside"),
        )
        for chart, (low, high) in FIXED_LIMITS.items()
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def residual_histogram(df: DataFrame, y: str = "y", yhat: str = "yhat", bins: int = BINS) -> DataFrame:
    """Equal-width histogram of the residuals as (bin, lo, hi, n), empty bins included.

    Bins are closed on the left, the last one on both sides; constant residuals get
    a range one unit wide.
    """
    residuals = df.select((F.col(y) - F.col(yhat)).alias("residual")).where("residual IS NOT NULL")
    span = residuals.agg(F.min("residual").alias("a"), F.max("residual").alias("b")).selectExpr(
        "CASE WHEN a = b THEN a - 0.5D ELSE a END AS low", "CASE WHEN a = b THEN b + 0.5D ELSE b END AS high"
    )

    def edge(i: str) -> str:
        return f"CASE WHEN {i} = {bins} THEN _facts.high ELSE _facts.low + {i} * ((_facts.high - _facts.low) / {bins}) END"

    share = "(residual - _facts.low) / (_facts.high - _facts.low)"
    guessed = with_facts(residuals, span).withColumn("guess", F.expr(f"least(floor({share} * {bins}), {bins - 1})"))
    # the quotient may round across an edge; the edges themselves decide
    counts = guessed.selectExpr(
        f"CAST(CASE WHEN guess > 0 AND residual < {edge('guess')} THEN guess - 1 "
        f"WHEN guess < {bins - 1} AND residual >= {edge('(guess + 1)')} THEN guess + 1 ELSE guess END AS INT) AS bin"
    ).groupBy("bin").agg(F.count("*").alias("n"))
    all_bins = df.sparkSession.range(bins).selectExpr("CAST(id AS INT) AS bin")
    return with_facts(all_bins.join(counts, "bin", "left"), span).selectExpr(
        "bin", f"{edge('bin')} AS lo", f"{edge('(bin + 1)')} AS hi", "coalesce(n, 0) AS n"
    )


def prediction_examples(df: DataFrame, key: str = "date_time", y: str = "y", yhat: str = "yhat", n: int = 5) -> DataFrame:
    """The first n rows by key, then by the other values: actual, predicted and gap, the
    latter two to one decimal (half to even)."""
    return (
        df.orderBy(key, y, yhat)
        .limit(n)
        .select(
            key,
            F.col(y).alias("actual"),
            F.bround(yhat, 1).alias("predicted"),
            F.bround(F.col(y) - F.col(yhat), 1).alias("gap"),
        )
    )
