"""Importance tables, the Pareto cut and ordered coefficients.

The tables have one row per name: mostly a column of the sensor table, but the Pareto
share takes any number of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from chamberlens.functions.columns import share_of, with_facts
from chamberlens.functions.running import running_sums

# Fixed value: the share the Pareto rule asks for, in per cent.
PARETO_SHARE = 80


def weights_table(spark: SparkSession, names: list[str], weights: list[float], weight: str = "importance") -> DataFrame:
    rows = [(n, float(w)) for n, w in zip(names, weights, strict=True)]
    return spark.createDataFrame(rows, f"variable string, {weight} double")


def feature_importance(model, names: list[str]) -> DataFrame:
    """(variable, importance), largest first, of a fitted forest or boosted model."""
    spark = SparkSession.active()
    values = model.featureImportances
    return weights_table(spark, names, [values[i] for i in range(len(names))]).orderBy(F.desc("importance"), "variable")


def coefficients(model, names: list[str]) -> DataFrame:
    """(variable, coefficient), largest absolute value first."""
    spark = SparkSession.active()
    table = weights_table(spark, names, list(model.coefficients), "coefficient")
    return table.orderBy(F.abs("coefficient").desc(), "variable")


def pareto(df: DataFrame, variable: str = "variable", weight: str = "importance") -> DataFrame:
    """Running share of the total in per cent, one decimal, half to even.

    Any number of names: positions and sums run over ranges of the order, and the total
    is a scalar subquery. Runs jobs when called.
    """
    named = df.select(F.col(variable).alias("variable"), F.col(weight).alias("importance"))
    ordered = running_sums(named, {"position": F.lit(1), "_so_far": F.col("importance")}, [F.desc("importance"), F.asc("variable")])
    total = ordered.agg(F.sum("importance").alias("total"))
    return with_facts(ordered, total).select(
        F.col("position").cast("int").alias("position"),
        "variable",
        "importance",
        F.bround(share_of(F.col("_so_far"), F.col("_facts.total")) * 100, 1).alias("cumul_pct"),
    )


def beyond_cut(shares: DataFrame, threshold: float = PARETO_SHARE) -> DataFrame:
    """The dispensable names, one a row with position and share: all after those within
    the threshold. The row-wise form of :func:`pareto_cut`, for any number of names."""
    within = shares.agg(F.count_if(F.col("cumul_pct") <= threshold).alias("n"))
    return with_facts(shares, within).where("position > _facts.n").drop("_facts")


def pareto_cut(shares: DataFrame, threshold: float = PARETO_SHARE) -> DataFrame:
    """One row: how many variables stay within the threshold, how many reach it, and
    the dispensable ones (all beyond the first count), in order of importance.

    The shares compared are the rounded ones; the variable that crosses the
    threshold is outside ``n_below`` and inside ``n_reaching``.
    """
    within = F.count_if(F.col("cumul_pct") <= threshold)
    short = F.count_if(F.col("cumul_pct") < threshold)
    ordered = F.array_sort(F.collect_list(F.struct("position", "variable"))).getField("variable")
    return shares.agg(
        within.alias("n_below"),
        F.least(short + 1, F.count(F.lit(1))).alias("n_reaching"),
        F.count(F.lit(1)).alias("n_variables"),
        ordered.alias("ordered"),
    ).select(
        "n_below",
        "n_reaching",
        "n_variables",
        F.expr("array_join(slice(ordered, int(n_below) + 1, size(ordered)), ',')").alias("dispensable"),
    )


def smallest_sufficient(results: DataFrame, ratio: float = 0.99) -> DataFrame:
    """The smallest n_vars whose r2 is at least ``ratio`` of the best one, null if none is."""
    best = results.agg(F.max("r2").alias("best"))
    return with_facts(results, best).where(f"r2 >= _facts.best * {ratio}").agg(F.min("n_vars").alias("n_vars"))
