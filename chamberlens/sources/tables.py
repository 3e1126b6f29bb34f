"""Reading the sensor and quality tables, and writing report tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

TIME = "date_time"


def typed_header(header: list[str]) -> T.StructType:
    """Schema by column name: time as text, temperatures as whole numbers, the rest as doubles."""

    def kind(name: str) -> T.DataType:
        if name == TIME:
            return T.StringType()
        return T.LongType() if name.startswith("T_") else T.DoubleType()

    return T.StructType([T.StructField(n, kind(n)) for n in header])


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    schema: T.StructType | None = None,
    malformed: str = "raise",
) -> DataFrame | None:
    """One table, or None with a message when the file is not there.

    Without a schema only the header line is read to name the columns; no value is
    read to guess a type. A malformed cell raises, or is null with ``malformed="null"``.
    """
    try:
        if fmt == "parquet":
            return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
        reader = spark.read.option("header", True).option("enforceSchema", False)
        reader = reader.option("mode", "FAILFAST" if malformed == "raise" else "PERMISSIVE")
        schema = schema or typed_header(spark.read.option("header", True).csv(path).columns)
        return reader.schema(schema).csv(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        print(f"not found: {path}")
        return None


def read_pair(spark: SparkSession, path_x: str, path_y: str, fmt: str = "csv", **options) -> tuple[DataFrame | None, DataFrame | None]:
    """Sensor and quality table; either is None when its file is missing."""
    return read_table(spark, path_x, fmt, **options), read_table(spark, path_y, fmt, **options)


def scan_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, n_rows, n_columns) of each table."""
    rows = [
        t.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("name"), "n_rows", F.lit(len(t.columns)).alias("n_columns")
        )
        for name, t in tables.items()
    ]
    result = rows[0]
    for r in rows[1:]:
        result = result.unionByName(r)
    return result


def write_report(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write a result table."""
    df.write.mode("overwrite").format(fmt).save(path)
