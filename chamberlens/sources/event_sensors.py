"""Sensor and quality views computed from the events table.

The test tables hold no sensors, so both engines derive them from ``events`` by the
same SQL text: one event is one minute of readings, with planted faults and gaps.
Only the timestamp expression differs between the dialects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

_TIME = {
    "spark": "TIMESTAMP_NTZ '2024-01-01 00:00:00' + INTERVAL '1' MINUTE * ({n})",
    "duckdb": "TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST({n} AS BIGINT))",
}


def _hits(offset: int, modulus: int) -> str:
    """(event_id + offset) is a multiple of the modulus; the remainder is computed once per row."""
    return f"m{modulus} = {-offset % modulus}"


def _probe(i: int, j: int) -> str:
    reading = f"""{300 + 20 * i + 3 * j} + signal_{i}
  + CASE WHEN {_hits(7 * i + j, 97)} THEN 1000 WHEN {_hits(11 * i + j, 101)} THEN -801 ELSE 0 END
  + CASE WHEN {_hits(i, 211)} THEN {120 * j} ELSE 0 END
  + CASE WHEN {_hits(i, 223)} THEN -701 WHEN {_hits(i, 227)} THEN 1000 ELSE 0 END"""
    if (i, j) == (2, 3):
        reading = f"CASE WHEN m89 = 0 THEN NULL ELSE {reading} END"
    return f"{reading} AS T_data_{i}_{j}"


def sensor_sql(dialect: str, source: str = "events") -> str:
    remainders = ", ".join(f"event_id % {m} AS m{m}" for m in (89, 97, 101, 211, 223, 227, 307))
    signals = ", ".join(f"(user_id * {i + 2} + event_id) % 41 AS signal_{i}" for i in range(1, 6))
    probes = ",\n".join(_probe(i, j) for i in range(1, 6) for j in range(1, 4))
    return f"""SELECT {_TIME[dialect].format(n="event_id")} AS date_time,
{probes},
CASE WHEN m307 = 0 THEN NULL ELSE value END AS H_data
FROM (SELECT event_id, value, {remainders}, {signals} FROM {source}) shared"""


def quality_sql(dialect: str, source: str = "events") -> str:
    return f"""SELECT {_TIME[dialect].format(n="event_id + 60")} AS date_time,
0.4 * ((user_id * 5 + event_id) % 41) + 0.05 * value + 0.1 * (event_id % 13) AS quality
FROM {source} WHERE event_id % 5 = 0"""


def sensor_and_quality(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both views. The sensors are computed once per row, as a struct: a filter on them stays
    above. Pushed below it would repeat all readings' expressions, and the JVM only
    interprets a generated method that long."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    sensors = spark.sql(sensor_sql("spark", "{events}"), events=events)
    quality = spark.sql(quality_sql("spark", "{events}"), events=events)
    return sensors.select(F.inline(F.array(F.struct("*")))), quality
