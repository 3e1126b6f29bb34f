"""The inner loops of tree growing in the JVM: ``Trees.java``, compiled when first needed.

Janino, the compiler with which Spark builds its own generated code, compiles it on the
driver; the classes reach the executors as a jar of the session. A task's table and jobs are
bytes in one broadcast row. Where any of this cannot be had, numpy does the same work and
finds the same trees.
"""

from __future__ import annotations

import atexit
import functools
import os
import shutil
import struct
import tempfile
import uuid
import zipfile

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SOURCE = os.path.join(os.path.dirname(os.path.abspath(__file__)), "Trees.java")
# Bytes of the table in a row, before all rows meet in one.
PIECE = 1 << 22


@functools.lru_cache(maxsize=1)
def _classes(application: str):
    """Instances of the functions, their jar added to the application; none if that fails."""
    spark = SparkSession.active()
    jvm = spark.sparkContext._jvm
    try:
        loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
        compiler = jvm.org.codehaus.janino.SimpleCompiler()
        compiler.setParentClassLoader(loader)
        with open(SOURCE, encoding="utf-8") as file:
            compiler.cook(file.read())
        made = compiler.getBytecodes()
        folder = tempfile.mkdtemp(prefix="chamberlens-")
        atexit.register(shutil.rmtree, folder, True)
        jar = os.path.join(folder, f"trees-{uuid.uuid4().hex}.jar")
        with zipfile.ZipFile(jar, "w") as file:
            for name in made:
                file.writestr(name.replace(".", "/") + ".class", bytes(made[name]))
        spark.sql(f"ADD JAR '{jar}'")
        loader = jvm.java.lang.Thread.currentThread().getContextClassLoader()
        nothing = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, 0)
        return {name: loader.loadClass(f"chamberlens.Trees${name}").getDeclaredConstructors()[0].newInstance(nothing) for name in ("Forest", "Boost")}
    except Exception:  # no such compiler, no place for a jar: numpy does it
        return {}


def available(spark: SparkSession) -> bool:
    return bool(_classes(spark.sparkContext.applicationId))


def results(spark: SparkSession, name: str, table: list[bytes | np.ndarray], jobs: list[bytes], partitions: int | None = None) -> DataFrame:
    """(number, result): what ``Trees.java`` makes of each job on the table, a task per job
    unless there are fewer partitions."""
    function = f"chamberlens_{name}".lower()
    binary = spark.sparkContext._jvm.org.apache.spark.sql.types.DataTypes.BinaryType
    spark._jsparkSession.udf().register(function, _classes(spark.sparkContext.applicationId)[name], binary)
    held = _pieces(spark, table).crossJoin(spark.createDataFrame([(bytearray(_indexed(jobs)),)], "jobs binary"))
    numbers = spark.range(0, len(jobs), 1, partitions or len(jobs)).toDF("number")
    return numbers.crossJoin(F.broadcast(held)).select("number", F.call_udf(function, "pieces", "jobs", "number").alias("result"))


def _pieces(spark: SparkSession, table: list[bytes | np.ndarray]) -> DataFrame:
    """One row with all bytes of a table, in pieces; an id stands at their front. An array's
    elements never lie across pieces, as all sizes of elements divide a piece."""
    parts = [np.frombuffer(uuid.uuid4().bytes[:8], np.uint8)]
    for part in table:
        flat = np.frombuffer(part, np.uint8) if isinstance(part, bytes) else np.ascontiguousarray(part).reshape(-1).view(np.uint8)
        parts += [flat[at : at + PIECE] for at in range(0, len(flat), PIECE)]
    rows = [(i, bytearray(part.tobytes())) for i, part in enumerate(parts) if len(part)]
    slices = max(1, sum(len(r[1]) for r in rows) // PIECE)
    spread = spark.createDataFrame(spark.sparkContext.parallelize(rows, slices), "i int, piece binary")
    return spread.agg(F.sort_array(F.collect_list(F.struct("i", "piece"))).getField("piece").alias("pieces"))


def _indexed(jobs: list[bytes]) -> bytes:
    starts = np.cumsum([4 * len(jobs), *(len(job) for job in jobs)])[:-1]
    return starts.astype("<i4").tobytes() + b"".join(jobs)


def packed(kinds: str, *values) -> bytes:
    return struct.pack("<" + kinds, *values)
