"""Session settings for tests and bench, and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str, cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and bench; on a cluster the caller brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``, or set on the context.

    Where neither is set it becomes a folder inside the warehouse, which the machines of
    a cluster share too. No session, local or not, uses a machine's own folder.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """``df`` cut from its lineage by a reliable checkpoint in the shared folder.

    Unlike a cache it survives lost executors, and unlike a lineage it is not recomputed
    by every later job. It is written when called. Its files go when no table refers to
    them any more, if the session sets ``spark.cleaner.referenceTracking.cleanCheckpoints``.
    """
    scratch_root(df.sparkSession)
    return df.checkpoint()


def stored_alone(df: DataFrame) -> DataFrame:
    """:func:`stored`, the files of the shuffles behind ``df`` removed at once instead of when
    the driver next collects its garbage: jobs that follow find the disk as it was."""
    kept = stored(df)
    df._jdf.queryExecution().toRdd().cleanShuffleDependencies(True)
    return kept


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/chamberlens/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder and read it back.

    Unlike a cache the table survives lost executors, and unlike a lineage it is
    not recomputed by every later job. Returns the table and its path.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table written by :func:`materialize`."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
