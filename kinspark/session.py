"""Session construction, table access and durable lineage cuts."""

from __future__ import annotations

import os
import tempfile

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_session(app: str = "kinspark", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings every operator assumes: UTC, AQE, Arrow."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", shuffle_partitions)
    return (
        b.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the session names; only a local session may fall
    back to a folder of this machine."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = "file://" + os.path.join(tempfile.gettempdir(), f"kinspark-{os.getpid()}")
    sc.setCheckpointDir(named)


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage by writing to the shared checkpoint folder (survives the loss
    of executors)."""
    _ensure_checkpoint_dir(df.sparkSession)
    return _measured(df.checkpoint(eager=True))


def _measured(df: DataFrame) -> DataFrame:
    """A checkpoint keeps the size that was estimated for its plan, the product of
    all joins that led to it. Over the rounds of an iteration that number grows
    without bound, in digits too, and where it is too small, large tables are
    broadcast. The size of the written files takes its place."""
    spark = df.sparkSession
    try:
        jvm, plan = spark._jvm, df._jdf.queryExecution().logical()
        folder = jvm.org.apache.hadoop.fs.Path(plan.rdd().getCheckpointFile().get())
        size = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
        # A range has 8 bytes a row.
        stats = jvm.scala.Some(spark.range(size // 8 + 1)._jdf.queryExecution().logical().stats())
        none = getattr(getattr(jvm, "scala.None$"), "MODULE$")
        parts = (plan.output(), plan.rdd(), plan.outputPartitioning(), plan.outputOrdering(), plan.isStreaming(), plan.stream())
        exact = jvm.org.apache.spark.sql.execution.LogicalRDD(*parts, spark._jsparkSession, stats, none)
        return DataFrame(jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, exact), spark)
    except (Py4JError, TypeError, AttributeError):  # another version of Spark: as it is
        return df


def first_delivery(df: DataFrame, key: str, version: str = "loaded_at") -> DataFrame:
    """One row per key: the one delivered first. Rows of a repeated delivery are
    alike but for ``version``. Rows whose key is null are no records and drop out."""
    rest = [c for c in df.columns if c not in (key, version)]
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min(F.struct(F.col(version), *[F.col(c) for c in rest])).alias("_r"))
        .select(key, "_r.*")
    )
