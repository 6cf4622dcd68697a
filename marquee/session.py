"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the operators are written for.  All are settable on a
# live session; none changes a result.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even where that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Text and model stages are heavy per byte: let small shuffles keep several tasks.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.sql.session.timeZone": "UTC",
    # Of whole texts, what a task hands to Python at once; it lies in the JVM, on the way and in Python.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    # Shuffle files go when the table or result they served is there, not when the driver's garbage is collected.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the recommended runtime settings, leaving alone what the session was configured with."""
    configured = spark.sparkContext.getConf()
    for key, value in RECOMMENDED.items():
        if not configured.contains(key):
            spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for written tables, checkpoints and stream state.

    The cluster names it in ``spark.checkpoint.dir``; else it lies in the
    warehouse, which every executor reaches as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    return root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; every call gets its own."""
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def checkpointing(spark: SparkSession) -> SparkSession:
    """Sees to it that iterative algorithms can checkpoint: in the folder of ``spark.checkpoint.dir``, which Spark
    sets by itself, or under the shared scratch folder where that is not configured."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{scratch_root(spark).rstrip('/')}/checkpoints")
    return spark


def shared_path(spark: SparkSession, label: str, of: str) -> str:
    """The folder in which this application keeps what it derives once from the data at ``of``."""
    digest = uuid.uuid5(uuid.NAMESPACE_URL, of).hex
    return f"{scratch_root(spark).rstrip('/')}/{label}-{spark.sparkContext.applicationId}-{digest}"


def materialise(df, label: str):
    """Cut lineage by writing a table to the shared folder and reading it back."""
    path = scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
