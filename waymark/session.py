"""Session settings and the shared folder that jobs use to cut lineage."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}

# What one shuffle partition should hold.
PARTITION_BYTES = 256 * 1024 * 1024


def sized_for(input_bytes: int) -> dict[str, str]:
    """Shuffle partitions for an input of this size; adaptive execution joins those that turn out small."""
    return {"spark.sql.shuffle.partitions": str(max(200, -(-input_bytes // PARTITION_BYTES)))}


def build_session(
    app: str = "waymark", master: str | None = None, input_bytes: int | None = None, **extra: str,
) -> SparkSession:
    """A session with the settings the jobs are written for; `extra` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    sized = {} if input_bytes is None else sized_for(input_bytes)
    for key, value in {**SETTINGS, **sized, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, which the driver and all executors share.

    Without that setting a local session uses a folder of its own under spark.local.dir; any other master is refused,
    since executors would not see each other's files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all executors share (master {context.master})")
    return f"{context.getConf().get('spark.local.dir', '/tmp').split(',')[0]}/waymark-{context.applicationId}"


def run_folder(spark: SparkSession) -> str:
    """The folder in the shared one that holds all intermediate tables of this application."""
    return f"{shared_folder(spark)}/waymark-run-{spark.sparkContext.applicationId}"


def drop_intermediate(spark: SparkSession) -> None:
    """Deletes the intermediate tables of this application; call it when all its results are written, since they are read from these."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def new_path(spark: SparkSession, name: str) -> str:
    """A path among the application's intermediate tables that nothing else uses."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """`df` written to the shared folder and read back, which cuts its lineage and survives lost executors.

    `compression` is Spark's name of a codec, by default the session's.
    """
    path = new_path(df.sparkSession, name)
    writer = df.write if compression is None else df.write.option("compression", compression)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fix_partitions(df: DataFrame) -> DataFrame:
    """Checkpoint `df`: later reads see the same rows in the same partitions, also after executor loss."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)
