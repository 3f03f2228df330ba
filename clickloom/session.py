"""Session settings shared by the batch jobs, the streams and the tests."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# All clock arithmetic is done in UTC; a job that wants local time passes `tz`.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins broadcast a side only once its measured size is known to be below this.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on to an existing session."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "clickloom", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without that setting (tests) gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    named = named or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    made = tempfile.mkdtemp(prefix="clickloom-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def intermediates(spark: SparkSession) -> str:
    """The folder of this application's written intermediates."""
    return f"{shared_folder(spark)}/clickloom-{spark.sparkContext.applicationId}"


def drop_intermediates(spark: SparkSession) -> None:
    """Delete what cut_lineage has written; frames built on it can't be read any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(intermediates(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of steps that are over.

    It does so for what the driver's collector finds unused, which it may not run for long.
    """
    spark.sparkContext._jvm.System.gc()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the frame as a table in the shared folder and go on from there.

    It is computed once (a checkpoint would run the plan twice), later reads
    prune its columns, and it survives the loss of any executor. A caller that is
    done with its results frees the space by drop_intermediates.
    """
    path = f"{intermediates(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
