"""Session defaults, table access and the guards other modules share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows above which a lookup side is joined by shuffle instead of broadcast.
BROADCAST_ROWS = 100_000


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidemark") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of a data directory (a file or a folder of files)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of a data directory as a stream, be it a file or a folder of files.

    A source named by a plain path has to be a folder; one named by a pattern may be either.
    """
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(f"{sf_dir}/[{name[0]}]{name[1:]}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores if it comes in fewer pieces than there are, as a table of one small file does.

    Larger tables come in more pieces and are left as they are, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for reliable checkpoints.

    A cluster names it in ``spark.checkpoint.dir``. A machine-local folder is
    made only when the setting is absent and the master is local, as in tests.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir", None)
    if named:
        if not context.getCheckpointDir():
            context.setCheckpointDir(named)
        return named
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def materialized(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder, with its lineage cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, *partition_by: str) -> DataFrame:
    """``df`` as a parquet table in the shared checkpoint folder, read back: smaller than a checkpoint, and read by column and partition.

    The folder stays until whoever owns the checkpoint folder clears it, as results that are not computed yet read it.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/tables/{uuid.uuid4().hex}"
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lookup(small: DataFrame, bound: int = BROADCAST_ROWS) -> DataFrame:
    """``small`` as a broadcast side if it has at most ``bound`` rows, else unchanged.

    At most ``bound + 1`` rows are read to the driver to find out, so the
    broadcast has a proven size; larger sides stay an ordinary shuffle join.
    """
    rows = small.limit(bound + 1).collect()
    if len(rows) > bound:
        return small
    return F.broadcast(small.sparkSession.createDataFrame(rows, small.schema))


def buckets_for(rows: int, per_bucket: int, least: int = 8) -> int:
    """How many hash buckets keep the average bucket under ``per_bucket`` rows."""
    return max(least, -(-rows // per_bucket))
