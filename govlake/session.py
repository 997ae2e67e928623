"""Session settings the library expects; pass your own session to use a cluster's."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = 8, app: str = "govlake", shuffle_partitions: int = 8,
                  **conf: str) -> SparkSession:
    """A single-machine session for tests and benches.

    On a cluster take the session the platform gives you: adaptive execution (on by default)
    sizes shuffle partitions and splits skewed joins from run-time statistics.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach, under the one the cluster names in
    spark.checkpoint.dir. Only where that is unset, as in tests, a local one is made."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="govlake-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def prepare_checkpoints(spark: SparkSession) -> None:
    """Point checkpoint() at the shared folder, unless the session already has one."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark, "checkpoints"))


def cut(df: DataFrame) -> DataFrame:
    """The rows written once to the checkpoint folder: a lost executor costs a reread."""
    prepare_checkpoints(df.sparkSession)
    return df.checkpoint()


def kept(df: DataFrame) -> DataFrame:
    """The rows written once to the shared folder as Parquet: smaller than a checkpoint, and a reader
    takes only the columns it needs. For relations that are read many times."""
    folder = shared_folder(df.sparkSession, "kept")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
