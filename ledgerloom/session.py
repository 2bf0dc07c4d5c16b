"""Session settings the jobs rely on."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Changes are written and not whole files; rows are not counted, which takes a read for each write.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def build_session(app: str = "ledgerloom", master: str | None = None, **conf: str) -> SparkSession:
    """Start (or reuse) a session; ``conf`` keys use ``__`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **STREAM_SETTINGS,
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpointed(df: DataFrame) -> DataFrame:
    """The frame's rows, written once to the shared folder.

    For frames that are dear to compute and read more than once.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


# Hashes in hex and addresses take about half the space that the default codec leaves them.
CODEC = "zstd"


def stored(df: DataFrame) -> DataFrame:
    """As :func:`checkpointed`, as a table: its files are by columns and compressed, those of a checkpoint are not.

    A checkpoint also computes the frame twice.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/stored-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Where that is unset, a folder below the warehouse in local mode, and an error on a
    cluster, whose executors may not share the warehouse.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints"
    spark.sparkContext.setCheckpointDir(folder)
    return folder
