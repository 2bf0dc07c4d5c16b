"""Stage tables in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for one run, below the shared folder of the session."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written once as Parquet and read back: computed once, and its lineage cut."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
