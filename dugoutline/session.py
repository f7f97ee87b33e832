"""Session helpers: table loading and lineage cuts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a scale directory."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back from there.

    The folder is the session's ``spark.checkpoint.dir``; one of this machine's is set only where the session
    names none and all of it runs in this process (tests).
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not shared and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="dugoutline-"))
    return df.checkpoint(eager=True)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` marked to be joined by sorting both sides, whatever size the optimizer expects.

    Rows that were exploded count as no larger than what they came from, so a join of them may be planned as a
    broadcast of any size.
    """
    return df.hint("merge")


def empty_like(spark: SparkSession, schema: str) -> DataFrame:
    """A DataFrame of ``schema`` without rows."""
    return spark.createDataFrame([], schema)
