"""Where a plan is cut: a table computed once, kept where all executors can read it."""

from __future__ import annotations

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """df computed now and once, from files in the checkpoint folder: later steps have a short plan, and outlive executors.

    The cluster names the folder in spark.checkpoint.dir; where that is unset on one machine (tests), it is /tmp/checkpoints."""
    spark = df.sparkSession
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(base or "/tmp/checkpoints")
    return df.checkpoint()
