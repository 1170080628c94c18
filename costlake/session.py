"""Session helpers: where scratch data lives and how lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the cluster.

    ``spark.checkpoint.dir`` is read from the session. Only a local session without the setting
    picks a folder of its own; on a cluster that folder would not be shared, so it is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    picked = tempfile.mkdtemp(prefix="costlake-")
    spark.conf.set("spark.checkpoint.dir", picked)
    return picked


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`shared_dir`, never reused between runs."""
    return f"{shared_dir(spark).rstrip('/')}/costlake/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into reliable storage and continue from there."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
