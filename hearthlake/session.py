"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """A new folder name under the shared folder the cluster names in its settings.

    Without that setting a local session gets a temporary folder; a cluster gets an
    error, because its executors share no local disk.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
        root = tempfile.mkdtemp(prefix="hearthlake-")
        spark.conf.set(CHECKPOINT_SETTING, root)
    return f"{root.rstrip('/')}/hearthlake-{uuid.uuid4().hex}"


def staged(frame: DataFrame) -> DataFrame:
    """The frame written to the shared folder, for what is read twice and costly to compute."""
    folder = shared_folder(frame.sparkSession)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)
