"""Where jobs keep state: a folder that every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`.

    A local folder is used only where the setting is absent and the session
    runs in one process, as in tests.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder")
    return tempfile.mkdtemp(prefix="tallyloom-")


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder of its own for one job."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
