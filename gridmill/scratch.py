"""Folders for intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, what: str = "gridmill") -> str:
    """A new folder that driver and executors share, removed when the session's JVM ends.

    It lies under ``spark.checkpoint.dir``; a session without that setting, as in tests, uses a
    folder of its warehouse, which is shared as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    folder = f"{root.rstrip('/')}/{what}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(path)
    return folder
