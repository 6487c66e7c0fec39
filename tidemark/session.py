"""Spark session defaults and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(app: str = "tidemark", cores: int | str = "*", **conf: str) -> SparkSession:
    """Local session for tests and the bench. A cluster brings its own session."""
    builder = (
        SparkSession.builder.appName(app)
        .master(f"local[{cores}]")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach, below ``spark.checkpoint.dir``
    or, where that is unset, the context's checkpoint folder.

    A machine-local folder is used only when the setting is absent and the session
    is local; on a cluster a missing setting is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = tempfile.mkdtemp(prefix="tidemark-")
    return f"{shared.rstrip('/')}/tidemark/{purpose}-{uuid.uuid4().hex}"
