"""Session defaults for local runs, and where shared intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, app: str = "promptsieve", **conf: str) -> SparkSession:
    """A session on this machine.  On a cluster, pass the library your own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder path under the cluster's shared checkpoint folder.

    The folder comes from `spark.checkpoint.dir`.  Where that is unset, the
    session is a local one and a folder of this machine does.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="promptsieve-")
    return f"{base.rstrip('/')}/promptsieve/{name}-{uuid.uuid4().hex}"
