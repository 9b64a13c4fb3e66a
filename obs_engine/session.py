"""A local session for tests and benchmarks, and the scratch area of a session.

On a cluster the caller brings its own session; nothing in the library sets
session configuration.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(app: str = "obs_engine", cores: int | str = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may do without the setting; on a cluster a machine-local
    folder would be lost with its executor, so that is refused.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.gettempdir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch root; nothing exists there yet."""
    return f"{scratch_root(spark)}/obs_engine/{label}-{uuid.uuid4().hex}"
