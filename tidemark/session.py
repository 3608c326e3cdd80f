"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from tidemark.errors import ConfigurationError

# What the jobs rely on: run-time re-planning with skew splitting, and UTC times.
# The last setting spares the driver a stack trace per Column expression.
SESSION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def apply_session_conf(spark: SparkSession) -> SparkSession:
    for name, value in SESSION_CONF.items():
        spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str | None:
    """The cluster's ``spark.checkpoint.dir``, or None where it is unset."""
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder name for intermediate tables that every executor can reach."""
    base = shared_folder(spark)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ConfigurationError(
                "Set spark.checkpoint.dir to a folder that all executors share."
            )
        base = tempfile.mkdtemp(prefix="tidemark-")
    return f"{base.rstrip('/')}/tidemark/{label}-{uuid.uuid4().hex}"
