"""Session settings that the engine expects."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def session(app: str = "tagloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with DEFAULTS; ``conf`` and an existing cluster configuration win over them."""
    b = SparkSession.builder.appName(app)
    if master or "SPARK_MASTER" in os.environ:
        b = b.master(master or os.environ["SPARK_MASTER"])
    return b.config(map=DEFAULTS | conf).getOrCreate()
