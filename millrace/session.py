"""Session building and the few engine-wide settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

#: Settings that suit both a laptop and a cluster; sizes are left to the cluster's own configuration.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's defaults; ``conf`` overrides them (dots written as double underscores)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        b = b.config(k, v)
    return b.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only where it is unset (tests, a laptop) one of our own is used."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = os.path.join(tempfile.gettempdir(), "millrace-checkpoints")
    sc.setCheckpointDir(d)
    return d


def cut_lineage(df):
    """A reliable checkpoint: survives the loss of executors and lets later stages start from files."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
