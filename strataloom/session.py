"""Session construction and lineage cutting that survives executor loss."""

from __future__ import annotations

import gc
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "strataloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and the time zone pinned to UTC."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for key, value in (defaults | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: the one the cluster names in
    ``spark.checkpoint.dir``. Without that setting only a session whose executors
    all run in the driver's process gets a temporary folder; any other is refused."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", "") or context.getConf().get("spark.checkpoint.dir", "")
        if not named and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="strataloom-"))
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and cut its lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let the driver forget frames that nothing refers to any more, so that their shuffle and checkpoint files are removed.

    Call it between the steps of a long chain: a driver with a large heap collects so seldom that files of all steps pile up.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def schema_text(df: DataFrame) -> str:
    """The DDL of a frame, with every name quoted."""
    return ", ".join(f"`{name}` {kind}" for name, kind in df.dtypes)
