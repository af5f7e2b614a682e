"""Session helpers for tests and the bench script.

Library code never changes session settings; it only reads them. The one
exception is the checkpoint directory: it is taken from the session
(``spark.checkpoint.dir`` or the context's directory). Where the session names
none, a local session gets a scratch folder that goes with the process, and any
other raises, since executors elsewhere couldn't see a folder of this machine.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "larder") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LARDER_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect sessions expose no SparkContext
        return None


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only if unset."""
    sc = _context(spark)
    current = None
    if sc is not None:
        try:
            current = sc.getCheckpointDir()
        except Exception:
            current = None
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="larder-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    if sc is not None:
        sc.setCheckpointDir(configured)
    return configured


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder: what follows reads it from there."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
