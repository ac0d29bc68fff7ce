"""Session settings that the engine is designed for; a cluster's own settings win."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tidemill", master: str | None = None, **extra: str) -> SparkSession:
    """A session with adaptive execution on; `master` only where no cluster sets one."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        b = b.master(master).config("spark.driver.memory", os.environ.get("TIDEMILL_DRIVER_MEMORY", "8g"))
    for k, v in extra.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir. Where none is set, a folder of its own on a single machine; on a cluster that is an error, as no machine's own folder is seen by the others."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
            named = tempfile.mkdtemp(prefix="tidemill-checkpoint-")
            atexit.register(shutil.rmtree, named, ignore_errors=True)
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def settled(df: DataFrame) -> DataFrame:
    """`df` cut from its lineage by a reliable checkpoint: later stages read it and do not compute it again, and lost executors cost no more than their share of it."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """`df` written as Parquet in the shared checkpoint folder and read again: for texts, which a checkpoint holds uncompressed and reads whole where a few columns are asked for."""
    path = f"{checkpoint_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
