"""Session helpers: building a session for tests/bench and cutting lineage safely."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "tagwise") -> SparkSession:
    """Session for tests and the bench. On a cluster the caller's session is used instead."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` (or a folder already set on the context) is used as is. Only a single-JVM
    ``local`` master, where driver and executors are one process, may fall back to a scratch folder of its
    own; on a cluster a missing setting is an error, because executors would each write to their own disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="tagwise-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def state_path(spark: SparkSession, name: str = "state") -> str:
    """A fresh path inside the shared checkpoint folder (a new run id each time)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tagwise-{name}/{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Fit barrier: write the table into the shared checkpoint folder and read it back.

    A written table survives executor loss (unlike localCheckpoint) and cuts the lineage so later
    stages never recompute the fit; it costs one job (a reliable ``checkpoint()`` costs two).
    """
    path = state_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
