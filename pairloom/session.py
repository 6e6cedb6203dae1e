"""Spark session helpers.

Cluster settings (shuffle partitions, checkpoint folder, memory) belong to
whoever launches the job; these helpers only fill in what is unset so that
tests and the local bench run with sane values.
"""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app_name: str = "pairloom") -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("PAIRLOOM_DRIVER_MEMORY", "16g"))
    )
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts: the one ``spark.checkpoint.dir`` (or
    the context) names.

    Only a local master may go without: it gets a scratch folder.  On a
    cluster a missing setting is an error, because executors would write to
    folders of their own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="pairloom-ckpt-")
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir() or named


@contextmanager
def batches_of(spark: SparkSession, rows: int | None) -> Iterator[None]:
    """What is run in here hands Python batches of at most ``rows`` rows: a batch is held whole, in the JVM and in Python."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if rows is not None and not 0 < int(before) <= rows:
        spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)
