"""SparkSession settings and the shared work folder.

The engine never assumes it owns the session: query functions call
:func:`prepare` on whatever session they are given, which pins the few
settings that change results (UTC clock, ANSI on, AQE on) and leaves sizing
knobs alone.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that change answers, not speed: pinned on every session we touch.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Skewed shuffle joins are split and small sides broadcast by measured size.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Partition values such as data=2026-07-01 stay text, exactly as landed.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

# Settings for a fresh local session (tests, bench). On a cluster these come
# from the job configuration and are sized to the data.
LOCAL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "tidewater", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's settings."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = {**LOCAL_SETTINGS, **RESULT_SETTINGS,
            "spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.driver.memory": os.environ.get("TIDEWATER_DRIVER_MEMORY", "16g")}
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin result-affecting settings on a session handed to us."""
    for k, v in RESULT_SETTINGS.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def work_dir(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables and checkpoints.

    On a cluster this is the folder named by ``spark.checkpoint.dir`` (shared
    storage every executor can reach). Only when the session has none, as in
    local tests, a scratch folder is created and registered.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        try:
            d = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect: no SparkContext
            d = None
    if not d:
        d = _LOCAL_WORK_DIRS.get(id(spark))
    if not d:
        master = spark.conf.get("spark.master", "local")
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share: "
                               f"a machine-local one can't be used with master {master}")
        d = tempfile.mkdtemp(prefix="tidewater-")
        _LOCAL_WORK_DIRS[id(spark)] = d
        try:
            spark.sparkContext.setCheckpointDir(d)
        except Exception:  # core settings may be read-only at runtime
            pass
    return d.rstrip("/")


_LOCAL_WORK_DIRS: dict[int, str] = {}


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared work folder."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


LISTING_PARALLELISM = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def tune_file_listing(spark: SparkSession) -> None:
    """A landing zone has one folder per day: list them with a few tasks per core.

    Spark's default launches up to one listing task per folder (10000); for
    thousands of small day folders the task overhead dominates. A value the
    user has set is left alone.
    """
    if spark.conf.get(LISTING_PARALLELISM, "10000") != "10000":
        return
    try:
        cores = spark.sparkContext.defaultParallelism
    except Exception:  # Spark Connect: no SparkContext
        return
    spark.conf.set(LISTING_PARALLELISM, str(max(8, cores * 4)))
