"""Session defaults and the shared working folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_local_scratch: dict[str, str] = {}


def build_session(
    app_name: str = "lavra",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
    **conf: str,
) -> SparkSession:
    """Session with adaptive execution on and UTC times.

    ``master`` (which turns the UI off), ``shuffle_partitions`` and
    ``driver_memory`` are for local runs;
    on a cluster leave them out, so that spark-submit decides and adaptive
    execution sizes the shuffles from ``initialPartitionNum``.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Rows without a key fill all partitions alike, so a hot key stands out less.
        .config("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "3.0")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name for an intermediate table, on storage all executors see.

    The folder lies under ``spark.checkpoint.dir``. Only a local master may go
    without that setting: it then gets a temporary folder, removed at exit.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = _local_base(spark)
    return f"{base.rstrip('/')}/lavra/{label}-{uuid.uuid4().hex}"


def _local_base(spark: SparkSession) -> str:
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: on a cluster, intermediate tables need a "
            "shared folder"
        )
    if context.applicationId not in _local_scratch:
        folder = tempfile.mkdtemp(prefix="lavra-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_scratch[context.applicationId] = folder
    return _local_scratch[context.applicationId]
