"""Session settings the library expects, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    # Text dates carry no zone, and reports must not move with the driver's clock.
    "spark.sql.session.timeZone": "UTC",
    # Overflow must fail the stage, never turn into NULL.
    "spark.sql.ansi.enabled": "true",
    # Joins start as shuffles unless a side is measured small; AQE then switches to a
    # broadcast or splits a hot key (the online store holds a large share of all lines).
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JIT leaves methods beyond this size interpreted; Spark then generates smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(app_name: str, cores: str = "8", **extra: str) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app_name)
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def settings_for(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings for a while; what held before holds again afterwards."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local session may fall back to a temporary folder: elsewhere the executors
    would not see it.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder all executors share.")
        folder = tempfile.mkdtemp(prefix="tallyroll-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path for one run under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
