"""Session set-up, and the shared folder for tables a job writes for itself."""

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# The Kafka connector for the Spark line this package is written for.
KAFKA_PACKAGE = "org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2"

SETTINGS = {
    # Text times without a zone, and the gold date, are read in this zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
    # Readers skip row groups by these; the older 96-bit form has no statistics.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Shuffle width and hot join keys are settled at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Do not record the calling line of every column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Window state lives on disk, so open windows may outgrow the executor heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above; ``settings`` use ``__`` for dots and win over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    extra = {key.replace("__", "."): value for key, value in settings.items()}
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings_for(spark: SparkSession, *keys: str) -> Iterator[None]:
    """What starts here runs with these of ``SETTINGS``, whoever built the session."""
    before = {key: spark.conf.get(key, None) for key in keys}
    for key in keys:
        spark.conf.set(key, SETTINGS[key])
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def timestamps_in_micros(spark: SparkSession):
    """Writers started here store timestamps as micros."""
    return settings_for(spark, "spark.sql.parquet.outputTimestampType")


def stream_settings(spark: SparkSession):
    """Streams started here store timestamps as micros and keep their state in RocksDB."""
    return settings_for(
        spark,
        "spark.sql.parquet.outputTimestampType",
        "spark.sql.streaming.stateStore.providerClass",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled",
    )


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the zone on a session somebody else built; it stays pinned for all its queries."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder of ``spark.checkpoint.dir``.

    Executors on other machines must see what a job writes there. Without that setting it is
    below the warehouse, which all of a cluster share too. Results are read from these folders
    after the job has returned, so their owner removes them, as with checkpoints.
    (Spark Connect has no ``sparkContext``; there, set ``spark.checkpoint.dir``.)
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        shared = os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "scratch")
    return os.path.join(shared, f"{name}-{uuid.uuid4().hex}")
