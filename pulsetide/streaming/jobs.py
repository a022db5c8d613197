"""The three streaming queries: topic to bronze, bronze to silver, silver to gold.

Each is a query of its own, chained through files. ``every=None`` takes what is there
and stops, for backfills and tests; a time keeps the query running. The options of the sink
(``files``, ``date_files``, ``codec``) are those of ``append_stream``.
"""

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pulsetide.model import BRONZE, SILVER, STREAM_NAMES, WATERMARK
from pulsetide.operators.bronze import to_bronze
from pulsetide.operators.gold import hourly
from pulsetide.operators.silver import to_silver
from pulsetide.sinks.layers import append_stream
from pulsetide.sources.layers import stream_layer


def layer_path(root: str, layer: str) -> str:
    """Folder of a layer."""
    return f"{root.rstrip('/')}/{layer}"


def checkpoint_path(root: str, layer: str) -> str:
    """Checkpoint folder of the query that writes a layer."""
    return f"{root.rstrip('/')}/checkpoints/{layer}"


def append_layer(
    frame: DataFrame,
    root: str,
    layer: str,
    every: str | None = None,
    files: int | None = None,
    date_files: int | None = None,
    codec: str = "snappy",
) -> StreamingQuery:
    """Append a stream to a layer below ``root``, under the layer's query name."""
    return append_stream(
        frame,
        layer_path(root, layer),
        checkpoint_path(root, layer),
        STREAM_NAMES[layer],
        every,
        files,
        date_files,
        codec,
    )


def start_bronze(
    records: DataFrame,
    root: str,
    every: str | None = None,
    files: int | None = None,
    ingested_at: Column | datetime | str | None = None,
    date_files: int | None = None,
    codec: str = "snappy",
) -> StreamingQuery:
    """Broker records (any stream of that shape) to bronze; ``ingested_at`` as in ``to_bronze``."""
    bronze = to_bronze(records, ingested_at)
    return append_layer(bronze, root, "bronze", every, files, date_files, codec)


def start_silver(
    spark: SparkSession,
    root: str,
    every: str | None = None,
    files: int | None = None,
    max_files: int | None = None,
    date_files: int | None = None,
    codec: str = "snappy",
) -> StreamingQuery:
    """Bronze to silver."""
    bronze = stream_layer(spark, layer_path(root, "bronze"), BRONZE, max_files)
    return append_layer(to_silver(bronze), root, "silver", every, files, date_files, codec)


def start_gold(
    spark: SparkSession,
    root: str,
    every: str | None = None,
    files: int | None = None,
    max_files: int | None = None,
    watermark: str = WATERMARK,
    date_files: int | None = None,
    codec: str = "snappy",
) -> StreamingQuery:
    """Silver to gold: a window is written once, when the watermark has passed its end.

    ``max_files`` is for silver files in the order of their events (see ``stream_layer``).
    The number of state partitions is ``spark.sql.shuffle.partitions`` at the first
    start and stays with the checkpoint; choose it for the widest hour to come.
    """
    silver = stream_layer(spark, layer_path(root, "silver"), SILVER, max_files)
    return append_layer(hourly(silver, watermark), root, "gold", every, files, date_files, codec)
