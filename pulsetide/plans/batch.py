"""Batch twins of the streaming queries, over the same operators."""

from pyspark.sql import DataFrame, SparkSession

from pulsetide.model import BRONZE, SILVER
from pulsetide.operators.bronze import to_bronze
from pulsetide.operators.gold import hourly
from pulsetide.operators.silver import to_silver
from pulsetide.sinks.layers import overwrite_layer
from pulsetide.sources.layers import read_layer
from pulsetide.streaming.jobs import layer_path


def write_bronze(records: DataFrame, root: str, files: int | None = None) -> int:
    """Broker records to bronze; returns the rows written."""
    return overwrite_layer(to_bronze(records), layer_path(root, "bronze"), files=files)


def write_silver(spark: SparkSession, root: str, files: int | None = None) -> int:
    """Bronze to silver; returns the rows written."""
    bronze = read_layer(spark, layer_path(root, "bronze"), BRONZE)
    return overwrite_layer(to_silver(bronze), layer_path(root, "silver"), files=files)


def write_gold(
    spark: SparkSession, root: str, out: str | None = None, files: int | None = None
) -> dict[str, int]:
    """Silver to gold, open windows included; returns the rows read and written.

    The silver count comes from file footers. Gold files hold narrow (date, user) ranges.
    """
    silver = read_layer(spark, layer_path(root, "silver"), SILVER)
    read = silver.count()
    written = overwrite_layer(
        hourly(silver), out or layer_path(root, "gold"), ("user_id", "window_start"), files
    )
    return {"read": read, "written": written}
