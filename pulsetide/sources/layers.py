"""Parquet layers, as tables and as streams."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Conditions Spark reports for a missing folder, a folder without files, and the folder
# of a stream that has written none yet.
NO_FILES = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "_LEGACY_ERROR_TEMP_1134")


def read_layer(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    skip_unreadable: bool = False,
    merge_schema: bool = False,
) -> DataFrame:
    """A layer as a table, with its ``date`` partitions.

    Only ``.parquet`` files are read. ``skip_unreadable`` passes over damaged or vanished
    files, which suits serving; jobs that write a layer leave it off. ``merge_schema``
    takes the union of the columns of all files.
    """
    reader = spark.read.option("pathGlobFilter", "*.parquet")
    if schema is not None:
        reader = reader.schema(schema)
    if skip_unreadable:
        reader = reader.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.parquet(path)


def find_layer(spark: SparkSession, path: str, **options) -> DataFrame | None:
    """The layer, or ``None`` when there is no Parquet file under the path."""
    try:
        return read_layer(spark, path, **options)
    except AnalysisException as error:
        if error.getCondition() in NO_FILES:
            return None
        raise


def stream_layer(
    spark: SparkSession,
    path: str,
    schema: StructType,
    max_files: int | None = None,
) -> DataFrame:
    """A layer as a stream; a batch takes all waiting files, or ``max_files`` of them.

    A limit is unsafe before a watermark unless the files are in the order of their events:
    the files of one batch may push the watermark past rows in files that still wait. To
    bound a batch, limit what the first step reads from the broker.
    """
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
