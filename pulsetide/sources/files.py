"""The files of a layer: how many a date has, and what their footers say."""

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def files_by_date(layer: DataFrame) -> DataFrame:
    """``date, files, row_count``: the files that hold the rows of each date.

    ``layer`` is a table as read, since only such rows know their file.
    """
    rows = layer.select("date", F.col("_metadata.file_path").alias("file"))
    # Rows per file first: one row per file and task is shuffled.
    per_file = rows.groupBy("date", "file").agg(F.count("*").alias("n"))
    return per_file.groupBy("date").agg(F.count("*").alias("files"), F.sum("n").alias("row_count"))


def parquet_footers(spark: SparkSession, path: str) -> DataFrame:
    """``file, codec, row_groups, row_count`` of every Parquet file below a folder.

    Spark lists the files without reading them; tasks read the footers alone, through
    pyarrow's file systems (local and shared folders, HDFS, S3, GCS). A file whose columns are
    compressed differently names all codecs.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [footer(name) for name in batch.column("path").to_pylist()]
            if rows:
                columns = [pa.array(column) for column in zip(*rows)]
                yield pa.RecordBatch.from_arrays(columns, ["file", "codec", "row_groups", "row_count"])

    return listing.mapInArrow(run, "file string, codec string, row_groups bigint, row_count bigint")


def footer(name: str) -> tuple[str, str, int, int]:
    """File, codecs, row groups and rows of one Parquet file."""
    if name.startswith("file:"):
        store, place = pafs.LocalFileSystem(), "/" + name[len("file:") :].lstrip("/")
    else:
        store, place = pafs.FileSystem.from_uri(name)
    with store.open_input_file(place) as opened:
        found = pq.ParquetFile(opened).metadata
        groups = [found.row_group(nr) for nr in range(found.num_row_groups)]
        codecs = {group.column(nr).compression.lower() for group in groups for nr in range(group.num_columns)}
        return name, "+".join(sorted(codecs)), found.num_row_groups, found.num_rows
