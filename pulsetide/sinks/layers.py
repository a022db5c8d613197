"""Parquet layers: streaming append and batch overwrite, partitioned by date."""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsetide.session import stream_settings, timestamps_in_micros

STREAM_LOG = "_spark_metadata"
#: Name of the count of rows a stream writes.
WRITTEN = "written"


def append_stream(
    frame: DataFrame,
    path: str,
    checkpoint: str,
    name: str,
    every: str | None = None,
    files: int | None = None,
    date_files: int | None = None,
    codec: str = "snappy",
) -> StreamingQuery:
    """Start appending a stream to a layer.

    ``every`` is the trigger interval; without it the query takes what is there and
    stops. ``files`` coalesces each batch into that many tasks, which suits small
    streams only, so it is off by default. ``date_files`` deals each batch by date and that
    many parts of it: then a batch writes so many files per date, and not one per task and
    date, while a date with most of the rows is still written by several tasks (of which
    ``spark.sql.shuffle.partitions`` is the limit). The rows each batch writes are counted on
    the way (``streaming.progress``).
    """
    out = frame if files is None else frame.coalesce(files)
    if date_files is not None:
        out = dealt_by_date(frame, date_files)
    writer = (
        out.observe(WRITTEN, F.count(F.lit(1)).alias("rows"))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("compression", codec)
        .option("checkpointLocation", checkpoint)
        .partitionBy("date")
        .queryName(name)
    )
    with stream_settings(frame.sparkSession):
        if every:
            return writer.trigger(processingTime=every).start()
        return writer.trigger(availableNow=True).start()


def dealt_by_date(frame: DataFrame, parts: int) -> DataFrame:
    """Rows of each date in that many tasks, by their content.

    Neighbouring tasks and not hashed ones, so that no task gets two parts of a date.
    """
    tasks = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64(*frame.columns), F.lit(parts))
    task = F.pmod(F.pmod(F.xxhash64("date"), F.lit(tasks)) + part, F.lit(tasks))
    return frame.repartitionById(tasks, task.cast("int"))


def is_stream_output(spark: SparkSession, path: str) -> bool:
    """Whether a streaming sink keeps its commit log in the folder (asks the JVM's file system,
    which Spark Connect lacks)."""
    log = spark._jvm.org.apache.hadoop.fs.Path(path, STREAM_LOG)
    return log.getFileSystem(spark._jsc.hadoopConfiguration()).exists(log)


def overwrite_layer(
    frame: DataFrame,
    path: str,
    cluster_by: tuple[str, ...] = (),
    files: int | None = None,
    codec: str = "snappy",
    date_files: int | None = None,
) -> int:
    """Replace a layer and return the number of rows written.

    ``cluster_by`` range-partitions the rows by date and these columns: files hold narrow
    ranges, so a lookup skips most of them, and a date with a third of all rows is spread
    over many tasks. Without it rows are rebalanced by date: adaptive execution splits a
    large date and merges small ones, so the files of a date follow its bytes and not the
    number of tasks that read the input.
    ``files`` coalesces the job into that many tasks, which suits small layers only;
    ``date_files`` deals the rows by date and that many parts of it instead, so that the files of
    a date are bounded while the dates are written by many tasks.
    A folder a stream writes to is refused: overwriting would delete its commit log.
    """
    spark = frame.sparkSession
    if is_stream_output(spark, path):
        raise ValueError(f"{path} is the output of a stream; choose another folder")
    out = frame
    if date_files is not None:
        out = dealt_by_date(frame, date_files)
    elif cluster_by:
        keys = ["date", *cluster_by]
        out = out.repartitionByRange(*keys).sortWithinPartitions(*keys)
    elif files is None:
        out = out.hint("rebalance", "date")
    if files is not None:
        out = out.coalesce(files)
    written = Observation()
    out = out.observe(written, F.count("*").alias("rows"))
    with timestamps_in_micros(spark):
        out.write.mode("overwrite").option("compression", codec).partitionBy("date").parquet(path)
    return written.get["rows"]
