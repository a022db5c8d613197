"""Streaming runs over the sample events, for the queries that show what streams do.

Events arrive in steps: a step's records are written to the topic's folder, and the streams
go on before the next step comes. The topic is a folder of broker-shaped records; its rows, and
with them the work, grow with ``events``.
"""

from collections.abc import Callable
from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetide.model import GOLD, LAYERS, SILVER
from pulsetide.operators.bronze import to_bronze
from pulsetide.operators.gold import hourly
from pulsetide.operators.silver import to_silver
from pulsetide.session import scratch_path, use_utc
from pulsetide.sinks.layers import overwrite_layer
from pulsetide.sources.events import ARRIVALS, HALF, arrivals, halves, kafka_records
from pulsetide.sources.files import files_by_date, parquet_footers
from pulsetide.sources.layers import read_layer
from pulsetide.streaming.jobs import layer_path, start_bronze, start_gold, start_silver
from pulsetide.streaming.progress import batches

ASAP = "0 seconds"


def events_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample events, in a session pinned to UTC."""
    return use_utc(spark).read.parquet(f"{sf_dir}/events.parquet")


def arrive(records: DataFrame, root: str) -> DataFrame:
    """Add records to the topic's folder and return the folder as a stream."""
    records.write.mode("append").parquet(f"{root}/topic")
    return records.sparkSession.readStream.schema(records.schema).parquet(f"{root}/topic")


def in_steps(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """All layers of events that arrive in steps, some late; the root, and batches of silver and gold.

    Bronze catches up after each step. Silver and gold are started once and keep running while
    files are added: silver looks for them every second, gold as soon as it is free.
    """
    root = scratch_path(spark, "in-steps")
    events = arrivals(events_of(spark, sf_dir))
    running = {}
    with ExitStack() as stack:
        for step in range(ARRIVALS):
            topic = arrive(kafka_records(events.filter(F.col("arrival") == step)), root)
            start_bronze(topic, root).awaitTermination()
            for layer, begin in (("silver", lambda: start_silver(spark, root, "1 second")), ("gold", lambda: start_gold(spark, root, ASAP))):
                if layer not in running:
                    running[layer] = begin()
                    stack.callback(running[layer].stop)
                running[layer].processAllAvailable()
    return root, batches(spark, running)


def with_input(done: DataFrame, layer: str) -> DataFrame:
    """The batches of a layer that read rows, counted from 0."""
    rows = sorted(row for row in done.filter(F.col("layer") == layer).collect() if row.read_rows)
    frame = [(step, *row[2:5]) for step, row in enumerate(rows)]
    return done.sparkSession.createDataFrame(
        frame, "step bigint, read_rows bigint, written_rows bigint, late_groups bigint"
    )


def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that gold read with each step, and how many windows of users came too late."""
    return with_input(in_steps(spark, sf_dir)[1], "gold").select("step", "read_rows", "late_groups")


def late_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gold layer of events that arrive in steps: late rows are in no window."""
    return read_layer(spark, layer_path(in_steps(spark, sf_dir)[0], "gold"), GOLD)


def trigger_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a silver stream with a time trigger wrote, batch by batch."""
    # Not those it read: the reader skips row groups without a row that silver keeps.
    return with_input(in_steps(spark, sf_dir)[1], "silver").select("step", "written_rows")


def in_halves(spark: SparkSession, sf_dir: str, after_each: Callable[[DataFrame, str, int], None]) -> str:
    """Let the first half of the events arrive, then the second; what each does is given."""
    root = scratch_path(spark, "in-halves")
    for nr, half in enumerate(halves(events_of(spark, sf_dir))):
        after_each(arrive(kafka_records(half), root), root, nr)
    return root


def restart_no_dupes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of a running query that was stopped with open windows and started anew.

    The second query finds offsets and window state in the checkpoint of the first.
    """

    def chain(topic: DataFrame, root: str, nr: int) -> None:
        start_bronze(topic, root).awaitTermination()
        start_silver(spark, root).awaitTermination()
        gold = start_gold(spark, root, ASAP)
        try:
            gold.processAllAvailable()
        finally:
            gold.stop()

    return read_layer(spark, layer_path(in_halves(spark, sf_dir, chain), "gold"), GOLD)


def file_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and rows per layer and date, of streams that write one file per date and batch."""

    def chain(topic: DataFrame, root: str, nr: int) -> None:
        start_bronze(topic, root, date_files=1).awaitTermination()
        start_silver(spark, root, date_files=1).awaitTermination()
        start_gold(spark, root, date_files=1).awaitTermination()

    root = in_halves(spark, sf_dir, chain)
    counted = [
        files_by_date(read_layer(spark, layer_path(root, name), schema)).select(F.lit(name).alias("layer"), "*")
        for name, schema in LAYERS.items()
    ]
    bronze, silver, gold = counted
    return bronze.union(silver).union(gold)


def stream_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the streams of all layers wrote, as counted on their way to the files."""
    done = []

    def chain(topic: DataFrame, root: str, nr: int) -> None:
        for layer, begin in (
            ("bronze", lambda: start_bronze(topic, root)),
            ("silver", lambda: start_silver(spark, root)),
            ("gold", lambda: start_gold(spark, root)),
        ):
            query = begin()
            query.awaitTermination()
            done.append(batches(spark, {layer: query}))

    in_halves(spark, sf_dir, chain)
    whole = done[0]
    for part in done[1:]:
        whole = whole.union(part)
    return whole.groupBy("layer").agg(F.sum("written_rows").alias("row_count"))


def bronze_stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze whose arrival stamps are given: a time for one batch, a column for the next."""

    def chain(topic: DataFrame, root: str, nr: int) -> None:
        stamp = F.col("timestamp") + F.expr("INTERVAL 5 MINUTES") if nr else "2024-02-01T00:00:00Z"
        start_bronze(topic, root, ingested_at=stamp).awaitTermination()

    root = in_halves(spark, sf_dir, chain)
    return read_layer(spark, layer_path(root, "bronze"), LAYERS["bronze"])


def layer_codecs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and rows per layer and codec, as the files' footers have them.

    Bronze is a batch, silver a stream, gold a batch with the default codec; all of one file per date.
    """
    root = scratch_path(spark, "codecs")
    bronze = to_bronze(kafka_records(events_of(spark, sf_dir)))
    overwrite_layer(bronze, layer_path(root, "bronze"), codec="zstd", date_files=1)
    start_silver(spark, root, date_files=1, codec="gzip").awaitTermination()
    silver = read_layer(spark, layer_path(root, "silver"), SILVER)
    overwrite_layer(hourly(silver), layer_path(root, "gold"), date_files=1)
    counted = [
        parquet_footers(spark, layer_path(root, name)).select(F.lit(name).alias("layer"), "codec", "row_count")
        for name in LAYERS
    ]
    whole = counted[0].union(counted[1]).union(counted[2])
    return whole.groupBy("layer", "codec").agg(F.count("*").alias("files"), F.sum("row_count").alias("row_count"))


def corrupt_file_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver read past a damaged file and one that vanishes after the folder was listed."""
    path = scratch_path(spark, "damaged")
    overwrite_layer(to_silver(to_bronze(kafka_records(events_of(spark, sf_dir)))), path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    store = hadoop.Path(path).getFileSystem(conf)
    day = f"{path}/date=2024-01-10"
    whole = hadoop.Path(read_layer(spark, day).select("_metadata.file_path").first()[0])
    vanishing = hadoop.Path(f"{day}/vanishing.parquet")
    hadoop.FileUtil.copy(store, whole, store, vanishing, False, conf)
    with_damage = store.create(hadoop.Path(f"{day}/damaged.parquet"))
    with_damage.write(bytearray(b"PAR1 this is no footer PAR1"))
    with_damage.close()
    layer = read_layer(spark, path, SILVER, skip_unreadable=True)
    store.delete(vanishing, False)
    return layer
