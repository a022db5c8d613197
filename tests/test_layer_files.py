"""What written layers look like, and what serving prints and reads."""

from types import SimpleNamespace

from conftest import final_plan
from pyspark.sql import functions as F
from test_summary import AS_OF, points, wide

from pulsetide.operators.reports import advice_prompts
from pulsetide.operators.series import recent
from pulsetide.operators.summary import summarise
from pulsetide.plans.command import packages, show_all
from pulsetide.sinks.layers import append_stream, overwrite_layer
from pulsetide.sources.layers import read_layer
from pulsetide.streaming.jobs import start_bronze, start_gold, start_silver


def parquet_files(path):
    return list(path.rglob("*.parquet"))


def test_every_user_is_printed(spark, capsys):
    show_all(spark.range(1500).selectExpr("concat('user_', id) AS user_id").repartition(5))
    printed = capsys.readouterr().out.splitlines()
    assert len(printed) == 1501 and len(set(printed)) == 1501


def test_recent_skips_row_groups(spark, tmp_path):
    rows = spark.range(200_000).selectExpr(
        "concat('u', id % 100) AS user_id",
        "timestamp'2024-01-30 00:00:00' + make_interval(0,0,0,0,0,0,id % 86400) AS window_start",
        "timestamp'2024-01-30 01:00:00' + make_interval(0,0,0,0,0,0,id % 86400) AS window_end",
        "1.0D AS avg_heart_rate", "1.0D AS avg_spo2", "1L AS total_steps", "date'2024-01-30' AS date",
    )
    spark.conf.set("parquet.block.size", "100000")
    try:
        overwrite_layer(rows.coalesce(1).orderBy("window_end"), str(tmp_path / "gold"), files=1)
    finally:
        spark.conf.unset("parquet.block.size")
    layer = read_layer(spark, str(tmp_path / "gold"))
    kept = recent(layer, "2024-01-31T20:00:00Z")
    assert kept.count() < layer.count()
    text = final_plan(kept)
    assert "GreaterThanOrEqual(window_end" in text
    import pyarrow.parquet as pq

    (file,) = parquet_files(tmp_path / "gold")
    found = pq.ParquetFile(file)
    assert str(found.schema_arrow.field("window_end").type).startswith("timestamp[us")
    place = found.schema_arrow.names.index("window_end")
    groups = [found.metadata.row_group(i) for i in range(found.metadata.num_row_groups)]
    # Row groups whose largest time lies before the look-back are skipped by the reader.
    earliest = kept.agg(F.min("window_end").cast("timestamp_ntz")).first()[0]
    ends = [group.column(place).statistics.max.replace(tzinfo=None) for group in groups]
    assert len(groups) > 2 and sum(end < earliest for end in ends) >= len(groups) // 2


def test_files_follow_bytes_and_not_tasks(spark, tmp_path):
    frame = spark.range(4000).selectExpr(
        "id", "date_add(date'2024-01-01', CAST(id % 5 AS int)) AS date"
    ).repartition(40)
    overwrite_layer(frame, str(tmp_path / "batch"))
    assert len(parquet_files(tmp_path / "batch")) <= 10
    frame.write.parquet(str(tmp_path / "source"))
    stream = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "source"))
    append_stream(
        stream, str(tmp_path / "stream"), str(tmp_path / "c"), "dated", date_files=3
    ).awaitTermination()
    assert len(parquet_files(tmp_path / "stream")) <= 15
    assert spark.read.parquet(str(tmp_path / "stream")).count() == 4000


def test_shuffles_of_summaries(spark):
    hourly_plan = final_plan(summarise(wide(spark, [("u1", 1, 70.0, 97.0, 10)] * 3), AS_OF))
    assert hourly_plan.count("Exchange hashpartitioning") == 1
    rows = [("u1", "steps", 1, 1.0), ("u1", "steps", 2, 2.0)]
    pointwise = final_plan(summarise(points(spark, rows), AS_OF))
    assert pointwise.count("Exchange hashpartitioning") <= 3


def test_prompt_of_a_table_without_time(spark):
    table = spark.createDataFrame([("u1", "steps", 5.0)], "user_id string, metric_name string, value double")
    (row,) = advice_prompts(summarise(table)).collect()
    assert "most recent: unknown" in row.prompt and "trend: unknown" in row.prompt


def test_configured_packages_stay(tmp_path, monkeypatch):
    (tmp_path / "spark-defaults.conf").write_text("spark.jars.packages  org.a:b:1,org.c:d:2\n")
    monkeypatch.setenv("SPARK_CONF_DIR", str(tmp_path))
    found = packages(SimpleNamespace(packages=["org.e:f:3"])).split(",")
    assert found[0].startswith("org.apache.spark:spark-sql-kafka") and found[1:] == ["org.a:b:1", "org.c:d:2", "org.e:f:3"]


def test_backlog_of_many_splits_loses_nothing(spark, tmp_path):
    from pulsetide.operators.bronze import to_bronze
    from pulsetide.operators.gold import hourly
    from pulsetide.operators.silver import to_silver
    from pulsetide.sources.events import kafka_records

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    records = kafka_records(events)
    records.repartition(32).write.parquet(str(tmp_path / "topic"))
    root = str(tmp_path / "layers")
    start_bronze(spark.readStream.schema(records.schema).parquet(str(tmp_path / "topic")), root).awaitTermination()
    start_silver(spark, root).awaitTermination()
    query = start_gold(spark, root)
    query.awaitTermination()
    dropped = [s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"]]
    assert sum(dropped) == 0
    silver = to_silver(to_bronze(records))
    end = silver.agg(F.max(F.to_timestamp("timestamp")) - F.expr("INTERVAL 15 MINUTES")).first()[0]
    closed = hourly(silver).filter(F.col("window_end") <= F.lit(end))
    assert read_layer(spark, f"{root}/gold").count() == closed.count()
