"""Files of streams, progress of streams, footers, arrival stamps."""

import os

import pytest
from conftest import event, records, rows
from pyspark.sql import functions as F

from pulsetide.model import BRONZE, GOLD, SILVER
from pulsetide.operators.bronze import to_bronze
from pulsetide.operators.silver import to_silver
from pulsetide.plans import runs
from pulsetide.sinks.layers import append_stream, overwrite_layer
from pulsetide.sources.files import files_by_date, parquet_footers
from pulsetide.sources.layers import read_layer
from pulsetide.streaming.jobs import start_bronze, start_gold, start_silver
from pulsetide.streaming.progress import batches


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def topic(spark, root, payloads):
    return runs.arrive(records(spark, payloads), root)


def at(day, clock="10:05"):
    return f"2026-01-{day:02}T{clock}:00Z"


def test_files_per_date_are_as_asked(spark, tmp_path):
    frame = spark.range(6000).selectExpr(
        "id", "date_add(date'2024-01-01', CAST(id % 11 AS int)) AS date"
    )
    frame.repartition(30).write.parquet(str(tmp_path / "source"))
    for parts in (1, 3, 50):
        stream = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "source"))
        path = str(tmp_path / f"stream{parts}")
        append_stream(stream, path, f"{path}-c", f"dated{parts}", date_files=parts).awaitTermination()
        got = files_by_date(spark.read.parquet(path)).collect()
        # Not more than there are tasks, of which the session has eight.
        assert {r.files for r in got} == {min(parts, 8)} and sum(r.row_count for r in got) == 6000


def test_jobs_bound_files_and_choose_a_codec(spark, root):
    source = topic(spark, root, [event(at=at(d), user=f"u{n}") for d in (2, 3) for n in range(40)] + ["not json"])
    start_bronze(source, root, date_files=2, codec="zstd").awaitTermination()
    start_silver(spark, root, date_files=1, codec="gzip").awaitTermination()
    bronze = rows(files_by_date(read_layer(spark, f"{root}/bronze", BRONZE)), "files", "row_count")
    assert bronze == [(1, 1), (2, 40), (2, 40)]  # the row without a date has one part
    assert rows(files_by_date(read_layer(spark, f"{root}/silver", SILVER)), "files", "row_count") == [(1, 40)] * 2
    assert {r.codec for r in parquet_footers(spark, f"{root}/bronze").collect()} == {"zstd"}
    assert {(r.codec, r.row_count) for r in parquet_footers(spark, f"{root}/silver").collect()} == {("gzip", 40)}


def test_footers_count_rows_and_name_all_codecs(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    table = pa.table({"a": [1, 2, 3], "b": ["x", "y", "z"]})
    pq.write_table(table, tmp_path / "mixed.parquet", compression={"a": "snappy", "b": "gzip"}, row_group_size=2)
    pq.write_table(table.slice(0, 0), tmp_path / "empty.parquet", compression="zstd")
    (tmp_path / "note.txt").write_text("not parquet")
    found = {os.path.basename(r.file): tuple(r)[1:] for r in parquet_footers(spark, str(tmp_path)).collect()}
    assert found["mixed.parquet"] == ("gzip+snappy", 2, 3) and found["empty.parquet"][2] == 0 and len(found) == 2


def test_unreadable_files_fail_without_the_option(spark, tmp_path):
    path = str(tmp_path / "silver")
    overwrite_layer(to_silver(to_bronze(records(spark, [event(at=at(2)), event(at=at(3))]))), path)
    (tmp_path / "silver/date=2026-01-02/damaged.parquet").write_bytes(b"PAR1 no footer PAR1")
    assert read_layer(spark, path, SILVER, skip_unreadable=True).count() == 2
    with pytest.raises(Exception, match="(?i)parquet"):
        read_layer(spark, path, SILVER).select("user_id").collect()
    (tmp_path / "silver/date=2026-01-02/damaged.parquet").unlink()
    strict, lenient = read_layer(spark, path, SILVER), read_layer(spark, path, SILVER, skip_unreadable=True)
    for file in (tmp_path / "silver/date=2026-01-02").glob("*.parquet"):
        file.unlink()
    assert lenient.select("user_id").collect() == [("u1",)]
    with pytest.raises(Exception, match="(?i)not exist|FILE_NOT_EXIST|not found"):
        strict.select("user_id").collect()


def test_stamp_of_the_batch_and_of_the_record(spark):
    frame = records(spark, [event()]).withColumn("timestamp", F.lit("2026-01-02T10:06:00Z").cast("timestamp"))
    given = to_bronze(frame, F.col("timestamp")).selectExpr("CAST(ingestion_timestamp AS string)").first()[0]
    assert given == "2026-01-02 10:06:00"
    for stamped in (to_bronze(frame), to_bronze(frame, "2026-03-01T00:00:00Z")):
        assert stamped.schema.simpleString() == BRONZE.simpleString()


def test_progress_of_running_streams(spark, root):
    source = topic(spark, root, [event(at=at(2)), event(at=at(2, "11:30")), event(hr=10)])
    start_bronze(source, root).awaitTermination()
    start_silver(spark, root).awaitTermination()
    gold = start_gold(spark, root, "0 seconds")
    try:
        gold.processAllAvailable()
        topic(spark, root, [event(at=at(2, "10:07")), event(at=at(2, "11:40"))])
        start_bronze(source, root).awaitTermination()
        silver = start_silver(spark, root)
        silver.awaitTermination()
        gold.processAllAvailable()
        done = batches(spark, {"silver": silver, "gold": gold})
    finally:
        gold.stop()
    read = [(r.layer, r.read_rows, r.written_rows, r.late_groups) for r in done.orderBy("layer", "batch").collect() if r.read_rows]
    # 10:07 came after its window was written.
    assert read == [("gold", 2, 0, 0), ("gold", 2, 0, 1), ("silver", 2, 2, 0)]
    assert done.filter("layer = 'gold'").agg(F.sum("written_rows")).first()[0] == 1
    assert rows(read_layer(spark, f"{root}/gold", GOLD), "event_count") == [(1,)]
    assert done.filter("layer = 'gold' AND state_rows > 0 AND watermark IS NOT NULL").count() > 0


def test_streams_keep_state_in_rocksdb_whoever_built_the_session(spark, root, setting):
    key = "spark.sql.streaming.stateStore.providerClass"
    other = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    setting(key, other)
    start_bronze(topic(spark, root, [event(), event(at=at(2, "12:00"))]), root).awaitTermination()
    start_silver(spark, root).awaitTermination()
    gold = start_gold(spark, root)
    gold.awaitTermination()
    assert any("rocksdb" in str(state.customMetrics).lower() for p in gold.recentProgress for state in p.stateOperators)
    assert spark.conf.get(key) == other


def test_a_layer_of_one_file_per_date_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    days = [at(d) for d in range(1, 21)]
    monkeypatch.setattr(runs, "events_of", lambda spark, sf_dir: None)
    monkeypatch.setattr(runs, "kafka_records", lambda frame: records(spark, [event(at=a, user=f"u{n}") for a in days for n in range(5)]))
    monkeypatch.setattr(runs, "scratch_path", lambda spark, name: str(tmp_path / name))
    got = {(r.layer, r.codec, r.files) for r in runs.layer_codecs(spark, "").collect()}
    assert {x[:2] for x in got} == {("bronze", "zstd"), ("silver", "gzip"), ("gold", "snappy")}
    for layer, _, files in got:
        names = [n for _, _, some in os.walk(tmp_path / "codecs" / layer) for n in some if n.startswith("part-")]
        dates = [d for d in os.listdir(tmp_path / "codecs" / layer) if d.startswith("date=")]
        assert files == len(names) == len(dates) >= 19
        assert len({n.split("-")[1] for n in names}) > 2, layer  # numbers of the tasks that wrote them
