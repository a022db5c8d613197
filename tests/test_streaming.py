"""Streaming queries: lateness, restarts, chained layers, and equality with batch."""

import os
from types import SimpleNamespace

import pytest
from conftest import event, records, rows

from pulsetide.model import SILVER, STREAM_NAMES
from pulsetide.operators.bronze import to_bronze
from pulsetide.operators.gold import hourly
from pulsetide.operators.silver import to_silver
from pulsetide.plans.batch import write_bronze, write_gold, write_silver
from pulsetide.plans.command import run
from pulsetide.sinks.layers import overwrite_layer
from pulsetide.sources.layers import find_layer, read_layer, stream_layer
from pulsetide.streaming.jobs import start_bronze, start_gold, start_silver

RECORD = "key binary, value binary, topic string, partition int, offset bigint"


def add_silver(spark, root, number, *times):
    """One more silver file, younger than those before it."""
    frame = to_silver(to_bronze(records(spark, [event(at=t) for t in times])))
    frame = frame.drop("date").coalesce(1)
    part = f"{root}/silver/date=2026-01-02"
    frame.write.mode("append").parquet(part)
    for name in os.listdir(part):
        path = os.path.join(part, name)
        if name.endswith(".parquet") and os.path.getmtime(path) > 2_000_000:
            os.utime(path, (1_000_000 + number, 1_000_000 + number))


def at(clock):
    return f"2026-01-02T{clock}:00Z"


def gold_hours(spark, root):
    frame = read_layer(spark, f"{root}/gold")
    return rows(frame.selectExpr("hour(window_start)", "event_count"))


def run_gold(spark, root, **options):
    query = start_gold(spark, root, **options)
    query.awaitTermination()
    return query


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def test_late_rows(spark, root):
    for number, clock in enumerate(["10:05", "11:16", "10:41", "10:42", "12:30"]):
        add_silver(spark, root, number, at(clock))
    query = run_gold(spark, root, max_files=1)
    assert query.name == STREAM_NAMES["gold"]
    # 10:41 came while its window was open, 10:42 did not; 12:30's window never closed.
    assert gold_hours(spark, root) == [(10, 2), (11, 1)]
    dropped = [
        state.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for state in progress.stateOperators
    ]
    assert sum(dropped) == 1


def test_restart_adds_nothing_twice(spark, root):
    add_silver(spark, root, 0, at("10:05"), at("11:30"))
    run_gold(spark, root)
    assert gold_hours(spark, root) == [(10, 1)]
    run_gold(spark, root)
    assert gold_hours(spark, root) == [(10, 1)]
    add_silver(spark, root, 1, at("11:40"), at("12:20"))
    run_gold(spark, root)
    assert gold_hours(spark, root) == [(10, 1), (11, 2)]


def topic_folder(spark, root, *batches):
    """Files of Kafka-shaped records, one per batch, as a stand-in for a topic."""
    for number, payloads in enumerate(batches):
        frame = records(spark, payloads).selectExpr(
            "key", "value", "topic", "partition", f"offset + {number} * 1000 AS offset"
        )
        frame.coalesce(1).write.mode("append").parquet(f"{root}/topic")
    return spark.readStream.schema(RECORD).parquet(f"{root}/topic")


BATCHES = (
    [
        event(at=at("10:05")),
        event(at=at("10:15"), hr=140),
        event(at=at("10:20"), hr=10),
        "not json",
    ],
    [event(at=at("11:00")), event(user="u2", at=at("10:59")), event(user=None, at=at("10:30"))],
    [event(at=at("12:40"))],
)


def run_chain(spark, root, records_stream):
    """All three layers, each until it has caught up."""
    for query in (
        lambda: start_bronze(records_stream, root),
        lambda: start_silver(spark, root),
        lambda: start_gold(spark, root),
    ):
        query().awaitTermination()


def test_three_layers_chained_equal_batch(spark, root):
    source = topic_folder(spark, root, *BATCHES)
    run_chain(spark, root, source)
    everything = spark.read.schema(RECORD).parquet(f"{root}/topic")
    bronze = to_bronze(everything)
    silver = to_silver(bronze)
    gold = hourly(silver)
    for name, batch in [("bronze", bronze), ("silver", silver)]:
        columns = [c for c in batch.columns if c != "ingestion_timestamp"]
        assert rows(read_layer(spark, f"{root}/{name}"), *columns) == rows(batch, *columns)
    closed = gold.filter("window_end <= timestamp'2026-01-02T12:25:00Z'")
    streamed = read_layer(spark, f"{root}/gold")
    assert rows(streamed, *gold.columns) == rows(closed)
    assert closed.count() == 4
    # A row without a date has a partition of its own.
    assert os.path.isdir(f"{root}/bronze/date=__HIVE_DEFAULT_PARTITION__")


def test_new_data_flows_through_a_restarted_chain(spark, root):
    run_chain(spark, root, topic_folder(spark, root, BATCHES[0]))
    assert find_layer(spark, f"{root}/gold") is None
    run_chain(spark, root, topic_folder(spark, root, BATCHES[1], BATCHES[2]))
    # Two rows of the first run, and one each of another user and of none; then 11:00.
    assert gold_hours(spark, root) == [(10, 1), (10, 1), (10, 2), (11, 1)]


def test_batch_jobs_write_the_same_layers(spark, root):
    topic_folder(spark, root, *BATCHES)
    write_bronze(spark.read.schema(RECORD).parquet(f"{root}/topic"), root)
    assert write_silver(spark, root) == 6
    assert write_gold(spark, root) == {"read": 6, "written": 5}
    # Open windows are in a batch layer too.
    assert gold_hours(spark, root) == [(10, 1), (10, 1), (10, 2), (11, 1), (12, 1)]


def test_overwriting_a_stream_output_is_refused(spark, root):
    run_chain(spark, root, topic_folder(spark, root, *BATCHES))
    before = gold_hours(spark, root)
    with pytest.raises(ValueError, match="output of a stream"):
        write_gold(spark, root)
    assert gold_hours(spark, root) == before
    assert write_gold(spark, root, out=f"{root}/gold_batch")["written"] == 5


def test_limit_of_files_per_batch(spark, root):
    for number in range(4):
        add_silver(spark, root, number, at("10:05"))

    def batches(max_files):
        query = (
            stream_layer(spark, f"{root}/silver", SILVER, max_files)
            .writeStream.format("noop")
            .option("checkpointLocation", f"{root}/c{max_files}")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return [p.numInputRows for p in query.recentProgress if p.numInputRows]

    assert batches(2) == [2, 2]
    assert batches(None) == [4]


def test_timed_trigger_keeps_running(spark, root):
    overwrite_layer(to_silver(to_bronze(records(spark, [event()]))), f"{root}/silver")
    query = start_gold(spark, root, every="1 second", files=1)
    query.processAllAvailable()
    assert query.isActive
    query.stop()


def test_command_line_jobs(spark, root, capsys, monkeypatch):
    monkeypatch.setattr("pulsetide.plans.command.session", lambda name, **_: spark)
    topic_folder(spark, root, *BATCHES)
    write_bronze(spark.read.schema(RECORD).parquet(f"{root}/topic"), root)

    def command(job, **options):
        defaults = {
            "root": root, "batch": False, "once": True, "every": None, "files": None,
            "max_files": None, "date_files": 2, "codec": "zstd", "out": None, "user": None, "metric": None, "as_of": None,
        }
        run(SimpleNamespace(job=job, **{**defaults, **options}))
        return capsys.readouterr().out

    command("silver")
    assert "6 silver rows read, 5 hourly rows written" in command("gold", batch=True)
    assert "u2" in command("users")
    assert command("check").count("passed") == 11  # one bronze row has no user
    command("summary", user="u1", metric="steps", out=f"{root}/answer")
    (answer,) = spark.read.json(f"{root}/answer").collect()
    assert answer["status"] == "no_recent_data"
    shown = command("summary", user="u1", metric="steps", as_of="2026-01-02T13:00:00Z")
    assert "|ok" in shown and "Metric steps of user u1" in shown
    with pytest.raises(SystemExit):
        command("silver", batch=True)


def test_users_command_without_gold(spark, root, capsys, monkeypatch):
    monkeypatch.setattr("pulsetide.plans.command.session", lambda name, **_: spark)
    options = SimpleNamespace(job="users", root=root, batch=False, out=f"{root}/users")
    run(options)
    assert spark.read.text(f"{root}/users").count() == 0
