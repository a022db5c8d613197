"""What each command-line job does."""

import os
from argparse import Namespace
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pulsetide.model import TOPIC, TRIGGERS
from pulsetide.operators.quality import dq_checks
from pulsetide.operators.reports import prompt_text, with_baseline
from pulsetide.operators.requests import answer_requests
from pulsetide.operators.series import available_users
from pulsetide.plans.batch import write_gold
from pulsetide.session import KAFKA_PACKAGE, session
from pulsetide.sources.kafka import kafka_source
from pulsetide.sources.layers import find_layer
from pulsetide.streaming.jobs import layer_path, start_bronze, start_gold, start_silver


def run(options: Namespace) -> None:
    """Run one job to its end; a running stream ends when it is stopped."""
    settings = {"spark__jars__packages": packages(options)} if options.job == "bronze" else {}
    spark = session(f"pulsetide-{options.job}", **settings)
    if options.job in TRIGGERS and not options.batch:
        start(spark, options).awaitTermination()
    elif options.job == "gold":
        rows = write_gold(spark, options.root, options.out, options.files)
        print(f"{rows['read']} silver rows read, {rows['written']} hourly rows written")
    elif options.batch:
        raise SystemExit(f"--batch is for gold, not for {options.job}")
    elif options.out:
        report(spark, options).write.json(options.out)
    else:
        show_all(report(spark, options))


def packages(options: Namespace) -> str:
    """The Kafka connector beside what spark-defaults and ``--packages`` ask for."""
    home = os.environ.get("SPARK_CONF_DIR") or os.path.join(os.environ.get("SPARK_HOME", ""), "conf")
    defaults = Path(home, "spark-defaults.conf")
    lines = defaults.read_text().splitlines() if defaults.is_file() else []
    configured = [
        line.split(None, 1)[1] for line in lines if line.split()[:1] == ["spark.jars.packages"]
    ]
    asked = ",".join([KAFKA_PACKAGE, *configured, *options.packages]).split(",")
    return ",".join(dict.fromkeys(name.strip() for name in asked if name.strip()))


def show_all(table: DataFrame) -> None:
    """Print every row; one partition at a time reaches the driver."""
    print("|" + "|".join(table.columns) + "|")
    for row in table.toLocalIterator(prefetchPartitions=True):
        print("|" + "|".join(str(value) for value in row) + "|")


def start(spark: SparkSession, options: Namespace) -> StreamingQuery:
    """The streaming query of a layer."""
    every = None if options.once else options.every or TRIGGERS[options.job]
    if options.job == "bronze":
        extra = dict(option.split("=", 1) for option in options.option)
        records = kafka_source(spark, options.brokers, options.topic or TOPIC, **extra)
        return start_bronze(
            records, options.root, every, options.files, date_files=options.date_files, codec=options.codec
        )
    begin = start_silver if options.job == "silver" else start_gold
    return begin(
        spark,
        options.root,
        every,
        options.files,
        options.max_files or None,
        date_files=options.date_files,
        codec=options.codec,
    )


def report(spark: SparkSession, options: Namespace) -> DataFrame:
    """The table a query job prints."""
    if options.job == "check":
        layers = [find_layer(spark, layer_path(options.root, name)) for name in TRIGGERS]
        return dq_checks(spark, *layers)
    gold = find_layer(spark, layer_path(options.root, "gold"), skip_unreadable=True)
    if options.job == "users":
        if gold is None:
            return spark.createDataFrame([], "user_id string")
        return available_users(gold)
    request = spark.createDataFrame(
        [(options.user, options.metric)], "user_id string, metric_name string"
    )
    answered = answer_requests(request, gold, options.as_of, users=[options.user])
    flat = answered.select("user_id", "metric_name", "status", "data_summary", "data_summary.*")
    return with_baseline(flat).select(
        "user_id",
        "metric_name",
        "status",
        "data_summary",
        F.when(F.col("data_summary").isNotNull(), prompt_text()).alias("prompt"),
    )
