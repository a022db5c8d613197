"""Reports: baseline texts, advice prompts, key/value rows and user labels."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsetide.functions import display_number, metric_label, user_label
from pulsetide.functions.numbers import formatted
from pulsetide.model import BASELINES, METRIC_COLUMNS, METRICS, NO_BASELINE, STATISTICS


def metric_catalog(gold: DataFrame) -> DataFrame:
    """The metrics served, each with its column and the number of windows holding a value."""
    counts = gold.agg(*[F.count(METRIC_COLUMNS[metric]).alias(metric) for metric in METRICS])
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(metric).alias("metric_name"),
                        F.lit(METRIC_COLUMNS[metric]).alias("value_column"),
                        F.col(metric).alias("window_count"),
                    )
                    for metric in METRICS
                ]
            )
        )
    )


def with_baseline(frame: DataFrame) -> DataFrame:
    """Add the baseline text of ``metric_name``, or the default text.

    The lookup has one fixed entry per metric, so it is a literal and needs no join.
    """
    lookup = F.create_map(*[F.lit(part) for entry in BASELINES.items() for part in entry])
    text = F.coalesce(F.try_element_at(lookup, F.col("metric_name")), F.lit(NO_BASELINE))
    return frame.withColumn("baseline", text)


#: Stands for a number or trend that a table without time cannot have.
UNKNOWN = "unknown"


def prompt_text() -> Column:
    """The prompt of a row with statistics and ``baseline``; never null for a named series."""
    number = {
        name: F.coalesce(formatted(F.col(name), "0.0#"), F.lit(UNKNOWN))
        for name in ("min", "max", "avg", "latest")
    }
    return F.concat(
        F.lit("Metric "),
        F.col("metric_name"),
        F.lit(" of user "),
        F.col("user_id"),
        F.lit(" in the past 24 hours\nlowest: "),
        number["min"],
        F.lit("\nhighest: "),
        number["max"],
        F.lit("\nmean: "),
        number["avg"],
        F.lit("\nmost recent: "),
        number["latest"],
        F.lit("\ntrend: "),
        F.coalesce("trend", F.lit(UNKNOWN)),
        F.lit("\nhourly windows: "),
        F.col("window_count").cast("string"),
        F.lit("\nBaseline: "),
        F.col("baseline"),
        F.lit(
            "\nSuggest three to five short, practical everyday habits that fit these "
            "numbers. Give general wellness advice and no diagnosis."
        ),
    )


def advice_prompts(summary: DataFrame) -> DataFrame:
    """One record per summary row: user, metric, ``data_summary`` and the prompt text."""
    return with_baseline(summary).select(
        "user_id",
        "metric_name",
        F.struct(*STATISTICS).alias("data_summary"),
        prompt_text().alias("prompt"),
    )


def summary_rows(summary: DataFrame) -> DataFrame:
    """Each summary as ordered (position, label, value) rows of text.

    Statistics with a label come first, others follow under their own name. A row
    without a summary gives the single row ``No data``.
    """

    def text(name: str) -> Column:
        if dict(summary.dtypes)[name] == "double":
            return display_number(F.col(name))
        return F.col(name).cast("string")

    ordered = sorted(STATISTICS, key=lambda name: metric_label(name) == name)
    rows = [(metric_label(name), text(name)) for name in ordered]
    keep = [name for name in summary.columns if name not in STATISTICS]

    def entries(pairs: list[tuple[str, Column]]) -> Column:
        return F.array(
            *[
                F.struct(
                    F.lit(position).alias("position"),
                    F.lit(label).alias("label"),
                    value.alias("value"),
                )
                for position, (label, value) in enumerate(pairs, start=1)
            ]
        )

    return summary.select(
        *keep,
        F.inline(
            F.when(F.col("window_count").isNull(), entries([("No data", F.lit("-"))])).otherwise(
                entries(rows)
            )
        ),
    )


def user_labels(users: DataFrame) -> DataFrame:
    """User ids with the label shown for them."""
    return users.select("user_id", user_label(F.col("user_id")).alias("label"))
