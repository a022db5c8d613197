"""What a streaming query has done, batch by batch, as a table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pulsetide.sinks.layers import WRITTEN

BATCHES = (
    "layer string, batch bigint, read_rows bigint, written_rows bigint, late_groups bigint, "
    "state_rows bigint, watermark string"
)


def batch_rows(query: StreamingQuery, layer: str) -> list[tuple]:
    """One row per batch of the query's run, from its progress events.

    Spark keeps the last ``spark.sql.streaming.numRecentProgressUpdates`` of them (100). An
    idle query reports the number of its next batch again and again; the last report of a
    number is that of the batch itself.
    """
    found = {}
    for event in query.recentProgress:
        counted = event.observedMetrics.get(WRITTEN)
        found[event.batchId] = (
            layer,
            event.batchId,
            event.numInputRows,
            counted.rows if counted else 0,
            sum(state.numRowsDroppedByWatermark for state in event.stateOperators),
            sum(state.numRowsTotal for state in event.stateOperators),
            event.eventTime.get("watermark"),
        )
    return list(found.values())


def batches(spark: SparkSession, queries: dict[str, StreamingQuery]) -> DataFrame:
    """Batches of the queries of some layers; a query may still run or have ended.

    ``read_rows`` come from the source, ``written_rows`` went to the layer, and
    ``late_groups`` are groups of rows (user and window) that came behind the watermark.
    """
    rows = [row for layer, query in queries.items() for row in batch_rows(query, layer)]
    return spark.createDataFrame(rows, BATCHES)
