"""Exact dedup by distributed most-significant-digit radix partitioning.

The first digit of a text is its length with its first bytes. Each round splits the open
groups by the next bytes, in longer and longer digits, until a group is a single text or its
texts have ended; then its texts are equal byte for byte, without any digest.

Groups are counted with a partial aggregate and joined back to their rows, so a group with a
third of all rows is one row per task in the aggregate, and the join is one that adaptive
execution may split. From the second round on, only the bytes not yet compared travel.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetide.llm.common import body, table, written

#: Bytes in the first digit, how much longer each next digit is, and the longest digit.
FIRST, GROWTH, LONGEST = 32, 8, 1 << 20


def exact_dedup(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", carry_text: bool = True
) -> DataFrame:
    """Every row of ``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    ``docs``: the id column, the text column and any others; columns with the names of the
    result are replaced. Without ``carry_text`` the text column is left out of the result and
    texts that are alone after the first digit are never written.

    * A null text equals an empty one. A null id is smaller than any other.
    * Of equal texts the row with the largest id stays; of several such rows, one.
    * An empty table gives an empty result. Texts may be of any length.
    """
    made = ("keep_id", "group_size", "kept", "text_sha256")
    others = [c for c in docs.columns if c not in (text, *made)]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"),
        F.col(f"`{text}`").alias("text"),
        body(f"`{text}`").alias("body"),
    ).select(
        "row",
        "text",
        "body",
        F.length("body").alias("size"),
        F.substring("body", 1, FIRST).alias("head"),
        F.unhex(F.sha2("body", 256)).alias("sha"),
    )
    shared = rows.groupBy("size", "head").agg(F.count("*").alias("n")).filter("n > 1")
    opened = rows.join(shared, ["size", "head"], "left")
    is_open = F.col("n").isNotNull()
    start = written(
        opened.select(
            F.monotonically_increasing_id().alias("rid"),
            "row",
            (F.col("text") if carry_text else F.lit(None).cast("string")).alias("text"),
            "sha",
            is_open.alias("open"),
            F.when(is_open, F.col("size")).alias("size"),
            F.when(is_open, F.col("head")).alias("head"),
            F.when(is_open, F.expr(f"substring(body, {FIRST + 1})")).alias("rest"),
        ),
        "radix-start",
    )
    decided = _split(
        start.filter("open").select(
            "rid", F.col(f"row.`{id_column}`").alias("id"), "size", "head", "rest"
        )
    )
    alone = start.filter("NOT open").select(
        "row", "text", "sha", F.col(f"row.`{id_column}`").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
    )
    grouped = (
        start.filter("open")
        .join(decided, "rid")
        .select("row", "text", "sha", "keep_id", "group_size", "kept")
    )
    out = alone.unionByName(grouped)
    columns = [F.col(f"row.`{c}`").alias(c) for c in others]
    if carry_text:
        columns.append(F.col("text").alias(text))
    return out.select(
        *columns, "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")
    )


def _split(rows: DataFrame) -> DataFrame:
    """The rounds after the first: ``rid, keep_id, group_size, kept`` of every row."""
    done, keys, digit = None, ["size", "head"], FIRST
    while True:
        digit = min(digit * GROWTH, LONGEST)
        rows = rows.select(
            "rid",
            "id",
            *keys,
            F.expr(f"substring(rest, 1, {digit})").alias("digit"),
            F.expr(f"substring(rest, {digit + 1})").alias("rest"),
        )
        groups = rows.groupBy(*keys, "digit").agg(
            F.count("*").alias("group_size"),
            F.min("rid").alias("group"),
            F.max(F.struct("id", "rid")).alias("best"),
        )
        ended = (F.col("group_size") == 1) | (F.length("rest") == 0)
        level = written(
            rows.join(groups, [*keys, "digit"]).select(
                "rid",
                "id",
                F.col("group").alias("size"),
                F.lit(b"").alias("head"),
                F.when(~ended, F.col("rest")).alias("rest"),
                ended.alias("ended"),
                F.col("best.id").alias("keep_id"),
                "group_size",
                (F.col("best.rid") == F.col("rid")).alias("kept"),
            ),
            "radix-level",
        )
        finished = level.filter("ended").select("rid", "keep_id", "group_size", "kept")
        done = finished if done is None else done.unionByName(finished)
        rows = level.filter("NOT ended").select("rid", "id", "size", "head", "rest")
        if rows.isEmpty():
            return done


def op6_exact_dedup(spark, sf_dir):
    """Exact dedup of the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup(docs, carry_text=False).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


ORACLE = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
