"""URL filters: a sort-merge range join of urls and nested host rules.

A host becomes a canonical key: its labels reversed, each followed by a dot, so that a host
and all its subdomains share a prefix, and a rule is an interval of keys. Urls are dealt to
ranges of keys, rules to every range they reach into, and a sorted sweep of each range keeps
the stack of rules whose interval is still open. No table of rules is broadcast: at a range's
lower end only the rules of the hosts above it are repeated.
"""

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsetide.llm.common import partitions, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Keys sampled per range to place the ranges' ends. It moves work between tasks only.
KEYS_PER_RANGE = 100

#: The list of op1_url_filters: verdict, host, path.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, "://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column) -> Column:
    """Reversed labels, each with a dot; empty for the empty host, which is above all."""
    reversed_labels = F.array_join(F.reverse(F.split(host, r"\.", -1)), ".")
    return F.when(host == "", "").otherwise(F.concat(reversed_labels, F.lit(".")))


def filter_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow"
) -> DataFrame:
    """Every row of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has ``verdict``, ``host`` and ``path``. A rule fits its host and all subdomains
    where the url's path starts with the rule's. The longest (host and path together) wins,
    of equally long ones that with the longer host; of two verdicts for one rule, block.
    Without a rule, ``rule`` is null and ``verdict`` is ``default``.

    * A null url, or one without ``://``, has an empty host and path.
    * Rules with a null verdict or host are left out; a null path is empty.
    * Repeated rows are judged each; columns named like the result are replaced.
    * Without rules every url gets the default; without urls the result is empty.
    """
    spark, made = pages.sparkSession, ("host", "path", "rule", "verdict")
    kept = [c for c in pages.columns if c not in made]
    urls = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"),
        host_of(F.col(f"`{url}`")).alias("host"),
        path_of(F.col(f"`{url}`")).alias("path"),
        F.monotonically_increasing_id().alias("salt"),
    ).withColumn("key", canonical(F.col("host")))
    listed = (
        rules.filter("verdict IS NOT NULL AND host IS NOT NULL")
        .select(
            F.translate("host", UPPER, LOWER).alias("host"),
            F.coalesce("path", F.lit("")).alias("path"),
            "verdict",
        )
        .withColumn("key", canonical(F.col("host")))
    )
    ranges = partitions(spark)
    ends = _ends(urls.select("key"), ranges)

    @F.pandas_udf("int")
    def range_of(keys: pd.Series, salts: pd.Series) -> pd.Series:
        # Equal ends mark a key with many urls: those are spread over all its ranges.
        low = [bisect_left(ends, key) for key in keys]
        high = [bisect_right(ends, key) for key in keys]
        return pd.Series([a + s % (b - a + 1) for a, b, s in zip(low, high, salts)], dtype="int32")

    @F.pandas_udf("array<int>")
    def ranges_of(keys: pd.Series) -> pd.Series:
        return pd.Series(
            [
                list(
                    range(
                        bisect_left(ends, key),
                        bisect_right(ends, key, key=lambda end, n=len(key): end[:n]) + 1,
                    )
                )
                for key in keys
            ]
        )

    events = urls.select(
        range_of("key", "salt").alias("range"), "key", F.lit(1).alias("kind"),
        "host", "path", F.lit(None).cast("string").alias("verdict"), "row",
    ).unionByName(
        listed.select(
            F.explode(ranges_of("key")).alias("range"), "key", F.lit(0).alias("kind"),
            "host", "path", "verdict",
            F.lit(None).cast(urls.schema["row"].dataType).alias("row"),
        )
    )
    schema = T.StructType(
        [T.StructField("row", urls.schema["row"].dataType)]
        + [T.StructField(c, T.StringType()) for c in made]
    )
    swept = (
        events.repartition(ranges, "range")
        .sortWithinPartitions("range", "key", "kind")
        .mapInArrow(_sweep(default), schema)
    )
    return swept.select(*[F.col(f"row.`{c}`").alias(c) for c in kept], *made)


def _ends(keys: DataFrame, ranges: int) -> list[str]:
    """Upper ends of all ranges but the last, from a sample bounded by the ranges."""
    total = keys.count()
    if ranges < 2 or not total:
        return []
    share = min(1.0, KEYS_PER_RANGE * ranges / total)
    sample = sorted(row.key for row in keys.sample(share, 1).limit(2 * KEYS_PER_RANGE * ranges).collect())
    return [sample[len(sample) * i // ranges] for i in range(1, ranges)] if sample else []


class _Open:
    """A host on the stack: its key, and its rules by path."""

    def __init__(self, key: str, host: str):
        self.key, self.host, self.paths, self.lengths = key, host, {}, []

    def add(self, path: str, verdict: str) -> None:
        if self.paths.get(path) != "block":
            self.paths[path] = verdict
        if len(path) not in self.lengths:
            self.lengths = sorted([*self.lengths, len(path)], reverse=True)

    def longest(self, path: str) -> str | None:
        for length in self.lengths:
            if length <= len(path) and path[:length] in self.paths:
                return path[:length]
        return None


def _sweep(default: str):
    """The sweep of sorted rules and urls of whole ranges."""

    def judged(stack: list[_Open], path: str) -> tuple[str | None, str]:
        found = [(host, fit) for host in stack if (fit := host.longest(path)) is not None]
        if not found:
            return None, default
        host, fit = max(found, key=lambda x: (len(x[0].host) + len(x[1]), len(x[0].host)))
        return host.host + fit, host.paths[fit]

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[_Open] = []
        at = None
        for batch in batches:
            rule_column, verdict_column = [], []
            names = ("range", "key", "kind", "host", "path", "verdict")
            for of, key, kind, host, path, verdict in zip(
                *[batch.column(name).to_pylist() for name in names]
            ):
                if of != at:
                    stack, at = [], of
                while stack and not key.startswith(stack[-1].key):
                    stack.pop()
                if kind:
                    rule, verdict = judged(stack, path)
                    rule_column.append(rule)
                    verdict_column.append(verdict)
                else:
                    if not stack or stack[-1].key != key:
                        stack.append(_Open(key, host))
                    stack[-1].add(path, verdict)
            urls = batch.filter(pa.compute.equal(batch.column("kind"), 1))
            yield pa.RecordBatch.from_arrays(
                [
                    urls.column("row"),
                    urls.column("host"),
                    urls.column("path"),
                    pa.array(rule_column, pa.string()),
                    pa.array(verdict_column, pa.string()),
                ],
                ["row", "host", "path", "rule", "verdict"],
            )

    return sweep


def op1_url_filters(spark, sf_dir):
    """Judge every url of ``pages`` by the fixed list."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    return filter_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


ORACLE = r"""
WITH rules(verdict, host, path) AS (VALUES
  ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
urls AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path,
    row_number() OVER () AS nr
  FROM pages),
fits AS (
  SELECT nr, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
    arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM urls u JOIN rules r
    ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
  GROUP BY nr)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM urls LEFT JOIN fits USING (nr)
"""
