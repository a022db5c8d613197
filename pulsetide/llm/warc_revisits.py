"""Not-modified revisits of web captures: as-of join to the latest earlier full response.

A server that answers "304 Not Modified" sends no body, so an archive's record of it points to
an earlier capture. Each such revisit is joined by canonical url to the latest full response
before it, its validators are compared with that response's, and the headers that a 304 may
update are merged into the response's.

Captures of one url are split into time slices. The last full response of a slice comes from a
partial aggregate, and what a slice inherits from those before is looked up over one row per
slice; only the captures of one slice of one url are ever ordered together. All of it is
built-in functions.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pulsetide.llm.common import table

#: Seconds of a time slice.
SLICE = 6 * 3600

#: Headers that a 304 may update (fixed values of the HTTP standard).
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "vary"]

CAPTURE = (
    "record_id string, url string, captured long, status int, etag string, "
    "last_modified string, headers map<string,string>, payload_digest string"
)


def canonical_url(url: Column) -> Column:
    """Host (lower case, without ``www.`` and default port), path and query.

    The scheme, the fragment, a slash at the end of the path and ``utm_`` parameters do not
    count. Without ``://`` the text itself, lower-cased, is the key.
    """
    rest = F.regexp_extract(url, "://([^#]*)", 1)
    host = F.lower(F.regexp_extract(rest, "^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(host, "^www[.]", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, "^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(rest, "[?](.*)$", 1)
    query = F.regexp_replace(F.regexp_replace(query, "(^|&)utm_[^&]*", ""), "^&", "")
    whole = F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(F.contains(url, F.lit("://")), whole).otherwise(F.lower(url))


def _validator(etag: Column) -> Column:
    """An entity tag for weak comparison."""
    return F.regexp_replace(etag, "^W/", "")


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """Every capture with ``canonical``, ``outcome``, ``resolved_id`` and merged ``headers``.

    ``captures`` has the columns of ``CAPTURE`` and any others; status 200 is a full response,
    304 a revisit. Earlier means a smaller (``captured``, ``record_id``). Outcomes:

    * ``full``: a full response, resolved to itself; ``other``: any other status, or none.
    * ``resolved``: the revisit's validators fit. If both sides have entity tags these decide
      (compared weakly), else both sides' modification times, else both payload digests.
      Headers are the response's, updated by those the revisit may update; ``payload_digest``
      is the response's.
    * ``unchecked``: there is no validator that both sides have; merged like ``resolved``.
    * ``changed``: the validators differ; nothing is taken over.
    * ``missing``: no earlier full response, or the url or time is null.

    Rows that repeat are resolved each; a null header map is empty; columns named like the
    result are replaced. An empty table stays empty.
    """
    kept = [c for c in captures.columns if c not in ("canonical", "outcome", "resolved_id")]
    rows = captures.select(*[F.col(f"`{c}`") for c in kept]).withColumns(
        {
            "canonical": canonical_url(F.col("url")),
            "headers": F.coalesce("headers", F.create_map().cast("map<string,string>")),
        }
    ).withColumn("__slice", F.floor(F.col("captured") / SLICE))
    full = (F.col("status") == 200) & F.col("captured").isNotNull()
    response = F.when(
        full,
        F.struct("captured", "record_id", "etag", "last_modified", "payload_digest",
                 F.map_entries("headers").alias("headers")),
    )
    # An array orders and compares; a map does not.
    rows = rows.withColumn("__own", response)
    known = rows.filter("canonical IS NOT NULL AND __own IS NOT NULL")
    last = known.groupBy("canonical", "__slice").agg(F.max("__own").alias("__last"))
    wanted = rows.filter("canonical IS NOT NULL").select("canonical", "__slice").distinct()
    slices = wanted.join(last, ["canonical", "__slice"], "left")
    before = W.partitionBy("canonical").orderBy("__slice").rowsBetween(W.unboundedPreceding, -1)
    inherited = slices.select(
        "canonical", "__slice", F.last("__last", ignorenulls=True).over(before).alias("__before")
    )
    within = (
        W.partitionBy("canonical", "__slice")
        .orderBy("captured", "record_id")
        .rangeBetween(W.unboundedPreceding, W.currentRow)
    )
    # Rows of equal time and id are peers; a revisit's own row is never a full response.
    found = rows.join(inherited, ["canonical", "__slice"], "left").withColumn(
        "__found", F.coalesce(F.last("__own", ignorenulls=True).over(within), "__before")
    )
    old = lambda name: F.col(f"__found.{name}")
    differs = F.coalesce(
        _validator(F.col("etag")) != _validator(old("etag")),
        F.col("last_modified") != old("last_modified"),
        F.col("payload_digest") != old("payload_digest"),
    )
    outcome = (
        F.when(F.col("status") == 200, "full")
        .when(~F.coalesce(F.col("status") == 304, F.lit(False)), "other")
        .when(F.col("canonical").isNull() | F.col("captured").isNull() | F.col("__found").isNull(), "missing")
        .when(differs.isNull(), "unchecked")
        .when(differs, "changed")
        .otherwise("resolved")
    )
    news = F.map_filter("headers", lambda k, _: F.lower(k).isin(PERMITTED))
    names = F.transform(F.map_keys(news), lambda k: F.lower(k))
    olds = F.map_filter(F.map_from_entries(old("headers")), lambda k, _: ~F.array_contains(names, F.lower(k)))
    taken = F.col("outcome").isin("resolved", "unchecked")
    columns = {
        "headers": F.when(taken, F.map_concat(olds, news)).otherwise(F.col("headers")),
        "payload_digest": F.when(taken, old("payload_digest")).otherwise(F.col("payload_digest")),
    }
    return found.withColumn("outcome", outcome).select(
        *[columns[c].alias(c) if c in columns else F.col(f"`{c}`") for c in kept],
        "canonical",
        "outcome",
        F.when(F.col("outcome") == "full", F.col("record_id")).when(taken, old("record_id")).alias("resolved_id"),
    )


def captures_of(pages: DataFrame) -> DataFrame:
    """A capture log of ``pages``: each page is fetched in full and revisited on later days.

    The second revisit of every third page has another entity tag; some pages lack entity tags
    or modification times; every eleventh has a revisit before its first full response.
    """
    base = F.lit(1704067200) + F.coalesce("page_id", F.lit(0)) * 60
    page = F.coalesce("page_id", F.lit(0))
    html = F.coalesce("html", F.lit(""))
    day = 86400

    def record(nr, after, status, url, etag, digest, headers):
        return F.struct(
            F.concat_ws("-", F.col("page_id").cast("string"), F.lit(nr)).alias("record_id"),
            url.alias("url"),
            (base + after).cast("long").alias("captured"),
            F.lit(status).alias("status"),
            F.when(page % 5 != 0, etag).alias("etag"),
            F.when(page % 7 != 0, (base - 3600).cast("string")).alias("last_modified"),
            F.create_map(*[F.lit(x) if isinstance(x, str) else x for pair in headers for x in pair]).alias("headers"),
            digest.alias("payload_digest"),
        )

    def date(after):
        return ("date", (base + after).cast("string"))

    none, same = F.lit(None).cast("string"), F.md5(html)
    again = F.concat("url", F.lit("#again"))
    other = F.when(page % 3 == 0, F.md5(F.concat(html, F.lit("x")))).otherwise(same)
    full = [("content-type", "text/html"), ("cache-control", "max-age=60"), date(0)]
    late = [("content-type", "text/plain"), ("cache-control", "max-age=120")]
    records = [
        record("0", 0, 200, F.col("url"), same, same, full),
        record("1", day, 304, again, F.concat(F.lit("W/"), same), none, [*late, date(day)]),
        record("2", 2 * day, 304, F.col("url"), other, none, [date(2 * day)]),
    ]
    early = record("3", -day, 304, F.col("url"), same, none, [date(-day)])
    all_records = F.array(*records)
    return pages.select(
        F.explode(F.when(page % 11 == 0, F.concat(all_records, F.array(early))).otherwise(all_records)).alias("r")
    ).select("r.*")


def op7_warc_revisits(spark, sf_dir):
    """Resolve the revisits of the capture log of the whole of ``pages``."""
    captures = captures_of(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    merged = F.array_join(
        F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e.key, F.lit(": "), e.value))), "\n"
    )
    return resolve_revisits(captures).select(
        "record_id", "canonical", "captured", "outcome", "resolved_id", "payload_digest",
        merged.alias("merged_headers"),
    )


ORACLE = r"""
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS html, coalesce(page_id, 0) AS n,
    1704067200 + coalesce(page_id, 0) * 60 AS base FROM pages),
raw AS (
  SELECT page_id, n, base, url, 0 AS k, 0 AS after, 200 AS status, md5(html) AS tag, md5(html) AS digest FROM p
  UNION ALL SELECT page_id, n, base, url || '#again', 1, 86400, 304, 'W/' || md5(html), NULL FROM p
  UNION ALL SELECT page_id, n, base, url, 2, 172800, 304,
    CASE WHEN n % 3 = 0 THEN md5(html || 'x') ELSE md5(html) END, NULL FROM p
  UNION ALL SELECT page_id, n, base, url, 3, -86400, 304, md5(html), NULL FROM p WHERE n % 11 = 0),
c AS (
  SELECT concat_ws('-', page_id::varchar, k::varchar) AS record_id, url, base + after AS captured, status, k,
    CASE WHEN n % 5 <> 0 THEN tag END AS etag,
    CASE WHEN n % 7 <> 0 THEN (base - 3600)::varchar END AS modified, digest,
    regexp_extract(url, '://([^#]*)', 1) AS rest
  FROM raw),
parts AS (
  SELECT *, regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), '^www[.]', ''), ':(80|443)$', '') AS host,
    regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
    regexp_replace(regexp_replace(regexp_extract(rest, '[?](.*)$', 1), '(^|&)utm_[^&]*', '', 'g'), '^&', '') AS query
  FROM c),
keyed AS (
  SELECT *, CASE WHEN contains(url, '://')
    THEN host || path || CASE WHEN query <> '' THEN '?' || query ELSE '' END ELSE lower(url) END AS canonical
  FROM parts),
matched AS (
  SELECT r.*, f.record_id AS f_id, f.captured AS f_captured, f.etag AS f_etag, f.modified AS f_modified, f.digest AS f_digest
  FROM keyed r LEFT JOIN keyed f
    ON f.canonical = r.canonical AND f.status = 200 AND (f.captured, f.record_id) <= (r.captured, r.record_id)
  QUALIFY row_number() OVER (PARTITION BY r.record_id, r.url, r.captured ORDER BY f.captured DESC NULLS LAST, f.record_id DESC) = 1),
judged AS (
  SELECT *, coalesce(regexp_replace(etag, '^W/', '') <> regexp_replace(f_etag, '^W/', ''), modified <> f_modified, digest <> f_digest) AS differs
  FROM matched),
named AS (
  SELECT *, CASE WHEN status = 200 THEN 'full' WHEN canonical IS NULL OR f_id IS NULL THEN 'missing'
    WHEN differs IS NULL THEN 'unchecked' WHEN differs THEN 'changed' ELSE 'resolved' END AS outcome
  FROM judged)
SELECT record_id, canonical, captured, outcome,
  CASE WHEN outcome = 'full' THEN record_id WHEN outcome IN ('resolved', 'unchecked') THEN f_id END AS resolved_id,
  CASE WHEN outcome IN ('resolved', 'unchecked') THEN f_digest ELSE digest END AS payload_digest,
  CASE WHEN k = 0 THEN 'cache-control: max-age=60' || chr(10) || 'content-type: text/html' || chr(10) || 'date: ' || captured
    WHEN outcome IN ('resolved', 'unchecked') THEN
      'cache-control: max-age=' || CASE WHEN k = 1 THEN '120' ELSE '60' END || chr(10) || 'content-type: text/html' || chr(10) || 'date: ' || captured
    WHEN k = 1 THEN 'cache-control: max-age=120' || chr(10) || 'content-type: text/plain' || chr(10) || 'date: ' || captured
    ELSE 'date: ' || captured END AS merged_headers
FROM named
"""
