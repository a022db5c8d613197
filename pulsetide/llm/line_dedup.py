"""Line dedup: a segment-partition edit join of all lines, in built-in functions only.

A line goes if an equal line, or one within ``threshold`` edits, comes earlier. Every line is
split into ``threshold + 1`` segments; two lines within the threshold share a segment, at a
place that their lengths and the segment's number confine. So each line is an entry under its
segments and their length, and probes the entries of its own and shorter lengths with its
substrings at those places.

Segments first meet as hashes alone, in two steps. The first takes segments of one size for a
whole class of lengths, which needs fewer than half the hashes, and leaves the few lines that
share any with a different line; the second takes those of the exact lengths. Only the lines
that pass both carry their text into the semi-joins that verify them with the banded edit
distance, so no pairs are written, and a line's first witness is enough. Long lines are verified
by the furthest places that so many edits reach on each diagonal.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsetide.llm.common import table, written

#: Edits allowed, and the least characters of a line that takes part in more than equality.
THRESHOLD, LEAST = 2, 20

#: The built-in edit distance walks a line quadratically, whatever the threshold, so lines of
#: more characters are verified by ``within``. Results do not depend on it.
WALKED = 4_096


def segment(length: Column, number: int, threshold: int) -> tuple[Column, Column]:
    """First character (from 1) and length of a segment; the last ones are longer by one."""
    parts = threshold + 1
    short = F.floor(length / parts).cast("int")
    longer = (length - short * parts).cast("int")
    first_longer = parts - longer  # segments before this one are short
    before = F.greatest(F.lit(number) - first_longer, F.lit(0))
    size = F.when(F.lit(number) >= first_longer, short + 1).otherwise(short)
    return short * number + before + 1, size.cast("int")


def entry_keys(line: Column, threshold: int) -> Column:
    """Hashes of the segments of a line, with their numbers and the line's length."""
    length = F.char_length(line)
    keys = []
    for number in range(threshold + 1):
        first, size = segment(length, number, threshold)
        keys.append(F.xxhash64(length, F.lit(number), F.substring(line, first, size)))
    return F.array(*keys)


def probe_keys(line: Column, threshold: int) -> Column:
    """Hashes under which the lines as long or shorter that are within the threshold are found.

    A segment is looked for where both the edits left of it and those right of it can lead.
    """
    keys = []
    for shorter in range(threshold + 1):
        length = (F.char_length(line) - shorter).cast("int")
        for number in range(threshold + 1):
            first, size = segment(length, number, threshold)
            right = threshold - number
            for shift in range(max(-number, shorter - right), min(number, shorter + right) + 1):
                keys.append(F.xxhash64(length, F.lit(number), F.substring(line, first + shift, size)))
    return F.array(*keys)


def class_of(length: Column, threshold: int) -> Column:
    """The least length of a line's class; classes are wider than the threshold.

    The leading three bits of the length name its class, so the lengths of a class differ by a
    quarter at most (or by the least width).
    """
    least_width = threshold.bit_length()
    bits = F.greatest(F.length(F.bin(length)) - 3, F.lit(least_width))
    return F.call_function("shiftleft", F.call_function("shiftright", length, bits), bits)


def class_keys(line: Column, of: Column, threshold: int) -> Column:
    """Hashes of segments of one size at the places that all lines of the class ``of`` have.

    The segments of the first half are counted from the start of the line, the others from its
    end. A segment without edits has as many edits left of it as there are segments, at least,
    and so has its right side (else another segment will do), which confines its place.
    """
    size = F.greatest(F.floor((of - threshold) / (threshold + 1)), F.lit(0)).cast("int")
    length = F.char_length(line)
    keys = []
    for number in range(threshold + 1):
        right = threshold - number
        first = size * number if number <= right else length - size * (right + 1)
        reach = min(number, right)
        for shift in range(-reach, reach + 1):
            keys.append(F.xxhash64(of, F.lit(number), F.substring(line, first + 1 + shift, size)))
    return F.array(*keys)


def _equal_run(x: Column, y: Column, i: Column, j: Column) -> Column:
    """How many characters of ``x`` from ``i`` and of ``y`` from ``j`` (from 0) are equal.

    Blocks of falling powers of two are compared, each after those that were equal.
    """
    most = F.least(F.char_length(x) - i, F.char_length(y) - j)
    steps = F.transform(
        F.sequence(F.length(F.bin(most)) - 1, F.lit(0), F.lit(-1)), lambda bit: F.call_function("shiftleft", F.lit(1), bit)
    )
    block = lambda line, at, size: F.substring(line, at + 1, size)
    return F.aggregate(
        steps,
        F.lit(0),
        lambda run, size: F.when(
            (run + size <= most) & (block(x, i + run, size) == block(y, j + run, size)), run + size
        ).otherwise(run),
    )


def within(x: Column, y: Column, threshold: int) -> Column:
    """Whether ``threshold`` edits at most lead from ``x`` to ``y``, for lines of any length.

    For 0, 1, ... edits, ``reached`` holds how far into ``x`` they can get on each diagonal (the
    place in ``y`` less that in ``x``); -1 is nowhere. Both ends have a diagonal to spare.
    """
    n, m = F.char_length(x), F.char_length(y)
    width = 2 * threshold + 3
    nowhere = F.lit(-1)

    def slid(place: Column, diagonal: Column) -> Column:
        inside = (place >= 0) & (place + diagonal >= 0) & (place <= n) & (place + diagonal <= m)
        return F.when(inside, place + _equal_run(x, y, place, place + diagonal)).otherwise(nowhere)

    def further(reached: Column, edits: Column) -> Column:
        def best(index: Column) -> Column:
            diagonal = index - (threshold + 1)
            before = lambda step: F.get(reached, index + step)
            moved = lambda place, by: F.when(place >= 0, place + by).otherwise(nowhere)
            ways = [
                moved(before(0), 1),  # a replacement
                before(-1),  # an insertion
                moved(before(1), 1),  # a deletion
            ]
            # A way past an end is none: the least end of both is as far as any gets.
            end = F.least(n, m - diagonal)
            place = F.least(F.greatest(*ways), end)
            return F.when(F.abs(diagonal) <= edits, slid(place, diagonal)).otherwise(nowhere)

        return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), best)

    start = F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)),
        lambda index: F.when(index == threshold + 1, slid(F.lit(0), F.lit(0))).otherwise(nowhere),
    )
    last = F.aggregate(F.sequence(F.lit(1), F.lit(threshold)), start, further) if threshold else start
    return (F.abs(m - n) <= threshold) & (F.get(last, m - n + threshold + 1) >= n)


def lines_of(docs: DataFrame, text: str, carried: list[str]) -> DataFrame:
    """The lines of every text with their numbers from 0; a null text has none."""
    return docs.select(
        *carried, F.posexplode(F.split(F.col(f"`{text}`"), "\n", -1)).alias("line_no", "line")
    )


def line_decisions(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    threshold: int = THRESHOLD,
    least: int = LEAST,
    most: int | None = None,
) -> DataFrame:
    """A row per document (row of ``docs``): ``rid``, its id, ``n_lines``, ``dropped_lines``.

    Lines are what line feeds separate. Lines without a character that is no white space stay.
    Of equal lines the first stays: that of the smallest id (null first), then line number.
    It goes too if any earlier line, kept or not, is within ``threshold`` edits (insertions,
    deletions and replacements of characters) and both have ``least`` to ``most`` characters
    (None: any number); shorter and longer lines go for equality only.

    * A null text has no lines; an empty one has one empty line. Texts may be of any length.
    * Rows that repeat are documents of their own, in any order. Other columns are not read.
    * Lines are told apart by 64-bit hashes. An empty table gives no rows.
    """
    key = lambda line: F.when(line.rlike(r"\S"), F.xxhash64(line))
    rows = written(
        docs.select(
            F.monotonically_increasing_id().alias("rid"),
            F.col(f"`{id_column}`").alias("id"),
            F.transform(F.split(F.col(f"`{text}`"), "\n", -1), key).alias("keys"),
        ),
        "lines",
    )
    occurrences = rows.select("rid", "id", F.posexplode("keys").alias("line_no", "key")).filter("key IS NOT NULL")
    near = _near_earlier(docs.select(F.col(f"`{text}`").alias("text")), occurrences, threshold, least, most)
    # Lines that occur once and are near no earlier one need no more work.
    marked = written(
        _firsts(occurrences)
        .join(near.withColumn("near", F.lit(True)), "key", "left")
        .filter("copies > 1 OR near"),
        "lines-marked",
    )
    stays = F.col("first").eqNullSafe(F.struct("id", "line_no", "rid")) & F.col("near").isNull()
    dropped = (
        occurrences.join(marked.hint("shuffle_hash"), "key")
        .filter(~stays)
        .groupBy("rid")
        .agg(F.array_sort(F.collect_list("line_no")).alias("dropped_lines"))
    )
    return rows.join(dropped.hint("shuffle_hash"), "rid", "left").select(
        "rid",
        F.col("id").alias(id_column),
        F.when(F.col("keys").isNull(), 0).otherwise(F.size("keys")).cast("long").alias("n_lines"),
        F.coalesce("dropped_lines", F.array().cast("array<int>")).alias("dropped_lines"),
    )


def _firsts(occurrences: DataFrame) -> DataFrame:
    """First place and number of copies of every line."""
    place = F.struct("id", "line_no", "rid")
    return occurrences.groupBy("key").agg(F.min(place).alias("first"), F.count("*").alias("copies"))


def _sharing(lines: DataFrame, keys: Column, name: str) -> DataFrame:
    """Keys of the lines that share any of the hashes ``keys`` with a line of another key.

    The shared hashes are counted map-side first, so a hash that many lines have does not gather
    them. They and the keys are shuffled, however few: their number follows the corpus.
    """
    dealt = lines.select("key", F.explode(keys).alias("segment"))
    shared = (
        dealt.groupBy("segment").agg(F.min("key").alias("low"), F.max("key").alias("high"))
        .filter("low <> high").select("segment")
    )
    met = dealt.join(shared.hint("shuffle_hash"), "segment", "left_semi")
    return written(met.select("key").distinct(), f"{name}-keys")


def _near_earlier(texts: DataFrame, occurrences: DataFrame, threshold: int, least: int, most: int | None) -> DataFrame:
    """Keys of the lines with an earlier line within the threshold."""
    line, length = F.col("line"), F.char_length("line")
    takes_part = length >= least if most is None else length.between(least, most)
    lines = (
        lines_of(texts, "text", [])
        .filter(takes_part & line.rlike(r"\S"))
        .select(F.xxhash64("line").alias("key"), "line")
    )
    # A line is in the class of its length and, near the border, in the next one.
    own, next_one = F.col("own"), F.col("next_one")
    classed = lines.select(
        "key", "line", class_of(length, threshold).alias("own"), class_of(length + threshold, threshold).alias("next_one")
    )
    keys = F.when(own == next_one, class_keys(line, own, threshold)).otherwise(
        F.concat(class_keys(line, own, threshold), class_keys(line, next_one, threshold))
    )
    some = lines.join(_sharing(classed, keys, "class").hint("shuffle_hash"), "key", "left_semi").dropDuplicates(["key"])
    some = written(some, "lines-some")
    both = F.concat(entry_keys(line, threshold), probe_keys(line, threshold))
    alive = _sharing(some, F.array_distinct(both), "exact")
    firsts = _firsts(occurrences.join(alive.hint("shuffle_hash"), "key", "left_semi"))
    held = written(some.join(alive, "key", "left_semi").join(firsts, "key").select("key", "line", "first"), "lines-alive")
    entries = held.select("*", F.explode(entry_keys(line, threshold)).alias("segment"))
    probes = held.select("*", F.explode(F.array_distinct(probe_keys(line, threshold))).alias("segment"))

    def later(left: DataFrame, right: DataFrame) -> DataFrame:
        left, right = left.alias("x"), right.alias("y")
        x, y = F.col("x.line"), F.col("y.line")
        close = F.when(
            F.greatest(F.char_length(x), F.char_length(y)) <= WALKED, F.levenshtein(x, y, threshold) >= 0
        ).otherwise(within(x, y, threshold))
        earlier = (F.col("y.first") < F.col("x.first")) & (F.col("x.key") != F.col("y.key"))
        met = (F.col("x.segment") == F.col("y.segment")) & earlier & close
        return left.join(right, met, "left_semi").select("key")

    return written(later(probes, entries).union(later(entries, probes)).distinct(), "lines-near")


def dedup_lines(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` with the dropped lines taken out of their texts, and nothing else changed.

    Rows are matched by id and text, so rows that repeat both need not be told apart: the
    first of them keeps its lines, the others lose them, in any order. A null text stays null.
    Columns may have any names but those with two leading underscores used here.
    """
    numbered = written(docs.withColumn("__rid", F.monotonically_increasing_id()), "numbered")
    # The decision names a row by the number it is given here, in place of the id's tie-breaker.
    decided = line_decisions(
        numbered.withColumn("__id", F.struct(F.col(f"`{id_column}`"), "__rid")), "__id", text, **how
    ).select(F.col("__id.__rid").alias("__rid"), F.col("dropped_lines").alias("__dropped"))
    kept = F.expr(
        f"array_join(filter(split(`{text}`, '\\n', -1), (x, i) -> NOT array_contains(__dropped, i)), '\\n')"
    )
    whole = F.when(F.size("__dropped") > 0, kept).otherwise(F.col(f"`{text}`"))
    return (
        numbered.join(decided, "__rid").withColumn(text, whole).select(*[F.col(f"`{c}`") for c in docs.columns])
    )


def op8_line_dedup(spark, sf_dir):
    """Near-repeated lines of the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_decisions(docs).select(
        "doc_id", "n_lines", F.size("dropped_lines").cast("long").alias("n_dropped"),
        F.array_join(F.col("dropped_lines").cast("array<string>"), ",").alias("dropped_lines"),
    )


ORACLE = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
  FROM documents),
placed AS (SELECT *, row_number() OVER (ORDER BY doc_id, line_no) AS place FROM lines),
firsts AS (SELECT line, min(place) AS first, length(line) AS n FROM placed WHERE regexp_matches(line, '\S') GROUP BY line),
near AS (
  SELECT DISTINCT x.line FROM (SELECT *, unnest([-2, -1, 0, 1, 2]) AS d FROM firsts WHERE n >= 20) x JOIN firsts y
    ON y.n = x.n + x.d AND y.first < x.first
  WHERE y.n >= 20 AND levenshtein(x.line, y.line) <= 2),
dropped AS (
  SELECT doc_id, list(line_no ORDER BY line_no) AS d FROM placed l JOIN firsts f USING (line)
  WHERE l.place <> f.first OR line IN (SELECT line FROM near) GROUP BY doc_id)
SELECT doc_id, coalesce(len(string_split(text, chr(10))), 0)::bigint AS n_lines, coalesce(len(d), 0)::bigint AS n_dropped,
  coalesce(array_to_string(d, ','), '') AS dropped_lines
FROM documents LEFT JOIN dropped USING (doc_id)
"""
