"""Phrase collocations by dynamic itemset counting over cyclic scans of shards.

The corpus is written once as blocks of word numbers, each with its own vocabulary, dealt to a
few shards. Step after step the next shard is scanned, again and again from the first, and
phrases of several lengths are counted in one scan. Single words are counted from the first
step on. A longer phrase becomes active once both phrases that it has without its last and
without its first word have reached the threshold, and is counted for one full cycle of shards
from the next step on, so its count is exact. Mining ends when no phrase is active.

Which phrases have reached the threshold, and at which step, is kept in one array of fixed size
that tasks get before each step: a phrase's hash names its place. Two phrases in one place can
only make others active too early or in vain; counts go by the phrases' own words. So the size
of the array bounds memory and decides speed, not the result.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pulsetide.llm.common import blocks, small_batches, table, text_buffers, written
from pulsetide.llm.subwords import hashed
from pulsetide.session import scratch_path

#: Occurrences of a frequent phrase, words of the longest, and shards of a cycle.
LEAST, LONGEST, SHARDS = 30, 4, 2
#: Bytes of text of a block, and logarithm of the places of the array of marks (a byte each).
BLOCK_BYTES, PLACE_BITS = 2 << 20, 24
#: Share of a phrase's occurrences, in percent, that make it part of a longer one; phrases of
#: a language that are reported; parts of a language when these are chosen.
PART_OF, REPORTED, SPREAD = 80, 2_000, 64
UNKNOWN = "und"
#: Rows of an Arrow batch of phrases.
ROWS = 1 << 16

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def word_blocks(docs: DataFrame, shards: int, text: str = "text", lang: str = "lang") -> DataFrame:
    """``shard, lang, words, vocabulary, tokens``: the corpus as blocks of word numbers.

    Texts are lower-cased (A-Z), cut at ``.,;:!?`` and line ends into pieces, and those at
    spaces and tabs into words. ``vocabulary`` has the block's words in lines; ``tokens`` are
    32-bit numbers of them, complemented where a piece begins. All blocks of a task belong to
    one shard.
    """
    rows = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.col(f"`{text}`").alias("text"),
        F.pmod(F.spark_partition_id(), F.lit(shards)).alias("shard"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        sizes: dict[str, int] = {}
        shard = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            shard = batch.column("shard")[0].as_py()
            for name in pc.unique(batch.column("lang")).to_pylist():
                raw, offsets = text_buffers(batch.column("text").filter(pc.equal(batch.column("lang"), name)))
                for first, last in blocks(offsets, BLOCK_BYTES):
                    part = offsets[first : last + 1]
                    held.setdefault(name, []).append((raw[part[0] : part[-1]].copy(), np.diff(part)))
                    sizes[name] = sizes.get(name, 0) + int(part[-1] - part[0])
                    if sizes[name] >= BLOCK_BYTES:
                        yield block_of(shard, name, held.pop(name))
                        del sizes[name]
            while sum(sizes.values()) > 4 * BLOCK_BYTES:  # many languages
                name = max(sizes, key=sizes.get)
                yield block_of(shard, name, held.pop(name))
                del sizes[name]
        for name, parts in held.items():
            yield block_of(shard, name, parts)

    return rows.mapInArrow(run, "shard int, lang string, words long, vocabulary binary, tokens binary")


def block_of(shard: int, lang: str, parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """The row of one block of whole texts."""
    raw = np.concatenate([p[0] for p in parts])
    offsets = np.concatenate([[0], np.cumsum(np.concatenate([p[1] for p in parts]))])
    vocabulary, tokens = word_numbers(raw, offsets)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([shard], pa.int32()),
            pa.array([lang]),
            pa.array([len(tokens)], pa.int64()),
            pa.array(["\n".join(vocabulary.to_pylist()).encode()], pa.binary()),
            pa.array([tokens.tobytes()], pa.binary()),
        ],
        ["shard", "lang", "words", "vocabulary", "tokens"],
    )


def word_numbers(raw: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Distinct words, and every word's number, complemented at the first word of a piece."""
    capital = (raw >= 65) & (raw <= 90)
    raw = raw + (capital.view(np.uint8) << 5)
    ending = _ENDS[raw]
    inside = ~(ending | (raw == 32) | (raw == 9))
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    texts = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[texts] = inside[texts]  # a word ends with its text
    starts = np.flatnonzero(begins)
    count = np.cumsum(inside, dtype=np.int32 if len(raw) < 1 << 31 else np.int64)
    edges = np.append(count[starts] - 1, count[-1:]).astype(np.int64)
    del count
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(edges), pa.py_buffer(raw[inside]))
    coded = words.dictionary_encode()
    piece = np.searchsorted(np.flatnonzero(ending), starts) + np.searchsorted(offsets, starts, side="right")
    tokens = coded.indices.to_numpy().astype(np.int32)
    opening = np.append(True, piece[1:] != piece[:-1])[: len(tokens)]
    return coded.dictionary, np.where(opening, ~tokens, tokens)


_ENDS = np.isin(np.arange(256), list(b".,;:!?\n\x0b\x0c\r"))


def frequent_phrases(
    word_rows: DataFrame, least: int = LEAST, longest: int = LONGEST, shards: int = SHARDS
) -> DataFrame:
    """``lang, length, phrase, f`` of every phrase of at most ``longest`` words that occurs at
    least ``least`` times in the texts of its language.

    ``word_rows`` are the blocks of ``word_blocks``, with shards from 0 on.
    """
    marks = np.zeros(1 << PLACE_BITS, np.uint8)
    counts = None
    whole = []
    step, marked = 0, 0
    # Words are active from the start, others while a cycle has not passed since the last mark.
    while step < max(shards, marked + shards if marked else 0):
        step += 1
        shard = word_rows.filter(F.col("shard") == (step - 1) % shards)
        found = counts_of(shard, marks, step, longest, shards)
        if counts is not None:  # of phrases whose cycle goes on
            found = found.unionByName(counts.filter(_since() >= step - shards).select("key", "tag", "f"))
        # The tag follows from the phrase: its length, place, and when it became active.
        found = found.groupBy("key").agg(F.min("tag").alias("tag"), F.sum("f").alias("f"))
        done = _since() == step - shards
        counts = written(found.filter(~done | (F.col("f") >= least)), "counted")
        # After a full cycle counts are final.
        whole.append(counts.filter(done))
        # At most as many places as the array has.
        reached = counts.filter((F.col("f") >= least) & (_length() < longest))
        places = reached.select(F.col("tag").bitwiseAND(_PLACES).alias("place")).distinct().toArrow()
        places = places.column(0).to_numpy()
        fresh = places[marks[places] == 0]
        if len(fresh):
            marks[fresh] = step
            marked = step
    out = whole[0]
    for part in whole[1:]:
        out = out.union(part)
    return written(
        out.select(
            F.expr("substring(key, 1, length(key) - length(substring_index(key, '\t', -1)) - 1)").alias("lang"),
            _length().cast("int").alias("length"),
            F.substring_index("key", "\t", -1).alias("phrase"),
            "f",
        ),
        "frequent",
    )


#: In a tag: bits of the place, and where the step of activation and the length stand.
_PLACES, _SINCE, _LENGTH = (1 << 32) - 1, 32, 48


def _since() -> Column:
    return F.shiftright("tag", _SINCE).bitwiseAND((1 << (_LENGTH - _SINCE)) - 1)


def _length() -> Column:
    return F.shiftright("tag", _LENGTH)


def counts_of(shard: DataFrame, marks: np.ndarray, step: int, longest: int, shards: int) -> DataFrame:
    """``key, tag, f``: active phrases in the blocks of a shard.

    A key is language, tab, phrase (which has no tab); a tag holds the phrase's length, the
    step after which it became active, and its place in the array.
    """
    shared = shard.sparkSession.sparkContext.broadcast(marks)
    bits = marks.size.bit_length() - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for nr in range(batch.num_rows):
                lang, vocabulary, tokens = (batch.column(c)[nr] for c in ("lang", "vocabulary", "tokens"))
                words = pa.array(vocabulary.as_py().decode().split("\n"), pa.large_string())
                ids = np.frombuffer(tokens.as_buffer(), np.int32)
                for length, since, phrases, places, f in active_counts(words, lang.as_py(), ids, shared.value, bits, step, longest, shards):
                    tags = (length << _LENGTH) | (since << _SINCE) | places
                    # Arrow batches of a bounded number of phrases.
                    for at in range(0, len(f), ROWS):
                        named = pc.binary_join_element_wise(pa.scalar(lang.as_py(), pa.large_string()), phrases.slice(at, ROWS), pa.scalar("\t", pa.large_string()))
                        yield pa.RecordBatch.from_arrays(
                            [named.cast(pa.string()), pa.array(tags[at : at + ROWS]), pa.array(f[at : at + ROWS].astype(np.int64))], ["key", "tag", "f"]
                        )
                pa.default_memory_pool().release_unused()

    found = shard.select("lang", "vocabulary", "tokens")
    return found.mapInArrow(run, "key string, tag long, f long")


def active_counts(words, lang, tokens, marks, bits, step, longest, shards):
    """For each length: when its phrases became active, phrases, places in the array, counts."""
    if not len(tokens):
        return
    opening = tokens < 0
    ids = np.where(opening, ~tokens, tokens).astype(np.int64)
    salt = hashed(pa.array([lang], pa.large_string()))[0]
    of_word = _mixed(hashed(words) ^ salt)
    shift = np.uint64(64 - bits)
    places = (of_word >> shift).astype(np.int64)
    if step <= shards:
        yield 1, np.zeros(len(words), np.int64), words, places, np.bincount(ids, minlength=len(words))
    # Starts of phrases of the present length that are marked, their marks and hashes.
    starts = np.flatnonzero(marks[places[ids]])
    since = marks[places[ids[starts]]].astype(np.int64)
    hashes = of_word[ids[starts]]
    for length in range(2, longest + 1):
        # The next marked phrase begins one word further on, and the new last word is of the piece.
        both = np.flatnonzero(starts[1:] == starts[:-1] + 1)
        last = starts[both] + length - 1
        both, last = both[~opening[last]], last[~opening[last]]
        since = np.maximum(since[both], since[both + 1])
        starts = starts[both]
        with np.errstate(over="ignore"):
            hashes = _mixed(hashes[both] * _GOLDEN + of_word[ids[last]])
        places = (hashes >> shift).astype(np.int64)
        now = np.flatnonzero((since < step) & (step <= since + shards))
        if len(now):
            code = ids[starts[now]]
            for further in range(1, length):
                code = code * len(words) + ids[starts[now] + further]
                if further < length - 1:
                    code = np.unique(code, return_inverse=True)[1]
            order = np.argsort(code, kind="stable")
            code = code[order]
            new = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
            one = now[order[new]]
            parts = [words.take(pa.array(ids[starts[one] + i])) for i in range(length)]
            phrases = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))
            yield length, since[one], phrases, places[one], np.diff(np.append(new, len(code)))
        seen = marks[places].astype(np.int64)
        kept = np.flatnonzero(seen)
        # Not the mark alone: in a shared place it may be older than those of the phrase's parts.
        starts, since, hashes = starts[kept], np.maximum(seen[kept], since[kept]), hashes[kept]


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def scored(frequent: DataFrame) -> DataFrame:
    """``lang, length, phrase, a, l, r, score`` of phrases of two and more words.

    A cut after the first k words gives ``floor(2000000 a / (l + r))``, from the counts of both
    parts; the lowest-scoring cut counts, the earliest of equal ones. Arithmetic is in decimals
    of 38 digits.
    """
    words = F.split("phrase", " ")
    cuts = frequent.filter("length > 1").select(
        "lang", "length", "phrase", F.col("f").alias("a"), words.alias("words"), F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("k")
    )
    cuts = cuts.select(
        "lang", "length", "phrase", "a", "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("words", F.col("k") + 1, F.col("length")), " ").alias("right"),
    )
    for side, name in (("left", "l"), ("right", "r")):
        part = frequent.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
        cuts = cuts.join(part, ["lang", side])
    score = F.expr("CAST(2000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(19,0)) div (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0)))")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r"))
    return (
        cuts.groupBy("lang", "length", "phrase", "a").agg(best.alias("best")).select("lang", "length", "phrase", "a", "best.l", "best.r", "best.score")
    )


def not_part_of_longer(candidates: DataFrame, percent: int = PART_OF) -> DataFrame:
    """Candidates but those of which so many percent lie in one longer candidate."""
    lengths = F.sequence(F.lit(2), F.col("length") - 1)
    inside = candidates.filter("length > 2").select(
        "lang", "a", F.split("phrase", " ").alias("words"), "length", F.explode(lengths).alias("size")
    )
    inside = inside.select(
        "lang", "a", "words", "size", F.explode(F.sequence(F.lit(1), F.col("length") - F.col("size") + 1)).alias("at")
    ).select("lang", F.array_join(F.slice("words", F.col("at"), F.col("size")), " ").alias("phrase"), "a")
    most = inside.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    share = F.col("most").cast("decimal(38,0)") * 100 >= F.col("a").cast("decimal(38,0)") * percent
    return candidates.join(most, ["lang", "phrase"], "left").filter(F.col("most").isNull() | ~share).drop("most")


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    longest: int = LONGEST,
    reported: int = REPORTED,
    shards: int = SHARDS,
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """The best collocations of every language: ``lang, rank, phrase, a, l, r, n, score``.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its weakest cut, ``n`` all words of
    the language. Phrases do not cross ``.,;:!?``, line ends or texts. Order is by score, then
    ``a`` (both descending), then the phrase's bytes.

    * A null text is empty, a null language is ``und``. Texts may be of any length; only the
      texts of a block of 2 MB, or one longer text, are held at once.
    * Repeated rows count as often as they occur. An empty table gives no rows, and other
      columns are not read.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "word-blocks")
    made = word_blocks(docs, shards, text, lang)
    with small_batches(spark):
        made.write.partitionBy("shard").parquet(path)
    word_rows = spark.read.schema(made.schema).parquet(path)
    frequent = frequent_phrases(word_rows, least, longest, shards)
    kept = not_part_of_longer(scored(frequent))
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # First in parts of a language, so that no task ranks a whole one.
    part = F.pmod(F.xxhash64("phrase"), F.lit(SPREAD))
    kept = kept.withColumn("part", part).withColumn("nth", F.row_number().over(W.partitionBy("lang", "part").orderBy(*best)))
    kept = kept.filter(F.col("nth") <= reported).withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*best)))
    totals = word_rows.groupBy("lang").agg(F.sum("words").alias("n"))
    return (
        kept.filter(F.col("rank") <= reported)
        .join(totals, "lang")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collocations of all ``documents``: the first 2,000 of every language."""
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = r"""
with pieces as (
  select row_number() over () as piece, lang,
         list_filter(regexp_split_to_array(part, '[\x20\x09]+'), lambda w: w <> '') as words
  from (select coalesce(lang, 'und') as lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as part
        from documents)),
total as (select lang, sum(len(words))::bigint as n from pieces group by lang),
places as (select lang, words, unnest(range(1, len(words) + 1)) as i from pieces where len(words) > 0),
phrases as (
  select lang, k, list_slice(words, i, i + k - 1) as words, count(*) as f
  from places, (values (1), (2), (3), (4)) as sizes(k) where i + k - 1 <= len(words)
  group by all having count(*) >= 30),
cuts as (
  select p.lang, p.k, p.words, p.f as a, c.k as cut, l.f as l, r.f as r,
         ((2000000::hugeint * p.f) // (l.f + r.f))::bigint as score
  from phrases p join (values (1), (2), (3)) as c(k) on c.k < p.k
  join phrases l on l.lang = p.lang and l.words = list_slice(p.words, 1, c.k)
  join phrases r on r.lang = p.lang and r.words = list_slice(p.words, c.k + 1, p.k)),
best as (
  select * from cuts qualify row_number() over (partition by lang, words order by score, cut) = 1),
inside as (
  select b.lang, list_slice(b.words, s.i, s.i + t.k - 1) as words, max(b.a) as most
  from best b join (values (2), (3)) as t(k) on t.k < b.k
  join (values (1), (2), (3)) as s(i) on s.i + t.k - 1 <= b.k
  group by all),
ranked as (
  select b.lang, row_number() over (partition by b.lang order by score desc, a desc, array_to_string(b.words, ' ')) as rank,
         array_to_string(b.words, ' ') as phrase, a, l, r, score
  from best b left join inside i on i.lang = b.lang and i.words = b.words
  where i.most is null or 100 * i.most < 80 * a)
select lang, rank, phrase, a, l, r, n, score from ranked join total using (lang) where rank <= 2000"""
