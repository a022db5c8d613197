"""Token ids as raw binary shards, with a minimal perfect hash index for access by key.

A store is a folder:

* ``ids/shard-N.bin``: ids of documents one after another, little-endian, two bytes each where
  the vocabulary allows it, else four. Documents are in ascending order of their keys, over
  all shards; each ends with the end id. ``ids/shard-N.len`` has their lengths (4 bytes each).
* ``index/bucket-N.mph``: for the keys whose hash falls into bucket N a minimal perfect hash
  function, and at each key's slot a 64-bit fingerprint and where its documents lie.
* ``shards``: a table of the shards; ``store.json``: width and number of buckets, written last,
  so that a folder without it is no store.

The hash function is a cascade of bit arrays. At each level a key that meets no other in its
position owns that bit, the others go on to the next level; a key's slot is the number of bits
before its own. A look-up reads one bit at one or two levels, one slot, and the ids themselves.
The fingerprint of a whole number is a bijection of it, so an absent number is never taken for
one that is there; of other keys it is a second 64-bit hash.

Tasks write files under names of their own and rename them, so a repeated task changes nothing.
Folders are reached by pyarrow's file systems (local or shared folders, HDFS, S3, GCS).
"""

import json
import uuid
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType
from tokenizers import Tokenizer

from pulsetide.llm.common import blocks, partitions, ragged, table, text_buffers, written
from pulsetide.llm.subwords import Pieces
from pulsetide.session import scratch_path

VOCABULARY, END = "word_bpe_49k.json", 1

#: Bytes of text for a shard, and keys in a bucket of the index, on average, in large stores.
SHARD_BYTES, BUCKET_KEYS = 64 << 20, 1 << 18
#: Bits per key that is left at a level of the hash function, and a bound no real keys reach.
SPARE, LEVELS = 2, 128
#: Shards whose sizes one task adds up.
ADDED = 1_000
#: Bytes of ids a task reads at once, and the gap over which two reads become one.
READ, GAP = 4 << 20, 1 << 16
#: Bytes of text that are encoded at once.
BATCH = 4 << 20

MAGIC = b"PTMPH001"
_GOLDEN = 0x9E3779B97F4A7C15


def write_store(
    docs: DataFrame,
    described: str,
    path: str,
    end: int = END,
    text: str = "text",
    key: str = "doc_id",
    shard_bytes: int = SHARD_BYTES,
    bucket_keys: int = BUCKET_KEYS,
) -> None:
    """Write the documents' ids below ``path``; ``described`` is a tokenizer as JSON.

    * A null or empty text is a document of the end id alone. Texts may be of any length; a
      document lies in one shard.
    * Rows of one key follow each other, by length and hash of their texts; a key with a third
      of all rows is spread over many shards. Null keys come last and are kept.
    * An empty table gives a store without shards. Other columns are not read.
    * A folder that exists is refused.
    """
    spark = docs.sparkSession
    path = qualified(spark, path)
    store, root = file_system(path)
    if store.get_file_info(root).type != fs.FileType.NotFound:
        raise ValueError(f"{path} exists; choose another folder")
    width = 2 if max(Tokenizer.from_str(described).get_vocab_size() - 1, end) < 1 << 16 else 4
    body = F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b""))
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"), body.alias("body"))
    size = rows.agg(F.sum(F.octet_length("body")).alias("bytes"), F.count("*").alias("docs")).first()
    shards = max(partitions(spark), -(-(size.bytes or 0) // shard_bytes))
    buckets = max(partitions(spark), -(-size.docs // bucket_keys))
    # The place only parts rows that are equal in all else, so that they go to many shards.
    ordered = rows.select(
        "key", "text", F.octet_length("body").alias("size"), F.xxhash64("body").alias("hash"), F.monotonically_increasing_id().alias("place")
    )
    order = [F.col("key").asc_nulls_last(), "size", "hash", "place"]
    ordered = ordered.repartitionByRange(shards, *order).sortWithinPartitions(*order).select("key", "text")
    runs = written(write_shards(ordered, described, path, end, width), "runs")
    sums = written(shard_starts(runs), "shards")
    sums.write.parquet(f"{path}/shards")
    # One row per key and shard: a key that many documents share is a few rows here.
    placed = runs.join(sums.select("shard", "first_id"), "shard").select(
        "key", "shard", "nr", "at", (F.col("first_id") + F.col("at")).alias("start"), "docs"
    )
    index = write_index(placed, path, buckets)
    index.agg(F.sum("keys")).collect()
    with store.open_output_stream(f"{root}/store.json") as out:
        out.write(json.dumps({"width": width, "buckets": buckets}).encode())


def look_up(spark: SparkSession, path: str, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """The documents of the keys: ``key, shard, start, n_tokens, ids``.

    ``start`` counts the ids of all documents before this one, over all shards; ``ids`` are
    little-endian and of four bytes each, the end id included.

    * Repeated keys count once; a key with several documents gives a row for each. A null key
      finds the documents with null keys. A key that is not there gives no row.
    * The keys are of the type the store was written with. Other columns are not read.
    """
    path = qualified(spark, path)
    store, root = file_system(path)
    with store.open_input_stream(f"{root}/store.json") as opened:
        about = json.loads(opened.read())
    asked = keys.select(F.col(f"`{key}`").alias("key")).distinct()
    runs = find_runs(asked, path, about["buckets"])
    # A shard has a bounded number of bytes, so its reader does too; requests come in order.
    together = runs.repartition("shard").sortWithinPartitions("shard", "nr")
    return read_runs(together, path, about["width"])


def binary_column(raw: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column of the bytes between the offsets."""
    places = pa.py_buffer(np.ascontiguousarray(offsets, np.int64))
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, places, pa.py_buffer(np.ascontiguousarray(raw))]
    ).cast(pa.binary())


def write_shards(ordered: DataFrame, described: str, path: str, end: int, width: int) -> DataFrame:
    """Encode each task's rows (``key, text``) into one shard: a row per run of equal keys.

    ``nr`` and ``at`` are the documents and ids before the run in its shard.
    """
    shared = ordered.sparkSession.sparkContext.broadcast(described)
    numbered = ordered.withColumn("shard", F.spark_partition_id())

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, offsets = text_buffers(batch.column("text"))
            for first, last in blocks(offsets, BATCH):
                yield batch.slice(first, last - first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.of(shared.value)
        store, root = file_system(path)
        out, lengths, held, nr, at = None, None, None, 0, 0
        for batch in parts(batches):
            shard = batch.column("shard")[0].as_py()
            if out is None:
                store.create_dir(f"{root}/ids", recursive=True)
                out, lengths = (Replaced(store, f"{root}/ids/shard-{shard:06d}.{x}") for x in ("bin", "len"))
            ids, bounds = pieces.encode(batch.column("text"))
            tokens = np.diff(bounds) + 1
            before = np.concatenate([[0], np.cumsum(tokens)])
            raw = np.full(before[-1], end, f"<u{width}")
            inside = np.ones(len(raw), bool)
            inside[before[1:] - 1] = False
            raw[inside] = ids
            out.write(raw)
            lengths.write(tokens.astype("<u4"))
            code = batch.column("key").dictionary_encode("encode").indices.to_numpy()
            firsts = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
            docs = np.diff(np.append(firsts, len(tokens)))
            sums = np.add.reduceat(tokens, firsts)
            keys = batch.column("key").take(pa.array(firsts)).to_pylist()
            runs = list(zip(keys, (nr + firsts).tolist(), (at + before[firsts]).tolist(), docs.tolist(), sums.tolist()))
            nr, at = nr + len(tokens), at + int(before[-1])
            if held and held[0] == runs[0][0]:  # the run goes on from the last batch
                runs[0] = (*held[:3], held[3] + runs[0][3], held[4] + runs[0][4])
            elif held:
                runs.insert(0, held)
            held = runs.pop()
            yield rows_of(runs, shard)
        if out is not None:
            out.close()
            lengths.close()
            yield rows_of([held], shard)

    def rows_of(runs: list[tuple], shard: int) -> pa.RecordBatch:
        columns = list(zip(*runs)) or [[]] * 5
        numbers = [pa.array(x, pa.int64()) for x in columns[1:]]
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], key_type), pa.array([shard] * len(runs), pa.int32()), *numbers],
            ["key", "shard", "nr", "at", "docs", "ids"],
        )

    kind = ordered.schema["key"].dataType
    key_type = arrow_type(ordered)
    return numbered.mapInArrow(
        run, f"key {kind.simpleString()}, shard int, nr long, at long, docs long, ids long"
    )


def arrow_type(frame: DataFrame) -> pa.DataType:
    """Arrow's type of the column ``key``."""
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(frame.schema["key"].dataType)


def shard_starts(runs: DataFrame) -> DataFrame:
    """``shard, docs, ids, first_id``: the ids of all shards before each."""
    shards = runs.groupBy("shard").agg(F.sum("docs").alias("docs"), F.sum("ids").alias("ids"))
    shards = shards.withColumn("part", F.floor(F.col("shard") / ADDED))
    before = W.rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    # The window over all parts has one row per thousand shards.
    parts = shards.groupBy("part").agg(F.sum("ids").alias("part_ids"))
    parts = parts.select("part", F.coalesce(F.sum("part_ids").over(before.orderBy("part")), zero).alias("part_first"))
    within = F.coalesce(F.sum("ids").over(before.partitionBy("part").orderBy("shard")), zero)
    return (
        shards.withColumn("within", within)
        .join(parts, "part")
        .select("shard", "docs", "ids", (F.col("part_first") + F.col("within")).alias("first_id"))
    )


def with_hashes(frame: DataFrame, buckets: int) -> DataFrame:
    """The key's two hashes, and its bucket; null keys belong to bucket 0.

    For whole numbers the first is the number itself and the second a bijection of it.
    """
    number = isinstance(frame.schema["key"].dataType, IntegralType)
    key = F.col("key").cast("long") if number else F.col("key").cast("string")
    one = key if number else F.xxhash64(key, F.lit("\0"))
    two = F.xxhash64(key)
    bucket = F.when(F.col("key").isNull(), 0).otherwise(F.pmod(two, F.lit(buckets))).cast("int")
    return frame.withColumns({"one": F.coalesce(one, F.lit(0)), "two": two, "bucket": bucket})


def write_index(placed: DataFrame, path: str, buckets: int) -> DataFrame:
    """Write the index file of every bucket that has keys; ``bucket, keys`` of each."""
    hashed = with_hashes(placed, buckets).withColumn("absent", F.col("key").isNull())
    dealt = hashed.select("bucket", "one", "two", "absent", "shard", "nr", "at", "start", "docs").repartitionById(buckets, "bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        bucket = rows.column("bucket")[0].as_py()
        one, two, absent, shard, nr, at, start, docs = (rows.column(c).to_numpy() for c in rows.column_names[1:])
        # Rows of one key together, null keys last, each key's in the order of its documents.
        order = np.lexsort((nr, shard, two, one, absent))
        entries = [x[order].astype(kind) for x, kind in zip((shard, nr, at, start, docs), ENTRY)]
        one, two = (x[order].view(np.uint64) for x in (one, two))
        known = int((~absent).sum())
        firsts = np.flatnonzero(np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1]))[:known])
        found = PerfectHash.build(one[firsts], two[firsts])
        slots = found.slots(one[firsts], two[firsts])
        fingerprints = np.zeros(len(firsts), "<u8")
        fingerprints[slots] = two[firsts]
        sizes = np.diff(np.append(firsts, known))
        # Entries in the order of the slots, so that a slot's begin where the one before ends.
        by_slot = np.argsort(slots)
        taken = np.concatenate([ragged(firsts[by_slot], sizes[by_slot]), np.arange(known, len(order))])
        edges = np.concatenate([[0], np.cumsum(sizes[by_slot])]).astype("<u4")
        store, root = file_system(path)
        store.create_dir(f"{root}/index", recursive=True)
        out = Replaced(store, f"{root}/index/bucket-{bucket:06d}.mph")
        out.write(MAGIC)
        out.write(np.array([len(found.sizes), len(firsts), len(order)], "<u8"))
        for part in (found.sizes.astype("<u8"), found.words, fingerprints, edges, *(x[taken] for x in entries)):
            out.write(part)
        out.close()
        yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([len(firsts)], pa.int64())], ["bucket", "keys"])

    return dealt.mapInArrow(run, "bucket int, keys long")


#: Types of an entry's shard, number of its first document, ids before it in the shard and in
#: the store, and how many documents it has.
ENTRY = ("<u4", "<u8", "<u8", "<u8", "<u8")


class PerfectHash:
    """A minimal perfect hash function of pairs of 64-bit hashes."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.first_bits = np.cumsum(sizes) - sizes
        counts = np.bitwise_count(words).astype(np.int64)
        self.ranks = np.cumsum(counts) - counts

    @classmethod
    def build(cls, one: np.ndarray, two: np.ndarray) -> "PerfectHash":
        """The function of these pairs, which must differ from each other."""
        sizes, words = [], [np.zeros(0, np.uint64)]
        while len(one):
            if len(sizes) == LEVELS:
                raise ValueError("two keys have both of their 64-bit hashes in common")
            size = -(-SPARE * len(one) // 64) * 64
            places = position(one, two, len(sizes), np.int64(size))
            alone = np.bincount(places, minlength=size)[places] == 1
            bits = np.zeros(size, np.uint8)
            bits[places[alone]] = 1
            sizes.append(size)
            words.append(np.packbits(bits, bitorder="little").view("<u8"))
            one, two = one[~alone], two[~alone]
        return cls(np.array(sizes, np.int64), np.concatenate(words))

    def slots(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Each pair's slot: unique for the pairs it was built of, any or -1 for others."""
        found = np.full(len(one), -1, np.int64)
        left = np.arange(len(one))
        for level, size in enumerate(self.sizes):
            bit = self.first_bits[level] + position(one[left], two[left], level, size)
            word, place = bit >> 6, (bit & 63).astype(np.uint64)
            value = self.words[word]
            owned = (value >> place) & np.uint64(1) == 1
            below = np.bitwise_count(value & ((np.uint64(1) << place) - np.uint64(1)))
            found[left[owned]] = self.ranks[word[owned]] + below[owned]
            left = left[~owned]
        return found


def position(one: np.ndarray, two: np.ndarray, level: int, size: np.int64) -> np.ndarray:
    """Where a pair of hashes falls in the bit array of a level."""
    salt = np.uint64((level + 1) * _GOLDEN & (1 << 64) - 1)
    mixed = _mixed(_mixed(one + salt) ^ two)
    return (mixed % np.uint64(size)).astype(np.int64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Bucket:
    """An index file: its hash function, fingerprints and entries."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not an index file")
        levels, keys, entries = (int(x) for x in np.frombuffer(data, "<u8", 3, 8))
        at = 32

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            part = np.frombuffer(data, kind, count, at)
            at += part.nbytes
            return part

        sizes = take("<u8", levels).astype(np.int64)
        self.hash = PerfectHash(sizes, take("<u8", int(sizes.sum()) // 64))
        self.fingerprints, self.edges = take("<u8", keys), take("<u4", keys + 1).astype(np.int64)
        self.entries = [take(kind, entries) for kind in ENTRY]

    def find(self, one: np.ndarray, two: np.ndarray, absent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First entry and number of entries of each key; none for keys that are not there."""
        slots = self.hash.slots(one, two)
        there = (slots >= 0) & ~absent
        there[there] = self.fingerprints[slots[there]] == two[there]
        firsts, counts = np.zeros((2, len(one)), np.int64)
        firsts[there] = self.edges[slots[there]]
        counts[there] = self.edges[slots[there] + 1] - firsts[there]
        firsts[absent] = self.edges[-1]
        counts[absent] = len(self.entries[0]) - self.edges[-1]
        return firsts, counts


def find_runs(asked: DataFrame, path: str, buckets: int) -> DataFrame:
    """``key, shard, nr, at, start, docs``: the runs of documents of each key."""
    dealt = with_hashes(asked, buckets).repartitionById(buckets, "bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_system(path)
        number, opened = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if batch.column("bucket")[0].as_py() != number:  # one bucket a task
                number = batch.column("bucket")[0].as_py()
                opened = open_bucket(store, f"{root}/index/bucket-{number:06d}.mph")
            if opened is None:
                continue
            one = batch.column("one").to_numpy().view(np.uint64)
            two = batch.column("two").to_numpy().view(np.uint64)
            absent = batch.column("key").is_null().to_numpy(zero_copy_only=False)
            firsts, counts = opened.find(one, two, absent)
            which = pa.array(np.repeat(np.arange(len(one)), counts))
            taken = ragged(firsts, counts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(which), *(pa.array(x[taken].astype(np.int64)) for x in opened.entries)],
                ["key", "shard", "nr", "at", "start", "docs"],
            )

    kind = asked.schema["key"].dataType.simpleString()
    return dealt.mapInArrow(run, f"key {kind}, shard long, nr long, at long, start long, docs long")


def open_bucket(store: fs.FileSystem, name: str) -> Bucket | None:
    """The index file of a bucket; a bucket without keys has none."""
    if store.get_file_info(name).type == fs.FileType.NotFound:
        return None
    with store.open_input_file(name) as opened:
        return Bucket(opened.read())


def read_runs(runs: DataFrame, path: str, width: int) -> DataFrame:
    """A row per document of each run, read from the shards; runs come in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_system(path)
        for batch in batches:
            shards, nr, at, start, docs = (batch.column(c).to_numpy() for c in batch.schema.names[1:])
            for shard in np.unique(shards):
                chosen = np.flatnonzero(shards == shard)
                name = f"{root}/ids/shard-{shard:06d}"
                with store.open_input_file(f"{name}.len") as lengths, store.open_input_file(f"{name}.bin") as ids:
                    for first, last in near(nr[chosen], docs[chosen]):
                        span = chosen[first:last]
                        yield from documents(batch, span, int(shard), nr[span], at[span], start[span], docs[span], lengths, ids)

    def documents(batch, span, shard, nr, at, start, docs, lengths, ids) -> Iterator[pa.RecordBatch]:
        """Of runs that lie close together in one shard, in order."""
        low, high = int(nr[0]), int(nr[-1] + docs[-1])
        tokens = np.frombuffer(lengths.read_at((high - low) * 4, low * 4), "<u4").astype(np.int64)
        begins = at[0] + np.cumsum(tokens) - tokens
        wanted = ragged(nr - low, docs)
        of = np.repeat(np.arange(len(nr)), docs)
        begins, tokens = begins[wanted], tokens[wanted]
        begun = (start - at)[of] + begins
        # Neighbours are read together, at most READ bytes unless one document has more.
        ends = begins + tokens
        for first, last in close(begins, ends, READ // width, GAP // width):
            raw = np.frombuffer(ids.read_at(int(ends[last - 1] - begins[first]) * width, int(begins[first]) * width), f"<u{width}")
            n = tokens[first:last]
            data = raw[ragged(begins[first:last] - begins[first], n)].astype("<u4")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").take(pa.array(span[of[first:last]])),
                    pa.array(np.full(last - first, shard), pa.int64()),
                    pa.array(begun[first:last], pa.int64()),
                    pa.array(n, pa.int64()),
                    binary_column(data.view(np.uint8), np.concatenate([[0], np.cumsum(n) * 4])),
                ],
                ["key", "shard", "start", "n_tokens", "ids"],
            )

    kind = runs.schema["key"].dataType.simpleString()
    return runs.mapInArrow(run, f"key {kind}, shard long, start long, n_tokens long, ids binary")


def near(nr: np.ndarray, docs: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of runs whose lengths are read together: gaps of at most GAP / 4 documents."""
    return close(nr, nr + docs, READ // 4, GAP // 4)


def close(begins: np.ndarray, ends: np.ndarray, most: int, gap: int) -> Iterator[tuple[int, int]]:
    """Ranges of ordered intervals with small gaps, spanning at most ``most`` in all."""
    first = 0
    far = np.append(begins[1:] - ends[:-1] > gap, True)
    while first < len(begins):
        last = int(np.searchsorted(ends, begins[first] + most, side="right"))
        stop = int(np.argmax(far[first:])) + first + 1
        last = max(min(last, stop), first + 1)
        yield first, last
        first = last


class Replaced:
    """A file that appears under its name when it is closed, whole."""

    def __init__(self, store: fs.FileSystem, name: str):
        folder, _, last = name.rpartition("/")
        self.store, self.name, self.own = store, name, f"{folder}/.{last}.{uuid.uuid4().hex}"
        self.out = store.open_output_stream(self.own)

    def write(self, data: bytes | np.ndarray) -> None:
        """Append bytes or the bytes of an array."""
        self.out.write(data if isinstance(data, bytes) else np.ascontiguousarray(data).data.cast("B") if len(data) else b"")

    def close(self) -> None:
        """Finish the file; another attempt's file of the same name has the same content."""
        self.out.close()
        if self.store.get_file_info(self.name).type != fs.FileType.NotFound:
            self.store.delete_file(self.own)
        else:
            self.store.move(self.own, self.name)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as the cluster's default file system gives it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path with a scheme, and the path on it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(path)


def op11_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the ids of the whole of ``documents`` and look every document up by its key."""
    docs = table(spark, sf_dir, "documents")
    described = Tokenizer.from_file(public_tokenizers.path(VOCABULARY)).to_str()
    path = scratch_path(spark, "token-store")
    write_store(docs, described, path)
    return look_up(spark, path, docs).select(
        F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
