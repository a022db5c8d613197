"""Packing documents into sequences: shortest-pack-first over the length histogram.

A document longer than a sequence is cut into full sequences and a rest. Only the histogram
of the lengths of these pieces, whose size the sequence length bounds, goes to the driver.
There lengths are placed longest first, each into the shortest open pack that has room, many
equal packs at a time, so the result is a short list of packing patterns with counts.
Every piece then finds its place by its rank among the pieces of its length. Ranks come from
counts per task and length, so a length that a third of all pieces have is never gathered.
"""

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pulsetide.llm.common import returning, table, written
from pulsetide.llm.subwords import Pieces

VOCABULARY, SEQUENCE, END = "word_bpe_49k.json", 4096, 2

#: A pattern: lengths of the pieces of a sequence, in order. Its count: how many sequences.
Patterns = list[tuple[tuple[int, ...], int]]


def pack_histogram(histogram: dict[int, int], size: int) -> Patterns:
    """Patterns and counts for so many pieces of each length up to ``size``.

    Longest lengths first; each goes to the shortest pack with room for it. Packs with equal
    contents are one entry with a count, split when only some of them are extended.
    """
    packs: dict[int, dict[tuple[int, ...], int]] = {}  # by filled length
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        filled = sorted(packs)
        turn = 0
        while left:
            # Packs that this length has filled are longer, so a later turn may extend them.
            if turn == len(filled):
                again = sorted(packs)
                room = [x for x in again if x + length <= size]
                if not room:
                    each = size // length
                    whole, rest = divmod(left, each)
                    _add(packs, (length,) * each, whole)
                    _add(packs, (length,) * rest, 1 if rest else 0)
                    break
                filled, turn = again, 0
            at = filled[turn]
            if at + length > size or at not in packs:
                turn = len(filled) if at + length > size else turn + 1
                continue
            pattern, count = packs[at].popitem()
            if not packs[at]:
                del packs[at]
            some = min(count, left)
            if count > some:
                _add(packs, pattern, count - some)
            _add(packs, (*pattern, length), some)
            left -= some
            if at not in packs:
                turn += 1
    return [(pattern, count) for at in sorted(packs) for pattern, count in sorted(packs[at].items())]


def _add(packs: dict[int, dict[tuple[int, ...], int]], pattern: tuple[int, ...], count: int) -> None:
    if count:
        same = packs.setdefault(sum(pattern), {})
        same[pattern] = same.get(pattern, 0) + count


class Places:
    """Where the n-th piece of each length goes."""

    def __init__(self, patterns: Patterns):
        self.slots: dict[int, tuple[list[int], list[tuple[int, int, list[int]]]]] = {}
        first = 0
        for pattern, count in patterns:
            offsets: dict[int, list[int]] = {}
            at = 0
            for length in pattern:
                offsets.setdefault(length, []).append(at)
                at += length
            for length, places in offsets.items():
                starts, entries = self.slots.setdefault(length, ([0], []))
                entries.append((starts[-1], first, places))
                starts.append(starts[-1] + count * len(places))
            first += count

    def of(self, length: int, rank: int) -> tuple[int, int]:
        """Sequence and offset of the piece of that length and rank (from 0)."""
        starts, entries = self.slots[length]
        start, first, places = entries[bisect_right(starts, rank) - 1]
        sequence, which = divmod(rank - start, len(places))
        return first + sequence, places[which]


def cut_pieces(docs: DataFrame, described: str, size: int, end: int, text: str, id_column: str) -> DataFrame:
    """Pieces of every document: full sequences and the rest, with the checksum of their ids."""
    shared = docs.sparkSession.sparkContext.broadcast(described)
    rows = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.of(shared.value)
        for batch in batches:
            ids, bounds = pieces.encode(batch.column("text"))
            tokens = np.diff(bounds) + 1
            counts = -(-tokens // size)
            row = np.repeat(np.arange(len(tokens)), counts)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            start = nth * size
            length = np.minimum(size, tokens[row] - start)
            last = np.array([end], "<u4").tobytes()
            ids = ids.astype("<u4")
            crc = [
                zlib.crc32(last, zlib.crc32(ids[a + s :][: n - 1].tobytes()))
                if s + n == t
                else zlib.crc32(ids[a + s :][:n].tobytes())
                for a, s, n, t in zip(bounds[row], start, length, tokens[row])
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row)),
                    *[pa.array(x, pa.int64()) for x in (start, length, crc, tokens[row])],
                ],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        returning(run),
        f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long",
    )


def pack(
    docs: DataFrame,
    described: str,
    size: int = SEQUENCE,
    end: int = END,
    text: str = "text",
    id_column: str = "doc_id",
) -> DataFrame:
    """A row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    ``described`` is a tokenizer as JSON. A document is its ids without special tokens, then
    ``end``; each id lies in exactly one piece. In a sequence pieces follow without a gap.

    * A null or empty text is a document of one id. Texts may be of any length.
    * Rows that repeat, or have null ids, are documents of their own. Other columns are not
      read. An empty table gives no rows.
    """
    # Written once, so that a piece keeps its task, and with it its rank.
    pieces = written(
        cut_pieces(docs, described, size, end, text, id_column).withColumn(
            "place", F.monotonically_increasing_id()
        ),
        "pieces",
    ).withColumn("task", F.shiftright("place", 33))
    by_task = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    firsts = by_task.select(
        "task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    histogram = {
        row.length: row.n for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()
    }
    places = docs.sparkSession.sparkContext.broadcast(Places(pack_histogram(histogram, size)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = (batch.column(c).to_pylist() for c in ("length", "rank"))
            found = [places.value.of(length, rank) for length, rank in zip(lengths, ranks)]
            columns = [pa.array(c, pa.int64()) for c in (zip(*found) if found else [[], []])]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in out], *columns], [*out, "sequence_id", "offset"]
            )

    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    schema = pieces.select(*out).schema.add("sequence_id", "long").add("offset", "long")
    # A task's pieces of one length are as many as its input has; no group is larger.
    within = F.row_number().over(W.partitionBy("task", "length").orderBy("place")) - 1
    ranked = (
        pieces.withColumn("nth", within)
        .join(firsts, ["task", "length"])
        .select(*out, (F.col("first") + F.col("nth")).alias("rank"))
    )
    return ranked.mapInArrow(returning(run), schema)


def op10_packing(spark, sf_dir):
    """Pack the whole of ``documents`` into sequences of 4,096 tokens."""
    described = Tokenizer.from_file(public_tokenizers.path(VOCABULARY)).to_str()
    return pack(table(spark, sf_dir, "documents"), described)
