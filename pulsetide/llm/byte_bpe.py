"""Byte-level BPE: encoding with offsets, and decoding, by the tokenizers library.

A vocabulary of ranks (token bytes with their ranks) becomes a tokenizers model: bytes are
mapped to printable characters, and each token's last merge is found by replaying the merges
of lower rank. Decoding reverses the byte table; a character may be split over tokens, so
offsets name, for every token, the characters its bytes touch.
"""

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType
from tokenizers import Regex, Tokenizer
from tokenizers.models import BPE
from tokenizers.pre_tokenizers import ByteLevel, Sequence, Split

from pulsetide.llm.common import blocks, ragged, table, written
from pulsetide.llm.subwords import Pieces

VOCABULARY = "byte_bpe_multi_50k.tiktoken"

#: Ids that are decoded at once; a longer list is a block of its own.
BLOCK_IDS = 1 << 18


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a vocabulary of the library.

    Printable bytes of Latin-1 stand for themselves, the others for characters from 256 on.
    """
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def last_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two tokens that merge into ``token`` last; None if lower ranks don't lead there."""
    parts = [token[i : i + 1] for i in range(len(token))]
    limit = ranks[token]
    while len(parts) > 2:
        rank, at = min((ranks.get(a + b, limit), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank >= limit:
            return None
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


def tokenizer_of(ranks: dict[bytes, int], pattern: str) -> Tokenizer:
    """The vocabulary as a tokenizers model: same ids for same texts."""
    shown = byte_characters()
    name = {token: "".join(shown[b] for b in token) for token in ranks}
    merges = []
    for token in sorted(ranks, key=ranks.get):
        if len(token) > 1 and (pair := last_merge(token, ranks)):
            merges.append((name[pair[0]], name[pair[1]]))
    model = BPE(vocab={name[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True)
    tokenizer = Tokenizer(model)
    tokenizer.pre_tokenizer = Sequence(
        [Split(Regex(pattern), "isolated"), ByteLevel(add_prefix_space=False, use_regex=False)]
    )
    return tokenizer


class ByteTable:
    """The reversed byte table: the bytes of every id, in one array."""

    def __init__(self, described: str):
        vocabulary = Tokenizer.from_str(described).get_vocab()
        value = {c: b for b, c in enumerate(byte_characters())}
        self.lengths = np.zeros(max(vocabulary.values()) + 1, np.int64)
        tokens = {i: bytes(value[c] for c in token) for token, i in vocabulary.items()}
        for i, token in tokens.items():
            self.lengths[i] = len(token)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(len(self.lengths))), np.uint8)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """All bytes of the ids."""
        return self.data[ragged(self.starts[ids], self.lengths[ids])]

    def ends(self, ids: np.ndarray) -> np.ndarray:
        """Byte offset after each id."""
        return np.cumsum(self.lengths[ids])

    def character_spans(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First character and the one after the last that each id's bytes touch.

        Ids of many texts may come at once, each from one of ``bounds`` to the next; the
        characters of every text are counted from 0.
        """
        raw = self.decode(ids)
        opening = np.append((raw & 0xC0) != 0x80, True)
        character = np.cumsum(opening) - 1  # of each byte; the end counts as one more
        ends = self.ends(ids)
        starts = ends - self.lengths[ids]
        before = np.repeat(character[np.append(0, ends)[bounds[:-1]]], np.diff(bounds))
        return character[starts] - before, character[np.maximum(ends - 1, starts)] + (ends > starts) - before


def load(path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> str:
    """The tokenizer of a rank file, as JSON that executors can rebuild it from."""
    return tokenizer_of(read_ranks(path or public_tokenizers.path(VOCABULARY)), pattern).to_str()


def encode(
    docs: DataFrame, described: str, text: str = "text", offsets: bool = False, digest: bool = False
) -> DataFrame:
    """Every row of ``docs`` with ``ids``, and with offsets also ``char_starts``, ``char_ends``.

    Offsets are the characters that a token's bytes touch; tokens that share a split character
    name it each. With ``digest`` there is also ``ids_sha256``, the SHA-256 of the ids as
    little-endian 32-bit integers, in lowercase hex.

    * A null or empty text has no ids. Texts may be of any length; rows may repeat.
    * Columns with the names of the result are replaced. An empty table stays empty.
    """
    lists_made = ["ids", "char_starts", "char_ends"] if offsets else ["ids"]
    made = [*lists_made, "ids_sha256"] if digest else lists_made
    kept = [c for c in docs.columns if c not in made]
    shared = docs.sparkSession.sparkContext.broadcast((described, ByteTable(described) if offsets else None))
    schema = docs.select(*[f"`{c}`" for c in kept]).schema
    for name in made:
        schema = schema.add(name, ArrayType(IntegerType()) if name in lists_made else "string")
    return docs.mapInArrow(lambda batches: _encoded(batches, *shared.value, text, kept, made), schema)


def _encoded(
    batches: Iterator[pa.RecordBatch], described: str, table_: ByteTable | None, text: str, kept: list[str], made: list[str]
) -> Iterator[pa.RecordBatch]:
    """Batches with the columns ``kept`` and those of ``encode`` that ``made`` names."""
    pieces = Pieces.of(described)
    for batch in batches:
        ids, bounds = pieces.encode(batch.column(text))
        lists = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32)))]
        if "char_ends" in made:
            spans = [
                table_.character_spans(ids[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
                for a, b in blocks(bounds, BLOCK_IDS)
            ]
            for side in (0, 1):
                flat = np.concatenate([np.zeros(0, np.int32), *[s[side].astype(np.int32) for s in spans]])
                lists.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat)))
        if "ids_sha256" in made:
            packed = ids.astype("<u4")
            sha = [hashlib.sha256(packed[a:b]).hexdigest() for a, b in zip(bounds, bounds[1:])]
            lists.append(pa.array(sha, pa.string()))
        yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *lists], [*kept, *made])


def id_lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column of lists, and where each list starts in them; a null list is empty."""
    flat = column.flatten()
    if flat.null_count:
        raise ValueError("a list of ids holds a null")
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return flat.to_numpy(zero_copy_only=False).astype(np.int64), np.append(0, np.cumsum(sizes, dtype=np.int64))


def decode(rows: DataFrame, described: str, ids: str = "ids") -> DataFrame:
    """Every row with ``decoded``, the bytes of its ids.

    Bytes, not text: a slice of ids may start or end inside a character. ``text_of`` turns
    them into text. Null and empty lists decode to no bytes; ids that the vocabulary lacks, and
    nulls in a list, are an error. A column ``decoded`` is replaced.
    """
    kept = [c for c in rows.columns if c != "decoded"]
    shared = rows.sparkSession.sparkContext.broadcast(ByteTable(described))
    schema = rows.select(*[f"`{c}`" for c in kept]).schema.add("decoded", "binary")
    return rows.mapInArrow(lambda batches: _decoded(batches, shared.value, ids, kept), schema)


def _decoded(
    batches: Iterator[pa.RecordBatch], table_: ByteTable, ids: str, kept: list[str]
) -> Iterator[pa.RecordBatch]:
    """Batches with the columns ``kept`` and the bytes of their ids."""
    for batch in batches:
        flat, bounds = id_lists(batch.column(ids))
        out = []
        for first, last in blocks(bounds, BLOCK_IDS):
            some = flat[bounds[first] : bounds[last]]
            raw = table_.decode(some).tobytes()
            cuts = np.append(0, table_.ends(some))[bounds[first : last + 1] - bounds[first]].tolist()
            out += [raw[a:b] for a, b in zip(cuts, cuts[1:])]
        columns = [*[batch.column(c) for c in kept], pa.array(out, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, [*kept, "decoded"])


def text_of(decoded: bytes) -> str:
    """Decoded bytes as text; a character cut off at either end becomes U+FFFD."""
    return decoded.decode("utf-8", errors="replace")


def round_trips(docs: DataFrame, described: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256, n_chars`` of every row of ``docs``.

    Texts are encoded with offsets and the ids decoded, as ``encode`` and ``decode`` do, one
    after the other in one worker, so ids and bytes never leave it. ``n_chars`` is where the
    offsets of the last token end. Rows are treated as by ``encode``.
    """
    shared = docs.sparkSession.sparkContext.broadcast((described, ByteTable(described)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = ["ids", "char_starts", "char_ends", "ids_sha256"]
        coded = _encoded(batches, *shared.value, text, [key], made)
        for batch in _decoded(coded, shared.value[1], "ids", [key, *made]):
            sha = [hashlib.sha256(x.as_buffer()).hexdigest() for x in batch.column("decoded")]
            ends, bounds = id_lists(batch.column("char_ends"))
            chars = np.where(np.diff(bounds) > 0, np.append(ends, 0)[bounds[1:] - 1], 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(np.diff(bounds)), batch.column("ids_sha256"), pa.array(sha, pa.string()), pa.array(chars)],
                [key, "n_tokens", "ids_sha256", "decoded_sha256", "n_chars"],
            )

    schema = docs.select(f"`{key}`").schema
    for name, kind in zip(("n_tokens", "ids_sha256", "decoded_sha256", "n_chars"), ("long", "string", "string", "long")):
        schema = schema.add(name, kind)
    return docs.select(f"`{key}`", f"`{text}`").mapInArrow(run, schema)


def op4_byte_bpe(spark, sf_dir):
    """Encode and decode the whole of ``documents``; ids and bytes as digests."""
    return written(round_trips(table(spark, sf_dir, "documents"), load()), "byte-bpe")
