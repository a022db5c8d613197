"""Suffix-array dedup: bytes covered by a string of ``width`` bytes that also starts elsewhere.

1. Anchors. Of all runs of ``GRAM`` bytes inside a string of ``width`` bytes, one with the
   smallest hash is its anchor; it depends on that string alone, so both places of a repeated
   string have the same one. A string whose anchor occurs once cannot repeat. This leaves the
   starts that can, and loses none.
2. Per-shard suffix arrays. Texts with such starts are packed into shards. The stretches they
   cover are sorted by Larsson-Sadakane refinement, and Kasai's algorithm gives the common
   prefixes: starts whose common prefix reaches ``width`` are one class, repeated or not.
3. Merging. Each shard sends one sorted run of its classes to every range of their
   fingerprints (the strings themselves would be ``width`` times the text). Runs of a range
   are merged pairwise by binary search; a class met twice repeats, and bit masks go back.

Equal texts are handled once: all of a text that occurs twice repeats. A class is in a run
once, whoever shares it, so no range holds more of a frequent passage than one entry a shard.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetide.llm.common import blocks, body, partitions, ragged, returning, table, text_buffers, written
from pulsetide.llm.shingles import mix, powers

#: Bytes of a repeated string, and of an anchor.
WIDTH, GRAM = 200, 64

#: Bytes that a shard's suffix array covers; a longer text has a shard of its own.
SHARD_BYTES = 2 << 20

#: Texts of a shard, so that a shard's row stays small when little of its texts repeats.
SHARD_TEXT = 8 << 20


def window_hashes(raw: np.ndarray, width: int, piece: int = 1 << 20) -> np.ndarray:
    """A 64-bit hash of the ``width`` bytes from each place that has so many."""
    count = max(len(raw) - width + 1, 0)
    out = np.empty(count, np.uint64)
    up, down = powers(min(piece, max(count, 1)) + width + 1)
    for at in range(0, count, piece):
        size = min(piece, count - at)
        part = raw[at : at + size + width - 1].astype(np.uint64)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part + np.uint64(1)) * up[: len(part)], out=sums[1:])
        out[at : at + size] = mix((sums[width:] - sums[:-width]) * down[:size])
    return out


def sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """``best`` (minimum or maximum) of ``width`` values from each place that has so many."""
    count = len(values) - width + 1
    rows = -(-len(values) // width)
    padded = np.full(rows * width, values[-1], values.dtype)
    padded[: len(values)] = values
    grid = padded.reshape(rows, width)
    ahead = best.accumulate(grid, axis=1).reshape(-1)
    behind = np.ascontiguousarray(best.accumulate(grid[:, ::-1], axis=1)[:, ::-1]).reshape(-1)
    return best(behind[:count], ahead[width - 1 : width - 1 + count])


def least_grams(raw: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all grams, and the least of those in each string (0 if it leaves its text)."""
    gram = min(GRAM, width)
    hashes = window_hashes(raw, gram) | np.uint64(1)
    if len(raw) < width:
        return hashes, np.zeros(0, np.uint64)
    least = sliding(hashes, width - gram + 1, np.minimum)
    least[~inside(offsets, width, len(least))] = 0
    return hashes, least


def anchors(raw: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``raw`` and hashes of all anchors of the texts."""
    hashes, least = least_grams(raw, offsets, width)
    if not len(least):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    span = width - min(GRAM, width) + 1
    edge = np.zeros(span - 1, np.uint64)
    most = sliding(np.concatenate([edge, least, edge]), span, np.maximum)
    places = np.flatnonzero(hashes == most)
    return places, hashes[places]


def inside(offsets: np.ndarray, width: int, count: int) -> np.ndarray:
    """Whether the ``width`` bytes from each of the first ``count`` places lie in one text."""
    lengths = np.diff(offsets)
    return (np.arange(offsets[-1]) + width <= np.repeat(offsets[1:], lengths))[:count]


def eight_bytes(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as one number in their order; zeros after the end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    key = np.zeros(len(text), np.uint64)
    for step in range(8):
        key = (key << np.uint64(8)) | padded[step : step + len(text)]
    return key


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of their suffixes' first ``depth`` bytes (or more).

    Larsson-Sadakane: sort by eight bytes, then refine the groups that are still equal by the
    ranks ``h`` places on, doubling ``h``; groups of one are left alone. A rank is the first
    index of a group. Places and ranks are 32-bit numbers unless the text is longer.
    """
    count = len(text)
    small = np.int32 if count < 1 << 31 else np.int64
    key = eight_bytes(text)
    order = np.argsort(key, kind="stable").astype(small)
    key = key[order]
    opens = np.ones(count, bool)
    opens[1:] = key[1:] != key[:-1]
    del key
    rank = np.empty(count, small)
    rank[order] = np.maximum.accumulate(np.where(opens, np.arange(count, dtype=small), small(0)))
    h = 8
    while h < depth:
        alone = opens & np.append(opens[1:], True)
        open_ = np.flatnonzero(~alone).astype(small)
        if not len(open_):
            break
        places = order[open_]
        both = rank[places].astype(np.int64) * (count + 1)
        further = np.flatnonzero(places < count - h)
        both[further] += rank[places[further] + small(h)] + np.int64(1)
        turn = np.argsort(both, kind="stable")
        both, places = both[turn], places[turn]
        del turn
        order[open_] = places
        new = np.ones(len(open_), bool)
        new[1:] = both[1:] != both[:-1]
        del both
        opens[open_] = new
        rank[places] = open_[np.maximum.accumulate(np.where(new, np.arange(len(open_), dtype=small), small(0)))]
        h *= 2
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int, run: int = 256) -> np.ndarray:
    """Common prefix of each suffix in order with the one before, up to ``most`` (Kasai).

    Kasai's walk along the text, in many runs of ``run`` places side by side: the prefix found
    for a place, less one, holds for the next. ``order`` must hold for the first ``most``
    bytes. Suffixes that agree on all of these may stand in any order, so nothing carries over
    from them to the next place.
    """
    count = len(text)
    at = np.empty(count, order.dtype)
    at[order] = np.arange(count, dtype=order.dtype)
    key = eight_bytes(text)
    lanes = np.arange(0, count, run)
    found = np.zeros(len(lanes), np.int64)
    prefixes = np.zeros(count, np.int32)
    for step in range(run):
        here = lanes + step
        some = np.flatnonzero(here < count)
        index = at[here[some]]
        first = index == 0
        found[some[first]] = 0
        some, index = some[~first], index[~first]
        a, b = here[some], order[index - 1].astype(np.int64)
        h = np.maximum(found[some] - 1, 0)
        h[found[some] >= most] = 0
        room = np.minimum(count - np.maximum(a, b), most)
        h[room < 16] = 0  # at the very end zeros stand for missing bytes
        for size in (8, 1):
            live = np.flatnonzero(h + size <= room)
            while len(live):
                x, y = a[live] + h[live], b[live] + h[live]
                same = key[x] == key[y] if size == 8 else text[x] == text[y]
                live = live[same]
                h[live] += size
                live = live[h[live] + size <= room[live]]
        prefixes[index] = found[some] = h
    return prefixes


def _anchor_rows(width: int, buckets: int):
    """Texts to packed ``(hash, owner, place)`` of their anchors by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners = batch.column("owner").to_numpy()
            _, firsts = np.unique(owners, return_index=True)  # a copy adds nothing
            firsts = np.sort(firsts)
            owners = owners[firsts]
            raw, offsets = text_buffers(batch.column("body").take(pa.array(firsts)))
            parts = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32))]
            for a, b in blocks(offsets):
                places, hashes = anchors(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], width)
                places = places + offsets[a]
                row = np.searchsorted(offsets, places, side="right") - 1
                parts.append((hashes, owners[row], (places - offsets[row]).astype(np.int32)))
            columns = [np.concatenate(x) for x in zip(*parts)]
            bucket = (mix(columns[0]) >> np.uint64(40)).astype(np.int64) % buckets
            turn = np.argsort(bucket, kind="stable")
            columns, bucket = [c[turn] for c in columns], bucket[turn]
            present, starts = np.unique(bucket, return_index=True)
            ends = np.append(starts[1:], len(bucket))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(present, pa.int64()),
                    *[pa.array([c[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()) for c in columns],
                ],
                ["bucket", "hashes", "owners", "places"],
            )

    return run


def _by_bucket(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple]:
    """Sorted rows as ``bucket, lists of values``, one bucket at a time."""
    current, held = None, None
    for batch in batches:
        for bucket, *values in zip(*[batch.column(c).to_pylist() for c in ["bucket", *names]]):
            if bucket != current:
                if held:
                    yield current, *held
                current, held = bucket, [[] for _ in names]
            for place, value in zip(held, values):
                place.append(value)
    if held:
        yield current, *held


def _repeated_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets of anchors to ``owner, places`` of those that occur more than once."""
    for _, hashes, owners, places in _by_bucket(batches, ["hashes", "owners", "places"]):
        hashes = np.frombuffer(b"".join(hashes), np.uint64)
        owners = np.frombuffer(b"".join(owners), np.int64)
        places = np.frombuffer(b"".join(places), np.int32)
        turn = np.lexsort((places, owners, hashes))
        hashes, owners, places = hashes[turn], owners[turn], places[turn]
        fresh = np.ones(len(hashes), bool)  # copies in other batches repeat an anchor
        fresh[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1]) | (places[1:] != places[:-1])
        hashes, owners, places = hashes[fresh], owners[fresh], places[fresh]
        same = hashes[1:] == hashes[:-1]
        twice = np.append(same, False) | np.append(False, same)
        owners, places = owners[twice], places[twice]
        turn = np.argsort(owners, kind="stable")
        owners, places = owners[turn], places[turn]
        present, starts = np.unique(owners, return_index=True)
        ends = np.append(starts[1:], len(owners))
        yield pa.RecordBatch.from_arrays(
            [pa.array(present, pa.int64()), pa.array([places[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary())],
            ["owner", "places"],
        )


def possible_starts(raw: np.ndarray, repeated: np.ndarray, width: int) -> np.ndarray:
    """Starts of the strings of a text whose anchor is at one of the places in ``repeated``."""
    hashes, least = least_grams(raw, np.array([0, len(raw)]), width)
    known = np.unique(hashes[repeated])
    if not len(known):
        return np.zeros(0, np.int64)
    place = np.minimum(np.searchsorted(known, least), len(known) - 1)
    return np.flatnonzero(known[place] == least)


def stretches(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted starts as first starts and counts of runs without a gap."""
    new = np.flatnonzero(np.append(True, starts[1:] > starts[:-1] + 1))
    return starts[new], np.diff(np.append(new, len(starts)))


def covered(starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end of the maximal stretches that the strings from sorted starts cover."""
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.flatnonzero(np.append(True, starts[1:] > starts[:-1] + width))
    return starts[new], starts[np.append(new[1:], len(starts)) - 1] + width


def _shards(width: int):
    """Texts with their repeated anchors to shards of texts with their possible starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        held, covers, size = [], 0, 0

        def out():
            nonlocal made, held, covers, size
            owners, texts, starts = zip(*held)
            runs = [stretches(x) for x in starts]
            row = [
                [(task << 32) + made],
                [np.array(owners, np.int64).tobytes()],
                [np.array([len(x) for x in texts], np.int64).tobytes()],
                [zstandard.compress(b"".join(texts), 1)],
                [np.array([len(x) for x, _ in runs], np.int64).tobytes()],
                [np.concatenate([x for x, _ in runs]).astype(np.int32).tobytes()],
                [np.concatenate([n for _, n in runs]).astype(np.int32).tobytes()],
            ]
            made, held, covers, size = made + 1, [], 0, 0
            types = [pa.int64()] + [pa.binary()] * 6
            return pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(row, types)],
                ["shard", "owners", "lengths", "texts", "counts", "firsts", "sizes"],
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("owner", "places", "body")]
            for owner, places, text in zip(*columns):
                repeated = np.frombuffer(b"".join(places), np.int32)
                starts = possible_starts(np.frombuffer(text, np.uint8), repeated, width)
                if not len(starts):
                    continue
                first, end = covered(starts, width)
                more = int((end - first).sum())
                if held and (covers + more > SHARD_BYTES or size + len(text) > SHARD_TEXT):
                    yield out()
                held.append((owner, text, starts))
                covers, size = covers + more, size + len(text)
        if held:
            yield out()

    return run


class Shard:
    """A shard's stretches as one text, its possible starts in it, and their fingerprints."""

    def __init__(self, row: dict, width: int):
        self.owners = np.frombuffer(row["owners"], np.int64)
        self.lengths = np.frombuffer(row["lengths"], np.int64)
        self.texts = np.frombuffer(zstandard.decompress(row["texts"]), np.uint8)
        runs = np.frombuffer(row["counts"], np.int64)
        base = np.cumsum(self.lengths) - self.lengths
        sizes = np.frombuffer(row["sizes"], np.int32).astype(np.int64)
        self.starts = ragged(np.frombuffer(row["firsts"], np.int32) + np.repeat(base, runs), sizes)
        self.counts = np.add.reduceat(sizes, np.cumsum(runs) - runs)
        self.base = base
        # Strings of two texts that follow each other never cover one stretch.
        split = np.repeat(np.arange(len(base)), self.counts) * (width + 1)
        first, end = covered(self.starts + split, width)
        shift = np.repeat(split, 1)[np.searchsorted(self.starts + split, first)]
        first, end = first - shift, end - shift
        self.text = self.texts[ragged(first, end - first)]
        place = np.cumsum(end - first) - (end - first)
        which = np.searchsorted(first, self.starts, side="right") - 1
        self.places = self.starts - first[which] + place[which]
        del split, shift, which
        prints = window_hashes(self.text, width)[self.places] >> np.uint64(1)
        self.prints, self.of = np.unique(prints, return_inverse=True)

    def repeated_within(self, width: int) -> np.ndarray:
        """Which fingerprints start more than once in the shard, by its suffix array."""
        depth = 8
        while depth < width:
            depth *= 2
        order = suffix_array(self.text, depth)
        prefixes = common_prefixes(self.text, order, depth)
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(prefixes < width)
        mine = group[self.places]
        twice = np.bincount(mine)[mine] > 1
        out = np.zeros(len(self.prints), bool)
        out[self.of[twice]] = True
        return out


def range_cuts(prints: np.ndarray, buckets: int) -> np.ndarray:
    """Where each of the ranges of 63-bit fingerprints starts in a sorted run, and the end."""
    edges = (np.arange(buckets, dtype=np.float64) * (2.0**63 / buckets)).astype(np.uint64)
    return np.append(np.searchsorted(prints, edges), len(prints))


def _runs(width: int, buckets: int):
    """Shards to their sorted runs by range; the lowest bit says repeated within the shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row, width)
                run_ = (shard.prints << np.uint64(1)) | shard.repeated_within(width).astype(np.uint64)
                cuts = range_cuts(shard.prints, buckets)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(buckets)),
                        pa.array([row["shard"]] * buckets, pa.int64()),
                        pa.array([run_[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
                    ],
                    ["bucket", "shard", "run"],
                )
                del shard, run_  # before the next is made

    return run


def merge(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two sorted runs of ``(values, repeated)`` as one; values in both repeat."""
    (left, left_twice), (right, right_twice) = a, b
    place = np.searchsorted(left, right)
    met = left[np.minimum(place, len(left) - 1)] == right if len(left) else np.zeros(len(right), bool)
    left_twice = left_twice.copy()
    left_twice[place[met]] = True
    new = ~met
    return np.insert(left, place[new], right[new]), np.insert(left_twice, place[new], right_twice[new])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of a range to a bit mask for each shard: which of its entries repeat."""
    for bucket, shards, runs in _by_bucket(batches, ["shard", "run"]):
        runs = [np.frombuffer(x, np.uint64) for x in runs]
        level = [(x >> np.uint64(1), (x & np.uint64(1)).astype(bool)) for x in runs]
        while len(level) > 1:
            level = [merge(*level[i : i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
        values, twice = level[0]
        masks = [np.packbits(twice[np.searchsorted(values, x >> np.uint64(1))]).tobytes() for x in runs]
        yield pa.RecordBatch.from_arrays(
            [pa.array([bucket] * len(shards), pa.int64()), pa.array(shards, pa.int64()), pa.array(masks, pa.binary())],
            ["bucket", "shard", "mask"],
        )


def to_characters(text: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ordered stretches widened to whole UTF-8 characters."""
    inner = np.append((text & 0xC0) == 0x80, False)
    while (split := inner[first] & (first > 0)).any():
        first = first - split
    while (split := inner[end]).any():
        end = end + split
    return first, end


def _spans(width: int, buckets: int, carry_text: bool, whole_characters: bool):
    """Shards with their masks to the repeated stretches of every text, and what is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row, width)
                cuts = range_cuts(shard.prints, buckets)
                twice = np.zeros(len(shard.prints), bool)
                for part in row["masks"]:
                    a, b = cuts[part["bucket"]], cuts[part["bucket"] + 1]
                    twice[a:b] = np.unpackbits(np.frombuffer(part["mask"], np.uint8), count=b - a)
                out = []
                ends = np.cumsum(shard.counts)
                for i, owner in enumerate(shard.owners):
                    some = slice(ends[i] - shard.counts[i], ends[i])
                    starts = shard.starts[some][twice[shard.of[some]]] - shard.base[i]
                    first, end = covered(starts, width)
                    text = shard.texts[shard.base[i] : shard.base[i] + shard.lengths[i]]
                    if whole_characters:
                        first, end = to_characters(text, first, end)
                    # Widened stretches may meet, but they never overlap by more than a character.
                    gone = np.zeros(len(text) + 1, np.int32)
                    np.add.at(gone, first, 1)
                    np.add.at(gone, end, -1)
                    left = text[np.cumsum(gone[:-1]) == 0].tobytes()
                    out.append((owner, first.tolist(), end.tolist(), hashlib.sha256(left).digest(), left if carry_text else None))
                columns = zip(*out)
                types = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)],
                    ["owner", "span_starts", "span_ends", "kept_sha", "left"],
                )
                del shard, twice, out, columns

    return run


def repeated_spans(
    docs: DataFrame,
    width: int = WIDTH,
    text: str = "text",
    carry_text: bool = True,
    whole_characters: bool = False,
) -> DataFrame:
    """Every row of ``docs`` with its repeated stretches and what is left of its text.

    Without ``carry_text`` the text column is left out. With ``whole_characters`` a stretch
    that begins or ends inside a UTF-8 character takes all of it, so what is left is text; two
    stretches may then touch. Added are ``n_bytes``, ``span_starts`` and ``span_ends`` (byte offsets of the maximal
    removed stretches), ``kept_sha256`` and, with ``carry_text``, ``left`` (the remaining
    bytes; without ``whole_characters``, cut characters are cut). Columns of these names are replaced.

    * A null text is empty. Texts shorter than ``width`` keep all their bytes, whatever else
      repeats. Strings never reach over the end of a text. Texts may be of any length.
    * Rows with equal texts, repeated rows among them, are places of their own, so all of such
      a text of ``width`` bytes or more is removed. An empty table stays empty.
    * Texts and strings are told apart by 64-bit hashes.
    """
    buckets = partitions(docs.sparkSession)
    made = ("n_bytes", "span_starts", "span_ends", "kept_sha256", "left")
    others = [c for c in docs.columns if c not in made and (carry_text or c != text)]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), body(f"`{text}`").alias("body")
    ).withColumns({"owner": F.xxhash64("body"), "size": F.length("body")})
    long = rows.filter(F.col("size") >= width)
    found = (
        long.select("owner", "body")
        .mapInArrow(returning(_anchor_rows(width, buckets)), "bucket long, hashes binary, owners binary, places binary")
        .repartition(buckets, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(returning(_repeated_anchors), "owner long, places binary")
        .groupBy("owner")
        .agg(F.collect_list("places").alias("places"))
    )
    # One of the rows with a text stands for it: the one that a hash of all its columns names.
    named = long.select("owner", F.xxhash64("row").alias("name"), "body")
    first = long.groupBy("owner").agg(F.min(F.xxhash64("row")).alias("name"), F.count("*").alias("copies"))
    chosen = written(found.join(first, "owner"), "anchors")
    shards = written(
        named.join(chosen.select("owner", "name", "places"), ["owner", "name"])
        .select("owner", "places", "body")
        .dropDuplicates(["owner"])
        .mapInArrow(
            returning(_shards(width)), "shard long, owners binary, lengths binary, texts binary, counts binary, firsts binary, sizes binary"
        ),
        "shards",
    )
    masks = written(
        shards.mapInArrow(returning(_runs(width, buckets)), "bucket long, shard long, run binary")
        .repartition(buckets, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(returning(_merged), "bucket long, shard long, mask binary"),
        "masks",
    )
    by_shard = masks.groupBy("shard").agg(F.collect_list(F.struct("bucket", "mask")).alias("masks"))
    spans = written(
        shards.join(by_shard, "shard").mapInArrow(
            returning(_spans(width, buckets, carry_text, whole_characters)),
            "owner long, span_starts array<int>, span_ends array<int>, kept_sha binary, left binary",
        ),
        "spans",
    )
    # A text that occurs twice goes as a whole; its shard's entry was for the others' sake.
    copied = first.filter("copies > 1").select("owner", F.lit(True).alias("copied"))
    facts = spans.join(copied, "owner", "full")
    none = F.array().cast("array<int>")
    whole = F.coalesce("copied", F.lit(False))
    # The text travels once, in the row; without it only its digest does.
    if carry_text:
        mine = rows.drop("body")
        own = F.coalesce(F.col(f"row.`{text}`").cast("binary"), F.lit(b""))
        sha = F.unhex(F.sha2(own, 256))
    else:
        mine = rows.withColumn("sha", F.unhex(F.sha2("body", 256))).drop("body")
        own = sha = F.col("sha")
    joined = mine.join(facts, "owner", "left")
    empty = hashlib.sha256(b"").hexdigest()
    columns = [
        F.col("size").cast("long").alias("n_bytes"),
        F.when(whole, F.array(F.lit(0))).otherwise(F.coalesce("span_starts", none)).alias("span_starts"),
        F.when(whole, F.array(F.col("size"))).otherwise(F.coalesce("span_ends", none)).alias("span_ends"),
        F.when(whole, F.lit(empty)).otherwise(F.lower(F.hex(F.coalesce("kept_sha", sha)))).alias("kept_sha256"),
    ]
    if carry_text:
        columns.append(F.when(whole, F.lit(b"")).otherwise(F.coalesce(F.col("left"), own)).alias("left"))
    return joined.select(*[F.col(f"row.`{c}`").alias(c) for c in others], *columns)


def op3_suffix_array_dedup(spark, sf_dir):
    """Repeated strings of 200 bytes in the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # The text itself is not carried along: only its bytes are compared.
    found = repeated_spans(docs, carry_text=False)
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select(
        "doc_id",
        "n_bytes",
        (total("span_ends") - total("span_starts")).alias("n_removed"),
        F.size("span_starts").cast("long").alias("n_spans"),
        "kept_sha256",
    )


ORACLE = r"""
WITH texts AS (
  SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS b FROM documents),
sized AS (SELECT *, octet_length(b) AS n FROM texts),
starts AS (SELECT rid, s, md5_number(array_slice(b, s + 1, s + 200)) AS h FROM (SELECT rid, b, unnest(range(n - 199)) AS s FROM sized)),
again AS (SELECT h FROM starts GROUP BY h HAVING count(*) > 1),
hits AS (SELECT rid, s FROM starts WHERE h IN (SELECT h FROM again)),
fresh AS (SELECT *, s > lag(s, 1, -201) OVER w + 200 AS opens FROM hits WINDOW w AS (PARTITION BY rid ORDER BY s)),
runs AS (SELECT rid, s, sum(opens::int) OVER (PARTITION BY rid ORDER BY s) AS run FROM fresh),
spans AS (SELECT rid, min(s) AS a, max(s) + 200 AS z FROM runs GROUP BY rid, run),
pieces AS (
  SELECT rid, a, hex(array_slice(b, lag(z, 1, 0) OVER (PARTITION BY rid ORDER BY a) + 1, a)) AS kept, z - a AS gone, z
  FROM spans JOIN sized USING (rid)),
found AS (
  SELECT rid, string_agg(kept, '' ORDER BY a) AS kept, sum(gone)::bigint AS gone, count(*) AS spans, max(z) AS z
  FROM pieces GROUP BY rid)
SELECT doc_id, n::bigint AS n_bytes, coalesce(gone, 0)::bigint AS n_removed, coalesce(spans, 0)::bigint AS n_spans,
  sha256(unhex(coalesce(kept, '') || hex(array_slice(b, coalesce(z, 0) + 1, n)))) AS kept_sha256
FROM sized LEFT JOIN found USING (rid)
"""
