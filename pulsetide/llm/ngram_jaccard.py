"""N-gram Jaccard join: count-vector R-trees over candidate groups, then exact verification.

Texts with equal shingle sets are one node. A node's prefix is the part of its set that, by the
prefix principle, must meet the prefix of every node it can link to in a stated number of
shingles: the set is ordered by (how many documents hold it, hash), rare shingles first. Those
numbers come from an array of counters over all documents, which different shingles may share;
any order finds all links, a good one makes groups small. Nodes that share a prefix shingle form
a group, or several where a gap in their sizes is too wide for a link; a group is named by its
smallest node. All links lie inside groups.

Inside a group, a node is a point: the counts of its shingles in hash groups. The summed minima
of two points bound the overlap of two sets, and the summed minima of two boxes that of all
pairs between them, so a pair of R-trees is descended together. Nodes already known to be
connected are not compared. Pairs that survive are verified on the texts themselves.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetide.llm.common import BLOCK_BYTES, blocks, partitions, ragged, returning, small_batches, table, text_buffers, written
from pulsetide.llm.components import components
from pulsetide.llm.shingles import digest, mix, shingle_sets

WORDS, PERCENT = 5, 75

#: Counters of the documents that hold a shingle, by the first bits of its hash, and the pieces
#: in which tasks send them. More counters only save work.
COUNTER_BITS, PIECES = 24, 64

#: Nodes of a group that one task compares at once, and entries of an R-tree node.
UNIT, FANOUT = 1024, 16

#: Rounds that try so many nodes of its groups for each open node before all remaining pairs are
#: tried; a round without a link is the last. They only save work.
ROUNDS, TRIES = 4, 4

#: Hash groups of the points: powers of two between these, more only where a byte cannot hold
#: a group's count.
LEAST_GROUPS, MOST_GROUPS = 64, 4096


def least_overlap(size: int, percent: int) -> int:
    """The overlap that a set of this size needs at least to link to anything."""
    return -(-percent * size // 100)


def shared_needed(size: int) -> int:
    """How many prefix shingles a set of this size shares with any it links to."""
    return min(max(size // 16, 1), 8)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, of sorted sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return bool(both) and 100 * both >= percent * (len(a) + len(b) - both)


def point(shingles: np.ndarray) -> np.ndarray:
    """Counts of the shingles by hash group, as bytes; the number of groups follows the size.

    Groups are split until a byte holds every count, so summed minima are never too small.
    """
    groups = LEAST_GROUPS
    while groups < MOST_GROUPS and groups < len(shingles):
        groups *= 2
    while True:
        shift = np.uint64(64 - groups.bit_length() + 1)
        counts = np.bincount((shingles >> shift).astype(np.int64), minlength=groups)
        if counts.max() < 256:
            return counts.astype(np.uint8)
        groups *= 2


def packed(counts: np.ndarray) -> bytes:
    """A point for the way: most counts are small, so Huffman codes take a fraction of the bytes."""
    coder = zlib.compressobj(1, strategy=zlib.Z_HUFFMAN_ONLY)
    return coder.compress(counts.tobytes()) + coder.flush()


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with their points' counts, in batches of about ``BLOCK_BYTES`` of them: packed
    points say little about how many bytes a batch of them becomes."""
    for batch in batches:
        place = batch.schema.get_field_index("point")
        first, counts, size = 0, [], 0
        for end, one in enumerate(batch.column("point"), 1):
            counts.append(zlib.decompress(one.as_py()))
            size += len(counts[-1])
            if size >= BLOCK_BYTES or end == len(batch):
                yield batch.slice(first, end - first).set_column(place, "point", pa.array(counts, pa.binary()))
                first, counts, size = end, [], 0


def folded(points: np.ndarray, groups: int) -> np.ndarray:
    """The same points by fewer, larger hash groups."""
    held = np.uint16 if points.shape[1] <= 256 * groups else np.uint32
    return points.reshape(len(points), groups, -1).sum(axis=2, dtype=held)


class Tree:
    """An R-tree of points, packed in the order given: boxes by level, leaves first."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        self.levels = [(points, sizes)]
        while len(self.levels[-1][1]) > 1:
            boxes, least = self.levels[-1]
            cuts = np.arange(0, len(least), FANOUT)
            self.levels.append(
                (np.maximum.reduceat(boxes, cuts, axis=0), np.minimum.reduceat(least, cuts))
            )


def tree_pairs(left: Tree, right: Tree, percent: int) -> np.ndarray:
    """Pairs of points whose overlap can reach the threshold, as index pairs."""
    depth = max(len(left.levels), len(right.levels)) - 1
    pairs = np.zeros((1, 2), np.int64)
    for level in range(depth, -1, -1):
        sides = [tree.levels[min(level, len(tree.levels) - 1)] for tree in (left, right)]
        width = sides[0][0].shape[1]
        kept = [np.zeros((0, 2), np.int64)]
        # Pairs are opened part by part too: most of what they open to does not stay.
        for chunk in np.array_split(pairs, max(1, len(pairs) * FANOUT**2 * width >> 20)):
            if level < depth:
                chunk = _opened(left, right, level + 1, chunk)
            (a, na), (b, nb) = [(boxes[chunk[:, s]], least[chunk[:, s]]) for s, (boxes, least) in enumerate(sides)]
            most = np.minimum(a, b).sum(axis=1, dtype=np.int64)
            kept.append(chunk[(100 + percent) * most >= percent * (na + nb)])
        pairs = np.concatenate(kept)
    return pairs


def _opened(left: Tree, right: Tree, level: int, pairs: np.ndarray) -> np.ndarray:
    """The pairs of entries one level below the pairs of this level."""
    opened = []
    for side, tree in enumerate((left, right)):
        if level < len(tree.levels):
            first = pairs[:, side] * FANOUT
            count = np.minimum(FANOUT, len(tree.levels[level - 1][1]) - first)
        else:
            first, count = pairs[:, side], np.ones(len(pairs), np.int64)
        opened.append((first, count))
    (fa, ca), (fb, cb) = opened
    total = ca * cb
    of = np.repeat(np.arange(len(pairs)), total)
    nth = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
    return np.stack([fa[of] + nth // cb[of], fb[of] + nth % cb[of]], axis=1)


def _sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    raw, offsets = text_buffers(column)
    for first, last in blocks(offsets):
        low, high = offsets[first], offsets[last]
        yield from shingle_sets(raw[low:high], offsets[first : last + 1] - low, words)


def counters(shingles: np.ndarray) -> np.ndarray:
    """The counter of each shingle."""
    return (shingles >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)


def _describe(words: int):
    """Documents to ``kind 0``: id, size, node; and ``kind 1``: a task's counters, by piece.

    A task counts to 255; in a batch equal sets count once.
    """
    names = ["kind", "doc_id", "size", "node", "piece", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, id_type = np.zeros(1 << COUNTER_BITS, np.uint8), pa.int64()
        for batch in batches:
            sizes, nodes, seen = [], [], set()
            for one in _sets(batch.column("text"), words):
                sizes.append(len(one))
                nodes.append(digest(one))
                if nodes[-1] not in seen:
                    seen.add(nodes[-1])
                    places = counters(one)
                    found = held[places]
                    held[places] = found + (found < 255)
            count, id_type = len(sizes), batch.column("doc_id").type
            yield pa.RecordBatch.from_arrays(
                [pa.array([0] * count, pa.int32()), batch.column("doc_id"), pa.array(sizes, pa.int64()),
                 pa.array(nodes, pa.int64()), pa.nulls(count, pa.int32()), pa.nulls(count, pa.binary())],
                names,
            )
        for nr, piece in enumerate(np.split(held, PIECES)):
            if piece.any():
                # Most counters of a small task are zero.
                coder = zlib.compressobj(1, strategy=zlib.Z_RLE)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([1], pa.int32()), pa.nulls(1, id_type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()),
                     pa.array([nr], pa.int32()), pa.array([coder.compress(piece.tobytes()) + coder.flush()], pa.binary())],
                    names,
                )

    return run


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counters of all tasks, sorted by piece, to a byte each: eighths of a power of two."""

    def out(piece: int, total: np.ndarray) -> pa.RecordBatch:
        classes = np.minimum(np.rint(8 * np.log2(total + 1.0)), 255).astype(np.uint8)
        return pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([classes.tobytes()], pa.binary())], ["piece", "classes"])

    current, total = None, None
    for batch in batches:
        for piece, counts in zip(batch.column("piece").to_pylist(), batch.column("counts")):
            if piece != current:
                if current is not None:
                    yield out(current, total)
                current, total = piece, np.zeros((1 << COUNTER_BITS) // PIECES, np.int64)
            total += np.frombuffer(zlib.decompress(counts.as_py()), np.uint8)
    if current is not None:
        yield out(current, total)


def rarity(first: DataFrame) -> np.ndarray:
    """A byte for each counter, larger for more documents, of what ``_describe`` made."""
    pieces = (
        first.filter("kind = 1")
        .select("piece", "counts")
        .repartition(min(PIECES, partitions(first.sparkSession)), "piece")
        .sortWithinPartitions("piece")
        .mapInArrow(returning(_classes), "piece int, classes binary")
    )
    found = np.zeros((PIECES, (1 << COUNTER_BITS) // PIECES), np.uint8)
    with small_batches(first.sparkSession):
        for row in pieces.collect():
            found[row.piece] = np.frombuffer(row.classes, np.uint8)
    return found.reshape(-1)


def prefix(shingles: np.ndarray, classes: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles in the order (class of the counter, hash)."""
    size = len(shingles)
    length = size - least_overlap(size, percent) + shared_needed(size)
    return shingles[np.argsort(classes[counters(shingles)], kind="stable")[:length]]


def _postings(classes, words: int, percent: int, buckets: int):
    """Documents to packed ``(shingle, node, size)`` arrays by bucket of the shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = classes.value
        for batch in batches:
            seen, parts, counts, nodes, sizes = set(), [np.zeros(0, np.uint64)], [], [], []
            for one in _sets(batch.column("text"), words):
                node = digest(one)
                if len(one) and node not in seen:
                    seen.add(node)
                    parts.append(prefix(one, order, percent))
                    nodes.append(node)
                    counts.append(len(parts[-1]))
                    sizes.append(len(one))
            values = np.concatenate(parts)
            owners = np.repeat(np.array(nodes, np.int64), counts)
            held = np.repeat(np.array(sizes, np.uint32), counts)
            # Not the hash itself: a prefix holds small ones of equal classes.
            bucket = (mix(values) >> np.uint64(40)).astype(np.int64) % buckets
            place = np.argsort(bucket, kind="stable")
            values, owners, held, bucket = values[place], owners[place], held[place], bucket[place]
            starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
            ends = np.append(starts[1:], len(bucket))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket[starts], pa.int64()),
                    pa.array([values[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                    pa.array([owners[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                    pa.array([held[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                ],
                ["bucket", "shingles", "nodes", "sizes"],
            )

    return run


def _groups(percent: int):
    """Buckets, sorted, to ``(leader, node, shared)``: shingles that a node shares in the group of
    another, its leader.

    Of the nodes of a shingle, ordered by size, those on two sides of a gap cannot link.
    """

    def out(values: list[bytes], owners: list[bytes], sizes: list[bytes]) -> pa.RecordBatch:
        values = np.frombuffer(b"".join(values), np.uint64)
        owners = np.frombuffer(b"".join(owners), np.int64)
        sizes = np.frombuffer(b"".join(sizes), np.uint32)
        place = np.lexsort((owners, sizes, values))
        values, owners, sizes = values[place], owners[place], sizes[place].astype(np.int64)
        fresh = np.ones(len(values), bool)  # copies in other batches repeat a pair
        fresh[1:] = (values[1:] != values[:-1]) | (owners[1:] != owners[:-1])
        values, owners, sizes = values[fresh], owners[fresh], sizes[fresh]
        first = np.ones(len(values), bool)
        first[1:] = (values[1:] != values[:-1]) | (100 * sizes[:-1] < percent * sizes[1:])
        starts = np.flatnonzero(first)
        counts = np.diff(np.append(starts, len(values)))
        least = np.minimum.reduceat(owners, starts) if len(starts) else owners
        leaders = np.repeat(least, counts)
        led = leaders != owners
        leaders, owners = leaders[led], owners[led]
        place = np.lexsort((owners, leaders))
        leaders, owners = leaders[place], owners[place]
        new = np.ones(len(owners), bool)
        new[1:] = (leaders[1:] != leaders[:-1]) | (owners[1:] != owners[:-1])
        at = np.flatnonzero(new)
        return pa.RecordBatch.from_arrays(
            [pa.array(leaders[at]), pa.array(owners[at]), pa.array(np.diff(np.append(at, len(owners))))],
            ["leader", "node", "shared"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = None, ([], [], [])
        for batch in batches:
            for bucket, *some in zip(*[batch.column(c).to_pylist() for c in ("bucket", "shingles", "nodes", "sizes")]):
                if bucket != current and held[0]:
                    yield out(*held)
                    held = ([], [], [])
                current = bucket
                for column, value in zip(held, some):
                    column.append(value)
        if held[0]:
            yield out(*held)

    return run


def _texts(words: int):
    """Candidate rows to ``node, text, size, point`` (packed) of those whose set is the node's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, points, sizes = [], [], []
            nodes = batch.column("node").to_pylist()
            for i, one in enumerate(_sets(batch.column("text"), words)):
                if digest(one) == nodes[i]:
                    kept.append(i)
                    sizes.append(len(one))
                    points.append(packed(point(one)))
            some = batch.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [some.column("node"), some.column("text"), pa.array(sizes, pa.int64()), pa.array(points, pa.binary())],
                ["node", "text", "size", "point"],
            )

    return run


def _verify(words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = _sets(batch.column("text_a"), words), _sets(batch.column("text_b"), words)
            good = [linked(x, y, percent) for x, y in zip(left, right)]
            yield batch.filter(pa.array(good, pa.bool_())).select(["a", "b"])

    return run


def verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs ``a, b`` of nodes that link, by their texts.

    The pairs are written first, so that their size is known: of the texts only those of nodes in
    a pair are dealt anew, and not all of them in every round.
    """
    pairs = written(pairs, "pairs")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    some = texts.select("node", "text").join(needed, "node", "left_semi")
    side = lambda c: some.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}"))
    return (
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .select("a", "b", "text_a", "text_b")
        .mapInArrow(returning(_verify(words, percent)), "a long, b long")
    )


def _leaf_pairs(rows: dict, first: np.ndarray, end: np.ndarray, percent: int) -> np.ndarray:
    """Pairs of rows inside small units, one leaf each, that the points let pass."""
    at = ragged(first, end - first)
    last = np.repeat(end, end - first)
    p = np.repeat(at, last - at - 1)
    q = ragged(at + 1, last - at - 1)
    two_sided = np.repeat(np.array([rows["side"][a:b].any() for a, b in zip(first, end)], bool), end - first)
    crossing = np.repeat(two_sided, last - at - 1)
    size, width = rows["size"], rows["width"]
    fits = 100 * np.minimum(size[p], size[q]) >= percent * np.maximum(size[p], size[q])
    fits &= (rows["label"][p] != rows["label"][q]) & (~crossing | (rows["side"][p] != rows["side"][q]))
    p, q = p[fits], q[fits]
    p, q = np.where(width[p] <= width[q], p, q), np.where(width[p] <= width[q], q, p)
    out = [np.zeros((0, 2), np.int64)]
    for groups in np.unique(width[p]):
        for other in np.unique(width[q[width[p] == groups]]):
            some = np.flatnonzero((width[p] == groups) & (width[q] == other))
            for part in np.array_split(some, max(1, len(some) * other >> 22)):
                a = rows["points"][groups][rows["nth"][p[part]]]
                b = folded(rows["points"][other][rows["nth"][q[part]]], groups) if len(part) else a
                most = np.minimum(a, b).sum(axis=1, dtype=np.int64)
                ok = (100 + percent) * most >= percent * (size[p[part]] + size[q[part]])
                out.append(np.stack([p[part][ok], q[part][ok]], axis=1))
    return np.concatenate(out)


def _tree_unit(rows: dict, first: int, end: int, percent: int) -> np.ndarray:
    """Pairs of rows of one large unit that its trees let pass."""
    index = np.arange(first, end)
    index = index[np.lexsort((rows["size"][index], rows["label"][index]))]
    side, width = rows["side"][index], rows["width"][index]
    right_side = 1 if side.any() else 0
    out = [np.zeros((0, 2), np.int64)]
    tree = lambda some, groups: Tree(
        folded(rows["points"][rows["width"][some[0]]][rows["nth"][some]], groups), rows["size"][some]
    )
    for ga in np.unique(width[side == 0]):
        for gb in np.unique(width[side == right_side]):
            if not right_side and gb > ga:
                continue
            left, right = index[(side == 0) & (width == ga)], index[(side == right_side) & (width == gb)]
            # Not the widths: of two sizes that may link, one may have its groups split more often.
            a, b = rows["size"][left], rows["size"][right]
            if 100 * min(a.max(), b.max()) < percent * max(a.min(), b.min()):
                continue
            groups = min(ga, gb)
            pairs = tree_pairs(tree(left, groups), tree(right, groups), percent)
            pairs = np.stack([left[pairs[:, 0]], right[pairs[:, 1]]], axis=1)
            out.append(pairs[rows["label"][pairs[:, 0]] != rows["label"][pairs[:, 1]]])
    return np.concatenate(out)


def _unit_pairs(percent: int):
    """Sorted units of groups to pairs of nodes that may link; many small ones at once."""
    keys = ["leader", "kind", "i", "j"]

    def found(batch: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows = {c: batch.column(c).to_numpy() for c in ("node", "label", "side", "size")}
        raw, offsets = text_buffers(batch.column("point"))
        rows["width"] = np.diff(offsets)
        rows["nth"], rows["points"] = np.zeros(len(batch), np.int64), {}
        for groups in np.unique(rows["width"]).tolist():
            some = np.flatnonzero(rows["width"] == groups)
            rows["nth"][some] = np.arange(len(some))
            # Not an index of every byte, which is eight times the points.
            rows["points"][groups] = np.lib.stride_tricks.sliding_window_view(raw, groups)[offsets[some]]
        ends = np.append(starts[1:], len(batch))
        small = ends - starts <= FANOUT
        yield named(rows, _leaf_pairs(rows, starts[small], ends[small], percent))
        # One unit at a time: each may leave a pair for any two of its nodes.
        for a, b in zip(starts[~small], ends[~small]):
            yield named(rows, _tree_unit(rows, a, b, percent))

    def named(rows: dict, pairs: np.ndarray) -> pa.RecordBatch:
        pairs = np.unique(np.sort(rows["node"][pairs], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not len(batch):
                continue
            batch = pa.Table.from_batches([batch])
            held = batch if held is None else pa.concat_tables([held, batch])
            starts = unit_starts(held)
            if len(starts) > 1:  # the last unit may go on in the next batch
                yield from found(held.slice(0, starts[-1]).combine_chunks(), starts[:-1])
                held = held.slice(starts[-1])
        if held is not None and len(held):
            yield from found(held.combine_chunks(), unit_starts(held))

    def unit_starts(rows: pa.Table) -> np.ndarray:
        new = np.zeros(len(rows), bool)
        new[:1] = True
        for key in keys:
            values = rows.column(key).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        return np.flatnonzero(new)

    return run


def _remaining(groups: DataFrame, labels: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs of one group and different labels that the points let pass.

    Nodes with the main label of a group are not compared with each other. The rest of a group
    is cut into units of ``UNIT`` nodes, and each meets every unit of the group, so a task never
    holds more than two units however large the group is.
    """
    rows = written(_labelled(groups, labels, ROUNDS), "group-rows")
    sizes = rows.groupBy("leader").agg(
        F.count_if("main").alias("mains"), F.count_if(~F.col("main")).alias("others")
    )
    units = lambda c: F.ceil(F.col(c) / UNIT).cast("int")
    open_groups = sizes.filter("others > 0 AND mains + others > 1").select(
        "leader", units("mains").alias("m"), units("others").alias("o")
    )
    placed = rows.join(open_groups, "leader").withColumn(
        "at", F.pmod(F.xxhash64("node"), F.when(F.col("main"), F.col("m")).otherwise(F.col("o"))).cast("int")
    )
    unit = "struct(CAST({i} AS int) AS i, CAST({j} AS int) AS j, {k} AS kind, {s} AS side)"
    with_mains = unit.format(i="x", j="at", k="1", s="1")
    others = unit.format(i="least(x, at)", j="greatest(x, at)", k="0", s="IF(x < at, 1, 0)")
    to_mains = unit.format(i="at", j="x", k="1", s="0")
    dealt = placed.select(
        "leader", "node", "label",
        F.explode(
            F.when(F.col("main"), F.expr(f"transform(sequence(0, o - 1), x -> {with_mains})")).otherwise(
                F.concat(
                    F.expr(f"transform(sequence(0, o - 1), x -> {others})"),
                    F.expr(f"IF(m > 0, transform(sequence(0, m - 1), x -> {to_mains}), array())"),
                )
            )
        ).alias("unit"),
    ).select("leader", "node", "label", "unit.*")
    points = texts.select("node", "size", "point")
    pairs_of = _unit_pairs(percent)
    return (
        dealt.join(points, "node")
        .repartition(partitions(texts.sparkSession), "leader", "kind", "i", "j")
        .sortWithinPartitions("leader", "kind", "i", "j")
        .mapInArrow(returning(lambda batches: pairs_of(unpacked(batches))), "a long, b long")
        .distinct()
    )


def jaccard_components(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """``doc_id, n_shingles, node, component_id`` of every row of ``docs``.

    Words are lower-cased (A-Z) runs without ASCII white space; the set of a text is its
    distinct runs of ``words`` words, of fewer words all of them as one. Rows link when
    100 * intersection >= ``percent`` * union. ``component_id`` is the smallest id reachable;
    ``node`` is equal for rows with equal sets (0: empty).

    * A null or empty text, or one of white space, has no shingles and links to nothing: its
      component is its own id. Texts may be of any length.
    * Rows that repeat an id are one document where their sets are equal. A null id never
      names a component unless all its ids are null. Other columns are not read.
    * An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    first = written(
        rows.mapInArrow(
            returning(_describe(words)), "kind int, doc_id long, size long, node long, piece int, counts binary"
        ),
        "described",
    )
    documents = first.filter("kind = 0").select("doc_id", "size", "node")
    classes = spark.sparkContext.broadcast(rarity(first))
    buckets = partitions(spark)
    shared = (
        rows.mapInArrow(
            returning(_postings(classes, words, percent, buckets)), "bucket long, shingles binary, nodes binary, sizes binary"
        )
        .repartition(buckets, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(returning(_groups(percent)), "leader long, node long, shared long")
    )
    groups = written(shared.groupBy("leader", "node").agg(F.sum("shared").alias("shared")), "groups")
    classes.unpersist()
    # A leader shares each of its group's shingles with another, so this is never too small.
    leaders = groups.groupBy("leader").agg(F.sum("shared").alias("shared"))
    groups = groups.union(leaders.select("leader", F.col("leader").alias("node"), "shared"))
    nodes = documents.filter("size > 0").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("size").alias("size")
    )
    # A node that shares fewer prefix shingles than any link of its size needs has no link.
    smaller = F.ceil(F.col("size") * percent / 100)
    needed = F.least(F.greatest(F.floor(smaller / 16), F.lit(1)), F.lit(8))
    alive = (
        groups.groupBy("node").agg(F.sum("shared").alias("shared"))
        .join(nodes, "node").filter(F.col("shared") >= needed).select("node", "doc_id")
    )
    texts = written(
        rows.join(alive.withColumnRenamed("doc_id", "of"), F.col("doc_id").eqNullSafe(F.col("of")))
        .select("node", "text")
        .mapInArrow(returning(_texts(words)), "node long, text string, size long, point binary")
        .dropDuplicates(["node"]),
        "texts",
    )
    # Groups of the nodes alive; a group of one has no pair.
    groups = groups.join(texts.select("node"), "node", "left_semi")
    groups = written(groups, "groups-alive")
    labels = spark.createDataFrame([], "node long, label long")
    for turn in range(ROUNDS):
        pairs = _bounded(_to_pivots(groups, labels, turn), texts, percent)
        found = written(verified(pairs, texts, words, percent), "to-pivots")
        if found.isEmpty():
            break
        labels = _relabelled(labels, found)
    rest = verified(_remaining(groups, labels, texts, percent), texts, words, percent)
    labels = _relabelled(labels, written(rest, "rest"))
    named = (
        nodes.join(labels, "node", "left").select("node", "doc_id", F.coalesce("label", "node").alias("component"))
    )
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_node = named.join(least, "component").select("node", "component_id")
    return documents.join(by_node, "node", "left").select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        "node",
        F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def _labelled(groups: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """The rows of ``groups`` with their ``label``, how many rows of the group have the label that
    most have (``n``), and whether theirs is that one (``main``); of ties a hash picks one."""
    rows = groups.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    sizes = rows.groupBy("leader", "label").agg(F.count("*").alias("n"))
    most = sizes.groupBy("leader").agg(F.max(F.struct("n", F.xxhash64("label", F.lit(turn)), "label")).alias("m"))
    return rows.join(most, "leader").select(
        "leader", "node", "shared", "label", F.col("m.n").alias("n"), (F.col("label") == F.col("m.label")).alias("main")
    )


def _to_pivots(groups: DataFrame, labels: DataFrame, turn: int) -> DataFrame:
    """Candidates for each node: the leader of the group in which it shares most, and in later
    turns, from groups whose main label it has not, nodes with that label that hashes pick. Half
    of these are of the group in which it shares most, the others of that with most such nodes."""
    if turn == 0:
        candidates = groups.select(F.col("leader").alias("pivot"), "node", "shared").filter("pivot <> node")
        best = candidates.groupBy("node").agg(F.max(F.struct("shared", "pivot")).alias("best"))
        return best.select(F.col("node").alias("a"), F.col("best.pivot").alias("b"))
    rows = _labelled(groups, labels, turn)
    pick = lambda nr: F.min(F.struct(F.xxhash64("node", F.lit(turn * TRIES + nr)), "node")).alias(f"p{nr}")
    pivots = rows.filter("main").groupBy("leader").agg(*[pick(nr) for nr in range(TRIES)])
    order = lambda nr: ("shared", "n") if nr % 2 else ("n", "shared")
    best = (
        rows.filter("NOT main").join(pivots, "leader").groupBy("node")
        .agg(*[F.max(F.struct(*order(nr), F.col(f"p{nr}.node").alias("pivot"))).alias(f"b{nr}") for nr in range(TRIES)])
    )
    tried = F.explode(F.array_distinct(F.array(*[F.col(f"b{nr}.pivot") for nr in range(TRIES)])))
    return best.select(F.col("node").alias("a"), tried.alias("b"))


def _relabelled(labels: DataFrame, found: DataFrame) -> DataFrame:
    """Labels after more links ``a, b``: nodes have one label if, and only if, they are connected.

    Nodes without a label are their own. Only the links between labels go through the stars.
    """
    label_of = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"label_{c}"))
    between = (
        found.join(label_of("a"), "a", "left").join(label_of("b"), "b", "left")
        .select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b"))
    )
    moved = components(between).select(F.col("node").alias("label"), F.col("component").alias("next"))
    new = found.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(labels, "node", "left_anti")
    known = labels.union(new.select("node", F.col("node").alias("label")))
    return written(known.join(moved, "label", "left").select("node", F.coalesce("next", "label").alias("label")), "labels")


def _bounded(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs that their points let pass; points are smaller than texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("size_a", "size_b", "point_a", "point_b")]
            good = []
            for na, nb, *both in zip(*columns):
                both = [np.frombuffer(zlib.decompress(x), np.uint8) for x in both]
                groups = min(map(len, both))
                a, b = (folded(x[None, :], groups)[0] for x in both)
                most = int(np.minimum(a, b).sum(dtype=np.int64))
                good.append((100 + percent) * most >= percent * (na + nb))
            yield batch.filter(pa.array(good, pa.bool_())).select(["a", "b"])

    # Sizes first: pairs that they rule out never meet a point.
    side = lambda what, c: texts.select(F.col("node").alias(c), F.col(what).alias(f"{what}_{c}"))
    fitting = pairs.join(side("size", "a"), "a").join(side("size", "b"), "b").filter(
        F.least("size_a", "size_b") * 100 >= F.greatest("size_a", "size_b") * percent
    )
    joined = fitting.join(side("point", "a"), "a").join(side("point", "b"), "b")
    return joined.select("a", "b", "size_a", "size_b", "point_a", "point_b").mapInArrow(returning(run), "a long, b long")


def op2_ngram_jaccard(spark, sf_dir):
    """Components of near-duplicates in the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_components(docs).select("doc_id", "n_shingles", "component_id")


ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
grams AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
  FROM words),
sets AS (SELECT s, min(doc_id) AS node, len(s) AS n FROM (SELECT doc_id, list_sort(s) AS s FROM grams) GROUP BY s),
tokens AS (SELECT node, n, unnest(s) AS t FROM sets),
shared AS (
  SELECT a.node AS a, b.node AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k
  FROM tokens a JOIN tokens b ON a.t = b.t AND a.node < b.node AND 100 * least(a.n, b.n) >= 75 * greatest(a.n, b.n)
  GROUP BY a.node, b.node),
links AS (SELECT a, b FROM shared WHERE 100 * k >= 75 * (na + nb - k)),
two_way AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, to_node) AS (
  SELECT node, node FROM sets UNION SELECT r.node, b.b FROM reach r JOIN two_way b ON r.to_node = b.a),
component AS (SELECT node, min(to_node) AS component_id FROM reach GROUP BY node)
SELECT g.doc_id, len(g.s)::bigint AS n_shingles,
  CASE WHEN len(g.s) = 0 THEN g.doc_id ELSE c.component_id END AS component_id
FROM grams g JOIN sets s ON list_sort(g.s) = s.s JOIN component c ON s.node = c.node
"""
