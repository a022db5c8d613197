"""Exact top-k search by inner product, with pivot-table elimination.

Distances from every vector to many pivots are computed once. By the triangle inequality the
largest difference of two vectors' distances to one pivot is a lower bound of their own
distance, and with both lengths an upper bound of their inner product. Candidates of a block
are evaluated in the order of that bound until no bound reaches the k-th best score, so the
result is exact. A block as a whole is bounded by the ranges of its distances first.

Vectors travel in packed blocks; each block of queries meets each block of candidates once,
as the task (a stated set of queries against all rows) demands, and nothing is broadcast but
the pivots. A block of queries meets all candidate blocks of a slice one after another, those
with long vectors first, and takes its k-th best scores along.

Vectors with huge components, whose scores need not fit 64 bits on the way, are in blocks of
their own, scored one by one in whole numbers of any size, without bounds.
"""

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pulsetide.llm.common import partitions, table

#: Pivots, the sample they are chosen from, and vectors in a block of each kind.
PIVOTS, SAMPLE, CANDIDATES, QUERIES = 32, 512, 2048, 256

#: Vectors with a component of this absolute value or more are huge.
HUGE = 1 << 27

#: Candidates evaluated between two looks at the bound.
STEP = 64

BLOCK = "block long, dim int, huge boolean, longest double, ids binary, vectors binary, distances binary"


def whole_numbers(vectors: DataFrame, id_column: str, vector: str, scale: int) -> DataFrame:
    """``id``, ``v`` (floor of ``scale`` times each component) and ``huge`` of vectors that take part.

    The floors are whole numbers in doubles, which hold them exactly whatever their size.
    """
    value = F.col(f"`{vector}`")
    finite = lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf"))

    def floor(x: Column) -> Column:
        y = x.cast("double") * scale
        return F.when(F.abs(y) < float(1 << 52), F.floor(y).cast("double")).otherwise(y)

    whole = F.transform(value, floor)
    return (
        vectors.filter(F.col(f"`{id_column}`").isNotNull() & value.isNotNull())
        .filter(F.forall(value, finite))
        .select(F.col(f"`{id_column}`").cast("long").alias("id"), whole.alias("v"))
        .withColumn("huge", F.exists("v", lambda x: F.abs(x) >= HUGE))
    )


def choose_pivots(vectors: DataFrame, count: int = PIVOTS) -> dict[int, np.ndarray]:
    """Pivots by dimension, each farthest from those before, out of a bounded sample."""
    sample = vectors.filter("NOT huge").orderBy(F.xxhash64("id", "v"), "id").limit(SAMPLE).collect()
    out = {}
    for dim in {len(row.v) for row in sample}:
        rows = np.array([row.v for row in sample if len(row.v) == dim], np.float64)
        near = np.linalg.norm(rows - rows.mean(axis=0), axis=1)
        picked = []
        for _ in range(min(count - 1, len(rows))):
            picked.append(int(near.argmax()))
            gap = np.linalg.norm(rows - rows[picked[-1]], axis=1)
            near = gap if len(picked) == 1 else np.minimum(near, gap)
            if near.max() == 0:
                break
        out[dim] = rows[picked]
    return out


def _packer(pivots: dict[int, np.ndarray], size: int):
    """Tables of whole vectors to blocks with their distances to the pivots.

    Huge vectors have no distances, and their components travel as they came, in doubles.
    """

    def packed(dim: int, huge: bool, ids: list[int], rows: list[list[float]]) -> tuple:
        ids, matrix = np.array(ids, np.int64), np.array(rows, np.float64).reshape(len(rows), dim)
        if huge:
            return int(ids[0]), dim, huge, np.inf, ids.tobytes(), matrix.tobytes(), b""
        # The origin is the first pivot, so the first distance is the length.
        points = np.vstack([np.zeros((1, dim)), pivots.get(dim, np.zeros((0, dim)))])
        distances = np.empty((len(points), len(rows)))
        for i, point in enumerate(points):
            distances[i] = np.linalg.norm(matrix - point, axis=1)
        return int(ids[0]), dim, huge, distances[0].max(), ids.tobytes(), matrix.astype(np.int32).tobytes(), distances.tobytes()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[tuple[int, bool], tuple[list, list]] = {}

        def out(kinds):
            columns = list(zip(*[packed(*kind, *waiting.pop(kind)) for kind in kinds])) or [[]] * len(names)
            types = [pa.int64(), pa.int32(), pa.bool_(), pa.float64(), *[pa.binary()] * 3]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        names = [field.split()[0] for field in BLOCK.split(", ")]
        for batch in batches:
            for key, vector, huge in zip(*(batch.column(c).to_pylist() for c in ("id", "v", "huge"))):
                kind = (len(vector), huge)
                ids, rows = waiting.setdefault(kind, ([], []))
                ids.append(key)
                rows.append(vector)
                if len(ids) == size:
                    yield out([kind])
        yield out(list(waiting))

    return pack


def best_of_block(query, own, lengths_q, ids, matrix, distances, k, floor):
    """Up to ``k`` best scores and ids of one query in a block, and how many were evaluated.

    ``floor`` is a score to reach; ``distances`` and ``lengths_q`` start with the vectors' own
    lengths.
    """
    low = np.abs(distances - lengths_q[:, None]).max(axis=0)
    bound = upper(distances[0], lengths_q[0], low)
    bound[ids == own] = -np.inf
    order = np.argsort(-bound, kind="stable")
    order = order[: int(np.searchsorted(-bound[order], np.inf))]
    best_scores, best_ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
    evaluated = 0
    for at in range(0, len(order), STEP):
        worst = max(floor, best_scores[-1] if len(best_scores) == k else floor)
        if bound[order[at]] < worst:
            break
        some = order[at : at + STEP]
        evaluated += len(some)
        scores = np.concatenate([best_scores, matrix[some] @ query])
        found = np.concatenate([best_ids, ids[some]])
        top = np.lexsort((found, -scores))[:k]
        best_scores, best_ids = scores[top], found[top]
    return best_scores, best_ids, evaluated


def upper(length, length_q, low):
    """The most that the inner product of vectors of these lengths, at least ``low`` apart, can be."""
    squares = length**2 + length_q**2
    return (squares - low**2) / 2 + 1e-9 * squares + 1e-6


def most_of_block(near, distances):
    """An upper bound of every query's scores in a block, from the ranges of its distances."""
    least, most = distances.min(axis=1)[:, None], distances.max(axis=1)[:, None]
    low = np.maximum(np.maximum(least - near, near - most), 0).max(axis=0)
    return upper(most[0], near[0], low)


def _exact(queries: np.ndarray, owns: np.ndarray, matrix: np.ndarray, ids: np.ndarray, k: int):
    """The best of every query in a block, in whole numbers of any size."""
    whole = [[int(x) for x in row] for row in matrix]
    for query, own in zip(queries, owns):
        wanted = [int(x) for x in query]
        scored = ((-sum(a * b for a, b in zip(wanted, row)), key) for row, key in zip(whole, ids.tolist()) if key != own)
        best = heapq.nsmallest(k, scored)
        if any(not -(1 << 63) <= -score < 1 << 63 for score, _ in best):
            raise OverflowError(f"a score of vector {own} does not fit 64 bits")
        yield np.full(len(best), own), np.array([key for _, key in best], np.int64), np.array([-s for s, _ in best], np.int64)


def _search(k: int):
    """Pairs of a block of queries and a block of candidates to the best of each query."""

    def vectors(data: bytes, huge: bool, dim: int, count: int) -> np.ndarray:
        kind = np.float64 if huge else np.int32
        return np.frombuffer(data, kind).reshape(count, dim).astype(np.float64 if huge else np.int64)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, floors = None, None
        for batch in batches:
            for nr in range(batch.num_rows):
                row = {name: batch.column(name)[nr].as_py() for name in batch.schema.names}
                dim, either = row["dim"], row["huge"] or row["q_huge"]
                owns, ids = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["ids"], np.int64)
                queries = vectors(row["q_vectors"], row["q_huge"], dim, len(owns))
                matrix = vectors(row["vectors"], row["huge"], dim, len(ids))
                if either:
                    out = list(_exact(queries, owns, matrix, ids, k))
                else:
                    near = np.frombuffer(row["q_distances"]).reshape(-1, len(owns))
                    distances = np.frombuffer(row["distances"]).reshape(-1, len(ids))
                    if row["q_ids"] != block:
                        block, floors = row["q_ids"], np.full(len(owns), np.iinfo(np.int64).min)
                    out = [(np.zeros(0, np.int64),) * 3]
                    for i in np.flatnonzero(most_of_block(near, distances) >= floors):
                        scores, found, _ = best_of_block(queries[i], owns[i], near[:, i], ids, matrix, distances, k, floors[i])
                        if len(scores) == k:
                            floors[i] = max(floors[i], scores[-1])
                        out.append((np.full(len(found), owns[i]), found, scores))
                columns = [np.concatenate(x) for x in zip(*out)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"]
                )

    return search


def top_k(
    candidates: DataFrame,
    queries: DataFrame,
    k: int,
    id_column: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best candidates of every query.

    Scores are inner products of ``floor(scale * x)``, as longs; ties go to the smaller id. A
    query's own id is no candidate of it.

    * Rows with a null id, and vectors that are null or hold null or non-finite components,
      take no part. A component may be of any size; a score among the best that does not fit a
      long is an error. Empty vectors score 0 with each other.
    * Vectors of another dimension than the query are no candidates.
    * A query id that repeats is one query, with the smallest of its vectors; repeated
      candidate rows count each. Other columns are not read. Empty tables give no rows.
    """
    spark = candidates.sparkSession
    rows = whole_numbers(candidates, id_column, vector, scale)
    asked = (
        whole_numbers(queries, id_column, vector, scale)
        .groupBy("id")
        .agg(F.min(F.struct("v", "huge")).alias("least"))
        .select("id", "least.*")
    )
    pivots, slices = choose_pivots(rows), partitions(spark)
    blocks = rows.mapInArrow(_packer(pivots, CANDIDATES), BLOCK).withColumn(
        "slice", F.pmod(F.xxhash64("ids"), F.lit(slices)).cast("int")
    )
    query_blocks = asked.mapInArrow(_packer(pivots, QUERIES), BLOCK).select(
        "dim",
        *[F.col(c).alias(f"q_{c}") for c in ("huge", "ids", "vectors", "distances")],
        F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"),
    )
    # The merge join goes through all candidate blocks of a slice for one query block, and in
    # this order, so the scores to reach rise early and hold for the rest.
    ordered = blocks.repartition(slices, "slice", "dim").sortWithinPartitions("slice", "dim", F.desc("longest"), "block")
    found = (
        query_blocks.hint("merge")
        .join(ordered, ["slice", "dim"])
        .select("dim", "huge", "ids", "vectors", "distances", "q_huge", "q_ids", "q_vectors", "q_distances")
        .mapInArrow(_search(k), "query_id long, vec_id long, score long")
    )
    place = F.row_number().over(
        W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    )
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )


def op9_topk_search(spark, sf_dir):
    """The five best of all ``embeddings`` for every fiftieth vector."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(rows, rows.filter("vec_id % 50 = 0"), 5)


ORACLE = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0),
placed AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::integer AS rank,
    vec_id, score
  FROM scored)
SELECT * FROM placed WHERE rank <= 5
"""
