"""Prefix trie of conversations: SQL ROLLUP over columns of turn ids, block by block.

A turn's id is a digest of its role and text. The ids of a conversation stand in positional
columns, ``BLOCK`` of them in a row; a longer conversation goes on in further rows, each keyed
by the node its block starts from. ``GROUP BY block, key, ROLLUP(turn_0, turn_1, ...)`` with
``GROUPING_ID()`` then aggregates every prefix of every conversation in one job, whatever their
lengths. Partial aggregates are taken before the shuffle, so a prefix that most conversations
share sends one row a task.

A node's key is the exclusive or of 128-bit hashes of (position, turn id) along its path. It
needs no walk along the conversation: keys of blocks are sums over the blocks before, and a
node's key follows from its row of the ROLLUP. Sums over subtrees are a second ROLLUP, over
nodes; what lies in further blocks is added by pointer jumping over blocks, in as many rounds
as the logarithm of the longest conversation's blocks.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pulsetide.llm.common import partitions, table, written

#: Turns in a row, and conversation ids in a chunk of text that is hashed at once.
BLOCK, CHUNK = 8, 50_000
KEY = ["depth", "key_a", "key_b"]
NOTHING = hashlib.sha256(b"").hexdigest()


def turn_id(role: str = "role", text: str = "text") -> Column:
    """Digest of role and text (null as empty), with the text's code points behind it."""
    said, who = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (text, role))
    digest = F.sha2(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said), 256)
    return F.concat_ws(":", digest, F.char_length(said).cast("string"))


def code_points(turn: Column) -> Column:
    """Code points of the text of a turn id."""
    return F.substring_index(turn, ":", -1).cast("long")


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, position, turn``: turns of every conversation, counted from 1.

    Order is by ``turn`` (null first), then by turn id. Positions come from counts per task of
    a range partitioning, so a conversation with a third of all turns is not gathered. Rows
    without a conversation id belong to no conversation; other columns are not read.
    """
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("nr"), turn_id().alias("turn")
    )
    order = ["conv_id", F.col("nr").asc_nulls_first(), "turn"]
    dealt = rows.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    # Written once, so that a row keeps its task and its place in it.
    placed = written(
        dealt.select("conv_id", "turn", F.monotonically_increasing_id().alias("place")), "turns"
    ).withColumn("task", F.shiftright("place", 33))
    counts = placed.groupBy("conv_id", "task").agg(F.count("*").alias("n"))
    earlier = W.partitionBy("conv_id").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    before = counts.select(
        "conv_id", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    nth = F.row_number().over(W.partitionBy("conv_id", "task").orderBy("place"))
    return (
        placed.withColumn("nth", nth)
        .join(before, ["conv_id", "task"])
        .select("conv_id", (F.col("before") + F.col("nth")).alias("position"), "turn")
    )


def rebuilt(ordered: DataFrame, group: int = 100, heads: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin as the first of their hundred does; also how long each is.

    Conversation ``c`` gets the first ``h = crc32(c) % heads`` turns of conversation
    ``c - c % group`` (all if it has fewer, none if it is absent) for its own first ``h``.
    Returns ``conv_id, position, turn`` and ``conv_id, n_turns``; a conversation may lose all
    its turns. At most ``group`` conversations share a beginning.
    """

    def head(conv: str) -> Column:
        return F.crc32(F.col(conv).cast("string").cast("binary")) % heads

    sizes = ordered.groupBy("conv_id").agg(F.max("position").alias("own"))
    starts = sizes.select(F.col("conv_id").alias("start"), F.col("own").alias("start_size"))
    sizes = (
        sizes.withColumns({"start": F.col("conv_id") - F.col("conv_id") % group, "h": head("conv_id")})
        .join(starts, "start", "left")
        .withColumn("taken", F.least("h", F.coalesce("start_size", F.lit(0))))
    )
    sizes = written(
        sizes.select("conv_id", "start", "taken", (F.col("taken") + F.greatest(F.lit(0), F.col("own") - F.col("h"))).alias("n_turns")),
        "sizes",
    )
    first = ordered.filter(F.col("position") < heads).withColumnRenamed("conv_id", "start")
    begun = first.join(sizes, "start").filter("position <= taken").select("conv_id", "position", "turn")
    kept = ordered.filter(F.col("position") > head("conv_id")).join(sizes, "conv_id")
    kept = kept.select("conv_id", (F.col("position") - head("conv_id") + F.col("taken")).alias("position"), "turn")
    return begun.union(kept), sizes.select("conv_id", "n_turns")


def names(block: int) -> list[str]:
    """The positional columns."""
    return [f"turn_{i}" for i in range(block)]


def lane(seed: int, position: Column, turn: Column) -> Column:
    """One of the two hashes of a turn at its position (from 0); 0 where there is no turn."""
    return F.when(turn.isNotNull(), F.xxhash64(F.lit(seed), position.cast("long"), turn)).otherwise(F.lit(0).cast("long"))


def folded(seed: int, block: int) -> Column:
    """The hashes of a row's turns in one number."""
    whole = F.lit(0).cast("long")
    for i, name in enumerate(names(block)):
        whole = whole.bitwiseXOR(lane(seed, F.col("block") * block + i, F.col(name)))
    return whole


def block_rows(turns: DataFrame, sizes: DataFrame, block: int) -> DataFrame:
    """``conv_id, n_turns, block, from_a, from_b, turn_0, ...``: a row per block.

    ``from_a, from_b`` is the key of the node before the block's first turn. A conversation
    without turns has one row without turns.
    """
    at = F.col("position") - 1
    rows = turns.select("conv_id", F.floor(at / block).alias("block"), (at % block).alias("slot"), "turn")
    bare = sizes.filter("n_turns = 0").select(
        "conv_id", F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("slot"), F.lit(None).cast("string").alias("turn")
    )
    filled = rows.union(bare).groupBy("conv_id", "block").agg(
        *[F.max(F.when(F.col("slot") == i, F.col("turn"))).alias(name) for i, name in enumerate(names(block))]
    )
    earlier = W.partitionBy("conv_id").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    keyed = filled.withColumns({"own_a": folded(1, block), "own_b": folded(2, block)})
    for part in "ab":
        before = F.coalesce(F.bit_xor(f"own_{part}").over(earlier), F.lit(0).cast("long"))
        keyed = keyed.withColumn(f"from_{part}", before)
    return keyed.join(sizes, "conv_id")


def rolled_up(rows: DataFrame, block: int, measures: str) -> DataFrame:
    """The measures of every prefix of the rows' turns, with its length in its block.

    Groups of a prefix that no row fills are left out, and so is the empty prefix of a further
    block, which is the last node of the block before.
    """
    turns = ", ".join(names(block))
    last = f"element_at(array({turns}), greatest(level, 1))"
    return rows.sparkSession.sql(
        f"""
        SELECT * FROM (
          SELECT block, from_a, from_b, {turns}, {measures},
                 CAST({block} - bit_count(grouping_id()) AS int) AS level
          FROM {{rows}}
          GROUP BY block, from_a, from_b, ROLLUP({turns}))
        WHERE if(level = 0, block = 0, {last} IS NOT NULL)""",
        rows=rows,
    )


def trie(turns: DataFrame, sizes: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row per node of the trie of conversations.

    ``turns`` has ``conv_id, position, turn`` (positions from 1, without gaps; turn ids of
    ``turn_id``) and ``sizes`` every conversation's ``conv_id, n_turns``, turnless ones too.

    Columns: ``depth, key_a, key_b`` (the node), ``parent_a, parent_b`` (its parent's key),
    ``turn`` (id of its last turn), ``conv_id`` (smallest member), ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``, a digest
    of the ids of conversations that end there. The root has no turn and no parent.

    * Equal turns are equal by role and text. Repeated conversations are members of the same
      nodes. Without conversations there are no nodes.
    * Conversations may have any number of turns.
    """
    rows = written(block_rows(turns, sizes, block), "blocks")
    found = rolled_up(
        rows, block, "count(*) AS n_convs, min(conv_id) AS conv_id, max(n_turns) AS longest"
    )
    last = F.element_at(F.array(*names(block)), F.greatest("level", F.lit(1)))
    nodes = written(
        found.withColumn("turn", F.when(F.col("level") > 0, last)).withColumns(
            {
                "depth": F.col("block") * block + F.col("level"),
                "key_a": F.col("from_a").bitwiseXOR(folded(1, block)),
                "key_b": F.col("from_b").bitwiseXOR(folded(2, block)),
            }
        ).withColumns(
            {
                "saved": (F.col("n_convs") - 1) * F.coalesce(code_points(F.col("turn")), F.lit(0)),
                # A node without children is one at which all its members end.
                "leaf": (F.col("longest") == F.col("depth")).cast("long"),
            }
        ),
        "nodes",
    )
    below = below_blocks(nodes, block)
    full = (F.col("level") == block).cast("long")
    nodes_and_below = nodes.join(below, KEY, "left").withColumns(
        {
            "leaves": F.col("leaf") + F.coalesce("leaves_below", F.lit(0)),
            "saved_in_all": F.col("saved") + F.coalesce("saved_below", F.lit(0)),
            "next_children": full * F.coalesce("children_below", F.lit(0)),
        }
    )
    by_level = ", ".join(f"count_if(level = {i + 1}) AS at_{i + 1}" for i in range(block))
    # The members of a node hold those of all nodes below it.
    totals = rolled_up(
        nodes_and_below,
        block,
        "max(n_convs) AS n_convs, min(conv_id) AS conv_id, sum(leaves) AS n_leaves, "
        f"sum(saved_in_all) AS saved_tokens, max(if(level = {block}, next_children, 0)) AS next_children, {by_level}",
    )
    children = F.col("next_children")
    for i in reversed(range(block)):
        children = F.when(F.col("level") == i, F.col(f"at_{i + 1}")).otherwise(children)
    at = F.col("block") * block + F.col("level")
    whole = written(
        totals.withColumn("turn", F.when(F.col("level") > 0, last)).select(
            at.alias("depth"),
            F.col("from_a").bitwiseXOR(folded(1, block)).alias("key_a"),
            F.col("from_b").bitwiseXOR(folded(2, block)).alias("key_b"),
            "turn", "conv_id", "n_convs", children.alias("n_children"), "n_leaves", "saved_tokens",
        ).withColumns(
            {f"parent_{part}": F.when(F.col("depth") > 0, F.col(f"key_{part}").bitwiseXOR(lane(seed, F.col("depth") - 1, F.col("turn")))) for seed, part in enumerate("ab", 1)}
        ),
        "totals",
    )
    parents = whole.select(
        (F.col("depth") + 1).alias("depth"), F.col("key_a").alias("parent_a"), F.col("key_b").alias("parent_b"), F.col("conv_id").alias("parent_conv_id")
    )
    return (
        whole.join(parents, ["depth", "parent_a", "parent_b"], "left")
        .join(ends(last_nodes(rows, block)), KEY, "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))
    )


def below_blocks(nodes: DataFrame, block: int) -> DataFrame:
    """What lies below the last nodes of full blocks: ``leaves_below, saved_below, children_below``.

    Every block that is not the first belongs to the node it starts from. Its sums go to the
    nodes the blocks before it start from by pointer jumping: after round k a node has the sums
    of 2^k blocks, and points as many blocks up.
    """
    blocks = nodes.filter("block > 0").groupBy("block", "from_a", "from_b").agg(
        F.sum("leaf").alias("leaves_below"), F.sum("saved").alias("saved_below"), F.count_if(F.col("level") == 1).alias("children_below")
    )
    owners = nodes.filter(F.col("level") == block).select(*KEY, F.col("block").alias("up_block"), F.col("from_a").alias("up_a"), F.col("from_b").alias("up_b"))
    starts = [(F.col("block") * block).alias("depth"), F.col("from_a").alias("key_a"), F.col("from_b").alias("key_b")]
    sums = blocks.select(*starts, "leaves_below", "saved_below", "children_below").join(owners, KEY)
    up = [F.when(F.col("up_block") > 0, F.col("up_block") * block).alias("up_depth"), "up_a", "up_b"]
    sums = written(sums.select(*KEY, "leaves_below", "saved_below", "children_below", *up), "sums")
    pointer = ["up_depth", "up_a", "up_b"]
    while sums.filter("up_depth IS NOT NULL").limit(1).count():
        sent = sums.filter("up_depth IS NOT NULL").groupBy(*pointer).agg(
            F.sum("leaves_below").alias("more_leaves"), F.sum("saved_below").alias("more_saved")
        )
        sent = sent.withColumnsRenamed(dict(zip(pointer, KEY)))
        further = sums.select(*[F.col(k).alias(p) for k, p in zip(KEY, pointer)], *[F.col(p).alias(f"next_{p}") for p in pointer])
        sums = written(
            sums.join(sent, KEY, "left")
            .join(further, pointer, "left")
            .select(
                *KEY,
                (F.col("leaves_below") + F.coalesce("more_leaves", F.lit(0))).alias("leaves_below"),
                (F.col("saved_below") + F.coalesce("more_saved", F.lit(0))).alias("saved_below"),
                "children_below",
                *[F.col(f"next_{p}").alias(p) for p in pointer],
            ),
            "sums",
        )
    return sums.drop(*pointer)


def last_nodes(rows: DataFrame, block: int) -> DataFrame:
    """``depth, key_a, key_b, conv_id``: the node at which each conversation ends."""
    final = F.greatest(F.lit(0), F.ceil(F.col("n_turns") / block) - 1)
    return rows.filter(F.col("block") == final).select(
        F.col("n_turns").alias("depth"),
        F.col("from_a").bitwiseXOR(F.col("own_a")).alias("key_a"),
        F.col("from_b").bitwiseXOR(F.col("own_b")).alias("key_b"),
        "conv_id",
    )


def ends(members: DataFrame) -> DataFrame:
    """``depth, key_a, key_b, ends_sha256``: SHA-256 of each node's ids, in order, with commas.

    Ids are sorted over all tasks and joined into chunks of text; then each node's chunks pass
    through its digest one by one. A node with a third of all ids is sorted by many tasks, and
    no task holds more than a chunk of it.
    """
    order = [*KEY, "conv_id"]
    dealt = members.repartitionByRange(partitions(members.sparkSession), *order).sortWithinPartitions(*order)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(c).to_numpy() for c in order]
            new = np.append(True, np.any([c[1:] != c[:-1] for c in columns[:3]], axis=0))
            new[::CHUNK] = True
            firsts = np.flatnonzero(new)
            ids = columns[3].astype(str)
            texts = [",".join(x) for x in np.split(ids, firsts[1:])]
            yield pa.RecordBatch.from_arrays([*(pa.array(c[firsts]) for c in columns), pa.array(texts)], [*order, "ids"])

    together = dealt.mapInArrow(chunks, "depth long, key_a long, key_b long, conv_id long, ids string")
    together = together.repartition(*KEY).sortWithinPartitions(*order)

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest, done = None, None, []
        for batch in batches:
            for *key, text in zip(*(batch.column(c).to_pylist() for c in [*KEY, "ids"])):
                if key == node:
                    digest.update(b",")
                else:
                    if node:
                        done.append((*node, digest.hexdigest()))
                    node, digest = key, hashlib.sha256()
                digest.update(text.encode())
            yield finished(done)
            done = []
        if node:
            yield finished([(*node, digest.hexdigest())])

    def finished(done: list[tuple]) -> pa.RecordBatch:
        *key, digest = zip(*done) if done else [[]] * 4
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in key), pa.array(digest, pa.string())], [*KEY, "ends_sha256"])

    return together.mapInArrow(digests, "depth long, key_a long, key_b long, ends_sha256 string")


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all ``conversations``, each begun as the first of its hundred."""
    turns, sizes = rebuilt(ordered_turns(table(spark, sf_dir, "conversations")))
    return trie(turns, sizes).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


ORACLE = """
with recursive ordered as (
  select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first,
           sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, ''))) as p
  from conversations where conv_id is not null),
crc as (
  select c, list_reduce(
    list_prepend(4294967295::bigint, list_transform(range(1, length(c::varchar) + 1), lambda i: ascii(substr(c::varchar, i, 1))::bigint)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda v, k: xor(v >> 1, 3988292384 * (v & 1)))) as crc
  from (select distinct c from ordered)),
sizes as (
  select k.c, k.c - k.c % 100 as s, xor(crc, 4294967295) % 6 as h, least(xor(crc, 4294967295) % 6, coalesce(z.n, 0)) as t
  from crc k left join (select c, max(p) as n from ordered group by c) z on z.c = k.c - k.c % 100),
turns as (
  select z.c, o.p, o.role, o.text from sizes z join ordered o on o.c = z.s and o.p <= z.t
  union all
  select z.c, o.p - z.h + z.t, o.role, o.text from sizes z join ordered o on o.c = z.c and o.p > z.h),
whole as (
  select z.c, coalesce(list({'role': role, 'text': text} order by p) filter (where p is not null), []) as said
  from sizes z left join turns using (c) group by z.c),
steps as (
  select c, said, 0 as depth, ''::varchar as node, ''::varchar as parent, 0::bigint as chars from whole
  union all
  select c, said, depth + 1, sha256(node || octet_length(encode(said[depth + 1].role)) || ':' || said[depth + 1].role || said[depth + 1].text),
         node, length(said[depth + 1].text)
  from steps where depth < len(said)),
nodes as (
  select node, any_value(parent) as parent, any_value(depth) as depth, any_value(chars) as chars, min(c) as conv_id,
         count(*) as n_convs, sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (where len(said) = depth), '')) as ends_sha256
  from steps group by node),
children as (select parent, count(*) as n from nodes where depth > 0 group by parent),
paths as (
  select distinct a.node as top, b.node as node from steps a join steps b on a.c = b.c and b.depth >= a.depth),
sums as (
  select top, count(*) filter (where n is null) as n_leaves, sum((n_convs - 1) * chars) as saved
  from paths join nodes using (node) left join children on children.parent = node group by top)
select n.conv_id, n.depth::bigint as depth, u.conv_id as parent_conv_id, n.n_convs, coalesce(k.n, 0)::bigint as n_children,
       s.n_leaves::bigint as n_leaves, s.saved::bigint as saved_tokens, n.ends_sha256
from nodes n join sums s on s.top = n.node left join children k on k.parent = n.node
left join nodes u on n.depth > 0 and u.node = n.parent"""
