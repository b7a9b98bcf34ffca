"""A prefix trie of conversations, from chained digests of their openings.

Every turn gets the digest of all turns up to it. The chain runs inside blocks of 16 turns, then over the last
digests of the blocks, again in blocks, so that no task holds more than 16 turns
of a conversation whatever its length. Every prefix of every conversation is then a row;
grouped by (depth, digest) the rows are the nodes. For sums over subtrees each node is exploded to its
ancestors inside its block of depths; the sums of the blocks' first nodes form a trie of their own, 16 times as
shallow, that is treated alike, and come back to the 16 nodes above each. So a conversation of n turns makes about 16 n
rows, not n * n.

The members that end at a node may be many; their ids are sorted by a range partitioning, joined into
pieces, and the pieces of a node stream through one hash.

Defined results: rows without conv_id belong to no conversation; null roles and texts are
empty; turns are ordered by their number, null first, equal ones by the digest of role and text, so repeated
rows are turns of their own; a conversation with null numbers only is ordered by digests; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import discard, global_rank, materialise
from quire.llm.merkle_manifest import CRC32_SQL

#: Turns, blocks or depths that are worked through together.
BLOCK = 16
#: Ids that one piece of a node's list holds at most.
PIECE = 20_000


def _digest(col: Column) -> Column:
    return F.unhex(F.sha2(col, 256))


def ordered(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, k, item, size): the turns of each conversation from k = 1, as digests of role and text, with the text's bytes."""
    named = lambda c: F.col(f"`{c}`")
    own = conversations.select(named(conv_id).cast("long").alias("conv_id"), named(turn).alias("turn"), F.coalesce(named(role), F.lit("")).alias("r"), F.coalesce(named(text), F.lit("")).alias("t")).where("conv_id is not null")
    item = _digest(F.concat(F.octet_length("r").cast("string"), F.lit(":"), F.col("r"), F.col("t")))
    turns = materialise(own.select("conv_id", "turn", item.alias("item"), F.octet_length("t").cast("long").alias("size")), "turns", "snappy")
    # Ranked over all rows and not in a window for each conversation, as one may hold a large part of them.
    ranked = materialise(global_rank(turns, F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("item")), "ranked", "snappy")
    discard(turns)
    first = ranked.groupBy("conv_id").agg(F.min("rank").alias("first"))
    return ranked.join(first, "conv_id").select("conv_id", (F.col("rank") - F.col("first") + 1).alias("k"), "item", "size")


def share_openings(turns: DataFrame, every: int = 5, most: int = 9) -> DataFrame:
    """(conv_id, depth, item, size), depth 0 being empty: each conversation with its first h turns taken from the one whose id is the next lower multiple of ``every``.

    h is the CRC-32 of the id modulo ``most``. What the other one lacks is not made up for. Remainders take the sign of the id.
    """
    sizes = turns.groupBy("conv_id").agg(F.max("k").alias("n"))
    own = sizes.select("conv_id", (F.col("conv_id") - F.col("conv_id") % every).alias("base"), (F.crc32(F.col("conv_id").cast("string")) % most).alias("h"))
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    plan = own.join(bases, "base", "left").select("conv_id", "base", "h", F.least("h", F.coalesce("n_base", F.lit(0))).alias("taken"))
    plan = materialise(plan, "openings", "snappy")
    rest = turns.join(plan.select("conv_id", "h", "taken"), "conv_id").where("k > h").select("conv_id", (F.col("k") - F.col("h") + F.col("taken")).alias("depth"), "item", "size")
    head = turns.where(F.col("k") < most).withColumnRenamed("conv_id", "base").join(plan.where("taken > 0"), "base").where("k <= h").select("conv_id", F.col("k").alias("depth"), "item", "size")
    root = plan.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit("").cast("binary").alias("item"), F.lit(0).cast("long").alias("size"))
    return root.unionByName(head).unionByName(rest)


def chains(items: DataFrame) -> DataFrame:
    """(conv_id, block, digests, sizes) from (conv_id, depth, item, size), depth running from 0 without gaps: the digest of everything up to each place."""
    rows = items.groupBy("conv_id", F.floor(F.col("depth") / BLOCK).alias("block")).agg(F.array_sort(F.collect_list(F.struct("depth", "item", "size"))).alias("rows"))
    last = lambda a: F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit("").cast("binary"))
    own = F.aggregate("rows", F.array().cast("array<binary>"), lambda a, x: F.concat(a, F.array(_digest(F.concat(last(a), x["item"])))))
    blocks = materialise(rows.select("conv_id", "block", own.alias("own"), F.col("rows.size").alias("sizes")), "blocks", "snappy")
    before = F.lit("").cast("binary")
    if blocks.where("block > 0").limit(1).count():
        ends = blocks.join(blocks.where("block = 1").select("conv_id"), "conv_id", "left_semi").select("conv_id", F.col("block").alias("depth"), F.element_at("own", -1).alias("item"), F.lit(0).cast("long").alias("size"))
        upper = chains(ends).select("conv_id", "block", F.posexplode("digests").alias("pos", "before"))
        upper = upper.select("conv_id", (F.col("block") * BLOCK + F.col("pos") + 1).alias("block"), "before")
        blocks, before = blocks.join(upper, ["conv_id", "block"], "left"), F.coalesce("before", before)
    return materialise(blocks.select("conv_id", "block", F.transform("own", lambda e: _digest(F.concat(before, e))).alias("digests"), "sizes"), "chains", "snappy")


def _prefixes(chain: DataFrame) -> DataFrame:
    """(conv_id, depth, digest, size, above, ends): every prefix of every conversation, with its parent's digest and whether the conversation ends there."""
    later = chain.where("block > 0")
    more = later.select("conv_id", (F.col("block") - 1).alias("block"), F.lit(True).alias("more"))
    before = chain.select("conv_id", (F.col("block") + 1).alias("block"), F.element_at("digests", -1).alias("before"))
    before = before.join(later.select("conv_id", "block"), ["conv_id", "block"], "left_semi")
    full = chain.join(more, ["conv_id", "block"], "left").join(before, ["conv_id", "block"], "left")
    each = F.transform(F.arrays_zip("digests", "sizes"), lambda x, i: F.struct((F.col("block") * BLOCK + i).alias("depth"), x["digests"].alias("digest"), x["sizes"].alias("size"), F.when(i > 0, F.get("digests", i - 1)).otherwise(F.col("before")).alias("above"), (F.col("more").isNull() & (i == F.size("digests") - 1)).alias("ends")))
    return full.select("conv_id", F.explode(each).alias("x")).select("conv_id", "x.*")


def _sums(nodes: DataFrame, chain: DataFrame) -> DataFrame:
    """(depth, digest, conv_id, leaves, saved): the sums of ``leaves`` and ``saved`` over each node's subtree.

    conv_id is a member of the node, by which ``chain`` tells its ancestors; the smallest one comes back.
    """
    total = [F.min("conv_id").alias("conv_id"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]
    near = nodes.withColumn("block", F.floor(F.col("depth") / BLOCK)).join(chain.select("conv_id", "block", "digests"), ["conv_id", "block"])
    near = near.select("conv_id", "leaves", "saved", "block", F.posexplode(F.slice("digests", F.lit(1), (F.col("depth") % BLOCK + 1).cast("int"))).alias("pos", "digest"))
    near = near.groupBy((F.col("block") * BLOCK + F.col("pos")).alias("depth"), "digest").agg(*total)
    if not nodes.where(F.col("depth") >= BLOCK).limit(1).count():
        return near
    near = materialise(near, "near", "snappy")
    long = chain.join(chain.where("block = 1").select("conv_id"), "conv_id", "left_semi")
    tops = near.where(F.col("depth") % BLOCK == 0).withColumn("depth", F.floor(F.col("depth") / BLOCK))
    upper = long.groupBy("conv_id", F.floor(F.col("block") / BLOCK).alias("upper")).agg(F.array_sort(F.collect_list(F.struct("block", F.col("digests")[0].alias("digest")))).alias("rows"))
    upper = materialise(upper.select("conv_id", F.col("upper").alias("block"), F.col("rows.digest").alias("digests")), "upper", "snappy")
    whole = _sums(tops, upper).where("depth > 0").withColumn("block", F.col("depth") - 1).drop("digest", "depth")
    far = whole.join(long.select("conv_id", "block", "digests"), ["conv_id", "block"])
    far = far.select("conv_id", "leaves", "saved", "block", F.posexplode("digests").alias("pos", "digest"))
    far = far.select((F.col("block") * BLOCK + F.col("pos")).alias("depth"), "digest", "conv_id", "leaves", "saved")
    return near.unionByName(far).groupBy("depth", "digest").agg(*total)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[bytes, int, int]]:
    """(digest, from, to) of neighbouring rows with equal digests."""
    digests = batch.column("digest").to_pylist()
    start = 0
    for k in range(1, len(digests) + 1):
        if k == len(digests) or digests[k] != digests[start]:
            yield digests[start], start, k
            start = k


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (digest, conv_id) to (digest, first, ids): the ids in decimal, joined by commas."""
    for batch in batches:
        ids, first = pc.cast(batch.column("conv_id"), pa.string()).to_pylist(), batch.column("conv_id").to_numpy()
        out = [(d, int(first[k]), ",".join(ids[k : min(b, k + PIECE)])) for d, a, b in _runs(batch) for k in range(a, b, PIECE)]
        for at in range(0, len(out), 1000):
            d, f, i = zip(*out[at : at + 1000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(d, pa.binary()), pa.array(f, pa.int64()), pa.array(i, pa.string())], names=["digest", "first", "ids"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (digest, first, ids) to (digest, ends_sha256), piece by piece."""
    last, state, out = None, None, []
    for batch in batches:
        for digest, ids in zip(batch.column("digest").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if digest == last:
                state.update(b"," + ids.encode())
                continue
            if state:
                out.append((last, state.hexdigest()))
            last, state = digest, sha256(ids.encode())
        if len(out) > 1000:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=["digest", "ends_sha256"])
            out = []
    if state:
        out.append((last, state.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=["digest", "ends_sha256"])


def end_lists(ends: DataFrame) -> DataFrame:
    """(digest, ends_sha256) of the ascending conv_ids of each digest in (digest, conv_id)."""
    n = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = ends.repartitionByRange(n, "digest", "conv_id").sortWithinPartitions("digest", "conv_id")
    pieces = dealt.mapInArrow(_pieces, "digest binary, first long, ids string")
    return pieces.repartition(n, "digest").sortWithinPartitions("digest", "first").mapInArrow(_hashed, "digest binary, ends_sha256 string")


def prefix_trie(items: DataFrame) -> DataFrame:
    """The nodes of the trie of (conv_id, depth, item, size) rows, where depth 0 is the empty prefix of each conversation.

    Returns conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (over the subtree,
    sizes that members beyond the first need not be read again) and ends_sha256.
    """
    chain = chains(items)
    prefixes = _prefixes(chain)
    nodes = prefixes.groupBy("depth", "digest").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("size").alias("size"), F.max("above").alias("above"))
    nodes = materialise(nodes, "nodes", "snappy")
    kids = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("above").alias("digest")).agg(F.count("*").alias("n_children"))
    nodes = materialise(nodes.join(kids, ["depth", "digest"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "nodes", "snappy")
    weighed = nodes.select("depth", "digest", "conv_id", (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved"))
    sums = _sums(weighed, chain).select("depth", "digest", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    # A digest tells its depth as well.
    lists = end_lists(materialise(prefixes.where("ends").select("digest", "conv_id"), "ends", "snappy"))
    whole = materialise(nodes.join(sums, ["depth", "digest"]).join(lists, "digest", "left"), "whole", "snappy")
    # A node with very many children: Spark may split their partition, as nothing else needs them together.
    parents = whole.select((F.col("depth") + 1).alias("depth"), F.col("digest").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    out = whole.join(parents, ["depth", "above"], "left")
    empty = F.lit(sha256(b"").hexdigest())
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", empty).alias("ends_sha256"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(share_openings(ordered(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))


OP12_SQL = f"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id),
c AS (SELECT n.conv_id, n.conv_id - n.conv_id % 5 AS base, {CRC32_SQL.format("n.conv_id::VARCHAR")} % 9 AS h FROM n),
p AS (SELECT c.*, least(h, coalesce(n.n, 0)) AS taken FROM c LEFT JOIN n ON n.conv_id = c.base),
s AS (SELECT p.conv_id, k AS depth, role, text FROM p JOIN t ON t.conv_id = p.base AND k <= h
  UNION ALL SELECT p.conv_id, k - h + taken, role, text FROM p JOIN t ON t.conv_id = p.conv_id AND k > h),
x AS (SELECT conv_id, depth, strlen(text) AS size, string_agg(sha256(strlen(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM s
  UNION ALL SELECT conv_id, 0, 0, '' FROM n),
l AS (SELECT conv_id, max(depth) AS last FROM x GROUP BY conv_id),
g AS (SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) AS size,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = last), '')) AS ends_sha256
  FROM x JOIN l USING (conv_id) GROUP BY depth, path),
k AS (SELECT depth - 1 AS depth, path[:-65] AS path, count(*) AS n_children FROM g WHERE depth > 0 GROUP BY ALL),
w AS (SELECT g.*, coalesce(n_children, 0) AS n_children FROM g LEFT JOIN k USING (depth, path)),
a AS (SELECT x.depth, x.path, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves, sum((n_convs - 1) * w.size)::BIGINT AS saved_tokens
  FROM w JOIN x ON x.conv_id = w.conv_id AND x.depth <= w.depth GROUP BY ALL)
SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens, w.ends_sha256
FROM w JOIN a USING (depth, path) LEFT JOIN w p ON p.depth = w.depth - 1 AND p.path = w.path[:-65]
"""
