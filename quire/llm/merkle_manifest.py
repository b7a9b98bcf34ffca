"""A Merkle manifest of a table, with an authentication path for every row.

Rows are leaves of 16-way trees, one for each source, whose roots are the leaves of one
more tree. Spark hashes the rows, ranks them inside their sources by a range partitioning, and
deals them in aligned blocks of 4096 leaves. A task reads a block's digests in order and goes
through it by fractal traversal: for each level it keeps the run of 16 nodes that the current
path passes (existing) and grows the next one from the leaves ahead (desired), so that the path of each leaf
is at hand in turn. What lies above the blocks is built from their roots by
grouping, level by level; its proofs go down the same levels, each node handing its own to its
16 children, and reach a task as one row for each block. So no key is larger than 16 nodes or one block,
siblings are never shuffled for each row, and a task holds one block whatever the table's size.

Defined results: a null value is written ``-`` and is another one than an empty text; null
doc_ids come first, and rows that share a doc_id follow each other by their leaves; repeated rows
are leaves of their own; null sources are one source, the first; one lone leaf is its own
root; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import ascii_lower, discard, global_rank, materialise

#: Children of a node, levels of a block, and its leaves. A digest is 64 hexadecimal letters.
WAYS = 16
LEVELS = 3
BLOCK = WAYS**LEVELS
HEX = 64
RUN = WAYS * HEX
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _hash(data: bytes) -> bytes:
    return sha256(data).hexdigest().encode()


def height(n: int) -> int:
    """Levels above ``n`` leaves."""
    h = 0
    while n > 1:
        n, h = -(-n // WAYS), h + 1
    return h


class Growing:
    """A run of up to 16 nodes of one level, grown from runs of leaves as they come. Holds 16 digests for each level below."""

    def __init__(self, level: int):
        self.parts = [b""] * level

    def add(self, run: bytes) -> None:
        for k, part in enumerate(self.parts):
            self.parts[k] = part = part + _hash(run)
            if len(part) < RUN or k + 1 == len(self.parts):
                return
            self.parts[k], run = b"", part

    def nodes(self) -> bytes:
        """The nodes, once all leaves below them have come."""
        for k in range(len(self.parts) - 1):
            if self.parts[k]:
                self.parts[k + 1] += _hash(self.parts[k])
                self.parts[k] = b""
        return self.parts[-1]


class Traversal:
    """Authentication paths of one block's runs of leaves, in order.

    ``existing[i]`` is the run of level ``i`` that the current path passes and ``desired[i]`` the next one, which takes in
    a run of leaves at each step; when the path leaves the first, the second takes its place.
    """

    def __init__(self, leaves: bytes, levels: int):
        self.leaves, self.levels = leaves, levels
        self.existing: list[bytes] = []
        self.desired: list[Growing | None] = []
        self.ahead: list[int] = []
        for i in range(1, levels):
            first = Growing(i)
            for k in range(WAYS**i):
                self._grow(first, k)
            self.existing.append(first.nodes())
            self.desired.append(Growing(i))
            self.ahead.append(WAYS**i)

    def _grow(self, nodes: Growing, run: int) -> None:
        some = self.leaves[run * RUN : (run + 1) * RUN]
        if some:
            nodes.add(some)

    def root(self) -> bytes:
        """The root of a block that is one run of its highest level."""
        return _hash(self.existing[-1] if self.existing else self.leaves) if self.levels else self.leaves

    def paths(self) -> Iterator[tuple[bytes, list[tuple[bytes, bytes]]]]:
        """Each run of leaves, with the nodes to the left and right of its path on the levels above it."""
        for run in range(-(-len(self.leaves) // RUN)):
            if run:
                for i in range(1, self.levels):
                    if run % WAYS**i == 0:
                        self.existing[i - 1], self.desired[i - 1], self.ahead[i - 1] = self.desired[i - 1].nodes(), Growing(i), run + WAYS**i
            sides = []
            for i in range(1, self.levels):
                own, at = self.existing[i - 1], run // WAYS ** (i - 1) % WAYS * HEX
                sides.append((own[:at], own[at + HEX :]))
            yield self.leaves[run * RUN : (run + 1) * RUN], sides
            for i in range(1, self.levels):
                self._grow(self.desired[i - 1], self.ahead[i - 1])
                self.ahead[i - 1] += 1


def _field(col: Column) -> Column:
    text = col.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*fields: Column) -> Column:
    """A row's digest: every value by its length in bytes, a null as ``-``."""
    return F.sha2(F.concat(*map(_field, fields)), 256)


def _hexes(col: pa.Array) -> bytes:
    """An array of digests, which stand one after the other in its buffer, as one string."""
    if not len(col):
        return b""
    ends = np.frombuffer(col.buffers()[1], np.int64 if pa.types.is_large_string(col.type) else np.int32)
    return memoryview(col.buffers()[2])[ends[col.offset] : ends[col.offset + len(col)]].tobytes()


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (tree, block), which follow each other."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        tree, block = (batch.column(c).to_numpy() for c in ("tree", "block"))
        cuts = np.flatnonzero((tree[1:] != tree[:-1]) | (block[1:] != block[:-1])) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            key = tree[a], block[a]
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _block_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _groups(batches):
        n = rows["n"][0].as_py()
        root = Traversal(b"".join(map(_hexes, rows["leaf"].chunks)), min(LEVELS, height(n))).root().decode()
        yield pa.RecordBatch.from_pydict({"tree": [rows["tree"][0].as_py()], "at": [rows["block"][0].as_py()], "n": [-(-n // BLOCK)], "digest": [root]})


def climb(nodes: DataFrame) -> list[DataFrame]:
    """Level by level, the nodes above (tree, at, n, digest), where n is the number of the tree's nodes; ``kids`` are a node's children."""
    levels = [nodes.withColumn("kids", F.lit(None).cast("array<string>"))]
    while (below := levels[-1].where("n > 1")).limit(1).count():
        up = below.groupBy("tree", F.floor(F.col("at") / WAYS).alias("up")).agg(F.array_sort(F.collect_list(F.struct("at", "digest"))).alias("kids"), F.max("n").alias("n"))
        up = up.select("tree", F.col("up").alias("at"), F.ceil(F.col("n") / WAYS).alias("n"), F.col("kids.digest").alias("kids"))
        levels.append(materialise(up.select("tree", "at", "n", F.sha2(F.array_join("kids", ""), 256).alias("digest"), "kids"), "level", "snappy"))
    return levels


def proofs(levels: list[DataFrame], given: DataFrame) -> DataFrame:
    """(tree, at, proof, ...) of the nodes of the lowest level: what lies left and right of the path up to the tree's root, then ``given``'s proof of that root."""
    out = None
    more = [c for c in given.columns if c not in ("tree", "proof")]
    for k in range(len(levels) - 1, -1, -1):
        top = levels[k].where("n = 1").select("tree", "at").join(given, "tree").select("tree", "at", "proof", *more)
        out = top if out is None else out.unionByName(top)
        if k:
            down = out.join(levels[k].select("tree", "at", "kids"), ["tree", "at"]).select("*", F.posexplode("kids").alias("pos", "kid"))
            side = lambda a, n: F.array_join(F.slice("kids", a, n), "")
            own = F.struct(side(F.lit(1), F.col("pos")).alias("left"), side(F.col("pos") + 2, F.lit(WAYS)).alias("right"))
            out = down.select("tree", (F.col("at") * WAYS + F.col("pos")).alias("at"), F.concat(F.array(own), "proof").alias("proof"), *more)
    return out


def _traverse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of a block brings its upper proof; its leaves follow."""
    for rows in _groups(batches):
        head, rows = rows.slice(0, 1).to_pylist()[0], rows.slice(1)
        levels = min(LEVELS, height(rows["n"][0].as_py()))
        upper = [(p["left"].encode(), p["right"].encode()) for p in head["proof"]]
        seen, proof, folded = rows["seen"].to_pylist(), [], []
        root = head["root"].encode()
        leaves = b"".join(map(_hexes, rows["leaf"].chunks))
        if not levels:
            proof = [_hash(b"".join(a + b for a, b in upper)).decode()]
            folded = [_fold((seen[0] or leaves.decode()).encode(), upper)]
        else:
            for run, sides in Traversal(leaves, levels).paths():
                above = sides + upper
                tail, known = b"".join(a + b for a, b in above), {}
                for at in range(0, len(run), HEX):
                    left, right = run[:at], run[at + HEX :]
                    proof.append(_hash(left + right + tail).decode())
                    other = seen[len(folded)]
                    node = _hash(left + (other.encode() if other else run[at : at + HEX]) + right)
                    if node not in known:
                        known[node] = _fold(node, above)
                    folded.append(known[node])
        columns = {
            "doc_id": rows["doc_id"].combine_chunks(), "leaf": rows["leaf"].combine_chunks(), "subroot": pa.repeat(head["subroot"], rows.num_rows), "root": pa.repeat(head["root"], rows.num_rows),
            "proof_sha256": pa.array(proof), "folded_root": pa.array([f.decode() for f in folded]), "verified": pa.array([f == root for f in folded]),
        }
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _fold(node: bytes, sides: list[tuple[bytes, bytes]]) -> bytes:
    for left, right in sides:
        node = _hash(left + node + right)
    return node


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, source: str = "source", doc_id: str = "doc_id", presented: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    ``presented`` is the digest with which a row claims to be in the table, null for the right one; ``verified`` tells whether the
    row's path leads from it to the root.
    """
    spark = docs.sparkSession
    named = lambda c: F.col(f"`{c}`")
    own = docs.select(named(source).cast("string").alias("source"), named(doc_id).alias("doc_id"), leaf(*map(named, fields)).alias("leaf"), (F.lit(None).cast("string") if presented is None else presented).alias("seen"))
    kind = own.schema["doc_id"].dataType.simpleString()
    leaves = materialise(own, "leaves", "snappy")
    ranked = materialise(global_rank(leaves, F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf")), "ranked", "snappy")
    discard(leaves)
    sources = global_rank(ranked.groupBy("source").agg(F.min("rank").alias("first"), F.count("*").alias("n")), F.col("first"), name="tree")
    sources = materialise(sources.withColumn("tree", F.col("tree") - 1), "sources", "snappy")
    at = F.col("rank") - F.col("first")
    # A source with many rows: only its number is joined, and Spark may split its partition.
    rows = ranked.join(sources.withColumnRenamed("source", "other"), F.col("source").eqNullSafe(F.col("other"))).select("tree", F.floor(at / BLOCK).alias("block"), at.alias("at"), "n", "doc_id", "leaf", "seen")
    rows = materialise(rows, "rows", "snappy")
    discard(ranked)
    dealt = rows.select("tree", "block", "at", "n", "leaf").repartition("tree", "block").sortWithinPartitions("tree", "block", "at")
    roots = materialise(dealt.mapInArrow(_block_roots, "tree long, at long, n long, digest string"), "roots", "snappy")

    levels = climb(roots)
    subroots = None
    for level in levels:
        tops = level.where("n = 1").select("tree", "digest")
        subroots = tops if subroots is None else subroots.unionAll(tops)
    subroots = materialise(subroots, "subroots", "snappy")
    n = subroots.count()
    over = climb(subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("at"), F.lit(n).cast("long").alias("n"), "digest"))
    root = over[-1].where("n = 1").select("digest").first()
    none = F.array().cast("array<struct<left:string,right:string>>")
    top = spark.range(1).select(F.lit(0).cast("long").alias("tree"), none.alias("proof"))
    given = proofs(over, top).select(F.col("at").alias("tree"), "proof").join(subroots.withColumnRenamed("digest", "subroot"), "tree")
    upper = proofs(levels, materialise(given, "given", "snappy")).withColumn("root", F.lit(root.digest if root else None).cast("string"))

    heads = upper.select("tree", F.col("at").alias("block"), F.lit(-1).cast("long").alias("at"), "proof", "subroot", "root")
    both = rows.unionByName(heads, allowMissingColumns=True).repartition("tree", "block").sortWithinPartitions("tree", "block", "at")
    schema = f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return both.mapInArrow(_traverse, schema)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, leaf(*[F.col(f) if f != "text" else ascii_lower(F.col(f)) for f in FIELDS]))
    return manifest(docs, presented=changed)


#: CRC-32 of a text of ASCII signs, for DuckDB.
CRC32_SQL = """xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({0}, ''), lambda x: ascii(x)::BIGINT)),
 lambda c, b: list_reduce(list_concat([xor(c, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)))"""


def _level_sql(name: str, below: str, tree: str) -> str:
    """One level up, for every row: its node, its node as folded, the siblings so far."""
    kids = "array_to_string(kids[1:pos % 16], '')", "array_to_string(kids[pos % 16 + 2:], '')"
    return f""", {name}_r AS (SELECT {tree} AS tree, pos // 16 AS up, list(node ORDER BY pos) AS kids FROM (SELECT DISTINCT {tree}, pos, node FROM {below}) GROUP BY ALL),
{name} AS (SELECT b.* EXCLUDE (pos, n, node, folded, sibs), pos // 16 AS pos, (n + 15) // 16 AS n,
  CASE WHEN n > 1 THEN sha256(array_to_string(kids, '')) ELSE node END AS node,
  CASE WHEN n > 1 THEN sha256({kids[0]} || folded || {kids[1]}) ELSE folded END AS folded,
  CASE WHEN n > 1 THEN sibs || {kids[0]} || {kids[1]} ELSE sibs END AS sibs
  FROM {below} b JOIN {name}_r r ON b.{tree} IS NOT DISTINCT FROM r.tree AND b.pos // 16 = r.up)"""


def _sql(depth: int = 6, over: int = 4) -> str:
    """For up to 16 ** depth rows of a source and 16 ** over sources."""
    value = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    low = f"translate(text, '{(up := 'ABCDEFGHIJKLMNOPQRSTUVWXYZ')}', '{up.lower()}')"
    row = " || ".join(map(value, FIELDS))
    out = f"""WITH d AS (SELECT *, sha256({row}) AS leaf, {CRC32_SQL.format("doc_id::VARCHAR")} % 5 = 0 AS bad,
  sha256({" || ".join(map(value, FIELDS[:-1]))} || {value(low)}) AS other FROM documents),
s0 AS (SELECT source, doc_id, leaf, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n,
  leaf AS node, CASE WHEN bad THEN other ELSE leaf END AS folded, '' AS sibs FROM d)"""
    for k in range(depth):
        out += _level_sql(f"s{k + 1}", f"s{k}", "source")
    out += f""",
t0 AS (SELECT doc_id, leaf, node AS subroot, 0 AS one, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, (SELECT count(*) FROM (SELECT DISTINCT source FROM d)) AS n, node, folded, sibs FROM s{depth})"""
    for k in range(over):
        out += _level_sql(f"t{k + 1}", f"t{k}", "one")
    return out + f"\nSELECT doc_id, leaf, subroot, node AS root, sha256(sibs) AS proof_sha256, folded AS folded_root, folded = node AS verified FROM t{over}"


OP11_SQL = _sql()
