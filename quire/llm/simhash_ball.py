"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at 4 or fewer differing bits share a variant that is at most 2 bits
from each. Every distinct fingerprint therefore emits all its variants within 2
bits, variants are shuffled, and fingerprints that meet in a variant are linked. The
2081 variants of a fingerprint are grouped by their leading bits: what is shuffled is
the fingerprint, once for each group that any variant of it falls in (37 rows for
8 leading bits), and the variants themselves are spelt out where they meet. All who
meet in one variant are within 4 bits of each other, so each is linked to the smallest
of them; the links are checked by counting bits, and no pairs are listed.
The number of leading bits follows the number of fingerprints, so that a group stays
small; a crowded group is worked through in slices of its next bits.

Exact copies have one fingerprint, so copies never multiply the work.

Defined results: null or blank text has fingerprint zero, linked like any other; rows
that share a doc_id each keep their fingerprint; a null doc_id is larger than any
other as a representative; other columns are not read.
"""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import LOWER, UPPER, discard, materialise, release
from quire.llm.graph import components

SHINGLE = 4
SEED = 42
RADIUS = 4
#: Variants that one group holds on average, and that are spelt out at a time at most.
GROUP_VARIANTS = 1 << 21
_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bits that are set in over half of the shingles' hashes."""
    words = text.encode("utf-8", "replace").translate(_FOLD).split() if text else []
    if not words:
        return 0
    sizes = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes).tolist()
    n = max(1, len(words) - shingle + 1)
    joined, digest = b" ".join(words), xxhash.xxh64_digest
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    raw = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=False)])
    ones = np.zeros(64, np.int64)
    bits = np.frombuffer(raw, np.uint8).reshape(n, 8)
    for at in range(0, n, 60_000):
        ones += np.unpackbits(bits[at : at + 60_000], axis=1).sum(0, dtype=np.uint16)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of the text's shingles."""
    words = text.encode("utf-8", "replace").translate(_FOLD).split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    joined, digest = b" ".join(words), xxhash.xxh64_digest
    raw = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, ends[min(shingle, len(words)) - 1 :].tolist(), strict=False)])
    return np.frombuffer(raw, ">u8").astype(np.uint64)


def several(text: str | None, shingle: int, seeds: int) -> list[int]:
    """Fingerprints of the same shingles by independent hashes."""
    h, out = _hashes(text, shingle), []
    for s in range(seeds):
        x = h * np.uint64(0x9E3779B97F4A7C15) + np.uint64(s * 0x632BE59BD9B4E019 % 2**64)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
        ones = np.zeros(64, np.int64)
        for at in range(0, len(x), 60_000):
            ones += np.unpackbits(x[at : at + 60_000].view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.uint16)
        out.append(int.from_bytes(np.packbits(2 * ones > len(x)).tobytes(), "big", signed=True))
    return out


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Columns doc_id, fp (the 64 bits as a signed long), one row for each row of ``docs``."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            fp = np.array([fingerprint(t if isinstance(t, str) else None, shingle) for t in pdf["text"]], np.uint64)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "fp": fp.view(np.int64)})

    return own.mapInPandas(run, f"doc_id {dict(own.dtypes)['doc_id']}, fp long")


def masks(width: int, most: int) -> np.ndarray:
    """All words of up to ``most`` set bits among the lowest ``width``."""
    one = np.uint64(1) << np.arange(width, dtype=np.uint64)
    out = [np.zeros(1, np.uint64)]
    if most >= 1:
        out.append(one)
    if most >= 2:
        a, b = np.triu_indices(width, 1)
        out.append(one[a] | one[b])
    return np.concatenate(out)


def meet(fps: np.ndarray, left: np.ndarray, width: int, limit: int = GROUP_VARIANTS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Fingerprints that share a variant: (variant number, index into ``fps``).

    ``fps`` agree with the group in all but the lowest ``width`` bits, after ``2 - left``
    flips there. Too many variants: the group is split by its next bit.
    """
    counts = [int((left == r).sum()) for r in range(3)]
    size = counts[0] + counts[1] * (1 + width) + counts[2] * (1 + width + width * (width - 1) // 2)
    if len(fps) < 2:
        return
    if size > 2 * limit and width > 1:
        bit = (fps >> np.uint64(width - 1)) & np.uint64(1)
        for v in (0, 1):
            room = left - (bit != v)
            at = np.flatnonzero(room >= 0)
            for g, own in meet(fps[at], room[at], width - 1, limit):
                yield g, at[own]
        return
    low = fps & np.uint64((1 << width) - 1)
    variants, owners = [], []
    for r in range(3):
        at = np.flatnonzero(left == r)
        if len(at):
            m = masks(width, r)
            variants.append((low[at][:, None] ^ m).ravel())
            owners.append(np.repeat(at.astype(np.int32), len(m)))
    variant, owner = np.concatenate(variants), np.concatenate(owners)
    order = np.sort(variant)
    shared = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(shared):
        return
    # A table of hashed values throws out most variants before the exact look-up.
    hashed = lambda x: (x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)
    seen = np.zeros(1 << 20, bool)
    seen[hashed(shared)] = True
    at = np.flatnonzero(seen[hashed(variant)])
    g = np.searchsorted(shared, variant[at])
    good = shared[np.minimum(g, len(shared) - 1)] == variant[at]
    yield g[good], owner[at[good]]


def links(fps: np.ndarray, group: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(smaller, other) for each fingerprint of a group that meets a smaller one, directly or through others."""
    fps = np.unique(fps)
    if len(fps) < 2:
        return fps[:0], fps[:0]
    top = np.bitwise_count((fps >> np.uint64(64 - bits)) ^ np.uint64(group)).astype(np.int64)
    label = np.arange(len(fps))
    for g, own in meet(fps, RADIUS // 2 - top, 64 - bits):
        order = np.argsort(g, kind="stable")
        g, own = g[order], own[order]
        first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        n = np.diff(np.concatenate([first, [len(g)]]))
        head = np.repeat(np.minimum.reduceat(own, first), n)
        near = np.bitwise_count(fps[head] ^ fps[own]) <= RADIUS
        a, b = head[near], own[near]
        while True:
            low = np.minimum(label[a], label[b])
            before = label.copy()
            np.minimum.at(label, label[a], low)
            np.minimum.at(label, label[b], low)
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            label = label[label]
            if (label == before).all():
                break
    other = np.flatnonzero(label != np.arange(len(fps)))
    return fps[label[other]], fps[other]


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers of edges that span the components of the graph: each round, every root takes its edge to the smallest other root."""
    label, kept = np.arange(n), [np.zeros(0, np.int64)]
    while True:
        la, lb = label[a], label[b]
        at = np.flatnonzero(la != lb)
        if not len(at):
            return np.concatenate(kept)
        hi, lo = np.maximum(la[at], lb[at]), np.minimum(la[at], lb[at])
        order = np.lexsort((lo, hi))
        first = order[np.concatenate([[True], hi[order][1:] != hi[order][:-1]])]
        kept.append(at[first])
        up = np.arange(n)
        up[hi[first]] = lo[first]
        while (up[up] != up).any():
            up = up[up]
        label = up[label]


def near_links(fps: np.ndarray, group: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Like ``links``, but every pair is itself within the radius: a spanning forest of the pairs that meet."""
    fps = np.unique(fps)
    top = np.bitwise_count((fps >> np.uint64(64 - bits)) ^ np.uint64(group)).astype(np.int64)
    pairs = [np.zeros(0, np.int64)]
    for g, own in meet(fps, RADIUS // 2 - top, 64 - bits):
        order = np.lexsort((own, g))
        g, own = g[order], own[order].astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
        head = np.repeat(own[first], np.diff(np.concatenate([first, [len(g)]])))
        pairs.append(np.unique(head * len(fps) + own))
    pair = np.unique(np.concatenate(pairs))
    a, b = pair // max(1, len(fps)), pair % max(1, len(fps))
    near = (a != b) & (np.bitwise_count(fps[a] ^ fps[b]) <= RADIUS)
    a, b = a[near], b[near]
    kept = forest(len(fps), a, b)
    return fps[a[kept]], fps[b[kept]]


def leading_bits(n: int) -> int:
    """So many that a group of ``n`` fingerprints' variants holds GROUP_VARIANTS on average."""
    return min(30, max(1, math.ceil(math.log2(max(2, n * 2081 / GROUP_VARIANTS)))))


def fingerprint_components(fps: DataFrame) -> DataFrame:
    """(fp) -> (fp, root) for fingerprints that are linked to another; root stands for the component."""
    distinct = materialise(fps.select("fp").distinct(), "distinct")
    bits = leading_bits(distinct.count())
    near = [int(m) for m in masks(bits, RADIUS // 2)]
    top = F.shiftrightunsigned("fp", 64 - bits)
    dealt = distinct.select("fp", F.explode(F.transform(F.array(*[F.lit(m).cast("long") for m in near]), lambda m: top.bitwiseXOR(m))).alias("group"))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = links(pdf["fp"].to_numpy().view(np.uint64), int(key[0]), bits)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    edges = materialise(dealt.groupBy("group").applyInPandas(run, "a long, b long"), "links")
    out = components(edges)
    discard(distinct, edges)
    return out.select(F.col("node").alias("fp"), "root")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """Columns doc_id, fp, component_id (smallest doc_id reachable over links), one row for each row of ``docs``."""
    own = materialise(fingerprints(docs, doc_id, text, shingle), "fps")
    linked = fingerprint_components(own)
    release(docs.sparkSession)
    first = own.groupBy("fp").agg(F.min("doc_id").alias("first"))
    by_root = first.join(linked, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    by_root = materialise(by_root, "roots")
    smallest = by_root.groupBy("root").agg(F.min("first").alias("component_id"))
    of_fp = by_root.select("fp", "root").join(smallest, "root").select("fp", "component_id")
    return own.join(of_fp, "fp").select("doc_id", "fp", "component_id")


SEEDS = 10
#: Seeds whose variants are dealt at a time.
SEEDS_AT_ONCE = 5
#: Rows of three numbers up to which the documents to verify are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 200_000
#: Documents that a family sets against its others in the first round; so many times more in each other round.
HEADS = 8
#: Classes, a multiple of 64, whose parities tell sets apart.
SKETCH = 1024
#: Links up to which the components of verified documents are worked out in one task, 16 bytes each.
FEW_EDGES = 500_000
#: Parts that the members of one family are dealt to.
PARTS = 32


def further_links(links_: DataFrame, found: DataFrame, sets: DataFrame, alike, similarity: float) -> DataFrame:
    """(a, b): verified links between the parts into which verification broke the components of the pairs ``found``.

    In rounds, each component that is still in several parts sets ever more of its documents
    against all members of its other parts, until it is one part or every pair across parts has been
    compared. A pair is left out only where it cannot be ``similarity`` alike, by the sizes of its sets or by the
    parities of their members in SKETCH classes: two sets differ in one member at least for each class of unequal parity.
    """
    spark = links_.sparkSession
    families = components(found, FEW_EDGES).withColumnRenamed("root", "family")

    @F.pandas_udf("array<long>")
    def parities(s: pd.Series) -> pd.Series:
        odd = (np.bincount((np.frombuffer(x, np.uint64) % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH) & 1 for x in s)
        return pd.Series([np.packbits(x.astype(np.uint8)).view(np.int64) for x in odd])

    sized = materialise(sets.select("doc_id", "s", (F.length("s") / 8).cast("long").alias("n"), parities("s").alias("odd")), "sized")
    lo, hi = 0, HEADS
    while True:
        parts = families.join(components(links_, FEW_EDGES), "node", "left").select(F.col("node").alias("doc_id"), "family", F.coalesce("root", "node").alias("part"))
        parts = materialise(parts, "parts")
        several_ = parts.groupBy("family").agg(F.count("*").alias("m"), F.min("part").alias("x"), F.max("part").alias("y")).where((F.col("x") != F.col("y")) & (F.col("m") > lo)).select("family", "m")
        several_ = materialise(several_, "families")
        n = several_.count()
        if not n:
            return links_
        # A place in (0, 1), so that about k documents of m come before k / m.
        place = (F.shiftrightunsigned(F.xxhash64(F.lit("place"), "doc_id"), 11).cast("double") + 0.5) / float(1 << 53)
        members = parts.join(F.broadcast(several_) if n <= BROADCAST_ROWS else several_, "family").withColumn("place", place * F.col("m"))
        members = materialise(members.join(sized, "doc_id").withColumn("deal", F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))), "members")
        heads = members.where((F.col("place") >= lo) & (F.col("place") < hi)).withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))))
        heads = heads.select("family", "deal", *[F.col(k).alias(f"{k}_a") for k in ("doc_id", "part", "place", "n", "s", "odd")])
        after = F.struct("place", "doc_id") > F.struct(F.col("place_a").alias("place"), F.col("doc_id_a").alias("doc_id"))
        differ = functools.reduce(operator.add, [F.bit_count(F.get("odd", F.lit(k)).bitwiseXOR(F.get("odd_a", F.lit(k)))) for k in range(SKETCH // 64)])
        # Half a member of room for rounding.
        fits = (F.least("n", "n_a") + 0.5 >= similarity * F.greatest("n", "n_a")) & (differ <= (1 - similarity) / (1 + similarity) * (F.col("n") + F.col("n_a")) + 0.5)
        pairs = members.join(heads, ["family", "deal"]).where((F.col("part") != F.col("part_a")) & after & fits)
        more = pairs.where(alike("s_a", "s")).select(F.least("doc_id", "doc_id_a").alias("a"), F.greatest("doc_id", "doc_id_a").alias("b"))
        links_ = materialise(links_.unionAll(more), "links")
        discard(parts, several_, members)
        release(spark)
        lo, hi = hi, HEADS * hi


def similar_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seeds: int = SEEDS, features: int = 2, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """Columns doc_id, c1, c2 (hashes of the text), component_id: documents linked by copies and by pairs whose sets of ``shingle``-word shingles are ``similarity`` alike.

    One fingerprint of four- or five-word shingles at 4 bits misses most pairs near 0.8, so candidates
    come from ``seeds`` fingerprints of ``features``-word shingles, by the same ball hashing, and each is
    verified on the texts' whole shingle sets. Exact copies are grouped first and go on as one. A group's
    first candidates are a spanning forest of its near pairs; every fingerprint stands in many groups.
    Where verification breaks a component of candidates, its other pairs are compared too.
    Texts without words are alike; a null doc_id stands alone among its exact copies.
    """
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    own = own.withColumns({"c1": F.xxhash64("text"), "c2": F.xxhash64(F.lit("copy"), "text")})

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield pdf[["doc_id", "c1", "c2"]].assign(fps=[several(t, features, seeds) for t in pdf["text"]])

    base = materialise(own.mapInPandas(run, "doc_id long, c1 long, c2 long, fps array<long>"), "base")
    reps = materialise(base.groupBy("c1", "c2").agg(F.min("doc_id").alias("rep"), F.first("fps").alias("fps")), "reps")
    # Wider groups than for one fingerprint: fewer rows are dealt, and crowded groups are sliced anyway.
    bits = leading_bits(reps.count() // 4)
    near = F.array(*[F.lit(int(m)).cast("long") for m in masks(bits, RADIUS // 2)])

    def pairs(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = near_links(pdf["fp"].to_numpy().view(np.uint64), int(key[1]), bits)
        return pd.DataFrame({"seed": int(key[0]), "a": a.view(np.int64), "b": b.view(np.int64)})

    met = []
    for at in range(0, seeds, SEEDS_AT_ONCE):
        each = reps.where("rep is not null").select("rep", F.posexplode("fps").alias("seed", "fp")).where(F.col("seed").between(at, at + SEEDS_AT_ONCE - 1))
        first = materialise(each.groupBy("seed", "fp").agg(F.min("rep").alias("first")), "first")
        dealt = first.select("seed", "fp", F.explode(F.transform(near, lambda m: F.shiftrightunsigned("fp", 64 - bits).bitwiseXOR(m))).alias("group"))
        linked = dealt.groupBy("seed", "group").applyInPandas(pairs, "seed int, a long, b long").distinct()
        side = lambda k: first.select("seed", F.col("fp").alias(k), F.col("first").alias(f"doc_{k}"))  # noqa: B023, E731
        cross = linked.join(side("a"), ["seed", "a"]).join(side("b"), ["seed", "b"]).select("doc_a", "doc_b")
        same = each.join(first, ["seed", "fp"]).where("rep <> first").select(F.col("first").alias("doc_a"), F.col("rep").alias("doc_b"))
        met.append(materialise(cross.unionAll(same).select(F.least("doc_a", "doc_b").alias("a"), F.greatest("doc_a", "doc_b").alias("b")).where("a <> b"), "met"))
        discard(first)
        release(docs.sparkSession)
    found = materialise(functools.reduce(DataFrame.unionAll, met).distinct(), "pairs")
    discard(*met)
    ids = found.select(F.col("a").alias("doc_id")).unionAll(found.select("b")).distinct()
    wanted = materialise(reps.select("c1", "c2", F.col("rep").alias("doc_id")).join(ids, "doc_id", "left_semi"), "wanted")
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)

    def shingles(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield pdf[["doc_id"]].assign(s=[np.unique(_hashes(t, shingle)).tobytes() for t in pdf["text"]])

    chosen = own.join(wanted, ["doc_id", "c1", "c2"], "left_semi")
    sets = materialise(chosen.select("doc_id", "text").mapInPandas(shingles, "doc_id long, s binary").dropDuplicates(["doc_id"]), "sets")

    @F.pandas_udf("boolean")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        out = []
        for x, y in zip(a, b, strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(both >= similarity * (len(x) + len(y) - both))
        return pd.Series(out)

    left, right = sets.select(F.col("doc_id").alias("a"), F.col("s").alias("sa")), sets.select(F.col("doc_id").alias("b"), F.col("s").alias("sb"))
    links_ = materialise(found.join(left, "a").join(right, "b").where(alike("sa", "sb")).select("a", "b"), "links")
    groups = components(further_links(links_, found, sets, alike, similarity), FEW_EDGES)
    release(docs.sparkSession)
    of_rep = reps.join(groups, reps.rep == groups.node, "left").select("c1", "c2", F.coalesce("root", "rep").alias("component_id"))
    return base.select("doc_id", "c1", "c2").join(of_rep, ["c1", "c2"]).select("doc_id", "c1", "c2", "component_id")


def hex_fingerprint(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", hex_fingerprint().alias("fingerprint"), "component_id")
