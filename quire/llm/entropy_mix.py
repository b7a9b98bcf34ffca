"""Mixing sources to target weights by entropy balancing.

Each document gets a rate: of all rates whose words meet the sources' targets and of which none is
above ``most``, those that are closest to one copy of every document in relative entropy. They are
exp(lambda of the source * size / mean size of the source), cut at ``most``: the documents of a source
are tilted by their sizes, and lambda solves the convex dual. It is found by Newton's iterations
for all sources at once, each one distributed sum over the table (source, size, documents), with
a bracket that no step leaves; they end when every source's words are within TOLERANCE of its target.

Rates become copies: everyone gets the whole part. The rest is drawn by sequential Poisson
sampling: documents stand in the order of u / fraction, with u a uniform hash, and the first get
one more until the words reach the target. The place where that stops is found from sums over
buckets of that order and over groups of buckets, so no source is ever sorted in one task, however large.

Defined results: null text has 0 words; null is a source of its own, ranked last;
documents that share a doc_id are counted one by one; documents without words keep one copy, or
none where their whole source has no words; an empty table gives an empty result; other columns
of the input are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import discard, global_rank, materialise

WORD = r"[^\x20\x09-\x0D]+"
#: Documents that one bucket of all sources together holds on average, and buckets in a group.
BUCKET_ROWS = 500
GROUP = 1000
#: Relative distance from the targets at which Newton's iterations end.
TOLERANCE = 1e-11


def targets(sources: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Add weight and target to (source, words): ``share`` of all words, dealt by weight, capped at ``most`` times the source.

    The level at which capped targets sum to the total is found by repeated
    aggregation; each round moves two numbers to the driver.
    """
    ranked = global_rank(sources, F.col("source").asc_nulls_last(), name="rank")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = materialise(ranked.withColumn("weight", F.element_at(cycle, (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))), "sources")
    sums = ranked.agg(F.sum("words"), F.sum("weight")).first()
    total, level = share * (sums[0] or 0), 0.0
    if total:
        level = total / sums[1]
        while True:
            over = most * F.col("words") <= F.col("weight") * level
            full, free = ranked.agg(F.sum(F.when(over, most * F.col("words")).otherwise(0.0)), F.sum(F.when(over, 0.0).otherwise(F.col("weight")))).first()
            new = (total - full) / free if free else math.inf
            if new <= level:
                break
            level = new
    return ranked.withColumn("target", F.least(most * F.col("words"), F.col("weight") * level) if math.isfinite(level) else most * F.col("words"))


def tilts(sources: DataFrame, sizes: DataFrame, most: float = 2.0, steps: int = 200) -> DataFrame:
    """``sources`` (source, words, target, mean) with lam: the dual variable; infinite where all are taken ``most`` times, null without words or target.

    ``sizes``: (source, size, n). At the bracket's ends all rates are alike or lie on one side of the target.
    """
    goal = F.col("target") / F.col("words")
    least = sizes.where("size > 0").groupBy(F.col("source").alias("src")).agg(F.min("size").alias("least"))
    state = sources.join(least, F.expr("source <=> src"), "left").drop("src")
    edge = F.when(goal > 1, F.log(F.lit(float(most)))).otherwise(F.log(goal)) * F.col("mean") / F.col("least")
    solved = ~F.coalesce((F.col("words") > 0) & (F.col("target") > 0), F.lit(False)) | (goal >= most * (1 - 1e-12))
    lam = F.when((F.col("words") > 0) & (F.col("target") > 0), F.when(goal >= most * (1 - 1e-12), float("inf")).otherwise(0.0))
    state = materialise(state.withColumns({"lam": lam, "lo": F.least(F.lit(0.0), edge), "hi": F.greatest(F.lit(0.0), edge), "done": solved}), "dual")
    for k in range(steps):
        # The first few steps are needed in any case.
        if k not in (1, 2, 3) and not state.where("not done").limit(1).count():
            break
        now = state.where("not done").select(F.col("source").alias("src"), "lam", "mean")
        z = F.col("size") / F.col("mean")
        rate = F.exp(F.col("lam") * z)
        sums = sizes.where("size > 0").join(now, F.expr("source <=> src")).groupBy("src").agg(
            F.sum(F.col("n") * F.col("size") * F.least(rate, F.lit(float(most)))).alias("f"),
            F.sum(F.when(rate < most, F.col("n") * F.col("size") * z * rate).otherwise(0.0)).alias("slope"),
        )
        off = F.col("f") - F.col("target")
        lo, hi = F.when(off < 0, F.col("lam")).otherwise(F.col("lo")), F.when(off > 0, F.col("lam")).otherwise(F.col("hi"))
        next_ = state.join(sums, F.expr("source <=> src"), "left").withColumns({"l": lo, "h": hi, "newton": F.col("lam") - F.try_divide(off, F.col("slope"))})
        inside = (F.col("newton") > F.col("l")) & (F.col("newton") < F.col("h"))
        near = (F.abs(off) <= TOLERANCE * F.col("target")) | (F.col("h") - F.col("l") <= 1e-15 * F.abs(F.col("lam")))
        stay = F.col("done") | F.coalesce(near, F.lit(True))
        lam = F.when(stay, F.col("lam")).when(inside, F.col("newton")).otherwise((F.col("l") + F.col("h")) / 2)
        before, state = state, materialise(next_.select(*sources.columns, "least", lam.alias("lam"), F.col("l").alias("lo"), F.col("h").alias("hi"), stay.alias("done")), "dual")
        discard(before)
    return state.select(*sources.columns, "lam")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """Columns doc_id, size, source, source_size, target, rate, copies, taken, h; one row for each row of ``docs``."""
    sized = materialise(
        docs.select(
            F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.xxhash64(F.lit("mix"), F.col(doc_id), F.col(text)).alias("h"), F.md5(F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit("")))).alias("o"),
        ), "sizes",
    )
    sizes = materialise(sized.groupBy("source", "size").agg(F.count("*").alias("n")), "histogram")
    sources = materialise(sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("words"), F.sum("n").alias("docs")), "sources")
    wanted = targets(sources, weights, share, most).select("source", "words", "target", (F.col("words") / F.col("docs")).alias("mean"))
    solved = tilts(materialise(wanted, "targets"), sizes, most)

    def rate(size: str) -> Column:
        tilt = F.when(F.col("lam") == float("inf"), float(most)).otherwise(F.least(F.lit(float(most)), F.exp(F.col("lam") * F.col(size) / F.col("mean"))))
        return F.when(F.col("words") > 0, F.when(F.col(size) == 0, 1.0).otherwise(F.coalesce(tilt, F.lit(0.0)))).otherwise(0.0)

    known = solved.select(F.col("source").alias("src"), "words", "target", "mean", "lam")
    whole = sizes.join(known, F.expr("source <=> src")).groupBy("src").agg(F.sum(F.floor(rate("size")) * F.col("size") * F.col("n")).alias("whole_words"))
    plan = known.alias("k").join(whole.alias("w"), F.expr("k.src <=> w.src"), "left").select("k.*", F.greatest(F.lit(0.0), F.col("target") - F.col("whole_words")).alias("extra"))
    plan = materialise(plan, "plan")
    n = max(1, math.ceil((sources.agg(F.sum("docs")).first()[0] or 0) / BUCKET_ROWS))
    drawn = sized.join(plan, F.expr("source <=> src")).withColumn("rate", rate("size"))
    u = F.conv(F.left("o", F.lit(13)), 16, 10).cast("double") / F.lit(float(2**52))
    drawn = drawn.withColumn("at", F.when(F.col("size") > 0, F.try_divide(u, F.col("rate") - F.floor("rate"))))
    drawn = drawn.withColumn("bucket", F.floor(F.col("at") / (1 + F.col("at")) * n).cast("long"))
    # The group of buckets, then the bucket, in which the extra words of a source run out.
    sums = drawn.where("bucket is not null").groupBy("src", "extra", F.floor(F.col("bucket") / GROUP).alias("part"), "bucket").agg(F.sum("size").alias("s"))
    sums = materialise(sums, "buckets")

    def edge(rows: DataFrame, over: list[str], by: str) -> DataFrame:
        upto = F.sum("s").over(Window.partitionBy(*over).orderBy(by))
        return rows.withColumn("upto", upto + F.col("start")).withColumn("before", F.col("upto") - F.col("s")).where("before < extra and upto >= extra")

    parts = edge(sums.groupBy("src", "extra", "part").agg(F.sum("s").alias("s")).withColumn("start", F.lit(0)), ["src"], "part")
    parts = parts.select(F.col("src").alias("part_src"), F.col("part").alias("part_no"), F.col("before").alias("start"))
    last = edge(sums.join(parts, F.expr("src <=> part_src and part = part_no")), ["src"], "bucket")
    last = materialise(last.select(F.col("src").alias("edge_src"), F.col("bucket").alias("edge"), F.col("before").alias("edge_before")), "edges")
    both = drawn.join(last, F.expr("source <=> edge_src"), "left").drop("edge_src")
    inside = Window.partitionBy("source", "bucket").orderBy("at", "o", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    edges = both.where("bucket = edge").withColumn("more", (F.col("edge_before") + F.coalesce(F.sum("size").over(inside), F.lit(0)) + F.col("size") / 2 <= F.col("extra")).cast("long"))
    rest = both.where("bucket is null or edge is null or bucket <> edge").withColumn("more", F.coalesce((F.col("extra") > 0) & (F.col("bucket") < F.coalesce("edge", F.lit(n))), F.lit(False)).cast("long"))
    copies = F.least(F.floor("rate") + F.col("more"), F.lit(most)).cast("long")
    return rest.unionByName(edges).select(
        "doc_id", "size", "source", F.col("words").alias("source_size"), "target", "rate", copies.alias("copies"), (copies * F.col("size")).alias("taken"), "h"
    )


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


OP7_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5(concat(doc_id, ':', text)) AS o
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS words FROM d GROUP BY source
), r AS (
  SELECT *, list_extract([5.0, 2.0, 1.0]::DOUBLE[], ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT) AS w FROM s
), c AS (
  SELECT sum(2.0::DOUBLE * words) OVER p AS full_words, sum(w) OVER () - sum(w) OVER p AS free_weight
  FROM r WINDOW p AS (ORDER BY 2.0::DOUBLE * words / w, source ROWS UNBOUNDED PRECEDING)
), l AS (
  SELECT greatest(1.5::DOUBLE * (SELECT sum(words) FROM s) / (SELECT sum(w) FROM r),
                  (SELECT max((1.5::DOUBLE * (SELECT sum(words) FROM s) - full_words) / free_weight) FROM c WHERE free_weight > 0)) AS level
), t AS (
  SELECT source, words, least(2.0::DOUBLE * words, w * level) AS target FROM r, l
), z AS (
  SELECT source, size, count(*) AS n FROM d WHERE size > 0 GROUP BY source, size
), q AS (
  SELECT t.source, t.words, t.target, t.words / (SELECT count(*) FROM d WHERE d.source IS NOT DISTINCT FROM t.source) AS mean, min(z.size) AS least
  FROM t JOIN z ON z.source IS NOT DISTINCT FROM t.source WHERE t.target > 0 AND t.target < 2 * t.words * (1 - 1e-12::DOUBLE) GROUP BY t.source, t.words, t.target
), it AS (
  SELECT source, target, mean, least(0, ln(least(target / words, 2)) * mean / least)::DOUBLE AS lo, CASE WHEN target > words THEN ln(2.0::DOUBLE) * mean / least ELSE 0 END::DOUBLE AS hi, 0 AS k FROM q
  UNION ALL
  SELECT source, target, mean, CASE WHEN f < target THEN (lo + hi) / 2 ELSE lo END, CASE WHEN f < target THEN hi ELSE (lo + hi) / 2 END, k + 1
  FROM (SELECT it.source, it.target, it.mean, it.lo, it.hi, it.k, sum(z.n * z.size * least(2.0::DOUBLE, exp((it.lo + it.hi) / 2 * z.size / it.mean))) AS f
        FROM it JOIN z ON z.source IS NOT DISTINCT FROM it.source WHERE it.k < 100 GROUP BY it.source, it.target, it.mean, it.lo, it.hi, it.k)
), y AS (
  SELECT t.source, t.words, t.target, it.mean, CASE WHEN t.target >= 2 * t.words * (1 - 1e-12::DOUBLE) THEN 2.0::DOUBLE END AS flat, (it.lo + it.hi) / 2 AS lam
  FROM t LEFT JOIN it ON it.source IS NOT DISTINCT FROM t.source AND it.k = 100
), x AS (
  SELECT d.doc_id, d.source, d.size, d.o, y.words, y.target,
         CASE WHEN y.words = 0 THEN 0 WHEN d.size = 0 THEN 1 ELSE coalesce(flat, least(2.0::DOUBLE, exp(lam * d.size / mean)), 0) END AS rate
  FROM d JOIN y ON d.source IS NOT DISTINCT FROM y.source
), e AS (
  SELECT *, sum(floor(rate) * size) OVER (PARTITION BY source) AS whole_words,
         CASE WHEN size > 0 AND rate > floor(rate) THEN ('0x' || left(o, 13))::BIGINT / 4503599627370496.0::DOUBLE / (rate - floor(rate)) END AS place
  FROM x
), m AS (
  SELECT *, greatest(0, target - whole_words) AS extra, CASE WHEN place IS NOT NULL THEN sum(size) OVER (PARTITION BY source, place IS NULL ORDER BY place, o, doc_id, size ROWS UNBOUNDED PRECEDING) - size END AS before
  FROM e
)
SELECT doc_id, size, words AS source_size, target,
       (least(floor(rate) + CASE WHEN before + size / 2 <= extra THEN 1 ELSE 0 END, 2) * size)::BIGINT AS taken
FROM m
"""
