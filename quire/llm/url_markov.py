"""URL filter by the ratio of two character language models.

Two Markov models, of the URLs that the rules accept and of those that they
reject, are smoothed by Witten-Bell: the estimate for a character after the five before it
falls back on that after the last four, and so on down to no context and to equal chances, each
the more the less its context has been seen. A URL's
score is the mean over its characters of the difference of log probabilities. The
cut is calibrated on labelled URLs that the models have not seen.

The models hold the counts of all windows of real characters (only A-Z are folded), so they
grow with the URLs; nothing bounds them but the text. The difference of log probabilities is
worked out once for each distinct window of the URLs to be judged, by joins with the counts
of each order, and joined to the windows of each URL: by broadcast up to BROADCAST_ROWS
windows, else by a salted shuffle. DataFrame functions only.

Defined results: a null url or one without ``://`` has empty host and path; a url
without characters scores 0; without labelled URLs of both kinds the verdict of the
method is allow; every row is judged by its url alone, so repeated page_ids do no harm;
other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import ascii_lower, materialise

#: Rule: verdict, host, path.
RULES = (
    ("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"), ("block", "org", "/es/"),
)
#: Characters of context that a model looks at, at most, unless ``order`` says otherwise; the sign that stands before a URL.
ORDER = 5
START = "\x02"
#: Distinct windows up to which their scores are broadcast, some 50 bytes each; parts that a window is dealt to beyond.
BROADCAST_ROWS = 400_000
SALTS = 16
#: Characters of URLs that one task spreads out.
TASK_CHARS = 8 << 20


def host_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """Struct (length, rule, verdict) of the longest fitting rule, or null."""
    fits = [
        F.when(((host == h) | host.endswith(f".{h}")) & path.startswith(p), F.struct(F.lit(len(h + p)).alias("length"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
        for v, h, p in rules
    ]
    return F.array_max(F.array_compact(F.array(*fits)))


#: A URL by two 64-bit hashes, so that its text need not go with each of its characters.
URL_KEY = ("h1", "h2")


def with_key(urls: DataFrame) -> DataFrame:
    return urls.withColumns({"h1": F.xxhash64("url"), "h2": F.xxhash64(F.lit("again"), "url")})


def places(urls: DataFrame, order: int = ORDER) -> DataFrame:
    """One row for each character of each (url, ...): its other columns and g, the character with the ``order`` ones before it."""
    chars = F.split(F.concat(F.lit(START * order), ascii_lower(F.coalesce("url", F.lit("")))), "")
    grams = F.transform(F.sequence(F.lit(0), F.size("chars") - (order + 1)), lambda i: F.concat(*[F.get("chars", i + j) for j in range(order + 1)]))
    more = [c for c in urls.columns if c != "url"]
    return urls.select(*more, chars.alias("chars")).where(F.size("chars") > order).select(*more, F.explode(grams).alias("g"))


def counts(labelled: DataFrame, order: int = ORDER) -> DataFrame:
    """(url, verdict) -> (g, allow, block): how often each window stands in URLs of either kind."""
    kind = lambda v: F.count(F.when(F.col("verdict") == v, 1)).cast("double").alias(v)
    return materialise(places(labelled.select("url", "verdict"), order).groupBy("g").agg(kind("allow"), kind("block")), "grams")


def ratios(windows: DataFrame, grams: DataFrame, most: int = ORDER) -> DataFrame:
    """(g) -> (g, llr): log probability of the window's last character among accepted URLs minus that among rejected ones."""
    kinds = ("allow", "block")
    total = [F.sum(k).alias(k) for k in kinds]
    seen = [F.count(F.when(F.col(k) > 0, 1)).cast("double").alias(f"t_{k}") for k in kinds]
    order = lambda k: grams.groupBy(F.right("g", F.lit(k + 1)).alias("gram")).agg(*total)
    flat = order(0)
    letters = flat.agg(F.count("*")).first()[0] + 1
    out = windows.withColumns({f"p_{v}": F.lit(1.0 / letters) for v in kinds})
    for k in range(most + 1):
        own = order(k)
        context = own.groupBy(F.left("gram", F.lit(k)).alias("context")).agg(*[F.sum(v).alias(f"n_{v}") for v in kinds], *seen)
        out = out.withColumns({"gram": F.right("g", F.lit(k + 1)), "context": F.left(F.right("g", F.lit(k + 1)), F.lit(k))})
        out = out.join(own, "gram", "left").join(context, "context", "left")
        step = lambda v: F.when(F.col(f"n_{v}") > 0, (F.coalesce(v, F.lit(0.0)) + F.col(f"t_{v}") * F.col(f"p_{v}")) / (F.col(f"n_{v}") + F.col(f"t_{v}"))).otherwise(F.col(f"p_{v}"))
        out = out.select("g", *[step(v).alias(f"p_{v}") for v in kinds])
        if k % 2:
            out = materialise(out, "windows")
    return materialise(out.select("g", (F.log("p_allow") - F.log("p_block")).alias("llr")), "ratio")


def scores(urls: DataFrame, grams: DataFrame, order: int = ORDER) -> DataFrame:
    """(h1, h2, url) -> (h1, h2, score)."""
    all_ = places(urls.select(*URL_KEY, "url"), order)
    llr = ratios(all_.select("g").distinct(), grams, order)
    if llr.count() <= BROADCAST_ROWS:
        both = all_.join(F.broadcast(llr), "g")
    else:
        # Every URL has some windows in common with most others.
        salted = llr.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
        both = all_.withColumn("salt", F.pmod("h1", F.lit(SALTS))).join(salted, ["g", "salt"])
    return both.groupBy(*URL_KEY).agg(F.avg("llr").alias("score"))


def judge(pages: DataFrame, page_id: str = "page_id", url: str = "url", rules: tuple = RULES, calibrate: int = 5, order: int = ORDER) -> DataFrame:
    """Columns page_id, host, path, rule, verdict, score, cut. One labelled URL in ``calibrate`` sets the cut, the others the models, which look at ``order`` characters before each."""
    host, path = host_path(F.col("url"))
    own = with_key(pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))).withColumns({"host": host, "path": path})
    own = materialise(own.withColumn("r", rule_of(F.col("host"), F.col("path"), rules)), "pages")
    n = max(int(own.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil((own.agg(F.sum(F.length("url"))).first()[0] or 0) / TASK_CHARS))
    # A number of parts that stays: the small table grows by all its windows.
    distinct = materialise(own.where("url is not null").select(*URL_KEY, "url", "r.verdict").repartition(n, *URL_KEY).groupBy(*URL_KEY).agg(F.first("url").alias("url"), F.first("verdict").alias("verdict")), "urls")
    aside = F.pmod(F.xxhash64(F.lit("cut"), F.col("url")), F.lit(calibrate)) == 0
    grams = counts(distinct.where(F.col("verdict").isNotNull() & ~aside), order)
    scored = materialise(scores(distinct, grams, order), "scores")
    # Shares of accepted and rejected URLs at each score, over at most 4001 steps.
    step = F.greatest(F.lit(-2000), F.least(F.lit(2000), F.floor(F.col("score") * 200)))
    bins = distinct.where(F.col("verdict").isNotNull() & aside).join(scored, [*URL_KEY]).groupBy(step.alias("step")).agg(F.count(F.when(F.col("verdict") == "allow", 1)).alias("a"), F.count(F.when(F.col("verdict") == "block", 1)).alias("b"))
    whole = Window.partitionBy(F.lit(0))
    below = whole.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    share = lambda x: F.coalesce(F.try_divide(F.sum(x).over(below), F.sum(x).over(whole)), F.lit(0.0))
    gain = share("b") - share("a")
    best = bins.where("step is not null").select("step", gain.alias("gain")).agg(F.max_by("step", F.struct("gain", -F.col("step")))).first()[0]
    kinds = distinct.agg(F.count(F.when(F.col("verdict") == "allow", 1)), F.count(F.when(F.col("verdict") == "block", 1))).first()
    cut = best / 200 if best is not None and min(kinds) else float("-inf")
    both = own.join(scored, [*URL_KEY], "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    verdict = F.coalesce(F.col("r.verdict"), F.when(F.col("score") >= cut, "allow").otherwise("block"))
    return both.select("page_id", "host", "path", F.col("r.rule").alias("rule"), verdict.alias("verdict"), "score", F.lit(cut).alias("cut"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "host", "path", "rule", "verdict", "score")
