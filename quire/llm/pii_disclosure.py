"""Information-theoretic sanitisation of personal data.

Base detectors find e-mail addresses, IP addresses, card numbers and phone numbers; each
distinct value is a protected entity. Terms (words of 4 letters or more) that stand within
``near`` characters of an entity (80; None: anywhere in the document), whatever else stands
there, are measured over the whole corpus: with document frequencies
as probabilities, a term's pointwise mutual information with the entity is compared with the
entity's information content. A term that gives away ``ratio`` of that content or more, in
``min_docs`` documents or more, discloses the entity wherever it stands, and is
generalised; if it never stands in a document without the entity, it is removed.

DataFrame functions only. Patterns are written so that matching takes linear time and no
deep recursion on long texts: where a repeated group would be needed, the separators that
cannot belong to a match are replaced first by one character that ends it.

Defined results: null text is empty; rows that share a doc_id are told apart by their
text, and equal ones get the same spans; terms inside base spans are not reported; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.llm.common import materialise

KINDS = ("email", "ip", "card", "phone", "term")
#: Characters on either side of an entity in which terms count as standing with it, unless ``near`` says otherwise.
NEAR = 80
TERM = r"\p{L}{4,}"
#: Rows of (term) or (document, pattern) up to which a table is broadcast; larger ones are shuffled.
BROADCAST_ROWS = 200_000
#: Bytes of such a table, written as JSON, up to which it is broadcast.
BROADCAST_BYTES = 16 << 20
#: Characters that the shortest match of any detector has.
SHORTEST = 4


def _around(pairs: Column, gaps: Column, i: Column, near: int) -> tuple[Column, Column]:
    """Up to ``near`` characters before and after match ``i``, whatever other matches stand there; words that are cut off are left out."""
    most = near // SHORTEST + 2
    join = lambda x: F.array_join(F.flatten(x), "")
    before = F.slice(pairs, F.greatest(F.lit(1), i + 1 - most), F.least(i, F.lit(most)))
    after = F.slice(pairs, i + 2, F.lit(most))
    left = F.concat(join(F.transform(before, lambda x: F.array(x["l"], x["m"]))), F.get(gaps, i))
    right = F.concat(F.get(gaps, i + 1), join(F.transform(after, lambda x: F.array(x["m"], x["r"]))))
    cut = lambda text, part, edge: F.when(F.length(text) > near, F.regexp_replace(part, edge, "")).otherwise(text)
    return cut(left, F.right(left, F.lit(near)), r"^\p{L}+"), cut(right, F.left(right, F.lit(near)), r"\p{L}+$")


def _bind(value: Column, f) -> Column:
    """``f`` of a value that is computed once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _matches(kind: int, text: Column, pattern: str, when: Column, near: int | None) -> Column:
    """Array of struct(kind, place, gap: characters since the last match, value, left, right: text around) where ``when`` holds."""
    parts = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))

    def pairs(s: Column) -> Column:
        n = F.size(s["found"])
        # Letters of neighbouring matches are no words of the text.
        masked = F.transform(s["found"], lambda m: F.regexp_replace(m, r"\p{L}", "0")) if kind == 0 else s["found"]
        return F.struct(s["gaps"].alias("gaps"), F.arrays_zip(masked.alias("m"), F.slice(s["gaps"], F.lit(1), n).alias("l"), F.slice(s["gaps"], F.lit(2), n).alias("r"), s["found"].alias("v")).alias("pairs"))

    def one(p: Column, x: Column, i: Column) -> Column:
        left, right = (F.lit(""), F.lit("")) if near is None else _around(p["pairs"], p["gaps"], i, near)
        return F.struct(F.lit(kind).alias("kind"), i.alias("place"), F.length(x["l"]).alias("gap"), x["v"].alias("value"), left.alias("left"), right.alias("right"))

    return F.when(when, _bind(parts, lambda s: _bind(pairs(s), lambda p: F.transform(p["pairs"], lambda x, i: one(p, x, i)))))


def base_spans(own: DataFrame, near: int | None = NEAR) -> DataFrame:
    """(doc_id, th, kind, start, stop, value, left, right) of the base detectors' matches."""
    t = F.col("text")
    # A dot that no domain can hold becomes a sign that only a local part can hold; a separator not between digits ends a card.
    mail = F.regexp_replace(t, r"(?<![A-Za-z0-9-])\.|\.(?![A-Za-z0-9-])", "_")
    card = F.regexp_replace(t, r"(?<![0-9])[ -]|[ -](?![0-9])", "\n")
    found = F.array(
        _matches(0, F.when(t.contains("@"), mail), r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9.-]*+", t.contains("@"), near),
        _matches(1, t, r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), near),
        _matches(2, F.when(t.rlike(r"[0-9][0-9 -]{14,}+"), card), r"[0-9][0-9 -]{15,}+", t.rlike(r"[0-9][0-9 -]{14,}+"), near),
        _matches(3, t, r"\+[0-9][ ().0-9-]+[0-9]", t.rlike(r"\+[0-9]"), near),
    )
    some = t.contains("@") | t.rlike(r"\+[0-9]|[0-9]\.[0-9]++\.[0-9]++\.[0-9]|[0-9][0-9 -]{14,}+")
    rows = own.where(some).select("doc_id", "th", F.explode(F.flatten(F.array_compact(found))).alias("m")).select("doc_id", "th", "m.*")
    upto = Window.partitionBy("doc_id", "th", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    n = F.length("value")
    rows = rows.distinct().withColumn("start", F.sum(F.col("gap") + n).over(upto) - n).withColumn("stop", F.col("start") + n)
    digits = F.length(F.regexp_replace("value", r"[^0-9]", ""))
    octets = ~F.exists(F.split("value", r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")) > 3) & ~F.exists(F.split("value", r"\."), lambda p: F.right(p, F.lit(3)).cast("int") > 255)
    good = (
        F.when(F.col("kind") == 1, octets)
        .when(F.col("kind") == 2, digits.between(16, 19) & F.call_function("luhn_check", F.regexp_replace("value", r"[ -]", "")))
        .when(F.col("kind") == 3, digits.between(8, 15)).otherwise(True)
    )
    return rows.where(good).select("doc_id", "th", "kind", "start", "stop", "value", "left", "right")


def _small(df: DataFrame) -> DataFrame:
    """Broadcast if rows and bytes are under their bounds, else leave the join to a shuffle."""
    rows, size = df.agg(F.count("*"), F.sum(F.octet_length(F.to_json(F.struct(*df.columns))))).first()
    return F.broadcast(df) if rows <= BROADCAST_ROWS and (size or 0) <= BROADCAST_BYTES else df


def _terms(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def disclosing_terms(own: DataFrame, spans: DataFrame, ratio: float = 0.9, min_docs: int = 3, near: int | None = NEAR) -> DataFrame:
    """(term, entity, bits, content, certain): terms that give away ``ratio`` of an entity's information content.

    Frequencies are counts of documents over the whole corpus.
    """
    entity = F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1), F.when(F.col("kind") >= 2, F.regexp_replace("value", r"[^0-9]", "")).otherwise(F.lower("value")))
    around = spans.select("doc_id", "th", entity.alias("entity"), F.concat_ws("\n", "left", "right").alias("around"))
    entities = around.groupBy("entity").agg(F.count_distinct("th", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("df_e"))
    n = own.count()
    content = F.log2(n / F.col("df_e"))
    bits = lambda df_t: F.log2(n * F.col("df_te") / (F.col(df_t) * F.col("df_e")))
    if near is None:
        # Whole documents: the terms of each one that holds an entity, outside its base spans' own letters only by chance of spelling.
        holds = around.select(F.col("doc_id").alias("hold_id"), F.col("th").alias("hold_th"), "entity").distinct()
        met = own.select("doc_id", "th", F.explode(_terms(F.col("text"))).alias("term")).distinct().join(holds, F.expr("doc_id <=> hold_id and th = hold_th")).select("doc_id", "th", "entity", "term")
    else:
        met = around.select("doc_id", "th", "entity", F.explode(_terms(F.col("around"))).alias("term")).distinct()
    pairs = met.groupBy("term", "entity").agg(F.count("*").alias("df_te")).where(F.col("df_te") >= min_docs).join(entities, "entity")
    # A term is in as many documents at least as it stands near any entity: most pairs fail on that alone.
    least = met.select("doc_id", "th", "term").distinct().groupBy("term").agg(F.count("*").alias("least"))
    pairs = pairs.join(least, "term").where((content > 0) & (bits("least") >= ratio * content))
    pairs = materialise(pairs, "pairs", "snappy")
    words = own.select(F.explode(_terms(F.col("text"))).alias("term")).join(_small(pairs.select("term").distinct()), "term", "left_semi")
    df_t = words.groupBy("term").agg(F.count("*").alias("df_t"))
    return (
        pairs.join(df_t, "term").withColumn("bits", bits("df_t")).withColumn("content", content)
        .where(F.col("bits") >= ratio * F.col("content"))
        .select("term", "entity", "bits", "content", (F.col("df_te") >= F.col("df_t")).alias("certain"))
    )


def term_spans(own: DataFrame, base: DataFrame, terms: DataFrame) -> DataFrame:
    """(doc_id, th, kind, start, stop, certain) of disclosing terms outside base spans."""
    flagged = terms.groupBy("term").agg(F.max("certain").alias("certain"))
    # As the text spells them: lower case may have other letters, and more of them, than any pattern would fold.
    spelt = F.array_distinct(F.regexp_extract_all("text", F.lit(TERM), F.lit(0)))
    holds = own.select("doc_id", "th", F.explode(spelt).alias("spelt")).withColumn("term", F.lower("spelt")).join(_small(flagged), "term")
    holds = holds.groupBy("doc_id", "th").agg(F.array_sort(F.collect_set("spelt")).alias("terms"), F.collect_set(F.when(F.col("certain"), F.col("spelt"))).alias("sure"))
    holds = materialise(holds, "holds", "snappy").select(F.col("doc_id").alias("hold_id"), F.col("th").alias("hold_th"), "terms", "sure")
    docs = own.join(_small(holds), F.expr("doc_id <=> hold_id and th = hold_th"))
    pattern = F.concat(F.lit(r"(?<!\p{L})(?:"), F.array_join("terms", "|"), F.lit(r")(?!\p{L})"))
    docs = docs.withColumns({"gaps": F.split("text", pattern, -1), "found": F.regexp_extract_all("text", pattern, F.lit(0))})
    each = F.transform(F.arrays_zip(F.col("found").alias("m"), F.slice("gaps", F.lit(1), F.size("found")).alias("g")), lambda x, i: F.struct(i.alias("place"), (F.length(x["g"])).alias("gap"), F.length(x["m"]).alias("n"), F.array_contains("sure", x["m"]).alias("certain")))
    rows = docs.select("doc_id", "th", F.explode(each).alias("m")).select("doc_id", "th", "m.*").distinct()
    upto = Window.partitionBy("doc_id", "th").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    stop = F.sum(F.col("gap") + F.col("n")).over(upto)
    rows = rows.withColumn("stop", stop).select("doc_id", "th", F.lit(4).alias("kind"), (F.col("stop") - F.col("n")).alias("start"), "stop", "certain")
    # Against base spans: those that begin before and end after the term's start, or begin within it.
    both = rows.unionByName(base.select("doc_id", "th", "kind", "start", "stop", F.lit(False).alias("certain")))
    order = Window.partitionBy("doc_id", "th").orderBy("start", "kind")
    is_base = F.col("kind") < 4
    ends = F.max(F.when(is_base, F.col("stop"))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    begins = F.min(F.when(is_base, F.col("start"))).over(order.rowsBetween(0, Window.unboundedFollowing))
    free = both.withColumns({"ends": ends, "begins": begins}).where(~is_base & F.coalesce(F.col("ends") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("begins") >= F.col("stop"), F.lit(True)))
    return free.select("doc_id", "th", "kind", "start", "stop", "certain")


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ratio: float = 0.9, min_docs: int = 3, near: int | None = NEAR) -> DataFrame:
    """Columns doc_id, text, spans: array of struct(kind, start, stop, certain), by kind and start; one row for each row of ``docs``."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    base = materialise(base_spans(own, near), "base", "snappy")
    terms = materialise(disclosing_terms(own, base, ratio, min_docs, near), "terms", "snappy")
    spans = base.select("doc_id", "th", "kind", "start", "stop", F.lit(False).alias("certain")).unionByName(term_spans(own, base, terms))
    lists = spans.groupBy("doc_id", "th").agg(F.array_sort(F.collect_set(F.struct("kind", "start", "stop", "certain"))).alias("spans"))
    lists = lists.select(F.col("doc_id").alias("span_id"), F.col("th").alias("span_th"), "spans")
    none = F.array().cast("array<struct<kind:int,start:bigint,stop:bigint,certain:boolean>>")
    joined = own.join(lists, F.expr("doc_id <=> span_id and th = span_th"), "left")
    return joined.select("doc_id", "text", F.coalesce(F.col("spans").cast("array<struct<kind:int,start:bigint,stop:bigint,certain:boolean>>"), none).alias("spans"))


def sanitise(found: DataFrame) -> DataFrame:
    """(doc_id, text) with base spans and disclosing terms replaced by their kind, certain terms removed. Base spans win where spans overlap."""
    key = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"), s["certain"].alias("certain"))))
    first = F.filter(key, lambda s: ~F.exists(key, lambda o: (o["start"] < s["stop"]) & (s["start"] < o["stop"]) & ((o["start"] < s["start"]) | ((o["start"] == s["start"]) & (o["kind"] < s["kind"])))))
    mark = lambda s: F.when(s["certain"], F.lit("")).otherwise(F.concat(F.lit("["), F.upper(F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)), F.lit("]")))
    rows = found.withColumn("s", first)
    piece = F.transform("s", lambda s, i: F.concat(F.substr("text", (F.when(i == 0, F.lit(0)).otherwise(F.get("s", i - 1)["stop"]) + 1).cast("int"), F.greatest(F.lit(0), s["start"] - F.when(i == 0, F.lit(0)).otherwise(F.get("s", i - 1)["stop"])).cast("int")), mark(s)))
    tail = F.substr("text", (F.coalesce(F.get("s", F.size("s") - 1)["stop"], F.lit(0)) + 1).cast("int"))
    return rows.select("doc_id", F.concat(F.array_join(piece, ""), tail).alias("text"))


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    name = F.element_at
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"], s["stop"])), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{KINDS[k]}") for k in range(4)],
        F.sha2(written(F.filter("spans", lambda s: s["kind"] < 4)), 256).alias("base_sha256"), written("spans").alias("spans"), count(4).alias("n_term"),
    )
