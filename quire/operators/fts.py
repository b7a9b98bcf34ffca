"""Full-text search: tokens, a query language, BM25.

The query language: words, "phrases", word* for prefixes, ^word for a document's first
word, a + b for phrases, parentheses, and AND, OR, NOT in capitals. From the tightest:
neighbours without an operator, NOT (from the left), AND, OR. Neighbours of parentheses
need an operator.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K1, B = 1.2, 0.75
LEAST_IDF = 1e-6


class QuerySyntaxError(ValueError):
    """The query does not follow the language."""


def _accents() -> tuple[str, str]:
    """Lower-case letters of the Latin blocks with marks, and their base letters."""
    source, target = [], []
    for c in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        base = unicodedata.normalize("NFD", chr(c))
        if len(base) > 1 and len(base[0]) == 1 and base[0].isalpha() and all(unicodedata.category(m) == "Mn" for m in base[1:]):
            source.append(chr(c))
            target.append(base[0])
    return "".join(source), "".join(target)


ACCENTED, PLAIN = _accents()


def fold(text: Column) -> Column:
    return F.regexp_replace(F.translate(F.lower(text), ACCENTED, PLAIN), r"\p{Mn}", "")


def words(text: Column) -> Column:
    return F.regexp_extract_all(fold(text), F.lit(r"[\p{L}\p{N}\p{Co}]+"), F.lit(0))


@dataclass
class Leaf:
    terms: list[str]
    prefix: bool = False
    first: bool = False


_LEX = re.compile(r'\s*(?:("(?:[^"]|"")*")|([A-Za-z0-9_\x1a\x80-\U0010FFFF]+)|([()*^+]))')


def _plain_words(text: str) -> list[str]:
    low = "".join(PLAIN[ACCENTED.index(c)] if c in ACCENTED else c for c in text.lower())
    low = "".join(c for c in low if unicodedata.category(c) != "Mn")
    return re.findall(r"[^\W_]+", low)


def parse(query: str) -> tuple[object, list[Leaf]]:
    """Tree of ("and" | "or" | "not", left, right) and leaf numbers, and the leaves."""
    toks, at, text = [], 0, query.rstrip()
    while at < len(text):
        m = _LEX.match(text, at)
        if not m:
            raise QuerySyntaxError(f"unexpected {text[at:].strip()[:1]!r} in {query!r}")
        if m[1] is not None:
            toks.append(("str", m[1][1:-1].replace('""', '"')))
        elif m[2] is not None:
            toks.append((m[2], m[2]) if m[2] in ("AND", "OR", "NOT") else ("str", m[2]))
        else:
            toks.append((m[3], m[3]))
        at = m.end()
    leaves: list[Leaf] = []
    i = 0

    def peek() -> str | None:
        return toks[i][0] if i < len(toks) else None

    def fail():
        raise QuerySyntaxError(f"cannot read {query!r}")

    def phrase():
        nonlocal i
        leaf = Leaf([])
        if peek() == "^":
            leaf.first, i = True, i + 1
        while True:
            if peek() != "str":
                fail()
            leaf.terms += _plain_words(toks[i][1])
            i += 1
            if peek() == "+":
                i += 1
                continue
            break
        if peek() == "*":
            leaf.prefix, i = True, i + 1
        leaves.append(leaf)
        return len(leaves) - 1

    def implicit():
        nonlocal i
        if peek() == "(":
            i += 1
            out = either()
            if peek() != ")":
                fail()
            i += 1
            if peek() in ("str", "^", "("):
                fail()
            return out
        if peek() not in ("str", "^"):
            fail()
        out = phrase()
        while peek() in ("str", "^"):
            out = ("and", out, phrase())
        if peek() == "(":
            fail()
        return out

    def chain(op: str, name: str, below):
        def run():
            nonlocal i
            out = below()
            while peek() == op:
                i += 1
                out = (name, out, below())
            return out

        return run

    either = chain("OR", "or", chain("AND", "and", chain("NOT", "not", implicit)))
    if not toks:
        raise QuerySyntaxError("the query is empty")
    tree = either()
    if i < len(toks):
        fail()
    return tree, leaves


def _hit(leaf: Leaf, k: int, term: Column) -> list[tuple[int, int, Column]]:
    out = []
    for off, t in enumerate(leaf.terms):
        last = off == len(leaf.terms) - 1
        out.append((k, off, term.startswith(t) if last and leaf.prefix else term == t))
    return out


def postings(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, term, places, dl): a row for each word of each document, with its places and the document's length."""
    split = docs.select(*keys, words(F.coalesce(F.col(text), F.lit(""))).alias("_w"))
    each = split.select(*keys, F.size("_w").alias("dl"), F.posexplode("_w").alias("_pos", "term"))
    return each.groupBy(*keys, "dl", "term").agg(F.array_sort(F.collect_list("_pos")).alias("places")).select(*keys, "term", "places", "dl")


def terms_of(leaves: list[Leaf]) -> list[str] | None:
    """The words that a query looks up; None if it has a prefix."""
    if any(leaf.prefix for leaf in leaves):
        return None
    return sorted({t for leaf in leaves for t in leaf.terms})


def search(index: DataFrame, query: str, keys: list[str], n: int, total: int, limit: int | None = 20) -> DataFrame:
    """(keys, score): matching documents, best first; the score is negative, lower is better.

    ``index`` has the postings of the query's words at least, ``n`` and ``total`` are the number of documents and of their
    words. Single words are counted by their postings; places are compared only for phrases. The numbers of documents that
    match each part of the query are all that comes to the driver.
    """
    tree, leaves = parse(query)
    term = F.col("term")
    tests = [h for k, leaf in enumerate(leaves) for h in _hit(leaf, k, term)]
    if not tests:
        return index.select(*keys, F.lit(0.0).alias("score")).limit(0)
    wanted = tests[0][2]
    for t in tests[1:]:
        wanted = wanted | t[2]
    each = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(k).alias("leaf"), F.lit(off).alias("off"))) for k, off, c in tests]))
    found = index.where(wanted).select(*keys, "places", "dl", F.explode(each).alias("h")).select(*keys, "places", "dl", "h.*")
    first = [k for k, leaf in enumerate(leaves) if leaf.first]
    plain = [k for k, leaf in enumerate(leaves) if len(leaf.terms) == 1 and not leaf.first]
    hits = found.where(F.col("leaf").isin(plain)).select(*keys, "leaf", F.size("places").alias("f"), "dl")
    if len(plain) < len(leaves):
        need = F.element_at(F.array(*[F.lit(len(leaf.terms)) for leaf in leaves]), F.col("leaf") + 1)
        places = found.where(~F.col("leaf").isin(plain)).select(*keys, "leaf", "dl", "off", F.explode("places").alias("pos"))
        starts = places.groupBy(*keys, "leaf", (F.col("pos") - F.col("off")).alias("at")).agg(F.count("*").alias("n"), F.max("dl").alias("dl")).where(F.col("n") == need)
        if first:
            starts = starts.where(~F.col("leaf").isin(first) | (F.col("at") == 0))
        hits = hits.unionByName(starts.select(*keys, "leaf", F.lit(1).alias("f"), "dl"))
    hits = hits.groupBy(*keys, "leaf").agg(F.sum("f").alias("f"), F.max("dl").alias("dl"))
    df = {r.leaf: r.n for r in hits.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
    flat = hits.groupBy(*keys).agg(F.max("dl").alias("dl"), *[F.max(F.when(F.col("leaf") == k, F.col("f"))).alias(f"f{k}") for k in range(len(leaves))])

    def holds(t) -> Column:
        if isinstance(t, int):
            return F.col(f"f{t}").isNotNull()
        a, b = holds(t[1]), holds(t[2])
        return a & b if t[0] == "and" else a | b if t[0] == "or" else a & ~b

    avg = total / n if n else 0
    score = F.lit(0.0)
    for k in range(len(leaves)):
        idf = F.greatest(F.lit(LEAST_IDF), F.log(F.lit((n - df.get(k, 0) + 0.5) / (df.get(k, 0) + 0.5))))
        f = F.coalesce(F.col(f"f{k}"), F.lit(0))
        score = score + idf * (f * (K1 + 1)) / (f + K1 * (1 - B + B * F.col("dl") / F.lit(float(avg or 1))))
    out = flat.where(holds(tree)).select(*keys, (-score).alias("score"))
    return out if limit is None else out.orderBy("score", *keys).limit(limit)
