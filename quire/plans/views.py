"""Derived views over the given tables, the same integers in Spark and in DuckDB.

There are no papers in the given tables; these views make positioned text, regions, papers and
questions of them. ``CTE`` has the DuckDB text, the functions the Spark side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TEXT = (
    "CASE pk % 11 WHEN 0 THEN concat(num, '.') WHEN 1 THEN 'A' WHEN 2 THEN 'B' WHEN 3 THEN 'C' WHEN 4 THEN 'D' WHEN 5 THEN '  ' "
    "WHEN 6 THEN 'please turn over' WHEN 7 THEN concat('word', pk % 97, ' ') WHEN 8 THEN 'For Examiner only' "
    "WHEN 9 THEN concat(' x', num, ' [', num, ']') ELSE 'n+2' END"
)
LEX = [
    ("Physics", "Endings", "tion", 0), ("Physics", "Endings", "ing", 0), ("Physics", "Articles", "the", 1), ("Mathematics", "Endings", "ent", 2),
    ("Mathematics", "Roots", "der", 3), ("Chemistry", "Plurals", "eaux", 4), ("Chemistry", "Plurals", "ung", 4), ("Chemistry", "Articles", "license", 5),
]
SESSION = "CASE o_orderkey % 3 WHEN 0 THEN 'M/J' WHEN 1 THEN 'O/N' ELSE 'F/M' END"
SUBJECT = "CASE o_custkey % 3 WHEN 0 THEN '9702' WHEN 1 THEN '9709' ELSE '9701' END"

CTE = {
    "v_spans": f"""SELECT *, {TEXT} AS text, CASE WHEN pk % 4 = 0 THEN 8.0 ELSE 12.0 END AS size FROM (
  SELECT l_orderkey//100 AS paper, (l_orderkey%100)//10+1 AS page,
       row_number() OVER (PARTITION BY l_orderkey//100,(l_orderkey%100)//10
         ORDER BY l_orderkey,l_linenumber,l_partkey,l_suppkey,l_extendedprice,l_quantity) AS ord,
       (l_partkey*7)%500 AS x0, (l_suppkey*37+l_linenumber*11+l_partkey*13)%760 AS y0,
       5+l_quantity::INT AS w, 8+l_linenumber AS h, l_linenumber AS num, l_partkey AS pk
  FROM lineitem)""",
    "v_regions": """SELECT paper, page, i AS region_ord, (c*(i+1)*31)%300 AS x0, (i*97+c*7)%600 AS y0, (c*(i+1)*31)%300+120+(c*(i+3))%140 AS x1, (i*97+c*7)%600+90+((c+i)*17)%90 AS y1
FROM (SELECT o_orderkey//100 AS paper, (o_orderkey%100)//10+1 AS page, o_orderkey%10 AS i, o_custkey AS c FROM orders)""",
    "v_markers": """SELECT paper, page, ord, y0, CASE WHEN pk%5=0 THEN 300 ELSE 40+(pk%4)*80 END AS x0,
       CASE WHEN pk%5=0 THEN page ELSE (page-1)*3+num END AS num
FROM v_spans""",
    "v_papers": f"""SELECT paper_code, row_number() OVER (ORDER BY paper_code) AS paper_id FROM (
  SELECT DISTINCT concat({SUBJECT}, '/', (1+o_orderkey%6)*10+1+o_orderkey%3, '/', {SESSION}, '/', right(year(o_orderdate)::VARCHAR, 2)) AS paper_code FROM orders)""",
    "v_questions": """SELECT q.doc_id, p.paper_code, p.paper_id, q.doc_id//40//k.n*40+q.doc_id%40+1 AS question, q.doc_id%12+1 AS page, q.text, 1+q.n_chars%8 AS marks
FROM documents q, (SELECT count(*) AS n FROM v_papers) k JOIN v_papers p ON p.paper_id = q.doc_id//40%k.n+1""",
    "v_lexicon": "SELECT * FROM (VALUES " + ", ".join(str(r) for r in LEX) + ") t(subject, topic, keyword, lex_ord)",
    "v_stems": """SELECT CASE WHEN paper_id%7=0 THEN concat('notes_', paper_id) ELSE concat(split_part(paper_code,'/',1), '_',
       CASE split_part(paper_code,'/',3) WHEN 'M' THEN 's' WHEN 'O' THEN 'w' ELSE 'm' END, split_part(paper_code,'/',5), '_qp_',
       CASE WHEN paper_id%5=1 THEN left(split_part(paper_code,'/',2),1) ELSE split_part(paper_code,'/',2) END) END AS stem, paper_id
FROM v_papers WHERE paper_id%6<>0""",
    "v_chat": """SELECT conv_id, turn, role, CASE conv_id%3 WHEN 0 THEN concat(text, ' explain q.', conv_id%40+1, ' in ', lower(p.paper_code)) WHEN 1 THEN concat(text, ' question 3') ELSE text END AS text
FROM conversations JOIN v_papers p ON p.paper_id = conv_id%20+1""",
}
NEEDS = {"v_markers": ["v_spans"], "v_questions": ["v_papers"], "v_stems": ["v_papers"], "v_chat": ["v_papers"]}


def sql(body: str, *views: str) -> str:
    """DuckDB SQL: the body with the named views and what they need."""
    names: list[str] = []
    for v in views:
        names += [n for n in (*NEEDS.get(v, []), v) if n not in names]
    ctes = ", ".join(f"{n} AS ({CTE[n]})" for n in names)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes}, {body[5:]}" if ctes else body
    return f"WITH {ctes} {body}" if ctes else body


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def v_spans(spark: SparkSession, d: str) -> DataFrame:
    raw = read(spark, d, "lineitem").selectExpr(
        "l_orderkey div 100 AS paper", "(l_orderkey % 100) div 10 + 1 AS page",
        "cast(row_number() OVER (PARTITION BY l_orderkey div 100, (l_orderkey % 100) div 10 ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS bigint) AS ord",
        "(l_partkey * 7) % 500 AS x0", "(l_suppkey * 37 + l_linenumber * 11 + l_partkey * 13) % 760 AS y0",
        "5 + cast(l_quantity AS int) AS w", "8 + l_linenumber AS h", "l_linenumber AS num", "l_partkey AS pk",
    )
    return raw.selectExpr("*", f"{TEXT} AS text", "cast(CASE WHEN pk % 4 = 0 THEN 8.0 ELSE 12.0 END AS double) AS size", "x0 + w AS x1", "y0 + h AS y1")


def v_regions(spark: SparkSession, d: str) -> DataFrame:
    """One region for each order, ten to a page."""
    o = read(spark, d, "orders").selectExpr("o_orderkey div 100 AS paper", "(o_orderkey % 100) div 10 + 1 AS page", "o_orderkey % 10 AS i", "o_custkey AS c")
    return o.selectExpr(
        "paper", "page", "i AS region_ord", "(c * (i + 1) * 31) % 300 AS x0", "(i * 97 + c * 7) % 600 AS y0",
        "(c * (i + 1) * 31) % 300 + 120 + (c * (i + 3)) % 140 AS x1", "(i * 97 + c * 7) % 600 + 90 + ((c + i) * 17) % 90 AS y1",
    )


def v_markers(spark: SparkSession, d: str) -> DataFrame:
    return v_spans(spark, d).selectExpr(
        "paper", "page", "ord", "y0", "CASE WHEN pk % 5 = 0 THEN 300 ELSE 40 + (pk % 4) * 80 END AS x0", "CASE WHEN pk % 5 = 0 THEN page ELSE (page - 1) * 3 + num END AS num",
    )


def v_papers(spark: SparkSession, d: str) -> DataFrame:
    codes = read(spark, d, "orders").selectExpr(
        f"concat({SUBJECT}, '/', (1 + o_orderkey % 6) * 10 + 1 + o_orderkey % 3, '/', {SESSION}, '/', right(cast(year(o_orderdate) AS string), 2)) AS paper_code"
    ).distinct()
    # A few hundred codes at most, whatever the scale: subjects, numbers, sittings and years are fixed.
    return codes.selectExpr("paper_code", "cast(row_number() OVER (ORDER BY paper_code) AS bigint) AS paper_id")


def v_questions(spark: SparkSession, d: str) -> DataFrame:
    """All documents, 40 at a time to one paper after the other, and round again with higher question numbers."""
    papers = v_papers(spark, d)
    n = papers.count()
    docs = read(spark, d, "documents").selectExpr("doc_id", f"(doc_id div 40) % {n} + 1 AS paper_id", f"doc_id div 40 div {n} * 40 + doc_id % 40 + 1 AS question", "doc_id % 12 + 1 AS page", "text", "1 + n_chars % 8 AS marks")
    return docs.join(papers, "paper_id").select("doc_id", "paper_code", "paper_id", "question", "page", "text", "marks")


def v_stems(spark: SparkSession, d: str) -> DataFrame:
    part = lambda k: f"split_part(paper_code, '/', {k})"
    return v_papers(spark, d).where("paper_id % 6 <> 0").selectExpr(
        f"CASE WHEN paper_id % 7 = 0 THEN concat('notes_', paper_id) ELSE concat({part(1)}, '_', CASE {part(3)} WHEN 'M' THEN 's' WHEN 'O' THEN 'w' ELSE 'm' END, {part(5)}, '_qp_', "
        f"CASE WHEN paper_id % 5 = 1 THEN left({part(2)}, 1) ELSE {part(2)} END) END AS stem", "paper_id",
    )


def v_chat(spark: SparkSession, d: str) -> DataFrame:
    c = read(spark, d, "conversations").selectExpr("*", "conv_id % 20 + 1 AS paper_id")
    return c.join(v_papers(spark, d), "paper_id").selectExpr(
        "conv_id", "turn", "role", "CASE conv_id % 3 WHEN 0 THEN concat(text, ' explain q.', conv_id % 40 + 1, ' in ', lower(paper_code)) WHEN 1 THEN concat(text, ' question 3') ELSE text END AS text",
    )
