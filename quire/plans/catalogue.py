"""Every registered query of the document engine with its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import geometry as G
from quire.functions import text as X
from quire.operators import assemble, audit, merge, options, quarantine, segment, spatial, topics, tutor
from quire.operators import order as O
from quire.plans import bank as B
from quire.plans import views as V
from quire.plans.scratch import scratch_path, written
from quire.sources import adapters, files, listing

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
c = F.col


def query(sql: str | None, *views: str):
    """Register a query under its name, with its SQL over derived views."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = V.sql(sql, *views)
        return f

    return add


# Codes, stems, marks, references


@query("""SELECT paper_code, split_part(paper_code,'/',1) AS subject, split_part(paper_code,'/',2) AS variant,
 CASE split_part(paper_code,'/',3) WHEN 'M' THEN 'May/June' WHEN 'O' THEN 'October/November' ELSE 'February/March' END AS session,
 2000+split_part(paper_code,'/',5)::INT AS year FROM v_papers""", "v_papers")  # fmt: skip
def code_parse(spark, d):
    return V.v_papers(spark, d).select("paper_code", X.parse_code(c("paper_code")).alias("p")).select("paper_code", "p.*")


@query(r"""SELECT stem, CASE WHEN regexp_matches(stem, '^\d{4}_[smw]\d{2}_qp_\d{1,2}$') THEN
 concat(split_part(stem,'_',1), '/', split_part(stem,'_',4), '/', CASE left(split_part(stem,'_',2),1) WHEN 's' THEN 'M/J' WHEN 'w' THEN 'O/N' ELSE 'F/M' END, '/', right(split_part(stem,'_',2),2)) END AS code FROM v_stems""", "v_stems")  # fmt: skip
def stem_to_code(spark, d):
    return V.v_stems(spark, d).select("stem", X.stem_code(c("stem")).alias("code"))


@query(r"""SELECT s AS code, CASE WHEN regexp_matches(upper(trim(s)), '^\d{4}/\d+/[A-Z]/[A-Z]/\d{2}$') THEN
 concat(split_part(upper(trim(s)),'/',1), '/', printf('%02d', split_part(trim(s),'/',2)::INT), '/', split_part(upper(trim(s)),'/',3), '/', split_part(upper(trim(s)),'/',4), '/', split_part(trim(s),'/',5)) END AS normal
 FROM (SELECT CASE paper_id%4 WHEN 0 THEN concat(' ', lower(paper_code), ' ') WHEN 1 THEN replace(paper_code, concat('/', split_part(paper_code,'/',2), '/'), concat('/', left(split_part(paper_code,'/',2),1), '/')) WHEN 2 THEN concat('x', paper_code) ELSE paper_code END AS s FROM v_papers)""", "v_papers")  # fmt: skip
def code_normalize(spark, d):
    s = V.v_papers(spark, d).selectExpr("CASE paper_id % 4 WHEN 0 THEN concat(' ', lower(paper_code), ' ') WHEN 1 THEN replace(paper_code, concat('/', split_part(paper_code, '/', 2), '/'), concat('/', left(split_part(paper_code, '/', 2), 1), '/')) WHEN 2 THEN concat('x', paper_code) ELSE paper_code END AS code")
    return s.select("code", X.normalise_code(c("code")).alias("normal"))


@query(r"""SELECT paper, page, CASE WHEN len(m) > 0 THEN list_sum(list_transform(m, lambda x: x::INT))::BIGINT ELSE 1 END AS marks
FROM (SELECT paper, page, regexp_extract_all(string_agg(text, ' ' ORDER BY ord), '\[(\d{1,2})\]', 1) AS m FROM v_spans GROUP BY paper, page)""", "v_spans")  # fmt: skip
def marks_sum(spark, d):
    pages = V.v_spans(spark, d).groupBy("paper", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "text"))), lambda s: s["text"]), " ").alias("text"))
    return pages.select("paper", "page", X.marks(c("text")).cast("long").alias("marks"))


@query(r"""SELECT conv_id, turn, CASE WHEN code <> '' AND n <> '' THEN upper(code) END AS code, CASE WHEN code <> '' AND n <> '' THEN n::INT END AS number FROM (
 SELECT conv_id, turn, regexp_extract(text, '\b(\d{4}/\d{1,2}/[A-Za-z]/[A-Za-z]/\d{2})\b', 1) AS code, regexp_extract(text, '(?i)\b(?:question|q)\.?\s*#?\s*(\d{1,2})\b', 1) AS n FROM v_chat)""", "v_chat")  # fmt: skip
def reference_detect(spark, d):
    return V.v_chat(spark, d).select("conv_id", "turn", X.find_reference(c("text")).alias("r")).select("conv_id", "turn", "r.code", "r.number")


@query("""SELECT paper_code, string_agg(stem, ',' ORDER BY k) AS stems FROM (
 SELECT paper_code, k, concat(split_part(paper_code,'/',1), '_', CASE split_part(paper_code,'/',3) WHEN 'M' THEN 's' WHEN 'O' THEN 'w' ELSE 'm' END, split_part(paper_code,'/',5), '_qp_',
  CASE k WHEN 0 THEN split_part(paper_code,'/',2) ELSE left(split_part(paper_code,'/',2),1) END) AS stem FROM v_papers, range(2) r(k)) GROUP BY paper_code""", "v_papers")  # fmt: skip
def asset_paths(spark, d):
    return V.v_papers(spark, d).select("paper_code", F.array_join(X.code_stems(c("paper_code")), ",").alias("stems"))


@query("""SELECT s.subject, y.yy, t.season, k.code FROM (VALUES ('9702'),('9709')) s(subject), (SELECT printf('%02d', i) AS yy FROM range(3,26) r(i)) y, (VALUES ('s'),('w'),('m')) t(season),
 (SELECT DISTINCT split_part(paper_code,'/',2) AS code FROM v_papers) k WHERE t.season <> 'm' OR k.code LIKE '%2'""", "v_papers")  # fmt: skip
def download_plan(spark, d):
    row = lambda name, vals: spark.createDataFrame([(v,) for v in vals], f"{name} string")
    codes = V.v_papers(spark, d).select(F.split("paper_code", "/")[1].alias("code")).distinct()
    return audit.sittings(row("subject", ["9702", "9709"]), row("yy", [f"{y:02d}" for y in range(3, 26)]), row("season", "swm"), codes)


@query("""SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1""")
def status_tally(spark, d):
    return audit.tally(V.read(spark, d, "orders"), "o_orderpriority")


@query("""SELECT stem, count(*) AS n FROM (SELECT regexp_extract(stem, '^([^_]+_[^_]+)', 1) AS stem FROM v_stems) GROUP BY 1 HAVING count(*) > 1""", "v_stems")
def stem_clash(spark, d):
    return files.clashes(V.v_stems(spark, d).select(F.regexp_extract("stem", "^([^_]+_[^_]+)", 1).alias("stem")))


# Spans


@query("""SELECT paper, page, ord, translate(t, 'αβγ×', 'abg*') AS back FROM (SELECT paper, page, ord, CASE WHEN pk%2=0 THEN CASE pk%3 WHEN 0 THEN 'α1' WHEN 1 THEN 'β×' ELSE 'χ' END ELSE CASE pk%3 WHEN 0 THEN '?1' WHEN 1 THEN '??' ELSE '?' END END AS t FROM v_spans)""", "v_spans")
def symbol_remap(spark, d):
    a, b, times, chi = (chr(0xF000 + ord(x)) for x in ("a", "b", "\xb4", "c"))
    s = V.v_spans(spark, d).withColumn("raw", F.expr(f"CASE pk % 3 WHEN 0 THEN '{a}1' WHEN 1 THEN '{b}{times}' ELSE '{chi}' END")).withColumn("font", F.expr("CASE WHEN pk % 2 = 0 THEN 'Symbol' ELSE 'Times' END"))
    s = s.withColumn("t", X.symbol_remap(c("raw"), c("font")))
    return s.select("paper", "page", "ord", F.translate(F.translate("t", f"{a}{b}{times}{chi}", "????"), "αβγ×", "abg*").alias("back"))


@query("""WITH r AS (SELECT *, y0 + h/2.0 AS cy FROM v_spans), g AS (SELECT *, CASE WHEN abs(cy - lag(cy) OVER w) > 6 OR lag(cy) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM r WINDOW w AS (PARTITION BY paper, page ORDER BY cy, ord)),
 k AS (SELECT *, sum(new) OVER (PARTITION BY paper, page ORDER BY cy, ord ROWS UNBOUNDED PRECEDING) AS rw FROM g), m AS (SELECT *, max(size) OVER (PARTITION BY paper, page, rw) AS ref, count(*) OVER (PARTITION BY paper, page, rw) AS n FROM k),
 q AS (SELECT paper, page, rw, list_sort(list(cy) FILTER (WHERE size = ref)) AS cs FROM m GROUP BY ALL)
SELECT m.paper, m.page, m.ord, CASE WHEN n > 1 AND size < 0.85*ref AND text = 'n+2' AND cy < cs[len(cs)//2+1] - 1 THEN 'ⁿ⁺²' WHEN n > 1 AND size < 0.85*ref AND text = 'n+2' AND cy > cs[len(cs)//2+1] + 1 THEN 'n₊₂' ELSE text END AS text
FROM m JOIN q USING (paper, page, rw)""", "v_spans")  # fmt: skip
def script_lift(spark, d):
    s = V.v_spans(spark, d).withColumn("y1", c("y0") + c("h"))
    return O.lift_scripts(s, ["paper", "page"]).select("paper", "page", "ord", "text")


@query("""WITH g AS (SELECT *, count(*) FILTER (WHERE trim(text) <> '') OVER (PARTITION BY paper, page ORDER BY ord ROWS UNBOUNDED PRECEDING) AS k FROM v_spans)
SELECT paper, page, min(ord) AS ord, string_agg(text, '' ORDER BY ord) AS text FROM g WHERE k > 0 GROUP BY paper, page, k""", "v_spans")  # fmt: skip
def blank_fold(spark, d):
    return O.fold_blanks(V.v_spans(spark, d), ["paper", "page"]).select("paper", "page", "ord", "text")


@query("""SELECT paper, page, ord, (pk >> 4) & 1 = 1 AS bold, (pk >> 1) & 1 = 1 AS italic FROM v_spans""", "v_spans")
def font_flags(spark, d):
    return V.v_spans(spark, d).select("paper", "page", "ord", X.is_bold(c("pk")).alias("bold"), X.is_italic(c("pk")).alias("italic"))


@query("""SELECT paper, page, count(*) AS kept FROM v_spans WHERE NOT (y0 <= 60 OR y0 + h >= 800 - 55 OR regexp_matches(text, '(?i)turn over')) GROUP BY paper, page""", "v_spans")
def boilerplate_filter(spark, d):
    s = V.v_spans(spark, d)
    return s.where(~segment.is_running_text(c("text"), c("y0"), c("y0") + c("h"), F.lit(800))).groupBy("paper", "page").agg(F.count("*").alias("kept"))


@query(r"""SELECT paper, page, ord, regexp_matches(t, '(?i)For\s+Examiner') AND length(regexp_replace(regexp_replace(regexp_replace(t, '(?i)For\s+Examiner', ' ', 'g'), '\bUse\b|\bTotal\b', ' ', 'g'), '[^A-Za-z]', '', 'g')) < 15 AS label
FROM (SELECT paper, page, ord, CASE WHEN pk%2=0 THEN text ELSE concat(text, ' state the principle') END AS t FROM v_spans)""", "v_spans")  # fmt: skip
def examiner_filter(spark, d):
    t = F.when(c("pk") % 2 == 0, c("text")).otherwise(F.concat("text", F.lit(" state the principle")))
    return V.v_spans(spark, d).select("paper", "page", "ord", X.is_examiner_column(t).alias("label"))


@query("""WITH e AS (SELECT paper, min(page*10000+ord) AS stop FROM v_spans WHERE pk%211=0 GROUP BY paper)
SELECT s.paper, count(*) AS kept FROM v_spans s LEFT JOIN e USING (paper) WHERE stop IS NULL OR page*10000+ord < stop GROUP BY s.paper""", "v_spans")  # fmt: skip
def colophon_cut(spark, d):
    s = V.v_spans(spark, d).withColumn("t", F.when(c("pk") % 211 == 0, "Permission to reproduce items").otherwise(c("text"))).withColumn("at", c("page") * 10000 + c("ord"))
    return segment.before_colophon(s, ["paper"], "at", c("t").rlike(X.COLOPHON)).groupBy("paper").agg(F.count("*").alias("kept"))


@query("""SELECT o_orderkey, CASE l WHEN 'doc_title' THEN 'title' WHEN 'chart' THEN 'image' WHEN 'formula_number' THEN 'formula' WHEN 'plain text' THEN 'text' ELSE 'other' END AS type
FROM (SELECT o_orderkey, CASE o_orderkey%5 WHEN 0 THEN 'doc_title' WHEN 1 THEN 'chart' WHEN 2 THEN 'formula_number' WHEN 3 THEN 'plain text' ELSE 'unheard of' END AS l FROM orders)""")  # fmt: skip
def label_canon(spark, d):
    from quire.sources.adapters import canonical_type

    label = F.expr("CASE o_orderkey % 5 WHEN 0 THEN 'doc_title' WHEN 1 THEN 'chart' WHEN 2 THEN 'formula_number' WHEN 3 THEN 'plain text' ELSE 'unheard of' END")
    return V.read(spark, d, "orders").select("o_orderkey", canonical_type(label).alias("type"))


# Geometry


@query("""SELECT a.paper, a.page, a.region_ord, (a.x1-a.x0)*(a.y1-a.y0) AS area, greatest(0, least(a.x1,b.x1)-greatest(a.x0,b.x0))*greatest(0, least(a.y1,b.y1)-greatest(a.y0,b.y0)) AS shared,
 round_even((a.x1-a.x0)*0.36, 2) AS w_pt, (a.y0+a.y1)/2.0 AS cy FROM v_regions a JOIN v_regions b ON a.paper=b.paper AND a.page=b.page AND b.region_ord=a.region_ord+1""", "v_regions")  # fmt: skip
def box_math(spark, d):
    r = V.v_regions(spark, d).select("paper", "page", "region_ord", G.box("x0", "y0", "x1", "y1").alias("a"))
    nxt = r.select("paper", "page", (c("region_ord") - 1).alias("region_ord"), c("a").alias("b"))
    both = r.join(nxt, ["paper", "page", "region_ord"])
    return both.select("paper", "page", "region_ord", G.area(c("a")).alias("area"), G.intersection(c("a"), c("b")).alias("shared"), F.bround(G.scaled(c("a"), F.lit(0.36))["x1"] - G.scaled(c("a"), F.lit(0.36))["x0"], 2).alias("w_pt"), G.centre_y(c("a")).alias("cy"))


@query("""WITH j AS (SELECT s.paper, s.page, s.ord, r.region_ord, (r.x1-r.x0)*(r.y1-r.y0) AS area FROM v_spans s LEFT JOIN v_regions r ON s.paper=r.paper AND s.page=r.page
 AND 2*greatest(0, least(s.x0+s.w,r.x1)-greatest(s.x0,r.x0))*greatest(0, least(s.y0+s.h,r.y1)-greatest(s.y0,r.y0)) >= s.w*s.h)
SELECT paper, page, ord, arg_min(region_ord, (area, region_ord)) FILTER (WHERE region_ord IS NOT NULL) AS region_ord FROM j GROUP BY paper, page, ord""", "v_spans", "v_regions")  # fmt: skip
def region_assign(spark, d):
    s = V.v_spans(spark, d).select("paper", "page", "ord", "x0", "y0", "x1", "y1")
    return spatial.assign_regions(s, V.v_regions(spark, d), ["paper", "page"]).select("paper", "page", "ord", "region_ord")


@query("""SELECT paper, page, num AS question, greatest(0.0, min(y0)-6.0) AS y0, least(760.0, max(y0+h)+6.0) AS y1 FROM v_spans GROUP BY ALL""", "v_spans")
def crop_rects(spark, d):
    s = V.v_spans(spark, d).select("paper", c("num").alias("question"), "page", "y0", "y1")
    pages = s.select("paper", "page").distinct().withColumns({"width": F.lit(595.0), "height": F.lit(760.0)})
    return assemble.crop_ranges(s, ["paper", "question"], pages).select("paper", "page", "question", c("crop.y0").alias("y0"), c("crop.y1").alias("y1"))


@query("""SELECT paper, page, region_ord, greatest(0.0, x0-2.0) AS x0, greatest(0.0, y0-2.0) AS y0, least(400.0, x1+2.0) AS x1, least(700.0, y1+2.0) AS y1,
 CASE WHEN least(x1-x0-100, y1-y0-80) >= 64 THEN x1-x0-100 ELSE greatest(1, floor((x1-x0-100)*(64.0::DOUBLE/least(x1-x0-100, y1-y0-80))))::BIGINT END AS width FROM v_regions""", "v_regions")  # fmt: skip
def formula_crops(spark, d):
    r = V.v_regions(spark, d)
    crop = G.padded_crop(G.box("x0", "y0", "x1", "y1"), F.lit(400.0), F.lit(700.0))
    up = G.upscaled(c("x1") - c("x0") - 100, c("y1") - c("y0") - 80)
    return r.select("paper", "page", "region_ord", crop.alias("k"), up["width"].cast("long").alias("width")).select("paper", "page", "region_ord", "k.*", "width")


# Order, margins, segmentation


@query("""WITH h AS (SELECT paper, x0 AS margin, count(*) AS n, min(page*10000+ord) AS f FROM v_markers GROUP BY paper, x0)
SELECT paper, arg_max(margin, (n, -f))::DOUBLE AS margin FROM h GROUP BY paper""", "v_markers")  # fmt: skip
def margin_hist(spark, d):
    m = V.v_markers(spark, d).withColumn("at", c("page") * 10000 + c("ord"))
    return segment.first_margin(m, ["paper"], ordinal="at").select("paper", c("margin").cast("double").alias("margin"))


MARGIN = """h AS (SELECT paper, x0 AS margin, count(*) AS n, count(*) FILTER (WHERE num=page) AS same FROM v_markers GROUP BY paper, x0),
 mg AS (SELECT paper, arg_max(margin, (NOT (n >= 3 AND same >= n*0.6), n, -margin)) AS margin FROM h GROUP BY paper)"""
ACCEPT = MARGIN + """, nr AS (SELECT m.* FROM v_markers m JOIN mg USING (paper) WHERE abs(x0-margin) <= 2),
 ac AS (SELECT * FROM (SELECT *, coalesce(max(num) OVER (PARTITION BY paper ORDER BY page, y0, ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS top FROM nr) WHERE num > top)"""


@query(f"WITH {MARGIN} SELECT paper, margin::DOUBLE AS margin FROM mg", "v_markers")
def margin_infer(spark, d):
    return segment.infer_margin(V.v_markers(spark, d), ["paper"]).select("paper", c("margin").cast("double").alias("margin"))


def _accepted(spark, d):
    m = V.v_markers(spark, d)
    return segment.markers(m, segment.infer_margin(m, ["paper"]), ["paper"], ["page", "y0", "ord"])


@query(f"WITH {ACCEPT} SELECT paper, page, ord, num FROM ac", "v_markers")
def marker_accept(spark, d):
    return _accepted(spark, d).select("paper", "page", "ord", "num")


@query(f"""WITH {ACCEPT}, b AS (SELECT paper, num, page*100000.0+(y0-5.0) AS k FROM ac), s AS (SELECT paper, page, ord, page*100000.0+y0 AS k FROM v_spans)
SELECT paper, page, ord, max(num) AS question FROM (SELECT s.paper, s.page, s.ord, b.num, b.k, max(b.k) OVER (PARTITION BY s.paper, s.page, s.ord) AS mk FROM s JOIN b ON s.paper=b.paper AND b.k <= s.k) WHERE k = mk GROUP BY ALL""", "v_markers")  # fmt: skip
def question_members(spark, d):
    return segment.members(V.v_spans(spark, d).select("paper", "page", "ord", "y0"), _accepted(spark, d), ["paper"]).select("paper", "page", "ord", "question")


@query("""WITH g AS (SELECT *, CASE WHEN y0 - lag(y0) OVER w > 9 OR lag(y0) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM v_spans WINDOW w AS (PARTITION BY paper, page ORDER BY y0, ord)),
 r AS (SELECT *, sum(new) OVER (PARTITION BY paper, page ORDER BY y0, ord ROWS UNBOUNDED PRECEDING)::BIGINT AS rw FROM g)
SELECT paper, page, ord, rw AS row, row_number() OVER (PARTITION BY paper, page ORDER BY rw, x0, y0, ord) AS place FROM r""", "v_spans")  # fmt: skip
def row_cluster(spark, d):
    rows = O.cluster_rows(V.v_spans(spark, d), ["paper", "page"], "y0", 9.0)
    return O.reading_rank(rows, ["paper", "page"]).select("paper", "page", "ord", "row", c("place").cast("long").alias("place"))


@query("""WITH t AS (SELECT *, (list_sort(list(h) OVER (PARTITION BY paper, page)))[(count(*) OVER (PARTITION BY paper, page))//2+1]*0.6 AS tol FROM v_spans),
 g AS (SELECT *, CASE WHEN y0 - lag(y0) OVER w > tol OR lag(y0) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM t WINDOW w AS (PARTITION BY paper, page ORDER BY y0, ord)),
 r AS (SELECT *, sum(new) OVER (PARTITION BY paper, page ORDER BY y0, ord ROWS UNBOUNDED PRECEDING) AS rw FROM g)
SELECT paper, page, string_agg(text, '|' ORDER BY x0, y0, ord) FILTER (WHERE rw = 1) AS headers, max(rw)::BIGINT - 1 AS n_rows FROM r GROUP BY paper, page""", "v_spans")  # fmt: skip
def table_grid(spark, d):
    t = V.v_spans(spark, d).select("paper", "page", "ord", "text", c("x0").alias("xc"), c("y0").alias("yc"), c("h").alias("height"))
    return options.grid(t, ["paper", "page"]).select("paper", "page", F.array_join("headers", "|").alias("headers"), F.size("rows").cast("long").alias("n_rows"))


@query("""WITH k AS (SELECT *, pk%2 AS v FROM v_spans), g AS (SELECT *, CASE WHEN v <> lag(v) OVER w OR lag(v) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM k WINDOW w AS (PARTITION BY paper, page ORDER BY ord)),
 r AS (SELECT *, sum(new) OVER (PARTITION BY paper, page ORDER BY ord ROWS UNBOUNDED PRECEDING)::BIGINT AS run FROM g)
SELECT paper, page, run, string_agg(trim(text), ' ' ORDER BY ord) AS line FROM r GROUP BY paper, page, run""", "v_spans")  # fmt: skip
def line_runs(spark, d):
    r = O.runs(V.v_spans(spark, d).withColumn("v", c("pk") % 2), ["paper", "page"], ["ord"], "v")
    return r.groupBy("paper", "page", "run").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", F.trim("text").alias("t")))), lambda s: s["t"]), " ").alias("line"))


@query(r"""WITH s AS (SELECT *, lag(text) OVER w AS pt, lag(y0) OVER w AS py FROM v_spans WINDOW w AS (PARTITION BY paper, page ORDER BY ord))
SELECT paper, page, trim(regexp_replace(string_agg(CASE WHEN pt IS NOT NULL AND right(pt,1) <> ' ' AND left(text,1) <> ' ' AND abs(y0-py) > 8 THEN ' ' || text ELSE text END, '' ORDER BY ord), ' +', ' ', 'g')) AS text FROM s GROUP BY paper, page""", "v_spans")  # fmt: skip
def seam_join(spark, d):
    return O.join_seams(V.v_spans(spark, d), ["paper", "page"], ["ord"])


ASSIGNED = """asg AS (SELECT paper, page, ord, arg_min(region_ord, (area, region_ord)) FILTER (WHERE region_ord IS NOT NULL) AS region_ord FROM (SELECT s.paper, s.page, s.ord, r.region_ord, (r.x1-r.x0)*(r.y1-r.y0) AS area FROM v_spans s LEFT JOIN v_regions r ON s.paper=r.paper AND s.page=r.page
 AND 2*greatest(0, least(s.x0+s.w,r.x1)-greatest(s.x0,r.x0))*greatest(0, least(s.y0+s.h,r.y1)-greatest(s.y0,r.y0)) >= s.w*s.h) GROUP BY paper, page, ord)"""


def _rows_sql(table: str, gap: int) -> str:
    """Rows of text (rw) within a question, and the items' reading order (rk)."""
    new = f"CASE WHEN abs(y0 - lag(y0) OVER w) > {gap} OR page <> lag(page) OVER w OR lag(y0) OVER w IS NULL THEN 1 ELSE 0 END"
    return f"""SELECT *, row_number() OVER (PARTITION BY paper, question ORDER BY rw, x0, y0, ord) AS rk FROM (SELECT *, sum(new) OVER (PARTITION BY paper, question ORDER BY page, y0, ord ROWS UNBOUNDED PRECEDING) AS rw
 FROM (SELECT *, {new} AS new FROM {table} WINDOW w AS (PARTITION BY paper, question ORDER BY page, y0, ord)))"""


def _accept_sql(order: str, margin: str) -> str:
    """The candidates cd at the margin mgn with rising numbers, and the place from which each question counts."""
    return f"""mgn AS ({margin}), nrr AS (SELECT cd.* FROM cd JOIN mgn USING (paper) WHERE abs(x0 - margin) <= 2),
 acc AS (SELECT * FROM (SELECT *, greatest(coalesce(max(num) OVER (PARTITION BY paper ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0) AS top FROM nrr) WHERE num > top)"""


def _inside_sql(table: str, slack: int, key: str) -> str:
    """The rows of a table that fall in a question, by the last boundary before them."""
    return f"""SELECT t.*, f.question FROM {table} t JOIN (SELECT paper, {key}, max(num) AS question FROM (SELECT i.paper, i.{key}, a.num, a.page*100000.0+(a.y0-{slack}) AS k, max(a.page*100000.0+(a.y0-{slack})) OVER (PARTITION BY i.paper, i.{key}) AS mk
 FROM {table} i JOIN acc a ON a.paper=i.paper AND a.page*100000.0+(a.y0-{slack}) <= i.page*100000.0+i.y0) WHERE k = mk GROUP BY paper, {key}) f ON f.paper=t.paper AND f.{key}=t.{key}"""


NUMBER = r"CASE WHEN regexp_matches(trim({0}), '^\d{{1,2}}[.):]?$') THEN regexp_extract(trim({0}), '^(\d{{1,2}})', 1)::INT END"
TYPED = "CASE (region_ord + paper) % 6 WHEN 0 THEN 'text' WHEN 1 THEN 'title' WHEN 2 THEN 'image' WHEN 3 THEN 'formula' WHEN 4 THEN 'other' ELSE 'text' END"
NOTICE_SQL = r"regexp_matches({0}, '(?i)turn over')"
EXAMINER_SQL = r"(regexp_matches({0}, '(?i)For\s+Examiner') AND length(regexp_replace(regexp_replace(regexp_replace({0}, '(?i)For\s+Examiner', ' ', 'g'), '\bUse\b|\bTotal\b', ' ', 'g'), '[^A-Za-z]', '', 'g')) < 15)"


@query(f"""WITH {ASSIGNED}, ct AS (SELECT a.paper, a.page, a.region_ord, list(struct_pack(ord := s.ord, text := s.text, x0 := s.x0, y0 := s.y0) ORDER BY s.ord) AS content FROM asg a JOIN v_spans s USING (paper, page, ord) GROUP BY ALL),
 bl AS (SELECT r.paper, r.page, r.region_ord, r.x0, r.y0, coalesce(content, []) AS content, 0 AS last FROM v_regions r LEFT JOIN ct ON ct.paper=r.paper AND ct.page=r.page AND ct.region_ord=r.region_ord UNION ALL SELECT paper, page, NULL, 0, 0, content, 1 FROM ct WHERE region_ord IS NULL),
 bo AS (SELECT *, row_number() OVER (PARTITION BY paper, page ORDER BY last, y0, x0, region_ord) AS block_ord, CASE WHEN region_ord IS NULL THEN 'other' ELSE {TYPED} END AS type, array_to_string(list_transform(content, lambda c: c.text), ' ') AS joined,
  list_sort(list_transform(content, lambda c: struct_pack(x0 := c.x0, ord := c.ord, text := c.text)))[1] AS lm FROM bl),
 bn AS (SELECT *, CASE WHEN len(content) > 0 AND type IN ('text', 'title', 'other') THEN {NUMBER.format("lm.text")} END AS num FROM bo),
 bq AS (SELECT *, row_number() OVER (PARTITION BY paper ORDER BY page, y0, x0, block_ord) AS seq FROM bn WHERE NOT ({NOTICE_SQL.format("joined")} OR (num IS NULL AND {EXAMINER_SQL.format("joined")}))),
 cd AS (SELECT paper, page, y0, lm.x0 AS x0, num, seq FROM bq WHERE num IS NOT NULL),
 {_accept_sql("seq", "SELECT paper, arg_max(x0, (NOT (n >= 3 AND same >= n*0.6), n, -x0)) AS margin FROM (SELECT paper, x0, count(*) AS n, count(*) FILTER (WHERE num=page) AS same FROM cd GROUP BY paper, x0) GROUP BY paper")},
 ins AS ({_inside_sql("bq", 5, "seq")}),
 sp AS (SELECT paper, question, page, type, seq, s.text AS text, s.x0 AS x0, s.y0 AS y0, seq*1000000 + s.ord AS ord FROM (SELECT paper, question, page, type, seq, unnest(content) AS s FROM ins WHERE type IN ('text', 'title', 'caption', 'formula'))),
 ranked AS ({_rows_sql("sp", 9)}),
 wh AS (SELECT paper, question, string_agg(trim(text), ' ' ORDER BY rk) AS text, count(*) AS n_spans FROM ranked GROUP BY ALL),
 ru AS (SELECT *, sum(fresh) OVER (PARTITION BY paper, question ORDER BY rk ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, CASE WHEN seq <> lag(seq) OVER w OR lag(seq) OVER w IS NULL THEN 1 ELSE 0 END AS fresh FROM ranked WHERE type IN ('text', 'title') WINDOW w AS (PARTITION BY paper, question ORDER BY rk))),
 li AS (SELECT paper, question, count(*) AS n_lines FROM (SELECT paper, question, run, trim(string_agg(trim(text), ' ' ORDER BY rk)) AS line FROM ru GROUP BY ALL) WHERE line <> '' GROUP BY ALL),
 pt AS (SELECT paper, question, max(page) AS end_page, count(*) FILTER (WHERE type IN ('image', 'table', 'formula')) AS n_regions FROM ins GROUP BY ALL)
SELECT acc.paper, num::BIGINT AS question, acc.page, coalesce(end_page, acc.page) AS end_page, coalesce(wh.text, '') AS text, coalesce(n_lines, 0)::INT AS n_lines, coalesce(n_spans, 0)::INT AS n_spans, coalesce(n_regions, 0)::INT AS n_regions
FROM acc LEFT JOIN pt ON pt.paper=acc.paper AND pt.question=num LEFT JOIN wh ON wh.paper=acc.paper AND wh.question=num LEFT JOIN li ON li.paper=acc.paper AND li.question=num""", "v_spans", "v_regions")  # fmt: skip
def parse_blocks(spark, d):
    keys = ["paper", "page"]
    regions = V.v_regions(spark, d).withColumn("type", F.expr(TYPED))
    spans = V.v_spans(spark, d).select(*keys, "ord", "text", "x0", "y0", "x1", "y1")
    blocks = spatial.blocks(written(spatial.assign_regions(spans, regions, keys), "assigned"), regions, keys)
    out = segment.parse_blocks(blocks, keep=written)
    return out.select("paper", "question", "page", "end_page", "text", F.size("lines").alias("n_lines"), F.size("spans").alias("n_spans"), F.size("regions").alias("n_regions"))


@query(f"""WITH bd AS (SELECT *, row_number() OVER (PARTITION BY paper ORDER BY page, ord) AS seq FROM v_spans WHERE NOT (y0 <= 60 OR y0 + h >= 800 - 55 OR {NOTICE_SQL.format("text")})),
 cd AS (SELECT paper, page, y0, x0, num_, seq, num_ AS num FROM (SELECT paper, page, y0, x0, seq, {NUMBER.format("text")} AS num_ FROM bd) WHERE num_ IS NOT NULL),
 {_accept_sql("page, y0, seq", "SELECT paper, arg_max(x0, (n, -f)) AS margin FROM (SELECT paper, x0, count(*) AS n, min(seq) AS f FROM cd GROUP BY paper, x0) GROUP BY paper")},
 ins AS ({_inside_sql("bd", 8, "seq")}),
 ranked AS ({_rows_sql("(SELECT * REPLACE (seq AS ord) FROM ins)", 8)}),
 tx AS (SELECT paper, question, trim(regexp_replace(string_agg(CASE WHEN pt IS NOT NULL AND right(pt,1) <> ' ' AND left(text,1) <> ' ' AND abs(y0-py) > 8 THEN ' ' || text ELSE text END, '' ORDER BY rk), ' +', ' ', 'g')) AS text
  FROM (SELECT *, lag(text) OVER w AS pt, lag(y0) OVER w AS py FROM ranked WINDOW w AS (PARTITION BY paper, question ORDER BY rk)) GROUP BY ALL),
 en AS (SELECT paper, question, max(page) AS end_page FROM ins GROUP BY ALL)
SELECT acc.paper, num::BIGINT AS question, acc.page, coalesce(end_page, acc.page) AS end_page, coalesce(text, '') AS text FROM acc LEFT JOIN en ON en.paper=acc.paper AND en.question=num LEFT JOIN tx ON tx.paper=acc.paper AND tx.question=num""", "v_spans")  # fmt: skip
def group_spans(spark, d):
    return segment.group_spans(V.v_spans(spark, d).select("paper", "page", "ord", "text", "x0", "y0", "y1", F.lit(800).alias("height")))


# Options, assembly


@query("""WITH g AS (SELECT *, CASE WHEN y0 - lag(y0) OVER w > 9 OR lag(y0) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM v_spans WINDOW w AS (PARTITION BY paper, page ORDER BY y0, ord)),
 r AS (SELECT *, sum(new) OVER (PARTITION BY paper, page ORDER BY y0, ord ROWS UNBOUNDED PRECEDING) AS rw FROM g),
 o AS (SELECT *, row_number() OVER (PARTITION BY paper, page ORDER BY rw, x0, y0, ord) AS pl FROM r),
 a AS (SELECT paper, page, min(pl) AS a FROM o WHERE text='A' GROUP BY ALL), b AS (SELECT o.paper, o.page, a, min(pl) AS b FROM o JOIN a USING (paper,page) WHERE text='B' AND pl>a GROUP BY ALL),
 cc AS (SELECT o.paper, o.page, a, b, min(pl) AS c FROM o JOIN b USING (paper,page) WHERE text='C' AND pl>b GROUP BY ALL), dd AS (SELECT o.paper, o.page, a, b, c, min(pl) AS d FROM o JOIN cc USING (paper,page) WHERE text='D' AND pl>c GROUP BY ALL)
SELECT o.paper, o.page, coalesce(string_agg(trim(text), ' ' ORDER BY pl) FILTER (WHERE pl>a AND pl<b AND trim(text)<>''),'') AS opt_a, coalesce(string_agg(trim(text), ' ' ORDER BY pl) FILTER (WHERE pl>d AND trim(text)<>''),'') AS opt_d FROM o JOIN dd USING (paper, page) GROUP BY o.paper, o.page""", "v_spans")  # fmt: skip
def option_split(spark, d):
    s = V.v_spans(spark, d).select("paper", "page", "ord", "text", "x0", "y0")
    out = options.split_options(s.withColumn("p", c("page")), ["paper", "p"]).where(F.size("options") > 0)
    return out.select("paper", c("p").alias("page"), F.get("options", F.lit(0))["text"].alias("opt_a"), F.get("options", F.lit(3))["text"].alias("opt_d"))


@query("""SELECT s.paper, s.page, string_agg(r.x0::VARCHAR, ',' ORDER BY s.pos) AS found FROM (SELECT paper, page, num::BIGINT AS rid, row_number() OVER (PARTITION BY paper, page ORDER BY ord) AS pos FROM v_spans) s
JOIN v_regions r ON r.paper=s.paper AND r.page=s.page AND r.region_ord=s.rid GROUP BY s.paper, s.page""", "v_spans", "v_regions")  # fmt: skip
def asset_join(spark, d):
    refs = V.v_spans(spark, d).groupBy("paper", "page").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "num"))), lambda x: F.concat_ws("_", c("page"), x["num"])).alias("ids"))
    assets = V.v_regions(spark, d).select("paper", F.concat_ws("_", "page", "region_ord").alias("id"), "x0")
    return assemble.resolve(refs, assets, ["paper", "page"], "ids", "id", c("x0"), "found").select("paper", "page", F.array_join("found", ",").alias("found"))


@query("""SELECT q.doc_id, coalesce(r.n, 0) AS n FROM v_questions q LEFT JOIN (SELECT paper, page, count(*) AS n FROM v_regions GROUP BY ALL) r ON r.paper=q.paper_id AND r.page=q.page""", "v_questions", "v_regions")
def crop_default_join(spark, d):
    crops = V.v_regions(spark, d).groupBy(c("paper").alias("paper_id"), "page").agg(F.collect_list("region_ord").alias("crops"))
    q = V.v_questions(spark, d).select("doc_id", "paper_id", "page")
    return assemble.with_default(q, crops, ["paper_id", "page"], "crops").select("doc_id", F.size("crops").cast("long").alias("n"))


@query("""SELECT paper, coalesce(arg_min(code, (page, ord)) FILTER (WHERE code IS NOT NULL), 'unknown') AS code FROM (SELECT paper, page, ord, CASE WHEN pk%17=0 THEN concat('9702/', num, '/M/J/0', num) END AS code FROM v_spans) GROUP BY paper""", "v_spans")
def first_code(spark, d):
    s = V.v_spans(spark, d).withColumn("text", F.expr("CASE WHEN pk % 17 = 0 THEN concat('see 9702/', num, '/M/J/0', num, ' there') ELSE text END"))
    return assemble.first_code(s, ["paper"])


@query("""SELECT paper, page, region_ord, CASE WHEN region_ord%2=0 THEN concat('img', region_ord, '.jpg') ELSE concat('p', page, '_r', region_ord, '.png') END AS file, CASE WHEN region_ord%2=0 THEN 'image/jpeg' ELSE 'image/png' END AS media FROM v_regions""", "v_regions")
def export_names(spark, d):
    images = F.when(c("region_ord") % 2 == 0, F.array(F.concat(F.lit("img"), c("region_ord"), F.lit(".jpg")))).otherwise(F.array().cast("array<string>"))
    r = V.v_regions(spark, d).withColumn("file", assemble.export_name(images, G.region_id(c("page"), c("region_ord"))))
    return r.select("paper", "page", "region_ord", "file", X.media_type(c("file")).alias("media"))


ROW9 = """SELECT *, sum(new) OVER (PARTITION BY paper, question ORDER BY page, y0, f, ord ROWS UNBOUNDED PRECEDING) AS rw FROM (
 SELECT *, CASE WHEN y0 - lag(y0) OVER w > 9 OR page <> lag(page) OVER w OR lag(y0) OVER w IS NULL THEN 1 ELSE 0 END AS new FROM {0} WINDOW w AS (PARTITION BY paper, question ORDER BY page, y0, f, ord))"""
KIND = "CASE (region_ord + r.paper) % 4 WHEN 0 THEN 'image' WHEN 1 THEN 'table' WHEN 2 THEN 'formula' ELSE 'text' END"
BUILT = ACCEPT + f""", bd AS (SELECT paper, num, page*100000.0+(y0-5.0) AS k FROM ac),
 any_ AS (SELECT paper, page, ord AS id, 0 AS f, page*100000.0+y0 AS k FROM v_spans UNION ALL SELECT paper, page, region_ord, 1, page*100000.0+y0 FROM v_regions),
 mem AS (SELECT paper, page, id, f, max(num) AS question FROM (SELECT a.*, b.num, b.k AS bk, max(b.k) OVER (PARTITION BY a.paper, a.page, a.id, a.f) AS mk FROM any_ a JOIN bd b ON a.paper=b.paper AND b.k <= a.k) WHERE bk = mk GROUP BY ALL),
 sp AS (SELECT s.*, m.question, 0 AS f FROM v_spans s JOIN mem m ON m.paper=s.paper AND m.page=s.page AND m.id=s.ord AND m.f=0),
 rg AS (SELECT r.*, m.question, {KIND} AS type FROM v_regions r JOIN mem m ON m.paper=r.paper AND m.page=r.page AND m.id=r.region_ord AND m.f=1 WHERE region_ord%5 <> 4),
 it AS (SELECT paper, question, page, f, ord, text, x0, y0, NULL AS latex, NULL AS bx FROM sp UNION ALL SELECT paper, question, page, 1, page*10+region_ord, '', x0, y0, concat('L', region_ord), concat_ws(' ', x0, y0, x1, y1) FROM rg WHERE type='formula'),
 tx AS (SELECT paper, question, string_agg(trim(text), ' ' ORDER BY rw, x0, y0, ord) AS text FROM ({ROW9.format("sp")}) GROUP BY ALL),
 o AS (SELECT *, row_number() OVER (PARTITION BY paper, question ORDER BY rw, x0, y0, f, ord) AS pl FROM ({ROW9.format("it")})),
 oa AS (SELECT paper, question, min(pl) AS a FROM o WHERE trim(text)='A' GROUP BY ALL), ob AS (SELECT o.paper, o.question, a, min(pl) AS b FROM o JOIN oa USING (paper, question) WHERE trim(text)='B' AND pl>a GROUP BY ALL),
 oc AS (SELECT o.paper, o.question, a, b, min(pl) AS c FROM o JOIN ob USING (paper, question) WHERE trim(text)='C' AND pl>b GROUP BY ALL), od AS (SELECT o.paper, o.question, a, b, c, min(pl) AS d FROM o JOIN oc USING (paper, question) WHERE trim(text)='D' AND pl>c GROUP BY ALL),
 op AS (SELECT paper, question, CASE WHEN pl>d THEN 'D' WHEN pl>c THEN 'C' WHEN pl>b THEN 'B' ELSE 'A' END AS label, text, latex, bx, pl FROM o JOIN od USING (paper, question) WHERE pl>a AND pl NOT IN (b, c, d)),
 ol AS (SELECT od.paper, od.question, l AS label, coalesce(string_agg(trim(text), ' ' ORDER BY pl) FILTER (WHERE trim(text)<>''), '') AS t, coalesce(string_agg(latex, '+' ORDER BY pl), '') AS fs
  FROM od CROSS JOIN (VALUES ('A'),('B'),('C'),('D')) v(l) LEFT JOIN op ON op.paper=od.paper AND op.question=od.question AND op.label=l GROUP BY ALL),
 os AS (SELECT paper, question, string_agg(concat(label, '. ', t, ' (', fs, ')'), '; ' ORDER BY label) AS options FROM ol GROUP BY ALL),
 ga AS (SELECT paper, question, coalesce(string_agg(concat('r', region_ord, '.png'), ',' ORDER BY page*10+region_ord) FILTER (WHERE type='image'), '') AS images,
  coalesce(string_agg(concat('h', region_ord, '/', page), ',' ORDER BY page*10+region_ord) FILTER (WHERE type='table'), '') AS tables, coalesce(string_agg(concat('L', region_ord, '@', x0), ',' ORDER BY page*10+region_ord) FILTER (WHERE type='formula'), '') AS formulas FROM rg GROUP BY ALL),
 cr AS (SELECT paper, question, page, greatest(0.0, min(y0)-6.0) AS y0, least(760.0, max(y1)+6.0) AS y1 FROM (SELECT paper, question, page, y0, y0+h AS y1 FROM sp UNION ALL SELECT paper, question, page, y0, y1 FROM rg) GROUP BY ALL),
 cs AS (SELECT paper, question, string_agg(concat('p', page, '_q', question, ' ', y0::INT, '-', y1::INT), ',' ORDER BY page) AS crops FROM cr GROUP BY ALL)"""


def _built(spark, d):
    """Questions from spans and regions, built end to end."""
    keys = ["paper", "question"]
    accepted = _accepted(spark, d)
    s = segment.members(V.v_spans(spark, d).select("paper", "page", "ord", "text", "x0", "y0", "y1"), accepted, ["paper"])
    r = V.v_regions(spark, d)
    r = segment.members(r.alias("r").withColumn("type", F.expr(KIND)).withColumn("region_id", G.region_id(c("page"), c("region_ord"))), accepted, ["paper"])
    rows = O.reading_rank(O.cluster_rows(s, keys, "y0", 9.0, page="page"), keys)
    text = rows.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", X.strip(c("text")).alias("t")))), lambda x: x["t"]), " ").alias("text"))
    parsed = accepted.select("paper", c("num").cast("long").alias("question"), "page").join(text, keys, "left").withColumn("text", F.coalesce("text", F.lit("")))
    refs = r.where("type <> 'text'").select(*keys, (c("page") * 10 + c("region_ord")).alias("ord"), "region_id", "type", "page", G.box("x0", "y0", "x1", "y1").alias("bbox"))
    # Of every fifth region there is no asset.
    made = V.v_regions(spark, d).where("region_ord % 5 <> 4")
    assets = made.select("paper", G.region_id(c("page"), c("region_ord")).alias("region_id"), F.concat(F.lit("r"), "region_ord", F.lit(".png")).alias("file"), F.concat(F.lit("L"), "region_ord").alias("latex"), F.array(F.concat(F.lit("h"), "region_ord")).alias("headers"), F.array(F.array(c("page").cast("string"))).alias("rows"))
    parts = s.select(*keys, "page", "y0", "y1").unionByName(r.where("region_ord % 5 <> 4").select(*keys, "page", "y0", "y1"))
    pages = parts.select("paper", "page").distinct().withColumns({"width": F.lit(595.0), "height": F.lit(760.0)})
    crops = assemble.crop_ranges(parts, keys, pages).select(*keys, "page", F.format_string("p%d_q%d", "page", "question").alias("file"), c("crop").alias("bbox"))
    codes = assemble.first_code(V.v_spans(spark, d), ["paper"], F.format_string("9702/%d/M/J/25", F.first("paper")))
    return written(assemble.build(parsed, s, refs, assets, crops, codes), "built")


@query(f"""WITH {BUILT} SELECT concat('9702/', ac.paper, '/M/J/25') AS paper, ac.page, ac.num AS question, coalesce(nullif(list_sum(regexp_extract_all(coalesce(tx.text, ''), '\\[(\\d{{1,2}})\\]', 1)::INT[]), NULL), 1)::BIGINT AS marks, sha256(coalesce(tx.text, '')) AS text,
 coalesce(images, '') AS images, coalesce(tables, '') AS tables, coalesce(formulas, '') AS formulas, coalesce(crops, '') AS question_images, coalesce(options, '') AS options
FROM ac LEFT JOIN tx ON tx.paper=ac.paper AND tx.question=ac.num LEFT JOIN ga ON ga.paper=ac.paper AND ga.question=ac.num LEFT JOIN cs ON cs.paper=ac.paper AND cs.question=ac.num LEFT JOIN os ON os.paper=ac.paper AND os.question=ac.num""", "v_markers", "v_regions")  # fmt: skip
def built_questions(spark, d):
    joined = lambda col, entry, sep=",": F.array_join(F.transform(col, entry), sep)
    n = lambda v: v.cast("int").cast("string")
    return _built(spark, d).select(
        "paper", "page", "question", c("marks").cast("long").alias("marks"), F.sha2("text", 256).alias("text"), joined("images", lambda x: x["file"]).alias("images"), joined("tables", lambda x: F.concat(x["headers"][0], F.lit("/"), x["rows"][0][0])).alias("tables"),
        joined("formulas", lambda x: F.concat(x["latex"], F.lit("@"), n(x["bbox"]["x0"]))).alias("formulas"), joined("question_images", lambda x: F.concat(x["file"], F.lit(" "), n(x["bbox"]["y0"]), F.lit("-"), n(x["bbox"]["y1"]))).alias("question_images"),
        joined("options", lambda x: F.concat(x["label"], F.lit(". "), x["text"], F.lit(" ("), F.array_join(x["formulas"]["latex"], "+"), F.lit(")")), "; ").alias("options"),
    )


@query(f"""WITH {BUILT}, lo AS (SELECT rg.paper, rg.question FROM rg WHERE type='formula' AND NOT EXISTS (SELECT 1 FROM op WHERE op.paper=rg.paper AND op.question=rg.question AND op.bx = concat_ws(' ', rg.x0, rg.y0, rg.x1, rg.y1)))
SELECT 'papers' AS part, (SELECT count(DISTINCT paper) FROM ac) AS n UNION ALL SELECT 'questions', (SELECT count(*) FROM ac) UNION ALL SELECT 'images', (SELECT count(*) FROM rg WHERE type='image') UNION ALL SELECT 'tables', (SELECT count(*) FROM rg WHERE type='table')
UNION ALL SELECT 'question_images', (SELECT count(*) FROM cr) UNION ALL SELECT 'options', (SELECT count(*) FROM ol) UNION ALL SELECT 'tied', (SELECT count(*) FROM op WHERE latex IS NOT NULL) UNION ALL SELECT 'loose', (SELECT count(*) FROM lo)""", "v_markers", "v_regions")  # fmt: skip
def built_bank(spark, d):
    """The built questions as rows of a bank; formulas under an option are stored there and not once more under the question."""
    b = B.Bank.of(spark).upsert(_built(spark, d))
    count = lambda name, df: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n")
    out = [count(t, b.t[t]) for t in ("papers", "questions", "images", "tables", "question_images", "options")]
    out += [count("tied", b.t["formulas"].where("label is not null")), count("loose", b.t["formulas"].where("label is null"))]
    return reduce(DataFrame.unionAll, out)


BOX_JSON = "concat('{\"x0\":', {0}.x0::DOUBLE, ',\"y0\":', {0}.y0::DOUBLE, ',\"x1\":', {0}.x1::DOUBLE, ',\"y1\":', {0}.y1::DOUBLE, '}')"


@query(f"""WITH {BUILT}, tj AS (SELECT paper, question, concat('[', string_agg(concat('{{"headers":["h', region_ord, '"],"rows":[["', page, '"]],"bbox":', {BOX_JSON.replace("{0}", "rg")}, '}}'), ',' ORDER BY page*10+region_ord), ']') AS tables FROM rg WHERE type='table' GROUP BY ALL),
 ij AS (SELECT paper, question, concat('[', string_agg(concat('{{"file":"r', region_ord, '.png","bbox":', {BOX_JSON.replace("{0}", "rg")}, '}}'), ',' ORDER BY page*10+region_ord), ']') AS images FROM rg WHERE type='image' GROUP BY ALL),
 lo AS (SELECT paper, question, count(*) AS n FROM rg WHERE type='formula' AND NOT EXISTS (SELECT 1 FROM op WHERE op.paper=rg.paper AND op.question=rg.question AND op.bx = concat_ws(' ', rg.x0, rg.y0, rg.x1, rg.y1)) GROUP BY ALL)
SELECT concat('9702/', ac.paper, '/M/J/25') AS paper, ac.num AS question, coalesce(tables, '[]') AS tables, coalesce(images, '[]') AS images, coalesce(lo.n, 0) AS loose, (SELECT count(*) FROM op WHERE latex IS NOT NULL AND op.paper=ac.paper AND op.question=ac.num) AS tied
FROM ac LEFT JOIN tj ON tj.paper=ac.paper AND tj.question=ac.num LEFT JOIN ij ON ij.paper=ac.paper AND ij.question=ac.num LEFT JOIN lo ON lo.paper=ac.paper AND lo.question=ac.num""", "v_markers", "v_regions")  # fmt: skip
def bank_export(spark, d):
    """Built questions stored, exported as JSON texts, stored again from those and exported once more."""
    first = written(B.Bank.of(spark).upsert(_built(spark, d)).exported(), "export")
    again = B.Bank.of(spark).upsert(B.Bank.imported(first)).export()
    tied = F.aggregate(F.transform("options", lambda o: F.size(o["formulas"])), F.lit(0), lambda a, x: a + x)
    return again.select("paper", "question", X.json_of(c("tables")).alias("tables"), X.json_of(c("images")).alias("images"), F.size("formulas").cast("long").alias("loose"), tied.cast("long").alias("tied"))


# Topics


SCORE = """sc AS (SELECT q.doc_id, l.topic, sum(CASE WHEN contains(lower(q.text), l.keyword) THEN 1 ELSE 0 END)::BIGINT AS score, min(CASE WHEN contains(lower(q.text), l.keyword) THEN l.lex_ord END) AS lex_ord
 FROM v_questions q JOIN v_lexicon l ON l.subject = CASE split_part(q.paper_code,'/',1) WHEN '9702' THEN 'Physics' WHEN '9709' THEN 'Mathematics' ELSE 'Chemistry' END GROUP BY ALL HAVING score > 0)"""


def _lex(spark):
    return topics.lexicon(spark, V.LEX)


def _scored(spark, d):
    q = V.v_questions(spark, d).withColumn("subject", X.subject_of(c("paper_code")))
    return topics.score(q, _lex(spark), ["doc_id"])


@query(f"WITH {SCORE} SELECT doc_id, topic, score, lex_ord FROM sc", "v_questions", "v_lexicon")
def topic_score(spark, d):
    return _scored(spark, d).select("doc_id", "topic", c("score").cast("long").alias("score"), "lex_ord")


@query("""SELECT doc_id, topic, sum(1)::BIGINT AS score FROM documents JOIN v_lexicon l ON contains(lower(text), l.keyword) GROUP BY ALL""", "v_lexicon")
def topic_score_all(spark, d):
    q = V.read(spark, d, "documents").select("doc_id", "text", F.lit(None).cast("string").alias("subject"))
    return topics.score(q, _lex(spark), ["doc_id"]).select("doc_id", "topic", c("score").cast("long").alias("score"))


RANK = SCORE + ", rk AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lex_ord) AS rank FROM sc)"


@query(f"WITH {RANK} SELECT doc_id, topic, rank FROM rk", "v_questions", "v_lexicon")
def topic_rank(spark, d):
    return topics.rank(_scored(spark, d), ["doc_id"]).select("doc_id", "topic", c("rank").cast("long").alias("rank"))


@query(f"WITH {SCORE} SELECT count(DISTINCT doc_id) AS tagged, (SELECT count(*) FROM v_questions) AS questions FROM sc", "v_questions", "v_lexicon")
def tagged_summary(spark, d):
    q = topics.classify(V.v_questions(spark, d), _lex(spark), ["doc_id"], "paper_code")
    return q.agg(F.count_if(F.size("topics") > 0).alias("tagged"), F.count("*").alias("questions"))


# Retrieval


_stored: dict[tuple[str, str], str] = {}


def store(spark, d) -> B.Bank:
    """The stored bank that the retrieval queries run on, with its index; written once for a session and its tables."""
    key = spark.sparkContext.applicationId, d
    if key not in _stored:
        path = scratch_path(spark, "bank")
        derived(spark, d).save(path)
        _stored[key] = path
    return B.Bank.load(spark, _stored[key])


def derived(spark, d) -> B.Bank:
    """A bank of the given tables: documents as questions, topics by their words, options for a fifth."""
    q = V.v_questions(spark, d)
    links = _scored(spark, d).join(q.select("doc_id", "paper_code", "question"), "doc_id").select("paper_code", "question", "topic", "score", "lex_ord")
    opts = q.where("doc_id % 5 = 0").select("paper_code", "question", F.explode(F.array(*map(F.lit, "ABCD"))).alias("label"), F.concat_ws(" ", F.lit("choice"), c("marks")).alias("text"))
    return B.Bank.of(spark, papers=V.v_papers(spark, d), questions=q, question_topics=topics.rank(links.select("*", F.struct("paper_code", "question").alias("k")), ["k"]).drop("k", "score", "lex_ord"), options=opts)


QT = RANK + ", qt AS (SELECT q.*, rk.topic, rk.rank FROM v_questions q JOIN rk USING (doc_id)), tl AS (SELECT doc_id, string_agg(topic, ',' ORDER BY rank) AS topics FROM rk GROUP BY doc_id)"
HEAD = "q.paper_code AS paper, q.question, q.marks, coalesce(tl.topics, '') AS topics"


def _head(df):
    return df.select("paper", "question", "marks", F.array_join("topics", ",").alias("topics"))


@query(f"WITH {QT} SELECT {HEAD} FROM (SELECT * FROM qt WHERE topic = 'Plurals' ORDER BY paper_id, question LIMIT 25) q LEFT JOIN tl USING (doc_id)", "v_questions", "v_lexicon")
def by_topic(spark, d):
    return _head(store(spark, d).by_topic("pLURALS", 25))


@query(f"WITH {QT} SELECT {HEAD} FROM v_questions q LEFT JOIN tl USING (doc_id) WHERE marks BETWEEN 3 AND 5", "v_questions", "v_lexicon")
def by_marks(spark, d):
    return _head(store(spark, d).by_marks(3, 5))


@query(f"WITH {QT} SELECT {HEAD} FROM v_questions q LEFT JOIN tl USING (doc_id) WHERE question = 7 AND paper_id = 3", "v_questions", "v_lexicon")
def by_reference(spark, d):
    code = V.v_papers(spark, d).where("paper_id = 3").first()[0]
    return _head(store(spark, d).by_reference(code, 7))


@query(f"WITH {QT} SELECT {HEAD} FROM v_questions q LEFT JOIN tl USING (doc_id) WHERE doc_id IN (SELECT doc_id FROM rk WHERE topic='Plurals') AND paper_code LIKE '9701/%' AND marks >= 2 AND marks <= 7", "v_questions", "v_lexicon")
def filtered_set(spark, d):
    return _head(store(spark, d).filtered(subject="9701", topic="Plurals", min_marks=2, max_marks=7))


@query("SELECT least(10, count(*)) AS picked, least(10, count(*)) AS different, least(10, count(*)) AS stored FROM v_questions WHERE marks >= 2", "v_questions")
def random_pick(spark, d):
    """The pick itself is random; its rows are counted, and those among them that pass the filter."""
    picked = store(spark, d).random(min_marks=2, count=10, seed=7).select("paper", "question")
    right = V.v_questions(spark, d).where("marks >= 2").select(c("paper_code").alias("paper"), "question")
    n = lambda name, df: df.agg(F.count("*").alias(name)).withColumn("_one", F.lit(1))
    counts = n("picked", picked).join(n("different", picked.distinct()), "_one").join(n("stored", picked.join(right, ["paper", "question"], "left_semi")), "_one")
    return counts.drop("_one")


@query(f"WITH {QT} SELECT {HEAD} FROM (SELECT * FROM v_questions ORDER BY paper_id, question LIMIT 30) q LEFT JOIN tl USING (doc_id)", "v_questions", "v_lexicon")
def list_first(spark, d):
    return _head(store(spark, d).first(30))


@query(f"WITH {SCORE} SELECT DISTINCT topic AS name FROM sc", "v_questions", "v_lexicon")
def topic_names(spark, d):
    return store(spark, d).topic_names()


@query("""WITH o AS (SELECT doc_id, string_agg(concat(l, '. choice ', marks), ';' ORDER BY l) AS opts FROM v_questions, (VALUES ('A'),('B'),('C'),('D')) t(l) WHERE doc_id%5=0 GROUP BY doc_id)
SELECT paper_code AS paper, question, page, marks, text, coalesce(opts, '') AS opts FROM v_questions LEFT JOIN o USING (doc_id)""", "v_questions")  # fmt: skip
def hydrate(spark, d):
    q = store(spark, d).all()
    return q.select("paper", "question", "page", "marks", "text", F.array_join(F.transform("options", lambda o: F.concat_ws(". ", o["label"], o["text"])), ";").alias("opts"))


@query("SELECT paper_code AS paper, question, concat(substr(text,1,220), CASE WHEN length(text) > 220 THEN '…' ELSE '' END) AS card, concat(marks, CASE WHEN marks=1 THEN ' mark' ELSE ' marks' END) AS worth FROM v_questions", "v_questions")
def search_cards(spark, d):
    return V.v_questions(spark, d).select(c("paper_code").alias("paper"), "question", X.card_text(c("text")).alias("card"), X.card_marks(c("marks")).alias("worth"))


@query("SELECT (SELECT count(*) FROM v_papers) AS papers, count(*) AS questions FROM v_questions", "v_questions")
def bank_counts(spark, d):
    return store(spark, d).counts()


# Full-text search

TOK = r"""tk AS (SELECT doc_id, unnest(t) AS term, unnest(range(len(t))) AS pos FROM (SELECT doc_id, regexp_extract_all(strip_accents(lower(text)), '[\p{L}\p{N}]+') AS t FROM documents)),
 dl AS (SELECT doc_id, len(regexp_extract_all(strip_accents(lower(coalesce(text,''))), '[\p{L}\p{N}]+')) AS dl FROM documents), st AS (SELECT count(*) AS n, avg(dl) AS a FROM dl)"""


def _bm25(leaves: list[str], where: str, top: int | None = None) -> str:
    """SQL of BM25 over leaf tables (doc_id, f) given by their SELECTs."""
    ctes = "".join(f", l{k} AS ({s})" for k, s in enumerate(leaves))
    joins = " ".join(f"LEFT JOIN l{k} ON l{k}.doc_id = dl.doc_id" for k in range(len(leaves)))
    total = " + ".join(f"greatest(1e-6, ln((n - (SELECT count(*) FROM l{k}) + 0.5) / ((SELECT count(*) FROM l{k}) + 0.5))) * coalesce(l{k}.f,0) * 2.2 / (coalesce(l{k}.f,0) + 1.2*(0.25 + 0.75*dl/a))" for k in range(len(leaves)))
    end = f" ORDER BY -({total}), paper, question LIMIT {top}" if top else ""
    return f"WITH {TOK}{ctes} SELECT q.paper_code AS paper, q.question, q.marks, round(-({total}), 6) AS score FROM dl JOIN v_questions q ON q.doc_id = dl.doc_id CROSS JOIN st {joins} WHERE {where}{end}"


def _term(t: str) -> str:
    return f"SELECT doc_id, count(*) AS f FROM tk WHERE term = '{t}' GROUP BY doc_id"


def _found(spark, d, text, limit=None):
    return store(spark, d).search(text, limit).select("paper", "question", "marks", F.round("score", 6).alias("score"))


@query(_bm25([_term("the"), _term("th")], "l0.f IS NOT NULL AND l1.f IS NOT NULL"), "v_questions")
def search_terms(spark, d):
    return _found(spark, d, "The TH")


@query(_bm25([_term("the"), _term("license"), _term("der")], "(l0.f IS NOT NULL AND l1.f IS NULL) OR l2.f IS NOT NULL"), "v_questions")
def search_bool(spark, d):
    return _found(spark, d, "the NOT license OR dér")


@query(_bm25(["SELECT a.doc_id, count(*) AS f FROM tk a JOIN tk b ON a.doc_id=b.doc_id AND b.pos=a.pos+1 WHERE a.term='of' AND b.term='the' GROUP BY a.doc_id"], "l0.f IS NOT NULL"), "v_questions")
def search_phrase(spark, d):
    return _found(spark, d, '"of the"')


@query(_bm25(["SELECT doc_id, count(*) AS f FROM tk WHERE starts_with(term, 'lice') GROUP BY doc_id"], "l0.f IS NOT NULL"), "v_questions")
def search_prefix(spark, d):
    return _found(spark, d, "lice*")


@query(_bm25([_term("der"), _term("die")], "l0.f IS NOT NULL AND l1.f IS NOT NULL", 20), "v_questions")
def search_top(spark, d):
    return _found(spark, d, "der die", 20)


# Upsert, merge


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def upsert_latest(spark, d):
    o = V.read(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return merge.latest(o, ["o_custkey"], "o_orderdate", ["o_orderkey"]).drop("o_orderdate")


@query("""SELECT s.question AS question, s.paper_code, CASE WHEN b.doc_id IS NULL THEN s.marks ELSE s.marks + 10 END AS marks FROM v_questions s LEFT JOIN (SELECT * FROM v_questions WHERE doc_id%3=0) b USING (paper_code, question)
WHERE s.doc_id%2=0 UNION ALL SELECT question, paper_code, marks+10 FROM v_questions WHERE doc_id%3=0 AND doc_id%2<>0""", "v_questions")  # fmt: skip
def upsert_bank(spark, d):
    q = V.v_questions(spark, d)
    old = q.where("doc_id % 2 = 0").select("paper_code", "question", "marks", F.lit(0).alias("load_seq"))
    new = q.where("doc_id % 3 = 0").select("paper_code", "question", (c("marks") + 10).alias("marks"), F.lit(1).alias("load_seq"))
    return merge.upsert(old, new, ["paper_code", "question"]).drop("load_seq")


@query("""SELECT source, count(*) AS n FROM (SELECT l_suppkey%4 AS source, lag(l_suppkey%4) OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_suppkey%4, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS b FROM lineitem) WHERE b <> source GROUP BY source""")
def merge_overrides(spark, d):
    rows = V.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (c("l_suppkey") % 4).alias("source"), F.struct("l_partkey", "l_suppkey", "l_extendedprice", "l_quantity").alias("row_seq"))
    return merge.overrides(rows.withColumn("load_seq", c("source")), ["l_orderkey", "l_linenumber"]).groupBy("source").agg(F.count("*").alias("n"))


@query("""WITH f AS (SELECT paper, page, ord, x0%40 AS bbox, num FROM v_spans), o AS (SELECT DISTINCT paper, page, bbox FROM f WHERE ord%3=0)
SELECT paper, page, count(*) FILTER (WHERE ord%3=0) AS tied, count(*) FILTER (WHERE ord%3<>0 AND o.bbox IS NULL) AS loose FROM f LEFT JOIN o USING (paper, page, bbox) GROUP BY paper, page""", "v_spans")  # fmt: skip
def formula_dedupe(spark, d):
    f = V.v_spans(spark, d).select("paper", "page", "ord", (c("x0") % 40).alias("bbox"), c("num").cast("string").alias("latex"))
    out = merge.split_formulas(f.where("ord % 3 = 0").withColumn("label", F.lit("A")), f.where("ord % 3 <> 0"), ["paper", "page"])
    return out.groupBy("paper", "page").agg(F.count_if(c("label").isNotNull()).alias("tied"), F.count_if(c("label").isNull()).alias("loose"))


@query("SELECT p_brand AS name, row_number() OVER (ORDER BY p_brand) AS id FROM (SELECT DISTINCT p_brand FROM part)")
def topic_ids(spark, d):
    known = spark.createDataFrame([], "id long, name string")
    return merge.with_ids(known, V.read(spark, d, "part").select(c("p_brand").alias("name")), "id", "name")


@query("SELECT p_brand AS path, min(p_partkey) AS src FROM part GROUP BY p_brand")
def asset_place(spark, d):
    p = V.read(spark, d, "part").select(c("p_brand").alias("path"), c("p_partkey").alias("priority"))
    return merge.place_assets(p).select("path", c("priority").alias("src"))


# Audit

STORED = """sp AS (SELECT paper_code, paper_id FROM v_papers WHERE paper_id%4<>0), cd AS (SELECT stem, CASE WHEN stem LIKE 'notes%' THEN NULL ELSE
 concat(split_part(stem,'_',1), '/', printf('%02d', split_part(stem,'_',4)::INT), '/', CASE left(split_part(stem,'_',2),1) WHEN 's' THEN 'M/J' WHEN 'w' THEN 'O/N' ELSE 'F/M' END, '/', right(split_part(stem,'_',2),2)) END AS code FROM (SELECT DISTINCT stem FROM v_stems)),
 ma AS (SELECT cd.*, sp.paper_code AS hit FROM cd LEFT JOIN sp ON sp.paper_code = cd.code), orp AS (SELECT paper_code FROM sp WHERE paper_code NOT IN (SELECT hit FROM ma WHERE hit IS NOT NULL)),
 near AS (SELECT stem, count(*) AS k, min(paper_code) AS found FROM ma JOIN orp ON split_part(code,'/',1)=split_part(paper_code,'/',1) AND split_part(code,'/',3)=split_part(paper_code,'/',3) AND split_part(code,'/',5)=split_part(paper_code,'/',5)
  AND left(split_part(paper_code,'/',2),1) = split_part(stem,'_',4) WHERE code IS NOT NULL AND hit IS NULL AND length(split_part(stem,'_',4))=1 GROUP BY stem),
 fa AS (SELECT ma.stem, code, CASE WHEN code IS NULL THEN 'unmappable' WHEN hit IS NOT NULL THEN 'matched' WHEN k=1 THEN 'reconciled' ELSE 'missing' END AS state, CASE WHEN hit IS NOT NULL THEN hit WHEN k=1 THEN found END AS found FROM ma LEFT JOIN near USING (stem))"""


def _fate(spark, d):
    papers = V.v_papers(spark, d).where("paper_id % 4 <> 0")
    q = V.v_questions(spark, d).where("paper_id % 4 <> 0")
    return audit.match(V.v_stems(spark, d), audit.by_code(audit.stored_papers(papers, q)))


@query(f"WITH {STORED} SELECT stem FROM fa WHERE state = 'missing'", "v_stems")
def audit_missing(spark, d):
    return _fate(spark, d).where("state = 'missing'").select("stem")


@query(f"WITH {STORED} SELECT stem, state, found FROM fa", "v_stems")
def audit_reconcile(spark, d):
    return _fate(spark, d).select("stem", "state", "found")


@query(f"WITH {STORED} SELECT paper_code AS key FROM sp WHERE paper_code NOT IN (SELECT found FROM fa WHERE found IS NOT NULL)", "v_stems")
def audit_orphans(spark, d):
    return _report(spark, d).where("category = 'orphan'").select("key")


def _report(spark, d, full_paper=40):
    papers = V.v_papers(spark, d).where("paper_id % 4 <> 0")
    q = V.v_questions(spark, d).where("paper_id % 4 <> 0").withColumn("text", F.when(c("doc_id") % 9 == 0, "  ").when(c("doc_id") % 11 == 0, None).otherwise(c("text")))
    return audit.audit(papers, q, V.v_stems(spark, d), full_paper=full_paper)


@query("SELECT paper_code AS key, count(*)::VARCHAR AS detail FROM v_questions WHERE paper_id%4<>0 AND (doc_id%9=0 OR doc_id%11=0 OR trim(text, ' ')='' OR text IS NULL) GROUP BY paper_code", "v_questions")
def audit_textless(spark, d):
    return _report(spark, d).where("category = 'textless'").select("key", "detail")


@query(f"WITH {STORED}, n AS (SELECT paper_code, count(*) AS n FROM v_questions GROUP BY 1) SELECT found AS key, n::VARCHAR AS detail FROM (SELECT DISTINCT found FROM fa WHERE found IS NOT NULL) JOIN n ON n.paper_code=found WHERE split_part(found,'/',2) LIKE '1%' AND n < 41", "v_stems", "v_questions")
def audit_short(spark, d):
    return _report(spark, d, 41).where("category = 'short'").select("key", "detail")


@query(f"WITH {STORED} SELECT found AS key FROM (SELECT DISTINCT found FROM fa WHERE found IS NOT NULL) WHERE found NOT IN (SELECT paper_code FROM v_questions)", "v_stems", "v_questions")
def audit_empty(spark, d):
    return _report(spark, d).where("category = 'empty'").select("key")


@query("""SELECT paper_code AS key, concat(paper_code, ', ', lower(paper_code)) AS detail FROM v_papers WHERE paper_id%5=0""", "v_papers")
def audit_duplicates(spark, d):
    p = V.v_papers(spark, d)
    both = p.unionByName(p.where("paper_id % 5 = 0").select(F.lower("paper_code").alias("paper_code"), (c("paper_id") + 100_000).alias("paper_id")))
    q = V.v_questions(spark, d)
    return audit.audit(both, q, V.v_stems(spark, d)).where("category = 'duplicate'").select("key", "detail")


@query("""WITH k AS (SELECT coalesce(lang, '-') AS category, doc_id, row_number() OVER (PARTITION BY coalesce(lang, '-') ORDER BY printf('%09d', doc_id)) AS place, count(*) OVER (PARTITION BY coalesce(lang, '-')) AS n FROM documents)
SELECT category, place, printf('%09d', doc_id) AS line FROM k WHERE place <= 20 UNION ALL SELECT category, 21, concat('... and ', max(n) - 20, ' more') FROM k GROUP BY category HAVING max(n) > 20""")  # fmt: skip
def report_lists(spark, d):
    """The lists of a report, cut off after twenty entries."""
    rows = V.read(spark, d, "documents").select(F.coalesce("lang", F.lit("-")).alias("category"), F.format_string("%09d", "doc_id").alias("key"))
    return audit.shown(rows, 20, order=("key",))


PHASES = ("extract_pdf", "layout_detection", "formula_extractor", "build_questions")


@query(f"""WITH p AS (SELECT o_orderkey AS k, min(o_custkey) AS c FROM orders GROUP BY 1), f AS (SELECT k, min(ph) AS ph FROM (SELECT l_orderkey AS k, CASE WHEN l_orderkey%97=0 THEN 2 ELSE l_partkey%40 END AS ph FROM lineitem WHERE l_linenumber > 1) WHERE ph < 4 GROUP BY 1)
SELECT concat('/in/', p.k, '.pdf') AS paper, CASE ph {" ".join(f"WHEN {k} THEN '{n}'" for k, n in enumerate(PHASES))} ELSE 'done' END AS phase FROM p LEFT JOIN f ON f.k = p.k""")  # fmt: skip
def quarantine_phases(spark, d):
    """Papers by the phase that they fell out of, or done: a phase's lines are read, met with what is left of the batch, and its papers dropped."""
    live = V.read(spark, d, "orders").select(F.concat(F.lit("/in/"), "o_orderkey", F.lit(".pdf")).alias("paper")).distinct()
    said = V.read(spark, d, "lineitem").withColumn("ph", F.expr("CASE WHEN l_orderkey % 97 = 0 THEN 2 ELSE l_partkey % 40 END"))

    def lines(k, name):
        # Besides the failures: notes, lines of too few fields, and papers that are not in the batch.
        line = F.expr(f"CASE WHEN l_linenumber = 1 THEN concat('!!! PAPER-FAILED {name} /in/', l_orderkey, '.pdf') ELSE concat('{quarantine.PREFIX}', chr(9), '{name}', chr(9), '/in/', l_orderkey, '.pdf') END")
        own = said.where(f"ph = {k}").select(line.alias("line"))
        other = said.where(f"ph = {k}").select(F.explode(F.array(F.lit("=== phase ==="), F.lit(f"{quarantine.PREFIX}\t{name}\t/elsewhere.pdf"), F.lit(f"{quarantine.PREFIX}\t{name}"))).alias("line"))
        return own.unionByName(other)

    done, failed = quarantine.run_phases(live, [(name, lambda _, k=k, name=name: lines(k, name)) for k, name in enumerate(PHASES)], written)
    return failed.select("paper", "phase").unionByName(done.select("paper", F.lit("done").alias("phase")))


# Listings and batches

FILES = """fl AS (SELECT doc_id, paper_code, concat('f', doc_id, '.png') AS file, concat(split_part(paper_code,'/',1), '_', CASE split_part(paper_code,'/',3) WHEN 'M' THEN 's' WHEN 'O' THEN 'w' ELSE 'm' END, split_part(paper_code,'/',5), '_qp_') AS st, split_part(paper_code,'/',2) AS num FROM v_questions)"""


def _tree(spark, d):
    """Files of questions: in the root, under it by the paper's stem or its short form, beside it, or nowhere; some in two places."""
    q = V.v_questions(spark, d).withColumn("stems", X.code_stems(c("paper_code"))).withColumn("file", F.concat(F.lit("f"), "doc_id", F.lit(".png")))
    first, last = F.element_at("stems", 1), F.element_at("stems", -1)
    at = lambda base, stem: F.concat(F.lit(base), stem, F.lit("/images/"), "file")
    k = c("doc_id") % 6
    places = F.array_compact(F.array(
        F.when(k == 0, F.concat(F.lit("out/"), "file")), F.when(k.isin(0, 1), at("out/", first)), F.when(k.isin(1, 2), at("out/", last)), F.when(k.isin(2, 3), at("", first)), F.when(k.isin(3, 4), at("", last)), F.when(k == 5, F.concat(F.lit("out/other/"), "file")),
    ))
    return q, q.select(F.explode(places).alias("path"))


@query(f"""WITH {FILES} SELECT doc_id, CASE doc_id%6 WHEN 0 THEN concat('out/', file) WHEN 1 THEN concat('out/', st, num, '/images/', file) WHEN 2 THEN concat('out/', st, left(num,1), '/images/', file) WHEN 3 THEN concat(st, num, '/images/', file)
 WHEN 4 THEN concat(st, left(num,1), '/images/', file) END AS path FROM fl""", "v_questions")  # fmt: skip
def asset_locate(spark, d):
    """The place of each question's file, first in priority."""
    q, tree = _tree(spark, d)
    return listing.locate(q.select("doc_id", "paper_code", "file"), tree, "out", "images").select("doc_id", "path")


SOURCES = """ls AS (SELECT concat('s', o_custkey%50) AS source, o_custkey%50 < 10 AS flat, concat('p', o_orderkey) AS dir, o_orderkey%5 AS k, o_orderkey FROM orders)"""


def _sources(spark, d):
    """A listing of fifty output trees, ten of them of a single paper."""
    o = V.read(spark, d, "orders").selectExpr("concat('s', o_custkey % 50) AS source", "o_custkey % 50 < 10 AS flat", "concat('p', o_orderkey) AS dir", "o_orderkey % 5 AS k", "o_orderkey")
    kinds = F.expr("CASE k WHEN 0 THEN 'topics/classified_questions.json' WHEN 1 THEN 'images/a.png' WHEN 2 THEN 'topics/other.json' WHEN 3 THEN 'images' ELSE 'sub/images/a.png' END")
    child = o.select("source", F.concat_ws("/", "dir", kinds).alias("path"))
    own = o.where("flat and k < 2").select("source", kinds.alias("path"))
    return child.unionByName(own).withColumn("size", F.lit(1).cast("long"))


@query(f"""WITH {SOURCES}, fs AS (SELECT DISTINCT source FROM ls WHERE flat AND k < 2) SELECT source, source AS stem, '' AS dir FROM fs UNION ALL SELECT DISTINCT source, dir, dir FROM ls WHERE k < 2 AND source NOT IN (SELECT source FROM fs)""")
def tree_scan(spark, d):
    """The papers of each tree, in either layout."""
    return listing.paper_dirs(_sources(spark, d))


@query(f"""WITH {SOURCES}, pd AS (SELECT source, concat('x', o_orderkey) AS stem FROM ls WHERE source < 's3' AND k = 2) SELECT source, stem FROM pd UNION ALL SELECT DISTINCT source, dir FROM ls WHERE source NOT IN (SELECT source FROM pd)
UNION ALL SELECT DISTINCT source, CASE k WHEN 0 THEN 'topics' ELSE 'images' END FROM ls WHERE flat AND k < 2 AND source NOT IN (SELECT source FROM pd)""")  # fmt: skip
def expected_scan(spark, d):
    """Stems of the PDFs of each tree, or its folders."""
    tree = _sources(spark, d)
    pdf = V.read(spark, d, "orders").selectExpr("concat('s', o_custkey % 50) AS source", "concat('in/deep/x', o_orderkey, '.pdf') AS path", "1L AS size", "o_orderkey % 5 AS k").where("source < 's3' and k = 2").drop("k")
    return listing.expected_stems(tree.unionByName(pdf))


@query("""WITH sc AS (SELECT paper_code, paper_id, CASE paper_id%3 WHEN 0 THEN paper_code ELSE concat(split_part(paper_code,'/',1), '/0', paper_code[6:]) END AS code FROM v_papers WHERE paper_id%11<>0)
SELECT DISTINCT stem, code AS paper_code FROM v_stems s LEFT JOIN sc ON CASE WHEN stem LIKE 'notes%' THEN NULL ELSE concat(split_part(stem,'_',1), '/', split_part(stem,'_',4), '/', CASE left(split_part(stem,'_',2),1) WHEN 's' THEN 'M/J' WHEN 'w' THEN 'O/N' ELSE 'F/M' END, '/', right(split_part(stem,'_',2),2)) END = sc.paper_code""", "v_stems")  # fmt: skip
def stem_fallback(spark, d):
    """The stored code of each stem, though most are stored with zeros in front and some in two spellings."""
    p = V.v_papers(spark, d).where("paper_id % 11 <> 0")
    padded = F.regexp_replace("paper_code", "^([0-9]{4})/", "$1/0")
    codes = p.select(F.when(c("paper_id") % 3 == 0, c("paper_code")).otherwise(padded).alias("paper_code"), c("paper_id").alias("ord"))
    again = p.where("paper_id % 3 <> 0").select("paper_code", (c("paper_id") + 1000).alias("ord"))
    return listing.stored_code(V.v_stems(spark, d), codes.unionByName(again))


@query("""WITH s AS (SELECT o_orderkey, CASE WHEN o_custkey%8 < 5 THEN 64 ELSE 32*(o_custkey%8) END AS height, CASE WHEN o_custkey%8 < 5 THEN 96 ELSE 0 END AS width FROM orders), r AS (SELECT *, row_number() OVER (PARTITION BY height, width ORDER BY o_orderkey) - 1 AS k FROM s)
SELECT o_orderkey, height, width, k//16 AS batch, k%16 AS place FROM r""")  # fmt: skip
def shape_batches(spark, d):
    """Crops in batches of one shape, most of them of the same; o_orderkey is the order in which they came."""
    crops = V.read(spark, d, "orders").selectExpr("o_orderkey", "CASE WHEN o_custkey % 8 < 5 THEN 64 ELSE 32 * (o_custkey % 8) END AS height", "CASE WHEN o_custkey % 8 < 5 THEN 96 ELSE 0 END AS width")
    return adapters.shape_batches(crops, ["height", "width"], "o_orderkey", 16, 1000)


# Tutor


def _contexts(spark, d):
    q = store(spark, d).all()
    none = F.array().cast("array<struct<latex:string>>")
    text = tutor.context_text(c("paper"), c("question"), c("marks"), c("text"), c("options"), none, F.array().cast("array<struct<headers:array<string>,rows:array<array<string>>>>"))
    return q.select(c("paper").alias("code"), c("question").cast("int").alias("number"), text.alias("context"), "text")


CONTEXT = "cx AS (SELECT doc_id, paper_code, question, concat('Paper ', paper_code, ', Question ', question, ' (', marks, ' mark(s)):', chr(10), coalesce(text,''), CASE WHEN doc_id%5=0 THEN concat(chr(10), 'Options:', chr(10), '  A. choice ', marks, chr(10), '  B. choice ', marks, chr(10), '  C. choice ', marks, chr(10), '  D. choice ', marks) ELSE '' END) AS context FROM v_questions)"


@query(f"WITH {CONTEXT} SELECT paper_code AS code, question AS number, sha256(context) AS digest FROM cx", "v_questions")
def context_text(spark, d):
    return _contexts(spark, d).select("code", c("number").cast("long").alias("number"), F.sha2("context", 256).alias("digest"))


@query(f"""WITH {CONTEXT}, la AS (SELECT conv_id, arg_max(role, turn) AS role, arg_max(text, turn) AS text FROM v_chat GROUP BY conv_id),
 rf AS (SELECT *, CASE WHEN role='user' THEN regexp_extract(text, '\\b(\\d{{4}}/\\d{{1,2}}/[A-Za-z]/[A-Za-z]/\\d{{2}})\\b', 1) ELSE '' END AS code, regexp_extract(text, '(?i)\\b(?:question|q)\\.?\\s*#?\\s*(\\d{{1,2}})\\b', 1) AS n FROM la)
SELECT conv_id, sha256(CASE WHEN code='' OR n='' THEN text ELSE concat(coalesce(context, concat('(No stored question ', n::INT, ' in paper ', upper(code), ')')), chr(10), chr(10), text) END) AS digest
FROM rf LEFT JOIN cx ON cx.paper_code = upper(code) AND cx.question = try_cast(n AS INT)""", "v_questions", "v_chat")  # fmt: skip
def chat_splice(spark, d):
    return tutor.splice(tutor.last_turns(V.v_chat(spark, d)), _contexts(spark, d)).select("conv_id", F.sha2("message", 256).alias("digest"))


@query(f"WITH {CONTEXT} SELECT paper_code AS code, question AS number, sha256(concat(context, chr(10), chr(10), 'Marking points:', chr(10), '- first', chr(10), '- second', chr(10), chr(10), 'Student''s answer:', chr(10), 'answer ', question, chr(10), chr(10), 'Grade the answer against each marking point independently.')) AS digest FROM cx", "v_questions")
def grade_prompts(spark, d):
    x = _contexts(spark, d)
    p = tutor.grade_prompt(c("context"), F.concat(F.lit("answer "), c("number").cast("string")), F.array(F.lit("first"), F.lit("second")))
    return x.select("code", c("number").cast("long").alias("number"), F.sha2(p, 256).alias("digest"))


@query("SELECT conv_id, arg_max(role, turn) AS role, max(turn) AS turn FROM conversations GROUP BY conv_id")
def last_turn(spark, d):
    return tutor.last_turns(V.read(spark, d, "conversations")).select("conv_id", "role", "turn")


@query("SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def failed_removal(spark, d):
    live = V.read(spark, d, "orders").select("o_orderkey", c("o_custkey").alias("paper"))
    bad = V.read(spark, d, "customer").where("c_acctbal < 0").select(c("c_custkey").alias("paper"))
    return audit.papers_failed(live, bad).select("o_orderkey")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classify the questions, store them, and fetch those of some marks with their topics and options."""
    return store(spark, sf_dir).by_marks(2, 6)
