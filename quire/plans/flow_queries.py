"""Queries of text units over candidates derived from the documents' lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import text_flow as X
from quire.plans import derived as D
from quire.plans.functions_queries import query

_C = D.OBSERVATIONS + """, c AS (SELECT doc_id, ord, page, 'o' || ord AS observation_id, CASE WHEN n % 5 = 0 THEN 'heading' ELSE 'paragraph' END AS candidate_type, 'lane' || n % 2 AS lane, x0 + CASE WHEN n % 2 = 1 THEN 120 ELSE 0 END AS x0, y0, x1 - CASE WHEN n % 2 = 1 THEN 150 ELSE 0 END AS x1, y1, line, n FROM o),
rn AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY ord) AS run FROM (SELECT *, CASE WHEN lag(page) OVER w = page AND lag(candidate_type) OVER w = candidate_type AND lag(lane) OVER w = lane THEN 0 ELSE 1 END AS new FROM c WINDOW w AS (PARTITION BY doc_id ORDER BY ord)))"""


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.observations(spark, sf_dir).selectExpr(
        "doc_id", "ord", "page", "concat('o', ord) AS observation_id", "if(n % 5 = 0, 'heading', 'paragraph') AS candidate_type", "concat('lane', n % 2) AS lane", "x0 + if(n % 2 = 1, 120, 0) AS x0", "y0", "x1 - if(n % 2 = 1, 150, 0) AS x1", "y1", "line", "n",
        "100D AS body_left", "600D AS body_right", "500D AS body_width",
    )


_KEYS = ["page", "candidate_type", "lane"]


@query(f"""WITH {_C}, b AS (SELECT *, lag(y1) OVER w AS py, lag(page) OVER w AS pp, lead(y0) OVER w AS fy, lead(page) OVER w AS fp FROM rn WINDOW w AS (PARTITION BY doc_id ORDER BY ord)) SELECT doc_id, run::BIGINT AS run, count(*) AS n, min(ord) AS first, max(ord) AS last, first(py ORDER BY ord) AS previous_y1, last(fy ORDER BY ord) AS following_y0 FROM b GROUP BY doc_id, run""")
def candidate_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs with the rows around them."""
    r = X.same_page_runs(_candidates(spark, sf_dir), _KEYS)
    return r.groupBy("doc_id", "run").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first"), F.max("ord").alias("last"), F.first("previous.y1").alias("previous_y1"), F.first("following.y0").alias("following_y0"))


_SET = _C + """, b AS (SELECT *, lag(y1) OVER w AS py, lag(page) OVER w AS pp, lead(y0) OVER w AS fy, lead(page) OVER w AS fp, row_number() OVER (PARTITION BY doc_id, run ORDER BY ord) AS i, count(*) OVER (PARTITION BY doc_id, run) AS k FROM rn WINDOW w AS (PARTITION BY doc_id ORDER BY ord)),
e AS (SELECT doc_id, run, arg_min(pp, ord) AS pp, arg_min(py, ord) AS py, arg_max(fp, ord) AS fp, arg_max(fy, ord) AS fy, arg_min(y0, ord) AS top, arg_max(y1, ord) AS foot, any_value(page) AS page FROM (SELECT *, coalesce(pp, -1) AS ppx FROM b) GROUP BY doc_id, run),
e0 AS (SELECT doc_id, run, min(ord) AS a, max(ord) AS z FROM b GROUP BY ALL), e1 AS (SELECT e0.doc_id, e0.run, (f.pp IS NULL OR f.pp <> f.page OR coalesce(f.y0 - f.py >= 40, false)) AS sb, (l.fp IS NULL OR l.fp <> l.page OR coalesce(l.fy - l.y1 >= 40, false)) AS sa FROM e0 JOIN b f ON f.doc_id = e0.doc_id AND f.ord = e0.a JOIN b l ON l.doc_id = e0.doc_id AND l.ord = e0.z),
g AS (SELECT b.*, sb, sa, x0 - 100 AS li, 600 - x1 AS ri, x1 - x0 AS w, y1 - y0 AS h FROM b JOIN e1 USING (doc_id, run)),
s AS (SELECT *, w <= 360 AS s1, li >= 60 AND ri >= 40 AS s2, w <= 480 AND li >= 25 AND ri >= -15 AS s3, w >= 470 AND w <= 490 AND li >= 24 AND ri >= -15 AND h >= 80 AS s4, w <= 488 AND li >= 20.4 AND ri >= -24 AS s5, abs(ri) <= 36 AND w <= 275 AND x0 >= 300 AS s6 FROM g),
t AS (SELECT *, ((s6 OR (s1 AND s2)) AND (sb OR sa)) OR (((s3 AND NOT s2) OR (s4 AND NOT s2 AND NOT s3) OR s5) AND sb AND sa) AS alone, ((s6 OR (s1 AND s2)) AND ((sb AND i = 1) OR (sa AND i = k))) OR (((s3 AND NOT s2) OR (s4 AND NOT s2 AND NOT s3) OR s5) AND sb AND i = 1 AND sa AND i = k) AS own FROM s),
u AS (SELECT *, bool_and(alone) OVER (PARTITION BY doc_id, run) AS display FROM t)"""


@query(f"""WITH {_SET} SELECT doc_id, ord, sb AS separated_before, sa AS separated_after, CASE WHEN candidate_type = 'paragraph' AND display THEN 'display_block' ELSE candidate_type END AS classified_type, candidate_type = 'paragraph' AND display AND NOT own AS is_by_run FROM u""")
def classified_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs set off by their outer gaps, at a display gap of 40."""
    r = X.classify_runs(X.same_page_runs(_candidates(spark, sf_dir), _KEYS), F.lit(40.0))
    return r.select("doc_id", "ord", "separated_before", "separated_after", "classified_type", F.coalesce(F.array_contains("signals", "set_off_run_outer_display_gap"), F.lit(False)).alias("is_by_run"))


@query(f"""WITH {D.LINES}, r AS (SELECT doc_id, ord AS run, n % 3 < 2 AS f, n % 2 = 0 AS a, n % 5 < 3 AS b FROM l), s AS (SELECT *, CASE WHEN coalesce(lag(f) OVER (PARTITION BY doc_id ORDER BY run), false) THEN 0 ELSE 1 END AS new FROM r), g AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY run) AS chain FROM s)
SELECT doc_id, chain::BIGINT AS chain, min(run) AS first_run, max(run) AS last_run, count(*) AS n_runs, arg_min(a, run) AND arg_max(b, run) AS is_display FROM g GROUP BY doc_id, chain HAVING count(*) > 1""")
def display_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W5."""
    r = D.lines(spark, sf_dir).selectExpr("doc_id", "ord AS run", "n % 3 < 2 AS fits_next", "n % 2 = 0 AS separated_before", "n % 5 < 3 AS separated_after")
    return X.chains(r)


@query(f"""WITH {_C}, k AS (SELECT *, CASE n % 4 WHEN 0 THEN 'heading' WHEN 3 THEN 'paragraph' ELSE 'display_block' END AS kind, 'r' || ord // 5 AS run_id, 'f' || n % 6 // 3 AS form, n % 17 = 0 AS prot, CASE WHEN n % 13 = 0 THEN 'uncertain' ELSE 'resolved' END AS status FROM c), m AS (SELECT *, count(*) OVER (PARTITION BY doc_id, run_id) AS size FROM k),
j AS (SELECT *, CASE WHEN coalesce(lag(page) OVER w = page AND lag(run_id) OVER w = run_id AND lag(kind) OVER w = kind AND status = 'resolved' AND lag(status) OVER w = 'resolved' AND NOT prot AND NOT lag(prot) OVER w AND ((kind = 'display_block' AND lag(form) OVER w = form) OR (kind = 'heading' AND size > 1)), false) THEN 0 ELSE 1 END AS new FROM m WINDOW w AS (PARTITION BY doc_id ORDER BY ord)),
u AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY ord) AS unit FROM j)
SELECT doc_id, 'tu' || lpad(unit::VARCHAR, 6, '0') AS unit_id, any_value(kind) AS unit_type, coalesce(string_agg(line, chr(10) ORDER BY ord) FILTER (line <> ''), '') AS text, min(page) AS page, string_agg(observation_id, ',' ORDER BY ord) AS observation_ids, min(x0) AS x0 FROM u GROUP BY doc_id, unit""")
def text_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R5, R11, X11."""
    c = _candidates(spark, sf_dir).selectExpr("doc_id", "ord", "page", "observation_id", "line AS text", "'body_text' AS role_hint", "x0", "y0", "x1", "y1", "CASE n % 4 WHEN 0 THEN 'heading' WHEN 3 THEN 'paragraph' ELSE 'display_block' END AS classified_type", "concat('r', ord div 5) AS run_id", "concat('f', n % 6 div 3) AS layout_form", "'left' AS alignment", "n % 17 = 0 AS is_protected", "if(n % 13 = 0, 'uncertain', 'resolved') AS status")
    return X.units(c).select("doc_id", "unit_id", "unit_type", "text", "page", F.array_join("observation_ids", ",").alias("observation_ids"), F.col("bbox")[0].alias("x0"))
