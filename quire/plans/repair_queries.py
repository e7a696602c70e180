"""Queries of repairs and of the evidence of model passes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import repairs as R
from quire.plans import derived as D
from quire.plans.functions_queries import query


@query(f"""WITH {D.OBSERVATIONS}, b AS (SELECT doc_id, ord, (['table', 'table_continuation', 'page_number', 'paragraph', 'table_continuation'])[n % 5 + 1] AS type, CASE WHEN n % 13 > 0 THEN page END AS page FROM o), c AS (SELECT *, sum(CASE WHEN type = 'table_continuation' THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY ord) AS g FROM b WHERE type <> 'page_number'),
d AS (SELECT doc_id, g, arg_min(type, ord) AS type, min(ord) AS first, count(*) AS n FROM c GROUP BY ALL), p AS (SELECT doc_id, g, string_agg(page, ',' ORDER BY pos) AS pages FROM (SELECT doc_id, g, page, min(ord) AS pos FROM c WHERE page IS NOT NULL GROUP BY ALL) GROUP BY ALL)
SELECT d.doc_id, 'b' || first AS block_id, coalesce(pages, '') AS pages, n > 1 AS is_continued FROM d LEFT JOIN p USING (doc_id, g) WHERE type = 'table'""")
def table_source_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W24."""
    b = D.observations(spark, sf_dir).selectExpr("doc_id", "ord", "concat('b', ord) AS block_id", "get(array('table', 'table_continuation', 'page_number', 'paragraph', 'table_continuation'), cast(n % 5 AS int)) AS type", "if(n % 13 > 0, page, NULL) AS page")
    return R.table_pages(b).withColumn("pages", F.array_join(F.transform("pages", lambda p: p.cast("string")), ","))


@query(f"""WITH {D.OBSERVATIONS}, s AS (SELECT doc_id, ord // 3 AS page, ord, n FROM o), nt AS (SELECT *, row_number() OVER w AS at, count(*) OVER (PARTITION BY doc_id, page) AS k, CASE WHEN n % 2 = 0 THEN '' ELSE (n % 4)::VARCHAR END AS marker FROM s WINDOW w AS (PARTITION BY doc_id, page ORDER BY ord)),
mk AS (SELECT *, row_number() OVER w AS at, count(*) OVER (PARTITION BY doc_id, page) AS m, (n % 4 + CASE WHEN n % 11 = 3 THEN 1 ELSE 0 END)::VARCHAR AS given FROM s WHERE n % 7 > 0 WINDOW w AS (PARTITION BY doc_id, page ORDER BY ord)), j AS (SELECT nt.doc_id, nt.page, nt.ord, nt.marker, mk.given FROM nt JOIN mk ON mk.doc_id = nt.doc_id AND mk.page = nt.page AND mk.at = nt.at WHERE k = m),
q AS (SELECT *, bool_or(marker <> '' AND marker <> given) OVER (PARTITION BY doc_id, page) AS bad FROM j) SELECT doc_id, ord AS note_id, given AS marker FROM q WHERE NOT bad AND marker = ''""")
def recovered_note_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R35."""
    s = D.observations(spark, sf_dir).selectExpr("doc_id", "ord div 3 AS page", "ord", "n", "ord AS note_id")
    m = s.where("n % 7 > 0").selectExpr("doc_id", "page", "ord", "cast(n % 4 + if(n % 11 = 3, 1, 0) AS string) AS marker")
    return R.recovered_markers(s.withColumn("marker", F.expr("if(n % 2 = 0, '', cast(n % 4 AS string))")), m)


@query(f"""WITH {D.OBSERVATIONS}, r AS (SELECT doc_id, ord // 4 AS group_no, ord, page, CASE WHEN n % 3 = 0 THEN '' ELSE 't' || n END AS text, CASE WHEN n % 5 > 0 THEN x0 END AS x0, CASE WHEN n % 5 > 0 THEN y1 END AS y1 FROM o) SELECT doc_id, group_no, coalesce(string_agg(text, chr(10) ORDER BY ord) FILTER (text <> ''), '') AS text, arg_min(page, ord) AS page, count(DISTINCT page)::INT AS n_pages, min(x0) AS x0, max(y1) AS y1,
 CASE WHEN count(*) FILTER (text <> '' AND x0 IS NOT NULL) > 1 THEN count(*) FILTER (text <> '' AND x0 IS NOT NULL) ELSE 0 END::INT AS n_spans FROM r GROUP BY doc_id, group_no""")
def made_display_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P19."""
    box = [f"if(n % 5 > 0, {c}, NULL) AS {c}" for c in ("x0", "y0", "x1", "y1")]
    raw = D.observations(spark, sf_dir).selectExpr("doc_id", "ord div 4 AS group_no", "ord", "page", "if(n % 3 = 0, '', concat('t', n)) AS text", *box)
    return R.display_blocks(raw).select("doc_id", "group_no", "text", "page", F.size("pages").alias("n_pages"), F.col("bbox")[0].alias("x0"), F.col("bbox")[3].alias("y1"), "n_spans")


@query(f"""WITH {D.LINES}, f AS (SELECT doc_id, ord, ord // 5 AS page, 'i' || n % 2 || '.png' AS image_name, CASE WHEN n % 4 > 0 THEN n % 4 * 50 ELSE 0 END::INT AS dpi, CASE WHEN n % 3 > 0 THEN 'r' || n END AS ref FROM l WHERE n % 6 > 0) SELECT doc_id, page, image_name, arg_max(dpi, ord) FILTER (dpi > 0) AS dpi, arg_max(ref, ord) FILTER (ref IS NOT NULL) AS first_ref FROM f GROUP BY ALL""")
def cached_model_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S25."""
    f = D.lines(spark, sf_dir).selectExpr("doc_id", "ord", "ord div 5 AS page", "concat('/a/', ord, '/i', n % 2, '.png') AS image", "cast(if(n % 4 > 0, n % 4 * 50, 0) AS int) AS dpi", "if(n % 3 > 0, array(concat('r', n)), array()) AS body_refs", "array('x') AS footnote_defs", "if(n % 6 > 0, 3, 2) AS prompt_version")
    return R.cached_evidence(f, 3).select("doc_id", "page", "image_name", "dpi", F.col("body_refs")[0].alias("first_ref"))


@query(f"WITH {D.LINES} SELECT doc_id, count(*) AS pages, count(*) FILTER (n % 3 = 0) AS cache_hits, count(*) - count(*) FILTER (n % 3 = 0) AS cache_misses, sum(n % 4)::BIGINT AS model_calls, round_even(sum(n % 8 / 8.0), 6)::DOUBLE AS total_page_seconds, round_even(sum(n % 8 / 8.0) / count(*), 6)::DOUBLE AS avg_page_seconds FROM l GROUP BY doc_id")
def model_pass_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A20, K11."""
    return R.pass_summary(D.lines(spark, sf_dir).selectExpr("doc_id", "n % 3 = 0 AS cache_hit", "n % 4 AS model_calls", "n % 8 / 8D AS seconds"))
