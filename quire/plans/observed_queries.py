"""Queries of observations and what is read off them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import observed as X
from quire.plans import derived as D
from quire.plans.functions_queries import query
from quire.plans.raw_queries import _OKINDS, _RAW, _ROLES, _raw


@query(f"""WITH {_RAW}, ow AS (SELECT doc_id, page, ord AS idx, {_OKINDS}[n % 9 + 1] AS kind, {_ROLES}[n % 9 + 1] AS role_hint, 't' || n % 20 AS text, x0, y0, x1, y1, 0 AS late FROM r), ti AS (SELECT doc_id, page, ord AS idx, 't' || (n % 20 + CASE WHEN n % 3 = 0 THEN 1 ELSE 0 END) AS text, CASE WHEN n % 5 = 0 THEN x0 + 1 ELSE x0 END AS x0, y0, x1, y1 FROM r WHERE n % 2 = 0),
nw AS (SELECT * FROM ti WHERE NOT EXISTS (SELECT 1 FROM ow WHERE ow.doc_id = ti.doc_id AND ow.page = ti.page AND ow.role_hint = 'title_text' AND ow.text = ti.text) AND NOT EXISTS (SELECT 1 FROM ow WHERE ow.doc_id = ti.doc_id AND ow.page = ti.page AND ow.text = ti.text AND ow.x0 = ti.x0 AND ow.y0 = ti.y0 AND ow.x1 = ti.x1 AND ow.y1 = ti.y1) QUALIFY row_number() OVER (PARTITION BY doc_id, page, text ORDER BY idx) = 1),
al AS (SELECT doc_id, page, idx, kind, role_hint, text, late FROM ow UNION ALL SELECT doc_id, page, idx, 'text_region', 'title_text', text, 1 FROM nw) SELECT doc_id, 'obs' || lpad((row_number() OVER (PARTITION BY doc_id ORDER BY late, page, idx))::VARCHAR, 6, '0') AS observation_id, page, kind, role_hint, text FROM al""")
def observed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S26, P5, U7."""
    raw = _raw(spark, sf_dir).withColumn("text", F.concat(F.lit("t"), F.col("n") % 20))
    titles = raw.where("n % 2 = 0").selectExpr("doc_id", "page", "index", "concat('t', n % 20 + if(n % 3 = 0, 1, 0)) AS text", "if(n % 5 = 0, x0 + 1, x0) AS x0", "y0", "x1", "y1")
    return X.observe(raw, titles).select("doc_id", "observation_id", "page", "kind", "role_hint", "text")


@query(f"""WITH {D.OBSERVATIONS}, s AS (SELECT doc_id, ord, page, 'o' || lpad(ord::VARCHAR, 6, '0') AS id, CASE WHEN n % 2 = 0 THEN 'title_text' ELSE 'body_text' END AS hint, ord // 3 AS ro, n % 3 = 0 AS prot, y0, x0 FROM o), i AS (SELECT *, row_number() OVER w AS i, CASE WHEN hint = 'title_text' AND lag(hint) OVER w = 'title_text' AND lag(page) OVER w = page AND lag(ro) OVER w = ro THEN 0 ELSE 1 END AS new FROM s WINDOW w AS (PARTITION BY doc_id ORDER BY page, ro, y0, x0, id)),
g AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM i) SELECT doc_id, ord, row_number() OVER (PARTITION BY doc_id ORDER BY run, CASE WHEN hint = 'title_text' AND prot THEN 0 ELSE 1 END, i) AS place FROM g""")
def protected_reading_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2."""
    o = D.observations(spark, sf_dir).selectExpr("doc_id", "ord", "page", "format_string('o%06d', ord) AS observation_id", "if(n % 2 = 0, 'title_text', 'body_text') AS role_hint", "ord div 3 AS reading_order", "n % 3 = 0 AS is_protected", "y0", "x0")
    return X.protected_order(o).select("doc_id", "ord", F.col("place").cast("long").alias("place"))


@query(f"""WITH {D.OBSERVATIONS}, s AS (SELECT doc_id, page, ord, kind, CASE n % 3 WHEN 0 THEN 'title_text' WHEN 1 THEN 'body_text' ELSE 'toc_text' END AS hint, 'l' || n AS t FROM o) SELECT doc_id, page, coalesce(string_agg(t, chr(10) ORDER BY ord) FILTER (kind = 'text_region'), '') AS text, coalesce(string_agg(t, chr(10) ORDER BY ord) FILTER (kind = 'text_region' AND hint = 'title_text'), '') AS title_text,
 bool_or(hint = 'toc_text' AND kind = 'text_region') AS has_toc, count(*) FILTER (hint = 'title_text') AS n_title_text, count(*) FILTER (hint = 'body_text') AS n_body_text FROM s GROUP BY doc_id, page""")
def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Z3-Z5."""
    o = D.observations(spark, sf_dir).selectExpr("doc_id", "page", "ord AS place", "kind", "CASE n % 3 WHEN 0 THEN 'title_text' WHEN 1 THEN 'body_text' ELSE 'toc_text' END AS role_hint", "concat(' l', n) AS text")
    return X.page_texts(o)


@query(f"""WITH {D.OBSERVATIONS}, e AS (SELECT doc_id, ord AS entry_index, ['Part' || n % 7 || n % 30, 'n' || n % 30] AS keys FROM o), t AS (SELECT DISTINCT doc_id, page, CASE WHEN ord % 2 = 0 THEN 'n' || n % 30 ELSE 'Part' || n % 7 || n % 30 END AS key FROM o WHERE n % 4 > 0 AND page % 5 <> 1)
SELECT e.doc_id, e.entry_index, array_to_string(list_sort(list(DISTINCT t.page)), ',') AS pages FROM e JOIN t ON t.doc_id = e.doc_id AND list_contains(e.keys, t.key) GROUP BY e.doc_id, e.entry_index""")
def exact_title_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose title is an entry's."""
    o = D.observations(spark, sf_dir)
    e = o.selectExpr("doc_id", "ord AS entry_index", "concat('Part. ', n % 7, ' · ', n % 30) AS display_title", "concat('n ', n % 30) AS title")
    seen = o.where("n % 4 > 0").selectExpr("doc_id", "page", "'title_text' AS role_hint", "if(ord % 2 = 0, concat('n', n % 30), concat('Part ', n % 7, ' ', n % 30, '…')) AS text")
    return X.exact_titles(e, seen, o.where("page % 5 = 1").select("doc_id", "page").distinct()).withColumn("pages", F.array_join(F.transform("pages", lambda p: p.cast("string")), ","))


@query(f"WITH {D.LINES}, b AS (SELECT * FROM l WHERE n % 3 = 0) SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY ord) - 1 AS entry_index, CASE WHEN n % 2 = 0 THEN 'T' || n ELSE line END AS title, CASE WHEN n % 4 = 0 THEN 1 ELSE 1 + n % 4 END::INT AS level, (n % 90)::VARCHAR AS target_page_label, 'b' || ord AS block_id FROM b")
def contents_of_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2, P12."""
    b = D.lines(spark, sf_dir).selectExpr("doc_id", "ord", "concat('b', ord) AS block_id", "if(n % 3 = 0, 'toc_item', 'paragraph') AS type", "line AS text", "if(n % 2 = 0, concat('T', n), NULL) AS toc_title", "cast(if(n % 4 = 0, NULL, 1 + n % 4) AS int) AS level", "cast(n % 90 AS string) AS target_page_label")
    return X.contents_of_blocks(b)


@query(f"WITH {D.OBSERVATIONS}, b AS (SELECT doc_id, ord, unnest(CASE WHEN n % 3 = 0 THEN [page, page + 1] WHEN n % 3 = 1 THEN [page] ELSE [] END) AS page FROM o) SELECT doc_id, page, string_agg('b' || ord, ',' ORDER BY ord) AS block_ids FROM b GROUP BY doc_id, page")
def blocks_by_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A21."""
    b = D.observations(spark, sf_dir).selectExpr("doc_id", "ord", "concat('b', ord) AS block_id", "if(n % 3 = 0, array(page, page + 1), NULL) AS pages", "if(n % 3 = 2, NULL, page) AS page")
    return X.blocks_by_page(b).withColumn("block_ids", F.array_join("block_ids", ","))


@query("SELECT DISTINCT l_orderkey AS doc_id, CASE WHEN l_partkey % 3 > 0 THEN (l_partkey % 3)::VARCHAR ELSE '' END AS marker, CASE WHEN l_suppkey % 2 = 0 THEN l_suppkey % 4 END AS page FROM lineitem")
def reference_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References once each."""
    r = D.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc_id"), X.reference_key(F.when(F.col("l_partkey") % 3 > 0, (F.col("l_partkey") % 3).cast("string")), F.lit(None).cast("string"), F.when(F.col("l_suppkey") % 2 == 0, F.col("l_suppkey") % 4)).alias("k"))
    return r.distinct().select("doc_id", "k.marker", "k.page")


@query(f"WITH {D.OBSERVATIONS} SELECT doc_id, ord, CASE WHEN n % 3 = 0 THEN '<table/>' WHEN n % 3 = 1 AND n % 2 = 0 THEN '<p/>' ELSE '' END AS html, NOT (n % 3 = 0 OR (n % 3 = 1 AND n % 2 = 0)) AS is_continuation FROM o")
def table_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S27."""
    o = D.observations(spark, sf_dir).selectExpr("doc_id", "page", "ord", "ord AS index", "n", "'table_region' AS kind", "if(n % 3 = 0, '<table/>', NULL) AS html")
    return X.table_attributes(o, o.where("n % 2 = 0").selectExpr("doc_id", "page", "index", "if(n % 3 = 1, '<p/>', ' ') AS html")).select("doc_id", "ord", F.trim("html").alias("html"), "is_continuation")


@query(f"WITH {D.ENTRIES} SELECT doc_id, count(*) AS n_entries, count(start_page) AS n_located, count(*) - count(start_page) AS n_unlocated, count(*) FILTER (role = 'P') AS n_front_matter, count(*) FILTER (role = 'O') AS n_body, count(*) FILTER (role = 'F') AS n_back_matter FROM e GROUP BY doc_id")
def contents_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A13."""
    names = F.create_map(F.lit("P"), F.lit("front_matter"), F.lit("O"), F.lit("body"), F.lit("F"), F.lit("back_matter"))
    return X.contents_audit(D.entries(spark, sf_dir).withColumn("role", names[F.col("role")]))
