"""Queries of whole artifacts: the table flow and the book graph."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import graph, tables
from quire.plans import derived as D
from quire.plans.functions_queries import query

_T = D.OBSERVATIONS + """, tb AS (SELECT doc_id, ord, ord // 2 + n % 2 AS page, 'o' || lpad(ord::VARCHAR, 6, '0') AS observation_id, CASE WHEN n % 8 = 7 THEN NULL WHEN n % 3 = 0 THEN '<table>' || n || '</table>' ELSE ' ' END AS html, n FROM o), h AS (SELECT *, length(trim(coalesce(html, ''))) > 0 AS has, html IS NULL AS none FROM tb),
a AS (SELECT *, has OR none OR coalesce(lag(none) OVER w, true) OR coalesce(page - lag(page) OVER w, 0) <> 1 AS apart FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY ord)), r AS (SELECT *, sum(apart::INT) OVER (PARTITION BY doc_id ORDER BY ord) AS run FROM a),
t AS (SELECT *, bool_or(has) OVER (PARTITION BY doc_id, run) AS is_table, page % 4 > 0 AS inside FROM r), k AS (SELECT *, CASE WHEN is_table THEN 0 ELSE row_number() OVER (PARTITION BY doc_id, run ORDER BY ord) END AS alone FROM t),
cp AS (SELECT doc_id, 'o' || lpad((ord - ord % 3)::VARCHAR, 6, '0') AS observation_id, string_agg('c' || ord, ',' ORDER BY ord) AS caps FROM o WHERE n % 2 = 1 GROUP BY ALL),
g AS (SELECT k.doc_id, run, alone, min(ord) AS first_ord, any_value(is_table) AS is_table, any_value(none) AS none, count(*) AS n, count(*) FILTER (inside) AS i, string_agg(k.observation_id, ',' ORDER BY ord) AS observation_ids, string_agg(caps, ',' ORDER BY ord) AS caption_ids, coalesce(first(html ORDER BY ord), '') AS html FROM k LEFT JOIN cp ON cp.doc_id = k.doc_id AND cp.observation_id = k.observation_id GROUP BY k.doc_id, run, alone),
s AS (SELECT *, CASE WHEN i = 0 THEN 'excluded' WHEN is_table AND i = n THEN 'admitted' ELSE 'unresolved' END AS status FROM g)"""


@query(f"""WITH {_T} SELECT doc_id, first_ord, status, CASE WHEN status = 'excluded' THEN 'excluded_by_page_review' WHEN none THEN 'missing_normalized_table_content' WHEN NOT is_table THEN 'continuation_without_primary' WHEN status = 'unresolved' THEN 'page_review_splits_table_candidate' END AS reason,
 CASE WHEN status = 'admitted' THEN 'tbl' || lpad((row_number() OVER (PARTITION BY doc_id, status ORDER BY first_ord))::VARCHAR, 6, '0') END AS table_id, observation_ids, coalesce(caption_ids, '') AS caption_ids, html FROM s""")
def table_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R18, J7, U2."""
    o = D.observations(spark, sf_dir)
    ident = lambda c: F.format_string("o%06d", c)
    t = o.select("doc_id", "ord", F.expr("ord div 2 + n % 2").alias("page"), ident(F.col("ord")).alias("observation_id"), F.expr("CASE WHEN n % 8 = 7 THEN NULL WHEN n % 3 = 0 THEN concat('<table>', n, '</table>') ELSE ' ' END").alias("html"))
    c = o.where("n % 2 = 1").select("doc_id", ident(F.col("ord") - F.col("ord") % 3).alias("parent_id"), F.concat(F.lit("c"), "ord").alias("observation_id"), "ord")
    review = t.select("doc_id", "page").distinct().withColumn("action", F.when(F.col("page") % 4 > 0, "include").otherwise("exclude"))
    join = lambda x: F.array_join(x, ",").alias(x)
    return tables.table_flow(t, c, review).select("doc_id", "first_ord", "status", "reason", "table_id", join("observation_ids"), join("caption_ids"), "html")


def _book(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    o = D.observations(spark, sf_dir)
    u = o.select("doc_id", "ord", F.concat(F.lit("u"), "ord").alias("unit_id"), F.expr("CASE n % 6 WHEN 0 THEN 'heading' WHEN 1 THEN 'footnote' WHEN 2 THEN 'list_item' ELSE 'paragraph' END").alias("unit_type"), "page",
                 F.expr("CASE WHEN n % 6 = 0 THEN get(array('Notes', 'One', 'Index', 'Two'), cast(ord % 4 AS int)) WHEN n % 5 < 2 THEN concat(n % 4, '. said ', n) ELSE concat('said ', n) END").alias("text"), F.expr("if(n % 7 = 0, array(page, page + 1), array(page))").alias("pages"), F.array("x0", "y0", "x1", "y1").alias("bbox"), F.lit(None).cast("string").alias("marker"))
    pages = o.select("doc_id", "page").distinct()
    review = pages.withColumn("action", F.when(F.col("page") % 9 == 8, "exclude").otherwise("include"))
    review = review.union(review.groupBy("doc_id").agg((F.max("page") + 1).alias("page")).withColumn("action", F.lit("include")))
    roles = pages.withColumn("page_role", F.when(F.col("page") % 3 == 0, "note_section_candidate").otherwise("text_flow_page"))
    refs = o.where("n % 6 > 2").select("doc_id", F.concat(F.lit("u"), "ord").alias("unit_id"), F.col("ord").alias("ref_id"), (F.col("n") % 4).cast("string").alias("marker"))
    return graph.book(u, roles, review, refs)


_BK = D.OBSERVATIONS + """, pg AS (SELECT DISTINCT doc_id, page FROM o), mx AS (SELECT doc_id, max(page) AS top FROM pg GROUP BY doc_id), u0 AS (SELECT o.* EXCLUDE (kind), CASE n % 6 WHEN 0 THEN 'heading' WHEN 1 THEN 'footnote' WHEN 2 THEN 'list_item' ELSE 'paragraph' END AS kind, CASE WHEN n % 6 = 0 THEN (['Notes', 'One', 'Index', 'Two'])[ord % 4 + 1] WHEN n % 5 < 2 THEN (n % 4)::VARCHAR || '. said ' || n ELSE 'said ' || n END AS text, CASE WHEN n % 6 > 0 AND n % 5 < 2 THEN (n % 4)::VARCHAR ELSE '' END AS lead FROM o),
u1 AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS k FROM u0 WHERE page % 9 <> 8 AND NOT (n % 7 = 0 AND (page + 1) % 9 = 8 AND (page + 1) <= (SELECT top FROM mx WHERE mx.doc_id = u0.doc_id))),
a AS (SELECT *, kind = 'heading' AND ord % 4 = 0 AS opens, kind = 'heading' AND ord % 4 = 2 AS stops, max(page) OVER (PARTITION BY doc_id) AS last_page FROM u1), b AS (SELECT *, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY ord) AS section FROM a),
c AS (SELECT *, section > 0 AND max(stops::INT) OVER (PARTITION BY doc_id, section ORDER BY ord) = 0 AS inside, first_value(page) OVER (PARTITION BY doc_id, section ORDER BY ord) >= greatest(1, round_even(last_page * 0.6, 0)) AS late FROM b), d AS (SELECT *, inside AND kind = 'heading' AND NOT opens AS sets FROM c),
e AS (SELECT *, CASE WHEN inside THEN coalesce(last_value(CASE WHEN sets THEN lower(text) END IGNORE NULLS) OVER (PARTITION BY doc_id, section ORDER BY ord), '') END AS skey, kind <> 'heading' AND inside AND (kind = 'footnote' OR lead <> '') AS entry FROM d),
nd AS (SELECT doc_id, ord, page, n, 'n' || lpad(k::VARCHAR, 6, '0') AS node_id, CASE WHEN kind = 'footnote' OR entry THEN 'note' ELSE kind END AS node_type, CASE WHEN kind = 'footnote' OR entry THEN 'said ' || n ELSE text END AS text, CASE WHEN kind = 'footnote' OR entry THEN lead END AS note_marker,
 CASE WHEN entry THEN CASE WHEN late THEN 'book_end' ELSE 'chapter_end' END WHEN kind = 'footnote' THEN CASE WHEN page % 3 = 0 THEN 'note_section_candidate' ELSE 'page_foot' END END AS placement, CASE WHEN entry THEN CASE WHEN skey <> '' THEN 'chapter' WHEN late THEN 'book' ELSE 'unknown' END WHEN kind = 'footnote' THEN CASE WHEN page % 3 = 0 THEN 'unknown' ELSE 'page' END END AS scope, CASE WHEN entry THEN skey ELSE '' END AS skey,
 last_value(CASE WHEN kind = 'heading' AND NOT (opens OR sets) THEN lower(text) END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY ord) AS body_key FROM e),
nt AS (SELECT * FROM nd WHERE node_type = 'note' AND note_marker <> ''), rf AS (SELECT doc_id, ord AS ref_id, node_id, page, body_key, (n % 4)::VARCHAR AS marker FROM nd WHERE n % 6 > 2 AND node_type <> 'note'),
pn AS (SELECT doc_id, page, note_marker AS marker, min(node_id) AS lo, max(node_id) AS hi FROM nt WHERE placement = 'page_foot' GROUP BY ALL), cn AS (SELECT doc_id, skey AS body_key, note_marker AS marker, min(node_id) AS clo, max(node_id) AS chi FROM nt WHERE placement <> 'page_foot' AND scope = 'chapter' GROUP BY ALL), bn AS (SELECT doc_id, note_marker AS marker, min(node_id) AS blo, max(node_id) AS bhi FROM nt WHERE placement <> 'page_foot' AND scope = 'book' GROUP BY ALL),
rs AS (SELECT rf.*, CASE WHEN lo = hi THEN lo END AS p, CASE WHEN clo IS NOT NULL THEN CASE WHEN clo = chi THEN clo END WHEN blo = bhi THEN blo END AS s FROM rf LEFT JOIN pn USING (doc_id, page, marker) LEFT JOIN cn USING (doc_id, body_key, marker) LEFT JOIN bn USING (doc_id, marker))"""


@query(f"WITH {_BK} SELECT doc_id, node_id, node_type, text, page, note_marker, placement, scope FROM nd")
def book_graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R22, F2, R23, W14."""
    return _book(spark, sf_dir)["nodes"].select("doc_id", "node_id", "node_type", "text", "page", "note_marker", "placement", "scope")


@query(f"WITH {_BK} SELECT doc_id, ref_id, node_id, marker, coalesce(p, s) AS note_id, CASE WHEN p IS NOT NULL THEN 'page_foot' WHEN s IS NOT NULL THEN 'note_section' END AS placement FROM rs")
def book_graph_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R22, J1, J2, Z14."""
    return _book(spark, sf_dir)["references"]


@query(f"WITH {_BK} SELECT doc_id, edge_type, count(*) AS n FROM (SELECT doc_id, 'appears_on_page' AS edge_type FROM nd UNION ALL SELECT doc_id, 'references_note' FROM (SELECT DISTINCT doc_id, node_id, coalesce(p, s) AS t FROM rs WHERE coalesce(p, s) IS NOT NULL)) GROUP BY doc_id, edge_type")
def book_graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges by type."""
    return _book(spark, sf_dir)["edges"].groupBy("doc_id", "edge_type").agg(F.count(F.lit(1)).alias("n"))
