"""Queries of the contracts between artifacts, over tables with planted violations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import contracts as C
from quire.plans import derived as D
from quire.plans.functions_queries import query


def _o(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.observations(spark, sf_dir).withColumn("observation_id", F.concat(F.lit("o"), "ord"))


_O = D.OBSERVATIONS + ", s AS (SELECT *, 'o' || ord AS observation_id FROM o), pg AS (SELECT DISTINCT doc_id, page FROM o)"


@query(f"WITH {_O}, r AS (SELECT doc_id, 'r' || (ord - CASE WHEN n % 23 = 0 AND ord > 0 THEN 1 ELSE 0 END) AS id, CASE WHEN n % 7 > 0 THEN 'p' || ord END AS a, CASE WHEN n % 11 = 0 THEN 'x' ELSE 'p' || ord END AS b FROM s) SELECT doc_id, 'unique:record_id' AS rule, id AS detail FROM r GROUP BY doc_id, id HAVING count(*) > 1 UNION ALL SELECT doc_id, 'pair', id FROM r WHERE a IS DISTINCT FROM b")
def internal_record_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4."""
    r = _o(spark, sf_dir).selectExpr("doc_id", "concat('r', ord - if(n % 23 = 0 AND ord > 0, 1, 0)) AS record_id", "if(n % 7 > 0, concat('p', ord), NULL) AS public_id", "if(n % 11 = 0, 'x', concat('p', ord)) AS debug_id")
    return C.internal_records(r)


@query(f"""WITH {_O}, a AS (SELECT doc_id, page AS ord, CASE WHEN page % 9 = 4 THEN page - 1 ELSE page END AS page, CASE WHEN page % 6 > 0 THEN 1.0 END AS width FROM pg WHERE page % 7 <> 6), lg AS (SELECT *, lag(page) OVER (PARTITION BY doc_id ORDER BY ord) AS before FROM a)
SELECT doc_id, 'required:width' AS rule, page::VARCHAR AS detail FROM a WHERE width IS NULL UNION ALL SELECT doc_id, 'unique:page', page::VARCHAR FROM a GROUP BY doc_id, page HAVING count(*) > 1 UNION ALL SELECT doc_id, 'increasing:page', ord::VARCHAR FROM lg WHERE page <= before
UNION ALL SELECT doc_id, 'uncovered:page', page::VARCHAR FROM pg WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.doc_id = pg.doc_id AND a.page = pg.page)""")
def page_layout_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5."""
    pages = _o(spark, sf_dir).select("doc_id", "page").distinct()
    a = pages.where("page % 7 <> 6").selectExpr("doc_id", "page AS ord", "if(page % 9 = 4, page - 1, page) AS page", "if(page % 6 > 0, 1D, NULL) AS width", "1D AS height")
    return C.page_layout(a, pages)


@query(f"""WITH {_O}, e AS (SELECT doc_id, ord AS entry_index, (['front_matter', 'body', 'body', 'body', 'back_matter'])[least(4, ord // 4 + CASE WHEN n % 10 = 0 THEN 1 ELSE 0 END) + 1] AS role, page FROM s), ev AS (SELECT doc_id, ord AS entry_index, CASE WHEN n % 2 = 0 THEN 'title' ELSE 'toc' END AS kind, 'o' || (ord + CASE WHEN n % 8 = 0 THEN 3 ELSE 0 END) AS observation_id FROM s),
ob AS (SELECT doc_id, observation_id, page, CASE WHEN n % 3 = 0 THEN 'toc_text' ELSE 'x' END AS hint FROM s), j AS (SELECT ev.*, e.page AS anchor, ob.page, ob.hint FROM ev JOIN e USING (doc_id, entry_index) LEFT JOIN ob USING (doc_id, observation_id)),
k AS (SELECT *, list_position(['front_matter', 'body', 'back_matter'], role) AS r FROM e), m AS (SELECT *, max(r) OVER (PARTITION BY doc_id ORDER BY entry_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS most FROM k)
SELECT doc_id, 'reference:observation_id' AS rule, observation_id AS detail FROM j WHERE page IS NULL UNION ALL SELECT doc_id, 'title_page', observation_id FROM j WHERE kind = 'title' AND page <> anchor UNION ALL SELECT doc_id, 'toc_page', observation_id FROM j WHERE page IS NOT NULL AND kind = 'toc' AND (page > 2 OR hint <> 'toc_text') UNION ALL SELECT doc_id, 'role_order', entry_index::VARCHAR FROM m WHERE r < most""")
def skeleton_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6."""
    o = _o(spark, sf_dir)
    e = o.selectExpr("doc_id", "ord AS entry_index", "get(array('front_matter', 'body', 'body', 'body', 'back_matter'), cast(least(4, ord div 4 + if(n % 10 = 0, 1, 0)) AS int)) AS role", "page")
    ev = o.selectExpr("doc_id", "ord AS entry_index", "if(n % 2 = 0, 'title', 'toc') AS kind", "concat('o', ord + if(n % 8 = 0, 3, 0)) AS observation_id")
    return C.skeleton(e, ev, o.selectExpr("doc_id", "observation_id", "page", "if(n % 3 = 0, 'toc_text', 'x') AS role_hint"), o.where("page <= 2").select("doc_id", "page"))


@query(f"""WITH {_O}, r AS (SELECT doc_id, page, CASE WHEN page % 5 = 0 THEN 'needs_review' ELSE 'include' END AS action, CASE WHEN page % 4 = 1 THEN 'layout' ELSE 'llm_page_review' END AS source, CASE WHEN page % 6 = 2 THEN 'pending' ELSE 'sent_and_resolved' END AS status FROM pg WHERE page % 7 > 0), c AS (SELECT * FROM pg WHERE page % 2 = 1)
SELECT doc_id, 'uncovered:page' AS rule, page::VARCHAR AS detail FROM c WHERE page % 7 = 0 UNION ALL SELECT doc_id, 'undecided', page::VARCHAR FROM c JOIN r USING (doc_id, page) WHERE source = 'layout' OR status = 'pending' UNION ALL SELECT doc_id, 'open_action', page::VARCHAR FROM c JOIN r USING (doc_id, page) WHERE action = 'needs_review'
UNION ALL SELECT pg.doc_id, 'reference:primary_page', (pg.page - 1)::VARCHAR FROM pg WHERE page % 3 = 0 AND NOT EXISTS (SELECT 1 FROM r WHERE r.doc_id = pg.doc_id AND r.page = pg.page - 1)""")
def resolved_review_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7."""
    pages = _o(spark, sf_dir).select("doc_id", "page").distinct()
    r = pages.where("page % 7 > 0").selectExpr("doc_id", "page", "if(page % 5 = 0, 'needs_review', 'include') AS action", "if(page % 4 = 1, 'layout', 'llm_page_review') AS source", "if(page % 6 = 2, 'pending', 'sent_and_resolved') AS status")
    return C.resolved_review(r, pages.where("page % 2 = 1"), pages.where("page % 3 = 0").selectExpr("doc_id", "page", "page - 1 AS primary_page"))


@query(f"""WITH {_O}, m AS (SELECT doc_id, 'u' || ord // 2 AS unit_id, 'o' || (ord - CASE WHEN n % 9 = 0 AND ord > 2 THEN 3 ELSE 0 END) AS observation_id FROM s WHERE n % 13 > 0), u AS (SELECT DISTINCT doc_id, 'u' || ord // 2 AS unit_id, CASE WHEN ord // 2 % 5 = 3 THEN ord // 2 - 2 ELSE ord // 2 END AS ord FROM s),
f AS (SELECT m.doc_id, m.unit_id, min(s.ord) AS place FROM m JOIN s USING (doc_id, observation_id) GROUP BY ALL), j AS (SELECT u.*, place, max(place) OVER (PARTITION BY u.doc_id ORDER BY u.ord, u.unit_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM u LEFT JOIN f USING (doc_id, unit_id))
SELECT doc_id, 'unique:observation_id' AS rule, observation_id AS detail FROM m GROUP BY doc_id, observation_id HAVING count(*) > 1 UNION ALL SELECT doc_id, 'empty_unit', unit_id FROM j WHERE place IS NULL UNION ALL SELECT doc_id, 'order', unit_id FROM j WHERE place < before""")
def text_flow_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q8."""
    o = _o(spark, sf_dir)
    m = o.where("n % 13 > 0").selectExpr("doc_id", "concat('u', ord div 2) AS unit_id", "concat('o', ord - if(n % 9 = 0 AND ord > 2, 3, 0)) AS observation_id")
    u = o.selectExpr("doc_id", "concat('u', ord div 2) AS unit_id", "struct(if(ord div 2 % 5 = 3, ord div 2 - 2, ord div 2) AS a, concat('u', ord div 2) AS b) AS ord").distinct()
    return C.text_flow(u, m, o.select("doc_id", "observation_id", F.col("ord").alias("place")))


@query(f"""WITH {_O}, cap AS (SELECT doc_id, observation_id AS id FROM s WHERE n % 4 = 0), img AS (SELECT doc_id, observation_id AS id FROM s WHERE n % 4 = 1), pl AS (SELECT doc_id, observation_id AS id FROM s WHERE (n % 4 = 0 AND n % 5 > 0) OR (n % 4 = 1 AND n % 6 = 5)), us AS (SELECT doc_id, observation_id AS id FROM s WHERE n % 4 = 2 AND n % 7 > 0)
SELECT doc_id, 'missing:caption_id' AS rule, id AS detail FROM (SELECT * FROM cap EXCEPT ALL SELECT * FROM pl) UNION ALL SELECT doc_id, 'asset_in_text', id FROM pl WHERE EXISTS (SELECT 1 FROM img WHERE img.doc_id = pl.doc_id AND img.id = pl.id) UNION ALL SELECT s.doc_id, 'missing:reference_id', observation_id FROM s WHERE n % 4 = 2 AND n % 7 = 0""")
def final_text_flow_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q9."""
    o = _o(spark, sf_dir)
    ref = lambda cond: o.where(cond).select("doc_id", F.col("observation_id").alias("reference_id"))
    return C.final_text_flow(o.where("n % 4 = 0"), o.where("n % 4 = 1"), o.where("(n % 4 = 0 AND n % 5 > 0) OR (n % 4 = 1 AND n % 6 = 5)"), ref("n % 4 = 2"), ref("n % 4 = 2 AND n % 7 > 0"))


@query(f"""WITH {_O}, t AS (SELECT doc_id, observation_id, page, n FROM s WHERE n % 3 = 0), c AS (SELECT doc_id, observation_id, (['admitted', 'unresolved', 'excluded'])[n % 5 % 3 + 1] AS status FROM t WHERE n % 7 > 0 UNION ALL SELECT doc_id, observation_id, 'admitted' FROM t WHERE n % 11 = 0)
SELECT doc_id, 'missing:observation_id' AS rule, observation_id AS detail FROM (SELECT doc_id, observation_id FROM t EXCEPT ALL SELECT doc_id, observation_id FROM c) UNION ALL SELECT doc_id, 'extra:observation_id', observation_id FROM (SELECT doc_id, observation_id FROM c EXCEPT ALL SELECT doc_id, observation_id FROM t)
UNION ALL SELECT c.doc_id, 'disposition', c.observation_id FROM c JOIN t USING (doc_id, observation_id) WHERE (c.status = 'admitted' AND t.page % 4 = 0) OR (c.status = 'excluded' AND t.page % 4 <> 0)""")
def table_flow_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q10."""
    o = _o(spark, sf_dir).withColumn("kind", F.when(F.col("n") % 3 == 0, "table_region"))
    t = o.where("n % 3 = 0")
    c = t.where("n % 7 > 0").selectExpr("doc_id", "observation_id", "get(array('admitted', 'unresolved', 'excluded'), cast(n % 5 % 3 AS int)) AS status").union(t.where("n % 11 = 0").selectExpr("doc_id", "observation_id", "'admitted' AS status"))
    review = o.select("doc_id", "page").distinct().withColumn("action", F.when(F.col("page") % 4 == 0, "exclude").otherwise("include"))
    return C.table_flow(c, o, review)


@query(f"""WITH {_O}, e AS (SELECT doc_id, 'g' || page AS group_id, 'o' || (ord + CASE WHEN n % 29 = 0 THEN 100000 ELSE 0 END) AS observation_id, CASE WHEN n % 10 = 0 OR kind = 'image_region' THEN 'image' ELSE 'caption' END AS side FROM s), j AS (SELECT e.*, s.kind, s.page, s.n FROM e LEFT JOIN s USING (doc_id, observation_id)),
g AS (SELECT doc_id, 'g' || page AS group_id, CASE WHEN page % 5 = 2 THEN [page, page + 1] ELSE [page, page] END AS pages FROM pg), f AS (SELECT doc_id, group_id, list_sort(list(DISTINCT page)) AS found FROM j WHERE page IS NOT NULL GROUP BY ALL)
SELECT doc_id, 'endpoint' AS rule, observation_id AS detail FROM j WHERE NOT coalesce(CASE WHEN side = 'image' THEN kind = 'image_region' ELSE kind = 'text_region' END, false) UNION ALL SELECT doc_id, 'unreviewed', observation_id FROM j WHERE side = 'image' AND kind = 'image_region' AND page % 6 = 0 UNION ALL SELECT doc_id, 'table_caption', observation_id FROM j WHERE side = 'caption' AND n % 17 = 3
UNION ALL SELECT g.doc_id, 'group_pages', g.group_id FROM g LEFT JOIN f USING (doc_id, group_id) WHERE list_sort(list_distinct(g.pages)) IS DISTINCT FROM f.found""")
def visual_relation_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q11."""
    o = _o(spark, sf_dir)
    e = o.selectExpr("doc_id", "concat('g', page) AS group_id", "concat('o', ord + if(n % 29 = 0, 100000, 0)) AS observation_id", "if(n % 10 = 0 OR kind = 'image_region', 'image', 'caption') AS side")
    pages = o.select("doc_id", "page").distinct()
    g = pages.selectExpr("doc_id", "concat('g', page) AS group_id", "if(page % 5 = 2, array(page, page + 1), array(page, page)) AS pages")
    return C.visual_relations(e, g, o, pages.where("page % 6 > 0"), o.where("n % 17 = 3"))


@query(f"""WITH {_O}, y AS (SELECT DISTINCT doc_id, 's' || page % 3 AS system_id FROM pg WHERE doc_id % 9 > 0), r AS (SELECT doc_id, 's' || page % 3 AS system_id, page AS first, page + (page % 5) - 1 AS last FROM pg), lg AS (SELECT *, max(last) OVER (PARTITION BY doc_id, system_id ORDER BY first, last ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS until FROM r)
SELECT doc_id, 'reference:system_id' AS rule, system_id AS detail FROM r WHERE doc_id % 9 = 0 UNION ALL SELECT doc_id, 'range', system_id FROM r WHERE first > last UNION ALL SELECT doc_id, 'overlap', system_id FROM lg WHERE first <= until
UNION ALL SELECT doc_id, 'reference:page', p::VARCHAR FROM (SELECT DISTINCT doc_id, unnest([first, last]) AS p FROM r) x WHERE NOT EXISTS (SELECT 1 FROM pg WHERE pg.doc_id = x.doc_id AND pg.page = x.p) UNION ALL SELECT doc_id, 'evidence', system_id FROM y WHERE doc_id % 4 = 1""")
def note_system_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q12."""
    pages = _o(spark, sf_dir).select("doc_id", "page").distinct()
    r = pages.selectExpr("doc_id", "concat('s', page % 3) AS system_id", "page AS first", "page + (page % 5) - 1 AS last")
    y = r.where("doc_id % 9 > 0").select("doc_id", "system_id").distinct()
    return C.note_systems(y, r, pages, y.where("doc_id % 4 <> 1"))


@query(f"""WITH {_O} SELECT doc_id, 'missing:definition_id' AS rule, observation_id AS detail FROM s WHERE n % 5 = 4 UNION ALL SELECT doc_id, 'extra:definition_id', observation_id FROM s WHERE n % 5 < 3 AND n % 7 = 0 UNION ALL SELECT doc_id, 'reference:system_id', 's' || page % 3 FROM s WHERE n % 5 < 3 AND page % 3 = 2""")
def marker_plan_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q13."""
    d = _o(spark, sf_dir).selectExpr("doc_id", "observation_id AS definition_id", "concat('s', page % 3) AS system_id", "n", "page")
    skipped = d.where("n % 5 = 3").select("doc_id", "definition_id").union(d.where("n % 5 < 3 AND n % 7 = 0").select("doc_id", "definition_id"))
    systems = d.select("doc_id").distinct().withColumn("system_id", F.explode(F.array(F.lit("s0"), F.lit("s1"))))
    return C.marker_plan(d, d.where("n % 5 < 3"), skipped, systems)


@query(f"""WITH {_O}, u AS (SELECT doc_id, observation_id AS id, (['found', 'absent', 'not_run', 'failed', 'unresolved', 'odd'])[n % 6 + 1] AS status, CASE WHEN n % 4 = 0 THEN 'x' END AS marker FROM s WHERE n % 9 > 0)
SELECT doc_id, 'missing:request_id' AS rule, observation_id AS detail FROM s WHERE n % 9 = 0 UNION ALL SELECT doc_id, 'domain:status', id FROM u WHERE status = 'odd' UNION ALL SELECT doc_id, 'marker', id FROM u WHERE (status = 'found') <> (marker IS NOT NULL)""")
def marker_review_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q14."""
    r = _o(spark, sf_dir).selectExpr("doc_id", "observation_id AS request_id", "get(array('found', 'absent', 'not_run', 'failed', 'unresolved', 'odd'), cast(n % 6 AS int)) AS status", "if(n % 4 = 0, 'x', NULL) AS marker", "n")
    return C.marker_review(r, r.where("n % 9 > 0"))


@query(f"""WITH {_O} SELECT doc_id, 'missing:unit_id' AS rule, observation_id AS detail FROM s WHERE n % 3 = 0 AND n % 4 = 3 UNION ALL SELECT doc_id, 'extra:unit_id', observation_id FROM s WHERE n % 3 > 0 AND n % 4 = 2 UNION ALL SELECT doc_id, 'reference:system_id', 's1' FROM s WHERE n % 3 = 0 AND n % 4 < 2 AND page % 2 = 1""")
def note_inventory_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q15, U5."""
    u = _o(spark, sf_dir).selectExpr("doc_id", "observation_id AS unit_id", "concat('d', ord) AS definition_id", "concat('r', ord) AS reference_id", "concat('s', page % 2) AS system_id", "n")
    systems = u.select("doc_id").distinct().withColumn("system_id", F.lit("s0"))
    return C.note_inventory(u.where("n % 3 = 0 AND n % 4 < 2"), u.where("n % 4 = 2"), u.where("n % 3 = 0"), u.where("system_id = 's0'"), u, systems)


@query(f"""WITH {_O}, x AS (SELECT doc_id, 'x' || ord AS section_id, ord, CASE WHEN ord % 3 > 0 THEN 'x' || (ord - ord % 3 + CASE WHEN n % 19 = 0 THEN 3 ELSE 0 END) END AS parent_id, page AS first, page + n % 3 - 1 AS last FROM s), c AS (SELECT x.*, p.ord AS po, p.first AS pf, p.last AS pl FROM x JOIN x p ON p.doc_id = x.doc_id AND p.section_id = x.parent_id)
SELECT doc_id, 'range' AS rule, section_id AS detail FROM x WHERE first > last UNION ALL SELECT doc_id, 'reference:parent_id', parent_id FROM x WHERE parent_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM x p WHERE p.doc_id = x.doc_id AND p.section_id = x.parent_id) UNION ALL SELECT doc_id, 'nesting', section_id FROM c WHERE NOT (pf <= first AND last <= pl AND po < ord)
UNION ALL SELECT doc_id, 'reference:page', p::VARCHAR FROM (SELECT DISTINCT doc_id, unnest([first, last]) AS p FROM x) y WHERE NOT EXISTS (SELECT 1 FROM pg WHERE pg.doc_id = y.doc_id AND pg.page = y.p) UNION ALL SELECT doc_id, 'evidence', section_id FROM x WHERE ord % 8 = 5""")
def section_map_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q16, J17."""
    o = _o(spark, sf_dir)
    x = o.selectExpr("doc_id", "concat('x', ord) AS section_id", "ord", "if(ord % 3 > 0, concat('x', ord - ord % 3 + if(n % 19 = 0, 3, 0)), NULL) AS parent_id", "page AS first", "page + n % 3 - 1 AS last")
    return C.section_map(x, x.where("ord % 8 <> 5"), o.select("doc_id", "page").distinct())


@query(f"WITH {_O} SELECT doc_id, 'missing:unit_id' AS rule, observation_id AS detail FROM s WHERE n % 6 = 0 UNION ALL SELECT doc_id, 'extra:unit_id', observation_id FROM s WHERE n % 6 = 1 UNION ALL SELECT doc_id, 'reference:section_id', 'x' || page FROM (SELECT * FROM s WHERE n % 6 > 0 UNION ALL SELECT * FROM s WHERE n % 6 = 1) WHERE page % 4 = 3")
def section_link_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q17, J27, U3."""
    u = _o(spark, sf_dir).selectExpr("doc_id", "observation_id AS unit_id", "concat('x', page) AS section_id", "n", "page")
    members = u.where("n % 6 > 0").union(u.where("n % 6 = 1"))
    return C.section_links(members, u, u.where("page % 4 <> 3").select("doc_id", "section_id").distinct())


@query(f"""WITH {_O}, rf AS (SELECT doc_id, 'r' || ord AS reference_id, 's' || page % 2 AS system_id, (n % 4)::VARCHAR AS marker, 'c' || ord // 9 AS section_id, page, n, ord FROM s), df AS (SELECT doc_id, 'd' || ord AS definition_id, 's' || page % 2 AS system_id, (n % 4)::VARCHAR AS marker, 'c' || ord // 9 AS section_id, page FROM s),
re AS (SELECT doc_id, reference_id, 'd' || (ord + n % 3) AS definition_id, (['page', 'chapter', 'book'])[n % 5 % 3 + 1] AS scope FROM rf WHERE n % 7 > 1), un AS (SELECT doc_id, reference_id FROM rf WHERE n % 7 IN (1, 3)), j AS (SELECT re.*, rf.system_id AS rs, rf.marker AS rm, rf.section_id AS rc, rf.page AS rp, df.system_id AS ds, df.marker AS dm, df.section_id AS dc, df.page AS dp FROM re JOIN rf USING (doc_id, reference_id) JOIN df ON df.doc_id = re.doc_id AND df.definition_id = re.definition_id)
SELECT doc_id, 'missing:reference_id' AS rule, reference_id AS detail FROM rf WHERE n % 7 = 0 UNION ALL SELECT doc_id, 'extra:reference_id', reference_id FROM rf WHERE n % 7 = 3 UNION ALL SELECT doc_id, 'reference:definition_id', definition_id FROM re WHERE NOT EXISTS (SELECT 1 FROM df WHERE df.doc_id = re.doc_id AND df.definition_id = re.definition_id)
UNION ALL SELECT doc_id, 'system', reference_id FROM j WHERE rs <> ds UNION ALL SELECT doc_id, 'marker', reference_id FROM j WHERE rm <> dm UNION ALL SELECT doc_id, 'scope', reference_id FROM j WHERE (scope = 'page' AND rp <> dp) OR (scope = 'chapter' AND rc <> dc)""")
def note_resolution_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q18, J18, U4."""
    both = _o(spark, sf_dir).selectExpr("doc_id", "concat('r', ord) AS reference_id", "concat('d', ord) AS definition_id", "concat('s', page % 2) AS system_id", "cast(n % 4 AS string) AS marker", "concat('c', ord div 9) AS section_id", "page", "n", "ord")
    relations = both.where("n % 7 > 1").selectExpr("doc_id", "reference_id", "concat('d', ord + n % 3) AS definition_id", "get(array('page', 'chapter', 'book'), cast(n % 5 % 3 AS int)) AS scope")
    return C.note_resolution(relations, both.where("n % 7 IN (1, 3)"), both, both)


_NAMES = ["page_layout", "skeleton", "table_flow", "text_flow"]


@query(f"WITH a AS (SELECT doc_id, unnest({_NAMES}) AS name FROM documents) SELECT doc_id, 'missing:name' AS rule, name AS detail FROM a WHERE (doc_id + length(name)) % 5 = 0 UNION ALL SELECT doc_id, 'extra:name', 'other' FROM documents WHERE doc_id % 6 = 0")
def bundle_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q19, Z1."""
    d = D.table(spark, sf_dir, "documents").select("doc_id")
    a = d.withColumn("name", F.explode(F.array(*[F.lit(x) for x in _NAMES]))).where((F.col("doc_id") + F.length("name")) % 5 != 0)
    return C.bundle(a.union(d.where("doc_id % 6 = 0").withColumn("name", F.lit("other"))), _NAMES)


@query(f"""WITH {_O}, c AS (SELECT doc_id, page + CASE WHEN page % 11 = 5 THEN 1000 ELSE 0 END AS page, a AS artifact FROM (SELECT doc_id, page, unnest(['layout', 'review']) AS a FROM pg) WHERE NOT (a = 'review' AND page % 4 = 2)), w AS (SELECT pg.doc_id, pg.page, x.artifact FROM pg JOIN (SELECT DISTINCT doc_id, artifact FROM c) x USING (doc_id))
SELECT doc_id, 'uncovered:page' AS rule, artifact || ':' || page AS detail FROM w WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.doc_id = w.doc_id AND c.page = w.page AND c.artifact = w.artifact) UNION ALL SELECT doc_id, 'reference:page', artifact || ':' || page FROM c WHERE page > 1000""")
def page_coverage_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q20."""
    pages = _o(spark, sf_dir).select("doc_id", "page").distinct()
    c = pages.withColumn("artifact", F.explode(F.array(F.lit("layout"), F.lit("review")))).where("NOT (artifact = 'review' AND page % 4 = 2)").withColumn("page", F.expr("page + if(page % 11 = 5, 1000, 0)"))
    return C.same_pages(c, pages)
