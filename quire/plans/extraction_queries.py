"""Queries of extracted text, contents entries, visual relations and note strategies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import extraction as X
from quire.operators import contents as C
from quire.operators import visuals as V
from quire.plans import derived as D
from quire.plans.functions_queries import query


@query(f"""WITH {D.LINES} SELECT doc_id, ord, CASE WHEN n % 3 = 0 THEN repeat('章', 20) || '。' || chr(10) || repeat('文', 21) WHEN n % 3 = 1 THEN repeat('章', 20 + n % 5) || repeat('文', 20) || chr(10) || 'short' ELSE repeat('章', 20) || chr(10) || '三、' || repeat('文', 20) END AS text FROM l""")
def joined_wraps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C5."""
    b, a = (lambda c: F.repeat(F.lit("章"), c)), F.repeat(F.lit("文"), F.lit(20))
    k = F.col("n") % 3
    t = F.when(k == 0, F.concat(b(F.lit(20)), F.lit("。\n文"), a)).when(k == 1, F.concat(b((20 + F.col("n") % 5).cast("int")), F.lit("\n"), a, F.lit("\nshort"))).otherwise(F.concat(b(F.lit(20)), F.lit("\n三、"), a))
    return D.lines(spark, sf_dir).select("doc_id", "ord", X.join_wraps(t).alias("text"))


@query(f"""WITH {D.LINES} SELECT doc_id, ord, CASE n % 6 WHEN 0 THEN '完了。' WHEN 1 THEN 'word 7' WHEN 2 THEN '- by 12' WHEN 3 THEN 'end' WHEN 4 THEN '完了。 123' ELSE '. 45' END AS body, CASE n % 6 WHEN 0 THEN (n % 90)::VARCHAR WHEN 3 THEN '**' END AS marker FROM l""")
def trailing_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C8, Z39."""
    t = F.expr("CASE n % 6 WHEN 0 THEN concat('完了。 ', translate(cast(n % 90 AS string), '0123456789', '⁰¹²³⁴⁵⁶⁷⁸⁹')) WHEN 1 THEN 'word 7' WHEN 2 THEN '- by 12' WHEN 3 THEN 'end **' WHEN 4 THEN '完了。 123' ELSE '. 45' END")
    return D.lines(spark, sf_dir).select("doc_id", "ord", X.trailing_note(t).alias("s")).select("doc_id", "ord", "s.body", "s.marker")


@query(f"""WITH {D.LINES} SELECT doc_id, ord, (['1' || n, '11 title', '21 title', '1 ' || n, '10 x', '16' || chr(10) || 'x', '30 y', 'a 僵局'])[n % 8 + 1] AS title FROM l""")
def contents_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C9."""
    t = F.get(F.array(*[F.expr(x) for x in ("concat('I', n)", "'II title'", "'2I title'", "concat('I ', n)", "'IO x'", "'i6\\nx'", "'3。 y'", "'a 僵 局'")]), (F.col("n") % 8).cast("int"))
    return D.lines(spark, sf_dir).select("doc_id", "ord", X.contents_number(t).alias("title"))


@query(f"""WITH {D.LINES} SELECT doc_id, ord, 'see ' || n || ' α x^2 end' AS text, (n % 50)::VARCHAR || ',**' AS markers, 5::INT AS n_runs FROM l""")
def nested_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text, formulas and notes of nested JSON."""
    content = F.format_string('{"item": [{"type": "text", "content": "see %d "}, {"deep": {"type": "equation_inline", "content": "^{%d}"}}, {"path": {"type": "text", "content": "no"}}], "more": [[{"type": "equation_inline", "content": "\\\\alpha"}, {"type": "text", "content": " "}, {"type": "equation_interline", "content": "x^2"}], {"type": "equation_inline", "content": "**"}, {"type": "text", "content": "  end"}]}', "n", F.col("n") % 50)
    r = D.lines(spark, sf_dir).select("doc_id", "ord", X.runs_udf(content).alias("r"))
    return r.select("doc_id", "ord", X.text_of(F.col("r")).alias("text"), F.array_join(X.markers_of(F.col("r")), ",").alias("markers"), F.size("r").alias("n_runs"))


_TITLES = "(['第一部分 起点', '第二章 城市', '专题 3 海', '附录 2 表', '附录 注', '7 seven', 'I one', '前言', '参考文献 x', '12 plain', '第三节 河', 'free title'])"
_ENTRIES = D.LINES + f""", e AS (SELECT doc_id, ord AS entry_index, n % 12 AS k, {_TITLES}[n % 12 + 1] AS raw_title, CASE n % 5 WHEN 0 THEN 'front_matter' WHEN 1 THEN 'back_matter' ELSE 'body' END AS role FROM l),
g AS (SELECT *, (['part', 'chapter', 'topic', 'appendix_number', 'appendix', 'number', 'number', NULL, NULL, 'number', 'chapter', NULL])[k + 1] AS label_kind, (['第一部分', '第二章', '专题3', '附录2', '附录', '7', '1', NULL, NULL, '12', '第三节', NULL])[k + 1] AS label, (['起点', '城市', '海', '表', '注', 'seven', 'one', '前言', '参考文献 x', 'plain', '河', 'free title'])[k + 1] AS title FROM e),
v AS (SELECT *, CASE WHEN label_kind = 'part' THEN 1 WHEN label_kind = 'chapter' THEN CASE WHEN max(CASE WHEN label_kind = 'part' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id) = 1 THEN 2 ELSE 1 END WHEN label_kind IN ('topic', 'appendix_number', 'appendix') THEN 1 WHEN label IS NOT NULL THEN 2 WHEN k IN (7, 8) THEN 1
 WHEN coalesce(max(CASE WHEN label_kind = 'chapter' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY entry_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 THEN 2 ELSE 1 END AS level FROM g)"""


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    titles = F.array(*[F.lit(x.strip(" '")) for x in _TITLES.strip("([])").split(",")])
    rows = D.lines(spark, sf_dir).select("doc_id", F.col("ord").alias("entry_index"), F.get(titles, (F.col("n") % 12).cast("int")).alias("raw_title"), F.expr("CASE n % 5 WHEN 0 THEN 'front_matter' WHEN 1 THEN 'back_matter' ELSE 'body' END AS role"))
    return C.levels(C.labelled(rows))


@query(f"WITH {_ENTRIES} SELECT doc_id, entry_index, label_kind, label, title, concat_ws(' ', label, title) AS display_title, level::INT AS level FROM v")
def contents_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C16, W18, Z11, Z12."""
    return _entries(spark, sf_dir).select("doc_id", "entry_index", "label_kind", "label", "title", "display_title", F.col("level").cast("int").alias("level"))


@query(f"""WITH {_ENTRIES}, p AS (SELECT a.doc_id, a.entry_index, max(b.entry_index) AS parent FROM v a JOIN v b ON b.doc_id = a.doc_id AND b.entry_index < a.entry_index AND b.level < a.level AND NOT (b.level = 1 AND b.label IS NULL AND b.k IN (7, 8)) GROUP BY ALL),
q AS (SELECT v.*, p.parent, (v.k IN (0, 1, 10)) AS looks_body, v.k IN (5, 9) AS numeric_body FROM v LEFT JOIN p ON p.doc_id = v.doc_id AND p.entry_index = v.entry_index),
s AS (SELECT *, CASE WHEN looks_body OR numeric_body OR k = 6 THEN 'body' ELSE role END AS new_role FROM q), t AS (SELECT *, (label IS NULL AND new_role IN ('front_matter', 'back_matter')) OR k IN (7, 8) AS top FROM s)
SELECT doc_id, entry_index, new_role AS role, CASE WHEN top THEN 1 ELSE level END::INT AS level, CASE WHEN NOT top THEN parent END AS parent_index FROM t""")
def contents_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W17, Z9, Z10."""
    return C.with_hierarchy(_entries(spark, sf_dir)).select("doc_id", "entry_index", "role", F.col("level").cast("int").alias("level"), "parent_index")


# Visual relations


_SEEN = D.OBSERVATIONS + """, s AS (SELECT doc_id, page, 'o' || lpad(ord::VARCHAR, 6, '0') AS observation_id, kind, (['caption_text', 'title_text', 'body_text', 'body_text'])[n % 4 + 1] AS role_hint, CASE WHEN n % 9 = 0 THEN 'o' || lpad((ord - ord % 6)::VARCHAR, 6, '0') END AS parent_id, CASE WHEN n % 5 > 0 THEN ord END AS reading_order, x0, y0, x1, y1, n, ord FROM o),
pl AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY coalesce(reading_order, 999999), y0, x0, observation_id) AS place FROM s)"""


def _seen(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    ident = lambda c: F.format_string("o%06d", c)
    o = D.observations(spark, sf_dir).select("doc_id", "page", ident(F.col("ord")).alias("observation_id"), "kind", F.expr("get(array('caption_text', 'title_text', 'body_text', 'body_text'), cast(n % 4 AS int)) AS role_hint"), F.when(F.col("n") % 9 == 0, ident(F.col("ord") - F.col("ord") % 6)).alias("parent_id"), F.when(F.col("n") % 5 > 0, F.col("ord")).alias("reading_order"), "x0", "y0", "x1", "y1", "n", "ord")
    pages = o.select("doc_id", "page").distinct().withColumns({"width": F.lit(1000.0), "height": F.lit(760.0), "normal_gap": F.lit(8.0)})
    return o, pages, o.where("n % 16 = 4").select("doc_id", "observation_id")


@query(f"WITH {_SEEN} SELECT doc_id, page, observation_id, place FROM pl")
def page_reading_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1."""
    return V.reading_order(_seen(spark, sf_dir)[0]).select("doc_id", "page", "observation_id", F.col("place").cast("long").alias("place"))


@query(f"WITH {_SEEN} SELECT doc_id, observation_id, row_number() OVER (PARTITION BY doc_id ORDER BY page, coalesce(reading_order, 1000000), observation_id) AS place FROM s WHERE n % 7 = 0")
def table_reading_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3."""
    o = _seen(spark, sf_dir)[0].withColumn("kind", F.when(F.col("n") % 7 == 0, "table_region"))
    return V.table_order(o).select("doc_id", "observation_id", F.col("place").cast("long").alias("place"))


_CAPTIONS = _SEEN + """, mm AS (SELECT *, kind = 'text_region' AND n % 16 <> 4 AS may FROM pl), im AS (SELECT doc_id, page, x0 AS a0, y0 AS b0, x1 AS a1, y1 AS b1 FROM pl WHERE kind = 'image_region'),
nr AS (SELECT DISTINCT m.doc_id, m.observation_id FROM mm m JOIN im USING (doc_id, page) WHERE may AND role_hint IN ('caption_text', 'title_text') AND ((greatest(a0 - x1, x0 - a1, 0) <= 120 AND greatest(b0 - y1, y0 - b1, 0) <= 121.6) OR (least(x1, a1) - greatest(x0, a0) > 0 AND greatest(b0 - y1, y0 - b1, 0) <= 91.2))),
fi AS (SELECT mm.*, may AND (nr.doc_id IS NOT NULL OR parent_id IS NOT NULL) AS first FROM mm LEFT JOIN nr ON nr.doc_id = mm.doc_id AND nr.observation_id = mm.observation_id WHERE EXISTS (SELECT 1 FROM im WHERE im.doc_id = mm.doc_id AND im.page = mm.page)),
li AS (SELECT *, coalesce(may AND y0 - lag(y1) OVER w >= 0 AND y0 - lag(y1) OVER w <= greatest(48, (lag(y1) OVER w - lag(y0) OVER w) * 2.5) AND least(lag(x1) OVER w, x1) - greatest(lag(x0) OVER w, x0) >= 0 AND lag(role_hint) OVER w IN ('caption_text', 'title_text'), false) AS link FROM fi WINDOW w AS (PARTITION BY doc_id, page ORDER BY place)),
ch AS (SELECT *, sum(CASE WHEN link THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, page ORDER BY place) AS chain FROM li),
ca AS (SELECT * FROM (SELECT *, first OR (link AND coalesce(bool_or(first) OVER (PARTITION BY doc_id, page, chain ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false)) AS chosen FROM ch) WHERE chosen)"""


@query(f"WITH {_CAPTIONS} SELECT doc_id, page, observation_id FROM ca")
def caption_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J9, R2."""
    return V.caption_candidates(*_seen(spark, sf_dir)).select("doc_id", "page", "observation_id")


_GROUPS = _CAPTIONS + """, gr AS (SELECT ca.doc_id, ca.page, ca.parent_id AS image_id, string_agg(ca.observation_id, ',' ORDER BY ca.place) AS caption_ids FROM ca JOIN pl i ON i.doc_id = ca.doc_id AND i.page = ca.page AND i.observation_id = ca.parent_id AND i.kind = 'image_region' GROUP BY ALL)"""


@query(f"WITH {_GROUPS} SELECT * FROM gr")
def caption_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J8."""
    seen = _seen(spark, sf_dir)
    return V.parser_groups(seen[0], V.caption_candidates(*seen)).withColumn("caption_ids", F.array_join("caption_ids", ","))


@query(f"WITH {_GROUPS}, us AS (SELECT doc_id, image_id AS observation_id FROM gr UNION ALL SELECT ca.doc_id, ca.observation_id FROM ca JOIN gr ON gr.doc_id = ca.doc_id AND gr.page = ca.page AND gr.image_id = ca.parent_id), al AS (SELECT doc_id, page, observation_id, 'image' AS side FROM pl WHERE kind = 'image_region' UNION ALL SELECT doc_id, page, observation_id, 'caption' FROM ca) SELECT al.* FROM al WHERE NOT EXISTS (SELECT 1 FROM us WHERE us.doc_id = al.doc_id AND us.observation_id = al.observation_id)")
def unpaired_visuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the parser's own relations leave apart."""
    seen = _seen(spark, sf_dir)
    captions = V.caption_candidates(*seen)
    return V.unpaired(seen[0], captions, V.parser_groups(seen[0], captions))


@query(f"""WITH {D.LINES} SELECT doc_id, ord, CASE WHEN n % 4 = 0 THEN '<table><tr><td>' || n || '</td></tr></table>' WHEN n % 4 = 1 THEN '<table><tr><th>' || ord || '</th></tr></table>' ELSE '<table><tr><th>' || ord || '</th></tr><tr><td>' || n || '</td></tr></table>' END AS html, 'a,b' || n AS notes FROM l""")
def merged_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C24, U6, A17."""
    left = F.when(F.col("n") % 4 == 0, "").otherwise(F.format_string(" <table border='1'><tr><th>%d</th></tr></TABLE> ", "ord"))
    left = F.when(F.col("n") % 4 == 1, F.format_string("<table><tr><th>%d</th></tr></table>", "ord")).otherwise(left)
    right = F.when(F.col("n") % 4 == 1, "<table><tr><td>（续表）</td></tr></table>").when(F.col("n") % 4 == 0, F.format_string("<table><tr><td>%d</td></tr></table>", "n")).otherwise(F.format_string("<table><tr class='x'><td> 【接上页】 </td></tr><tr><td>%d</td></tr></table>", "n"))
    notes = V.ordered_union(F.array(F.lit("a"), F.concat(F.lit("b"), "n")), F.array(F.concat(F.lit("b"), "n"), F.lit("a")))
    return D.lines(spark, sf_dir).select("doc_id", "ord", V.merged_table_html(left, right).alias("html"), F.array_join(notes, ",").alias("notes"))


@query(f"""WITH {D.OBSERVATIONS}, t AS (SELECT doc_id, page, 'b' || ord AS block_id, ord, y0, y1, n % 2 = 0 AS is_marked FROM o), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, page ORDER BY ord DESC) = 1 AS last, row_number() OVER (PARTITION BY doc_id, page ORDER BY ord) = 1 AS first FROM t)
SELECT a.doc_id, a.block_id AS left_id, b.block_id AS right_id FROM r a JOIN r b ON b.doc_id = a.doc_id AND b.page = a.page + 1 WHERE a.last AND a.y1 >= 760 * 0.72 AND b.first AND b.y0 <= 760 * 0.28 AND b.is_marked""")
def continued_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R32."""
    o = D.observations(spark, sf_dir)
    return V.continued_tables(o.select("doc_id", "page", F.concat(F.lit("b"), "ord").alias("block_id"), "ord", "y0", "y1", (F.col("n") % 2 == 0).alias("is_marked")), D.pages(o))


# Note strategies


_NOTES = """r AS (SELECT l_orderkey AS doc_id, l_linenumber AS ref_id, l_partkey % 3 AS page, (l_suppkey % 4)::VARCHAR AS marker, 'c' || l_partkey % 2 AS scope_key FROM lineitem),
pn AS (SELECT l_orderkey AS doc_id, l_linenumber + 100 AS note_id, l_suppkey % 3 AS page, CASE WHEN l_partkey % 5 = 0 THEN '' ELSE (l_partkey % 4)::VARCHAR END AS marker FROM lineitem), en AS (SELECT l_orderkey AS doc_id, l_linenumber + 200 AS note_id, (l_partkey % 6)::VARCHAR AS marker, CASE WHEN l_suppkey % 3 = 0 THEN '' ELSE 'c' || l_suppkey % 2 END AS scope_key FROM lineitem),
ex AS (SELECT doc_id, page, marker, min(note_id) AS lo, count(*) AS n FROM pn WHERE marker <> '' GROUP BY ALL), ba AS (SELECT doc_id, page, min(note_id) AS bare, count(*) AS nb FROM pn WHERE marker = '' GROUP BY ALL), rr AS (SELECT *, count(*) OVER (PARTITION BY doc_id, page, marker) AS k FROM r),
pg AS (SELECT rr.doc_id, rr.ref_id, rr.page, rr.marker, rr.scope_key, CASE WHEN n = 1 THEN lo WHEN nb = 1 AND k = 1 THEN bare END AS note_id, CASE WHEN n = 1 THEN 'high' WHEN nb = 1 AND k = 1 THEN 'medium' END AS confidence FROM rr LEFT JOIN ex USING (doc_id, page, marker) LEFT JOIN ba USING (doc_id, page)),
sc AS (SELECT doc_id, scope_key, marker, min(note_id) AS c FROM en WHERE scope_key <> '' GROUP BY ALL HAVING count(*) = 1), bo AS (SELECT doc_id, marker, min(note_id) AS b FROM en GROUP BY ALL HAVING count(*) = 1)"""


def _strategies(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    li = D.table(spark, sf_dir, "lineitem")
    refs = li.selectExpr("l_orderkey AS doc_id", "l_linenumber AS ref_id", "l_partkey % 3 AS page", "cast(l_suppkey % 4 AS string) AS marker", "concat('c', l_partkey % 2) AS scope_key")
    page = li.selectExpr("l_orderkey AS doc_id", "l_linenumber + 100 AS note_id", "l_suppkey % 3 AS page", "if(l_partkey % 5 = 0, '', cast(l_partkey % 4 AS string)) AS marker")
    return refs, page, li.selectExpr("l_orderkey AS doc_id", "l_linenumber + 200 AS note_id", "cast(l_partkey % 6 AS string) AS marker", "if(l_suppkey % 3 = 0, '', concat('c', l_suppkey % 2)) AS scope_key")


@query(f"WITH {_NOTES} SELECT doc_id, ref_id, page, marker, note_id, confidence FROM pg")
def page_note_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4."""
    refs, page, _ = _strategies(spark, sf_dir)
    return V.resolve_page_footnotes(refs, page)


@query(f"WITH {_NOTES} SELECT r.doc_id, r.ref_id, r.marker, sc.c AS note_id FROM r LEFT JOIN sc USING (doc_id, scope_key, marker)")
def chapter_note_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J5."""
    refs, _, end = _strategies(spark, sf_dir)
    return V.resolve_endnotes(refs, end, True)


@query(f"WITH {_NOTES} SELECT pg.doc_id, pg.ref_id, coalesce(note_id, c, b) AS note_id, CASE WHEN note_id IS NOT NULL THEN 'page_footnote' WHEN c IS NOT NULL THEN 'chapter_endnote' WHEN b IS NOT NULL THEN 'book_endnote' END AS strategy FROM pg LEFT JOIN sc USING (doc_id, scope_key, marker) LEFT JOIN bo USING (doc_id, marker)")
def note_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strategies in their order."""
    return V.resolve_in_order(*_strategies(spark, sf_dir))


@query(f"WITH {_NOTES} SELECT doc_id, scope_key, array_to_string(list_sort(list(DISTINCT marker)), ',') AS markers FROM en WHERE marker <> '' GROUP BY doc_id, scope_key")
def note_markers_by_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A23."""
    return V.marker_inventory(_strategies(spark, sf_dir)[2]).withColumn("markers", F.array_join("markers", ","))
