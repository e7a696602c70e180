"""Queries of page roles, note sections and audits over pages derived from the documents' lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import note_sections as N
from quire.operators import pages as P
from quire.plans import derived as D
from quire.plans.functions_queries import query

_HINTS = "(['body_text', 'body_text', 'title_text', 'title_text', 'list_text', 'unknown', 'footnote_text', 'page_number', 'caption_text', 'body_text', 'toc_text'])"
_KIND = "CASE WHEN n % 11 < 2 THEN 'image_region' WHEN n % 13 = 0 THEN 'table_region' WHEN n % 11 = 6 THEN 'footnote_region' ELSE 'text_region' END"


def _observed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three lines a page; every seventh page has no observation; kinds and hints follow from a line's length."""
    hints = ",".join(f"'{x}'" for x in _HINTS.strip("([])").replace("'", "").replace(" ", "").split(","))
    o = D.observations(spark, sf_dir).selectExpr("doc_id", "ord", "n", "ord div 3 + 1 AS page", f"{_KIND} AS kind", f"get(array({hints}), cast((n + ord div 9) % 11 AS int)) AS role_hint", "x0", "y0 * 1.2D AS y0", "x1", "y1 * 1.2D + (n % 4) * 90 AS y1")
    pages = o.select("doc_id", "page").distinct().withColumns({"width": F.lit(1000.0), "height": F.lit(760.0)})
    return o.where("page % 7 <> 5"), pages, pages.where("page % 4 = 1").select("doc_id", "page")


_OBSERVED = D.OBSERVATIONS + f""", o1 AS (SELECT doc_id, ord, n, ord // 3 + 1 AS page, {_KIND} AS kind, {_HINTS}[(n + ord // 9) % 11 + 1] AS role_hint, x0, y0 * 1.2::DOUBLE AS y0, x1, y1 * 1.2::DOUBLE + (n % 4) * 90 AS y1 FROM o),
pg AS (SELECT DISTINCT doc_id, page FROM o1), ob AS (SELECT * FROM o1 WHERE page % 7 <> 5),
ob2 AS (SELECT *, kind IN ('text_region', 'footnote_region') AS t, kind IN ('image_region', 'table_region') AS v, greatest(x1 - x0, 0) * greatest(y1 - y0, 0) AS a FROM ob),
me AS (SELECT pg.doc_id, pg.page, count(kind) AS content_count, count(*) FILTER (t) AS text_count, count(*) FILTER (v) AS visual_count, count(*) FILTER (kind = 'table_region') AS table_count, count(*) FILTER (t AND role_hint = 'footnote_text' AND y0 < 532) AS body_zone_footnote_count,
 round(least(coalesce(sum(a) FILTER (v), 0) / 760000, 1), 4)::DOUBLE AS visual_area_ratio, round(least(coalesce(sum(a) FILTER (t), 0) / 760000, 1), 4)::DOUBLE AS text_area_ratio, coalesce(count(*) FILTER (t AND abs((x0 + x1) / 2 - 500) <= 180) / nullif(count(*) FILTER (t), 0), 0)::DOUBLE AS centered_text_ratio,
 count(*) FILTER (t AND x1 > x0 AND y1 - y0 >= (x1 - x0) * 2) AS tall_text_count, count(*) FILTER (role_hint NOT IN ('caption_text', 'footnote_text', 'unknown')) AS n_other, count(*) FILTER (role_hint = 'toc_text') AS n_toc, count(*) FILTER (role_hint = 'title_text') AS n_title, count(*) FILTER (role_hint = 'body_text') AS n_body,
 count(*) FILTER (role_hint IN ('body_text', 'list_text', 'reference_text', 'footnote_text')) AS n_flow, count(*) FILTER (role_hint = 'page_number') AS n_number FROM pg LEFT JOIN ob2 ON ob2.doc_id = pg.doc_id AND ob2.page = pg.page GROUP BY pg.doc_id, pg.page)"""


@query(f"WITH {_OBSERVED} SELECT doc_id, page, content_count, text_count, visual_count, table_count, body_zone_footnote_count, visual_area_ratio, text_area_ratio, round(centered_text_ratio, 9) AS centered_text_ratio, tall_text_count, n_other, n_toc AS n_toc_text, n_title AS n_title_text, n_body AS n_body_text, n_number AS n_page_number FROM me")
def page_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3, A4, A19."""
    o, pages, _ = _observed(spark, sf_dir)
    m = P.metrics(o, pages)
    names = ("content_count", "text_count", "visual_count", "table_count", "body_zone_footnote_count", "visual_area_ratio", "text_area_ratio", "tall_text_count", "n_other", "n_toc_text", "n_title_text", "n_body_text", "n_page_number")
    return m.select("doc_id", "page", *names, F.round("centered_text_ratio", 9).alias("centered_text_ratio"))


_OWN = _OBSERVED + """, ed AS (SELECT *, row_number() OVER w AS place, count(*) OVER (PARTITION BY doc_id) AS np, page % 4 = 1 AS prof, coalesce(page < min(CASE WHEN n_number > 0 THEN page END) OVER (PARTITION BY doc_id), false) AS prelude FROM me WINDOW w AS (PARTITION BY doc_id ORDER BY page)),
ee AS (SELECT *, least(24, greatest(4, round_even(np * 0.05, 0))) AS k FROM ed),
ef AS (SELECT *, place = 1 AS first, place = np AS last, place <= k AS early, np - place < k AS late, CASE WHEN prof THEN 'body_profile' ELSE 'no_body_profile' END AS said, content_count > 0 AND body_zone_footnote_count / nullif(content_count, 0) >= 0.5 AS note, text_count BETWEEN 1 AND 4 AS few, visual_count = 0 AS bare,
 visual_count > 0 AND (visual_area_ratio >= 0.55 OR (text_count = 0 AND visual_area_ratio >= 0.1) OR (visual_count >= 2 AND visual_area_ratio >= 0.45) OR (text_area_ratio <= 0.02 AND visual_area_ratio >= 0.15) OR (n_other = 0 AND text_area_ratio <= 0.03 AND visual_area_ratio >= 0.15)) AS cand,
 CASE WHEN visual_count > 0 AND visual_area_ratio >= 0.25 AND visual_area_ratio < 0.55 AND text_count BETWEEN 1 AND 4 AND text_area_ratio <= 0.18 THEN 'visual_verifier_candidate' END AS ver,
 CASE WHEN tall_text_count >= 2 THEN 'vertical_text_layout' WHEN text_count >= 8 AND visual_count = 0 AND text_area_ratio <= 0.3 AND centered_text_ratio >= 0.8 THEN 'dense_centered_nonflow_layout' END AS outlier FROM ee),
eg AS (SELECT *, CASE WHEN content_count = 0 THEN 1 WHEN prelude AND n_toc > 0 THEN 2 WHEN prelude AND note THEN 3 WHEN prelude AND visual_count > 0 THEN 4 WHEN prelude AND few AND bare AND text_area_ratio <= 0.02 AND centered_text_ratio >= 0.5 THEN 5 WHEN prelude AND outlier IS NOT NULL THEN 6 WHEN prelude THEN 7 WHEN n_toc > 0 THEN 8 WHEN note THEN 9 WHEN cand THEN 10
 WHEN last AND NOT first AND visual_count > 0 THEN 11 WHEN prof THEN 12 WHEN few AND bare AND n_title > 0 AND text_area_ratio <= 0.12 AND centered_text_ratio >= 0.5 THEN 13 WHEN n_flow > 0 THEN 14 WHEN (early OR late) AND text_count > 0 AND bare AND text_area_ratio <= 0.45 THEN 15 ELSE 16 END AS c FROM ef),
ow AS (SELECT *, CASE c WHEN 1 THEN 'blank_page' WHEN 2 THEN 'toc_page' WHEN 8 THEN 'toc_page' WHEN 3 THEN 'note_section_candidate' WHEN 9 THEN 'note_section_candidate' WHEN 4 THEN CASE WHEN first THEN 'cover_page' ELSE 'front_visual_page' END WHEN 5 THEN 'front_visual_page' WHEN 6 THEN 'front_visual_page' WHEN 7 THEN 'front_matter_page'
 WHEN 10 THEN CASE WHEN first THEN 'cover_page' WHEN early THEN 'front_visual_page' WHEN last THEN 'back_cover_candidate' ELSE 'visual_page' END WHEN 11 THEN 'back_cover_candidate' WHEN 12 THEN 'text_flow_page' WHEN 13 THEN 'title_like_page' WHEN 14 THEN 'text_flow_candidate' WHEN 15 THEN 'bibliographic_like_page' ELSE 'unknown' END AS page_role,
 CASE c WHEN 1 THEN CASE WHEN prelude OR early THEN 'front_matter' WHEN late THEN 'back_matter' ELSE 'body' END WHEN 10 THEN CASE WHEN first OR early THEN 'front_matter' WHEN last THEN 'back_matter' ELSE 'body' END WHEN 11 THEN 'back_matter' WHEN 13 THEN CASE WHEN early THEN 'front_matter' ELSE 'body' END WHEN 15 THEN CASE WHEN early THEN 'front_matter' ELSE 'back_matter' END
 WHEN 16 THEN 'unknown' ELSE CASE WHEN c IN (2, 4, 5, 6, 7, 8) THEN 'front_matter' ELSE 'body' END END AS flow_scope,
 CASE c WHEN 1 THEN 'no_content_observations' WHEN 2 THEN 'unnumbered_prelude,toc_hint,' || said WHEN 3 THEN 'unnumbered_prelude,note_section_hint,' || said WHEN 4 THEN 'unnumbered_prelude,visual_content,' || said WHEN 5 THEN 'unnumbered_prelude,sparse_centered_front_text,' || said WHEN 6 THEN 'unnumbered_prelude,' || outlier || ',' || said WHEN 7 THEN 'unnumbered_prelude,text_content,' || said
 WHEN 8 THEN 'toc_hint' WHEN 9 THEN 'note_section_hint' WHEN 10 THEN concat_ws(',', CASE WHEN visual_area_ratio >= 0.55 THEN 'visual_dominant' ELSE 'visual_sparse_text' END, 'no_body_profile', CASE WHEN early THEN 'early_page' END, CASE WHEN late THEN 'late_page' END) WHEN 11 THEN 'last_page_visual_content,' || said WHEN 12 THEN concat_ws(',', 'body_profile', ver)
 WHEN 13 THEN concat_ws(',', CASE WHEN early THEN 'early_page' END, 'sparse_centered_text', 'no_body_profile') WHEN 14 THEN concat_ws(',', 'text_flow_hint', 'no_body_profile', ver) WHEN 15 THEN 'text_without_body_profile,edge_page' ELSE 'no_body_profile' END AS signals FROM eg)"""


@query(f"WITH {_OWN} SELECT doc_id, page, page_role, flow_scope, signals FROM ow")
def page_own_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles by each page alone."""
    o, pages, profiles = _observed(spark, sf_dir)
    return P.own_roles(P.metrics(o, pages), profiles).select("doc_id", "page", "page_role", "flow_scope", F.array_join("signals", ",").alias("signals"))


@query(f"""WITH {_OWN}, r1 AS (SELECT *, min(CASE WHEN n_toc > 0 THEN place END) OVER (PARTITION BY doc_id) AS toc FROM ow), r2 AS (SELECT *, min(CASE WHEN n_title >= 2 AND n_body > 0 AND place > toc THEN place END) OVER (PARTITION BY doc_id) AS start FROM r1),
r3 AS (SELECT * EXCLUDE (page_role, flow_scope, signals), CASE WHEN p AND n_toc > 0 THEN 'toc_page' WHEN p AND flow_scope = 'body' THEN 'front_matter_page' ELSE page_role END AS page_role, CASE WHEN p AND (n_toc > 0 OR flow_scope = 'body') THEN 'front_matter' ELSE flow_scope END AS flow_scope,
 CASE WHEN p AND n_toc > 0 THEN 'book_front_prefix,toc_hint' WHEN p AND flow_scope = 'body' THEN 'book_front_prefix,before_body_anchor' ELSE signals END AS signals FROM (SELECT *, coalesce(place < start, false) AND page_role <> 'blank_page' AS p FROM r2)),
r4 AS (SELECT *, visual_count > 0 AND text_count <= 8 AND visual_area_ratio >= 0.15 AS seen FROM r3), r5 AS (SELECT *, sum(CASE WHEN seen THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY place) AS g FROM r4), r6 AS (SELECT *, seen AND count(*) FILTER (seen) OVER (PARTITION BY doc_id, g) >= 4 AND flow_scope = 'body' AND page_role NOT IN ('note_section_candidate', 'blank_page') AS long FROM r5),
r7 AS (SELECT * EXCLUDE (page_role, signals), CASE WHEN long THEN 'visual_page' ELSE page_role END AS page_role, CASE WHEN long THEN 'visual_run,' || signals ELSE signals END AS signals FROM r6),
r8 AS (SELECT *, page_role = 'note_section_candidate' AS note8, (flow_scope = 'body' OR page_role = 'blank_page') AND page_role NOT IN ('cover_page', 'front_visual_page', 'visual_page', 'back_cover_candidate', 'toc_page') AND visual_count = 0 AND table_count = 0 AS ok FROM r7),
r9 AS (SELECT *, max(CASE WHEN note8 THEN place END) OVER (PARTITION BY doc_id ORDER BY place) AS prev, min(CASE WHEN note8 THEN place END) OVER (PARTITION BY doc_id ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next FROM r8),
r10 AS (SELECT *, NOT note8 AND prev IS NOT NULL AND next IS NOT NULL AND next - prev - 1 <= 3 AND max(CASE WHEN NOT note8 AND NOT ok THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, prev ORDER BY place) = 0 AS filled FROM r9),
r11 AS (SELECT * EXCLUDE (page_role, flow_scope, signals), CASE WHEN filled THEN 'note_section_candidate' ELSE page_role END AS page_role, CASE WHEN filled THEN 'body' ELSE flow_scope END AS flow_scope, CASE WHEN filled THEN 'note_cluster_gap,' || signals ELSE signals END AS signals FROM r10),
r12 AS (SELECT *, min(CASE WHEN flow_scope = 'body' THEN place END) OVER (PARTITION BY doc_id) AS a, max(CASE WHEN flow_scope = 'body' THEN place END) OVER (PARTITION BY doc_id) AS z FROM r11),
r13 AS (SELECT *, CASE WHEN place < a AND flow_scope = 'back_matter' THEN 'front_matter' WHEN place BETWEEN a AND z AND flow_scope IN ('front_matter', 'back_matter') THEN 'body' WHEN place > z AND flow_scope = 'front_matter' THEN 'back_matter' END AS moved FROM r12)
SELECT doc_id, page, CASE WHEN moved = 'body' AND page_role IN ('back_cover_candidate', 'cover_page', 'front_visual_page') THEN 'visual_page' ELSE page_role END AS page_role, coalesce(moved, flow_scope) AS flow_scope, signals || CASE WHEN moved IS NOT NULL THEN ',book_scope_continuity' ELSE '' END AS signals FROM r13""")
def page_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roles in the order of the book."""
    return P.page_roles(*_observed(spark, sf_dir)).withColumn("signals", F.array_join("signals", ","))


@query(f"""WITH {_OBSERVED}, b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY page DESC) AS back FROM pg) SELECT b.doc_id, b.page FROM b JOIN ob2 USING (doc_id, page) WHERE back <= 8 GROUP BY b.doc_id, b.page HAVING bool_or(v) OR bool_or(role_hint IN ('footer', 'title_text', 'unknown')) OR (bool_or(t) AND NOT bool_or(role_hint IN ('header', 'page_number')))""")
def terminal_review_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F15."""
    o, pages, _ = _observed(spark, sf_dir)
    return P.terminal_reviews(o, pages)


@query(f"""WITH {_OBSERVED}, rv AS (SELECT doc_id, page, 'r' || page % 3 AS page_role, (['needs_review', 'exclude', 'metadata_only', 'include'])[page % 4 + 1] AS action, page % 4 AS k FROM pg), tp AS (SELECT DISTINCT doc_id, page, greatest(1, page - n % 3) AS primary_page FROM ob WHERE kind = 'table_region'),
bs AS (SELECT tp.doc_id, tp.page, tp.primary_page, rv.page_role, rv.action FROM tp JOIN rv ON rv.doc_id = tp.doc_id AND rv.page = tp.primary_page QUALIFY row_number() OVER (PARTITION BY tp.doc_id, tp.page ORDER BY rv.k DESC, tp.primary_page) = 1)
SELECT rv.doc_id, rv.page, CASE WHEN bs.primary_page <> rv.page THEN bs.page_role ELSE rv.page_role END AS page_role, CASE WHEN bs.primary_page <> rv.page THEN bs.action ELSE rv.action END AS action, CASE WHEN bs.primary_page <> rv.page THEN bs.primary_page END AS decided_by FROM rv LEFT JOIN bs USING (doc_id, page)""")
def table_page_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Continuation pages follow their tables' first pages."""
    o, pages, _ = _observed(spark, sf_dir)
    actions = F.array(*[F.lit(x) for x in ("needs_review", "exclude", "metadata_only", "include")])
    review = pages.select("doc_id", "page", F.concat(F.lit("r"), F.col("page") % 3).alias("page_role"), F.get(actions, (F.col("page") % 4).cast("int")).alias("action"))
    tables = o.where("kind = 'table_region'").select("doc_id", "page", F.greatest(F.lit(1).cast("long"), F.col("page") - F.col("n") % 3).alias("primary_page"))
    return P.follow_primary_tables(review, tables)


# Notes


_HEADS = "(['Notes', 'Chapter One', '参考文献', ' chapter  two ', '注释', 'Part'])"
_NODES = D.OBSERVATIONS + f""", n0 AS (SELECT doc_id, ord, 'n' || ord AS node_id, CASE n % 6 WHEN 0 THEN 'heading' WHEN 1 THEN 'note' WHEN 2 THEN 'paragraph' WHEN 3 THEN 'list_item' WHEN 4 THEN 'display_block' ELSE 'paragraph' END AS node_type, page, y0, n FROM o),
nd AS (SELECT *, CASE WHEN node_type = 'heading' THEN {_HEADS}[ord % 6 + 1] WHEN n % 4 = 0 THEN (n % 90)::VARCHAR || '. said ' || n ELSE 'said ' || n END AS text, CASE WHEN node_type <> 'heading' AND n % 4 = 0 THEN (n % 90)::VARCHAR ELSE '' END AS lead FROM n0)"""


def _nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = ",".join(f"'{x}'" for x in ("Notes", "Chapter One", "参考文献", " chapter  two ", "注释", "Part"))
    n = D.observations(spark, sf_dir).selectExpr("doc_id", "ord", "concat('n', ord) AS node_id", "CASE n % 6 WHEN 0 THEN 'heading' WHEN 1 THEN 'note' WHEN 2 THEN 'paragraph' WHEN 3 THEN 'list_item' WHEN 4 THEN 'display_block' ELSE 'paragraph' END AS node_type", "page", "y0", "n")
    return n.selectExpr("*", f"CASE WHEN node_type = 'heading' THEN get(array({heads}), cast(ord % 6 AS int)) WHEN n % 4 = 0 THEN concat(n % 90, '. said ', n) ELSE concat('said ', n) END AS text", "cast(NULL AS string) AS marker")


@query(f"""WITH {_NODES}, a AS (SELECT *, node_type = 'heading' AND ord % 6 IN (0, 4) AS opens, node_type = 'heading' AND ord % 6 = 2 AS stops, max(page) OVER (PARTITION BY doc_id) AS last_page FROM nd), b AS (SELECT *, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY ord) AS section FROM a),
c AS (SELECT *, section > 0 AND max(stops::INT) OVER (PARTITION BY doc_id, section ORDER BY ord) = 0 AS inside, first_value(page) OVER (PARTITION BY doc_id, section ORDER BY ord) >= greatest(1, round_even(last_page * 0.6, 0)) AS late FROM b),
d AS (SELECT *, inside AND node_type = 'heading' AND NOT opens AS sets FROM c), e AS (SELECT *, CASE WHEN inside THEN coalesce(last_value(CASE WHEN sets THEN lower(regexp_replace(text, '\\s+', '', 'g')) END IGNORE NULLS) OVER (PARTITION BY doc_id, section ORDER BY ord), '') END AS scope_key, CASE WHEN inside THEN CASE WHEN late THEN 'book_end' ELSE 'chapter_end' END END AS placement FROM d),
f AS (SELECT *, inside AND node_type IN ('note', 'paragraph', 'list_item') AND (node_type = 'note' OR lead <> '') AS is_entry FROM e)
SELECT doc_id, node_id, CASE WHEN is_entry THEN 'note' ELSE node_type END AS node_type, CASE WHEN is_entry AND node_type <> 'note' THEN 'said ' || n ELSE text END AS text, CASE WHEN is_entry OR opens OR sets THEN section END::BIGINT AS section_no, scope_key, placement, CASE WHEN is_entry THEN CASE WHEN scope_key <> '' THEN 'chapter' WHEN placement = 'book_end' THEN 'book' ELSE 'unknown' END END AS scope,
 CASE WHEN node_type IN ('note', 'paragraph', 'list_item') THEN lead END AS note_marker, is_entry AND node_type <> 'note' AS is_promoted FROM f""")
def note_section_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W14, Z13, F12, C11, C14."""
    n = N.note_sections(_nodes(spark, sf_dir))
    return n.select("doc_id", "node_id", "node_type", "text", F.col("section_no").cast("long").alias("section_no"), "scope_key", "placement", "scope", "note_marker", "is_promoted")


@query(f"""WITH {_NODES}, r AS (SELECT *, count(*) OVER (PARTITION BY doc_id, page) AS k FROM nd WHERE n % 2 = 0) SELECT doc_id, node_id, lead AS note_marker FROM r WHERE k <= 3 AND node_type <> 'note' AND lead <> '' AND y0 / 760 >= 0.55""")
def page_foot_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R24, with at most three reference texts a page."""
    n = _nodes(spark, sf_dir).withColumn("is_reference", F.col("n") % 2 == 0)
    return N.page_foot_references(n, D.pages(n), most=3)


@query(f"""WITH {_NODES}, f AS (SELECT *, CASE WHEN node_type = 'note' THEN 'footnote' ELSE node_type END AS kind, page % 3 = 0 AS apart FROM nd)
SELECT doc_id, node_id, CASE WHEN kind = 'footnote' THEN 'note' ELSE kind END AS node_type, CASE WHEN kind = 'footnote' THEN 'said ' || n ELSE text END AS text, CASE WHEN kind = 'footnote' THEN lead END AS note_marker, CASE WHEN kind = 'footnote' THEN CASE WHEN apart THEN 'note_section_candidate' ELSE 'page_foot' END END AS placement, CASE WHEN kind = 'footnote' THEN CASE WHEN apart THEN 'unknown' ELSE 'page' END END AS scope FROM f""")
def normalised_footnotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R23."""
    n = _nodes(spark, sf_dir).withColumn("node_type", F.when(F.col("node_type") == "note", "footnote").otherwise(F.col("node_type"))).withColumn("page_role", F.when(F.col("page") % 3 == 0, "note_section_candidate"))
    return N.normalised_notes(n)


@query(f"""WITH {_NODES}, d AS (SELECT doc_id, node_id, 'short_text' || CASE WHEN y0 <= 360 THEN ',top_of_page' ELSE '' END || ',no_sentence_terminal' AS why, y0 <= 360 AS top FROM nd WHERE node_type = 'display_block') SELECT doc_id, node_id, 'heading_like' AS finding, why AS reasons FROM d WHERE top""")
def display_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: displays that look like headings."""
    return N.display_audit(_nodes(spark, sf_dir).withColumn("layout_context", F.lit("inline_flow")))


@query(f"""WITH {_NODES}, c AS (SELECT doc_id, count(*) FILTER (node_type = 'display_block') AS display_block_count, count(*) FILTER (node_type = 'paragraph') AS paragraph_count FROM nd GROUP BY doc_id) SELECT doc_id, display_block_count, paragraph_count, 'display_blocks_outnumber_paragraphs' AS warning FROM c WHERE display_block_count > paragraph_count""")
def structure_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A15."""
    return N.structure_warnings(_nodes(spark, sf_dir))


@query("""WITH r AS (SELECT l_orderkey AS doc_id, CASE WHEN l_suppkey % 3 > 0 THEN l_partkey END AS note_id FROM lineitem) SELECT doc_id, count(*) AS n_references, count(note_id) AS n_resolved, round_even(count(note_id) / count(*), 4) AS ratio FROM r GROUP BY doc_id""")
def reference_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10, A11."""
    return N.reference_ratio(D.table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS doc_id", "if(l_suppkey % 3 > 0, l_partkey, NULL) AS note_id"))


@query("""WITH r AS (SELECT l_orderkey AS doc_id, CASE l_suppkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'page_foot' END AS placement, CASE WHEN l_partkey % 2 = 0 THEN 'page' END AS scope FROM lineitem) SELECT doc_id, coalesce(nullif(placement, ''), 'unknown') AS placement, coalesce(scope, 'unknown') AS scope, count(*) AS n FROM r GROUP BY ALL""")
def note_placements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11."""
    return N.placement_counts(D.table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS doc_id", "CASE l_suppkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'page_foot' END AS placement", "if(l_partkey % 2 = 0, 'page', NULL) AS scope"))


@query(f"WITH {D.OBSERVATIONS} SELECT doc_id, count(*) AS n, count(*) FILTER (n % 3 > 0) AS with_page, count(*) FILTER (n % 4 > 0) AS with_bbox FROM o GROUP BY doc_id")
def evidence_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10."""
    o = D.observations(spark, sf_dir)
    return N.evidence_summary(o.select("doc_id", F.when(F.col("n") % 3 > 0, F.col("page")).alias("page"), F.when(F.col("n") % 4 > 0, F.array("x0", "y0", "x1", "y1")).alias("bbox")))
