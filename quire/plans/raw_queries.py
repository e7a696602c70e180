"""Queries of the parser's rows and of what is published of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import raw_layout as R
from quire.operators import vectors
from quire.plans import derived as D
from quire.plans.functions_queries import query

_KINDS = "(['paragraph', 'title', 'image', 'paragraph', 'list', 'page_number', 'table', 'paragraph', 'title'])"
_RAW = D.OBSERVATIONS + f""", r AS (SELECT doc_id, ord, ord // 3 + 1 AS page, n, {_KINDS}[n % 9 + 1] AS raw_type, CASE WHEN n % 2 = 0 THEN repeat('w', (n % 70)::INT) ELSE repeat('w', (n % 30)::INT) END AS text, x0, y0, x1 + (n % 3) * 90 AS x1, y1 + (n % 5) * 100 AS y1 FROM o)"""


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = ",".join(f"'{x}'" for x in _KINDS.strip("([])").replace("'", "").replace(" ", "").split(","))
    return D.observations(spark, sf_dir).selectExpr("doc_id", "ord", "ord AS index", "ord div 3 + 1 AS page", "n", f"get(array({kinds}), cast(n % 9 AS int)) AS raw_type", "if(n % 2 = 0, repeat('w', cast(n % 70 AS int)), repeat('w', cast(n % 30 AS int))) AS text", "x0", "y0", "x1 + (n % 3) * 90 AS x1", "y1 + (n % 5) * 100 AS y1")


def _sizes(raw: DataFrame) -> DataFrame:
    return raw.select("doc_id", "page").distinct().withColumns({"width": F.lit(600.0) + F.col("page") % 3, "height": F.when(F.col("page") % 4 > 0, 800.0).otherwise(0.0)})


_STATS = _RAW + """, z AS (SELECT DISTINCT doc_id, page, 600.0::DOUBLE + page % 3 AS width, CASE WHEN page % 4 > 0 THEN 800.0::DOUBLE ELSE 0 END AS height FROM r), st0 AS (SELECT doc_id, coalesce(median(width), 1000) AS page_width, coalesce(median(CASE WHEN height > 0 THEN height END), 1000) AS page_height FROM z GROUP BY doc_id),
st1 AS (SELECT r.doc_id, median(x0) AS l, median(x1) AS rr FROM r JOIN st0 USING (doc_id) WHERE page >= 20 AND raw_type = 'paragraph' AND length(text) >= 60 AND x1 - x0 > page_width * 0.55 GROUP BY r.doc_id),
st AS (SELECT st0.doc_id, page_width, page_height, coalesce(l, page_width * 0.13) AS body_left, coalesce(rr, page_width * 0.88) AS body_right FROM st0 LEFT JOIN st1 USING (doc_id))"""


@query(f"WITH {_STATS} SELECT doc_id, page_width, page_height, round(body_left, 6) AS body_left, round(body_right, 6) AS body_right FROM st")
def raw_layout_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8."""
    raw = _raw(spark, sf_dir)
    s = R.layout_stats(raw, _sizes(raw))
    return s.withColumns({c: F.round(c, 6) for c in ("body_left", "body_right")})


@query(f"WITH {_STATS} SELECT doc_id, ord, x0 >= body_left + 35 OR x1 - x0 <= (body_right - body_left) * 0.82 AS is_short_or_indented, x0 >= body_left + 18 OR x1 - x0 <= (body_right - body_left) * 0.95 AS is_set_off, length(text) <= 20 AND x0 > body_left + (body_right - body_left) * 0.65 AS is_right_short FROM r JOIN st USING (doc_id)")
def raw_layout_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Z40."""
    raw = _raw(spark, sf_dir)
    b = raw.join(R.layout_stats(raw, _sizes(raw)), "doc_id")
    return b.select("doc_id", "ord", *[c.alias(n) for n, c in R.layout_tests(F.col("x0"), F.col("x1"), F.col("text"), F.col("body_left"), F.col("body_right")).items()])


@query(f"""WITH {_STATS}, c AS (SELECT r.*, page_height, body_right - body_left AS lane, raw_type <> 'page_number' AND (length(text) > 0 OR raw_type IN ('image', 'table')) AS ct, raw_type IN ('paragraph', 'title') AND length(text) > 0 AS tx FROM r JOIN st USING (doc_id)),
g AS (SELECT doc_id, page, bool_or(raw_type = 'image') AS has_images, count(*) FILTER (ct) AS n, count(*) FILTER (ct AND raw_type = 'title') AS nt, count(*) FILTER (ct AND tx) AS nx, count(*) FILTER (ct AND tx AND raw_type = 'title') AS nxt, coalesce(max(length(text)) FILTER (ct AND tx), 0) AS longest, count(*) FILTER (ct AND raw_type = 'image') AS ni, count(*) FILTER (ct AND raw_type NOT IN ('image', 'paragraph', 'title')) AS no,
 min(x0) FILTER (ct) AS ux0, min(y0) FILTER (ct) AS uy0, max(x1) FILTER (ct) AS ux1, max(y1) FILTER (ct) AS uy1, min(x0) FILTER (raw_type = 'image') AS ix0, min(x1) FILTER (raw_type = 'image') AS ix1, min(y1) FILTER (raw_type = 'image') AS iy1, any_value(page_height) AS ph, any_value(lane) AS lane FROM c GROUP BY ALL),
h AS (SELECT *, CASE WHEN ux1 > 650 OR uy1 > 750 THEN 1000 ELSE ph END AS high FROM g), bad AS (SELECT DISTINCT c.doc_id, c.page FROM c JOIN h USING (doc_id, page) WHERE ct AND tx AND NOT (c.x0 >= ix0 - 20 AND c.x1 <= ix1 + 20 AND c.y0 <= iy1 + high * 0.12))
SELECT h.doc_id, h.page, has_images, n > 0 AND ((nt = n AND n <= 3) OR (nx = n AND nx <= 4 AND nxt > 0 AND longest <= 24)) AS is_title_only, coalesce(ni = 1 AND nx > 0 AND longest <= 24 AND no = 0 AND (ix1 - ix0 >= lane * 0.95 OR ux1 - ux0 >= lane * 1.05) AND uy1 - uy0 >= high * 0.55 AND bad.doc_id IS NULL, false) AS is_full_page_image FROM h LEFT JOIN bad ON bad.doc_id = h.doc_id AND bad.page = h.page""")
def raw_page_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F7, F10, Z41."""
    raw = _raw(spark, sf_dir)
    return R.page_kinds(raw, R.layout_stats(raw, _sizes(raw)))


@query(f"""WITH {D.OBSERVATIONS}, t AS (SELECT doc_id, ord // 3 AS page, kind, CASE WHEN n % 3 = 0 THEN 'title_text' ELSE 'body_text' END AS hint, x0 + 150 AS x0, x0 + 350 + (n % 5) * 100 AS x1, y0 / 3 AS y0, y0 / 3 + 20 AS y1 FROM o), u AS (SELECT *, min(CASE WHEN hint = 'title_text' AND kind = 'text_region' THEN y0 END) OVER (PARTITION BY doc_id, page) AS top, max(CASE WHEN hint = 'title_text' AND kind = 'text_region' THEN y1 END) OVER (PARTITION BY doc_id, page) AS foot FROM t)
SELECT doc_id, page FROM u GROUP BY doc_id, page HAVING count(*) FILTER (kind = 'image_region') = 0 AND count(*) BETWEEN 2 AND 4 AND bool_or(hint = 'title_text') AND bool_or(hint = 'body_text') AND count(*) FILTER (hint = 'body_text' AND NOT coalesce(x1 - x0 <= 550 AND abs((x0 + x1) / 2 - 500) <= 120 AND y0 >= top - 91.2 AND y1 <= foot + 91.2, false)) = 0""")
def title_cluster_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W31."""
    o = D.observations(spark, sf_dir).selectExpr("doc_id", "ord div 3 AS page", "kind", "if(n % 3 = 0, 'title_text', 'body_text') AS role_hint", "x0 + 150 AS x0", "x0 + 350 + (n % 5) * 100 AS x1", "y0 / 3 AS y0", "y0 / 3 + 20 AS y1")
    return R.title_cluster_pages(o, D.pages(o))


@query(f"WITH {D.OBSERVATIONS} SELECT doc_id, ord, x1 - x0 >= 480 AND abs(x0 - 120) <= 12 AND abs(x1 - 620) <= 16 AS strict, x1 - x0 >= 350 AND abs(x0 - 120) <= 30 AND abs(x1 - 620) <= 40 AS loose FROM o")
def body_like_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4."""
    test = lambda s: R.is_body_like(F.col("x0"), F.col("x1"), F.lit(120.0), F.lit(620.0), s)
    return D.observations(spark, sf_dir).select("doc_id", "ord", test(True).alias("strict"), test(False).alias("loose"))


@query(f"WITH {D.OBSERVATIONS}, e AS (SELECT doc_id, page, (n % 4) * 40.0::DOUBLE + ord % 2 AS x FROM o WHERE line <> '') SELECT doc_id, page, dense_rank() OVER (PARTITION BY doc_id, page ORDER BY k)::INT AS cluster, lft AS \"left\", n FROM (SELECT doc_id, page, floor(x / 40) AS k, median(x) AS lft, count(*) AS n FROM e GROUP BY ALL)")
def contents_left_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A22."""
    b = D.observations(spark, sf_dir).select("doc_id", "page", F.col("ord").alias("index"), F.lit("paragraph").alias("raw_type"), F.when(F.col("line") != "", "entry").otherwise("").alias("text"), ((F.col("n") % 4) * 40.0 + F.col("ord") % 2).alias("x0"))
    return R.left_edges(b)


_ROLES = "(['body_text', 'title_text', 'unknown', 'body_text', 'list_text', 'page_number', 'unknown', 'body_text', 'title_text'])"
_OKINDS = "(['text_region', 'text_region', 'image_region', 'text_region', 'text_region', 'page_marker', 'table_region', 'text_region', 'text_region'])"


@query(f"WITH {_RAW} SELECT doc_id, ord, {_ROLES}[n % 9 + 1] AS role_hint, {_OKINDS}[n % 9 + 1] AS kind FROM r")
def raw_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P15."""
    return _raw(spark, sf_dir).select("doc_id", "ord", R.role_hint(F.col("raw_type"), F.lit(True)).alias("role_hint"), R.observation_kind(F.col("raw_type")).alias("kind"))


@query(f"WITH {_RAW} SELECT doc_id, ord, CASE {_ROLES}[n % 9 + 1] WHEN 'title_text' THEN 'heading' WHEN 'list_text' THEN 'list_item' ELSE 'paragraph' END AS candidate_type FROM r WHERE {_OKINDS}[n % 9 + 1] = 'text_region' AND page % 3 > 0")
def text_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2, F3, J21."""
    raw = _raw(spark, sf_dir)
    o = raw.withColumns({"kind": R.observation_kind(F.col("raw_type")), "role_hint": R.role_hint(F.col("raw_type"), F.lit(False))})
    review = raw.select("doc_id", "page").distinct().withColumn("action", F.when(F.col("page") % 3 > 0, "include").otherwise("exclude"))
    return R.candidates(o, review)[0].select("doc_id", "ord", "candidate_type")


@query(f"WITH {_RAW} SELECT doc_id, {_OKINDS}[n % 9 + 1] AS kind, count(*) AS n FROM r WHERE {_OKINDS}[n % 9 + 1] <> 'text_region' AND page % 3 > 0 GROUP BY ALL")
def ignored_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3."""
    raw = _raw(spark, sf_dir)
    o = raw.withColumns({"kind": R.observation_kind(F.col("raw_type")), "role_hint": R.role_hint(F.col("raw_type"), F.lit(False))})
    review = raw.select("doc_id", "page").distinct().withColumn("action", F.when(F.col("page") % 3 > 0, "include").otherwise("exclude"))
    return R.candidates(o, review)[1]


@query(f"WITH {_RAW} SELECT DISTINCT doc_id, page FROM r WHERE page % 3 = 0")
def excluded_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U1."""
    pages = _raw(spark, sf_dir).select("doc_id", "page").distinct()
    return R.excluded_pages(pages, pages.withColumn("action", F.when(F.col("page") % 3 > 0, "include").otherwise("exclude")))


@query(f"WITH {D.LINES} SELECT doc_id, ord, CASE WHEN n % 3 = 0 THEN 'group' ELSE 'inline_display_block' END AS layout_role, CASE WHEN n % 2 = 0 THEN 3 ELSE 2 END::INT AS line_count, n % 2 = 0 AS has_attribution_line FROM l")
def public_displays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P13."""
    text = F.when(F.col("n") % 2 == 0, "a\n\n b\n —— someone").otherwise("a\n  \nb")
    d = D.lines(spark, sf_dir).select("doc_id", "ord", R.public_display(text, F.when(F.col("n") % 3 == 0, "group")).alias("d"))
    return d.select("doc_id", "ord", "d.*")


@query("SELECT doc_id, regexp_replace(coalesce(source, '') || ' v1.' || doc_id, '[^A-Za-z0-9_\\-]+', '_', 'g') AS stem FROM documents")
def stem_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Z52."""
    path = F.concat(F.lit("/in/put.d/"), F.coalesce("source", F.lit("")), F.lit(" v1."), F.col("doc_id").cast("string"), F.lit(".pdf"))
    return D.table(spark, sf_dir, "documents").select("doc_id", R.stem_id(path).alias("stem"))


@query("SELECT row_number() OVER (ORDER BY s DESC, vec_id) AS rank, vec_id AS vector_id, round(s, 9) AS score, label, substr(repeat(label::VARCHAR || ' text ', 200), 1, 500) AS preview FROM (SELECT v.vec_id, v.label, list_sum(list_transform(range(1, 65), lambda i: v.embedding[i]::DOUBLE * q.embedding[i]::DOUBLE)) AS s FROM embeddings v, (SELECT embedding FROM embeddings WHERE vec_id = 3) q) ORDER BY s DESC, vec_id LIMIT 7")
def search_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query's hits with their rows and a preview."""
    e = D.table(spark, sf_dir, "embeddings")
    q = e.where("vec_id = 3").first()["embedding"]
    found = vectors.top_k(e.select(F.col("vec_id").alias("vector_id"), "embedding"), q, 7)
    store = e.select(F.col("vec_id").alias("vector_id"), "label", F.repeat(F.concat(F.col("label").cast("string"), F.lit(" text ")), F.lit(200)).alias("text"))
    h = R.hits(found, store)
    return h.select(F.col("rank").cast("long").alias("rank"), "vector_id", F.round("score", 9).alias("score"), "label", R.preview(F.col("text")).alias("preview"))


@query("""WITH n AS (SELECT l_orderkey AS doc_id, l_linenumber AS note_id, CASE WHEN l_partkey % 3 > 0 THEN 'm' ELSE '' END AS marker FROM lineitem), r AS (SELECT l_orderkey AS doc_id, CASE WHEN l_suppkey % 2 = 0 THEN l_suppkey % 6 END AS note_id FROM lineitem), j AS (SELECT n.*, EXISTS (SELECT 1 FROM r WHERE r.doc_id = n.doc_id AND r.note_id = n.note_id) AS used FROM n)
SELECT j.doc_id, count(*) AS n_notes, count(*) FILTER (used) AS n_referenced, count(*) FILTER (NOT used AND marker <> '') AS n_missing_marked, count(*) FILTER (NOT used AND marker = '') AS n_missing_unmarked, any_value(u.k) AS n_unresolved FROM j JOIN (SELECT doc_id, count(*) FILTER (note_id IS NULL) AS k FROM r GROUP BY doc_id) u USING (doc_id) GROUP BY j.doc_id""")
def note_gap_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A12, K8."""
    li = D.table(spark, sf_dir, "lineitem")
    return R.note_gaps(li.selectExpr("l_orderkey AS doc_id", "l_linenumber AS note_id", "if(l_partkey % 3 > 0, 'm', '') AS marker"), li.selectExpr("l_orderkey AS doc_id", "if(l_suppkey % 2 = 0, l_suppkey % 6, NULL) AS note_id"))


@query(f"WITH {D.LINES} SELECT doc_id, ord, (n % 5000)::INT AS width, (ord % 300)::INT AS height FROM l WHERE n % 4 > 0 UNION ALL SELECT doc_id, ord, NULL, NULL FROM l WHERE n % 4 = 0")
def png_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S24."""
    head = F.when(F.col("n") % 4 > 0, "89504E470D0A1A0A0000000D49484452").otherwise("89504E470D0A1A0A0000000D49444154")
    content = F.unhex(F.concat(head, F.format_string("%08x%08x", F.col("n") % 5000, F.col("ord") % 300)))
    return D.lines(spark, sf_dir).select("doc_id", "ord", R.png_size(content).alias("s")).select("doc_id", "ord", "s.width", "s.height")


@query(f"WITH {D.LINES} SELECT doc_id, ord, CASE n % 3 WHEN 0 THEN 'abc|1' WHEN 1 THEN 'abc|1| d' ELSE '' END AS before, CASE n % 3 WHEN 0 THEN 'd ef' WHEN 1 THEN 'ef' ELSE '' END AS after FROM l")
def parted_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs parted at 4, at 5 and beyond their end."""
    run = lambda kind, text, marker: F.struct(F.lit(kind).alias("type"), F.lit(text).cast("string").alias("text"), F.lit(marker).cast("string").alias("marker"))
    runs = F.array(run("text", "abc", None), run("note_ref", None, "1"), run("text", " d ef", None))
    s = R.split_runs(runs, F.get(F.array(F.lit(4), F.lit(5), F.lit(99)), (F.col("n") % 3).cast("int")))
    show = lambda side: F.array_join(F.transform(side, lambda r: F.coalesce(r["text"], r["marker"])), "|")
    return D.lines(spark, sf_dir).select("doc_id", "ord", s.alias("s")).select("doc_id", "ord", show(F.col("s.before")).alias("before"), show(F.col("s.after")).alias("after"))


@query(f"WITH {D.OBSERVATIONS} SELECT doc_id, ord, CASE WHEN n % 3 > 0 THEN page END AS page, CASE WHEN n % 3 > 0 THEN x0 END AS x0 FROM o")
def source_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3, P11."""
    o = D.observations(spark, sf_dir).select("doc_id", "ord", R.box_reference(F.when(F.col("n") % 3 > 0, F.col("page")), F.array("x0", "y0", "x1", "y1")).alias("s"))
    return o.select("doc_id", "ord", "s.page", F.col("s.bbox")[0].alias("x0"))
