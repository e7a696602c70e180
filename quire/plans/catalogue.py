"""Named queries of the engine and their DuckDB equivalents, by operator of the survey."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import geometry
from quire.functions import text as T
from quire.operators import chunking, constraints, flow, graph, layout, notes, skeleton, tables, vectors
from quire.plans import derived as D
from quire.plans import book_queries, contract_queries, decision_queries, epub_queries, extraction_queries, flow_queries, functions_queries, observed_queries, page_queries, raw_queries, repair_queries  # noqa: F401  the former registers with the latter
from quire.sources import html

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}
_WHITE = r"\x{0009}-\x{000D}\x{001C}-\x{0020}\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_STRIP = rf"regexp_replace(%s, '^[{_WHITE}]+|[{_WHITE}]+$', '', 'g')"


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return _QUERIES | functions_queries.QUERIES


def oracle_sql() -> dict[str, str]:
    return _SQL | functions_queries.SQL


# Text functions


@_query(f"SELECT doc_id, CASE WHEN length({_STRIP % 'text'}) = 0 THEN 0 ELSE greatest(1, length({_STRIP % 'text'}) // 2) END::INT AS token_count FROM documents")
def token_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1."""
    return D.table(spark, sf_dir, "documents").select("doc_id", T.token_estimate(F.col("text")).alias("token_count"))


@_query(f"WITH {D.LINES} SELECT doc_id, ord, {_STRIP % rf'''regexp_replace(regexp_replace(line, '[ \t]+', ' ', 'g'), '[{_WHITE}]+([，。；：？！、）】》])', '\1', 'g')'''} AS line FROM l")
def normalize_ws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4."""
    return D.lines(spark, sf_dir).select("doc_id", "ord", T.normalise_ws(F.col("line")).alias("line"))


@_query(rf"WITH {D.LINES} SELECT doc_id, ord, regexp_replace(line, '[{_WHITE},，.。:：;；/／\\\-—–·•…*＊①②③④⑤⑥⑦⑧⑨⑩《》〈〉（）()【】\[\]]+', '', 'g') AS title_key FROM l")
def title_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line as a title."""
    return D.lines(spark, sf_dir).select("doc_id", "ord", T.title_key(F.col("line")).alias("title_key"))


@_query(rf"""WITH {D.LINES}, m AS (SELECT doc_id, ord, CASE n % 5 WHEN 0 THEN (n % 10)::VARCHAR || '. ' || line WHEN 1 THEN '* ' || line WHEN 2 THEN (n % 10)::VARCHAR || 'rd ' || line WHEN 3 THEN '1999 ' || line ELSE '† ' || line END AS text FROM l),
y AS (SELECT *, regexp_replace(text, '^([0-9]{{1,2}}|[*†])([{_WHITE}]+|[.．、:：)）\]］][{_WHITE}]*)', '') AS cut FROM m) SELECT doc_id, ord, CASE WHEN cut <> '' THEN cut ELSE text END AS text FROM y""")
def strip_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3."""
    m = D.lines(spark, sf_dir).selectExpr(
        "doc_id", "ord", "CASE n % 5 WHEN 0 THEN concat(n % 10, '. ', line) WHEN 1 THEN concat('* ', line) WHEN 2 THEN concat(n % 10, 'rd ', line) WHEN 3 THEN concat('1999 ', line) ELSE concat('† ', line) END AS text",
        "CASE n % 5 WHEN 0 THEN cast(n % 10 AS string) WHEN 1 THEN '*' END AS marker",
    )
    return m.select("doc_id", "ord", T.strip_note_marker(F.col("text"), F.col("marker")).alias("text"))


# Chunking


_CHUNK_SQL = """WITH b AS (SELECT conv_id AS doc_id, turn, role, text, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS part FROM conversations),
h AS (SELECT doc_id, part, text AS head FROM b WHERE role = 'user'),
c AS (SELECT doc_id, part, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS text, list('t' || turn ORDER BY turn) AS block_ids, min(turn) AS first FROM b WHERE role <> 'user' AND text <> '' GROUP BY ALL)
SELECT c.doc_id, c.doc_id || '-chat-' || lpad((row_number() OVER (PARTITION BY c.doc_id ORDER BY first))::VARCHAR, 6, '0') AS chunk_id, c.text, coalesce(h.head, c.doc_id::VARCHAR) AS chapter_title, array_to_string(block_ids, ',') AS block_ids,
 greatest(1, length(trim(c.text, ' ' || chr(10))) // 2)::INT AS token_count FROM c LEFT JOIN h ON h.doc_id = c.doc_id AND h.part = c.part"""


@_query(_CHUNK_SQL)
def rag_chunks_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's turn is a heading, other turns its text."""
    c = D.table(spark, sf_dir, "conversations")
    none = lambda kind: F.lit(None).cast(kind)
    blocks = c.select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("ord"), F.concat(F.lit("t"), "turn").alias("block_id"), F.when(F.col("role") == "user", "heading").otherwise("paragraph").alias("type"), "text", F.lit(1).alias("level"), none("int").alias("page"), none("array<double>").alias("bbox"), none("string").alias("note_marker"))
    docs = c.select(F.col("conv_id").alias("doc_id"), none("string").alias("title"), F.lit("chat").alias("parser_name")).distinct()
    return chunking.chunks(blocks, docs).select("doc_id", "chunk_id", "text", "chapter_title", F.array_join("block_ids", ",").alias("block_ids"), "token_count")


@_query(f"""WITH RECURSIVE {D.LINES}, h AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS k, ord, (1 + n % 4)::INT AS level, line AS t FROM l),
f AS (SELECT doc_id, k, ord, [t] AS path FROM h WHERE k = 1 UNION ALL SELECT h.doc_id, h.k, h.ord, list_concat(f.path[1 : h.level - 1], [h.t]) FROM f JOIN h ON h.doc_id = f.doc_id AND h.k = f.k + 1)
SELECT doc_id, ord, array_to_string(path, ' > ') AS path FROM f""")
def rag_heading_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line, in full, a heading of level 1 + length % 4."""
    h = D.lines(spark, sf_dir).select("doc_id", "ord", F.lit("heading").alias("type"), (1 + F.col("n") % 4).cast("int").alias("level"), F.col("line").alias("text"))
    return chunking.heading_paths(h).select("doc_id", "ord", F.array_join("path", " > ").alias("path"))


@_query()
def html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S18."""
    return html.html_blocks(D.table(spark, sf_dir, "pages")).select("doc_id", "ord", "block_id", "type", "text", "level")


@_query()
def html_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of web pages under their headings."""
    pages = D.table(spark, sf_dir, "pages")
    docs = pages.select(F.col("page_id").alias("doc_id"), F.col("url").alias("title"), F.lit("html").alias("parser_name"))
    return chunking.chunks(html.html_blocks(pages), docs).select("doc_id", "chunk_id", "chunk_type", "text", "chapter_title", "token_count")


# Vectors


_DOT = "list_sum(list_transform(range(1, 65), lambda i: v.embedding[i]::DOUBLE * q.embedding[i]::DOUBLE))"


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("vector_id"), "embedding")


@_query(f"SELECT row_number() OVER (ORDER BY score DESC, vector_id) AS rank, vector_id, round(score, 9) AS score FROM (SELECT v.vec_id AS vector_id, {_DOT} AS score FROM embeddings v, (SELECT embedding FROM embeddings WHERE vec_id = 0) q) ORDER BY score DESC, vector_id LIMIT 10")
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query is one vector, as a caller would pass it."""
    query = D.table(spark, sf_dir, "embeddings").where("vec_id = 0").first()["embedding"]
    return vectors.top_k(_vectors(spark, sf_dir), query, 10).select(F.col("rank").cast("long").alias("rank"), "vector_id", F.round("score", 9).alias("score"))


@_query(f"SELECT query_id, rank, vector_id, round(score, 9) AS score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vector_id) AS rank FROM (SELECT q.vec_id AS query_id, v.vec_id AS vector_id, {_DOT} AS score FROM embeddings v, (SELECT * FROM embeddings WHERE vec_id % 20 = 0) q)) WHERE rank <= 5")
def vector_topk_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O5 for every row whose id is divisible by 20, against all rows."""
    q = _vectors(spark, sf_dir).where("vector_id % 20 = 0").select(F.col("vector_id").alias("query_id"), F.col("embedding").alias("query"))
    return vectors.top_k_batch(_vectors(spark, sf_dir), q, 5).select("query_id", F.col("rank").cast("long").alias("rank"), "vector_id", F.round("score", 9).alias("score"))


@_query("SELECT row_number() OVER (ORDER BY label, vec_id) - 1 AS vector_id, vec_id, label FROM embeddings")
def vector_docstore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6, S20."""
    rows = D.table(spark, sf_dir, "embeddings").select("vec_id", "label").withColumn("key", F.struct("label", "vec_id"))
    return vectors.docstore(rows, F.col("key")).select("vector_id", "vec_id", "label")


# Layout


@_query(f"""WITH {D.OBSERVATIONS}, {D.PAGES}, a AS (SELECT *, (x1 - x0) * (y1 - y0) AS a FROM o)
SELECT doc_id, page, count(*) AS n, count(*) FILTER (kind = 'text_region') AS n_text, count(*) FILTER (kind = 'image_region') AS n_image, count(*) FILTER (y1 - y0 >= 80) AS n_tall,
 round(sum(CASE WHEN kind = 'text_region' THEN a ELSE 0 END) / any_value(width * height), 9) AS text_ratio, round(sum(CASE WHEN kind = 'image_region' THEN a ELSE 0 END) / any_value(width * height), 9) AS image_ratio FROM a JOIN p USING (doc_id, page) GROUP BY doc_id, page""")
def role_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3, A4."""
    o = D.observations(spark, sf_dir)
    return layout.page_metrics(o, D.pages(o)).withColumns({c: F.round(c, 9) for c in ("text_ratio", "image_ratio")})


_PROFILE = f"""{D.OBSERVATIONS}, {D.PAGES}, w AS (SELECT *, x1 - x0 AS w, count(*) OVER (PARTITION BY doc_id, page) AS c, max(x1 - x0) OVER (PARTITION BY doc_id, page) AS m FROM o),
d AS (SELECT doc_id, page, count(*) FILTER (ok) AS n, median(x0) FILTER (ok) AS l, median(x1) FILTER (ok) AS r, median(w) FILTER (ok) AS bw, max(w) FILTER (ok) / min(w) FILTER (ok) AS s FROM (SELECT *, c >= 2 AND w >= m * 0.7 AS ok FROM w) GROUP BY ALL),
f AS (SELECT doc_id, page, CASE WHEN n < 2 THEN 'needs_fallback' WHEN s > 1.5 THEN 'unstable_widths' WHEN bw / 1000 < 0.2 OR bw / 1000 > 0.92 THEN 'extreme_body_width' ELSE '' END AS reason, l, r, bw FROM d)"""


@_query(f"WITH {_PROFILE} SELECT doc_id, page, reason, CASE WHEN reason = '' THEN l END AS body_left, CASE WHEN reason = '' THEN r END AS body_right, CASE WHEN reason = '' THEN bw END AS body_width FROM f")
def layout_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5, A7."""
    o = D.observations(spark, sf_dir)
    return layout.page_profiles(o, D.pages(o))


@_query(f"WITH {_PROFILE}, g AS (SELECT * FROM f WHERE reason = '') SELECT f.doc_id, f.page, arg_min(g.page, abs(g.page - f.page) * 1000000 + g.page) AS profile_page FROM f LEFT JOIN g ON g.doc_id = f.doc_id GROUP BY f.doc_id, f.page")
def nearest_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J10."""
    o = D.observations(spark, sf_dir)
    return layout.nearest_profile(layout.page_profiles(o, D.pages(o)))


@_query(f"""WITH {D.OBSERVATIONS}, g AS (SELECT doc_id, y1 - y0 AS h, y0 - lag(y1) OVER w AS gap, lag(y1 - y0) OVER w AS b FROM o WINDOW w AS (PARTITION BY doc_id, page ORDER BY y0, x0, ord)),
n AS (SELECT *, CASE WHEN gap >= 0 AND gap <= greatest(12, b * 0.45) THEN gap END AS near FROM g), a AS (SELECT *, min(near) FILTER (near > 0) OVER (PARTITION BY doc_id) AS anchor FROM n),
m AS (SELECT doc_id, median(CASE WHEN anchor IS NULL OR near <= greatest(anchor * 1.8, anchor + 4) THEN near END) AS normal_gap, median(h) AS line_height FROM a GROUP BY doc_id)
SELECT m.doc_id, round(normal_gap, 9) AS normal_gap, line_height, median(CASE WHEN gap >= greatest(normal_gap * 2.5, normal_gap + 18) THEN gap END) AS display_gap FROM m JOIN a USING (doc_id) GROUP BY m.doc_id, normal_gap, line_height""")
def line_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1, W2, A6."""
    return layout.normal_gaps(D.observations(spark, sf_dir)).withColumn("normal_gap", F.round("normal_gap", 9))


@_query(f"""WITH {D.OBSERVATIONS}, r AS (SELECT *, CASE WHEN lag(kind) OVER w IS DISTINCT FROM kind OR row_number() OVER w = 1 THEN 1 ELSE 0 END AS new FROM o WINDOW w AS (PARTITION BY doc_id, page ORDER BY ord)),
s AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, page ORDER BY ord) AS run FROM r)
SELECT doc_id, page, run::BIGINT AS run, kind, count(*) AS n, min(ord) AS first, max(ord) AS last, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM s GROUP BY ALL""")
def same_page_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W3, A18."""
    r = layout.runs(D.observations(spark, sf_dir), ["doc_id", "page"], ["ord"], ["kind"])
    box = geometry.union_box(F.array("x0", "y0", "x1", "y1"))
    g = r.groupBy("doc_id", "page", "run", "kind").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("first"), F.max("ord").alias("last"), box.alias("b"))
    return g.select("doc_id", "page", "run", "kind", "n", "first", "last", *(F.col("b")[i].alias(c) for i, c in enumerate(("x0", "y0", "x1", "y1"))))


_SIGNALS = f"""{_PROFILE}, s0 AS (SELECT o.*, o.x0 - f.l AS li, f.r - o.x1 AS ri, o.x1 - o.x0 AS w, f.bw AS b, f.l, f.r, o.y1 - o.y0 AS h, CASE WHEN o.n % 2 = 0 THEN 30.0::DOUBLE ELSE greatest(24.0, f.bw * 0.04) END AS u, o.n % 3 = 0 AS gb, o.n % 4 < 2 AS ga FROM o JOIN f USING (doc_id, page) WHERE f.reason = ''),
s AS (SELECT doc_id, ord, concat_ws(',', CASE WHEN w <= b * 0.72 THEN 'narrower_than_body_lane' END, CASE WHEN li >= b * 0.12 AND ri >= b * 0.08 THEN 'inset_from_body_lane' WHEN w <= b * 0.96 AND li >= b * 0.05 AND ri >= b * -0.03 THEN 'left_inset_set_off_text'
 WHEN w >= b * 0.94 AND w <= b * 0.98 AND li >= greatest(24, b * 0.03) AND ri >= b * -0.03 AND h >= 80 THEN 'slightly_inset_tall_block' END, CASE WHEN w <= b - u * 0.5 AND li >= greatest(12, u * 0.85) AND ri >= -u THEN 'book_indent_set_off_text' END,
 CASE WHEN abs(x1 - r) <= greatest(24, u * 1.5) AND w <= b * 0.55 AND x0 >= l + b * 0.4 THEN 'right_aligned_attribution' END, CASE WHEN gb THEN 'display_gap_before' END, CASE WHEN ga THEN 'display_gap_after' END) AS signals FROM s0)"""


@_query(f"""WITH {_SIGNALS}, h AS (SELECT *, ',' || signals || ',' AS q FROM s) SELECT doc_id, ord, signals, ((q LIKE '%,right_aligned_attribution,%' OR (q LIKE '%,narrower_than_body_lane,%' AND q LIKE '%,inset_from_body_lane,%')) AND (q LIKE '%,display_gap_before,%' OR q LIKE '%,display_gap_after,%'))
 OR ((q LIKE '%,left_inset_set_off_text,%' OR q LIKE '%,slightly_inset_tall_block,%' OR q LIKE '%,book_indent_set_off_text,%') AND q LIKE '%,display_gap_before,%' AND q LIKE '%,display_gap_after,%') AS is_display FROM h""")
def display_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """all eight signals and the decision."""
    o = D.observations(spark, sf_dir)
    p = layout.page_profiles(o, D.pages(o)).where("reason = ''")
    s = layout.display_signals(*(F.col(c) for c in ("x0", "y0", "x1", "y1", "body_left", "body_right", "body_width")), F.when(F.col("n") % 2 == 0, 30.0), F.col("n") % 3 == 0, F.col("n") % 4 < 2)
    return o.join(p, ["doc_id", "page"]).withColumn("s", s).select("doc_id", "ord", F.array_join("s", ",").alias("signals"), layout.is_display(F.col("s")).alias("is_display"))


@_query(f"WITH {D.OBSERVATIONS} SELECT doc_id, list_sort(list(x1))[least(count(*) - 1, floor(count(*) * 0.95)::BIGINT) + 1] AS page_width FROM o GROUP BY doc_id")
def page_width_p95(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A16."""
    return D.observations(spark, sf_dir).groupBy("doc_id").agg(layout.element_at_share(F.col("x1"), 0.95).alias("page_width"))


@_query("""WITH r AS (SELECT user_id, event_id, event_type = 'click' AS v, sum(CASE WHEN event_type = 'click' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS g FROM events)
SELECT user_id, min(event_id) AS first, max(event_id) AS last, count(*) AS n FROM r WHERE v GROUP BY user_id, g HAVING count(*) >= 2""")
def visual_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of at least two clicks of a user."""
    e = D.table(spark, sf_dir, "events").select("user_id", "event_id", (F.col("event_type") == "click").alias("v"))
    return layout.flagged_runs(e, ["user_id"], "event_id", "v", 2)


@_query("""WITH r AS (SELECT user_id, event_id, event_type = 'purchase' AS f, value < 50 AS ok, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
s AS (SELECT *, max(CASE WHEN f THEN i END) OVER (PARTITION BY user_id ORDER BY i) AS p, min(CASE WHEN f THEN i END) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS q FROM r),
t AS (SELECT *, max(CASE WHEN NOT f AND NOT ok THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, p ORDER BY i) AS stop FROM s)
SELECT user_id, event_id FROM t WHERE NOT f AND p IS NOT NULL AND q IS NOT NULL AND q - p - 1 <= 3 AND stop = 0""")
def note_gap_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W7."""
    e = D.table(spark, sf_dir, "events").select("user_id", "event_id", (F.col("event_type") == "purchase").alias("f"), (F.col("value") < 50).alias("ok"))
    return layout.fill_gaps(e, ["user_id"], "event_id", "f", "ok").where("filled").select("user_id", "event_id")


@_query("""WITH r AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS j, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
SELECT o_custkey, o_orderkey, i <= least(24, greatest(4, round_even(n * 0.05, 0))) AS is_first_edge, j <= least(24, greatest(4, round_even(n * 0.05, 0))) AS is_last_edge FROM r""")
def edge_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W10."""
    return layout.edge_rows(D.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], "o_orderkey")


# Tables


_RUNS = f"""{D.LINES}, t0 AS (SELECT doc_id, ord // 2 + n % 2 + ord // 14 * 2 AS page, ord, n % 3 = 0 AS prim FROM l),
t1 AS (SELECT *, page - lag(page) OVER w AS step FROM t0 WINDOW w AS (PARTITION BY doc_id ORDER BY page, ord)),
t2 AS (SELECT *, sum(CASE WHEN prim OR step IS NULL OR step <> 1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY page, ord) AS run, sum(prim::INT) OVER (PARTITION BY doc_id ORDER BY page, ord) AS no FROM t1),
t3 AS (SELECT doc_id, page, ord, prim AS is_primary, CASE WHEN max(prim::INT) OVER (PARTITION BY doc_id, run) = 1 THEN no::BIGINT END AS table_no FROM t2)"""


def _table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line a row, with two pages left out after the pages of each 14 lines."""
    rows = D.lines(spark, sf_dir).select("doc_id", F.expr("ord div 2 + n % 2 + ord div 14 * 2").alias("page"), "ord", F.when(F.col("n") % 3 == 0, "<table/>").otherwise("").alias("html"))
    return tables.table_runs(rows)


@_query(f"WITH {_RUNS} SELECT * FROM t3")
def table_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W15."""
    return _table_rows(spark, sf_dir)


@_query(f"WITH {_RUNS} SELECT doc_id, table_no, count(*) AS n_pages, count(*) FILTER (page % 4 <> 0) AS n_included, CASE WHEN count(*) FILTER (page % 4 <> 0) = count(*) THEN 'admitted' WHEN count(*) FILTER (page % 4 <> 0) = 0 THEN 'excluded' ELSE 'unresolved' END AS status FROM t3 WHERE table_no IS NOT NULL GROUP BY doc_id, table_no")
def table_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U2."""
    t = _table_rows(spark, sf_dir)
    review = t.select("doc_id", "page").distinct().withColumn("action", F.when(F.col("page") % 4 == 0, "exclude").otherwise("include"))
    return tables.partition(t, review)


# Notes


_REFS = "r AS (SELECT l_orderkey AS doc_id, l_linenumber AS ref_id, l_partkey % 3 AS page, (l_suppkey % 4)::VARCHAR AS marker FROM lineitem), n AS (SELECT l_orderkey AS doc_id, l_linenumber + 100 AS note_id, l_suppkey % 3 AS page, (l_partkey % 4)::VARCHAR AS marker FROM lineitem)"


def _refs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    li = D.table(spark, sf_dir, "lineitem")
    refs = li.selectExpr("l_orderkey AS doc_id", "l_linenumber AS ref_id", "l_partkey % 3 AS page", "cast(l_suppkey % 4 AS string) AS marker")
    return refs, li.selectExpr("l_orderkey AS doc_id", "l_linenumber + 100 AS note_id", "l_suppkey % 3 AS page", "cast(l_partkey % 4 AS string) AS marker")


@_query(f"""WITH {_REFS}, k AS (SELECT doc_id, page, marker, min(note_id) AS a, max(note_id) AS b FROM n GROUP BY ALL)
SELECT r.doc_id, r.ref_id, r.page, r.marker, CASE WHEN a IS NULL THEN 'unresolved' WHEN a = b THEN 'resolved' ELSE 'ambiguous' END AS status, CASE WHEN a = b THEN a END AS note_id FROM r LEFT JOIN k USING (doc_id, page, marker)""")
def note_resolve_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1."""
    return notes.resolve_on_page(*_refs(spark, sf_dir))


@_query(f"""WITH {_REFS}, k AS (SELECT doc_id, page, marker, min(note_id) AS a, max(note_id) AS b FROM n GROUP BY ALL), x AS (SELECT r.doc_id, a FROM r JOIN k USING (doc_id, page, marker) WHERE a = b)
SELECT n.doc_id, n.note_id FROM n WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.doc_id = n.doc_id AND x.a = n.note_id)""")
def note_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J20."""
    refs, own = _refs(spark, sf_dir)
    return notes.orphans(own, notes.resolve_on_page(refs, own)).select("doc_id", "note_id")


@_query("""WITH b AS (SELECT o_custkey AS doc_id, o_orderkey AS ord, CASE WHEN o_orderstatus = 'F' THEN 'c' || o_orderkey END AS key FROM orders),
s AS (SELECT doc_id, ord, last_value(key IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS scope_key FROM b),
r AS (SELECT doc_id, ord AS ref_id, scope_key, (ord % 3)::VARCHAR AS marker FROM s), n AS (SELECT doc_id, ord AS note_id, scope_key, (ord % 5)::VARCHAR AS marker, CASE WHEN ord % 2 = 0 THEN 'chapter' ELSE 'book' END AS scope FROM s),
c AS (SELECT doc_id, scope_key, marker, min(note_id) AS lo, max(note_id) AS hi FROM n WHERE scope = 'chapter' AND scope_key IS NOT NULL GROUP BY ALL), w AS (SELECT doc_id, marker, min(note_id) AS blo, max(note_id) AS bhi FROM n WHERE scope = 'book' GROUP BY ALL),
j AS (SELECT r.*, coalesce(lo, blo) AS a, CASE WHEN lo IS NOT NULL THEN hi ELSE bhi END AS z FROM r LEFT JOIN c USING (doc_id, scope_key, marker) LEFT JOIN w USING (doc_id, marker))
SELECT doc_id, ref_id, scope_key, marker, CASE WHEN a IS NULL THEN 'unresolved' WHEN a = z THEN 'resolved' ELSE 'ambiguous' END AS status, CASE WHEN a = z THEN a END AS note_id FROM j""")
def note_resolve_scoped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2, W13."""
    o = D.table(spark, sf_dir, "orders")
    b = o.select(F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("ord"), F.when(F.col("o_orderstatus") == "F", "heading").otherwise("paragraph").alias("type"), F.concat(F.lit("c"), "o_orderkey").alias("key"))
    s = notes.scopes(b)
    refs = s.selectExpr("doc_id", "ord AS ref_id", "scope_key", "cast(ord % 3 AS string) AS marker")
    own = s.selectExpr("doc_id", "ord AS note_id", "scope_key", "cast(ord % 5 AS string) AS marker", "if(ord % 2 = 0, 'chapter', 'book') AS scope")
    return notes.resolve_scoped(refs, own)


@_query(f"WITH {_REFS}, k AS (SELECT doc_id, page, marker, min(note_id) AS a, max(note_id) AS b FROM n GROUP BY ALL), s AS (SELECT r.doc_id, CASE WHEN a IS NULL THEN 'u' WHEN a = b THEN 'r' ELSE 'a' END AS s FROM r LEFT JOIN k USING (doc_id, page, marker)) SELECT doc_id, count(*) FILTER (s = 'r') AS n_resolved, count(*) FILTER (s = 'a') AS n_ambiguous, count(*) FILTER (s = 'u') AS n_unresolved FROM s GROUP BY doc_id")
def note_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11."""
    return notes.audit(notes.resolve_on_page(*_refs(spark, sf_dir)))


@_query("""WITH r AS (SELECT l_orderkey AS doc_id, l_linenumber AS ord, l_returnflag AS chapter, l_suppkey % 3 AS note_id FROM lineitem), f AS (SELECT *, min(ord) OVER (PARTITION BY doc_id, chapter, note_id) AS f FROM r)
SELECT doc_id, ord, chapter, note_id, dense_rank() OVER (PARTITION BY doc_id, chapter ORDER BY f) AS number FROM f""")
def footnote_renumber(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W26."""
    r = D.table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS doc_id", "l_linenumber AS ord", "l_returnflag AS chapter", "l_suppkey % 3 AS note_id")
    return notes.renumber(r).withColumn("number", F.col("number").cast("long"))


# Contents and sections


@_query(f"""WITH {D.ENTRIES}, w AS (SELECT *, last_value(start_page - printed_page IGNORE NULLS) OVER (PARTITION BY doc_id, role ORDER BY entry_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS a, first_value(start_page - printed_page IGNORE NULLS) OVER (PARTITION BY doc_id, role ORDER BY entry_index ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS b FROM e)
SELECT doc_id, entry_index, CASE WHEN a = b THEN a END AS "offset" FROM w""")
def offset_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J11."""
    return skeleton.agreed_offsets(D.entries(spark, sf_dir)).select("doc_id", F.col("entry_index").cast("long").alias("entry_index"), "offset")


@_query(f"WITH {D.ENTRIES}, v AS (SELECT doc_id, entry_index, 1 + printed_page % 4 AS level FROM e) SELECT v.doc_id, v.entry_index, v.level, max(u.entry_index) AS parent_index FROM v LEFT JOIN v u ON u.doc_id = v.doc_id AND u.entry_index < v.entry_index AND u.level < v.level GROUP BY ALL")
def toc_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W17."""
    e = D.entries(spark, sf_dir).select("doc_id", F.col("entry_index").cast("long").alias("entry_index"), (1 + F.col("printed_page") % 4).alias("level"))
    return skeleton.hierarchy(e)


@_query()
def monotonic_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W19."""
    e = D.entries(spark, sf_dir).withColumn("candidates", F.array(F.col("printed_page") + 10, F.col("printed_page") + 11))
    return skeleton.monotonic_starts(e.withColumn("entry_index", F.col("entry_index").cast("long")))


@_query(f"WITH {D.ENTRIES} SELECT doc_id, min(entry_index) FILTER (role = 'O') AS first_body, max(entry_index) FILTER (role = 'O') AS last_body, min(entry_index) FILTER (role = 'P') AS first_back FROM e GROUP BY doc_id")
def toc_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9."""
    e = D.entries(spark, sf_dir).select("doc_id", F.col("entry_index").cast("long").alias("entry_index"), F.when(F.col("role") == "O", "body").when(F.col("role") == "P", "back_matter").alias("role"))
    return skeleton.boundaries(e)


@_query(f"""WITH {D.OBSERVATIONS}, g AS (SELECT DISTINCT doc_id, page FROM o), s AS (SELECT doc_id, page, count(*) AS n_starts, min(ord) AS one FROM o WHERE n % 5 = 0 GROUP BY ALL)
SELECT g.doc_id, g.page, coalesce(n_starts, 0) AS n_starts, CASE WHEN g.page % 5 = 0 THEN 'standalone' WHEN n_starts = 1 THEN 'start' WHEN n_starts > 1 THEN 'conflict' ELSE 'none' END AS placement, CASE WHEN g.page % 5 <> 0 AND n_starts = 1 THEN one END AS section_id FROM g LEFT JOIN s USING (doc_id, page)""")
def placements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J16."""
    o = D.observations(spark, sf_dir)
    pages = o.select("doc_id", "page").distinct().withColumn("is_standalone", F.col("page") % 5 == 0)
    return skeleton.placements(pages, o.where("n % 5 = 0").select("doc_id", "page", F.col("ord").alias("section_id")))


# Graph and constraints


def _units(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = D.observations(spark, sf_dir)
    return o.select("doc_id", "ord", F.concat(F.lit("u"), "ord").alias("unit_id"), F.when(F.col("n") % 4 == 0, "heading").otherwise("paragraph").alias("unit_type"), F.col("line").alias("text"), "page", F.array("x0", "y0", "x1", "y1").alias("bbox"))


@_query(f"WITH {D.OBSERVATIONS} SELECT doc_id, ord + 1 AS ord, 'b' || lpad((ord + 1)::VARCHAR, 6, '0') AS block_id, CASE WHEN n % 4 = 0 THEN 'heading' ELSE 'paragraph' END AS type, line AS text, page, x0 FROM o")
def graph_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9, P10."""
    return graph.blocks_of(graph.records(_units(spark, sf_dir))).select("doc_id", F.col("ord").cast("long").alias("ord"), "block_id", "type", "text", "page", F.col("bbox")[0].alias("x0"))


@_query(f"WITH {D.OBSERVATIONS} SELECT doc_id, 'node' AS part, CASE WHEN n % 4 = 0 THEN 'heading' ELSE 'paragraph' END AS kind, count(*) AS n FROM o GROUP BY ALL UNION ALL SELECT doc_id, 'edge', 'appears_on_page', count(*) FROM o GROUP BY ALL")
def graph_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10."""
    return graph.audit(graph.records(_units(spark, sf_dir)))


@_query("""WITH a AS (SELECT doc_id + CASE WHEN doc_id % 7 = 0 THEN 1000000000 ELSE 0 END AS doc_id, lang, n_chars FROM documents), b AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'xx' ELSE lang END AS lang, CASE WHEN doc_id % 6 = 0 THEN n_chars + 1 ELSE n_chars END AS n_chars FROM documents)
SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN b.doc_id IS NULL THEN 'added' WHEN a.doc_id IS NULL THEN 'removed' WHEN a.lang IS DISTINCT FROM b.lang OR a.n_chars IS DISTINCT FROM b.n_chars THEN 'changed' ELSE 'same' END AS change,
 CASE WHEN a.doc_id IS NULL OR b.doc_id IS NULL THEN '' ELSE concat_ws(',', CASE WHEN a.lang IS DISTINCT FROM b.lang THEN 'lang' END, CASE WHEN a.n_chars IS DISTINCT FROM b.n_chars THEN 'n_chars' END) END AS fields FROM a FULL JOIN b ON a.doc_id = b.doc_id""")
def projection_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J19."""
    d = D.table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    old = d.selectExpr("doc_id", "if(doc_id % 5 = 0, 'xx', lang) AS lang", "if(doc_id % 6 = 0, n_chars + 1, n_chars) AS n_chars")
    return graph.difference(d.withColumn("doc_id", F.expr("doc_id + if(doc_id % 7 = 0, 1000000000, 0)")), old, ["doc_id"], ["lang", "n_chars"])


@_query("SELECT doc_id, 'missing:key' AS rule, doc_id::VARCHAR AS detail FROM (SELECT doc_id FROM documents EXCEPT ALL SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'extra:key', doc_id::VARCHAR FROM (SELECT doc_id FROM labels EXCEPT ALL SELECT doc_id FROM documents)")
def partition_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U3."""
    key = lambda name: D.table(spark, sf_dir, name).select("doc_id", F.col("doc_id").alias("key"))
    return constraints.same_set(key("documents"), key("labels"), "key")


@_query(f"WITH {D.LINES} SELECT doc_id, 'heading_level' AS rule, 'b' || ord AS detail FROM l WHERE n % 4 = 0 AND n % 5 = 0 UNION ALL SELECT doc_id, 'domain:type', 'b' || ord FROM l WHERE n % 13 = 1 AND n % 4 <> 0")
def canonical_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1."""
    b = D.lines(spark, sf_dir).select("doc_id", F.concat(F.lit("b"), "ord").alias("block_id"), F.expr("CASE WHEN n % 4 = 0 THEN 'heading' WHEN n % 13 = 1 THEN 'other' ELSE 'paragraph' END").alias("type"), F.expr("n % 5").alias("level"))
    return constraints.canonical(b)


@_query()
def flow_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R6-R9 in part: what texts and page numbers alone decide."""
    u = D.observations(spark, sf_dir).select("doc_id", "ord", F.expr("CASE WHEN n % 9 = 0 THEN 'footnote' WHEN n % 9 = 1 THEN 'display_block' ELSE 'paragraph' END").alias("unit_type"), F.col("line").alias("text"), "page")
    return flow.reconcile(u)
