"""Pages and blocks as the parser's rows have them, and what is published of them.

Raw blocks: doc_id, page, index, raw_type, text, x0, y0, x1, y1; text is taken without
the note mark at its end. Null boxes never match a layout test; null text is empty;
empty tables give empty tables or, where a document's defaults apply, its defaults.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import extraction as X
from quire.functions import text as T

# Page furniture, roles of raw types, kinds of raw types.
FURNITURE = ("page_number", "page_header", "page_footer")
ROLE_HINTS = {"paragraph": "body_text", "title": "title_text", "list": "list_text", "page_footnote": "footnote_text", "ref_text": "reference_text", "caption": "caption_text", "toc": "toc_text", "page_number": "page_number", "page_header": "header", "page_footer": "footer"}
FIRST_BODY_PAGE, LEAST_BODY_TEXT = 20, 60


def layout_stats(blocks: DataFrame, sizes: DataFrame) -> DataFrame:
    """doc_id, page_width, page_height, body_left, body_right: medians, defaults where there is nothing to measure."""
    s = sizes.groupBy("doc_id").agg(F.coalesce(F.median(F.when(F.col("width") > 0, F.col("width"))), F.lit(1000.0)).alias("page_width"), F.coalesce(F.median(F.when(F.col("height") > 0, F.col("height"))), F.lit(1000.0)).alias("page_height"))
    b = blocks.join(s, "doc_id").where((F.col("page") >= FIRST_BODY_PAGE) & (F.col("raw_type") == "paragraph") & (F.length(X.block_text(F.col("text"))) >= LEAST_BODY_TEXT) & (F.col("x1") - F.col("x0") > F.col("page_width") * 0.55))
    m = b.groupBy("doc_id").agg(F.median("x0").alias("_l"), F.median("x1").alias("_r"))
    return s.join(m, "doc_id", "left").select("doc_id", "page_width", "page_height", F.coalesce("_l", F.col("page_width") * 0.13).alias("body_left"), F.coalesce("_r", F.col("page_width") * 0.88).alias("body_right"))


def layout_tests(x0: Column, x1: Column, text: Column, left: Column, right: Column) -> dict[str, Column]:
    """Whether a box is short or indented, set off, or short at the right."""
    w, lane = x1 - x0, right - left
    no = lambda c: F.coalesce(c, F.lit(False))
    return {
        "is_short_or_indented": no((x0 >= left + 35) | (w <= lane * 0.82)), "is_set_off": no((x0 >= left + 18) | (w <= lane * 0.95)),
        "is_right_short": no((F.length(X.block_text(text)) <= 20) & (x0 > left + lane * 0.65)),
    }


def page_kinds(blocks: DataFrame, stats: DataFrame) -> DataFrame:
    """doc_id, page, has_images, is_title_only, is_full_page_image of every page with blocks."""
    said = X.block_text(F.col("text"))
    b = blocks.withColumn("_t", F.length(said)).join(stats, "doc_id")
    content = ~F.col("raw_type").isin(*FURNITURE) & ((F.col("_t") > 0) | F.col("raw_type").isin("image", "table"))
    c = lambda cond: F.coalesce(content & cond, F.lit(False))
    text, image = F.col("raw_type").isin("paragraph", "title") & (F.col("_t") > 0), (F.col("raw_type") == "image") & F.col("x0").isNotNull()
    only = F.first(F.when(c(image), F.struct("x0", "y0", "x1", "y1")), ignorenulls=True)
    g = b.groupBy("doc_id", "page").agg(
        F.max(F.col("raw_type") == "image").alias("has_images"), F.count_if(c(F.lit(True))).alias("n"), F.count_if(c(F.col("raw_type") == "title")).alias("n_title"), F.count_if(c(text)).alias("n_text"), F.count_if(c(text & (F.col("raw_type") == "title"))).alias("n_text_title"),
        F.coalesce(F.max(F.when(c(text), F.col("_t"))), F.lit(0)).alias("longest"), F.count_if(c(image)).alias("n_image"), F.count_if(c(~F.col("raw_type").isin("image", "paragraph", "title"))).alias("n_other"), only.alias("i"),
        *[f(F.when(c(F.lit(True)), F.col(k))).alias(f"u_{k}") for f, k in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))], F.collect_list(F.when(c(text), F.struct("x0", "y0", "x1"))).alias("texts"),
        F.first("page_height").alias("page_height"), F.first(F.col("body_right") - F.col("body_left")).alias("lane"),
    )
    titles = (F.col("n") > 0) & (((F.col("n_title") == F.col("n")) & (F.col("n") <= 3)) | ((F.col("n_text") == F.col("n")) & (F.col("n_text") <= 4) & (F.col("n_text_title") > 0) & (F.col("longest") <= 24)))
    high = F.when((F.col("u_x1") > 650) | (F.col("u_y1") > 750), 1000.0).otherwise(F.col("page_height"))
    wide = (F.col("i.x1") - F.col("i.x0") >= F.col("lane") * 0.95) | (F.col("u_x1") - F.col("u_x0") >= F.col("lane") * 1.05)
    near = F.forall("texts", lambda t: F.coalesce((t["x0"] >= F.col("i.x0") - 20) & (t["x1"] <= F.col("i.x1") + 20) & (t["y0"] <= F.col("i.y1") + high * 0.12), F.lit(False)))
    full = (F.col("n_image") == 1) & (F.col("n_text") > 0) & (F.col("longest") <= 24) & (F.col("n_other") == 0) & wide & (F.col("u_y1") - F.col("u_y0") >= high * 0.55) & near
    return g.select("doc_id", "page", "has_images", titles.alias("is_title_only"), F.coalesce(full, F.lit(False)).alias("is_full_page_image"))


def title_cluster_pages(observations: DataFrame, pages: DataFrame) -> DataFrame:
    """(doc_id, page) of two to four titles and bodies without visuals, the bodies narrow, centred and by the titles."""
    o = observations.join(pages.select("doc_id", "page", "width", "height"), ["doc_id", "page"])
    kept = (F.col("kind") == "text_region") & F.col("role_hint").isin("title_text", "body_text") & F.col("x0").isNotNull()
    title, body = kept & (F.col("role_hint") == "title_text"), kept & (F.col("role_hint") == "body_text")
    o = o.withColumn("_top", F.min(F.when(title, F.col("y0"))).over(Window.partitionBy("doc_id", "page"))).withColumn("_foot", F.max(F.when(title, F.col("y1"))).over(Window.partitionBy("doc_id", "page")))
    margin = F.col("height") * 0.12
    fits = (F.col("x1") - F.col("x0") <= F.col("width") * 0.55) & (F.abs((F.col("x0") + F.col("x1")) / 2 - F.col("width") / 2) <= F.col("width") * 0.12) & (F.col("y0") >= F.col("_top") - margin) & (F.col("y1") <= F.col("_foot") + margin)
    yes = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    g = o.groupBy("doc_id", "page").agg(yes(F.col("kind").isin("image_region", "table_region")).alias("v"), yes(kept).alias("n"), yes(title).alias("t"), yes(body).alias("b"), yes(body & ~F.coalesce(fits, F.lit(False))).alias("off"))
    return g.where("v = 0 AND n BETWEEN 2 AND 4 AND t > 0 AND b > 0 AND off = 0").select("doc_id", "page")


def is_body_like(x0: Column, x1: Column, left: Column, right: Column, strict: bool) -> Column:
    """Whether a box lies in its page's body lane."""
    lane = right - left
    share, l0, l1, r0, r1 = (0.96, 12.0, 0.015, 16.0, 0.02) if strict else (0.7, 24.0, 0.06, 32.0, 0.08)
    return F.coalesce((lane > 0) & (x1 - x0 >= lane * share) & (F.abs(x0 - left) <= F.greatest(F.lit(l0), lane * l1)) & (F.abs(x1 - right) <= F.greatest(F.lit(r0), lane * r1)), F.lit(False))


def left_edges(blocks: DataFrame, apart: float = 12.0) -> DataFrame:
    """(doc_id, page, cluster, left, n): left edges of a contents page's text, a new cluster where one lies over ``apart`` from the median so far."""
    from quire.operators.folds import along

    b = blocks.where(F.col("raw_type").isin("title", "paragraph", "list") & F.col("x0").isNotNull()).withColumn("_t", X.block_text(F.col("text")))
    b = b.where("_t <> '' AND NOT (raw_type = 'title' AND _t = '目录')").select("doc_id", "page", F.struct("x0", "index").alias("at"), "x0")

    def clusters(xs: list[float]) -> list[int]:
        out: list[int] = []
        start = 0
        for i, x in enumerate(xs):
            n = i - start  # sorted edges: the median lies in the middle of the cluster
            if n and abs(x - (xs[start + n // 2] + xs[start + (n - 1) // 2]) / 2) > apart:
                start = i
                out.append(out[-1] + 1)
            else:
                out.append(out[-1] if out else 1)
        return out

    done = along(b, "at", ["x0"], clusters, "int", "cluster", ("doc_id", "page"))
    return done.groupBy("doc_id", "page", "cluster").agg(F.median("at.x0").alias("left"), F.count(F.lit(1)).alias("n"))


def role_hint(raw_type: Column, is_front_edge: Column) -> Column:
    """P15."""
    known = F.create_map(*[F.lit(x) for pair in ROLE_HINTS.items() for x in pair])
    return F.when((raw_type == "index") & is_front_edge, "toc_text").otherwise(F.coalesce(F.element_at(known, raw_type), F.lit("unknown")))


def observation_kind(raw_type: Column) -> Column:
    """P15."""
    return F.when(raw_type.isin("image", "chart"), "image_region").when(raw_type == "table", "table_region").when(raw_type.isin(*FURNITURE), "page_marker").when(raw_type.isin("page_footnote"), "footnote_region").otherwise("text_region")


def candidates(observations: DataFrame, review: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Text of included pages with its type, and per document and kind how much else is there.

    Titles are headings, list texts list items, footnotes and reference texts footnotes, captions captions, other texts paragraphs.
    """
    inside = observations.join(review.where("action = 'include'").select("doc_id", "page").distinct(), ["doc_id", "page"], "left_semi")
    hint = F.coalesce("role_hint", F.lit(""))
    kind = F.when((F.col("kind") == "footnote_region") | hint.isin("footnote_text", "reference_text"), "footnote").when(hint == "title_text", "heading").when(hint == "list_text", "list_item").when(hint == "caption_text", "caption").otherwise("paragraph")
    text = F.col("kind").isin("text_region", "footnote_region")
    return inside.where(text).withColumn("candidate_type", kind), inside.where(~text).groupBy("doc_id", "kind").agg(F.count(F.lit(1)).alias("n"))


def excluded_pages(pages: DataFrame, review: DataFrame) -> DataFrame:
    """U1."""
    return pages.select("doc_id", "page").join(review.where("action = 'include'").select("doc_id", "page"), ["doc_id", "page"], "left_anti")


def public_display(text: Column, layout_role: Column) -> Column:
    """struct<layout_role, line_count, has_attribution_line> that is published of a display."""
    lines = F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), T.strip), lambda x: x != "")
    return F.struct(F.coalesce(layout_role, F.lit("inline_display_block")).alias("layout_role"), F.size(lines).alias("line_count"), F.exists(lines, lambda x: x.rlike(r"^\s*[—－–-]{1,4}\s*(.+?)\s*$")).alias("has_attribution_line"))


def box_reference(page: Column, bbox: Column) -> Column:
    """P11, and with every block P3's map of sources."""
    return F.when(page.isNotNull(), F.struct(page.alias("page"), bbox.alias("bbox")))


def stem_id(path: Column) -> Column:
    """Z52."""
    stem = F.regexp_replace(F.substring_index(path, "/", -1), r"(?<=.)\.[^.]*$", "")
    return F.regexp_replace(stem, r"[^A-Za-z0-9_\-]+", "_")


def preview(text: Column, most: int = 500) -> Column:
    """The first characters shown of a hit (O6); what is searched and stored stays whole."""
    return F.substring(F.coalesce(text, F.lit("")), 1, most)


def hits(found: DataFrame, docstore: DataFrame) -> DataFrame:
    """Search results with their rows of the docstore, in order of rank."""
    return found.join(docstore, "vector_id").select("rank", "vector_id", "score", *[c for c in docstore.columns if c != "vector_id"])


def note_gaps(notes: DataFrame, references: DataFrame) -> DataFrame:
    """Per document the notes, those that a text refers to, those that none does with and without marker, and references without a note."""
    n = notes.join(references.where("note_id IS NOT NULL").select("doc_id", "note_id").distinct().withColumn("_used", F.lit(True)), ["doc_id", "note_id"], "left")
    used, marked = F.coalesce("_used", F.lit(False)), F.coalesce(F.col("marker") != "", F.lit(False))
    g = n.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_notes"), F.count_if(used).alias("n_referenced"), F.count_if(~used & marked).alias("n_missing_marked"), F.count_if(~used & ~marked).alias("n_missing_unmarked"))
    r = references.groupBy("doc_id").agg(F.count_if(F.col("note_id").isNull()).alias("n_unresolved"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return g.join(r, "doc_id", "full").select("doc_id", *[zero(c) for c in ("n_notes", "n_referenced", "n_missing_marked", "n_missing_unmarked", "n_unresolved")])


def png_size(content: Column) -> Column:
    """struct<width, height> of a PNG's first bytes, else null."""
    head = F.hex(F.substring(content, 1, 24))
    number = lambda at: F.conv(F.substring(head, at, 8), 16, 10).cast("int")
    return F.when(head.startswith("89504E470D0A1A0A") & (F.substring(head, 25, 8) == "49484452"), F.struct(number(33).alias("width"), number(41).alias("height")))


def split_runs(runs: Column, offset: Column) -> Column:
    """struct<before, after> of inline runs parted at a character of their text (C35, Z48). Runs without text at or over the offset give empty sides."""
    size = lambda r: F.when(r["type"] == "text", F.length(r["text"])).otherwise(0)
    upto = lambda i: F.aggregate(F.slice(runs, 1, i), F.lit(0), lambda s, r: s + size(r))
    placed = F.transform(runs, lambda r, i: F.struct(r.alias("r"), upto(i).alias("at")))
    holds = F.transform(placed, lambda p: (p["r"]["type"] == "text") & (p["at"] <= offset) & (offset <= p["at"] + F.length(p["r"]["text"])))
    k = F.array_position(holds, F.lit(True)).cast("int")
    cut = F.element_at(placed, F.greatest(k, F.lit(1)))
    piece = lambda text: F.filter(F.array(F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("marker"))), lambda p: p["text"] != "")
    whole = F.transform(placed, lambda p: F.struct(p["r"]["type"].alias("type"), p["r"]["text"].alias("text"), p["r"]["marker"].alias("marker")))
    at = offset - cut["at"]
    before = F.concat(F.slice(whole, 1, F.greatest(k - 1, F.lit(0))), piece(F.rtrim(F.substring(cut["r"]["text"], F.lit(1), at.cast("int")))))
    after = F.concat(piece(F.ltrim(F.substring(cut["r"]["text"], (at + 1).cast("int"), F.length(cut["r"]["text"])))), F.slice(whole, k + 1, F.size(runs)))
    none = F.array().cast("array<struct<type: string, text: string, marker: string>>")
    return F.struct(F.when(k > 0, before).otherwise(none).alias("before"), F.when(k > 0, after).otherwise(none).alias("after"))
