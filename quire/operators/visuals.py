"""Captions and images of a page, tables over page breaks, reading orders.

Observations: doc_id, page, observation_id, kind, role_hint, parent_id, reading_order,
x0, y0, x1, y1. Pairs are only ever made within a page, of its images and those of
its texts that call themselves captions or titles. Null boxes make no pair.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.folds import dealt

MISSING_PAGE_ORDER, MISSING_TABLE_ORDER = 999_999, 1_000_000


def reading_order(observations: DataFrame) -> DataFrame:
    """``place`` of each observation on its page: reading order, then top, left and id (O1)."""
    far = lambda c: F.coalesce(F.col(c), F.lit(float("inf")))
    w = Window.partitionBy("doc_id", "page").orderBy(F.coalesce("reading_order", F.lit(MISSING_PAGE_ORDER)), far("y0"), far("x0"), "observation_id")
    return observations.withColumn("place", F.row_number().over(w))


def table_order(observations: DataFrame) -> DataFrame:
    """``place`` of each table in its document: page, reading order, id (O3)."""
    w = Window.partitionBy("doc_id").orderBy("page", F.coalesce("reading_order", F.lit(MISSING_TABLE_ORDER)), "observation_id")
    return observations.where("kind = 'table_region'").withColumn("place", F.row_number().over(w))


def in_corridor(text: str, image: str, width: Column, height: Column, normal_gap: Column) -> Column:
    """Whether box ``text`` lies near box ``image``; names are prefixes of x0, y0, x1, y1."""
    t, i = ({c: F.col(f"{p}{c}") for c in ("x0", "y0", "x1", "y1")} for p in (text, image))
    across = F.greatest(i["x0"] - t["x1"], t["x0"] - i["x1"], F.lit(0.0))
    along = F.greatest(i["y0"] - t["y1"], t["y0"] - i["y1"], F.lit(0.0))
    shared = F.least(t["x1"], i["x1"]) - F.greatest(t["x0"], i["x0"])
    near = (across <= F.greatest(F.lit(48.0), width * 0.12)) & (along <= F.greatest(normal_gap * 6, height * 0.16))
    return near | ((shared > 0) & (along <= F.greatest(F.lit(72.0), height * 0.12)))


def caption_candidates(observations: DataFrame, pages: DataFrame, excluded: DataFrame) -> DataFrame:
    """(doc_id, page, observation_id, place) of the texts that may be captions of a page's images.

    Texts with an image for a parent, and captions and titles near one, and the line right below such a caption
    or title. pages: doc_id, page, width, height, normal_gap; excluded: doc_id, observation_id of table captions.
    """
    corner = ("x0", "y0", "x1", "y1")
    o = reading_order(observations).join(excluded.select("doc_id", "observation_id").distinct().withColumn("_out", F.lit(True)), ["doc_id", "observation_id"], "left")
    o = o.withColumn("_may", F.col("kind").isin("text_region", "footnote_region") & F.col("_out").isNull())
    images = o.where("kind = 'image_region'").select("doc_id", "page", *[F.col(c).alias(f"i_{c}") for c in corner])
    titled = o.where("_may AND role_hint IN ('caption_text', 'title_text')").select("doc_id", "page", "observation_id", *corner)
    near = titled.join(images, ["doc_id", "page"]).join(pages.select("doc_id", "page", "width", "height", "normal_gap"), ["doc_id", "page"])
    near = near.where(in_corridor("", "i_", F.col("width"), F.col("height"), F.col("normal_gap"))).select("doc_id", "observation_id").distinct()
    has = images.select("doc_id", "page").distinct()
    o = o.join(has, ["doc_id", "page"], "left_semi").join(near.withColumn("_near", F.lit(True)), ["doc_id", "observation_id"], "left")
    o = o.withColumn("_first", F.col("_may") & (F.coalesce("_near", F.lit(False)) | (F.coalesce("parent_id", F.lit("")) != "")))
    w = Window.partitionBy("doc_id", "page").orderBy("place")
    before = lambda c: F.lag(c).over(w)
    gap, shared = F.col("y0") - before("y1"), F.least(before("x1"), F.col("x1")) - F.greatest(before("x0"), F.col("x0"))
    follows = (gap >= 0) & (gap <= F.greatest(F.lit(48.0), (before("y1") - before("y0")) * 2.5)) & (shared >= 0)
    # The pass along the page: a line below a chosen caption or title is chosen, and if it is one itself goes on.
    o = o.withColumn("_link", F.coalesce(F.col("_may") & follows & before("role_hint").isin("caption_text", "title_text"), F.lit(False)))
    o = o.withColumn("_chain", F.sum(F.when(F.col("_link"), 0).otherwise(1)).over(w))
    chain = Window.partitionBy("doc_id", "page", "_chain").orderBy("place")
    chosen = F.col("_first") | (F.col("_link") & F.coalesce(F.max("_first").over(chain.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False)))
    return o.withColumn("_chosen", chosen).where("_chosen").select("doc_id", "page", "observation_id", "place")


def parser_groups(observations: DataFrame, captions: DataFrame) -> DataFrame:
    """(doc_id, page, image_id, caption_ids) by the parser's own parents, captions in order."""
    c = captions.join(observations.select("doc_id", "observation_id", "parent_id"), ["doc_id", "observation_id"])
    image = observations.where("kind = 'image_region'").select("doc_id", "page", F.col("observation_id").alias("parent_id"))
    g = c.join(image, ["doc_id", "page", "parent_id"]).groupBy("doc_id", "page", F.col("parent_id").alias("image_id"))
    return g.agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "observation_id"))), lambda x: x["observation_id"]).alias("caption_ids"))


def unpaired(observations: DataFrame, captions: DataFrame, groups: DataFrame) -> DataFrame:
    """(doc_id, page, observation_id, side) of the images and captions in no group, on pages with images."""
    used = groups.select("doc_id", F.explode(F.concat(F.array("image_id"), "caption_ids")).alias("observation_id"))
    images = observations.where("kind = 'image_region'").select("doc_id", "page", "observation_id", F.lit("image").alias("side"))
    return images.union(captions.select("doc_id", "page", "observation_id", F.lit("caption").alias("side"))).join(used, ["doc_id", "observation_id"], "left_anti").select("doc_id", "page", "observation_id", "side")


def merged_table_html(left: Column, right: Column) -> Column:
    """Rows of the right table, without rows that only say that it goes on, below those of the left."""
    from quire.functions.xhtml import CONTINUATION_MARKS

    mark = rf"(?is)<tr[^>]*>(?:\s|<[^>]+>|[()（）\[\]【】])*(?:{'|'.join(CONTINUATION_MARKS)})(?:\s|<[^>]+>|[()（）\[\]【】])*?</tr>"
    inner = lambda h: F.regexp_replace(F.regexp_replace(F.coalesce(h, F.lit("")), r"(?is)^\s*<table[^>]*>", ""), r"(?is)</table>\s*$", "")
    a, b = inner(left), inner(F.regexp_replace(F.coalesce(right, F.lit("")), mark, ""))
    return F.when(a == "", right).when(b == "", left).otherwise(F.concat(F.lit("<table>"), a, b, F.lit("</table>")))


def continued_tables(tables: DataFrame, pages: DataFrame, bottom: float = 0.72, top: float = 0.28) -> DataFrame:
    """(doc_id, left_id, right_id) of a table near a page's foot and the next page's first one near its head that says it goes on.

    tables: doc_id, page, block_id, ord, y0, y1, is_marked; pages: doc_id, page, height.
    """
    t = tables.join(pages.select("doc_id", "page", "height"), ["doc_id", "page"])
    by_page = Window.partitionBy("doc_id", "page")
    t = t.withColumn("_last", F.row_number().over(by_page.orderBy(F.desc("ord"))) == 1).withColumn("_first", F.row_number().over(by_page.orderBy("ord")) == 1)
    left = t.where((F.col("_last")) & (F.col("y1") >= F.col("height") * bottom)).select("doc_id", (F.col("page") + 1).alias("page"), F.col("block_id").alias("left_id"))
    right = t.where(F.col("_first") & (F.col("y0") <= F.col("height") * top) & F.col("is_marked")).select("doc_id", "page", F.col("block_id").alias("right_id"))
    return left.join(right, ["doc_id", "page"]).select("doc_id", "left_id", "right_id")


def ordered_union(left: Column, right: Column) -> Column:
    """Items of both in order, each once."""
    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(F.coalesce(left, none), F.coalesce(right, none)))


def _beside(refs: DataFrame, notes: DataFrame, on: list[str], keys: list[str]) -> DataFrame:
    """References and notes in one table, dealt by ``on``: columns of ``refs``, _is_note and _id; notes have only ``keys``.

    Windows over it count both sides in one sort, where aggregates and joins would deal and sort each side anew.
    """
    own = notes.select(*[F.col(c) if c in keys else F.lit(None).alias(c) for c in refs.columns], F.lit(True), F.col("note_id"))
    return dealt(refs.select("*", F.lit(False).alias("_is_note"), F.lit(None).alias("_id")).union(own), *on)


def _references(both: DataFrame, refs: DataFrame, *made: str) -> DataFrame:
    kinds = {f.name: f.dataType for f in refs.schema}
    return both.where("NOT _is_note").select(*[F.col(c).cast(kinds[c]).alias(c) for c in refs.columns], *made)


def _known(keys: list[str]) -> Column:
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def _with_page_note(refs: DataFrame, notes: DataFrame) -> DataFrame:
    page = ["doc_id", "page"]
    own, on_page = Window.partitionBy(*page, "marker"), Window.partitionBy(*page)
    marked, bare = F.col("_is_note") & (F.col("marker") != ""), F.col("_is_note") & (F.col("marker") == "")
    r = _beside(refs, notes, page, [*page, "marker"])
    r = r.withColumns({"_lo": F.min(F.when(marked, F.col("_id"))).over(own), "_n": F.count_if(marked).over(own), "_refs": F.count_if(~F.col("_is_note")).over(own)})
    r = r.withColumns({"_bare": F.min(F.when(bare, F.col("_id"))).over(on_page), "_n_bare": F.count_if(bare).over(on_page)})
    exact = _known([*page, "marker"]) & (F.col("_n") == 1)
    note = F.when(exact, F.col("_lo")).when(_known(page) & (F.col("_n_bare") == 1) & (F.col("_refs") == 1), F.col("_bare"))
    r = r.withColumn("_page_note", note).withColumn("_confidence", F.when(exact, "high").when(note.isNotNull(), "medium"))
    return _references(r, refs, "_page_note", "_confidence")


def _with_end_note(refs: DataFrame, notes: DataFrame, scoped: bool, name: str) -> DataFrame:
    keys = ["doc_id", "scope_key", "marker"] if scoped else ["doc_id", "marker"]
    own = Window.partitionBy(*keys)
    r = _beside(refs, notes.where("scope_key <> ''") if scoped else notes, keys, keys)
    r = r.withColumns({"_only": F.min("_id").over(own), "_k": F.count_if(F.col("_is_note")).over(own)})
    return _references(r.withColumn(name, F.when(_known(keys) & (F.col("_k") == 1), F.col("_only"))), refs, name)


def resolve_page_footnotes(refs: DataFrame, notes: DataFrame) -> DataFrame:
    """A page's note with exactly the reference's marker if it is the only one, else the page's only unmarked note if the reference is alone there.

    refs: doc_id, ref_id, page, marker; notes: doc_id, note_id, page, marker (empty: none). Repeated references are resolved each.
    """
    return _with_page_note(refs, notes).select("doc_id", "ref_id", "page", "marker", F.col("_page_note").alias("note_id"), F.col("_confidence").alias("confidence"))


def resolve_endnotes(refs: DataFrame, notes: DataFrame, scoped: bool) -> DataFrame:
    """The only note of a marker, within the reference's scope if ``scoped``."""
    return _with_end_note(refs, notes, scoped, "note_id").select("doc_id", "ref_id", "marker", "note_id")


def resolve_in_order(refs: DataFrame, page_notes: DataFrame, end_notes: DataFrame) -> DataFrame:
    """Page footnotes first, then notes of the chapter, then of the book (J3): doc_id, ref_id, note_id, strategy."""
    r = _with_end_note(_with_end_note(_with_page_note(refs, page_notes), end_notes, True, "_c"), end_notes, False, "_b")
    strategy = F.when(F.col("_page_note").isNotNull(), "page_footnote").when(F.col("_c").isNotNull(), "chapter_endnote").when(F.col("_b").isNotNull(), "book_endnote")
    return r.select("doc_id", "ref_id", F.coalesce("_page_note", "_c", "_b").alias("note_id"), strategy.alias("strategy"))


def marker_inventory(notes: DataFrame) -> DataFrame:
    """Markers of note definitions by scope, in order."""
    return notes.where("marker <> ''").groupBy("doc_id", "scope_key").agg(F.array_sort(F.collect_set("marker")).alias("markers"))
