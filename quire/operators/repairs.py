"""Repairs of parsed blocks and evidence of model passes.

All are windows or aggregates by document; null pages and texts are left out where
they would count, repeated rows count each, empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def table_pages(blocks: DataFrame) -> DataFrame:
    """doc_id, block_id, pages and is_continued of every table: its page and those of the continuations after it.

    Page numbers in between don't end a table, anything else does. blocks: doc_id, ord, block_id, type, page.
    """
    order = Window.partitionBy("doc_id").orderBy("ord", "block_id")
    b = blocks.where("type <> 'page_number'").withColumn("_g", F.sum(F.when(F.col("type") == "table_continuation", 0).otherwise(1)).over(order))
    page = F.when(F.coalesce(F.col("page"), F.lit(0)) != 0, F.col("page"))
    rows = F.sort_array(F.collect_list(F.struct("ord", page.alias("p"))))
    g = b.groupBy("doc_id", "_g").agg(F.min(F.struct("ord", "type", "block_id")).alias("first"), rows.alias("r"), F.count(F.lit(1)).alias("n"))
    pages = F.array_distinct(F.filter(F.transform("r", lambda x: x["p"]), lambda p: p.isNotNull()))
    return g.where("first.type = 'table'").select("doc_id", "first.block_id", pages.alias("pages"), (F.col("n") > 1).alias("is_continued"))


def recovered_markers(notes: DataFrame, markers: DataFrame) -> DataFrame:
    """(doc_id, note_id, marker) for notes without one, by place among the markers that their page's formulas give.

    Only on pages with as many markers as notes, where those that notes have stand at their places and some note has none.
    notes: doc_id, page, ord, note_id, marker (empty: none); markers: doc_id, page, ord, marker.
    """
    at = lambda df: F.row_number().over(Window.partitionBy("doc_id", "page").orderBy("ord"))  # noqa: E731, ARG005
    n = notes.withColumn("_at", at(notes)).withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("doc_id", "page")))
    m = markers.withColumn("_at", at(markers)).withColumn("_m", F.count(F.lit(1)).over(Window.partitionBy("doc_id", "page"))).select("doc_id", "page", "_at", "_m", F.col("marker").alias("_given"))
    both = n.join(m, ["doc_id", "page", "_at"]).where("_n = _m")
    own = F.coalesce("marker", F.lit(""))
    both = both.withColumn("_bad", F.max((own != "") & (own != F.col("_given"))).over(Window.partitionBy("doc_id", "page")))
    return both.where(~F.col("_bad") & (own == "")).select("doc_id", "note_id", F.col("_given").alias("marker"))


def display_blocks(raw: DataFrame) -> DataFrame:
    """doc_id, group_no, text, page, pages, bbox and n_spans of displays made of raw blocks (P19). raw: doc_id, group_no, ord, page, text and box."""
    row = F.sort_array(F.collect_list(F.struct("ord", "page", F.coalesce("text", F.lit("")).alias("text"), F.col("x0").isNotNull().alias("boxed"))))
    g = raw.groupBy("doc_id", "group_no").agg(row.alias("r"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))
    said = F.filter(F.transform("r", lambda x: x["text"]), lambda x: x != "")
    pages = F.array_distinct(F.filter(F.transform("r", lambda x: x["page"]), lambda p: p.isNotNull()))
    spans = F.size(F.filter("r", lambda x: (x["text"] != "") & x["boxed"]))
    return g.select("doc_id", "group_no", F.trim(F.array_join(said, "\n")).alias("text"), F.col("r")[0]["page"].alias("page"), pages.alias("pages"), F.when(F.col("x0").isNotNull(), F.array("x0", "y0", "x1", "y1")).alias("bbox"), F.when(spans > 1, spans).otherwise(0).alias("n_spans"))


def cached_evidence(found: DataFrame, prompt_version: int) -> DataFrame:
    """One row a page and image of the current prompt, later rows over earlier ones where they say something.

    found: doc_id, ord, page, image (a path), dpi, body_refs, footnote_defs, prompt_version.
    """
    f = found.where((F.col("prompt_version") == prompt_version) & F.col("page").isNotNull() & F.col("image").isNotNull()).withColumn("image_name", F.substring_index("image", "/", -1))
    said = {"dpi": F.col("dpi") > 0, "body_refs": F.size("body_refs") > 0, "footnote_defs": F.size("footnote_defs") > 0}
    last = lambda c, ok: F.max_by(F.when(ok, F.col(c)), F.when(ok, F.col("ord"))).alias(c)
    return f.groupBy("doc_id", "page", "image_name").agg(*[last(c, ok) for c, ok in said.items()])


def pass_summary(timings: DataFrame) -> DataFrame:
    """Per document the pages asked, cache hits and misses, calls, and seconds in all and a page."""
    g = timings.groupBy("doc_id").agg(F.count(F.lit(1)).alias("pages"), F.count_if("cache_hit").alias("cache_hits"), F.sum("model_calls").alias("model_calls"), F.bround(F.sum("seconds"), 6).alias("total_page_seconds"))
    return g.withColumn("cache_misses", F.col("pages") - F.col("cache_hits")).withColumn("avg_page_seconds", F.bround(F.col("total_page_seconds") / F.col("pages"), 6))
