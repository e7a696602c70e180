"""Note sections of the book graph and its audits.

Nodes in reading order: doc_id, ord, node_id, node_type, text, page, y0, marker
(explicit), is_reference. Every step is a window over a document's nodes; null
texts are empty; nodes that repeat an ord are taken by node_id; empty tables give
empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import text as T

# Headings that begin and end note sections, and leading markers.
_BEGINS = r"(?i)^(?:注释|注|notes?|endnotes?)$"
_ENDS = r"(?i)^(?:参考文献|参考书目|扩展阅读|索引|出版后记|版权|bibliography|references|index)$"
_MARKER = rf"^[{T.WHITE}]*([0-9]{{1,3}}|[①-⓿❶-➓¹²³⁴⁵⁶⁷⁸⁹⁰*†‡§]+)(?:[{T.WHITE}.、．,)）]|$)"


def first_line(text: Column) -> Column:
    return T.strip(F.regexp_replace(F.split(F.coalesce(text, F.lit("")), "\n")[0], rf"[{T.WHITE}]+", " "))


def begins_notes(text: Column) -> Column:
    """F12."""
    return first_line(text).rlike(_BEGINS)


def ends_notes(text: Column) -> Column:
    return first_line(text).rlike(_ENDS)


def leading_marker(text: Column, explicit: Column) -> Column:
    """The marker that is given, else the one the text begins with, else empty (C11)."""
    return F.coalesce(T.strip(explicit), F.regexp_extract(F.coalesce(text, F.lit("")), _MARKER, 1))


def scope_key(text: Column) -> Column:
    """C14."""
    return F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), rf"[{T.WHITE}]+", ""))


def note_sections(nodes: DataFrame) -> DataFrame:
    """``nodes`` with section_no, scope_key, placement, scope, note_marker, is_promoted, and what promotion makes of node_type and text.

    A note heading opens a section, a stop heading closes it, any other heading in it sets the scope. Notes, paragraphs
    and list items with a marker, and all notes, are entries of their section.
    """
    order = Window.partitionBy("doc_id").orderBy("ord", "node_id")
    heading = F.col("node_type") == "heading"
    n = nodes.withColumn("_opens", F.coalesce(heading & begins_notes(F.col("text")), F.lit(False))).withColumn("_stops", F.coalesce(heading & ends_notes(F.col("text")), F.lit(False)) & ~F.col("_opens"))
    n = n.withColumn("_section", F.sum(F.col("_opens").cast("int")).over(order)).withColumn("_last_page", F.max("page").over(Window.partitionBy("doc_id")))
    inside = Window.partitionBy("doc_id", "_section").orderBy("ord", "node_id")
    n = n.withColumn("_closed", F.max(F.col("_stops").cast("int")).over(inside))
    n = n.withColumn("_in", (F.col("_section") > 0) & (F.col("_closed") == 0))
    late = F.first(F.col("page"), ignorenulls=False).over(inside) >= F.greatest(F.lit(1), F.bround(F.col("_last_page") * F.lit(0.6)).cast("int"))
    placement = F.when(F.coalesce(late & (F.col("_last_page") > 0), F.lit(False)), "book_end").otherwise("chapter_end")
    n = n.withColumn("placement", F.when(F.col("_in"), placement))
    sets = F.col("_in") & heading & ~F.col("_opens")
    n = n.withColumn("scope_key", F.when(F.col("_in"), F.coalesce(F.last(F.when(sets, scope_key(F.col("text"))), ignorenulls=True).over(inside), F.lit(""))))
    n = n.withColumn("note_marker", F.when(F.col("node_type").isin("note", "paragraph", "list_item"), leading_marker(F.col("text"), F.col("marker"))))
    entry = F.coalesce(F.col("_in") & F.col("node_type").isin("note", "paragraph", "list_item") & ((F.col("node_type") == "note") | (F.col("note_marker") != "")), F.lit(False))
    n = n.withColumn("is_entry", entry).withColumn("is_promoted", F.col("is_entry") & (F.col("node_type") != "note"))
    scope = F.when(F.col("scope_key") != "", "chapter").when(F.col("placement") == "book_end", "book").otherwise("unknown")
    n = n.withColumn("scope", F.when(F.col("is_entry"), scope)).withColumn("section_no", F.when(F.col("is_entry") | F.col("_opens") | sets, F.col("_section")))
    said = F.when(F.col("is_promoted"), T.strip_note_marker(F.col("text"), F.col("note_marker"))).otherwise(F.col("text"))
    return n.withColumn("text", said).withColumn("node_type", F.when(F.col("is_promoted"), "note").otherwise(F.col("node_type"))).drop("_opens", "_stops", "_section", "_last_page", "_closed", "_in")


def page_foot_references(nodes: DataFrame, pages: DataFrame, most: int = 10, least_top: float = 0.55) -> DataFrame:
    """(doc_id, node_id, note_marker) of the reference texts that are notes at the foot of a page.

    Only pages with at most ``most`` reference texts, and texts that start below ``least_top`` of the page, count.
    """
    r = nodes.where("is_reference").withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("doc_id", "page"))).join(pages.select("doc_id", "page", "height"), ["doc_id", "page"])
    r = r.withColumn("note_marker", leading_marker(F.col("text"), F.col("marker")))
    return r.where((F.col("_n") <= most) & (F.col("node_type") != "note") & (F.col("note_marker") != "") & (F.col("height") > 0) & (F.col("y0") / F.col("height") >= least_top)).select("doc_id", "node_id", "note_marker")


def normalised() -> dict[str, Column]:
    """Footnotes as notes: their marker, text without it, and placement by the page's role (R23), columns of nodes with page_role."""
    is_note = F.col("node_type") == "footnote"
    marker = leading_marker(F.col("text"), F.col("marker"))
    apart = F.coalesce(F.col("page_role") == "note_section_candidate", F.lit(False))
    return {
        "node_type": F.when(is_note, "note").otherwise(F.col("node_type")), "text": F.when(is_note, T.strip_note_marker(F.col("text"), marker)).otherwise(F.col("text")), "note_marker": F.when(is_note, marker),
        "placement": F.when(is_note, F.when(apart, "note_section_candidate").otherwise("page_foot")), "scope": F.when(is_note, F.when(apart, "unknown").otherwise("page")),
    }


def normalised_notes(nodes: DataFrame) -> DataFrame:
    """``normalised`` as a table."""
    return nodes.select("doc_id", "node_id", *[c.alias(name) for name, c in normalised().items()])


def display_audit(nodes: DataFrame) -> DataFrame:
    """(doc_id, node_id, finding, reasons) of displays that look like headings or like body text."""
    text = T.strip(F.coalesce("text", F.lit("")))
    some = lambda *cs: F.filter(F.array(*cs), lambda x: x.isNotNull())
    head = some(F.when(F.length(text).between(1, 40), "short_text"), F.when(F.col("y0") <= 360, "top_of_page"), F.when((text != "") & ~text.rlike("[.!?;:。！？；：]$"), "no_sentence_terminal"))
    body = some(F.when(F.length(F.coalesce("text", F.lit(""))) >= 80, "long_text"), F.when(F.col("layout_context") == "inline_flow", "inline_flow"))
    d = nodes.where("node_type = 'display_block'")
    row = lambda name, why, least: F.when(F.size(why) >= least, F.struct(F.lit(name).alias("finding"), F.array_join(why, ",").alias("reasons")))
    return d.select("doc_id", "node_id", F.explode(some(row("heading_like", head, 3), row("body_like", body, 2))).alias("f")).select("doc_id", "node_id", "f.finding", "f.reasons")


def structure_warnings(nodes: DataFrame) -> DataFrame:
    """Documents with more displays than paragraphs."""
    n = nodes.groupBy("doc_id").agg(F.count_if(F.col("node_type") == "display_block").alias("display_block_count"), F.count_if(F.col("node_type") == "paragraph").alias("paragraph_count"))
    return n.where("display_block_count > paragraph_count").withColumn("warning", F.lit("display_blocks_outnumber_paragraphs"))


def evidence_summary(evidence: DataFrame) -> DataFrame:
    """A10: evidence by what it has."""
    return evidence.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.count("page").alias("with_page"), F.count("bbox").alias("with_bbox"))


def reference_ratio(references: DataFrame) -> DataFrame:
    """n_references, n_resolved and their ratio at four places, null without references."""
    g = references.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_references"), F.count("note_id").alias("n_resolved"))
    return g.withColumn("ratio", F.bround(F.col("n_resolved") / F.col("n_references"), 4))


def placement_counts(notes: DataFrame) -> DataFrame:
    """Notes by placement and scope, unknown where there is none."""
    known = lambda c: F.coalesce(F.when(F.col(c) != "", F.col(c)), F.lit("unknown")).alias(c)
    return notes.select("doc_id", known("placement"), known("scope")).groupBy("doc_id", "placement", "scope").agg(F.count(F.lit(1)).alias("n"))
