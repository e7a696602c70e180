"""The book graph as tables: nodes, edges, evidence and reading order.

Units: doc_id, ord, unit_id, unit_type, text, page, bbox.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.folds import dealt
from quire.sources import folders


def records(units: DataFrame) -> dict[str, DataFrame]:
    """Nodes, evidence, page edges and reading order of units, ids dense in order."""
    n = F.row_number().over(Window.partitionBy("doc_id").orderBy("ord"))
    u = dealt(units, "doc_id").withColumn("_n", n).withColumn("node_id", F.format_string("n%06d", "_n")).withColumn("evidence_id", F.format_string("ev%06d", "_n"))
    return {
        "nodes": u.select("doc_id", "node_id", F.col("unit_type").alias("node_type"), "text", F.array("evidence_id").alias("evidence_ids")),
        "evidence": u.select("doc_id", "evidence_id", F.col("unit_id").alias("source_id"), "page", F.array("page").alias("pages"), "bbox"),
        "edges": u.where("page IS NOT NULL").select("doc_id", F.lit("appears_on_page").alias("edge_type"), F.col("node_id").alias("source"), F.format_string("page:%d", F.col("page").cast("int")).alias("target")),
        "reading_order": u.select("doc_id", F.col("_n").alias("ord"), "node_id"),
    }


def blocks_of(graph: dict[str, DataFrame]) -> DataFrame:
    """Legacy blocks in reading order, each with its first evidence's place (P10)."""
    nodes = graph["nodes"].withColumn("evidence_id", F.get("evidence_ids", F.lit(0)))
    b = graph["reading_order"].join(nodes, ["doc_id", "node_id"]).join(graph["evidence"].select("doc_id", "evidence_id", "page", "bbox"), ["doc_id", "evidence_id"], "left")
    return b.select("doc_id", "ord", F.format_string("b%06d", F.col("ord").cast("int")).alias("block_id"), F.col("node_type").alias("type"), "text", "page", "bbox")


def node_pages(graph: dict[str, DataFrame]) -> DataFrame:
    """(doc_id, node_id, page) by evidence."""
    n = graph["nodes"].select("doc_id", "node_id", F.explode("evidence_ids").alias("evidence_id"))
    e = graph["evidence"].select("doc_id", "evidence_id", F.explode("pages").alias("page"))
    return n.join(e, ["doc_id", "evidence_id"]).select("doc_id", "node_id", "page").distinct()


def audit(graph: dict[str, DataFrame]) -> DataFrame:
    """Counts by part and type of each document (A10)."""
    one = lambda df, part, kind: df.groupBy("doc_id", F.lit(part).alias("part"), F.col(kind).alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    return one(graph["nodes"], "node", "node_type").union(one(graph["edges"], "edge", "edge_type"))


def difference(new: DataFrame, old: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """``change`` of every key: added, removed, changed or same, and the names of the fields that differ."""
    o = old.select(*keys, F.lit(1).alias("_o"), *(F.col(f).alias(f"_old_{f}") for f in fields))
    d = new.select(*keys, F.lit(1).alias("_n"), *fields).join(o, keys, "full_outer")
    differ = F.filter(F.array(*(F.when(~F.col(f).eqNullSafe(F.col(f"_old_{f}")), f) for f in fields)), lambda x: x.isNotNull())
    change = F.when(F.col("_o").isNull(), "added").when(F.col("_n").isNull(), "removed").when(F.size(differ) > 0, "changed").otherwise("same")
    return d.select(*keys, change.alias("change"), F.when(change == "changed", F.array_join(differ, ",")).otherwise("").alias("fields"))


def merge_runs(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Adjacent inline runs of one type and marker joined (P6, C32): keys, run, type, marker, text."""
    from quire.operators.layout import runs as islands

    r = islands(runs, keys, ["ord"], ["type", "marker"])
    parts = F.sort_array(F.collect_list(F.struct("ord", "text")))
    return r.groupBy(*keys, "run", "type", "marker").agg(F.array_join(F.transform(parts, lambda x: x["text"]), "").alias("text"))


def book(units: DataFrame, roles: DataFrame, review: DataFrame, references: DataFrame) -> dict[str, DataFrame]:
    """The book graph of text units (R22, F2, R23, W14, J1, J2): nodes, edges, evidence, reading_order and references.

    units: doc_id, ord, unit_id, unit_type, text, page, pages, bbox, marker; roles: doc_id, page, page_role; review:
    doc_id, page, action; references: doc_id, unit_id, ref_id, marker. Units with every page included are nodes; footnotes
    are notes by their page's role, entries of note sections too; a reference is resolved among the notes of its page,
    then of its chapter, then of the book, if exactly one has its marker.
    """
    from quire.operators import note_sections as S
    from quire.operators import notes as N

    out = units.select("doc_id", "unit_id", F.explode("pages").alias("page")).join(review.where("action = 'include'").select("doc_id", "page").distinct(), ["doc_id", "page"], "left_anti")
    kept = units.join(out.select("doc_id", "unit_id").distinct(), ["doc_id", "unit_id"], "left_anti").join(roles.select("doc_id", "page", "page_role"), ["doc_id", "page"], "left")
    u = dealt(kept, "doc_id").withColumn("_n", F.row_number().over(Window.partitionBy("doc_id").orderBy("ord"))).withColumn("node_id", F.format_string("n%06d", "_n")).withColumn("evidence_id", F.format_string("ev%06d", "_n"))
    foot = S.normalised()
    n = u.withColumn("node_type", F.col("unit_type")).select("doc_id", "node_id", "ord", "page", "unit_id", "evidence_id", "page_role", foot["node_type"].alias("node_type"), foot["text"].alias("text"), F.coalesce(foot["note_marker"], "marker").alias("marker"), foot["note_marker"].alias("_foot_marker"), foot["placement"].alias("_foot_placement"))
    n = S.note_sections(n)
    placed = F.when(F.col("is_entry"), F.col("placement")).otherwise(F.col("_foot_placement"))
    nodes = n.select("doc_id", "node_id", "ord", "page", "unit_id", "evidence_id", "page_role", "node_type", "text", F.when(F.col("node_type") == "note", F.coalesce("note_marker", "_foot_marker")).alias("note_marker"), placed.alias("placement"),
                     F.coalesce("scope", F.when(F.col("_foot_placement") == "page_foot", "page").when(F.col("_foot_placement").isNotNull(), "unknown")).alias("scope"), F.when(F.col("is_entry"), F.col("scope_key")).alias("note_scope_key"), "section_no")
    heading = F.when((F.col("node_type") == "heading") & F.col("section_no").isNull(), S.scope_key(F.col("text")))
    # References, notes and edges are read off the nodes: these are made and written once.
    scoped = folders.stored(nodes.withColumn("_scope", F.last(heading, ignorenulls=True).over(Window.partitionBy("doc_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0))), "nodes")
    nodes = scoped.drop("_scope")
    r = references.select("doc_id", "unit_id", "ref_id", "marker").join(scoped.where("node_type <> 'note'").select("doc_id", "unit_id", "node_id", "page", F.col("_scope").alias("scope_key")).hint("merge"), ["doc_id", "unit_id"])  # packed ids look small enough to broadcast and are not
    notes = nodes.where("node_type = 'note' AND coalesce(note_marker, '') <> ''").select("doc_id", F.col("node_id").alias("note_id"), "page", F.col("note_marker").alias("marker"), "scope", F.coalesce("note_scope_key", F.lit("")).alias("scope_key"), "placement")
    found = N.with_scoped_notes(N.with_page_notes(r, notes.where("placement = 'page_foot'")), notes.where("placement <> 'page_foot'"))
    page_note, scope_note = F.when(F.col("_note") == F.col("_last"), F.col("_note")), F.when(F.col("_lo") == F.col("_hi"), F.col("_lo"))
    refs = found.select("doc_id", "ref_id", "node_id", "marker", F.coalesce(page_note, scope_note).alias("note_id"), F.when(page_note.isNotNull(), "page_foot").when(scope_note.isNotNull(), "note_section").alias("placement"))
    pages = nodes.select("doc_id", F.lit("appears_on_page").alias("edge_type"), F.col("node_id").alias("source"), F.format_string("page:%d", F.col("page").cast("int")).alias("target"))
    links = refs.where("note_id IS NOT NULL").select("doc_id", F.lit("references_note").alias("edge_type"), F.col("node_id").alias("source"), F.col("note_id").alias("target")).distinct()
    return {"nodes": nodes, "edges": pages.union(links), "evidence": u.select("doc_id", "evidence_id", F.col("unit_id").alias("source_id"), "page", "pages", "bbox"), "reading_order": nodes.select("doc_id", "ord", "node_id"), "references": refs}
