"""Constraints between artifacts, as tables of violations: doc_id, rule, detail.

Each contract is a union of rules over the artifacts' tables, every one a filter,
a join by document and id, or a difference of sets; none gathers a document. An
artifact keeps its contract if its table of violations is empty. Null ids break
what needs them; repeated rows break what must be unique; empty tables break
nothing but completeness.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.operators.constraints import broken, every, increasing, lost, references, required, same_set, unique, where
from quire.operators.folds import joined

# Domains of the contracts.
REVIEW_ACTIONS = ("include", "metadata_only", "exclude")
OUTCOMES = ("found", "absent", "not_run", "failed", "unresolved")


def internal_records(records: DataFrame) -> DataFrame:
    """Every record is a public part and a debug part of one id (Q4)."""
    at = F.col("record_id")
    return every([unique(records, "record_id"), where(records, "pair", F.col("public_id").isNull() | F.col("debug_id").isNull() | (F.col("public_id") != F.col("debug_id")), at)])


def page_layout(analysed: DataFrame, pages: DataFrame) -> DataFrame:
    """Pages unique, in order, all there, fields given (Q5). analysed: doc_id, ord, page, width, height."""
    return every([required(analysed, ["width", "height"], F.col("page")), unique(analysed, "page"), increasing(analysed, "page", "ord"), lost(pages, analysed, "page", "uncovered:page"), lost(analysed, pages, "page", "reference:page")])


def skeleton(entries: DataFrame, evidence: DataFrame, observations: DataFrame, toc_pages: DataFrame) -> DataFrame:
    """Anchors' evidence exists, titles on the anchor's page, contents on contents pages, roles in order (Q6).

    entries: doc_id, entry_index, role, page; evidence: doc_id, entry_index, kind (title or toc), observation_id.
    """
    rank = F.array_position(F.array(*[F.lit(r) for r in ("front_matter", "body", "back_matter")]), F.col("role"))
    order = Window.partitionBy("doc_id").orderBy("entry_index").rowsBetween(Window.unboundedPreceding, -1)
    back = entries.withColumn("_rank", rank).withColumn("_most", F.max("_rank").over(order))
    e = evidence.join(entries.select("doc_id", "entry_index", F.col("page").alias("anchor_page")), ["doc_id", "entry_index"])
    o = observations.select("doc_id", "observation_id", "page", "role_hint")
    seen = e.join(o, ["doc_id", "observation_id"]).join(toc_pages.select("doc_id", "page").distinct().withColumn("_toc", F.lit(True)), ["doc_id", "page"], "left")
    off = (F.col("kind") == "toc") & (F.col("_toc").isNull() | ~F.coalesce(F.col("role_hint") == "toc_text", F.lit(False)))
    return every([
        lost(e, o, "observation_id", "reference:observation_id"), where(seen, "title_page", (F.col("kind") == "title") & (F.col("page") != F.col("anchor_page")), F.col("observation_id")),
        where(seen, "toc_page", off, F.col("observation_id")), where(back, "role_order", F.col("_rank") < F.col("_most"), F.col("entry_index")),
    ])


def resolved_review(review: DataFrame, candidates: DataFrame, primaries: DataFrame) -> DataFrame:
    """Every candidate page is decided by review, no action is open, primary pages exist.

    review: doc_id, page, action, source, status; primaries: doc_id, page, primary_page.
    """
    decided = candidates.select("doc_id", "page").join(review, ["doc_id", "page"])
    return every([
        unique(candidates, "page"), lost(candidates, review, "page", "uncovered:page"),
        where(decided, "undecided", ~F.coalesce((F.col("source") == "llm_page_review") & (F.col("status") == "sent_and_resolved"), F.lit(False)), F.col("page")),
        where(decided, "open_action", ~F.coalesce(F.col("action").isin(*REVIEW_ACTIONS), F.lit(False)), F.col("page")),
        lost(primaries.select("doc_id", F.col("primary_page").alias("page")), review, "page", "reference:primary_page"),
    ])


def text_flow(units: DataFrame, members: DataFrame, observations: DataFrame) -> DataFrame:
    """Each observation in at most one unit, units in the order of their first observation (Q8).

    units: doc_id, unit_id, ord; members: doc_id, unit_id, observation_id; observations: doc_id, observation_id, place.
    """
    first = members.join(observations, ["doc_id", "observation_id"]).groupBy("doc_id", "unit_id").agg(F.min("place").alias("_place"))
    u = units.join(first, ["doc_id", "unit_id"], "left")
    moved = u.withColumn("_before", F.max("_place").over(Window.partitionBy("doc_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)))
    return every([unique(units, "unit_id"), unique(members, "observation_id"), references(members, "observation_id", observations, "observation_id"), where(u, "empty_unit", F.col("_place").isNull(), F.col("unit_id")), where(moved, "order", F.col("_place") < F.col("_before"), F.col("unit_id"))])


def final_text_flow(captions: DataFrame, images: DataFrame, placed: DataFrame, markers: DataFrame, used: DataFrame) -> DataFrame:
    """Grouped captions are placed once each, images never, every reference's marker is used once (Q9)."""
    key = lambda df: df.select("doc_id", F.col("observation_id").alias("caption_id"))
    asset = key(placed).join(images.select("doc_id", F.col("observation_id").alias("caption_id")), ["doc_id", "caption_id"], "left_semi")
    own = key(placed).join(images.select("doc_id", F.col("observation_id").alias("caption_id")), ["doc_id", "caption_id"], "left_anti")
    return every([same_set(key(captions), own, "caption_id"), where(asset, "asset_in_text", F.lit(True), F.col("caption_id")), same_set(markers, used, "reference_id")])


def table_flow(consumed: DataFrame, observations: DataFrame, review: DataFrame) -> DataFrame:
    """Every table observation is in one run, admitted runs on included pages only, excluded ones on none.

    consumed: doc_id, observation_id, run_id, status (admitted, unresolved, excluded).
    """
    tables = observations.where("kind = 'table_region'")
    pages = consumed.join(tables.select("doc_id", "observation_id", "page"), ["doc_id", "observation_id"]).join(review.select("doc_id", "page", "action"), ["doc_id", "page"], "left")
    included = F.coalesce(F.col("action") == "include", F.lit(False))
    bad = ((F.col("status") == "admitted") & ~included) | ((F.col("status") == "excluded") & included)
    return every([same_set(tables, consumed, "observation_id"), where(pages, "disposition", bad, F.col("observation_id"))])


def visual_relations(endpoints: DataFrame, groups: DataFrame, observations: DataFrame, reviewed: DataFrame, table_captions: DataFrame) -> DataFrame:
    """Endpoints are images or texts of reviewed pages, captions aren't a table's, a group's pages are its endpoints' (Q11).

    endpoints: doc_id, group_id, observation_id, side (image or caption); groups: doc_id, group_id, pages.
    """
    at = F.col("observation_id")
    e = endpoints.join(observations.select("doc_id", "observation_id", "kind", "page"), ["doc_id", "observation_id"], "left")
    kind = F.when(F.col("side") == "image", F.col("kind") == "image_region").otherwise(F.col("kind").isin("text_region", "footnote_region"))
    images = e.where("side = 'image' AND kind = 'image_region'")
    own = e.where("side = 'caption'").join(table_captions.select("doc_id", "observation_id").distinct(), ["doc_id", "observation_id"], "left_semi")
    found = e.where("page IS NOT NULL").groupBy("doc_id", "group_id").agg(F.array_sort(F.collect_set("page")).alias("_pages"))
    g = groups.join(found, ["doc_id", "group_id"], "left")
    return every([where(e, "endpoint", ~F.coalesce(kind, F.lit(False)), at), where(joined(images, reviewed.select("doc_id", "page"), ["doc_id", "page"], "left_anti"), "unreviewed", F.lit(True), at), where(own, "table_caption", F.lit(True), at), where(g, "group_pages", ~F.array_sort(F.array_distinct("pages")).eqNullSafe(F.col("_pages")), F.col("group_id"))])


def note_systems(systems: DataFrame, ranges: DataFrame, pages: DataFrame, evidence: DataFrame) -> DataFrame:
    """Systems unique, their page ranges in order, in the document and apart within a system, evidence there.

    ranges: doc_id, system_id, first, last; evidence: doc_id, system_id.
    """
    w = Window.partitionBy("doc_id", "system_id").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    r = ranges.withColumn("_until", F.max("last").over(w))
    ends = ranges.select("doc_id", F.explode(F.array_distinct(F.array("first", "last"))).alias("page"))
    return every([unique(systems, "system_id"), references(ranges, "system_id", systems, "system_id"), where(ranges, "range", F.col("first") > F.col("last"), F.col("system_id")), where(r, "overlap", F.col("first") <= F.col("_until"), F.col("system_id")), references(ends.distinct(), "page", pages, "page"), lost(systems, evidence, "system_id", "evidence")])


def marker_plan(definitions: DataFrame, requests: DataFrame, skipped: DataFrame, systems: DataFrame) -> DataFrame:
    """Every definition is asked for or skipped, once, under a known system (Q13)."""
    both = requests.select("doc_id", "definition_id").union(skipped.select("doc_id", "definition_id"))
    return every([same_set(definitions, both, "definition_id"), references(requests, "system_id", systems, "system_id")])


def marker_review(requests: DataFrame, outcomes: DataFrame) -> DataFrame:
    """One outcome a request; found ones have a marker, others none (Q14, R21). outcomes: doc_id, request_id, status, marker."""
    has = F.coalesce(F.col("marker") != "", F.lit(False))
    return every([same_set(requests, outcomes, "request_id"), where(outcomes, "domain:status", ~F.coalesce(F.col("status").isin(*OUTCOMES), F.lit(False)), F.col("request_id")), where(outcomes, "marker", (F.col("status") == "found") != has, F.col("request_id"))])


def note_inventory(definitions: DataFrame, unresolved: DataFrame, footnotes: DataFrame, refs: DataFrame, units: DataFrame, systems: DataFrame) -> DataFrame:
    """Every footnote unit is a definition or unresolved, ids unique, units and systems known."""
    placed = definitions.select("doc_id", "unit_id").union(unresolved.select("doc_id", "unit_id"))
    return every([same_set(footnotes, placed, "unit_id"), unique(definitions, "definition_id"), unique(refs, "reference_id"), references(refs, "unit_id", units, "unit_id"), references(definitions, "system_id", systems, "system_id"), references(refs, "system_id", systems, "system_id")])


def section_map(sections: DataFrame, evidence: DataFrame, pages: DataFrame) -> DataFrame:
    """Sections unique, ranges in order and in the document, parents earlier and around them, evidence there.

    sections: doc_id, section_id, ord, parent_id, first, last.
    """
    p = sections.select("doc_id", F.col("section_id").alias("parent_id"), F.col("ord").alias("_ord"), F.col("first").alias("_first"), F.col("last").alias("_last"))
    child = joined(sections, p, ["doc_id", "parent_id"])
    ends = sections.select("doc_id", F.explode(F.array_distinct(F.array("first", "last"))).alias("page")).distinct()
    around = (F.col("_first") <= F.col("first")) & (F.col("last") <= F.col("_last")) & (F.col("_ord") < F.col("ord"))
    return every([unique(sections, "section_id"), where(sections, "range", F.col("first") > F.col("last"), F.col("section_id")), references(sections, "parent_id", sections, "section_id"), where(child, "nesting", ~around, F.col("section_id")), references(ends, "page", pages, "page"), lost(sections, evidence, "section_id", "evidence")])


def section_links(members: DataFrame, units: DataFrame, sections: DataFrame) -> DataFrame:
    """Every text unit lies in one known section."""
    return every([same_set(units, members, "unit_id"), references(members, "section_id", sections, "section_id")])


def note_resolution(relations: DataFrame, unresolved: DataFrame, refs: DataFrame, definitions: DataFrame) -> DataFrame:
    """Every reference is related or unresolved, once; relations keep system, marker and scope.

    refs and definitions: their id, system_id, marker, section_id, page; relations: doc_id, reference_id, definition_id, scope.
    """
    placed = relations.select("doc_id", "reference_id").union(unresolved.select("doc_id", "reference_id"))
    r = refs.select("doc_id", "reference_id", *[F.col(c).alias(f"r_{c}") for c in ("system_id", "marker", "section_id", "page")])
    d = definitions.select("doc_id", "definition_id", *[F.col(c).alias(f"d_{c}") for c in ("system_id", "marker", "section_id", "page")])
    both = joined(joined(relations, r, ["doc_id", "reference_id"]), d, ["doc_id", "definition_id"])
    differ = lambda c: ~F.col(f"r_{c}").eqNullSafe(F.col(f"d_{c}"))
    at = F.col("reference_id")
    scope = ((F.col("scope") == "page") & differ("page")) | ((F.col("scope") == "chapter") & differ("section_id"))
    return every([same_set(refs, placed, "reference_id"), references(relations, "definition_id", definitions, "definition_id"), broken(both, {"system": differ("system_id"), "marker": differ("marker"), "scope": scope}, at)])


def bundle(artifacts: DataFrame, names: list[str]) -> DataFrame:
    """Every artifact of the list is there once for each document, and no other (Q19, Z1). artifacts: doc_id, name."""
    wanted = artifacts.select("doc_id").distinct().withColumn("name", F.explode(F.array(*[F.lit(n) for n in names])))
    return same_set(wanted, artifacts, "name")


def same_pages(covered: DataFrame, pages: DataFrame) -> DataFrame:
    """Every artifact covers just the document's pages (Q20). covered: doc_id, artifact, page."""
    wanted = pages.select("doc_id", "page").join(covered.select("doc_id", "artifact").distinct(), "doc_id")
    name = F.concat_ws(":", "artifact", "page")
    lost = wanted.join(covered, ["doc_id", "artifact", "page"], "left_anti")
    extra = covered.join(pages, ["doc_id", "page"], "left_anti")
    return where(lost, "uncovered:page", F.lit(True), name).union(where(extra, "reference:page", F.lit(True), name))
