"""Page roles: signals of each page, its role alone, and what its neighbours change.

Observations: doc_id, page, kind, role_hint, x0, y0, x1, y1; pages: doc_id, page,
width, height; profiles: doc_id, page of the pages that have a body lane of their own.
A role is a cascade over the page's own signals, so one projection; the overrides
are windows over a document's pages. Observations with a null corner don't count;
pages without observations are blank; empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.operators import layout

# Thresholds of page roles.
VISUAL, TEXT = ("image_region", "table_region"), ("text_region", "footnote_region")
DOMINANT, SPARSE_TEXT, CENTRE_TOLERANCE, LEAST_RUN, MOST_GAP = 0.55, 0.12, 0.18, 4, 3
SPARSE_VISUAL_TEXT, ANNOTATED_VISUAL_TEXT = 0.02, 0.03
HINTS = ("toc_text", "title_text", "body_text", "list_text", "reference_text", "footnote_text", "page_number")
BLOCKED_GAP_ROLES = ("cover_page", "front_visual_page", "visual_page", "back_cover_candidate", "toc_page")


def metrics(observations: DataFrame, pages: DataFrame) -> DataFrame:
    """Counts and shares of every page."""
    p = pages.select("doc_id", "page", "width", "height")
    boxed = F.col("x0").isNotNull() & F.col("y0").isNotNull() & F.col("x1").isNotNull() & F.col("y1").isNotNull()
    o = p.join(observations.select("doc_id", "page", "kind", "role_hint", "x0", "y0", "x1", "y1"), ["doc_id", "page"], "left")
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    text, visual = boxed & F.col("kind").isin(*TEXT), boxed & F.col("kind").isin(*VISUAL)
    content = text | visual
    area = F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0))
    centred = F.abs((F.col("x0") + F.col("x1")) / 2 - F.col("width") / 2) <= F.col("width") * CENTRE_TOLERANCE
    count = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    share = lambda c: F.round(F.least(F.coalesce(F.sum(F.when(c, area)), F.lit(0.0)) / F.first(F.col("width") * F.col("height")), F.lit(1.0)), 4)
    hint = lambda name: count(content & (F.col("role_hint") == name)).alias(f"n_{name}")
    return o.groupBy("doc_id", "page").agg(
        count(content).alias("content_count"), count(text).alias("text_count"), count(visual).alias("visual_count"), count(boxed & (F.col("kind") == "table_region")).alias("table_count"),
        count(text & (F.col("role_hint") == "footnote_text") & (F.col("y0") < F.col("height") * 0.7)).alias("body_zone_footnote_count"), share(visual).alias("visual_area_ratio"), share(text).alias("text_area_ratio"),
        F.coalesce(count(text & centred) / F.nullif(count(text), F.lit(0)), F.lit(0.0)).alias("centered_text_ratio"), count(text & (w > 0) & (h >= w * 2)).alias("tall_text_count"),
        count(content & ~F.coalesce(F.col("role_hint"), F.lit("")).isin("caption_text", "footnote_text", "unknown")).alias("n_other"), *[hint(x) for x in HINTS if x != "page_number"], count(F.col("role_hint") == "page_number").alias("n_page_number"),
    )


def _signals(*names: Column | str) -> Column:
    return F.filter(F.array(*[F.lit(n) if isinstance(n, str) else n for n in names]), lambda x: x.isNotNull())


def own_roles(measured: DataFrame, profiles: DataFrame) -> DataFrame:
    """``measured`` with page_role, flow_scope and signals by the page alone."""
    by_page = Window.partitionBy("doc_id").orderBy("page")
    whole = Window.partitionBy("doc_id")
    m = layout.edge_rows(measured, ["doc_id"], "page").join(profiles.select("doc_id", "page").distinct().withColumn("has_profile", F.lit(True)), ["doc_id", "page"], "left")
    m = m.withColumns({
        "has_profile": F.coalesce("has_profile", F.lit(False)), "is_first": F.col("page") == F.min("page").over(whole), "is_last": F.col("page") == F.max("page").over(whole),
        "is_prelude": F.coalesce(F.col("page") < F.min(F.when(F.col("n_page_number") > 0, F.col("page"))).over(whole), F.lit(False)), "place": F.row_number().over(by_page),
    })
    c, first, last, early, late, prelude, profile = (F.col(x) for x in ("content_count", "is_first", "is_last", "is_first_edge", "is_last_edge", "is_prelude", "has_profile"))
    n_text, n_visual, text, visual, centred = (F.col(x) for x in ("text_count", "visual_count", "text_area_ratio", "visual_area_ratio", "centered_text_ratio"))
    said = F.when(profile, "body_profile").otherwise("no_body_profile")
    toc, note = F.col("n_toc_text") > 0, (c > 0) & (F.col("body_zone_footnote_count") / c >= 0.5)
    few, bare = n_text.between(1, 4), n_visual == 0
    candidate = (n_visual > 0) & ((visual >= DOMINANT) | ((n_text == 0) & (visual >= 0.1)) | ((n_visual >= 2) & (visual >= 0.45)) | ((text <= SPARSE_VISUAL_TEXT) & (visual >= 0.15)) | ((F.col("n_other") == 0) & (text <= ANNOTATED_VISUAL_TEXT) & (visual >= 0.15)))
    verifier = F.when((n_visual > 0) & (visual >= 0.25) & (visual < DOMINANT) & few & (text <= 0.18), "visual_verifier_candidate")
    outlier = F.when(F.col("tall_text_count") >= 2, "vertical_text_layout").when((n_text >= 8) & bare & (text <= 0.3) & (centred >= 0.8), "dense_centered_nonflow_layout")
    title = few & bare & (F.col("n_title_text") > 0) & (text <= SPARSE_TEXT) & (centred >= 0.5)
    leaf = few & bare & (text <= 0.02) & (centred >= 0.5)
    flow = (F.col("n_body_text") > 0) | (F.col("n_list_text") > 0) | (F.col("n_reference_text") > 0) | (F.col("n_footnote_text") > 0)
    edge = (early | late) & (n_text > 0) & bare & (text <= 0.45)
    seen = _signals(F.when(visual >= DOMINANT, "visual_dominant").otherwise("visual_sparse_text"), "no_body_profile", F.when(early, "early_page"), F.when(late, "late_page"))
    record = lambda role, scope, signals: F.struct(*[(F.lit(x) if isinstance(x, str) else x).alias(n) for x, n in ((role, "page_role"), (scope, "flow_scope"), (signals, "signals"))])
    r = (
        F.when(c == 0, record("blank_page", F.when(prelude | early, "front_matter").when(late, "back_matter").otherwise("body"), _signals("no_content_observations")))
        .when(prelude & toc, record("toc_page", "front_matter", _signals("unnumbered_prelude", "toc_hint", said))).when(prelude & note, record("note_section_candidate", "body", _signals("unnumbered_prelude", "note_section_hint", said)))
        .when(prelude & (n_visual > 0), record(F.when(first, "cover_page").otherwise("front_visual_page"), "front_matter", _signals("unnumbered_prelude", "visual_content", said)))
        .when(prelude & leaf, record("front_visual_page", "front_matter", _signals("unnumbered_prelude", "sparse_centered_front_text", said))).when(prelude & outlier.isNotNull(), record("front_visual_page", "front_matter", _signals("unnumbered_prelude", outlier, said)))
        .when(prelude, record("front_matter_page", "front_matter", _signals("unnumbered_prelude", "text_content", said)))
        .when(toc, record("toc_page", "front_matter", _signals("toc_hint"))).when(note, record("note_section_candidate", "body", _signals("note_section_hint")))
        .when(candidate, record(F.when(first, "cover_page").when(early, "front_visual_page").when(last, "back_cover_candidate").otherwise("visual_page"), F.when(first | early, "front_matter").when(last, "back_matter").otherwise("body"), seen))
        .when(last & ~first & (n_visual > 0), record("back_cover_candidate", "back_matter", _signals("last_page_visual_content", said)))
        .when(profile, record("text_flow_page", "body", _signals("body_profile", verifier)))
        .when(title, record("title_like_page", F.when(early, "front_matter").otherwise("body"), _signals(F.when(early, "early_page"), "sparse_centered_text", "no_body_profile")))
        .when(flow, record("text_flow_candidate", "body", _signals("text_flow_hint", "no_body_profile", verifier)))
        .when(edge, record("bibliographic_like_page", F.when(early, "front_matter").otherwise("back_matter"), _signals("text_without_body_profile", "edge_page"))).otherwise(record("unknown", "unknown", _signals("no_body_profile")))
    )
    return m.withColumn("_r", r).select("*", "_r.*").drop("_r")


def _led(signals: Column, name: str) -> Column:
    return F.when(F.array_contains(signals, name), signals).otherwise(F.concat(F.array(F.lit(name)), signals))


def book_roles(roles: DataFrame) -> DataFrame:
    """doc_id, page, page_role, flow_scope and signals after the book's own order is heard.

    Pages before the first body start after the contents are front matter; runs of at least four visual pages are
    visual; up to three pages between note pages are note pages up to the first that can't be one; scopes between the
    first and last body page are body.
    """
    whole, order = Window.partitionBy("doc_id"), Window.partitionBy("doc_id").orderBy("place")
    has_toc = F.col("n_toc_text") > 0
    r = roles.withColumn("_toc", F.min(F.when(has_toc, F.col("place"))).over(whole))
    start = (F.col("n_title_text") >= 2) & (F.col("n_body_text") > 0) & (F.col("place") > F.col("_toc"))
    r = r.withColumn("_start", F.min(F.when(start, F.col("place"))).over(whole))
    prefix = (F.col("place") < F.col("_start")) & (F.col("page_role") != "blank_page")
    to_toc, to_front = F.coalesce(prefix & has_toc, F.lit(False)), F.coalesce(prefix & ~has_toc & (F.col("flow_scope") == "body"), F.lit(False))
    r = r.withColumns({
        "signals": F.when(to_toc, F.array(F.lit("book_front_prefix"), F.lit("toc_hint"))).when(to_front, F.array(F.lit("book_front_prefix"), F.lit("before_body_anchor"))).otherwise(F.col("signals")),
        "page_role": F.when(to_toc, "toc_page").when(to_front, "front_matter_page").otherwise(F.col("page_role")), "flow_scope": F.when(to_toc | to_front, "front_matter").otherwise(F.col("flow_scope")),
    })
    seen = (F.col("visual_count") > 0) & (F.col("text_count") <= 8) & (F.col("visual_area_ratio") >= 0.15)
    r = layout.runs(r.withColumn("_seen", seen), ["doc_id"], ["place"], ["_seen"])
    long = F.col("_seen") & (F.count(F.lit(1)).over(Window.partitionBy("doc_id", "run")) >= LEAST_RUN) & (F.col("flow_scope") == "body") & ~F.col("page_role").isin("note_section_candidate", "blank_page")
    r = r.withColumn("_long", long)
    r = r.withColumns({"signals": F.when(F.col("_long"), _led(F.col("signals"), "visual_run")).otherwise(F.col("signals")), "page_role": F.when(F.col("_long"), "visual_page").otherwise(F.col("page_role"))})
    fillable = ((F.col("flow_scope") == "body") | (F.col("page_role") == "blank_page")) & ~F.col("page_role").isin(*BLOCKED_GAP_ROLES) & (F.col("visual_count") == 0) & (F.col("table_count") == 0)
    r = r.withColumns({"_note": F.col("page_role") == "note_section_candidate", "_ok": fillable})
    r = layout.fill_gaps(r, ["doc_id"], "place", "_note", "_ok", MOST_GAP)
    r = r.withColumns({
        "signals": F.when(F.col("filled"), _led(F.col("signals"), "note_cluster_gap")).otherwise(F.col("signals")), "page_role": F.when(F.col("filled"), "note_section_candidate").otherwise(F.col("page_role")),
        "flow_scope": F.when(F.col("filled"), "body").otherwise(F.col("flow_scope")),
    })
    body = F.when(F.col("flow_scope") == "body", F.col("place"))
    r = r.withColumn("_a", F.min(body).over(whole)).withColumn("_z", F.max(body).over(whole))
    inside = F.col("place").between(F.col("_a"), F.col("_z")) & F.col("flow_scope").isin("front_matter", "back_matter")
    moved = F.when((F.col("place") < F.col("_a")) & (F.col("flow_scope") == "back_matter"), "front_matter").when(inside, "body").when((F.col("place") > F.col("_z")) & (F.col("flow_scope") == "front_matter"), "back_matter")
    tail = F.when(F.array_contains("signals", "book_scope_continuity"), F.col("signals")).otherwise(F.concat("signals", F.array(F.lit("book_scope_continuity"))))
    r = r.withColumn("_moved", moved)
    role = F.when((F.col("_moved") == "body") & F.col("page_role").isin("back_cover_candidate", "cover_page", "front_visual_page"), "visual_page").otherwise(F.col("page_role"))
    return r.select("doc_id", "page", role.alias("page_role"), F.coalesce("_moved", "flow_scope").alias("flow_scope"), F.when(F.col("_moved").isNotNull(), tail).otherwise(F.col("signals")).alias("signals"))


def page_roles(observations: DataFrame, pages: DataFrame, profiles: DataFrame) -> DataFrame:
    """R14."""
    return book_roles(own_roles(metrics(observations, pages), profiles))


def terminal_reviews(observations: DataFrame, pages: DataFrame, window: int = 8) -> DataFrame:
    """(doc_id, page) among a document's last pages whose structure asks for a look: visual kinds, risky hints or text without pagination."""
    p = pages.select("doc_id", "page").withColumn("_back", F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("page")))).where(F.col("_back") <= window)
    hint = F.coalesce("role_hint", F.lit(""))
    o = observations.groupBy("doc_id", "page").agg(
        F.max(F.col("kind").isin(*VISUAL)).alias("visual"), F.max(F.col("kind").isin(*TEXT)).alias("text"), F.max(hint.isin("footer", "title_text", "unknown")).alias("risk"), F.max(hint.isin("header", "page_number")).alias("numbered"),
    )
    return p.join(o, ["doc_id", "page"]).where("visual OR risk OR (text AND NOT numbered)").select("doc_id", "page")


def follow_primary_tables(review: DataFrame, table_pages: DataFrame) -> DataFrame:
    """``review`` with pages that continue tables decided as the strongest of their primary pages.

    review: doc_id, page, page_role, action; table_pages: doc_id, page, primary_page. Of pages of equal action the first decides.
    """
    rank = F.array_position(F.array(*[F.lit(x) for x in ("needs_review", "exclude", "metadata_only", "include")]), F.col("action"))
    source = review.select("doc_id", F.col("page").alias("primary_page"), "page_role", "action")
    best = table_pages.select("doc_id", "page", "primary_page").distinct().join(source, ["doc_id", "primary_page"])
    best = best.groupBy("doc_id", "page").agg(F.max(F.struct(rank.alias("k"), (-F.col("primary_page")).alias("p"), "page_role", "action")).alias("b"))
    r = review.join(best, ["doc_id", "page"], "left")
    other = F.col("b").isNotNull() & (-F.col("b.p") != F.col("page"))
    take = lambda c: F.when(other, F.col(f"b.{c}")).otherwise(F.col(c)).alias(c)
    return r.select("doc_id", "page", take("page_role"), take("action"), F.when(other, -F.col("b.p")).alias("decided_by"))
