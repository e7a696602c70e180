"""Page layout: metrics, body lanes, gaps, runs and neighbouring pages.

Observations: doc_id, page, kind, x0, y0, x1, y1; pages: doc_id, page, width, height.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Thresholds of the layout model.
MIN_REFERENCES, DOMINANT_RATIO, SPREAD = 2, 0.7, 1.5
MIN_WIDTH_RATIO, MAX_WIDTH_RATIO = 0.2, 0.92


def page_metrics(observations: DataFrame, pages: DataFrame) -> DataFrame:
    """Counts by kind and the share of the page that images and text cover (A3, A4)."""
    a = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    of = lambda k: F.when(F.col("kind") == k, a).otherwise(0.0)
    g = observations.groupBy("doc_id", "page").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("kind") == "text_region").alias("n_text"), F.count_if(F.col("kind") == "image_region").alias("n_image"),
        F.sum(of("text_region")).alias("text_area"), F.sum(of("image_region")).alias("image_area"),
        F.count_if(F.col("y1") - F.col("y0") >= 80).alias("n_tall"),
    )
    size = F.col("width") * F.col("height")
    return pages.join(g, ["doc_id", "page"]).select("doc_id", "page", "n", "n_text", "n_image", "n_tall", (F.col("text_area") / size).alias("text_ratio"), (F.col("image_area") / size).alias("image_ratio"))


def page_profiles(observations: DataFrame, pages: DataFrame) -> DataFrame:
    """Each page's body lane from its dominant boxes, or why it has none."""
    w = F.col("x1") - F.col("x0")
    per_page = Window.partitionBy("doc_id", "page")
    o = observations.where(w > 0).withColumn("_w", w).withColumn("_all", F.count(F.lit(1)).over(per_page)).withColumn("_max", F.max(w).over(per_page))
    o = o.withColumn("_dominant", (F.col("_all") >= MIN_REFERENCES) & (F.col("_w") >= F.col("_max") * DOMINANT_RATIO))
    d = lambda c: F.when(F.col("_dominant"), F.col(c))
    p = o.groupBy("doc_id", "page").agg(F.count(d("_w")).alias("n"), F.median(d("x0")).alias("body_left"), F.median(d("x1")).alias("body_right"), F.median(d("_w")).alias("body_width"), (F.max(d("_w")) / F.min(d("_w"))).alias("_spread"))
    p = pages.join(p, ["doc_id", "page"], "left")
    ratio = F.col("body_width") / F.col("width")
    reason = F.when(F.coalesce("n", F.lit(0)) < MIN_REFERENCES, "needs_fallback").when(F.col("_spread") > SPREAD, "unstable_widths").when((F.col("width") > 0) & ((ratio < MIN_WIDTH_RATIO) | (ratio > MAX_WIDTH_RATIO)), "extreme_body_width").otherwise("")
    lane = lambda c: F.when(F.col("reason") == "", F.col(c)).alias(c)
    return p.withColumn("reason", reason).select("doc_id", "page", "reason", lane("body_left"), lane("body_right"), lane("body_width"))


def nearest_profile(profiles: DataFrame) -> DataFrame:
    """For each page the nearest one that has a lane, the lower in a tie (J10): doc_id, page, profile_page."""
    has = F.when(F.col("reason") == "", F.col("page"))
    order = Window.partitionBy("doc_id").orderBy("page")
    low = F.last(has, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    high = F.first(has, ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing))
    p = profiles.select("doc_id", "page", low.alias("_low"), high.alias("_high"))
    nearer = F.when(F.col("_high").isNull() | (F.col("page") - F.col("_low") <= F.col("_high") - F.col("page")), F.coalesce("_low", "_high")).otherwise(F.col("_high"))
    return p.select("doc_id", "page", nearer.alias("profile_page"))


def normal_gaps(observations: DataFrame) -> DataFrame:
    """Median normal gap, display gap and line height of each document."""
    order = Window.partitionBy("doc_id", "page").orderBy("y0", "x0", "ord")
    g = observations.select("doc_id", (F.col("y1") - F.col("y0")).alias("h"), (F.col("y0") - F.lag("y1").over(order)).alias("gap"), F.lag(F.col("y1") - F.col("y0")).over(order).alias("before"))
    g = g.withColumn("near", F.when((F.col("gap") >= 0) & (F.col("gap") <= F.greatest(F.lit(12.0), F.col("before") * 0.45)), F.col("gap")))
    doc = Window.partitionBy("doc_id")
    g = g.withColumn("anchor", F.min(F.when(F.col("near") > 0, F.col("near"))).over(doc))
    g = g.withColumn("normal", F.when(F.col("anchor").isNull() | (F.col("near") <= F.greatest(F.col("anchor") * 1.8, F.col("anchor") + 4)), F.col("near")))
    m = g.groupBy("doc_id").agg(F.median("normal").alias("normal_gap"), F.median("h").alias("line_height"))
    wide = F.when(F.col("gap") >= F.greatest(F.col("normal_gap") * 2.5, F.col("normal_gap") + 18), F.col("gap"))
    return g.join(m, "doc_id").groupBy("doc_id").agg(F.first("normal_gap").alias("normal_gap"), F.first("line_height").alias("line_height"), F.median(wide).alias("display_gap"))


def display_gap_threshold(normal_gap: Column, line_height: Column) -> Column:
    """C27."""
    return F.coalesce(F.greatest(normal_gap * 2.5, normal_gap + 18), F.greatest(F.lit(24.0), line_height * 0.45), F.lit(24.0))


def display_signals(x0: Column, y0: Column, x1: Column, y1: Column, left: Column, right: Column, lane: Column, indent: Column | None = None, gap_before: Column | None = None, gap_after: Column | None = None) -> Column:
    """Names of what sets a box off its body lane.

    ``indent`` is the book's indent unit, by default or where null or 0 the larger of 24 and 4 % of the lane; the gaps say
    whether a display gap lies before or after.
    """
    w, li, ri = x1 - x0, x0 - left, right - x1
    default = F.greatest(F.lit(24.0), lane * 0.04)
    unit = default if indent is None else F.when(indent > 0, indent).otherwise(default)
    inset = (li >= lane * 0.12) & (ri >= lane * 0.08)
    set_off = (w <= lane * 0.96) & (li >= lane * 0.05) & (ri >= lane * -0.03)
    tall = (w >= lane * 0.94) & (w <= lane * 0.98) & (li >= F.greatest(F.lit(24.0), lane * 0.03)) & (ri >= lane * -0.03) & (y1 - y0 >= 80)
    second = F.when(inset, "inset_from_body_lane").when(set_off, "left_inset_set_off_text").when(tall, "slightly_inset_tall_block")
    indented = (w <= lane - unit * 0.5) & (li >= F.greatest(F.lit(12.0), unit * 0.85)) & (ri >= -unit)
    attribution = (F.abs(x1 - right) <= F.greatest(F.lit(24.0), unit * 1.5)) & (w <= lane * 0.55) & (x0 >= left + lane * 0.4)
    on = lambda c, name: F.when(F.lit(False) if c is None else c, name)
    every = (F.when(w <= lane * 0.72, "narrower_than_body_lane"), second, on(indented, "book_indent_set_off_text"), on(attribution, "right_aligned_attribution"), on(gap_before, "display_gap_before"), on(gap_after, "display_gap_after"))
    return F.filter(F.array(*every), lambda s: s.isNotNull())


def is_display(signals: Column, gap_before: Column | None = None, gap_after: Column | None = None) -> Column:
    """F6; gaps are read from the signals where they aren't given."""
    has = lambda s: F.array_contains(signals, s)
    before = has("display_gap_before") if gap_before is None else gap_before
    after = has("display_gap_after") if gap_after is None else gap_after
    strong = has("narrower_than_body_lane") & has("inset_from_body_lane")
    prose = has("left_inset_set_off_text") | has("slightly_inset_tall_block") | has("book_indent_set_off_text")
    return ((strong | has("right_aligned_attribution")) & (before | after)) | (prose & before & after)


def runs(rows: DataFrame, keys: list[str], order: list[str], same: list[str]) -> DataFrame:
    """Gaps and islands: ``run`` numbers from 1 the stretches in which the columns ``same`` don't change."""
    w = Window.partitionBy(*keys).orderBy(*order)
    changed = F.when(F.row_number().over(w) == 1, 1)
    for c in same:
        changed = changed.when(~F.col(c).eqNullSafe(F.lag(c).over(w)), 1)
    return rows.withColumn("_new", changed.otherwise(0)).withColumn("run", F.sum("_new").over(w)).drop("_new")


def flagged_runs(rows: DataFrame, keys: list[str], order: str, flag: str, least: int) -> DataFrame:
    """(keys, first, last, n) of the runs of at least ``least`` rows that have the flag."""
    r = runs(rows, keys, [order], [flag]).where(F.col(flag))
    return r.groupBy(*keys, "run").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).drop("run")


def fill_gaps(rows: DataFrame, keys: list[str], order: str, flag: str, fillable: str, most: int = 3) -> DataFrame:
    """``filled``: whether a row lies in a gap of at most ``most`` rows between flagged ones, with only fillable rows before it there."""
    w = Window.partitionBy(*keys).orderBy(order)
    r = rows.withColumn("_i", F.row_number().over(w))
    at = F.when(F.col(flag), F.col("_i"))
    r = r.withColumn("_p", F.last(at, ignorenulls=True).over(w)).withColumn("_n", F.first(at, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)))
    stop = F.max(F.when(~F.col(flag) & ~F.col(fillable), 1).otherwise(0)).over(Window.partitionBy(*keys, "_p").orderBy(order))
    inside = ~F.col(flag) & F.col("_p").isNotNull() & F.col("_n").isNotNull() & (F.col("_n") - F.col("_p") - 1 <= most)
    return r.withColumn("filled", inside & (stop == 0)).drop("_i", "_p", "_n")


def edge_rows(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """``is_first_edge`` and ``is_last_edge``: among the first or last min(24, max(4, 5 %)) rows."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    edge = F.least(F.lit(24), F.greatest(F.lit(4), F.bround(n * F.lit(0.05)).cast("int")))
    up, down = (F.row_number().over(Window.partitionBy(*keys).orderBy(o)) for o in (F.asc(order), F.desc(order)))
    return rows.select("*", (up <= edge).alias("is_first_edge"), (down <= edge).alias("is_last_edge"))


def element_at_share(values: Column, share: float) -> Column:
    """Aggregate: the element at min(n - 1, int(n * share)) of the sorted values."""
    v = F.sort_array(F.collect_list(values))
    return F.get(v, F.least(F.size(v) - 1, F.floor(F.size(v) * F.lit(share)).cast("int")))
