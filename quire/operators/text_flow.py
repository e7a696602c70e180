"""Text units from classified candidates: runs of a page, display runs by their outer gaps, chains over pages, units.

Candidates in reading order: doc_id, ord, page, observation_id, candidate_type, text,
role_hint, x0, y0, x1, y1 and what runs are keyed by. All steps are windows over a
document. Null boxes separate nothing; null texts add nothing to a unit; candidates
that repeat an ord are taken by observation_id; empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.operators import layout

RUN_KEYS = ["page", "candidate_type", "status", "lane", "layout_form", "alignment", "is_protected", "is_body"]


def same_page_runs(candidates: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``candidates`` with run, and the boxes of the rows before and after it."""
    order = Window.partitionBy("doc_id").orderBy("ord", "observation_id")
    box = F.struct("page", "y0", "y1")
    c = layout.runs(candidates, ["doc_id"], ["ord", "observation_id"], keys or RUN_KEYS)
    c = c.withColumn("_before", F.lag(box).over(order)).withColumn("_after", F.lead(box).over(order))
    run = Window.partitionBy("doc_id", "run").orderBy("ord", "observation_id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return c.withColumn("previous", F.first("_before").over(run)).withColumn("following", F.last("_after").over(run)).drop("_before", "_after")


def classify_runs(runs: DataFrame, threshold: Column) -> DataFrame:
    """``runs`` with separated_before, separated_after, signals and classified_type of body candidates.

    A run is apart from its neighbour if that is on another page or at least the display gap away; a run of
    which a member is a display by its own signals is one, and all its members with it. runs: with body_left, body_right, body_width.
    """
    whole = Window.partitionBy("doc_id", "run")
    order = whole.orderBy("ord", "observation_id")
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    top, foot = F.first("y0").over(every), F.last("y1").over(every)
    first_page, last_page = F.first("page").over(every), F.last("page").over(every)
    gap_before, gap_after = top - F.col("previous.y1"), F.col("following.y0") - foot
    away = lambda outside, page, gap: F.col(f"{outside}.page").isNull() | (F.col(f"{outside}.page") != page) | F.coalesce(gap >= threshold, F.lit(False))
    r = runs.withColumn("separated_before", away("previous", first_page, gap_before)).withColumn("separated_after", away("following", last_page, gap_after))
    r = r.withColumn("_i", F.row_number().over(order)).withColumn("_n", F.count(F.lit(1)).over(whole))
    own = layout.display_signals(*(F.col(c) for c in ("x0", "y0", "x1", "y1", "body_left", "body_right", "body_width")), None, F.col("separated_before") & (F.col("_i") == 1), F.col("separated_after") & (F.col("_i") == F.col("_n")))
    r = r.withColumn("signals", own)
    # Within a run the outer gaps are everybody's.
    alone = layout.is_display(F.col("signals"), F.col("separated_before"), F.col("separated_after"))
    r = r.withColumn("_display", F.coalesce(F.min(F.coalesce(alone, F.lit(False))).over(whole), F.lit(False)))
    added = F.when(F.col("_display") & ~layout.is_display(F.col("signals")), F.concat("signals", F.array(F.lit("set_off_run_outer_display_gap")))).otherwise(F.col("signals"))
    body = F.col("candidate_type") == "paragraph"
    kind = F.when(body & F.col("_display"), "display_block").otherwise(F.col("candidate_type"))
    return r.withColumn("signals", F.when(body, added)).withColumn("classified_type", kind).drop("_i", "_n", "_display")


def chains(runs: DataFrame) -> DataFrame:
    """(doc_id, chain, first_run, last_run, n_runs, is_display) of runs over page breaks that fit one another.

    runs: doc_id, run, fits_next (whether it goes on in the next run), separated_before, separated_after. A chain is a
    display if its first run is apart from what is before it and its last from what follows.
    """
    order = Window.partitionBy("doc_id").orderBy("run")
    starts = ~F.coalesce(F.lag("fits_next").over(order), F.lit(False))
    r = runs.withColumn("_starts", starts).withColumn("chain", F.sum(F.col("_starts").cast("int")).over(order))
    g = r.groupBy("doc_id", "chain").agg(F.min("run").alias("first_run"), F.max("run").alias("last_run"), F.count(F.lit(1)).alias("n_runs"), F.min_by("separated_before", "run").alias("a"), F.max_by("separated_after", "run").alias("b"))
    return g.where("n_runs > 1").select("doc_id", "chain", "first_run", "last_run", "n_runs", (F.col("a") & F.col("b")).alias("is_display"))


def units(classified: DataFrame) -> DataFrame:
    """doc_id, unit_id, unit_type, text, page, observation_ids, role_hints and box of homogeneous neighbours.

    Resolved displays of one run, form and alignment are one unit, as are resolved headings of one run of several;
    protected candidates stay alone. classified: with run_id, status, layout_form, alignment, is_protected.
    """
    order = Window.partitionBy("doc_id").orderBy("ord", "observation_id")
    size = F.count(F.lit(1)).over(Window.partitionBy("doc_id", "run_id"))
    c = classified.withColumn("_size", F.when(F.col("run_id").isNotNull(), size))
    same = lambda name: F.col(name) == F.lag(name).over(order)
    both = same("page") & same("run_id") & same("classified_type") & (F.col("status") == "resolved") & same("status") & ~F.col("is_protected") & ~F.lag("is_protected").over(order)
    display = (F.col("classified_type") == "display_block") & same("layout_form") & same("alignment")
    joins = F.coalesce(both & (display | ((F.col("classified_type") == "heading") & (F.col("_size") > 1))), F.lit(False))
    c = c.withColumn("_new", F.when(joins, 0).otherwise(1)).withColumn("_unit", F.sum("_new").over(order))
    row = F.sort_array(F.collect_list(F.struct("ord", "observation_id", "text", "role_hint")))
    g = c.groupBy("doc_id", "_unit").agg(F.first("classified_type").alias("unit_type"), F.first("page").alias("page"), row.alias("rows"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))
    said = F.filter(F.transform("rows", lambda r: r["text"]), lambda x: F.coalesce(x != "", F.lit(False)))
    return g.select(
        "doc_id", F.format_string("tu%06d", F.col("_unit").cast("int")).alias("unit_id"), "unit_type", F.array_join(said, "\n").alias("text"), "page",
        F.transform("rows", lambda r: r["observation_id"]).alias("observation_ids"), F.array_distinct(F.transform("rows", lambda r: F.coalesce(r["role_hint"], F.lit("")))).alias("role_hints"), F.array("x0", "y0", "x1", "y1").alias("bbox"),
    )
