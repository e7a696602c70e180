"""Logical tables over pages and the pages' review."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def table_runs(rows: DataFrame) -> DataFrame:
    """``table_no`` and ``is_primary``: a row with html starts a table, blank rows on the next page continue it.

    rows: doc_id, page, ord, html. A blank row after a gap, or before any table, is an orphan with a null number.
    """
    w = Window.partitionBy("doc_id").orderBy("page", "ord")
    has = F.coalesce(F.length(F.trim("html")), F.lit(0)) > 0
    r = rows.withColumn("is_primary", has).withColumn("_step", F.col("page") - F.lag("page").over(w))
    r = r.withColumn("_break", F.when(has, 1).when(F.col("_step").isNull() | (F.col("_step") != 1), 1).otherwise(0)).withColumn("_run", F.sum("_break").over(w))
    r = r.withColumn("_started", F.max(F.col("is_primary").cast("int")).over(Window.partitionBy("doc_id", "_run")))
    number = F.sum(F.col("is_primary").cast("int")).over(w)
    return r.select("doc_id", "page", "ord", "is_primary", F.when(F.col("_started") == 1, number).alias("table_no"))


def partition(tables: DataFrame, review: DataFrame) -> DataFrame:
    """``status`` of each table (doc_id, table_no, page rows): admitted, excluded or unresolved by its pages' review."""
    r = review.select("doc_id", "page", (F.col("action") == "include").alias("ok"))
    t = tables.where("table_no IS NOT NULL").join(r, ["doc_id", "page"], "left").groupBy("doc_id", "table_no").agg(F.count(F.lit(1)).alias("n_pages"), F.count_if(F.coalesce("ok", F.lit(False))).alias("n_included"))
    status = F.when(F.col("n_included") == F.col("n_pages"), "admitted").when(F.col("n_included") == 0, "excluded").otherwise("unresolved")
    return t.select("doc_id", "table_no", "n_pages", "n_included", status.alias("status"))


def captions(tables: DataFrame, observations: DataFrame) -> DataFrame:
    """Tables with their caption ids in order."""
    c = observations.where("role_hint = 'caption'").groupBy("doc_id", F.col("parent_id").alias("observation_id")).agg(F.sort_array(F.collect_list(F.struct("ord", "caption_id"))).alias("c"))
    t = tables.join(c, ["doc_id", "observation_id"], "left")
    return t.withColumn("caption_ids", F.coalesce(F.transform("c", lambda x: x["caption_id"]), F.array().cast("array<string>"))).drop("c")


def strongest_action(rows: DataFrame, priority: tuple[str, ...] = ("exclude", "metadata_only", "needs_review", "include")) -> DataFrame:
    """One action per (doc_id, page): the last of ``priority`` that a row has."""
    rank = F.array_position(F.array(*[F.lit(p) for p in priority]), F.col("action"))
    return rows.groupBy("doc_id", "page").agg(F.max_by("action", rank).alias("action"))


def table_flow(observations: DataFrame, captions: DataFrame, review: DataFrame) -> DataFrame:
    """Every run of table observations with its fate: doc_id, first_ord, status, reason, table_id, pages, observation_ids, caption_ids, html.

    observations: doc_id, ord (their order), page, observation_id, html (null: no content that was read; blank: goes on);
    captions: doc_id, parent_id, observation_id, ord; review: doc_id, page, action. A run is a table and the blank ones
    on the pages right after it. Tables with all pages included are admitted and numbered, with none excluded, else
    unresolved; what isn't part of a table is excluded with its page, else unresolved.
    """
    order = Window.partitionBy("doc_id").orderBy("ord", "observation_id")
    has = F.length(F.trim("html")) > 0
    o = observations.withColumn("_has", F.coalesce(has, F.lit(False))).withColumn("_none", F.col("html").isNull())
    apart = F.col("_has") | F.col("_none") | F.coalesce(F.lag("_none").over(order), F.lit(True)) | (F.coalesce(F.col("page") - F.lag("page").over(order), F.lit(0)) != 1)
    o = o.withColumn("_run", F.sum(apart.cast("int")).over(order))
    # Blank ones without a table at the start of their run are runs of one.
    run = Window.partitionBy("doc_id", "_run")
    o = o.withColumn("_table", F.max("_has").over(run)).withColumn("_alone", F.when(F.col("_table"), F.lit(0)).otherwise(F.row_number().over(run.orderBy("ord", "observation_id"))))
    inside = review.where("action = 'include'").select("doc_id", "page").distinct().withColumn("_in", F.lit(True))
    o = o.join(inside, ["doc_id", "page"], "left")
    own = captions.groupBy("doc_id", F.col("parent_id").alias("observation_id")).agg(F.transform(F.sort_array(F.collect_list(F.struct("ord", "observation_id"))), lambda r: r["observation_id"]).alias("_captions"))
    o = o.join(own, ["doc_id", "observation_id"], "left")
    row = F.sort_array(F.collect_list(F.struct("ord", "observation_id", "page", F.coalesce("html", F.lit("")).alias("html"), F.coalesce("_captions", F.array().cast("array<string>")).alias("captions"))))
    g = o.groupBy("doc_id", "_run", "_alone").agg(F.min("ord").alias("first_ord"), F.first("_table").alias("_table"), F.first("_none").alias("_none"), F.count(F.lit(1)).alias("_n"), F.count("_in").alias("_included"), row.alias("r"))
    status = F.when(F.col("_included") == 0, "excluded").when(F.col("_table") & (F.col("_included") == F.col("_n")), "admitted").otherwise("unresolved")
    why = F.when(status == "excluded", "excluded_by_page_review").when(F.col("_none"), "missing_normalized_table_content").when(~F.col("_table"), "continuation_without_primary").when(status == "unresolved", "page_review_splits_table_candidate")
    g = g.withColumn("status", status).withColumn("reason", why)
    number = F.row_number().over(Window.partitionBy("doc_id", "status").orderBy("first_ord"))
    part = lambda c: F.transform("r", lambda x: x[c])
    return g.select("doc_id", "first_ord", "status", "reason", F.when(F.col("status") == "admitted", F.format_string("tbl%06d", number)).alias("table_id"), F.array_distinct(part("page")).alias("pages"), part("observation_id").alias("observation_ids"), F.array_distinct(F.flatten(part("captions"))).alias("caption_ids"), F.col("r")[0]["html"].alias("html"))
