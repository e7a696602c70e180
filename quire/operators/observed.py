"""Observations of a document and what is read off them (A13, A21, C15, J12 in part, O2, O4, P1, P2, P5, P12, S26, S27, U7, Z3-Z5, Z7).

Raw blocks: doc_id, page, index, raw_type, text, x0, y0, x1, y1. Null texts are empty,
null boxes no boxes; rows of equal place are taken by id; empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as t

from quire.functions import text as T
from quire.operators import raw_layout as R

#: Rows of the document model.
BLOCK = t.StructType([t.StructField(n, k) for n, k in (("doc_id", t.StringType()), ("ord", t.LongType()), ("block_id", t.StringType()), ("type", t.StringType()), ("text", t.StringType()), ("level", t.IntegerType()), ("page", t.IntegerType()), ("bbox", t.ArrayType(t.DoubleType())))])
ENTRY = t.StructType([t.StructField(n, k) for n, k in (("doc_id", t.StringType()), ("entry_index", t.LongType()), ("title", t.StringType()), ("level", t.IntegerType()), ("page_hint", t.StringType()), ("target_page_label", t.StringType()), ("block_id", t.StringType()), ("parent_index", t.LongType()))])


def observe(raw: DataFrame, titles: DataFrame) -> DataFrame:
    """Observations of raw blocks in order, then the titles that only the middle file has, ids dense.

    titles: doc_id, page, index, text and box. A title is there already if the page has an observation of the same text
    and box, or a title of the same text without white space; of equal new ones the first stays.
    """
    corners = [c for c in ("x0", "y0", "x1", "y1")]
    front = F.col("page") <= F.greatest(F.lit(4), F.bround(F.max("page").over(Window.partitionBy("doc_id")) * F.lit(0.05)))
    own = raw.select("doc_id", "page", "index", R.observation_kind(F.col("raw_type")).alias("kind"), R.role_hint(F.col("raw_type"), front).alias("role_hint"), F.coalesce("text", F.lit("")).alias("text"), *corners, F.lit(0).alias("_late"))
    key = F.regexp_replace(F.coalesce("text", F.lit("")), rf"[{T.WHITE}]+", "")
    known = own.where("role_hint = 'title_text'").select("doc_id", "page", key.alias("_key")).distinct()
    same = own.select("doc_id", "page", F.col("text").alias("_text"), F.struct(*corners).alias("_box")).distinct()
    new = titles.where("coalesce(text, '') <> ''").withColumn("_key", key).withColumn("_text", F.col("text")).withColumn("_box", F.struct(*corners))
    new = new.join(known, ["doc_id", "page", "_key"], "left_anti")
    new = new.join(same.withColumnRenamed("_box", "_other").withColumnRenamed("_text", "_t"), (new["doc_id"] == same["doc_id"]) & (new["page"] == same["page"]) & (F.col("_text") == F.col("_t")) & F.col("_box").eqNullSafe(F.col("_other")), "left_anti")
    first = F.row_number().over(Window.partitionBy("doc_id", "page", "_key").orderBy("index"))
    new = new.withColumn("_first", first).where("_first = 1").select("doc_id", "page", "index", F.lit("text_region").alias("kind"), F.lit("title_text").alias("role_hint"), "text", *corners, F.lit(1).alias("_late"))
    n = F.row_number().over(Window.partitionBy("doc_id").orderBy("_late", "page", "index"))
    return own.union(new).withColumn("observation_id", F.format_string("obs%06d", n)).drop("_late")


def protected_order(observations: DataFrame) -> DataFrame:
    """``place`` in the document: page, reading order, top, left, id; neighbouring titles of one page and order with protected ones first (O2).

    observations: reading_order, is_protected.
    """
    far = lambda c: F.coalesce(F.col(c), F.lit(float("inf")))
    order = F.coalesce("reading_order", F.lit(999_999))
    w = Window.partitionBy("doc_id").orderBy("page", "_order", far("y0"), far("x0"), "observation_id")
    o = observations.withColumn("_order", order)
    title = F.col("role_hint") == "title_text"
    o = o.withColumn("_i", F.row_number().over(w)).withColumn("_title", F.coalesce(title, F.lit(False)))
    slot = F.struct("page", "_order", "_title")
    o = o.withColumn("_slot", slot).withColumn("_new", F.when(F.coalesce(F.lag("_slot").over(w) == F.col("_slot"), F.lit(False)) & F.col("_title"), 0).otherwise(1)).withColumn("_run", F.sum("_new").over(w))
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy("_run", F.when(F.col("_title") & F.col("is_protected"), 0).otherwise(1), "_i"))
    return o.withColumn("place", place).drop("_order", "_i", "_title", "_slot", "_new", "_run")


def page_texts(observations: DataFrame) -> DataFrame:
    """doc_id, page, text, title_text, has_toc and counts of hints: what pages are found and judged by."""
    text = F.col("kind").isin("text_region", "footnote_region") & (T.strip(F.coalesce("text", F.lit(""))) != "")
    row = lambda cond: F.transform(F.sort_array(F.collect_list(F.when(cond, F.struct("place", T.strip(F.col("text")).alias("t"))))), lambda r: r["t"])
    hint = F.coalesce("role_hint", F.lit(""))
    return observations.groupBy("doc_id", "page").agg(
        F.array_join(row(text), "\n").alias("text"), F.array_join(row(text & (hint == "title_text")), "\n").alias("title_text"), F.max((hint == "toc_text") & F.col("kind").isin("text_region", "footnote_region")).alias("has_toc"),
        *[F.count_if(hint == h).alias(f"n_{h}") for h in ("title_text", "body_text")],
    )


def exact_titles(entries: DataFrame, observations: DataFrame, toc_pages: DataFrame) -> DataFrame:
    """(doc_id, entry_index, pages): pages off the contents with a title that is just an entry's, by key, in order.

    Keys are joined, so no entry meets a page that doesn't name it. Titles that only contain an entry's aren't found.
    """
    titles = observations.where("role_hint = 'title_text'").select("doc_id", "page", T.title_key(F.coalesce("text", F.lit(""))).alias("key")).where("key <> ''").distinct()
    titles = titles.join(toc_pages.select("doc_id", "page"), ["doc_id", "page"], "left_anti")
    e = entries.select("doc_id", "entry_index", F.explode(F.array_distinct(F.array(T.title_key(F.coalesce("display_title", F.lit(""))), T.title_key(F.coalesce("title", F.lit("")))))).alias("key")).where("key <> ''")
    return e.join(titles, ["doc_id", "key"]).groupBy("doc_id", "entry_index").agg(F.array_sort(F.collect_set("page")).alias("pages"))


def contents_of_blocks(blocks: DataFrame) -> DataFrame:
    """Contents entries of ``toc_item`` blocks in order (P12): doc_id, entry_index, title, level, target_page_label, block_id."""
    b = blocks.where("type = 'toc_item'")
    n = F.row_number().over(Window.partitionBy("doc_id").orderBy("ord")) - 1
    return b.select("doc_id", n.cast("long").alias("entry_index"), F.coalesce("toc_title", "text").alias("title"), F.coalesce("level", F.lit(1)).alias("level"), "target_page_label", "block_id")


def blocks_by_page(blocks: DataFrame) -> DataFrame:
    """doc_id, page and the ids of its blocks in order, by ``pages`` or else ``page``."""
    pages = F.coalesce("pages", F.when(F.col("page").isNotNull(), F.array("page")), F.array().cast("array<bigint>"))
    b = blocks.where("block_id IS NOT NULL").select("doc_id", "ord", "block_id", F.explode(pages).alias("page")).where("page IS NOT NULL")
    return b.groupBy("doc_id", "page").agg(F.transform(F.sort_array(F.collect_list(F.struct("ord", "block_id"))), lambda r: r["block_id"]).alias("block_ids"))


def reference_key(marker: Column, source: Column, page: Column) -> Column:
    """What makes two note references the same."""
    return F.struct(F.coalesce(marker, F.lit("")).alias("marker"), F.coalesce(source, F.lit("")).alias("source"), page.alias("page"))


def table_attributes(observations: DataFrame, parsed: DataFrame) -> DataFrame:
    """Table observations with html and is_continuation filled in from the parser's rows where they have none."""
    p = parsed.select("doc_id", "page", "index", F.col("html").alias("_html"))
    o = observations.where("kind = 'table_region'").join(p, ["doc_id", "page", "index"], "left").withColumn("html", F.coalesce("html", "_html", F.lit("")))
    return o.withColumn("is_continuation", T.strip(F.col("html")) == "").drop("_html")


def contents_audit(entries: DataFrame) -> DataFrame:
    """Entries by role, located and not, per document."""
    role = F.coalesce("role", F.lit(""))
    return entries.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_entries"), F.count("start_page").alias("n_located"), F.count_if(F.col("start_page").isNull()).alias("n_unlocated"), *[F.count_if(role == r).alias(f"n_{r}") for r in ("front_matter", "body", "back_matter")])
