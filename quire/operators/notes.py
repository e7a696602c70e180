"""Notes: resolving references, scopes, numbering and audits.

References: doc_id, ref_id, node_id, page, ord, marker; notes: doc_id, note_id, page, marker, scope, scope_key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import note_marker


def with_page_notes(refs: DataFrame, notes: DataFrame) -> DataFrame:
    """References with the first and last note of their page and marker, _note and _last; _mark is the marker as compared.

    Notes are aggregated by key first, so that repeated markers make no pairs.
    """
    keys = ["doc_id", "page", "_mark"]
    by = notes.withColumn("_mark", note_marker(F.col("marker"))).groupBy(*keys).agg(F.min("note_id").alias("_note"), F.max("note_id").alias("_last"))
    return refs.withColumn("_mark", note_marker(F.col("marker"))).join(by, keys, "left")


def resolve_on_page(refs: DataFrame, notes: DataFrame) -> DataFrame:
    """``status`` of every reference by (page, marker), and its note if exactly one matches."""
    r = with_page_notes(refs, notes)
    one = F.col("_note") == F.col("_last")
    status = F.when(F.col("_note").isNull(), "unresolved").when(one, "resolved").otherwise("ambiguous")
    return r.select("doc_id", "ref_id", "page", F.col("_mark").alias("marker"), status.alias("status"), F.when(one, F.col("_note")).alias("note_id"))


def scopes(blocks: DataFrame) -> DataFrame:
    """``scope_key``: that of the last heading so far."""
    w = Window.partitionBy("doc_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, 0)
    return blocks.withColumn("scope_key", F.last(F.when(F.col("type") == "heading", F.col("key")), ignorenulls=True).over(w))


def with_scoped_notes(refs: DataFrame, notes: DataFrame) -> DataFrame:
    """References with the first and last note of their chapter and marker, of the book where the chapter has none, _lo and _hi."""
    agg = [F.min("note_id").alias("lo"), F.max("note_id").alias("hi")]
    near = notes.where("scope = 'chapter'").groupBy("doc_id", "scope_key", "marker").agg(*agg)
    wide = notes.where("scope = 'book'").groupBy("doc_id", "marker").agg(F.min("note_id").alias("blo"), F.max("note_id").alias("bhi"))
    r = refs.join(near, ["doc_id", "scope_key", "marker"], "left").join(wide, ["doc_id", "marker"], "left")
    return r.withColumn("_lo", F.coalesce("lo", "blo")).withColumn("_hi", F.when(F.col("lo").isNotNull(), F.col("hi")).otherwise(F.col("bhi"))).drop("lo", "hi", "blo", "bhi")


def resolve_scoped(refs: DataFrame, notes: DataFrame) -> DataFrame:
    """By (scope_key, marker) among chapter notes; book notes only where the chapter has none."""
    lo, hi = F.col("_lo"), F.col("_hi")
    status = F.when(lo.isNull(), "unresolved").when(lo == hi, "resolved").otherwise("ambiguous")
    return with_scoped_notes(refs, notes).select("doc_id", "ref_id", "scope_key", "marker", status.alias("status"), F.when(lo == hi, lo).alias("note_id"))


def orphans(notes: DataFrame, resolved: DataFrame) -> DataFrame:
    """Notes that no reference leads to."""
    return notes.join(resolved.select("doc_id", "note_id"), ["doc_id", "note_id"], "left_anti")


def audit(resolved: DataFrame) -> DataFrame:
    """Counts per document and status."""
    return resolved.groupBy("doc_id").agg(*(F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("resolved", "ambiguous", "unresolved")))


def renumber(refs: DataFrame) -> DataFrame:
    """``number``: notes of a chapter in order of their first reference."""
    first = F.min("ord").over(Window.partitionBy("doc_id", "chapter", "note_id"))
    return refs.withColumn("_first", first).withColumn("number", F.dense_rank().over(Window.partitionBy("doc_id", "chapter").orderBy("_first"))).drop("_first")


def visible_repeats(notes: DataFrame) -> DataFrame:
    """Notes whose text repeats the one before, compared without white space."""
    compact = F.regexp_replace("text", r"\s+", "")
    w = Window.partitionBy("doc_id").orderBy("ord")
    return notes.withColumn("_c", compact).withColumn("is_repeat", F.coalesce(F.col("_c") == F.lag("_c").over(w), F.lit(False))).drop("_c")
