"""Contents entries: labels, levels, roles.

Entries: doc_id, entry_index, raw_title and, where known, role. Labels and levels
are expressions over an entry and one window over its document; null titles are
empty; entries that repeat an index stand side by side; empty tables stay empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import skeleton

# Labels of contents entries and titles of a book's matter.
_NUMBER = "一二三四五六七八九十百千万0-9"
LABELS = (("part", rf"第[{_NUMBER}]+部分"), ("chapter", rf"第[{_NUMBER}]+[章节]"), ("topic", r"专题\s*[0-9]+"), ("appendix_number", r"附录\s*[0-9]+"), ("appendix", "附录"), ("number", "[0-9]+|[IVXLCDM]+|[ivxlcdm]+"))
MATTER = ("前言", "序言", "引言", "致谢", "说明", "结论", "附录", "注释", "参考书目", "参考文献", "索引", "译后记", "出版后记", "扩展阅读", "大事年表")
_BODY = rf"^(?:第[{_NUMBER}]+(?:章节|部分|[章节部卷篇])|序章)|^[0-9]{{1,3}}\s+\S"


def labelled(entries: DataFrame) -> DataFrame:
    """``entries`` with label_kind, label, title and display_title."""
    raw = F.coalesce("raw_title", F.lit(""))
    kind, label, title = F.lit(None).cast("string"), F.lit(None).cast("string"), raw
    for name, pattern in reversed(LABELS):
        whole = rf"^({pattern})[{T.WHITE}]+(.+)$"
        hit = raw.rlike(whole)
        kind, title = F.when(hit, name).otherwise(kind), F.when(hit, T.strip(F.regexp_extract(raw, whole, 2))).otherwise(title)
        own = F.regexp_extract(raw, whole, 1)
        label = F.when(hit, F.when(own == "I", "1").otherwise(F.regexp_replace(own, rf"[{T.WHITE}]+", ""))).otherwise(label)
    return entries.withColumns({"label_kind": kind, "label": label, "title": title}).withColumn("display_title", F.concat_ws(" ", "label", "title"))


def is_matter_title(title: Column) -> Column:
    """Z11."""
    return T.strip(F.coalesce(title, F.lit(""))).rlike(f"^(?:{'|'.join(MATTER)})")


def is_body_title(title: Column) -> Column:
    """Z10."""
    return T.strip(F.coalesce(title, F.lit(""))).rlike(_BODY)


def levels(entries: DataFrame) -> DataFrame:
    """``level`` of labelled entries: parts 1, chapters 2 below parts, others by what came before."""
    order = Window.partitionBy("doc_id").orderBy("entry_index").rowsBetween(Window.unboundedPreceding, -1)
    is_ = lambda k: F.coalesce(F.col("label_kind") == k, F.lit(False))
    parts = F.max(is_("part")).over(Window.partitionBy("doc_id"))
    seen = F.coalesce(F.max(is_("chapter")).over(order), F.lit(False))
    own = F.when(is_("part"), 1).when(is_("chapter"), F.when(parts, 2).otherwise(1)).when(F.col("label_kind").isin("topic", "appendix_number", "appendix"), 1).when(F.col("label").isNotNull(), 2)
    return entries.withColumn("level", own.when(is_matter_title(F.col("title")), 1).when(seen, 2).otherwise(1))


def with_hierarchy(entries: DataFrame) -> DataFrame:
    """``parent_index`` too (W17), with the roles' guards.

    Unlabelled matter of the first level is no parent; entries that look like body text are body; unlabelled front and
    back matter, and matter titles, are of the first level without a parent.
    """
    alone = (F.col("level") == 1) & F.col("label").isNull() & is_matter_title(F.col("title"))
    h = skeleton.hierarchy(entries.withColumn("is_parent", ~alone)).drop("is_parent")
    body = is_body_title(F.col("label")) | is_body_title(F.col("display_title"))
    h = h.withColumn("role", F.when(body, "body").otherwise(F.col("role")))
    top = (F.col("label").isNull() & F.coalesce(F.col("role").isin("front_matter", "back_matter"), F.lit(False))) | is_matter_title(F.col("title"))
    return h.withColumn("level", F.when(top, 1).otherwise(F.col("level"))).withColumn("parent_index", F.when(~top, F.col("parent_index")))
