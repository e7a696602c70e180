"""JSON and JSONL sources and sinks, parser output, and the check of the document store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as t

from quire.functions import text as T

#: Parser rows: pages are lists of typed items.
ITEM = "struct<type: string, sub_type: string, text: string, bbox: array<double>>"
#: Blocks of the parser's middle file and its pages.
BLOCK = "type: string, index: int, bbox: array<double>, lines: array<struct<spans: array<struct<type: string, content: string>>>>"
MIDDLE = f"array<struct<page_idx: int, page_size: array<double>, discarded_blocks: array<struct<{BLOCK}>>, para_blocks: array<struct<{BLOCK}, sub_type: string, blocks: array<struct<{BLOCK}>>>>>>"


def read_json(spark: SparkSession, path: str, schema: str | t.StructType) -> DataFrame:
    """One JSON value a file, with an explicit schema; broken files raise."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_jsonl(spark: SparkSession, path: str, schema: str | t.StructType) -> DataFrame:
    """One JSON object a line; blank lines are skipped."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_jsonl(df: DataFrame, path: str) -> int:
    """Write rows as JSON lines and return their number, counted as they are written."""
    from pyspark.sql import Observation

    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").json(path)
    return seen.get["n"]


def migrate(documents: DataFrame) -> DataFrame:
    """Documents without a schema version are of the first one; unknown versions are violations, not rows."""
    return documents.withColumn("schema_version", F.coalesce("schema_version", F.lit("1.0")))


def flatten_pages(documents: DataFrame) -> DataFrame:
    """doc_id, page and index from 1, and the item's fields, of page lists (S6): doc_id, pages array<array<ITEM>>."""
    p = documents.select("doc_id", F.posexplode("pages").alias("page", "items"))
    i = p.select("doc_id", (F.col("page") + 1).alias("page"), F.posexplode("items").alias("index", "item"))
    return i.select("doc_id", "page", (F.col("index") + 1).alias("index"), "item.*")


def flatten_legacy(items: DataFrame) -> DataFrame:
    """The same from a flat list with page_idx (S7): doc_id, ord, page_idx and fields."""
    n = F.row_number().over(Window.partitionBy("doc_id", "page_idx").orderBy("ord"))
    return items.withColumn("index", n).withColumn("page", F.col("page_idx") + 1).drop("page_idx")


def page_sizes(middle: DataFrame) -> DataFrame:
    """doc_id, page, width, height from pdf_info array<struct<page_idx, page_size array<double>>>."""
    m = middle.select("doc_id", F.explode("pdf_info").alias("p"))
    return m.select("doc_id", (F.col("p.page_idx") + 1).alias("page"), F.col("p.page_size")[0].alias("width"), F.col("p.page_size")[1].alias("height"))


def coordinate_space(items: DataFrame) -> DataFrame:
    """doc_id, page, width, height of the space that boxes are in."""
    m = items.groupBy("doc_id", "page").agg(F.max(F.col("bbox")[2]).alias("x"), F.max(F.col("bbox")[3]).alias("y"))
    big = (F.col("x") > 650) | (F.col("y") > 750)
    return m.select("doc_id", "page", F.when(big, 1000.0).otherwise(425.0).alias("width"), F.when(big, 1000.0).otherwise(680.0).alias("height"))


def content_page_sizes(items: DataFrame, sizes: DataFrame) -> DataFrame:
    """doc_id, page, width, height of the boxes' space: 1000 x 1000 if a document's medians say so, else the page's own size."""
    far = lambda i: F.greatest(F.coalesce(F.max(F.col("bbox")[i]), F.lit(0.0)), F.lit(0.0))
    m = items.groupBy("doc_id", "page").agg(far(2).alias("x"), far(3).alias("y")).join(sizes, ["doc_id", "page"], "full")
    known = F.col("width").isNotNull() & (F.col("x") > 0) & (F.col("y") > 0)
    mid = m.where(known).groupBy("doc_id").agg(*[F.percentile(c, F.lit(0.5)).alias(f"_{c}") for c in ("x", "y", "width", "height")])
    over = lambda a, b: F.col(a) > b * 1.15
    fits = (F.col("_x") <= 1150.0) & (F.col("_y") <= 1150.0) & ((F.col("_x") >= 650) | (F.col("_y") >= 750))
    rendered = F.coalesce(fits & (over("_x", F.col("_width")) | over("_y", F.col("_height")) | (F.col("_width") > 1150.0) | (F.col("_height") > 1150.0)), F.lit(False))
    # Sizes of a document without items are its pages' own.
    big = F.coalesce((F.col("x") > 650) | (F.col("y") > 750), F.lit(False))
    size = lambda own, c: F.when(rendered, 1000.0).otherwise(F.coalesce(F.col(own), F.when(big, 1000.0).otherwise(F.greatest(F.col(c), F.lit(1.0)))))
    return m.join(mid, "doc_id", "left").select("doc_id", "page", size("width", "x").alias("width"), size("height", "y").alias("height"))


def _block_text(block: Column) -> Column:
    """A block's lines, an equation that is a note's marker in its plain form."""

    def span(s: Column) -> Column:
        content = F.coalesce(s["content"], F.lit(""))
        marker = F.translate(F.regexp_replace(T.strip(content), r"^[{}^ ]+|[{}^ ]+$", ""), T.SUPERSCRIPTS + "＊", T.DIGITS + "*")
        equation = s["type"].isin("inline_equation", "equation_inline") & marker.rlike(r"^(?:\d{1,3}\*{0,3}|\*{1,3})$")
        return F.when(equation, marker).otherwise(content)

    lines = F.transform(F.coalesce(block["lines"], F.array()), lambda x: T.normalise_ws(F.array_join(F.transform(F.coalesce(x["spans"], F.array()), span), "")))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def middle_footnotes(middle: DataFrame, content_sizes: DataFrame) -> DataFrame:
    """doc_id, page, index, type, text and bbox of discarded page footnotes and reference texts, also those in lists.

    middle: doc_id, pdf_info MIDDLE. Boxes are scaled to the space of ``content_sizes`` (1000 x 1000 where a page has none).
    """
    slim = lambda b: F.struct(*[b[f].alias(f) for f in ("type", "index", "bbox", "lines")])
    none = F.array().cast(f"array<struct<{BLOCK}>>")
    p = middle.select("doc_id", F.posexplode("pdf_info").alias("at", "p")).where("p IS NOT NULL").select("doc_id", (F.coalesce("p.page_idx", "at") + 1).alias("page"), "p")
    notes = F.filter(F.coalesce("p.discarded_blocks", none), lambda b: b["type"] == "page_footnote")
    listed = lambda b: F.filter(F.coalesce(b["blocks"], none), lambda c: c["type"] == "ref_text")
    texts = F.transform(F.coalesce("p.para_blocks", F.array()), lambda b: F.when(b["type"] == "ref_text", F.array(slim(b))).when((b["type"] == "list") & (b["sub_type"] == "ref_text"), F.transform(listed(b), slim)).otherwise(none))
    d = p.select("doc_id", "page", F.col("p.page_size").alias("size"), F.posexplode(F.concat(F.transform(notes, slim), F.flatten(texts))).alias("at", "b"))
    d = d.withColumn("text", _block_text(F.col("b"))).where("text <> ''").join(content_sizes.select("doc_id", "page", "width", "height"), ["doc_id", "page"], "left")
    own = (F.size("size") >= 2) & (F.col("size")[0] > 0) & (F.col("size")[1] > 0)
    scale = [F.when(own, F.coalesce(c, F.lit(1000.0)) / F.col("size")[i]) for i, c in enumerate(("width", "height"))]
    box = F.array(*[F.coalesce(F.round(F.col("b.bbox")[i] * scale[i % 2], 3), F.col("b.bbox")[i]) for i in range(4)])
    return d.select("doc_id", "page", F.coalesce("b.index", "at").alias("index"), F.col("b.type").alias("type"), "text", F.when(F.size("b.bbox") >= 4, box).alias("bbox"))


def replace_footnotes(items: DataFrame, middle: DataFrame, content_sizes: DataFrame) -> DataFrame:
    """Items with the middle file's footnotes in place of their own, and ``ord`` by place on the page.

    A list's ``sub_type`` is its list type. Documents without pages in ``middle`` keep their footnotes.
    """
    given = middle.where("pdf_info IS NOT NULL").select("doc_id", F.lit(True).alias("_given")).distinct()
    own = F.col("type").isin("page_footnote", "ref_text") | ((F.col("type") == "list") & F.coalesce(F.col("sub_type") == "reference_list", F.lit(False)))
    kept = items.join(given, "doc_id", "left").where(F.col("_given").isNull() | ~F.coalesce(own, F.lit(False))).drop("_given")
    both = kept.unionByName(middle_footnotes(middle, content_sizes), allowMissingColumns=True)
    at = lambda i: F.coalesce(F.col("bbox")[i], F.lit(0.0))
    return both.withColumn("ord", F.row_number().over(Window.partitionBy("doc_id", "page").orderBy(at(1), at(0), "index")))


def load_inputs(pages: DataFrame | None, items: DataFrame | None, middle: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Items and their page sizes from page lists, else from a flat list, with the middle file's footnotes."""
    if pages is None and items is None:
        raise ValueError("either page lists or a flat list is required")
    flat = flatten_pages(pages) if pages is not None else flatten_legacy(items)
    sizes = content_page_sizes(flat, page_sizes(middle))
    return replace_footnotes(flat, middle, sizes), sizes


def check_docstore(rows: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Counts of the stores, one for each of ``keys``, whose vector_id isn't the contiguous sequence from 0."""
    g = rows.groupBy(*(keys or []))
    stats = g.agg(F.count(F.lit(1)).alias("n"), F.min("vector_id").alias("lo"), F.max("vector_id").alias("hi"), F.countDistinct("vector_id").alias("d"))
    return stats.where("n > 0 AND (lo <> 0 OR hi <> n - 1 OR d <> n)")
