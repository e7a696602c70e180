"""Retrieval chunks of canonical blocks.

Blocks: doc_id, ord, block_id, type, text, level, page, bbox and note_marker;
documents: doc_id, title, parser_name. Order is ``ord``; a chunk never spans
documents, so everything partitions by doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as t

from quire.functions import text as T
from quire.operators.folds import MOST_ROWS, along

# The types whose text goes into text chunks.
TEXT_TYPES = ("paragraph", "display_block", "list_item", "caption", "footnote")


def _below(path: list[str], level: int | None, said: str) -> list[str]:
    return [*path[: max((1 if level is None else int(level)) - 1, 0)], said]


def _paths(level: list[int | None], text: list[str]) -> list[list[str]]:
    out: list[list[str]] = []
    path: list[str] = []
    for own, said in zip(level, text, strict=True):
        path = _below(path, own, said)
        out.append(path)
    return out


def heading_paths(blocks: DataFrame) -> DataFrame:
    """(doc_id, ord, path) of every heading: the path before, cut to level - 1 entries, and the heading's text.

    The cut is by length, so a skipped level lengthens the path; only a pass in
    order gives that. Headings alone are gathered, not the text between them.
    """
    heads = blocks.where("type = 'heading'").select("doc_id", "ord", "level", "text")
    return along(heads, "ord", ["level", "text"], _paths, "array<string>", "path")


def _with_paths(blocks: DataFrame) -> DataFrame:
    """``blocks`` and ``_path``, the headings above each: one pass over sorted rows that holds a batch and a path."""
    rest = [c for c in blocks.columns if c not in ("doc_id", "ord")]
    names = ["doc_id", "ord", *rest]
    b = blocks.select(*names)
    kinds = t.StructType([*b.schema, t.StructField("_path", t.ArrayType(t.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        document, path = object(), []
        for batch in batches:
            for at in range(0, batch.num_rows, MOST_ROWS):
                part = batch.slice(at, MOST_ROWS)
                columns = dict(zip(names, part.columns, strict=True))
                heads = [k == "heading" for k in columns["type"].to_pylist()]
                paths = []
                for i, (key, head) in enumerate(zip(columns["doc_id"].to_pylist(), heads, strict=True)):
                    if key != document:
                        document, path = key, []
                    if head:
                        path = _below(path, columns["level"][i].as_py(), columns["text"][i].as_py())
                    paths.append(path)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(paths, pa.list_(pa.string()))], [*names, "_path"])

    return b.repartition("doc_id").sortWithinPartitions("doc_id", "ord", *rest).mapInArrow(run, kinds)


def chunks(blocks: DataFrame, documents: DataFrame) -> DataFrame:
    """Chunk rows: a run of text blocks between headings and tables, or one table."""
    order = Window.partitionBy("doc_id").orderBy("ord")
    b = _with_paths(blocks).withColumn("_part", F.sum(F.when(F.col("type").isin("heading", "table"), 1).otherwise(0)).over(order))
    held = F.col("type").isin(*TEXT_TYPES) & (F.coalesce("text", F.lit("")) != "")
    b = b.where(held | (F.col("type") == "table"))
    b = b.withColumn("_table", F.col("type") == "table").withColumn("_text", F.when(F.col("type") == "footnote", T.strip_note_marker(F.col("text"), F.col("note_marker"))).otherwise(F.coalesce("text", F.lit(""))))
    ref = F.when(F.col("page").isNotNull(), F.struct("page", "bbox"))
    rows = F.sort_array(F.collect_list(F.struct("ord", "block_id", F.col("_text").alias("text"), ref.alias("ref"))))
    page = F.when((F.col("page") != 0) | F.col("_table"), F.col("page"))
    c = b.groupBy("doc_id", "_part", "_table").agg(F.first("_path").alias("heading_path"), rows.alias("r"), F.min(page).alias("page_start"), F.max(page).alias("page_end"), F.min("ord").alias("_first"))
    c = c.withColumn("chunk_no", F.row_number().over(Window.partitionBy("doc_id").orderBy("_first"))).join(documents, "doc_id")
    title = F.coalesce(F.when(F.col("title") != "", F.col("title")), F.col("doc_id").cast("string"))
    joined = F.array_join(F.transform("r", lambda x: x["text"]), "\n\n")
    return c.select(
        T.chunk_id(F.col("doc_id"), F.col("parser_name"), F.col("chunk_no")).alias("chunk_id"), "doc_id", title.alias("title"), F.when(F.col("_table"), "table").otherwise("text").alias("chunk_type"), joined.alias("text"), "heading_path",
        F.coalesce(F.try_element_at("heading_path", F.lit(-1)), title).alias("chapter_title"), "page_start", "page_end", F.transform("r", lambda x: x["block_id"]).alias("block_ids"),
        F.filter(F.transform("r", lambda x: x["ref"]), lambda x: x.isNotNull()).alias("bbox_refs"), T.token_estimate(joined).alias("token_count"),
    )
