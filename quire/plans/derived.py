"""Inputs for layout, note and contents operators, derived from the driver's tables.

Those tables have no boxes, pages or notes; each builder here has its SQL twin below.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, ord, line and n (its length) of every document's lines."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("ord", "line"))
    return d.select("doc_id", F.col("ord").cast("long").alias("ord"), "line", F.length("line").cast("long").alias("n"))


LINES = """l AS (SELECT doc_id, ord, line, length(line) AS n FROM (SELECT doc_id, unnest(range(len(s))) AS ord, unnest(s) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)))"""


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six lines a page, each a box whose place and size follow from the line's length."""
    o = lines(spark, sf_dir).selectExpr(
        "doc_id", "ord", "line", "n", "ord div 6 + 1 AS page", "if(n % 11 = 0, 'image_region', 'text_region') AS kind", "100D + (n % 7) * 20 AS x0", "(ord % 6) * 120D + (n % 3) * 4 AS y0", "300D + (n % 4) * 100 AS w", "20D + (n % 5) * 16 AS h"
    )
    return o.selectExpr("doc_id", "ord", "line", "n", "page", "kind", "x0", "y0", "x0 + w AS x1", "y0 + h AS y1")


OBSERVATIONS = LINES + """, o0 AS (SELECT *, ord // 6 + 1 AS page, if(n % 11 = 0, 'image_region', 'text_region') AS kind, 100.0::DOUBLE + (n % 7) * 20 AS x0, (ord % 6) * 120.0::DOUBLE + (n % 3) * 4 AS y0, 300.0::DOUBLE + (n % 4) * 100 AS w, 20.0::DOUBLE + (n % 5) * 16 AS h FROM l),
o AS (SELECT doc_id, ord, line, n, page, kind, x0, y0, x0 + w AS x1, y0 + h AS y1 FROM o0)"""


def pages(observed: DataFrame) -> DataFrame:
    return observed.select("doc_id", "page").distinct().withColumns({"width": F.lit(1000.0), "height": F.lit(760.0)})


PAGES = "p AS (SELECT DISTINCT doc_id, page, 1000.0::DOUBLE AS width, 760.0::DOUBLE AS height FROM o)"


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents entries of customers: orders by key; every third one has no start page."""
    o = table(spark, sf_dir, "orders").selectExpr("o_custkey AS doc_id", "row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS entry_index", "o_orderkey % 997 AS printed_page", "o_orderstatus AS role", "o_orderkey")
    return o.selectExpr("doc_id", "entry_index", "role", "printed_page", "if(o_orderkey % 3 = 0, NULL, printed_page + 10 + doc_id % 2) AS start_page")


ENTRIES = """e0 AS (SELECT o_custkey AS doc_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS entry_index, o_orderkey % 997 AS printed_page, o_orderstatus AS role, o_orderkey FROM orders),
e AS (SELECT doc_id, entry_index, role, printed_page, CASE WHEN o_orderkey % 3 <> 0 THEN printed_page + 10 + doc_id % 2 END AS start_page FROM e0)"""
