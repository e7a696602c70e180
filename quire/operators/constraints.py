"""Constraints as tables of violations: doc_id, rule, detail (Q1-Q21).

A valid input gives an empty table; ``gate`` raises if it isn't.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from quire.operators.folds import dealt

# Domains of the document model.
BLOCK_TYPES = ("heading", "paragraph", "toc_item", "display_block", "list_item", "table", "table_continuation", "figure", "caption", "footnote")
OBSERVATION_KINDS = ("text_region", "image_region", "table_region", "page_marker", "footnote_region")


def where(rows: DataFrame, rule: str, broken: Column, detail: Column) -> DataFrame:
    return rows.where(broken).select("doc_id", F.lit(rule).alias("rule"), detail.cast("string").alias("detail"))


def broken(rows: DataFrame, rules: dict[str, Column], detail: Column) -> DataFrame:
    """Several rules of one table, which is read once."""
    found = F.array_compact(F.array(*[F.when(bad, rule) for rule, bad in rules.items()]))
    return rows.select("doc_id", F.explode(found).alias("rule"), detail.cast("string").alias("detail"))


def required(rows: DataFrame, fields: list[str], detail: Column) -> DataFrame:
    return every([where(rows, f"required:{f}", F.col(f).isNull() | (F.col(f).cast("string") == ""), detail) for f in fields])


def domain(rows: DataFrame, field: str, values: tuple[str, ...], detail: Column) -> DataFrame:
    return where(rows, f"domain:{field}", ~F.coalesce(F.col(field).isin(*values), F.lit(False)), detail)


def _in_order(rows: DataFrame, keys: list[str], *order: str) -> tuple[DataFrame, WindowSpec]:
    """``rows`` dealt and sorted by ``keys``, and the window over rows of one key, nulls being equal.

    One sort of slim rows in tasks of bounded size is all that a constraint holds: no join and no table of keys.
    """
    return dealt(rows, *keys), Window.partitionBy(*keys).orderBy(*order)


def unique(rows: DataFrame, key: str) -> DataFrame:
    r, w = _in_order(rows.select("doc_id", key), ["doc_id", key], key)
    return where(r.withColumn("_n", F.row_number().over(w)), f"unique:{key}", F.col("_n") == 2, F.col(key))


def lost(rows: DataFrame, parents: DataFrame, field: str, rule: str) -> DataFrame:
    """``rows`` whose ``field`` no row of ``parents`` has in the document; null keys find none."""
    both = rows.select("doc_id", field, F.lit(False).alias("_parent")).union(parents.select("doc_id", field, F.lit(True)))
    r, w = _in_order(both, ["doc_id", field], F.desc("_parent"))
    found = F.coalesce(F.first("_parent").over(w) & F.col("doc_id").isNotNull() & F.col(field).isNotNull(), F.lit(False))
    return where(r.withColumn("_found", found), rule, ~F.col("_parent") & ~F.col("_found"), F.col(field))


def references(rows: DataFrame, field: str, parents: DataFrame, key: str) -> DataFrame:
    return lost(rows.where(F.col(field).isNotNull()), parents.select("doc_id", F.col(key).alias(field)), field, f"reference:{field}")


def increasing(rows: DataFrame, field: str, order: str) -> DataFrame:
    w = Window.partitionBy("doc_id").orderBy(order)
    r = rows.withColumn("_before", F.lag(field).over(w))
    return where(r, f"increasing:{field}", F.col(field) <= F.col("_before"), F.col(order))


def dense_ids(rows: DataFrame, field: str, order: str, pattern: str) -> DataFrame:
    r = rows.withColumn("_expected", F.format_string(pattern, F.row_number().over(Window.partitionBy("doc_id").orderBy(order))))
    return where(r, f"dense:{field}", ~F.col(field).eqNullSafe(F.col("_expected")), F.col(field))


def boxes(rows: DataFrame, field: str, detail: Column) -> DataFrame:
    b = F.col(field)
    good = (F.size(b) == 4) & F.forall(b, lambda x: x.isNotNull()) & (b[0] <= b[2]) & (b[1] <= b[3])
    return where(rows, f"box:{field}", b.isNotNull() & ~F.coalesce(good, F.lit(False)), detail)


def same_set(known: DataFrame, placed: DataFrame, field: str) -> DataFrame:
    """Complete partition: what is known is placed, once, and nothing else is."""
    both = known.select("doc_id", field, F.lit(1).alias("_known")).union(placed.select("doc_id", field, F.lit(0)))
    r, w = _in_order(both, ["doc_id", field], F.desc("_known"))
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    r = r.withColumns({"_at": F.row_number().over(w), "_n": F.count(F.lit(1)).over(whole), "_of": F.sum("_known").over(whole)})
    # Of a key's rows the first _of are known and as many placed are owed: the surplus of either side is over its rule.
    over = F.when(F.col("_known") == 1, F.col("_at") <= 2 * F.col("_of") - F.col("_n")).otherwise(F.col("_at") > 2 * F.col("_of"))
    rule = F.when(F.col("_known") == 1, f"missing:{field}").otherwise(f"extra:{field}")
    return r.where(over).select("doc_id", rule.alias("rule"), F.col(field).cast("string").alias("detail"))


def every(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, parts)


def canonical(blocks: DataFrame) -> DataFrame:
    """Q1 over blocks."""
    at = F.col("block_id")
    return every([required(blocks, ["doc_id", "block_id", "type"], at), domain(blocks, "type", BLOCK_TYPES, at), unique(blocks, "block_id"), where(blocks, "heading_level", (F.col("type") == "heading") & (F.coalesce("level", F.lit(0)) < 1), at)])


def observed(observations: DataFrame, pages: DataFrame) -> DataFrame:
    """Q2 over observations and pages."""
    at = F.col("observation_id")
    return every([unique(observations, "observation_id"), domain(observations, "kind", OBSERVATION_KINDS, at), references(observations, "page", pages, "page"), boxes(observations, "bbox", at), unique(pages, "page")])


def graph(nodes: DataFrame, edges: DataFrame, evidence: DataFrame) -> DataFrame:
    """Q3 over the book graph's tables."""
    cited = nodes.select("doc_id", F.explode("evidence_ids").alias("evidence_id"))
    return every([unique(nodes, "node_id"), unique(evidence, "evidence_id"), references(edges, "source", nodes, "node_id"), references(cited, "evidence_id", evidence, "evidence_id")])


def gate(violations: DataFrame) -> None:
    """Raise on the first violation."""
    if found := violations.take(1):
        raise ValueError(f"{found[0]['rule']} in {found[0]['doc_id']}: {found[0]['detail']}")
