"""Mixing sources to target weights.

Efraimidis-Spirakis sampling: a document's key is an exponential variate divided
by its quality weight, -ln(u) / w, with u a hash of doc_id, so that reruns agree.
A source takes complete epochs first; what is left of its target is a prefix of
its documents in key order, found by prefix sums of sizes.

No source is gathered in one task. Keys fall into CELLS cells for each doubling,
so that a cell holds less than a thousandth of a source whatever the weights are;
sums per (source, cell) find the cell in which a source's budget ends, and only
that cell's rows are sorted. The decision of a row is then a comparison with one
(key, doc_id) per source, so texts are never shuffled. One row per source goes
through a single task for ranks and targets; it is broadcast only if there are
at most BROADCAST_SOURCES sources, otherwise joined by shuffle.

Null texts have size 0 and are taken as often as any row of no words: never.
A null source is a source of its own, last in order. Repeated rows are rows of
their own; rows that share a doc_id and a key stand or fall together, by where the
middle of their sizes lies. A row is taken in the part epoch if the sizes before it
and half its own are at most the budget. An empty table gives an empty mix. Input
columns, whatever their names, pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.store import materialise

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
CELLS = 1024
BROADCAST_SOURCES = 10_000
SEED = 2017
#: The column in which a row's decision lies; as good as unknown to tables.
MIX = "_mix_3f1c9a7e"


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null: 0."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, r"[\x20\x09-\x0D]+"))).cast("long")


def quality_weight(text: Column) -> Column:
    """Between 0.25 and 1: the share of a text's bytes that the mean line leaves to prose.

    Very short lines (lists, tables, boilerplate) lower it: 64 characters a line or more weigh 1.
    """
    text = F.coalesce(text, F.lit(""))
    lines = F.size(F.split(text, "\n"))
    return F.least(F.lit(1.0), F.greatest(F.lit(0.25), F.length(text) / (lines * 64.0)))


def _keyed(docs: DataFrame, doc_id: str, size: Column, source: Column, weight: Column) -> DataFrame:
    """docs with MIX: source, size, key in (0, inf) and cell."""
    # 52 bits of a hash that every SQL engine has.
    bits = F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")), F.lit(f":{SEED}"))), 1, 13), 16, 10).cast("double")
    u = (bits + F.lit(0.5)) * F.lit(2.0**-52)
    df = docs.withColumn(MIX, F.struct(source.alias("source"), size.alias("size"), (-F.log(u) / weight).alias("key")))
    # Between 2 ** -53 and 2 ** 8 the logarithm orders keys as they are; a part of a doubling holds at most 0.37 / CELLS of a source.
    cell = F.floor((F.log2(F.greatest(F.col(MIX)["key"], F.lit(2.0**-60))) + 60) * CELLS).cast("int")
    return df.withColumn(MIX, F.col(MIX).withField("cell", cell))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) with ``weight`` and ``target``: shares of the total by weight, stopped at most * size.

    Sources ordered by cap per weight are stopped from the front: source k is
    stopped if the level (rest of the total) / (rest of the weights) lies above
    its cap. That is the fixed point of resharing the excess by weight.
    """
    by_code = Window.orderBy(F.encode("source", "utf-8").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    df = sources.withColumn("weight", F.get(cycle, (F.row_number().over(by_code) - 1) % len(weights)))
    every = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_cap = Window.orderBy(F.col("source_size") / F.col("weight"), F.encode("source", "utf-8").asc_nulls_last())
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    df = df.select(
        "*",
        (F.sum("source_size").over(every) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))).alias("_rest"),
        (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("_left"),
    )
    df = df.withColumn("_stopped", most * F.col("source_size") * F.col("_left") < F.col("weight") * F.col("_rest"))
    # The level is that of the first source that isn't stopped; the largest one is the same, as levels only rise to it.
    level = F.first(F.when(~F.col("_stopped"), F.col("_rest") / F.col("_left")), ignorenulls=True).over(by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.when(F.col("_stopped"), most * F.col("source_size").cast("double")).otherwise(F.col("weight") * level)
    return df.select("source", "source_size", "weight", target.alias("target"))


def plan(rows: DataFrame) -> DataFrame:
    """One row per source: its size, target, whole epochs and the last (key, doc_id) of the part epoch.

    ``rows``: source, size, key, cell, doc_id; read three times, so a stored table.
    """
    cells = rows.groupBy("source", "cell").agg(F.sum("size").alias("cell_size"))
    cells = materialise(cells, "mix-cells")
    sources = targets(cells.groupBy("source").agg(F.sum("cell_size").alias("source_size")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + F.lit(1e-12))).otherwise(0).cast("long")
    sources = sources.withColumn("epochs", epochs)
    sources = materialise(sources.withColumn("budget", F.greatest(F.lit(0.0), F.col("target") - F.col("epochs") * F.col("source_size"))), "mix-sources")
    small = sources.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    side = F.broadcast if small else (lambda df: df)
    same = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))
    upto = Window.partitionBy("c.source").orderBy("c.cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = cells.alias("c").join(side(sources).alias("s"), same("c", "s"))
    ends = ends.select("c.source", "c.cell", "s.budget", (F.sum("c.cell_size").over(upto) - F.col("c.cell_size")).alias("before"), "c.cell_size")
    # The cell in which the budget ends: one per source.
    ends = ends.where("before <= budget AND budget < before + cell_size").select("source", "cell", (F.col("budget") - F.col("before")).alias("room"))
    inside = rows.alias("r").join(side(ends).alias("e"), same("r", "e") & (F.col("r.cell") == F.col("e.cell")))
    inside = inside.groupBy("r.source", "e.room", "r.key", "r.doc_id").agg(F.sum("r.size").alias("size"))
    run = Window.partitionBy("source").orderBy("key", F.col("doc_id").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.withColumn("mid", F.sum("size").over(run) - F.col("size") / 2)
    last = inside.where("mid <= room").groupBy("source").agg(F.max(F.struct("key", "doc_id")).alias("last"))
    ends = ends.alias("e").join(last.alias("l"), same("e", "l"), "left").select("e.source", "e.cell", "l.last")
    out = sources.alias("s").join(ends.alias("e"), same("s", "e"), "left").select("s.*", F.col("e.cell").alias("last_cell"), "e.last")
    return materialise(out, "mix-plan")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` with a struct column MIX: source, size, key, cell, source_size, target and copies (0 to 3)."""
    keyed = _keyed(docs, doc_id, word_count(F.col(f"`{text}`")), F.col(f"`{source}`"), quality_weight(F.col(f"`{text}`")))
    rows = materialise(keyed.select(f"{MIX}.*", F.col(f"`{doc_id}`").alias("doc_id")), "mix-rows")
    return _decide(keyed, doc_id, plan(rows))


def _decide(keyed: DataFrame, doc_id: str, planned: DataFrame) -> DataFrame:
    side = F.broadcast(planned) if planned.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES else planned
    names = [F.col(f"d.`{c}`") for c in keyed.columns if c != MIX]
    joined = keyed.alias("d").join(side.alias("p"), F.col(f"d.{MIX}.source").eqNullSafe(F.col("p.source")))
    m, key_id = F.col(f"d.{MIX}"), F.struct(F.col(f"d.{MIX}.key"), F.col(f"d.`{doc_id}`"))
    part = F.when(F.col("p.last_cell").isNull(), F.lit(False)).when(m["cell"] != F.col("p.last_cell"), m["cell"] < F.col("p.last_cell"))
    part = part.otherwise(F.coalesce(key_id <= F.col("p.last"), F.lit(False)))
    copies = F.when(m["size"] == 0, 0).otherwise(F.col("p.epochs") + part.cast("long")).cast("long")
    out = m.withField("source_size", F.col("p.source_size")).withField("target", F.col("p.target")).withField("copies", copies)
    return joined.select(*names, out.alias(MIX))


def decisions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, size, source_size, target and taken (words) of every row; texts are read once."""
    keyed = _keyed(docs, doc_id, word_count(F.col(f"`{text}`")), F.col(f"`{source}`"), quality_weight(F.col(f"`{text}`")))
    rows = materialise(keyed.select(f"{MIX}.*", F.col(f"`{doc_id}`").alias("doc_id")), "mix-rows")
    slim = rows.select("doc_id", F.struct("source", "size", "key", "cell").alias(MIX))
    out = _decide(slim, "doc_id", plan(rows))
    return out.select("doc_id", f"{MIX}.size", f"{MIX}.source_size", f"{MIX}.target", (F.col(f"{MIX}.size") * F.col(f"{MIX}.copies")).alias("taken"))


def take(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: each row as many times as it is taken, with the columns of ``docs``."""
    mixed = mix(docs, doc_id, text, source).where(f"{MIX}.copies > 0")
    return mixed.withColumn(MIX, F.explode(F.array_repeat(F.lit(0), F.col(f"{MIX}.copies").cast("int")))).drop(MIX)
