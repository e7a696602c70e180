"""Chat formatting by quotation linking.

Lines that start with ``>`` marks, spaces between them allowed, are quoted at a
level of as many marks; other lines are a message's own. A passage is a run of
lines of one level, ended by a line without a letter or digit; its text has marks
stripped, case folded and every run of white space made one space, so that a
mailer may wrap it anew. A quoted passage is joined by hash to the latest earlier
turn of its conversation that has it among its own passages; failing that, its
windows of WINDOW words are, and failing that its lines: it comes from the turn in
which most of them are found, the later one in a tie. A message answers the turn
that most of its shallowest linked passages come from, the later one in a tie. Its
thread is that of the turn it answers; a message without a link begins a thread.
Messages ordered by (root_turn, turn) are the conversation in reply order, without
the quotes.

The link is an as-of window over hashes that share a conversation, so a passage
that many turns repeat makes no pairs. Threads of replies are followed by pointer
jumping, in as many rounds as the depth's logarithm.

Null texts have no line and stay null; a text of quotes alone becomes empty. Rows
with a null conv_id or turn link with nothing. Turns that a conversation repeats
are one place: they link alike. Passages without a letter or digit aren't linked.
Texts are read whole, in time linear in them. Empty tables give empty tables; other
columns, whatever their names, aren't read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.store import materialise, scratch

#: Words of a window of a passage.
WINDOW = 8
_MARKS = r"^[\x20\t]*(?:>[\x20\t]*)+"


def level(line: Column) -> Column:
    """Number of quote marks that a line starts with."""
    return F.length(F.regexp_replace(F.regexp_extract(line, _MARKS, 0), r"[^>]", ""))


def normalised(line: Column) -> Column:
    """A line without quote marks, in lower case, white space runs one space."""
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(line, _MARKS, "")), r"[\x20\x01\x02\x09-\x0D]+", " "))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def passages(text: Column) -> Column:
    """array<struct<level, text, lines>> of a message's passages in order."""
    said = F.transform(F.split(text, "\n"), lambda x: F.struct(level(x).alias("level"), normalised(x).alias("said")))
    said = F.transform(said, lambda e: F.struct(F.when(e["said"].rlike(r"[\p{L}\p{N}]"), e["level"]).alias("level"), e["said"].alias("said")))
    # \x01 begins a passage, \x02 ends its level and every line: one string, split again.
    begins = lambda all_, e, i: ~F.coalesce(F.get(all_, i - 1)["level"] == e["level"], F.lit(False))
    mark = lambda all_: F.transform(all_, lambda e, i: F.when(e["level"].isNull(), "").otherwise(F.concat(F.when(begins(all_, e, i), F.concat(F.lit("\x01"), e["level"].cast("string"))).otherwise(""), F.lit("\x02"), e["said"])))
    parts = F.filter(F.split(F.array_join(_let(said, mark), ""), "\x01"), lambda p: p != "")
    fields = F.transform(parts, lambda p: F.split(p, "\x02"))
    lines = lambda f: F.slice(f, 2, F.size(f))
    return F.transform(fields, lambda f: F.struct(f[0].cast("int").alias("level"), F.array_join(lines(f), " ").alias("text"), lines(f).alias("lines")))


def _units(rows: DataFrame) -> DataFrame:
    """conv_id, turn, passage (its place), level, kind (0 whole, 1 window, 2 line) and hash."""
    each = rows.select("conv_id", "turn", F.posexplode(passages(F.col("text"))).alias("passage", "p"))
    words = F.split("p.text", " ")
    windows = _let(words, lambda w: F.when(F.size(w) >= WINDOW, F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - WINDOW + 1, F.lit(1))), lambda i: F.struct(F.lit(1).alias("kind"), F.md5(F.array_join(F.slice(w, i, WINDOW), " ")).alias("hash")))))
    of = lambda kind, column: F.transform(column, lambda x: F.struct(F.lit(kind).alias("kind"), F.md5(x).alias("hash")))
    none = F.array().cast("array<struct<kind: int, hash: string>>")
    units = F.concat(of(0, F.array("p.text")), F.coalesce(windows, none), of(2, F.col("p.lines")))
    return each.select("conv_id", "turn", "passage", F.col("p.level").alias("level"), F.explode(units).alias("u")).select("conv_id", "turn", "passage", "level", "u.kind", "u.hash")


def links(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, parent_turn) of the messages whose passages were found."""
    quoting = rows.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull() & F.col("text").rlike(r"(?m)^[\x20\t]*>"))
    keys = ["conv_id", "kind", "hash"]
    asked = _units(quoting).where("level > 0").groupBy(*keys, "turn", "passage", "level").agg(F.count(F.lit(1)).alias("n"))
    # Only conversations that quote, and of their units only those that are quoted, matter.
    talk = rows.join(quoting.select("conv_id").distinct(), "conv_id", "left_semi")
    said = _units(talk).where("level = 0").select(*keys, "turn").distinct().join(asked.select(keys).distinct(), keys, "left_semi")
    none = F.lit(None)
    both = said.select(*keys, "turn", none.cast("int").alias("passage"), none.cast("int").alias("level"), none.cast("long").alias("n")).union(asked.select(*keys, "turn", "passage", "level", "n"))
    earlier = Window.partitionBy(*keys).orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    source = F.max(F.when(F.col("level").isNull(), F.col("turn"))).over(earlier)
    found = both.withColumn("parent_turn", source).where("level IS NOT NULL AND parent_turn IS NOT NULL")
    # One source of each passage, then one of each message.
    found = found.groupBy("conv_id", "turn", "passage", "level", "kind", "parent_turn").agg(F.sum("n").alias("n"))
    first = F.min_by("parent_turn", F.struct("kind", -F.col("n"), -F.col("parent_turn")))
    votes = found.groupBy("conv_id", "turn", "passage", "level").agg(first.alias("parent_turn")).groupBy("conv_id", "turn", "level", "parent_turn").agg(F.count(F.lit(1)).alias("n"))
    best = F.min_by("parent_turn", F.struct("level", -F.col("n"), -F.col("parent_turn")))
    return votes.groupBy("conv_id", "turn").agg(best.alias("parent_turn"))


def roots(replies: DataFrame) -> DataFrame:
    """(conv_id, turn, root_turn): the turn at the top of each linked message's thread."""
    step = materialise(replies.select("conv_id", "turn", F.col("parent_turn").alias("root_turn")), "chat-roots")
    while True:
        up = step.select("conv_id", F.col("turn").alias("root_turn"), F.col("root_turn").alias("higher"))
        joined = step.join(up, ["conv_id", "root_turn"], "left")
        step = joined.select("conv_id", "turn", F.coalesce("higher", "root_turn").alias("root_turn"), F.col("higher").isNotNull().alias("moved"))
        step = materialise(step, "chat-roots")
        if step.where("moved").limit(1).count() == 0:
            return step.select("conv_id", "turn", "root_turn")
        step = step.select("conv_id", "turn", "root_turn")


def reply_ordered(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, root_turn, turn, parent_turn, role, quote_depth, n_quoted (lines) and the text without quotes.

    Sort by conv_id, root_turn and turn for conversations in reply order.
    """
    name = lambda c: rows[f"`{c}`"]
    slim = rows.select(name(conv_id).alias("conv_id"), name(turn).cast("long").alias("turn"), name(role).alias("role"), name(text).cast("string").alias("text"))
    with scratch() as tables:
        replies = materialise(links(slim), "chat-links")
        threads = replies.join(roots(replies), ["conv_id", "turn"]) if replies.limit(1).count() else replies.withColumn("root_turn", F.col("parent_turn"))
        threads = tables.keep(materialise(threads, "chat-threads"))
    lines = F.split("text", "\n")
    levels = F.transform(lines, level)
    own = F.array_join(F.filter(lines, lambda x: level(x) == 0), "\n")
    out = slim.join(threads, ["conv_id", "turn"], "left")
    return out.select(
        "conv_id", F.coalesce("root_turn", "turn").alias("root_turn"), "turn", "parent_turn", "role",
        F.coalesce(F.array_max(levels), F.lit(0)).alias("quote_depth"), F.coalesce(F.size(F.filter(levels, lambda n: n > 0)).cast("long"), F.lit(0)).alias("n_quoted"),
        F.regexp_replace(F.regexp_replace(own, r"^\n+|\n+$", ""), r"\n{3,}", "\n\n").alias("text"),
    )
