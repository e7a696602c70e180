"""Quality rules: a threshold table compiled into one projection.

``compile_rules`` turns rows of (metric, low, high) into a single boolean
expression; no user function runs. All counts come from the whole text.

Null or empty texts have no words, so they fail the base rule ``n_words >= 10``.
Very long texts are counted whole. Repeated rows are judged row by row, ties do not
occur, an empty table gives an empty table, and input columns of any name pass
through untouched.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 5
#: The column in which counts lie; as good as unknown to tables.
_Q = "_quality_5c1d0e7b"
METRICS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_bullet_lines", "n_ellipsis_lines", "n_stop_words", "n_repeat_words")
# Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "das dem den der des die ein eine im ist mit nicht und von zu "
    "au de dans du elle en est et il la le les ne ou pour que qui un une "
    "con como del el las lo los no para por se su y"
).split()
_STOP_FORMS = sorted({form for w in STOP_WORDS for form in (w, w.capitalize(), w.upper())})


@dataclass(frozen=True)
class Rule:
    """Keep a document if ``low <= metric <= high``; ``metric`` is SQL over METRICS' names."""

    name: str
    metric: str
    low: float
    high: float


#: Production thresholds. A ratio over nothing is 0.
RULES = (
    Rule("mean_word_length", "word_chars / greatest(n_words, 1)", 2.0, 25.0),
    Rule("symbol_ratio", "n_symbols / greatest(n_words, 1)", 0.0, 0.5),
    Rule("stop_words", "n_stop_words / greatest(n_words, 1) + if(n_words < 40, 1, 0)", 0.002, 2.0),
    Rule("duplicate_lines", "n_dup_lines / greatest(n_lines, 1)", 0.0, 0.5),
    Rule("bullet_lines", "n_bullet_lines / greatest(n_lines, 1)", 0.0, 0.95),
    Rule("ellipsis_lines", "n_ellipsis_lines / greatest(n_lines, 1)", 0.0, 0.5),
)


def _counts(text: Column) -> tuple[list[Column], list[Column], list[Column]]:
    """Three projections, each over the one before: parts, hashes, metrics."""
    text = F.coalesce(text, F.lit(""))
    has_word = lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    parts = [
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+")).alias("w"),
        F.filter(F.split(text, "\n"), has_word).alias("l"),
        F.when(text.rlike("[#*$%&|<>]"), F.regexp_count(text, F.lit("[#*$%&|<>]"))).otherwise(0).cast("long").alias("n_symbols"),
    ]
    w, lines = F.col(f"{_Q}.w"), F.col(f"{_Q}.l")
    n = F.size(w) - WINDOW + 1
    windows = F.arrays_zip(*[F.slice(w, 1 + j, n).alias(f"w{j}") for j in range(WINDOW)])
    hashes = [
        F.when(F.size(w) >= WINDOW, F.transform(windows, lambda x: F.xxhash64(x))).otherwise(F.array().cast("array<bigint>")).alias("h"),
        F.size(w).cast("long").alias("n_words"),
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.size(F.filter(lines, lambda x: F.ltrim(x).rlike(r"^(?:[-*+•]|[0-9]+[.)])[\x20\t]"))).cast("long").alias("n_bullet_lines"),
        F.size(F.filter(lines, lambda x: F.rtrim(x).rlike(r"(?:\.\.\.|…)$"))).cast("long").alias("n_ellipsis_lines"),
        F.size(F.filter(w, lambda x: x.isin(_STOP_FORMS))).cast("long").alias("n_stop_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.col(f"{_Q}.n_symbols").alias("n_symbols"),
    ]
    h = F.col(f"{_Q}.h")
    ranked = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
    same = lambda s, i, e: F.coalesce(F.get(s, i)["h"] == e["h"], F.lit(False))
    # A window is found again if a neighbour in hash order has its hash.
    again = F.transform(F.array(ranked), lambda s: F.transform(s, lambda e, i: F.when(same(s, i - 1, e) | same(s, i + 1, e), e["p"])))
    at = F.sort_array(F.filter(F.get(again, F.lit(0)), lambda p: p.isNotNull()))
    state = lambda end, n: F.struct(end.cast("int").alias("end"), n.cast("long").alias("n"))
    covered = F.aggregate(at, state(F.lit(0), F.lit(0)), lambda s, p: state(p + WINDOW, s["n"] + p + WINDOW - F.greatest(p, s["end"])), lambda s: s["n"])
    metrics = [F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(covered).alias("n_repeat_words")]
    metrics += [F.col(f"{_Q}.{c}").alias(c) for c in METRICS if c != "n_repeat_words"]
    return parts, hashes, metrics


def compile_rules(rules: tuple[Rule, ...] = RULES, metrics: str = "") -> str:
    """One SQL condition that is true for documents inside every threshold; METRICS are fields of ``metrics`` if given."""
    verdict = " AND ".join(f"({r.metric}) BETWEEN {r.low!r}D AND {r.high!r}D" for r in rules) or "true"
    return re.sub(rf"\b({'|'.join(METRICS)})\b", rf"{metrics}.\1", verdict) if metrics else verdict


def quality(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, into: str = "quality") -> DataFrame:
    """``docs`` and a struct column: the counts, ``base_failed`` and ``kept``.

    It is the last column, named ``into``, with an underscore added while ``docs`` has that name.
    """
    out = docs
    for columns in _counts(F.col(f"`{text}`")):
        out = out.withColumn(_Q, F.struct(*columns))
    failed = f"{_Q}.n_words < 10 OR 100 * {_Q}.n_repeat_words > 20 * {_Q}.n_words"
    judged = F.col(_Q).withField("base_failed", F.expr(failed)).withField("kept", F.expr(f"NOT ({failed}) AND ({compile_rules(rules, _Q)})"))
    while into in docs.columns:
        into += "_"
    return out.withColumn(_Q, judged).withColumnRenamed(_Q, into)


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass; their columns are unchanged.

    A filter over the counts would be pushed below them, with every count written
    out anew at each use; an array of one element for each row that passes,
    exploded, reads the verdict where it is computed.
    """
    judged = quality(docs, text, rules, _Q)
    one = F.when(F.col(_Q)["kept"], F.array(F.lit(True)))
    return judged.select("*", F.explode(one).alias(f"{_Q}k")).drop(_Q, f"{_Q}k")
