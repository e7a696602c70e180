"""Text as parsers give it: wraps, markers, trailing notes, contents numbers and nested content.

Column expressions, but for nested JSON, whose depth no schema bounds.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as t

from quire.functions import text as T

CJK = "一-鿿"
# Letters that formulas stand for, and what isn't text in nested content.
GREEK = dict(zip("alpha beta gamma delta epsilon theta lambda mu pi rho sigma tau phi chi psi omega".split(), "αβγδεθλμπρστφχψω", strict=True))
NOT_TEXT = ("image_source", "html", "table_type", "table_nest_level", "path")
WRAP_LEAST = 20


def join_wraps(text: Column) -> Column:
    """Lines that prose was wrapped into, joined.

    Both have 20 characters or more, the first ends in an ideograph and not in a closing mark, the second begins with
    one and not like a list item. A joined line is compared on as a whole, which only its end decides; so each
    break is judged by itself.
    """
    lines = F.transform(F.split(text, "\n"), T.strip)
    dense = lambda x: F.length(F.regexp_replace(x, rf"[{T.WHITE}]+", "")) >= WRAP_LEAST
    item = rf"^[0-9A-Za-z（(【《一二三四五六七八九十]+[、.．)]"
    joins = lambda a, b: dense(a) & dense(b) & a.rlike(rf"[{CJK}]$") & b.rlike(rf"^[{CJK}]") & ~b.rlike(item)

    def one(all_: Column) -> Column:
        # A line that was joined to a long one is long whatever it is itself.
        return F.array_join(F.transform(all_, lambda x, i: F.when(i == 0, x).otherwise(F.concat(F.when(joins(F.get(all_, i - 1), x), "").otherwise("\n"), x))), "")

    return F.get(F.transform(F.array(lines), one), F.lit(0))


def trailing_note(text: Column) -> Column:
    """struct<body, marker>: text without a note mark at its end, and the mark, null if there is none.

    Page numbers and attributions keep theirs; figures count only after a closing mark, and no more than two.
    """
    text = T.normalise_ws(F.coalesce(text, F.lit("")))
    pattern = rf"^(?s)(.*?)[{T.WHITE}]*(\*{{1,3}}|[0-9]{{1,3}}|[{T.SUPERSCRIPTS}]+)[{T.WHITE}]*$"
    body = T.normalise_ws(F.regexp_extract(text, pattern, 1))
    mark = F.translate(F.regexp_extract(text, pattern, 2), T.SUPERSCRIPTS, T.DIGITS)
    number = mark.rlike("^[0-9]+$")
    kept = text.rlike(r"^\s*[.·。]?\s*[0-9]+\s*$") | text.rlike(r"^\s*[—－–-]{1,4}\s*.+$")
    found = (mark != "") & ~kept & (~number | (body.rlike("[。？！；”’）】》.]$") & (F.length(mark) <= 2)))
    return F.struct(F.when(found, body).otherwise(text).alias("body"), F.when(found, mark).alias("marker"))


def block_text(text: Column) -> Column:
    """Z39."""
    return trailing_note(text)["body"]


def contents_number(text: Column) -> Column:
    """Confusions of letters and figures at the start of a contents line mended."""
    s = T.strip(text)
    for wrong, right in (("^I(?=[0-9])", "1"), (r"^II(?=[ \t\r\n]+)", "11"), (r"^2I(?=[ \t\r\n]+)", "21"), (r"^I(?=[ \t\r\n]+)", "1"), (r"(?i)^io(?=[ \t\r\n]+)", "10"), (r"(?i)^i6(?=[ \t\r\n]+)", "16"), ("^3[。.]", "30"), (r"僵[ \t]+局", "僵局")):
        s = F.regexp_replace(s, wrong, right)
    return s


def _marker(raw: str) -> str | None:
    text = raw.strip()
    if text.startswith("^{") and text.endswith("}") and "}" not in text[2:-1] and len(text) > 3:
        text = text[2:-1]
    text = text.strip().strip("{}^ ").translate(str.maketrans(T.SUPERSCRIPTS, T.DIGITS))
    stars = text.lstrip("0123456789")
    digits = len(text) - len(stars)
    return text if text and digits <= 3 and len(stars) <= 3 and set(stars) <= {"*", "＊"} else None


def runs_of(content: str | None) -> list[dict[str, str | None]]:
    """Text and note references of nested content in order, adjacent texts joined (C7); broken JSON gives nothing."""
    try:
        root = json.loads(content) if content else None
    except ValueError:
        return []
    out: list[dict[str, str | None]] = []

    def text(said: str) -> None:
        if said and out and out[-1]["type"] == "text":
            out[-1]["text"] += said
        elif said:
            out.append({"type": "text", "text": said, "marker": None, "raw_marker": None})

    pending = [root]
    while pending:
        x = pending.pop()
        if isinstance(x, list):
            pending.extend(reversed(x))
        elif isinstance(x, dict) and x.get("type") == "text":
            text(str(x.get("content", "")))
        elif isinstance(x, dict) and x.get("type") in ("equation_inline", "equation_interline"):
            raw = str(x.get("content", ""))
            if marker := _marker(raw):
                out.append({"type": "note_ref", "text": None, "marker": marker, "raw_marker": raw})
            else:
                text(GREEK.get(raw.strip()[1:], raw.strip()) if raw.strip().startswith("\\") else raw.strip())
        elif isinstance(x, dict):
            pending.extend(v for k, v in reversed(x.items()) if k not in NOT_TEXT)
    return out


RUNS = t.ArrayType(t.StructType([t.StructField(c, t.StringType()) for c in ("type", "text", "marker", "raw_marker")]))


@F.pandas_udf(RUNS)
def runs_udf(content: pd.Series) -> pd.Series:
    return pd.Series([runs_of(x) for x in content], dtype=object)


def text_of(runs: Column) -> Column:
    """All text of runs as one, wraps joined and white space normalised."""
    said = F.array_join(F.transform(F.filter(runs, lambda r: r["type"] == "text"), lambda r: r["text"]), "")
    return T.normalise_ws(join_wraps(said))


def markers_of(runs: Column) -> Column:
    """Z37."""
    return F.transform(F.filter(runs, lambda r: r["type"] == "note_ref"), lambda r: r["marker"])
