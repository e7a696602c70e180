"""Text functions of the document model, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as the document model counts it (Unicode), and superscript digits.
WHITE = r"\x09-\x0D\x1C-\x20\x85\xA0  -     　"
SUPERSCRIPTS, DIGITS = "⁰¹²³⁴⁵⁶⁷⁸⁹", "0123456789"
CLOSING, OPENING = "，。；：？！、）】》", "（【《"
CHINESE_DIGITS = "零一二三四五六七八九"
TITLE_NOISE = rf"[{WHITE},，.。:：;；/／\\\-—–·•…*＊①②③④⑤⑥⑦⑧⑨⑩《》〈〉（）()【】\[\]]+"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^[{WHITE}]+|[{WHITE}]+$", "")


def token_estimate(text: Column) -> Column:
    """Half the stripped length, 1 at least, and 0 for blank text."""
    n = F.length(strip(F.coalesce(text, F.lit(""))))
    return F.when(n == 0, 0).otherwise(F.greatest(F.lit(1), F.floor(n / 2).cast("int"))).cast("int")


def chunk_id(doc_id: Column, parser: Column, number: Column) -> Column:
    """``doc-parser-000001``."""
    return F.format_string("%s-%s-%06d", doc_id.cast("string"), parser, number.cast("int"))


def normalise_ws(text: Column) -> Column:
    """Blanks become one space, none beside CJK brackets and closing marks (C4)."""
    text = F.regexp_replace(F.translate(text, "　", " "), r"[ \t]+", " ")
    text = F.regexp_replace(text, rf"[{WHITE}]+([{CLOSING}])", "$1")
    return strip(F.regexp_replace(text, rf"([{OPENING}])[{WHITE}]+", "$1"))


def title_key(text: Column) -> Column:
    """A title without white space and punctuation, for comparison."""
    return F.regexp_replace(text, TITLE_NOISE, "")


def toc_line(text: Column) -> Column:
    """Full-width separators of a contents line as ASCII."""
    return F.translate(text, "／．—–", "/.--")


def clean_toc_title(text: Column) -> Column:
    """A contents title without its leader."""
    return strip(F.regexp_replace(text, rf"[{WHITE}.·•/\-／]+$", ""))


def note_marker(text: Column) -> Column:
    """A marker without braces and carets, superscripts as digits."""
    return strip(F.translate(F.regexp_replace(text, r"[{}^$]", ""), SUPERSCRIPTS, DIGITS))


def cjk_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[一-鿿]")).cast("int")


def chinese_number(text: Column) -> Column:
    """Chinese numerals up to 99 as an integer, null for others."""
    value = lambda c: F.instr(F.lit(CHINESE_DIGITS), c) - 1
    tens, ones = F.regexp_extract(text, "^([一二三四五六七八九]?)十([一二三四五六七八九]?)$", 1), F.regexp_extract(text, "^([一二三四五六七八九]?)十([一二三四五六七八九]?)$", 2)
    two = F.when(tens == "", 1).otherwise(value(tens)) * 10 + F.when(ones == "", 0).otherwise(value(ones))
    return F.when(text.rlike("^[零一二三四五六七八九]$"), value(text)).when(text.rlike("^[一二三四五六七八九]?十[一二三四五六七八九]?$"), two).cast("int")


def roman_number(text: Column) -> Column:
    """A roman numeral as an integer, null for other text."""
    values = F.map_from_arrays(F.split(F.lit("I,V,X,L,C,D,M"), ","), F.array(*[F.lit(v) for v in (1, 5, 10, 50, 100, 500, 1000)]))
    v = F.transform(F.split(F.upper(text), ""), lambda c: F.coalesce(F.element_at(values, c), F.lit(0)))
    signed = F.transform(v, lambda x, i: F.when(x < F.coalesce(F.get(v, i + 1), F.lit(0)), -x).otherwise(x))
    return F.when(text.rlike("^[IVXLCDMivxlcdm]+$"), F.aggregate(signed, F.lit(0), lambda a, x: a + x))


_SUPER_RUN = rf"^[{SUPERSCRIPTS}]+"
_DELIMITER = rf"(?:[{WHITE}]+|[.．、:：)）\]］][{WHITE}]*)"


def strip_note_marker(text: Column, marker: Column) -> Column:
    """Note text without the marker it starts with; never empty.

    A known marker goes in superscript or literal form, the literal one only
    before a delimiter; else up to two digits, or marker signs, before one.
    """
    m = strip(F.coalesce(marker, F.lit("")))
    head = F.regexp_extract(text, f"({_SUPER_RUN})", 1)
    raised = F.when((head != "") & (F.translate(head, SUPERSCRIPTS, DIGITS) == m), F.regexp_replace(text, rf"{_SUPER_RUN}{_DELIMITER}?", ""))
    quoted = F.concat(F.lit(r"^\Q"), F.regexp_replace(m, r"\\E", ""), F.lit(rf"\E{_DELIMITER}"))
    literal = F.when(m != "", F.regexp_replace(text, quoted, F.lit("")))
    guess = F.regexp_replace(text, rf"^(?:[0-9]{{1,2}}|[①-⓿❶-➓{SUPERSCRIPTS}*†‡§]+){_DELIMITER}", "")
    pick = lambda c: F.when((c != "") & (c != text), c)
    return F.coalesce(pick(raised), pick(literal), pick(guess), text)


def safe_doc_id(text: Column) -> Column:
    """A slug and ten hexadecimal digits of the text's SHA-1."""
    slug = F.regexp_replace(F.regexp_replace(F.lower(text), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")
    return F.concat_ws("-", F.when(slug != "", F.substring(slug, 1, 40)), F.substring(F.sha1(text), 1, 10))


def xml_escape(text: Column) -> Column:
    for sign, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(sign), F.lit(name))
    return text
