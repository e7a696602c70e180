"""HTML as blocks, tables as text, EPUB archives as documents.

Only text inside p, li, blockquote and h1 to h6 counts; the first heading is the
title, later ones are paragraphs; an opening tag of these discards pending text.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as t

_HEADINGS = {f"h{i}" for i in range(1, 7)}
# Pages whose blocks are made at a time.
MOST_PAGES = 64
_HOLDERS = {"p", "li", "blockquote"} | _HEADINGS


class _Blocks(HTMLParser):
    """Text inside open holders; an opening tag drops what is pending, the end of any holder gives it out."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[str] = []
        self.held: list[str] = []
        self.blocks: list[tuple[str, str]] = []
        self.titled = False

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _HOLDERS:
            self.open.append(tag)
            self.held = []

    def handle_data(self, data: str) -> None:
        if self.open:
            self.held.append(data)

    def handle_endtag(self, tag: str) -> None:
        if tag not in _HOLDERS:
            return
        if said := " ".join("".join(self.held).split()):
            first = tag in _HEADINGS and not self.titled
            self.titled |= first
            self.blocks.append(("heading" if first else "paragraph", said))
        self.held = []
        if self.open:
            self.open.pop()


def read_blocks(html: str | None) -> list[tuple[str, str]]:
    parser = _Blocks()
    parser.feed(html or "")
    parser.close()
    return parser.blocks


class _Cells(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[list[str]] = []
        self.open = False

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th"):
            self.rows = self.rows or [[]]
            self.rows[-1].append("")
            self.open = True
        elif tag == "br":
            self.handle_data(" ")

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th"):
            self.open = False

    def handle_data(self, data: str) -> None:
        if self.open and self.rows and self.rows[-1]:
            self.rows[-1][-1] += data


def table_text(html: str | None) -> str:
    """Rows as lines, cells parted by tabs."""
    parser = _Cells()
    parser.feed(html or "")
    return "\n".join("\t".join(" ".join(c.split()) for c in row) for row in parser.rows if row)


@F.pandas_udf(t.StringType())
def table_text_udf(html: pd.Series) -> pd.Series:
    return html.map(table_text)


def html_blocks(pages: DataFrame, doc_id: str = "page_id", html: str = "html") -> DataFrame:
    """doc_id, ord, block_id, type, text, level, page, bbox and note_marker of every page's blocks.

    A task holds a batch of pages as they came and the blocks of ``MOST_PAGES`` of them.
    """
    rows = pages.select(F.col(doc_id).alias("doc_id"), F.col(html).alias("html"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, MOST_PAGES):
                part = batch.slice(at, MOST_PAGES)
                found = [(i, n, *block) for i, page in enumerate(part.column(1)) for n, block in enumerate(read_blocks(page.as_py()))]
                if found:
                    page, place, types, texts = zip(*found, strict=True)
                    columns = [part.column(0).take(pa.array(page)), pa.array(place, pa.int32()), pa.array(types, pa.string()), pa.array(texts, pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ord", "type", "text"])

    b = rows.mapInArrow(read, f"doc_id {kind}, ord int, type string, text string")
    return b.select(
        "doc_id", F.col("ord").cast("long").alias("ord"), F.format_string("b%06d", F.col("ord") + 1).alias("block_id"), "type", "text",
        F.when(F.col("type") == "heading", 1).alias("level"), F.lit(None).cast("int").alias("page"), F.lit(None).cast("array<double>").alias("bbox"), F.lit(None).cast("string").alias("note_marker"),
    )


def _member_names(names: list[str]) -> list[str]:
    """Content documents in order of name: not navigation, not covers."""
    keep = [n for n in names if n.lower().endswith((".xhtml", ".html", ".htm")) and not n.lower().endswith("nav.xhtml")]
    return sorted(n for n in keep if "cover" not in n.rsplit("/", 1)[-1].rsplit(".", 1)[0].lower())


def epub_blocks(files: DataFrame) -> DataFrame:
    """Blocks of EPUB archives read with the ``binaryFile`` source: path, title, author, language, ord, type, text."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    opf = next((archive.read(n).decode("utf-8", "replace") for n in archive.namelist() if n.endswith(".opf")), "")
                    meta = [(m[1].strip() if (m := re.search(rf"<dc:{k}[^>]*>(.*?)</dc:{k}>", opf, re.S)) else None) for k in ("title", "creator", "language")]
                    found = [b for n in _member_names(archive.namelist()) for b in read_blocks(archive.read(n).decode("utf-8", "replace"))]
                rows += [(path, *meta, i, kind, said) for i, (kind, said) in enumerate(found)]
            yield pd.DataFrame(rows, columns=["path", "title", "author", "language", "ord", "type", "text"])

    return files.select("path", "content").mapInPandas(read, "path string, title string, author string, language string, ord long, type string, text string")
