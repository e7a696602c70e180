"""EPUB archives: what is in them, and reading them back."""

from __future__ import annotations

import io
import zipfile
from xml.etree import ElementTree

from quire.functions import xhtml
from quire.operators import epub
from quire.sources import html

SCHEMA = "doc_id long, ord long, block_id string, type string, text string, level int, page long, bbox array<double>, layout_role string, captions array<string>, image_id string, runs array<struct<type: string, text: string, marker: string, target: string>>"


def book(spark):
    def row(n, kind, text, level=None, page=1, role=None, captions=None, image=None, runs=None):
        return (1, n, f"b{n}", kind, text, level, page, [10.0, 10.0, 500.0, 90.0], role, captions, image, runs)

    ref = lambda target: ("note_ref", None, "7", target)
    blocks = [
        row(0, "toc_item", "One ... 1"), row(1, "heading", "One & only\nsub", 1, 2), row(2, "paragraph", "x", page=2, runs=[("text", "say <b>", None, None), ref("f2"), ref("f1"), ref("f2")]),
        row(3, "list_item", "a", page=2), row(4, "list_item", "b", page=2), row(5, "figure", "Fig. 1", page=2, image="i1"), row(6, "caption", "under it", page=2), row(7, "caption", "and more", page=2), row(8, "footnote", "7. note text", page=2),
        row(9, "heading", "Two", 2, 3), row(10, "paragraph", "hidden", page=4), row(11, "figure", "whole page", page=4, role="full_page_image"), row(12, "caption", "its words", page=4), row(13, "paragraph", "hidden too", page=4), row(14, "paragraph", "second", page=5, runs=[ref("f9")]),
        row(15, "caption", "alone", page=5), row(16, "paragraph", "only a picture", page=6), row(17, None, None, page=7), row(18, "heading", None, 2, 8), row(19, "paragraph", None, page=8),
    ]
    docs = spark.createDataFrame([(1, "Book <1>", "en", None, "p"), (2, None, None, "A", "p")], "doc_id long, title string, language string, author string, parser_name string")
    contents = spark.createDataFrame([(1, 0, "One & only", "b1"), (1, 1, "Two", None), (1, 2, "Nowhere", None)], "doc_id long, entry_index long, title string, block_id string")
    pages = spark.createDataFrame([(1, p, p in (4, 6), None) for p in range(1, 9)], "doc_id long, page long, is_snapshot boolean, asset_id string")
    images = spark.createDataFrame([(1, "i1", 1, "x.png", None, 10, 20, "cover", bytearray(b"png"))], "doc_id long, image_id string, ord long, file_name string, media_type string, width int, height int, role string, content binary")
    return spark.createDataFrame(blocks, SCHEMA), docs, contents, pages, images


def test_chapters(spark):
    made = {(r["doc_id"], r["chapter_no"]): (r["title"], r["block_id"], r["body"]) for r in epub.chapters(*book(spark)).collect()}
    assert {k: v[:2] for k, v in made.items()} == {(1, 1): ("One & only", "b1"), (1, 2): ("Two", "b9"), (1, 3): ("Two", "b18"), (2, 1): ("2", None)}
    first, second = made[1, 1][2], made[1, 2][2]
    link = lambda target, n, at: f'<a epub:type="noteref" href="#{target}" id="b2_note_ref_{at}"><sup>{n}</sup></a>'
    assert first.startswith('<div class="chapter-title-page">\n  <h1>One &amp; only<br/>\nsub</h1>\n</div>\n<p>say &lt;b&gt;' + link("f2", 1, 1) + link("f1", 2, 2) + link("f2", 1, 3) + "</p>\n<ul><li>a</li><li>b</li></ul>\n")
    assert '<figure class="figure-block has-caption figure-portrait">\n  <img src="images/i1_x.png" alt="Fig. 1"/>\n  <figcaption>\n    <p class="caption-title">Fig. 1</p>\n    <p class="caption-body">under it</p>\n    <p class="caption-body">and more</p>\n  </figcaption>\n</figure>' in first
    assert first.endswith('<aside epub:type="footnote" id="b8">\n  <p>note text</p>\n</aside>') and "toc" not in first and "under it</figcaption>" not in first
    assert "<p>hidden" not in second and "whole page" in second and "its words" in second and '<sup>1</sup></a>' in second and '<p class="caption">alone</p>' in second
    assert second.endswith(xhtml.PLACEHOLDER + "\n</figure>") and "only a picture" not in second and made[2, 1][2] == ""


def test_archive_and_back(spark):
    files = {r["doc_id"]: bytes(r["content"]) for r in epub.archives(*book(spark)).collect()}
    with zipfile.ZipFile(io.BytesIO(files[1])) as archive:
        names = archive.namelist()
        assert names[0] == "mimetype" and archive.getinfo("mimetype").compress_type == zipfile.ZIP_STORED and archive.read("EPUB/images/i1_x.png") == b"png"
        for name in names:
            if name.endswith((".xhtml", ".opf", ".xml")):
                ElementTree.fromstring(archive.read(name))
        opf, nav = archive.read("EPUB/content.opf").decode(), archive.read("EPUB/nav.xhtml").decode()
    assert opf.count("<itemref") == 3 and 'properties="cover-image"' in opf and "<dc:title>Book &lt;1&gt;</dc:title>" in opf and "<dc:creator>Unknown</dc:creator>" in opf and '<meta name="cover" content="i1"/>' in opf
    assert [line.split('"')[1] for line in nav.split("\n") if "<li>" in line] == ["chapter_0001.xhtml", "chapter_0002.xhtml", "chapter_0001.xhtml"]
    again = html.epub_blocks(spark.createDataFrame([(f"{d}.epub", bytearray(c)) for d, c in files.items()], "path string, content binary")).where("path = '1.epub'").orderBy("ord").collect()
    assert again[0]["title"] == "Book &lt;1&gt;" and [r["text"] for r in again][:3] == ["One & only sub", "say <b>121", "a"]


def test_titles_find_headings():
    heads = ["前言", "第一章绪论", "方法", "结果与讨论", "附录"]
    assert epub.matched_headings(["前言", "第一章绪论", "结果与讨论全文"], heads, heads) == [0, 1, 3]
    assert epub.matched_headings(["没有", "附录"], heads, heads) == []  # an entry that nothing matches uses up the headings
    assert epub.matched_headings(["", "附录"], heads, heads) == [4] and epub.matched_headings(["a"], [], []) == []


def test_fragments():
    assert xhtml.sanitized("<p>a &nbsp;&mdash; &amp; b & c<br></p>") == "<p>a \xa0— &amp; b &amp; c<br/></p>"
    assert xhtml.sanitized("<p>x") is None and xhtml.sanitized(" ") is None and xhtml.sanitized(None) is None and xhtml.sanitized("<p>&nosuch;</p>") == "<p>&amp;nosuch;</p>"
    table = "<table><tr><td>1</td><td class='q'>2</td></tr><tr><th>3</th></tr></table>"
    assert xhtml.aligned(table, None, None, None) == table
    assert xhtml.aligned(table, "center", [(1, "right")], [(0, 1, "left")]) == "<table><tr><td class=\"td-align-center\">1</td><td class='q td-align-left'>2</td></tr><tr><th class=\"td-align-right\">3</th></tr></table>"
