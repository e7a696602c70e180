from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quire.functions import geometry
from quire.functions import text as T
from quire.operators import chunking, constraints, flow, graph, layout, notes, skeleton, tables, vectors
from quire.plans import catalogue
from quire.sources import html, records

BLOCK = "doc_id string, ord long, block_id string, type string, text string, level int, page int, bbox array<double>, note_marker string"


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column).first()[0]


@pytest.mark.parametrize("text,marker,expected", [("* note", "*", "note"), ("3. note", "3", "note"), ("³ note", "3", "note"), ("¹² note", "12", "note"), ("3rd note", "3", "3rd note"), ("755 年", None, "755 年"), ("12 note", None, "note"), ("3.", "3", "3."), ("① 注", None, "注")])
def test_strip_marker(spark, text, marker, expected):
    assert one(spark, T.strip_note_marker(F.col("t"), F.col("m")), t=text, m=marker) == expected


@pytest.mark.parametrize("text,expected", [("", 0), ("　 ", 0), ("a", 1), ("abcd", 2), (None, 0)])
def test_token_estimate(spark, text, expected):
    assert one(spark, T.token_estimate(F.col("t")), t=text) == expected


def test_numerals(spark):
    assert [one(spark, T.chinese_number(F.col("t")), t=x) for x in ("十", "二十三", "九", "十二", "x")] == [10, 23, 9, 12, None]
    assert [one(spark, T.roman_number(F.col("t")), t=x) for x in ("iv", "XLII", "MCMXC", "abc")] == [4, 42, 1990, None]


def test_heading_path_grows_by_length(spark):
    rows = [("d", 0, "heading", 1, "A"), ("d", 1, "heading", 3, "B"), ("d", 2, "heading", 3, "C"), ("d", 3, "heading", 0, "D")]
    got = chunking.heading_paths(spark.createDataFrame(rows, "doc_id string, ord long, type string, level int, text string")).orderBy("ord").collect()
    assert [r["path"] for r in got] == [["A"], ["A", "B"], ["A", "B", "C"], ["D"]]


def test_chunks(spark):
    rows = [
        ("d", 0, "b1", "paragraph", "before", None, 0, None, None), ("d", 1, "b2", "heading", "H", 1, 1, None, None), ("d", 2, "b3", "paragraph", "x", None, 7, [0.0, 0.0, 1.0, 1.0], None),
        ("d", 3, "b4", "figure", "f", None, 7, None, None), ("d", 4, "b5", "footnote", "1. note", None, 8, None, "1"), ("d", 5, "b6", "table", "t", None, 9, None, None), ("d", 6, "b7", "paragraph", "", None, 9, None, None),
    ]
    docs = spark.createDataFrame([("d", None, "p")], "doc_id string, title string, parser_name string")
    got = chunking.chunks(spark.createDataFrame(rows, BLOCK), docs).orderBy("chunk_id").collect()
    assert [(r["chunk_type"], r["text"], r["heading_path"], r["page_start"], r["page_end"]) for r in got] == [("text", "before", [], None, None), ("text", "x\n\nnote", ["H"], 7, 8), ("table", "t", ["H"], 9, 9)]
    assert got[1]["block_ids"] == ["b3", "b5"] and got[0]["chapter_title"] == "d" and got[2]["chunk_id"] == "d-p-000003"
    assert chunking.chunks(spark.createDataFrame([], BLOCK), docs).count() == 0


def test_vectors(spark):
    v = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 2.0])], "vector_id long, embedding array<float>")
    assert [(r["rank"], r["vector_id"]) for r in vectors.top_k(v, [1.0, 0.0], 5).orderBy("rank").collect()] == [(1, 0), (2, 1), (3, 2)]
    stored = vectors.docstore(spark.range(100).withColumnRenamed("id", "k"), F.col("k"))
    assert sorted((r["k"], r["vector_id"]) for r in stored.collect()) == [(i, i) for i in range(100)]


def test_top_k_batch_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, [float(rng.randint(-2, 2)) for _ in range(3)]) for i in range(1500)] + [(1500, None), (1501, [1.0])]
    v = spark.createDataFrame(rows, "vector_id long, embedding array<float>").repartition(3)
    q = v.where("vector_id < 1101").select(F.col("vector_id").alias("query_id"), F.col("embedding").alias("query"))
    got = {}
    for r in vectors.top_k_batch(v, q, 4).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vector_id"], r["score"]))
    for i in range(1101):
        scored = [(j, sum(a * b for a, b in zip(rows[i][1], x, strict=True))) for j, x in rows[:1500]]
        assert got[i] == sorted(scored, key=lambda s: (-s[1], s[0]))[:4], i
    few = vectors.top_k_batch(v.where("vector_id >= 1498"), q.where("query_id = 0"), 9).orderBy("rank").collect()
    assert len(few) == 4 and [(r["vector_id"], r["score"]) for r in few[2:]] == [(1500, None), (1501, None)]


def test_nearest_profile_ties_to_lower(spark):
    rows = [("d", p, r) for p, r in ((1, "x"), (2, ""), (3, "x"), (4, ""), (9, "x"))]
    got = layout.nearest_profile(spark.createDataFrame(rows, "doc_id string, page long, reason string"))
    assert {r["page"]: r["profile_page"] for r in got.collect()} == {1: 2, 2: 2, 3: 2, 4: 4, 9: 4}


def test_gap_fill_stops_at_first_unfillable(spark):
    rows = [("d", i, f, ok) for i, (f, ok) in enumerate([(True, True), (False, True), (False, False), (False, True), (True, True), (False, True), (True, True)])]
    got = layout.fill_gaps(spark.createDataFrame(rows, "k string, i long, f boolean, ok boolean"), ["k"], "i", "f", "ok")
    assert [r["i"] for r in got.where("filled").orderBy("i").collect()] == [1, 5]


def test_notes(spark):
    refs = spark.createDataFrame([("d", 1, 1, "{1}"), ("d", 2, 1, "2"), ("d", 3, 1, "9")], "doc_id string, ref_id long, page long, marker string")
    own = spark.createDataFrame([("d", 10, 1, "¹"), ("d", 11, 1, "2"), ("d", 12, 1, "2")], "doc_id string, note_id long, page long, marker string")
    got = notes.resolve_on_page(refs, own)
    assert {r["ref_id"]: (r["status"], r["note_id"]) for r in got.collect()} == {1: ("resolved", 10), 2: ("ambiguous", None), 3: ("unresolved", None)}
    assert sorted(r["note_id"] for r in notes.orphans(own, got).collect()) == [11, 12]


def test_tables(spark):
    rows = [("d", 1, 1, "<t>"), ("d", 2, 2, ""), ("d", 4, 3, ""), ("d", 5, 4, "<t>")]
    got = tables.table_runs(spark.createDataFrame(rows, "doc_id string, page long, ord long, html string")).orderBy("page")
    assert [(r["page"], r["table_no"]) for r in got.collect()] == [(1, 1), (2, 1), (4, None), (5, 2)]


def test_skeleton(spark):
    rows = [("d", 1, "b", 1, 11, [11, 12]), ("d", 2, "b", 5, None, [3, 15]), ("d", 3, "b", 9, 19, [19])]
    e = spark.createDataFrame(rows, "doc_id string, entry_index long, role string, printed_page long, start_page long, candidates array<long>")
    assert [r["offset"] for r in skeleton.agreed_offsets(e).orderBy("entry_index").collect()] == [None, 10, None]
    assert [r["start_page"] for r in skeleton.monotonic_starts(e).orderBy("entry_index").collect()] == [11, 15, 19]
    lines = spark.createDataFrame([("One .... 12",), ("Intro   iv",), ("no page",)], "l string").select(skeleton.toc_entry(F.col("l")).alias("e"))
    assert [r["e"] and (r["e"]["title"], r["e"]["page_label"]) for r in lines.collect()] == [("One", "12"), ("Intro", "iv"), None]


def start_cost(entries, path):
    """(cost, missing entries, last page) of a path through (role, printed page, candidates), or None if it may not be taken."""
    cost, last, active = 0, None, (None, None)
    for (role, printed, candidates), page in zip(entries, path, strict=True):
        if page is None:
            cost += 24
            continue
        own = None if printed is None else page - printed
        before = active[1] if active[0] == role else None
        if (last is not None and page < last) or (own is not None and abs(own) > 128):
            return None
        cost += candidates.index(page) + (abs(own - before) if own is not None and before is not None else 0)
        last, active = page, (role, before if own is None else own)
    return cost, [p is None for p in path], last or 0


def test_starts_brute_force(spark):
    rng = random.Random(3)
    docs = [[(rng.choice("ab"), rng.choice([None, rng.randint(1, 40)]), rng.sample(range(1, 60), rng.randint(0, 3))) for _ in range(5)] for _ in range(40)]
    docs.append([("a", 1, [9]), ("a", 1, [9]), ("a", 2, [3, 40])])  # equal pages; an offset change of 30 costs more than a skip
    # 600 descending pages of which one may be taken, or none and all three entries behind them
    docs.append([("a", None, [5000 - 2 * i, 4999 - 2 * i]) for i in range(300)] + [("a", None, [p]) for p in (1, 2, 3)])
    rows = [(d, i, *entry) for d, entries in enumerate(docs) for i, entry in enumerate(entries)]
    e = spark.createDataFrame(rows, "doc_id long, entry_index long, role string, printed_page long, candidates array<long>")
    got = {}
    for r in skeleton.monotonic_starts(e).orderBy("doc_id", "entry_index").collect():
        got.setdefault(r["doc_id"], []).append(r["start_page"])
    for d, entries in enumerate(docs):
        paths = [[]]
        for k in range(len(entries)):
            paths = [[*path, page] for path in paths for page in (None, *entries[k][2]) if page is None or page >= next((p for p in reversed(path) if p is not None), 0)]
        assert start_cost(entries, got[d]) == min(c for c in (start_cost(entries, path) for path in paths) if c), d
    assert got[40] == [9, 9, None] and got[41] == [None] * 300 + [1, 2, 3]


def test_graph_and_constraints(spark):
    units = spark.createDataFrame([("d", 5, "u1", "heading", "A", 1, [0.0, 0.0, 1.0, 1.0]), ("d", 7, "u2", "paragraph", "B", 2, None)], "doc_id string, ord long, unit_id string, unit_type string, text string, page long, bbox array<double>")
    g = graph.records(units)
    assert [r["block_id"] for r in graph.blocks_of(g).orderBy("ord").collect()] == ["b000001", "b000002"]
    assert constraints.graph(g["nodes"], g["edges"], g["evidence"]).count() == 0
    broken = g["edges"].withColumn("source", F.lit("n999999"))
    with pytest.raises(ValueError, match="reference:source"):
        constraints.gate(constraints.graph(g["nodes"], broken, g["evidence"]))


def test_flow_joins_over_pages(spark):
    rows = [("d", 1, "paragraph", "An open", 1), ("d", 2, "footnote", "1 note.", 1), ("d", 3, "paragraph", " end.", 2), ("d", 4, "paragraph", "Next.", 2), ("d", 5, "paragraph", "Apart.", 4)]
    got = flow.reconcile(spark.createDataFrame(rows, "doc_id string, ord long, unit_type string, text string, page long")).orderBy("unit_no")
    assert [r["text"] for r in got.collect()] == ["An open end.", "1 note.", "Next.", "Apart."]


def test_footnotes_need_both_marks(spark):
    pairs = [("1 a（接下页）", "（接上页）b"), ("1 a 接下页", "2 b"), ("1 a", "接上页 b"), ("1 see 接下页 there", "接上页 b")]
    rows = [(d, i, "footnote", text, i) for d, pair in enumerate(pairs) for i, text in enumerate(pair, 1)]
    got = flow.reconcile(spark.createDataFrame(rows, "doc_id long, ord long, unit_type string, text string, page long")).orderBy("doc_id", "unit_no").collect()
    assert [(r["doc_id"], r["text"]) for r in got] == [(0, "1 a\nb")] + [(d, text) for d in (1, 2, 3) for text in pairs[d]]
    rows = [(1, "footnote", "1 a（接下页）", 1), (2, "paragraph", "Body.", 2), (3, "footnote", "2 c", 2), (4, "footnote", "（接上页）b", 2)]
    got = flow.reconcile(spark.createDataFrame([("d", *r) for r in rows], "doc_id string, ord long, unit_type string, text string, page long")).orderBy("unit_no").collect()
    assert [r["text"] for r in got] == ["1 a\nb", "Body.", "2 c"]


def test_html():
    assert html.read_blocks("<h1>T</h1><p>a <b>b</b></p><p>lost<li>c</li><h2>later</h2>") == [("heading", "T"), ("paragraph", "a b"), ("paragraph", "c"), ("paragraph", "later")]
    assert html.read_blocks(None) == [] and html.table_text("<table><tr><td>a</td><th>b  c</th></tr><tr><td>d</td></tr></table>") == "a\tb c\nd"


def test_geometry(spark):
    a, b = F.array(*map(F.lit, (0.0, 0.0, 2.0, 2.0))), F.array(*map(F.lit, (1.0, 1.0, 3.0, 3.0)))
    assert spark.range(1).select(geometry.overlap_ratio(a, b), geometry.area(a), geometry.valid(F.array(F.lit(1.0)))).first()[:] == (0.25, 4.0, False)


def test_whole_lines_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    paths, runs, status = {}, {}, {}
    for doc_id, text in spark.read.parquet(f"{sf}/documents.parquet").where("text IS NOT NULL").select("doc_id", "text").collect():
        lines, path = text.split("\n"), []
        for i, line in enumerate(lines):
            path = [*path[: len(line) % 4], line]
            paths[doc_id, i] = " > ".join(path)
        number, last, on, of_table = 0, None, False, {}
        for page, i, primary in sorted((i // 2 + len(x) % 2 + i // 14 * 2, i, len(x) % 3 == 0) for i, x in enumerate(lines)):
            on = primary or (on and page == last + 1)
            number, last = number + primary, page
            runs[doc_id, i] = (page, primary, number if on else None)
            if on:
                of_table.setdefault(number, []).append(page % 4 != 0)
        status |= {(doc_id, t): (len(p), sum(p), "admitted" if all(p) else "unresolved" if any(p) else "excluded") for t, p in of_table.items()}
    q = catalogue.queries()
    assert {(r["doc_id"], r["ord"]): r["path"] for r in q["rag_heading_path"](spark, sf).collect()} == paths
    assert max(map(len, paths.values())) > 5000
    assert {(r["doc_id"], r["ord"]): (r["page"], r["is_primary"], r["table_no"]) for r in q["table_runs"](spark, sf).collect()} == runs
    assert {t for _, _, t in runs.values()} > {None} and len(runs) == len(paths)
    assert {(r["doc_id"], r["table_no"]): (r["n_pages"], r["n_included"], r["status"]) for r in q["table_partition"](spark, sf).collect()} == status


def test_footnotes_of_the_middle_file(spark):
    line = lambda *spans: {"spans": [{"type": kind, "content": x} for kind, x in spans]}
    block = lambda kind, i, box, *lines, **more: {"type": kind, "index": i, "bbox": box, "lines": list(lines)} | more
    page = {
        "page_idx": 0, "page_size": [500.0, 800.0], "discarded_blocks": [block("page_footnote", 7, [50.0, 700.0, 450.0, 720.0], line(("inline_equation", "{^²}"), ("text", " lost  note")), line(("text", " "))), block("header", 1, [0.0, 0.0, 9.0, 9.0], line(("text", "head")))],
        "para_blocks": [block("ref_text", 8, None, line(("text", "direct"))), block("list", 3, [0.0, 0.0, 1.0, 1.0], sub_type="ref_text", blocks=[block("ref_text", None, [50.0, 400.0, 450.0, 420.0], line(("text", "nested"))), block("text", 1, None, line(("text", "no")))])],
    }
    middle = spark.createDataFrame([("d", [page]), ("e", None)], f"doc_id string, pdf_info {records.MIDDLE}")
    body = [("text", None, "body", [100.0, 100.0, 900.0, 950.0]), ("page_footnote", None, "old", [1.0, 1.0, 2.0, 2.0]), ("list", "reference_list", "refs", None), ("list", None, "kept", [100.0, 960.0, 900.0, 980.0])]
    pages = spark.createDataFrame([(d, [body]) for d in "de"], f"doc_id string, pages array<array<{records.ITEM}>>")
    got, sizes = records.load_inputs(pages, None, middle)
    rows = got.orderBy("doc_id", "ord").collect()
    assert [(r["text"], r["bbox"]) for r in rows if r["doc_id"] == "d"] == [("direct", None), ("body", [100.0, 100.0, 900.0, 950.0]), ("nested", [100.0, 500.0, 900.0, 525.0]), ("2 lost note", [100.0, 875.0, 900.0, 900.0]), ("kept", [100.0, 960.0, 900.0, 980.0])]
    assert sorted(r["text"] for r in rows if r["doc_id"] == "e") == ["body", "kept", "old", "refs"]
    assert {tuple(r) for r in sizes.collect()} == {("d", 1, 1000.0, 1000.0), ("e", 1, 1000.0, 1000.0)}
    flat = spark.createDataFrame([("d", i, 0, *x) for i, x in enumerate(body)], "doc_id string, ord long, page_idx long, type string, sub_type string, text string, bbox array<double>")
    assert [r["text"] for r in records.load_inputs(None, flat, middle)[0].orderBy("ord").collect()] == ["direct", "body", "nested", "2 lost note", "kept"]
    with pytest.raises(ValueError, match="required"):
        records.load_inputs(None, None, middle)


def test_nested_html_blocks():
    from quire.sources.html import read_blocks, table_text

    assert read_blocks("<blockquote><p>a</p>b</blockquote>") == [("paragraph", "a"), ("paragraph", "b")]
    assert read_blocks("<li>x<p>y</p>z</li>") == [("paragraph", "y"), ("paragraph", "z")]
    assert read_blocks("<h2> T </h2><p>one <b>two</b></p>out<h1>U</h1>") == [("heading", "T"), ("paragraph", "one two"), ("paragraph", "U")]
    assert read_blocks(None) == [] and read_blocks("plain") == []
    assert table_text("<table><tr><td>a<br>b</td><th> c  d</th></tr><tr></tr><tr><td>e</td></tr></table>") == "a b\tc d\ne"


def test_hierarchy_of_any_level(spark):
    import random

    from quire.operators import skeleton

    rng = random.Random(3)
    rows = [(d, i, rng.choice([-2, 0, 1, 2, 3, 7, 11, 40])) for d in range(5) for i in range(60)]
    got = {(r["doc_id"], r["entry_index"]): r["parent_index"] for r in skeleton.hierarchy(spark.createDataFrame(rows, "doc_id long, entry_index long, level long")).collect()}
    level = {(d, i): v for d, i, v in rows}
    for (d, i), v in level.items():
        assert got[d, i] == max((j for j in range(i) if level[d, j] < v), default=None)
