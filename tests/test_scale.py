"""Passes that stream: no call, batch or task that grows with the table."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire import workflow
from quire.operators import chunking, constraints, contracts, epub, flow, folds, graph, notes, skeleton, vectors, visuals
from quire.sources import html
from tests import test_epub


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_starts_stream(spark):
    rows = [(d, i, [i + 11, i + 12], i + 1, "body") for d in range(3000) for i in range(3)]
    e = spark.createDataFrame(rows, "doc_id long, entry_index long, candidates array<long>, printed_page long, role string")
    starts = skeleton.monotonic_starts(e)
    assert "FlatMapGroups" not in plan(starts)  # a call a document
    assert {tuple(r) for r in starts.collect()} == {(d, i, i + 11) for d in range(3000) for i in range(3)}


def test_documents_over_batches(spark):
    sizes = [1, 5000, 3, folds.MOST_ROWS, 0, 7]
    rows = [(d, i) for d, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, ord long").repartition(5)
    got = folds.along(df, "ord", ["ord"], lambda x: [len(x) * 10000 + v for v in x], "long", "seen").collect()
    assert {tuple(r) for r in got} == {(d, i, sizes[d] * 10000 + i) for d, i in rows} and len(got) == len(rows)


def test_flow_streams(spark):
    rows = [(d, i, "paragraph", "a" if i % 2 else "b. ", i) for d in range(50) for i in range(100)]
    merged = flow.reconcile(spark.createDataFrame(rows, "doc_id long, ord long, unit_type string, text string, page long"))
    assert "FlatMapGroups" not in plan(merged)
    assert merged.groupBy("text").agg(F.count(F.lit(1)).alias("n")).orderBy("text").collect() == [("a", 50), ("ab. ", 50 * 49), ("b. ", 50)]


def test_pages_and_paths_stream(spark):
    pages = spark.createDataFrame([(i, f"<h2>t{i}</h2><p>a</p><p>b{i}</p>" if i % 3 else None) for i in range(300)], "page_id long, html string")
    blocks = html.html_blocks(pages)
    assert "EvalPython" not in plan(blocks)  # whole batches of pages as nested lists
    assert {(r["doc_id"], r["ord"], r["text"]) for r in blocks.collect()} == {(i, n, s) for i in range(300) if i % 3 for n, s in enumerate((f"t{i}", "a", f"b{i}"))}
    docs = pages.select(F.col("page_id").alias("doc_id"), F.lit("x").alias("title"), F.lit("html").alias("parser_name"))
    chunks = chunking.chunks(blocks, docs)
    assert "EvalPython" not in plan(chunks)  # whole batches of documents with all their blocks
    assert {(r["doc_id"], r["chapter_title"], r["text"]) for r in chunks.collect()} == {(i, f"t{i}", f"a\n\nb{i}") for i in range(300) if i % 3}
    assert "EvalPython" not in plan(chunking.heading_paths(blocks))


def test_few_blocks_a_partition(spark):
    rows = spark.range(0, 60000, 1, 1).select(F.col("id").alias("vector_id"), F.array(F.lit(1.0), F.col("id").cast("double")).alias("embedding"))
    blocks = vectors._blocks(rows, 4096)
    assert blocks.select(F.spark_partition_id().alias("p")).groupBy("p").count().agg(F.max("count")).first()[0] <= 3  # else pairs of all of them are one batch
    best = vectors.top_k_batch(rows, rows.where("vector_id % 20000 = 1").select(F.col("vector_id").alias("query_id"), F.col("embedding").alias("query")), 2)
    assert {(r["query_id"], r["rank"], r["vector_id"]) for r in best.collect()} == {(q, n, 60000 - n) for q in (1, 20001, 40001) for n in (1, 2)}


def test_markup_is_made_once(spark):
    blocks, *rest = test_epub.book(spark)
    r = epub.rendered(blocks, *rest).where("html IS NOT NULL").select("ord", F.col("html").startswith("<p>").alias("p"), F.col("html").rlike("^<ul").alias("u"))
    assert plan(r).count("display-block-paragraph") <= 2 and "EvalPython" not in plan(r)  # a filter or a second reader would make it anew; no tables, no Python
    assert {x["ord"] for x in r.where("p").collect()} >= {2, 14}


def test_strategies_are_one_pass(spark):
    refs = spark.createDataFrame([(1, 1, 1, "a", "c"), (1, 1, 1, "a", "c"), (1, 2, 1, "b", None), (1, 3, 2, "c", "c"), (None, 4, 1, "a", "c"), (1, 5, 3, "z", "c")], "doc_id long, ref_id long, page int, marker string, scope_key string")
    foot = spark.createDataFrame([(1, 10, 1, "a"), (1, 11, 2, ""), (1, 12, 3, "y"), (None, 13, 1, "a")], "doc_id long, note_id long, page long, marker string")
    end = spark.createDataFrame([(1, 20, "b", "c"), (1, 21, "c", "c"), (1, 22, "c", "c"), (1, 23, "z", "")], "doc_id long, note_id long, marker string, scope_key string")
    chain = [("page", lambda r: visuals._with_page_note(r, foot).select(*refs.columns, F.col("_page_note").alias("note_id"))), ("chapter", lambda r: visuals._with_end_note(r, end, True, "note_id")), ("book", lambda r: visuals._with_end_note(r, end, False, "note_id"))]
    found = workflow.first_of(refs, chain, refs.columns)
    assert "Join" not in plan(found)  # a join and an aggregate for each strategy
    assert found.schema["page"].dataType == refs.schema["page"].dataType
    assert {tuple(r)[1:2] + tuple(r)[5:] for r in found.collect()} == {(1, 10, "page"), (2, 20, "book"), (3, 11, "page"), (4, None, None), (5, 23, "book")} and found.count() == 5


def many(spark, n, *columns):
    path = f"{spark.sparkContext.getConf().get('spark.checkpoint.dir')}/many-{n}-{len(columns)}"
    spark.range(n).selectExpr("id div 10 AS doc_id", *columns).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_tasks_grow_with_the_files(spark, monkeypatch):
    rows = many(spark, 20_000, "concat('x', id) AS key", "id % 7 AS n")
    monkeypatch.setattr(folds, "TASK_BYTES", 20_000)
    few = folds.tasks(rows.limit(1))
    assert few > 4 and folds.tasks(rows, rows) >= 2 * few - 1 and folds.tasks(rows.union(rows)) >= 2 * few - 1 and folds.tasks(spark.range(5)) >= 1
    u = rows.select("doc_id", F.col("key").alias("unit_id"), "n")
    book = graph.records(rows.selectExpr("doc_id", "n AS ord", "key AS unit_id", "'p' AS unit_type", "key AS text", "1 AS page", "array(1D) AS bbox"))
    for made in (constraints.unique(rows, "key"), constraints.references(rows, "key", rows, "key"), constraints.same_set(rows, rows, "key"), constraints.graph(book["nodes"], book["edges"], book["evidence"]), contracts.section_links(u.withColumn("section_id", F.lit("s")), u, u.withColumn("section_id", F.lit("s")))):
        assert "Join" not in plan(made) and made.rdd.getNumPartitions() >= few  # else as many tasks as the session has, however large the input
        assert made.count() == 0


def test_notes_are_joined_once(spark, monkeypatch):
    rows = many(spark, 20_000, "concat('x', id) AS key", "id", "id % 3 AS page")
    monkeypatch.setattr(folds, "TASK_BYTES", 20_000)
    both = rows.selectExpr("doc_id", "key AS reference_id", "key AS definition_id", "'s' AS system_id", "if(id = 7, 'o', 'm') AS marker", "'c' AS section_id", "page")
    made = contracts.note_resolution(both.selectExpr("doc_id", "reference_id", "'x7' AS definition_id", "'page' AS scope").where("doc_id = 0"), both.where("doc_id > 0"), both, both)
    assert plan(made).count("SortMergeJoin") + plan(made).count("HashJoin") <= 2  # one pass over relations and their notes, not one for each rule
    assert made.groupBy("rule").count().orderBy("rule").collect() == [("marker", 9), ("scope", 7)]


def test_section_map_is_dealt(spark, monkeypatch):
    rows = many(spark, 20_000, "concat('x', id) AS key", "id", "id % 3 AS page")
    monkeypatch.setattr(folds, "TASK_BYTES", 20_000)
    sections = rows.selectExpr("doc_id", "key AS section_id", "id AS ord", "if(id % 10 = 0, NULL, concat('x', id - id % 10)) AS parent_id", "page AS first", "if(id = 13, 2, page) AS last")
    made = contracts.section_map(sections, sections.where("ord <> 15"), sections.selectExpr("doc_id", "explode(array(0, 1, 2)) AS page"))
    assert plan(made).count("REPARTITION_BY_NUM") >= 5 and plan(made).count("Join") <= 1
    assert made.where("rule = 'evidence'").collect() == [(1, "evidence", "x15")] and made.where("rule = 'reference:parent_id'").count() == 0


def test_surplus_of_either_side(spark):
    rows = lambda *x: spark.createDataFrame(list(x), "doc_id long, key string")
    known = rows((1, "a"), (1, "a"), (1, "b"), (1, "d"), (1, None), (None, "n"), (2, "a"))
    placed = rows((1, "a"), (1, "b"), (1, "b"), (1, "b"), (1, "c"), (None, "n"), (None, None))
    got = sorted(map(tuple, constraints.same_set(known, placed, "key").collect()), key=str)
    assert got == sorted([(1, "missing:key", "a"), (1, "extra:key", "b"), (1, "extra:key", "b"), (1, "missing:key", "d"), (1, "missing:key", None), (1, "extra:key", "c"), (None, "extra:key", None), (2, "missing:key", "a")], key=str)
    assert sorted(map(tuple, constraints.unique(placed.union(placed), "key").where("doc_id IS NOT NULL").collect())) == [(1, "unique:key", x) for x in "abc"]
    assert sorted(map(tuple, constraints.references(known, "key", placed, "key").collect()), key=str) == [(1, "reference:key", "d"), (2, "reference:key", "a"), (None, "reference:key", "n")]


def test_book_is_made_once(spark):
    units = spark.createDataFrame([(1, 1, "u1", "paragraph", "said", 1, [1], None, None), (1, 2, "u2", "footnote", "1. foot", 1, [1], None, None), (1, 3, "u3", "heading", "Notes", 2, [2], None, None), (1, 4, "u4", "paragraph", "2. end", 2, [2], None, None)], "doc_id long, ord long, unit_id string, unit_type string, text string, page long, pages array<long>, bbox array<double>, marker string")
    roles = spark.createDataFrame([(1, 1, "text_flow_page")], "doc_id long, page long, page_role string")
    review = spark.createDataFrame([(1, 1, "include"), (1, 2, "include")], "doc_id long, page long, action string")
    refs = spark.createDataFrame([(1, "u1", 7, "1"), (1, "u1", 8, "2"), (1, "u1", 9, "3")], "doc_id long, unit_id string, ref_id long, marker string")
    b = graph.book(units, roles, review, refs)
    assert "Window" not in plan(b["edges"]) and "Window" not in plan(b["references"])  # the units' passes for every reader of the nodes
    assert [(r["ref_id"], r["note_id"], r["placement"]) for r in b["references"].orderBy("ref_id").collect()] == [(7, "n000002", "page_foot"), (8, "n000004", "note_section"), (9, None, None)]
    assert b["edges"].where("edge_type = 'references_note'").count() == 2 and b["edges"].count() == 6
    slim = notes.resolve_on_page(refs.selectExpr("doc_id", "ref_id", "1L AS page", "marker"), spark.createDataFrame([(1, 5, 1, "1")], "doc_id long, note_id long, page long, marker string"))
    assert {(r["ref_id"], r["marker"], r["status"]) for r in slim.collect()} == {(7, "1", "resolved"), (8, "2", "unresolved"), (9, "3", "unresolved")}
