"""Stages, stores, readers and the boundary to models."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quire import workflow as W
from quire.operators import constraints, decisions, tables, visuals
from quire.functions import extraction

BLOCKS = "doc_id long, block_id string, type string, text string, level int"


def test_stages_run_by_their_inputs_and_go_on(spark, tmp_path):
    ran = []

    def step(name, f):
        def run(**inputs):
            ran.append(name)
            return f(**inputs)

        return run

    numbers = spark.range(5).select(F.col("id").alias("doc_id"))
    twice = W.Stage("twice", ("plus",), "twice", step("twice", lambda plus: plus.select("doc_id", (F.col("v") * 2).alias("w"))))
    plus = W.Stage("plus", ("numbers",), "plus", step("plus", lambda numbers: numbers.select("doc_id", (F.col("doc_id") + 1).alias("v"))), lambda t: constraints.unique(t, "v"))
    store, seen = W.ParquetStore(spark, f"file://{tmp_path}/store"), []
    out = W.run({"numbers": numbers}, [twice, plus], store, lambda name, _: seen.append(name))
    assert sorted(r["w"] for r in out["twice"].collect()) == [2, 4, 6, 8, 10] and ran == seen == ["plus", "twice"]
    again = W.run({"numbers": numbers}, [twice, plus], store)
    assert again["twice"].count() == 5 and ran == ["plus", "twice"]
    with pytest.raises(ValueError, match="twice needs plus"):
        W.run({"numbers": numbers}, [twice])
    broken = W.Stage("bad", ("numbers",), "bad", lambda numbers: numbers.withColumn("v", F.lit(1)).union(numbers.withColumn("v", F.lit(1))), lambda t: constraints.unique(t, "v"))
    with pytest.raises(ValueError, match="unique:v"):
        W.run({"numbers": numbers}, [broken])


def test_readers(spark, tmp_path):
    class Lines:
        name = "Lines"

        def read(self, spark, request):
            bad = request.options.get("bad")
            return spark.createDataFrame([(1, "b1", "odd" if bad else "paragraph", request.path, None)], BLOCKS)

    readers = W.Readers("no.such.group")
    readers.register(Lines())
    assert readers.names() == ["lines"] and readers.read(spark, W.Request("x"), " LINES ").first()["text"] == "x"
    with pytest.raises(ValueError, match="there is a reader"):
        readers.register(Lines())
    with pytest.raises(LookupError, match="known: lines"):
        readers.read(spark, W.Request("x"), "other")
    with pytest.raises(ValueError, match="domain:type"):
        readers.read(spark, W.Request("x", options={"bad": "1"}), "lines")
    blocks = spark.createDataFrame([(1, "b1", "paragraph", "t", None)], BLOCKS)
    W.write_canonical(blocks, f"file://{tmp_path}/out")
    assert spark.read.schema(BLOCKS).json(f"file://{tmp_path}/out").count() == 1
    with pytest.raises(ValueError, match="unique:block_id"):
        W.write_canonical(blocks.union(blocks), f"file://{tmp_path}/other")


def test_answers(spark):
    rows = spark.createDataFrame([(1, i, str(i)) for i in range(70)], "doc_id long, request_id long, request string").coalesce(1)

    def send(texts):
        if "40" in texts:
            raise TimeoutError("late")
        return [f"[{x}.5]" for x in texts]

    got = decisions.embeddings(rows, send).collect()
    late = {r["request_id"] for r in got if r["error"]}
    assert late == set(range(32, 64)) and {r["error"] for r in got if r["error"]} == {"TimeoutError: late"}
    assert {r["request_id"]: r["embedding"] for r in got if not r["error"]} == {i: [i + 0.5] for i in range(70) if i not in late}
    assert decisions.json_in('x {"a": [1, {"b": "}"}]} y') == '{"a": [1, {"b": "}"}]}' and decisions.json_in("{no [1, 2] x") == "[1, 2]" and decisions.json_in(None) is None


def test_odd_rows(spark):
    obs = "doc_id long, ord long, page long, observation_id string, html string"
    empty = spark.createDataFrame([], obs)
    captions = spark.createDataFrame([], "doc_id long, parent_id string, observation_id string, ord long")
    review = spark.createDataFrame([(1, 1, "include"), (1, 2, "include")], "doc_id long, page long, action string")
    assert tables.table_flow(empty, captions, review).count() == 0
    got = tables.table_flow(spark.createDataFrame([(1, 1, 1, "a", "<t/>"), (1, 2, 2, "b", ""), (1, 3, 3, "c", ""), (1, 4, 4, "d", None), (1, 5, 5, "e", "")], obs), captions, review).orderBy("first_ord").collect()
    assert [(r["status"], r["reason"], r["observation_ids"]) for r in got] == [("unresolved", "page_review_splits_table_candidate", ["a", "b", "c"]), ("excluded", "excluded_by_page_review", ["d"]), ("excluded", "excluded_by_page_review", ["e"])]
    text = spark.createDataFrame([(None,), ("",), ("x" * 50_000 + "。 7",)], "t string").select(extraction.trailing_note(F.col("t")).alias("s")).select("s.*").collect()
    assert [(len(r["body"] or ""), r["marker"]) for r in text] == [(0, None), (0, None), (50_001, "7")]
    assert extraction.runs_of("{broken") == [] and extraction.runs_of(None) == []
    refs = spark.createDataFrame([], "doc_id long, ref_id long, page long, marker string, scope_key string")
    notes = spark.createDataFrame([], "doc_id long, note_id long, page long, marker string, scope_key string")
    assert visuals.resolve_in_order(refs, notes, notes).count() == 0
