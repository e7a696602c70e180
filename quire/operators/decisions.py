"""The boundary to models: requests and answers as tables (C31, L1, L2, L4, L5, L7-L9, O7, J23, X-5, Z20-Z22).

The library calls no model. A caller gives ``send``, a function from a list of request
texts to a list of answers; it runs in the executors on batches of bounded size, a
failure is an answer of its own, and answers are checked like any other table.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as t

from quire.operators.constraints import every, same_set, where

BATCH = 32
# Choices of a page's review.
ROLES = ("text_flow_page", "visual_page")
ACTIONS = ("include", "metadata_only", "exclude")
CONFIDENCES = ("high", "medium", "low")


def json_in(text: str | None) -> str | None:
    """The first JSON object, else list, in a model's text, as JSON; null if there is none."""
    for opening in "{[":
        at = (text or "").find(opening)
        while at >= 0:
            try:
                return json.dumps(json.JSONDecoder().raw_decode(text, at)[0], ensure_ascii=False)
            except ValueError:
                at = text.find(opening, at + 1)
    return None


@F.pandas_udf(t.StringType())
def json_in_udf(text: pd.Series) -> pd.Series:
    return text.map(json_in)


def ask(requests: DataFrame, send: Callable[[list[str]], list[str]], batch: int = BATCH) -> DataFrame:
    """``requests`` (doc_id, request_id, request) with answer and error, asked in batches (L1, L2, X-5).

    ``send`` may be called again for the same rows when an executor is lost; store the result before it is used twice.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for at in range(0, len(pdf), batch):
                part = pdf.iloc[at : at + batch].copy()
                try:
                    answers = send(part["request"].tolist())
                    if len(answers) != len(part):
                        raise ValueError(f"{len(answers)} answers to {len(part)} requests")
                    part["answer"], part["error"] = answers, None
                except Exception as failed:  # a model out of reach is a row's state, not the job's end
                    part["answer"], part["error"] = None, f"{type(failed).__name__}: {failed}"
                yield part

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in requests.schema)
    return requests.mapInPandas(run, f"{kinds}, answer string, error string")


def embeddings(rows: DataFrame, send: Callable[[list[str]], list[str]], batch: int = BATCH) -> DataFrame:
    """``rows`` (doc_id, request_id, request) with embedding: answers are JSON lists of numbers."""
    return ask(rows, send, batch).withColumn("embedding", F.from_json("answer", "array<double>")).drop("answer")


def page_requests(pages: DataFrame, observations: DataFrame) -> DataFrame:
    """doc_id, request_id (page) and request, a JSON text of the page's observations in order."""
    o = observations.groupBy("doc_id", "page").agg(F.sort_array(F.collect_list(F.struct("ord", "observation_id", "kind", "text"))).alias("observations"))
    r = pages.select("doc_id", "page").join(o, ["doc_id", "page"], "left")
    body = F.struct("page", F.coalesce("observations", F.array().cast("array<struct<ord:bigint,observation_id:string,kind:string,text:string>>")).alias("observations"))
    return r.select("doc_id", F.col("page").alias("request_id"), F.to_json(body).alias("request"))


def page_decisions(answers: DataFrame) -> DataFrame:
    """doc_id, page, page_role, action, confidence of answers that hold a JSON object with them."""
    a = F.from_json(json_in_udf("answer"), "page_role string, action string, confidence string")
    return answers.select("doc_id", F.col("request_id").alias("page"), a.alias("a")).select("doc_id", "page", "a.*")


def decision_violations(decisions: DataFrame, candidates: DataFrame) -> DataFrame:
    """One decision a candidate page, of known choices."""
    odd = lambda c, values: where(decisions, f"domain:{c}", ~F.coalesce(F.col(c).isin(*values), F.lit(False)), F.col("page"))
    return every([same_set(candidates, decisions, "page"), odd("page_role", ROLES), odd("action", ACTIONS), odd("confidence", CONFIDENCES)])
