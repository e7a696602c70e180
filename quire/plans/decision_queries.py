"""Queries of the boundary to models, with answers made from the requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire import workflow
from quire.operators import decisions as M
from quire.operators import visuals as V
from quire.plans import derived as D
from quire.plans.extraction_queries import _NOTES, _strategies
from quire.plans.functions_queries import query
from quire.sources import folders


def _said(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.expr("""CASE n % 5 WHEN 0 THEN concat('Sure: {"page_role": "text_flow_page", "action": "include", "confidence": "high", "n": ', n, '} done') WHEN 1 THEN '```json\n{"page_role": "visual_page", "action": "drop", "confidence": "low"}\n```' WHEN 2 THEN 'no answer' WHEN 3 THEN concat('[', n, ', {]') ELSE '{bad {"action": "exclude"}' END""")
    return D.lines(spark, sf_dir).select("doc_id", F.col("ord").alias("request_id"), "n", text.alias("answer"))


_D = """d AS (SELECT doc_id, ord AS page, CASE n % 5 WHEN 0 THEN 'text_flow_page' WHEN 1 THEN 'visual_page' END AS page_role, CASE n % 5 WHEN 0 THEN 'include' WHEN 1 THEN 'drop' WHEN 4 THEN 'exclude' END AS action, CASE n % 5 WHEN 0 THEN 'high' WHEN 1 THEN 'low' END AS confidence, n FROM l)"""


@query(f"WITH {D.LINES}, {_D} SELECT doc_id, page, page_role, action, confidence FROM d")
def model_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Choices read out of a model's text."""
    return M.page_decisions(_said(spark, sf_dir))


@query(f"""WITH {D.LINES}, {_D} SELECT doc_id, 'missing:page' AS rule, page::VARCHAR AS detail FROM d WHERE n % 7 = 0 UNION ALL SELECT doc_id, 'domain:page_role', page::VARCHAR FROM d WHERE n % 7 > 0 AND page_role IS NULL UNION ALL SELECT doc_id, 'domain:action', page::VARCHAR FROM d WHERE n % 7 > 0 AND coalesce(action, 'drop') = 'drop' UNION ALL SELECT doc_id, 'domain:confidence', page::VARCHAR FROM d WHERE n % 7 > 0 AND confidence IS NULL""")
def decision_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L5."""
    said = _said(spark, sf_dir)
    return M.decision_violations(M.page_decisions(said.where("n % 7 > 0")), said.select("doc_id", F.col("request_id").alias("page")))


@query(f"WITH {D.LINES} SELECT doc_id, ord AS request_id, [length(line)::DOUBLE, (ord % 7)::DOUBLE] AS embedding, NULL::VARCHAR AS error FROM l")
def batched_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors by batches of a caller's function."""
    r = D.lines(spark, sf_dir).select("doc_id", F.col("ord").alias("request_id"), F.concat_ws(":", "n", F.col("ord") % 7).alias("request"))

    def send(texts: list[str]) -> list[str]:
        return [f"[{x.split(':')[0]}.0, {x.split(':')[1]}.0]" for x in texts]

    return M.embeddings(r, send).select("doc_id", "request_id", "embedding", "error")


@query(f"WITH {D.OBSERVATIONS} SELECT doc_id, page AS request_id, count(*)::INT AS n_observations, min('o' || ord) AS first_id FROM o GROUP BY doc_id, page")
def page_review_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's request holds its observations."""
    o = D.observations(spark, sf_dir).select("doc_id", "page", "ord", F.concat(F.lit("o"), "ord").alias("observation_id"), "kind", F.col("line").alias("text"))
    r = M.page_requests(o.select("doc_id", "page").distinct(), o)
    ids = F.from_json("request", "observations array<struct<observation_id: string>>")["observations"]["observation_id"]
    return r.select("doc_id", "request_id", F.size(ids).alias("n_observations"), F.array_min(ids).alias("first_id"))


@query(f"WITH {_NOTES} SELECT DISTINCT pg.doc_id, pg.ref_id, pg.page, pg.marker, pg.scope_key, coalesce(note_id, c, b) AS note_id, CASE WHEN note_id IS NOT NULL THEN 'page' WHEN c IS NOT NULL THEN 'chapter' WHEN b IS NOT NULL THEN 'book' END AS strategy FROM pg LEFT JOIN sc USING (doc_id, scope_key, marker) LEFT JOIN bo USING (doc_id, marker)")
def strategy_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X-8, X-4: stages that resolve notes by a list of strategies, through a store."""
    refs, page, end = _strategies(spark, sf_dir)
    keys = ["doc_id", "ref_id", "page", "marker", "scope_key"]

    def by_page(r: DataFrame) -> DataFrame:
        return V._with_page_note(r, page).select(*keys, F.col("_page_note").alias("note_id"))

    def by_end(scoped: bool):
        return lambda r: V._with_end_note(r, end, scoped, "note_id").select(*keys, "note_id")

    def link(r: DataFrame) -> DataFrame:
        # Strategies see all references; repeated ones are one row of the result.
        return workflow.first_of(r, [("page", by_page), ("chapter", by_end(True)), ("book", by_end(False))], keys)

    stage = workflow.Stage("link", ("refs",), "links", lambda refs: link(refs))
    return workflow.run({"refs": refs}, [stage], workflow.ParquetStore(spark, folders.work_folder(spark, "stages")))["links"]
