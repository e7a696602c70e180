"""Exact dense search by inner product."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.sources.folders import stored

# Rows of a block, blocks of a partition, queries scored at a time.
MOST_ROWS, PART_BLOCKS, MOST_SCORED = 4096, 2, 128


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def top_k(vectors: DataFrame, query: list[float], k: int) -> DataFrame:
    """rank, vector_id and score of the k best rows of (vector_id, embedding); ties to the smaller id."""
    scored = vectors.select("vector_id", dot(F.col("embedding"), F.array(*[F.lit(float(x)) for x in query])).alias("score"))
    best = scored.orderBy(F.desc("score"), "vector_id").limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), "vector_id")))


def _blocks(rows: DataFrame, most: int) -> DataFrame:
    """Rows of (id, vector) as blocks of at most ``most``: ids, lengths (-1 for a null or a null within) and padded doubles."""
    kind = rows.schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                part = batch.slice(at, most)
                found = [None if v is None or None in v else np.array(v, np.float64) for v in part.column(1).to_pylist()]
                lengths = np.array([-1 if v is None else len(v) for v in found], np.int64)
                data = np.zeros((len(found), max(lengths.max(), 0)))
                for row, v in zip(data, found, strict=True):
                    if v is not None:
                        row[: len(v)] = v
                yield pa.RecordBatch.from_pylist([{"ids": part.column(0).to_pylist(), "lengths": lengths.tolist(), "data": data.tobytes()}], schema=pa.schema([("ids", pa.list_(part.schema.field(0).type)), ("lengths", pa.list_(pa.int64())), ("data", pa.binary())]))

    # Pairs of blocks go to a task in one Arrow batch, so a partition has few blocks, however many rows there are.
    parts = max(1, -(-rows.count() // (most * PART_BLOCKS)))
    return rows.repartition(parts).mapInArrow(run, f"ids array<{kind}>, lengths array<long>, data binary")


def _best(ids: np.ndarray, score: np.ndarray, valid: np.ndarray, k: int) -> np.ndarray:
    """Mask of the k best of each row of scores: NaN first as Spark orders it, invalid last, ties to the smaller id."""
    order = np.argsort(ids, kind="stable")
    key = np.where(valid, np.where(np.isnan(score), np.inf, score), -np.inf)[:, order]
    if key.shape[1] <= k:
        return np.ones_like(valid)
    kth = np.partition(key, -k, axis=1)[:, -k, None]
    above, equal = key > kth, key == kth
    out = np.zeros_like(valid)
    out[:, order] = above | (equal & (np.cumsum(equal, axis=1) <= k - above.sum(1, keepdims=True)))
    return out


def top_k_batch(vectors: DataFrame, queries: DataFrame, k: int, most_queries: int = 1000) -> DataFrame:
    """The k best rows for each (query_id, query); a stated query set of any size against all rows.

    Blocks of at most ``most_queries`` queries meet blocks of rows, and only the k
    best of each pair of blocks go on; a task has the pairs of a few blocks. Products are
    summed in the order of ``dot``. Rows and queries are counted first.
    """
    q = queries.where(F.col("query").isNotNull()).select("query_id", "query")
    left = _blocks(vectors.select("vector_id", "embedding"), MOST_ROWS)
    right = _blocks(q, most_queries).select(*[F.col(c).alias(f"q_{c}") for c in ("ids", "lengths", "data")])
    kinds = queries.schema["query_id"].dataType.simpleString(), vectors.schema["vector_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pair in range(batch.num_rows):
                ids, lengths, data, q_ids, q_lengths, q_data = (c[pair].values.to_numpy(zero_copy_only=False) if i % 3 < 2 else np.frombuffer(c[pair].as_py()) for i, c in enumerate(batch.columns))
                data, q_data = data.reshape(len(ids), -1), q_data.reshape(len(q_ids), -1)
                for at in range(0, len(q_ids), MOST_SCORED):
                    part = slice(at, at + MOST_SCORED)
                    valid = (q_lengths[part, None] == lengths) & (lengths >= 0)
                    score = np.zeros(valid.shape)
                    for x, y in zip(q_data[part].T, data.T, strict=False):
                        score += x[:, None] * y
                    a, b = np.nonzero(_best(ids, score, valid, k))
                    columns = [pa.array(q_ids[part][a]), pa.array(ids[b]), pa.array(score[a, b], mask=~valid[a, b])]
                    yield pa.RecordBatch.from_arrays(columns, ["query_id", "vector_id", "score"])

    pairs = left.crossJoin(right.hint("shuffle_replicate_nl")).mapInArrow(run, f"query_id {kinds[0]}, vector_id {kinds[1]}, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vector_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k)


def docstore(rows: DataFrame, order: Column) -> DataFrame:
    """Rows with contiguous ``vector_id`` from 0 in the given order, without one task for all.

    Rows are range-partitioned and written once, so that each keeps the partition it was counted in; a
    partition's offset is the count of those before it.
    """
    ranged = stored(rows.repartitionByRange(order).withColumn("_p", F.spark_partition_id()), "docstore")
    counts = ranged.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("_p", before.alias("_before"))  # one row a partition
    place = F.row_number().over(Window.partitionBy("_p").orderBy(order))
    return ranged.withColumn("_r", place).join(F.broadcast(offsets), "_p").withColumn("vector_id", F.col("_before") + F.col("_r") - 1).drop("_p", "_r", "_before")
