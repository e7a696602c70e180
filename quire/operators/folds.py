"""Passes over a document's rows in order, linear in them, where each row depends on all before.

Rows come sorted by document and are read as they stream in, so that a task holds
one batch and one document, and a document costs no call of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as t
from pyspark.sql.pandas.types import to_arrow_schema

# Rows read and given out at a time; bytes of input files behind a task of ``dealt``.
MOST_ROWS = 2048
TASK_BYTES = 16 << 20


def tasks(*tables: DataFrame) -> int:
    """How many tasks the bytes of the files behind ``tables`` ask for.

    Every branch of a union counts its files; a file read twice within a branch counts once.
    """
    branches, size = [x._jdf.queryExecution().analyzed() for x in tables], 0
    while branches:
        branch = branches.pop()
        if branch.nodeName() == "Union":
            branches += [branch.children().apply(i) for i in range(branch.children().size())]
            continue
        leaves = branch.collectLeaves()
        found = {int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())}
        size += sum(x for x in found if x < 1 << 60)  # rows without files have no known size
    return max(tables[0].sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES))


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` dealt by ``keys`` into as many ``tasks`` as their files ask for.

    Ids pack so well that a task of the usual size in bytes holds millions of rows, and more the larger the input; a
    task of these holds the same however large it is.
    """
    return rows.repartition(tasks(rows), *keys)


def joined(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Both sides dealt alike by the keys of their join, as ``dealt`` deals rows."""
    n = tasks(left, right)
    return left.repartition(n, *keys).join(right.repartition(n, *keys), keys, how)


def _documents(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[list[list]]:
    """Columns of each document of sorted batches, as lists; documents may lie across batches."""
    key, held = None, []
    for batch in batches:
        for at in range(0, batch.num_rows, MOST_ROWS):
            columns = [c.to_pylist() for c in batch.slice(at, MOST_ROWS).columns]
            keys = list(zip(*columns[:n_keys], strict=True))
            ends = [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]]
            for first, end in zip([0, *ends], [*ends, len(keys)], strict=True):
                part = [c[first:end] for c in columns]
                if held and keys[first] == key:
                    for column, more in zip(held, part, strict=True):
                        column += more
                    continue
                if held:
                    yield held
                key, held = keys[first], part
    if held:
        yield held


def by_document(rows: DataFrame, order: list[str | Column], run: Callable[..., tuple[list, ...]], schema: str, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``run`` of each document's columns, lists in order, gives the columns of its rows of ``schema``."""
    arrow = to_arrow_schema(t.StructType.fromDDL(schema))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[list] = [[] for _ in arrow]
        batch = lambda: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(made, arrow, strict=True)], schema=arrow)
        for document in _documents(batches, len(keys)):
            for column, more in zip(made, run(*document), strict=True):
                column += more
            if len(made[0]) >= MOST_ROWS:
                yield batch()
                made = [[] for _ in arrow]
        if made[0]:
            yield batch()

    first = [k for k in rows.columns if k in keys]
    rows = rows.select(*first, *[c for c in rows.columns if c not in keys])
    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(stream, schema)


def along(rows: DataFrame, order: str, inputs: list[str], run: Callable[..., list], kind: str, name: str, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(keys, order, name): ``run`` of the arrays ``inputs`` gives ``name`` for each row of a document, in order.

    Rows with equal ``order`` are taken by their other columns. Null arrays don't occur; nulls in them are None.
    """
    slim = rows.select(*keys, rows[order].alias("_at"), *[rows[c].alias(f"_c{i}") for i, c in enumerate(inputs)])
    kinds = [f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in (*keys, order)]

    def one(*columns: list) -> tuple[list, ...]:
        return *columns[: len(keys) + 1], run(*[[None if v != v else v for v in c] for c in columns[len(keys) + 1 :]])

    return by_document(slim, ["_at", *[f"_c{i}" for i in range(len(inputs))]], one, f"{', '.join(kinds)}, `{name}` {kind}", keys)
