"""Stages over tables: what each needs and gives, checks, resumable storage, readers by name (K2, K7, K12, P4, X-1 to X-8, Z1).

A stage is a function from named tables to one table, with a check that gives a table
of violations. ``run`` resolves the stages' order from their inputs, checks every
output before another stage sees it, and keeps it in a store if there is one, so
that a later run goes on where an earlier one stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from importlib import metadata
from typing import Protocol, runtime_checkable

from pyspark.sql import DataFrame, SparkSession

from quire.operators.constraints import canonical, gate


@dataclass(frozen=True)
class Stage:
    """``check`` gets the output and gives its violations; none means that it may not be broken."""

    name: str
    inputs: tuple[str, ...]
    output: str
    run: Callable[..., DataFrame]
    check: Callable[[DataFrame], DataFrame] | None = None


class Store(Protocol):
    """Where tables lie between runs (K12, X-6)."""

    def has(self, name: str) -> bool: ...

    def load(self, name: str) -> DataFrame: ...

    def save(self, name: str, table: DataFrame) -> None: ...


@dataclass
class ParquetStore:
    """Tables as Parquet below one folder, which driver and executors share; a table counts once it is wholly written (K7)."""

    spark: SparkSession
    folder: str

    def _path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"

    def has(self, name: str) -> bool:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._path(name) + "/_SUCCESS")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def load(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self._path(name))

    def save(self, name: str, table: DataFrame) -> None:
        table.write.mode("overwrite").parquet(self._path(name))


def run(given: Mapping[str, DataFrame], stages: Iterable[Stage], store: Store | None = None, done: Callable[[str, DataFrame], None] | None = None) -> dict[str, DataFrame]:
    """All tables by name (X-4, X-7). Stages may be listed in any order; inputs that nothing gives raise ValueError."""
    tables, waiting = dict(given), list(stages)
    while waiting:
        ready = [s for s in waiting if set(s.inputs) <= tables.keys()]
        if not ready:
            raise ValueError("inputs that no stage gives: " + "; ".join(f"{s.name} needs {', '.join(sorted(set(s.inputs) - tables.keys()))}" for s in waiting))
        for stage in ready:
            kept = store is not None and store.has(stage.output)
            out = store.load(stage.output) if kept else stage.run(**{n: tables[n] for n in stage.inputs})
            if stage.check:
                gate(stage.check(out))
            if store is not None and not kept:
                store.save(stage.output, out)
                out = store.load(stage.output)
            tables[stage.output] = out
            if done:
                done(stage.output, out)
            waiting.remove(stage)
    return tables


def write_canonical(blocks: DataFrame, path: str) -> None:
    """Blocks that keep their contract, as JSON lines; others raise and nothing is written (K2)."""
    gate(canonical(blocks))
    blocks.write.mode("errorifexists").json(path)


# Readers by name


@dataclass(frozen=True)
class Request:
    """What to read and how (X-1)."""

    path: str
    language: str = "zh-CN"
    options: Mapping[str, str] = field(default_factory=dict)


@runtime_checkable
class Reader(Protocol):
    name: str

    def read(self, spark: SparkSession, request: Request) -> DataFrame: ...


class Readers:
    """Readers by name, one's own and those that installed packages offer (X-2, X-3)."""

    def __init__(self, group: str = "quire.readers") -> None:
        self.group, self._known, self._offered = group, {}, False

    def register(self, reader: Reader, replace: bool = False) -> None:
        name = reader.name.strip().lower()
        if not name:
            raise ValueError("a reader needs a name")
        if name in self._known and not replace:
            raise ValueError(f"there is a reader {name}")
        self._known[name] = reader

    def _discover(self) -> None:
        if self._offered:
            return
        for point in metadata.entry_points(group=self.group):
            found = point.load()
            reader = found() if isinstance(found, type) else found
            if not isinstance(reader, Reader):
                raise TypeError(f"{point.name} is no reader")
            if reader.name.strip().lower() != point.name.strip().lower():
                raise ValueError(f"{point.name} gives a reader called {reader.name}")
            self.register(reader, replace=True)
        self._offered = True

    def names(self) -> list[str]:
        self._discover()
        return sorted(self._known)

    def read(self, spark: SparkSession, request: Request, name: str) -> DataFrame:
        """The reader's blocks, once they keep their contract."""
        self._discover()
        if (reader := self._known.get(name.strip().lower())) is None:
            raise LookupError(f"no reader {name}; known: {', '.join(self.names()) or 'none'}")
        blocks = reader.read(spark, request)
        gate(canonical(blocks))
        return blocks


#: A note strategy gives references their note_id; the first in the list that does decides (X-8).
Strategy = tuple[str, Callable[[DataFrame], DataFrame]]


def first_of(refs: DataFrame, strategies: list[Strategy], keys: list[str]) -> DataFrame:
    """keys, note_id and strategy: each reference by the first strategy that finds it a note (X-8).

    What repeats is one row; of several notes of one strategy the smallest counts. All that was found is sorted by the
    keys once, so that a strategy costs no join.
    """
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from quire.operators.folds import dealt

    rows = refs.select(*keys, F.lit(-1).alias("_by"), F.lit(None).alias("note_id"))
    for i, (_, find) in enumerate(strategies):
        rows = rows.union(find(refs).where("note_id IS NOT NULL").select(*keys, F.lit(i), "note_id"))
    w = Window.partitionBy(*keys).orderBy("_by", "note_id")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = lambda c: F.first(F.when(F.col("_by") >= 0, F.col(c)), ignorenulls=True).over(whole)
    out = dealt(rows, *keys).withColumns({"_at": F.row_number().over(w), "_note": found("note_id"), "_which": found("_by")})
    out = out.where("_by = -1 AND _at = 1")  # a key that only a strategy has is no reference
    name = F.coalesce(*[F.when(F.col("_which") == i, n) for i, (n, _) in enumerate(strategies)])
    return out.select(*keys, F.col("_note").alias("note_id"), name.alias("strategy"))
