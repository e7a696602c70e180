"""Tables that cut lineage, in the folder that the cluster shares.

``spark.checkpoint.dir`` names that folder. Where it is unset, a local session
uses a folder under its warehouse directory; any other raises, as executors
could not read each other's files. What is written here survives the loss of any
executor. Every application has a folder of its own; ``scratch`` deletes the
tables of a block of code when it ends, ``discard`` single ones and ``release``
all of this application.
"""

from __future__ import annotations

import contextvars
import uuid
import weakref
from types import TracebackType

from pyspark.sql import DataFrame, SparkSession

_FOLDER = "quire-stages"
_paths: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
_open: contextvars.ContextVar[scratch | None] = contextvars.ContextVar("quire_scratch", default=None)


def shared_folder(spark: SparkSession) -> str:
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"
    return f"{base.rstrip('/')}/{_FOLDER}/{spark.sparkContext.applicationId}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[out] = path
    if (block := _open.get()) is not None:
        block.made.append((spark, path))
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialise`` returned; nothing may read them any more."""
    for df in tables:
        if path := _paths.pop(df, None):
            _delete(df.sparkSession, path)


class scratch:
    """A block whose tables are deleted at its end, but for those passed to ``keep``."""

    def __enter__(self) -> scratch:
        self.made: list[tuple[SparkSession, str]] = []
        self.kept: set[str] = set()
        self.outer = _open.get()
        self.token = _open.set(self)
        return self

    def keep(self, df: DataFrame) -> DataFrame:
        self.kept.add(_paths[df])
        return df

    def __exit__(self, kind: type[BaseException] | None, value: BaseException | None, trace: TracebackType | None) -> None:
        _open.reset(self.token)
        for spark, path in self.made:
            if path not in self.kept:
                _delete(spark, path)
            elif self.outer is not None:
                self.outer.made.append((spark, path))


def release(spark: SparkSession) -> None:
    """Delete every stage table of this application; call it when a job's results are written."""
    _delete(spark, shared_folder(spark))
