"""What several training-data operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import lru_cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import configure, shared_folder

#: Largest side, in bytes as measured, that a join may broadcast.
BROADCAST_BYTES = 32 << 20
#: The letters whose case counts as the same.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the library; Python workers that run on this machine
    find the package where the driver found it."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    # Rows may be long: batches for Python stay small.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return configure(spark)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the folder that all executors share."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read again: cuts the lineage,
    and a lost executor loses none of it."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def workspace(spark: SparkSession, name: str) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A function like ``stored`` for intermediate tables, whose files go at the end.
    What is to last must be stored outside, before the end."""
    folder = scratch(spark, name)

    def put(df: DataFrame, table: str) -> DataFrame:
        path = f"{folder}/{table}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        yield put
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of ``df`` has, in whatever letter case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_of(column: str | Column = "text") -> Column:
    """The whole text; NULL counts as empty."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Marks ``df``, which should be stored, for broadcast if its counted rows
    fit the limit; otherwise the join shuffles."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


#: How to give up what this worker keeps for later tasks.
GIVE_UP: list[Callable[[], None]] = []


def kept(make: Callable) -> Callable:
    """What ``make`` gives is kept by the worker until a task hands memory back."""
    found = lru_cache(maxsize=2)(make)
    GIVE_UP.append(found.cache_clear)
    return found


def hand_back() -> None:
    """Returns memory that a finished task has freed to the system, and what other
    operators have kept. Workers live on for other tasks, and what they hold counts
    against the executor."""
    import ctypes
    import gc

    import pyarrow

    for give_up in GIVE_UP:
        give_up()
    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


@contextmanager
def settings(spark: SparkSession, **values: str):
    """Session settings for a while. Keys are given with ``__`` for dots."""
    values = {key.replace("__", "."): value for key, value in values.items()}
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
