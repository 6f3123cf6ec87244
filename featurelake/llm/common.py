"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelake.session import fresh_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Bytes that go to a Python task at a time; Spark, its buffers and the task
#: each hold a batch or two of that size.
BATCH_BYTES = 8 << 20


@contextmanager
def small_batches(spark: SparkSession):
    """Smaller Arrow batches for the jobs inside; the session's own setting is
    put back."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    former = spark.conf.get(name, None)
    size = (former or "").rstrip("bB")
    if size.lstrip("-").isdigit() and not 0 < int(size) <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        if former is not None:
            spark.conf.set(name, former)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: computed
    once, lineage cut, recoverable when executors are lost."""
    path = fresh_dir(df.sparkSession, name)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def released() -> None:
    """Give memory back to the system at the end of a partition: the worker
    lives on and waits for tasks of other operators."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):       # another C library
        pass


#: Rows of a few numbers or short arrays that are broadcast at most.
BROADCAST_ROWS = 200_000


#: Rows that a Python task turns into objects, or holds for a result, at a time.
IN_ROWS, OUT_ROWS = 128, 1024


def checked_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint if a count proves the table small, else the table,
    which is then joined by shuffling."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def lower_ascii(text):
    """A-Z to a-z, every other character untouched.  ``lower`` has a fast
    path for ASCII text, where both agree."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_keys(rows: DataFrame) -> DataFrame:
    """(id, th) of rows (doc_id, th, ...): the hashed id, which is never null,
    and the hash of the text; together they tell apart rows of one id."""
    return rows.select(F.xxhash64("doc_id").alias("id"), F.col("th"))


def with_row_keys(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with the columns of ``row_keys`` under free names."""
    names = [unused(docs, "_row_id"), unused(docs, "_row_th")]
    return docs.withColumns(dict(zip(names, (F.xxhash64("doc_id"), F.xxhash64("text"))))), names


def rows_in(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """``docs`` filtered by ``row_keys`` rows: ``left_semi`` or ``left_anti``."""
    keyed, names = with_row_keys(docs)
    return keyed.join(keys.toDF(*names), names, how).drop(*names)


def map_rows(df: DataFrame, fn: Callable[[Iterator[tuple]], Iterator[tuple]], schema, out_rows: int = OUT_ROWS) -> DataFrame:
    """Partition-wise Python over Arrow batches: ``fn`` turns an iterator of
    input tuples into an iterator of output tuples.  Rows come and leave in
    small slices, so that a batch of long texts takes little memory;
    ``out_rows`` are held for a result, and no more are read at a time."""
    out = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(out)
    in_rows = min(IN_ROWS, out_rows)

    def run(batches):
        def rows():
            for b in batches:
                for at in range(0, b.num_rows, in_rows):  # few texts are Python objects at a time
                    yield from zip(*[c.to_pylist() for c in b.slice(at, in_rows).columns])

        held = []
        for row in fn(rows()):
            held.append(row)
            if len(held) >= out_rows:
                yield _batch(held, arrow)
                held = []
        if held:
            yield _batch(held, arrow)
        held = []
        released()

    return df.mapInArrow(run, out)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
