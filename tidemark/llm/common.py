"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: ASCII white space: tab, line feed, vertical tab, form feed, carriage return, space.
WHITE = " \t\n\x0b\f\r"
#: Rows of a batch that are worked on at a time, for the sake of the workers' memory.
SLICE = 512
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def without(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` less the columns that an operator is about to add (names compared as Spark does)."""
    taken = {n.lower() for n in names}
    return df.select(*[quoted(c) for c in df.columns if c.lower() not in taken])


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z lower-cased and all other letters left as they are."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, with underscores added until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


@functools.cache
def _trim() -> Callable[[int], int] | None:
    return getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return what Arrow and the C library keep for later use to the system.

    Spark's Python workers outlive their tasks, so memory that one stage leaves in them is missing in the next.
    """
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def lean(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``work``, which treats each batch by itself, with its memory given back after every batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from work(iter([batch]))
            del batch
            give_back()

    return run


def with_arrow(df: DataFrame, column: str, make, added: Sequence[T.StructField]) -> DataFrame:
    """``df`` plus columns that ``make(Arrow array) -> list of Arrow arrays`` computes from one column.

    Columns of the same name are replaced. Only ``column`` goes to the Python workers, and only what
    is made comes back; all other columns stay in the JVM.
    """
    names = [f.name for f in added]
    source = df if column in names else without(df, names)
    made = free_name(source, "made")

    @F.arrow_udf(T.StructType(list(added)))
    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for whole in arrays:
            parts = [make(whole.slice(at, SLICE)) for at in range(0, max(len(whole), 1), SLICE)]
            yield pa.StructArray.from_arrays([pa.concat_arrays(x) for x in zip(*parts)], names)
            del whole, parts
            give_back()

    computed = source.withColumn(made, run(quoted(column)))
    kept = [quoted(c) for c in without(source, names).columns]
    return computed.select(*kept, *[F.col(made)[n].alias(n) for n in names])


def groups(lengths: Sequence[int], most: int) -> Iterator[tuple[int, int]]:
    """Runs [a, b) of rows whose lengths add up to ``most`` or that hold one row."""
    start = total = 0
    for i, n in enumerate(lengths):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)
