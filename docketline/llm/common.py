"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketline.session import materialize
from docketline.session import small_batches as prepare

__all__ = ["fresh", "read_table", "text_struct", "prepare", "materialize", "give_back", "CONTINUATION", "SPACES"]

#: The bytes of the white space class [\x20\x09-\x0D].
SPACES = b" \t\n\x0b\x0c\r"
#: UTF-8 continuation bytes: deleting them leaves one byte per code point.
CONTINUATION = bytes(range(0x80, 0xC0))


def give_back() -> None:
    """Return a Python worker's freed memory to the system. Workers live on from
    stage to stage, and what one leaves in its heap adds to what the next needs."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim:
        trim(0)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` doesn't have (case aside)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_struct(make: Callable[[], Callable[[bytes | None], tuple]], schema: pa.StructType,
                ddl: str) -> Callable[[Column], Column]:
    """An Arrow function from a text column to a struct.

    ``make`` runs once a task and returns the function for one text (its UTF-8
    bytes, or None for null), which returns the struct's values in order. The
    result is marked nondeterministic only so that a filter on it is not
    pushed below it, which would run the Python code twice.
    """
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        one = make()
        for texts in batches:
            rows = [one(b) for b in texts.cast(pa.binary()).to_pylist()]
            columns: Iterable = zip(*rows) if rows else [[] for _ in schema]
            yield pa.StructArray.from_arrays(
                [pa.array(list(c), type=f.type) for c, f in zip(columns, schema)],
                fields=list(schema))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    udf = F.arrow_udf(run, ddl).asNondeterministic()
    return lambda col: udf(col.cast("string"))
