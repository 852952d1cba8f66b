"""Helpers shared by the operators on texts."""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows that Python holds as objects at a time; texts may be long.
SLICE_ROWS = 1000

TO_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def map_slices(df: DataFrame, schema: str | T.StructType, make: Callable) -> DataFrame:
    """Map the rows of `df`, a slice at a time, by the function that `make()` gives.

    `make` is called once per task. Its function gets a list per column of `df` and
    returns a list per column of `schema`; the number of rows may change.
    """
    kind = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
    arrow = to_arrow_schema(kind)

    def run(batches):
        act = make()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                made = act(*[c.to_pylist() for c in batch.slice(at, SLICE_ROWS).columns])
                arrays = [pa.array(c, f.type) for c, f in zip(made, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, kind)


def columns_of(rows: list[tuple], width: int) -> list[list]:
    """The columns of a list of rows, also of none."""
    return [list(c) for c in zip(*rows)] if rows else [[] for _ in range(width)]


def words(text: str | None) -> list[bytes]:
    """Runs of characters other than the space and tab to carriage return."""
    return text.encode("utf-8").split() if text else []


def lower_ascii(text: str | None) -> bytes:
    return text.encode("utf-8").translate(TO_LOWER) if text else b""


def signed(value: int) -> int:
    """A 64-bit hash as Spark's long."""
    return value - (1 << 64) if value >= 1 << 63 else value


def hash64(data: bytes, seed: int = 42) -> int:
    return signed(xxhash.xxh64_intdigest(data, seed))


_SPACES = re.compile(rb"[\x20\x09-\x0D]+")


def normal_line(line: bytes) -> bytes:
    """Lower case (A-Z), one space between words."""
    return b" ".join(line.translate(TO_LOWER).split())


def id_rest(key: str, by: int):
    """crc32 of the id as text, modulo `by`; 0 for no id."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % by, F.lit(0))
