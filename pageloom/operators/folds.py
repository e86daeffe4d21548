"""Folds over the tokens of a page: columns that Python makes of others, batch by batch, inside the page's row."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

Reader = Callable[..., pa.Array]
PAGES = 2000  # read together; what is made of a page is larger than its markup


def fold(pages: DataFrame, make: Callable[[], Reader], takes: Sequence[str], output: str, made: T.DataType) -> DataFrame:
    """``output`` is what a reader makes of the columns ``takes``, which go; the other columns pass by as they are.

    ``make`` is called once per task, so what its reader remembers ends with the task.
    """
    kept = [f for f in pages.schema if f.name not in takes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = make()
        for batch in batches:
            for at in range(0, batch.num_rows, PAGES):
                part = batch.slice(at, PAGES)
                columns = [part.column(f.name) for f in kept] + [read(*(part.column(name) for name in takes))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = T.StructType([*kept, T.StructField(output, made)])
    names = schema.names
    return pages.mapInArrow(run, schema)


def unfold(pages: DataFrame, make: Callable[[], Callable[..., tuple[pa.Array, list[pa.Array]]]], takes: Sequence[str], made: T.StructType) -> DataFrame:
    """Rows that a reader makes of the columns ``takes``: for each its page's place in the batch, and the columns ``made``."""
    kept = [f for f in pages.schema if f.name not in takes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = make()
        for batch in batches:
            for at in range(0, batch.num_rows, PAGES):
                part = batch.slice(at, PAGES)
                places, columns = read(*(part.column(name) for name in takes))
                yield pa.RecordBatch.from_arrays([part.column(f.name).take(places) for f in kept] + columns, names=names)

    schema = T.StructType([*kept, *made])
    names = schema.names
    return pages.mapInArrow(run, schema)
