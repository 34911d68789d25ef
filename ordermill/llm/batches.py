"""Arrow batches in and out of per-partition functions, and columns that all operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder. Workers of a local session then find this package where the driver does."""
    if spark.sparkContext.master.startswith("local"):
        spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_of(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo `folds`; NULL ids have a NULL fold."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds).cast("long"))


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple[Any, ...]]:
    """Python values row by row; at most `ROWS` rows are converted at a time."""
    for start in range(0, batch.num_rows, ROWS):
        part = batch.slice(start, ROWS)
        if part.nbytes > 64 * ROWS * 1024:  # very long texts: one at a time
            for i in range(part.num_rows):
                yield tuple(column[i].as_py() for column in part.columns)
        else:
            yield from zip(*(column.to_pylist() for column in part.columns))


def map_rows(
    df: DataFrame,
    schema: str,
    start: Callable[[], Callable[..., tuple]],
) -> DataFrame:
    """One output row per input row.

    `start()` runs once per task and returns the function of one row's values. Results leave in
    batches of `ROWS`, so a task holds a few batches and its own state, whatever its share is.
    """
    fields = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = start()
        for batch in batches:
            out: list[tuple] = []
            size = 0
            for values in rows_of(batch):
                out.append(row(*values))
                size += sum(len(v) for v in out[-1] if isinstance(v, (bytes, str)))
                if len(out) == ROWS or size > 8 << 20:
                    yield to_batch(out, fields)
                    out, size = [], 0
            if out:
                yield to_batch(out, fields)

    return df.mapInArrow(run, schema)


def fold_rows(
    df: DataFrame,
    schema: str,
    start: Callable[[], Any],
    add: Callable[..., Iterator[tuple[list, ...]] | None],
    finish: Callable[[Any], Iterator[tuple[list, ...]]],
) -> DataFrame:
    """Any number of output rows per task, from a state that `add` grows row by row.

    `add` may yield columns early, to keep the state bounded; `finish` yields the rest.
    """
    fields = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = start()
        for batch in batches:
            for values in rows_of(batch):
                for columns in add(state, *values) or ():
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=fields)
        for columns in finish(state):
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=fields)

    return df.mapInArrow(run, schema)


def to_batch(rows: list[tuple], fields: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(list(c), f.type) for c, f in zip(zip(*rows), fields)], schema=fields)
