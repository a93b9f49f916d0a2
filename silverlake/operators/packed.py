"""Rows moved between tasks as packed batches, where a shuffle of the rows themselves would fill the disks.

Spark shuffles row by row and packs its files lightly. Here a task sorts out some tens of megabytes of rows by the task
they go to, and what goes to one task travels as one batch of columns, packed by zstd.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DataType,
    DateType,
    NumericType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

TO, BATCH = "__to", "__batch"
# Bytes of rows that a task sorts out at once, and rows that it hands on at once.
HELD, HANDED = 64 << 20, 10_000
# Types that come out of a batch exactly as they went in.
PACKABLE = (StringType, NumericType, BooleanType, DateType, TimestampType, TimestampNTZType, BinaryType)
WRITING = pa.ipc.IpcWriteOptions(compression="zstd")


def packable(schema: StructType) -> bool:
    return all(isinstance(field.dataType, PACKABLE) for field in schema)


def deal_out(rows: DataFrame, to: Column, tasks: int) -> DataFrame:
    """The same rows, those with the number ``to`` (from 0) in the task of that number."""
    numbered = rows.select(to.cast("int").alias(TO), *rows.columns)
    packed = numbered.mapInArrow(_pack, f"{TO} int, {BATCH} binary")
    return packed.repartitionById(tasks, TO).mapInArrow(_unpack, rows.schema)


def first_of_each(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row by ``order`` of each key, for rows whose equal keys are in one task; no shuffle.

    Rows with a null key are all kept. Keys must not be floating-point numbers, see ``comparable``.
    """
    # By the row before it, so Spark must not move it.
    begins = F.arrow_udf(_begins, BooleanType()).asNondeterministic()
    ordered = rows.sortWithinPartitions(*keys, *order)
    marked = ordered.select(*rows.columns, begins(F.struct(*keys)).alias("__first"))
    return marked.where("__first").select(*rows.columns)


def comparable(kind: DataType) -> bool:
    """True if values that Spark groups together are equal in Arrow; NaN is not."""
    return kind.simpleString() not in ("float", "double")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= HELD:
            yield _by_task(held)
            held, size = [], 0
    if held:
        yield _by_task(held)


def _by_task(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(held)
    rows = rows.take(pc.sort_indices(rows[TO])).combine_chunks()
    runs = pc.run_end_encode(rows[TO].combine_chunks())
    (whole,) = rows.drop_columns([TO]).to_batches()
    starts = [0, *runs.run_ends.to_pylist()]
    packed = [_written(whole.slice(a, b - a)) for a, b in zip(starts, starts[1:], strict=False)]
    return pa.RecordBatch.from_arrays([runs.values, pa.array(packed, pa.binary())], [TO, BATCH])


def _written(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=WRITING) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, count = [], 0
    for packed in batches:
        for one in packed.column(BATCH):
            for batch in pa.ipc.open_stream(one.as_buffer()):
                held.append(batch)
                count += batch.num_rows
            if count >= HANDED:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, count = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _begins(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Whether a row's key is another than that of the row before it; keys are structs."""
    last = None
    for keys in batches:
        fields = keys.flatten()
        before = last or [f.slice(0, 1) for f in fields]
        begins = None
        for now, end in zip(fields, before, strict=True):
            earlier = pa.concat_arrays([end, now.slice(0, max(len(now) - 1, 0))]).slice(0, len(now))
            # Null is equal to nothing.
            other = pc.fill_null(pc.not_equal(now, earlier), True)
            begins = other if begins is None else pc.or_(begins, other)
        if len(keys):
            if last is None:
                begins = pa.concat_arrays([pa.array([True]), begins.slice(1)])
            last = [f.slice(len(f) - 1) for f in fields]
        yield begins
