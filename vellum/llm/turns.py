"""Conversations' turns in order, dealt over parts of equal size.

Turns are sorted as a whole by conversation and turn, so a part holds whole conversations but for the first and the last one in it, and a conversation of any length goes over as many parts as it takes.
Each part says in one record what the next ones need to know (``carried``); those records, one for each part, are all that the driver sees.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame

from .streams import Batches, thrifty

MASK = (1 << 64) - 1


def in_order(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` range-partitioned and sorted by ``order``."""
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def part() -> int:
    return TaskContext.get().partitionId()


def over_rows(f: Callable[[Iterator[tuple]], Iterator[pa.RecordBatch]]) -> Callable[[Batches], Batches]:
    """A function of Arrow batches from one of rows in order; columns are turned into values one batch at a time."""

    def rows(batches: Batches) -> Iterator[tuple]:
        for b in batches:
            yield from zip(*(c.to_pylist() for c in b.columns), strict=True)

    return thrifty(lambda batches: f(rows(batches)))


def carried(records: list[tuple[int, Any]], start: Any, step: Callable[[Any, Any], Any]) -> dict[int, Any]:
    """For each part what holds where it begins, given (part, record) of those that have rows."""
    out, state = {}, start
    for n, record in sorted(records, key=lambda r: r[0]):
        out[n] = state
        state = step(state, record)
    return out


def columns(rows: Iterator[tuple], schema: str, size: int = 10_000) -> Iterator[pa.RecordBatch]:
    """Batches of rows with the columns of ``schema``."""
    fields = arrow_schema(schema)
    held: list[tuple] = []
    for r in rows:
        held.append(r)
        if len(held) >= size:
            yield _batch(held, fields)
            held = []
    if held:
        yield _batch(held, fields)


def _batch(rows: list[tuple], fields: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), fields, strict=True)], schema=fields)


_KINDS = {"boolean": pa.bool_(), "int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}


def arrow_schema(schema: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (c.split() for c in schema.split(", "))])
