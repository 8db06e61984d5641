"""Whole groups from a sorted stream of Arrow batches, and memory given back at its end."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa

Batches = Iterator[pa.RecordBatch]


def give_back() -> None:
    """Return freed memory to the system. Workers outlive their tasks and wait beside the JVM, so what they keep counts."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def thrifty(f: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``f``, giving memory back once its partition is done."""

    @wraps(f)
    def run(batches: Batches) -> Batches:
        try:
            yield from f(batches)
        finally:
            give_back()

    return run


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches that hold whole runs of equal ``key`` (an integer column without nulls), each with the places where its runs begin and
    its length at the end. No more than one run besides a batch is held."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        keys = b.column(b.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
        last = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if (keys != keys[-1]).any() else 0
        if last == 0 and held and held[-1].column(held[-1].schema.get_field_index(key))[-1].as_py() == keys[0]:
            held.append(b)
            continue
        whole = pa.concat_batches([*held, b.slice(0, last)]) if held else b.slice(0, last)
        if whole.num_rows:
            yield whole, starts(whole, key)
        held = [b.slice(last)]
    if held:
        whole = pa.concat_batches(held)
        yield whole, starts(whole, key)


def starts(b: pa.RecordBatch, key: str) -> np.ndarray:
    keys = b.column(b.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
    return np.r_[0, np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)]
