"""What a worker process of Spark keeps from task to task, and how it gives memory back.

Workers outlive their tasks, and several share an executor's memory with its JVM: one stage's cache or freed heap must
not lie beside the next stage's.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa

_KEPT: dict[tuple[str, str], object] = {}


def trim() -> None:
    """Return freed memory to the system: Arrow's, and the C library's where it can do that."""
    pa.default_memory_pool().release_unused()
    give = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give:
        give(0)


def forget() -> None:
    """Drop what earlier tasks of other kinds kept."""
    if _KEPT:
        _KEPT.clear()
        gc.collect()
        trim()


def kept(kind: str, key: str, make: Callable[[], object]) -> object:
    """The worker's one object of this kind and key, made at the first call; what it kept before goes."""
    if (kind, key) not in _KEPT:
        forget()
        _KEPT[kind, key] = make()
    return _KEPT[kind, key]


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, in a worker that keeps nothing: not from earlier tasks, and not of this one."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        try:
            yield from run(batches)
        finally:
            trim()

    return whole
