"""Memory of Python workers, which live on from task to task and stage to stage."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa


def trim() -> None:
    """Give free memory back to the system, where its C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def released(run: Callable[[Iterator], Iterator], *clear: Callable[[], None]) -> Callable[[Iterator], Iterator]:
    """run over a task's batches; at its end caches are cleared and free memory is given back."""

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            for c in clear:
                c()
            trim()

    return wrapped
