"""Tables that Python workers keep between tasks. A worker serves one operator after another; each drops the others' tables
when it starts, so that a pipeline's stages don't add up in memory."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable

import pyarrow as pa

_DROP: dict[str, Callable[[], object]] = {}
_OWNER: list[str] = [""]


def keeps(name: str, drop: Callable[[], object]) -> None:
    _DROP[name] = drop


def serve(name: str) -> None:
    """To be called where a task starts."""
    if _OWNER[0] == name:
        return
    _OWNER[0] = name
    for other, drop in _DROP.items():
        if other != name:
            drop()
    trim()


def trim() -> None:
    """Gives free memory back, which an idle worker would otherwise hold while other tasks run."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library: memory goes back when it likes


def tidy(f: Callable) -> Callable:
    """A task's function over batches that trims at its end."""

    @functools.wraps(f)
    def run(batches):
        try:
            yield from f(batches)
        finally:
            trim()

    return run


def tidy_group(f: Callable) -> Callable:
    """A function of one group's table that trims after large ones."""

    @functools.wraps(f)
    def run(table: pa.Table) -> pa.Table:
        out, large = f(table), table.nbytes > 4_000_000
        if large:
            trim()
        return out

    return run
