"""Caches of a run: kept while it lasts, released at its end."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import StorageLevel
from pyspark.sql import DataFrame

_RUN: ContextVar[list[DataFrame] | None] = ContextVar("run_caches", default=None)


def keep(df: DataFrame) -> DataFrame:
    """``df`` persisted (memory, spilling to disk; lost blocks are recomputed). Inside ``caches_released`` it is
    unpersisted at the end; elsewhere it is the caller's session that decides."""
    held = _RUN.get()
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    if held is not None:
        held.append(kept)
    return kept


@contextmanager
def caches_released() -> Iterator[None]:
    """Everything that ``keep`` persists inside is unpersisted on leaving."""
    token = _RUN.set([])
    try:
        yield
    finally:
        for df in _RUN.get():
            df.unpersist()
        _RUN.reset(token)
