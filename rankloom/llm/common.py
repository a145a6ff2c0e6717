"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache, wraps

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_CHARS = 1_000_000


_CACHES: list = []


def worker_cache(maxsize: int) -> Callable:
    """``lru_cache`` that a reused Python worker drops once it runs a tidy task of another module."""

    def cached(function: Callable) -> Callable:
        kept = lru_cache(maxsize=maxsize)(function)
        _CACHES.append(kept)
        return kept

    return cached


def fresh_worker(module: str | None = None) -> None:
    """Free what earlier tasks have left in a reused Python worker: caches of modules but ``module``, if named, and unused memory."""
    for kept in _CACHES:
        if module and kept.__module__ != module:
            kept.cache_clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps its memory
        pass


def tidy_task(run: Callable) -> Callable:
    """A task that leaves a small worker behind, whatever stage comes next."""

    @wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh_worker(run.__module__)
        yield from run(batches)
        fresh_worker()

    return tidied


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def chunks(sizes: Sequence[int], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring rows whose sizes add up to about ``limit``; a larger row stands alone."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def text_slices(column: pa.Array, limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int, list]]:
    """(first row, end, values) of a text or binary column, about ``limit`` bytes at a time."""
    for a, b in chunks(pc.fill_null(pc.binary_length(column), 0).to_pylist(), limit):
        yield a, b, column[a:b].to_pylist()


def file_content(path: str, most: int = 64 << 20) -> bytes:
    """A vocabulary file, read once by the driver and broadcast; its size is checked."""
    with open(path, "rb") as source:
        content = source.read(most + 1)
    if len(content) > most:
        raise ValueError(f"{path} is larger than {most} bytes")
    return content


def broadcast_if_small(rows: DataFrame, most: int) -> DataFrame:
    """Marked for a broadcast if it has at most ``most`` rows, which are counted; else as it is."""
    return F.broadcast(rows) if rows.count() <= most else rows
