"""What a session needs before a Python stage of this subpackage runs."""

from __future__ import annotations

import ctypes
import functools
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import SparkSession

import pairloom

_shipped: set[str] = set()


def prepare(spark: SparkSession, megabytes: int = 16) -> None:
    """Bound Arrow batches by bytes, whatever the texts' lengths, and send the package to the executors once."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(megabytes << 20))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.abspath(pairloom.__file__))
    archive = os.path.join(tempfile.mkdtemp(), "pairloom-package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("pairloom", os.path.relpath(path, top)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def _release() -> None:
    """Give freed memory back to the system: workers live on from task to task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


_kept: list[dict] = []
_last: list[str] = []


def cleared(cache: dict) -> dict:
    """A cache of a module that lasts from task to task, and goes when the worker turns to another function."""
    _kept.append(cache)
    return cache


def tidy(work: Callable) -> Callable:
    """A function for ``mapInArrow`` that leaves no freed memory behind when its task ends, nor caches of other functions when it begins."""
    name = f"{work.__module__}.{work.__qualname__}"

    @functools.wraps(work)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if _last != [name]:
            _last[:] = [name]
            for cache in _kept:
                cache.clear()
            _release()
        try:
            yield from work(batches)
        finally:
            _release()

    return run


def tidy_group(work: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """The same for ``applyInArrow``: nothing freed stays behind a group of rows."""
    name = f"{work.__module__}.{work.__qualname__}"

    def run(table: pa.Table) -> pa.Table:
        if _last != [name]:
            _last[:] = [name]
            for cache in _kept:
                cache.clear()
            _release()
        try:
            return work(table)
        finally:
            _release()

    return run
