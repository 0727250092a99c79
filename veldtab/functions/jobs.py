"""Independent Spark jobs side by side."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target


def in_parallel(fn: Callable, items, workers: int = 4) -> list:
    """``fn`` of every item, results in order; each call submits its own jobs."""
    with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
        return list(pool.map(inheritable_thread_target(fn), items))
