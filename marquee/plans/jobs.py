"""Running independent Spark jobs side by side.

One SparkContext accepts jobs from several driver threads at once.  Models
inside a layer, the assertions and the analyses are independent of each
other, so submitting them together lets the short jobs' tasks fill the
executors that one job alone would leave idle.  Results keep their input
order; an exception is returned in place of its result.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

DEFAULT_CONCURRENT_JOBS = 4


def run_concurrently(tasks: dict[str, Callable[[], object]],
                     max_jobs: int = DEFAULT_CONCURRENT_JOBS) -> dict[str, tuple[object, float]]:
    """name -> (result or exception, seconds), in the order of ``tasks``."""
    def timed(fn):
        t0 = time.time()
        try:
            return fn(), time.time() - t0
        except Exception as exc:  # reported to the caller, not raised here
            return exc, time.time() - t0

    if max_jobs <= 1 or len(tasks) <= 1:
        return {name: timed(fn) for name, fn in tasks.items()}
    with ThreadPoolExecutor(max_workers=min(max_jobs, len(tasks))) as pool:
        futures = {name: pool.submit(timed, fn) for name, fn in tasks.items()}
        return {name: f.result() for name, f in futures.items()}
