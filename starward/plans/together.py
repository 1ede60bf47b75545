"""Run independent Spark jobs at the same time.

Small tables leave most of a cluster idle when they are loaded one after the other.  Each step
submits its jobs from its own thread and Spark runs them side by side.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def together(
    spark: SparkSession, steps: Mapping[str, Callable[[], Any]]
) -> dict[str, Any | Exception]:
    """Each step's result, or the exception that ended it, in the order given."""
    with ThreadPoolExecutor(max_workers=len(steps)) as pool:
        running = {
            name: pool.submit(inheritable_thread_target(spark)(step)) for name, step in steps.items()
        }
        return {name: job.exception() or job.result() for name, job in running.items()}


def results_of(spark: SparkSession, steps: Mapping[str, Callable[[], Any]]) -> dict[str, Any]:
    """The results; the first failure is raised once all steps have ended."""
    results = together(spark, steps)
    for result in results.values():
        if isinstance(result, Exception):
            raise result
    return results
