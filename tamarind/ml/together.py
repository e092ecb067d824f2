"""Independent jobs of one session at the same time.

A boosted model is hundreds of short jobs in a row; on small segments each of
them leaves nearly all cores idle. Fits that don't need each other are started
from threads of their own, each with its own pool, so that a fair scheduler
deals cores out evenly and a first-come one fills the gaps.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")
K = TypeVar("K", bound=Hashable)

AT_ONCE = 12  # threads of the driver that wait for jobs


def together(spark: SparkSession, jobs: Mapping[K, Callable[[], T]], at_once: int = AT_ONCE) -> dict[K, T]:
    """The result of every job by its key, in the order given.

    The first error, in that order, is raised once the jobs that have begun have
    ended; those that haven't are not started.
    """
    context = spark.sparkContext

    def named(key: K, job: Callable[[], T]) -> Callable[[], T]:
        def run() -> T:
            context.setLocalProperty("spark.scheduler.pool", str(key))
            return job()

        return inheritable_thread_target(spark)(run)

    if not jobs:
        return {}
    with ThreadPoolExecutor(min(at_once, len(jobs))) as pool:
        begun = {key: pool.submit(named(key, job)) for key, job in jobs.items()}
        try:
            return {key: future.result() for key, future in begun.items()}
        except BaseException:
            for future in begun.values():
                future.cancel()
            raise
