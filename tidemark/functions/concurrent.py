"""Independent Spark jobs submitted side by side, as model selection does."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

PARALLELISM = 4


def run_all(jobs: Sequence[Callable[[], object]], parallelism: int = PARALLELISM) -> list:
    """Results of the jobs in order. The threads only wait; the work is on the executors."""
    if len(jobs) < 2 or parallelism < 2:
        return [job() for job in jobs]
    session = SparkSession.active()
    # Wrapped one by one: each job has local properties of its own, else one job's query would end another's execution id.
    wrapped = [inheritable_thread_target(session)(job) for job in jobs]
    with ThreadPool(min(parallelism, len(jobs))) as pool:
        return pool.map(lambda job: job(), wrapped, chunksize=1)
