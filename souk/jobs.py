"""Running independent Spark jobs (table or mart writes) concurrently."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait


def run_concurrently(jobs: Iterable[Callable[[], object]], parallelism: int) -> list:
    """Run independent jobs from a thread pool; results in submission order.

    Spark schedules the jobs of the threads side by side.  Fails fast like a
    serial loop: on the first exception no further job is started (queued
    ones are cancelled) and that exception is raised once the running ones
    have finished.
    """
    jobs = list(jobs)
    if parallelism <= 1:
        return [j() for j in jobs]
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        futures = [pool.submit(j) for j in jobs]
        done, _ = wait(futures, return_when=FIRST_EXCEPTION)
        failed = [f for f in futures if f in done and f.exception() is not None]
        if failed:
            for f in futures:
                f.cancel()
            raise failed[0].exception()
        return [f.result() for f in futures]
