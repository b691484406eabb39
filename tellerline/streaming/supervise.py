"""Several streaming jobs in one session: failed ones go on from their checkpoint, all stop in order."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.errors import StreamingQueryException
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

Job = Callable[[], StreamingQuery]

#: The longest wait before a job is started again, in seconds.
LONGEST_PAUSE = 60.0


class _Running:
    """One job's query, how often it failed since it last finished a micro-batch, and how often in all."""

    def __init__(self, name: str, start: Job, restarts: int):
        self.name, self.start, self.limit = name, start, restarts
        self.query = start()
        self.in_a_row = self.failures = 0

    def resume(self) -> None:
        """Start a query that failed again; one that failed too often raises its error."""
        error = self.query.exception()
        if self.query.isActive or error is None:
            return
        # A batch that fails each time is the first one of each run, so such a run has no progress.
        self.in_a_row = 1 if self.query.lastProgress else self.in_a_row + 1
        self.failures += 1
        if self.in_a_row > self.limit:
            raise error
        time.sleep(min(LONGEST_PAUSE, 0.1 * 2**self.in_a_row))
        self.query = self.start()

    def drain(self) -> None:
        """Let the query take up all there is now, then stop it."""
        while self.query.isActive or self.query.exception() is not None:
            try:
                self.query.processAllAvailable()
                self.query.stop()
                return
            except StreamingQueryException:
                self.resume()


def supervise(
    spark: SparkSession, jobs: Mapping[str, Job], until: Callable[[], bool], restarts: int = 3, poll_seconds: float = 5.0
) -> dict[str, int]:
    """Run streaming jobs until ``until()`` holds; returns how often each was started again.

    ``jobs`` are named functions that start a query in Streaming mode, those that feed others first. A query that ends
    with an error is started again, from its checkpoint, unless it failed more than ``restarts`` times without
    finishing a micro-batch: then all are stopped and its error is raised. A query that somebody stopped stays so.
    In the end each job takes up what there is and stops, in the order given, so what one
    hands on reaches the next. Other queries of the session go on.
    """
    running: list[_Running] = []
    try:
        for name, start in jobs.items():
            running.append(_Running(name, start, restarts))
        while not until():
            try:
                spark.streams.awaitAnyTermination(poll_seconds)
            except StreamingQueryException:
                pass  # which one, and why, is asked of each below
            spark.streams.resetTerminated()
            for job in running:
                job.resume()
        for job in running:
            job.drain()
        return {job.name: job.failures for job in running}
    finally:
        for job in running:
            if job.query.isActive:
                job.query.stop()
