"""Control loop of a running speed layer: upkeep beside the batches, and an end
after the batch that is running.

``StreamingQuery.stop()`` cancels a batch in its middle. Here the gate of the
query is closed first: a batch that has not begun to write is refused, so the
one that is writing is the last, is committed in the checkpoint, and a restart
goes on behind it.
"""

from __future__ import annotations

import signal
import threading
import time
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ratinglens.sources.store import path_exists

CLOSED = "the gate of this query is closed"


class Gate:
    """Passed by every batch before it writes."""

    def __init__(self) -> None:
        self.closed = False
        self.passed = 0

    def enter(self) -> None:
        if self.closed:
            raise RuntimeError(CLOSED)
        self.passed += 1

    def close(self) -> None:
        self.closed = True


def failure(query: StreamingQuery) -> str | None:
    """Why a query ended, unless it was refused a batch at its closed gate."""
    error = query.exception()
    if error is None or (CLOSED in str(error) and query.gate.closed):
        return None
    return str(error)


def stop_cleanly(query: StreamingQuery, timeout_s: float | None = None, poll_s: float = 0.1) -> None:
    """End a query, and its rejects query, after the batch that is running;
    re-raise its failure. With ``timeout_s``, a batch that is still running
    after it is an error (and goes on to its end)."""
    until = None if timeout_s is None else time.monotonic() + timeout_s
    query.gate.close()
    for q in filter(None, (query, getattr(query, "rejects", None))):
        while q.isActive:
            if not q.status["isTriggerActive"]:
                q.stop()  # between two batches; one that begins now is refused
            elif until is not None and time.monotonic() > until:
                raise TimeoutError(f"a batch is still running after {timeout_s} s")
            else:
                time.sleep(poll_s)
    if failure(query):
        raise RuntimeError(failure(query))


def supervise(
    query: StreamingQuery,
    should_stop: Callable[[], bool] | None = None,
    timeout_s: float | None = None,
    poll_s: float = 1.0,
    upkeep_s: float = 30.0,
) -> None:
    """Stay with a query until it ends or ``should_stop()`` says so, then end it
    cleanly. Upkeep of the view runs in this thread, beside the batches, every
    ``upkeep_s`` seconds and once more at the end, when it folds whatever is
    left into a snapshot. Re-raises the failure of the query."""
    until = None if timeout_s is None else time.monotonic() + timeout_s
    due = time.monotonic()
    while query.isActive:
        if should_stop is not None and should_stop():
            stop_cleanly(query)
            break
        if until is not None and time.monotonic() > until:
            query.stop()
            raise TimeoutError(f"streaming query did not catch up within {timeout_s} s")
        if query.maintenance and time.monotonic() >= due:
            query.maintenance()
            due = time.monotonic() + upkeep_s
        try:
            query.awaitTermination(poll_s)
        except StreamingQueryException:
            break  # its failure is told below
    if failure(query):
        raise RuntimeError(failure(query))
    if query.rejects:  # of an availableNow query: it ends by itself, and raises its failure
        query.rejects.awaitTermination()
    if query.maintenance:
        query.maintenance(1)


def stop_on(spark: SparkSession, stop_file: str | None = None, signals: tuple[int, ...] = ()) -> Callable[[], bool]:
    """A ``should_stop`` that answers yes after one of the signals, or once
    ``stop_file`` exists in the shared folder (which stays there: remove it
    before the next start)."""
    told = threading.Event()
    for s in signals:
        signal.signal(s, lambda *_: told.set())
    return lambda: told.is_set() or bool(stop_file and path_exists(spark, stop_file))
