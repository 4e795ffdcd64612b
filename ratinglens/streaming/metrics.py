"""Metrics of the speed layer's batches: what each observed, kept as a table.

A batch observes how many messages it read, how many of them were rejected and
how many players changed (``DataFrame.observe`` in ``start_speed_layer``; the
counts ride on the batch's own job). The listener hears of it when the batch
has committed and holds the rows until ``flush`` appends them.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

SCHEMA = "batch_id long, at timestamp, messages long, rejects long, players_changed long"


class BatchMetrics(StreamingQueryListener):
    """Collects the metrics of one query; add it to the session before the
    query starts (``spark.streams.addListener``), then name the query."""

    def __init__(self, spark: SparkSession, root: str, query_name: str) -> None:
        self.spark, self.root, self.query_name = spark, root, query_name
        self.rows: list[tuple] = []
        self.lock, self.ended = threading.Lock(), threading.Event()
        self.id = None

    def onQueryStarted(self, event) -> None:
        if event.name == self.query_name:
            self.id = event.id

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics
        if p.name == self.query_name and p.numInputRows and "messages" in seen and "players" in seen:
            row = (p.batchId, p.timestamp, seen["messages"][0], seen["messages"][1], seen["players"][0])
            with self.lock:
                self.rows.append(row)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.id == self.id:
            self.ended.set()

    def flush(self, least: int = 1) -> int:
        """Append the rows held, if there are at least ``least``, as one file;
        how many."""
        with self.lock:
            if len(self.rows) < max(1, least):
                return 0
            rows, self.rows = self.rows, []
        frame = self.spark.createDataFrame(rows, SCHEMA.replace("at timestamp", "at string"))
        frame.withColumn("at", F.to_timestamp("at")).coalesce(1).write.mode("append").parquet(self.root)
        return len(rows)


def with_metrics(query: StreamingQuery, listener: BatchMetrics, every: int = 50) -> StreamingQuery:
    """The query with a flush of ``every`` rows in each round of its upkeep,
    and of what is left in the last one."""
    upkeep = query.maintenance

    def round_(due: int | None = None) -> None:
        if upkeep:
            upkeep() if due is None else upkeep(due)
        if due is not None:
            listener.ended.wait(30)  # the last batch's event comes before the end
        listener.flush(every if due is None else 1)

    query.maintenance = round_
    return query


def read_metrics(spark: SparkSession, root: str) -> DataFrame:
    """A row per batch; a batch that ran again after a restart counts once (its
    last run)."""
    rows = spark.read.schema(SCHEMA).parquet(root)
    values = [c for c in rows.columns if c not in ("batch_id", "at")]
    last = rows.groupBy("batch_id").agg(F.max_by(F.struct("at", *values), "at").alias("_r"))
    return last.select("batch_id", "_r.*")
