"""Speed layer: latest submitted rating and submission count per player.

One Structured Streaming aggregation produces both views; the rejects, if
wanted, are a second query over the same source with a checkpoint of its own:

    messages ─ from_json ─┬─ no report → rejects (raw text and reason kept)
                          └─ groupBy(fide_id)
                               max_by(report, arrival order) → live row
                               count(*)                        → stream_count

State is keyed by fide_id and bounded by the number of players, so no
watermark is needed. The query runs in update mode; every micro-batch writes
the absolute state of the keys it changed into the view store as version
``batch_id`` (see ``sources.store``). A replayed batch id rewrites the same
folder with the same rows, so the sink is idempotent and, with the
checkpointed state, the counts are exactly-once. Snapshots, which bound what a
reader merges, and the removal of what they replace are jobs beside the
stream (see ``streaming.control``); no batch waits for them. A
restart continues from the checkpointed offsets and state; a view belongs to
one checkpoint, and starting a new one on a view that has versions is refused
(its batch ids would start again below the versions that are there).

The same ``speed_state`` function runs on a batch DataFrame of the message
log, which is how the tests prove stream = batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ratinglens.functions.scalar import parse_reports, reject_reason, report_json, update_message
from ratinglens.schemas import REPORT_FIELDS, SUBMISSION_FIELDS
from ratinglens.sources.store import GRACE_S, folder_names, has_versions, maintain_view, read_view, write_version
from ratinglens.streaming.control import Gate, supervise

ORDER_COLS = ("ts", "seq")


# --------------------------------------------------------------------------
# sources


def read_kafka_messages(
    spark: SparkSession,
    brokers: str,
    topic: str,
    starting_offsets: str = "latest",
    **options: str,
) -> DataFrame:
    """Submission topic → (value, ts, part, seq). Needs the Kafka connector
    on the classpath; ``options`` are its options (``kafka.group.id``,
    ``maxOffsetsPerTrigger``, …).

    The arrival order is (ts, part, seq=offset) if the topic's timestamps are
    set on arrival (``message.timestamp.type=LogAppendTime``). On a topic with
    one partition the offset alone is right whatever the timestamps are: pass
    ``order_cols=("seq",)``."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load().select(
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("ts"),
        F.col("partition").alias("part"),
        F.col("offset").alias("seq"),
    )


MESSAGE_SCHEMA = "seq bigint, ts timestamp, value string"
PARTITIONED_MESSAGE_SCHEMA = "part int, seq bigint, ts timestamp, value string"


def read_message_files(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    schema: str = MESSAGE_SCHEMA,
    max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """Folder of JSON-lines files, one message per line with fields
    ``seq`` (long), ``ts`` (timestamp) and ``value`` (the report JSON text);
    with ``PARTITIONED_MESSAGE_SCHEMA`` also ``part`` (source partition), as a
    multi-partition topic delivers them.

    A backlog is taken in batches of at most ``max_files_per_trigger`` files,
    or of ``max_bytes_per_trigger`` bytes (at least one file); not both."""
    if max_files_per_trigger and max_bytes_per_trigger:
        raise ValueError("limit a batch by files or by bytes, not by both")
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.json(path)


def to_messages(reports: DataFrame, order_cols: Sequence[str] = ORDER_COLS) -> DataFrame:
    """Rating reports → wire messages: the report as JSON text plus its
    arrival order columns (what a producer publishes)."""
    return reports.select(report_json(*SUBMISSION_FIELDS).alias("value"), *order_cols)


def write_messages(messages: DataFrame, path: str) -> None:
    """Publish messages as JSON-lines files (the offline stand-in for a topic)."""
    messages.write.mode("append").json(path)


def write_kafka_messages(messages: DataFrame, brokers: str, topic: str) -> None:
    """Publish messages to a topic (needs the Kafka connector)."""
    (
        messages.select("value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("topic", topic)
        .save()
    )


# --------------------------------------------------------------------------
# parse, quarantine, aggregate


#: What is done with a message that carries no report.
PERMISSIVE, STRICT, FAILFAST = "permissive", "strict", "failfast"


def parse_messages(
    messages: DataFrame, order_cols: Sequence[str] = ORDER_COLS, mode: str = PERMISSIVE
) -> DataFrame:
    """Messages → report columns + ``reason`` + order columns + the raw text.

    ``reason`` says why a message carries no report (see ``reject_reason``); its
    report columns are NULL then. In mode ``permissive`` fields that a report
    does not have are ignored, in ``strict`` they are a reason, and
    ``failfast`` ends the query with an error at the first such message."""
    if mode not in (PERMISSIVE, STRICT, FAILFAST):
        raise ValueError(f"no such mode: {mode}")
    reason = reject_reason("value", strict=mode != PERMISSIVE)
    if mode == FAILFAST:
        told = F.concat(reason, F.lit(": "), F.coalesce("value", F.lit("NULL")))
        reason = F.when(reason.isNotNull(), F.raise_error(told)).otherwise(F.lit(None).cast("string"))
    parsed = messages.select(parse_reports("value").alias("_r"), reason.alias("reason"), "value", *order_cols)
    fields = [F.when(F.col("reason").isNull(), F.col(f"_r.{c}")).alias(c) for c in SUBMISSION_FIELDS]
    return parsed.select(*fields, "reason", "value", *order_cols)


def valid_reports(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("fide_id").isNotNull())


def rejected_messages(parsed: DataFrame, order_cols: Sequence[str] = ORDER_COLS) -> DataFrame:
    """Messages without a report, and why."""
    return parsed.filter(F.col("reason").isNotNull()).select("value", "reason", *order_cols)


def message_reasons(messages: DataFrame, mode: str = PERMISSIVE) -> DataFrame:
    """(reason, n_messages): messages per reason, NULL for reports."""
    return parse_messages(messages, (), mode).groupBy("reason").agg(F.count(F.lit(1)).alias("n_messages"))


def speed_state(reports: DataFrame, order_cols: Sequence[str] = ORDER_COLS) -> DataFrame:
    """Per player: the whole latest report (all five fields replaced together)
    and the number of submissions. Works on batch and streaming frames."""
    report = F.struct(*REPORT_FIELDS)
    order = F.struct(*order_cols)
    agg = valid_reports(reports).groupBy("fide_id").agg(
        F.max_by(report, order).alias("_latest"),
        F.count(F.lit(1)).alias("stream_count"),
    )
    return agg.select(
        "fide_id", *[F.col(f"_latest.{c}").alias(c) for c in REPORT_FIELDS], "stream_count"
    )


def live_view(state: DataFrame) -> DataFrame:
    """(fide_id, first_name, last_name, rating_standard, rating_rapid, rating_blitz)."""
    return state.select("fide_id", *REPORT_FIELDS)


def stream_counts(state: DataFrame) -> DataFrame:
    """(fide_id, stream_count)."""
    return state.select("fide_id", "stream_count")


# --------------------------------------------------------------------------
# sinks and running


def start_speed_layer(
    messages: DataFrame,
    view_root: str,
    checkpoint: str,
    order_cols: Sequence[str] = ORDER_COLS,
    processing_time: str | None = "2 seconds",
    available_now: bool = False,
    rejects_root: str | None = None,
    query_name: str | None = None,
    compact_every: int | None = 500,
    mode: str = PERMISSIVE,
    grace_s: float = GRACE_S,
) -> StreamingQuery:
    """Start the speed-layer query: update-mode aggregation → versioned
    upsert of the view store in ``foreachBatch``.

    A delta holds only the keys changed in one micro-batch, a file per state
    partition that has any. The query returned has three attributes for
    ``streaming.control``: ``gate`` (closed, it refuses further batches),
    ``maintenance`` (one round of upkeep: a snapshot when ``compact_every``
    deltas are due, which may change from run to run, and removal of versions
    superseded for ``grace_s`` seconds; None without ``compact_every``) and
    ``rejects`` (with ``rejects_root`` the rejects are written by a second
    query). Every batch observes ``messages`` (messages, rejects) and
    ``players`` (players_changed); see ``streaming.metrics``."""
    spark = messages.sparkSession
    if has_versions(spark, view_root) and "offsets" not in folder_names(spark, checkpoint):
        raise ValueError(f"{view_root} has versions of another checkpoint; {checkpoint} is new")
    parsed = parse_messages(messages, order_cols, mode)
    counted = parsed.observe(
        "messages", F.count(F.lit(1)).alias("messages"), F.count("reason").alias("rejects")
    )
    state = speed_state(counted, order_cols).observe("players", F.count(F.lit(1)).alias("players_changed"))
    gate = Gate()

    def upsert(batch: DataFrame, batch_id: int) -> None:
        gate.enter()
        write_version(batch, view_root, batch_id, once=True)

    writer = (
        state.writeStream.outputMode("update")
        .foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
    )
    if query_name:
        writer = writer.queryName(query_name)
    trigger = {"availableNow": True} if available_now else {"processingTime": processing_time}
    query = writer.trigger(**trigger).start()
    query.gate, query.maintenance, query.rejects = gate, None, None
    if compact_every:
        query.maintenance = lambda every=compact_every: maintain_view(spark, view_root, ["fide_id"], every, grace_s)
    if rejects_root:
        query.rejects = (
            rejected_messages(parsed, order_cols)
            .writeStream.outputMode("append")
            .format("parquet")
            .option("path", rejects_root)
            .option("checkpointLocation", checkpoint.rstrip("/") + "-rejects")
            .trigger(**trigger)
            .start()
        )
    return query


def run_speed_layer(
    spark: SparkSession,
    brokers: str,
    topic: str,
    view_root: str,
    checkpoint: str,
    starting_offsets: str = "latest",
    processing_time: str = "2 seconds",
    compact_every: int | None = 500,
    order_cols: Sequence[str] = ("ts", "part", "seq"),
    options: dict[str, str] | None = None,
    mode: str = PERMISSIVE,
    should_stop=None,
) -> None:
    """Production entry: Kafka topic → speed views, 2-second micro-batches,
    runs until ``should_stop()`` or terminated. Restarts resume from
    ``checkpoint``; ``options`` go to the topic reader (consumer group, rate
    limit, …)."""
    messages = read_kafka_messages(spark, brokers, topic, starting_offsets, **(options or {}))
    query = start_speed_layer(
        messages,
        view_root,
        checkpoint,
        order_cols=order_cols,
        processing_time=processing_time,
        rejects_root=view_root.rstrip("/") + "-rejects",
        compact_every=compact_every,
        mode=mode,
    )
    supervise(query, should_stop)


def update_messages(state: DataFrame) -> DataFrame:
    """One log line per player whose state changed in a micro-batch."""
    return state.select("fide_id", update_message().alias("message"), "stream_count")


def debug_sink(df: DataFrame, rows: int = 10) -> StreamingQuery:
    """Console output of the first rows of every micro-batch (debugging only;
    the views are written by ``start_speed_layer``, never by this sink)."""
    return (
        df.writeStream.outputMode("update")
        .format("console")
        .option("numRows", rows)
        .option("truncate", False)
        .start()
    )


def read_speed_state(spark: SparkSession, view_root: str) -> DataFrame:
    """Current speed-layer state from the view store."""
    return read_view(spark, view_root, ["fide_id"])


def read_speed_checkpoint(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state of the stream itself, as committed in its checkpoint by the
    last batch: the columns of ``speed_state``, one row per player. What the
    view store returns has to be equal to it."""
    state = spark.read.format("statestore").load(checkpoint)
    buffers = state.schema["value"].dataType.fields
    latest, count = (F.col(f"value.`{f.name}`") for f in (buffers[0], buffers[-1]))
    return state.select(
        F.col("key.fide_id").alias("fide_id"), *[latest[c].alias(c) for c in REPORT_FIELDS], count.alias("stream_count")
    )


def run_until_caught_up(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for an availableNow query to finish, however long its backlog, with
    upkeep of its view beside it and at the end; re-raise its failure. With
    ``timeout_s``, a query still running after it is stopped and reported."""
    supervise(query, timeout_s=timeout_s)
