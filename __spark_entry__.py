"""

``entry(spark)`` runs the flagship query (yearly averages per federation) on
sf0.001; ``queries()`` maps every implemented operator to a callable
``(spark, sf_dir) -> DataFrame`` over the whole driver tables; ``oracle_sql()``
gives the equivalent DuckDB SQL for each query that has one.

The driver tables are bound to the rating model in
``ratinglens.sources.tables`` (players ← customer ⟕ nation, ratings ← orders
per player-month, submissions ← events); the oracle CTEs below state the same
binding in SQL.
"""

from __future__ import annotations

import os
import sys
import warnings
from collections.abc import Callable

# The driver may load this file by path; make the package beside it importable.
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ratinglens.functions import scalar  # noqa: E402
from ratinglens.operators import batch, cells, lookup, series  # noqa: E402
from ratinglens.plans.build import Model, build_views, model_from_tables, read_views  # noqa: E402
from ratinglens.plans.service import RatingService  # noqa: E402
from ratinglens.schemas import JOINED_COLS, RATINGS  # noqa: E402
from ratinglens.session import at_once, scratch_dir  # noqa: E402
from ratinglens.sources import delimited, store, tables  # noqa: E402
from ratinglens.streaming import metrics, speed  # noqa: E402

try:  # the training-data operators are an optional part
    import corpus_pipeline  # noqa: E402
    from ratinglens.llm import queries as llm_queries  # noqa: E402
except ImportError as missing:  # these modules, or a library that they need, are absent
    if missing.name not in ("corpus_pipeline", "ratinglens.llm", "ratinglens.llm.queries"):
        warnings.warn(f"no training-data queries: {missing}", stacklevel=1)
    llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"

# Fixed lookup arguments (the serving forms' sample inputs, picked from data).
PLAYER = "5"
PLAYER_MONTH = "5_7_1995"
FEDERATION = "NATION_0"
NAME_PREFIX = "0000001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: yearly averages per federation on sf0.001."""
    return q_ratings_by_federation_year(spark, SMOKE_DIR)


# ---------------------------------------------------------------- batch layer


def q_players_and_ratings(spark, sf):
    return model_from_tables(spark, sf).joined


def q_ratings_by_federation_year(spark, sf):
    return model_from_tables(spark, sf).fed_by_year


def q_ratings_by_year(spark, sf):
    return model_from_tables(spark, sf).by_year


def q_rating_counts(spark, sf):
    return model_from_tables(spark, sf).batch_counts


def q_current_rating(spark, sf):
    return batch.current_rating(model_from_tables(spark, sf).ratings)


def q_history_view(spark, sf):
    return model_from_tables(spark, sf).history


def q_id_name_view(spark, sf):
    return model_from_tables(spark, sf).id_name


def q_orphan_ratings(spark, sf):
    """Rating rows of players who are not members."""
    return batch.orphan_ratings(tables.members_from_tables(spark, sf), tables.ratings_from_tables(spark, sf))


def q_players_without_ratings(spark, sf):
    """Players without a rating in the first season."""
    m = model_from_tables(spark, sf)
    return batch.players_without_ratings(m.players, m.ratings.filter("year < 1996"))


def q_summary(spark, sf):
    return batch.summary(model_from_tables(spark, sf).joined)


# ----------------------------------------------- the built views, read back

_BUILT: dict[tuple, object] = {}


def _once(spark, sf, name, make):
    """``make()`` once per session and tables: its files are in the shared
    scratch folder."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _BUILT:
        _BUILT[key] = make()
    return _BUILT[key]


def _built_paths(spark, sf):
    def build():
        players, ratings = tables.players_from_tables(spark, sf), tables.ratings_from_tables(spark, sf)
        return build_views(spark, players, ratings, scratch_dir(spark, "views"), unique_ratings=True)

    return _once(spark, sf, "views", build)


def _service(spark, sf):
    """The serving facade over built views and a streamed speed store."""
    return RatingService(spark, *at_once(spark, lambda: _built_paths(spark, sf), lambda: _speed_root(spark, sf)))


def _speed_root(spark, sf):
    return _once(spark, sf, "speed", lambda: _stream_message_files(spark, sf))


def q_built_joined(spark, sf):
    return read_views(spark, _built_paths(spark, sf))["players_and_ratings"]


def q_built_history(spark, sf):
    return read_views(spark, _built_paths(spark, sf))["history"]


def q_built_id_name(spark, sf):
    return read_views(spark, _built_paths(spark, sf))["id_name"]


def q_built_by_year(spark, sf):
    return read_views(spark, _built_paths(spark, sf))["by_year"]


def q_built_fed_by_year(spark, sf):
    return read_views(spark, _built_paths(spark, sf))["fed_by_year"]


def q_built_id_count(spark, sf):
    return read_views(spark, _built_paths(spark, sf))["id_count"]


def q_built_current_rating(spark, sf):
    return read_views(spark, _built_paths(spark, sf))["current_rating"]


def q_upsert_view(spark, sf):
    """The latest report per player by two upserts and a compaction: the
    first half of the events, then the second."""
    subs = tables.submissions_from_tables(spark, sf)
    half = (subs.agg(F.max("seq")).first()[0] or 0) / 2
    root = scratch_dir(spark, "upserts")
    for version, part in enumerate([subs.filter(F.col("seq") <= half), subs.filter(F.col("seq") > half)]):
        latest = cells.latest_version(part, ["fide_id"], ["ts", "seq"])
        store.upsert_view(latest, root, ["fide_id"], version)
    store.maintain_view(spark, root, ["fide_id"], every=2, grace_s=0)
    return store.read_view(spark, root, ["fide_id"])


# --------------------------------------------------------------------- ingest


def q_scan_ratings(spark, sf):
    """Ratings written in the master-data text format, read back typed."""
    path = scratch_dir(spark, "ratings-csv")
    delimited.write_delimited(tables.ratings_from_tables(spark, sf), path)
    return delimited.read_ratings(spark, path)


def q_scan_players(spark, sf):
    path = scratch_dir(spark, "players-csv")
    delimited.write_delimited(tables.players_from_tables(spark, sf), path)
    return delimited.read_players(spark, path)


def q_split_name(spark, sf):
    """Players written with one quoted "Last, First" field, then normalised."""
    path = scratch_dir(spark, "players-raw-csv")
    delimited.write_players_raw(tables.players_from_tables(spark, sf), path)
    return delimited.normalise_players(delimited.read_players_raw(spark, path))


def q_name_quality(spark, sf):
    """Shapes of the raw names of a player file as delivered."""
    path = scratch_dir(spark, "players-raw-csv")
    delimited.write_raw(tables.raw_players_from_tables(spark, sf), path)
    return delimited.name_quality(delimited.read_players_raw(spark, path))


def q_scan_players_raw(spark, sf):
    """The same file, read and normalised: NULL and empty text kept apart."""
    path = scratch_dir(spark, "players-raw-csv")
    delimited.write_raw(tables.raw_players_from_tables(spark, sf), path)
    return delimited.normalise_players(delimited.read_players_raw(spark, path))


def q_scalar_functions(spark, sf):
    """The scalar helpers over customer and event columns."""
    c = tables.load(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    count = F.abs(F.floor("c_acctbal")).cast("bigint")
    return c.select(
        "c_custkey",
        scalar.strip_prefix("c_name", "Customer#").alias("stripped"),
        scalar.strip_prefix("c_name", "Supplier#").alias("not_stripped"),
        scalar.drop_first("c_name").alias("dropped"),
        scalar.pad_month((F.col("c_custkey") % 12 + 1).cast("string")).alias("padded"),
        scalar.to_number(F.split("c_name", "#")[1]).alias("number"),
        scalar.to_number("c_name").alias("no_number"),
        scalar.first_of_month(F.lit(1999), F.col("c_custkey") % 14).alias("month_start"),
        scalar.be_long(scalar.be_bytes(count)).alias("counter"),
        F.hex(scalar.be_bytes(count)).alias("counter_bytes"),
        scalar.update_message(F.col("c_custkey")).alias("message"),
    )


def q_latest_version(spark, sf):
    subs = tables.submissions_from_tables(spark, sf)
    return cells.latest_version(subs, ["fide_id"], ["ts", "seq"])


def q_binary_cells(spark, sf):
    """Live rows with their count → binary cells → text cells → rows."""
    m = _members(spark, sf)
    rows = lookup.live_with_count(m.live, m.batch_counts).drop("has_count")
    coded = cells.to_binary_cells(rows, "fide_id", ["games_count"])
    values = [c for c in rows.columns if c != "fide_id"]
    return cells.cells_to_rows(cells.text_cells(coded, ["games_count"]), values, {"games_count": "bigint"})


def q_ingest_audit(spark, sf):
    """Ratings written as text with a fault in some lines, audited."""
    r = tables.ratings_from_tables(spark, sf)
    fault = F.pmod(F.col("fide_id").cast("long") * 5 + F.col("year") + F.col("month"), F.lit(9))
    text = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in r.columns])
    line = (
        F.when(fault == 1, F.regexp_replace(text, ",[^,]*$", ",n/a"))
        .when(fault == 2, F.regexp_replace(text, ",[^,]*$", ""))
        .when(fault == 3, F.concat(text, F.lit(",7")))
        .when(fault == 4, F.regexp_replace(text, ",[^,]*,[^,]*$", ",12x,,9"))
        .otherwise(text)
    )
    path = scratch_dir(spark, "ratings-faults")
    delimited.write_lines(r.select(line.alias("line")), path, ",".join(r.columns))
    return delimited.audit_counts(delimited.audit_delimited(spark, path, RATINGS))


def q_cells_to_rows(spark, sf):
    """History view → key/column/value cells → rows again."""
    hist = model_from_tables(spark, sf).history
    types = {c: t for c, t in hist.dtypes if c != "row_key"}
    value_cols = [c for c in hist.columns if c != "row_key"]
    cs = cells.to_cells(hist, "row_key")
    return cells.cells_to_rows(cs, value_cols, types)


# -------------------------------------------------------------------- lookups


def q_player_month(spark, sf):
    return _service(spark, sf).player_month(PLAYER_MONTH)


def q_player_month_bulk(spark, sf):
    """Two ``ID_month_year`` lookups per order — its month and the month
    after, in which most customers have no order — and one malformed key."""
    o = tables.load(spark, sf, "orders")
    customer = F.col("o_custkey").cast("string")

    def key(date):
        return F.concat_ws("_", customer, F.month(date).cast("string"), F.year(date).cast("string"))

    after = F.add_months(F.trunc("o_orderdate", "month"), 1)
    keys = F.array(key(F.col("o_orderdate")), key(after), F.concat(customer, F.lit("_x_1995")))
    req = o.select(F.explode(keys).alias("lookup_key"))
    return lookup.player_month_bulk(model_from_tables(spark, sf).history, req)


def q_find_ids(spark, sf):
    return _service(spark, sf).find_ids(NAME_PREFIX)


def q_first_row(spark, sf):
    """First history row, in key order, of the keys that start with a text."""
    return lookup.first_row(_service(spark, sf).views["history"], "row_key", PLAYER)


def q_first_rows(spark, sf):
    """The same for every customer's number (a prefix of longer numbers too)
    and for each with a separator and a year."""
    c = F.col("c_custkey").cast("string")
    asked = F.array(c, F.concat(c, F.lit("_")), F.concat(c, F.lit("_1995")))
    prefixes = tables.load(spark, sf, "customer").select(F.explode(asked).alias("prefix"))
    return lookup.first_rows(model_from_tables(spark, sf).history, "row_key", prefixes)


def q_player_history(spark, sf):
    return _service(spark, sf).player_history(PLAYER)


def q_player_years(spark, sf):
    return _service(spark, sf).player_years(PLAYER)


def q_federation_years(spark, sf):
    return _service(spark, sf).federation_years(FEDERATION)


def q_player_latest(spark, sf):
    return _service(spark, sf).player_latest(PLAYER)


def q_player_count(spark, sf):
    return _service(spark, sf).player_count(PLAYER)


def q_players_with_live(spark, sf):
    m = model_from_tables(spark, sf)
    return lookup.players_with_live(m.players, m.live)


def _members(spark, sf):
    """The model of the members: others have live ratings but no history."""
    m = model_from_tables(spark, sf)
    return Model(tables.members_from_tables(spark, sf), m.ratings, m.submissions)


def q_live_with_count(spark, sf):
    """Live rows with the members' batch counts: others have no count."""
    m = _members(spark, sf)
    return lookup.live_with_count(m.live, m.batch_counts)


def q_player_page(spark, sf):
    return _service(spark, sf).player_page(PLAYER)


def q_player_page_all(spark, sf):
    """Every member's page, on built views; others have a live rating only."""

    def build():
        m = _members(spark, sf)
        return build_views(spark, m.players, m.ratings, scratch_dir(spark, "member-views"), unique_ratings=True)

    made = at_once(spark, lambda: _once(spark, sf, "member-views", build), lambda: _speed_root(spark, sf))
    return RatingService(spark, *made).player_page()


def q_games_count_merged(spark, sf):
    return _members(spark, sf).merged_counts


# ---------------------------------------------------------------- speed layer


def _stream_messages(spark, messages, compact_every, metered=False):
    """Messages through the speed layer (availableNow) into a fresh store;
    with ``metered`` also the metrics of its batches."""
    root = scratch_dir(spark, "speed")
    listener = metrics.BatchMetrics(spark, f"{root}/metrics", root) if metered else None
    if metered:
        spark.streams.addListener(listener)
    q = speed.start_speed_layer(
        messages, f"{root}/view", f"{root}/checkpoint", available_now=True, compact_every=compact_every, query_name=root
    )
    speed.run_until_caught_up(metrics.with_metrics(q, listener) if metered else q)
    if metered:
        spark.streams.removeListener(listener)
    return f"{root}/view"


def _mixed_messages(spark, sf):
    """Every event as a message, of every kind: of ten one is cut short, one
    has a field more, one no id, one is no object."""
    subs = tables.submissions_from_tables(spark, sf)
    kind = F.col("seq") % 10
    value = (
        F.when(kind == 1, F.expr("substring(value, 1, length(value) - 3)"))
        .when(kind == 3, F.regexp_replace("value", "}$", ',"club":"x"}'))
        .when(kind == 5, F.regexp_replace("value", '"fide_id"', '"id"'))
        .when(kind == 7, F.lit("[1, 2]"))
        .otherwise(F.col("value"))
    )
    return speed.to_messages(subs).withColumn("value", value)


def _stream_mixed_files(spark, sf):
    """The mixed messages in four files (by seq modulo 4), a batch each, and
    the checkpoint, view and metrics of the run."""
    published, messages = scratch_dir(spark, "mixed-messages"), _mixed_messages(spark, sf)
    for k in range(4):
        speed.write_messages(messages.filter(F.col("seq") % 4 == k).coalesce(1), published)
    files = speed.read_message_files(spark, published, max_files_per_trigger=1)
    return _stream_messages(spark, files, compact_every=2, metered=True).removesuffix("/view")


def _mixed(spark, sf):
    return _once(spark, sf, "mixed", lambda: _stream_mixed_files(spark, sf))


def q_stream_metrics(spark, sf):
    """Messages, rejects and changed players of every batch, as observed."""
    got = metrics.read_metrics(spark, f"{_mixed(spark, sf)}/metrics")
    return got.select("messages", "rejects", "players_changed")


def q_stream_state(spark, sf):
    """The state in the checkpoint, read by itself; equal to the view."""
    return speed.read_speed_checkpoint(spark, f"{_mixed(spark, sf)}/checkpoint")


def q_stream_view(spark, sf):
    """The view that the same stream has written."""
    return speed.read_speed_state(spark, f"{_mixed(spark, sf)}/view")


def q_message_reasons(spark, sf):
    """Messages per reject reason, unknown fields being one."""
    return speed.message_reasons(_mixed_messages(spark, sf), speed.STRICT)


def _stream_message_files(spark, sf):
    """Every event published as a message in one of six files, streamed in
    six micro-batches with a snapshot at every second one."""
    published = scratch_dir(spark, "messages")
    speed.write_messages(speed.to_messages(tables.submissions_from_tables(spark, sf)).repartition(6), published)
    files = speed.read_message_files(spark, published, max_files_per_trigger=1)
    return _stream_messages(spark, files, compact_every=2)


def q_stream_latest(spark, sf):
    return speed.live_view(speed.read_speed_state(spark, _speed_root(spark, sf)))


def q_stream_counts(spark, sf):
    """The events table as a stream of its files."""
    events = tables.stream_table(spark, sf, "events").select("event_id", "ts", "user_id", "value")
    messages = speed.to_messages(tables.submissions_from_events(events))
    return speed.stream_counts(speed.read_speed_state(spark, _stream_messages(spark, messages, 500)))


def q_submit_json(spark, sf):
    return speed.to_messages(tables.submissions_from_tables(spark, sf))


# --------------------------------------------------------------------- series


def q_series_monthly(spark, sf):
    return series.series_monthly(model_from_tables(spark, sf).history)


def q_series_player_yearly(spark, sf):
    return series.series_player_yearly(model_from_tables(spark, sf).by_year)


def q_series_federation_yearly(spark, sf):
    return series.series_federation_yearly(model_from_tables(spark, sf).fed_by_year)


def q_series_packed(spark, sf):
    """The packed points, one row per position."""
    s = series.series_monthly(model_from_tables(spark, sf).history)
    packed = series.series_packed(s, ["fide_id"])
    rows = packed.select("fide_id", "discipline", F.posexplode("points").alias("position", "point"))
    return rows.select("fide_id", "discipline", "position", "point.date", "point.rating")


def q_series_text(spark, sf):
    s = series.series_monthly(model_from_tables(spark, sf).history)
    return series.series_text(s, ["fide_id"])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        name[2:]: fn
        for name, fn in globals().items()
        if name.startswith("q_") and callable(fn)
    }
    if llm_queries:
        found |= llm_queries.queries() | {"pipeline": corpus_pipeline.run}
    return found


# --------------------------------------------------------------------- oracle

# The binding of the driver tables, stated in SQL (mirrors sources/tables.py).
_CTES = """
WITH players AS (
  SELECT CAST(c.c_custkey AS VARCHAR) AS fide_id,
         string_split(c.c_name, '#')[1] AS last_name,
         string_split(c.c_name, '#')[2] AS first_name,
         n.n_name AS federation,
         CAST(NULL AS VARCHAR) AS gender,
         c.c_mktsegment AS title,
         CAST(NULL AS BIGINT) AS yob
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
ratings AS (
  SELECT CAST(o_custkey AS VARCHAR) AS fide_id,
         CAST(year(o_orderdate) AS BIGINT) AS year,
         CAST(month(o_orderdate) AS BIGINT) AS month,
         max(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH')
                  THEN CAST(trunc(o_totalprice / 100.0) AS BIGINT) END) AS rating_standard,
         max(CASE WHEN o_orderpriority IN ('3-MEDIUM')
                  THEN CAST(trunc(o_totalprice / 100.0) AS BIGINT) END) AS rating_rapid,
         max(CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')
                  THEN CAST(trunc(o_totalprice / 100.0) AS BIGINT) END) AS rating_blitz
  FROM orders
  GROUP BY 1, 2, 3
),
joined AS (
  SELECT r.fide_id, p.last_name, p.first_name, p.federation, p.gender, p.title, p.yob,
         r.year, r.month, r.rating_standard, r.rating_rapid, r.rating_blitz
  FROM ratings r JOIN players p ON r.fide_id = p.fide_id
),
history AS (
  SELECT fide_id || '_' || CAST(year AS VARCHAR) || '_' || CAST(month AS VARCHAR) AS row_key, *
  FROM joined
),
by_year AS (
  SELECT fide_id || '_' || CAST(year AS VARCHAR) AS row_key,
         fide_id, last_name, first_name, federation, gender, title, yob, year,
         CAST(trunc(avg(rating_standard)) AS BIGINT) AS rating_standard,
         CAST(trunc(avg(rating_rapid)) AS BIGINT) AS rating_rapid,
         CAST(trunc(avg(rating_blitz)) AS BIGINT) AS rating_blitz
  FROM joined
  GROUP BY fide_id, last_name, first_name, federation, gender, title, yob, year
),
fed_by_year AS (
  SELECT federation || '_' || CAST(year AS VARCHAR) AS row_key, federation, year,
         CAST(trunc(avg(rating_standard)) AS BIGINT) AS rating_standard,
         CAST(trunc(avg(rating_rapid)) AS BIGINT) AS rating_rapid,
         CAST(trunc(avg(rating_blitz)) AS BIGINT) AS rating_blitz
  FROM joined
  GROUP BY federation, year
),
submissions AS (
  SELECT CAST(user_id AS VARCHAR) AS fide_id,
         lpad(CAST(user_id AS VARCHAR), 9, '0') AS first_name,
         'Customer' AS last_name,
         CAST(CAST(trunc(value * 10.0) AS BIGINT) AS VARCHAR) AS rating_standard,
         CAST(CAST(trunc(value * 9.0) AS BIGINT) AS VARCHAR) AS rating_rapid,
         CAST(CAST(trunc(value * 8.0) AS BIGINT) AS VARCHAR) AS rating_blitz,
         ts, event_id AS seq
  FROM events
),
latest_sub AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY fide_id ORDER BY ts DESC, seq DESC) AS rn
    FROM submissions
  ) WHERE rn = 1
),
live AS (
  SELECT fide_id, first_name, last_name, rating_standard, rating_rapid, rating_blitz
  FROM latest_sub
),
scounts AS (
  SELECT fide_id, count(*) AS stream_count FROM submissions GROUP BY fide_id
),
bcounts AS (
  SELECT fide_id, count(*) AS games_count FROM joined GROUP BY fide_id
),
merged AS (
  SELECT coalesce(b.fide_id, s.fide_id) AS fide_id,
         b.games_count AS batch_count,
         s.stream_count AS stream_count,
         coalesce(b.games_count, 0) + coalesce(s.stream_count, 0) AS games_count
  FROM bcounts b FULL OUTER JOIN scounts s ON b.fide_id = s.fide_id
),
page AS (
  SELECT h.*, m.games_count,
         l.rating_standard AS rating_standard_curr,
         l.rating_rapid AS rating_rapid_curr,
         l.rating_blitz AS rating_blitz_curr,
         m.fide_id IS NOT NULL AS has_count,
         l.fide_id IS NOT NULL AS has_live
  FROM history h
  LEFT JOIN merged m ON h.fide_id = m.fide_id
  LEFT JOIN live l ON h.fide_id = l.fide_id
),
members AS (
  SELECT p.* FROM players p JOIN customer c ON p.fide_id = CAST(c.c_custkey AS VARCHAR) WHERE c_acctbal >= 0
),
mcounts AS (
  SELECT r.fide_id, count(*) AS games_count FROM ratings r JOIN members m ON r.fide_id = m.fide_id GROUP BY r.fide_id
),
mmerged AS (
  SELECT coalesce(b.fide_id, s.fide_id) AS fide_id, b.games_count AS batch_count, s.stream_count,
         coalesce(b.games_count, 0) + coalesce(s.stream_count, 0) AS games_count
  FROM mcounts b FULL OUTER JOIN scounts s ON b.fide_id = s.fide_id
),
mpage AS (
  SELECT h.* REPLACE (coalesce(h.fide_id, l.fide_id) AS fide_id), g.games_count,
         l.rating_standard AS rating_standard_curr,
         l.rating_rapid AS rating_rapid_curr,
         l.rating_blitz AS rating_blitz_curr,
         g.fide_id IS NOT NULL AS has_count,
         l.fide_id IS NOT NULL AS has_live
  FROM (SELECT * FROM history WHERE fide_id IN (SELECT fide_id FROM members)) h
  FULL OUTER JOIN live l ON h.fide_id = l.fide_id
  LEFT JOIN mmerged g ON coalesce(h.fide_id, l.fide_id) = g.fide_id
),
raw AS (
  SELECT CAST(c_custkey AS VARCHAR) AS fide_id, c_mktsegment AS title,
         CASE WHEN c_acctbal < 0 THEN string_split(c_name, '#')[1]
              WHEN c_acctbal > 9000 THEN replace(c_name, '#', ', ') || ', Jr.'
              WHEN c_acctbal NOT BETWEEN 0 AND 100 THEN replace(c_name, '#', ', ') END AS name
  FROM customer
)
"""

_JOINED = ", ".join(JOINED_COLS)


def _series(src: str, ids: str, date: str) -> str:
    parts = [
        f"SELECT {ids}, {date} AS date, '{d}' AS discipline, rating_{d} AS rating FROM {src}"
        for d in ("standard", "rapid", "blitz")
    ]
    return " UNION ALL ".join(parts)


# The state of the stream of mixed messages: those without a report left out.
_MIXED = """
        SELECT fide_id, first_name, last_name, rating_standard, rating_rapid, rating_blitz, n AS stream_count FROM (
          SELECT *, row_number() OVER (PARTITION BY fide_id ORDER BY ts DESC, seq DESC) AS rn,
                 count(*) OVER (PARTITION BY fide_id) AS n
          FROM submissions WHERE seq % 10 NOT IN (1, 5, 7))
        WHERE rn = 1"""

_ORACLE = {
    "players_and_ratings": f"SELECT {_JOINED} FROM joined",
    "ratings_by_federation_year": "SELECT * FROM fed_by_year",
    "ratings_by_year": "SELECT * FROM by_year",
    "rating_counts": "SELECT * FROM bcounts",
    "current_rating": """
        SELECT fide_id, year, month, rating_standard, rating_rapid, rating_blitz FROM (
          SELECT *, row_number() OVER (PARTITION BY fide_id ORDER BY year DESC, month DESC) AS rn
          FROM ratings) WHERE rn = 1""",
    "history_view": "SELECT * FROM history",
    "id_name_view": """
        SELECT first_name || '_' || last_name || '_' || fide_id AS name_key,
               first_name, last_name, fide_id FROM players""",
    "orphan_ratings": """
        SELECT * FROM ratings r
        WHERE NOT EXISTS (SELECT 1 FROM members p WHERE p.fide_id = r.fide_id)""",
    "players_without_ratings": """
        SELECT * FROM players p
        WHERE NOT EXISTS (SELECT 1 FROM ratings r WHERE r.fide_id = p.fide_id AND r.year < 1996)""",
    "built_joined": f"SELECT {_JOINED} FROM joined",
    "built_history": "SELECT * FROM history",
    "built_id_name": """
        SELECT first_name || '_' || last_name || '_' || fide_id AS name_key,
               first_name, last_name, fide_id FROM players""",
    "built_by_year": "SELECT * FROM by_year",
    "built_fed_by_year": "SELECT * FROM fed_by_year",
    "built_id_count": "SELECT * FROM bcounts",
    "built_current_rating": """
        SELECT fide_id, year, month, rating_standard, rating_rapid, rating_blitz FROM (
          SELECT *, row_number() OVER (PARTITION BY fide_id ORDER BY year DESC, month DESC) AS rn
          FROM ratings) WHERE rn = 1""",
    "upsert_view": """
        SELECT fide_id, first_name, last_name, rating_standard, rating_rapid, rating_blitz, ts, seq FROM (
          SELECT *, row_number() OVER (PARTITION BY fide_id ORDER BY late DESC, ts DESC, seq DESC) AS rn
          FROM (SELECT *, seq > (SELECT max(seq) / 2 FROM submissions) AS late FROM submissions))
        WHERE rn = 1""",
    "scalar_functions": """
        SELECT c_custkey, substr(c_name, 10) AS stripped, CAST(NULL AS VARCHAR) AS not_stripped,
               substr(c_name, 2) AS dropped, lpad(CAST(c_custkey % 12 + 1 AS VARCHAR), 2, '0') AS padded,
               CAST(string_split(c_name, '#')[2] AS BIGINT) AS number, CAST(NULL AS BIGINT) AS no_number,
               CASE WHEN c_custkey % 14 BETWEEN 1 AND 12 THEN make_date(1999, c_custkey % 14, 1) END AS month_start,
               CAST(abs(floor(c_acctbal)) AS BIGINT) AS counter,
               lpad(hex(CAST(abs(floor(c_acctbal)) AS BIGINT)), 16, '0') AS counter_bytes,
               'Updated speed layer for player' || c_custkey AS message
        FROM customer""",
    "scan_players_raw": """
        SELECT fide_id, string_split(name, ', ')[1] AS last_name,
               CASE WHEN contains(name, ', ') THEN substr(name, strpos(name, ', ') + 2) END AS first_name,
               '' AS federation, CAST(NULL AS VARCHAR) AS gender, title, CAST(NULL AS BIGINT) AS yob
        FROM raw""",
    "summary": """
        SELECT count(DISTINCT fide_id) AS players, count(*) AS rating_rows,
               min(year) AS first_year, max(year) AS last_year,
               count(DISTINCT year * 100 + month) AS months
        FROM joined""",
    "scan_ratings": "SELECT * FROM ratings",
    "scan_players": "SELECT * FROM players",
    "split_name": "SELECT * FROM players",
    "name_quality": """
        SELECT shape, count(*) AS n_rows FROM (
          SELECT CASE WHEN name IS NULL THEN 'null'
                      WHEN length(name) - length(replace(name, ',', '')) = 1 THEN 'ok'
                      WHEN length(name) - length(replace(name, ',', '')) = 0 THEN 'no_comma'
                      ELSE 'extra_comma' END AS shape
          FROM raw
        ) GROUP BY shape""",
    "latest_version": """
        SELECT fide_id, first_name, last_name, rating_standard, rating_rapid, rating_blitz, ts, seq
        FROM latest_sub""",
    "cells_to_rows": """
        SELECT row_key AS key, fide_id, last_name, first_name, federation, gender, title, yob,
               year, month, rating_standard, rating_rapid, rating_blitz
        FROM history""",
    "player_month": f"""
        SELECT * FROM history
        WHERE fide_id || '_' || CAST(month AS VARCHAR) || '_' || CAST(year AS VARCHAR) = '{PLAYER_MONTH}'""",
    "player_month_bulk": """
        SELECT q.lookup_key, h.row_key IS NOT NULL AS found, h.*
        FROM (SELECT CAST(o_custkey AS VARCHAR) || '_' || CAST(month(d) AS VARCHAR)
                     || '_' || CAST(year(d) AS VARCHAR) AS lookup_key
              FROM (SELECT o_custkey, o_orderdate AS d FROM orders
                    UNION ALL SELECT o_custkey, date_trunc('month', o_orderdate) + INTERVAL 1 MONTH FROM orders)
              UNION ALL SELECT CAST(o_custkey AS VARCHAR) || '_x_1995' FROM orders) q
        LEFT JOIN history h
          ON q.lookup_key = h.fide_id || '_' || CAST(h.month AS VARCHAR) || '_' || CAST(h.year AS VARCHAR)""",
    "find_ids": f"""
        SELECT first_name, last_name, fide_id FROM players
        WHERE starts_with(first_name || '_' || last_name || '_' || fide_id, '{NAME_PREFIX}')""",
    "player_history": f"SELECT * FROM history WHERE fide_id = '{PLAYER}'",
    "player_years": f"SELECT * FROM by_year WHERE fide_id = '{PLAYER}'",
    "federation_years": f"SELECT * FROM fed_by_year WHERE federation = '{FEDERATION}'",
    "player_latest": f"SELECT * FROM live WHERE fide_id = '{PLAYER}'",
    "player_count": f"SELECT fide_id, games_count FROM merged WHERE fide_id = '{PLAYER}'",
    "players_with_live": """
        SELECT * FROM players p WHERE EXISTS (SELECT 1 FROM live l WHERE l.fide_id = p.fide_id)""",
    "live_with_count": """
        SELECT l.*, m.games_count, m.fide_id IS NOT NULL AS has_count
        FROM live l LEFT JOIN mcounts m ON l.fide_id = m.fide_id""",
    "player_page": f"SELECT * FROM page WHERE fide_id = '{PLAYER}'",
    "player_page_all": "SELECT * FROM mpage",
    "games_count_merged": "SELECT * FROM mmerged",
    "stream_latest": "SELECT * FROM live",
    "stream_counts": "SELECT * FROM scounts",
    "submit_json": """
        SELECT to_json(struct_pack(fide_id := fide_id, first_name := first_name,
                                   last_name := last_name, rating_standard := rating_standard,
                                   rating_rapid := rating_rapid, rating_blitz := rating_blitz))::VARCHAR AS value,
               ts, seq
        FROM submissions""",
    "first_row": f"SELECT * FROM history WHERE starts_with(row_key, '{PLAYER}') ORDER BY row_key LIMIT 1",
    "first_rows": """
        SELECT q.prefix, h.row_key IS NOT NULL AS found, h.*
        FROM (SELECT unnest([c, c || '_', c || '_1995']) AS prefix
              FROM (SELECT CAST(c_custkey AS VARCHAR) AS c FROM customer)) q
        LEFT JOIN (SELECT p, min(row_key) AS k
                   FROM (SELECT row_key, unnest([row_key[:i] FOR i IN range(1, length(row_key) + 1)]) AS p FROM history)
                   GROUP BY p) f ON f.p = q.prefix
        LEFT JOIN history h ON h.row_key = f.k""",
    "binary_cells": """
        SELECT l.fide_id AS key, first_name, last_name, rating_standard, rating_rapid, rating_blitz, m.games_count
        FROM live l LEFT JOIN mcounts m ON l.fide_id = m.fide_id""",
    "ingest_audit": """
        SELECT reason, count(*) AS n_lines FROM (
          SELECT unnest(CASE (CAST(fide_id AS BIGINT) * 5 + year + month) % 9
                        WHEN 1 THEN ['bad_number'] WHEN 2 THEN ['missing_fields']
                        WHEN 3 THEN ['extra_fields'] WHEN 4 THEN ['bad_number', 'extra_fields'] END) AS reason
          FROM ratings) GROUP BY reason""",
    "message_reasons": """
        SELECT CASE seq % 10 WHEN 1 THEN 'bad_json' WHEN 3 THEN 'unknown_field' WHEN 5 THEN 'unknown_field'
               WHEN 7 THEN 'bad_json' END AS reason, count(*) AS n_messages
        FROM submissions GROUP BY 1""",
    "stream_metrics": """
        SELECT count(*) AS messages, count(*) FILTER (WHERE seq % 10 IN (1, 5, 7)) AS rejects,
               count(DISTINCT fide_id) FILTER (WHERE seq % 10 NOT IN (1, 5, 7)) AS players_changed
        FROM submissions GROUP BY seq % 4""",
    "stream_state": _MIXED,
    "stream_view": _MIXED,
    "series_monthly": _series("joined", "fide_id, year, month", "make_date(year, month, 1)"),
    "series_player_yearly": _series("by_year", "fide_id, year", "make_date(year, 1, 1)"),
    "series_federation_yearly": _series("fed_by_year", "federation, year", "make_date(year, 1, 1)"),
    "series_packed": f"""
        SELECT fide_id, discipline, CAST(row_number() OVER (PARTITION BY fide_id, discipline ORDER BY date) - 1 AS INTEGER)
               AS position, date, rating
        FROM ({_series("joined", "fide_id, year, month", "make_date(year, month, 1)")})""",
    "series_text": f"""
        SELECT fide_id, discipline,
               '[' || string_agg('["' || CAST(date AS VARCHAR) || '",'
                                 || coalesce(CAST(rating AS VARCHAR), 'null') || ']', ',' ORDER BY date)
                   || ']' AS points_json
        FROM ({_series("joined", "fide_id, year, month", "make_date(year, month, 1)")})
        GROUP BY fide_id, discipline""",
}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query over the pre-registered driver views; queries
    without an entry are checked by pytest."""
    found = {name: _CTES + sql for name, sql in _ORACLE.items()}
    if llm_queries:
        found |= llm_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
