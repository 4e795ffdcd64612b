"""Serving facade: the read and submit requests of the rating pages, each a
method returning a lazy DataFrame over the materialised batch views and the
speed-layer view store.

    svc = RatingService(spark, build_views(...), speed_view_root)
    svc.player_page("1503014")          # history + count + live rating
    svc.find_ids("Hikaru")              # name prefix search

Counts merge the batch count with the live submission count at read time.
Every method is bulk-capable: pass ``None`` to answer for all players.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratinglens.operators import lookup, serving
from ratinglens.operators import series as series_ops
from ratinglens.plans.build import published_paths, read_views
from ratinglens.schemas import COUNTER_CHANGE, SUBMISSION
from ratinglens.streaming import speed


class RatingService:
    def __init__(
        self,
        spark: SparkSession,
        view_paths: dict[str, str],
        speed_root: str | None = None,
        table_prefix: str | None = None,
    ) -> None:
        self.spark = spark
        self.views = read_views(spark, view_paths, table_prefix)
        self.speed_root = speed_root

    @classmethod
    def from_published(
        cls, spark: SparkSession, dst: str, speed_root: str | None = None
    ) -> "RatingService":
        """Serve the newest published build under ``dst``."""
        return cls(spark, published_paths(spark, dst), speed_root)

    # ------------------------------------------------------------ speed side

    def _speed_state(self) -> DataFrame | None:
        if self.speed_root is None:
            return None
        try:
            return speed.read_speed_state(self.spark, self.speed_root)
        except FileNotFoundError:
            return None

    def live(self) -> DataFrame:
        state = self._speed_state()
        if state is None:
            return self.spark.createDataFrame([], SUBMISSION)  # same columns as live_view
        return speed.live_view(state)

    def counts(self) -> DataFrame:
        """(fide_id, batch_count, stream_count, games_count)."""
        state = self._speed_state()
        stream = (
            self.spark.createDataFrame([], COUNTER_CHANGE).withColumnRenamed("games_count", "stream_count")
            if state is None
            else speed.stream_counts(state)
        )
        return serving.games_count_merged(self.views["id_count"], stream)

    # -------------------------------------------------------------- requests

    def player_month(self, id_month_year: str) -> DataFrame:
        """One player-month by its ``ID_month_year`` string."""
        return lookup.player_month(self.views["history"], id_month_year)

    def live_with_count(self, fide_id: str | None = None) -> DataFrame:
        """Live rating with its games count (no live row → no row)."""
        return lookup.live_with_count(self.live(), serving.serving_counts(self.counts()), fide_id)

    def player_page(self, fide_id: str | None = None, strict: bool = False) -> DataFrame:
        """Monthly history with games count and live rating."""
        return lookup.player_page(
            self.views["history"], serving.serving_counts(self.counts()), self.live(), fide_id, strict
        )

    def player_series(self, fide_id: str | None = None) -> DataFrame:
        """Monthly chart series of a player (long format), in date order."""
        hist = self.views["history"]
        if fide_id is not None:
            hist = hist.filter(F.col("fide_id") == F.lit(fide_id))
        points = series_ops.series_monthly(hist)
        return points if fide_id is None else series_ops.in_date_order(points, ["fide_id"])

    def player_history(self, fide_id: str | None = None) -> DataFrame:
        """Monthly history in month order."""
        return lookup.player_history(self.views["history"], fide_id)

    def player_years(self, fide_id: str | None = None) -> DataFrame:
        return lookup.player_years(self.views["by_year"], fide_id)

    def player_years_series(self, fide_id: str | None = None) -> DataFrame:
        by_year = self.views["by_year"]
        if fide_id is not None:
            by_year = by_year.filter(F.col("fide_id") == F.lit(fide_id))
        points = series_ops.series_player_yearly(by_year)
        return points if fide_id is None else series_ops.in_date_order(points, ["fide_id"])

    def federation_years(self, federation: str | None = None) -> DataFrame:
        return lookup.federation_years(self.views["fed_by_year"], federation)

    def federation_series(self, federation: str | None = None) -> DataFrame:
        fed = self.views["fed_by_year"]
        if federation is not None:
            fed = fed.filter(F.col("federation") == F.lit(federation))
        points = series_ops.series_federation_yearly(fed)
        return points if federation is None else series_ops.in_date_order(points, ["federation"])

    def find_ids(self, prefix: str) -> DataFrame:
        return lookup.find_ids(self.views["id_name"], prefix)

    def player_latest(self, fide_id: str | None = None) -> DataFrame:
        return lookup.player_latest(self.live(), fide_id)

    def player_count(self, fide_id: str | None = None) -> DataFrame:
        """(fide_id, games_count) over both layers."""
        return lookup.player_count(serving.serving_counts(self.counts()), fide_id)

    # ---------------------------------------------------------------- submit

    def submit(
        self, reports: DataFrame, message_path: str | None = None, brokers: str | None = None, topic: str | None = None
    ) -> None:
        """Publish rating reports (fide_id, names, three ratings as text,
        plus ts/seq arrival order) as messages for the speed layer: to a
        topic, or as files in ``message_path``."""
        messages = speed.to_messages(reports)
        if topic:
            speed.write_kafka_messages(messages, brokers, topic)
        else:
            speed.write_messages(messages, message_path)
