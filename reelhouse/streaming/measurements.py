"""Measured seats as a stream: eligibility, late rows, idempotent batch sink, side outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reelhouse.functions import time as tm
from reelhouse.operators.match_screen import auditorium_offers
from reelhouse.operators.providers import measuring_window, provider_of
from reelhouse.plans.measurements import apply_resolved, screen_lookup, with_path
from reelhouse.schemas import SCHEMAS
from reelhouse.session import children, complete, scratch, written
from reelhouse.streaming.showing_state import ShowingState, day_of

UPDATE_COLUMNS = ["id", "seats_sold", "screen_id", "scraped_at", "path", "measured_at", "bucket", "day"]


def measurement_stream(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """Landed measurement files as a stream."""
    reader = spark.readStream.schema(SCHEMAS["measurements"])
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def theater_windows(theaters: DataFrame) -> DataFrame:
    """theater_id, provider and the first and last second around a start at which its shows may be measured."""
    provider = provider_of(F.col("name"))
    first, last = measuring_window(provider, F.col("name"))
    return theaters.select(F.col("id").alias("theater_id"), provider.alias("provider"), first.alias("_first"), last.alias("_last"))


def with_window(measurements: DataFrame, showings: DataFrame, theaters: DataFrame) -> DataFrame:
    """Measurements with the window of their show; rows of unknown shows keep NULL bounds.

    Works on a stream (stream-static join) as on a table.
    """
    return _with_window(measurements, showings, theater_windows(theaters))


def _with_window(measurements: DataFrame, showings: DataFrame, windows: DataFrame) -> DataFrame:
    starts = showings.select(F.col("id").alias("showing_id"), "start_at")
    joined = measurements.join(starts, "showing_id", "left").join(windows, "theater_id", "left")
    return joined.select(
        *measurements.columns, "provider",
        (F.col("start_at") + F.make_dt_interval(secs=F.col("_first"))).alias("window_start"),
        (F.col("start_at") + F.make_dt_interval(secs=F.col("_last"))).alias("window_end"),
    )


def rejection() -> Column:
    """Why a measurement with its window cannot be used; NULL when it can."""
    at = F.col("measured_at")
    return (
        F.when(F.col("showing_id").isNull() | at.isNull(), "incomplete")
        .when(F.col("window_end").isNull(), "unknown_show")
        .when(F.col("provider").isNull(), "unmapped_theater")
        .when(at > F.col("window_end"), "past_window")
        .when(at < F.col("window_start"), "before_window")
        .when(tm.in_quiet_hours(at), "quiet_hours")
    )


def accepted(windowed: DataFrame) -> DataFrame:
    return windowed.where(rejection().isNull())


def rejected(windowed: DataFrame) -> DataFrame:
    """Side output: unusable measurements with the reason."""
    return windowed.withColumn("error", rejection()).where(F.col("error").isNotNull())


#: What a batch leaves: measurements by outcome, and the updates of the state.
RESOLVED = ["path", "matched_screen", "matched_seats"]
UPDATED, SUPERSEDED, REJECTED = "updated", "superseded", "rejected"


def routed(batch: DataFrame, state: DataFrame, screens: DataFrame, windows: DataFrame, offers: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Every row of the batch once, with its outcome and, where it was rejected, the reason.

    Of the usable measurements of a show the one taken last updates it, unless the state already has a later one; the
    others are superseded, replays of the same row too. A row is rejected as rejection() says, or because it gives no
    seats (no_seats) or a seat grid that fits no screen (no_screen). `state` holds (id, start_at, measured_at),
    `windows` is theater_windows(), `offers` the auditorium_offers() of the screens. Judged rows are written once, since the
    winners are found among them and laid against them.
    """
    names = batch.columns
    numbered = batch.withColumn("_row", F.monotonically_increasing_id())
    found = with_path(numbered, screen_lookup(batch, screens, offers))
    windowed = _with_window(found, state, windows)
    unfit = F.when(F.col("path") == "skipped", F.when(F.col("seats_remaining").isNull(), "no_seats").otherwise("no_screen"))
    judged = windowed.withColumn("error", F.coalesce(rejection(), unfit)).select(*names, *RESOLVED, "_row", "error")
    judged = written(judged, "judged")
    rest = [c for c in names if c not in ("showing_id", "measured_at")]
    winners = judged.where(F.col("error").isNull()).groupBy("showing_id").agg(F.max(F.struct("measured_at", *rest, "_row")).alias("_best"))
    last = state.select(F.col("id").alias("showing_id"), F.col("measured_at").alias("_last"))
    winners = winners.join(last, "showing_id", "left").select("showing_id", F.col("_best._row").alias("_winner"), (F.col("_last") > F.col("_best.measured_at")).alias("_late"))
    stands = (F.col("_row") == F.col("_winner")) & ~F.coalesce("_late", F.lit(False))
    outcome = F.when(F.col("error").isNotNull(), REJECTED).when(stands, UPDATED).otherwise(SUPERSEDED)
    return judged.join(winners, "showing_id", "left").select(*names, *RESOLVED, "error", outcome.alias("outcome"))


class ShowingUpdates:
    """The measurement stream's sink: updates of the showings, one folder per flush.

    A flush replaces its own folders, so a batch run again after a failure leaves the same tables. It reads the state of
    its own shows only (see showing_state), and every `compact_every` batches the updates so far are laid over the state.

    Measurements may come in any order and more than once, however late: the usable one taken last wins. Every row of a
    flush ends in exactly one of the folders updated, superseded and rejected under `routed`.

    Rows wait in `buffer` until `flush_rows` of them have come, or `flush_after` lies between the first and the last time
    of measurement waiting, or one was taken in quiet hours; `flush` writes out what waits when a run ends.
    """

    def __init__(
        self, spark: SparkSession, folder: str, showings: DataFrame, screens: DataFrame, theaters: DataFrame,
        buckets: int = 64, compact_every: int = 20, flush_rows: int = 1, flush_after: str = "3 hours",
    ):
        self.spark, self.folder, self.screens = spark, folder.rstrip("/"), screens
        self.windows = written(theater_windows(theaters), "theater-windows")
        keys, longer = auditorium_offers(screens)
        self.offers = written(keys, "screen-keys"), written(longer, "long-screens")
        self.state = ShowingState(spark, self.folder, showings, buckets)
        self.compact_every, self.flush_rows, self.flush_after = compact_every, flush_rows, flush_after

    def updates(self) -> DataFrame:
        return self.state.updates()

    def current(self) -> DataFrame:
        """Showings with the latest update of each laid over."""
        return self.state.current()

    def outcomes(self) -> DataFrame:
        """All measurements flushed so far with outcome, error and batch_id."""
        return self.spark.read.parquet(f"{self.folder}/routed")

    def rejections(self) -> DataFrame:
        return self.outcomes().where(F.col("outcome") == REJECTED)

    def superseded(self) -> DataFrame:
        return self.outcomes().where(F.col("outcome") == SUPERSEDED)

    def _flushed(self, batch_id: int) -> bool:
        return complete(self.spark, f"{self.folder}/updates/batch_id={batch_id}")

    def _waiting(self, batch_id: int) -> list[str]:
        """Buffer folders of the batches behind the last flush, up to this one."""
        first = batch_id
        while first > 0 and not self._flushed(first - 1) and complete(self.spark, f"{self.folder}/buffer/batch_id={first - 1}"):
            first -= 1
        return [f"{self.folder}/buffer/batch_id={n}" for n in range(first, batch_id + 1)]

    def apply_batch(self, batch: DataFrame, batch_id: int) -> None:
        if self.flush_rows <= 1:
            return self._flush(batch, batch_id)
        batch.write.mode("overwrite").parquet(f"{self.folder}/buffer/batch_id={batch_id}")
        waiting = self.spark.read.schema(batch.schema).parquet(*self._waiting(batch_id))
        span = F.max("measured_at") - F.min("measured_at")
        due = waiting.agg(
            ((F.count(F.lit(1)) >= self.flush_rows) | F.coalesce(span >= F.expr(f"interval {self.flush_after}"), F.lit(False)) | F.coalesce(F.bool_or(tm.in_quiet_hours(F.col("measured_at"))), F.lit(False))).alias("due")
        ).first()["due"]
        if due:
            self._flush(waiting, batch_id)

    def flush(self) -> None:
        """Write out what waits, under the last batch that came."""
        landed = [int(n.removeprefix("batch_id=")) for n in children(self.spark, f"{self.folder}/buffer")]
        if landed and not self._flushed(max(landed)):
            self._flush(self.spark.read.schema(SCHEMAS["measurements"]).parquet(*self._waiting(max(landed))), max(landed))

    def _flush(self, batch: DataFrame, batch_id: int) -> None:
        if batch_id - 1 - self.state.newest(batch_id)[1] >= self.compact_every:
            self.state.compact(batch_id)
        with scratch(self.spark):
            batch = written(batch, "batch")
            rows = written(self.state.slice(batch, batch_id), "batch-state")
            done = routed(batch, rows, self.screens, self.windows, self.offers)
            done.write.mode("overwrite").partitionBy("outcome").parquet(f"{self.folder}/routed/batch_id={batch_id}")
            taken = self.spark.read.schema(done.schema).parquet(f"{self.folder}/routed/batch_id={batch_id}").where(F.col("outcome") == UPDATED)
            taken = taken.select("showing_id", "seats_remaining", "measured_at", *RESOLVED)
            measured = taken.select(F.col("showing_id").alias("id"), F.col("measured_at").alias("_measured"))
            changed = apply_resolved(rows.drop("measured_at"), self.screens, taken).where(F.col("path").isNotNull()).join(measured, "id")
            changed = changed.withColumns({"measured_at": F.col("_measured"), "bucket": self.state.bucket(F.col("id")), "day": day_of(F.col("start_at"))})
            changed.select(*UPDATE_COLUMNS).write.mode("overwrite").parquet(f"{self.folder}/updates/batch_id={batch_id}")

    def compact(self, folder: str) -> None:
        """Write the current state as a new base table, from which a fresh folder can start."""
        self.current().write.mode("overwrite").parquet(folder)

    def start(self, measurements: DataFrame, interval: str | None = None) -> StreamingQuery:
        """Run the stream: every interval, or once over all that has landed."""
        trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
        return (
            measurements.writeStream.foreachBatch(self.apply_batch)
            .option("checkpointLocation", f"{self.folder}/checkpoint")
            .trigger(**trigger)
            .start()
        )
