"""Measurement stream. Landed files are day slices of the measurements Spark derives from the events."""

import uuid

from pyspark.sql import functions as F

from reelhouse.catalog.queries_screens import APPLIED_STEPS
from reelhouse.catalog.queries_tables import shown
from reelhouse.catalog.queries_worklist import _PROVIDED
from reelhouse.catalog.registry import query
from reelhouse.functions import time as tm
from reelhouse.session import shared_folder
from reelhouse.sources.sample import SampleTables
from reelhouse.streaming import completeness
from reelhouse.streaming import measurements as stream

_WINDOWED = f"""
SELECT m.*, t.provider,
  s.start_at + to_seconds(CASE WHEN t.k = 'cinema beaubien' THEN 729 WHEN t.provider = 'webdev' THEN 825 WHEN t.provider = 'cineplex' THEN 750 WHEN t.provider = 'cinematheque' THEN -420 WHEN t.provider = 'cineentreprise' THEN -435 ELSE 720 END) AS a,
  s.start_at + to_seconds(CASE WHEN t.k = 'cinema beaubien' THEN 900 WHEN t.provider = 'webdev' THEN 1005 WHEN t.provider = 'cineplex' THEN 930 WHEN t.provider = 'cinematheque' THEN -60 WHEN t.provider = 'cineentreprise' THEN 0 ELSE 1020 END) AS b
FROM measurements m JOIN showings s ON s.id = m.showing_id JOIN ({_PROVIDED}) t ON t.id = m.theater_id"""
_REASON = """CASE WHEN provider IS NULL THEN 'unmapped_theater' WHEN measured_at > b THEN 'past_window' WHEN measured_at < a THEN 'before_window'
  WHEN strftime(measured_at - INTERVAL '5' HOUR, '%H:%M') >= '01:00' AND strftime(measured_at - INTERVAL '5' HOUR, '%H:%M') < '09:30' THEN 'quiet_hours' END"""


def windowed(t: SampleTables):
    return stream.with_window(t.measurements, t.showings, t.theaters)


@query("t01_eligible_measurements", f"SELECT showing_id, strftime(measured_at, '%Y-%m-%d %H:%M:%S') AS measured_at FROM ({_WINDOWED}) WHERE measured_at BETWEEN a AND b")
def _(spark, folder):
    at = F.col("measured_at")
    rows = windowed(SampleTables(spark, folder))
    return shown(rows.where(at.between(F.col("window_start"), F.col("window_end"))).select("showing_id", at))


@query("t02_late_measurements", f"SELECT showing_id, {_REASON} AS error FROM ({_WINDOWED}) WHERE {_REASON} IN ('past_window', 'before_window')")
def _(spark, folder):
    rows = stream.rejected(windowed(SampleTables(spark, folder)))
    return rows.where(F.col("error").isin("past_window", "before_window")).select("showing_id", "error")


@query("t07_quiet_hours_gate", f"SELECT theater_id, count(*) AS n FROM ({_WINDOWED}) WHERE {_REASON} IS NULL GROUP BY 1")
def _(spark, folder):
    return stream.accepted(windowed(SampleTables(spark, folder))).groupBy("theater_id").agg(F.count(F.lit(1)).alias("n"))


#: Files that the measurements land in, however many they are; more of them make larger batches, not more batches.
LANDED_FILES = 10


def landed(spark, t: SampleTables, base: str) -> str:
    """Measurements in files of mixed days, as a stream source would find them, in no order of time."""
    path, mixed = f"{base}/landed", F.xxhash64("showing_id", "measured_at")
    t.measurements.repartition(LANDED_FILES, mixed).sortWithinPartitions(mixed).write.parquet(path)
    return path


def stream_target(t: SampleTables):
    return t.showings.select("id", "theater_id", "screen_id", "start_at", "seats_sold", F.lit(None).cast("timestamp_ntz").alias("scraped_at"))


def run_stream(spark, folder):
    t = SampleTables(spark, folder)
    base = shared_folder(spark, f"measurement-stream-{uuid.uuid4().hex}")
    sink = stream.ShowingUpdates(spark, f"{base}/state", stream_target(t), t.screens, t.theaters, buckets=4, compact_every=1)
    source = stream.measurement_stream(spark, landed(spark, t, base), files_per_batch=5)
    sink.start(source).awaitTermination()
    return sink


_STREAMED = APPLIED_STEPS.replace("FROM showings s JOIN measurements m ON m.showing_id = s.id", f"FROM showings s JOIN (SELECT * FROM ({_WINDOWED}) WHERE {_REASON} IS NULL) m ON m.showing_id = s.id")


@query("t03_streamed_showings", _STREAMED + """
SELECT s.id, coalesce(a.seats_sold, s.seats_sold) AS seats_sold, coalesce(a.screen_id, s.screen_id) AS screen_id, CASE WHEN a.scraped_at IS NOT NULL THEN strftime(s.start_at + INTERVAL '13' MINUTE, '%Y-%m-%d %H:%M:%S') END AS scraped_at
FROM showings s LEFT JOIN (SELECT * FROM applied WHERE path <> 'skipped') a USING (id)""")
def _(spark, folder):
    return shown(run_stream(spark, folder).current().select("id", "seats_sold", "screen_id", "scraped_at"))


@query("t05_rejected_measurements", _STREAMED + f"""
SELECT error, count(*) AS n FROM (SELECT {_REASON} AS error FROM ({_WINDOWED}) WHERE {_REASON} IS NOT NULL
  UNION ALL SELECT CASE WHEN seats_remaining IS NULL THEN 'no_seats' ELSE 'no_screen' END FROM facts WHERE path = 'skipped') GROUP BY 1""")
def _(spark, folder):
    return run_stream(spark, folder).rejections().groupBy("error").agg(F.count(F.lit(1)).alias("n"))


@query("t08_streamed_completeness", """
WITH w AS (SELECT s.seats_sold, date_trunc('hour', s.start_at) - to_hours(CAST(k AS BIGINT)) AS window_start FROM showings s, range(5) r(k))
SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS total_shows, count(*) FILTER (WHERE seats_sold IS NULL) AS missing_shows FROM w GROUP BY 1""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    base = shared_folder(spark, f"completeness-{uuid.uuid4().hex}")
    shows = t.showings.select("id", "start_at", "seats_sold")
    shows.write.parquet(f"{base}/shows")
    source = spark.readStream.schema(shows.schema).option("maxFilesPerTrigger", 2).parquet(f"{base}/shows")
    sums = completeness.CompletenessSums(spark, f"{base}/windows", compact_every=3)
    sums.start(source).awaitTermination()
    return shown(sums.totals().select("window_start", "total_shows", "missing_shows"))


@query("t02_routed_measurements", _STREAMED + f"""
SELECT outcome, coalesce(error, '') AS error, count(*) AS n FROM (
  SELECT CASE WHEN r.reason IS NOT NULL OR f.path = 'skipped' THEN 'rejected' WHEN k.k = 0 THEN 'updated' ELSE 'superseded' END AS outcome,
    coalesce(r.reason, CASE WHEN f.path = 'skipped' THEN CASE WHEN f.seats_remaining IS NULL THEN 'no_seats' ELSE 'no_screen' END END) AS error
  FROM (SELECT *, {_REASON} AS reason FROM ({_WINDOWED})) r LEFT JOIN facts f ON f.id = r.showing_id CROSS JOIN range(2) k(k)) GROUP BY 1, 2""")
def _(spark, folder):
    """Every measurement landed twice: the copy is superseded or rejected too."""
    t = SampleTables(spark, folder)
    sink = stream.ShowingUpdates(spark, f"{shared_folder(spark, f'routed-{uuid.uuid4().hex}')}", stream_target(t), t.screens, t.theaters, buckets=4)
    sink.apply_batch(t.measurements.unionByName(t.measurements), 0)
    outcomes = sink.outcomes().groupBy("outcome", F.coalesce("error", F.lit("")).alias("error"))
    return outcomes.agg(F.count(F.lit(1)).alias("n"))
