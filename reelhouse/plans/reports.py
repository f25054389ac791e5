"""Reports written as files: theatre-day census, window probe, nested hall schedule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.functions import text as tx
from reelhouse.functions import time as tm
from reelhouse.sources.pages import purchase_headers

CENSUS_COLUMNS = ["theater_name", "date", "title", "time", "auditorium", "seats_remaining", "status", "error"]
PROBE_COLUMNS = ["theater", "date", "movie", "time", "seats_remaining", "confirm_url", "schedule_url", "match_notes"]


def census(shows: DataFrame, answers: DataFrame) -> DataFrame:
    """Every show (theater_name, date, title, time, url) with what its purchase page (url, html, error) says.

    A page that is missing or failed gives status 'fail' and its error.
    """
    read = purchase_headers(answers.where(F.col("error").isNull()).select("url", "html")).drop("time")
    failed = answers.select("url", "error")
    error = F.when(F.col("_read").isNull(), F.coalesce("error", F.lit("no answer")))
    return (
        shows.join(read.withColumn("_read", F.lit(True)), "url", "left").join(failed, "url", "left")
        .select(
            "theater_name", "date", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("time", F.lit("")).alias("time"),
            "auditorium", "seats_remaining", F.when(error.isNull(), "ok").otherwise("fail").alias("status"), error.alias("error"),
        )
    )


def status_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def window_probe(outcomes: DataFrame, start: str, end: str) -> DataFrame:
    """Recorded probes (theater, date, seq, title, time, url, seats_remaining, seat_map, failure, confirm_url)
    of the shows starting within [start, end].

    Repeats of a title, time and address count once. After a timeout or a seat map the later
    probes of that film in the same run are reported as skipped.
    """
    def minutes(hhmm: str) -> int:
        return int(hhmm[:2]) * 60 + int(hhmm[3:])

    run = ["theater", "date"]
    film = tx.trim_space(tx.collapse_space(tx.strip_diacritics(F.coalesce("title", F.lit("")))))
    rest = [c for c in outcomes.columns if c not in (*run, "time", "url", "seq")]
    shows = (
        outcomes.where(
            (F.col("url") != "") & tm.minute_of_day(F.col("time")).between(minutes(start), minutes(end))
        )
        .groupBy(*run, film.alias("film"), "time", "url")
        .agg(F.min(F.struct("seq", *rest)).alias("r"))
        .select(*run, "film", "time", "url", "r.*")
    )
    stops = F.col("seat_map") | F.col("failure").isin("cutoff", "timeout")
    stopped = shows.groupBy(*run, "film").agg(F.min(F.when(stops, F.col("seq"))).alias("stopped_at"))
    skipped = F.col("seq") > F.col("stopped_at")
    failed = F.col("failure").isNotNull()
    notes = (
        F.when(skipped, "skipped_after_force_skip")
        .when(F.col("failure") == "cutoff", "probe_error:force_skip")
        .when(F.col("failure") == "timeout", "probe_error:timeout")
        .when(failed, F.concat(F.lit("probe_error:"), "failure"))
        .when(F.col("seat_map"), "provider_seatmap_detected")
        .when(F.col("seats_remaining").isNull(), "no_seats_number")
    )
    told = ~F.coalesce(skipped, F.lit(False)) & ~failed
    return shows.join(stopped, [*run, "film"]).select(
        "theater", "date", F.col("title").alias("movie"), "time",
        F.when(told, F.col("seats_remaining")).alias("seats_remaining"),
        F.when(told, F.col("confirm_url")).alias("confirm_url"),
        F.col("url").alias("schedule_url"), notes.alias("match_notes"),
    )


def nested_schedule(shows: DataFrame) -> DataFrame:
    """film and month -> date -> [{time, salle}] of (movie, date, time, salle), repeats dropped.

    A map holds the days of one month, so none grows with the time that is kept.
    """
    days = shows.groupBy("movie", "date").agg(F.array_sort(F.collect_set(F.struct("time", "salle"))).alias("shows"))
    month = F.left(F.col("date").cast("string"), F.lit(7))
    return days.groupBy("movie", month.alias("month")).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("date", "shows")))).alias("schedule")
    )
