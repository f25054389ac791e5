"""Shows whose seats should be measured now, with their provider, window and priority."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.functions import time as tm
from reelhouse.operators import providers

LOOKAHEAD_HOURS = 4
BACK_MINUTES = 15


def shows_in_context(showings: DataFrame, theaters: DataFrame, movies: DataFrame, screens: DataFrame) -> DataFrame:
    """Shows with theatre, display title and, where a screen is set, its seats."""
    t = theaters.select(
        F.col("id").alias("theater_id"), F.col("name").alias("theater_name"), F.col("theater_api_id").alias("location_id"),
        F.col("showings_url").alias("theater_url"),
    )
    m = movies.select(F.col("id").alias("movie_id"), F.coalesce("fr_title", "title").alias("movie_title"))
    sc = screens.select(F.col("id").alias("screen_id"), "seat_count")
    return (
        showings.withColumnRenamed("id", "showing_id")
        .join(t, "theater_id").join(m, "movie_id").join(sc, "screen_id", "left")
    )


def around(instant: Column, as_of: Column, back: str, ahead: str) -> Column:
    return instant.between(as_of - F.expr(f"interval {back}"), as_of + F.expr(f"interval {ahead}"))


def with_windows(shows: DataFrame, theaters: DataFrame) -> DataFrame:
    """Add provider, measuring window and priority; unmapped theatres keep a NULL provider.

    Names are classified once per theatre, not once per show.
    """
    name = F.col("name")
    served = theaters.select(F.col("id").alias("theater_id"), name, providers.provider_of(name).alias("provider"))
    first, last = providers.measuring_window(F.col("provider"), name)
    served = served.select(
        "theater_id", "provider", first.alias("_first"), last.alias("_last"), providers.priority(F.col("provider")).alias("priority")
    )
    return (
        shows.join(served, "theater_id")
        .withColumn("window_start", F.col("start_at") + F.make_dt_interval(secs=F.col("_first")))
        .withColumn("window_end", F.col("start_at") + F.make_dt_interval(secs=F.col("_last")))
        .drop("_first", "_last")
    )


def candidates(
    showings: DataFrame, theaters: DataFrame, movies: DataFrame, screens: DataFrame, as_of: Column
) -> DataFrame:
    unseen = showings.where(
        F.col("seats_sold").isNull()
        & around(F.col("start_at"), as_of, f"{BACK_MINUTES} minutes", f"{LOOKAHEAD_HOURS} hours")
    )
    return with_windows(shows_in_context(unseen, theaters, movies, screens), theaters)


def work_list(
    showings: DataFrame, theaters: DataFrame, movies: DataFrame, screens: DataFrame, as_of: Column
) -> DataFrame:
    """Shows without seats around now whose window is still open; chain theatres need an address and a location."""
    local = tm.to_local(F.col("start_at"))
    reachable = (F.col("provider") != "cineplex") | (F.col("theater_url").isNotNull() & F.col("location_id").isNotNull())
    return (
        candidates(showings, theaters, movies, screens, as_of)
        .where(F.col("provider").isNotNull() & reachable & (F.col("window_end") >= as_of))
        .select(
            "showing_id", "movie_id", "theater_id", "theater_name", "movie_title", "provider", "priority",
            local.cast("date").alias("local_date"), tm.hhmm(local).alias("local_time"),
            "window_start", "window_end", "seat_count", "purchase_url",
        )
    )


def unmapped(
    showings: DataFrame, theaters: DataFrame, movies: DataFrame, screens: DataFrame, as_of: Column
) -> DataFrame:
    """Side output: shows of theatres no provider serves."""
    return (
        candidates(showings, theaters, movies, screens, as_of)
        .where(F.col("provider").isNull())
        .select("showing_id", "theater_name", F.lit("unmapped_theater").alias("error"))
    )


def shows_between(
    showings: DataFrame, theaters: DataFrame, movies: DataFrame, first_day: str, last_day: str,
    names: list[str], rows: int | None = None,
) -> DataFrame:
    """Shows of named theatres on local days first..last, by theatre, title and start; all of them, or as many as asked for."""
    local = tm.to_local(F.col("start_at"))
    t = theaters.where(F.col("name").isin(names)).select(F.col("id").alias("theater_id"), F.col("name").alias("theater_name"))
    m = movies.select(F.col("id").alias("movie_id"), "title", F.coalesce("fr_title", "title").alias("movie_title"))
    lower, upper = (F.lit(d).cast("date") for d in (first_day, last_day))
    found = (
        showings.where((local >= lower) & (local < F.date_add(upper, 1)))
        .join(t, "theater_id").join(m, "movie_id")
        .orderBy("theater_name", "title", "start_at", "id")
        .select(F.col("id").alias("showing_id"), "start_at", "movie_title", "theater_name")
    )
    return found if rows is None else found.limit(rows)
