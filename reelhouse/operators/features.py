"""Occupancy, share of showings and show counts per film and weekend."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.functions import time as tm


def ratio(part: Column, total: Column, digits: int = 4) -> Column:
    """Rounded quotient as decimal(6,4); NULL for an empty total or a quotient that does not fit."""
    return F.round(part / F.nullif(total, F.lit(0)), digits).try_cast("decimal(6,4)")


def weekend_showings(showings: DataFrame) -> DataFrame:
    """Friday to Sunday showings, tagged with the week they belong to."""
    return showings.where(F.weekday("date") >= 4).withColumn("weekend_id", tm.weekend_id(F.col("date")))


def show_counts(showings: DataFrame) -> DataFrame:
    """Friday to Sunday showings per film and weekend."""
    return (
        weekend_showings(showings)
        .groupBy(F.col("movie_id").alias("film_id"), "weekend_id")
        .agg(F.count(F.lit(1)).alias("film_cnt"))
    )


def total_counts(showings: DataFrame) -> DataFrame:
    return (
        weekend_showings(showings).groupBy("weekend_id").agg(F.count(F.lit(1)).alias("total_cnt"))
    )


def show_share(showings: DataFrame) -> DataFrame:
    """A film's share of all showings of a weekend."""
    counts = show_counts(showings)
    totals = counts.groupBy("weekend_id").agg(F.sum("film_cnt").alias("total_cnt"))
    return counts.join(totals, "weekend_id").select(
        "film_id", "weekend_id", "film_cnt", "total_cnt",
        ratio(F.col("film_cnt"), F.col("total_cnt")).alias("showings_proportion"),
    )


def occupancy(showings: DataFrame, screens: DataFrame, banded: bool = False) -> DataFrame:
    """Seats sold over seats offered per film and weekend, over shows where both are known.

    Shows are summed per film and screen before the screens join, so raw rows are never
    shuffled by screen and shows without a screen do not pile up on one key.
    """
    known = weekend_showings(showings).where(F.col("seats_sold").isNotNull())
    if banded:
        known = known.where(tm.band(tm.second_of_day(tm.to_local(F.col("start_at")))).isNotNull())
    per_screen = known.groupBy("movie_id", "weekend_id", "screen_id").agg(
        F.count(F.lit(1)).alias("shows"), F.sum("seats_sold").alias("sold")
    )
    capacity = screens.where(F.col("seat_count").isNotNull()).select(
        F.col("id").alias("screen_id"), "seat_count"
    )
    return (
        per_screen.where(F.col("screen_id").isNotNull())
        .join(capacity, "screen_id")
        .groupBy(F.col("movie_id").alias("film_id"), "weekend_id")
        .agg(
            ratio(F.sum("sold"), F.sum(F.col("shows") * F.col("seat_count"))).alias("average_showing_occupancy")
        )
    )


def weekend_features(showings: DataFrame, screens: DataFrame) -> DataFrame:
    """Occupancy and share of showings of every film on every weekend."""
    return show_share(showings).join(occupancy(showings, screens), ["film_id", "weekend_id"], "left").select(
        "film_id", "weekend_id", "average_showing_occupancy", "showings_proportion"
    )
