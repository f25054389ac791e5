"""Completeness of seat data: alert summary, detail lists and estimate diagnostics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse import fixed_values as fv
from reelhouse.functions import time as tm

WATCHED_NAME = "Cineplex"
LOOK_BACK_HOURS = 5
THRESHOLD = 0.7


def _watched(showings: DataFrame, theaters: DataFrame, as_of: Column, hours: int, name: str) -> DataFrame:
    t = theaters.where(F.contains("name", F.lit(name))).select(
        F.col("id").alias("theater_id"), F.col("name").alias("theater_name")
    )
    recent = (F.col("start_at") < as_of) & (F.col("start_at") > as_of - F.expr(f"interval {hours} hours"))
    return showings.where(recent).join(t, "theater_id")


def _alerting(total: Column, missing: Column, threshold: float) -> Column:
    return (total > 0) & (missing / F.nullif(total, F.lit(0)) >= threshold)


def missing_data_summary(
    showings: DataFrame, theaters: DataFrame, as_of: Column,
    hours: int = LOOK_BACK_HOURS, threshold: float = THRESHOLD, name: str = WATCHED_NAME,
) -> DataFrame:
    """One row: shows of the last hours, how many lack seats, the share, and whether that is an alert.

    Quiet hours and an empty window never alert.
    """
    counted = _watched(showings, theaters, as_of, hours, name).agg(
        F.count(F.lit(1)).alias("total_shows"), F.count_if(F.col("seats_sold").isNull()).alias("missing_shows")
    )
    total, missing = F.col("total_shows"), F.col("missing_shows")
    return counted.select(
        total,
        missing,
        F.round(missing / F.nullif(total, F.lit(0)), 4).alias("missing_share"),
        F.coalesce(_alerting(total, missing, threshold) & ~tm.in_quiet_hours(as_of), F.lit(False)).alias("alert"),
    )


def missing_data_by_theater(
    showings: DataFrame, theaters: DataFrame, as_of: Column, hours: int = LOOK_BACK_HOURS, name: str = WATCHED_NAME
) -> DataFrame:
    return (
        _watched(showings, theaters, as_of, hours, name)
        .groupBy("theater_name")
        .agg(F.count(F.lit(1)).alias("total_shows"), F.count_if(F.col("seats_sold").isNull()).alias("missing_shows"))
        .where(F.col("missing_shows") > 0)
    )


def missing_data_detail(
    showings: DataFrame, theaters: DataFrame, movies: DataFrame, as_of: Column,
    hours: int = LOOK_BACK_HOURS, name: str = WATCHED_NAME,
) -> DataFrame:
    """Shows without seats, latest first, then theatre and French title (titles without one last)."""
    m = movies.select(F.col("id").alias("movie_id"), "fr_title", F.coalesce("fr_title", "title").alias("movie_title"))
    return (
        _watched(showings, theaters, as_of, hours, name)
        .where(F.col("seats_sold").isNull())
        .join(m, "movie_id")
        .orderBy(F.desc("start_at"), F.asc_nulls_last("theater_name"), F.asc_nulls_last("fr_title"), "id")
        .select(F.col("id").alias("showing_id"), "start_at", "movie_title", "theater_name", "theater_id")
    )


def missing_data_alert(showings: DataFrame, theaters: DataFrame, movies: DataFrame, as_of: Column, **settings) -> DataFrame:
    """Alert rows to write to a table: the summary, and per theatre its share; none without an alert."""
    summary = missing_data_summary(showings, theaters, as_of, **settings)
    settings.pop("threshold", None)
    rows = missing_data_by_theater(showings, theaters, as_of, **settings)
    alert = summary.select("alert").scalar()
    top = summary.where("alert").select(F.lit("all").alias("theater_name"), "total_shows", "missing_shows")
    return top.unionByName(rows.where(alert))


def sliding_completeness(shows: DataFrame, length: str = "5 hours", step: str = "1 hour") -> DataFrame:
    """Missing share of every sliding window over show starts; works on a stream as on a table."""
    return (
        shows.groupBy(F.window("start_at", length, step))
        .agg(F.count(F.lit(1)).alias("total_shows"), F.count_if(F.col("seats_sold").isNull()).alias("missing_shows"))
        .select(
            F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "total_shows",
            "missing_shows", (F.col("missing_shows") / F.col("total_shows") >= THRESHOLD).alias("alert"),
        )
    )


def estimates_without_features(revenues: DataFrame) -> DataFrame:
    """Estimate rows per weekend that lack occupancy or share."""
    lacking = F.col("showings_proportion").isNull() | F.col("average_showing_occupancy").isNull()
    return (
        revenues.where(F.col("data_source") == fv.ESTIMATE).groupBy("weekend_id").agg(F.count_if(lacking).alias("n_null"))
    )


def feature_sample(revenues: DataFrame, rows: int = 10) -> DataFrame:
    """A few estimate rows, those lacking features first."""
    return (
        revenues.where(F.col("data_source") == fv.ESTIMATE)
        .orderBy(
            F.asc_nulls_first("showings_proportion"), F.asc_nulls_first("average_showing_occupancy"), "film_id"
        )
        .limit(rows)
        .select("film_id", "showings_proportion", "average_showing_occupancy")
    )
