"""Seat sums with gaps filled from averages, seat-grid counts, and probe outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelhouse.functions import time as tm
from reelhouse.operators.features import weekend_showings

KEY = ["film_id", "weekend_id"]


def banded_weekend(showings: DataFrame) -> DataFrame:
    """Shows, known shows and seats sold per film, weekend and time-of-day band."""
    band = tm.band(tm.second_of_day(tm.to_local(F.col("start_at"))))
    return (
        weekend_showings(showings).withColumn("band", band).where(F.col("band").isNotNull())
        .groupBy(F.col("movie_id").alias("film_id"), "weekend_id", "band")
        .agg(
            F.count(F.lit(1)).alias("shows"),
            F.count("seats_sold").alias("known"),
            F.coalesce(F.sum("seats_sold"), F.lit(0)).alias("sold"),
        )
    )


def with_averages(cells: DataFrame) -> DataFrame:
    """Average seats of the band and of the film's whole weekend; NULL where nothing is known."""
    film = Window.partitionBy(*KEY)
    return cells.withColumns(
        {
            "avg_band": F.try_divide("sold", "known"),
            "avg_film": F.try_divide(F.sum("sold").over(film), F.sum("known").over(film)),
        }
    )


def filled_seats(cells: DataFrame) -> DataFrame:
    """Seats per film and weekend, missing shows at the band's or else the film's average."""
    missing = F.col("shows") - F.col("known")
    average = F.coalesce("avg_band", "avg_film")
    filled = F.when(missing > 0, F.col("sold") + missing * average).otherwise(F.col("sold").cast("double"))
    return with_averages(cells).groupBy(*KEY).agg(
        F.sum(filled).alias("seats"), F.sum(missing).alias("missing_cnt")
    )


def grid_counts(seats: DataFrame, keys: list[str]) -> DataFrame:
    """Seat-grid elements (status, wheelchair) to counts.

    One occupied element is the legend. Blocked and wheelchair places are not for sale.
    """
    status = F.col("status")
    occupied = F.greatest(F.lit(0), F.count_if(status == "occupied") - 1)
    sellable = F.count_if((status != "blocked") & ~F.col("wheelchair"))
    return seats.groupBy(*keys).agg(
        sellable.alias("sellable"),
        occupied.alias("occupied"),
        (sellable - occupied).alias("remaining"),
        F.count_if(status == "blocked").alias("blocked"),
        F.count_if("wheelchair").alias("wheelchair"),
    )


def remaining_from_probes(outcomes: DataFrame, capacities: DataFrame | None = None, start_high: int = 300) -> DataFrame:
    """Remaining seats from recorded quantities: the largest accepted plus one.

    When none was accepted one seat is taken as sold of the capacity, or of start_high + 1
    where that is unknown; 'fallback' marks those rows.
    """
    accepted = outcomes.groupBy("showing_id").agg(F.max(F.when(F.col("ok"), F.col("quantity"))).alias("accepted"))
    if capacities is None:
        known = accepted.withColumn("capacity", F.lit(None).cast("int"))
    else:
        known = accepted.join(capacities.select("showing_id", "capacity"), "showing_id", "left")
    usable = F.when(F.col("capacity") > 0, F.col("capacity"))
    fallback = F.greatest(F.lit(0), F.coalesce(usable, F.lit(start_high + 1)) - 1)
    return known.select(
        "showing_id",
        F.coalesce(F.col("accepted") + 1, fallback).cast("int").alias("seats_remaining"),
        F.col("accepted").isNull().alias("fallback"),
    )
