"""Revenue estimate of one weekend for films without a published figure."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelhouse import fixed_values as fv
from reelhouse.functions import money
from reelhouse.functions import time as tm
from reelhouse.operators.features import ratio

NO_BAND = "none"
WEEKEND, MIDWEEK = "weekend", "midweek"


@dataclass(frozen=True)
class Weekend:
    id: int
    friday: dt.date
    sunday: dt.date

    @classmethod
    def of(cls, weekend_id: int) -> Weekend:
        return cls(weekend_id, *tm.weekend_dates(weekend_id))

    @property
    def monday(self) -> dt.date:
        return self.sunday - dt.timedelta(days=6)


def week_showings(showings: DataFrame, weekend: Weekend) -> DataFrame:
    """Monday to Sunday showings with day class and time-of-day band; literal bounds reach the scan."""
    day = F.weekday("date")
    return showings.where(F.col("date").between(F.lit(weekend.monday), F.lit(weekend.sunday))).select(
        F.col("movie_id").alias("film_id"),
        "screen_id",
        F.when(day == 0, "mon").when(day <= 3, "tue_thu").otherwise("fri_sun").alias("day_class"),
        F.coalesce(tm.band(tm.second_of_day(tm.to_local(F.col("start_at")))), F.lit(NO_BAND)).alias("band"),
        "seats_sold",
    )


def film_cells(showings: DataFrame, screens: DataFrame, weekend: Weekend) -> DataFrame:
    """Shows, known shows, seats sold and seats offered per film, day class and band.

    Raw rows are summed per film, screen, day class and band first (map-side combined, so a
    film holding most of the shows costs no more than its screens); screens join after that.
    """
    per_screen = (
        week_showings(showings, weekend)
        .groupBy("film_id", "screen_id", "day_class", "band")
        .agg(
            F.count(F.lit(1)).alias("shows"),
            F.count("seats_sold").alias("known"),
            F.sum("seats_sold").alias("sold"),
        )
    )
    capacity = screens.where(F.col("seat_count").isNotNull()).select(
        F.col("id").alias("screen_id"), "seat_count"
    )
    with_capacity = F.col("seat_count").isNotNull()
    return (
        per_screen.join(capacity, "screen_id", "left")
        .groupBy("film_id", "day_class", "band")
        .agg(
            F.sum("shows").alias("shows"),
            F.sum("known").alias("known"),
            F.coalesce(F.sum("sold"), F.lit(0)).alias("sold"),
            F.sum(F.when(with_capacity, F.col("sold"))).alias("occupied"),
            F.sum(F.col("known") * F.col("seat_count")).alias("offered"),
        )
    )


def film_history(revenues: DataFrame, weekends: DataFrame, weekend: Weekend) -> DataFrame:
    """What the revenue table knows per film up to this weekend: one scan, one aggregation.

    The weekends table holds one row per ISO week (a few thousand per century), so it may be
    broadcast whatever the size of the revenues; a shuffle on its few keys would be skewed.
    """
    prior = F.col("weekend_id") < weekend.id
    here = F.col("weekend_id") == weekend.id
    ends = weekends.select(F.col("id").alias("weekend_id"), "end_date")
    latest = lambda c: F.max_by(c, F.when(prior, F.col("weekend_id")))
    return (
        revenues.where(F.col("weekend_id") <= weekend.id)
        .join(ends, "weekend_id", "left")
        .groupBy("film_id")
        .agg(
            F.coalesce(F.bool_or(prior), F.lit(False)).alias("has_prior"),
            F.bool_or(here & ~F.col("data_source").eqNullSafe(F.lit(fv.ESTIMATE))).alias("settled"),
            latest("revenue_qc").alias("prev_rev"),
            latest("cumulatif_qc_to_date").alias("prev_cumul"),
            F.max(F.when(prior, F.col("end_date"))).alias("last_prior_end"),
        )
    )


def published_floor(revenues: DataFrame, weekend: Weekend) -> Column:
    """Lowest revenue of the published top ten, as a one-value subquery."""
    top10 = revenues.where(
        (F.col("weekend_id") == weekend.id)
        & (F.col("data_source") == fv.PUBLISHED)
        & F.col("rank").between(1, 10)
    )
    return top10.agg(F.min("revenue_qc")).scalar()


def _filled_seats() -> Column:
    """Seats of one band with missing shows at the band's, else the film's average; NULL if none is known."""
    film = Window.partitionBy("film_id")

    def film_average(part: str) -> Column:
        cell = (F.col("part") == part) & (F.col("band") != NO_BAND)
        sold, known = (F.sum(F.when(cell, F.col(c))).over(film) for c in ("sold", "known"))
        return F.try_divide(sold, known)

    previews, weekend_days = (F.sum(c).over(film) for c in ("preview_known", "weekend_known"))
    preview_only = F.col("is_first") & (previews > 0) & (weekend_days == 0)
    band_average = F.try_divide("sold", "known")
    weekend_average = film_average(WEEKEND)
    average = F.when(
        F.col("part") == WEEKEND,
        F.coalesce(band_average, weekend_average) * F.when(preview_only, 2).otherwise(1),
    ).otherwise(F.coalesce(band_average, film_average(MIDWEEK), weekend_average))
    missing = F.col("shows") - F.col("known")
    return F.when(
        F.col("band") != NO_BAND,
        F.when(missing > 0, F.col("sold") + missing * average).otherwise(F.col("sold").cast("double")),
    )


def estimate_weekend(
    showings: DataFrame,
    screens: DataFrame,
    revenues: DataFrame,
    weekends: DataFrame,
    movies: DataFrame,
    weekend_id: int,
    ticket_price: float = 14.0,
    bias: float = 0.7,
) -> DataFrame:
    """Estimate rows for films shown in the week that have no revenue row, or an estimate, there."""
    weekend = Weekend.of(weekend_id)
    cells = film_cells(showings, screens, weekend)
    # All films' shows, counted over the date column alone rather than through the film cells.
    on_weekend = F.col("date").between(F.lit(weekend.friday), F.lit(weekend.sunday))
    total_shows = showings.where(on_weekend).agg(F.count(F.lit(1))).scalar()
    released = movies.select(F.col("id").alias("film_id"), "release_date")
    history = ["is_first", "prev_rev", "prev_cumul", "last_prior_end"]

    # From the join on film_id on, every grouping and window keeps its partitioning.
    preview, friday_on = F.col("day_class") == "tue_thu", F.col("day_class") == "fri_sun"
    in_weekend = friday_on | (preview & F.col("is_first"))
    parts = (
        cells.where(F.col("film_id").isNotNull())
        .join(film_history(revenues, weekends, weekend), "film_id", "left")
        .where(~F.coalesce("settled", F.lit(False)))
        .withColumn("is_first", ~F.coalesce("has_prior", F.lit(False)))
        .withColumn("part", F.when(in_weekend, WEEKEND).otherwise(MIDWEEK))
        .groupBy("film_id", *history, "part", "band")
        .agg(
            *[F.sum(c).alias(c) for c in ("shows", "known", "sold", "occupied", "offered")],
            F.sum(F.when(friday_on, F.col("shows")).otherwise(0)).alias("weekend_shows"),
            F.sum(F.when(preview, F.col("known")).otherwise(0)).alias("preview_known"),
            F.sum(F.when(friday_on, F.col("known")).otherwise(0)).alias("weekend_known"),
        )
    )
    this_weekend = F.col("part") == WEEKEND
    banded = this_weekend & (F.col("band") != NO_BAND)
    measured = (
        parts.withColumn("seats", _filled_seats())
        .groupBy("film_id", *history)
        .agg(
            F.sum(F.when(this_weekend, F.col("shows"))).alias("base_shows"),
            F.sum(F.when(this_weekend, F.col("seats"))).alias("seats_weekend"),
            F.sum(F.when(~this_weekend, F.col("seats"))).alias("seats_midweek"),
            ratio(
                F.sum(F.when(banded, F.col("occupied"))), F.sum(F.when(banded, F.col("offered")))
            ).alias("average_showing_occupancy"),
            F.sum("weekend_shows").alias("weekend_shows"),
        )
        .where(F.col("base_shows") > 0)
        .join(released, "film_id", "left")
        .select(
            "*",
            F.coalesce(F.col("last_prior_end") >= F.col("release_date"), F.lit(False)).alias("had_real_weekend"),
            F.coalesce(ratio(F.col("weekend_shows"), total_shows), F.lit(0).cast("decimal(6,4)")).alias(
                "showings_proportion"
            ),
        )
    )

    priced = measured.withColumns(
        {
            "revenue_qc": money.weekend_revenue(
                F.col("seats_weekend"), ticket_price, bias, published_floor(revenues, weekend)
            ),
            "revenue_midweek": money.midweek_revenue(F.col("seats_midweek"), ticket_price, bias),
        }
    )
    zero = F.lit(0).cast("bigint")
    return priced.select(
        "film_id",
        F.lit(weekend.id).alias("weekend_id"),
        "revenue_qc",
        F.lit(fv.ESTIMATE).alias("data_source"),
        (
            F.coalesce("prev_cumul", zero)
            + F.coalesce("revenue_midweek", zero)
            + F.coalesce("revenue_qc", zero)
        ).alias("cumulatif_qc_to_date"),
        money.change_percent(
            F.col("revenue_qc"), F.col("prev_rev"), ~F.col("had_real_weekend")
        ).alias("change_qc"),
        "average_showing_occupancy",
        "showings_proportion",
    )
