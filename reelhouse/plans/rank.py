"""Ranking of the films of each weekend."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelhouse import fixed_values as fv
from reelhouse.functions import time as tm

FILM_WEEKEND = ["film_id", "weekend_id"]


def weekend_totals(revenues: DataFrame, estimate: Column | None = None) -> DataFrame:
    """Published figure of a film's weekend, else its estimate."""
    published = F.max(F.when(F.col("data_source") == fv.PUBLISHED, F.col("revenue_qc")))
    estimated = estimate if estimate is not None else F.max(
        F.when(F.col("data_source") == fv.ESTIMATE, F.col("revenue_qc"))
    )
    return revenues.groupBy(*FILM_WEEKEND).agg(F.coalesce(published, estimated).alias("weekend_total"))


def _week_counts(showings: DataFrame) -> DataFrame:
    """Shows per film and ISO week, split into previews and weekend days; raw rows combine map-side."""
    day = F.weekday("date")
    return showings.groupBy(
        F.col("movie_id").alias("film_id"), tm.weekend_id(F.col("date")).alias("weekend_id")
    ).agg(
        F.count_if(day.between(1, 3)).alias("tue_thu"),
        F.count_if(day == 3).alias("thu"),
        F.count_if(day >= 4).alias("fri_sun"),
    )


def _ranked(totals: DataFrame) -> DataFrame:
    order = Window.partitionBy("weekend_id").orderBy(
        F.desc_nulls_last("weekend_total"), F.desc("show_count"), "film_id"
    )
    return totals.select(
        "film_id", "weekend_id", "weekend_total", "show_count", F.rank().over(order).alias("rank")
    )


def rank_weekends(revenues: DataFrame, showings: DataFrame, weekend_id: int | None = None) -> DataFrame:
    """Rank by total, then shows, then film. A film without earlier revenue counts its previews too.

    Without a weekend every weekend is ranked in one pass.
    """
    first_weekend = revenues.groupBy("film_id").agg(F.min("weekend_id").alias("first_weekend"))
    current = revenues
    if weekend_id is not None:
        friday, sunday = tm.weekend_dates(weekend_id)
        current = revenues.where(F.col("weekend_id") == weekend_id)
        showings = showings.where(F.col("date").between(F.date_sub(F.lit(friday), 3), F.lit(sunday)))
    shows = F.col("fri_sun") + F.when(F.col("weekend_id") == F.col("first_weekend"), F.col("tue_thu")).otherwise(0)
    return _ranked(
        weekend_totals(current)
        .join(first_weekend, "film_id")
        .join(_week_counts(showings), FILM_WEEKEND, "left")
        .withColumn("show_count", F.coalesce(shows, F.lit(0)))
    )


def rank_weekends_by_day_rows(revenues: DataFrame, showings: DataFrame) -> DataFrame:
    """Older form: sum of dated non-preview estimate rows; a film without an earlier show is new."""
    dated = (F.col("data_source") == fv.ESTIMATE) & (F.col("preview") == F.lit(False)) & F.col("date").isNotNull()
    first_show = showings.groupBy(F.col("movie_id").alias("film_id")).agg(F.min("date").alias("first_show"))
    is_new = F.col("first_show").isNull() | (F.col("first_show") >= tm.friday_of(F.col("weekend_id")))
    shows = F.col("fri_sun") + F.when(is_new, F.col("thu")).otherwise(0)
    return _ranked(
        weekend_totals(revenues, F.sum(F.when(dated, F.col("revenue_qc"))))
        .join(first_show, "film_id", "left")
        .join(_week_counts(showings), FILM_WEEKEND, "left")
        .withColumn("show_count", F.coalesce(shows, F.lit(0)))
    )
