"""Announced films: this and next month, and everything later."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.functions import text as tx
from reelhouse.functions import time as tm
from reelhouse.sources.pages import coming_soon


def _first_per_address(films: DataFrame) -> DataFrame:
    """Of an address on several month pages the earliest month's entry."""
    return (
        films.groupBy("href")
        .agg(F.min(F.struct("month", "title", "release_date")).alias("f"))
        .select("href", F.col("f.title").alias("title"), F.col("f.release_date").alias("release_date"))
    )


def near_films(pages: DataFrame, as_of: Column, site: str) -> DataFrame:
    """Films on the pages (month, html) of this and the next month."""
    wanted = F.col("month").isin(tm.month_label(as_of), tm.month_label(as_of, 1))
    return _first_per_address(coming_soon(pages.where(wanted), site))


def later_films(pages: DataFrame, as_of: Column, site: str, months: DataFrame | None = None) -> DataFrame:
    """Films on the pages of the listed months after the next; of the six following when none is listed."""
    nxt = tm.month_label(as_of, 1)
    following = F.array_contains(tm.month_labels(as_of, 2, 7), F.col("month"))
    if months is None:
        chosen = pages.where(following)
    else:
        later = months.where(F.col("month") > nxt).select("month").distinct()
        any_later = later.agg(F.count(F.lit(1)) > 0).scalar()
        listed = later.withColumn("_listed", F.lit(True))
        chosen = pages.join(listed, "month", "left").where(F.when(any_later, F.col("_listed").isNotNull()).otherwise(following)).drop("_listed")
    return _first_per_address(coming_soon(chosen, site))


def film_wants(films: DataFrame) -> DataFrame:
    return films.select(
        "href", "title", F.year("release_date").alias("year_hint"),
        F.filter(F.array(tx.slug_title(F.col("href"), drop_version=True)), lambda t: t != "").alias("extra_queries"),
    )


def outcomes(films: DataFrame, movies: DataFrame) -> DataFrame:
    """Whether each announced film is known under its exact title: 'updated' or 'inserted'."""
    titles = movies.select(F.explode(F.array_compact(F.array("fr_title", "title"))).alias("title")).distinct()
    known = titles.withColumn("_known", F.lit(True))
    return films.join(known, "title", "left").select(
        "href", "title", F.when(F.col("_known"), "updated").otherwise("inserted").alias("outcome")
    )
