"""Purchase addresses and screens for shows that have none yet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse import fixed_values as fv
from reelhouse.functions import text as tx
from reelhouse.functions import time as tm
from reelhouse.operators import match_schedule, merge
from reelhouse.operators.match_screen import nearest_screen
from reelhouse.operators.providers import ticketing_kind
from reelhouse.session import written

LOOKAHEAD_DAYS = 14


def picker_comparison(wanted: DataFrame, items: DataFrame) -> DataFrame:
    """What the strict and the simple picker say for every wanted show, side by side."""
    both = match_schedule.pick_entries_both_ways(wanted, items)
    entries = items.groupBy(*match_schedule.SLOT).agg(F.count(F.lit(1)).alias("entries"))
    return match_schedule.matched(wanted, both, with_missing=True).join(entries, match_schedule.SLOT, "left")


def targets(showings: DataFrame, theaters: DataFrame, movies: DataFrame, as_of: Column) -> DataFrame:
    """Coming shows without a screen at theatres whose ticketing hides the seats, with the last day to fill."""
    hidden = theaters.where(ticketing_kind(F.col("name")) == fv.NOT_DISPLAYING_SEATS).select(
        F.col("id").alias("theater_id"), F.col("name").alias("theater_name")
    )
    titles = movies.select(
        F.col("id").alias("movie_id"), F.coalesce("fr_title", "title").alias("title"), F.col("title").alias("sort_title")
    )
    shows = (
        showings.where(F.col("screen_id").isNull() & (F.col("start_at") >= as_of))
        .join(hidden, "theater_id").join(titles, "movie_id")
        .withColumnRenamed("id", "showing_id")
    )
    ends = furthest_days(shows, as_of)
    local = tm.to_local(F.col("start_at"))
    return shows.join(ends, ["theater_id", "movie_id"]).select(
        "showing_id", "theater_id", "movie_id", "theater_name", "title", "sort_title", "start_at",
        local.cast("date").alias("date"), tm.hhmm(local).alias("time"), "purchase_url", "end_date",
    )


def furthest_days(shows: DataFrame, as_of: Column, ahead: int = LOOKAHEAD_DAYS) -> DataFrame:
    """Last day to look at per theatre and film: the furthest start, two weeks ahead at most."""
    today = tm.local_date(as_of)
    return shows.groupBy("theater_id", "movie_id").agg(
        F.least(F.max(F.col("start_at").cast("date")), F.date_add(today, ahead)).alias("end_date")
    )


def filled_urls(work: DataFrame, items: DataFrame, showings: DataFrame, as_of: Column) -> DataFrame:
    """(showing_id, purchase_url) for shows up to their last day whose address nobody else uses.

    Schedule entries are narrowed to the slots of these shows before their titles are read. `work` is gone over twice.
    """
    open_shows = work.where(
        F.col("purchase_url").isNull() & F.col("date").between(tm.local_date(as_of), F.col("end_date"))
    )
    slots = open_shows.select(*match_schedule.SLOT).distinct()
    asked = items.join(slots, match_schedule.SLOT, "left_semi")
    picks = match_schedule.matched(open_shows, match_schedule.pick_entries(open_shows, asked)).select(
        "theater_id", "url", "time", "theater_name", "sort_title", "start_at", "showing_id", "strategy"
    )
    picks = written(picks, "prefill-picks")
    free = match_schedule.unused_urls(picks, showings, ["theater_name", "sort_title", "start_at", "showing_id"])
    return free.select("showing_id", F.col("url").alias("purchase_url"), "strategy")


def accepted_capacity(outcomes: DataFrame) -> DataFrame:
    """Largest accepted capacity candidate of each show."""
    return (
        outcomes.groupBy("showing_id")
        .agg(F.max(F.when(F.col("ok") & (F.col("candidate") > 0), F.col("candidate"))).alias("capacity"))
        .where(F.col("capacity").isNotNull())
    )


def prefill(
    showings: DataFrame, theaters: DataFrame, movies: DataFrame, screens: DataFrame,
    items: DataFrame, outcomes: DataFrame, as_of: Column,
) -> DataFrame:
    """Next state of the showings: purchase_url and screen_id set where they were NULL.

    The work list and the addresses found for it (both small beside the showings) are written
    once, since the merges go over them again.
    """
    work = written(targets(showings, theaters, movies, as_of), "prefill-work")
    found_urls = filled_urls(work, items, showings, as_of)
    urls = written(found_urls.select(F.col("showing_id").alias("id"), "purchase_url"), "prefill-urls")
    with_urls = merge.write_once(showings, urls, "purchase_url")
    probed = (
        work.join(urls.select(F.col("id").alias("showing_id"), F.lit(True).alias("_filled")), "showing_id", "left")
        .where(F.col("purchase_url").isNotNull() | F.col("_filled"))
        .join(accepted_capacity(outcomes), "showing_id")
    )
    found = probed.join(nearest_screen(probed, screens), ["theater_id", "capacity"]).select(
        F.col("showing_id").alias("id"), "screen_id", "end_date"
    )
    return merge.assign_screens(with_urls, found, as_of)


def version_of(picks: DataFrame, items: DataFrame) -> DataFrame:
    """Version signature of the schedule entry each pick points to."""
    titles = items.groupBy("theater_id", "date", "time", "url").agg(F.min(F.struct("pos", "title")).alias("e"))
    return picks.join(titles, ["theater_id", "date", "time", "url"], "left").withColumn(
        "version", tx.version_signature(F.coalesce("e.title", F.lit("")))
    ).drop("e")
