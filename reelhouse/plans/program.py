"""The week's program: listed films with their show blocks, ready to become showings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.functions import text as tx
from reelhouse.functions import time as tm
from reelhouse.operators import merge

NOW, UPCOMING = "now", "upcoming"


def merge_listings(now: DataFrame, upcoming: DataFrame) -> DataFrame:
    """Films of two listings (href, title, pos) by address; the running list wins and is kept as origin."""
    tagged = now.select(F.lit(0).alias("rank"), "href", "title", "pos").unionByName(
        upcoming.select(F.lit(1).alias("rank"), "href", "title", "pos")
    )
    return (
        tagged.groupBy(tx.canonical_href(F.col("href")).alias("href"))
        .agg(F.min(F.struct("rank", "pos", "title")).alias("f"))
        .select("href", F.col("f.title").alias("title"), F.when(F.col("f.rank") == 0, NOW).otherwise(UPCOMING).alias("source"), F.col("f.pos").alias("pos"))
    )


def first_films(listing: DataFrame, count: int) -> DataFrame:
    """The first films of the merged list, running ones before announced ones."""
    return listing.orderBy(F.when(F.col("source") == NOW, 0).otherwise(1), "pos", "href").limit(count)


def normalised_blocks(blocks: DataFrame, as_of: Column) -> DataFrame:
    """(href, day_label, theater, times) with a date, a theatre and distinct readable times."""
    times = F.array_distinct(F.array_compact(F.transform("times", tm.program_time)))
    read = F.struct(tm.french_day_month(F.col("day_label"), as_of).alias("date"), tx.trim_space(F.col("theater")).alias("theater"), times.alias("times"))
    # exploded, not filtered, so that each block is read once: a filter on what is read would read it again
    usable = F.filter(F.array(read), lambda b: b["date"].isNotNull() & (b["theater"] != "") & (F.size(b["times"]) > 0))
    rest = [c for c in blocks.columns if c != "date"]
    return blocks.select("*", F.explode(usable).alias("_read")).select(
        *[F.col(f"_read.{c}").alias(c) if c in ("theater", "times") else c for c in rest], F.col("_read.date").alias("date")
    )


def show_totals(blocks: DataFrame) -> DataFrame:
    """Shows per film, and the earliest year they lie in (the year hint of a film search)."""
    return blocks.groupBy("href").agg(F.sum(F.size("times")).alias("total"), F.min(F.year("date")).alias("year_hint"))


def build_program(
    listing: DataFrame, blocks: DataFrame, min_now: int = 5, min_upcoming: int = 1
) -> DataFrame:
    """Films with enough shows, with their totals: running films need five, announced ones one."""
    needed = F.when(F.col("source") == UPCOMING, min_upcoming).otherwise(min_now)
    return listing.join(show_totals(blocks), "href").where(F.col("total") >= needed)


def film_wants(program: DataFrame, alternate: DataFrame | None = None) -> DataFrame:
    """Search wants of the program's films: title, year hint, and the slug and alternate titles."""
    wants = program if alternate is None else program.join(alternate.select("href", "titles"), "href", "left")
    more = F.array().cast("array<string>") if alternate is None else F.coalesce("titles", F.array().cast("array<string>"))
    extras = F.filter(F.concat(F.array(tx.slug_title(F.col("href"), drop_version=True)), more), lambda t: t != "")
    return wants.select("href", "title", "year_hint", extras.alias("extra_queries"))


def search_titles(wants: DataFrame) -> DataFrame:
    """Distinct query titles that name no venue."""
    titles = tx.without_blanks(F.concat("extra_queries", F.array("title")))
    return wants.withColumn("queries", F.filter(titles, tx.names_no_venue))


def program_showings(program: DataFrame, blocks: DataFrame, films: DataFrame, theaters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Next theatres, and the showing rows of the program's films (href -> film_id)."""
    needed = blocks.select("href", "date", "theater", "company", "screens", "times")
    kept = needed.join(program.select("href"), "href", "left_semi").join(films.select("href", F.col("film_id").alias("movie_id")), "href")
    named = kept.select(F.col("theater").alias("name"), "company", "screens").distinct()
    next_theaters = merge.merge_theaters(theaters, named)
    ids = next_theaters.groupBy(F.upper("name").alias("_name")).agg(F.min("id").alias("theater_id"))
    rows = merge.showing_rows(kept.withColumn("_name", F.upper("theater")).join(ids, "_name"))
    return next_theaters, rows
