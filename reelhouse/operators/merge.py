"""Keyed writes as pure merges: merge(target, source) gives the next state of the target.

The source of a merge is one batch (a weekend, a scrape, a micro-batch) and the target the
whole history, so a merge is a left join for the updates and an anti join for the inserts.
When the batch is small, adaptive execution broadcasts it and the target is only scanned,
never shuffled. The source must hold one row per key; it is gone over twice, so write an expensive
one to a table first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelhouse import fixed_values as fv
from reelhouse.functions import money
from reelhouse.functions import time as tm

Rule = Callable[[Column, Column], Column]


def overwrite(target: Column, source: Column) -> Column:
    return source


def prefer_source(target: Column, source: Column) -> Column:
    return F.coalesce(source, target)


def prefer_target(target: Column, source: Column) -> Column:
    return F.coalesce(target, source)


def fill_zero_too(target: Column, source: Column) -> Column:
    """Zero counts as missing, but stays when there is nothing better."""
    return F.when(target.isNull() | (target == 0), F.coalesce(source, target)).otherwise(target)


def larger(target: Column, source: Column) -> Column:
    zero = F.lit(0)
    return F.greatest(F.coalesce(target, zero), F.coalesce(source, zero))


def same_key(keys: list[str]) -> Column:
    condition = F.lit(True)
    for k in keys:
        condition = condition & (F.col(f"t.{k}") == F.col(f"s.{k}"))
    return condition


def update(
    target: DataFrame, source: DataFrame, keys: list[str], rules: dict[str, Rule], only_if: Column | None = None
) -> DataFrame:
    """Apply per-column rules to target rows that meet a source row (and the guard on 't.'/'s.')."""
    met = F.col("s._met").isNotNull()
    if only_if is not None:
        met = met & F.coalesce(only_if, F.lit(False))
    marked = source.withColumn("_met", F.lit(True))
    columns = [
        F.when(met, rules[c](F.col(f"t.{c}"), F.col(f"s.{c}")).cast(target.schema[c].dataType))
        .otherwise(F.col(f"t.{c}")).alias(c)
        if c in rules
        else F.col(f"t.{c}").alias(c)
        for c in target.columns
    ]
    return target.alias("t").join(marked.alias("s"), same_key(keys), "left").select(*columns)


def new_rows(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key the target lacks. The target is reduced to the source's keys first."""
    wanted = source.select(*keys)
    present = target.select(*keys).join(wanted, keys, "left_semi").distinct()
    return source.join(present, keys, "left_anti")


def shaped_like(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Columns and types of the target; columns the rows lack are NULL."""
    return rows.select(
        *[
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ]
    )


def merge(
    target: DataFrame, source: DataFrame, keys: list[str], rules: dict[str, Rule], only_if: Column | None = None
) -> DataFrame:
    changed = update(target, source, keys, rules, only_if)
    return changed.unionByName(shaped_like(target, new_rows(target, source, keys)))


def insert_if_absent(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    return target.unionByName(shaped_like(target, new_rows(target, source.dropDuplicates(keys), keys)))


# ---- the tables ---------------------------------------------------------------------------
def merge_weekends(weekends: DataFrame, source: DataFrame) -> DataFrame:
    return merge(weekends, source, ["id"], {"start_date": overwrite, "end_date": overwrite})


PUBLISHED_RULES: dict[str, Rule] = {
    "revenue_qc": overwrite,
    "revenue_us": overwrite,
    "rank": overwrite,
    "cumulatif_qc_to_date": prefer_source,
    "cumulatif_us_to_date": prefer_source,
    "data_source": lambda t, s: F.lit(fv.PUBLISHED),
    "average_showing_occupancy": overwrite,
    "showings_proportion": overwrite,
}


REVENUE_KEY = ["film_id", "weekend_id"]


def published_merge(revenues: DataFrame, source: DataFrame) -> tuple[DataFrame, dict[str, Rule]]:
    """Source rows and rules of merge_published."""
    source = source.withColumn("data_source", F.lit(fv.PUBLISHED))
    return source, {c: r for c, r in PUBLISHED_RULES.items() if c in revenues.columns and c in source.columns}


def merge_published(revenues: DataFrame, source: DataFrame) -> DataFrame:
    """Published figures win, but a missing cumulative never erases a known one."""
    source, rules = published_merge(revenues, source)
    return merge(revenues, source, REVENUE_KEY, rules)


ESTIMATE_COLUMNS = [
    "revenue_qc", "cumulatif_qc_to_date", "change_qc", "average_showing_occupancy", "showings_proportion",
]


STILL_ESTIMATED = "t.data_source = '" + fv.ESTIMATE + "'"


def estimate_rules(revenues: DataFrame) -> dict[str, Rule]:
    return {c: overwrite for c in ESTIMATE_COLUMNS if c in revenues.columns}


def merge_estimates(revenues: DataFrame, estimates: DataFrame) -> DataFrame:
    """Insert new estimates and refresh old ones; published rows stay as they are."""
    return merge(revenues, estimates, REVENUE_KEY, estimate_rules(revenues), F.expr(STILL_ESTIMATED))


def estimated_films(revenues: DataFrame, estimates: DataFrame) -> DataFrame:
    """Films whose estimate merge_estimates writes."""
    keys = ["film_id", "weekend_id"]
    other = revenues.where(~F.col("data_source").eqNullSafe(fv.ESTIMATE)).select(*keys)
    return estimates.join(other, keys, "left_anti").select("film_id").distinct()


MOVIE_RULES: dict[str, Rule] = {
    "title": prefer_target,
    "fr_title": prefer_target,
    "release_date": prefer_target,
    "poster_path": prefer_target,
    "backdrop_path": prefer_target,
    "budget": fill_zero_too,
    "runtime": fill_zero_too,
    "popularity": larger,
}


def merge_new_movies(movies: DataFrame, source: DataFrame) -> DataFrame:
    """Full metadata of films: known values stay, gaps are filled, popularity is the larger."""
    rules = {c: r for c, r in MOVIE_RULES.items() if c in movies.columns and c in source.columns}
    return merge(movies, source, ["id"], rules)


def refresh_movies(movies: DataFrame, source: DataFrame) -> DataFrame:
    """Known films: popularity overwritten, release date only when the site states one, fr_title if missing."""
    rules = {
        "popularity": lambda t, s: F.coalesce(s, F.lit(0.0)),
        "release_date": prefer_source,
        "fr_title": prefer_target,
    }
    return update(movies, source, ["id"], rules)


def add_showings(showings: DataFrame, source: DataFrame) -> DataFrame:
    return insert_if_absent(showings, source, ["movie_id", "theater_id", "start_at", "date"])


def added_showings(showings: DataFrame, source: DataFrame) -> DataFrame:
    keys = ["movie_id", "theater_id", "start_at", "date"]
    return new_rows(showings, source.dropDuplicates(keys), keys)


def merge_theaters(theaters: DataFrame, source: DataFrame) -> DataFrame:
    """Theatres by name without regard to case: fill chain and screens, add unknown names.

    New theatres take the next ids in name order.
    """
    per_name = source.where(F.col("name").isNotNull()).groupBy(F.upper("name").alias("_key")).agg(
        F.min("name").alias("name"), F.min("company").alias("company"), F.min("screens").alias("screens")
    )
    keyed = theaters.withColumn("_key", F.upper("name"))
    known = update(keyed, per_name, ["_key"], {"company": prefer_target, "screens": prefer_target})
    added = new_rows(keyed, per_name, ["_key"])
    last_id = theaters.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    numbered = dense_numbers(added, "_key").withColumn("id", last_id + F.col("_number"))
    return known.unionByName(shaped_like(keyed, numbered)).drop("_key")


def dense_numbers(rows: DataFrame, key: str) -> DataFrame:
    """Number rows 1..n without a global sort: by hash bucket, each bucket starting after those before it."""
    bucketed = rows.withColumn("_bucket", F.left(F.md5(F.col(key)), F.lit(2)))
    sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    # At most 256 buckets, so this one window is of fixed size.
    before = F.sum("_size").over(Window.orderBy("_bucket")) - F.col("_size")
    starts = sizes.select("_bucket", before.alias("_before"))
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return bucketed.join(starts, "_bucket").withColumn("_number", F.col("_before") + within).drop("_bucket", "_before")


def write_seats(showings: DataFrame, source: DataFrame, as_of: Column) -> DataFrame:
    """Seats sold written, and the stamp set, only where the value differs (NULL-safe)."""
    stamped = source.withColumn("scraped_at", as_of)
    differs = ~F.col("t.seats_sold").eqNullSafe(F.col("s.seats_sold"))
    return update(showings, stamped, ["id"], {"seats_sold": overwrite, "scraped_at": overwrite}, differs)


def write_once(showings: DataFrame, source: DataFrame, column: str) -> DataFrame:
    """Set a column only while it is NULL."""
    return update(showings, source.select("id", column), ["id"], {column: prefer_target})


def assign_screens(showings: DataFrame, source: DataFrame, as_of: Column) -> DataFrame:
    """screen_id set while NULL and the show lies between now and the last second of end_date."""
    last = F.col("s.end_date").cast("timestamp_ntz") + F.expr("interval 1 day") - F.expr("interval 1 second")
    in_range = F.col("t.start_at").between(as_of, last)
    return update(showings, source, ["id"], {"screen_id": prefer_target}, in_range)


def refresh_popularity(movies: DataFrame, source: DataFrame) -> DataFrame:
    """Popularity and budget of films with a real id; an unknown (0) budget becomes NULL."""
    return update(
        movies,
        source,
        ["id"],
        {"popularity": lambda t, s: F.coalesce(s, F.lit(0.0)), "budget": lambda t, s: money.budget_or_null(s)},
        ~money.is_provisional(F.col("t.id")),
    )


def write_ranks(revenues: DataFrame, ranks: DataFrame) -> DataFrame:
    return update(revenues, ranks, ["film_id", "weekend_id"], {"rank": overwrite})


def showing_rows(blocks: DataFrame) -> DataFrame:
    """One showing per listed time of (movie_id, theater_id, date, times); malformed times dropped."""
    return (
        blocks.where(F.col("date").isNotNull())
        .select("movie_id", "theater_id", "date", F.explode("times").alias("time"))
        .where(F.rlike("time", F.lit("^[0-9]{1,2}:[0-9]{2}$")))
        .select("movie_id", "theater_id", tm.local_start(F.col("date"), F.col("time")).alias("start_at"), "date")
        .where(F.col("start_at").isNotNull())
    )
