"""Seat measurements to seats sold and screens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.functions import money
from reelhouse.functions import text as tx
from reelhouse.operators.match_screen import screen_by_auditorium, screen_within

GRID_SOURCE = "cineentreprise"


def latest_measurements(measurements: DataFrame) -> DataFrame:
    """Last measurement of every showing; map-side combined, so replays cost nothing extra."""
    rest = [c for c in measurements.columns if c not in ("showing_id", "measured_at")]
    return (
        measurements.groupBy("showing_id")
        .agg(F.max(F.struct("measured_at", *rest)).alias("m"))
        .select("showing_id", "m.*")
    )


def screen_lookup(measurements: DataFrame, screens: DataFrame, offers: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """(theater_id, match_key) to a screen, for every distinct capacity and auditorium text measured; `offers` as in screen_by_auditorium()."""
    grid = F.col("source") == GRID_SOURCE
    by_size = screen_within(measurements.where(grid), screens)
    by_name = screen_by_auditorium(measurements.where(~grid), screens, offers)
    return by_size.select(
        "theater_id", _capacity_key(F.col("capacity")).alias("match_key"), F.col("screen_id").alias("matched_screen"), F.col("seat_count").alias("matched_seats")
    ).unionByName(
        by_name.select(
            "theater_id", _auditorium_key(F.col("auditorium")).alias("match_key"), F.col("screen_id").alias("matched_screen"), F.col("seat_count").alias("matched_seats")
        )
    )


def _capacity_key(capacity: Column) -> Column:
    return F.concat(F.lit("capacity:"), capacity.cast("string"))


def _auditorium_key(auditorium: Column) -> Column:
    return F.concat(F.lit("auditorium:"), auditorium)


def with_path(measurements: DataFrame, lookup: DataFrame) -> DataFrame:
    """Measurements with the path each takes and, where the text or capacity tells, its screen.

    One join serves both kinds of key. Rows without a key get one of their own that matches
    nothing, so they spread over the partitions instead of meeting on NULL.
    """
    grid = F.col("source") == GRID_SOURCE
    blank = F.coalesce(tx.trim_space(F.col("auditorium")), F.lit("")) == ""
    own = F.concat(F.lit("none:"), F.col("showing_id").cast("string"))
    key = F.coalesce(
        F.when(grid, _capacity_key(F.col("capacity"))).when(~blank, _auditorium_key(F.col("auditorium"))), own
    )
    found = F.col("matched_screen").isNotNull()
    path = (
        F.when(F.col("seats_remaining").isNull(), "skipped")
        .when(grid, F.when(found, "capacity").otherwise("skipped"))
        .when(blank, "known_screen")
        .otherwise(F.when(found, "auditorium").otherwise("stamped"))
    )
    return measurements.withColumn("match_key", key).join(lookup, ["theater_id", "match_key"], "left").select(
        *measurements.columns, path.alias("path"), "matched_screen", "matched_seats"
    )


def resolve(measurements: DataFrame, lookup: DataFrame) -> DataFrame:
    """What of with_path() the showings need."""
    return with_path(measurements, lookup).select("showing_id", "seats_remaining", "measured_at", "path", "matched_screen", "matched_seats")


def apply_measurements(
    showings: DataFrame, screens: DataFrame, measurements: DataFrame, as_of: Column | None = None
) -> DataFrame:
    """Next state of the showings: seats sold, write-once screen, stamp; and the path each took.

    The showings table keeps its columns and gains 'path' (NULL where nothing was measured).
    Without as_of the stamp is the time of the measurement itself.
    """
    # The lookup covers every measurement, not just the latest ones: a superset of distinct keys
    # is cheaper than picking the latest twice more.
    return apply_resolved(showings, screens, resolve(latest_measurements(measurements), screen_lookup(measurements, screens)), as_of)


def apply_resolved(showings: DataFrame, screens: DataFrame, resolved: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The same from one resolved measurement per showing, as resolve() gives them."""
    stamp = F.col("measured_at") if as_of is None else as_of
    known = screens.select(F.col("id").alias("_screen"), F.col("seat_count").alias("known_seats"))
    no_screen = -1 - F.col("id")
    both = (
        showings.join(resolved, F.col("id") == F.col("showing_id"), "left")
        .withColumn("_screen", F.coalesce(F.when(F.col("path") == "known_screen", F.col("screen_id")), no_screen))
        .join(known, "_screen", "left")
    )
    path = F.when((F.col("path") == "known_screen") & F.col("known_seats").isNull(), "stamped").otherwise(F.col("path"))
    remaining = F.col("seats_remaining")
    sold = (
        F.when(path == "capacity", money.seats_sold_clamped(F.col("matched_seats"), remaining))
        .when(path == "auditorium", money.seats_sold(F.col("matched_seats"), remaining))
        .when(path == "known_screen", money.seats_sold(F.col("known_seats"), remaining))
    )
    changed = path.isin("auditorium", "known_screen") & ~F.col("seats_sold").eqNullSafe(sold)
    new = {
        "seats_sold": F.coalesce(sold, F.col("seats_sold")),
        "screen_id": F.coalesce(
            "screen_id", F.when(path.isin("capacity", "auditorium"), F.col("matched_screen"))
        ),
        "scraped_at": F.when(changed | (path == "stamped"), stamp).otherwise(F.col("scraped_at")),
    }
    return both.select(*[new[c].alias(c) if c in new else F.col(c) for c in showings.columns], path.alias("path"))
