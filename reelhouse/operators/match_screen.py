"""Which screen a measured capacity or an auditorium text belongs to.

Every match is a lookup on keys: no screen is paired with every row of its theatre, so a
theatre holding a third of all rows costs no more than its distinct capacities and names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelhouse.functions import text as tx


def screen_by_capacity(screens: DataFrame) -> DataFrame:
    """First screen by name for every seat count of a theatre."""
    return (
        screens.where(F.col("seat_count").isNotNull())
        .groupBy("theater_id", "seat_count")
        .agg(F.min(F.struct("name", "id")).alias("first"))
        .select("theater_id", "seat_count", F.col("first.id").alias("screen_id"))
    )


def neighbours(wanted: DataFrame, offered: DataFrame, group: list[str], value: str) -> DataFrame:
    """For every wanted value the nearest offered value at or below and at or above it.

    Only distinct values per group meet in the window, not rows.
    """
    both = (
        wanted.where(F.col(value).isNotNull()).select(*group, value, F.lit(None).cast("boolean").alias("_offered"))
        .unionByName(offered.where(F.col(value).isNotNull()).select(*group, value, F.lit(True).alias("_offered")))
        .groupBy(*group, value)
        .agg(F.bool_or("_offered").alias("_offered"), F.bool_or(F.col("_offered").isNull()).alias("_wanted"))
    )
    here = F.when(F.col("_offered"), F.col(value))
    line = Window.partitionBy(*group).orderBy(value)
    up_to = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    from_on = line.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return (
        both.withColumn("at_most", F.last(here, ignorenulls=True).over(up_to))
        .withColumn("at_least", F.first(here, ignorenulls=True).over(from_on))
        .where("_wanted")
        .drop("_offered", "_wanted")
    )


def _with_screen(near: DataFrame, pick: Column, screens: DataFrame) -> DataFrame:
    return near.withColumn("seat_count", pick).join(screen_by_capacity(screens), ["theater_id", "seat_count"]).select(
        "theater_id", "capacity", "screen_id", "seat_count"
    )


def _capacity_neighbours(wanted: DataFrame, screens: DataFrame) -> DataFrame:
    offered = screens.select("theater_id", F.col("seat_count").alias("capacity"))
    return neighbours(wanted.select("theater_id", "capacity"), offered, ["theater_id"], "capacity")


def nearest_screen(wanted: DataFrame, screens: DataFrame) -> DataFrame:
    """(theater_id, capacity) to a screen: same size, else the next larger, else the next smaller."""
    return _with_screen(_capacity_neighbours(wanted, screens), F.coalesce("at_least", "at_most"), screens)


def screen_within(wanted: DataFrame, screens: DataFrame, tolerance: int = 10) -> DataFrame:
    """(theater_id, capacity) to the closest screen within a tolerance; of two equally close the larger."""
    above = F.col("at_least") - F.col("capacity")
    below = F.col("capacity") - F.col("at_most")
    above_ok, below_ok = F.coalesce(above <= tolerance, F.lit(False)), F.coalesce(below <= tolerance, F.lit(False))
    pick = F.when(above_ok & (~below_ok | (above <= below)), F.col("at_least")).when(below_ok, F.col("at_most"))
    return _with_screen(_capacity_neighbours(wanted, screens), pick, screens)


#: Texts up to this length are looked up whole; longer ones by their head, and what is found is verified.
LONG = 16


def _pieces(c: Column, shortest: int) -> Column:
    """Distinct substrings of `shortest` to LONG characters: their number grows with the length of the text, not its square."""
    n = F.length(c)

    def at(i: Column) -> Column:
        return F.transform(F.sequence(F.lit(shortest), F.least(n - i + 1, F.lit(LONG))), lambda k: F.substr(c, i, k))

    starts = F.sequence(F.lit(1), n - shortest + 1)
    return F.when(n >= shortest, F.array_distinct(F.flatten(F.transform(starts, at)))).otherwise(F.array().cast("array<string>"))


def _one(c: Column, usable: Column | None = None) -> Column:
    key = F.array(c)
    return key if usable is None else F.when(usable, key).otherwise(F.array().cast("array<string>"))


def _tagged(kind: str, values: Column) -> Column:
    return F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("key")))


def _keyed(rows: DataFrame, keys: dict[str, Column]) -> DataFrame:
    kinds = [_tagged(kind, values) for kind, values in keys.items()]
    return rows.withColumn("_k", F.explode(F.concat(*kinds))).select(*rows.columns, "_k.kind", "_k.key")


def _short(c: Column) -> Column:
    return F.length(c).between(1, LONG)


def _long_head(c: Column) -> Column:
    return _one(F.left(c, F.lit(LONG)), F.length(c) > LONG)


def auditorium_offers(screens: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What of screen_by_auditorium() doesn't depend on the texts: the best screen per key, and the screens by keys of long texts.

    Screens are few rows with many keys each, so they are dealt over all cores first.
    """
    name = F.coalesce("name", F.lit(""))
    named = screens.select("theater_id", F.struct(F.length(name).alias("size"), "id", "seat_count").alias("best"), name.alias("name"))
    named = named.repartition(screens.sparkSession.sparkContext.defaultParallelism)
    named = named.withColumns({"plain": tx.auditorium_key(F.col("name")), "low": F.lower("name")})
    plain, low = F.col("plain"), F.col("low")
    screen_keys = _keyed(
        named,
        {
            "same": _one(F.col("name")),
            "plain": _one(plain),
            "digits": _one(tx.digits(F.col("name")), tx.digits(F.col("name")) != ""),
            "part": _pieces(plain, 1),
            "whole": _one(plain, _short(plain)),
            "like": _pieces(low, 1),
        },
    ).groupBy("theater_id", "kind", "key").agg(F.min("best").alias("best"))
    long_screens = _keyed(named, {"part": _pieces(plain, LONG), "whole": _long_head(plain), "like": _pieces(low, LONG)})
    return screen_keys, long_screens


def screen_by_auditorium(wanted: DataFrame, screens: DataFrame, offers: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """(theater_id, auditorium) to a screen by name.

    Tiers: same text; same normalised name; same digits; one normalised name contains the
    other; the screen name contains the text. Within a tier the shorter, then the lower id.

    Screens are reduced to the best one per key before any text meets them. Only texts over
    LONG characters meet the screens that hold their first LONG, to be compared in full.
    Who asks several times about the same screens passes their auditorium_offers(), written once.
    """
    screen_keys, long_screens = auditorium_offers(screens) if offers is None else offers
    texts = wanted.select("theater_id", "auditorium").where(tx.trim_space(F.col("auditorium")) != "").distinct()
    texts = texts.withColumn("said", tx.trim_space(F.col("auditorium"))).withColumns({"want": tx.auditorium_key(F.col("said")), "want_low": F.lower("said")})
    said, want, want_low = F.col("said"), F.col("want"), F.col("want_low")

    text_keys = _keyed(
        texts,
        {
            "same": _one(said),
            "plain": _one(want),
            "digits": _one(tx.digits(said)),
            "part": _one(want, _short(want)),
            "whole": _pieces(want, 1),
            "like": _one(want_low, _short(want_low)),
        },
    )
    looked_up = text_keys.join(screen_keys, ["theater_id", "kind", "key"]).select("theater_id", "auditorium", "kind", "best")
    long_texts = _keyed(texts, {"part": _long_head(want), "whole": _pieces(want, LONG), "like": _long_head(want_low)})
    holds = (
        F.when(F.col("kind") == "part", F.contains("plain", "want"))
        .when(F.col("kind") == "whole", F.contains("want", "plain"))
        .otherwise(F.contains("low", "want_low"))
    )
    compared = long_texts.join(long_screens, ["theater_id", "kind", "key"]).where(holds).select("theater_id", "auditorium", "kind", "best")
    tier = F.when(F.col("kind") == "same", 0)
    for kind, order in (("plain", 1), ("digits", 2), ("part", 3), ("whole", 3), ("like", 4)):
        tier = tier.when(F.col("kind") == kind, order)
    return (
        looked_up.unionByName(compared)
        .groupBy("theater_id", "auditorium")
        .agg(F.min(F.struct(tier.alias("tier"), "best")).alias("pick"))
        .select(
            "theater_id",
            "auditorium",
            F.col("pick.best.id").alias("screen_id"),
            F.col("pick.best.seat_count").alias("seat_count"),
            F.col("pick.tier").alias("tier"),
        )
    )
