"""Which source serves a theatre, and when a show may be measured there."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse import fixed_values as fv
from reelhouse.functions.text import name_key, pattern


def _keys(names: list[str]) -> list[str]:
    """The literal lists in the same form name_key gives a column."""
    folded = []
    for n in names:
        plain = "".join(ch for ch in unicodedata.normalize("NFD", n) if not unicodedata.combining(ch))
        folded.append(" ".join(plain.lower().split()))
    return sorted(set(folded))


_WITH_SEATS = _keys(fv.TICKETING_WITH_SEATS)
_WITHOUT_SEATS = _keys(fv.TICKETING_WITHOUT_SEATS)
_CHAIN = _keys(fv.CHAIN_THEATERS)
_SEAT_GRID = _keys(fv.SEAT_GRID_THEATERS)


def provider_of(name: Column) -> Column:
    """Provider tag: listed names first, name patterns as the last resort, NULL when unmapped."""
    key = name_key(name)
    return (
        F.when(key.isin(_WITH_SEATS + _WITHOUT_SEATS), "webdev")
        .when(key.isin(_CHAIN), "cineplex")
        .when(F.rlike(key, F.lit(pattern("{B}cinematheque{B}"))), "cinematheque")
        .when(key.isin(_SEAT_GRID), "cineentreprise")
        .when(F.rlike(key, F.lit(pattern("{B}cineplex{B}"))), "cineplex")
    )


def ticketing_kind(name: Column) -> Column:
    """Whether a ticketing theatre shows its seats; NULL for other theatres."""
    key = name_key(name)
    return F.when(key.isin(_WITH_SEATS), fv.DISPLAYING_SEATS).when(
        key.isin(_WITHOUT_SEATS), fv.NOT_DISPLAYING_SEATS
    )


def measuring_window(provider: Column, name: Column) -> tuple[Column, Column]:
    """First and last second, relative to the start of a show, at which it may be measured."""
    first, last = (F.lit(v) for v in fv.DEFAULT_WINDOW)
    for tag, (a, b) in fv.PROVIDER_WINDOWS.items():
        first = F.when(provider == tag, a).otherwise(first)
        last = F.when(provider == tag, b).otherwise(last)
    own = (provider == "webdev") & name_key(name).isin(_WITH_SEATS)
    first = F.when(own, fv.TICKETING_WITH_SEATS_WINDOW[0]).otherwise(first)
    last = F.when(own, fv.TICKETING_WITH_SEATS_WINDOW[1]).otherwise(last)
    return first, F.greatest(last, first + fv.MIN_WINDOW_SECONDS)


def priority(provider: Column) -> Column:
    out = F.lit(fv.UNKNOWN_PRIORITY)
    for tag, order in fv.PROVIDER_PRIORITY.items():
        out = F.when(provider == tag, order).otherwise(out)
    return out


@dataclass(frozen=True)
class Registration:
    """One ticketing site: the theatres it serves and how their shows are measured."""

    names: Sequence[str]
    schedule_url: str
    purchase_url: str
    kind: str = fv.DISPLAYING_SEATS
    window: tuple[int, int] | None = None


_KIND_WORDS = ["noseat", "noseats", "notdisplayingseats"]


def registry(spark: SparkSession, registrations: Sequence[Registration]) -> DataFrame:
    """Registered theatres by name key (as many rows as names were configured).

    A theatre registered twice keeps the later entry. The site address is the origin of the
    schedule address; a window counts only with both bounds.
    """
    entries = [
        (order, n, r.kind, r.schedule_url, r.purchase_url, *(r.window or (None, None)))
        for order, r in enumerate(registrations)
        for n in r.names
    ]
    columns = "seq int, name string, kind string, schedule_url string, purchase_url string, first int, last int"
    word = F.regexp_replace(F.lower("kind"), r"[\s_-]", "")
    rows = spark.createDataFrame(entries, columns).select(
        name_key(F.col("name")).alias("name_key"), "seq",
        F.when(word.isin(_KIND_WORDS), fv.NOT_DISPLAYING_SEATS).otherwise(fv.DISPLAYING_SEATS).alias("kind"),
        F.regexp_extract("schedule_url", "^(https?://[^/?#]+)", 1).alias("site"), "schedule_url", "purchase_url", "first", "last",
    )
    rest = [c for c in rows.columns if c not in ("name_key", "seq")]
    return rows.groupBy("name_key").agg(F.max(F.struct("seq", *rest)).alias("r")).select("name_key", *[f"r.{c}" for c in rest])


def with_registration(theaters: DataFrame, registered: DataFrame) -> DataFrame:
    """Theatres with the site they are registered under, if any."""
    return theaters.withColumn("name_key", name_key(F.col("name"))).join(registered, "name_key", "left")
