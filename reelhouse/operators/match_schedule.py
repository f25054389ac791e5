"""Which schedule entry a show is: by theatre, date, time and title.

Repeated shows and repeated entries collapse before titles are compared, and the best entry is a
minimum over a struct, combined map-side. A title meets the entries of its minute only where they
are few; among many it meets those that share a key with it, and an entry that is taken for want
of a better one comes from the minute's own aggregate, not from a comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.functions import text as tx
from reelhouse.functions import time as tm
from reelhouse.operators import title_keys as tk
from reelhouse.operators.match_screen import neighbours
from reelhouse.session import written

SLOT = ["theater_id", "date", "time"]
DAY = ["theater_id", "date"]


def _usable(items: DataFrame) -> DataFrame:
    return items.where((F.col("url") != "") & (F.col("time") != ""))


def _first_entries(items: DataFrame, keys: list[str]) -> DataFrame:
    """First entry of every distinct title within the keys, and how many have the title."""
    return items.groupBy(*keys, F.coalesce("title", F.lit("")).alias("entry_title")).agg(
        F.min(F.struct("pos", "url")).alias("entry"), F.count(F.lit(1)).alias("entry_copies")
    )


def _groups(entries: DataFrame, keys: list[str]) -> DataFrame:
    return entries.groupBy(*keys).agg(
        F.sum("entry_copies").alias("entries"), F.min("entry").alias("first"), F.count(F.lit(1)).alias("titles")
    )


def _shared_words(entry: Column, repeats: Column, wanted: Column) -> Column:
    """Entry words found in the wanted title; a repeated entry word counts every time."""
    every = F.size(F.filter(entry, lambda w: F.array_contains(wanted, w)))
    return F.when(repeats, every).otherwise(F.size(F.array_intersect(entry, wanted)))


def _title_forms(df: DataFrame, title: str, prefix: str) -> DataFrame:
    keyed = df.withColumn("_key", tx.title_key(F.coalesce(F.col(title), F.lit(""))))
    return keyed.withColumns({f"{prefix}_words": tx.words(F.col("_key")), f"{prefix}_flat": F.replace("_key", F.lit(" "), F.lit(""))}).drop("_key")


def _wanted_titles(wanted: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct wanted titles with the size and first entry of their minute; the pairs of them and entries that may match.

    Titles and entries are written, since the pairs of small and of large minutes, the minutes and the picks all read them.
    """
    entries = _title_forms(_first_entries(_usable(items), SLOT), "entry_title", "entry").withColumn(
        "entry_repeats", F.size("entry_words") > F.size(F.array_distinct("entry_words"))
    )
    entries = written(entries, "schedule-entries")
    titles = written(_title_forms(wanted.select(*SLOT, "title").distinct(), "title", "want").join(_groups(entries, SLOT), SLOT), "wanted-titles")
    want_keys = F.concat(tk.inside("a", F.col("want_flat")), tk.around("b", F.col("want_flat")), tk.two_words(F.col("want_words"), False))
    entry_keys = F.concat(tk.around("a", F.col("entry_flat")), tk.inside("b", F.col("entry_flat")), tk.two_words(F.col("entry_words"), True))
    return titles, tk.meeting(titles, entries, SLOT, ["title"], "entry_title", want_keys, entry_keys)


def _shared() -> Column:
    return _shared_words(F.col("entry_words"), F.col("entry_repeats"), F.col("want_words"))


def _simple() -> Column:
    """(tier, rank) of a pair: 1 one title contains the other, 2 by most shared words, two at least; NULL for no match."""
    want, entry = F.col("want_flat"), F.col("entry_flat")
    contained = (entry != "") & (F.contains(want, entry) | F.contains(entry, want))
    shared = _shared()
    return F.when(contained, F.struct(F.lit(1).alias("tier"), F.lit(0).alias("rank"))).when(
        shared >= 2, F.struct(F.lit(2).alias("tier"), (-shared).alias("rank"))
    )


def _strict() -> Column:
    """(tier, rank) of a pair: 1 equal titles, 2 by word similarity, a half at least; NULL for no match."""
    want, entry = F.array_distinct("want_words"), F.array_distinct("entry_words")
    share = F.try_divide(F.size(F.array_intersect(want, entry)), F.greatest(F.size(want), F.size(entry)))
    similarity = F.when(F.size(entry) == 0, 0.0).otherwise(F.coalesce(share, F.lit(0.0)))
    return F.when(F.col("want_flat") == F.col("entry_flat"), F.struct(F.lit(1).alias("tier"), F.lit(0.0).alias("rank"))).when(
        similarity >= 0.5, F.struct(F.lit(2).alias("tier"), (-similarity).alias("rank"))
    )


def _picks(wanted: DataFrame, items: DataFrame, pickers: dict[str, Column]) -> DataFrame:
    """Distinct wanted titles with `entries`, `first` and, per picker, the best match as (tier, rank, pos, url), if any."""
    titles, pairs = _wanted_titles(wanted, items)
    best = [
        F.min(F.when(F.col(f"_{n}").isNotNull(), F.struct(f"_{n}.tier", f"_{n}.rank", "entry.pos", "entry.url"))).alias(n) for n in pickers
    ]
    found = pairs.withColumns({f"_{n}": how for n, how in pickers.items()}).groupBy(*SLOT, "title").agg(*best)
    return titles.alias("_want").join(found.alias("_pick"), _same_title(), "left").select(*[f"_want.{k}" for k in (*SLOT, "title")], "entries", "first", *pickers)


def _same_title() -> Column:
    same = F.col("_want.title").eqNullSafe(F.col("_pick.title"))
    for k in SLOT:
        same = same & (F.col(f"_want.{k}") == F.col(f"_pick.{k}"))
    return same


def _lone() -> Column:
    return F.col("entries") == 1


def _simple_strategy() -> Column:
    by_words = F.concat(F.lit("shared-words("), (-F.col("simple.rank")).cast("string"), F.lit(")"))
    return F.when(_lone(), "single").when(F.col("simple.tier") == 1, "containment").when(F.col("simple.tier") == 2, by_words).otherwise("first")


def _strict_strategy() -> Column:
    by_words = F.concat(F.lit("similar("), F.format_number(-F.col("strict.rank"), 2), F.lit(")"))
    return F.when(_lone(), "single").when(F.col("strict.tier") == 1, "equal").when(F.col("strict.tier") == 2, by_words).otherwise("weak")


def _of(picker: str, field: str, fallback: Column) -> Column:
    return F.when(_lone(), F.col(f"first.{field}")).when(F.col(picker).isNotNull(), F.col(f"{picker}.{field}")).otherwise(fallback)


def pick_entries(wanted: DataFrame, items: DataFrame) -> DataFrame:
    """Entry of each (theater_id, date, time, title): only one at that time; else one title
    contains the other; else the most shared words, two at least; else the first.
    """
    chosen = [_of("simple", f, F.col(f"first.{f}")).alias(f) for f in ("url", "pos")]
    return _picks(wanted, items, {"simple": _simple()}).select(*SLOT, "title", *chosen, _simple_strategy().alias("strategy"))


def pick_entries_strict(wanted: DataFrame, items: DataFrame) -> DataFrame:
    """Older picker: only one at that time; else equal titles; else word similarity of a half or more."""
    chosen = [_of("strict", f, F.lit(None)).alias(f) for f in ("url", "pos")]
    return _picks(wanted, items, {"strict": _strict()}).select(*SLOT, "title", *chosen, _strict_strategy().alias("strategy"))


def pick_entries_both_ways(wanted: DataFrame, items: DataFrame) -> DataFrame:
    """Address and strategy of both pickers, and how many usable entries there are, from one comparison."""
    return _picks(wanted, items, {"simple": _simple(), "strict": _strict()}).select(
        *SLOT, "title",
        _of("strict", "url", F.lit(None)).alias("strict_url"), _strict_strategy().alias("strict_strategy"),
        _of("simple", "url", F.col("first.url")).alias("simple_url"), _simple_strategy().alias("simple_strategy"),
    )


def matched(wanted: DataFrame, picks: DataFrame, with_missing: bool = False) -> DataFrame:
    """Wanted rows with their pick. A show without a title has one too."""
    rest = [f"_pick.{c}" for c in picks.columns if c not in (*SLOT, "title")]
    return wanted.alias("_want").join(picks.alias("_pick"), _same_title(), "left" if with_missing else "inner").select("_want.*", *rest)


def unused_urls(picks: DataFrame, showings: DataFrame, order: list[str]) -> DataFrame:
    """Drop a pick whose address another show of the theatre already has at the same local time.

    Within the batch the first show in the given order keeps it. Of all addresses ever used only those that the batch picked
    go on to the comparison; `picks` is gone over twice, so hand over what is written.
    """
    keys = ["theater_id", "url", "time"]
    picked = picks.select("theater_id", "url").distinct()
    taken = showings.where(F.col("purchase_url").isNotNull()).select(
        "theater_id",
        F.col("purchase_url").alias("url"),
        F.date_trunc("minute", tm.to_local(F.col("start_at"))).alias("_minute"),
        tm.to_local(F.col("start_at")).alias("_at"),
    ).join(picked, ["theater_id", "url"], "left_semi")
    # a taken address blocks only shows at the very same time of day
    taken = taken.where(F.col("_minute") == F.col("_at")).select("theater_id", "url", tm.hhmm(F.col("_at")).alias("time"))
    rest = [c for c in picks.columns if c not in keys and c not in order]
    return (
        picks.join(taken, keys, "left_anti")
        .groupBy(*keys)
        .agg(F.min(F.struct(*order, *rest)).alias("p"))
        .select(*keys, "p.*")
    )


def pick_near(wanted: DataFrame, items: DataFrame, minutes: int = 10) -> DataFrame:
    """Entry of each (theater_id, date, time, title) at that time, else at the nearest time within
    some minutes (both, when equally near), by best title score; else by title alone that day.
    """
    minute = tm.minute_of_day(F.col("time"))
    at = [*DAY, "entry_minute"]
    listed = items.where(F.col("time").isNotNull()).withColumn("entry_minute", minute)
    # read again for the minutes, the first of each, crowded ones and pairs
    entries = written(_near_forms(_first_entries(listed, at), "entry_title", "entry"), "near-entries")
    asked = written(_near_forms(wanted.select(*SLOT, "title").distinct().withColumn("minute", minute), "title", "want"), "near-titles")
    near = neighbours(asked, entries.select(*DAY, F.col("entry_minute").alias("minute")), DAY, "minute")
    before, after = F.col("minute") - F.col("at_most"), F.col("at_least") - F.col("minute")
    gap = F.least(before, after)
    reached = near.where(gap <= minutes).select(
        *DAY,
        "minute",
        F.explode(
            F.array_distinct(
                F.array_compact(F.array(F.when(before == gap, F.col("at_most")), F.when(after == gap, F.col("at_least"))))
            )
        ).alias("entry_minute"),
    )
    reached = written(reached, "near-minutes")
    groups = _groups(entries, at)
    near_titles = asked.join(reached, [*DAY, "minute"]).join(groups, at)
    no_crowd = groups.where(F.col("entries") > tk.FEW).isEmpty()
    if no_crowd:
        words = entries.select(*at, F.lit(None).cast("array<string>").alias("crowding")).limit(0)
    else:
        words = written(tk.crowding_words(entries, at, "entry_long"), "crowding-words")
    entries, near_titles = tk.parted_words(entries.join(words, at, "left"), "entry"), tk.parted_words(near_titles.join(words, at, "left"), "want")
    want_keys, entry_keys = _near_keys("want", tk.inside), _near_keys("entry", tk.heads)
    pairs = tk.meeting(near_titles, entries, at, ["time", "title"], "entry_title", want_keys, entry_keys)
    exact = F.col("entry_listing") == F.col("want_listing")
    starts = F.startswith(F.col("entry_base"), F.col("want_base"))
    overlap = F.size(F.array_intersect("entry_long", "want_long"))
    score = F.when(exact, 300).when(starts, 200).otherwise(0) + overlap
    best = F.min(F.struct((-F.col("score")).alias("minus"), "entry.pos", "entry.url")).alias("b")

    def chosen(scored: DataFrame, found_by: str) -> DataFrame:
        return scored.groupBy(*SLOT, "title").agg(best).select(
            *SLOT, "title", "b.pos", "b.url", (-F.col("b.minus")).alias("score"), F.lit(found_by).alias("found_by")
        )

    # an entry that shares nothing with the title is the first of its minute; every title begins with an empty one
    unlike = near_titles.select(*SLOT, "title", F.col("first").alias("entry"), F.when(F.col("want_base") == "", 200).otherwise(0).alias("score"))
    scored = pairs.select(*SLOT, "title", "entry", score.alias("score")).unionByName(unlike)
    if not no_crowd:
        scored = scored.unionByName(tk.best_by_crowding_words(near_titles, entries, at).select(*SLOT, "title", "entry", "score"))
    timed = chosen(scored, "time")
    untimed = asked.join(reached.select(*DAY, "minute").distinct(), [*DAY, "minute"], "left_anti")
    if untimed.isEmpty():
        return timed
    open_days = items.join(untimed.select(*DAY).distinct(), DAY, "left_semi")  # entries without a time as well
    day_entries = _near_forms(_first_entries(open_days, DAY), "entry_title", "entry")
    return timed.unionByName(chosen(_sharing(untimed, day_entries), "title"))


def _near_keys(prefix: str, base_keys) -> Column:
    listing, base, words = [F.col(f"{prefix}_{f}") for f in ("listing", "base", "rare")]
    return F.concat(F.array(F.concat(F.lit("l:"), listing)), base_keys("b", base), F.transform(words, lambda w: F.concat(F.lit("w:"), w)))


def _near_forms(df: DataFrame, title: str, prefix: str) -> DataFrame:
    return (
        df.withColumn(f"{prefix}_listing", tx.listing_title(F.coalesce(F.col(title), F.lit(""))))
        .withColumn(f"{prefix}_base", tx.base_title(F.coalesce(F.col(title), F.lit(""))))
        .withColumn(f"{prefix}_long", tx.long_words(F.col(f"{prefix}_base")))
    )


def _sharing(untimed: DataFrame, entries: DataFrame) -> DataFrame:
    """Pairs of one theatre and day that share a long word or a title head, with their score.

    Pairs are found through keys (words; heads of the entry title), so unrelated titles never meet. A word that many
    titles of the day share is no key: it adds to the pairs found otherwise, and the best entry by such words alone
    comes from rows of equal crowding words.
    """
    words = written(tk.crowding_words(entries, DAY, "entry_long"), "crowding-words")
    untimed, entries = tk.parted_words(untimed.join(words, DAY, "left"), "want"), tk.parted_words(entries.join(words, DAY, "left"), "entry")

    def word_keys(words: Column) -> Column:
        return F.transform(words, lambda w: F.struct(F.lit(1).alias("points"), w.alias("key")))

    def head_keys(heads: Column) -> Column:
        return F.transform(heads, lambda h: F.struct(F.lit(100).alias("points"), h.alias("key")))

    left = untimed.withColumn("k", F.explode(F.concat(word_keys(F.col("want_rare")), head_keys(tk.inside("", F.col("want_base")))))).select(
        *SLOT, "title", "want_base", "want_hot", "k.points", "k.key"
    )
    right = entries.withColumn("k", F.explode(F.concat(word_keys(F.col("entry_rare")), head_keys(tk.heads("", F.col("entry_base")))))).select(
        *DAY, "entry_title", "entry", "entry_base", "entry_hot", "k.points", "k.key"
    )
    also = F.size(F.array_intersect(F.first("want_hot"), F.first("entry_hot")))
    found = (
        left.join(right, [*DAY, "points", "key"])
        .where((F.col("points") == 1) | F.startswith("entry_base", "want_base"))
        .groupBy(*SLOT, "title", "entry_title", "entry")
        .agg((F.sum("points") + also).alias("score"))
        .select(*SLOT, "title", "entry", "score")
    )
    return found.unionByName(tk.best_by_crowding_words(untimed, entries, DAY).select(*SLOT, "title", "entry", "score"))
