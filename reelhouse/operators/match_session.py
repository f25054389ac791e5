"""Which ticketing session a show is: duplicates, scored match, narrowing match, title match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelhouse import fixed_values as fv
from reelhouse.functions import text as tx
from reelhouse.operators import title_keys as tk
from reelhouse.session import written

SLOT = ["theater_id", "date", "time"]
#: Distinct titles wanted in a crowded slot up to which each is compared with all its offers.
FEW_TITLES = 256


def session_key(
    session_id: Column, auditorium: Column, start: Column, film: Column
) -> Column:
    fallback = F.concat(
        F.lit("k:"),
        F.concat_ws("|", tx.trim_space(F.coalesce(auditorium, F.lit(""))), F.coalesce(start, F.lit("")), F.coalesce(film, F.lit(""))),
    )
    return F.when(F.coalesce(session_id, F.lit("")) != "", F.concat(F.lit("v:"), session_id)).otherwise(fallback)


def area_priority(area: Column) -> Column:
    return F.when(area == fv.GENERAL_AREA, 3).when(area == fv.MOTION_SEAT_AREA, 1).otherwise(2)


def experience_priority(types: Column) -> Column:
    low = F.transform(F.coalesce(types, F.array().cast("array<string>")), F.lower)
    regular = F.exists(low, lambda x: F.contains(x, F.lit("regular")))
    motion = F.exists(low, lambda x: F.contains(x, F.lit("d-box")) | F.contains(x, F.lit("dbox")))
    return F.when(regular, 2).when(motion, 1).otherwise(0)


def best_sessions(sessions: DataFrame) -> DataFrame:
    """One row per session: the best area and experience, the first listed on ties.

    A minimum over a struct, so copies of one session combine before the shuffle.
    """
    key = session_key(
        F.col("session_id"), F.col("auditorium"), F.coalesce("start_utc", "start_local"), F.coalesce("film_url", "movie_name")
    )
    score = area_priority(F.col("area_code")) * 100 + experience_priority(F.col("experience_types"))
    rest = [c for c in sessions.columns if c not in ("theater_id", "pos")]
    return (
        sessions.groupBy("theater_id", key.alias("session_key"))
        .agg(F.min(F.struct((-score).alias("minus"), "pos", F.struct(*rest).alias("row"))).alias("b"))
        .select("theater_id", F.col("b.pos").alias("pos"), "b.row.*")
    )


def _base_score(offer_runtime: Column | None = None, offer_language: Column | None = None) -> Column:
    """What runtime and language add to a score, whatever the titles are."""
    offer_runtime = F.col("offer_runtime") if offer_runtime is None else offer_runtime
    offer_language = F.col("offer_language") if offer_language is None else offer_language
    off = F.abs(offer_runtime - F.col("runtime"))
    by_runtime = F.when(off <= 3, 0.0).when(off <= 6, 0.5).when(off <= 10, 1.0).when(off.isNotNull(), 2.0).otherwise(0.5)
    return by_runtime + F.when(offer_language != F.col("language"), 0.5).otherwise(0.0)


def _title_score() -> Column:
    return tx.squished_distance(*[F.col(c) for c in ("offer_form", "offer_chars", "want_form", "want_chars")])


_WANT = [*SLOT, "title", "runtime", "language"]
_CLASS = ["offer_runtime", "offer_language"]
_OFFER = ["pos", "auditorium", "offer_title"]


def _three_best(scored: DataFrame) -> DataFrame:
    """Per want the three best of (score, pos, auditorium, offer_title), as o1, o2, o3."""
    place = F.row_number().over(Window.partitionBy(*_WANT).orderBy("score", "pos"))
    offer = F.struct("score", *_OFFER)
    best = scored.withColumn("place", place).where(F.col("place") <= 3).groupBy(*_WANT)
    return best.agg(*[F.max(F.when(F.col("place") == i, offer)).alias(f"o{i}") for i in (1, 2, 3)])


def _same_want(left: str, right: str) -> Column:
    same = F.lit(True)
    for k in _WANT:
        same = same & (F.col(f"{left}.{k}") == F.col(f"{right}.{k}") if k in SLOT else F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")))
    return same


def _few_titles(wants: DataFrame, offers: DataFrame) -> DataFrame:
    """Three best of crowded slots whose wants name few titles: each title is compared once per offer, and its wants meet classes.

    Offers of one class of runtime and language differ in their titles' score alone, so a title's first three of a class are
    all that a want can take from it, and of the classes only the three whose first offers are best.
    """
    members = offers.groupBy(*SLOT, *_CLASS).agg(F.collect_list(F.struct("pos", "auditorium", "offer_title", "offer_form", "offer_chars")).alias("_all"))
    slots = members.groupBy(*SLOT).agg(F.collect_list(F.struct(*_CLASS, "_all")).alias("_slot"))
    titles = wants.select(*SLOT, "want_form", "want_chars").dropDuplicates([*SLOT, "want_form"])

    def compared(o: Column) -> Column:
        score = tx.squished_distance(o["offer_form"], o["offer_chars"], F.col("want_form"), F.col("want_chars"))
        return F.struct(score.cast("double").alias("score"), *[o[c].alias(c) for c in _OFFER])

    def reduced(c: Column) -> Column:
        first = F.slice(F.sort_array(F.transform(c["_all"], compared)), 1, 3)
        return F.struct(*[c[k].alias(k) for k in _CLASS], first.alias("first"))

    met = titles.join(slots, SLOT).select(*SLOT, "want_form", F.transform("_slot", reduced).alias("_classes"))

    def shifted(c: Column) -> Column:
        base = _base_score(c["offer_runtime"], c["offer_language"])
        return F.struct((c["first"][0]["score"] + base).alias("score"), c["first"][0]["pos"].alias("pos"), base.alias("base"), c["first"].alias("first"))

    nearest = F.slice(F.sort_array(F.transform("_classes", shifted)), 1, 3)
    scored = F.transform(nearest, lambda c: F.transform(c["first"], lambda o: F.struct((o["score"] + c["base"]).alias("score"), *[o[k].alias(k) for k in _OFFER])))
    best = wants.join(met, [*SLOT, "want_form"]).select(*_WANT, F.sort_array(F.flatten(scored)).alias("_best"))
    return best.select(*_WANT, *[F.get("_best", F.lit(i)).alias(f"o{i + 1}") for i in range(3)])


def _bounded(wants: DataFrame, offers: DataFrame) -> DataFrame:
    """Scored pairs of crowded slots that hold every want's three best, found by branch and bound.

    Offers of a slot fall into classes of runtime and language, which bound their scores from below. The first
    offer of every class (its first three for an empty title) gives each want a third-best score to beat. Then the class nearest to the want is opened, its
    titles compared and the third best lowered; of the other classes only those are opened whose bound still beats it.
    An empty title is equally far from all, so it needs no class opened. Of each step only the three best per want are kept.
    """
    forms = [*_OFFER, "offer_form", "offer_chars"]
    first = F.row_number().over(Window.partitionBy(*SLOT, *_CLASS).orderBy("pos"))
    heads = offers.withColumn("_nth", first).where(F.col("_nth") <= 3).groupBy(*SLOT, *_CLASS)
    classes = heads.agg(F.collect_list(F.struct(*forms)).alias("_heads"), F.min("pos").alias("_first"))
    met = wants.join(classes, SLOT).withColumn("base", _base_score())
    scored = ["score", *_OFFER]
    at_heads = met.select("*", F.explode(F.slice("_heads", 1, F.when(F.col("want_form") == "", 3).otherwise(1))).alias("_h")).select(*_WANT, "base", "want_form", "want_chars", *[F.col(f"_h.{c}").alias(c) for c in forms])
    at_heads = at_heads.withColumn("score", F.col("base") + _title_score()).select(*_WANT, *scored)

    def kept(found: DataFrame, purpose: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*_WANT).orderBy("score", "pos"))
        return written(found.withColumn("_place", place).where(F.col("_place") <= 3).drop("_place"), purpose)

    def third(found: DataFrame) -> DataFrame:
        return _three_best(found).select(*_WANT, F.struct(F.col("o3.score").alias("score"), F.col("o3.pos").alias("pos")).alias("_third"), F.col("o3").isNotNull().alias("_full"))

    def opened(chosen: DataFrame) -> DataFrame:
        inside = (F.col("c.offer_runtime").eqNullSafe(F.col("o.offer_runtime"))) & (F.col("c.offer_language").eqNullSafe(F.col("o.offer_language")))
        for k in SLOT:
            inside = inside & (F.col(f"c.{k}") == F.col(f"o.{k}"))
        pairs = chosen.alias("c").join(offers.alias("o"), inside).select("c.*", *[f"o.{c}" for c in forms])
        return pairs.withColumn("score", F.col("base") + _title_score()).select(*_WANT, *scored)

    held = [*_WANT, "want_form", "want_chars", *_CLASS, "base", "_first"]
    may_win = ~F.col("t._full") | (F.struct(F.col("m.base").alias("score"), F.col("m._first").alias("pos")) < F.col("t._third"))
    open_to = met.where(F.col("want_form") != "").select(*held)
    nearest = open_to.groupBy(*_WANT).agg(F.min("base").alias("_least"))
    ranked = open_to.alias("m").join(nearest.alias("t"), _same_want("m", "t")).select("m.*", (F.col("base") == F.col("_least")).alias("_near"))
    start = kept(at_heads, "session-heads")
    near = ranked.where("_near").alias("m").join(third(start).alias("t"), _same_want("m", "t")).where(may_win).select("m.*")
    start = kept(start.unionByName(opened(near)).distinct(), "session-nearest")
    rest = ranked.where("NOT _near").alias("m").join(third(start).alias("t"), _same_want("m", "t")).where(may_win).select("m.*")
    return start.unionByName(opened(rest)).distinct()


def scored_session(wanted: DataFrame, sessions: DataFrame, few: int = tk.FEW) -> DataFrame:
    """Wanted (theater_id, date, time, title, runtime, language) to a session by lowest score.

    Runtime distance, title distance and language add up; two best closer than a quarter
    point are reported as ambiguous with the three best. In slots of more than `few` distinct
    offers wants of one title share its comparisons; where many titles are wanted, they are compared only where a bound of the
    score allows one of the three best.
    """
    wants = (
        wanted.select(*_WANT).distinct()
        .withColumn("want_form", tx.squished(F.coalesce("title", F.lit(""))))
        .withColumn("want_chars", tx.characters(F.col("want_form")))
    )
    offers = sessions.select(
        *SLOT, "pos", "auditorium", F.coalesce("movie_name", F.lit("")).alias("offer_title"),
        F.nullif("runtime_minutes", F.lit(0)).alias("offer_runtime"), F.col("language_code").alias("offer_language"),
    )
    # Offers alike in all that is scored tie, so the first three of them are enough.
    alike = Window.partitionBy(*SLOT, "offer_title", *_CLASS).orderBy("pos")
    offers = (
        offers.withColumn("_copy", F.row_number().over(alike)).where(F.col("_copy") <= 3).drop("_copy")
        .withColumn("offer_form", tx.squished(F.col("offer_title")))
        .withColumn("offer_chars", tx.characters(F.col("offer_form")))
    )
    # read again for the crowded slots, their titles and every method
    wants, offers = written(wants, "session-wants"), written(offers, "session-offers")
    crowded = offers.groupBy(*SLOT).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > few).select(*SLOT)
    named = wants.join(crowded, SLOT, "left_semi").groupBy(*SLOT).agg(F.countDistinct("want_form").alias("_titles"))
    named = written(named, "session-slots")
    # never broadcast: the sizes that Catalyst goes by are those of compressed files
    best = _three_best(wants.join(named, SLOT, "left_anti").hint("merge").join(offers, SLOT).withColumn("score", _base_score() + _title_score()))
    for slots, method in ((F.col("_titles") <= FEW_TITLES, _few_titles), (F.col("_titles") > FEW_TITLES, lambda w, o: _three_best(_bounded(w, o)))):
        chosen = named.where(slots).select(*SLOT)
        if not chosen.isEmpty():
            best = best.unionByName(method(wants.join(chosen, SLOT, "left_semi"), offers.join(chosen, SLOT, "left_semi")))
    close = F.col("o2").isNotNull() & (F.abs(F.col("o1.score") - F.col("o2.score")) < 0.25)
    top = F.array_compact(F.array(*[F.col(f"o{i}.pos") for i in (1, 2, 3)]))
    return wanted.alias("w").join(best.alias("b"), _same_want("w", "b"), "left").select(
        "w.*",
        F.when(F.col("o1").isNull(), "NOT_FOUND_AT_TIME").when(close, "AMBIGUOUS_AT_TIME").otherwise("OK").alias("status"),
        F.when(~close, F.col("o1.pos")).alias("session_pos"),
        F.when(~close, F.col("o1.auditorium")).alias("auditorium"),
        F.when(close, top).alias("candidates"),
    )


def narrowed_session(wanted: DataFrame, sessions: DataFrame) -> DataFrame:
    """Wanted (theater_id, date, time, title, runtime) to a session by narrowing: runtime within three
    minutes if any, then title if any; of several auditoriums the general area; else the first.

    Titles that contain the wanted one are found through keys. Where none does, the sessions near in
    runtime, or all of the slot, decide as an aggregate of their minute, with no pair made.
    """
    pick = F.struct("pos", "auditorium", "seats_remaining")
    hall = tx.trim_space(F.coalesce("auditorium", F.lit("")))
    name = F.coalesce("movie_name", F.lit(""))
    # Sessions alike in all that is compared collapse to their first before any want meets them.
    offers = sessions.groupBy(*SLOT, name.alias("offer_title"), "runtime_minutes", hall.alias("hall")).agg(
        F.min(pick).alias("any"), F.min(F.when(F.col("area_code") == fv.GENERAL_AREA, pick)).alias("general")
    )
    offers = written(offers, "session-offers")
    decided = [F.min("any").alias("any"), F.min("general").alias("general"), F.min("low").alias("low"), F.max("high").alias("high")]
    spread = offers.withColumns({"low": F.col("hall"), "high": F.col("hall")})
    keys = [*SLOT, "title", "runtime"]
    wants = written(wanted.select(*keys).distinct(), "session-wants")
    names = (
        offers.select(*SLOT, "offer_title").distinct()
        .withColumn("offer_low", tx.strip_marks(F.lower("offer_title")))
        .withColumn("offer_form", tx.squished(F.col("offer_title")))
    )
    names = written(names, "session-names")
    titles = (
        wants.select(*SLOT, "title").distinct()
        .withColumn("want_low", tx.strip_marks(F.lower(F.coalesce("title", F.lit("")))))
        .withColumn("want_form", tx.squished(F.coalesce("title", F.lit(""))))
        # a title without letters or digits is in all or in none, which decides nothing
        .where((F.col("want_low") != "") & (F.col("want_form") != ""))
        .join(names.groupBy(*SLOT).agg(F.count(F.lit(1)).alias("titles")), SLOT)
    )
    titles = written(titles, "session-titles")
    want_keys = F.concat(tk.inside("a", F.col("want_low")), tk.inside("b", F.col("want_form")))
    offer_keys = F.concat(tk.around("a", F.col("offer_low")), tk.around("b", F.col("offer_form")))
    named = tk.meeting(titles, names, SLOT, ["title"], "offer_title", want_keys, offer_keys)
    named = named.where(F.contains("offer_low", "want_low") | F.contains("offer_form", "want_form")).select(*SLOT, "title", "offer_title")
    near = F.coalesce(F.abs(F.col("runtime_minutes") - F.col("runtime")) <= 3, F.lit(False))
    by_title = wants.join(named, [*SLOT, "title"]).join(spread, [*SLOT, "offer_title"]).groupBy(*keys, near.alias("near")).agg(*decided)
    minutes = spread.groupBy(*SLOT, "runtime_minutes").agg(*decided)
    reach = wants.select(*SLOT, "runtime").where(F.col("runtime").isNotNull()).distinct()
    reach = reach.withColumn("runtime_minutes", F.explode(F.sequence(F.col("runtime") - 3, F.col("runtime") + 3)))
    by_runtime = reach.join(minutes, [*SLOT, "runtime_minutes"]).groupBy(*SLOT, "runtime").agg(*decided)
    whole = minutes.groupBy(*SLOT).agg(*decided)
    found = ["any", "general", "low", "high"]
    groups = [
        by_title.select(*keys, F.when(F.col("near"), 1).otherwise(3).alias("turn"), *found),
        wants.join(by_runtime, [*SLOT, "runtime"]).select(*keys, F.lit(2).alias("turn"), *found),
        wants.join(whole, SLOT).select(*keys, F.lit(4).alias("turn"), *found),
    ]
    best = groups[0].unionByName(groups[1]).unionByName(groups[2]).groupBy(*keys).agg(F.min_by(F.struct(*found), "turn").alias("b"))
    chosen = F.when(F.col("b.low") == F.col("b.high"), F.col("b.any")).otherwise(F.coalesce("b.general", "b.any"))
    return best.select(*keys, chosen.alias("p")).select(
        *keys, F.col("p.pos").alias("session_pos"), tx.trim_space(F.col("p.auditorium")).alias("auditorium"), F.col("p.seats_remaining").alias("seats_remaining")
    )


def titled_session(wanted: DataFrame, sessions: DataFrame) -> DataFrame:
    """Wanted (theater_id, date, time, title) to the first session with the same date, time and title;
    else the first at that time whose title contains the wanted one, whatever its date says.

    'date' is the day the listing was asked for, 'session_date' what the session says.
    """
    wants = wanted.select(*SLOT, "title").where(F.col("title").isNotNull()).distinct().withColumn("want_key", tx.listing_title(F.col("title")))
    offers = sessions.withColumn("offer_key", tx.listing_title(F.coalesce("movie_name", F.lit(""))))
    first = offers.groupBy(*SLOT, "offer_key").agg(
        F.min(F.struct("pos", "auditorium", "seats_remaining")).alias("loose"),
        F.min(F.when(F.col("session_date") == F.col("date"), F.struct("pos", "auditorium", "seats_remaining"))).alias("exact"),
    )
    same = F.col("offer_key") == F.col("want_key")
    wants = wants.join(first.groupBy(*SLOT).agg(F.count(F.lit(1)).alias("titles")), SLOT)
    pairs = tk.meeting(wants, first, SLOT, ["title"], "offer_key", tk.inside("", F.col("want_key")), tk.around("", F.col("offer_key")))
    return (
        pairs.where(F.contains("offer_key", "want_key"))
        .groupBy(*SLOT, "title")
        .agg(F.min(F.when(same, F.col("exact"))).alias("e"), F.min("loose").alias("l"))
        .select(
            *SLOT, "title",
            F.coalesce("e.pos", "l.pos").alias("session_pos"),
            F.when(F.col("e").isNotNull(), F.col("e.auditorium")).otherwise(F.col("l.auditorium")).alias("auditorium"),
            F.when(F.col("e").isNotNull(), F.col("e.seats_remaining")).otherwise(F.col("l.seats_remaining")).alias("seats_remaining"),
            F.when(F.col("e").isNotNull(), "exact").otherwise("loose").alias("found_by"),
        )
    )
