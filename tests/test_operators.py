"""Merge properties, brute-force matches, estimate properties."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from reelhouse.operators import match_screen, match_schedule, merge, seats
from reelhouse.plans import rank, weekly_load
from reelhouse.plans.weekend_estimate import Weekend, estimate_weekend, published_floor
from reelhouse.session import written
from reelhouse.sources.sample import SampleTables

REV = "film_id bigint, weekend_id int, revenue_qc bigint, data_source string, cumulatif_qc_to_date bigint, rank int"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def t(spark, folder):
    return SampleTables(spark, folder)


def test_estimates_replace_only_estimates(spark):
    target = spark.createDataFrame([(1, 202401, 10, "cinoche", 10, 1), (2, 202401, 20, "estimate", 20, 2)], REV)
    source = spark.createDataFrame([(1, 202401, 99, "estimate", 99, None), (2, 202401, 88, "estimate", 88, None), (3, 202401, 77, "estimate", 77, None)], REV)
    out = {r.film_id: (r.revenue_qc, r.data_source, r["rank"]) for r in merge.merge_estimates(target, source).collect()}
    assert out == {1: (10, "cinoche", 1), 2: (88, "estimate", 2), 3: (77, "estimate", None)}
    assert {r.film_id for r in merge.estimated_films(target, source).collect()} == {2, 3}


def test_published_keeps_known_cumulative(spark):
    target = spark.createDataFrame([(1, 202401, 10, "estimate", 500, 3)], REV)
    source = spark.createDataFrame([(1, 202401, 12, "x", None, None)], REV)
    assert rows(merge.merge_published(target, source)) == [(1, 202401, 12, "cinoche", 500, None)]


@pytest.mark.parametrize("operation", ["weekends", "estimates", "movies", "showings", "theaters"])
def test_merges_are_idempotent(t, operation):
    if operation == "weekends":
        target, source, apply = t.weekends, t.weekends.withColumn("id", F.col("id") + 1), merge.merge_weekends
    elif operation == "estimates":
        target, apply = t.revenues, merge.merge_estimates
        source = t.revenues.withColumn("revenue_qc", F.col("revenue_qc") + 5).withColumn("film_id", F.col("film_id") * 2)
    elif operation == "movies":
        target, source, apply = t.movies, t.movies.withColumn("id", F.col("id") * 3), merge.merge_new_movies
    elif operation == "showings":
        target, apply = t.showings, merge.add_showings
        source = t.showings.select("movie_id", "theater_id", F.col("start_at") + F.expr("interval 1 day") * 1, "date").toDF("movie_id", "theater_id", "start_at", "date")
    else:
        target, apply = t.theaters, merge.merge_theaters
        source = t.theaters.select(F.concat("name", F.lit(" annexe")).alias("name"), "company", F.lit(3).alias("screens"))
    once = written(apply(target, source), f"merge-{operation}")
    assert rows(apply(once, source)) == rows(once)


def test_write_once_never_changes_a_set_value(spark):
    target = spark.createDataFrame([(1, 5), (2, None)], "id bigint, screen_id bigint")
    source = spark.createDataFrame([(1, 9), (2, 8), (3, 7)], "id bigint, screen_id bigint")
    assert rows(merge.write_once(target, source, "screen_id")) == [(1, 5), (2, 8)]


def test_seats_stamp_only_on_change(spark):
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    schema = "id bigint, seats_sold int, scraped_at timestamp_ntz"
    target = spark.createDataFrame([(1, 5, None), (2, None, None), (3, 4, None)], schema)
    source = spark.createDataFrame([(1, 5), (2, None), (3, None)], "id bigint, seats_sold int")
    out = {r.id: (r.seats_sold, r.scraped_at is not None) for r in merge.write_seats(target, source, at).collect()}
    assert out == {1: (5, False), 2: (None, False), 3: (None, True)}


SCREENS = [(1, 1, "Salle 1", 80), (2, 1, "Salle 2", 120), (3, 1, "Salle 03", 200), (4, 1, "VIP 12", 120), (5, 1, "Grande salle", None), (6, 2, "Unique", 50)]


@pytest.fixture(scope="module")
def screens(spark):
    return spark.createDataFrame(SCREENS, "id bigint, theater_id bigint, name string, seat_count int")


def test_nearest_and_tolerance(spark, screens):
    wanted = spark.createDataFrame([(1, c) for c in (120, 100, 250, 112, 70, 130, 131)] + [(9, 10)], "theater_id bigint, capacity int")
    near = {r.capacity: r.seat_count for r in match_screen.nearest_screen(wanted, screens).collect()}
    assert near == {120: 120, 100: 120, 250: 200, 112: 120, 70: 80, 130: 200, 131: 200}
    within = {r.capacity: (r.seat_count, r.screen_id) for r in match_screen.screen_within(wanted, screens).collect()}
    assert within == {120: (120, 2), 112: (120, 2), 70: (80, 1), 130: (120, 2)}


def test_equally_close_takes_the_larger(spark):
    sc = spark.createDataFrame([(1, 1, "a", 90), (2, 1, "b", 110)], "id bigint, theater_id bigint, name string, seat_count int")
    wanted = spark.createDataFrame([(1, 100)], "theater_id bigint, capacity int")
    assert [r.seat_count for r in match_screen.screen_within(wanted, sc).collect()] == [110]


def test_auditorium_tiers(spark, screens):
    said = [("Salle 2", 2), ("salle 3", 3), ("Auditorium #1", 1), ("vip", 4), ("Grande", 5), ("Salle 99", None), ("12", 4)]
    wanted = spark.createDataFrame([(1, s) for s, _ in said], "theater_id bigint, auditorium string")
    out = {r.auditorium: r.screen_id for r in match_screen.screen_by_auditorium(wanted, screens).collect()}
    assert out == {s: i for s, i in said if i is not None}


def test_long_auditorium_texts_match_brute_force(spark):
    """Names and texts up to 300 characters, some inside each other, one shorter than a piece."""
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcd") for _ in range(rnd.randint(2, 30)))
    names = [" ".join(word() for _ in range(rnd.randint(1, 20)))[:300] for _ in range(60)] + ["Salle 7", "ab", ""]
    said = [n[a : a + rnd.randint(1, 200)] for n in names[:40] if n for a in [rnd.randrange(len(n))]] + [f"x {n} y" for n in names[:20]] + [n.upper() for n in names[:10]]
    said = [t for t in dict.fromkeys(said) if t.strip()]
    sc = [(i, 1, n, 80 + i) for i, n in enumerate(names)]
    got = match_screen.screen_by_auditorium(
        spark.createDataFrame([(1, t) for t in said], "theater_id bigint, auditorium string"),
        spark.createDataFrame(sc, "id bigint, theater_id bigint, name string, seat_count int"),
    )
    found = {r.auditorium: (r.tier, r.screen_id) for r in got.collect()}
    plain = lambda t: t.lower().replace("salle", "").replace(" ", "")
    digits = lambda t: "".join(c for c in t if c.isdigit())
    for t in said:
        s, tiers = t.strip(" "), []
        for i, _, n, _ in sc:
            p, w = plain(n), plain(s)
            if n == s:
                tier = 0
            elif p == w:
                tier = 1
            elif digits(n) and digits(n) == digits(s):
                tier = 2
            elif p and w and (p in w or w in p):
                tier = 3
            elif s.lower() in n.lower():
                tier = 4
            else:
                continue
            tiers.append((tier, len(n), i))
        assert found.get(t) == (None if not tiers else (min(tiers)[0], min(tiers)[2])), t


def test_hot_theatre_matches_brute_force(spark):
    """A third of all rows in one theatre, with many copies."""
    rnd = random.Random(7)
    sc = [(i, 1 if i % 3 == 0 else i % 5, f"Salle {i}", 50 + rnd.randrange(40) * 5) for i in range(120)]
    want = [(1 if k % 3 == 0 else k % 5, 40 + rnd.randrange(300)) for k in range(3000)]
    got = match_screen.screen_within(
        spark.createDataFrame(want, "theater_id bigint, capacity int"),
        spark.createDataFrame(sc, "id bigint, theater_id bigint, name string, seat_count int"),
    )
    expected = set()
    for th, cap in set(want):
        close = sorted((abs(s[3] - cap), -s[3], s[2], s[0]) for s in sc if s[1] == th and abs(s[3] - cap) <= 10)
        if close:
            expected.add((th, cap, close[0][3]))
    assert {(r.theater_id, r.capacity, r.screen_id) for r in got.collect()} == expected


def test_schedule_repeated_words_count_every_time(spark):
    items = spark.createDataFrame(
        [(1, "2024-01-05", "19:00", 1, "mer mer verte", "u1"), (1, "2024-01-05", "19:00", 2, "ciel bleu mer", "u2")],
        "theater_id bigint, date string, time string, pos int, title string, url string",
    )
    wanted = spark.createDataFrame([(1, "2024-01-05", "19:00", "la mer du sud")], "theater_id bigint, date string, time string, title string")
    pick = match_schedule.pick_entries(wanted, items).first()
    assert (pick.url, pick.strategy) == ("u1", "shared-words(2)")


SHOW = "theater_id bigint, date string, time string, title string"
ENTRY = "theater_id bigint, date string, time string, pos int, title string, url string"
AT = (1, "2024-01-05", "19:00")


def test_one_minute_with_thousands_of_titles(spark):
    """Many titles of one minute are matched through keys, with the results of comparing all."""
    rnd = random.Random(5)
    stems = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(1, 5))) for _ in range(700)]
    title = lambda: " ".join(rnd.choice(stems) for _ in range(rnd.randint(1, 4)))
    offered = list(dict.fromkeys(title() for _ in range(3000)))
    asked = list(dict.fromkeys([*(title() for _ in range(150)), *offered[:20], "", "zz qq ww"]))
    items = spark.createDataFrame([(*AT, i, t, f"u{i}") for i, t in enumerate(offered)], ENTRY)
    wanted = spark.createDataFrame([(*AT, t) for t in asked], SHOW)
    got = {r.title: r for r in match_schedule.pick_entries_both_ways(wanted, items).collect()}
    assert len(got) == len(asked)
    articles = {"le", "la", "les", "the", "l", "un", "une"}
    key = lambda t: t.split()[1:] if t.split() and t.split()[0] in articles and len(t.split()) > 1 else t.split()
    for t in asked:
        w, flat = key(t), "".join(key(t))
        simple, strict = (3, 0, 0), None
        for i, o in enumerate(offered):
            e, ef = key(o), "".join(key(o))
            if ef and (ef in flat or flat in ef):
                simple = min(simple, (1, 0, i))
            elif (n := sum(x in w for x in e)) >= 2:
                simple = min(simple, (2, -n, i))
            same = len(set(e) & set(w)) / max(len(set(e)), len(set(w)))
            found = (1, 0, i) if ef == flat else (2, -same, i) if same >= 0.5 else None
            strict = min(strict or found, found or strict) if found or strict else None
        assert got[t].simple_url == f"u{simple[2]}", t
        assert got[t].strict_url == (f"u{strict[2]}" if strict else None), t


def test_keys_and_direct_comparison_agree(spark, monkeypatch):
    from reelhouse.operators import match_session, title_keys

    rnd = random.Random(9)
    words = ["la", "mer", "Été", "nuit", "x", "film", "3D", "VF", "Dune", "deux", "deux:", "..."]
    title = lambda: " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 4)))
    slot = lambda: (rnd.randint(1, 2), "2024-01-05", rnd.choice(["19:00", "19:04", "21:00"]))
    items = spark.createDataFrame([(*slot(), i, title(), f"u{i}") for i in range(300)] + [(1, "2024-01-05", None, 900, "rare titre", "u900")], ENTRY)
    wanted = spark.createDataFrame([(*slot(), title()) for _ in range(200)] + [(1, "2024-01-05", "12:00", "Rare Titre: suite"), (*AT, None)], SHOW)
    sessions = items.select("theater_id", "date", "time", "pos", F.col("title").alias("movie_name"), F.col("date").alias("session_date"), F.col("url").alias("auditorium"), F.col("pos").alias("seats_remaining"))

    def all_results():
        return [
            rows(match_schedule.pick_entries_both_ways(wanted, items)), rows(match_schedule.pick_near(wanted, items)), rows(match_session.titled_session(wanted, sessions)),
        ]

    direct = all_results()
    bound = title_keys.meeting.__defaults__
    monkeypatch.setattr(title_keys.meeting, "__defaults__", (0,))
    assert bound == (title_keys.FEW,) and all_results() == direct
    assert [r for r in direct[1] if r[3] == "Rare Titre: suite"][0][5] == "u900"


def test_a_show_without_title_has_the_only_entry(spark):
    items = spark.createDataFrame([(*AT, 1, "Dune", "u1")], ENTRY)
    wanted = spark.createDataFrame([(*AT, None)], SHOW)
    assert [(r.url, r.strategy) for r in match_schedule.matched(wanted, match_schedule.pick_entries(wanted, items)).collect()] == [("u1", "single")]


def test_probes(spark):
    outcomes = spark.createDataFrame([(1, 47, True), (1, 60, False), (2, 10, False), (3, 10, False)], "showing_id bigint, quantity int, ok boolean")
    capacities = spark.createDataFrame([(2, 150)], "showing_id bigint, capacity int")
    out = {r.showing_id: (r.seats_remaining, r.fallback) for r in seats.remaining_from_probes(outcomes, capacities).collect()}
    assert out == {1: (48, False), 2: (149, True), 3: (300, True)}


def test_estimates_stay_below_the_floor(t):
    floor = t.spark.range(1).select(published_floor(t.revenues, Weekend.of(202403)).alias("f")).first()["f"]
    estimates = estimate_weekend(t.showings, t.screens, t.revenues, t.weekends, t.movies, 202403, 13.0, 0.9)
    worst = estimates.agg(F.max("revenue_qc"), F.min("revenue_qc")).first()
    assert worst[0] <= floor - 10 and worst[1] >= 0


def test_ranks_are_a_permutation(t):
    places = rank.rank_weekends(t.revenues, t.showings).groupBy("weekend_id").agg(
        F.count("*").alias("n"), F.max("rank").alias("last"), F.count_distinct("rank").alias("distinct")
    )
    assert all(r.n == r["last"] == r["distinct"] for r in places.collect())


def test_weekly_run_feeds_the_next_weekend(t):
    args = (t.showings, t.screens, t.weekends, t.movies)
    first = written(weekly_load.estimate_and_rank(t.revenues, *args, 202403, 13.0, 0.9), "weekly-run")
    ranks = [r["rank"] for r in first.where("weekend_id = 202403").collect()]
    assert sorted(ranks) == list(range(1, len(ranks) + 1))
    second = weekly_load.estimate_and_rank(first, *args, 202404, 13.0, 0.92)
    new = second.where("weekend_id = 202404 and data_source = 'estimate'")
    before = {r.film_id: r.cumulatif_qc_to_date for r in first.where("weekend_id = 202403").collect()}
    for r in new.collect():
        if r.film_id in before:
            assert r.cumulatif_qc_to_date >= before[r.film_id]


def test_local_showing_rows(spark):
    blocks = spark.createDataFrame([(1, 2, dt.date(2025, 7, 1), ["9:05", "abc", "19:30"])], "movie_id bigint, theater_id bigint, date date, times array<string>")
    assert [r.start_at for r in merge.showing_rows(blocks).orderBy("start_at").collect()] == [dt.datetime(2025, 7, 1, 13, 5), dt.datetime(2025, 7, 1, 23, 30)]


def test_first_films_keeps_running_ones_first(spark):
    from reelhouse.plans import program

    now = spark.createDataFrame([("/films/a/", "A", 2), ("/films/b", "B", 1)], "href string, title string, pos int")
    soon = spark.createDataFrame([("/films/a", "A bientôt", 0), ("/films/c", "C", 1)], "href string, title string, pos int")
    merged = program.merge_listings(now, soon)
    assert [(r.href, r.title, r.source) for r in program.first_films(merged, 3).collect()] == [
        ("/films/b", "B", "now"), ("/films/a", "A", "now"), ("/films/c", "C", "upcoming"),
    ]
    assert program.first_films(merged, 1).count() == 1


def test_versions_of_picked_entries(spark):
    from reelhouse.plans import prefill

    key = "theater_id bigint, date string, time string, url string"
    picks = spark.createDataFrame([(1, "2024-01-05", "19:00", "u1"), (1, "2024-01-05", "20:00", "u2")], key)
    items = spark.createDataFrame([(1, "2024-01-05", "19:00", "u1", 1, "Dune VF 3D")], key + ", pos int, title string")
    assert {r.url: r.version for r in prefill.version_of(picks, items).collect()} == {"u1": "3D+VF", "u2": "default"}


def test_provisional_films_share_one_id_per_title(spark):
    from reelhouse.operators import match_film

    wants = spark.createDataFrame(
        [("L’Été", 2024, []), ("L'ete  VF", None, ["x"]), ("Autre", None, []), ("Connu", None, [])], "title string, year_hint int, extra_queries array<string>"
    )
    movies = spark.createDataFrame([(1_000_000_004, "Vieux", None), (7, "Connu", "Le connu"), (9, "connu", None)], "id bigint, title string, fr_title string")
    results = spark.createDataFrame(
        [], "query string, year int, pos int, id bigint, title string, original_title string, release_date string, genre_ids array<int>, popularity double"
    )
    resolved = match_film.resolve_films(wants, results, movies)
    out = {r.title: (r.film_id, r.found_by) for r in resolved.collect()}
    assert out["Connu"] == (7, "known")
    assert out["L’Été"] == out["L'ete  VF"] and out["L’Été"][1] == "provisional"
    assert {out["L’Été"][0], out["Autre"][0]} == {1_000_000_005, 1_000_000_006}
    rows_ = match_film.provisional_movies(resolved).collect()
    assert len(rows_) == 2 and all(r.provisional and r.title == r.fr_title for r in rows_)


def test_documentaries_only_when_nothing_else(spark):
    from reelhouse.operators import match_film

    results = spark.createDataFrame(
        [("Dune", 2024, 0, 1, "Dune", "Dune", "2024-03-01", [99], 500.0), ("Dune", 2024, 1, 2, "Dune autre", "x", "2023-03-01", [18], 1.0),
         ("Rare", 2024, 0, 3, "Rare", "Rare", "2024-01-01", [99], 1.0), ("Tard", 2025, 0, 4, "Tard", "Tard", "2025-01-01", [], 1.0)],
        "query string, year int, pos int, id bigint, title string, original_title string, release_date string, genre_ids array<int>, popularity double",
    )
    wants = spark.createDataFrame([(t, 2024, []) for t in ("Dune", "Rare", "Tard", "Absent")], "title string, year_hint int, extra_queries array<string>")
    assert {r.title: r.film_id for r in match_film.search_films(wants, results).collect()} == {"Dune": 2, "Rare": 3, "Tard": 4}


def test_announced_film_wants(spark):
    from reelhouse.plans import upcoming

    films = spark.createDataFrame([("https://x.example/films/le-film-vf", "Le film", dt.date(2025, 2, 1))], "href string, title string, release_date date")
    row = upcoming.film_wants(films).first()
    assert (row.title, row.year_hint, row.extra_queries) == ("Le film", 2025, ["Le Film"])


def test_an_address_in_use_is_narrowed_to_the_picks_before_any_shuffle(spark):
    """Another show of the theatre blocks an address at the same time of day only; the used addresses meet the picks by a semi join."""
    from reelhouse.operators.match_schedule import unused_urls

    used = spark.sql(
        "select * from values (1, 'a', timestamp_ntz'2024-01-10 00:10:00'), (1, 'b', timestamp_ntz'2024-01-10 00:10:30'), (2, 'c', timestamp_ntz'2024-01-10 00:10:00'), "
        "(1, 'd', timestamp_ntz'2024-01-10 01:10:00'), (1, null, timestamp_ntz'2024-01-10 00:10:00'), (1, 'a', timestamp_ntz'2024-02-10 00:10:00') t(theater_id, purchase_url, start_at)"
    )
    picks = spark.createDataFrame([(1, u, "19:10", i) for i, u in enumerate("abcddx")], "theater_id int, url string, time string, showing_id int")
    free = unused_urls(picks, used, ["showing_id"])
    assert sorted((r.url, r.showing_id) for r in free.collect()) == [("b", 1), ("c", 2), ("d", 3), ("x", 5)]
    plan = free._jdf.queryExecution().optimizedPlan().toString()
    anti = plan[plan.index("LeftAnti") :]
    assert "LeftSemi" in anti  # every use of an address passes it before the comparison
    assert unused_urls(picks, used.where("false"), ["showing_id"]).count() == 5
    assert unused_urls(picks.where("false"), used, ["showing_id"]).count() == 0
