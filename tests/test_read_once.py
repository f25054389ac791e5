"""Pieces of pages are read once each, whatever is asked of them later; forms of titles are worked out before they are read again."""

import datetime as dt

from pyspark.sql import functions as F

from reelhouse import fixed_values as fv
from reelhouse.operators import match_schedule, match_session
from reelhouse.plans import program
from reelhouse.sources import pages


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_links_of_halls_are_read_once(spark):
    link = '<a href="{}"><span class="hour">{}</span> <span class="salle">{}</span></a>'
    card = '<div class="list-item"><h2>{}</h2><div class="schedule-day-grid" data-date="{}">{}</div></div>'
    shows = link.format("x", "9:30", "salle #4") + link.format("y", "9:30", "SALLE 4") + link.format("z", "late", "Grand Studio") + "<a>10:00</a>"
    html = card.format("Un film", "2024-01-05", shows) + card.format("", "2024-01-05", shows) + card.format("Sans jour", "", shows)
    found = pages.hall_schedule(spark.createDataFrame([(1, html), (2, None)], "page int, html string"))
    assert [tuple(r) for r in found.collect()] == [(1, "Un film", "2024-01-05", "09:30", "Salle 4")]
    plan = optimized(found)
    for name in (fv.HALL_TIME, fv.HALL_NAME):
        assert plan.count(pages.with_class(name)) == 1


def test_blocks_of_the_program_are_read_once(spark):
    rows = [
        ("a", "mardi 2 janvier", " Cinéma  ", ["9h30", "09:30", "24h05", "tard"]), ("b", "samedi 30 décembre", "C", ["18h45"]),
        ("c", "mardi 2 brumaire", "C", ["18h45"]), ("d", "mardi 2 janvier", " ", ["18h45"]), ("e", "mardi 2 janvier", "C", ["tard"]), ("f", None, None, None),
    ]
    blocks = spark.createDataFrame(rows, "href string, day_label string, theater string, times array<string>")
    found = program.normalised_blocks(blocks, F.lit("2023-12-31").cast("date"))
    assert found.columns == ["href", "day_label", "theater", "times", "date"]
    assert sorted(tuple(r) for r in found.collect()) == [
        ("a", "mardi 2 janvier", "Cinéma", ["09:30", "00:05"], dt.date(2024, 1, 2)), ("b", "samedi 30 décembre", "C", ["18:45"], dt.date(2023, 12, 30)),
    ]
    plan = optimized(found)
    assert plan.count("[^0-9hH:]") == 1 and plan.count("(?:er)?") == 1


SLOT = (1, dt.date(2024, 1, 5), "18:00")


def test_titles_of_entries_are_read_before_they_meet(spark):
    wanted = spark.createDataFrame([(*SLOT, "Le Film"), (*SLOT, None)], "theater_id long, date date, time string, title string")
    items = spark.createDataFrame([(*SLOT, 1, "Autre", "u1"), (*SLOT, 2, "Film VF", "u2")], "theater_id long, date date, time string, pos int, title string, url string")
    for pick in (match_schedule.pick_entries, match_schedule.pick_entries_both_ways, match_schedule.pick_near):
        found = pick(wanted, items)
        assert "regexp" not in optimized(found), pick
        assert found.count() == 2
    # a title with a show too far off is looked for over the day
    late = wanted.withColumn("time", F.lit("23:00"))
    assert [(r["pos"], r["found_by"]) for r in match_schedule.pick_near(late.where("title is not null"), items.withColumn("title", F.lit("Le film noir"))).collect()] == [(1, "title")]


def test_sessions_are_read_before_they_meet(spark):
    wanted = spark.createDataFrame([(*SLOT, "Film", 90)], "theater_id long, date date, time string, title string, runtime int")
    sessions = spark.createDataFrame(
        [(*SLOT, 1, "Film noir", 91, "Salle 1", "x", 10), (*SLOT, 2, "Autre", 90, "Salle 2", "x", 20)],
        "theater_id long, date date, time string, pos long, movie_name string, runtime_minutes int, auditorium string, area_code string, seats_remaining int",
    )
    found = match_session.narrowed_session(wanted, sessions)
    assert "regexp" not in optimized(found)
    assert [(r["session_pos"], r["seats_remaining"]) for r in found.collect()] == [(1, 10)]


def test_scored_sessions_are_read_once(spark):
    """However many slots are crowded, sessions are gone over once, and wanted shows twice: for their titles and for the rows."""
    read = {n: spark.sparkContext.accumulator(0) for n in ("wanted", "sessions")}

    def counted(df, name):
        def seen(t):
            read[name].add(1)
            return t

        return df.withColumn("time", F.udf(seen, "string")("time"))

    wanted = spark.createDataFrame([(*SLOT, t, 90, "FR") for t in ("Film", "Autre", None)], "theater_id long, date date, time string, title string, runtime int, language string")
    sessions = spark.createDataFrame(
        [(*SLOT, i, n, 90, "FR", f"Salle {i}") for i, n in enumerate(["Film", "Film noir", "Autre", None])],
        "theater_id long, date date, time string, pos long, movie_name string, runtime_minutes int, language_code string, auditorium string",
    )
    found = match_session.scored_session(counted(wanted, "wanted"), counted(sessions, "sessions"), few=2)
    assert {r["title"]: (r["status"], r["session_pos"], r["candidates"]) for r in found.collect()} == {
        "Film": ("OK", 0, None), "Autre": ("OK", 2, None), None: ("AMBIGUOUS_AT_TIME", None, [0, 1, 2]),
    }
    assert read["sessions"].value == 4 and read["wanted"].value <= 6
