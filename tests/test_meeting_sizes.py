"""Wanted titles and entries meet without being sent to the driver, whatever size their files seem to have."""

import datetime as dt

from reelhouse.operators import match_schedule

SLOT = (1, dt.date(2024, 1, 5), "18:00")


def test_titles_of_minutes_are_not_broadcast(spark):
    wanted = spark.createDataFrame([(*SLOT, f"film {i}") for i in range(5)], "theater_id long, date date, time string, title string")
    items = spark.createDataFrame([(*SLOT, i, f"film {i} VF", f"u{i}") for i in range(70)], "theater_id long, date date, time string, pos int, title string, url string")
    titles, pairs = match_schedule._wanted_titles(wanted, items)
    assert titles.where("titles > 64").count() == 5
    assert "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()
    assert {r["title"] for r in pairs.collect() if r["title"].split()[1] == r["entry_title"].split()[1]} == {f"film {i}" for i in range(5)}
