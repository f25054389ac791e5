"""Readers, sinks, payload shapes, stream against batch."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from reelhouse.plans import measurements as ms
from reelhouse.schemas import schema_of
from reelhouse.sources import pages, payloads, sinks, tables
from reelhouse.sources.sample import SampleTables
from reelhouse.streaming import measurements as stream


def test_table_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(202401, dt.date(2024, 1, 5), dt.date(2024, 1, 7))], schema_of("weekends"))
    tables.write_table(rows, str(tmp_path), "weekends")
    back = tables.read_table(spark, str(tmp_path), "weekends")
    assert back.schema == schema_of("weekends") and back.collect() == rows.collect()


def test_partitioned_write_prunes(spark, tmp_path):
    rows = spark.createDataFrame([(1, w, 5) for w in (202401, 202402)], "film_id bigint, weekend_id int, revenue_qc bigint")
    tables.write_table(rows, str(tmp_path), "revenues", ["weekend_id"])
    one = spark.read.parquet(f"{tmp_path}/revenues").where("weekend_id = 202402")
    assert one.count() == 1 and len(one.inputFiles()) >= 1


def test_census_csv_quoting(spark, tmp_path):
    from reelhouse.plans.reports import CENSUS_COLUMNS

    row = ("Ciné, Un", "2024-01-05", 'Le "film"', "19:00", None, 12, "fail", "a\nb")
    df = spark.createDataFrame([row], ", ".join(f"{c} {'int' if c == 'seats_remaining' else 'string'}" for c in CENSUS_COLUMNS))
    sinks.write_census(df, str(tmp_path / "census"))
    texts = [p.read_text() for p in (tmp_path / "census").glob("part-*.csv")]
    assert texts and all(x.splitlines()[0] == ",".join(CENSUS_COLUMNS) for x in texts if x)
    assert any('"Ciné, Un",2024-01-05,"Le ""film""",19:00,,12,fail,"a\nb"' in x for x in texts)


def test_window_probe_is_written_with_all_its_columns(spark, tmp_path):
    from reelhouse.plans.reports import PROBE_COLUMNS

    df = spark.createDataFrame([tuple(f"v{i}" for i in range(len(PROBE_COLUMNS)))], ", ".join(f"{c} string" for c in PROBE_COLUMNS))
    sinks.write_window_probe(df, str(tmp_path / "probe"))
    lines = [x for p in (tmp_path / "probe").glob("part-*.csv") for x in p.read_text().splitlines()]
    assert set(lines) == {",".join(PROBE_COLUMNS), ",".join(f"v{i}" for i in range(len(PROBE_COLUMNS)))}


def test_nested_schedule_json(spark, tmp_path):
    shows = spark.createDataFrame([("Dune", "2024-01-05", "19:00", "Salle 1")] * 2 + [("Dune", "2024-01-06", "20:00", None), ("Dune", "2024-02-01", "21:00", "B")], "movie string, date string, time string, salle string")
    sinks.write_nested_schedule(shows, str(tmp_path / "nested"))
    docs = [json.loads(line) for f in (tmp_path / "nested").glob("part-*.json") for line in f.read_text().splitlines()]
    assert sorted(docs, key=lambda d: d["month"]) == [
        {"movie": "Dune", "month": "2024-01", "schedule": {"2024-01-05": [{"time": "19:00", "salle": "Salle 1"}], "2024-01-06": [{"time": "20:00"}]}},
        {"movie": "Dune", "month": "2024-02", "schedule": {"2024-02-01": [{"time": "21:00", "salle": "B"}]}},
    ]


def test_sessions_take_the_first_date_only(spark):
    movie = lambda n: {"name": n, "experiences": [{"experienceTypes": ["Regular"], "sessions": [{"vistaSessionId": n, "showStartDateTime": "2024-01-05T19:00:00"}]}]}
    one = {"dates": [{"movies": [movie("a")]}, {"movies": [movie("b")]}]}
    raw = spark.createDataFrame([(json.dumps(one),), (json.dumps([one, {"dates": []}]),), ("not json",)], "payload string")
    out = payloads.flatten_sessions(raw).collect()
    assert [(r.session_id, str(r.date), r.time) for r in out] == [("a", "2024-01-05", "19:00")] * 2


def test_hidden_keys_go_to_keyless_buttons_in_order(spark):
    html = (
        '<span id="zrl_1_A37">Dune -</span><a id="c-1-A5" role="button">19 h 10</a>'
        '<a id="c-1-A6" role="button" href="/x?P3=55555">20:15</a><a id="c-1-A7" role="button">7:10 PM</a>'
        '<span id="tzzrl_1_A8">11111</span><span id="tzzrl_1_A9">22222</span>'
    )
    df = spark.createDataFrame([("u", html)], "url string, html string")
    rows = pages.ticket_rows(df.withColumnRenamed("url", "page"), pages.TicketSpec("https://t.example/a?P1=01")).orderBy("pos").collect()
    assert [(r.title, r.time, r.key) for r in rows] == [("Dune", "19:10", "11111"), ("Dune", "20:15", "55555"), ("Dune", "19:10", "22222")]
    assert rows[0].url == "https://t.example/a?P1=01&P3=11111"


def test_hidden_keys_follow_cell_numbers_of_any_site_profile(spark):
    html = (
        "<span id='tzzrl_1_A12'>Autre titre</span><span id=zrl_1_A37>Dune</span><span id='zrl_1_A11'>22222</span><span class=x id=tzzrl_1_A8>11111</span>"
        "<a role='button' id='zrl_1_A5'>19 h 10</a><a role=button id=zrl_1_A6>20:15</a>"
    )
    df = spark.createDataFrame([("u", html)], "page string, html string")
    read = lambda **profile: [(r.title, r.time, r.key) for r in pages.ticket_rows(df, pages.TicketSpec("https://t.example/a?P1=01", **profile)).orderBy("pos").collect()]
    assert read() == [("Dune", "19:10", "11111"), ("Dune", "20:15", "22222")]
    assert read(title_cells=("tzzrl_{row}_A12",)) == [("Autre titre", "19:10", "11111"), ("Autre titre", "20:15", "22222")]


def test_a_page_of_thousands_of_rows(spark):
    html = "".join(f'<span id="zrl_{i}_A37">Film {i}</span><a id="c-{i}-A5" role="button" href="/x?P3={100000 + i}">19:10</a>' for i in range(5000))
    df = spark.createDataFrame([("u", html)], "page string, html string")
    rows = pages.ticket_rows(df, pages.TicketSpec("https://t.example/a?P1=01")).collect()
    assert {(r.title, r.key) for r in rows} == {(f"Film {i}", str(100000 + i)) for i in range(5000)} and len(rows) == 5000


def test_showtimes_in_other_markup(spark):
    html = (
        "<div class='days-slider-slide-trigger-content'><span class=days-slider-weekday>lundi</span><span class='a days-slider-date'>8</span>"
        "<span class='days-slider-month b'>janvier</span></div><section data-x=1 class='cinema-schedule-movies'><div class=theater-item>"
        "<h3 class='item-title'><a href='/c'>Cinéma Un</a></h3><div class='item-subtitle'>Groupe A • 4 salles</div>"
        "<span class=movie-time>13h05</span><span class='session-time late'>19h10</span></div></section>"
    )
    row = pages.showtime_blocks(spark.createDataFrame([("u", html)], "page string, html string")).first()
    assert (row.day_label, row.theater, row.company, row.screens, row.times) == ("lundi 8 janvier", "Cinéma Un", "Groupe A", 4, ["13h05", "19h10"])


def test_stream_equals_batch(spark, folder, tmp_path):
    t = SampleTables(spark, folder)
    target = t.showings.select("id", "theater_id", "screen_id", "start_at", "seats_sold", F.lit(None).cast("timestamp_ntz").alias("scraped_at"))
    landed = str(tmp_path / "landed")
    t.measurements.repartition(3, "showing_id").write.parquet(landed)
    # the same files delivered twice: replays must change nothing
    t.measurements.repartition(2, "showing_id").write.mode("append").parquet(landed)
    sink = stream.ShowingUpdates(spark, str(tmp_path / "state"), target, t.screens, t.theaters, buckets=2)
    sink.start(stream.measurement_stream(spark, landed, 3)).awaitTermination()
    good = stream.accepted(stream.with_window(t.measurements, target, t.theaters)).select(*t.measurements.columns)
    batch = ms.apply_measurements(target, t.screens, good).drop("path")
    assert sorted(map(tuple, sink.current().collect()), key=repr) == sorted(map(tuple, batch.collect()), key=repr)


def test_batch_rerun_leaves_the_same_updates(spark, folder, tmp_path):
    t = SampleTables(spark, folder)
    target = t.showings.select("id", "theater_id", "screen_id", "start_at", "seats_sold", F.lit(None).cast("timestamp_ntz").alias("scraped_at"))
    sink = stream.ShowingUpdates(spark, str(tmp_path), target, t.screens, t.theaters, buckets=2)
    sink.apply_batch(t.measurements, 0)
    once = sorted(map(tuple, sink.updates().collect()), key=repr)
    sink.apply_batch(t.measurements, 0)
    assert sorted(map(tuple, sink.updates().collect()), key=repr) == once


def test_the_measurement_taken_last_wins_in_any_order_of_batches(spark, folder, tmp_path):
    t = SampleTables(spark, folder)
    target = t.showings.select("id", "theater_id", "screen_id", "start_at", "seats_sold", F.lit(None).cast("timestamp_ntz").alias("scraped_at"))
    good = stream.accepted(stream.with_window(t.measurements, target, t.theaters)).select(*t.measurements.columns)
    applied = ms.apply_measurements(target, t.screens, good).where("path = 'auditorium'").select("id")
    last = good.join(applied, good["showing_id"] == applied["id"], "left_semi").limit(1)
    earlier = last.withColumn("measured_at", F.expr("measured_at - interval 1 second")).withColumn("seats_remaining", F.col("seats_remaining") + 7)
    show = last.first()["showing_id"]
    sinks = []
    for name, order in (("rising", [earlier, last]), ("falling", [last, earlier])):
        sink = stream.ShowingUpdates(spark, str(tmp_path / name), target, t.screens, t.theaters, buckets=2)
        for batch_id, batch in enumerate(order):
            sink.apply_batch(batch, batch_id)
        sinks.append(sink)
    states = [s.current().where(F.col("id") == show).select("seats_sold", "screen_id").collect() for s in sinks]
    assert states[0] == states[1]
    assert sinks[1].superseded().count() == 1 and sinks[1].updates().count() == 1 and sinks[0].updates().count() == 2


@pytest.mark.parametrize("reason", ["incomplete", "unknown_show"])
def test_bad_rows_go_to_the_side_output(spark, folder, reason):
    t = SampleTables(spark, folder)
    m = t.measurements.limit(1)
    bad = m.withColumn("measured_at", F.lit(None).cast("timestamp_ntz")) if reason == "incomplete" else m.withColumn("showing_id", F.lit(-1).cast("bigint"))
    out = stream.rejected(stream.with_window(bad, t.showings, t.theaters))
    assert [r.error for r in out.collect()] == [reason]
