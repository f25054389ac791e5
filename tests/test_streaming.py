"""The stream's state on files: routing without loss, bounded work per batch, compaction, late shows."""

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from reelhouse.catalog.queries_streaming import stream_target
from reelhouse.plans import measurements as ms
from reelhouse.schemas import schema_of
from reelhouse.session import written
from reelhouse.sources.sample import SampleTables
from reelhouse.streaming import completeness
from reelhouse.streaming import measurements as stream
from reelhouse.streaming.showing_state import ShowingState

SHOWS = "id bigint, theater_id bigint, screen_id bigint, start_at timestamp_ntz, seats_sold int, scraped_at timestamp_ntz"
AT = dt.datetime(2024, 1, 1, 20)


@pytest.fixture(scope="module")
def t(spark, folder):
    """The tables written once, so that plans stay short."""
    sample = SampleTables(spark, folder)
    return SimpleNamespace(**{n: written(getattr(sample, n), f"sample-{n}") for n in ("measurements", "showings", "screens", "theaters")})


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_every_measurement_has_one_outcome(spark, t, tmp_path):
    """Two measurements of a show in one batch, replays, rows without seats, a grid that fits no screen."""
    m = t.measurements
    earlier = m.withColumn("measured_at", F.expr("measured_at - interval 1 second")).withColumn("seats_remaining", F.col("seats_remaining") + 1)
    no_seats = m.limit(40).withColumn("seats_remaining", F.lit(None).cast("int"))
    no_screen = m.limit(40).withColumns({"source": F.lit("cineentreprise"), "capacity": F.lit(99_999)})
    broken = m.limit(3).withColumn("showing_id", F.lit(None).cast("bigint")).unionByName(m.limit(3).withColumn("showing_id", F.lit(-5).cast("bigint")))
    sink = stream.ShowingUpdates(spark, str(tmp_path), stream_target(t), t.screens, t.theaters, buckets=4)
    sent = 0
    for n, batch in enumerate([m.unionByName(earlier), m, no_seats.unionByName(no_screen).unionByName(broken), earlier]):
        sink.apply_batch(batch, n)
        sent += batch.count()
        assert sink.outcomes().count() == sent
    found = {(r.outcome, r.error): r.n for r in sink.outcomes().groupBy("outcome", "error").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert found[("rejected", "incomplete")] == found[("rejected", "unknown_show")] == 3
    assert ("rejected", "no_seats") in found and ("rejected", "no_screen") in found and ("superseded", None) in found
    last = sink.outcomes().where("batch_id = 3 and outcome = 'updated'").count()
    assert last == 0  # all of them are older than what the state has


def test_skipped_measurement_does_not_hide_an_earlier_one(spark, t, tmp_path):
    """The usable measurement taken last wins, whether an unusable later one comes in its batch or in the next."""
    good = stream.accepted(stream.with_window(t.measurements, t.showings, t.theaters)).select(*t.measurements.columns)
    path = ms.apply_measurements(stream_target(t), t.screens, good).where("path = 'auditorium'").select("id")
    one = good.join(path, good["showing_id"] == path["id"], "left_semi").limit(1)
    later = one.withColumn("measured_at", F.expr("measured_at + interval 1 second")).withColumn("seats_remaining", F.lit(None).cast("int"))
    states = []
    for name, batches in (("together", [one.unionByName(later)]), ("apart", [one, later]), ("turned", [later, one])):
        sink = stream.ShowingUpdates(spark, str(tmp_path / name), stream_target(t), t.screens, t.theaters, buckets=2)
        for n, batch in enumerate(batches):
            sink.apply_batch(batch, n)
        states.append(rows(sink.current().where(F.col("id") == one.first()["showing_id"])))
    assert states[0] == states[1] == states[2]


def test_work_per_batch_is_constant_over_50_batches(spark, tmp_path, monkeypatch):
    """Five shows a day over 50 days, updated day by day: rows read per batch don't grow with the history."""
    shows = spark.createDataFrame([(day * 10 + k, 1, None, AT + dt.timedelta(days=day, minutes=k), None, None) for day in range(50) for k in range(5)], SHOWS)
    state = ShowingState(spark, str(tmp_path), shows, buckets=2)
    read, take, updates = [], ShowingState._read, ShowingState.updates

    def counted_read(self, parts):
        out = take(self, parts)
        read[-1] += out.count()
        return out

    def counted_updates(self, after=-1, before=None):
        out = updates(self, after, before)
        read[-1] += out.count() if before is not None else 0
        return out

    monkeypatch.setattr(ShowingState, "_read", counted_read)
    monkeypatch.setattr(ShowingState, "updates", counted_updates)
    compacted = []
    for day in range(50):
        read.append(0)
        at = AT + dt.timedelta(days=day, minutes=14)
        if day - 1 - state.newest(day)[1] >= 10:
            state.compact(day)
            compacted.append(day)
        asked = spark.createDataFrame([(day * 10 + k, at) for k in range(2)], "showing_id bigint, measured_at timestamp_ntz")
        assert {r.id: r.seats_sold for r in state.slice(asked, day).collect()} == {day * 10: None, day * 10 + 1: None}
        rows_ = [(day * 10 + k, 7 + k, None, at, "stamped", at, str(day)) for k in range(2)]
        out = spark.createDataFrame(rows_, "id bigint, seats_sold int, screen_id bigint, scraped_at timestamp_ntz, path string, measured_at timestamp_ntz, day string")
        out = out.withColumns({"bucket": state.bucket(F.col("id")), "day": F.lit((AT + dt.timedelta(days=day)).strftime("%Y-%m-%d"))})
        out.coalesce(1).write.parquet(f"{tmp_path}/updates/batch_id={day}")
    assert compacted == [10, 20, 30, 40]
    plain = [r for n, r in enumerate(read) if n not in compacted]
    assert max(plain) <= 3 * 5 + 10 * 2  # three days of shows, ten batches of updates
    assert max(read) <= 3 * 5 + 10 * 2 + 10 * (5 + 2)  # and one compaction
    monkeypatch.undo()
    assert state.current().where("seats_sold >= 7").count() == 100 and state.current().count() == 250
    state.remove_stale(keep=1)
    assert state.current().where("seats_sold >= 7").count() == 100


def test_shows_far_from_their_measurement_and_new_shows(spark, t, tmp_path):
    theatre = t.theaters.where("name like 'Cineplex%'").first()["id"]
    shows = spark.createDataFrame([(n, theatre, None, AT + dt.timedelta(days=n), None, None) for n in range(4)] + [(9, theatre, None, None, None, None)], SHOWS)
    state = ShowingState(spark, str(tmp_path), shows, buckets=2)
    asked = spark.createDataFrame([(0, AT + dt.timedelta(days=90)), (1, AT + dt.timedelta(days=1)), (9, AT), (77, AT)], "showing_id bigint, measured_at timestamp_ntz")
    assert sorted(r.id for r in state.slice(asked, 0).collect()) == [0, 1, 9]
    state.add(spark.createDataFrame([(77, theatre, None, AT, 5, None), (1, theatre, None, AT + dt.timedelta(days=1), 99, None)], SHOWS))
    assert {r.id: r.seats_sold for r in state.slice(asked, 0).collect()} == {0: None, 1: None, 9: None, 77: 5}
    assert sorted(r.id for r in state.current().collect()) == [0, 1, 2, 3, 9, 77]
    again = ShowingState(spark, str(tmp_path), shows, buckets=2)  # an existing folder is taken up, not laid out anew
    assert again.newest() == state.newest() and again.current().count() == 6


def test_rows_wait_until_enough_have_come(spark, t, tmp_path):
    sink = stream.ShowingUpdates(spark, str(tmp_path / "a"), stream_target(t), t.screens, t.theaters, buckets=2, flush_rows=100, flush_after="1000 days")
    few = t.measurements.where(~F.coalesce(F.hour(F.expr("measured_at - interval 5 hours")).between(1, 9), F.lit(False))).limit(130).collect()
    kind = t.measurements.schema
    for n in range(3):
        sink.apply_batch(spark.createDataFrame(few[n * 40 : n * 40 + 40], kind), n)
        assert sink.updates().count() == 0 or n == 2
    assert sink.outcomes().count() == 120
    sink.apply_batch(spark.createDataFrame(few[120:], kind), 3)
    assert sink.outcomes().count() == 120
    sink.flush()
    sink.flush()
    assert sink.outcomes().count() == 130
    whole = stream.ShowingUpdates(spark, str(tmp_path / "b"), stream_target(t), t.screens, t.theaters, buckets=2)
    whole.apply_batch(spark.createDataFrame(few, kind), 0)
    assert rows(whole.current()) == rows(sink.current())
    timed = stream.ShowingUpdates(spark, str(tmp_path / "c"), stream_target(t), t.screens, t.theaters, buckets=2, flush_rows=100, flush_after="1 hour")
    timed.apply_batch(spark.createDataFrame(few[:1], kind), 0)
    timed.apply_batch(spark.createDataFrame([few[0], few[0].__class__(**{**few[0].asDict(), "measured_at": few[0].measured_at + dt.timedelta(hours=2)})], kind), 1)
    assert timed.outcomes().count() == 3


def test_completeness_counts_shows_in_any_order(spark, tmp_path):
    """Shows 100 days apart, newest first, and a batch delivered again."""
    shows = spark.createDataFrame([(n, AT + dt.timedelta(days=100 * (n % 4), minutes=17 * n), n if n % 3 else None) for n in range(60)], "id bigint, start_at timestamp_ntz, seats_sold int")
    want = {}
    for r in shows.collect():
        for back in range(5):
            hour = r.start_at.replace(minute=0, second=0) - dt.timedelta(hours=back)
            total, missing = want.get(hour, (0, 0))
            want[hour] = (total + 1, missing + (r.seats_sold is None))
    sums = completeness.CompletenessSums(spark, str(tmp_path), compact_every=2)
    batches = [shows.where(F.col("id") % 4 == k) for k in (3, 0, 2, 1)]
    for n, batch in enumerate(batches):
        sums.apply_batch(batch, n)
        sums.apply_batch(batch, n)
    assert {r.window_start: (r.total_shows, r.missing_shows) for r in sums.totals().collect()} == want
    assert sums._added() == 2
