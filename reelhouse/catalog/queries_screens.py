"""Screen matching and applied measurements."""

from pyspark.sql import functions as F

from reelhouse.catalog.queries_merge import AS_OF, as_of
from reelhouse.catalog.queries_tables import shown
from reelhouse.catalog.registry import query
from reelhouse.operators import match_screen
from reelhouse.plans import measurements as ms
from reelhouse.sources.sample import SampleTables


@query("j12_nearest_screen", """
SELECT theater_id, capacity, screen_id, seat_count FROM (
  SELECT m.theater_id, m.capacity, sc.id AS screen_id, sc.seat_count, row_number() OVER (PARTITION BY m.theater_id, m.capacity ORDER BY
    CASE WHEN sc.seat_count = m.capacity THEN 0 WHEN sc.seat_count > m.capacity THEN 1 ELSE 2 END, abs(sc.seat_count - m.capacity), sc.name) AS rn
  FROM (SELECT DISTINCT theater_id, capacity FROM measurements) m JOIN screens sc ON sc.theater_id = m.theater_id) WHERE rn = 1""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    return match_screen.nearest_screen(t.measurements, t.screens)


@query("j13_screen_within_tolerance", """
SELECT showing_id, screen_id, seat_count FROM (
  SELECT m.showing_id, sc.id AS screen_id, sc.seat_count, row_number() OVER (PARTITION BY m.showing_id ORDER BY
    abs(sc.seat_count - m.capacity), sc.seat_count DESC, sc.name) AS rn
  FROM measurements m JOIN screens sc ON sc.theater_id = m.theater_id AND sc.seat_count BETWEEN m.capacity - 10 AND m.capacity + 10) WHERE rn = 1""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    m = t.measurements
    return m.join(match_screen.screen_within(m, t.screens), ["theater_id", "capacity"]).select(
        "showing_id", "screen_id", "seat_count"
    )


def _aud(c: str) -> str:
    x = f"lower(strip_accents({c}))"
    x = rf"regexp_replace({x}, '\b(salle|aud|auditorium|screen|vip)\b', '', 'g')"
    x = rf"regexp_replace({x}, '#|\s+', '', 'g')"
    return rf"regexp_replace({x}, '(^|[^0-9])0+([0-9])', '\1\2', 'g')"


def _digits(c: str) -> str:
    return f"regexp_replace({c}, '[^0-9]', '', 'g')"


_AUDITORIUM_STEPS = f"""WITH said AS (SELECT DISTINCT theater_id, auditorium FROM measurements WHERE trim(auditorium) <> ''),
scored AS (
  SELECT a.theater_id, a.auditorium, sc.id AS screen_id, sc.seat_count, sc.name,
    CASE WHEN sc.name = a.auditorium THEN 0
      WHEN {_aud('sc.name')} = {_aud('a.auditorium')} THEN 1
      WHEN {_digits('sc.name')} <> '' AND {_digits('sc.name')} = {_digits('a.auditorium')} THEN 2
      WHEN {_aud('sc.name')} <> '' AND {_aud('a.auditorium')} <> '' AND (contains({_aud('sc.name')}, {_aud('a.auditorium')}) OR contains({_aud('a.auditorium')}, {_aud('sc.name')})) THEN 3
      WHEN contains(lower(sc.name), lower(a.auditorium)) THEN 4 END AS tier
  FROM said a JOIN screens sc USING (theater_id)),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY theater_id, auditorium ORDER BY tier, length(name), screen_id) AS rn FROM scored WHERE tier IS NOT NULL) WHERE rn = 1)
"""


@query("j14_screen_by_auditorium", _AUDITORIUM_STEPS + """
SELECT m.showing_id, b.screen_id, b.seat_count, b.tier FROM measurements m JOIN best b USING (theater_id, auditorium)""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    m = t.measurements
    return m.join(match_screen.screen_by_auditorium(m, t.screens), ["theater_id", "auditorium"]).select(
        "showing_id", "screen_id", "seat_count", "tier"
    )


APPLIED_STEPS = _AUDITORIUM_STEPS + f""",
sized AS (SELECT showing_id, screen_id, seat_count FROM (
  SELECT m.showing_id, sc.id AS screen_id, sc.seat_count, row_number() OVER (PARTITION BY m.showing_id ORDER BY abs(sc.seat_count - m.capacity), sc.seat_count DESC, sc.name) AS rn
  FROM measurements m JOIN screens sc ON sc.theater_id = m.theater_id AND abs(sc.seat_count - m.capacity) <= 10) WHERE rn = 1),
facts AS (
  SELECT s.*, m.seats_remaining, m.source, m.auditorium, z.screen_id AS z_screen, z.seat_count AS z_seats, b.screen_id AS b_screen, b.seat_count AS b_seats, k.seat_count AS k_seats,
    CASE WHEN m.seats_remaining IS NULL THEN 'skipped'
      WHEN m.source = 'cineentreprise' THEN CASE WHEN z.screen_id IS NULL THEN 'skipped' ELSE 'capacity' END
      WHEN coalesce(trim(m.auditorium), '') = '' THEN CASE WHEN k.seat_count IS NULL THEN 'stamped' ELSE 'known_screen' END
      WHEN b.screen_id IS NULL THEN 'stamped' ELSE 'auditorium' END AS path
  FROM showings s JOIN measurements m ON m.showing_id = s.id LEFT JOIN sized z ON z.showing_id = s.id
    LEFT JOIN best b ON b.theater_id = m.theater_id AND b.auditorium = m.auditorium LEFT JOIN screens k ON k.id = s.screen_id),
worked AS (
  SELECT *, CASE path WHEN 'capacity' THEN greatest(0, least(z_seats, z_seats - seats_remaining)) WHEN 'auditorium' THEN greatest(0, b_seats - seats_remaining)
      WHEN 'known_screen' THEN greatest(0, k_seats - seats_remaining) END AS new_sold FROM facts),
applied AS (
  SELECT id, path, CAST(coalesce(new_sold, seats_sold) AS INTEGER) AS seats_sold,
    coalesce(screen_id, CASE path WHEN 'capacity' THEN z_screen WHEN 'auditorium' THEN b_screen END) AS screen_id,
    CASE WHEN path = 'stamped' OR (path IN ('auditorium', 'known_screen') AND seats_sold IS DISTINCT FROM new_sold) THEN '{AS_OF}' END AS scraped_at
  FROM worked)
"""


def applied(spark, folder):
    t = SampleTables(spark, folder)
    target = t.showings.select("id", "screen_id", "seats_sold", F.lit(None).cast("timestamp_ntz").alias("scraped_at"))
    return ms.apply_measurements(target, t.screens, t.measurements, as_of())


@query("q06_apply_measurements", APPLIED_STEPS + "SELECT id, path, seats_sold, screen_id, scraped_at FROM applied")
def _(spark, folder):
    return shown(applied(spark, folder))


@query("a16_outcome_counts", APPLIED_STEPS + "SELECT path, count(*) AS n, count(seats_sold) AS n_seats FROM applied GROUP BY path")
def _(spark, folder):
    return applied(spark, folder).groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.count("seats_sold").alias("n_seats"))


@query("t04_latest_measurement", """
WITH repeated AS (SELECT showing_id, seats_remaining, measured_at FROM measurements
  UNION ALL SELECT showing_id, seats_remaining - 1, measured_at + to_minutes(CAST(showing_id % 3 - 1 AS BIGINT)) FROM measurements)
SELECT showing_id, seats_remaining, strftime(measured_at, '%Y-%m-%d %H:%M:%S') AS measured_at FROM (
  SELECT *, row_number() OVER (PARTITION BY showing_id ORDER BY measured_at DESC, seats_remaining DESC NULLS LAST) AS rn FROM repeated) WHERE rn = 1""")
def _(spark, folder):
    m = SampleTables(spark, folder).measurements.select("showing_id", "seats_remaining", "measured_at")
    shifted = F.col("measured_at") + F.make_dt_interval(mins=(F.col("showing_id") % 3 - 1).cast("int"))
    again = m.select("showing_id", (F.col("seats_remaining") - 1).alias("seats_remaining"), shifted.alias("measured_at"))
    return shown(ms.latest_measurements(m.unionByName(again)))
