"""Table scans."""

from pyspark.sql import functions as F

from reelhouse.catalog.registry import query
from reelhouse.sources.sample import SampleTables


def shown(df):
    """Dates, instants and decimals in forms every engine prints alike."""
    out = []
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        c = F.col(f"`{f.name}`")
        if kind == "date":
            c = c.cast("string")
        elif kind in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind == "decimal":
            c = c.cast("double")
        out.append(c.alias(f.name))
    return df.select(*out)


@query("s01_movies", "SELECT id, title, fr_title, CAST(release_date AS VARCHAR) AS release_date, runtime, popularity, budget FROM movies")
def _(spark, folder):
    return shown(SampleTables(spark, folder).movies)


@query("s01_theaters", "SELECT id, name, company, screens, theater_api_id, showings_url FROM theaters")
def _(spark, folder):
    return SampleTables(spark, folder).theaters


@query("s01_screens", "SELECT id, theater_id, name, seat_count FROM screens")
def _(spark, folder):
    return SampleTables(spark, folder).screens


@query("s01_showings", """
SELECT id, movie_id, theater_id, screen_id, strftime(start_at, '%Y-%m-%d %H:%M:%S') AS start_at,
  CAST(date AS VARCHAR) AS date, seats_sold, purchase_url FROM showings""")
def _(spark, folder):
    return shown(SampleTables(spark, folder).showings)


@query("s01_weekends", "SELECT id, CAST(start_date AS VARCHAR) AS start_date, CAST(end_date AS VARCHAR) AS end_date FROM weekends")
def _(spark, folder):
    return shown(SampleTables(spark, folder).weekends)


@query("s01_revenues", "SELECT film_id, weekend_id, revenue_qc, data_source, cumulatif_qc_to_date, rank FROM revenues")
def _(spark, folder):
    return SampleTables(spark, folder).revenues


@query("s01_measurements", """
SELECT showing_id, movie_id, theater_id, auditorium, seats_remaining, capacity, source,
  strftime(measured_at, '%Y-%m-%d %H:%M:%S') AS measured_at FROM measurements""")
def _(spark, folder):
    return shown(SampleTables(spark, folder).measurements)


@query("s01_schedule_items", "SELECT theater_id, CAST(date AS VARCHAR) AS date, pos, title, time, key, url FROM schedule_items")
def _(spark, folder):
    return shown(SampleTables(spark, folder).schedule_items)


@query("s01_probe_outcomes", "SELECT showing_id, candidate, ok FROM probe_outcomes")
def _(spark, folder):
    return SampleTables(spark, folder).probe_outcomes
