"""Landed JSON to rows. The answers are built by Spark from the shared tables and read back."""

from pyspark.sql import functions as F

from reelhouse.catalog.queries_tables import shown
from reelhouse.catalog.registry import query
from reelhouse.sources import payloads
from reelhouse.sources.sample import SampleTables


def session_answers(t: SampleTables):
    """One answer per theatre, day and film; every third as a bare object instead of a list."""
    s = t.sessions
    session = F.struct(
        "auditorium", F.col("start_local").alias("showStartDateTime"), F.col("session_id").alias("vistaSessionId"),
        F.col("seats_remaining").alias("seatsRemaining"), F.col("area_code").alias("areaCode"), F.col("pos").cast("string").alias("seatMapUrl"),
    )
    movie = F.struct(
        F.col("movie_name").alias("name"), F.col("film_url").alias("filmUrl"), F.col("runtime_minutes").alias("runtimeInMinutes"),
        F.col("language_code").alias("languageCode"),
        F.array(F.struct(F.col("experience_types").alias("experienceTypes"), F.array(session).alias("sessions"))).alias("experiences"),
    )
    block = F.struct(F.array(F.struct(F.col("movies"))).alias("dates"))
    listed = s.groupBy("theater_id", F.col("date").alias("day"), "film_url").agg(F.collect_list(movie).alias("movies"))
    bare = F.crc32("film_url") % 3 == 0
    return listed.select("theater_id", F.when(bare, F.to_json(block)).otherwise(F.to_json(F.array(block))).alias("payload"))


@query("s02_session_json", """
SELECT theater_id, movie_name, film_url, runtime_minutes, language_code, experience, auditorium, start_local, session_id, seats_remaining, area_code, CAST(pos AS VARCHAR) AS seat_map_url, CAST(date AS VARCHAR) AS date, time FROM sessions""")
def _(spark, folder):
    flat = payloads.flatten_sessions(session_answers(SampleTables(spark, folder)))
    return shown(flat.select(
        "theater_id", "movie_name", "film_url", "runtime_minutes", "language_code", F.element_at("experience_types", 1).alias("experience"),
        "auditorium", "start_local", "session_id", "seats_remaining", "area_code", "seat_map_url", "date", "time",
    ))


def session_map_answers(t: SampleTables):
    """One answer per show: general and reserved performances under shared keys."""
    def perf(seats):
        time = F.when(F.col("pos") % 11 != 0, F.col("time"))
        return F.struct(time.alias("startTime"), F.col("session_date").cast("string").alias("schDateStr"), seats.alias("seatsRemaining"), F.col("pos").cast("string").alias("perfIx"))

    seats = F.col("seats_remaining")
    general = F.create_map(F.lit("a"), perf(seats), F.lit("b"), perf(seats + 1))
    reserved = F.create_map(F.lit("b"), perf(seats + 2))
    hall = F.struct(F.col("auditorium").alias("name"), general.alias("schPerfsGeneral"), F.when(F.col("pos") % 2 == 0, reserved).alias("schPerfsReserved"))
    film = F.struct(F.col("film_url").alias("code"), F.concat("movie_name", F.lit(" &amp; co")).alias("title"), F.create_map(F.lit("h1"), hall).alias("schAuds"))
    return t.sessions.select("theater_id", F.to_json(F.create_map(F.lit("m"), film)).alias("payload"))


@query("s03_session_map_json", """
SELECT theater_id, film_url AS code, concat(movie_name, ' & co') AS movie_name, trim(auditorium) AS auditorium, time, CAST(session_date AS VARCHAR) AS session_date, seats_remaining + k.extra AS seats_remaining, CAST(pos AS VARCHAR) AS performance
FROM sessions CROSS JOIN (VALUES (0), (1), (2)) k(extra) WHERE pos % 11 <> 0 AND (k.extra = 0 OR k.extra = CASE WHEN pos % 2 = 0 THEN 2 ELSE 1 END)""")
def _(spark, folder):
    flat = payloads.flatten_session_maps(session_map_answers(SampleTables(spark, folder)))
    return shown(flat.select("theater_id", "code", "movie_name", "auditorium", "time", "session_date", "seats_remaining", "performance"))


@query("s04_search_json", """
SELECT query, year, id, title, original_title, release_date, genre, popularity FROM search_results""")
def _(spark, folder):
    r = SampleTables(spark, folder).search_results
    item = F.struct("id", "title", "original_title", "release_date", "genre_ids", "popularity")
    raw = r.groupBy("query", "year", F.floor(F.col("id") / 20)).agg(F.to_json(F.struct(F.collect_list(item).alias("results"))).alias("payload"))
    found = payloads.search_candidates(raw.select("query", "year", "payload"))
    return found.select("query", "year", "id", "title", "original_title", "release_date", F.element_at("genre_ids", 1).alias("genre"), "popularity")


def movie_answers(t: SampleTables):
    key, size = F.col("p_partkey"), F.col("p_size")
    poster = lambda lang, votes: F.struct(F.concat_ws("-", F.lit(lang), key.cast("string"), votes.cast("string")).alias("file_path"), F.lit(lang).alias("iso_639_1"), votes.alias("vote_count"))
    details = F.struct(
        F.col("p_name").alias("title"), F.when(key % 5 == 0, "").otherwise("2023-11-03").alias("release_date"), F.col("p_retailprice").alias("popularity"),
        F.concat(F.lit("default-"), key.cast("string")).alias("poster_path"), (size % 3 * 1000).alias("budget"), (size % 4 * 30).alias("runtime"),
        F.array(F.struct((size % 7).alias("id"), F.concat(F.lit("g"), (size % 7).cast("string")).alias("name")), F.struct((size % 7 + 1).alias("id"), F.concat(F.lit("g"), (size % 7 + 1).cast("string")).alias("name"))).alias("genres"),
        F.array(F.struct(F.col("p_type").alias("iso_3166_1"), F.lower("p_type").alias("name"))).alias("production_countries"),
        F.array(F.struct((size % 9).alias("id"), F.concat(F.lit("s"), (size % 9).cast("string")).alias("name"))).alias("production_companies"),
    )
    person = lambda i, name: [i.alias("id"), F.concat(F.lit(name), i.cast("string")).alias("name"), F.lit("Acting").alias("known_for_department"), F.lit(1.5).alias("popularity"), F.lit(2).alias("gender")]
    crew = F.array(F.struct(*person(size + 100, "d"), F.lit("Director").alias("job")), F.struct(*person(size + 200, "w"), F.lit("Writer").alias("job")))
    cast = F.transform(F.sequence(F.lit(0), size % 12), lambda i: F.struct(*person(size + i, "a"), i.alias("order")))
    images = F.struct(F.when(key % 3 != 0, F.array(poster("en", size), poster("fr", size % 5), poster("fr", size % 6), poster("de", size * 9))).otherwise(F.array(poster("en", size), poster("es", size * 2))).alias("posters"))
    images = F.when(key % 4 != 0, F.to_json(images)).otherwise("{}")
    return t.raw("part").select(
        key.alias("id"), F.when(key % 2 == 0, F.concat(F.lit("Le "), "p_name")).alias("fr_title"),
        F.when(key % 6 == 0, F.lit("2024-01-05").cast("date")).alias("site_release_date"),
        F.to_json(details).alias("details"), F.to_json(F.struct(crew.alias("crew"), cast.alias("cast"))).alias("credits"), images.alias("images"),
    )


@query("s05_movie_rows", """
SELECT p_partkey AS id, p_name AS title, CASE WHEN p_partkey % 2 = 0 THEN concat('Le ', p_name) END AS fr_title,
  CASE WHEN p_partkey % 6 = 0 THEN '2024-01-05' WHEN p_partkey % 5 = 0 THEN NULL ELSE '2023-11-03' END AS release_date, p_retailprice AS popularity,
  CASE WHEN p_partkey % 4 = 0 THEN concat('default-', p_partkey) WHEN p_partkey % 3 = 0 THEN concat('en-', p_partkey, '-', p_size)
    ELSE concat('fr-', p_partkey, '-', greatest(p_size % 5, p_size % 6)) END AS poster_path,
  CAST(nullif(p_size % 3 * 1000, 0) AS BIGINT) AS budget, CAST(nullif(p_size % 4 * 30, 0) AS INTEGER) AS runtime FROM part""")
def _(spark, folder):
    rows = payloads.split_movie_details(movie_answers(SampleTables(spark, folder)))["movies"]
    return shown(rows.drop("backdrop_path"))


@query("w06_best_poster", """
SELECT p_partkey AS id, CASE WHEN p_partkey % 4 = 0 THEN concat('default-', p_partkey) WHEN p_partkey % 3 = 0 THEN concat('en-', p_partkey, '-', p_size)
    ELSE concat('fr-', p_partkey, '-', greatest(p_size % 5, p_size % 6)) END AS poster FROM part""")
def _(spark, folder):
    films = payloads.parse_movies(movie_answers(SampleTables(spark, folder)))
    return films.select("id", payloads.best_poster(F.col("i.posters"), F.col("d.poster_path")).alias("poster"))


@query("s05_dimension_rows", """
SELECT 'genres' AS kind, CAST(id AS VARCHAR) AS key, name FROM (SELECT DISTINCT p_size % 7 + k AS id, concat('g', p_size % 7 + k) AS name FROM part, (VALUES (0), (1)) v(k))
UNION ALL SELECT 'countries', p_type, lower(p_type) FROM (SELECT DISTINCT p_type FROM part)
UNION ALL SELECT 'studios', CAST(id AS VARCHAR), concat('s', id) FROM (SELECT DISTINCT p_size % 9 AS id FROM part)
UNION ALL SELECT 'crew', CAST(id AS VARCHAR), concat('d', id) FROM (SELECT DISTINCT p_size + 100 AS id FROM part)
UNION ALL SELECT 'actors', CAST(id AS VARCHAR), concat('a', id) FROM (SELECT DISTINCT p_size + k AS id FROM part, range(9) r(k) WHERE k <= p_size % 12)""")
def _(spark, folder):
    tables = payloads.split_movie_details(movie_answers(SampleTables(spark, folder)))
    out = None
    for kind, key in (("genres", "id"), ("countries", "code"), ("studios", "id"), ("crew", "id"), ("actors", "id")):
        rows = tables[kind].select(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("key"), "name")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("s05_bridge_rows", """
SELECT 'movie_genres' AS kind, p_partkey AS movie_id, CAST(p_size % 7 + k AS VARCHAR) AS key, '' AS detail FROM part, (VALUES (0), (1)) v(k)
UNION ALL SELECT 'movie_countries', p_partkey, p_type, '' FROM part UNION ALL SELECT 'movie_studio', p_partkey, CAST(p_size % 9 AS VARCHAR), '' FROM part
UNION ALL SELECT 'movie_crew', p_partkey, CAST(p_size + 100 AS VARCHAR), 'Director' FROM part""")
def _(spark, folder):
    tables = payloads.split_movie_details(movie_answers(SampleTables(spark, folder)))
    out = None
    for kind, key, detail in (("movie_genres", "genre_id", F.lit("")), ("movie_countries", "country_code", F.lit("")), ("movie_studio", "studio_id", F.lit("")), ("movie_crew", "crew_id", F.col("job"))):
        rows = tables[kind].select(F.lit(kind).alias("kind"), "movie_id", F.col(key).cast("string").alias("key"), detail.alias("detail"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query("w04_first_nine_cast", "SELECT p_partkey AS movie_id, CAST(p_size + k AS BIGINT) AS actor_id, CAST(k AS INTEGER) AS \"order\" FROM part, range(9) r(k) WHERE k <= p_size % 12")
def _(spark, folder):
    return payloads.split_movie_details(movie_answers(SampleTables(spark, folder)))["movie_actors"]
