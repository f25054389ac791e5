"""Landed JSON answers to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.functions import text as tx

_SESSION = (
    "struct<auditorium:string,showStartDateTime:string,showStartDateTimeUtc:string,vistaSessionId:string,"
    "seatsRemaining:int,areaCode:string,seatMapUrl:string>"
)
_SHOWTIMES = (
    "array<struct<dates:array<struct<movies:array<struct<name:string,filmUrl:string,runtimeInMinutes:int,"
    f"languageCode:string,experiences:array<struct<experienceTypes:array<string>,sessions:array<{_SESSION}>>>>>>>>>"
)
_PERFORMANCE = "struct<startTime:string,startTimeStr:string,schDateStr:string,seatsRemaining:int,perfIx:string,linkStr:string>"
_SESSION_MAP = (
    f"map<string,struct<code:string,title:string,schAuds:map<string,struct<name:string,"
    f"schPerfsGeneral:map<string,{_PERFORMANCE}>,schPerfsReserved:map<string,{_PERFORMANCE}>>>>>"
)
_SEARCH = (
    "struct<results:array<struct<id:bigint,title:string,original_title:string,release_date:string,"
    "genre_ids:array<int>,popularity:double>>>"
)
_DETAILS = (
    "struct<title:string,release_date:string,popularity:double,poster_path:string,backdrop_path:string,budget:bigint,"
    "runtime:int,genres:array<struct<id:bigint,name:string>>,"
    "production_countries:array<struct<iso_3166_1:string,name:string>>,"
    "production_companies:array<struct<id:bigint,name:string>>>"
)
_CREDITS = (
    "struct<crew:array<struct<id:bigint,name:string,known_for_department:string,popularity:double,gender:int,"
    "profile_path:string,job:string>>,cast:array<struct<id:bigint,name:string,known_for_department:string,"
    "popularity:double,gender:int,profile_path:string,`order`:int>>>"
)
_IMAGES = "struct<posters:array<struct<file_path:string,iso_639_1:string,vote_count:int>>>"


def flatten_sessions(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Showtimes answers (an object or a list of them) to one row per session.

    Only the first date of each block counts. 'pos' keeps the order of the answer.
    """
    keep = [c for c in raw.columns if c != payload]
    movies = (
        raw.select(*keep, F.posexplode(F.from_json(payload, _SHOWTIMES)).alias("p0", "block"))
        .select(*keep, "p0", F.posexplode(F.get(F.col("block.dates"), F.lit(0))["movies"]).alias("p1", "m"))
        .select(*keep, "p0", "p1", "m", F.posexplode("m.experiences").alias("p2", "e"))
        .select(*keep, "p0", "p1", "m", "p2", "e", F.posexplode("e.sessions").alias("p3", "s"))
    )
    return movies.select(
        *keep,
        F.struct("p0", "p1", "p2", "p3").alias("pos"),
        F.col("m.name").alias("movie_name"),
        F.col("m.filmUrl").alias("film_url"),
        F.col("m.runtimeInMinutes").alias("runtime_minutes"),
        F.col("m.languageCode").alias("language_code"),
        F.col("e.experienceTypes").alias("experience_types"),
        F.col("s.auditorium").alias("auditorium"),
        F.col("s.showStartDateTime").alias("start_local"),
        F.col("s.showStartDateTimeUtc").alias("start_utc"),
        F.col("s.vistaSessionId").alias("session_id"),
        F.col("s.seatsRemaining").alias("seats_remaining"),
        F.col("s.areaCode").alias("area_code"),
        F.col("s.seatMapUrl").alias("seat_map_url"),
        F.left("s.showStartDateTime", F.lit(10)).try_cast("date").alias("date"),
        F.substring("s.showStartDateTime", 12, 5).alias("time"),
    )


def flatten_session_maps(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Film -> auditoriums -> performances, general and reserved; a reserved one replaces its namesake.

    Performances without a readable time are dropped.
    """
    keep = [c for c in raw.columns if c != payload]
    general = F.coalesce("a.schPerfsGeneral", F.map_from_arrays(F.array(), F.array()).cast(f"map<string,{_PERFORMANCE}>"))
    reserved = F.coalesce("a.schPerfsReserved", F.map_from_arrays(F.array(), F.array()).cast(f"map<string,{_PERFORMANCE}>"))
    only_general = F.map_filter(general, lambda k, v: ~F.map_contains_key(reserved, k))
    spoken = F.coalesce(F.nullif("p.startTime", F.lit("")), F.nullif("p.startTimeStr", F.lit("")), F.col("perf_key"))
    h, m = (F.regexp_extract("spoken", tx.pattern(r"{B}([0-9]{1,2}):([0-9]{2}){B}"), i) for i in (1, 2))
    return (
        raw.select(*keep, F.explode(F.from_json(payload, _SESSION_MAP)).alias("film_key", "f"))
        .select(*keep, "f", F.explode("f.schAuds").alias("aud_key", "a"))
        .select(*keep, "f", "aud_key", "a", F.explode(F.map_concat(only_general, reserved)).alias("perf_key", "p"))
        .withColumn("spoken", spoken)
        .select(
            *keep,
            F.col("f.code").alias("code"),
            tx.decode_entities(tx.trim_space(F.coalesce("f.title", F.lit("")))).alias("movie_name"),
            tx.trim_space(F.coalesce(F.nullif("a.name", F.lit("")), F.col("aud_key"))).alias("auditorium"),
            F.when(h != "", F.concat_ws(":", F.lpad(h, 2, "0"), m)).alias("time"),
            F.col("p.schDateStr").try_cast("date").alias("session_date"),
            F.col("p.seatsRemaining").alias("seats_remaining"),
            F.col("p.perfIx").alias("performance"),
            F.col("p.linkStr").alias("link"),
        )
        .where(F.col("time").isNotNull())
    )


def search_candidates(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """Film-search answers to one row per result, in answer order."""
    keep = [c for c in raw.columns if c != payload]
    return raw.select(*keep, F.posexplode(F.from_json(payload, _SEARCH)["results"]).alias("pos", "r")).select(
        *keep, "pos", "r.*"
    )


def best_poster(posters: Column, default: Column) -> Column:
    """French before English before any other language, then votes, then order; else the default."""
    def rank(p: Column, i: Column) -> Column:
        language = F.when(p["iso_639_1"] == "fr", 3).when(p["iso_639_1"] == "en", 2).otherwise(1)
        return F.struct(language.alias("l"), F.coalesce(p["vote_count"], F.lit(0)).alias("v"), (-i).alias("i"), p["file_path"].alias("path"))

    return F.coalesce(F.array_max(F.transform(posters, rank))["path"], default)


def positive(c: Column) -> Column:
    return F.when(c > 0, c)


def parse_movies(raw: DataFrame) -> DataFrame:
    """(id, fr_title, site_release_date, details, credits, images) with the three answers parsed."""
    return raw.select(
        "id", "fr_title", "site_release_date",
        F.from_json("details", _DETAILS).alias("d"), F.from_json("credits", _CREDITS).alias("c"), F.from_json("images", _IMAGES).alias("i"),
    )


def split_movie_details(raw: DataFrame) -> dict[str, DataFrame]:
    """Film answers to the rows of the films table, the dimension tables and their bridges.

    The site's release date comes before the database's; 0 budget and runtime mean unknown;
    directors only; the first nine of the cast.
    """
    films = parse_movies(raw)
    movies = films.select(
        "id",
        F.col("d.title").alias("title"),
        "fr_title",
        F.coalesce("site_release_date", F.col("d.release_date").try_cast("date")).alias("release_date"),
        F.coalesce("d.popularity", F.lit(0.0)).alias("popularity"),
        best_poster(F.col("i.posters"), F.col("d.poster_path")).alias("poster_path"),
        F.col("d.backdrop_path").alias("backdrop_path"),
        positive(F.col("d.budget")).alias("budget"),
        positive(F.col("d.runtime")).alias("runtime"),
    )

    def parts(array: Column) -> DataFrame:
        return films.select(F.col("id").alias("movie_id"), F.explode(array).alias("x")).select("movie_id", "x.*")

    genres = parts(F.col("d.genres"))
    countries = parts(F.col("d.production_countries")).withColumnRenamed("iso_3166_1", "code")
    studios = parts(F.col("d.production_companies"))
    crew = parts(F.filter("c.crew", lambda p: p["job"] == "Director")).withColumnRenamed("profile_path", "image_path")
    cast = parts(F.slice(F.col("c.cast"), 1, 9))
    person = ["name", "known_for_department", "popularity", "gender"]

    def dimension(rows: DataFrame, key: str, *columns: str) -> DataFrame:
        """One row per id: of differing copies the least, so reruns agree."""
        best = rows.groupBy(key).agg(F.min(F.struct(*columns)).alias("v"))
        return best.select(key, "v.*")

    return {
        "movies": movies,
        "genres": dimension(genres, "id", "name"),
        "movie_genres": genres.select("movie_id", F.col("id").alias("genre_id")).distinct(),
        "countries": dimension(countries, "code", "name"),
        "movie_countries": countries.select("movie_id", F.col("code").alias("country_code")).distinct(),
        "studios": dimension(studios, "id", "name"),
        "movie_studio": studios.select("movie_id", F.col("id").alias("studio_id")).distinct(),
        "crew": dimension(crew, "id", *person, "image_path"),
        "movie_crew": crew.select("movie_id", F.col("id").alias("crew_id"), "job").distinct(),
        "actors": dimension(cast, "id", *person, "profile_path"),
        "movie_actors": cast.groupBy("movie_id", F.col("id").alias("actor_id")).agg(F.min("order").alias("order")),
    }

