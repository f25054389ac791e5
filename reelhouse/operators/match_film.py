"""Which film a title is: landed search results, else a known film, else a provisional id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse import fixed_values as fv
from reelhouse.functions import text as tx
from reelhouse.operators.merge import dense_numbers

YEAR_TOLERANCE = 1
# A search that finds nothing in its year is read again for these neighbouring years, in order.
YEAR_STEPS = [0, 1, -1, 2, -2]
NO_YEAR = 0


def search_norm(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(tx.strip_diacritics(F.coalesce(c, F.lit("")))), "[^a-z0-9]+", " "))


def release_year(c: Column) -> Column:
    return F.nullif(F.left(c, F.lit(4)).try_cast("int"), F.lit(0))


def within_year(release: Column, year: Column, strict: bool = True, tolerance: int = YEAR_TOLERANCE) -> Column:
    """Year gate of a search: no year asked keeps all; an unknown release year passes only when not strict."""
    near = F.abs(release_year(release) - year) <= tolerance
    return F.when(year.isNull(), F.lit(True)).otherwise(F.coalesce(near, F.lit(not strict)))


def is_documentary(genres: Column) -> Column:
    return F.coalesce(F.array_contains(genres, fv.DOCUMENTARY_GENRE), F.lit(False))


def film_score(query: Column, title: Column, original: Column, release: Column, year: Column, popularity: Column) -> Column:
    q, t, o = search_norm(query), search_norm(title), search_norm(original)
    by_title = F.when((t == q) | (o == q), 100).when(F.contains(t, q) | F.contains(o, q), 25).otherwise(0)
    off = F.abs(release_year(release) - year)
    by_year = F.when(off == 0, 40).when(off <= 1, 20).otherwise(0)
    return by_title + by_year + F.coalesce(popularity, F.lit(0.0)) / 10


def best_results(results: DataFrame) -> DataFrame:
    """Best landed result per (query, year searched, year asked), documentaries apart.

    The variants of a title differ in separators only, so the title score depends on the
    query text alone; results are reduced to one row per key before wants meet them.
    """
    year = F.col("year")
    stepped = results.withColumn("step", F.explode(F.when(year.isNull(), F.array(F.lit(0))).otherwise(F.array(*[F.lit(s) for s in YEAR_STEPS]))))
    asked = year - F.col("step")
    score = film_score(F.col("query"), F.col("title"), F.col("original_title"), F.col("release_date"), asked, F.col("popularity"))
    return (
        stepped.where(within_year(F.col("release_date"), year))
        .groupBy("query", F.coalesce(year, F.lit(NO_YEAR)).alias("search_year"), "step", is_documentary(F.col("genre_ids")).alias("documentary"))
        .agg(F.min(F.struct((-score).alias("minus"), "pos", "id")).alias("best"))
    )


def search_films(
    wants: DataFrame, results: DataFrame, year_offsets: tuple[int, ...] = (0, -1, 1), clean: bool = True
) -> DataFrame:
    """(title, year_hint, extra_queries) to a film id: queries in order, years y, y-1, y+1, no
    documentaries first, title variants, then neighbouring years; within one search the best score.
    """
    cleaned = tx.without_version_markers(F.col("title")) if clean else tx.trim_space(F.col("title"))
    queries = F.array_distinct(
        F.filter(F.concat(F.array(cleaned), F.coalesce("extra_queries", F.array().cast("array<string>"))), lambda q: q != "")
    )
    hint = F.col("year_hint")
    years = F.when(hint.isNull(), F.array(F.lit(None).cast("int"))).otherwise(F.array(*[hint + o for o in year_offsets]))
    steps = F.when(F.col("year").isNull(), F.array(F.lit(0))).otherwise(F.array(*[F.lit(s) for s in YEAR_STEPS]))
    keys = ["title", "year_hint", "extra_queries"]
    attempts = (
        wants.select(*keys).distinct()
        .select(*keys, F.posexplode(queries).alias("query_order", "base_query"))
        .select(*keys, "query_order", "base_query", F.posexplode(years).alias("year_order", "year"))
        .select("*", F.posexplode(tx.separator_variants(F.col("base_query"))).alias("variant_order", "query"))
        .select("*", F.posexplode(steps).alias("step_order", "step"))
        .withColumn("search_year", F.coalesce(F.col("year") + F.col("step"), F.lit(NO_YEAR)))
    )
    order = F.struct("query_order", "year_order", "documentary", "variant_order", "step_order", F.col("best.minus").alias("minus"), F.col("best.pos").alias("pos"), F.col("best.id").alias("id"))
    return (
        attempts.join(best_results(results), ["query", "search_year", "step"])
        .groupBy(*keys)
        .agg(F.min(order).alias("hit"))
        .select(*keys, F.col("hit.id").alias("film_id"))
    )


def known_titles(movies: DataFrame) -> DataFrame:
    """Lowest film id under every title key, French titles included."""
    keys = F.array_distinct(F.array_compact(F.array(tx.identity_key(F.col("fr_title")), tx.identity_key(F.col("title")))))
    return movies.select("id", F.explode(keys).alias("title_key")).groupBy("title_key").agg(F.min("id").alias("known_id"))


def resolve_films(wants: DataFrame, results: DataFrame, movies: DataFrame) -> DataFrame:
    """Every want with its film id and how it was found: 'search', 'known' or 'provisional'.

    Titles with one key share one provisional id; ids continue after the highest in use.
    """
    keys = ["title", "year_hint", "extra_queries"]
    title_key = tx.identity_key(tx.without_version_markers(F.col("title")))
    found = search_films(wants, results)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"w.{k}").eqNullSafe(F.col(f"f.{k}"))
    tried = (
        wants.alias("w").join(found.alias("f"), same, "left").select("w.*", F.col("f.film_id").alias("search_id"))
        .withColumn("title_key", title_key)
        .join(known_titles(movies), "title_key", "left")
    )
    new_keys = tried.where(F.col("search_id").isNull() & F.col("known_id").isNull()).select("title_key").distinct()
    highest = movies.where(F.col("id") >= fv.PROVISIONAL_BASE).agg(F.coalesce(F.max("id"), F.lit(fv.PROVISIONAL_BASE - 1))).scalar()
    provisional = dense_numbers(new_keys, "title_key").select("title_key", (highest + F.col("_number")).alias("new_id"))
    return tried.join(provisional, "title_key", "left").select(
        *wants.columns,
        F.coalesce("search_id", "known_id", "new_id").alias("film_id"),
        F.when(F.col("search_id").isNotNull(), "search").when(F.col("known_id").isNotNull(), "known").otherwise("provisional").alias("found_by"),
    )


def provisional_movies(resolved: DataFrame) -> DataFrame:
    """Rows for the films table of the provisional ids, one per id."""
    return (
        resolved.where(F.col("found_by") == "provisional")
        .groupBy(F.col("film_id").alias("id"))
        .agg(F.min(tx.without_version_markers(F.col("title"))).alias("title"))
        .select("id", "title", F.col("title").alias("fr_title"), F.lit(True).alias("provisional"))
    )
