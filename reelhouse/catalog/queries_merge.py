"""Keyed merges."""

import uuid

from pyspark.sql import functions as F

from reelhouse.catalog.queries_tables import shown
from reelhouse.catalog.queries_weekend import BIAS, PRICE, WEEKEND, estimate_steps, weekend_estimate_query
from reelhouse.catalog.registry import query
from reelhouse.functions import time as tm
from reelhouse.operators import merge, publish
from reelhouse.operators.partition_merge import PartitionedTable
from reelhouse.plans import rank, weekly_load
from reelhouse.session import shared_folder, written
from reelhouse.sources.sample import SampleTables

AS_OF = "2024-01-15 12:00:00"


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


@query("m01_weekend_upsert", """
WITH src AS (SELECT DISTINCT CAST(isoyear(d + 14) * 100 + week(d + 14) AS INTEGER) AS id, d + CAST(18 - wd AS INTEGER) AS start_date, d + CAST(20 - wd AS INTEGER) AS end_date FROM local_days),
tgt AS (SELECT id, start_date, CAST(NULL AS DATE) AS end_date FROM weekends)
SELECT coalesce(s.id, t.id) AS id, CAST(coalesce(s.start_date, t.start_date) AS VARCHAR) AS start_date, CAST(coalesce(s.end_date, t.end_date) AS VARCHAR) AS end_date
FROM tgt t FULL JOIN src s ON s.id = t.id""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    ids = t.showings.select(tm.weekend_id(F.date_add("date", 14)).alias("id")).distinct()
    source = ids.select("id", tm.friday_of(F.col("id")).alias("start_date"), tm.sunday_of(F.col("id")).alias("end_date"))
    target = t.weekends.withColumn("end_date", F.lit(None).cast("date"))
    return shown(merge.merge_weekends(target, source))


_FIGURES = """
SELECT user_id AS film_id, CAST(isoyear(CAST(ts - INTERVAL '5' HOUR AS DATE)) * 100 + week(CAST(ts - INTERVAL '5' HOUR AS DATE)) AS INTEGER) AS weekend_id,
  CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS revenue_qc,
  CAST(CASE WHEN user_id % 2 = 0 THEN sum(CAST(floor(value) AS BIGINT)) * 3 END AS BIGINT) AS cumulatif_qc_to_date
FROM events WHERE isodow(CAST(ts - INTERVAL '5' HOUR AS DATE)) >= 5 GROUP BY 1, 2"""


def purchase_figures(t: SampleTables):
    day = tm.local_date(F.col("ts"))
    total = F.sum(F.floor("value"))
    return (
        t.raw("events").where(F.weekday(day) >= 4)
        .groupBy(F.col("user_id").alias("film_id"), tm.weekend_id(day).alias("weekend_id"))
        .agg(total.alias("revenue_qc"), F.when(F.col("user_id") % 2 == 0, total * 3).alias("cumulatif_qc_to_date"))
        .withColumns({
            "revenue_us": F.lit(None).cast("bigint"), "rank": F.lit(None).cast("int"),
            "cumulatif_us_to_date": F.lit(None).cast("bigint"),
        })
    )


_PUBLISHED = f"""
WITH src AS ({_FIGURES})
SELECT coalesce(t.film_id, s.film_id) AS film_id, coalesce(t.weekend_id, s.weekend_id) AS weekend_id,
  CASE WHEN s.film_id IS NULL THEN t.revenue_qc ELSE s.revenue_qc END AS revenue_qc,
  CASE WHEN s.film_id IS NULL THEN t.data_source ELSE 'cinoche' END AS data_source,
  coalesce(s.cumulatif_qc_to_date, t.cumulatif_qc_to_date) AS cumulatif_qc_to_date,
  CASE WHEN s.film_id IS NULL THEN t.rank END AS rank
FROM revenues t FULL JOIN src s ON s.film_id = t.film_id AND s.weekend_id = t.weekend_id"""


@query("m02_published_upsert", _PUBLISHED)
def _(spark, folder):
    t = SampleTables(spark, folder)
    return merge.merge_published(t.revenues, purchase_figures(t))


def stored(rows, partition, of=None):
    """The rows as a partitioned table in the shared folder."""
    table = PartitionedTable(rows.sparkSession, shared_folder(rows.sparkSession, f"stored-{uuid.uuid4().hex}"), partition, of)
    table.create(rows)
    return table


@query("m02_published_by_partition", _PUBLISHED)
def _(spark, folder):
    """One weekend after the other into a table partitioned by weekend."""
    t = SampleTables(spark, folder)
    table = stored(t.revenues, "weekend_id")
    figures = written(purchase_figures(t), "figures")
    source, rules = merge.published_merge(table.read(), figures)
    for weekend in (r[0] for r in t.weekends.select("id").collect()):
        table.merge(source.where(F.col("weekend_id") == weekend), merge.REVENUE_KEY, rules)
    return table.read().select(*t.revenues.columns)


@query("q04_published_enrich", f"""
WITH src AS ({_FIGURES}),
feat AS (
  SELECT f.film_id, f.weekend_id,
    (SELECT round(sum(s.seats_sold) / nullif(sum(sc.seat_count), 0), 4) FROM showings s JOIN screens sc ON sc.id = s.screen_id
      WHERE s.movie_id = f.film_id AND s.date BETWEEN w.start_date AND w.end_date AND s.seats_sold IS NOT NULL) AS average_showing_occupancy,
    round((SELECT count(*) FROM showings s WHERE s.movie_id = f.film_id AND s.date BETWEEN w.start_date AND w.end_date)
      / nullif((SELECT count(*) FROM showings s WHERE s.date BETWEEN w.start_date AND w.end_date), 0), 4) AS showings_proportion
  FROM src f JOIN weekends w ON w.id = f.weekend_id)
SELECT coalesce(t.film_id, s.film_id) AS film_id, coalesce(t.weekend_id, s.weekend_id) AS weekend_id,
  CASE WHEN s.film_id IS NULL THEN t.revenue_qc ELSE s.revenue_qc END AS revenue_qc,
  CASE WHEN s.film_id IS NULL THEN t.data_source ELSE 'cinoche' END AS data_source,
  coalesce(s.cumulatif_qc_to_date, t.cumulatif_qc_to_date) AS cumulatif_qc_to_date,
  f.average_showing_occupancy, f.showings_proportion
FROM revenues t FULL JOIN src s ON s.film_id = t.film_id AND s.weekend_id = t.weekend_id
LEFT JOIN feat f ON f.film_id = s.film_id AND f.weekend_id = s.weekend_id""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    target = t.revenues.drop("rank").withColumns({
        "average_showing_occupancy": F.lit(None).cast("decimal(6,4)"),
        "showings_proportion": F.lit(None).cast("decimal(6,4)"),
    })
    return shown(merge.merge_published(target, publish.published_rows(purchase_figures(t), t.showings, t.screens)))


_REFRESHED = estimate_steps(WEEKEND, PRICE, BIAS) + """
SELECT coalesce(t.film_id, s.film_id) AS film_id, coalesce(t.weekend_id, s.weekend_id) AS weekend_id,
  coalesce(t.data_source, s.data_source) AS data_source, t.rank,
  CASE WHEN s.film_id IS NOT NULL AND (t.film_id IS NULL OR t.data_source = 'estimate') THEN s.revenue_qc ELSE t.revenue_qc END AS revenue_qc,
  CASE WHEN s.film_id IS NOT NULL AND (t.film_id IS NULL OR t.data_source = 'estimate') THEN s.cumulatif_qc_to_date ELSE t.cumulatif_qc_to_date END AS cumulatif_qc_to_date
FROM revenues t FULL JOIN final s ON s.film_id = t.film_id AND s.weekend_id = t.weekend_id"""


@query("m03_estimate_refresh", _REFRESHED)
def _(spark, folder):
    t = SampleTables(spark, folder)
    return merge.merge_estimates(t.revenues, written(weekend_estimate_query(spark, folder), "estimates"))


@query("m03_estimates_by_partition", _REFRESHED)
def _(spark, folder):
    t = SampleTables(spark, folder)
    table = stored(t.revenues, "weekend_id")
    weekly_load.load_estimates_into(table, weekend_estimate_query(spark, folder))
    return table.read().select(*t.revenues.columns)


@query("m03_estimated_films", estimate_steps(WEEKEND, PRICE, BIAS) + """
SELECT s.film_id FROM final s LEFT JOIN revenues t ON s.film_id = t.film_id AND s.weekend_id = t.weekend_id
WHERE t.film_id IS NULL OR t.data_source = 'estimate'""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    return merge.estimated_films(t.revenues, weekend_estimate_query(spark, folder))


_MOVIE_SOURCE = """
SELECT p_partkey * 2 AS id, concat('New ', p_name) AS title, concat('Nouveau ', p_name) AS fr_title,
  DATE '2024-02-01' AS release_date, CAST(p_size % 3 * 30 AS INTEGER) AS runtime,
  CAST(p_size AS DOUBLE) * 30 AS popularity, CAST(CASE WHEN p_size % 2 = 0 THEN p_size * 7 END AS BIGINT) AS budget
FROM part"""


def movie_source(t: SampleTables):
    return t.raw("part").select(
        (F.col("p_partkey") * 2).alias("id"),
        F.concat(F.lit("New "), "p_name").alias("title"),
        F.concat(F.lit("Nouveau "), "p_name").alias("fr_title"),
        F.lit("2024-02-01").cast("date").alias("release_date"),
        (F.col("p_size") % 3 * 30).alias("runtime"),
        (F.col("p_size").cast("double") * 30).alias("popularity"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_size") * 7).cast("bigint").alias("budget"),
    )


_FILLED = f"""
WITH src AS ({_MOVIE_SOURCE})
SELECT coalesce(t.id, s.id) AS id, coalesce(t.title, s.title) AS title, coalesce(t.fr_title, s.fr_title) AS fr_title,
  CAST(coalesce(t.release_date, s.release_date) AS VARCHAR) AS release_date,
  CASE WHEN t.runtime IS NULL OR t.runtime = 0 THEN coalesce(s.runtime, t.runtime) ELSE t.runtime END AS runtime,
  CASE WHEN t.budget IS NULL OR t.budget = 0 THEN coalesce(s.budget, t.budget) ELSE t.budget END AS budget,
  greatest(coalesce(t.popularity, 0), coalesce(s.popularity, 0)) AS popularity
FROM movies t FULL JOIN src s ON s.id = t.id"""


@query("m04_movie_fill_missing", _FILLED)
def _(spark, folder):
    t = SampleTables(spark, folder)
    return shown(merge.merge_new_movies(t.movies, movie_source(t)))


@query("m04_movies_by_bucket", _FILLED)
def _(spark, folder):
    """A table without a natural partition lies by bucket of its key; two merges, each of some buckets."""
    t = SampleTables(spark, folder)
    table = stored(t.movies, "bucket", lambda rows: F.pmod(F.xxhash64(F.col("id").cast("bigint")), F.lit(8)).cast("int"))
    source = movie_source(t)
    rules = {c: r for c, r in merge.MOVIE_RULES.items() if c in t.movies.columns and c in source.columns}
    for part in (0, 1):
        table.merge(source.where(table.of(source) % 2 == part), ["id"], rules)
    return shown(table.read().select(*t.movies.columns))


@query("m05_movie_refresh", f"""
WITH src AS ({_MOVIE_SOURCE})
SELECT t.id, t.title, coalesce(t.fr_title, s.fr_title) AS fr_title, t.runtime, t.budget,
  CAST(CASE WHEN s.id % 3 = 0 THEN s.release_date ELSE t.release_date END AS VARCHAR) AS release_date,
  CASE WHEN s.id IS NULL THEN t.popularity ELSE s.popularity END AS popularity
FROM movies t LEFT JOIN src s ON s.id = t.id""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    source = movie_source(t).withColumn("release_date", F.when(F.col("id") % 3 == 0, F.col("release_date")))
    return shown(merge.refresh_movies(t.movies, source))


@query("m06_dimension_insert", """
WITH tgt AS (SELECT CAST(p_size AS BIGINT) AS id, min(p_type) AS name FROM part GROUP BY 1),
src AS (SELECT CAST(p_size + 10 AS BIGINT) AS id, max(p_type) AS name FROM part GROUP BY 1)
SELECT id, name FROM tgt UNION ALL SELECT id, name FROM src WHERE id NOT IN (SELECT id FROM tgt)""")
def _(spark, folder):
    part = SampleTables(spark, folder).raw("part")
    target = part.groupBy(F.col("p_size").cast("bigint").alias("id")).agg(F.min("p_type").alias("name"))
    source = part.groupBy((F.col("p_size") + 10).cast("bigint").alias("id")).agg(F.max("p_type").alias("name"))
    return merge.insert_if_absent(target, source, ["id"])


@query("m06_bridge_insert", """
SELECT p_partkey AS movie_id, CAST(p_size AS BIGINT) AS genre_id FROM part
UNION SELECT p_partkey, CAST(p_size + p_partkey % 2 AS BIGINT) FROM part""")
def _(spark, folder):
    part = SampleTables(spark, folder).raw("part")
    movie = F.col("p_partkey").alias("movie_id")
    target = part.select(movie, F.col("p_size").cast("bigint").alias("genre_id"))
    source = part.select(movie, (F.col("p_size") + F.col("p_partkey") % 2).cast("bigint").alias("genre_id"))
    return merge.insert_if_absent(target, source, ["movie_id", "genre_id"])


_REPEAT_SHOWS = """
SELECT movie_id, theater_id, start_at + to_hours(CAST(id % 2 AS BIGINT) * 24) AS start_at, CAST(date + CAST(id % 2 AS INTEGER) AS DATE) AS date FROM showings
UNION ALL SELECT movie_id, theater_id, start_at, date FROM showings"""


@query("m07_showing_insert", f"""
WITH src AS ({_REPEAT_SHOWS}),
added AS (SELECT DISTINCT * FROM src s WHERE NOT EXISTS (SELECT 1 FROM showings t
  WHERE t.movie_id = s.movie_id AND t.theater_id = s.theater_id AND t.start_at = s.start_at AND t.date = s.date))
SELECT movie_id, count(*) AS n, count(id) AS n_known, CAST(max(start_at) AS VARCHAR)[1:19] AS last_start FROM (
  SELECT id, movie_id, start_at FROM showings UNION ALL SELECT NULL, movie_id, start_at FROM added) GROUP BY 1""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    later = F.col("id") % 2
    shows = t.showings
    shifted = shows.select(
        "movie_id", "theater_id", (F.col("start_at") + F.make_dt_interval(days=later.cast("int"))).alias("start_at"),
        F.date_add("date", later.cast("int")).alias("date"),
    )
    source = shifted.unionByName(shows.select("movie_id", "theater_id", "start_at", "date"))
    return shown(
        merge.add_showings(shows, source).groupBy("movie_id").agg(
            F.count(F.lit(1)).alias("n"), F.count("id").alias("n_known"), F.max("start_at").alias("last_start")
        )
    )


@query("m07_showings_added", f"""
WITH src AS ({_REPEAT_SHOWS})
SELECT CAST(count(*) AS BIGINT) AS n_added FROM (SELECT DISTINCT * FROM src s WHERE NOT EXISTS (SELECT 1 FROM showings t
  WHERE t.movie_id = s.movie_id AND t.theater_id = s.theater_id AND t.start_at = s.start_at AND t.date = s.date))""")
def _(spark, folder):
    shows = SampleTables(spark, folder).showings
    later = F.col("id") % 2
    source = shows.select(
        "movie_id", "theater_id", (F.col("start_at") + F.make_dt_interval(days=later.cast("int"))).alias("start_at"),
        F.date_add("date", later.cast("int")).alias("date"),
    )
    return merge.added_showings(shows, source).agg(F.count(F.lit(1)).alias("n_added"))


@query("m08_theater_upsert", """
WITH src AS (
  SELECT upper(t.name) AS name, concat('Group ', c.c_mktsegment) AS company, CAST(c.c_custkey % 16 + 1 AS INTEGER) AS screens
  FROM customer c JOIN theaters t ON t.id = c.c_nationkey
  UNION ALL SELECT concat('Ciné ', c_mktsegment, ' ', c_custkey % 40), c_mktsegment, NULL FROM customer),
keyed AS (SELECT upper(name) AS k, min(name) AS name, min(company) AS company, min(screens) AS screens FROM src GROUP BY 1)
SELECT t.id, t.name, coalesce(t.company, s.company) AS company, coalesce(t.screens, s.screens) AS screens
FROM theaters t LEFT JOIN keyed s ON s.k = upper(t.name)
UNION ALL
SELECT (SELECT max(id) FROM theaters) + row_number() OVER (ORDER BY left(md5(k), 2), k), name, company, screens
FROM keyed WHERE k NOT IN (SELECT upper(name) FROM theaters)""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    c = t.raw("customer")
    known = c.join(t.theaters, F.col("id") == F.col("c_nationkey")).select(
        F.upper("name").alias("name"),
        F.concat(F.lit("Group "), "c_mktsegment").alias("company"),
        (F.col("c_custkey") % 16 + 1).cast("int").alias("screens"),
    )
    other = c.select(
        F.concat_ws(" ", F.lit("Ciné"), "c_mktsegment", (F.col("c_custkey") % 40).cast("string")).alias("name"),
        F.col("c_mktsegment").alias("company"),
        F.lit(None).cast("int").alias("screens"),
    )
    return merge.merge_theaters(t.theaters, known.unionByName(other)).select("id", "name", "company", "screens")


_SEATS = f"""
SELECT s.id, CASE WHEN s.seats_sold IS DISTINCT FROM x.v THEN x.v ELSE s.seats_sold END AS seats_sold,
  CASE WHEN s.seats_sold IS DISTINCT FROM x.v THEN '{AS_OF}' END AS scraped_at
FROM showings s JOIN (SELECT id, CASE WHEN id % 5 = 0 THEN NULL ELSE CAST(least(floor(value), true_seats) AS INTEGER) END AS v FROM showing_facts) x USING (id)"""


def seats_written(t: SampleTables):
    return t.showing_facts.select(
        "id", F.when(F.col("id") % 5 != 0, F.least(F.floor("value"), F.col("true_seats"))).cast("int").alias("seats_sold")
    )


@query("m09_seats_by_partition", _SEATS)
def _(spark, folder):
    """Showings partitioned by local date; the source names the date of each show."""
    t = SampleTables(spark, folder)
    table = stored(t.showings.select("id", "seats_sold", F.lit(None).cast("timestamp_ntz").alias("scraped_at"), "date"), "date")
    source = seats_written(t).withColumn("scraped_at", as_of()).join(t.showings.select("id", "date"), "id")
    differs = ~F.col("t.seats_sold").eqNullSafe(F.col("s.seats_sold"))
    table.merge(source, ["id"], {"seats_sold": merge.overwrite, "scraped_at": merge.overwrite}, differs, insert=False)
    return shown(table.read().select("id", "seats_sold", "scraped_at"))


@query("m09_seats_write", _SEATS)
def _(spark, folder):
    t = SampleTables(spark, folder)
    source = seats_written(t)
    target = t.showings.select("id", "seats_sold", F.lit(None).cast("timestamp_ntz").alias("scraped_at"))
    return shown(merge.write_seats(target, source, as_of()))


@query("m10_write_once", """
SELECT s.id, coalesce(s.screen_id, f.true_screen) AS screen_id, coalesce(s.purchase_url, concat('https://tickets.example/new?P3=', s.id)) AS purchase_url
FROM showings s JOIN showing_facts f USING (id)""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    source = t.showing_facts.select(
        "id", F.col("true_screen").alias("screen_id"),
        F.concat(F.lit("https://tickets.example/new?P3="), F.col("id").cast("string")).alias("purchase_url"),
    )
    target = t.showings.select("id", "screen_id", "purchase_url")
    return merge.write_once(merge.write_once(target, source, "screen_id"), source, "purchase_url")


@query("m11_screen_assign", f"""
SELECT s.id, CASE WHEN s.screen_id IS NULL AND s.start_at BETWEEN TIMESTAMP '{AS_OF}'
    AND s.date + CAST(f.true_screen % 3 - 1 AS INTEGER) + INTERVAL '1' DAY - INTERVAL '1' SECOND THEN f.true_screen ELSE s.screen_id END AS screen_id
FROM showings s JOIN showing_facts f USING (id)""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    source = t.showing_facts.select(
        "id", F.col("true_screen").alias("screen_id"),
        F.date_add("date", (F.col("true_screen") % 3 - 1).cast("int")).alias("end_date"),
    )
    target = t.showings.select("id", "screen_id", "start_at")
    return merge.assign_screens(target, source, as_of()).select("id", "screen_id")


@query("m12_popularity_refresh", """
WITH tgt AS (SELECT id + CASE WHEN id % 10 = 3 THEN 1000000000 ELSE 0 END AS id, popularity, budget FROM movies),
src AS (SELECT id, CASE WHEN id % 7 = 0 THEN NULL ELSE CAST(id % 100 AS DOUBLE) END AS popularity, id % 4 * 500 AS budget FROM tgt)
SELECT t.id, CASE WHEN t.id < 1000000000 THEN coalesce(s.popularity, 0) ELSE t.popularity END AS popularity,
  CASE WHEN t.id < 1000000000 THEN nullif(s.budget, 0) ELSE t.budget END AS budget
FROM tgt t LEFT JOIN src s USING (id)""")
def _(spark, folder):
    movies = SampleTables(spark, folder).movies.select("id", "popularity", "budget")
    movies = movies.withColumn("id", F.col("id") + F.when(F.col("id") % 10 == 3, 1_000_000_000).otherwise(0))
    source = movies.select(
        "id",
        F.when(F.col("id") % 7 != 0, (F.col("id") % 100).cast("double")).alias("popularity"),
        (F.col("id") % 4 * 500).alias("budget"),
    )
    return merge.refresh_popularity(movies, source)


@query("m13_rank_write_back", """
WITH ranked AS (
  SELECT r.film_id, r.weekend_id, rank() OVER (PARTITION BY r.weekend_id ORDER BY r.revenue_qc DESC NULLS LAST,
    (SELECT count(*) FROM showings s WHERE s.movie_id = r.film_id AND s.date BETWEEN
       CASE WHEN NOT EXISTS (SELECT 1 FROM revenues p WHERE p.film_id = r.film_id AND p.weekend_id < r.weekend_id) THEN w.start_date - 3 ELSE w.start_date END AND w.end_date) DESC, r.film_id) AS rk
  FROM revenues r JOIN weekends w ON w.id = r.weekend_id)
SELECT r.film_id, r.weekend_id, r.revenue_qc, r.data_source, r.cumulatif_qc_to_date, CAST(k.rk AS INTEGER) AS rank
FROM revenues r JOIN ranked k USING (film_id, weekend_id)""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    return merge.write_ranks(t.revenues, rank.rank_weekends(t.revenues, t.showings))
