"""Predicates, joins, aggregations, windows and set operations on the box-office tables."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelhouse.catalog.queries_merge import AS_OF, as_of
from reelhouse.catalog.queries_tables import shown
from reelhouse.catalog.registry import query
from reelhouse.functions import money
from reelhouse.functions import text as tx
from reelhouse.functions import time as tm
from reelhouse.operators import features, history, seats
from reelhouse.plans import rank, worklist
from reelhouse.plans.weekend_estimate import Weekend, published_floor
from reelhouse.sources.sample import SampleTables



def row_count():
    return F.count(F.lit(1))
LOCAL = "(start_at - INTERVAL '5' HOUR)"


# ---- predicates ---------------------------------------------------------------------------
@query("p01_display_title", "SELECT coalesce(fr_title, title) AS display_title, count(*) AS n FROM movies GROUP BY 1")
def _(spark, folder):
    m = SampleTables(spark, folder).movies
    return m.groupBy(F.coalesce("fr_title", "title").alias("display_title")).agg(row_count().alias("n"))


@query("p02_weekend_bounds", """
SELECT w.id AS weekend_id, count(*) FILTER (WHERE s.date BETWEEN w.start_date AND w.end_date) AS fri_sun, count(*) FILTER (WHERE s.date = w.start_date - 1) AS thu,
  count(*) FILTER (WHERE s.date BETWEEN w.start_date - 3 AND w.start_date - 1) AS tue_thu, count(*) FILTER (WHERE s.date BETWEEN w.end_date - 6 AND w.start_date - 4) AS mon
FROM weekends w JOIN showings s ON s.date BETWEEN w.end_date - 6 AND w.end_date GROUP BY 1""")
def _(spark, folder):
    d = F.col("date")
    wid = tm.weekend_id(d)
    friday, sunday = tm.friday_of(F.col("weekend_id")), tm.sunday_of(F.col("weekend_id"))
    s = SampleTables(spark, folder).showings.select(d, wid.alias("weekend_id"))
    return s.groupBy("weekend_id").agg(
        F.count_if(d.between(friday, sunday)).alias("fri_sun"),
        F.count_if(d == F.date_sub(friday, 1)).alias("thu"),
        F.count_if(d.between(F.date_sub(friday, 3), F.date_sub(friday, 1))).alias("tue_thu"),
        F.count_if(d.between(F.date_sub(sunday, 6), F.date_sub(friday, 4))).alias("mon"),
    )


@query("p03_first_week_bound", """
SELECT r.film_id, r.weekend_id, count(s.id) AS n FROM revenues r JOIN weekends w ON w.id = r.weekend_id
LEFT JOIN showings s ON s.movie_id = r.film_id AND s.date BETWEEN CASE WHEN NOT EXISTS (SELECT 1 FROM revenues p WHERE p.film_id = r.film_id AND p.weekend_id < r.weekend_id)
  THEN w.start_date - 3 ELSE w.start_date END AND w.end_date GROUP BY 1, 2""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    return rank.rank_weekends(t.revenues, t.showings).select("film_id", "weekend_id", F.col("show_count").alias("n"))


@query("p04_instant_window", f"""
SELECT id, start_at >= TIMESTAMP '{AS_OF}' AS ahead FROM showings WHERE start_at BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL '15' MINUTE AND TIMESTAMP '{AS_OF}' + INTERVAL '4' HOUR""")
def _(spark, folder):
    s = SampleTables(spark, folder).showings
    return s.where(worklist.around(F.col("start_at"), as_of(), "15 minutes", "4 hours")).select(
        "id", (F.col("start_at") >= as_of()).alias("ahead")
    )


@query("p05_name_contains", "SELECT id, name, contains(name, 'Cineplex') AS exact_case, contains(lower(name), 'nation_1') AS any_case FROM theaters")
def _(spark, folder):
    name = F.col("name")
    return SampleTables(spark, folder).theaters.select(
        "id", name, F.contains(name, F.lit("Cineplex")).alias("exact_case"),
        F.contains(F.lower(name), F.lit("nation_1")).alias("any_case"),
    )


@query("p06_venue_words", "SELECT doc_id FROM documents WHERE NOT regexp_matches(text, '(?i)(th[eé]âtre|cin[eé]|rgfm|guzzo|beaubien|forum|imax|vip)')")
def _(spark, folder):
    return SampleTables(spark, folder).raw("documents").where(tx.names_no_venue(F.col("text"))).select("doc_id")


@query("p09_local_day_window", f"""
SELECT s.id AS showing_id, strftime(s.start_at, '%Y-%m-%d %H:%M:%S') AS start_at, coalesce(m.fr_title, m.title) AS movie_title, t.name AS theater_name
FROM showings s JOIN theaters t ON t.id = s.theater_id JOIN movies m ON m.id = s.movie_id
WHERE s.start_at - INTERVAL '5' HOUR >= DATE '2024-01-15' AND s.start_at - INTERVAL '5' HOUR < DATE '2024-01-17' + INTERVAL '1' DAY AND t.name IN ('Cinéma RGFM Beloeil', 'Cineplex NATION_2')
ORDER BY t.name, m.title, s.start_at, s.id LIMIT 2000""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    return shown(
        worklist.shows_between(t.showings, t.theaters, t.movies, "2024-01-15", "2024-01-17", ["Cinéma RGFM Beloeil", "Cineplex NATION_2"])
    )


@query("p10_minute_range", "SELECT theater_id, pos, time FROM schedule_items WHERE CAST(left(time, 2) AS INTEGER) * 60 + CAST(right(time, 2) AS INTEGER) BETWEEN 480 AND 1200")
def _(spark, folder):
    items = SampleTables(spark, folder).schedule_items
    return items.where(tm.minute_of_day(F.col("time")).between(8 * 60, 20 * 60)).select("theater_id", "pos", "time")


# ---- joins --------------------------------------------------------------------------------
@query("j01_shows_in_context", """
SELECT s.id AS showing_id, t.name AS theater_name, coalesce(m.fr_title, m.title) AS movie_title FROM showings s JOIN theaters t ON t.id = s.theater_id JOIN movies m ON m.id = s.movie_id""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    return worklist.shows_in_context(t.showings, t.theaters, t.movies, t.screens).select("showing_id", "theater_name", "movie_title")


@query("j02_with_screen_seats", "SELECT s.id AS showing_id, sc.seat_count FROM showings s LEFT JOIN screens sc ON sc.id = s.screen_id")
def _(spark, folder):
    t = SampleTables(spark, folder)
    return worklist.shows_in_context(t.showings, t.theaters, t.movies, t.screens).select("showing_id", "seat_count")


_CELLS = f"""
SELECT movie_id AS film_id, w.id AS weekend_id, seats_sold,
  CASE WHEN sec BETWEEN 39600 AND 50340 THEN '11-14' WHEN sec BETWEEN 50400 AND 64740 THEN '14-18' WHEN sec BETWEEN 64800 AND 73740 THEN '18-2030' WHEN sec BETWEEN 73800 AND 86340 THEN '2030-24' END AS band
FROM (SELECT *, epoch({LOCAL} - date_trunc('day', {LOCAL})) AS sec FROM showings) s JOIN weekends w ON s.date BETWEEN w.start_date AND w.end_date"""


@query("j03_band_and_film_averages", f"""
WITH c AS (SELECT * FROM ({_CELLS}) WHERE band IS NOT NULL)
SELECT b.film_id, b.weekend_id, b.band, round(a.avg_band, 6) AS avg_band, round(f.avg_film, 6) AS avg_film
FROM (SELECT DISTINCT film_id, weekend_id, band FROM c) b
LEFT JOIN (SELECT film_id, weekend_id, band, avg(seats_sold) AS avg_band FROM c WHERE seats_sold IS NOT NULL GROUP BY 1, 2, 3) a USING (film_id, weekend_id, band)
LEFT JOIN (SELECT film_id, weekend_id, avg(seats_sold) AS avg_film FROM c WHERE seats_sold IS NOT NULL GROUP BY 1, 2) f USING (film_id, weekend_id)""")
def _(spark, folder):
    cells = seats.with_averages(seats.banded_weekend(SampleTables(spark, folder).showings))
    return cells.select("film_id", "weekend_id", "band", F.round("avg_band", 6).alias("avg_band"), F.round("avg_film", 6).alias("avg_film"))


@query("a05_average_seats", f"""
SELECT film_id, weekend_id, round(avg(seats_sold), 6) AS avg_seats FROM ({_CELLS}) WHERE band IS NOT NULL AND seats_sold IS NOT NULL GROUP BY 1, 2""")
def _(spark, folder):
    cells = seats.with_averages(seats.banded_weekend(SampleTables(spark, folder).showings))
    film = cells.groupBy("film_id", "weekend_id").agg(F.round(F.max("avg_film"), 6).alias("avg_seats"))
    return film.where(F.col("avg_seats").isNotNull())


@query("a06_filled_seats", f"""
WITH c AS (SELECT * FROM ({_CELLS}) WHERE band IS NOT NULL),
per AS (SELECT film_id, weekend_id, band, coalesce(sum(seats_sold), 0) AS known_sum, count(*) FILTER (WHERE seats_sold IS NULL) AS missing,
  coalesce(avg(seats_sold), (SELECT avg(seats_sold) FROM c f WHERE f.film_id = c.film_id AND f.weekend_id = c.weekend_id)) AS est FROM c GROUP BY film_id, weekend_id, band)
SELECT film_id, weekend_id, round(sum(CASE WHEN missing > 0 AND est IS NULL THEN NULL ELSE known_sum + missing * coalesce(est, 0) END), 6) AS seats, CAST(sum(missing) AS BIGINT) AS missing_cnt FROM per GROUP BY 1, 2""")
def _(spark, folder):
    filled = seats.filled_seats(seats.banded_weekend(SampleTables(spark, folder).showings))
    return filled.withColumn("seats", F.round("seats", 6))


@query("j04_share_of_all", """
SELECT weekend_id, n, round(n / (SELECT count(*) FROM revenues), 6) AS share FROM (SELECT weekend_id, count(*) AS n FROM revenues GROUP BY 1)""")
def _(spark, folder):
    r = SampleTables(spark, folder).revenues
    total = r.agg(row_count()).scalar()
    return r.groupBy("weekend_id").agg(row_count().alias("n")).select("weekend_id", "n", F.round(F.col("n") / total, 6).alias("share"))


@query("j05_shows_in_range", """
SELECT f.film_id, w.id AS weekend_id, count(s.id) AS n FROM (SELECT DISTINCT film_id, weekend_id FROM revenues) f JOIN weekends w ON w.id = f.weekend_id
LEFT JOIN showings s ON s.movie_id = f.film_id AND s.date BETWEEN w.start_date AND w.end_date GROUP BY 1, 2""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    films = t.revenues.select("film_id", "weekend_id").distinct()
    return films.join(features.show_counts(t.showings), ["film_id", "weekend_id"], "left").select(
        "film_id", "weekend_id", F.coalesce("film_cnt", F.lit(0)).alias("n")
    )


@query("j06_films_with_known_seats", "SELECT m.id FROM movies m WHERE EXISTS (SELECT 1 FROM showings s WHERE s.movie_id = m.id AND s.seats_sold IS NOT NULL)")
def _(spark, folder):
    t = SampleTables(spark, folder)
    known = t.showings.where(F.col("seats_sold").isNotNull()).select(F.col("movie_id").alias("id"))
    return t.movies.join(known, "id", "left_semi").select("id")


@query("j07_first_weekend", """
SELECT r.film_id, r.weekend_id, NOT EXISTS (SELECT 1 FROM revenues p WHERE p.film_id = r.film_id AND p.weekend_id < r.weekend_id) AS is_first,
  NOT EXISTS (SELECT 1 FROM revenues p JOIN weekends w ON w.id = p.weekend_id JOIN movies m ON m.id = p.film_id WHERE p.film_id = r.film_id AND p.weekend_id < r.weekend_id AND w.end_date >= m.release_date) AS is_first_real
FROM revenues r""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    return history.had_real_weekend(history.with_previous(t.revenues), t.weekends, t.movies).select(
        "film_id", "weekend_id", F.col("prev_weekend").isNull().alias("is_first"), (~F.col("had_real_weekend")).alias("is_first_real")
    )


@query("j08_films_not_present", """
SELECT DISTINCT movie_id AS film_id FROM showings WHERE movie_id NOT IN (SELECT film_id FROM revenues WHERE weekend_id = 202403)""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    present = t.revenues.where(F.col("weekend_id") == 202403).select("film_id")
    return t.showings.select(F.col("movie_id").alias("film_id")).distinct().join(present, "film_id", "left_anti")


@query("j09_latest_prior", """
SELECT r.film_id, r.weekend_id, (SELECT p.revenue_qc FROM revenues p WHERE p.film_id = r.film_id AND p.weekend_id < r.weekend_id ORDER BY p.weekend_id DESC LIMIT 1) AS prev_rev,
  (SELECT p.cumulatif_qc_to_date FROM revenues p WHERE p.film_id = r.film_id AND p.weekend_id < r.weekend_id ORDER BY p.weekend_id DESC LIMIT 1) AS prev_cumul FROM revenues r""")
def _(spark, folder):
    return history.with_previous(SampleTables(spark, folder).revenues).select("film_id", "weekend_id", "prev_rev", "prev_cumul")


@query("j10_total_by_source", """
SELECT f.film_id, f.weekend_id, coalesce((SELECT r.revenue_qc FROM revenues r WHERE r.film_id = f.film_id AND r.weekend_id = f.weekend_id AND r.data_source = 'cinoche' LIMIT 1),
  (SELECT r.revenue_qc FROM revenues r WHERE r.film_id = f.film_id AND r.weekend_id = f.weekend_id AND r.data_source = 'estimate' LIMIT 1)) AS weekend_total
FROM (SELECT DISTINCT film_id, weekend_id FROM revenues) f""")
def _(spark, folder):
    return rank.weekend_totals(SampleTables(spark, folder).revenues)


# ---- aggregations -------------------------------------------------------------------------
@query("a01_show_counts", """
SELECT s.movie_id AS film_id, w.id AS weekend_id, count(*) AS film_cnt FROM showings s JOIN weekends w ON s.date BETWEEN w.start_date AND w.end_date GROUP BY 1, 2""")
def _(spark, folder):
    return features.show_counts(SampleTables(spark, folder).showings)


@query("a02_filtered_sums", """
SELECT theater_id, sum(seats_sold) FILTER (WHERE screen_id IS NOT NULL) AS with_screen, count(*) FILTER (WHERE seats_sold IS NULL) AS missing_cnt FROM showings GROUP BY 1""")
def _(spark, folder):
    return SampleTables(spark, folder).showings.groupBy("theater_id").agg(
        F.sum(F.when(F.col("screen_id").isNotNull(), F.col("seats_sold"))).alias("with_screen"),
        F.count_if(F.col("seats_sold").isNull()).alias("missing_cnt"),
    )


@query("a07_published_floor", "SELECT min(revenue_qc) AS floor_top10 FROM revenues WHERE weekend_id = 202403 AND data_source = 'cinoche' AND rank BETWEEN 1 AND 10")
def _(spark, folder):
    t = SampleTables(spark, folder)
    return spark.range(1).select(published_floor(t.revenues, Weekend.of(202403)).alias("floor_top10"))


@query("a08_distinct_seat_counts", "SELECT DISTINCT theater_id, seat_count FROM screens WHERE seat_count IS NOT NULL")
def _(spark, folder):
    return SampleTables(spark, folder).screens.where(F.col("seat_count").isNotNull()).select("theater_id", "seat_count").distinct()


@query("a11_seat_grid_counts", """
WITH g AS (SELECT l_orderkey, CASE l_returnflag WHEN 'A' THEN 'occupied' WHEN 'R' THEN 'blocked' ELSE 'free' END AS status, l_linestatus = 'O' AND l_linenumber = 1 AS wheelchair FROM lineitem),
c AS (SELECT l_orderkey, count(*) FILTER (WHERE status <> 'blocked' AND NOT wheelchair) AS sellable, greatest(0, count(*) FILTER (WHERE status = 'occupied') - 1) AS occupied,
  count(*) FILTER (WHERE status = 'blocked') AS blocked, count(*) FILTER (WHERE wheelchair) AS wheelchair FROM g GROUP BY 1)
SELECT l_orderkey, sellable, occupied, sellable - occupied AS remaining, blocked, wheelchair FROM c""")
def _(spark, folder):
    flag = F.col("l_returnflag")
    grid = SampleTables(spark, folder).raw("lineitem").select(
        "l_orderkey",
        F.when(flag == "A", "occupied").when(flag == "R", "blocked").otherwise("free").alias("status"),
        ((F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 1)).alias("wheelchair"),
    )
    return seats.grid_counts(grid, ["l_orderkey"])


@query("a12_remaining_from_probes", """
WITH q AS (SELECT showing_id, candidate AS quantity, ok AND showing_id % 3 <> 0 AS ok FROM probe_outcomes),
a AS (SELECT showing_id, max(quantity) FILTER (WHERE ok) AS accepted FROM q GROUP BY 1)
SELECT a.showing_id, CAST(coalesce(a.accepted + 1, greatest(0, coalesce(CASE WHEN f.true_screen % 2 = 0 THEN f.true_seats END, 301) - 1)) AS INTEGER) AS seats_remaining, a.accepted IS NULL AS fallback
FROM a JOIN showing_facts f ON f.id = a.showing_id""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    outcomes = t.probe_outcomes.select(
        "showing_id", F.col("candidate").alias("quantity"), (F.col("ok") & (F.col("showing_id") % 3 != 0)).alias("ok")
    )
    capacities = t.showing_facts.select(
        F.col("id").alias("showing_id"), F.when(F.col("true_screen") % 2 == 0, F.col("true_seats")).alias("capacity")
    )
    return seats.remaining_from_probes(outcomes, capacities)


# ---- windows, sorts, limits ---------------------------------------------------------------
@query("w01_rank", """
SELECT weekend_id, film_id, CAST(rank() OVER (PARTITION BY weekend_id ORDER BY revenue_qc DESC NULLS LAST, film_id) AS INTEGER) AS rank FROM revenues""")
def _(spark, folder):
    order = Window.partitionBy("weekend_id").orderBy(F.desc_nulls_last("revenue_qc"), "film_id")
    return SampleTables(spark, folder).revenues.select("weekend_id", "film_id", F.rank().over(order).alias("rank"))


@query("w02_first_per_key", """
SELECT theater_id, seat_count, id AS screen_id FROM screens QUALIFY row_number() OVER (PARTITION BY theater_id, seat_count ORDER BY name) = 1""")
def _(spark, folder):
    from reelhouse.operators.match_screen import screen_by_capacity

    return screen_by_capacity(SampleTables(spark, folder).screens)


@query("w03_null_ordering", """
SELECT id, fr_title, CAST(row_number() OVER (PARTITION BY runtime ORDER BY fr_title ASC NULLS LAST, popularity DESC, id) AS INTEGER) AS place,
  CAST(row_number() OVER (PARTITION BY runtime ORDER BY budget ASC NULLS FIRST, id) AS INTEGER) AS by_budget FROM movies""")
def _(spark, folder):
    by_title = Window.partitionBy("runtime").orderBy(F.asc_nulls_last("fr_title"), F.desc("popularity"), "id")
    by_budget = Window.partitionBy("runtime").orderBy(F.asc_nulls_first("budget"), "id")
    return SampleTables(spark, folder).movies.select(
        "id", "fr_title", F.row_number().over(by_title).alias("place"), F.row_number().over(by_budget).alias("by_budget")
    )


@query("w07_provider_priority", """
SELECT showing_id, source, CAST(CASE source WHEN 'cineentreprise' THEN 0 WHEN 'cineplex' THEN 1 WHEN 'cinematheque' THEN 2 WHEN 'webdev' THEN 3 ELSE 99 END AS INTEGER) AS priority FROM measurements""")
def _(spark, folder):
    from reelhouse.operators.providers import priority

    m = SampleTables(spark, folder).measurements
    return m.select("showing_id", "source", priority(F.col("source")).alias("priority")).orderBy("priority", "showing_id")


@query("w08_week_over_week", """
WITH p AS (SELECT r.*, (SELECT q.revenue_qc FROM revenues q WHERE q.film_id = r.film_id AND q.weekend_id < r.weekend_id ORDER BY q.weekend_id DESC LIMIT 1) AS prev,
  EXISTS (SELECT 1 FROM revenues q JOIN weekends w ON w.id = q.weekend_id JOIN movies m ON m.id = q.film_id WHERE q.film_id = r.film_id AND q.weekend_id < r.weekend_id AND w.end_date >= m.release_date) AS real_before FROM revenues r)
SELECT film_id, weekend_id, CASE WHEN NOT real_before OR prev IS NULL OR prev = 0 THEN NULL ELSE least(9999.99, greatest(-9999.99, round((CAST(revenue_qc AS DOUBLE) / prev - 1) * 100, 2))) END AS change_qc FROM p""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    return shown(history.week_over_week(t.revenues, t.weekends, t.movies).select("film_id", "weekend_id", "change_qc"))


@query("w09_running_total", """
SELECT r.film_id, r.weekend_id, CAST((SELECT sum(p.revenue_qc) FROM revenues p WHERE p.film_id = r.film_id AND p.weekend_id <= r.weekend_id) AS BIGINT) AS running_qc FROM revenues r""")
def _(spark, folder):
    return history.running_totals(SampleTables(spark, folder).revenues).select("film_id", "weekend_id", "running_qc")


# ---- set operations -----------------------------------------------------------------------
@query("u01_union_of_targets", """
SELECT DISTINCT movie_id AS film_id FROM showings WHERE movie_id NOT IN (SELECT film_id FROM revenues WHERE weekend_id = 202403)
UNION SELECT film_id FROM revenues WHERE weekend_id = 202403 AND data_source = 'estimate'""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    here = t.revenues.where(F.col("weekend_id") == 202403)
    eligible = t.showings.select(F.col("movie_id").alias("film_id")).join(here.select("film_id"), "film_id", "left_anti")
    return eligible.union(here.where(F.col("data_source") == "estimate").select("film_id")).distinct()


# ---- seats and money ----------------------------------------------------------------------
@query("f22_band_counts", f"""
SELECT band, count(*) AS n FROM (SELECT CASE WHEN sec BETWEEN 39600 AND 50340 THEN '11-14' WHEN sec BETWEEN 50400 AND 64740 THEN '14-18' WHEN sec BETWEEN 64800 AND 73740 THEN '18-2030' WHEN sec BETWEEN 73800 AND 86340 THEN '2030-24' END AS band
  FROM (SELECT epoch({LOCAL} - date_trunc('day', {LOCAL})) AS sec FROM showings)) GROUP BY 1""")
def _(spark, folder):
    s = SampleTables(spark, folder).showings
    return s.groupBy(tm.band(tm.second_of_day(tm.to_local(F.col("start_at")))).alias("band")).agg(row_count().alias("n"))


@query("f23_quiet_hours", f"""
SELECT theater_id, count(*) FILTER (WHERE strftime({LOCAL}, '%H:%M') >= '01:00' AND strftime({LOCAL}, '%H:%M') < '09:30') AS quiet, count(*) AS n FROM showings GROUP BY 1""")
def _(spark, folder):
    s = SampleTables(spark, folder).showings
    return s.groupBy("theater_id").agg(F.count_if(tm.in_quiet_hours(F.col("start_at"))).alias("quiet"), row_count().alias("n"))


@query("f24_seats_sold", """
SELECT showing_id, CAST(greatest(0, least(capacity, capacity - coalesce(seats_remaining, 0))) AS INTEGER) AS clamped, CASE WHEN seats_remaining IS NULL THEN 0 ELSE CAST(greatest(0, capacity - seats_remaining) AS INTEGER) END AS floored FROM measurements""")
def _(spark, folder):
    cap, left = F.col("capacity"), F.col("seats_remaining")
    return SampleTables(spark, folder).measurements.select(
        "showing_id", money.seats_sold_clamped(cap, left).alias("clamped"), money.seats_sold(cap, left).alias("floored")
    )


@query("f25_capped_revenue", """
WITH f AS (SELECT weekend_id, min(revenue_qc) AS fl FROM revenues WHERE data_source = 'cinoche' AND rank BETWEEN 1 AND 10 GROUP BY 1),
s AS (SELECT s.movie_id AS film_id, w.id AS weekend_id, sum(s.seats_sold) AS seats FROM showings s JOIN weekends w ON s.date BETWEEN w.start_date AND w.end_date GROUP BY 1, 2)
SELECT film_id, weekend_id, CASE WHEN seats IS NOT NULL THEN CAST(round(round(greatest(0, least(seats * 14 * 0.7, fl - 10)), 6)) AS BIGINT) END AS revenue,
  CAST(round(round(seats * 14 * 0.7, 6)) AS BIGINT) AS uncapped FROM s LEFT JOIN f USING (weekend_id)""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    r = t.revenues
    floors = r.where((F.col("data_source") == "cinoche") & F.col("rank").between(1, 10)).groupBy("weekend_id").agg(F.min("revenue_qc").alias("fl"))
    sold = features.weekend_showings(t.showings).groupBy(F.col("movie_id").alias("film_id"), "weekend_id").agg(F.sum("seats_sold").alias("seats"))
    return sold.join(floors, "weekend_id", "left").select(
        "film_id", "weekend_id", money.weekend_revenue(F.col("seats"), 14.0, 0.7, F.col("fl")).alias("revenue"),
        money.midweek_revenue(F.col("seats"), 14.0, 0.7).alias("uncapped"),
    )


@query("f26_minutes_apart", """
SELECT w.showing_id, abs((CAST(left(w.time, 2) AS INTEGER) * 60 + CAST(right(w.time, 2) AS INTEGER)) - (extract(hour FROM s.start_at - INTERVAL '5' HOUR) * 60 + extract(minute FROM s.start_at - INTERVAL '5' HOUR))) AS apart
FROM wanted_shows w JOIN showings s ON s.id = w.showing_id""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    real = t.showings.select(F.col("id").alias("showing_id"), tm.hhmm(tm.to_local(F.col("start_at"))).alias("real_time"))
    return t.wanted_shows.join(real, "showing_id").select(
        "showing_id", tm.minutes_apart(F.col("time"), F.col("real_time")).cast("bigint").alias("apart")
    )


@query("f28_provisional_ids", "SELECT id + CASE WHEN id % 10 = 3 THEN 1000000000 ELSE 0 END AS id, id % 10 = 3 AS provisional FROM movies")
def _(spark, folder):
    ids = SampleTables(spark, folder).movies.select((F.col("id") + F.when(F.col("id") % 10 == 3, 1_000_000_000).otherwise(0)).alias("id"))
    return ids.select("id", money.is_provisional(F.col("id")).alias("provisional"))
