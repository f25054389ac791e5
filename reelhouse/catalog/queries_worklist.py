"""Work list, provider lookup, completeness monitor, prefill."""

from pyspark.sql import functions as F

from reelhouse.catalog.queries_match import sql_title_key, sql_words
from reelhouse.catalog.queries_merge import AS_OF, as_of
from reelhouse.catalog.queries_tables import shown
from reelhouse.catalog.queries_weekend import BIAS, PRICE, WEEKEND, estimate_steps, weekend_estimate_query
from reelhouse.catalog.registry import query
from reelhouse.operators import providers
from reelhouse.plans import monitor, prefill, worklist
from reelhouse.sources.sample import SampleTables

_PROVIDED = """
SELECT *, CASE WHEN k IN ('cinema beaubien', 'cinema rgfm beloeil', 'cinema magog') THEN 'webdev' WHEN k = 'cinema banque scotia' THEN 'cineplex'
    WHEN k LIKE '%cinematheque%' THEN 'cinematheque' WHEN k = 'cinema elysee (granby)' THEN 'cineentreprise' WHEN regexp_matches(k, '\\bcineplex\\b') THEN 'cineplex' END AS provider
FROM (SELECT *, trim(regexp_replace(lower(strip_accents(name)), '\\s+', ' ', 'g')) AS k FROM theaters)"""


@query("j22_provider_lookup", f"""
SELECT id, name, provider, CASE k WHEN 'cinema beaubien' THEN 'displayingSeats' WHEN 'cinema rgfm beloeil' THEN 'notDisplayingSeats' WHEN 'cinema magog' THEN 'notDisplayingSeats' END AS kind FROM ({_PROVIDED})""")
def _(spark, folder):
    name = F.col("name")
    return SampleTables(spark, folder).theaters.select(
        "id", "name", providers.provider_of(name).alias("provider"), providers.ticketing_kind(name).alias("kind")
    )


_WORK = f"""WITH open AS (
  SELECT s.id AS showing_id, s.movie_id, s.theater_id, t.name AS theater_name, t.provider, coalesce(m.fr_title, m.title) AS movie_title, s.start_at, sc.seat_count, s.purchase_url, t.theater_api_id, t.showings_url,
    CASE WHEN t.k = 'cinema beaubien' THEN 729 WHEN t.provider = 'webdev' THEN 825 WHEN t.provider = 'cineplex' THEN 750 WHEN t.provider = 'cinematheque' THEN -420 WHEN t.provider = 'cineentreprise' THEN -435 ELSE 720 END AS a,
    CASE WHEN t.k = 'cinema beaubien' THEN 900 WHEN t.provider = 'webdev' THEN 1005 WHEN t.provider = 'cineplex' THEN 930 WHEN t.provider = 'cinematheque' THEN -60 WHEN t.provider = 'cineentreprise' THEN 0 ELSE 1020 END AS b
  FROM showings s JOIN ({_PROVIDED}) t ON t.id = s.theater_id JOIN movies m ON m.id = s.movie_id LEFT JOIN screens sc ON sc.id = s.screen_id
  WHERE s.seats_sold IS NULL AND s.start_at BETWEEN TIMESTAMP '{AS_OF}' - INTERVAL '15' MINUTE AND TIMESTAMP '{AS_OF}' + INTERVAL '4' HOUR)
"""


@query("q05_work_list", _WORK + f"""
SELECT showing_id, movie_id, theater_id, theater_name, movie_title, provider, CAST(CASE provider WHEN 'cineentreprise' THEN 0 WHEN 'cineplex' THEN 1 WHEN 'cinematheque' THEN 2 WHEN 'webdev' THEN 3 ELSE 99 END AS INTEGER) AS priority,
  strftime(start_at - INTERVAL '5' HOUR, '%Y-%m-%d') AS local_date, strftime(start_at - INTERVAL '5' HOUR, '%H:%M') AS local_time,
  strftime(start_at + to_seconds(a), '%Y-%m-%d %H:%M:%S') AS window_start, strftime(start_at + to_seconds(b), '%Y-%m-%d %H:%M:%S') AS window_end, seat_count, purchase_url
FROM open WHERE provider IS NOT NULL AND (provider <> 'cineplex' OR (theater_api_id IS NOT NULL AND showings_url IS NOT NULL)) AND TIMESTAMP '{AS_OF}' <= start_at + to_seconds(b)""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    return shown(worklist.work_list(t.showings, t.theaters, t.movies, t.screens, as_of()))


@query("t06_unmapped_side_output", _WORK + "SELECT showing_id, theater_name, 'unmapped_theater' AS error FROM open WHERE provider IS NULL")
def _(spark, folder):
    t = SampleTables(spark, folder)
    return worklist.unmapped(t.showings, t.theaters, t.movies, t.screens, as_of())


@query("t01_measuring_windows", f"""
SELECT id, CASE WHEN k = 'cinema beaubien' THEN 729 WHEN provider = 'webdev' THEN 825 WHEN provider = 'cineplex' THEN 750 WHEN provider = 'cinematheque' THEN -420 WHEN provider = 'cineentreprise' THEN -435 ELSE 720 END AS first_second,
  CASE WHEN k = 'cinema beaubien' THEN 900 WHEN provider = 'webdev' THEN 1005 WHEN provider = 'cineplex' THEN 930 WHEN provider = 'cinematheque' THEN -60 WHEN provider = 'cineentreprise' THEN 0 ELSE 1020 END AS last_second
FROM ({_PROVIDED})""")
def _(spark, folder):
    t = SampleTables(spark, folder).theaters
    first, last = providers.measuring_window(providers.provider_of(F.col("name")), F.col("name"))
    return t.select("id", first.alias("first_second"), last.alias("last_second"))


_RECENT = f"""FROM showings s JOIN theaters t ON t.id = s.theater_id
WHERE s.start_at < TIMESTAMP '{AS_OF}' AND s.start_at > TIMESTAMP '{AS_OF}' - INTERVAL '40' HOUR AND t.name LIKE '%Cineplex%'"""


@query("a10_missing_data_summary", f"""
SELECT count(*) AS total_shows, count(*) FILTER (WHERE s.seats_sold IS NULL) AS missing_shows,
  round(count(*) FILTER (WHERE s.seats_sold IS NULL) / count(*), 4) AS missing_share,
  count(*) > 0 AND count(*) FILTER (WHERE s.seats_sold IS NULL) / count(*) >= 0.2 AND NOT strftime(TIMESTAMP '{AS_OF}' - INTERVAL '5' HOUR, '%H:%M') BETWEEN '01:00' AND '09:29' AS alert {_RECENT}""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    return monitor.missing_data_summary(t.showings, t.theaters, as_of(), hours=40, threshold=0.2)


@query("q07_missing_data_report", f"""
SELECT s.id AS showing_id, strftime(s.start_at, '%Y-%m-%d %H:%M:%S') AS start_at, (SELECT coalesce(m.fr_title, m.title) FROM movies m WHERE m.id = s.movie_id) AS movie_title, t.name AS theater_name, t.id AS theater_id
{_RECENT} AND s.seats_sold IS NULL""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    return shown(monitor.missing_data_detail(t.showings, t.theaters, t.movies, as_of(), hours=40))


@query("k04_missing_data_alert_rows", f"""
WITH r AS (SELECT t.name AS theater_name, s.seats_sold {_RECENT}),
c AS (SELECT theater_name, count(*) AS total_shows, count(*) FILTER (WHERE seats_sold IS NULL) AS missing_shows FROM r GROUP BY 1)
SELECT 'all' AS theater_name, CAST(sum(total_shows) AS BIGINT) AS total_shows, CAST(sum(missing_shows) AS BIGINT) AS missing_shows FROM c HAVING sum(missing_shows) / sum(total_shows) >= 0.1
UNION ALL SELECT * FROM c WHERE missing_shows > 0 AND (SELECT sum(missing_shows) / sum(total_shows) FROM c) >= 0.1""".replace(AS_OF, "2024-01-15 18:00:00"))
def _(spark, folder):
    t = SampleTables(spark, folder)
    at = F.lit("2024-01-15 18:00:00").cast("timestamp_ntz")
    return monitor.missing_data_alert(t.showings, t.theaters, t.movies, at, hours=40, threshold=0.1)


@query("t08_sliding_completeness", """
WITH w AS (SELECT s.seats_sold, date_trunc('hour', s.start_at) - to_hours(CAST(k AS BIGINT)) AS window_start FROM showings s, range(5) r(k))
SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(window_start + INTERVAL '5' HOUR, '%Y-%m-%d %H:%M:%S') AS window_end, count(*) AS total_shows,
  count(*) FILTER (WHERE seats_sold IS NULL) AS missing_shows, count(*) FILTER (WHERE seats_sold IS NULL) / count(*) >= 0.7 AS alert FROM w GROUP BY 1, 2""")
def _(spark, folder):
    return shown(monitor.sliding_completeness(SampleTables(spark, folder).showings))


_AFTER_MERGE = estimate_steps(WEEKEND, PRICE, BIAS) + """SELECT film_id, weekend_id, data_source, average_showing_occupancy, showings_proportion FROM final"""


@query("a17_estimates_without_features", f"""
SELECT weekend_id, count(*) FILTER (WHERE average_showing_occupancy IS NULL OR showings_proportion IS NULL) AS n_null FROM (
{_AFTER_MERGE}) GROUP BY 1""")
def _(spark, folder):
    return monitor.estimates_without_features(weekend_estimate_query(spark, folder))


@query("a17_feature_sample", f"""
SELECT film_id, showings_proportion, average_showing_occupancy FROM ({_AFTER_MERGE})
ORDER BY showings_proportion NULLS FIRST, average_showing_occupancy NULLS FIRST, film_id LIMIT 10""")
def _(spark, folder):
    return monitor.feature_sample(weekend_estimate_query(spark, folder))


_HIDDEN = "'Cinéma RGFM Beloeil', 'CINEMA  MAGOG'"


@query("a09_furthest_days", f"""
SELECT s.theater_id, s.movie_id, CAST(least(max(CAST(s.start_at AS DATE)), CAST(TIMESTAMP '{AS_OF}' - INTERVAL '5' HOUR AS DATE) + 14) AS VARCHAR) AS end_date
FROM showings s WHERE s.screen_id IS NULL AND s.start_at >= TIMESTAMP '{AS_OF}' GROUP BY 1, 2""")
def _(spark, folder):
    s = SampleTables(spark, folder).showings
    return shown(prefill.furthest_days(s.where(F.col("screen_id").isNull() & (F.col("start_at") >= as_of())), as_of()))


@query("a13_accepted_capacity", "SELECT showing_id, max(candidate) AS capacity FROM probe_outcomes WHERE ok GROUP BY 1")
def _(spark, folder):
    return prefill.accepted_capacity(SampleTables(spark, folder).probe_outcomes)


@query("q08_prefill", f"""
WITH shows AS (SELECT b.id, b.movie_id, b.theater_id, b.screen_id, b.local_start + INTERVAL '5' HOUR AS start_at, b.local_start, b.date,
    CASE WHEN b.id % 5 = 2 THEN concat('https://tickets.example/Film-achat.awp?P1=01&P2=01&P3=', 100000 + b.id - 7) END AS purchase_url FROM block_showings b),
work AS (
  SELECT s.*, t.name, coalesce(m.fr_title, m.title) AS title, m.title AS sort_title,
    least(max(CAST(s.start_at AS DATE)) OVER (PARTITION BY s.theater_id, s.movie_id), DATE '2024-01-15' + 14) AS end_date
  FROM shows s JOIN theaters t ON t.id = s.theater_id JOIN movies m ON m.id = s.movie_id
  WHERE s.screen_id IS NULL AND s.start_at >= TIMESTAMP '{AS_OF}' AND t.name IN ({_HIDDEN})),
pairs AS (
  SELECT w.id, w.theater_id, w.name, w.sort_title, w.start_at, strftime(w.local_start, '%H:%M') AS time, i.pos, i.url, {sql_title_key('w.title')} AS wk, {sql_title_key('i.title')} AS ek
  FROM work w JOIN schedule_items i ON i.theater_id = w.theater_id AND i.date = w.date AND i.time = strftime(w.local_start, '%H:%M')
  WHERE w.purchase_url IS NULL AND w.date BETWEEN DATE '2024-01-15' AND w.end_date),
scored AS (SELECT *, replace(ek, ' ', '') <> '' AND (contains(replace(wk, ' ', ''), replace(ek, ' ', '')) OR contains(replace(ek, ' ', ''), replace(wk, ' ', ''))) AS held,
  len(list_filter({sql_words('ek')}, lambda x: list_contains({sql_words('wk')}, x))) AS shared FROM pairs),
picks AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY id ORDER BY CASE WHEN held THEN 1 WHEN shared >= 2 THEN 2 ELSE 3 END, CASE WHEN NOT held AND shared >= 2 THEN -shared ELSE 0 END, pos) = 1),
free AS (SELECT * FROM picks p WHERE NOT EXISTS (SELECT 1 FROM shows s WHERE s.theater_id = p.theater_id AND s.id <> p.id AND s.purchase_url = p.url AND strftime(s.local_start, '%H:%M') = p.time)
  QUALIFY row_number() OVER (PARTITION BY theater_id, url, time ORDER BY name, sort_title, start_at, id) = 1),
cap AS (SELECT showing_id AS id, max(candidate) AS capacity FROM probe_outcomes WHERE ok GROUP BY 1),
found AS (SELECT w.id, w.end_date, sc.id AS screen_id FROM work w JOIN cap c USING (id) LEFT JOIN free f USING (id) JOIN screens sc ON sc.theater_id = w.theater_id
  WHERE w.purchase_url IS NOT NULL OR f.id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY w.id ORDER BY CASE WHEN sc.seat_count = c.capacity THEN 0 WHEN sc.seat_count > c.capacity THEN 1 ELSE 2 END, abs(sc.seat_count - c.capacity), sc.name) = 1)
SELECT s.id, coalesce(s.purchase_url, f.url) AS purchase_url,
  CASE WHEN s.screen_id IS NULL AND s.start_at BETWEEN TIMESTAMP '{AS_OF}' AND x.end_date + INTERVAL '1' DAY - INTERVAL '1' SECOND THEN x.screen_id ELSE s.screen_id END AS screen_id
FROM shows s LEFT JOIN free f USING (id) LEFT JOIN found x USING (id)""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    key = F.col("id")
    url = F.concat(F.lit("https://tickets.example/Film-achat.awp?P1=01&P2=01&P3="), (100000 + key - 7).cast("string"))
    shows = t.block_showings.select(
        "id", "movie_id", "theater_id", "screen_id", (F.col("local_start") + F.expr("interval 5 hours")).alias("start_at"), "date",
        F.when(key % 5 == 2, url).alias("purchase_url"),
    )
    return prefill.prefill(
        shows, t.theaters, t.movies, t.screens, t.schedule_items, t.probe_outcomes, as_of()
    ).select("id", "purchase_url", "screen_id")


@query("x03_registered_theaters", """
SELECT id, CASE WHEN n_nationkey IN (3, 11) THEN 'notDisplayingSeats' WHEN n_nationkey = 1 THEN 'displayingSeats' END AS kind,
  CASE WHEN n_nationkey IN (3, 11) THEN 'https://b.example' WHEN n_nationkey = 1 THEN 'https://a.example' END AS site, CAST(CASE WHEN n_nationkey = 1 THEN 600 END AS INTEGER) AS first, CAST(CASE WHEN n_nationkey = 1 THEN 900 END AS INTEGER) AS last
FROM theaters JOIN nation ON n_nationkey = id""")
def _(spark, folder):
    sites = [
        providers.Registration(["Cinema Beaubien"], "https://a.example/FR/horaire?P1=01", "https://a.example/FR/achat", window=(600, 900)),
        providers.Registration(["Cinéma Rgfm Beloeil", "Cinéma Magog"], "https://b.example/FR/horaire", "https://b.example/FR/achat", kind="no-seats"),
    ]
    registered = providers.registry(spark, sites)
    return providers.with_registration(SampleTables(spark, folder).theaters, registered).select("id", "kind", "site", "first", "last")
