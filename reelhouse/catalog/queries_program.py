"""Program, announced films, weekly load, reports."""

from pyspark.sql import functions as F

from reelhouse.catalog.queries_match import sql_squish
from reelhouse.catalog.queries_pages import BOX_LOCAL, BOX_SHORT, SITE
from reelhouse.catalog.queries_tables import shown
from reelhouse.catalog.registry import query
from reelhouse.functions import text as tx
from reelhouse.session import written
from reelhouse.plans import program, rank, reports, upcoming, weekly_load
from reelhouse.sources import pages, sample_pages
from reelhouse.sources.sample import SampleTables
from reelhouse.sources.sinks import CSV_OPTIONS


def listings(t: SampleTables):
    """Running films are those shown before mid-month, announced ones all films of the films table."""
    href = lambda c: F.concat(F.lit("/films/f-"), F.col(c).cast("string"), F.lit("/?p=1"))
    early = t.showings.where(F.col("date") < "2024-01-15").select(F.col("movie_id").alias("id")).distinct()
    now = early.join(t.movies, "id").select(href("id").alias("href"), "title", F.col("id").alias("pos"))
    soon = t.movies.select(href("id").alias("href"), F.coalesce("fr_title", "title").alias("title"), F.col("id").alias("pos"))
    return now, soon


_LISTING = """
SELECT m.id, concat('/films/f-', m.id) AS href, CASE WHEN n.id IS NOT NULL THEN m.title ELSE coalesce(m.fr_title, m.title) END AS title, CASE WHEN n.id IS NOT NULL THEN 'now' ELSE 'upcoming' END AS source
FROM movies m LEFT JOIN (SELECT DISTINCT movie_id AS id FROM showings WHERE date < DATE '2024-01-15') n ON n.id = m.id"""


@query("j21_merged_listings", f"SELECT href, title, source FROM ({_LISTING})")
def _(spark, folder):
    return program.merge_listings(*listings(SampleTables(spark, folder))).select("href", "title", "source")


def program_blocks(t: SampleTables):
    """Show blocks read from the showtime pages; the year of a label is that of its page."""
    blocks = pages.showtime_blocks(sample_pages.showtime_pages(t))
    year_end = F.when(F.contains("day_label", F.lit("décembre")), "2023-12-31").otherwise("2024-01-31").cast("date")
    href = F.concat(F.lit("/films/f-"), F.col("movie_id").cast("string"))
    return program.normalised_blocks(blocks.withColumn("href", href), year_end)


_TOTALS = """
SELECT movie_id AS id, count(DISTINCT concat(date, '|', theater_id, '|', strftime(start_at - INTERVAL '5' HOUR, '%H:%M'))) AS total, min(year(date)) AS year_hint FROM showings GROUP BY 1"""


@query("a14_show_totals", f"SELECT concat('/films/f-', id) AS href, CAST(total AS BIGINT) AS total FROM ({_TOTALS})")
def _(spark, folder):
    return program.show_totals(program_blocks(SampleTables(spark, folder))).select("href", "total")


@query("a15_year_hints", f"SELECT concat('/films/f-', id) AS href, CAST(year_hint AS INTEGER) AS year_hint FROM ({_TOTALS})")
def _(spark, folder):
    return program.show_totals(program_blocks(SampleTables(spark, folder))).select("href", "year_hint")


@query("p08_enough_shows", f"""
SELECT l.href, l.title, l.source, CAST(t.total AS BIGINT) AS total FROM ({_LISTING}) l JOIN ({_TOTALS}) t USING (id) WHERE t.total >= CASE WHEN l.source = 'now' THEN 70 ELSE 40 END""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    listing = program.merge_listings(*listings(t))
    return program.build_program(listing, program_blocks(t), 70, 40).select("href", "title", "source", "total")


@query("q10_program_showings", """
SELECT s.movie_id, t.id AS theater_id, strftime(date_trunc('minute', s.start_at), '%Y-%m-%d %H:%M:%S') AS start_at, CAST(s.date AS VARCHAR) AS date
FROM showings s JOIN theaters t ON t.id = s.theater_id GROUP BY ALL""".replace("FROM showings s JOIN theaters t ON t.id = s.theater_id", f"FROM showings s JOIN (SELECT id, regexp_replace(name, '\\s+', ' ', 'g') AS n FROM theaters) t ON t.id = s.theater_id JOIN ({_TOTALS}) x ON x.id = s.movie_id JOIN ({_LISTING}) l ON l.id = s.movie_id WHERE x.total >= CASE WHEN l.source = 'now' THEN 5 ELSE 1 END"))
def _(spark, folder):
    t = SampleTables(spark, folder)
    blocks = written(program_blocks(t), "show-blocks")
    chosen = program.build_program(program.merge_listings(*listings(t)), blocks)
    films = chosen.select("href", F.regexp_extract("href", "([0-9]+)$", 1).cast("bigint").alias("film_id"))
    tidy = t.theaters.withColumn("name", tx.collapse_space(F.col("name")))
    _, rows = program.program_showings(chosen, blocks, films, tidy)
    return shown(rows)


@query("x02_search_titles", f"""
SELECT concat('/films/f-', l.id) AS href, concat('F ', l.id) || '#' || l.title AS queries, CAST(t.year_hint AS INTEGER) AS year_hint FROM ({_LISTING}) l JOIN ({_TOTALS}) t USING (id)""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    chosen = program.build_program(program.merge_listings(*listings(t)), program_blocks(t), 1, 1)
    wants = program.search_titles(program.film_wants(chosen))
    return wants.select("href", F.array_join("queries", "#").alias("queries"), "year_hint")


def month_pages(t: SampleTables):
    month = F.date_format(F.add_months(F.lit("2024-01-01").cast("date"), (F.col("page") % 8).cast("int")), "yyyy-MM")
    return sample_pages.coming_soon_pages(t).select(month.alias("month"), "html")


_ANNOUNCED = """SELECT id, concat('https://films.example/films/f-', id) AS href, title, CASE WHEN id % 3 <> 0 THEN CAST(release_date AS VARCHAR) END AS release_date, CAST(floor(id / 20) AS BIGINT) % 8 AS k FROM movies"""


def january():
    return F.lit("2024-01-31").cast("date")


@query("q11_near_films", f"SELECT href, title, release_date FROM ({_ANNOUNCED}) WHERE k IN (0, 1)")
def _(spark, folder):
    return shown(upcoming.near_films(month_pages(SampleTables(spark, folder)), january(), SITE))


@query("q11_later_films", f"SELECT href, title, release_date FROM ({_ANNOUNCED}) WHERE k > 1")
def _(spark, folder):
    t = SampleTables(spark, folder)
    months = month_pages(t).select("month").distinct()
    return shown(upcoming.later_films(month_pages(t), january(), SITE, months))


@query("u02_union_by_address", f"SELECT href, title FROM ({_ANNOUNCED})")
def _(spark, folder):
    t = SampleTables(spark, folder)
    near = upcoming.near_films(month_pages(t), january(), SITE)
    later = upcoming.later_films(month_pages(t), january(), SITE)
    again = near.unionByName(later).unionByName(near)
    return again.groupBy("href").agg(F.min("title").alias("title"))


@query("a16_lookahead_outcomes", f"""
SELECT CASE WHEN title IN (SELECT title FROM movies UNION SELECT fr_title FROM movies WHERE fr_title IS NOT NULL) THEN 'updated' ELSE 'inserted' END AS outcome, count(*) AS n FROM (SELECT * REPLACE (CASE WHEN id % 3 = 0 THEN concat(title, ' bis') ELSE title END AS title) FROM ({_ANNOUNCED})) WHERE k > 1 GROUP BY 1""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    films = upcoming.later_films(month_pages(t), january(), SITE)
    unknown = F.regexp_extract("href", "([0-9]+)$", 1).cast("bigint") % 3 == 0
    films = films.withColumn("title", F.when(unknown, F.concat("title", F.lit(" bis"))).otherwise(F.col("title")))
    return upcoming.outcomes(films, t.movies).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query("q12_published_load", f"""
WITH loc AS (SELECT weekend_id, page, title, fr_title, CAST(week_end AS BIGINT) AS revenue_qc, CAST(cumulative AS BIGINT) AS cumulatif_qc_to_date, CAST(regexp_extract(url, '([0-9]+)$', 1) AS BIGINT) AS pos FROM ({BOX_LOCAL})),
one AS (SELECT * FROM loc QUALIFY row_number() OVER (PARTITION BY weekend_id, title ORDER BY pos DESC) = 1),
us AS (SELECT weekend_id, title, week_end, cumulative FROM ({BOX_SHORT}) QUALIFY row_number() OVER (PARTITION BY weekend_id, title ORDER BY CAST(regexp_extract(url, '([0-9]+)$', 1) AS BIGINT) DESC) = 1),
v AS (SELECT DISTINCT title, title AS q FROM one),
d AS (SELECT v.*, s.so, s.step FROM v CROSS JOIN (VALUES (0, 0), (1, 1), (2, -1), (3, 2), (4, -2)) s(so, step)),
h AS (SELECT d.title, d.so, r.id, r.pos, r.genre = 99 AS doc, nullif(TRY_CAST(left(r.release_date, 4) AS INTEGER), 0) AS ry, d.step, {sql_squish('r.title')} AS tn, {sql_squish('r.original_title')} AS onn, {sql_squish('d.title')} AS qn, r.popularity
  FROM d JOIN search_results r ON r.query = d.q AND r.year = 2024 + d.step),
ok AS (SELECT *, CASE WHEN tn = qn OR onn = qn THEN 100 WHEN contains(tn, qn) OR contains(onn, qn) THEN 25 ELSE 0 END + CASE WHEN ry = 2024 THEN 40 WHEN abs(ry - 2024) <= 1 THEN 20 ELSE 0 END + popularity / 10 AS score
  FROM h WHERE abs(ry - (2024 + step)) <= 1),
f AS (SELECT title, id AS film_id FROM ok QUALIFY row_number() OVER (PARTITION BY title ORDER BY doc, so, score DESC, pos) = 1)
SELECT f.film_id, o.weekend_id, o.title, o.revenue_qc, o.cumulatif_qc_to_date, CAST(us.week_end AS BIGINT) AS revenue_us, CAST(us.cumulative AS BIGINT) AS cumulatif_us_to_date
FROM one o JOIN f USING (title) LEFT JOIN us ON us.weekend_id = o.weekend_id AND us.title = o.title
QUALIFY row_number() OVER (PARTITION BY f.film_id, o.weekend_id ORDER BY o.pos DESC) = 1""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    landed = sample_pages.box_office_pages(t)

    def weekend_rows(section, short):
        rows = pages.box_office(landed, section, short, SITE)
        order = F.regexp_extract("url", "([0-9]+)$", 1).cast("bigint")
        best = F.max(F.struct(order.alias("pos"), "fr_title", "week_end", "cumulative", "url"))
        return rows.groupBy("weekend_id", "title").agg(best.alias("r")).select("weekend_id", "title", "r.*")

    figures = weekly_load.published_figures(
        weekend_rows("box-office-qc-box-office", False), weekend_rows("box-office-murica-box-office", True), t.search_results, 2024
    )
    return figures.select("film_id", "weekend_id", "title", "revenue_qc", "cumulatif_qc_to_date", "revenue_us", "cumulatif_us_to_date")


_DAYS = """
SELECT user_id AS film_id, CAST(isoyear(d) * 100 + week(d) AS INTEGER) AS weekend_id, d AS date, isodow(d) = 4 AS preview, CASE WHEN user_id % 4 = 0 AND isodow(d) = 5 THEN 'cinoche' ELSE 'estimate' END AS data_source,
  CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS revenue_qc FROM (SELECT *, CAST(ts - INTERVAL '5' HOUR AS DATE) AS d FROM events) WHERE isodow(d) >= 4 GROUP BY 1, 3"""


@query("q03_rank_by_day_rows", f"""
WITH r AS ({_DAYS}), films AS (SELECT DISTINCT film_id, weekend_id FROM r),
tot AS (SELECT f.*, coalesce((SELECT max(revenue_qc) FROM r WHERE r.film_id = f.film_id AND r.weekend_id = f.weekend_id AND data_source = 'cinoche'),
  (SELECT sum(revenue_qc) FROM r WHERE r.film_id = f.film_id AND r.weekend_id = f.weekend_id AND data_source = 'estimate' AND NOT preview AND date IS NOT NULL)) AS weekend_total FROM films f),
c AS (SELECT f.film_id, f.weekend_id, count(s.id) AS show_count FROM films f JOIN weekends w ON w.id = f.weekend_id LEFT JOIN showings s ON s.movie_id = f.film_id AND (s.date BETWEEN w.start_date AND w.end_date
  OR (s.date = w.start_date - 1 AND NOT EXISTS (SELECT 1 FROM showings p WHERE p.movie_id = f.film_id AND p.date < w.start_date))) GROUP BY 1, 2)
SELECT film_id, weekend_id, CAST(weekend_total AS BIGINT) AS weekend_total, show_count, CAST(rank() OVER (PARTITION BY weekend_id ORDER BY weekend_total DESC NULLS LAST, show_count DESC, film_id) AS INTEGER) AS rank FROM tot JOIN c USING (film_id, weekend_id)""")
def _(spark, folder):
    from reelhouse.functions import time as tm

    t = SampleTables(spark, folder)
    d = F.col("date")
    rows = (
        t.raw("events").withColumn("date", tm.local_date(F.col("ts"))).where(F.weekday("date") >= 3)
        .groupBy(F.col("user_id").alias("film_id"), "date").agg(F.sum(F.floor("value")).alias("revenue_qc"))
        .select(
            "film_id", tm.weekend_id(d).alias("weekend_id"), "date", (F.weekday("date") == 3).alias("preview"),
            F.when((F.col("film_id") % 4 == 0) & (F.weekday("date") == 4), "cinoche").otherwise("estimate").alias("data_source"), "revenue_qc",
        )
    )
    return rank.rank_weekends_by_day_rows(rows, t.showings)


_CENSUS = """
SELECT t.name AS theater_name, CAST(s.date AS VARCHAR) AS date, coalesce(m.fr_title, m.title) AS title, strftime(s.start_at - INTERVAL '5' HOUR, '%H:%M') AS time,
  CASE WHEN s.id % 5 > 1 THEN concat('Salle ', x.capacity % 20) END AS auditorium, CASE WHEN s.id % 5 > 1 AND x.seats_remaining >= 0 THEN x.seats_remaining END AS seats_remaining,
  CASE WHEN s.id % 5 > 1 THEN 'ok' ELSE 'fail' END AS status, CASE s.id % 5 WHEN 0 THEN 'timeout' WHEN 1 THEN 'HTTP 500, "busy"' END AS error
FROM showings s JOIN theaters t ON t.id = s.theater_id JOIN movies m ON m.id = s.movie_id JOIN measurements x ON x.showing_id = s.id"""


def census_rows(t: SampleTables):
    from reelhouse.functions import time as tm
    from reelhouse.plans.worklist import shows_in_context

    url = F.concat(F.lit("https://tickets.example/"), F.col("showing_id").cast("string"))
    local = tm.to_local(F.col("start_at"))
    shows = shows_in_context(t.showings, t.theaters, t.movies, t.screens).select(
        "theater_name", local.cast("date").cast("string").alias("date"), F.col("movie_title").alias("title"), tm.hhmm(local).alias("time"), url.alias("url")
    )
    kind = F.col("showing_id") % 5
    answers = sample_pages.purchase_pages(t).select(
        url.alias("url"), F.when(kind > 1, F.col("html")).alias("html"),
        F.when(kind == 0, "timeout").when(kind == 1, 'HTTP 500, "busy"').alias("error"),
    )
    return reports.census(shows, answers)


@query("q13_census", _CENSUS)
def _(spark, folder):
    return census_rows(SampleTables(spark, folder))


@query("a16_census_counts", f"SELECT status, count(*) AS n FROM ({_CENSUS}) GROUP BY 1")
def _(spark, folder):
    return reports.status_counts(census_rows(SampleTables(spark, folder)))


@query("k01_census_lines", f"""
SELECT concat_ws(',', theater_name, date, title, time, coalesce(auditorium, ''), coalesce(CAST(seats_remaining AS VARCHAR), ''), status, CASE WHEN error LIKE '%,%' THEN concat('"', replace(error, '"', '""'), '"') ELSE coalesce(error, '') END) AS line FROM ({_CENSUS})""")
def _(spark, folder):
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "header"}
    rows = census_rows(SampleTables(spark, folder)).select(*reports.CENSUS_COLUMNS)
    return rows.select(F.to_csv(F.struct(*reports.CENSUS_COLUMNS), options).alias("line"))


_PROBES = """
SELECT w.theater_id AS theater, CAST(w.date AS VARCHAR) AS date, w.showing_id AS seq, w.title, w.time, concat('https://tickets.example/', w.showing_id // 2) AS url,
  CASE WHEN w.showing_id % 7 = 0 THEN NULL ELSE CAST(w.showing_id % 200 AS INTEGER) END AS seats_remaining, w.showing_id % 31 = 0 AS seat_map,
  CASE w.showing_id % 29 WHEN 0 THEN 'cutoff' WHEN 1 THEN 'timeout' WHEN 2 THEN 'refused' END AS failure FROM wanted_shows w"""
_PROBE_REPORT = f"""
WITH p AS ({_PROBES}),
x AS (SELECT * FROM p WHERE CAST(left(time, 2) AS INTEGER) * 60 BETWEEN 480 AND 1200 QUALIFY row_number() OVER (PARTITION BY theater, date, title, time, url ORDER BY seq) = 1),
y AS (SELECT *, min(CASE WHEN seat_map OR failure IN ('cutoff', 'timeout') THEN seq END) OVER (PARTITION BY theater, date, title) AS stop FROM x)
SELECT theater, date, title AS movie, time, url AS schedule_url, CASE WHEN coalesce(seq > stop, false) OR failure IS NOT NULL THEN NULL ELSE seats_remaining END AS seats_remaining,
  CASE WHEN coalesce(seq > stop, false) OR failure IS NOT NULL THEN NULL ELSE concat('c', seq) END AS confirm_url,
  CASE WHEN seq > stop THEN 'skipped_after_force_skip' WHEN failure = 'cutoff' THEN 'probe_error:force_skip' WHEN failure = 'timeout' THEN 'probe_error:timeout' WHEN failure IS NOT NULL THEN concat('probe_error:', failure)
    WHEN seat_map THEN 'provider_seatmap_detected' WHEN seats_remaining IS NULL THEN 'no_seats_number' END AS match_notes FROM y"""


def probe_report(t: SampleTables):
    key = F.col("showing_id")
    probes = t.wanted_shows.select(
        F.col("theater_id").alias("theater"), F.col("date").cast("string").alias("date"), key.alias("seq"), "title", "time",
        F.concat(F.lit("https://tickets.example/"), F.floor(key / 2).cast("string")).alias("url"),
        F.when(key % 7 != 0, (key % 200).cast("int")).alias("seats_remaining"), (key % 31 == 0).alias("seat_map"),
        F.when(key % 29 == 0, "cutoff").when(key % 29 == 1, "timeout").when(key % 29 == 2, "refused").alias("failure"),
        F.concat(F.lit("c"), key.cast("string")).alias("confirm_url"),
    )
    return reports.window_probe(probes, "08:00", "20:00")


@query("q14_window_probe", _PROBE_REPORT)
def _(spark, folder):
    return probe_report(SampleTables(spark, folder))


@query("k02_probe_lines", f"""
SELECT concat_ws(',', CAST(theater AS VARCHAR), date, movie, time, coalesce(CAST(seats_remaining AS VARCHAR), ''), coalesce(confirm_url, ''), schedule_url, coalesce(match_notes, '')) AS line FROM ({_PROBE_REPORT})""")
def _(spark, folder):
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "header"}
    return probe_report(SampleTables(spark, folder)).select(F.to_csv(F.struct(*reports.PROBE_COLUMNS), options).alias("line"))


@query("k03_nested_schedule", """
SELECT movie_title AS movie, CAST(date AS VARCHAR) AS date, string_agg(DISTINCT concat(strftime(local_start, '%H:%M'), ' ', CASE WHEN id % 3 <> 0 THEN concat('Salle ', true_screen % 12) ELSE 'Grand Studio' END), ','
  ORDER BY concat(strftime(local_start, '%H:%M'), ' ', CASE WHEN id % 3 <> 0 THEN concat('Salle ', true_screen % 12) ELSE 'Grand Studio' END)) AS shows FROM block_showings GROUP BY 1, 2""")
def _(spark, folder):
    shows = pages.hall_schedule(sample_pages.hall_pages(SampleTables(spark, folder)))
    nested = reports.nested_schedule(shows)
    texts = F.array_sort(F.transform("shows", lambda s: F.concat_ws(" ", s["time"], s["salle"])))
    return nested.select("movie", F.explode("schedule").alias("date", "shows")).select("movie", "date", F.array_join(texts, ",").alias("shows"))
