"""Records out of landed pages."""

from pyspark.sql import functions as F

from reelhouse.catalog.queries_tables import shown
from reelhouse.catalog.queries_match import sql_base
from reelhouse.catalog.registry import query
from reelhouse import fixed_values as fv
from reelhouse.functions import text as tx
from reelhouse.functions import time as tm
from reelhouse.operators import seats
from reelhouse.sources import pages, sample_pages
from reelhouse.sources.elements import BlockLocator, Selector
from reelhouse.sources.sample import SampleTables

SITE = sample_pages.SITE

_BOX = """
SELECT r.weekend_id, CAST(floor(r.film_id / 20) AS BIGINT) AS page, CASE WHEN r.film_id % 2 = 0 THEN m.title ELSE coalesce(m.fr_title, m.title) END AS title, coalesce(m.fr_title, m.title) AS fr_title,
  {figure} AS week_end, {cumulative} AS cumulative, concat('https://films.example/films/f-', r.film_id) AS url
FROM revenues r JOIN movies m ON m.id = r.film_id WHERE {figure} <> 0
QUALIFY row_number() OVER (PARTITION BY r.weekend_id, floor(r.film_id / 20), CASE WHEN r.film_id % 2 = 0 THEN m.title ELSE coalesce(m.fr_title, m.title) END ORDER BY r.film_id DESC) = 1"""
BOX_LOCAL = _BOX.format(figure="CAST(r.revenue_qc AS DOUBLE)", cumulative="CAST(r.cumulatif_qc_to_date AS DOUBLE)")
BOX_SHORT = _BOX.format(figure="CAST(floor(r.revenue_qc / 100) * 10000 AS BIGINT)", cumulative="CAST(floor(r.revenue_qc / 100) * 10000 AS BIGINT)")


@query("s06a_box_office", BOX_LOCAL)
def _(spark, folder):
    return pages.box_office(sample_pages.box_office_pages(SampleTables(spark, folder)), "box-office-qc-box-office", False, SITE).drop("pos")


@query("s06a_box_office_short_money", BOX_SHORT)
def _(spark, folder):
    return pages.box_office(sample_pages.box_office_pages(SampleTables(spark, folder)), "box-office-murica-box-office", True, SITE).drop("pos")


@query("s06b_page_links", r"""
WITH a AS (SELECT page_id, unnest(list_zip(regexp_extract_all(html, '(?s)<a\s([^>]*)>(.*?)</a>', 1), regexp_extract_all(html, '(?s)<a\s([^>]*)>(.*?)</a>', 2), range(len(regexp_extract_all(html, '(?s)<a\s([^>]*)>', 0))))) AS z FROM pages),
b AS (SELECT page_id, z[3] AS pos, regexp_replace(regexp_extract(regexp_extract(z[1], 'href="([^"]*)"', 1), '^([^?]*)', 1), '/$', '') AS href, trim(regexp_replace(replace(z[2], '&amp;', '&'), '\s+', ' ', 'g')) AS title FROM a)
SELECT page_id, href, CAST(pos AS INTEGER) AS pos, title FROM b WHERE regexp_matches(href, '^/[^/?#]+$') QUALIFY row_number() OVER (PARTITION BY page_id, href ORDER BY pos) = 1""")
def _(spark, folder):
    real = SampleTables(spark, folder).raw("pages").select("page_id", "html")
    return pages.film_links(real, "^/[^/?#]+$").select("page_id", "href", "pos", "title")


SHOWTIMES = """
SELECT s.movie_id, CAST(isoyear(s.date) * 100 + week(s.date) AS INTEGER) AS week,
  concat(['lundi','mardi','mercredi','jeudi','vendredi','samedi','dimanche'][isodow(s.date)], ' ', day(s.date), ' ', CASE month(s.date) WHEN 12 THEN 'décembre' ELSE 'janvier' END) AS day_label,
  CAST(s.date AS VARCHAR) AS date, regexp_replace(t.name, '\\s+', ' ', 'g') AS theater, concat('Groupe ', t.id % 5) AS company, CAST(t.id % 12 + 1 AS INTEGER) AS screens,
  string_agg(strftime(s.start_at - INTERVAL '5' HOUR, '%Hh%M'), ',' ORDER BY s.start_at) AS times
FROM showings s JOIN theaters t ON t.id = s.theater_id GROUP BY s.movie_id, s.date, t.id, t.name"""


@query("s06c_showtimes", SHOWTIMES)
def _(spark, folder):
    # the labels carry no year; most days lie in January 2024, the first local night in December 2023
    blocks = pages.showtime_blocks(sample_pages.showtime_pages(SampleTables(spark, folder)))
    seen = F.when(F.col("week") < 202400, "2023-12-31").otherwise("2024-01-31").cast("date")
    december = F.contains("day_label", F.lit("décembre"))
    day = tm.french_day_month(F.col("day_label"), F.when(december, F.lit("2023-12-31").cast("date")).otherwise(seen))
    return shown(blocks.select("movie_id", "week", "day_label", day.alias("date"), "theater", "company", "screens", F.array_join("times", ",").alias("times")))


@query("s06d_coming_soon", """
SELECT CAST(floor(id / 20) AS BIGINT) AS page, concat('https://films.example/films/f-', id) AS href, title, CASE WHEN id % 3 <> 0 THEN CAST(release_date AS VARCHAR) END AS release_date FROM movies""")
def _(spark, folder):
    return shown(pages.coming_soon(sample_pages.coming_soon_pages(SampleTables(spark, folder)), SITE))


@query("s06d_month_links", "SELECT DISTINCT CAST(floor(id / 20) AS BIGINT) AS page, strftime(release_date, '%Y-%m') AS month FROM movies")
def _(spark, folder):
    return pages.month_links(sample_pages.coming_soon_pages(SampleTables(spark, folder)))


@query("s06e_release_dates", "SELECT id AS film_id, CASE WHEN id % 4 <> 3 THEN CAST(release_date AS VARCHAR) END AS release_date FROM movies")
def _(spark, folder):
    return shown(pages.release_dates(sample_pages.film_pages(SampleTables(spark, folder))))


@query("s06f_alternate_titles", "SELECT id AS film_id, CASE WHEN id % 3 = 1 THEN split_part(title || CASE id % 4 WHEN 0 THEN concat(' Sortie partout au Québec : ', day(release_date), ' ', CASE month(release_date) WHEN 12 THEN 'décembre' ELSE 'janvier' END, ' ', year(release_date)) WHEN 2 THEN concat(' Sortie partout au Québec : ', day(release_date), ' ', CASE month(release_date) WHEN 12 THEN 'décembre' ELSE 'janvier' END, ' ', year(release_date)) WHEN 3 THEN ' Prochainement' ELSE '' END, '#', 1) ELSE title END AS titles FROM movies")
def _(spark, folder):
    found = pages.alternate_titles(sample_pages.film_pages(SampleTables(spark, folder)))
    return found.select("film_id", F.array_join("titles", "#").alias("titles"))


@query("s06f_original_titles", "SELECT id AS film_id, CASE WHEN id % 3 <> 0 THEN title END AS original_title FROM movies")
def _(spark, folder):
    return pages.original_titles(sample_pages.film_pages(SampleTables(spark, folder)))


_TICKET_ROWS = """
SELECT theater_id, CAST(date AS VARCHAR) AS date, CAST(pos AS VARCHAR) AS row, trim(title) AS title, time, key, concat('https://tickets.example/FR/Film-achat.awp?P1=01&P2=01&P3=', key) AS url FROM schedule_items
UNION ALL SELECT theater_id, CAST(date AS VARCHAR), CAST(pos AS VARCHAR), trim(title), '23:30', concat('9', key), concat('https://tickets.example/FR/Film-achat.awp?P1=01&P2=01&P3=9', key) FROM schedule_items"""
TICKET_SPEC = pages.TicketSpec("https://tickets.example/FR/Film-achat.awp?P1=01&P2=01", clean_title=tx.without_markup_remains)


@query("s06g_ticket_rows", _TICKET_ROWS)
def _(spark, folder):
    rows = pages.ticket_rows(sample_pages.ticket_pages(SampleTables(spark, folder)), TICKET_SPEC)
    return shown(rows.select("theater_id", "date", "row", "title", "time", "key", "url"))


_LINK_SCHEDULE = f"""
WITH e AS (SELECT *, trim(regexp_replace(trim(regexp_replace(regexp_replace(title, '(?i)\\b(VF|VO|VOA|VOSTA|VOSTFR|FR|ENG|IMAX|ATMOS|4DX|3D|2D)\\b', ' ', 'g'), '\\s+', ' ', 'g')), '[|,;:\\-]\\s*$', '')) AS shown FROM schedule_items)
SELECT theater_id, CAST(date AS VARCHAR) AS date, shown AS title, time, concat('https://tickets.example/FR/Film-achat.awp?P1=01&P2=01&P3=', key) AS url FROM e
QUALIFY row_number() OVER (PARTITION BY theater_id, date, time, {sql_base('shown')} ORDER BY pos) = 1"""


@query("s06g_link_schedule", _LINK_SCHEDULE)
def _(spark, folder):
    spec = pages.LinkScheduleSpec("https://tickets.example/FR/Film-achat.awp")
    rows = pages.link_schedule(sample_pages.link_schedule_pages(SampleTables(spark, folder)), spec)
    return shown(rows.select("theater_id", "date", "title", "time", "url"))


@query("s06g_purchase_headers", """
SELECT m.showing_id, concat('Salle ', m.capacity % 20) AS auditorium, CASE WHEN m.seats_remaining >= 0 THEN m.seats_remaining END AS seats_remaining, strftime(s.start_at - INTERVAL '5' HOUR, '%H:%M') AS time
FROM measurements m JOIN showings s ON s.id = m.showing_id""")
def _(spark, folder):
    return pages.purchase_headers(sample_pages.purchase_pages(SampleTables(spark, folder)))


@query("s06g_seat_grid", """
SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag <> 'R' AND NOT (l_linestatus = 'O' AND l_linenumber = 1)) AS sellable, greatest(0, count(*) FILTER (WHERE l_returnflag = 'A') - 1) AS occupied,
  count(*) FILTER (WHERE l_returnflag <> 'R' AND NOT (l_linestatus = 'O' AND l_linenumber = 1)) - greatest(0, count(*) FILTER (WHERE l_returnflag = 'A') - 1) AS remaining,
  count(*) FILTER (WHERE l_returnflag = 'R') AS blocked, count(*) FILTER (WHERE l_linestatus = 'O' AND l_linenumber = 1) AS wheelchair FROM lineitem GROUP BY 1""")
def _(spark, folder):
    grid = pages.seat_elements(sample_pages.seat_grid_pages(SampleTables(spark, folder)))
    return seats.grid_counts(grid, ["l_orderkey"])


@query("s06g_hall_schedule", """
SELECT DISTINCT movie_id, movie_title AS movie, CAST(date AS VARCHAR) AS date, strftime(local_start, '%H:%M') AS time, CASE WHEN id % 3 <> 0 THEN concat('Salle ', true_screen % 12) ELSE 'Grand Studio' END AS salle FROM block_showings""")
def _(spark, folder):
    return pages.hall_schedule(sample_pages.hall_pages(SampleTables(spark, folder)))


@query("x01_title_hook", """
SELECT theater_id, CAST(date AS VARCHAR) AS date, CAST(pos AS VARCHAR) AS row, upper(trim(title)) AS title, unnest([time, '23:30']) AS time FROM schedule_items""")
def _(spark, folder):
    shouting = pages.TicketSpec("https://tickets.example/FR/Film-achat.awp?P1=01&P2=01", clean_title=F.upper)
    rows = pages.ticket_rows(sample_pages.ticket_pages(SampleTables(spark, folder)), shouting)
    return shown(rows.select("theater_id", "date", "row", "title", "time"))


@query("x02_site_profile", """
SELECT theater_id, CAST(date AS VARCHAR) AS date, CAST(pos AS VARCHAR) AS row, trim(title) AS title, unnest([time, '23:30']) AS time FROM schedule_items""")
def _(spark, folder):
    # a site that keeps its titles in another cell, and something else where they usually are
    moved = F.regexp_replace("html", 'id="zrl_([0-9]+)_A37">', "id='zrl_$1_A37'>Menu</span><span id='tzzrl_$1_A12'>")
    landed = sample_pages.ticket_pages(SampleTables(spark, folder)).withColumn("html", moved)
    rows = pages.ticket_rows(landed, pages.TicketSpec("https://tickets.example/FR/Film-achat.awp?P1=01&P2=01", title_cells=("tzzrl_{row}_A12",)))
    return shown(rows.select("theater_id", "date", "row", "title", "time"))


@query("x01_block_locator", _LINK_SCHEDULE)
def _(spark, folder):
    # a site whose film rows are told by their style
    locator = BlockLocator(fv.STYLE_ANCHORS, fv.STYLED_HEADING, expand="row")
    spec = pages.LinkScheduleSpec("https://tickets.example/FR/Film-achat.awp", clean_title=tx.without_markup_remains, locator=locator)
    rows = pages.link_schedule(sample_pages.styled_schedule_pages(SampleTables(spark, folder)), spec)
    return shown(rows.select("theater_id", "date", "title", "time", "url"))


@query("x02_site_selectors", _TICKET_ROWS)
def _(spark, folder):
    # a site that differs in rows, titles, buttons and hidden keys
    spec = pages.TicketSpec(
        "https://tickets.example/FR/Film-achat.awp?P1=01&P2=01", title_cells=("film_{row}_T",), rows=("film_{row}_T",), cells=("film_{row}_T",), clean_title=tx.without_markup_remains,
        buttons=(Selector("show-{row}-{cell}", tag="button"), Selector("show-{row}-*", role="button")), hidden_keys=("k_{row}_N{cell}",), hidden_range=(10, 20),
    )
    rows = pages.ticket_rows(sample_pages.other_site_pages(SampleTables(spark, folder)), spec)
    return shown(rows.select("theater_id", "date", "row", "title", "time", "key", "url"))
