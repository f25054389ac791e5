"""Landed pages rendered by Spark from the shared tables, for the extraction queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.functions import time as tm
from reelhouse.sources.sample import SampleTables

SITE = "https://films.example"


def _text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def html(*parts: str | Column) -> Column:
    """Markup from literal text and columns; a NULL column leaves an empty place."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(_text(p), F.lit("")) for p in parts])


def joined(value: Column, order: Column) -> Column:
    """Concatenation of a (small) group of fragments in a given order."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v")))), lambda x: x["v"]), "")


def spaced(amount: Column) -> Column:
    return F.regexp_replace(_text(amount), r"(?<=\d)(?=(\d{3})+$)", " ")


def box_office_pages(t: SampleTables) -> DataFrame:
    """One page per weekend and twenty films, with a local and a short-money section."""
    titles = t.movies.select(F.col("id").alias("film_id"), "title", F.coalesce("fr_title", "title").alias("shown"))
    hundredths = F.floor(F.col("revenue_qc") / 100)
    million = html(F.floor(hundredths / 100), ",", F.lpad(_text(hundredths % 100), 2, "0"), "M$")
    r = t.revenues.join(titles, "film_id")
    original = F.when(F.col("film_id") % 2 == 0, html("(", F.col("title"), " - V.O.A.)"))
    head = html(
        '<tr class="table-row odd"><td><h2 class="movie-title"><a href="/films/f-', F.col("film_id"), '">', F.col("shown"),
        '</a></h2><div class="movie-infos">1 h 45 ', original, "</div></td>",
    )
    qc = html(head, '<td class="is-week-end-total"><span>', spaced(F.col("revenue_qc")), ' $</span></td><td class="is-all-time-total"><span>', spaced(F.col("cumulatif_qc_to_date")), " $</span></td></tr>")
    us = html(head, '<td class="is-week-end-total"><span>', million, '</span></td><td class="is-all-time-total"><span>', million, "</span></td></tr>")
    return r.groupBy("weekend_id", F.floor(F.col("film_id") / 20).alias("page")).agg(
        html(
            '<body><div class="box-office-wrapper box-office-qc-box-office"><table>', joined(qc, F.col("film_id")),
            '</table></div><div class="box-office-wrapper box-office-murica-box-office"><table>', joined(us, F.col("film_id")), "</table></div></body>",
        ).alias("html")
    )


_DAY_NAMES = "lundi mardi mercredi jeudi vendredi samedi dimanche".split()
_MONTH_NAMES = "janvier février mars avril mai juin juillet août septembre octobre novembre décembre".split()


def name_of(names: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), index)


def showtime_pages(t: SampleTables) -> DataFrame:
    """One page per film and week: a tab and a section per day, a theatre item with its times."""
    d = F.col("date")
    names = t.theaters.select(F.col("id").alias("theater_id"), F.col("name").alias("theater"))
    s = t.showings.join(names, "theater_id").withColumn("week", tm.weekend_id(d))
    time = html('<span class="cinema-schedule-movie-time">', F.date_format(tm.to_local(F.col("start_at")), "HH'h'mm"), "</span>")
    items = s.groupBy("movie_id", "week", "date", "theater_id", "theater").agg(
        html(
            '<li class="theater-item"><span class="cinema-schedule-movie-title"><a href="/t/', F.col("theater_id"), '">', F.col("theater"),
            '</a></span><div class="cinema-schedule-movie-subtitle">Groupe ', F.col("theater_id") % 5, " • ", F.col("theater_id") % 12 + 1, " salles</div>",
            joined(time, F.col("start_at")), "</li>",
        ).alias("item")
    )
    days = items.groupBy("movie_id", "week", "date").agg(
        html('<div class="cinema-schedule-movies"><ul class="theaters-items">', joined(F.col("item"), F.col("theater_id")), "</ul></div>").alias("section")
    )
    tab = html(
        '<div class="days-slider-slide"><span class="days-slider-slide-trigger-content"><span class="days-slider-weekday is-not-mobile">',
        name_of(_DAY_NAMES, F.weekday(d) + 1), '</span><span class="days-slider-date">', F.dayofmonth(d),
        '</span><span class="days-slider-month is-not-mobile">', name_of(_MONTH_NAMES, F.month(d)), "</span></span></div>",
    )
    return days.groupBy("movie_id", "week").agg(html("<body>", joined(tab, d), joined(F.col("section"), d), "</body>").alias("html"))


def coming_soon_pages(t: SampleTables) -> DataFrame:
    """One page per twenty films: dated cards, plain links, and month links."""
    key = F.col("id")
    card = html(
        '<div class="movie" data-release-date="', F.col("release_date"), '" data-name="', F.when(key % 2 == 0, F.col("title")),
        '"><a class="movies-element-link" href="/films/f-', key, '"><h3>', F.col("title"), "</h3></a></div>",
    )
    link = html('<a href="/films/f-', key, '" ', F.when(key % 2 == 0, html('title="', F.col("title"), '"')), '><img src="x.png" alt="', F.when(key % 4 == 1, F.col("title")), '">', F.when(key % 4 == 3, F.col("title")), "</a>")
    month = html('<a href="/films/a-venir/', F.date_format("release_date", "yyyy-MM"), '">m</a>')
    return t.movies.groupBy(F.floor(key / 20).alias("page")).agg(
        html("<body>", joined(F.when(key % 3 == 0, link).otherwise(card), key), "<nav>", joined(month, key), "</nav></body>").alias("html")
    )


def film_pages(t: SampleTables) -> DataFrame:
    """One page per film: release date in one of three places, other titles in one of three forms."""
    key, d = F.col("id"), F.col("release_date")
    spoken = html("Sortie partout au Québec : ", F.dayofmonth(d), " ", name_of(_MONTH_NAMES, F.month(d)), " ", F.year(d))
    where = key % 4
    date_part = (
        F.when(where == 0, html('<div class="movie-schedule"><span class="movie-schedule-next">', spoken, "</span></div>"))
        .when(where == 1, html('<div data-release-date="', d, '"></div>'))
        .when(where == 2, html("<p>", spoken, "</p>"))
        .otherwise(F.lit("<p>Prochainement</p>"))
    )
    how = key % 3
    title_part = (
        F.when(how == 0, html('<div class="movie-languages-content">v.o.a. s.-t.f. : ', F.col("title"), "</div>"))
        .when(how == 1, html('<div class="movie-infos">Titre original : ', F.col("title"), "</div>"))
        .otherwise(html('<script type="application/ld+json">{"@type":"Movie","name":"', F.col("fr_title"), '","alternateName":"', F.col("title"), '"}</script>'))
    )
    return t.movies.select(F.col("id").alias("film_id"), html("<html><body><h1>Film</h1>", title_part, date_part, "</body></html>").alias("html"))


def ticket_pages(t: SampleTables) -> DataFrame:
    """One page per theatre, day and time: a schedule row per entry; every third button has no own key."""
    pos = F.col("pos")
    own = html(' href="/FR/Film-achat.awp?P1=01&amp;P3=', F.col("key"), '"')
    row = html(
        '<div><span id="zrl_', pos, '_A37">', F.col("title"), '</span><a id="c-', pos, '-A5" role="button"', F.when(pos % 3 != 0, own), ">", F.replace("time", F.lit(":"), F.lit(" h ")),
        '</a><a id="c-', pos, '-A6" role="button">23 h 30</a><span id="tzzrl_', pos, '_A8" style="display:none">', F.when(pos % 3 == 0, F.col("key")), '</span><span id="tzzrl_', pos, '_A9">9', F.col("key"), "</span></div>",
    )
    return t.schedule_items.groupBy("theater_id", "date", F.col("time").alias("slot")).agg(html("<body>", joined(row, pos), "</body>").alias("html"))


def link_schedule_pages(t: SampleTables) -> DataFrame:
    """One page per theatre, day and time: a heading table and a purchase link per entry."""
    pos = F.col("pos")
    row = html(
        '<table class="h"><tr><td id="zrl_', pos, '_A9">', F.col("title"), " - ", F.col("time"), '</td></tr></table><p><a class="b" href="/FR/Film-achat.awp?P1=01&amp;P2=01&amp;P3=', F.col("key"), '">',
        F.when(pos % 2 == 0, F.replace("time", F.lit(":"), F.lit("h"))).otherwise("Acheter"), "</a></p>",
    )
    return t.schedule_items.groupBy("theater_id", "date", F.col("time").alias("slot")).agg(html("<body>", joined(row, pos), "</body>").alias("html"))


def styled_schedule_pages(t: SampleTables) -> DataFrame:
    """One page per theatre, day and time: entries told by the style of a row in a nested table, with a foreign table before the link."""
    pos = F.col("pos")
    row = html(
        '<TABLE><tr><td><table class=film><tr id=r', pos, '><td style="color:red;margin-bottom:-1px"><b>', F.col("title"), "</b> - ", F.col("time"),
        "</td></tr><tr><td>Salle</td></tr></table></td></tr></TABLE><table class=pub><tr><td>Publicité 10:10</td></tr></table>",
        '<p><a class="b" href="/FR/Film-achat.awp?P1=01&amp;P2=01&amp;P3=', F.col("key"), '"><span>', F.when(pos % 2 == 0, F.replace("time", F.lit(":"), F.lit("h"))).otherwise("Acheter"), "</span></a></p>",
    )
    return t.schedule_items.groupBy("theater_id", "date", F.col("time").alias("slot")).agg(html("<body>", joined(row, pos), "</body>").alias("html"))


def other_site_pages(t: SampleTables) -> DataFrame:
    """One page per theatre, day and time of a site with ids of its own: nested buttons, keys in the cells 10 to 20, a number that is no key in cell 21."""
    pos = F.col("pos")
    row = html(
        "<div id='menu_", pos, "_T'>Menu</div><section><div id='film_", pos, "_T'><i>", F.col("title"), "</i></div><button id='show-", pos, "-2'><div><div>", F.replace("time", F.lit(":"), F.lit(" h ")),
        "</div></div></button><a id='show-", pos, "-3'>12:34</a><div id='show-", pos, "-4' role=button><b>23</b>:30</div><i id=k_", pos, "_N21>77777</i><i id=k_", pos, "_N12>9", F.col("key"), "</i><i id=k_", pos, "_N9>88888</i><i id=k_", pos, "_N10>", F.col("key"), "</i></section>",
    )
    return t.schedule_items.groupBy("theater_id", "date", F.col("time").alias("slot")).agg(html("<body>", joined(row, pos), "</body>").alias("html"))


def purchase_pages(t: SampleTables) -> DataFrame:
    """One purchase page per measured show."""
    m = t.measurements.join(t.showings.select(F.col("id").alias("showing_id"), "start_at"), "showing_id")
    time = F.date_format(tm.to_local(F.col("start_at")), "HH:mm")
    return m.select(
        "showing_id",
        html(
            "<html><style>p{color:red}</style><script>var a = '10:10';</script><body><h1>Le film - ", time, " - Salle ", F.col("capacity") % 20,
            "</h1>| <p>Places disponibles : ", F.when(F.col("seats_remaining") >= 0, F.col("seats_remaining")), "</p></body></html>",
        ).alias("html"),
    )


def seat_grid_pages(t: SampleTables) -> DataFrame:
    """One seat grid per order, a seat per line."""
    flag = F.col("l_returnflag")
    status = F.when(flag == "A", " occupied").when(flag == "R", " blocked").otherwise("")
    wheelchair = F.when((F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 1), " wheelchair")
    seat = html('<div class="seat', status, wheelchair, '"></div>')
    return t.raw("lineitem").groupBy("l_orderkey").agg(html("<body>", joined(seat, F.col("l_linenumber")), "</body>").alias("html"))


def hall_pages(t: SampleTables) -> DataFrame:
    """One card per film and day: times with halls, each listed twice."""
    s = t.block_showings
    hall = F.when(F.col("id") % 3 != 0, html("salle #", F.col("true_screen") % 12)).otherwise("Grand Studio")
    link = html('<a href="#"><span class="hour">', F.date_format("local_start", "H:mm"), '</span> <span class="salle">', hall, "</span></a>")
    twice = joined(F.concat(link, link), F.col("id"))
    return s.groupBy("movie_id", "movie_title", "date").agg(
        html('<div class="list-item"><h2>', F.col("movie_title"), '</h2><div class="schedule-day-grid" data-date="', F.col("date"), '"><div class="show_col_2">', twice, "</div></div></div>").alias("html")
    ).select("movie_id", "html")
