"""Landed web pages to records.

A page table (url, source, fetched_at, html) goes through one job per record kind. A
RecordSpec names the blocks of a page and the column expression of every field; the blocks
are exploded with their position, so order-dependent rules stay possible.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse import fixed_values as fv
from reelhouse.functions import money
from reelhouse.functions import text as tx
from reelhouse.functions import time as tm
from reelhouse.sources.elements import BlockLocator, Selector, any_fits, elements, id_patterns, located_links, with_id

FieldOf = Callable[[Column], Column]


@dataclass(frozen=True)
class RecordSpec:
    """How one kind of record lies in a page."""

    blocks: FieldOf
    fields: dict[str, FieldOf]
    keep: Callable[[], Column] = field(default=lambda: F.lit(True))


def extract(pages: DataFrame, spec: RecordSpec, html: str = "html") -> DataFrame:
    rest = [c for c in pages.columns if c != html]
    blocks = pages.select(*rest, F.posexplode(spec.blocks(F.col(html))).alias("pos", "block"))
    return blocks.select(*rest, "pos", *[f(F.col("block")).alias(n) for n, f in spec.fields.items()]).where(spec.keep())


# ---- pieces of markup ---------------------------------------------------------------------
def with_class(name: str) -> str:
    """Pattern of an opening tag that carries a class, whichever way its value is quoted."""
    quoted = "|".join(f"{q}(?:[^{q}]*\\s)?{name}(?:\\s[^{q}]*)?{q}" for q in "\"'")
    return f"<[a-zA-Z][^>]*\\sclass\\s*=\\s*(?:{quoted}|{name}(?=[\\s>]))[^>]*>"


def all_of(html: Column, p: str, group: int = 0) -> Column:
    return F.regexp_extract_all(html, F.lit(p), F.lit(group))


def pieces_after(html: Column, opening: str) -> Column:
    """Page cut at every opening tag: one piece from each tag to the next."""
    cut = F.split(html, f"(?={opening})")
    return F.filter(cut, lambda p: F.rlike(p, F.lit(f"^{opening}")))


def attribute(tag: Column, name: str) -> Column:
    """Value of an attribute in double, single or no quotes."""
    value = F.regexp_extract(tag, f"(?i)[\\s\"']{name}\\s*=\\s*(\"[^\"]*\"|'[^']*'|[^\\s\"'>]+)", 1)
    return F.nullif(tx.trim_space(tx.decode_entities(F.regexp_replace(value, "^[\"']|[\"']$", ""))), F.lit(""))


def inner_text(html: Column) -> Column:
    return tx.once(tx.plain_text(html), lambda t: F.when(t != "", t))


def text_in(html: Column, opening: str, tag: str) -> Column:
    """Text from an opening tag to the end tag of that kind."""
    return inner_text(F.regexp_extract(html, f"(?s){opening}(.*?)</{tag}>", 1))


def first_text(*options: Column) -> Column:
    return F.coalesce(*options)


# ---- box-office tables --------------------------------------------------------------------
def box_office_spec(section: str, short_money: bool, site: str) -> RecordSpec:
    """Rows of one section. Figures are whole amounts, or short money text such as '1,23M$'."""
    opening = with_class(section)
    amount = money.money_text if short_money else money.plain_amount

    def section_rows(html: Column) -> Column:
        body = F.regexp_extract(html, f"(?s){opening}(.*?)(?:{with_class(fv.BOX_OFFICE_SECTION)}|$)", 1)
        return all_of(body, f"(?s){with_class(fv.BOX_OFFICE_ROW)}.*?</tr>")

    def title(row: Column) -> Column:
        return text_in(row, f"<h2[^>]*{fv.FILM_TITLE}[^>]*>", "h2")

    def original(row: Column) -> Column:
        infos = F.coalesce(text_in(row, with_class(fv.FILM_INFO), "div"), F.lit(""))
        return F.nullif(tx.trim_space(F.regexp_extract(infos, tx.pattern(fv.ORIGINAL_TITLE_IN_INFO), 1)), F.lit(""))

    def total(name: str) -> FieldOf:
        return lambda row: amount(F.coalesce(text_in(row, with_class(name) + r"\s*<span[^>]*>", "span"), F.lit("")))

    def address(row: Column) -> Column:
        href = F.regexp_extract(row, f'(?s)<h2[^>]*{fv.FILM_TITLE}[^>]*>.*?<a[^>]*href="([^"]*)"', 1)
        return F.when(href.startswith("http"), href).otherwise(F.concat(F.lit(site), href))

    return RecordSpec(
        section_rows,
        {
            "title": lambda r: F.coalesce(original(r), title(r)),
            "fr_title": title,
            "week_end": total(fv.WEEKEND_TOTAL),
            "cumulative": total(fv.ALL_TIME_TOTAL),
            "url": address,
        },
        lambda: F.col("title").isNotNull() & (F.col("week_end") != 0),
    )


def box_office(pages: DataFrame, section: str, short_money: bool, site: str) -> DataFrame:
    """Figures per page and title; of repeated titles the last."""
    rest = [c for c in pages.columns if c != "html"]
    rows = extract(pages, box_office_spec(section, short_money, site))
    return (
        rows.groupBy(*rest, "title")
        .agg(F.max(F.struct("pos", "fr_title", "week_end", "cumulative", "url")).alias("r"))
        .select(*rest, "title", "r.*")
    )


# ---- film links ---------------------------------------------------------------------------
def link_spec(href_pattern: str) -> RecordSpec:
    """Links whose address fits; the title is the title attribute, image text, link text or the slug."""
    href = lambda a: tx.canonical_href(F.coalesce(attribute(a, "href"), F.lit("")))
    opening = lambda a: F.regexp_extract(a, "^(<a[^>]*>)", 1)
    image = lambda a: F.regexp_extract(a, "(<img[^>]*>)", 1)
    return RecordSpec(
        lambda html: all_of(html, r"(?s)<a\s[^>]*>.*?</a>"),
        {
            "href": lambda a: href(opening(a)),
            "title": lambda a: F.coalesce(
                attribute(opening(a), "title"), attribute(image(a), "alt"), inner_text(a), tx.slug_title(href(opening(a)))
            ),
        },
        lambda: F.rlike("href", F.lit(href_pattern)),
    )


def film_links(pages: DataFrame, href_pattern: str = "^/films/[^/]+$") -> DataFrame:
    """Distinct film addresses of every page with the first title seen."""
    rest = [c for c in pages.columns if c != "html"]
    links = extract(pages, link_spec(href_pattern))
    return links.groupBy(*rest, "href").agg(F.min(F.struct("pos", "title")).alias("f")).select(
        *rest, "href", F.col("f.pos").alias("pos"), F.col("f.title").alias("title")
    )


# ---- showtimes ----------------------------------------------------------------------------
def showtime_blocks(pages: DataFrame) -> DataFrame:
    """One row per day and theatre: day label, theatre, chain, screens, list of time texts.

    The i-th day label belongs to the i-th schedule section.
    """
    rest = [c for c in pages.columns if c != "html"]

    def label(slide: Column) -> Column:
        parts = [text_in(slide, with_class(part), "span") for part in fv.DAY_PARTS]
        return F.nullif(F.concat_ws(" ", *parts), F.lit(""))

    labels = F.transform(pieces_after(F.col("html"), with_class(fv.DAY_TAB)), label)
    sections = pieces_after(F.col("html"), with_class(fv.DAY_SECTION))
    days = pages.select(*rest, labels.alias("label"), sections.alias("section")).select(
        *rest, F.posexplode(F.arrays_zip("label", "section")).alias("day", "d")
    )
    theaters = days.select(
        *rest, F.col("d.label").alias("day_label"), "day",
        F.posexplode(pieces_after(F.col("d.section"), with_class(fv.THEATER_ITEM))).alias("item", "theater_html"),
    )
    html = F.col("theater_html")
    titles = [text_in(html, with_class(c), "a") for c in (fv.THEATER_TITLE, *fv.OTHER_THEATER_TITLES)]
    name = F.coalesce(*titles, text_in(html, r"<a\s[^>]*>", "a"))
    subtitles = [text_in(html, with_class(c), "div") for c in (fv.THEATER_SUBTITLE, *fv.OTHER_THEATER_SUBTITLES)]
    tells = [tx.once(x, lambda t: F.when(F.rlike(t, F.lit("(?i)salle")), t)) for x in (*subtitles, inner_text(html))]
    subtitle = F.coalesce(*tells, F.lit(""))
    show_time = with_class("(?:" + "|".join((fv.SHOW_TIME, *fv.OTHER_SHOW_TIMES)) + ")")
    times = F.transform(all_of(html, f"(?s){show_time}(.*?)</", 1), tx.plain_text)
    read = theaters.select(
        *rest, "day", "item", "day_label", F.coalesce(name, F.lit("")).alias("theater"), subtitle.alias("subtitle"), times.alias("times")
    )
    chain, count = tx.chain_and_screens(F.col("subtitle"))
    return read.select(
        *rest, "day", "item", "day_label", "theater", chain.alias("company"), count.alias("screens"),
        F.array_remove("times", "").alias("times"),
    )


# ---- coming soon --------------------------------------------------------------------------
def coming_soon(pages: DataFrame, site: str) -> DataFrame:
    """Announced films with their date: dated entries first, then further film links; first per address."""
    rest = [c for c in pages.columns if c != "html"]
    absolute = lambda h: F.when(h.startswith("http"), h).otherwise(F.concat(F.lit(site), h))
    link = rf'(?s)(<a\s[^>]*class="[^"]*{fv.FILM_LINK}[^"]*"[^>]*>.*?</a>)'
    dated = RecordSpec(
        lambda html: pieces_after(html, r'<[a-zA-Z][^>]*\sdata-release-date="[^"]*"[^>]*>'),
        {
            "href": lambda p: attribute(F.regexp_extract(p, link, 1), "href"),
            "title": lambda p: F.coalesce(
                attribute(F.regexp_extract(p, "^(<[^>]*>)", 1), "data-name"),
                text_in(F.regexp_extract(p, link, 1), "<h3[^>]*>", "h3"),
                attribute(F.regexp_extract(p, link, 1), "title"),
            ),
            "release_date": lambda p: attribute(F.regexp_extract(p, "^(<[^>]*>)", 1), "data-release-date"),
        },
        lambda: F.col("href").isNotNull() & F.col("title").isNotNull(),
    )
    entries = extract(pages, dated).select(*rest, F.lit(0).alias("kind"), "pos", absolute(F.col("href")).alias("href"), "title", "release_date")
    plain = extract(pages, link_spec("^/films/[^/?#]+$")).select(
        *rest, F.lit(1).alias("kind"), "pos", absolute(F.col("href")).alias("href"), "title", F.lit(None).cast("string").alias("release_date")
    )
    return (
        entries.unionByName(plain)
        .groupBy(*rest, "href")
        .agg(F.min(F.struct("kind", "pos", "title", "release_date")).alias("f"))
        .select(*rest, "href", F.col("f.title").alias("title"), F.col("f.release_date").try_cast("date").alias("release_date"))
    )


def month_links(pages: DataFrame) -> DataFrame:
    """Distinct 'YYYY-MM' labels a page links to or names in its month attributes."""
    html = F.col("html")
    found = F.concat(
        all_of(html, r'href="[^"]*/films/a-venir/([0-9]{4}-[0-9]{2})', 1),
        all_of(html, r'data-(?:month|date)="([0-9]{4}-[0-9]{2})"', 1),
    )
    rest = [c for c in pages.columns if c != "html"]
    return pages.select(*rest, F.explode(found).alias("month")).distinct()


# ---- film pages ---------------------------------------------------------------------------
def release_dates(pages: DataFrame) -> DataFrame:
    """Release date of a film page: schedule text, else the data attribute, else anywhere in the text."""
    rest = [c for c in pages.columns if c != "html"]
    html = F.col("html")
    body = F.coalesce(F.nullif(F.regexp_extract(html, "(?s)<body[^>]*>(.*)", 1), F.lit("")), html)
    schedule = F.array_join(
        F.transform(all_of(html, f"(?s){with_class(fv.RELEASE_NOTE)}(.*?)</span>", 1), tx.plain_text), "\n"
    )
    by_attribute = F.regexp_extract(html, 'data-release-date="([0-9]{4}-[0-9]{2}-[0-9]{2})"', 1)
    return pages.select(
        *rest,
        F.coalesce(
            tm.french_date(schedule, "sortie"), by_attribute.try_cast("date"), tm.french_date(tx.plain_text(body), "sortie")
        ).alias("release_date"),
    )


def _linked_data(html: Column) -> Column:
    """Film nodes of the JSON-LD scripts of a page (each an object or a list)."""
    scripts = all_of(html, r'(?s)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>', 1)
    nodes = F.flatten(
        F.transform(scripts, lambda s: F.from_json(s, "array<struct<`@type`:string,name:string,alternateName:string>>"))
    )
    return F.filter(nodes, lambda n: n["@type"].isin("Movie", "CreativeWork"))


def alternate_titles(pages: DataFrame) -> DataFrame:
    """Every other-language title a film page states: language lines, 'titre original', JSON-LD."""
    rest = [c for c in pages.columns if c != "html"]
    html = F.col("html")
    lines = F.transform(all_of(html, f"(?s){with_class(fv.LANGUAGE_LINES)}(.*?)</div>", 1), tx.plain_text)
    by_line = F.transform(lines, lambda x: F.regexp_extract(x, tx.pattern(fv.LANGUAGE_TITLE), 1))
    body = F.coalesce(F.nullif(F.regexp_extract(html, "(?s)<body[^>]*>(.*)", 1), F.lit("")), html)
    by_label = F.regexp_extract(tx.plain_text(body), tx.pattern(fv.ORIGINAL_TITLE_LABEL), 1)
    by_data = F.transform(_linked_data(html), lambda n: F.coalesce(F.nullif(n["alternateName"], F.lit("")), n["name"], F.lit("")))
    titles = tx.without_blanks(F.concat(by_line, F.array(by_label), F.coalesce(by_data, F.array().cast("array<string>"))))
    return pages.select(*rest, titles.alias("titles"))


def original_titles(pages: DataFrame) -> DataFrame:
    """The first usable original title: labelled text, '(title - V.O.A.)' in a header, JSON-LD."""
    rest = [c for c in pages.columns if c != "html"]
    html = F.col("html")
    info = F.coalesce(text_in(html, with_class(fv.FILM_INFO), "div"), F.lit(""))
    labelled = tx.title_candidate(F.regexp_extract(info, tx.pattern(fv.ORIGINAL_TITLE_LABEL), 1))
    definition = tx.title_candidate(
        F.coalesce(inner_text(F.regexp_extract(html, r"(?is)<(?:dt|th)[^>]*>\s*titre original.*?</(?:dt|th)>\s*<(?:dd|td)[^>]*>(.*?)</(?:dd|td)>", 1)), F.lit(""))
    )
    header = tx.title_candidate(F.regexp_extract(info, r"\(([^()]+?)\s*-\s*V\.?O\.?A\.?[^)]*\)", 1))
    by_data = F.filter(
        F.transform(_linked_data(html), lambda n: tx.title_candidate(F.coalesce(n["alternateName"], F.lit("")))), lambda t: t.isNotNull()
    )
    return pages.select(*rest, F.coalesce(labelled, definition, header, F.get(by_data, F.lit(0))).alias("original_title"))


# ---- ticketing schedules ------------------------------------------------------------------
@dataclass(frozen=True)
class TicketSpec:
    """Per-site parts of a row schedule.

    `rows` names what makes a row exist, `title_cells` the ids of titles in order of preference, `buttons` the shows, and
    `hidden_keys` the cells with keys, of those with numbers within `hidden_range`. `cells` are all cells that may hold a
    title where none of `title_cells` does.
    """

    purchase_url: str
    title_cells: tuple[str, ...] = fv.TITLE_CELLS
    clean_title: FieldOf = lambda t: t
    buttons: tuple[Selector, ...] = tuple(Selector(i, tag, role) for i in fv.BUTTON_IDS for tag, role in (("a", None), (None, "button")))
    hidden_keys: tuple[str, ...] = fv.HIDDEN_KEY_CELLS
    hidden_range: tuple[int, int] = fv.HIDDEN_SCAN_RANGE
    cells: tuple[str, ...] = fv.SCHEDULE_CELLS
    rows: tuple[str, ...] = fv.SCHEDULE_CELLS


def ticket_rows(pages: DataFrame, spec: TicketSpec) -> DataFrame:
    """Schedule rows: title, time and purchase address.

    A button without its own key takes the next hidden key of its row, in the order of the cell numbers. Cells are grouped
    by page and row, so a page of any length costs its cells once.
    """
    rest = [c for c in pages.columns if c != "html"]
    hidden, rows_of = [Selector(i) for i in spec.hidden_keys], [Selector(i) for i in spec.rows]
    known = list(dict.fromkeys([*map(Selector, spec.title_cells), *spec.buttons, *hidden, *map(Selector, spec.cells), *rows_of]))
    found = elements(pages, with_id(known))
    role = F.lower(attribute(F.col("opening"), "role")) if any(s.role for s in spec.buttons) else F.lit(None).cast("string")
    found = found.select(*rest, "at", "name", "opening", attribute(F.col("opening"), "id").alias("id"), role.alias("role"), tx.trim_space(tx.decode_entities(F.col("text"))).alias("text"))
    found = found.withColumn("ids", id_patterns(known, F.col("id")))
    # read once per cell; what is named twice in one step is worked out twice
    found = found.withColumn("time", F.when(F.rlike("text", F.lit("[0-9]")), tm.schedule_time(F.col("text"))))
    low, high = spec.hidden_range
    places = [F.when(F.col("ids")[s.pattern] & s.cell(F.col("id")).between(low, high), F.struct(s.cell(F.col("id")).alias("number"), F.lit(i).alias("form"), F.col("text").alias("key"))) for i, s in enumerate(hidden)]
    this = {n: F.col(n) for n in ("ids", "name", "role")}
    cells = found.select(
        *rest, F.coalesce(*[F.when(F.col("ids")[p], s.row(F.col("id"))) for p, s in {s.pattern: s for s in known}.items()]).alias("row"),
        F.struct(
            "at", "id", "text", F.col("opening").alias("tag"), "time", any_fits(rows_of, this).alias("makes_row"),
            any_fits(map(Selector, spec.cells), this).alias("plain"), (any_fits(spec.buttons, this) & F.col("time").isNotNull()).alias("button"),
            F.when(F.rlike("text", F.lit(fv.HIDDEN_KEY)), F.coalesce(*places)).alias("hidden"),
        ).alias("cell"),
    )
    rows = cells.groupBy(*rest, "row").agg(F.array_sort(F.collect_list("cell")).alias("mine")).where(F.exists("mine", lambda c: c["makes_row"]))
    keyless = lambda c: F.coalesce(tx.url_param(attribute(c["tag"], "href"), "P3"), F.lit("")) == ""
    title_ids = [F.replace(F.lit(t), F.lit("{row}"), F.col("row")) for t in spec.title_cells]

    def first_text(fits: FieldOf) -> Column:
        return F.nullif(F.get(F.filter("mine", fits), F.lit(0))["text"], F.lit(""))

    titled = lambda i: first_text(lambda c: c["id"] == i)
    any_cell = first_text(lambda c: c["plain"] & ~F.rlike(c["text"], F.lit(fv.HIDDEN_KEY)) & c["time"].isNull() & (c["text"] != ""))
    prepared = rows.select(
        *rest, "row",
        F.coalesce(*map(titled, title_ids), any_cell).alias("raw_title"),
        F.filter("mine", lambda c: c["button"]).alias("buttons"),
        F.transform(F.array_sort(F.transform(F.filter("mine", lambda c: c["hidden"].isNotNull()), lambda c: c["hidden"])), lambda h: h["key"]).alias("keys"),
    )
    shows = prepared.select(
        *rest, "row", "raw_title", "buttons", "keys", F.posexplode("buttons").alias("pos", "button")
    )
    own = tx.url_param(attribute(F.col("button.tag"), "href"), "P3")
    place = F.size(F.filter(F.slice("buttons", F.lit(1), F.col("pos") + 1), keyless)) - 1
    key = F.coalesce(F.nullif(own, F.lit("")), F.get("keys", place))
    tail = tx.pattern(fv.TITLE_TAIL)
    title = F.regexp_replace(spec.clean_title(F.coalesce("raw_title", F.lit(""))), tail, "")
    return (
        shows.select(
            *rest, "row", "pos",
            F.nullif(tx.trim_space(tx.collapse_space(title)), F.lit("")).alias("title"),
            F.col("button.time").alias("time"),
            key.alias("key"),
        )
        .where(F.col("time").isNotNull() | F.col("key").isNotNull())
        .withColumn("url", tx.with_url_param(F.lit(spec.purchase_url), "P3", F.col("key")))
        .dropDuplicates([*rest, "row", "time", "key"])
    )


@dataclass(frozen=True)
class LinkScheduleSpec:
    """Per-site parts of a schedule whose shows are purchase links below a film heading."""

    purchase_url: str
    heading: str = fv.HEADING_MARKER
    clean_title: FieldOf = lambda t: t
    locator: BlockLocator | None = None


_CLOCK = tx.pattern(r"{B}([0-9]{1,2})\s*[:hH]\s*([0-9]{2}){B}")


def _headed_links(pages: DataFrame, heading: str) -> DataFrame:
    """Purchase links with their section and the table of the heading above them."""
    rest = [c for c in pages.columns if c != "html"]
    # The heading's own table may begin before the marker, so cut at the table that holds it.
    cut = F.split("html", f"(?s)(?=<table(?:(?!<table).)*?{heading})")
    sections = pages.select(*rest, F.posexplode(cut).alias("section", "part"))
    block = F.regexp_extract("part", "(?s)^(.*?)(?:</table>|$)", 1)
    link = rf"(?is){fv.PURCHASE_LINK}.*?</a>"
    return sections.select(*rest, "section", block.alias("block"), F.posexplode(all_of(F.col("part"), link)).alias("pos", "link"))


def link_schedule(pages: DataFrame, spec: LinkScheduleSpec) -> DataFrame:
    """Purchase links with the title of the block they belong to and the time in or near the link.

    The block is the table of the heading above the link or, with a locator, what that finds. Of links with one title and
    time the first counts.
    """
    rest = [c for c in pages.columns if c != "html"]
    if spec.locator is None:
        links = _headed_links(pages, spec.heading)
    else:
        links = located_links(pages, f"(?is)^{fv.PURCHASE_LINK}", spec.locator).withColumn("section", F.lit(0))
    text = tx.trim_space(tx.collapse_space(F.regexp_replace(tx.plain_text(F.col("block")), tx.pattern(fv.SCHEDULE_NOISE), " ")))
    links = links.withColumn("block", text)
    before = F.regexp_replace("block", f"(?s)^(.+?){_CLOCK}.*$", "$1")
    title = spec.clean_title(tx.trim_space(F.regexp_replace(before, tx.pattern(r"[|,;:\-]\s*$"), "")))
    href = tx.decode_entities(F.regexp_extract("link", '(?i)href="([^"]*)"', 1))
    query = F.regexp_extract(href, r"(\?[^#]*)", 1)
    near = lambda c: tm.ticket_time(F.regexp_replace(F.regexp_extract(c, _CLOCK, 0), r"\s", ""))
    shows = links.select(
        *rest, "section", "pos", title.alias("title"),
        F.coalesce(near(F.col("link")), near(F.col("block"))).alias("time"),
        F.concat(F.lit(spec.purchase_url), query).alias("url"),
    )
    first = F.min(F.struct("section", "pos", "title", "url"))
    return (
        shows.groupBy(*rest, tx.base_title(F.col("title")).alias("_base"), "time").agg(first.alias("f"))
        .select(*rest, "f.section", "f.pos", "f.title", "time", "f.url")
    )


def purchase_headers(pages: DataFrame) -> DataFrame:
    """Auditorium, seats left and time of a purchase page."""
    rest = [c for c in pages.columns if c != "html"]
    text = tx.plain_text(F.col("html"))
    header = F.regexp_extract(text, fv.PURCHASE_HEADER, 1)
    line = F.when(header != "", header).otherwise(text)
    left = lambda c: F.regexp_extract(c, tx.pattern(fv.SEATS_LEFT), 1).try_cast("int")
    hall = F.regexp_extract(line, tx.pattern(fv.HALL_IN_HEADER), 0)
    return pages.select(
        *rest,
        F.nullif(tx.trim_space(F.regexp_replace(hall, r"\s{2,}", " ")), F.lit("")).alias("auditorium"),
        F.coalesce(left(line), left(text)).alias("seats_remaining"),
        F.coalesce(tm.ticket_time(line), tm.ticket_time(text)).alias("time"),
    )


def seat_elements(pages: DataFrame) -> DataFrame:
    """One row per seat of a seat-grid page: status and wheelchair flag, read from its classes."""
    rest = [c for c in pages.columns if c != "html"]
    classes = all_of(F.col("html"), r'class="((?:[^"]* )?seat(?: [^"]*)?)"', 1)
    c = F.col("classes")
    has = lambda word: F.array_contains(F.split(c, " "), word)
    return pages.select(*rest, F.explode(classes).alias("classes")).select(
        *rest,
        F.when(has("occupied"), "occupied").when(has("blocked"), "blocked").otherwise("free").alias("status"),
        has("wheelchair").alias("wheelchair"),
    )


def hall_schedule(pages: DataFrame) -> DataFrame:
    """Film cards with day grids: film, date, time and hall of every show, repeats dropped."""
    rest = [c for c in pages.columns if c != "html"]
    named = tx.pattern(fv.HALL_NUMBER)

    def card(html: Column) -> Column:
        return F.struct(text_in(html, "<h2[^>]*>", "h2").alias("movie"), pieces_after(html, with_class(fv.HALL_DAY)).alias("grids"))

    def texts(link: Column) -> Column:
        clock = tx.pattern("{B}(0?[0-9]|1[0-9]|2[0-3]):([0-9]{2}){B}")
        time = F.regexp_extract(F.coalesce(text_in(link, with_class(fv.HALL_TIME), "span"), F.lit("")), clock, 0)
        hall = tx.once(
            text_in(link, with_class(fv.HALL_NAME), "span"),
            lambda h: F.struct(h.alias("text"), *[F.regexp_extract(h, named, i).alias(n) for i, n in ((1, "word"), (2, "number"))]),
        )
        return F.struct(time.alias("time"), hall.alias("hall"))

    def show(t: Column) -> Column:
        hall = t["hall"]
        tidy = F.when(hall["word"] != "", F.concat_ws(" ", F.initcap(F.lower(hall["word"])), hall["number"])).otherwise(hall["text"])
        return F.struct(F.when(t["time"] != "", F.lpad(t["time"], 5, "0")).alias("time"), tidy.alias("salle"))

    def day(grid: Column) -> Column:
        links = F.array_distinct(all_of(grid, r"(?s)<a\s[^>]*>.*?</a>"))
        date = attribute(F.regexp_extract(grid, "^(<[^>]*>)", 1), "data-date")
        return F.struct(date.alias("date"), F.array_distinct(F.transform(F.transform(links, texts), show)).alias("shows"))

    # read within the arrays that are exploded: once per card, day and link, whatever is asked of them later
    cards = pages.select(*rest, F.explode(F.transform(pieces_after(F.col("html"), with_class(fv.HALL_CARD)), card)).alias("card"))
    days = cards.where(F.col("card.movie").isNotNull()).select(*rest, F.col("card.movie").alias("movie"), F.explode(F.transform("card.grids", day)).alias("day"))
    shows = days.where(F.col("day.date").isNotNull()).select(*rest, "movie", F.col("day.date").alias("date"), F.explode("day.shows").alias("show"))
    return shows.select(*rest, "movie", "date", "show.time", "show.salle").where(F.col("time").isNotNull()).distinct()
