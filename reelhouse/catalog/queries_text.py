"""Normalised text, dates, times and amounts inside table jobs: normalise, then group or join."""

from pyspark.sql import functions as F

from reelhouse.catalog.queries_match import NOISE, sql_base, sql_listing, sql_squish, sql_title_key, sql_words
from reelhouse.catalog.queries_merge import as_of
from reelhouse.catalog.queries_tables import shown
from reelhouse.catalog.registry import query
from reelhouse.functions import money
from reelhouse.functions import text as tx
from reelhouse.functions import time as tm
from reelhouse.sources.sample import SampleTables



def row_count():
    return F.count(F.lit(1))
SP = r"[\s\x0b\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"


def sql_space(c):
    return f"regexp_replace(regexp_replace({c}, '{SP}+', ' ', 'g'), '^ | $', '', 'g')"


def sql_plain(c):
    return f"regexp_replace(strip_accents({c}), '[\\^`¨¯´·¸]', '', 'g')"


def docs(spark, folder):
    return SampleTables(spark, folder).raw("documents")


def page_titles(spark, folder):
    pages = SampleTables(spark, folder).raw("pages")
    return pages.select("page_id", F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1).alias("title"))


_TITLES = "SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title FROM pages"


def keyed_counts(df, key):
    """Rows per key, the key shown by its digest (texts can be long)."""
    return df.groupBy(F.md5(key).alias("key")).agg(row_count().alias("n"))


@query("f01_name_key", f"SELECT md5({sql_space(f'lower({sql_plain(chr(116)+chr(101)+chr(120)+chr(116))})')}) AS key, count(*) AS n FROM documents GROUP BY 1")
def _(spark, folder):
    return keyed_counts(docs(spark, folder), tx.name_key(F.col("text")))


@query("f02_title_key", f"SELECT {sql_title_key('title')} AS title_key, count(*) AS n FROM (SELECT title FROM ({_TITLES}) UNION ALL SELECT title FROM schedule_items) GROUP BY 1")
def _(spark, folder):
    titles = page_titles(spark, folder).select("title").unionByName(SampleTables(spark, folder).schedule_items.select("title"))
    return titles.groupBy(tx.title_key(F.col("title")).alias("title_key")).agg(row_count().alias("n"))


@query("f03_title_words", f"SELECT word, count(*) AS n FROM (SELECT unnest({sql_words(sql_title_key('text'))}) AS word FROM documents) GROUP BY 1")
def _(spark, folder):
    return docs(spark, folder).select(F.explode(tx.title_words(F.col("text"))).alias("word")).groupBy("word").agg(row_count().alias("n"))


@query("f03_flat_title", f"SELECT replace({sql_title_key('title')}, ' ', '') AS flat, count(*) AS n FROM schedule_items GROUP BY 1")
def _(spark, folder):
    return SampleTables(spark, folder).schedule_items.groupBy(tx.flat_title(F.col("title")).alias("flat")).agg(row_count().alias("n"))


@query("f04_word_similarity", f"""
WITH p AS (SELECT w.showing_id, list_distinct({sql_words(sql_title_key('w.title'))}) AS a, list_distinct({sql_words(sql_title_key('i.title'))}) AS b FROM wanted_shows w JOIN schedule_items i ON i.pos = w.showing_id)
SELECT showing_id, CASE WHEN len(a) = 0 OR len(b) = 0 THEN 0 ELSE round(len(list_intersect(a, b)) / greatest(len(a), len(b)), 6) END AS similarity FROM p""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    items = t.schedule_items.select(F.col("pos").cast("bigint").alias("showing_id"), F.col("title").alias("entry"))
    return t.wanted_shows.join(items, "showing_id").select(
        "showing_id", F.round(tx.word_similarity(F.col("title"), F.col("entry")), 6).alias("similarity")
    )


@query("f05_base_title", f"SELECT {sql_base('title')} AS base, count(*) AS n FROM (SELECT title FROM schedule_items UNION ALL SELECT concat(p_name, '…') FROM part UNION ALL SELECT concat(p_brand, ' - ', p_name) FROM part) GROUP BY 1")
def _(spark, folder):
    t = SampleTables(spark, folder)
    part = t.raw("part")
    titles = t.schedule_items.select("title").union(part.select(F.concat("p_name", F.lit("…")))).union(
        part.select(F.concat_ws(" - ", "p_brand", "p_name"))
    )
    return titles.groupBy(tx.base_title(F.col("title")).alias("base")).agg(row_count().alias("n"))


_TURNS = "FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1"


def turns(spark, folder):
    c = SampleTables(spark, folder).raw("conversations")
    nxt = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    return c.join(nxt, ["conv_id", "turn"])


@query("f06_long_word_overlap", f"""
SELECT a.conv_id, a.turn, CAST(len(list_intersect(list_distinct(list_filter(string_split(a.text, ' '), lambda w: length(w) > 2)), list_distinct(list_filter(string_split(b.text, ' '), lambda w: length(w) > 2)))) AS INTEGER) AS shared {_TURNS}""")
def _(spark, folder):
    return turns(spark, folder).select("conv_id", "turn", tx.long_word_overlap(F.col("text"), F.col("answer")).alias("shared"))


@query("f07_title_distance", f"""
WITH p AS (SELECT a.conv_id, a.turn, {sql_squish('a.text')} AS x, {sql_squish('b.text')} AS y {_TURNS}),
s AS (SELECT *, list_distinct(string_split(x, '')) AS cx, list_distinct(string_split(y, '')) AS cy FROM p)
SELECT conv_id, turn, CAST(CASE WHEN x = '' OR y = '' THEN 4 WHEN x = y THEN 0 WHEN contains(x, y) OR contains(y, x) THEN 1
  ELSE 3 - least(3, floor(len(list_intersect(cx, cy)) * 3 / greatest(1, least(len(cx), len(cy))))) END AS INTEGER) AS distance FROM s""")
def _(spark, folder):
    return turns(spark, folder).select("conv_id", "turn", tx.title_distance(F.col("text"), F.col("answer")).alias("distance"))


_FLAGS = [
    ("VF", r"\bV\.?F\.?\b"), ("VOA", r"\bV\.?O\.?A?\.?\b"), ("VOST", r"\bVOST(FR|A)?\b"), ("IMAX", r"\bIMAX\b"), ("ATMOS", r"\bATMOS\b"),
    ("4DX", r"\b4DX\b"), ("DBOX", r"\bD-?BOX\b"), ("HFR", r"\bHFR\b"), ("3D", r"\b3D\b"), ("2D", r"\b2D\b"),
]
_SIGNATURE = "coalesce(nullif(array_to_string(list_sort(list_filter([" + ", ".join(
    f"CASE WHEN regexp_matches(title, '(?i){p}') THEN '{f}' END" for f, p in _FLAGS
) + "], lambda f: f IS NOT NULL)), '+'), ''), 'default')"


@query("f08_version_signature", f"SELECT {_SIGNATURE} AS version, count(*) AS n FROM (SELECT title FROM schedule_items UNION ALL SELECT text FROM documents UNION ALL SELECT concat(p_name, ' v.o.a. D-Box') FROM part) GROUP BY 1")
def _(spark, folder):
    t = SampleTables(spark, folder)
    titles = t.schedule_items.select("title").union(t.raw("documents").select("text")).union(
        t.raw("part").select(F.concat("p_name", F.lit(" v.o.a. D-Box")))
    )
    return titles.groupBy(tx.version_signature(F.col("title")).alias("version")).agg(row_count().alias("n"))


@query("f09_auditorium_key", r"""
SELECT regexp_replace(regexp_replace(regexp_replace(lower(strip_accents(a)), '\b(salle|aud|auditorium|screen|vip)\b', '', 'g'), '#|\s+', '', 'g'), '(^|[^0-9])0+([0-9])', '\1\2', 'g') AS plain,
  regexp_replace(a, '[^0-9]', '', 'g') AS digits, count(*) AS n
FROM (SELECT coalesce(auditorium, '') AS a FROM measurements UNION ALL SELECT s_name FROM supplier) GROUP BY 1, 2""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    names = t.measurements.select("auditorium").union(t.raw("supplier").select("s_name"))
    a = F.col("auditorium")
    return names.groupBy(tx.auditorium_key(a).alias("plain"), tx.digits(a).alias("digits")).agg(row_count().alias("n"))


_IDENTITY = sql_space("lower(strip_accents(nfc_normalize(translate(replace(replace(regexp_replace(text, '[\\x{200b}-\\x{200d}\\x{feff}]', '', 'g'), '…', '...'), '™', 'TM'), '“”„‟’‘‛', '\"\"\"\"'''''''))))")


@query("f10_identity_key", f"SELECT md5({_IDENTITY}) AS key, count(*) AS n FROM (SELECT text FROM documents UNION ALL SELECT concat('L’été : ', p_name) FROM part UNION ALL SELECT concat('l''ete : ', upper(p_name)) FROM part) GROUP BY 1")
def _(spark, folder):
    t = SampleTables(spark, folder)
    part = t.raw("part")
    texts = t.raw("documents").select("text").union(part.select(F.concat(F.lit("L’été : "), "p_name"))).union(
        part.select(F.concat(F.lit("l'ete : "), F.upper("p_name")))
    )
    return keyed_counts(texts, tx.identity_key(F.col("text")))


_CLEAN = r"(?i)\bV\.?F\.?(\s*Q|O?F)?\b", r"(?i)\bV\.?O\.?(S?T\.)?\b", r"(?i)\s*\(\s*version\s+fran(?:ç|c)aise\s*\)\s*", r"(?i)\s*\(\s*vf(?:of)?\s*\)\s*", r"(?i)\s+vf(?:of)?\s*$"


def sql_clean(c):
    for p in _CLEAN:
        c = f"regexp_replace({c}, '{p}', '', 'g')"
    return f"trim({c})"


@query("f11_without_version_markers", f"SELECT {sql_clean('title')} AS title, count(*) AS n FROM (SELECT title FROM schedule_items UNION ALL SELECT concat(p_name, ' (version française)') FROM part UNION ALL SELECT concat(p_name, ' V.O. (VFOF)') FROM part) GROUP BY 1")
def _(spark, folder):
    t = SampleTables(spark, folder)
    part = t.raw("part")
    titles = t.schedule_items.select("title").union(part.select(F.concat("p_name", F.lit(" (version française)")))).union(
        part.select(F.concat("p_name", F.lit(" V.O. (VFOF)")))
    )
    return titles.groupBy(tx.without_version_markers(F.col("title")).alias("title")).agg(row_count().alias("n"))


_ENTITIES = "replace(replace(replace(replace(replace({c}, '&apos;', chr(39)), '&quot;', '\"'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>')"


def sql_page_text(c):
    x = f"regexp_replace(regexp_replace({c}, '(?is)<script.*?</script>', ' ', 'g'), '(?is)<style.*?</style>', ' ', 'g')"
    return _ENTITIES.format(c=sql_space(f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"))


@query("f13_page_text", f"SELECT page_id, md5({sql_page_text('html')}) AS digest, CAST(length({sql_page_text('html')}) AS INTEGER) AS n_chars FROM pages")
def _(spark, folder):
    pages = SampleTables(spark, folder).raw("pages").withColumn("text", tx.plain_text(F.col("html")))
    return pages.select("page_id", F.md5("text").alias("digest"), F.length("text").alias("n_chars"))


_CRUMBS = [
    (rf'\b(?:data-[A-Za-z0-9_-]+|[a-zA-Z-]+-media){SP}*={SP}*"\[[^"]*\]"{SP}*', " "), (rf';{SP}*[a-z-]+{SP}*:{SP}*[^;"]+;?', " "),
    (rf"(?i)\bvisibility{SP}*:{SP}*hidden\b", " "), (r"(?i)\bpos[0-9]+\b", " "), (SP + "{2,}", " "), (f"^{SP}+|{SP}+$", ""),
]
_REMAINS = [
    (r'\[[^\]]*\]">?$', " "), (rf"[\"'']{SP}*>?$", " "), (rf"(?i)\b[a-z-]*media{SP}*={SP}*[\"''][^\"'']*[\"'']", " "),
    (rf"(?i)\bstyle{SP}*={SP}*[\"''][^\"'']*[\"'']", " "), (SP + "{2,}", " "), (f"^{SP}+|{SP}+$", ""),
]


def sql_chain(c, steps):
    for p, to in steps:
        c = f"regexp_replace({c}, '{p}', '{to}', 'g')"
    return c


@query("f14_attribute_crumbs", f"SELECT page_id, md5({sql_chain('html', _CRUMBS)}) AS mild, md5({sql_chain(sql_chain('html', _REMAINS), _CRUMBS)}) AS strong FROM pages")
def _(spark, folder):
    html = F.col("html")
    return SampleTables(spark, folder).raw("pages").select(
        "page_id", F.md5(tx.without_attribute_crumbs(html)).alias("mild"), F.md5(tx.without_markup_remains(html)).alias("strong")
    )


_CANON = "regexp_replace(regexp_extract(url, '^([^?]*)', 1), '/$', '')"


@query("f15_addresses", f"""
SELECT page_id, {_CANON} AS href, CASE WHEN regexp_matches(url, '[?&]page=') THEN regexp_extract(url, '[?&]page=([^&#]*)', 1) END AS page,
  CASE WHEN regexp_matches(url, '[?&]page=') THEN regexp_replace(url, '([?&]page=)[^&#]*', concat('\\1', page_id))
    WHEN contains(url, '#') THEN concat(regexp_extract(url, '^([^#]*)', 1), CASE WHEN contains(regexp_extract(url, '^([^#]*)', 1), '?') THEN '&' ELSE '?' END, 'page=', page_id, regexp_extract(url, '(#.*)$', 1))
    ELSE concat(url, CASE WHEN contains(url, '?') THEN '&' ELSE '?' END, 'page=', page_id) END AS with_page FROM pages""")
def _(spark, folder):
    url = F.col("url")
    return SampleTables(spark, folder).raw("pages").select(
        "page_id", tx.canonical_href(url).alias("href"), tx.url_param(url, "page").alias("page"),
        tx.with_url_param(url, "page", F.col("page_id").cast("string")).alias("with_page"),
    )


@query("f15_slug_titles", """
WITH h AS (SELECT p_partkey, concat('/films/', replace(p_name, ' ', '-'), CASE WHEN p_partkey % 3 = 0 THEN '-vf/' WHEN p_partkey % 3 = 1 THEN '?x=1' ELSE '' END) AS href, p_name FROM part),
w AS (SELECT *, array_to_string(list_transform(string_split(p_name, ' '), lambda x: concat(upper(x[1]), x[2:])), ' ') AS cap FROM h)
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN concat(cap, ' Vf') ELSE cap END AS title, cap AS bare, concat('https://films.example', regexp_replace(href, '/horaires', '')) AS base_url FROM w""")
def _(spark, folder):
    key = F.col("p_partkey")
    tail = F.when(key % 3 == 0, "-vf/").when(key % 3 == 1, "?x=1").otherwise("")
    h = SampleTables(spark, folder).raw("part").select(key, F.concat(F.lit("/films/"), F.replace("p_name", F.lit(" "), F.lit("-")), tail).alias("href"))
    href = F.col("href")
    return h.select(
        "p_partkey", tx.slug_title(href).alias("title"), tx.slug_title(href, drop_version=True).alias("bare"),
        tx.base_film_url(href, "https://films.example").alias("base_url"),
    )


_MONTHS = "['janvier','février','mars','avril','mai','juin','juillet','août','septembre','octobre','novembre','décembre']"


def french_months():
    return F.array(*[F.lit(m) for m in "janvier février mars avril mai juin juillet août septembre octobre novembre décembre".split()])


@query("f16_french_dates", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS release_date, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS plain_date FROM orders")
def _(spark, folder):
    d = F.col("o_orderdate")
    word = F.element_at(french_months(), F.month(d))
    words = F.when(F.col("o_orderkey") % 2 == 0, tx.strip_marks(word)).otherwise(F.initcap(word))
    text = F.concat_ws(" ", F.lit("Sortie partout au Québec :"), F.dayofmonth(d).cast("string"), words, F.year(d).cast("string"))
    o = SampleTables(spark, folder).raw("orders").select("o_orderkey", text.alias("text"))
    return shown(o.select("o_orderkey", tm.french_date(F.col("text"), "sortie").alias("release_date"), tm.french_date(F.col("text")).alias("plain_date")))


@query("f16_day_month_labels", """
SELECT o_orderkey, CAST(make_date(CASE WHEN month(o_orderdate) = 1 THEN 2025 ELSE 2024 END, month(o_orderdate), least(day(o_orderdate), 28)) AS VARCHAR) AS label_date FROM orders""")
def _(spark, folder):
    d = F.col("o_orderdate")
    day = F.least(F.dayofmonth(d), F.lit(28))
    label = F.concat_ws(
        " ", F.lit("vendredi"), F.concat(day.cast("string"), F.when(day == 1, "er").otherwise("")), F.element_at(french_months(), F.month(d))
    )
    december = F.lit("2024-12-10").cast("date")
    o = SampleTables(spark, folder).raw("orders").select("o_orderkey", label.alias("label"))
    return shown(o.select("o_orderkey", tm.french_day_month(F.col("label"), december).alias("label_date")))


@query("f17_time_text", """
WITH t AS (SELECT id, CAST(extract(hour FROM start_at) AS INTEGER) AS h, CAST(extract(minute FROM start_at) AS INTEGER) AS m FROM showings)
SELECT id, printf('%02d:%02d', h, m) AS program, printf('%02d:%02d', h, m) AS schedule, printf('%02d:%02d', h, m) AS half_day, printf('%02d:%02d', h, m) AS ticket, printf('%02d:00', h) AS bare FROM t""")
def _(spark, folder):
    h, m = F.hour("start_at"), F.minute("start_at")
    mm = F.lpad(m.cast("string"), 2, "0")
    shows = SampleTables(spark, folder).showings.select(
        "id",
        F.concat(h.cast("string"), F.when(F.col("id") % 2 == 0, "h").otherwise(":"), mm).alias("a"),
        F.concat(F.lit("Achat "), h.cast("string"), F.lit(" h "), mm).alias("b"),
        F.concat(((h + 11) % 12 + 1).cast("string"), F.lit(":"), mm, F.when(h >= 12, " pm").otherwise(" AM")).alias("c"),
        F.concat(F.lit("séance de "), h.cast("string"), F.lit("H"), mm, F.lit(" salle")).alias("d"),
        F.concat(F.lit("à "), h.cast("string"), F.lit(" heures")).alias("e"),
    )
    return shows.select(
        "id", tm.program_time(F.col("a")).alias("program"), tm.schedule_time(F.col("b")).alias("schedule"),
        tm.schedule_time(F.col("c")).alias("half_day"), tm.ticket_time(F.col("d")).alias("ticket"), tm.ticket_time(F.col("e")).alias("bare"),
    )


@query("f18_weekend_ids", """
SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, CAST(isoyear(o_orderdate) * 100 + week(o_orderdate) AS INTEGER) AS weekend_id,
  CAST(CAST(o_orderdate AS DATE) + CAST(5 - isodow(o_orderdate) AS INTEGER) AS VARCHAR) AS friday, CAST(CAST(o_orderdate AS DATE) + CAST(7 - isodow(o_orderdate) AS INTEGER) AS VARCHAR) AS sunday FROM orders""")
def _(spark, folder):
    days = SampleTables(spark, folder).raw("orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    wid = days.withColumn("weekend_id", tm.weekend_id(F.col("day")))
    return shown(wid.select("day", "weekend_id", tm.friday_of(F.col("weekend_id")).alias("friday"), tm.sunday_of(F.col("weekend_id")).alias("sunday")))


@query("f19_last_friday", """
SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, CAST(CAST(o_orderdate AS DATE) - CAST((isodow(o_orderdate) + 2) % 7 AS INTEGER) AS VARCHAR) AS friday,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS parsed FROM orders""")
def _(spark, folder):
    days = SampleTables(spark, folder).raw("orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    loose = F.concat_ws("/", F.year("day").cast("string"), F.month("day").cast("string"), F.dayofmonth("day").cast("string"))
    return shown(days.select("day", tm.last_friday(F.col("day")).alias("friday"), tm.lenient_iso_date(F.concat(F.lit(" "), loose, F.lit(" (ven.)"))).alias("parsed")))


@query("f20_money_text", """
SELECT o_orderkey, CAST(round(round(o_totalprice)) AS BIGINT) AS spaced, CAST(round(floor(o_totalprice / 1000) / 100 * 1000000) AS BIGINT) AS millions, floor(o_totalprice) + 0.5 AS plain FROM orders""")
def _(spark, folder):
    total = F.col("o_totalprice")
    whole = F.round(total).cast("bigint").cast("string")
    spaced = F.concat(F.regexp_replace(whole, r"(?<=\d)(?=(\d{3})+$)", " "), F.lit(" $"))
    hundredths = F.floor(total / 1000)
    millions = F.concat(F.floor(hundredths / 100).cast("string"), F.lit(","), F.lpad((hundredths % 100).cast("string"), 2, "0"), F.lit("M$"))
    plain = F.concat(F.floor(total).cast("string"), F.lit(",5 $"))
    o = SampleTables(spark, folder).raw("orders").select("o_orderkey", spaced.alias("a"), millions.alias("b"), plain.alias("c"))
    return o.select(
        "o_orderkey", money.money_text(F.col("a")).alias("spaced"), money.money_text(F.col("b")).alias("millions"), money.plain_amount(F.col("c")).alias("plain")
    )


@query("f21_local_time", """
SELECT id, strftime(start_at - INTERVAL '5' HOUR, '%Y-%m-%d') AS local_date, strftime(start_at - INTERVAL '5' HOUR, '%H:%M') AS local_time,
  strftime(date_trunc('minute', start_at), '%Y-%m-%d %H:%M:%S') AS start_again FROM showings""")
def _(spark, folder):
    at = F.col("start_at")
    local = SampleTables(spark, folder).showings.select("id", tm.local_date(at).alias("local_date"), tm.hhmm(tm.to_local(at)).alias("local_time"))
    return shown(local.withColumn("start_again", tm.local_start(F.col("local_date"), F.col("local_time"))))


@query("f27_without_blanks", f"""
SELECT doc_id, CAST(len(list_distinct(list_filter(list_transform(regexp_split_to_array(text, '\\n'), lambda x: regexp_replace(x, '^{SP}+|{SP}+$', '', 'g')), lambda x: x <> ''))) AS INTEGER) AS n_lines FROM documents""")
def _(spark, folder):
    return docs(spark, folder).select("doc_id", F.size(tx.without_blanks(F.split("text", "\n"))).alias("n_lines"))


@query("f29_month_labels", """
SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, strftime(o_orderdate, '%Y-%m') AS this_month, strftime(date_trunc('month', o_orderdate) + INTERVAL '1' MONTH, '%Y-%m') AS next_month,
  array_to_string(list_transform([2,3,4,5,6,7], lambda k: strftime(date_trunc('month', o_orderdate) + to_months(k), '%Y-%m')), ',') AS following FROM orders""")
def _(spark, folder):
    days = SampleTables(spark, folder).raw("orders").select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    d = F.col("day")
    return shown(days.select(d, tm.month_label(d).alias("this_month"), tm.month_label(d, 1).alias("next_month"), F.array_join(tm.month_labels(d, 2, 7), ",").alias("following")))


@query("f30_theater_subtitles", """
SELECT s_suppkey, CASE WHEN s_suppkey % 4 <> 3 THEN s_name END AS chain, CASE WHEN s_suppkey % 4 <> 3 THEN CAST(s_suppkey % 20 + 1 AS INTEGER) END AS screen_count FROM supplier""")
def _(spark, folder):
    key = F.col("s_suppkey")
    subtitle = F.when(key % 4 != 3, F.concat(F.col("s_name"), F.lit(" • "), (key % 20 + 1).cast("string"), F.lit(" Salles"))).otherwise("Montréal")
    s = SampleTables(spark, folder).raw("supplier").select("s_suppkey", subtitle.alias("subtitle"))
    chain, count = tx.chain_and_screens(F.col("subtitle"))
    return s.select("s_suppkey", chain.alias("chain"), count.alias("screen_count"))
