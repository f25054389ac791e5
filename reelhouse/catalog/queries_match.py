"""Schedule, session and film matching."""

from pyspark.sql import functions as F

from reelhouse.catalog.registry import query
from reelhouse.functions import text as tx
from reelhouse.operators import match_film, match_schedule, match_session
from reelhouse.sources.sample import SampleTables

NOISE = r"(?i)\b(VF|VOA?|VOST(?:FR)?|IMAX|ATMOS|4DX|D-?BOX|HFR|3D|2D|Dolby(?:\s+Cinema)?)\b"


def sql_title_key(c: str) -> str:
    x = f"regexp_replace(strip_accents({c}), '[\\^`¨¯´·¸]', '', 'g')"
    x = f"regexp_replace({x}, '{NOISE}', ' ', 'g')"
    x = rf"regexp_replace({x}, '\([^)]*\)|\[[^\]]*\]', ' ', 'g')"
    x = f"regexp_replace(lower(replace(replace({x}, '’', ' '), chr(39), ' ')), '[^a-z0-9]+', ' ', 'g')"
    return rf"trim(regexp_replace({x}, '^(le|la|les|the|l|un|une)\s+', ''))"


def sql_words(key: str) -> str:
    return f"list_filter(string_split({key}, ' '), lambda w: w <> '')"


_PAIR_STEPS = f"""WITH entries AS (SELECT *, {sql_title_key('title')} AS k FROM schedule_items),
wants AS (SELECT *, {sql_title_key('title')} AS k FROM wanted_shows),
pairs AS (
  SELECT w.showing_id, e.pos, e.url, replace(w.k, ' ', '') AS wf, replace(e.k, ' ', '') AS ef,
    {sql_words('w.k')} AS ww, {sql_words('e.k')} AS ew, count(*) OVER (PARTITION BY w.showing_id) AS n
  FROM wants w JOIN entries e ON e.theater_id = w.theater_id AND e.date = w.date AND e.time = w.time),
scored AS (
  SELECT *, ef <> '' AND (contains(wf, ef) OR contains(ef, wf)) AS held, len(list_filter(ew, lambda x: list_contains(ww, x))) AS shared,
    CASE WHEN len(ew) = 0 THEN 0 ELSE len(list_intersect(list_distinct(ew), list_distinct(ww))) / greatest(len(list_distinct(ew)), len(list_distinct(ww))) END AS sim
  FROM pairs),
simple AS (SELECT * FROM (SELECT *, CASE WHEN n = 1 THEN 'single' WHEN held THEN 'containment' WHEN shared >= 2 THEN concat('shared-words(', shared, ')') ELSE 'first' END AS strategy,
  row_number() OVER (PARTITION BY showing_id ORDER BY CASE WHEN held THEN 1 WHEN shared >= 2 THEN 2 ELSE 3 END, CASE WHEN NOT held AND shared >= 2 THEN -shared ELSE 0 END, pos) AS rn FROM scored) WHERE rn = 1),
strict AS (SELECT * FROM (SELECT *, CASE WHEN n = 1 THEN 'single' WHEN wf = ef THEN 'equal' WHEN sim >= 0.5 THEN concat('similar(', printf('%.2f', sim), ')') ELSE 'weak' END AS strategy,
  row_number() OVER (PARTITION BY showing_id ORDER BY CASE WHEN wf = ef THEN 1 WHEN sim >= 0.5 THEN 2 ELSE 3 END, CASE WHEN wf <> ef AND sim >= 0.5 THEN -sim ELSE 0 END, pos) AS rn FROM scored) WHERE rn = 1)
"""


@query("j15_schedule_entry", _PAIR_STEPS + "SELECT showing_id, pos, url, strategy FROM simple")
def _(spark, folder):
    t = SampleTables(spark, folder)
    picks = match_schedule.pick_entries(t.wanted_shows, t.schedule_items)
    return match_schedule.matched(t.wanted_shows, picks).select("showing_id", "pos", "url", "strategy")


@query("q09_picker_comparison", _PAIR_STEPS + """
SELECT w.showing_id, w.title, CASE WHEN o.strategy <> 'weak' THEN o.url END AS strict_url, o.strategy AS strict_strategy, s.url AS simple_url, s.strategy AS simple_strategy, s.n AS entries
FROM wanted_shows w LEFT JOIN simple s USING (showing_id) LEFT JOIN strict o USING (showing_id)""")
def _(spark, folder):
    from reelhouse.plans.prefill import picker_comparison

    t = SampleTables(spark, folder)
    return picker_comparison(t.wanted_shows, t.schedule_items).select(
        "showing_id", "title", "strict_url", "strict_strategy", "simple_url", "simple_strategy", "entries"
    )


@query("j11_unused_urls", """
WITH picks AS (SELECT w.showing_id, w.theater_id, w.time, concat('https://tickets.example/old?P3=', 50000 + w.showing_id % 60) AS url FROM wanted_shows w),
free AS (SELECT * FROM picks p WHERE NOT EXISTS (SELECT 1 FROM showings s WHERE s.theater_id = p.theater_id AND s.id <> p.showing_id AND s.purchase_url = p.url
  AND date_trunc('hour', s.start_at) = s.start_at AND strftime(s.start_at - INTERVAL '5' HOUR, '%H:%M') = p.time))
SELECT theater_id, url, time, min(showing_id) AS showing_id FROM free GROUP BY 1, 2, 3""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    url = F.concat(F.lit("https://tickets.example/old?P3="), (50000 + F.col("showing_id") % 60).cast("string"))
    picks = t.wanted_shows.select("showing_id", "theater_id", "time", url.alias("url"))
    return match_schedule.unused_urls(picks, t.showings, ["showing_id"])


_LISTING = "trim(regexp_replace(lower(regexp_replace(strip_accents(replace({c}, '’', chr(39))), '[\\^`¨¯´·¸]', '', 'g')), '\\s+', ' ', 'g'))"
_BASE = "trim(coalesce(nullif(regexp_extract({x}, '^([^:-]{{3,}})', 1), ''), {x}))"


def sql_listing(c):
    return _LISTING.format(c=c)


def sql_base(c):
    return _BASE.format(x=sql_listing(f"trim(regexp_replace({c}, '[.…]+$', ''))"))


@query("j16_near_time_entry", f"""
WITH items AS (SELECT theater_id, date, pos, title, url, lpad(CAST(h AS VARCHAR), 2, '0') || ':' || lpad(CAST(m AS VARCHAR), 2, '0') AS time, h * 60 + m AS minute FROM (
  SELECT *, CAST(left(time, 2) AS INTEGER) AS h, CAST(pos % 23 AS INTEGER) AS m FROM schedule_items)),
wants AS (SELECT *, CAST(left(time, 2) AS INTEGER) * 60 + CAST(right(time, 2) AS INTEGER) AS minute, {sql_listing('title')} AS wl, {sql_base('title')} AS wb FROM wanted_shows),
pairs AS (
  SELECT w.showing_id, w.wl, w.wb, i.pos, i.url, {sql_listing('i.title')} AS el, {sql_base('i.title')} AS eb, abs(i.minute - w.minute) AS gap
  FROM wants w JOIN items i USING (theater_id, date)),
scored AS (
  SELECT *, len(list_intersect(list_distinct(list_filter(string_split(wb, ' '), lambda x: length(x) > 2)), list_distinct(list_filter(string_split(eb, ' '), lambda x: length(x) > 2)))) AS ov,
    min(gap) OVER (PARTITION BY showing_id) AS least_gap, starts_with(eb, wb) AS st FROM pairs),
timed AS (SELECT showing_id, pos, url, score, 'time' AS found_by FROM (
  SELECT *, CASE WHEN el = wl THEN 300 WHEN st THEN 200 ELSE 0 END + ov AS score FROM scored WHERE least_gap <= 10 AND gap = least_gap)
  QUALIFY row_number() OVER (PARTITION BY showing_id ORDER BY score DESC, pos) = 1),
titled AS (SELECT showing_id, pos, url, score, 'title' AS found_by FROM (
  SELECT *, CASE WHEN st THEN 100 ELSE 0 END + ov AS score FROM scored WHERE least_gap > 10) WHERE score > 0
  QUALIFY row_number() OVER (PARTITION BY showing_id ORDER BY score DESC, pos) = 1)
SELECT showing_id, pos, url, CAST(score AS BIGINT) AS score, found_by FROM timed UNION ALL SELECT showing_id, pos, url, CAST(score AS BIGINT), found_by FROM titled""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    minute = F.lpad((F.col("pos") % 23).cast("string"), 2, "0")
    items = t.schedule_items.withColumn("time", F.concat(F.left("time", F.lit(3)), minute))
    picks = match_schedule.pick_near(t.wanted_shows, items)
    return t.wanted_shows.join(picks, ["theater_id", "date", "time", "title"]).select(
        "showing_id", "pos", "url", F.col("score").cast("bigint").alias("score"), "found_by"
    )


def sql_squish(c):
    return f"trim(regexp_replace(strip_accents(lower({c})), '[^a-z0-9]+', ' ', 'g'))"


@query("j17_scored_session", f"""
WITH pairs AS (
  SELECT w.showing_id, s.pos, s.auditorium, {sql_squish('s.movie_name')} AS a, {sql_squish('w.title')} AS b,
    CASE WHEN s.runtime_minutes IS NULL OR w.runtime IS NULL THEN 0.5 WHEN abs(s.runtime_minutes - w.runtime) <= 3 THEN 0 WHEN abs(s.runtime_minutes - w.runtime) <= 6 THEN 0.5 WHEN abs(s.runtime_minutes - w.runtime) <= 10 THEN 1 ELSE 2 END
    + CASE WHEN w.language IS NOT NULL AND s.language_code <> w.language THEN 0.5 ELSE 0 END AS base
  FROM wanted_shows w JOIN sessions s ON s.theater_id = w.theater_id AND s.date = w.date AND s.time = w.time),
sets AS (SELECT *, list_distinct(string_split(a, '')) AS ca, list_distinct(string_split(b, '')) AS cb FROM pairs),
scored AS (
  SELECT showing_id, pos, auditorium, base + CASE WHEN a = '' OR b = '' THEN 4 WHEN a = b THEN 0 WHEN contains(a, b) OR contains(b, a) THEN 1
      ELSE 3 - least(3, floor(len(list_intersect(ca, cb)) * 3 / greatest(1, least(len(ca), len(cb))))) END AS score FROM sets),
placed AS (SELECT *, row_number() OVER (PARTITION BY showing_id ORDER BY score, pos) AS rn, lead(score) OVER (PARTITION BY showing_id ORDER BY score, pos) AS nxt FROM scored),
best AS (SELECT showing_id, max(CASE WHEN rn = 1 THEN pos END) AS pos, max(CASE WHEN rn = 1 THEN auditorium END) AS auditorium,
  coalesce(max(CASE WHEN rn = 1 THEN nxt - score END) < 0.25, false) AS close, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY rn) FILTER (WHERE rn <= 3) AS top3 FROM placed GROUP BY 1)
SELECT showing_id, CASE WHEN close THEN 'AMBIGUOUS_AT_TIME' ELSE 'OK' END AS status, CASE WHEN NOT close THEN pos END AS session_pos,
  CASE WHEN NOT close THEN auditorium END AS auditorium, CASE WHEN close THEN top3 END AS candidates FROM best""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    return match_session.scored_session(t.wanted_shows, t.sessions).select(
        "showing_id", "status", "session_pos", "auditorium", F.array_join(F.col("candidates").cast("array<string>"), ",").alias("candidates")
    )


_BEST_SESSIONS = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY theater_id, coalesce('v:' || session_id, 'k:' || trim(auditorium) || '|' || start_local || '|' || film_url)
  ORDER BY CASE area_code WHEN '0000000001' THEN 3 WHEN '0000000004' THEN 1 ELSE 2 END * 100 + CASE experience WHEN 'Regular' THEN 2 WHEN 'D-BOX' THEN 1 ELSE 0 END DESC, pos) AS srn FROM sessions) WHERE srn = 1"""


@query("w05_best_session", f"SELECT theater_id, pos, movie_name, session_id, auditorium, area_code, seats_remaining FROM ({_BEST_SESSIONS})")
def _(spark, folder):
    return match_session.best_sessions(SampleTables(spark, folder).sessions).select(
        "theater_id", "pos", "movie_name", "session_id", "auditorium", "area_code", "seats_remaining"
    )


@query("j18_narrowed_session", f"""
WITH offers AS ({_BEST_SESSIONS}),
pairs AS (
  SELECT w.showing_id, o.pos, trim(o.auditorium) AS auditorium, o.seats_remaining, o.area_code, coalesce(abs(o.runtime_minutes - w.runtime) <= 3, false) AS near,
    contains(strip_accents(lower(o.movie_name)), strip_accents(lower(w.title))) OR contains({sql_squish('o.movie_name')}, {sql_squish('w.title')}) AS named
  FROM wanted_shows w JOIN offers o ON o.theater_id = w.theater_id AND o.date = w.date AND o.time = w.time),
by_runtime AS (SELECT *, max(near) OVER (PARTITION BY showing_id) AS any_near FROM pairs),
r AS (SELECT *, max(named) OVER (PARTITION BY showing_id) AS any_named FROM by_runtime WHERE near OR NOT any_near),
n AS (SELECT * FROM r WHERE named OR NOT any_named),
halls AS (SELECT showing_id, count(DISTINCT auditorium) AS halls FROM n GROUP BY 1)
SELECT showing_id, pos AS session_pos, auditorium, seats_remaining FROM n JOIN halls USING (showing_id)
QUALIFY row_number() OVER (PARTITION BY showing_id ORDER BY CASE WHEN halls > 1 AND area_code = '0000000001' THEN 0 ELSE 1 END, pos) = 1""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    picks = match_session.narrowed_session(t.wanted_shows, match_session.best_sessions(t.sessions))
    w = t.wanted_shows.alias("w")
    same = F.lit(True)
    for k in ("theater_id", "date", "time", "title", "runtime"):
        same = same & F.col(f"w.{k}").eqNullSafe(F.col(f"p.{k}"))
    return w.join(picks.alias("p"), same).select("w.showing_id", "p.session_pos", "p.auditorium", "p.seats_remaining")


@query("j20_titled_session", f"""
WITH pairs AS (
  SELECT w.showing_id, s.pos, s.auditorium, s.seats_remaining, {sql_listing('s.movie_name')} AS a, {sql_listing('w.title')} AS b, s.session_date = w.date AS same_day
  FROM wanted_shows w JOIN sessions s ON s.theater_id = w.theater_id AND s.date = w.date AND s.time = w.time)
SELECT showing_id, pos AS session_pos, auditorium, seats_remaining, CASE WHEN a = b AND same_day THEN 'exact' ELSE 'loose' END AS found_by
FROM pairs WHERE contains(a, b)
QUALIFY row_number() OVER (PARTITION BY showing_id ORDER BY CASE WHEN a = b AND same_day THEN 0 ELSE 1 END, pos) = 1""")
def _(spark, folder):
    t = SampleTables(spark, folder)
    picks = match_session.titled_session(t.wanted_shows, t.sessions)
    return t.wanted_shows.join(picks, ["theater_id", "date", "time", "title"]).select(
        "showing_id", "session_pos", "auditorium", "seats_remaining", "found_by"
    )


_CLEAN = r"trim(regexp_replace(title, '(?i)\bV\.?F\.?(\s*Q|O?F)?\b', '', 'g'))"
_RESOLVE_STEPS = f"""WITH wants AS (SELECT *, {_CLEAN} AS t FROM search_wants),
qs AS (SELECT want_id, year_hint, 0 AS qo, t AS q FROM wants UNION ALL SELECT want_id, year_hint, 1, extra_query FROM wants),
ys AS (SELECT want_id, qo, q, 0 AS yo, year_hint AS y FROM qs UNION ALL SELECT want_id, qo, q, 1, year_hint - 1 FROM qs WHERE year_hint IS NOT NULL UNION ALL SELECT want_id, qo, q, 2, year_hint + 1 FROM qs WHERE year_hint IS NOT NULL),
vs AS (SELECT *, 0 AS vo, q AS v FROM ys UNION ALL SELECT *, 1, regexp_replace(q, '\\s*\\|\\s*', ' : ', 'g') FROM ys UNION ALL SELECT *, 2, regexp_replace(q, '\\s*:\\s*', ' | ', 'g') FROM ys
  UNION ALL SELECT *, 3, regexp_replace(q, '\\s*[:|]\\s*', ' - ', 'g') FROM ys UNION ALL SELECT *, 4, regexp_replace(q, '\\s*[:|]\\s*', ' ', 'g') FROM ys),
ds AS (SELECT vs.*, d.so, d.step FROM vs JOIN (VALUES (0, 0), (1, 1), (2, -1), (3, 2), (4, -2)) d(so, step) ON vs.y IS NOT NULL OR d.so = 0),
hits AS (
  SELECT ds.*, r.id, r.pos, r.genre = 99 AS doc, nullif(TRY_CAST(left(r.release_date, 4) AS INTEGER), 0) AS ry,
    {sql_squish('r.title')} AS tn, {sql_squish('r.original_title')} AS onn, {sql_squish('ds.q')} AS qn, r.popularity
  FROM ds JOIN search_results r ON r.query = ds.v AND r.year = ds.y + ds.step),
ok AS (SELECT *, CASE WHEN tn = qn OR onn = qn THEN 100 WHEN contains(tn, qn) OR contains(onn, qn) THEN 25 ELSE 0 END
    + CASE WHEN abs(ry - y) = 0 THEN 40 WHEN abs(ry - y) <= 1 THEN 20 ELSE 0 END + popularity / 10 AS score
  FROM hits WHERE abs(ry - (y + step)) <= 1),
searched AS (SELECT want_id, id FROM ok QUALIFY row_number() OVER (PARTITION BY want_id ORDER BY qo, yo, doc, vo, so, score DESC, pos) = 1),
keys AS (SELECT id, lower(fr_title) AS k FROM movies WHERE fr_title IS NOT NULL UNION SELECT id, lower(title) FROM movies),
known AS (SELECT k, min(id) AS id FROM keys GROUP BY 1),
tried AS (SELECT w.want_id, lower(w.t) AS k, s.id AS sid, n.id AS nid FROM wants w LEFT JOIN searched s USING (want_id) LEFT JOIN known n ON n.k = lower(w.t)),
fresh AS (SELECT k, 1000000000 - 1 + row_number() OVER (ORDER BY left(md5(k), 2), k) AS id FROM (SELECT DISTINCT k FROM tried WHERE sid IS NULL AND nid IS NULL))
"""


@query("j19_film_resolution", _RESOLVE_STEPS + """
SELECT t.want_id, coalesce(t.sid, t.nid, f.id) AS film_id, CASE WHEN t.sid IS NOT NULL THEN 'search' WHEN t.nid IS NOT NULL THEN 'known' ELSE 'provisional' END AS found_by
FROM tried t LEFT JOIN fresh f USING (k)""")
def resolved_wants(spark, folder):
    t = SampleTables(spark, folder)
    return match_film.resolve_films(t.search_wants, t.search_results, t.movies).select("want_id", "film_id", "found_by")


@query("p07_year_gate", """
SELECT id, pos, abs(coalesce(nullif(TRY_CAST(left(release_date, 4) AS INTEGER), 0), 9999) - year) <= 1 AS strict_ok,
  coalesce(abs(nullif(TRY_CAST(left(release_date, 4) AS INTEGER), 0) - year) <= 1, true) AS loose_ok
FROM search_results WHERE genre <> 99""")
def _(spark, folder):
    r = SampleTables(spark, folder).search_results
    return r.where(~match_film.is_documentary(F.col("genre_ids"))).select(
        "id", "pos",
        match_film.within_year(F.col("release_date"), F.col("year")).alias("strict_ok"),
        match_film.within_year(F.col("release_date"), F.col("year"), strict=False).alias("loose_ok"),
    )


@query("f12_separator_variants", r"""
SELECT v AS variant, count(*) AS n FROM (
  SELECT DISTINCT want_id, unnest(list_value(title, regexp_replace(title, '\s*\|\s*', ' : ', 'g'), regexp_replace(title, '\s*:\s*', ' | ', 'g'),
    regexp_replace(title, '\s*[:|]\s*', ' - ', 'g'), regexp_replace(title, '\s*[:|]\s*', ' ', 'g'))) AS v FROM search_wants) GROUP BY 1""")
def _(spark, folder):
    w = SampleTables(spark, folder).search_wants
    return w.select(F.explode(tx.separator_variants(F.col("title"))).alias("variant")).groupBy("variant").agg(F.count(F.lit(1)).alias("n"))
