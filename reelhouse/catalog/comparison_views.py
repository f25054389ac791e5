"""The box-office tables as SQL views over the shared test tables, for the comparison queries.

All instants lie in January 2024, so Toronto local time is UTC less five hours.
"""

VIEWS: dict[str, str] = {}

VIEWS["movies"] = """
SELECT p_partkey AS id, p_name AS title,
  CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE concat('Le ', p_name) END AS fr_title,
  DATE '2023-12-15' + CAST(p_partkey % 40 AS INTEGER) AS release_date,
  CAST(80 + p_size AS INTEGER) AS runtime,
  CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS popularity,
  CAST(CASE p_partkey % 3 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE p_partkey * 1000 END AS BIGINT) AS budget
FROM part"""

VIEWS["theaters"] = """
SELECT CAST(n_nationkey AS BIGINT) AS id,
  CASE n_nationkey
    WHEN 1 THEN 'Cinéma Beaubien' WHEN 3 THEN 'Cinéma RGFM Beloeil' WHEN 5 THEN 'Cinéma Élysée (Granby)'
    WHEN 7 THEN 'Cinémathèque québécoise' WHEN 9 THEN 'Cinéma Banque Scotia' WHEN 11 THEN 'CINEMA  MAGOG'
    ELSE concat(CASE WHEN n_nationkey % 2 = 0 THEN 'Cineplex ' ELSE 'Cinema ' END, n_name) END AS name,
  CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE concat('Chain ', n_regionkey) END AS company,
  CAST(NULL AS INTEGER) AS screens,
  CASE WHEN n_nationkey % 10 = 4 THEN NULL ELSE CAST(1000 + n_nationkey AS VARCHAR) END AS theater_api_id,
  concat('https://theatres.example/', n_nationkey) AS showings_url
FROM nation"""

VIEWS["screens"] = """
SELECT s_suppkey AS id, CAST(s_nationkey AS BIGINT) AS theater_id, concat('Salle ', s_suppkey) AS name,
  CAST(80 + (s_suppkey % 11) * 20 AS INTEGER) AS seat_count
FROM supplier"""

VIEWS["showing_facts"] = """
SELECT e.event_id AS id, e.user_id AS movie_id, CAST(s.s_nationkey AS BIGINT) AS theater_id,
  s.s_suppkey AS true_screen, 80 + (s.s_suppkey % 11) * 20 AS true_seats,
  CASE WHEN e.event_id % 7 = 0 THEN NULL ELSE s.s_suppkey END AS screen_id,
  e.ts AS start_at, CAST(e.ts - INTERVAL '5' HOUR AS DATE) AS date,
  e.value AS value,
  CAST(CASE WHEN e.event_type = 'error' OR e.user_id % 13 = 5
         OR (e.user_id % 11 = 7 AND e.ts >= TIMESTAMP '2024-01-19 05:00:00' AND e.ts < TIMESTAMP '2024-01-22 05:00:00')
       THEN NULL ELSE least(floor(e.value), 80 + (s.s_suppkey % 11) * 20) END AS INTEGER) AS seats_sold
FROM (SELECT events.*, event_id % n AS supplier_key FROM events, (SELECT count(*) AS n FROM supplier)) e JOIN supplier s ON s.s_suppkey = e.supplier_key"""

VIEWS["showings"] = """
SELECT id, movie_id, theater_id, screen_id, start_at, date, seats_sold,
  CASE WHEN id % 4 = 1 THEN concat('https://tickets.example/old?P3=', 50000 + id % 500) END AS purchase_url
FROM showing_facts"""

VIEWS["local_days"] = """
SELECT DISTINCT date AS d, isodow(date) - 1 AS wd FROM showings"""

VIEWS["weekends"] = """
SELECT DISTINCT CAST(isoyear(d) * 100 + week(d) AS INTEGER) AS id,
  d + CAST(4 - wd AS INTEGER) AS start_date, d + CAST(6 - wd AS INTEGER) AS end_date
FROM local_days"""

VIEWS["weekend_takings"] = """
SELECT film_id, weekend_id, v, CAST(round(v * CASE WHEN film_id % 3 = 0 THEN 5 ELSE 100 END) AS BIGINT) AS revenue_qc
FROM (
  SELECT e.user_id AS film_id,
    CAST(isoyear(CAST(e.ts - INTERVAL '5' HOUR AS DATE)) * 100 + week(CAST(e.ts - INTERVAL '5' HOUR AS DATE)) AS INTEGER) AS weekend_id,
    sum(CAST(e.value AS DECIMAL(12,2))) AS v
  FROM events e
  WHERE isodow(CAST(e.ts - INTERVAL '5' HOUR AS DATE)) - 1 >= 4 AND e.event_type <> 'error'
  GROUP BY 1, 2)
WHERE film_id % 4 <> 3 AND NOT (weekend_id = 202403 AND film_id % 3 <> 0 AND film_id % 5 <> 0)"""

VIEWS["revenues"] = """
SELECT film_id, weekend_id, revenue_qc,
  CASE WHEN film_id % 3 = 0 THEN 'cinoche' ELSE 'estimate' END AS data_source,
  CAST(sum(revenue_qc) OVER (PARTITION BY film_id ORDER BY weekend_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulatif_qc_to_date,
  CASE WHEN film_id % 3 = 0 THEN CAST(row_number() OVER (PARTITION BY weekend_id, film_id % 3 ORDER BY v DESC, film_id) AS INTEGER) END AS rank
FROM weekend_takings"""

VIEWS["measurements"] = """
SELECT f.id AS showing_id, f.movie_id, f.theater_id,
  CASE f.id % 6 WHEN 0 THEN NULL WHEN 1 THEN concat('Salle ', f.true_screen)
    WHEN 2 THEN concat('SALLE ', lpad(CAST(f.true_screen AS VARCHAR), CAST(greatest(3, length(CAST(f.true_screen AS VARCHAR))) AS INTEGER), '0'))
    WHEN 3 THEN concat('Auditorium #', f.true_screen, ' bis') WHEN 4 THEN 'le' ELSE concat('Grande Salle ', f.true_screen % 10) END AS auditorium,
  CASE WHEN f.id % 17 = 0 THEN NULL ELSE CAST(f.true_seats - floor(f.value) AS INTEGER) END AS seats_remaining,
  CAST(f.true_seats + f.id // 7 % 25 - 12 AS INTEGER) AS capacity,
  CASE WHEN f.id % 4 = 0 THEN 'cineentreprise' ELSE 'cineplex' END AS source,
  f.start_at + INTERVAL '13' MINUTE AS measured_at
FROM showing_facts f"""

# Starts set to the last full four-hour block, so several shows share a theatre and a time.
VIEWS["block_showings"] = """
SELECT f.id, f.movie_id, f.theater_id, f.date, f.screen_id, f.true_screen, f.true_seats,
  date_trunc('day', f.start_at - INTERVAL '5' HOUR) + to_hours(CAST(extract(hour FROM f.start_at - INTERVAL '5' HOUR) AS BIGINT) // 4 * 4) AS local_start,
  coalesce(m.fr_title, m.title) AS movie_title, m.runtime
FROM showing_facts f JOIN movies m ON m.id = f.movie_id"""

VIEWS["schedule_items"] = """
SELECT theater_id, date, CAST(id AS INTEGER) AS pos,
  CASE WHEN id % 5 = 0 THEN left(movie_title, 8) WHEN id % 5 = 1 THEN concat(movie_title, ' VF')
    WHEN id % 5 = 2 THEN concat(movie_title, ' (VOSTFR) 3D') WHEN id % 5 = 3 THEN concat('IMAX: ', movie_title)
    ELSE movie_title END AS title,
  strftime(local_start, '%H:%M') AS time,
  CAST(100000 + id AS VARCHAR) AS key,
  concat('https://tickets.example/Film-achat.awp?P1=01&P2=01&P3=', 100000 + id) AS url
FROM block_showings"""

VIEWS["probe_outcomes"] = """
SELECT f.id AS showing_id, c.seat_count AS candidate, c.seat_count <= f.true_seats AS ok
FROM showing_facts f
JOIN (SELECT DISTINCT theater_id, seat_count FROM screens) c ON c.theater_id = f.theater_id
WHERE f.screen_id IS NULL"""

VIEWS["wanted_shows"] = """
SELECT id AS showing_id, theater_id, date, strftime(local_start, '%H:%M') AS time, movie_title AS title,
  CASE WHEN id % 8 = 0 THEN NULL ELSE runtime END AS runtime, CASE WHEN id % 3 = 0 THEN 'FR' WHEN id % 3 = 1 THEN 'EN' END AS language
FROM block_showings"""

VIEWS["sessions"] = """
SELECT theater_id, id AS pos,
  CASE id % 4 WHEN 0 THEN movie_title WHEN 1 THEN upper(movie_title) WHEN 2 THEN concat(movie_title, ' 3D') ELSE left(movie_title, 7) END AS movie_name,
  concat('/film/', movie_id) AS film_url,
  CAST(CASE WHEN id % 9 = 0 THEN NULL ELSE runtime + id % 13 - 6 END AS INTEGER) AS runtime_minutes,
  CASE WHEN id % 2 = 0 THEN 'FR' ELSE 'EN' END AS language_code,
  CASE id % 3 WHEN 0 THEN 'Regular' WHEN 1 THEN 'D-BOX' ELSE 'UltraAVX' END AS experience,
  concat(' Salle ', true_screen, ' ') AS auditorium,
  strftime(local_start, '%Y-%m-%dT%H:%M:%S') AS start_local,
  CASE WHEN id % 10 = 0 THEN NULL ELSE concat('s', id // 2) END AS session_id,
  CAST(true_seats - id % 70 AS INTEGER) AS seats_remaining,
  CASE id % 5 WHEN 0 THEN '0000000001' WHEN 1 THEN '0000000004' ELSE '0000000002' END AS area_code,
  date, strftime(local_start, '%H:%M') AS time,
  CASE WHEN id % 6 = 0 THEN date + 1 ELSE date END AS session_date
FROM block_showings"""

VIEWS["search_wants"] = """
SELECT p_partkey AS want_id,
  CASE p_partkey % 5 WHEN 0 THEN concat(p_name, ' VF') WHEN 1 THEN concat('Le ', p_name) WHEN 2 THEN concat(p_brand, ' : ', p_name) WHEN 3 THEN concat('Inconnu ', p_brand) ELSE p_name END AS title,
  CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST(2021 + p_size % 6 AS INTEGER) END AS year_hint,
  concat(p_type, ' ', p_name) AS extra_query
FROM part"""

VIEWS["search_results"] = """
SELECT CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN concat('Le ', p_name) ELSE concat(p_brand, ' | ', p_name) END AS query,
  CAST(2022 + p_size % 4 AS INTEGER) AS year, CAST(p_partkey AS INTEGER) AS pos, 500000 + p_partkey AS id,
  CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN upper(p_name) WHEN 2 THEN concat(p_name, ' deux') ELSE p_brand END AS title,
  CASE p_partkey % 7 WHEN 0 THEN concat('The ', p_name) WHEN 1 THEN p_name ELSE p_type END AS original_title,
  CASE WHEN p_partkey % 13 = 0 THEN '' ELSE concat(CAST(2021 + p_partkey % 6 AS VARCHAR), '-05-01') END AS release_date,
  CASE WHEN p_partkey % 4 = 1 THEN 99 ELSE 18 END AS genre, CAST(p_size * 1.5 AS DOUBLE) AS popularity
FROM part"""
