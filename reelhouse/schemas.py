"""Table schemas of the box-office model. Instants are UTC wall clock (timestamp_ntz)."""

from __future__ import annotations

from pyspark.sql.types import StructType

SCHEMAS: dict[str, str] = {
    "movies": (
        "id bigint, title string, fr_title string, release_date date, popularity double, "
        "poster_path string, backdrop_path string, budget bigint, runtime int, "
        "provisional boolean, source_url string"
    ),
    "weekends": "id int, start_date date, end_date date",
    "revenues": (
        "film_id bigint, weekend_id int, revenue_qc bigint, revenue_us bigint, rank int, "
        "cumulatif_qc_to_date bigint, cumulatif_us_to_date bigint, change_qc decimal(6,2), "
        "data_source string, average_showing_occupancy decimal(6,4), "
        "showings_proportion decimal(6,4)"
    ),
    "showings": (
        "id bigint, movie_id bigint, theater_id bigint, start_at timestamp_ntz, date date, "
        "screen_id bigint, seats_sold int, purchase_url string, scraped_at timestamp_ntz"
    ),
    "theaters": (
        "id bigint, name string, company string, screens int, theater_api_id string, "
        "showings_url string"
    ),
    "screens": "id bigint, theater_id bigint, name string, seat_count int",
    "genres": "id bigint, name string",
    "movie_genres": "movie_id bigint, genre_id bigint",
    "countries": "code string, name string",
    "movie_countries": "movie_id bigint, country_code string",
    "studios": "id bigint, name string",
    "movie_studio": "movie_id bigint, studio_id bigint",
    "crew": (
        "id bigint, name string, known_for_department string, popularity double, gender int, "
        "image_path string"
    ),
    "movie_crew": "movie_id bigint, crew_id bigint, job string",
    "actors": (
        "id bigint, name string, popularity double, gender int, profile_path string, "
        "known_for_department string"
    ),
    "movie_actors": "movie_id bigint, actor_id bigint, `order` int",
    "measurements": (
        "showing_id bigint, movie_id bigint, theater_id bigint, auditorium string, "
        "seats_remaining int, capacity int, source string, measured_at timestamp_ntz"
    ),
    "schedule_items": (
        "theater_id bigint, date date, pos int, title string, time string, key string, url string"
    ),
    "probe_outcomes": "showing_id bigint, candidate int, ok boolean",
    "raw_pages": "url string, source string, fetched_at timestamp_ntz, html string",
}


def schema_of(name: str) -> StructType:
    """Declared schema of a table as a type (needs a running session)."""
    return StructType.fromDDL(SCHEMAS[name])
