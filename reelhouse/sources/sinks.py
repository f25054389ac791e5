"""File sinks of the reports."""

from __future__ import annotations

from pyspark.sql import DataFrame

from reelhouse.plans.reports import CENSUS_COLUMNS, PROBE_COLUMNS, nested_schedule

# Fields with a comma, quote or line break are quoted, inner quotes doubled, missing values empty.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "nullValue": "", "emptyValue": ""}


def _write_csv(rows: DataFrame, path: str, columns: list[str]) -> None:
    rows.select(*columns).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_census(rows: DataFrame, path: str) -> None:
    _write_csv(rows, path, CENSUS_COLUMNS)


def write_window_probe(rows: DataFrame, path: str) -> None:
    _write_csv(rows, path, PROBE_COLUMNS)


def write_nested_schedule(shows: DataFrame, path: str) -> None:
    """One JSON object per film and month: {"movie": ..., "month": ..., "schedule": {date: [{time, salle}]}}."""
    nested_schedule(shows).write.mode("overwrite").json(path)
