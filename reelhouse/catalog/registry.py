"""Registry of the queries this package offers, each with its comparison SQL where SQL can say it."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from reelhouse.catalog.comparison_views import VIEWS


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CATALOG: dict[str, Query] = {}


def with_views(body: str) -> str:
    """Put the definitions of the views a comparison query names in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, definition in VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(definition)
                needed.append(name)

    visit(body)
    if not needed:
        return body
    definitions = ",\n".join(f"{name} AS (\n{VIEWS[name]}\n)" for name in needed)
    head = f"WITH {definitions}"
    stripped = body.lstrip()
    if stripped[:5].upper() == "WITH ":
        return f"{head},\n{stripped[5:]}"
    return f"{head}\n{body}"


def query(name: str, sql: str | None = None):
    def add(run: Callable[[SparkSession, str], DataFrame]):
        assert name not in CATALOG, name
        CATALOG[name] = Query(run, with_views(sql) if sql is not None else None)
        return run

    return add
