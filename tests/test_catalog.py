"""Every registered query against its comparison SQL on the smallest tables."""

import pytest

from compare import compare, duck
from reelhouse.catalog import load_catalog

CATALOG = load_catalog()
# Rare cases that the smallest tables may not hold.
MAY_BE_EMPTY = {"q05_work_list", "t06_unmapped_side_output", "k04_missing_data_alert_rows"}


@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query(spark, con, folder, name):
    text, ok, _ = compare(spark, con, name, CATALOG[name], folder)
    if name in MAY_BE_EMPTY and text == "0 rows":
        return
    assert ok, text


def test_every_query_has_sql():
    assert [n for n, q in CATALOG.items() if q.sql is None] == []


def test_driver_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns[0] == "film_id"
    assert set(entry.oracle_sql()) <= set(entry.queries())
