"""Every registered query beside its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import pytest

from lakemill import registry
from tests.compare import difference, duck

FOLDER = "/root/testdata/sf0.001"
ENTRIES = registry.load()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_inventory_is_whole():
    sizes = {"S": 15, "P": 20, "J": 11, "A": 25, "W": 15, "L": 4, "U": 6, "F": 35, "D": 29, "V": 8, "Q": 43, "G": 10, "R": 5}
    expected = {f"{letter}{i:02d}" for letter, n in sizes.items() for i in range(1, n + 1)}
    assert set(ENTRIES) == expected


@pytest.mark.parametrize("name", sorted(ENTRIES))
def test_query(spark, con, name):
    assert difference(spark, con, ENTRIES[name], FOLDER) is None


def test_every_query_has_sql():
    assert not [n for n, e in ENTRIES.items() if e.sql is None]
