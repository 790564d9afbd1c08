"""Every query with an oracle matches DuckDB exactly (small scale factor)."""

import pytest

from climark.plans import catalog
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck

catalog.load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, catalog.QUERIES[name], catalog.ORACLE[name], SF_SMALL)
    assert ok, msg


def test_every_inventory_id_is_registered():
    ids = set(catalog.SURVEY_ID.values())
    expected = {f"A0{i}" for i in range(1, 10)} | {f"B{i:02d}" for i in range(1, 17)} \
        | {f"C0{i}" for i in range(1, 8)} | {f"D{i:02d}" for i in range(1, 18)} \
        | {f"E0{i}" for i in (1, 2, 3, 5, 6, 7, 8)} | {f"F0{i}" for i in range(1, 8)} | {"G01"} \
        | {f"L{i:02d}" for i in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 13, 14)} | {"K01", "K02", "K03", "K04"} \
        | {"I01", "I02"}
    assert expected <= ids, sorted(expected - ids)
