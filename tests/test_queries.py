"""Every query against its SQL twin, on the smallest driver tables."""

from concurrent.futures import ThreadPoolExecutor
from functools import cache

import pytest
from compare import connect, difference

import __spark_entry__ as entry_point
from casebridge.plans import oracle
from casebridge.plans import queries as module

SF = "/root/testdata/sf0.001"
SQL = oracle.oracle_sql()
GOLDEN = {"transfer_rows": 306, "mark_transferred": 344, "lab_transfer_rows": 73, "merge_lab": 190}
GOLDEN |= {"ownership_candidates": 130, "update_ownership": 75, "message_rows": 52, "recipients": 5}
GOLDEN |= {"flag_check_name": 127, "flag_no_match": 52, "flag_id_not_found": 218, "filter_waiting": 792}


@pytest.fixture(scope="module")
def differences(spark):
    """Queries share the steps of one run here; each is compared in full."""
    original = module._run
    module._run = cache(original)
    module._run(spark, SF).merged
    con = connect(SF)

    def compare(name):
        df = module.QUERIES[name](spark, SF)
        return difference(df, con.cursor(), SQL[name]), df.count() if name in GOLDEN else None

    with ThreadPoolExecutor(6) as pool:
        yield {name: pool.submit(compare, name) for name in module.QUERIES}
    module._run = original


def test_each_query_has_a_twin():
    assert set(module.QUERIES) == set(SQL)
    assert set(module.QUERIES) <= set(entry_point.queries()) and set(SQL) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", module.QUERIES)
def test_query(name, differences):
    found, count = differences[name].result()
    assert found == ""
    assert count == GOLDEN.get(name)


def test_entry(spark):
    assert entry_point.entry(spark).count() == 306
