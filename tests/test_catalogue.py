"""Every catalogue query against its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from compare import connect, differences

from tidewheel.plans.catalogue import QUERIES
from tidewheel.plans.oracles import ORACLES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, sf_dir, name):
    assert differences(spark, duck, QUERIES[name], ORACLES[name], sf_dir) == []


def test_digests_are_stable(spark, sf_dir):
    first, again = (QUERIES["event_digest"](spark, sf_dir) for _ in range(2))
    assert first.exceptAll(again).isEmpty()
    assert first.select("event_id").where("length(event_id) <> 64").isEmpty()


def test_flagship(spark):
    rows = contract.entry(spark).collect()
    total = {}
    for r in rows:
        total[r.outcome] = total.get(r.outcome, 0) + r.rows
    assert total == {"accepted": 808, "duplicate": 42, "quarantined": 200}
