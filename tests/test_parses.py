"""A document is parsed once for all columns a query gives, of a laid-out table only for those it has no column for."""

import pytest
from tiny import CFG, World, document

from casebridge.plans import queries as module
from casebridge.sources import fixtures
from casebridge.sources.layout import lay_out


def events(spark):
    with_more = document("N1", "Ann").replace("{", '{"labOnly0001":{"value":2.50},', 1)
    return World().person(1, "N1", "Ann").event(1, with_more).event(2, document("N2", "Bob")).event(3, None).tables(spark).programstageinstance


def parses(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("from_json")


def test_every_event_takes_one_parse(spark):
    stored = events(spark)
    plain, laid_out = module._every_event(stored), module._every_event(lay_out(stored, CFG))
    assert parses(plain) == 1
    found = plain.orderBy("event_id").collect()
    assert [(r["id_number"], r["full_name"], r["lab_only"]) for r in found] == [("N1", "Ann", "2.50"), ("N2", "Bob", None), (None, None, None)]
    assert laid_out.orderBy("event_id").collect() == found


@pytest.mark.parametrize("name", ["json_set", "json_merge"])
def test_edited_documents_take_one_parse(spark, name, monkeypatch):
    t = World().person(1, "N1", "Ann").event(1, document("N1", "Ann")).tables(spark)
    monkeypatch.setattr(fixtures, "load", lambda *args, **kwargs: t)
    assert parses(module.QUERIES[name](spark, "")) == 1
