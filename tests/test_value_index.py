"""The kept index of attribute values: the same results, no shuffle of the values, new values found."""

import re
from dataclasses import replace
from datetime import datetime

import pytest
from compare import connect, difference
from tiny import CFG, World, document

from casebridge.config import Run
from casebridge.operators import link
from casebridge.operators.staging import stage
from casebridge.plans import oracle
from casebridge.plans.queries import QUERIES, _facts, _waiting
from casebridge.plans.run import TransferRun
from casebridge.sources.value_index import build_index, new_values, open_index

SF = "/root/testdata/sf0.001"
RUN = Run("r", datetime(2026, 1, 1), event_base=100)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_the_values_are_not_shuffled(spark, tmp_path, no_broadcast):
    t, facts = _facts(spark, SF)
    index = build_index(t, CFG, "values_plan", f"{tmp_path}/values", 8)
    waiting = stage(_waiting(facts).select("event_id", "key_0", "key_1"), "waiting", ("key_0", "key_1"))
    found = link.match_pairs(waiting, index.lookup(), CFG, [0, 1])
    counted = link.match_counts(waiting, index.lookup().df, CFG)
    try:
        for df in (found, counted):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Bucketed: true") == 2
            # One exchange for each key, both of the events.
            assert re.findall(r"Exchange hashpartitioning\((\w+)#", plan) == ["key_1", "key_0"]
        twin = link.match_pairs(waiting, link.stage_lookup(t, CFG), CFG, [0, 1])
        assert found.exceptAll(twin.select(found.columns)).isEmpty() and twin.select(found.columns).exceptAll(found).isEmpty()
    finally:
        spark.sql("DROP TABLE values_plan")


def test_query_against_sql(spark):
    assert difference(QUERIES["match_both_indexed"](spark, SF), connect(SF), oracle.oracle_sql()["match_both_indexed"]) == ""


def test_a_run_with_an_index_and_values_that_come_later(spark, tmp_path):
    w = World().person(1, "N1", "Ann").person(2, "N2", "Bob").event(5, document("N1", "Ann")).event(6, document("N3", "Cy"))
    t, cfg, folder = w.tables(spark), replace(CFG, static_notice=False), f"{tmp_path}/it's a folder"
    index = build_index(t, cfg, "values_first", folder, 3)
    with pytest.raises(ValueError, match="exists"):
        build_index(t, cfg, "values_first", folder, 3)
    try:
        linked = lambda index: sorted(r["event_id"] for r in TransferRun(later, cfg, RUN, index).links.df.collect())
        later = World()
        later.rows = {k: list(v) for k, v in w.rows.items()}
        later = later.person(3, "N3", "Cy").person(4, None, "Cy").tables(spark)
        assert linked(index) == [5]
        spark.sql("DROP TABLE values_first")  # the files stay: another session opens them
        again = open_index(t, "values_second", folder, 3)
        more = later.trackedentityattributevalue.where("trackedentityinstanceid > 2")
        again.add(new_values(later, cfg, more))
        assert again.lookup().rows == 7 and linked(again) == linked(None) == [5, 6]
        assert {r["n_1"] for r in TransferRun(later, cfg, RUN, again).matched.df.where("event_id = 6").collect()} == {2}
    finally:
        spark.sql("DROP TABLE IF EXISTS values_first")
        spark.sql("DROP TABLE IF EXISTS values_second")
