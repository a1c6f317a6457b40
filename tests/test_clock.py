from datetime import datetime
from types import SimpleNamespace

import pytest

from casebridge.config import Run
from casebridge.functions.clock import run_clock
from casebridge.operators.staging import staging_root


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_one_clock_in_every_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        at = datetime(2026, 1, 1, 0, 0, 7, 250_000)
        row = spark.range(1).select(run_clock(Run("r", at, 0)).alias("now")).selectExpr("now", "CAST(now AS string) AS text")
        assert row.schema["now"].dataType.simpleString() == "timestamp_ntz"
        assert tuple(row.first()) == (at, "2026-01-01 00:00:07.25")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_staging_root_is_a_shared_folder(spark):
    assert staging_root(spark) == spark.conf.get("spark.checkpoint.dir")
    settings = {"spark.sql.warehouse.dir": "hdfs://shared/warehouse"}
    unset = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, *default: settings.get(key, *default)),
        sparkContext=SimpleNamespace(getCheckpointDir=lambda: None),
    )
    assert staging_root(unset) == "hdfs://shared/warehouse/staging"
