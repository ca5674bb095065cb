"""The at-scale plan paths give the same table as the small-data ones.

With every broadcast disabled (hints withheld by the size checks, Catalyst's
and AQE's automatic broadcasts off) each join becomes a shuffle join — the
plan a full-size run gets when a side exceeds its bound.
"""

from slotwise.plans import fixture_run as fr
from tests.conftest import SMALL
from tools.oracle_check import rows_of

NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


def test_shuffle_join_paths_match(spark):
    baseline = rows_of(fr.fixture_run(spark, SMALL).output.toPandas())
    saved = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    try:
        for k, v in NO_BROADCAST.items():
            spark.conf.set(k, v)
        for share in (True, False):
            fr._RUNS.clear()
            spark.catalog.clearCache()
            run = fr.fixture_run(spark, SMALL, max_broadcast_rows=0, share_content=share)
            plan = run.output._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan
            assert rows_of(run.output.toPandas()) == baseline
    finally:
        for k, v in saved.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
        fr._RUNS.clear()
        spark.catalog.clearCache()
