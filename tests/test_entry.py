import os

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    r = df.collect()
    assert len(r) == 5 and set(df.columns) >= {"r_name", "n_orders", "avg_amount"}


def test_every_query_has_callable_and_runs_on_smallest_sf(spark):
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    from kempt.plans.queries import ORACLE, QUERIES
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(qs)
    if os.path.isdir(SF):
        for name in ("flagship", "profile", "upsert", "run_pipeline"):
            assert qs[name](spark, SF).count() >= 0
