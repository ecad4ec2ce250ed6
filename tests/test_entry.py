"""Driver contract: entry runs, every query has a callable, oracle keys are a subset."""

import __spark_entry__ as E
from tests.conftest import SF


def test_entry_runs(spark):
    rows = E.entry(spark).collect()
    assert {r.split for r in rows} == {"train", "test"}
    assert all(0 <= r.accuracy <= 1 for r in rows)


def test_oracle_keys_subset():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_small_queries_run(spark):
    qs = E.queries()
    for name in ["p8_shape", "g1_split", "r4_top_runs", "f10_label_decode"]:
        assert qs[name](spark, SF).count() >= 0
