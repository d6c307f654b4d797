"""Every query of the core library agrees with its SQL oracle (smallest scale)."""

from ledgerwise.plans import registry
from tests.conftest import SF_SMALL
from tests.oracle_check import compare


def test_all_queries_match_oracle(spark):
    results = compare(spark, SF_SMALL, sorted(registry.queries()), verbose=False)
    bad = {k: v for k, v in results.items() if v["ok"] is False}
    assert not bad, bad
    assert len(results) >= 40


def test_entry_runs(spark):
    import __spark_entry__ as E

    rows = E.entry(spark).collect()
    assert {r["recon_status"]: r["n"] for r in rows}["MATCHED"] == 998
