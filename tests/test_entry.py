"""Driver contract."""

import __spark_entry__ as E


def test_registry_keys_match():
    qs, orc = E.queries(), E.oracle_sql()
    assert len(qs) >= 80
    assert set(orc) <= set(qs)


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["ip", "n_ports", "line"] and len(rows) > 0
    assert all(r.line.startswith(f"IP {r.ip} (") for r in rows)
