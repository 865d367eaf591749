"""The stored inventory."""

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from scanlake.operators.domains import latest_domains
from scanlake.store import Inventory, add_scan, create_generic


def test_append_replace_rewrite(spark, tmp_path, write_text):
    cap1 = write_text("c1.txt", "Discovered open port 80/tcp on 10.0.0.1\nDiscovered open port 22/tcp on 10.0.0.2\n")
    cap2 = write_text("c2.txt", "10.0.0.3:443\n")
    inv = Inventory(spark, str(tmp_path / "inv"))
    assert inv.read().count() == 0
    b1, n1 = add_scan(spark, inv, cap1, "masscan")
    b2, n2 = add_scan(spark, inv, cap1, "masscan")
    assert (b1, n1, b2, n2) == (1, 2, 2, 2)
    assert inv.read().count() == 4 and inv.version() == 1
    b3, n3 = add_scan(spark, inv, cap2, "generic", rm=True)
    assert n3 == 1 and [r.ip for r in inv.read().collect()] == ["10.0.0.3"] and inv.version() == 2
    assert [r.seq.batch_id for r in inv.read().collect()] == [b3] == [r.batch_id for r in inv.read().collect()]


def names_of(inv):
    return {r.ip: r.domains for r in latest_domains(inv.read(), delta=inv.names()).collect()}


def test_names_added_later_hold_until_a_rescan(spark, tmp_path, write_text):
    inv = Inventory(spark, str(tmp_path / "inv"))
    cap = write_text("c1.txt", "10.0.0.1:80\n10.0.0.2:22\n")
    add_scan(spark, inv, cap, "generic")
    assert names_of(inv) == {"10.0.0.1": [], "10.0.0.2": []}
    files = {p for p in (tmp_path / "inv").rglob("*.parquet")}
    inv.add_names(spark.createDataFrame([("b.x", "10.0.0.1"), ("a.x", "10.0.0.1"), ("a.x", "10.0.0.2")], "domain string, ip string"))
    inv.add_names(spark.createDataFrame([("b.x", "10.0.0.1"), ("c.x", "10.0.0.1")], "domain string, ip string"))
    assert names_of(inv) == {"10.0.0.1": ["a.x", "b.x", "c.x"], "10.0.0.2": ["a.x"]}
    assert files == {p for p in (tmp_path / "inv" / "v=1").rglob("*.parquet")}      # no observation is written again
    add_scan(spark, inv, write_text("c2.txt", "10.0.0.1:443\n"), "generic")
    assert names_of(inv) == {"10.0.0.1": [], "10.0.0.2": ["a.x"]}                    # hidden by the rescan
    union = latest_domains(inv.read(), "union", inv.names())
    assert {r.ip: r.domains for r in union.collect()} == {"10.0.0.1": ["a.x", "b.x", "c.x"], "10.0.0.2": ["a.x"]}
    add_scan(spark, inv, cap, "generic", rm=True)
    assert inv.names().count() == 0


def test_seq_orders_rows(spark, tmp_path, write_text):
    cap = write_text("c.txt", "\n".join(f"10.0.0.1:{p}" for p in range(1, 30)) + "\n")
    inv = Inventory(spark, str(tmp_path / "inv"))
    add_scan(spark, inv, cap, "generic")
    got = [r.port for r in inv.read().orderBy("seq").collect()]
    assert got == list(range(1, 30))


def test_create_generic(spark, tmp_path, write_text):
    scan = write_text("s.txt", "10.0.0.1:80\n10.0.0.2:22\n10.0.0.1:443\n")
    res = write_text("r.txt", "b.example [10.0.0.1]\na.example [10.0.0.1]\n")
    inv = Inventory(spark, str(tmp_path / "inv"))
    assert create_generic(spark, inv, scan, res) == 2
    assert sorted((r.ip, r.port) for r in inv.read().collect()) == [("10.0.0.1", 80), ("10.0.0.1", 443), ("10.0.0.2", 22)]
    assert names_of(inv) == {"10.0.0.1": ["a.example", "b.example"], "10.0.0.2": []}
    bad = write_text("bad.txt", "10.0.0.1:80\n\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        create_generic(spark, Inventory(spark, str(tmp_path / "inv2")), bad)


def test_appends_that_saw_the_same_state_are_both_kept(spark, tmp_path, monkeypatch, write_text):
    inv = Inventory(spark, str(tmp_path / "two"))
    add_scan(spark, inv, write_text("a.txt", "10.0.0.1:1\n"), "generic")
    monkeypatch.setattr(Inventory, "_state", lambda self: (1, 2))
    add_scan(spark, inv, write_text("b.txt", "10.0.0.2:2\n"), "generic")
    add_scan(spark, inv, write_text("c.txt", "10.0.0.3:3\n"), "generic")
    assert sorted(r.ip for r in inv.read().collect()) == ["10.0.0.1", "10.0.0.2", "10.0.0.3"]


def test_a_write_that_fails_leaves_nothing_to_read(spark, tmp_path, write_text):
    inv = Inventory(spark, str(tmp_path / "died"))
    with pytest.raises((PySparkException, Py4JJavaError)):
        add_scan(spark, inv, write_text("bad.txt", "10.0.0.1:1\nfoo:bar\n"), "generic")
    assert inv.version() is None and inv.read().count() == 0
    add_scan(spark, inv, write_text("a.txt", "10.0.0.1:1\n"), "generic")
    with pytest.raises((PySparkException, Py4JJavaError)):
        add_scan(spark, inv, write_text("bad.txt", "10.0.0.1:1\nfoo:bar\n"), "generic", rm=True)
    assert inv.version() == 1 and inv.read().count() == 1


def test_first_capture_without_a_match(spark, tmp_path):
    from scanlake.store import Inventory

    inv = Inventory(spark, str(tmp_path / "none"))
    inv.append(inv.read())
    assert inv.read().count() == 0
