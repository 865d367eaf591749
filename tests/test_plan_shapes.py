"""Plan guards: the physical plans keep the scale properties the README claims."""

import contextlib
import re
import io

import pytest

import __spark_entry__ as E
from scanlake.operators import select as sel
from scanlake.operators import views as vw
from scanlake.operators import domains as dom

SF = "/root/testdata/sf0.001"


def plan(df, mode="simple"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def unpartitioned_window(p: str) -> bool:
    """A Window fed by an ``Exchange SinglePartition`` sorts everything in one task."""
    lines = p.splitlines()
    for i, line in enumerate(lines):
        if "Window [" in line:
            for nxt in lines[i + 1:]:
                if "Exchange" in nxt:
                    if "SinglePartition" in nxt:
                        return True
                    break
    return False


SINGLE_PARTITION_OK: set[str] = set()


def test_no_cross_or_nested_loop_joins(spark):
    bad = {}
    for name, fn in E.queries().items():
        p = plan(fn(spark, SF))
        hits = [k for k in ("CartesianProduct", "BroadcastNestedLoopJoin") if k in p]
        if unpartitioned_window(p) and name not in SINGLE_PARTITION_OK:
            hits.append("unpartitioned window")
        if hits:
            bad[name] = hits
    assert bad == {}


@pytest.fixture
def stored(spark, tmp_path):
    df = spark.createDataFrame([(1, "10.0.0.1", 167772161, 80, ["a"]), (2, "10.1.0.1", 167837697, 22, [])],
                               "seq long, ip string, ip_num long, port int, domains array<string>")
    p = str(tmp_path / "inv")
    df.write.parquet(p)
    return spark.read.parquet(p)


def test_guard_sees_unpartitioned_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    df = spark.range(10).withColumn("r", F.row_number().over(Window.orderBy("id")))
    assert unpartitioned_window(plan(df))
    assert not unpartitioned_window(plan(E.queries()["r3_merge_text"](spark, SF)))


def test_range_filter_reaches_scan(spark, stored):
    p = plan(sel.select_hosts(spark, stored, "10.1.0.0/16,10.0.0.0/24"), "formatted")
    assert "PushedFilters: [Or(" in p and "ip_num" in p


def test_many_selectors_read_the_inventory_once_by_range(spark, stored):
    spec = ",".join(f"10.{i // 250}.{i % 250}.0/24" for i in range(1000))
    p = plan(sel.select_hosts(spark, stored, spec), "formatted")
    scans = [x for x in p.split("\n\n") if "Scan parquet" in x and "seq:" in x and "ReadSchema" in x]
    assert len(scans) == 1
    assert "GreaterThanOrEqual(ip_num" in scans[0] and "LessThanOrEqual(ip_num" in scans[0]


def test_partial_aggregation(spark, stored):
    assert "partial_collect_set" in plan(vw.host_ports(stored))
    assert "partial_max_by" in plan(dom.latest_domains(stored))


def test_projection_pruned(spark, stored):
    p = plan(vw.host_ports(stored), "formatted")
    assert "ReadSchema: struct<ip:string,port:int>" in p


def test_port_list_reaches_scan(spark, stored):
    p = plan(sel.select_by_ports(spark, stored, "22,443"), "formatted")
    assert re.search(r"PushedFilters: \[.*In\(port, \[22,443\]\)", p)


@pytest.mark.parametrize("fn", [dom.add_domains, dom.update_domains])
def test_rows_are_not_multiplied_by_their_names(spark, stored, fn):
    res = spark.createDataFrame([("a", "10.0.0.1"), ("b", "10.0.0.1")], "domain string, ip string")
    out = fn(stored.select("seq", "ip", "port", "domains"), res)
    p = plan(out)
    assert "Generate" not in p and "hashpartitioning(seq" not in p
    assert {(r.ip, tuple(r.domains)) for r in out.collect()} == {("10.0.0.1", ("a", "b")), ("10.1.0.1", ())}


def test_rows_with_the_names_of_their_hosts_are_not_shuffled(spark):
    p = plan(E.queries()["t3_create_generic"](spark, SF))
    assert "Exchange hashpartitioning" not in p and "array_join" not in p
