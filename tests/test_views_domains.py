"""A1-A6, P1-P6, domains."""

import pytest

from scanlake.operators import domains as dom
from scanlake.operators import views as vw
from scanlake.sources import domains as sdom


@pytest.fixture
def obs(spark):
    data = [(1, "10.0.0.10", 443, ["a.example"]), (2, "10.0.0.9", 22, []), (3, "10.0.0.10", 80, ["b.example"]),
            (4, "10.0.0.9", 22, []), (5, "10.0.0.10", 443, [])]
    return spark.createDataFrame(data, "seq long, ip string, port int, domains array<string>")


def test_host_ports_and_listing(obs):
    hp = {r.ip: (r.ports, r.n_ports) for r in vw.host_ports(obs).collect()}
    assert hp == {"10.0.0.10": ([80, 443], 2), "10.0.0.9": ([22], 1)}
    lines = [r.line for r in vw.host_listing(obs).orderBy("ip_num").collect()]
    assert lines == ["IP 10.0.0.9 (1) -> [22]", "IP 10.0.0.10 (2) -> [80,443]"]


def test_latest_domains_hidden_by_rescan(obs):
    # the last row of 10.0.0.10 has no domains, so the listing shows none
    got = {r.ip: r.domains for r in dom.latest_domains(obs).collect()}
    assert got == {"10.0.0.10": [], "10.0.0.9": []}
    union = {r.ip: r.domains for r in dom.latest_domains(obs, mode="union").collect()}
    assert union["10.0.0.10"] == ["a.example", "b.example"]


def test_raw_listing_with_domains(spark):
    df = spark.createDataFrame([(1, "10.0.0.1", 80, ["x.example"]), (2, "10.0.0.1", 22, ["x.example"])],
                               "seq long, ip string, port int, domains array<string>")
    got = [r.line for r in vw.host_listing_raw(df, dns=True).orderBy("ip_num", "port", "k").collect()]
    assert got == ["10.0.0.1:22", "x.example:22", "10.0.0.1:80", "x.example:80"]


def test_port_views_long_and_array_agree(obs):
    long = {(r.port, r.ip) for r in vw.port_hosts(obs).collect()}
    pairs = {(r.ip, p) for r in vw.host_ports(obs).collect() for p in r.ports}
    assert long == {(p, i) for i, p in pairs}
    arr = vw.port_listing(obs).orderBy("port").collect()
    assert [r.line for r in arr] == ["Port 22 (1) -> [10.0.0.9]", "Port 80 (1) -> [10.0.0.10]",
                                     "Port 443 (1) -> [10.0.0.10]"]
    assert vw.port_listing_raw(obs).count() == len(long)


def test_port_blocks_split_hot_ports(spark):
    rows = [(i, f"10.{i % 4}.0.{i // 4}", 443, []) for i in range(400)] + [(500, "10.0.0.1", 22, [])]
    df = spark.createDataFrame(rows, "seq long, ip string, port int, domains array<string>")
    b = vw.port_worklist(df, block_hosts=100).orderBy("port", "block").collect()
    assert [(r.stem, r.block, r.n_block, r.n_hosts) for r in b] == [("port22", 0, 1, 1)] + [(f"port443_{i}", i, 100, 400) for i in range(4)]
    two = vw.port_listing(df, block_hosts=150).where("port = 443").orderBy("block").collect()
    assert [(r.block, r.n_block) for r in two] == [(0, 200), (1, 100), (2, 100)]
    assert all(r.line.startswith(f"Port 443 ({r.n_block}) -> [") and r.line.count(",") == r.n_block - 1 for r in two)
    assert [r.line for r in vw.port_listing(df).where("port = 22").collect()] == ["Port 22 (1) -> [10.0.0.1]"]


def test_many_names_on_one_port_stay_in_bounds(spark):
    from pyspark.sql import functions as F

    names = spark.range(200_000).select("id", F.concat(F.lit("host"), "id", F.lit(".example")).alias("ip"), F.lit(443).alias("port"))
    v4 = spark.range(300).select("id", F.concat(F.lit("10.0.0."), F.col("id") % 250).alias("ip"), F.lit(443).alias("port"))
    b = vw.port_worklist(names.unionByName(v4), block_hosts=20_000)
    got = b.select("stem", "block", "n_block", "n_hosts", F.substring("hosts_csv", 1, 20).alias("head"),
                   (F.size(F.split("hosts_csv", ","))).alias("n")).orderBy("block").collect()
    assert [r.block for r in got] == list(range(len(got))) and len({r.stem for r in got}) == len(got) >= 10
    assert sum(r.n_block for r in got) == 200_250 and all(r.n == r.n_block <= 20_300 and r.n_hosts == 200_250 for r in got)
    assert got[0].head.startswith("10.0.0.0,10.0.0.1,")


def test_worklists_and_counts(obs):
    w = {r.stem: r.ports_csv for r in vw.host_worklist(obs, max_ports_exclusive=2).collect()}
    assert w == {"10.0.0.9": "22"}
    assert vw.count_hosts(obs).first().n_hosts == 2
    assert vw.total_targets(obs, by="port").first().total == 3


def test_empty_inventory(spark):
    e = spark.createDataFrame([], "seq long, ip string, port int, domains array<string>")
    assert vw.host_ports(e).count() == 0 and vw.count_hosts(e).first().n_hosts == 0


def test_t4_t5_agree_and_t5_idempotent(spark, obs):
    res = spark.createDataFrame([("c.example", "10.0.0.10"), ("a.example", "10.0.0.10"), ("z.example", "10.9.9.9")],
                                "domain string, ip string")
    t4 = {r.seq: set(r.domains) for r in dom.add_domains(obs, res).collect()}
    t5 = {r.seq: set(r.domains) for r in dom.update_domains(obs, res).collect()}
    assert t4 == t5
    once = dom.update_domains(obs, res)
    twice = dom.update_domains(once, res)
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    assert t5[1] == {"a.example", "c.example"} and t5[2] == set()
    assert [r.domain for r in dom.unmatched_domains(obs, res).collect()] == ["z.example"]
    assert dom.hosts_updated(obs, res).first().n_hosts == 1


def test_names_are_joined_in_long_form(spark, obs):
    res = spark.createDataFrame([("c.example", "10.0.0.10")], "domain string, ip string")
    for op in (dom.add_domains, dom.update_domains):
        plan = op(obs, res)._jdf.queryExecution().optimizedPlan().toString()
        assert "collect_set" not in plan and plan.count("collect_list") == 1
    names = dom.host_names(obs)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect" not in names


def test_one_grouping_lists_ports_and_names(obs):
    plan = vw.host_listing(obs, dns=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_t4_keeps_existing_order(spark):
    df = spark.createDataFrame([(1, "1.1.1.1", 80, ["z", "a"])], "seq long, ip string, port int, domains array<string>")
    res = spark.createDataFrame([("a", "1.1.1.1"), ("m", "1.1.1.1")], "domain string, ip string")
    assert dom.add_domains(df, res).first().domains == ["z", "a", "m"]


def test_punycode_both_ways(spark, write_text):
    p = write_text("d.txt", "café.example.com\nplain.example.com\n\ncafé.example.com\n")
    ri = sorted(r.domain_ascii for r in sdom.resolver_input(sdom.read_domain_list(spark, p)).collect())
    assert ri == ["plain.example.com", "xn--caf-dma.example.com"]
    r = write_text("r.txt", "xn--caf-dma.example.com [10.0.0.1]\nplain.example.com [10.0.0.2]\n")
    got = sorted((x.domain, x.ip) for x in sdom.read_resolutions(spark, r).collect())
    assert got == [("café.example.com", "10.0.0.1"), ("plain.example.com", "10.0.0.2")]
    a4 = {x.ip: x.domains for x in dom.domains_by_ip(sdom.read_resolutions(spark, r)).collect()}
    assert a4["10.0.0.1"] == ["café.example.com"]


def test_listing_domains_mode(obs):
    latest = {r.ip: r.line for r in vw.host_listing(obs, dns=True).collect()}
    union = {r.ip: r.line for r in vw.host_listing(obs, dns=True, domains_mode="union").collect()}
    assert latest["10.0.0.10"] == "IP 10.0.0.10, Domains [] (2) -> [80,443]"
    assert union["10.0.0.10"] == "IP 10.0.0.10, Domains [a.example,b.example] (2) -> [80,443]"


def test_domain_pairs_match_update(spark, obs):
    res = spark.createDataFrame([("c.example", "10.0.0.10"), ("z.example", "10.9.9.9")], "domain string, ip string")
    pairs = {(r.ip, r.domain) for r in dom.host_domain_pairs(obs, res).collect()}
    upd = {(r.ip, d) for r in dom.update_domains(obs, res).collect() for d in r.domains}
    assert pairs == upd | {(r.ip, d) for r in obs.collect() for d in r.domains}
    assert ("10.9.9.9", "z.example") not in pairs
