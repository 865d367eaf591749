"""F1-F5 and the two CIDR strategies."""

import pytest

from scanlake.sources import selectors as sel_src
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from scanlake.functions.ip import ip_num
from scanlake.operators import select as sel
from scanlake.operators.views import host_ports
from scanlake.sources.selectors import host_ranges, selector_tokens


@pytest.fixture
def obs(spark):
    data = [(1, "10.0.0.1", 80), (2, "10.0.0.2", 22), (3, "10.1.2.3", 443), (4, "10.0.0.1", 443),
            (5, "192.168.0.9", 22), (6, "10.0.0.255", 8080)]
    return spark.createDataFrame(data, "seq long, ip string, port int")


def seqs(df):
    return sorted(r.seq for r in df.select("seq").collect())


def test_all_and_cidr(spark, obs):
    assert seqs(sel.select_hosts(spark, obs, "all")) == [1, 2, 3, 4, 5, 6]
    assert seqs(sel.select_hosts(spark, obs, "10.0.0.0/24")) == [1, 2, 4, 6]
    assert seqs(sel.select_hosts(spark, obs, "10.0.0.1,192.168.0.0/16")) == [1, 4, 5]


def test_overlapping_selectors_give_each_row_once(spark, obs):
    assert seqs(sel.select_hosts(spark, obs, "10.0.0.0/8,10.0.0.0/24,10.0.0.1")) == [1, 2, 3, 4, 6]


def test_any_number_of_selectors_agrees(spark, obs):
    base = ["10.0.0.0/24", "10.0.0.1", "10.1.0.0/16"]
    for n in (0, 61, 62, 997):
        toks = selector_tokens(spark, ",".join(base + [f"172.{16 + i // 250}.{i % 250}.0/24" for i in range(n)]))
        assert seqs(sel.select_cidr(obs, host_ranges(toks))) == [1, 2, 3, 4, 6]


def test_any_number_of_ports_agrees(spark, obs):
    for n in (0, 62, 5000):
        spec = ",".join(["22", "443"] + [str(10000 + 2 * i) for i in range(n)])
        assert seqs(sel.select_by_ports(spark, obs, spec)) == [2, 3, 4, 5]


def test_selector_file(spark, obs, write_text):
    p = write_text("sel.txt", "10.0.0.1\n\n 192.168.0.9 \n")
    assert seqs(sel.select_hosts(spark, obs, p)) == [1, 4, 5]
    q = write_text("all.txt", "all\n")
    assert seqs(sel.select_hosts(spark, obs, q)) == [1, 2, 3, 4, 5, 6]


def test_bad_selector_fails(spark, obs):
    with pytest.raises((PySparkException, Py4JJavaError)):
        sel.select_hosts(spark, obs, "10.0.0.0/24,nonsense").collect()


def test_ports(spark, obs):
    assert seqs(sel.select_by_ports(spark, obs, "22,443")) == [2, 3, 4, 5]
    assert seqs(sel.select_by_ports(spark, obs, "all")) == [1, 2, 3, 4, 5, 6]


def test_new_hosts(spark, obs):
    cat = spark.createDataFrame([("10.0.0.1",), ("port22",)], "stem string")
    assert seqs(sel.new_hosts(obs, cat)) == [2, 3, 5, 6]
    with pytest.raises(ValueError):
        sel.select_hosts(spark, obs, "new")


def test_limit_is_exclusive(spark, obs):
    hp = host_ports(obs)
    assert sorted(r.ip for r in sel.limit_hosts(hp, 2).collect()) == ["10.0.0.2", "10.0.0.255", "10.1.2.3",
                                                                        "192.168.0.9"]
    assert sel.limit_hosts(hp, None).count() == 5


def test_new_and_reported_cover_all(spark, obs):
    cat = spark.createDataFrame([("10.0.0.1",), ("10.1.2.3",), ("port80",)], "stem string")
    new = set(seqs(sel.new_hosts(obs, cat)))
    reported = set(seqs(obs.join(cat.withColumnRenamed("stem", "ip"), "ip", "left_semi")))
    assert new | reported == set(seqs(obs)) and not (new & reported)


def test_netmask_selectors_and_bad_prefixes(spark):
    got = sorted(tuple(r) for r in sel_src.host_ranges(sel_src.selector_tokens(
        spark, "10.0.0.0/255.255.255.0,10.0.1.7/255.255.255.255,0.0.0.0/0.0.0.0")).collect())
    assert got == [(0, 0, 2 ** 32 - 1), (24, 167772160, 167772415), (32, 167772423, 167772423)]
    for bad in ("10.0.0.0/24,10.0.1.0/x", "10.0.0.0/255.0.255.0", "10.0.0.0/33", "10.0.0.0/"):
        with pytest.raises(Exception, match="not an IPv4 address"):
            sel_src.host_ranges(sel_src.selector_tokens(spark, bad)).collect()


def test_a_thousand_mixed_prefixes_agree_with_brute_force(spark):
    import ipaddress
    import random

    r = random.Random(9)
    address = lambda: ipaddress.ip_address((10 << 24) + r.randrange(1 << 20) * r.choice([1, 16]))
    nets = [ipaddress.ip_network((str(address()), r.choice([32, 32, 31, 30, 29, 28, 27, 26, 25])), strict=False) for _ in range(995)]
    nets += [ipaddress.ip_network(x) for x in ("10.9.0.0/16", "10.12.0.0/14", "10.9.3.0/24", "11.0.0.0/8", "10.64.0.0/17")]
    ips = [str(address()) for _ in range(4000)] + [str(n[0]) for n in nets[::3]] + [str(n[-1]) for n in nets[::3]] + ["11.2.3.4", "x", None]
    df = spark.createDataFrame(list(enumerate(ips)), "seq long, ip string")
    want = [i for i, ip in enumerate(ips) if ip and ip != "x" and any(ipaddress.ip_address(ip) in n for n in nets)]
    got = sel.select_hosts(spark, df, ",".join(map(str, nets)))
    assert seqs(got) == want and len(want) > 300
    stored = df.withColumn("ip_num", ip_num("ip"))
    plan = sel.select_hosts(spark, stored, ",".join(map(str, nets)))._jdf.queryExecution().optimizedPlan().toString()
    rows = [line for line in plan.splitlines() if "seq#" in line]
    assert rows and not any("Generate" in line for line in rows)             # no row is multiplied: Generate stands on selectors only


def test_ipv6_selectors(spark):
    import ipaddress

    ips = ["2001:db8::1", "2001:db8:0:1::7", "2001:db9::1", "fe80::1", "::1", "2001:db8:ffff::", "3000::", "10.0.0.1", "10.0.0.2", "host", None,
           "2001:db8::1:0"]
    df = spark.createDataFrame(list(enumerate(ips)), "seq long, ip string")
    for spec in ("2001:db8::/32", "2001:db8::/48,fe80::1", "::/0", "2000::/3,10.0.0.0/30", "::1,::1/128,10.0.0.2", "2001:db8::/112",
                 "2001:db8:0:1::/64,2001:db8::/33", "2001:db8::1:0/127"):
        nets = [ipaddress.ip_network(t, strict=False) for t in spec.split(",")]
        ok = [i for i, ip in enumerate(ips) if ip and ip != "host" and any(
            ipaddress.ip_address(ip).version == n.version and ipaddress.ip_address(ip) in n for n in nets)]
        assert seqs(sel.select_hosts(spark, df, spec)) == ok, spec
    for bad in ("2001:db8::/129", "2001:::1", "fe80::1/x"):
        with pytest.raises(Exception, match="not an IPv6 address"):
            sel.select_hosts(spark, df, bad).collect()
