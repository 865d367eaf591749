"""Randomised checks against plain-Python models of the same rules."""

import ipaddress

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from scanlake.operators import select as sel
from scanlake.sources.scanners import parse_lines
from scanlake.sources.selectors import host_ranges

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

octet = st.integers(0, 255)
ip4 = st.builds(lambda a, b, c, d: f"{a}.{b}.{c}.{d}", octet, octet, octet, octet)
port_txt = st.one_of(st.integers(0, 65535).map(str), st.sampled_from(["x", "", "8o"]))
word = st.sampled_from(["a", "b:c", "open", "tcp", "x/y", "/", ":"])


def _int_or_none(s):
    try:
        return int(s)
    except ValueError:
        return None


def model_generic(line):
    parts = line.split(":")
    if len(parts) != 2:
        return []
    p = _int_or_none(parts[1])
    return [] if p is None else [(parts[0], p)]


def model_nmap(line, tcp_only):
    t = line.split()
    if len(t) < 4:
        return []
    pp = t[3].split("/")
    if len(pp) != 2 or (tcp_only and pp[1] != "tcp"):
        return []
    p = _int_or_none(pp[0])
    return [] if p is None else [(t[-1], p)]


generic_line = st.one_of(
    st.builds(lambda i, p: f"{i}:{p}", ip4, port_txt),
    st.builds(lambda a, b: f"{a}:{b}", word, word),
    st.just(""), st.builds(lambda i: f"{i}:1:2", ip4))
nmap_line = st.one_of(
    st.builds(lambda p, pr, i: f"Discovered open port {p}/{pr} on {i}", port_txt, st.sampled_from(["tcp", "udp"]), ip4),
    st.builds(lambda ws: " ".join(ws), st.lists(word, max_size=6)),
    st.just("Nmap done: 1 IP address"))


@SETTINGS
@given(st.lists(generic_line, min_size=1, max_size=40))
def test_generic_matches_model(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = sorted((r.ip, r.port) for r in parse_lines(df, "generic", mode="skip").collect())
    want = sorted(r for x in lines for r in model_generic(x))
    assert got == want


@SETTINGS
@given(st.lists(nmap_line, min_size=1, max_size=40), st.booleans())
def test_nmap_masscan_match_model(spark, lines, tcp_only):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    fmt = "masscan" if tcp_only else "nmap"
    got = sorted((r.ip, r.port) for r in parse_lines(df, fmt, mode="skip").collect())
    want = sorted(r for x in lines for r in model_nmap(x, tcp_only))
    assert got == want


cidr = st.builds(lambda a, b, p: f"10.{a}.{b}.0/{p}", st.integers(0, 3), st.integers(0, 255), st.integers(8, 32))
host = st.builds(lambda a, b, c: f"10.{a}.{b}.{c}", st.integers(0, 3), st.integers(0, 255), octet)


@SETTINGS
@given(st.lists(host, min_size=1, max_size=60), st.lists(st.one_of(cidr, host), min_size=1, max_size=90))
def test_cidr_matches_ipaddress(spark, hosts, sels):
    df = spark.createDataFrame(list(enumerate(hosts)), "seq long, ip string")
    nets = [ipaddress.ip_network(s, strict=False) for s in sels]
    want = sorted(i for i, h in enumerate(hosts) if any(ipaddress.ip_address(h) in n for n in nets))
    toks = spark.createDataFrame([(s,) for s in sels], "token string")
    got = sorted(r.seq for r in sel.select_cidr(df, host_ranges(toks)).collect())
    assert got == want
