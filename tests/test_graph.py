"""S18, S19, A7, A8, A11, F10, G1-G3."""

from scanlake.operators import graph as gr
from scanlake.sources import reports as srp
from scanlake.schema import FLAT_COLUMNS


def test_flat_csv_rule(spark, write_text):
    header = ",".join(FLAT_COLUMNS)
    good = "10.0.0.1,h,Linux,tcp,80,http,nginx,fp,,\"out\""
    text = "\n".join([header, good, good + ",extra", "10.0.0.1,h,Linux,icmp,0,a,b,c,d,e",
                      "10.0.0.2,h,Linux,udp,53,domain,bind,fp,,", ""])
    df = gr.read_flat_csv(spark, write_text("f.csv", text))
    got = sorted((r.IP, r.Proto, r.Port, r["NSE Script Output"], r.Notes) for r in df.collect())
    assert got == [("10.0.0.1", "tcp", 80, "out", None), ("10.0.0.2", "udp", 53, None, None)]


def test_dedup_profile_graph(spark, write_text):
    xml = ('<?xml version="1.0"?><nmaprun><host><address addr="10.0.0.1" addrtype="ipv4"/>'
           '<hostnames><hostname name="a" type="PTR"/></hostnames><ports>'
           '<port protocol="tcp" portid="80"><state state="open"/><service name="http" product="p1"/></port>'
           '<port protocol="udp" portid="80"><state state="open"/><service name="x"/></port>'
           '<port protocol="tcp" portid="22"><state state="open"/><service name="ssh"/></port>'
           '</ports><os><osmatch name="Linux"/></os></host>'
           '<host><address addr="10.0.1.5" addrtype="ipv4"/><ports><port protocol="tcp" portid="443">'
           '<state state="open"/><service name="https"/><script id="a" output="1"/><script id="b" output="2"/>'
           '</port></ports></host></nmaprun>')
    flat = gr.flat_table(srp.parse_hosts(srp.read_host_elements(spark, write_text("g.xml", xml))))
    assert flat.count() == 5  # one row per port and script
    first = {(r.IP, r.Port): (r.Proto, r["NSE Script ID"]) for r in gr.first_per_ip_port(flat).collect()}
    assert first == {("10.0.0.1", 80): ("tcp", None), ("10.0.0.1", 22): ("tcp", None), ("10.0.1.5", 443): ("tcp", "a")}
    prof = {r.IP: r for r in gr.host_profile(gr.first_per_ip_port(flat)).collect()}
    assert prof["10.0.0.1"].Port == [80, 22] and prof["10.0.0.1"].Service == ["http", "ssh"]
    assert prof["10.0.0.1"].Product == ["p1", None] and prof["10.0.0.1"].Host == ["a", "a"]
    e = gr.graph_edges(flat)
    assert sorted((r.subnet, r.ip) for r in e.collect()) == [("10.0.0", "10.0.0.1"), ("10.0.1", "10.0.1.5")]
    v = {r.id: (r.kind, r.n_ports, r.hover) for r in gr.graph_vertices(e).collect()}
    assert v["10.0.0.1"] == ("host", 2, "[80, 22]<br>['http', 'ssh']")
    assert v["10.0.0"] == ("subnet", 0, "")
    assert [r.Port for r in gr.all_ports(flat).collect()] == [22, 80, 443]
    e3, v3 = gr.graph_for_ports(flat, [443])
    assert [r.ip for r in e3.collect()] == ["10.0.1.5"] and v3.count() == 2
    assert gr.flat_by_ports(flat, []).count() == 5


def test_missing_service_is_nan_without_quotes(spark):
    df = spark.createDataFrame([("10.0.0.0/24", "10.0.0.1", [80, 81], ["http", None])],
                               "subnet string, ip string, Port array<int>, Service array<string>")
    host = gr.graph_vertices(df).where("kind = 'host'").first()
    assert host.hover == "[80, 81]<br>['http', nan]"


def test_flat_csv_takes_columns_from_each_header(spark, write_text):
    import pytest

    a = "IP,Host,OS,Proto,Port,Service,Product,Service FP,NSE Script ID,NSE Script Output,Notes\n10.0.0.1,h,Linux,tcp,80,http,nginx,fp,,\n"
    b = '"Port","Proto","IP","OS","Notes"\n443,tcp,10.0.0.2,BSD\n53,udp,10.0.0.3,\n'
    write_text("csv/a.csv", a)
    folder = write_text("csv/b.csv", b).rsplit("/", 1)[0]
    got = sorted((r.IP, r.OS, r.Proto, r.Port, r.Host) for r in gr.read_flat_csv(spark, folder).collect())
    assert got == [("10.0.0.1", "Linux", "tcp", 80, "h"), ("10.0.0.2", "BSD", "tcp", 443, None), ("10.0.0.3", None, "udp", 53, None)]
    bad = write_text("bad/c.csv", b + "http,tcp,10.0.0.4,x\n")
    with pytest.raises(Exception, match="no port number: http,tcp,10.0.0.4,x"):
        gr.read_flat_csv(spark, bad).collect()
    assert sorted(r.IP for r in gr.read_flat_csv(spark, bad, mode="quarantine").collect()) == ["10.0.0.2", "10.0.0.3"]
    assert [r.value for r in gr.bad_flat_lines(spark, bad).collect()] == ["http,tcp,10.0.0.4,x"]
    named = gr.read_flat_csv(spark, write_text("n/d.csv", "80,tcp,10.0.0.9,\n"), header=["Port", "Proto", "IP", "OS", "Notes"])
    assert [(r.IP, r.Port) for r in named.collect()] == [("10.0.0.9", 80)]


def test_numbering_without_gaps(spark):
    from scanlake.functions import number_rows

    df = spark.range(5000).selectExpr("id * 7919 % 5000 as k", "if(id % 50 = 0, null, id) as z")
    got = number_rows(df, ["k"]).collect()
    assert sorted(r.i for r in got) == list(range(1, 5001)) and all(r.k == r.i - 1 for r in got)
    assert number_rows(df.limit(0), ["k"]).collect() == []
