"""S14-S17, S21, F6-F9, P7, P8, R1-R4, T7-T9, A9, A12 on literal reports."""

import pytest
from pyspark.sql import functions as F

from scanlake.operators import reports as rp
from scanlake.operators import services as sv
from scanlake.sources import reports as srp

SMALL = """<?xml version="1.0" encoding="UTF-8"?>
<!DOCTYPE nmaprun>
<nmaprun scanner="nmap" args="nmap -sV &quot;x&quot; &amp; y" start="1" startstr="a" version="7.9" xmloutputversion="1.05">
<scaninfo type="syn" protocol="tcp" numservices="2" services="80,8443"/>
<hosthint><address addr="10.0.0.1" addrtype="ipv4"/></hosthint>
<host starttime="1"><address addr="10.0.0.1" addrtype="ipv4"/>
<hostnames><hostname name="a.example.com" type="PTR"/></hostnames>
<ports><port protocol="tcp" portid="80"><state state="open"/><service name="http"/></port>
<port protocol="tcp" portid="8443"><state state="open"/><service name="http"/><script id="ssl-cert" output="x"/></port>
<port protocol="udp" portid="53"><state state="open"/><service name="domain"/></port></ports></host>
<host><address addr="10.0.0.2" addrtype="ipv4"/></host>
</nmaprun>
"""


def host_doc(ip, ports):
    ps = "".join(f'<port protocol="tcp" portid="{p}"><state state="open"/><service name="http"/></port>' for p in ports)
    return (f'<?xml version="1.0" encoding="UTF-8"?>\n<nmaprun scanner="nmap" args="nmap {ip}" version="7.9" '
            f'xmloutputversion="1.05">\n<scaninfo type="syn" protocol="tcp"/>\n<host><address addr="{ip}" '
            f'addrtype="ipv4"/><hostnames/><ports>{ps}</ports></host>\n<runstats/></nmaprun>\n')


@pytest.fixture
def small(spark, write_text):
    return write_text("rep/small.xml", SMALL)


def test_hosts_and_services(spark, small):
    hosts = srp.parse_hosts(srp.read_host_elements(spark, small))
    assert sorted(r.ip for r in hosts.collect()) == ["10.0.0.1", "10.0.0.2"]
    s = sv.service_rows(hosts)
    got = sorted((r.ip, r.proto, r.port, r.service, r.has_cert) for r in s.collect())
    assert got == [("10.0.0.1", "tcp", 80, "http", False), ("10.0.0.1", "tcp", 8443, "http", True),
                   ("10.0.0.1", "udp", 53, "domain", False)]
    urls = sorted(r.url for r in sv.service_urls(s, "http,https").collect())
    assert urls == ["http://10.0.0.1", "https://10.0.0.1:8443"]


@pytest.mark.parametrize("wanted,expected", [
    ("http", ["http://h", "http://h:8080"]),
    ("https", ["http://h", "http://h:8080", "https://h", "https://h:80", "https://h:8443"]),
    ("http,https", ["http://h", "http://h:8080", "https://h", "https://h:80", "https://h:8443"]),
    ("ssh", ["ssh://h:22"]),
])
def test_http_https_rule(spark, wanted, expected):
    rows = [("h", "tcp", 80, "open", "http", False), ("h", "tcp", 8080, "open", "http", False),
            ("h", "tcp", 80, "open", "http", True), ("h", "tcp", 8443, "open", "http", True),
            ("h", "tcp", 443, "open", "https", False), ("h", "tcp", 22, "open", "ssh", False),
            ("h", "tcp", 25, "closed", "ssh", False), ("h", "udp", 22, "open", "ssh", False)]
    s = spark.createDataFrame(rows, "ip string, proto string, port int, state string, service string, has_cert boolean")
    assert sorted(r.url for r in sv.service_urls(s, wanted).collect()) == sorted(expected)


def test_urls_by_domain(spark):
    s = spark.createDataFrame([("1.1.1.1", "tcp", 443, "open", "https", False), ("2.2.2.2", "tcp", 80, "open", "http", False),
                               ("3.3.3.3", "tcp", 80, "open", "http", False)],
                              "ip string, proto string, port int, state string, service string, has_cert boolean")
    d = spark.createDataFrame([("1.1.1.1", ["a.x", "b.x"]), ("2.2.2.2", [])], "ip string, domains array<string>")
    got = sorted(r.url for r in sv.service_urls_by_domain(s, "http,https", d).collect())
    assert got == ["http://2.2.2.2", "http://3.3.3.3", "https://a.x", "https://b.x"]


def test_header(spark, small):
    h = srp.read_headers(spark, small).first()
    assert (h.scanner, h.version, h.type, h.protocol) == ("nmap", "7.9", "syn", "tcp")
    assert h.args == "nmap -sV &quot;x&quot; &amp; y"


def test_split_documents(spark, write_text):
    text = host_doc("10.0.0.1", [80]) + host_doc("10.0.0.2", [22]) + host_doc("10.0.0.1", [443]) + \
        '<?xml version="1.0" encoding="UTF-8"?>\n<nmaprun><runstats/></nmaprun>\n'
    p = write_text("cat/merged.xml", text)
    docs = srp.split_documents(spark, p)
    got = sorted((r.stem, r.n) for r in docs.where(F.col("stem").isNotNull()).collect())
    assert got == [("10.0.0.1", 1), ("10.0.0.1", 2), ("10.0.0.2", 1)]
    assert srp.documents_without_address(docs).count() == 1


@pytest.fixture
def report_dir(tmp_path):
    d = tmp_path / "reports"
    d.mkdir()
    for ip, ports in (("10.0.0.9", [80]), ("10.0.0.10", [443, 8080]), ("10.1.0.1", [22])):
        (d / f"{ip}.xml").write_text(host_doc(ip, ports))
        (d / f"{ip}.nmap").write_text(f"Nmap scan report for {ip}\n" + "".join(f"{p}/tcp open\n" for p in ports))
        (d / f"{ip}.gnmap").write_text(f"Host: {ip} ()\n")
    (d / "port80.xml").write_text(host_doc("10.0.0.9", [80]))
    (d / "port80.nmap").write_text("Nmap scan report for 10.0.0.9\n")
    (d / "README").write_text("no dot, not a report\n")
    return str(d)


def test_catalog_and_selection(spark, report_dir):
    cat = srp.report_catalog(spark, report_dir)
    assert cat.count() == 11
    k = {(r.stem, r.suffix): (r.kind, r.report_ip, r.report_port) for r in cat.collect()}
    assert k[("port80", ".xml")] == ("port", None, 80) and k[("10.0.0.9", ".nmap")] == ("host", "10.0.0.9", None)
    hosts = rp.reports_by_host(spark, cat, "10.0.0.0/24")
    assert sorted({r.stem for r in hosts.collect()}) == ["10.0.0.10", "10.0.0.9"]
    assert rp.report_count(rp.reports_by_host(spark, cat, "all"), ".xml").first().n_reports == 3
    assert sorted({r.stem for r in rp.reports_by_port(spark, cat, "80,443").collect()}) == ["port80"]
    assert sorted({r.stem for r in rp.reports_by_port(spark, cat, "all").collect()}) == ["port80"]


def merged_text(folder):
    """The merged report: part files in the order of their paths."""
    from pathlib import Path

    return "".join(p.read_text() for p in sorted(Path(folder).rglob("part-*.txt")))


def test_merged_xml_body_is_written_where_it_is_read(spark, report_dir, tmp_path, monkeypatch):
    from pyspark.sql.readwriter import DataFrameWriter

    plans, text = {}, DataFrameWriter.text

    def seen(self, path, *a, **k):
        plans[path.rsplit("/", 1)[-1]] = self._df._jdf.queryExecution().executedPlan().toString()
        return text(self, path, *a, **k)

    monkeypatch.setattr(DataFrameWriter, "text", seen)
    sel = rp.reports_by_host(spark, srp.report_catalog(spark, report_dir), "all")
    out = rp.write_merged_xml(spark, sel, str(tmp_path / "merged"))
    body = plans["section=1"]
    assert "Exchange hashpartitioning" not in body and "Exchange rangepartitioning" not in body and "Sort " not in body
    assert "; 3 IP address scanned" in merged_text(out)


def files_read(df):
    """How many files the text scan of an executed query read."""
    df.collect()
    todo, counts = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if name.startswith("Scan text"):
            counts.append(node.metrics().apply("numFiles").value())
        if name.endswith("QueryStage"):
            todo.append(node.plan())
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return counts


def test_a_selection_of_one_report_reads_few_files(spark, tmp_path):
    d = tmp_path / "many"
    d.mkdir()
    for i in range(200):
        (d / f"10.0.{i}.1.xml").write_text(host_doc(f"10.0.{i}.1", [80]))
        (d / f"10.0.{i}.1.nmap").write_text(f"report {i}\n")
    for p in (22, 80, 443):
        (d / f"port{p}.xml").write_text(host_doc("10.0.0.1", [p]))
    cat = srp.report_catalog(spark, str(d))
    one = rp.merge_xml(spark, rp.reports_by_host(spark, cat, "10.0.17.1"), folders=[str(d)])
    assert max(files_read(one)) == 1 and sum(r.section == 1 for r in one.collect()) == 1
    some = rp.merge_xml(spark, rp.reports_by_host(spark, cat, "10.0.16.0/20,10.0.99.1"), folders=[str(d)])
    assert max(files_read(some)) <= 20 and sum(r.section == 1 for r in some.collect()) == 17
    port = rp.merge_xml(spark, rp.reports_by_port(spark, cat, "80"), folders=[str(d)])
    assert max(files_read(port)) == 1 and sum(r.section == 1 for r in port.collect()) == 1
    text = rp.merge_text(spark, rp.reports_by_host(spark, cat, "10.0.42.1"), ".nmap", [str(d)])
    assert max(files_read(text)) == 1 and [r.value for r in text.collect()] == ["report 42"]


def test_malformed_host_elements(spark, write_text):
    text = SMALL.replace('<host><address addr="10.0.0.2" addrtype="ipv4"/></host>',
                         '<host><address addr="10.0.0.2" addrtype="ipv4"></host>')
    hosts = srp.read_host_elements(spark, write_text("bad/x.xml", text))
    with pytest.raises(Exception, match="malformed host element in .*x.xml"):
        sv.service_rows(srp.parse_hosts(hosts)).collect()
    assert [r.ip for r in srp.parse_hosts(hosts, mode="quarantine").collect()] == ["10.0.0.1"]
    bad = srp.bad_hosts(hosts).collect()
    assert len(bad) == 1 and "10.0.0.2" in bad[0].value and bad[0].source_file.endswith("x.xml")


def test_a_report_cut_off_within_a_host(spark, write_text):
    text = SMALL[: SMALL.index('<host><address addr="10.0.0.2"') + 20]
    hosts = srp.read_host_elements(spark, write_text("cut/x.xml", text))
    assert [r.ip for r in srp.parse_hosts(hosts, mode="quarantine").collect()] == ["10.0.0.1"]
    assert srp.bad_hosts(hosts).count() == 1


def test_merge_xml_and_sink(spark, report_dir, tmp_path):
    cat = srp.report_catalog(spark, report_dir)
    sel = rp.reports_by_host(spark, cat, "all")
    dom = spark.createDataFrame([("10.0.0.10", ["a&b.example"])], "ip string, domains array<string>")
    m = rp.merge_xml(spark, sel, dom)
    assert rp.merged_host_count(m).first().n_hosts == 3
    out = rp.write_merged_xml(spark, sel, str(tmp_path / "merged"), dom)
    text = merged_text(out)
    assert text.startswith('<?xml version="1.0"') and 'args="(Example) nmap 10.0.0.9"' in text
    assert all(text.count(f'addr="{ip}"') == 1 for ip in ("10.0.0.9", "10.0.0.10", "10.1.0.1"))
    assert '<hostname name="a&amp;b.example" type="A"/>' in text
    assert "; 3 IP address scanned" in text and text.rstrip().endswith("</nmaprun>")
    back = srp.parse_hosts(srp.read_host_elements(spark, out))
    names = {r.ip: r.h.hostnames for r in back.collect()}
    assert names["10.0.0.10"].hostname[0]._name == "a&b.example"


def test_merge_text_order(spark, report_dir, tmp_path):
    cat = srp.report_catalog(spark, report_dir)
    sel = rp.reports_by_host(spark, cat, "all")
    out = rp.write_merged_text(rp.merge_text(spark, sel, ".nmap"), str(tmp_path / "m"), single_file=True)
    got = [r.value for r in spark.read.text(out).collect()]
    assert got == ["Nmap scan report for 10.0.0.9", "80/tcp open", "Nmap scan report for 10.0.0.10", "443/tcp open",
                   "8080/tcp open", "Nmap scan report for 10.1.0.1", "22/tcp open"]
    show = rp.show_text(spark, sel).orderBy(*["k_ip", "path", "sep", "k_block", "k_row"]).collect()
    assert show[0].value.startswith("(1/3) ") and show[0].value.endswith("10.0.0.9.nmap")


def test_merge_text_path_order_when_stem_not_ip(spark, tmp_path):
    d = tmp_path / "r2"
    d.mkdir()
    (d / "b.nmap").write_text("B\n")
    (d / "10.0.0.1.nmap").write_text("A\n")
    cat = srp.report_catalog(spark, str(d))
    m = rp.merge_text(spark, cat, ".nmap")
    got = [r.value for r in m.orderBy(*rp.TEXT_ORDER).collect()]
    assert got == ["A", "B"]  # path order: '.../10.0.0.1.nmap' < '.../b.nmap'


def test_split_numbering_across_splits(spark, write_text):
    docs = "".join(host_doc("10.0.0.1", [p]) for p in range(1, 200)) + host_doc("10.0.0.2", [1])
    p = write_text("many/m.xml", docs)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        d = srp.split_documents(spark, p)
        got = sorted((r.stem, r.n, r.doc.count("portid")) for r in d.collect())
        order = [r.n for r in d.where(F.col("stem") == "10.0.0.1").orderBy("n").collect()]
        ports = [int(r.doc.split('portid="')[1].split('"')[0])
                 for r in d.where(F.col("stem") == "10.0.0.1").orderBy("n").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert order == list(range(1, 200)) and ports == list(range(1, 200))
    assert ("10.0.0.2", 1, 1) in got


def test_odd_folder_names(spark, write_text, tmp_path):
    folder = tmp_path / "my reports #1+2"
    for ip in ("10.0.0.1", "10.0.0.2"):
        write_text(f"{folder.name}/{ip}.xml", host_doc(ip, [80]))
        write_text(f"{folder.name}/{ip}.nmap", f"Report for {ip}\n")
    write_text(f"{folder.name}/port80.xml", host_doc("10.0.0.9", [80]))
    sel = rp.reports_by_host(spark, srp.report_catalog(spark, str(folder)), "all")
    for folders in (None, [str(folder)]):
        assert sum(r.section == 1 for r in rp.merge_xml(spark, sel, folders=folders).collect()) == 2
        assert sorted(r.value for r in rp.merge_text(spark, sel, ".nmap", folders).collect()) == [
            "Report for 10.0.0.1", "Report for 10.0.0.2"]
        shown = [r.value for r in rp.show_text(spark, sel, folders).orderBy("k_ip", "path", "sep", "k_block", "k_row").collect()]
        assert sum("(1/2)" in v for v in shown) == sum("(2/2)" in v for v in shown) == 1


def test_port_reports_alone_give_no_host_rows(spark, write_text):
    from scanlake.plans import commands as cmd

    p = write_text("ports/port80.xml", host_doc("10.0.0.9", [80]))
    folder = p.rsplit("/", 1)[0]
    assert cmd.parse_urls(spark, folder, "http,https").count() == 0
    edges, vertices, _ = cmd.draw(spark, reports_dir=folder)
    assert edges.count() == vertices.count() == 0


def test_header_without_scaninfo_is_not_lost(spark, write_text):
    write_text("h/10.0.0.1.xml", '<nmaprun scanner="nmap" args="a &lt;b&gt; &amp; c">' + "<host><address addr=\"10.0.0.1\" addrtype=\"ipv4\"/></host></nmaprun>")
    p = write_text("h/10.0.0.2.nmap", "x")
    sel = rp.reports_by_host(spark, srp.report_catalog(spark, p.rsplit("/", 1)[0]), "all")
    head = [r.value for r in rp.merge_xml(spark, sel).collect() if r.section == 0]
    assert len(head) == 1 and "a &lt;b&gt; &amp; c" in head[0]
