"""End-to-end flows and the streaming ingest."""

import pytest

from scanlake.plans import commands as cmd
from scanlake.streaming.ingest import start_ingest
from scanlake.store import Inventory

from tests.test_reports import host_doc


def test_add_scan_report_parse_draw(spark, tmp_path, write_text):
    inv = str(tmp_path / "inv")
    cap = write_text("c.txt", "Discovered open port 80/tcp on 10.0.0.10\nDiscovered open port 443/tcp on 10.0.0.10\n"
                              "Discovered open port 22/tcp on 10.0.0.9\n")
    assert cmd.add(spark, inv, "masscan", cap) == (1, 2)
    res = write_text("r.txt", "a.example [10.0.0.10]\nz.example [10.9.9.9]\n")
    assert [r.domain for r in cmd.dns_add(spark, inv, res).collect()] == ["z.example"]
    assert cmd.dns_update(spark, inv, res) == 1
    total, listing = cmd.scan_show(spark, inv, hosts="10.0.0.0/24", dns=True)
    assert total == 2
    assert [r.line for r in listing.collect()] == ["IP 10.0.0.9, Domains [] (1) -> [22]",
                                                   "IP 10.0.0.10, Domains [a.example] (2) -> [80,443]"]
    total, ports = cmd.scan_show(spark, inv, ports="all", raw=True)
    assert total == 3 and [r.line for r in ports.collect()] == ["10.0.0.9", "10.0.0.10", "10.0.0.10"]
    wl = cmd.scan_worklist(spark, inv, hosts="all", max_ports_exclusive=2).collect()
    assert [(r.stem, r.ports_csv) for r in wl] == [("10.0.0.9", "22")]

    rep = tmp_path / "reports"
    rep.mkdir()
    (rep / "10.0.0.10.xml").write_text(host_doc("10.0.0.10", [80, 443]))
    (rep / "10.0.0.10.nmap").write_text("Nmap scan report for 10.0.0.10\n")
    (rep / "10.0.0.10.gnmap").write_text("Host: 10.0.0.10 ()\n")
    out = cmd.report(spark, str(rep), str(tmp_path / "merged"), hosts="all", inventory=inv, dns=True,
                     single_file=True)
    assert set(out) == {".xml", ".nmap", ".gnmap"}
    xml = "\n".join(r.value for r in spark.read.text(out[".xml"]).orderBy("section").collect())
    assert '<hostname name="a.example" type="A"/>' in xml
    n, show = cmd.report_show(spark, str(rep), hosts="all")
    assert n == 1 and show.count() == 2
    urls = [r.url for r in cmd.parse_urls(spark, str(rep), "http", inventory=inv, dns=True).collect()]
    assert urls == ["http://a.example", "http://a.example:443"]
    lines = [r.line for r in cmd.parse_urls(spark, str(rep), "http", inventory=inv, dns=True, raw=False).collect()]
    assert lines == ["IP 10.0.0.10 -> http://a.example", "IP 10.0.0.10 -> http://a.example:443"]
    assert [r.line for r in cmd.parse_urls(spark, str(rep), "http", raw=False).collect()] == ["http://10.0.0.10", "http://10.0.0.10:443"]
    with pytest.warns(UserWarning, match="no .nmap reports that meet"):
        empty = cmd.report(spark, str(rep), str(tmp_path / "none"), hosts="10.9.9.9")
    assert set(empty) == {".xml"} and not (tmp_path / "none.nmap").exists()
    xml = [r.value for r in spark.read.text(empty[".xml"]).collect()]
    assert len(xml) == 2 and "; 0 IP address" in xml[0]
    edges, vertices, ports = cmd.draw(spark, reports_dir=str(rep))
    assert edges.count() == 1 and vertices.count() == 2 and [r.Port for r in ports.collect()] == [80, 443]
    e2, _, _ = cmd.draw(spark, xml_reports=[str(rep / "10.0.0.10.xml")], ports=[443])
    assert [r.Port for r in e2.collect()] == [[443]]


def test_split_xml(spark, tmp_path, write_text):
    text = host_doc("10.0.0.1", [80]) + host_doc("10.0.0.1", [22]) + \
        '<?xml version="1.0" encoding="UTF-8"?>\n<nmaprun/>\n'
    bad = cmd.split_xml(spark, write_text("m.xml", text), str(tmp_path / "out"))
    assert bad.count() == 1
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.suffix == ".xml") == ["10.0.0.1.xml", "10.0.0.1_2.xml"]
    assert (tmp_path / "out" / "10.0.0.1_2.xml").read_text() == host_doc("10.0.0.1", [22])


def test_stream_ingest_is_idempotent(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    (land / "a.txt").write_text("10.0.0.1:80\n10.0.0.2:22\nfoo:bar\n")
    inv = str(tmp_path / "inv")
    q = start_ingest(spark, str(land), "generic", inv, str(tmp_path / "ckpt"),
                     quarantine_path=str(tmp_path / "bad"), available_now=True)
    q.awaitTermination(120)
    rows = sorted((r.ip, r.port) for r in Inventory(spark, inv).read().collect())
    assert rows == [("10.0.0.1", 80), ("10.0.0.2", 22)]
    assert [r.value for r in spark.read.parquet(str(tmp_path / "bad")).collect()] == ["foo:bar"]
    # a replayed micro-batch (same tag) is skipped
    assert Inventory(spark, inv).append(Inventory(spark, inv).read().drop("batch_id"), op="stream:ingest:0") == -1


def test_db_create(spark, tmp_path, write_text):
    inv = str(tmp_path / "inv")
    scan = write_text("s.txt", "10.0.0.1:80\n10.0.0.2:22\n")
    res = write_text("r.txt", "a.example [10.0.0.2]\n")
    assert cmd.db_create(spark, inv, scan, res) == 2
    _, listing = cmd.scan_show(spark, inv, hosts="all", dns=True)
    assert [r.line for r in listing.collect()] == ["IP 10.0.0.1, Domains [] (1) -> [80]", "IP 10.0.0.2, Domains [a.example] (1) -> [22]"]


def test_resolver_input(spark, tmp_path, write_text):
    out = cmd.dns_input(spark, write_text("d.txt", "café.example.com\nplain.example.com\ncafé.example.com\n"), str(tmp_path / "out"))
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["plain.example.com", "xn--caf-dma.example.com"]


def test_non_ipv4_hosts_listed_last(spark, tmp_path, write_text):
    inv = str(tmp_path / "inv")
    cap = write_text("c.txt", "10.0.0.10 80\nfe80::1 22\n10.0.0.9 443\nhost.local 25\n")
    cmd.add(spark, inv, "sx", cap)
    _, listing = cmd.scan_show(spark, inv, hosts="all")
    assert [r.ip for r in listing.collect()] == ["10.0.0.9", "10.0.0.10", "fe80::1", "host.local"]


def test_stream_two_arrivals(spark, tmp_path):
    land = tmp_path / "land2"
    land.mkdir()
    inv = str(tmp_path / "inv2")
    (land / "a.txt").write_text("10.0.0.1:80\n")
    q = start_ingest(spark, str(land), "generic", inv, str(tmp_path / "ck2"), available_now=True)
    q.awaitTermination(120)
    (land / "b.txt").write_text("10.0.0.2:22\n")  # arrives while no run is active
    q = start_ingest(spark, str(land), "generic", inv, str(tmp_path / "ck2"), available_now=True)
    q.awaitTermination(120)
    rows = sorted((r.ip, r.port, r.batch_id) for r in Inventory(spark, inv).read().collect())
    assert rows == [("10.0.0.1", 80, 1), ("10.0.0.2", 22, 2)]
