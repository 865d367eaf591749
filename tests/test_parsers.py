"""Literal scanner lines – kept, skipped and aborting rows."""

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from scanlake.sources.scanners import get_parser, parse_lines, parser_names, quarantine, read_scan_lines

ESC = "\x1b"


def rows(df):
    return sorted((r.ip, r.port) for r in df.select("ip", "port").collect())


@pytest.mark.parametrize("fmt,good,skip,bad", [
    ("generic", "10.0.0.1:80", ["a:b:c", ""], "foo:bar"),
    ("naabu", "10.0.0.1:80", ["a:b:c", ""], "foo:bar"),
    ("sx", "10.0.0.1   80", ["x y z", ""], "foo bar"),
    ("nmap", "Discovered open port 80/tcp on 10.0.0.1", ["Nmap done", ""], "a b c x/tcp z"),
    ("masscan", "Discovered open port 80/tcp on 10.0.0.1",
     ["Discovered open port 80/udp on 10.0.0.1", ""], "a b c x/tcp z"),
    ("masscan_import", "Timestamp: 1\tHost: 10.0.0.1 ()\tPorts: 80/open/tcp//http//",
     ["Timestamp: 1\tHost: 10.0.0.1 ()\tPorts: 80/open/udp//http//", "#masscan"], "a b c 10.0.0.1 x/open/tcp"),
    ("nimscan", f"{ESC}[32m==> {ESC}[0m10.0.0.1:80{ESC}[0m [open]", ["zzz"], "==> 10.0.0.1:x"),
])
def test_formats(lines, fmt, good, skip, bad):
    df = lines(good, *skip)
    assert rows(parse_lines(df, fmt)) == [("10.0.0.1", 80)]
    with pytest.raises((PySparkException, Py4JJavaError)):
        parse_lines(lines(good, bad), fmt).collect()
    assert rows(parse_lines(lines(good, bad), fmt, mode="skip")) == [("10.0.0.1", 80)]


def test_nmap_keeps_udp(lines):
    assert rows(parse_lines(lines("Discovered open port 53/udp on 10.0.0.1"), "nmap")) == [("10.0.0.1", 53)]


def test_masscan_udp_with_bad_port_does_not_abort(lines):
    df = lines("Discovered open port x/udp on 10.0.0.1", "Discovered open port 22/tcp on 10.0.0.2")
    assert rows(parse_lines(df, "masscan")) == [("10.0.0.2", 22)]


def test_rustscan(lines):
    df = lines("10.0.0.1 -> [80,443]", "junk", "10.0.0.2 -> []")
    assert rows(parse_lines(df, "rustscan")) == [("10.0.0.1", 80), ("10.0.0.1", 443)]
    with pytest.raises((PySparkException, Py4JJavaError)):
        parse_lines(lines("10.0.0.1 -> [a"), "rustscan").collect()


def test_nimscan_keeps_whole_address(lines):
    df = lines(f"{ESC}[32m==> {ESC}[0m10.0.0.10:80{ESC}[0m [open]")
    assert rows(parse_lines(df, "nimscan")) == [("10.0.0.10", 80)]


def test_header_line_dropped(lines):
    df = lines("# nmap -v 10.0.0.0/24", "", "Discovered open port 22/tcp on 10.0.0.5")
    assert rows(parse_lines(df, "nmap")) == [("10.0.0.5", 22)]


def test_quarantine_lists_bad_lines(lines):
    df = lines("10.0.0.1:80", "foo:bar", "a:b:c")
    assert rows(parse_lines(df, "generic", mode="quarantine")) == [("10.0.0.1", 80)]
    q = quarantine(df, "generic").collect()
    assert [(r.value, r.reason) for r in q] == [("foo:bar", "bad port: bar")]


def test_registry(lines):
    assert {"generic", "naabu", "sx", "nmap", "masscan", "masscan_import", "rustscan", "nimscan"} <= set(parser_names())
    with pytest.raises(ValueError):
        get_parser("nosuch")


def test_strict_check_survives_pruning(lines):
    df = parse_lines(lines("10.0.0.1:80", "foo:bar"), "generic").select("ip")
    with pytest.raises((PySparkException, Py4JJavaError)):
        df.collect()


def test_read_scan_lines_order(spark, write_text):
    p = write_text("cap/a.txt", "\n".join(f"10.0.0.{i}:{i}" for i in range(1, 50)) + "\n")
    df = read_scan_lines(spark, p)
    got = [r.value for r in df.orderBy("file_name", "block_start", "row_id").collect()]
    assert got == [f"10.0.0.{i}:{i}" for i in range(1, 50)]


def test_line_numbers_across_splits(spark, write_text):
    from scanlake.sources.scanners import line_numbers

    text = "".join(f"line {i:05d}\n" for i in range(1, 3001))
    a = write_text("big/a.txt", text)
    write_text("big/b.txt", "x\ny\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = read_scan_lines(spark, a.rsplit("/", 1)[0])
        assert lines.select("block_start").distinct().count() > 5
        got = {(r.file_name.rsplit("/", 1)[1], r.line_no, r.value) for r in line_numbers(lines).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {("a.txt", i, f"line {i:05d}") for i in range(1, 3001)} | {("b.txt", 1, "x"), ("b.txt", 2, "y")}
