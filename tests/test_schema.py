"""Operator outputs follow the declared data model (scanlake.schema)."""

from pyspark.sql import types as T

from scanlake import schema as S
from scanlake.operators import graph as gr
from scanlake.operators import services as sv
from scanlake.sources import domains as sdom
from scanlake.sources import reports as srp
from scanlake.sources.scanners import parse_lines, quarantine
from scanlake.store import Inventory, add_scan

from tests.test_reports import SMALL


def fields(spark, ddl):
    return [(f.name, f.dataType.simpleString()) for f in spark.createDataFrame([], ddl).schema.fields]


def got(df, names=None):
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields if names is None or f.name in names]


def test_schemas(spark, tmp_path, write_text):
    lines = spark.createDataFrame([("10.0.0.1:80",), ("a:b",)], "value string")
    assert got(parse_lines(lines, "generic")) == fields(spark, S.PARSED)
    assert got(quarantine(lines.withColumn("file_name", lines.value), "generic")) == fields(spark, S.QUARANTINE)
    res = write_text("r.txt", "a.example [10.0.0.1]\n")
    assert got(sdom.read_resolutions(spark, res)) == fields(spark, S.RESOLUTION)
    rep = write_text("rep/10.0.0.1.xml", SMALL)
    assert got(srp.report_catalog(spark, rep.rsplit("/", 1)[0])) == fields(spark, S.CATALOG)
    assert got(srp.read_headers(spark, rep))[1:] == fields(spark, S.HEADER)
    hosts = srp.parse_hosts(srp.read_host_elements(spark, rep))
    assert hosts.schema["h"].dataType == spark.createDataFrame([], S.HOST_XML).schema
    want = fields(spark, S.SERVICE)
    assert got(sv.service_rows(hosts), [n for n, _ in want]) == want
    assert gr.flat_table(hosts).drop("seq").schema == S.FLAT
    inv = Inventory(spark, str(tmp_path / "inv"))
    add_scan(spark, inv, write_text("c.txt", "10.0.0.1:80\n"), "generic")
    assert inv.read().schema == T.StructType(S.OBSERVATION.fields[:5] + [S.OBSERVATION["source_file"],
                                                                          S.OBSERVATION["batch_id"]])
