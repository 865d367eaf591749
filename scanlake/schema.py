"""Explicit schemas for the data model."""

from __future__ import annotations

from pyspark.sql import types as T

SEQ = T.StructType([
    T.StructField("batch_id", T.LongType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("block_start", T.LongType()),
    T.StructField("row_id", T.LongType()),
])

# One stored observation
OBSERVATION = T.StructType([
    T.StructField("seq", SEQ),
    T.StructField("ip", T.StringType()),
    T.StructField("ip_num", T.LongType()),
    T.StructField("port", T.IntegerType()),
    T.StructField("domains", T.ArrayType(T.StringType())),
    T.StructField("batch_id", T.LongType()),
    T.StructField("source_file", T.StringType()),
])

PARSED = "ip string, port int"
QUARANTINE = "source_file string, value string, reason string"

# D10
RESOLUTION = "domain string, ip string"

# D4
CATALOG = ("path string, stem string, suffix string, kind string, "
           "report_ip string, report_port int")

# The parts of a <host> element the operators read (public nmap XML names)
HOST_XML = (
    "address array<struct<_addr:string,_addrtype:string>>, "
    "hostnames struct<hostname:array<struct<_name:string,_type:string>>>, "
    "ports struct<port:array<struct<_protocol:string,_portid:int,"
    "state:struct<_state:string>,"
    "service:struct<_name:string,_product:string,_servicefp:string>,"
    "script:array<struct<_id:string,_output:string>>>>>, "
    "os struct<osmatch:array<struct<_name:string>>>"
)

# D6
HEADER = ("scanner string, args string, version string, xmloutputversion string, "
          "type string, protocol string")

SERVICE = "ip string, proto string, port int, state string, service string, has_cert boolean"

# Column names of the flat port table (fixed values: the exported CSV's header)
FLAT_COLUMNS = ["IP", "Host", "OS", "Proto", "Port", "Service", "Product", "Service FP",
                "NSE Script ID", "NSE Script Output", "Notes"]
FLAT = T.StructType([T.StructField(c, T.IntegerType() if c == "Port" else T.StringType())
                     for c in FLAT_COLUMNS])
