"""P9, P10 and CIDR bounds."""

import ipaddress

from pyspark.sql import functions as F

from scanlake.functions.ip import address_order, ip6_key, ip_num, subnet


def test_ip_order(spark):
    ips = ["10.0.0.10", "10.0.0.9", "9.255.255.255", "192.168.1.1", "bad", "1.2.3.256", "::1"]
    df = spark.createDataFrame([(x,) for x in ips], "ip string").select("ip", ip_num("ip").alias("n"))
    got = [r.ip for r in df.where(F.col("n").isNotNull()).orderBy("n").collect()]
    assert got == ["9.255.255.255", "10.0.0.9", "10.0.0.10", "192.168.1.1"]
    assert df.where(F.col("n").isNull()).count() == 3


def test_ip6_key(spark):
    good = ["::", "::1", "1::", "fe80::1", "2001:db8::8a2e:370:7334", "2001:DB8:0:0:0:0:0:1", "::ffff:10.1.2.3", "64:ff9b::192.0.2.33",
            "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:1.2.3.4", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8"]
    bad = ["", "10.0.0.1", ":", ":::", "1::2::3", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "1:2:3:4::5:6:7:8", "g::1", "12345::", ":1:2:3:4:5:6:7",
           "1:2:3:4:5:6:7:", "::1.2.3", "::1.2.3.256", "host.local", None]
    got = {r.ip: r.k for r in spark.createDataFrame([(x,) for x in good + bad], "ip string").select("ip", ip6_key("ip").alias("k")).collect()}
    assert {x: got[x] for x in good} == {x: ipaddress.IPv6Address(x).packed.hex() for x in good}
    assert all(got[x] is None for x in bad)
    assert spark.createDataFrame([("fe80::1%eth0",)], "ip string").select(ip6_key("ip")).first()[0] == got["fe80::1"]


def test_address_order(spark):
    ips = ["host.b", "fe80::2", "10.0.0.10", "fe80::10", "2001::", "10.0.0.9", "host.a"]
    df = spark.createDataFrame([(x,) for x in ips], "ip string").withColumn("ip_num", ip_num("ip"))
    assert [r.ip for r in df.orderBy(*address_order()).collect()] == [
        "10.0.0.9", "10.0.0.10", "2001::", "fe80::2", "fe80::10", "host.a", "host.b"]


def test_subnet(spark):
    df = spark.createDataFrame([("10.1.2.3",), ("abc",)], "ip string")
    assert [r.s for r in df.select(subnet("ip").alias("s")).collect()] == ["10.1.2", "ab"]
