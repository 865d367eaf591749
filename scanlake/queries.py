"""Driver registry: one Spark query per operator, with its DuckDB oracle SQL.

Each query takes ``(spark, sf_dir)`` and reads the driver's tables, or files
Spark renders from them (scanner captures, XML and text reports), so its work
grows with the data.  The oracle SQL computes the same answer straight from the
fixture formulas (FIXTURES.md); the two sides share no parsing.  Arrays are
compared as comma-joined text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake import fixtures as fx
from scanlake.functions import number_rows
from scanlake.functions.ip import ip_num, subnet
from scanlake.operators import domains as dom
from scanlake.operators import select as sel
from scanlake.operators import views as vw
from scanlake.session import materialized, new_path
from scanlake.sources import domains as sdom
from scanlake.sources.scanners import parse_lines, read_scan_lines, register_parser
from scanlake.sources.selectors import host_ranges
from scanlake.store import Inventory, create_generic, ingest

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def q(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


# --------------------------------------------------------------- oracle SQL
OBS = """obs as (
  select event_id as seq,
    concat('10.', cast(user_id % 3 as varchar), '.', cast(user_id % 8 as varchar), '.', cast(user_id % 256 as varchar)) as ip,
    cast(split_part('21,22,25,53,80,110,139,143,389,443,445,993,3306,3389,8080,8443', ',',
      cast(cast(floor(value) as bigint) % (1 + user_id % 16) as int) + 1) as int) as port,
    split_part('ftp,ssh,smtp,domain,http,pop3,netbios-ssn,imap,ldap,http,microsoft-ds,imaps,mysql,ms-wbt-server,http,https', ',',
      cast(cast(floor(value) as bigint) % (1 + user_id % 16) as int) + 1) as service,
    case when event_type = 'error' then 'udp' else 'tcp' end as proto,
    case when event_type = 'view' then 'closed' else 'open' end as state,
    event_id % 5 = 0 as has_cert,
    case when event_type = 'purchase' then concat('old', cast(user_id % 5 as varchar), '.example.com',
      case when user_id % 2 = 1 then concat(',srv', cast(user_id % 97 as varchar), '.building.example.net') else '' end) else '' end as domain_csv
  from events)"""

RES = """res as (
  select concat('srv', cast(c_custkey % 97 as varchar), '.', lower(c_mktsegment), '.example.net') as domain,
    concat('10.', cast((c_custkey % 200) % 3 as varchar), '.', cast((c_custkey % 200) % 8 as varchar), '.',
      cast((c_custkey % 200) % 256 as varchar)) as ip
  from customer)"""

SVC = """svc as (
  select ip, port, proto, service, state, has_cert from (
    select o.*, row_number() over (partition by ip, port, proto order by seq desc) as rn from obs o) t
  where rn = 1)"""

A4 = """a4 as (select ip, array_to_string(list_sort(list_distinct(list(domain))), ',') as dtext,
  list_sort(list_distinct(list(domain))) as dlist from res group by ip)"""

#: One row per name of each observation, with its place.
OWN = """own as (select seq, ip, unnest(string_split(domain_csv, ',')) as domain, generate_subscripts(string_split(domain_csv, ','), 1) as k
  from obs where domain_csv <> '')"""

LATEST = """latest as (select ip, arg_max(domain_csv, seq) as domain_csv from obs group by ip)"""


def ipnum_sql(x: str) -> str:
    return (f"(cast(split_part({x}, '.', 1) as bigint) * 16777216 + cast(split_part({x}, '.', 2) as bigint) * 65536"
            f" + cast(split_part({x}, '.', 3) as bigint) * 256 + cast(split_part({x}, '.', 4) as bigint))")


def w(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


def _ports_text(c="ports"):
    return F.array_join(F.transform(c, lambda p: p.cast("string")), ",")


# ================================================================ S1 - S10
@q("s1_read_lines", w(OBS) + """
select '# masscan -p1-65535 10.0.0.0/8' as value union all select ''
union all select concat('Discovered open port ', cast(port as varchar), '/', proto, ' on ', ip) from obs
union all select concat('Nmap scan report for ', ip) from obs where seq % 7 = 3""")
def s1_read_lines(spark, sf):
    return read_scan_lines(spark, fx.scanner_capture(spark, sf, "masscan")).select("value")


def _ingest_query(fmt: str, parser: str | None = None):
    def run(spark, sf):
        return ingest(spark, fx.scanner_capture(spark, sf, fmt), parser or fmt).select("ip", "port")

    return run


_ALL = w(OBS) + "select ip, port from obs"
_TCP = w(OBS) + "select ip, port from obs where proto = 'tcp'"
q("s2_generic", _ALL)(_ingest_query("generic"))
q("s3_naabu", _ALL)(_ingest_query("naabu"))
q("s4_sx", _ALL)(_ingest_query("sx"))
q("s5_nmap", _ALL)(_ingest_query("nmap"))
q("s6_masscan", _TCP)(_ingest_query("masscan"))
q("s7_masscan_import", _TCP)(_ingest_query("masscan_import"))
q("s8_rustscan", _ALL)(_ingest_query("rustscan"))
q("s9_nimscan", _ALL)(_ingest_query("nimscan"))


@register_parser("semicolon")
def _parse_semicolon(lines):
    """A user format registered through the S10 extension point: ``ip;port``."""
    p = F.split(F.col("value"), ";", -1)
    rest = [c for c in lines.columns if c not in ("ip", "port_raw")]
    return lines.where(F.size(p) == 2).select(*rest, F.try_element_at(p, F.lit(1)).alias("ip"),
                                              F.try_element_at(p, F.lit(2)).alias("port_raw"))


q("s10_custom_format", _ALL)(_ingest_query("semicolon"))


@q("s1_quarantine_counts", w(OBS) + """
select count(*) filter (where seq % 13 = 4) as n_bad, count(*) filter (where seq % 13 <> 4) as n_good from obs where proto = 'tcp'""")
def s1_quarantine_counts(spark, sf):
    from scanlake.sources.scanners import quarantine

    lines = read_scan_lines(spark, fx.scanner_capture(spark, sf, "masscan", bad_ports=True))
    good = parse_lines(lines, "masscan", mode="quarantine").agg(F.count("*").alias("n_good"))
    bad = quarantine(lines, "masscan").agg(F.count("*").alias("n_bad"))
    return bad.unionByName(good, allowMissingColumns=True).agg(
        F.max("n_bad").alias("n_bad"), F.max("n_good").alias("n_good"))


# ================================================================= T1 - T3
@q("t1_append", w(OBS) + """
select ip, port, cast(1 as bigint) as batch_id from obs where proto = 'tcp'
union all select ip, port, cast(2 as bigint) from obs where proto = 'tcp'""")
def t1_append(spark, sf):
    inv = Inventory(spark, new_path(spark, "inventory"))
    cap = fx.scanner_capture(spark, sf, "masscan")
    inv.append(ingest(spark, cap, "masscan"))
    inv.append(ingest(spark, cap, "masscan"))
    return inv.read().select("ip", "port", "batch_id")


@q("t2_replace", w(OBS) + "select ip, port, cast(2 as bigint) as batch_id from obs")
def t2_replace(spark, sf):
    inv = Inventory(spark, new_path(spark, "inventory"))
    inv.append(ingest(spark, fx.scanner_capture(spark, sf, "masscan"), "masscan"))
    inv.append(ingest(spark, fx.scanner_capture(spark, sf, "generic"), "generic"), replace=True)
    return inv.read().select("ip", "port", "batch_id")


@q("t3_create_generic", w(OBS, RES, A4) + """
select o.ip, o.port, coalesce(a4.dtext, '') as domains_text from obs o left join a4 on o.ip = a4.ip""")
def t3_create_generic(spark, sf):
    # the generic capture has a header and junk lines; create_generic takes a clean file
    clean_path = new_path(spark, "clean_generic")
    (ingest(spark, fx.scanner_capture(spark, sf, "generic"), "generic")
     .select(F.concat("ip", F.lit(":"), F.col("port").cast("string")).alias("value"))
     .write.text(clean_path))
    inv = Inventory(spark, new_path(spark, "inventory"))
    create_generic(spark, inv, clean_path, fx.resolution_capture(spark, sf))
    # the text is made once per host, not once per row, and written, so that its size is known: rows stay where they are read
    names = materialized(dom.latest_domains(inv.read(), delta=inv.names()).select(
        "ip", F.array_join("domains", ",").alias("domains_text")), "host_names")
    return inv.read().select("ip", "port").join(names, "ip").select("ip", "port", "domains_text")


@q("a5_hosts_added", w(OBS) + "select count(distinct ip) as n_hosts from obs where proto = 'tcp'")
def a5_hosts_added(spark, sf):
    return vw.count_hosts(ingest(spark, fx.scanner_capture(spark, sf, "masscan"), "masscan"))


# ================================================================= F1 - F5
def _obs(spark, sf):
    return fx.obs(spark, sf)


@q("f1_all_hosts", w(OBS) + "select ip, port from obs")
def f1_all_hosts(spark, sf):
    return sel.select_hosts(spark, _obs(spark, sf), "all").select("ip", "port")


@q("f1_all_ports", w(OBS) + "select ip, port from obs")
def f1_all_ports(spark, sf):
    return sel.select_by_ports(spark, _obs(spark, sf), "all").select("ip", "port")


_CIDR_SPEC = "10.1.0.0/16,10.0.3.0/24,10.2.7.7,10.0.5.130/25"


@q("f3_cidr_hosts", w(OBS) + """
select seq, ip, port from obs
where ip like '10.1.%' or ip like '10.0.3.%' or ip = '10.2.7.7'
   or (ip like '10.0.5.%' and cast(split_part(ip, '.', 4) as int) >= 128)""")
def f3_cidr_hosts(spark, sf):
    return sel.select_hosts(spark, _obs(spark, sf), _CIDR_SPEC).select("seq", "ip", "port")


_SEL = f"""sel as (
  select n // 16 * 16 as lo, n // 16 * 16 + 15 as hi from (select {ipnum_sql("concat('10.', n_nationkey % 3, '.', n_nationkey % 8, '.', n_nationkey % 256)")} as n from nation) x
  union all
  select n, n from (select {ipnum_sql("concat('10.', s_suppkey * 4 % 3, '.', s_suppkey * 4 % 8, '.', s_suppkey * 4 % 256)")} as n from supplier) y)"""


@q("f3_cidr_many", w(OBS, _SEL) + f"""
select o.seq, o.ip, o.port from obs o
where exists (select 1 from sel where {ipnum_sql('o.ip')} between sel.lo and sel.hi)""")
def f3_cidr_many(spark, sf):
    """Selectors taken from tables: slices of disjoint intervals."""
    return sel.select_cidr(_obs(spark, sf), host_ranges(fx.selectors(spark, sf))).select("seq", "ip", "port")


@q("s20_selector_file", w(OBS, _SEL) + f"""
select o.seq, o.ip, o.port from obs o
where exists (select 1 from sel where {ipnum_sql('o.ip')} between sel.lo and sel.hi)""")
def s20_selector_file(spark, sf):
    """Selectors read from a file (one or more per line, comma separated)."""
    return sel.select_hosts(spark, _obs(spark, sf), fx.selector_file(spark, sf)).select("seq", "ip", "port")


_OBS6 = """obs6 as (select seq, port, ip, cast(split_part(ip, '.', 4) as int) as u, concat('2001:db8:', split_part(ip, '.', 3), '::',
  lower(to_hex(cast(split_part(ip, '.', 4) as int)))) as ip6 from obs)"""


@q("f3_ipv6_hosts", w(OBS, _OBS6) + """
select seq, ip6, port from obs6 where split_part(ip, '.', 3) = '2' or (split_part(ip, '.', 3) = '5' and u between 16 and 31) or ip6 = '2001:db8:3::3'""")
def f3_ipv6_hosts(spark, sf):
    """The hosts under IPv6 addresses: selectors of several prefix lengths, one of them IPv4."""
    octet = F.substring_index("ip", ".", -1).cast("int")
    third = F.substring_index(F.substring_index("ip", ".", 3), ".", -1)
    o = _obs(spark, sf).withColumn("ip6", F.concat(F.lit("2001:db8:"), third, F.lit("::"), F.lower(F.hex(octet))))
    got = sel.select_spec(spark, o, "2001:0db8:2::/48,2001:db8:5::10/124,2001:db8:3::3,10.0.0.0/8", ip_col="ip6")
    return got.select("seq", "ip6", "port")


@q("f4_ports", w(OBS) + "select seq, ip, port from obs where port in (22, 443, 8080)")
def f4_ports(spark, sf):
    return sel.select_by_ports(spark, _obs(spark, sf), "22,443,8080").select("seq", "ip", "port")


@q("f5_host_limit", w(OBS) + """
select ip, cast(count(distinct port) as int) as n_ports,
  array_to_string(list_sort(list_distinct(list(port))), ',') as ports_text
from obs group by ip having count(distinct port) < 4""")
def f5_host_limit(spark, sf):
    hp = sel.limit_hosts(vw.host_ports(_obs(spark, sf)), 4)
    return hp.select("ip", "n_ports", _ports_text().alias("ports_text"))


# ================================================================ A1 - A6
_A1 = """a1 as (select ip, count(distinct port) as n_ports,
  array_to_string(list_sort(list_distinct(list(port))), ',') as ports_text
  from obs group by ip)"""


@q("a1_host_ports", w(OBS, _A1) + "select ip, cast(n_ports as int) as n_ports, ports_text from a1")
def a1_host_ports(spark, sf):
    return vw.host_ports(_obs(spark, sf)).select("ip", "n_ports", _ports_text().alias("ports_text"))


@q("a2_port_hosts", w(OBS) + "select distinct port, ip from obs")
def a2_port_hosts(spark, sf):
    return vw.port_hosts(_obs(spark, sf)).select("port", "ip")


@q("a3_latest_domains", w(OBS, LATEST) + "select ip, domain_csv as domains_text from latest")
def a3_latest_domains(spark, sf):
    return dom.latest_domains(_obs(spark, sf)).select("ip", F.array_join("domains", ",").alias("domains_text"))


@q("a3_union_domains", w(OBS, OWN) + """
select ip, coalesce((select string_agg(domain, ',' order by domain) from (select distinct domain from own where own.ip = h.ip) d), '') as domains_text
from (select distinct ip from obs) h""")
def a3_union_domains(spark, sf):
    return dom.latest_domains(_obs(spark, sf), mode="union").select(
        "ip", F.array_join("domains", ",").alias("domains_text"))


@q("a6_total_targets", w(OBS) + """
select count(distinct ip) as total from obs
where ip like '10.1.%' or ip like '10.0.3.%' or ip = '10.2.7.7'
   or (ip like '10.0.5.%' and cast(split_part(ip, '.', 4) as int) >= 128)""")
def a6_total_targets(spark, sf):
    return vw.total_targets(sel.select_hosts(spark, _obs(spark, sf), _CIDR_SPEC))


@q("a6_total_ports", w(OBS) + "select count(distinct port) as total from obs where port in (22, 443, 8080)")
def a6_total_ports(spark, sf):
    return vw.total_targets(sel.select_by_ports(spark, _obs(spark, sf), "22,443,8080"), by="port")


# ================================================================ P1 - P10
@q("p1_host_listing_raw", w(OBS, LATEST) + """
select distinct o.ip, o.port, 0 as k, concat(o.ip, ':', cast(o.port as varchar)) as line from obs o
union all
select x.ip, x.port, cast(n.k as int), concat(n.domain, ':', cast(x.port as varchar))
from (select distinct ip, port from obs) x join (
  select ip, unnest(string_split(domain_csv, ',')) as domain, generate_subscripts(string_split(domain_csv, ','), 1) as k
  from latest where domain_csv <> '') n on x.ip = n.ip""")
def p1_host_listing_raw(spark, sf):
    return vw.host_listing_raw(_obs(spark, sf), dns=True).select("ip", "port", "k", "line")


@q("p2_host_listing", w(OBS, _A1) + f"""
select row_number() over (order by {ipnum_sql('ip')}) as i, ip, cast(n_ports as int) as n_ports,
  concat('IP ', ip, ' (', cast(n_ports as varchar), ') -> [', ports_text, ']') as line from a1""")
def p2_host_listing(spark, sf):
    """The listing in the order it is printed, numbered."""
    return number_rows(vw.host_listing(_obs(spark, sf)), ["ip_num", "ip"]).select("i", "ip", "n_ports", "line")


@q("p2_host_listing_dns", w(OBS, _A1, LATEST) + """
select a1.ip, cast(n_ports as int) as n_ports,
  concat('IP ', a1.ip, ', Domains [', l.domain_csv, '] (', cast(n_ports as varchar), ') -> [', ports_text, ']') as line
from a1 join latest l on a1.ip = l.ip""")
def p2_host_listing_dns(spark, sf):
    return vw.host_listing(_obs(spark, sf), dns=True).select("ip", "n_ports", "line")


_PH = f"""ph as (select distinct port, ip, {ipnum_sql('ip')} as ipn from obs)"""


_BLOCK_HOSTS = 32          # small, so that ports have several blocks here
_BLOCKS = f"""cells as (select port, ipn // 65536 as cell, count(*) as n from ph group by port, ipn // 65536),
filled as (select port, cell, floor(coalesce(sum(n) over (partition by port order by cell rows between unbounded preceding and 1 preceding), 0)
  / {_BLOCK_HOSTS}) as f, cast(sum(n) over (partition by port) as bigint) as n_hosts from cells),
numbered as (select *, cast(dense_rank() over (partition by port order by f) - 1 as int) as block from filled),
blocks as (select ph.port, block, n_hosts, string_agg(ip, ',' order by ipn) as ips, count(*) as n_block
  from ph join numbered c on ph.port = c.port and ph.ipn // 65536 = c.cell group by ph.port, block, n_hosts)"""


@q("p3_port_listing", w(OBS, _PH, _BLOCKS) + """
select port, block, n_block, n_hosts,
  concat('Port ', cast(port as varchar), ' (', cast(n_block as varchar), ') -> [', ips, ']') as line from blocks""")
def p3_port_listing(spark, sf):
    return vw.port_listing(_obs(spark, sf), _BLOCK_HOSTS).select("port", "block", "n_block", "n_hosts", "line")


@q("p3_port_listing_whole", w(OBS, _PH) + """
select port, count(*) as n_hosts,
  concat('Port ', cast(port as varchar), ' (', cast(count(*) as varchar), ') -> [', string_agg(ip, ',' order by ipn), ']') as line
from ph group by port""")
def p3_port_listing_whole(spark, sf):
    """Blocks of the size used in production: a port with fewer hosts than that is one line."""
    return vw.port_listing(_obs(spark, sf)).select("port", "n_hosts", "line")


@q("p4_port_listing_raw", w(OBS) + "select distinct port, ip as line from obs")
def p4_port_listing_raw(spark, sf):
    return vw.port_listing_raw(_obs(spark, sf)).select("port", "line")


@q("p5_host_worklist", w(OBS, _A1) + "select ip as stem, ports_text as ports_csv, cast(n_ports as int) as n_ports from a1 where n_ports < 8")
def p5_host_worklist(spark, sf):
    return vw.host_worklist(_obs(spark, sf), max_ports_exclusive=8).select("stem", "ports_csv", "n_ports")


@q("p6_port_worklist", w(OBS, _PH, _BLOCKS) + """
select concat('port', cast(port as varchar), case when max(block) over (partition by port) > 0 then concat('_', cast(block as varchar)) else '' end)
  as stem, block, ips as hosts_csv, n_block from blocks""")
def p6_port_worklist(spark, sf):
    return vw.port_worklist(_obs(spark, sf), _BLOCK_HOSTS).select("stem", "block", "hosts_csv", "n_block")


@q("p9_ip_order", w(OBS) + f"select distinct ip, {ipnum_sql('ip')} as ip_num from obs")
def p9_ip_order(spark, sf):
    return _obs(spark, sf).select("ip").distinct().select("ip", ip_num("ip").alias("ip_num"))


@q("p10_subnet", w(OBS) + """
select distinct ip, concat(split_part(ip, '.', 1), '.', split_part(ip, '.', 2), '.', split_part(ip, '.', 3)) as subnet from obs""")
def p10_subnet(spark, sf):
    return _obs(spark, sf).select("ip").distinct().select("ip", subnet("ip").alias("subnet"))


# ========================================================= S11 - S13, A4, T4 - T6, A10
@q("s11_domain_list", w(RES) + "select distinct domain from res")
def s11_domain_list(spark, sf):
    return sdom.read_domain_list(spark, fx.domain_list_capture(spark, sf))


@q("s12_resolver_input", w(RES) + "select distinct domain as domain_ascii from res")
def s12_resolver_input(spark, sf):
    return sdom.resolver_input(sdom.read_domain_list(spark, fx.domain_list_capture(spark, sf)))


@q("s13_resolutions", w(RES) + "select domain, ip from res")
def s13_resolutions(spark, sf):
    return sdom.read_resolutions(spark, fx.resolution_capture(spark, sf))


def _resolved(spark, sf):
    return sdom.read_resolutions(spark, fx.resolution_capture(spark, sf))


@q("a4_domains_by_ip", w(RES, A4) + "select ip, dtext as domains_text from a4")
def a4_domains_by_ip(spark, sf):
    return dom.domains_by_ip(_resolved(spark, sf)).select("ip", F.array_join("domains", ",").alias("domains_text"))


@q("t4_add_domains", w(OBS, RES, OWN).rstrip() + """
, gained as (select o.seq, string_agg(r.domain, ',' order by r.domain) as new from obs o join (select distinct ip, domain from res) r on o.ip = r.ip
  where not exists (select 1 from own where own.seq = o.seq and own.domain = r.domain) group by o.seq)
select o.seq, o.ip, o.port, concat_ws(',', nullif(o.domain_csv, ''), g.new) as domains_text from obs o left join gained g on o.seq = g.seq""")
def t4_add_domains(spark, sf):
    o = _obs(spark, sf).select("seq", "ip", "port", "domains")
    return dom.add_domains(o, _resolved(spark, sf)).select(
        "seq", "ip", "port", F.array_join("domains", ",").alias("domains_text"))


@q("t5_update_domains", w(OBS, RES, OWN).rstrip() + """
, all_names as (select seq, domain from own union select o.seq, r.domain from obs o join res r on o.ip = r.ip),
texts as (select seq, string_agg(domain, ',' order by domain) as t from all_names group by seq)
select o.seq, o.ip, o.port, case when o.ip in (select ip from res) then t.t else o.domain_csv end as domains_text
from obs o left join texts t on o.seq = t.seq""")
def t5_update_domains(spark, sf):
    o = _obs(spark, sf).select("seq", "ip", "port", "domains")
    return dom.update_domains(o, _resolved(spark, sf)).select(
        "seq", "ip", "port", F.array_join("domains", ",").alias("domains_text"))


@q("t5_domain_pairs", w(OBS, RES, OWN) + """
select distinct ip, domain from own
union
select distinct r.ip, r.domain from res r where r.ip in (select ip from obs)""")
def t5_domain_pairs(spark, sf):
    o = _obs(spark, sf).select("seq", "ip", "port", "domains")
    return dom.host_domain_pairs(o, _resolved(spark, sf))


@q("t5_stored_names", w(OBS, RES, "hosts as (select distinct ip from obs where proto = 'tcp')") + """
select distinct r.ip, r.domain from res r join hosts h on r.ip = h.ip where r.ip not like '10.1.%'""")
def t5_stored_names(spark, sf):
    """Names added to a stored inventory, of which a rescan of 10.1/16 hides those of that network's hosts again."""
    inv = Inventory(spark, new_path(spark, "inventory"))
    obs = ingest(spark, fx.scanner_capture(spark, sf, "masscan"), "masscan")
    inv.append(obs)
    inv.add_names(dom.resolved_names(_resolved(spark, sf)))
    inv.append(sel.select_hosts(spark, obs, "10.1.0.0/16"))
    return dom.host_names(inv.read(), inv.names()).select("ip", "domain")


@q("t6_unmatched_domains", w(OBS, RES) + """
select distinct domain from res r1
where not exists (select 1 from res r2 join (select distinct ip from obs) h on r2.ip = h.ip where r2.domain = r1.domain)""")
def t6_unmatched_domains(spark, sf):
    return dom.unmatched_domains(_obs(spark, sf), _resolved(spark, sf))


@q("a10_hosts_updated", w(OBS, RES) + "select count(distinct ip) as n_hosts from obs where ip in (select ip from res)")
def a10_hosts_updated(spark, sf):
    return dom.hosts_updated(_obs(spark, sf), _resolved(spark, sf))


# ============================================== S14, S16, S17, F8, F9, P7, P8
from scanlake.operators import graph as gr  # noqa: E402
from scanlake.operators import reports as rp  # noqa: E402
from scanlake.operators import services as sv  # noqa: E402
from scanlake.sources import reports as srp  # noqa: E402


def _hosts(spark, sf):
    return srp.parse_hosts(srp.read_host_elements(spark, fx.concatenated_xml(spark, sf)))


def _services(spark, sf):
    return sv.service_rows(_hosts(spark, sf))


_REPEATED = """select distinct ip as stem, 1 as n from svc
union all select distinct ip, x.n from svc, (select unnest([2, 3]) as n) x where cast(split_part(ip, '.', 4) as int) % 4 = 1"""


@q("s14_split_xml", w(OBS, SVC) + _REPEATED)
def s14_split_xml(spark, sf):
    return srp.split_documents(spark, fx.concatenated_xml(spark, sf, "repeated")).select("stem", "n")


@q("s14_split_files", w(OBS, SVC) + f"""select concat(stem, case when n > 1 then concat('_', n) else '' end, '.xml') as name,
  stem as report_ip from ({_REPEATED}) t""")
def s14_split_files(spark, sf):
    """The files written, by name, with the address that each one's host element has."""
    folder = new_path(spark, "split_xml")
    srp.write_split_documents(spark, fx.concatenated_xml(spark, sf, "repeated"), folder)
    h = srp.parse_hosts(srp.read_host_elements(spark, folder, "*.xml"))
    return h.select(F.regexp_extract("source_file", r"([^/]+)$", 1).alias("name"), F.col("ip").alias("report_ip"))


@q("s16_host_elements", w(OBS, SVC) + "select ip, cast(count(*) as int) as n_ports from svc group by ip")
def s16_host_elements(spark, sf):
    return _hosts(spark, sf).select("ip", F.size("h.ports.port").alias("n_ports"))


@q("s16_quarantine", w(OBS, SVC) + """
select ip, case when bad then 'malformed host element' end as reason from (select distinct ip, unnest([false, true]) as bad from svc) t
where not bad or cast(split_part(ip, '.', 4) as int) % 4 = 1""")
def s16_quarantine(spark, sf):
    """Captures in which some host elements aren't well formed: good ones, and the side table of the others."""
    hosts = srp.read_host_elements(spark, fx.concatenated_xml(spark, sf, "broken"))
    good = srp.parse_hosts(hosts, mode="quarantine").select("ip", F.lit(None).cast("string").alias("reason"))
    return good.unionByName(srp.bad_hosts(hosts).select(F.regexp_extract("value", 'addr="([^"]*)"', 1).alias("ip"), "reason"))


@q("s17_service_rows", w(OBS, SVC) + "select ip, proto, port, state, service, has_cert from svc")
def s17_service_rows(spark, sf):
    return _services(spark, sf).select("ip", "proto", "port", "state", "service", "has_cert")


@q("f8_open_tcp", w(OBS, SVC) + "select ip, port, service from svc where proto = 'tcp' and state = 'open'")
def f8_open_tcp(spark, sf):
    return sv.open_tcp(_services(spark, sf)).select("ip", "port", "service")


def _url_sql(wanted: list[str], by_domain: bool = False) -> str:
    H, S = "http" in wanted, "https" in wanted
    lst = ", ".join(f"'{x}'" for x in wanted)
    sb, hb = ("true" if S else "false"), ("true" if H else "false")
    base = f"""u as (
  select ip, port, case when service = 'http' and has_cert and {sb} then 'https' else service end as scheme
  from svc where proto = 'tcp' and state = 'open'
    and (service in ({lst}) or (service = 'http' and {sb}))
    and not (service = 'http' and has_cert and not {sb} and {hb})),
v as (select ip, port, scheme, case when (scheme = 'http' and port = 80) or (scheme = 'https' and port = 443)
  then '' else concat(':', cast(port as varchar)) end as pt from u)"""
    if not by_domain:
        return w(OBS, SVC, base) + "select ip, port, scheme, concat(scheme, '://', ip, pt) as url from v"
    return w(OBS, SVC, LATEST, base) + """select v.ip, v.port, concat(v.scheme, '://', coalesce(n.domain, v.ip), v.pt) as url
from v left join (select ip, unnest(string_split(domain_csv, ',')) as domain from latest where domain_csv <> '') n on v.ip = n.ip"""


@q("f9_services", _url_sql(["ssh", "http"]).replace(", concat(scheme, '://', ip, pt) as url", ""))
def f9_services(spark, sf):
    return sv.select_services(sv.open_tcp(_services(spark, sf)), "ssh,http").select("ip", "port", "scheme")


def _url_query(wanted):
    def run(spark, sf):
        return sv.service_urls(_services(spark, sf), wanted).select("ip", "port", "scheme", "url")

    return run


q("p7_urls_http", _url_sql(["http"]))(_url_query("http"))
q("p7_urls_https", _url_sql(["https"]))(_url_query("https"))
q("p7_urls_http_https", _url_sql(["http", "https"]))(_url_query("http,https"))
q("p7_urls_ssh_http", _url_sql(["ssh", "http"]))(_url_query("ssh,http"))


@q("p8_urls_by_domain", _url_sql(["http", "https"], by_domain=True))
def p8_urls_by_domain(spark, sf):
    names = dom.host_names(_obs(spark, sf))
    return sv.service_urls_by_name(_services(spark, sf), "http,https", names).select("ip", "port", "url")


# ========================================== S15, F2, F6, F7, A12, S21
_REPORTED = "reported as (select * from svc)"      # every host has its reports
_CAT = """cat as (
  select distinct ip as stem, s.suffix, 'host' as kind, ip as report_ip, cast(null as int) as report_port
  from reported, (select unnest(['.xml', '.nmap', '.gnmap']) as suffix) s
  union all
  select distinct concat('port', cast(port as varchar)), s.suffix, 'port', cast(null as varchar), port
  from svc, (select unnest(['.xml', '.nmap', '.gnmap']) as suffix) s)"""


def _catalog(spark, sf):
    return srp.report_catalog(spark, fx.report_set(spark, sf))


@q("s15_report_catalog", w(OBS, SVC, _REPORTED, _CAT) + "select stem, suffix, kind, report_ip, report_port from cat")
def s15_report_catalog(spark, sf):
    return _catalog(spark, sf).select("stem", "suffix", "kind", "report_ip", "report_port")


@q("f2_new_hosts", w(OBS) + "select seq, ip, port from obs where cast(split_part(ip, '.', 4) as int) % 2 = 1")
def f2_new_hosts(spark, sf):
    return sel.select_hosts(spark, _obs(spark, sf), "new", catalog=srp.report_catalog(spark, fx.partial_report_set(spark, sf))).select("seq", "ip", "port")


@q("f6_reports_by_host", w(OBS, SVC, _REPORTED, _CAT) + """
select stem, suffix from cat where kind = 'host' and (report_ip like '10.0.%' or report_ip like '10.2.1.%')""")
def f6_reports_by_host(spark, sf):
    return rp.reports_by_host(spark, _catalog(spark, sf), "10.0.0.0/16,10.2.1.0/24").select("stem", "suffix")


@q("f6_reports_all_hosts", w(OBS, SVC, _REPORTED, _CAT) + "select stem, suffix from cat where kind = 'host'")
def f6_reports_all_hosts(spark, sf):
    return rp.reports_by_host(spark, _catalog(spark, sf), "all").select("stem", "suffix")


@q("f7_reports_by_port", w(OBS, SVC, _REPORTED, _CAT) + """
select stem, suffix from cat where stem in ('port80', 'port443', 'port8080')""")
def f7_reports_by_port(spark, sf):
    return rp.reports_by_port(spark, _catalog(spark, sf), "80,443,8080").select("stem", "suffix")


@q("f7_reports_all_ports", w(OBS, SVC, _REPORTED, _CAT) + "select stem, suffix from cat where kind = 'port'")
def f7_reports_all_ports(spark, sf):
    return rp.reports_by_port(spark, _catalog(spark, sf), "all").select("stem", "suffix")


@q("a12_report_count", w(OBS, SVC, _REPORTED) + "select count(distinct ip) as n_reports from reported")
def a12_report_count(spark, sf):
    return rp.report_count(rp.reports_by_host(spark, _catalog(spark, sf), "all"), ".xml")


_PORTS_CSV = "pc as (select ip, array_to_string(list_sort(list_distinct(list(port))), ',') as ports_csv " \
             "from svc group by ip)"


@q("s21_report_header", w(OBS, SVC, _REPORTED, _PORTS_CSV) + """
select distinct e.ip as stem, 'nmap' as scanner, concat('nmap -sV -oA &quot;out&quot; -p', pc.ports_csv, ' ', e.ip) as args,
  '7.94' as version, '1.05' as xmloutputversion, 'syn' as type, 'tcp' as protocol
from reported e join pc on e.ip = pc.ip
union all
select distinct concat('port', cast(port as varchar)), 'nmap', concat('nmap -sV -p', cast(port as varchar)),
  '7.94', '1.05', 'syn', 'tcp' from svc""")
def s21_report_header(spark, sf):
    folder = fx.report_set(spark, sf)
    h = srp.read_headers(spark, f"{folder}/*.xml")
    return h.select(F.regexp_extract("source_file", r"([^/]+)\.xml$", 1).alias("stem"), "scanner", "args",
                    "version", "xmloutputversion", "type", "protocol")


# ======================================================== R1, R2, A9, T9
def _merged(spark, sf, dns: bool):
    sel_ = rp.reports_by_host(spark, _catalog(spark, sf), "all")
    d = dom.latest_domains(_obs(spark, sf)) if dns else None
    return rp.merge_xml(spark, sel_, d)


@q("r1_add_domains", w(OBS, SVC, _REPORTED, LATEST) + """
select distinct e.ip, case when l.domain_csv is null or l.domain_csv = ''
  then concat(replace(e.ip, '.', '-'), '.example.org')
  else concat(replace(e.ip, '.', '-'), '.example.org', ',', l.domain_csv) end as names_text
from reported e left join latest l on e.ip = l.ip""")
def r1_add_domains(spark, sf):
    body = _merged(spark, sf, dns=True).where(F.col("section") == 1)
    h = srp.parse_hosts(body.withColumnRenamed("value", "host_xml"))
    names = F.transform("h.hostnames.hostname", lambda x: x["_name"])
    return h.select("ip", F.array_join(names, ",").alias("names_text"))


@q("r2_merge_xml", w(OBS, SVC, _REPORTED) + """
select 0 as section, cast(null as varchar) as ip, cast(0 as bigint) as n_ports
union all select 1, ip, count(*) from reported group by ip
union all select 2, null, 0""")
def r2_merge_xml(spark, sf):
    m = _merged(spark, sf, dns=False)
    ip = F.regexp_extract("value", r'<address\b[^>]*\saddr="([^"]*)"', 1)
    n = F.size(F.split("value", "<port ")) - 1
    return m.select("section", F.when(ip != "", ip).alias("ip"), n.cast("bigint").alias("n_ports"))


@q("a9_merged_host_count", w(OBS, SVC, _REPORTED) + "select count(distinct ip) as n_hosts from reported")
def a9_merged_host_count(spark, sf):
    return rp.merged_host_count(_merged(spark, sf, dns=False))


@q("t9_write_merged_xml", w(OBS, SVC, _REPORTED) + "select ip, cast(count(*) as int) as n_ports from reported group by ip")
def t9_write_merged_xml(spark, sf):
    sel_ = rp.reports_by_host(spark, _catalog(spark, sf), "all")
    out = rp.write_merged_xml(spark, sel_, new_path(spark, "merged_xml"), dom.latest_domains(_obs(spark, sf)))
    h = srp.parse_hosts(srp.read_host_elements(spark, out))
    return h.select("ip", F.size("h.ports.port").alias("n_ports"))


@q("t9_merged_footer", w(OBS, SVC, _REPORTED) + """
select concat('<runstats><finished time="0" timestr="Thu Jan  1 00:00:00 1970" elapsed="0" summary="Nmap done at Thu Jan  1 00:00:00 1970; ',
  cast(count(distinct ip) as varchar), ' IP address scanned in 0.0 seconds" exit="success"/></runstats>') as value from reported""")
def t9_merged_footer(spark, sf):
    out = rp.write_merged_xml(spark, rp.reports_by_host(spark, _catalog(spark, sf), "all"), new_path(spark, "merged_xml"))
    return spark.read.text(out).where("section = 2").where(F.col("value").startswith("<runstats>")).select("value")


@q("t9_merged_header", w(OBS, SVC, _REPORTED, _PORTS_CSV) + f"""
select concat('<nmaprun scanner="nmap" args="(Example) nmap -sV -oA &quot;out&quot; -p', ports_csv, ' ', ip,
  '" start="0" startstr="Thu Jan  1 00:00:00 1970" version="7.94" xmloutputversion="1.05">') as value
from pc order by {ipnum_sql('ip')} limit 1""")
def t9_merged_header(spark, sf):
    out = rp.write_merged_xml(spark, rp.reports_by_host(spark, _catalog(spark, sf), "all"), new_path(spark, "merged_xml"))
    return spark.read.text(out).where("section = 0").where(F.col("value").startswith("<nmaprun")).select("value")


# ============================================================ R3, R4, T7, T8
_TEXT_LINES = """tl as (
  select ip, 0 as n, concat('# Nmap 7.94 scan initiated: nmap -sV ', ip) as line from (select distinct ip from reported) a
  union all select ip, 1, concat('Nmap scan report for ', ip) from (select distinct ip from reported) b
  union all select ip, 2, 'PORT STATE SERVICE' from (select distinct ip from reported) c
  union all select ip, 3 + port * 2 + case when proto = 'udp' then 1 else 0 end,
    concat(cast(port as varchar), '/', proto, ' ', state, ' ', service) from reported
  union all select ip, 1048576, '# Nmap done: 1 IP address (1 host up)' from (select distinct ip from reported) d)"""


def _text_merge(spark, sf, suffix, numbered=False):
    return rp.merge_text(spark, rp.reports_by_host(spark, _catalog(spark, sf), "all"), suffix, numbered=numbered)


def _read_in_order(spark, folder):
    """Lines of a merged report with their position: part files in the order of their names."""
    lines = spark.read.text(folder).select("value", F.col("_metadata.file_name").alias("f"), F.col("_metadata.file_block_start").alias("b"),
                                           F.monotonically_increasing_id().alias("r"))
    return number_rows(lines, ["f", "b", "r"]).select("i", "value")


@q("r3_merge_text", w(OBS, SVC, _REPORTED, _TEXT_LINES) + """
select ip as stem, row_number() over (partition by ip order by n) as line_no, line as value from tl""")
def r3_merge_text(spark, sf):
    return _text_merge(spark, sf, ".nmap", numbered=True).select("stem", "line_no", "value")


@q("t7_write_merged_text", w(OBS, SVC, _REPORTED, _TEXT_LINES) + f"""
select row_number() over (order by {ipnum_sql('ip')}, n) as i, line as value from tl""")
def t7_write_merged_text(spark, sf):
    return _read_in_order(spark, rp.write_merged_text(_text_merge(spark, sf, ".nmap"), new_path(spark, "merged_nmap")))


@q("t8_write_merged_grepable", w(OBS, SVC, _REPORTED) + f"""
select row_number() over (order by {ipnum_sql('ip')}, n) as i, value from (
  select ip, 0 as n, concat('# Nmap 7.94 scan initiated: nmap -sV ', ip) as value from (select distinct ip from reported) a
  union all
  select ip, 1, concat('Host: ', ip, ' ()\tPorts: ', string_agg(concat(cast(port as varchar), '/', state, '/', proto, '//', service, '///'),
    ', ' order by port, proto)) from reported group by ip) t""")
def t8_write_merged_grepable(spark, sf):
    return _read_in_order(spark, rp.write_merged_text(_text_merge(spark, sf, ".gnmap"), new_path(spark, "merged_gnmap")))


@q("r4_show_text", w(OBS, SVC, _REPORTED, _TEXT_LINES) + f"""
select 0 as sep, concat('(', cast(row_number() over (order by {ipnum_sql('ip')}) as varchar), '/',
  cast(count(*) over () as varchar), ')') as value from (select distinct ip from reported) x
union all select 1, line from tl""")
def r4_show_text(spark, sf):
    s = rp.show_text(spark, rp.reports_by_host(spark, _catalog(spark, sf), "all"))
    return s.select("sep", F.when(F.col("sep") == 0, F.regexp_replace("value", " .*$", "")).otherwise(
        F.col("value")).alias("value"))


# ============================================== S18, S19, A7, A8, A11, F10, G1-G3
_FLAT = """flat as (
  select ip as "IP", concat(replace(ip, '.', '-'), '.example.org') as "Host", concat('Linux ', split_part(ip, '.', 4)) as "OS",
    proto as "Proto", port as "Port", service as "Service", concat('prod-', service) as "Product",
    concat('fp-', cast(port as varchar)) as "Service FP",
    case when has_cert then 'ssl-cert' end as "NSE Script ID",
    case when has_cert then concat('Subject: commonName=', ip) end as "NSE Script Output",
    cast(null as varchar) as "Notes"
  from svc)"""
_FLAT_COLS = '"IP", "Host", "OS", "Proto", "Port", "Service", "Product", "Service FP", "NSE Script ID", "NSE Script Output", "Notes"'
_A11 = """a11 as (select * from (select f.*, row_number() over (partition by "IP", "Port" order by "Proto") as rn from flat f) t
  where rn = 1)"""
_A7 = """a7 as (select "IP",
  string_agg(cast("Port" as varchar), ',' order by "Port") as ports_text,
  string_agg("Service", ',' order by "Port") as services_text,
  string_agg("Host", ',' order by "Port") as hosts_text,
  string_agg("OS", ',' order by "Port") as os_text,
  string_agg("Product", ',' order by "Port") as products_text,
  arg_min("Proto", "Port") as "Proto", arg_min("Service FP", "Port") as "Service FP",
  count(*) as n
  from a11 group by "IP")"""


def _flat(spark, sf):
    return gr.flat_table(_hosts(spark, sf))


@q("s18_flat_table", w(OBS, SVC, _FLAT) + f"select {_FLAT_COLS} from flat")
def s18_flat_table(spark, sf):
    return _flat(spark, sf).drop("seq")


@q("s19_flat_csv", w(OBS, SVC, _FLAT) + f"select {_FLAT_COLS} from flat")
def s19_flat_csv(spark, sf):
    return gr.read_flat_csv(spark, fx.flat_csv_capture(spark, sf)).drop("seq")


@q("s19_other_header", w(OBS, SVC, _FLAT) + f"select {_FLAT_COLS} from flat")
def s19_other_header(spark, sf):
    """The same rows from a file whose header has the columns in another order."""
    return gr.read_flat_csv(spark, fx.flat_csv_capture(spark, sf, "reordered")).drop("seq")


@q("s19_quarantine", w(OBS, SVC, _FLAT) + """
select "IP", cast("Port" as varchar) as port, cast(null as varchar) as reason from flat
union all select "IP", 'http', 'no port number' from flat where "Port" > 1000""")
def s19_quarantine(spark, sf):
    path = fx.flat_csv_capture(spark, sf, "bad")
    good = gr.read_flat_csv(spark, path, mode="quarantine").select("IP", F.col("Port").cast("string").alias("port"),
                                                                   F.lit(None).cast("string").alias("reason"))
    bad = gr.bad_flat_lines(spark, path).select(F.split("value", ",")[0].alias("IP"), F.split("value", ",")[4].alias("port"), "reason")
    return good.unionByName(bad)


@q("a11_first_per_ip_port", w(OBS, SVC, _FLAT, _A11) + 'select "IP", "Port", "Proto", "Service" from a11')
def a11_first_per_ip_port(spark, sf):
    return gr.first_per_ip_port(_flat(spark, sf)).select("IP", "Port", "Proto", "Service")


def _joined(c):
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


@q("a7_host_profile", w(OBS, SVC, _FLAT, _A11, _A7) + """
select "IP", ports_text, services_text, hosts_text, os_text, products_text, "Proto", "Service FP" from a7""")
def a7_host_profile(spark, sf):
    p = gr.host_profile(gr.first_per_ip_port(_flat(spark, sf)))
    return p.select("IP", _joined("Port").alias("ports_text"), _joined("Service").alias("services_text"),
                    _joined("Host").alias("hosts_text"), _joined("OS").alias("os_text"),
                    _joined("Product").alias("products_text"), "Proto", "Service FP")


@q("a8_all_ports", w(OBS, SVC) + 'select distinct port as "Port" from svc')
def a8_all_ports(spark, sf):
    return gr.all_ports(_flat(spark, sf))


@q("f10_flat_by_ports", w(OBS, SVC, _FLAT) + 'select "IP", "Port", "Proto" from flat where "Port" in (80, 443)')
def f10_flat_by_ports(spark, sf):
    return gr.flat_by_ports(_flat(spark, sf), [80, 443]).select("IP", "Port", "Proto")


_SUBNET = "concat(split_part(\"IP\", '.', 1), '.', split_part(\"IP\", '.', 2), '.', split_part(\"IP\", '.', 3))"


@q("g1_graph_edges", w(OBS, SVC, _FLAT, _A11, _A7) + f"""
select {_SUBNET} as subnet, "IP" as ip, ports_text, services_text, "Proto" from a7""")
def g1_graph_edges(spark, sf):
    e = gr.graph_edges(_flat(spark, sf))
    return e.select("subnet", "ip", _joined("Port").alias("ports_text"), _joined("Service").alias("services_text"),
                    "Proto")


@q("g2_graph_vertices", w(OBS, SVC, _FLAT, _A11, _A7) + f"""
select "IP" as id, 'host' as kind, cast(n as int) as n_ports,
  concat('[', replace(ports_text, ',', ', '), ']<br>[''', replace(services_text, ',', ''', '''), ''']') as hover from a7
union all select distinct {_SUBNET}, 'subnet', 0, '' from a7""")
def g2_graph_vertices(spark, sf):
    v = gr.graph_vertices(gr.graph_edges(_flat(spark, sf)))
    return v.select("id", "kind", "n_ports", "hover")


@q("g3_graph_for_ports", w(OBS, SVC, "flat0 as (select * from svc where port in (80, 443))",
                           _FLAT.replace("from svc)", "from flat0)"), _A11, _A7) + f"""
select {_SUBNET} as subnet, "IP" as ip, ports_text from a7""")
def g3_graph_for_ports(spark, sf):
    e, _ = gr.graph_for_ports(_flat(spark, sf), [80, 443])
    return e.select("subnet", "ip", _joined("Port").alias("ports_text"))
