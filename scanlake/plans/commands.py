"""End-to-end flows, one per command of the original tool.

Each flow composes operators into one declarative plan and leaves physical
choices to Catalyst and AQE.  Flows that print in the original return a
DataFrame with an order key instead; flows that write return the paths.
Nothing here loops over rows on the driver; the only driver-side values are
counts and the small bounded lists the operators document.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.functions import order
from scanlake.functions.ip import address_order, ip_num
from scanlake.operators import domains as dom
from scanlake.operators import graph as gr
from scanlake.operators import reports as rp
from scanlake.operators import select as sel
from scanlake.operators import services as sv
from scanlake.operators import views as vw
from scanlake.sources import reports as srp
from scanlake.sources.domains import read_domain_list, read_resolutions, resolver_input
from scanlake.store import Inventory, add_scan, create_generic


# ------------------------------------------------------------------ add / db
def add(spark: SparkSession, inventory: str, scanner: str, paths, rm: bool = False,
        mode: str = "strict") -> tuple[int, int]:
    """Parse a capture into the inventory (T1, or T2 with ``rm``); returns (batch id, hosts added)."""
    return add_scan(spark, Inventory(spark, inventory), paths, scanner, rm=rm, mode=mode)


def db_create(spark: SparkSession, inventory: str, scan_paths, resolution_paths=None) -> int:
    """Replace the inventory from a strict ``ip:port`` capture plus resolutions."""
    return create_generic(spark, Inventory(spark, inventory), scan_paths, resolution_paths)


# ---------------------------------------------------------------------- dns
def dns_input(spark: SparkSession, domain_paths, out: str) -> str:
    """What a resolver is given for a domain list (S11): distinct names in ASCII form, one per line."""
    resolver_input(read_domain_list(spark, domain_paths)).write.mode("overwrite").text(out)
    return out


def dns_add(spark: SparkSession, inventory: str, resolution_paths) -> DataFrame:
    """T4 on the stored inventory; returns the unmatched domains."""
    inv = Inventory(spark, inventory)
    res = read_resolutions(spark, resolution_paths)
    inv.add_names(dom.resolved_names(res))
    return dom.unmatched_domains(inv.read(), res)


def dns_update(spark: SparkSession, inventory: str, resolution_paths) -> int:
    """T5 on the stored inventory; returns the hosts updated (A10)."""
    inv = Inventory(spark, inventory)
    res = read_resolutions(spark, resolution_paths)
    inv.add_names(dom.resolved_names(res))
    return dom.hosts_updated(inv.read(), res).first().n_hosts


# --------------------------------------------------------------------- scan
def _selected(spark, inventory: str, hosts=None, ports=None, reports_dir: str | None = None) -> DataFrame:
    df = Inventory(spark, inventory).read()
    if hosts is not None:
        cat = srp.report_catalog(spark, reports_dir) if reports_dir else None
        return sel.select_hosts(spark, df, hosts, catalog=cat)
    if ports is not None:
        return sel.select_by_ports(spark, df, ports)
    raise ValueError("give hosts or ports")


def scan_show(spark: SparkSession, inventory: str, hosts=None, ports=None, dns: bool = False,
              raw: bool = False, max_ports_exclusive: int | None = None,
              reports_dir: str | None = None, domains_mode: str = "latest") -> tuple[int, DataFrame]:
    """``scan -show``: (total targets A6, ordered listing P1/P2 by host or P3/P4 by port)."""
    df = _selected(spark, inventory, hosts, ports, reports_dir)
    if hosts is not None:
        total = vw.total_targets(df).first().total
        delta = Inventory(spark, inventory).names() if dns else None
        if raw:
            out = vw.host_listing_raw(df, dns, max_ports_exclusive, domains_mode, delta).orderBy(
                *address_order(), *order("port", "k", "line"))
        else:
            out = vw.host_listing(df, dns, max_ports_exclusive, domains_mode, delta).orderBy(*address_order())
        return total, out
    total = vw.total_targets(df, by="port").first().total
    out = vw.port_listing_raw(df).orderBy(*order("port"), *address_order("line")) if raw else \
        vw.port_listing(df).orderBy("port", "block")
    return total, out


def scan_worklist(spark: SparkSession, inventory: str, hosts=None, ports=None,
                  max_ports_exclusive: int | None = None, reports_dir: str | None = None) -> DataFrame:
    """The scans a ``scan`` run would launch, as a table (P5 by host, P6 by port)."""
    df = _selected(spark, inventory, hosts, ports, reports_dir)
    if hosts is not None:
        return vw.host_worklist(df, max_ports_exclusive).orderBy(*address_order())
    return vw.port_worklist(df).orderBy("port", "block")


# ------------------------------------------------------------------- report
def _reports(spark, reports_dir: str, hosts=None, ports=None) -> DataFrame:
    cat = srp.report_catalog(spark, reports_dir)
    if hosts is not None:
        return rp.reports_by_host(spark, cat, hosts)
    if ports is not None:
        return rp.reports_by_port(spark, cat, ports)
    raise ValueError("give hosts or ports")


def report(spark: SparkSession, reports_dir: str, out_prefix: str, fmt: str = "oA", hosts=None, ports=None,
           inventory: str | None = None, dns: bool = False, single_file: bool = False) -> dict[str, str]:
    """Merge the selected reports: ``oX`` XML (R2/T9, with R1 when ``dns``), ``oN`` text (R3/T7),
    ``oG`` grepable (T8), ``oA`` all three.  Returns the written folders by suffix.

    Where no text report meets the selection, there is a warning and no output of that form; the XML
    form then has a footer alone.  ``single_file`` makes one file of a text report.
    """
    selected = _reports(spark, reports_dir, hosts, ports)
    out = {}
    if fmt in ("oX", "oA"):
        inv = Inventory(spark, inventory) if dns and inventory else None
        d = dom.latest_domains(inv.read(), delta=inv.names()) if inv else None
        out[".xml"] = rp.write_merged_xml(spark, selected, f"{out_prefix}.xml", d, [reports_dir])
    for suffix in ((".nmap",) if fmt == "oN" else (".gnmap",) if fmt == "oG" else (".nmap", ".gnmap") if fmt == "oA" else ()):
        if selected.where(F.col("suffix") == suffix).isEmpty():
            warnings.warn(f"no {suffix} reports that meet the search criteria", stacklevel=2)
            continue
        text = rp.merge_text(spark, selected, suffix, [reports_dir])
        out[suffix] = rp.write_merged_text(text, f"{out_prefix}{suffix}", single_file)
    return out


def report_show(spark: SparkSession, reports_dir: str, hosts=None, ports=None) -> tuple[int, DataFrame]:
    """``report -show``: (report count A12, text reports with separators R4, ordered)."""
    selected = _reports(spark, reports_dir, hosts, ports)
    n = rp.report_count(selected, ".nmap").first().n_reports
    shown = rp.show_text(spark, selected, [reports_dir])
    return n, shown.orderBy(*order("k_ip", "path", "sep", "k_block", "k_row"))


# -------------------------------------------------------------------- parse
def parse_urls(spark: SparkSession, reports_dir: str, services, inventory: str | None = None,
               dns: bool = False, raw: bool = True) -> DataFrame:
    """``parse``: service URLs from the host XML reports (P7, or P8 with ``dns``), by report address.

    ``line`` is what is printed: the URL alone if ``raw``, and else, where a domain stands for its host,
    ``IP {ip} -> {url}``.
    """
    cat = srp.report_catalog(spark, reports_dir)
    files, inputs, near = rp.selected_files(cat.where(F.col("kind") == "host"), ".xml", [reports_dir])
    records = srp.read_host_elements(spark, inputs or reports_dir, "*.xml", near)
    hosts = srp.parse_hosts(rp.of_selected(records, files, "source_file"))
    rows = sv.service_rows(hosts).withColumn("report_ip", rp.stem_of("source_file"))     # a host report's name is its address
    if dns and inventory:
        inv = Inventory(spark, inventory)
        urls = sv.service_urls_by_name(rows, services, dom.host_names(inv.read(), inv.names()))
        listed = F.when(F.col("name") == F.col("ip"), F.col("url")).otherwise(F.concat(F.lit("IP "), "ip", F.lit(" -> "), "url"))
    else:
        urls = sv.service_urls(rows, services)
        listed = F.col("url")
    return urls.withColumn("line", F.col("url") if raw else listed).withColumn("k_ip", ip_num("report_ip")).orderBy(
        *order("k_ip", "source_file", "block_start", "row_id", "pos", "url"))


# --------------------------------------------------------------------- draw
def draw(spark: SparkSession, reports_dir: str | None = None, csv_paths=None, ports=None, xml_reports=None):
    """``draw``: the graph's data – (edges G1, vertices G2, all ports A8) – from the
    given XML reports (paths or globs), the host reports of a folder (S18), or an
    exported CSV (S19), optionally for chosen ports (F10/G3)."""
    if csv_paths is not None:
        flat = gr.read_flat_csv(spark, csv_paths)
    elif xml_reports is not None:
        paths = [xml_reports] if isinstance(xml_reports, str) else list(xml_reports)
        flat = gr.flat_table(srp.parse_hosts(srp.read_host_elements(spark, paths)))
    else:
        cat = srp.report_catalog(spark, reports_dir).where(F.col("kind") == "host")
        files, inputs, near = rp.selected_files(cat, ".xml", [reports_dir])
        records = srp.read_host_elements(spark, inputs or reports_dir, "*.xml", near)
        flat = gr.flat_table(srp.parse_hosts(rp.of_selected(records, files, "source_file")))
    edges, vertices = gr.graph_for_ports(flat, ports)
    return edges, vertices, gr.all_ports(flat)


# ---------------------------------------------------------------- split xml
def split_xml(spark: SparkSession, paths, out_dir: str) -> DataFrame:
    """Write each document of concatenated XML files as ``<ip>.xml`` (repeats as
    ``<ip>_<n>.xml``); returns the documents without an address (quarantine)."""
    return srp.write_split_documents(spark, paths, out_dir)
