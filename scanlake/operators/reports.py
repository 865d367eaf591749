"""Report selection, enrichment and merging.

Reading starts at the selection: its file names become a cover of a few ranges, which leaves
other files out when Spark lists the folder; the exact selection is a semi join on the paths.

The merged XML is written in sections (header, body, footer), each host element by the
task that read it: a report set has no order.  Text reports are merged in address order: the sink
range-partitions on that key and sorts within partitions.  Part files in path order are
the merged report; ``single_file=True`` makes one file of a text report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from scanlake.functions import order as sort_order
from scanlake.functions import fill, number_rows, pin
from scanlake.functions.ip import ip_num
from scanlake.functions.ranges import covers
from scanlake.functions.xmltext import escape_attr
from scanlake.operators.select import select_spec
from scanlake.session import materialized
from scanlake.sources.reports import file_number, header_struct, host_fragment, near_names, read_records
from scanlake.sources.scanners import line_numbers
from scanlake.sources.selectors import selector_keyword, selector_tokens


# ------------------------------------------------------------------ F6, F7
def reports_by_host(spark: SparkSession, catalog: DataFrame, hosts) -> DataFrame:
    """``all`` → every report whose stem does not start with ``port``;
    otherwise reports whose stem is an address in the selected ranges."""
    if selector_keyword(spark, hosts) == "all":
        return catalog.where(~F.col("stem").startswith("port"))
    hostcat = catalog.where(F.col("report_ip").isNotNull())
    return select_spec(spark, hostcat, hosts, ip_col="report_ip")


def reports_by_port(spark: SparkSession, catalog: DataFrame, ports) -> DataFrame:
    """``all`` → stems starting with ``port``; otherwise stem equals ``port<p>`` as text (or one of its blocks, ``port<p>_<n>``)."""
    if selector_keyword(spark, ports) == "all":
        return catalog.where(F.col("stem").startswith("port"))
    stems = selector_tokens(spark, ports).select(F.concat(F.lit("port"), F.col("token")).alias("stem")).distinct()
    whole = F.regexp_replace("stem", "_[0-9]+$", "")            # blocks of a port's worklist (P6) belong to the port
    return catalog.withColumn("_port", whole).join(stems.withColumnRenamed("stem", "_port"), "_port", "left_semi") \
        .select(catalog.columns)


def report_count(selected: DataFrame, suffix: str) -> DataFrame:
    """Number of selected reports with ``suffix``."""
    return selected.where(F.col("suffix") == suffix).agg(F.count("*").alias("n_reports"))


# ---------------------------------------------------------------------- R1
def add_domains_to_hosts(hosts: DataFrame, domains: DataFrame) -> DataFrame:
    """For a host with a ``hostnames`` element and known domains, add
    ``<hostname name="d" type="A"/>`` per domain inside it.

    ``hosts`` needs ``ip, host_xml``; ``domains`` is ``ip, domains`` (A3).
    Names are XML-escaped and inserted by literal replacement.
    """
    j = hosts.join(domains.select("ip", F.col("domains").alias("_d")), "ip", "left")
    d = F.coalesce("_d", F.array().cast("array<string>"))
    has = F.col("host_xml").rlike(r"<hostnames[\s/>]")
    expanded = F.regexp_replace("host_xml", r"<hostnames\s*/>", "<hostnames></hostnames>")
    ins = F.array_join(F.transform(d, lambda x: fill(ADDED_HOSTNAME, {"name": escape_attr(x)})), "")
    new = F.replace(expanded, F.lit("</hostnames>"), F.concat(ins, F.lit("</hostnames>")))
    return j.withColumn("host_xml", F.when(has & (F.size(d) > 0), new).otherwise(F.col("host_xml"))).drop("_d")


# ---------------------------------------------------------------------- R2
# The merged report's header and footer, the element added per
# domain (R1) and the separator before each shown report (R4).  The braces are
# filled from the chosen report's header, the host count and the report path.
MERGED_HEADER = (
    '<?xml version="1.0" encoding="UTF-8"?>\n'
    '<!DOCTYPE nmaprun>\n'
    '<?xml-stylesheet href="file:///usr/share/nmap/nmap.xsl" type="text/xsl"?>\n'
    '<!-- merged report -->\n'
    '<nmaprun scanner="{scanner}" args="(Example) {args}" start="0" startstr="Thu Jan  1 00:00:00 1970" '
    'version="{version}" xmloutputversion="{xmloutputversion}">\n'
    '<scaninfo type="{type}" protocol="{protocol}" numservices="0" services="0"/>\n'
    '<verbose level="0"/>\n'
    '<debugging level="0"/>'
)
MERGED_FOOTER = (
    '<runstats><finished time="0" timestr="Thu Jan  1 00:00:00 1970" elapsed="0" '
    'summary="Nmap done at Thu Jan  1 00:00:00 1970; {n} IP address scanned in 0.0 seconds" '
    'exit="success"/></runstats>\n'
    '</nmaprun>'
)
ADDED_HOSTNAME = '<hostname name="{name}" type="A"/>'
SHOW_SEPARATOR = "({i}/{total}) {path}"


def _header_text(h):
    return fill(MERGED_HEADER, {k: h[k] for k in ("scanner", "args", "version", "xmloutputversion", "type",
                                                   "protocol")})


def _footer_text(n):
    return fill(MERGED_FOOTER, {"n": n})


def selected_files(selected: DataFrame, suffix: str, folders: list[str] | None):
    """(files, folders, near): the selected files of one suffix, written once; where they are; a condition on file
    names that all of them meet, and that few others do."""
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    files = materialized(selected.where(F.col("suffix") == suffix).select("path", "stem", file_number(name).alias("lo")), "selected")
    low, high = files.agg(F.min("lo"), F.max("lo")).first()
    if low is None:
        return files, [], None
    cover = covers(files.select("lo", F.col("lo").alias("hi")), low, high)
    return files, report_folders(files, folders), near_names(cover)


def _records(spark: SparkSession, selected: DataFrame, folders: list[str] | None):
    """(files, folders, near, records): records hold ``k_ip, source_file, block_start, row_id, host_xml, h`` (header, or null)."""
    files, inputs, near = selected_files(selected, ".xml", folders)
    raw = read_records(spark, inputs, "*.xml", near) if inputs else _no_records(spark)
    src = of_selected(raw, files, "source_file").withColumn("k_ip", ip_num(stem_of("source_file")))
    # one scan: each record yields its host element and, for a file's first record, the header
    return files, inputs, near, pin(src, keep=["k_ip", "source_file", "block_start", "row_id"],
                                    host_xml=host_fragment("value"), h=header_struct("value"))


def _with_domains(hosts: DataFrame, domains: DataFrame | None) -> DataFrame:
    if domains is None:
        return hosts
    addr = F.regexp_extract("host_xml", r'<address\b[^>]*\saddr="([^"]*)"', 1)
    return add_domains_to_hosts(hosts.withColumn("ip", addr), domains).drop("ip")


def _header_key():
    """Headers in the order of the reports' addresses, then paths."""
    return F.struct(F.coalesce("k_ip", F.lit(1 << 40)), "source_file")


def merge_xml(spark: SparkSession, selected: DataFrame, domains: DataFrame | None = None,
              folders: list[str] | None = None) -> DataFrame:
    """R2: header of one report, every host element of every selected XML report
    (duplicates kept), footer with the host count.

    Returns ``section, k_ip, k_path, k_block, k_row, value`` – order by all five.
    The header comes from the report with the lowest (address, path).
    ``folders`` names the report folders; without it they are derived from the paths.
    """
    recs = _records(spark, selected, folders)[-1]
    hosts = _with_domains(recs.where(F.col("host_xml").isNotNull()), domains)
    body = hosts.select(F.lit(1).alias("section"), "k_ip", F.col("source_file").alias("k_path"),
                        F.col("block_start").alias("k_block"), F.col("row_id").alias("k_row"),
                        F.col("host_xml").alias("value"))
    # header and host count from one aggregate; both rows below reuse its exchange
    stats = recs.agg(F.count("host_xml").alias("n"), F.min_by("h", F.when(F.col("h").isNotNull(), _header_key())).alias("h"))
    nulls = [F.lit(None).cast("bigint").alias("k_ip"), F.lit(None).cast("string").alias("k_path"),
             F.lit(None).cast("bigint").alias("k_block"), F.lit(None).cast("bigint").alias("k_row")]
    header = stats.where(F.col("h").isNotNull()).select(F.lit(0).alias("section"), *nulls,
                                                        _header_text(F.col("h")).alias("value"))
    footer = stats.select(F.lit(2).alias("section"), *nulls, _footer_text(F.col("n")).alias("value"))
    return header.unionByName(body).unionByName(footer)


def file_key(path, encoded: bool) -> "F.Column":
    """A file's place without scheme or repeated slashes; a path from ``_metadata`` is URL-encoded."""
    c = F.col(path)
    if encoded:
        c = F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(F.regexp_replace(c, "^[A-Za-z][A-Za-z0-9+.-]*:", ""), "^/+", "/")


def report_folders(files: DataFrame, folders: list[str] | None = None) -> list[str]:
    """Folders to read: those given, else the ones that hold the files (file-system metadata: a few folders)."""
    if folders:
        return list(folders)
    return [r.d for r in files.select(F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("d")).distinct().collect()]


def of_selected(rows: DataFrame, files: DataFrame, path: str) -> DataFrame:
    """Rows read from a folder that belong to the selected files (``path``): one plan for any number of files.

    The selection is the small side; Spark broadcasts it below its size threshold and joins by shuffle beyond.
    """
    keys = files.select(file_key("path", encoded=False).alias("_key"))
    return rows.withColumn("_key", file_key(path, encoded=True)).join(keys, "_key", "left_semi").drop("_key")


def stem_of(path_col) -> "F.Column":
    """File name of an encoded path without its last suffix."""
    return F.regexp_extract(F.url_decode(F.replace(F.col(path_col), F.lit("+"), F.lit("%2B"))), r"([^/]+)\.[^./]*$", 1)


def _no_records(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "value string, source_file string, block_start bigint, row_id bigint")


def merged_host_count(merged: DataFrame) -> DataFrame:
    """Host elements merged (duplicates counted)."""
    return merged.where(F.col("section") == 1).agg(F.count("*").alias("n_hosts"))


# ---------------------------------------------------------------- R3, R4
def merge_text(spark: SparkSession, selected: DataFrame, suffix: str = ".nmap",
               folders: list[str] | None = None, numbered: bool = False) -> DataFrame:
    """All lines of the selected reports with ``suffix``, by address of the
    stem (by path if any stem is not IPv4).

    Returns ``stem, path, k_ip, k_block, k_row, value``; order by ``k_ip, path, k_block, k_row``.
    ``numbered`` adds ``line_no``, which counts lines within a report.
    """
    files, inputs, near = selected_files(selected, suffix, folders)
    all_v4 = files.agg(F.bool_and(ip_num("stem").isNotNull()).alias("b")).first().b  # one value
    if inputs:
        lines = spark.read.option("pathGlobFilter", f"*{suffix}").text(inputs).where(near(F.col("_metadata.file_name"))).select(
            "value", F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("k_block"), F.monotonically_increasing_id().alias("k_row"))
    else:
        lines = spark.createDataFrame([], "value string, path string, k_block bigint, k_row bigint")
    key = ip_num(stem_of("path")) if all_v4 else F.lit(None).cast("bigint")
    out = of_selected(lines, files, "path").withColumn("stem", stem_of("path")).withColumn("k_ip", key)
    if numbered:
        out = line_numbers(out, "path", "k_block", "k_row")
    return out.select("stem", "path", "k_ip", "k_block", "k_row", *(["line_no"] if numbered else []), "value")


TEXT_ORDER = ["k_ip", "path", "k_block", "k_row"]


def show_text(spark: SparkSession, selected: DataFrame, folders: list[str] | None = None) -> DataFrame:
    """R3 over ``.nmap`` reports with a numbered separator row before each report.

    Returns ``k_ip, path, sep, k_block, k_row, value``; order by all but ``value``.
    """
    body = merge_text(spark, selected, ".nmap", folders)
    # number the selected reports themselves (one row per file), so a report without lines is shown too
    files = selected.where(F.col("suffix") == ".nmap").select(F.col("path").alias("shown"), "stem", ip_num("stem").alias("k_ip"))
    numeric, total = files.agg(F.bool_and(F.col("k_ip").isNotNull()), F.count("*")).first()
    if not numeric:
        files = files.withColumn("k_ip", F.lit(None).cast("bigint"))
    files = files.withColumn("path", file_key("shown", encoded=False))
    body = body.withColumn("path", file_key("path", encoded=True))
    numbered = number_rows(files, ["k_ip", "path"], "i").withColumn("total", F.lit(total))
    seps = numbered.select("k_ip", "path", F.lit(0).alias("sep"), F.lit(None).cast("bigint").alias("k_block"),
                           F.lit(None).cast("bigint").alias("k_row"),
                           fill(SHOW_SEPARATOR, {"i": F.col("i"), "total": F.col("total"),
                                                  "path": F.col("path")}).alias("value"))
    lines = body.select("k_ip", "path", F.lit(1).alias("sep"), "k_block", "k_row", "value")
    return seps.unionByName(lines)


# ---------------------------------------------------------------- T7-T9
def write_ordered_text(df: DataFrame, order: list[str], path: str, single_file: bool = False,
                       partitions: int | None = None) -> str:
    """Write ``value`` rows in ``order`` as text: range-partitioned, sorted within partitions."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = sort_order(*order)
    out = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).select("value")
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").text(path)
    return path


def write_merged_xml(spark: SparkSession, selected: DataFrame, path: str, domains: DataFrame | None = None,
                     folders: list[str] | None = None) -> str:
    """The merged XML report of R2 in ``path``, as ``section=0`` (header), ``section=1`` (host elements) and
    ``section=2`` (footer with their number).

    Host elements are written by the tasks that read them, and counted on their way.  The header is read from the
    first report alone, or, where that has none, from all.
    """
    files, inputs, near, recs = _records(spark, selected, folders)
    seen = Observation()
    hosts = _with_domains(recs.where(F.col("host_xml").isNotNull()), domains)
    hosts.select(F.col("host_xml").alias("value")).observe(seen, F.count(F.lit(1)).alias("n")) \
        .write.mode("overwrite").text(f"{path}/section=1")
    first = files.orderBy(*sort_order("lo", "path")).limit(1)
    head = None
    if inputs:
        low = first.first().lo
        one = of_selected(read_records(spark, inputs, "*.xml", near_names([(low, low)])), first, "source_file")
        for records in (one.select(header_struct("value").alias("h"), "source_file").withColumn("k_ip", F.lit(0)), recs):
            head = records.where(F.col("h").isNotNull()).agg(F.min_by("h", _header_key()).alias("h")).where("h is not null").first()
            if head:
                break
    none = spark.createDataFrame([], "value string")
    given = spark.createDataFrame([head.h], recs.schema["h"].dataType).select(_header_text({c: F.col(c) for c in head.h.asDict()}).alias("value")) \
        if head else none
    given.coalesce(1).write.mode("overwrite").text(f"{path}/section=0")
    spark.range(1).select(_footer_text(F.lit(seen.get["n"])).alias("value")).write.mode("overwrite").text(f"{path}/section=2")
    return path


def write_merged_text(merged: DataFrame, path: str, single_file: bool = False) -> str:
    """T7 (``.nmap``) and T8 (``.gnmap``)."""
    return write_ordered_text(merged, TEXT_ORDER, path, single_file)
