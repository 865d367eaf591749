"""Report sets and XML reports.

XML is read as text split at ``</host>``: a file of any size is cut into
host records by the splittable line reader, each record keeps its raw
fragment (so merging loses no attribute), and ``from_xml`` with a narrow
schema gives the columns.  Order within a file is ``(block_start, row_id)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scanlake.functions import let, pin
from scanlake.functions.ip import ip_num
from scanlake.functions.ranges import within
from scanlake.functions.xmltext import escape_attr
from scanlake.schema import HOST_XML
from scanlake.session import materialized, new_path

XML_DECL = '<?xml version="1.0" encoding="UTF-8"?>'
_IPV4_ANY = r"([0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3})"


# --------------------------------------------------------------------- S15
def report_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """List report files: ``path, stem, suffix, kind, report_ip, report_port``.

    Only names holding a dot are listed; ``stem`` is the name without its last
    suffix.  The binary content column is never read.
    """
    files = spark.read.format("binaryFile").load(folder).select("path")
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    stem = F.regexp_extract(name, r"^(.*)\.[^.]*$", 1)
    suffix = F.regexp_extract(name, r"(\.[^.]*)$", 1)
    is_port = stem.startswith("port")
    return (files.where(name.contains(".") & (stem != ""))
            .select("path", stem.alias("stem"), suffix.alias("suffix"),
                    F.when(is_port, "port").otherwise("host").alias("kind"),
                    F.when(~is_port & ip_num(stem).isNotNull(), stem).alias("report_ip"),
                    F.when(is_port, F.substring(stem, 5, 1 << 20).try_cast("int")).alias("report_port")))


# --------------------------------------------------------------------- S16
def read_host_elements(spark: SparkSession, paths, names: str | None = None, near=None) -> DataFrame:
    """One row per ``<host>`` element: ``source_file, block_start, row_id, host_xml``."""
    recs = read_records(spark, paths, names, near)
    keyed = pin(recs, keep=["source_file", "block_start", "row_id"], host_xml=host_fragment("value"))
    return keyed.where(F.col("host_xml").isNotNull())


def _parsed(hosts: DataFrame, schema: str) -> DataFrame:
    # pinned: the filters Spark infers for later explodes must not re-run the XML parser
    return pin(hosts, h=F.from_xml("host_xml", f"{schema}, _bad string",
                                   {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))


def _is_bad():
    return F.col("h").isNull() | F.col("h._bad").isNotNull()


def parse_hosts(hosts: DataFrame, schema: str = HOST_XML, mode: str = "strict") -> DataFrame:
    """Add the parsed element ``h`` (D5) and its address ``ip`` (first IPv4, else first).

    An element that is no well-formed XML fails the job (``strict``) or is left to ``bad_hosts`` (``quarantine``).
    """
    if mode not in ("strict", "quarantine"):
        raise ValueError(mode)
    h = _parsed(hosts, schema)
    if mode == "strict":
        h = h.where(F.when(_is_bad(), F.raise_error(F.concat(F.lit("malformed host element in "), F.coalesce(
            F.col("source_file") if "source_file" in hosts.columns else F.lit(None), F.lit("?")), F.lit(": "),
            F.substring("host_xml", 1, 200)))).otherwise(F.lit(True)))
    else:
        h = h.where(~_is_bad())
    h = h.withColumn("h", F.col("h").dropFields("_bad"))
    v4 = F.filter("h.address", lambda a: a["_addrtype"] == "ipv4")
    ip = F.coalesce(F.try_element_at(v4, F.lit(1))["_addr"],
                    F.try_element_at(F.col("h.address"), F.lit(1))["_addr"])
    return h.withColumn("ip", ip)


def bad_hosts(hosts: DataFrame, schema: str = HOST_XML) -> DataFrame:
    """The side table of ``parse_hosts(mode="quarantine")``: ``source_file, value, reason`` of malformed elements."""
    return _parsed(hosts, schema).where(_is_bad()).select(
        "source_file", F.col("host_xml").alias("value"), F.lit("malformed host element").alias("reason"))


# --------------------------------------------------------------------- S14
BROADCAST_REPEATS = 1_000_000      # rows of three numbers and a path; beyond, documents are merged with them by shuffle


def _documents(spark: SparkSession, paths) -> DataFrame:
    """Documents (declaration removed, trimmed) with their first IPv4 address and their place in the input."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    raw = spark.read.option("lineSep", XML_DECL).text(paths).select(
        F.btrim("value", F.lit(" \t\r\n")).alias("doc"), F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_id"))
    stem = F.regexp_extract("doc", _IPV4_ANY, 1)
    return raw.where(F.col("doc") != "").withColumn("stem", F.when(stem != "", stem))


_PLACE = ["source_file", "block_start", "row_id"]


def numbered_names(places: DataFrame) -> DataFrame:
    """``n = 1, 2, ...`` of each ``stem`` in the order of its places, without gathering a stem in one task: places are
    numbered within (stem, file split), and then moved on by the stem's places in earlier splits."""
    part = ["stem", "source_file", "block_start"]
    local = places.withColumn("_i", F.row_number().over(Window.partitionBy(*part).orderBy("row_id")))
    splits = places.groupBy(*part).agg(F.count("*").alias("_c"))
    w = Window.partitionBy("stem").orderBy("source_file", "block_start").rowsBetween(Window.unboundedPreceding, -1)
    offs = splits.withColumn("_off", F.coalesce(F.sum("_c").over(w), F.lit(0))).drop("_c")
    return local.join(offs, part).withColumn("n", (F.col("_off") + F.col("_i")).cast("int")).drop("_i", "_off")


def split_documents(spark: SparkSession, paths) -> DataFrame:
    """Split files holding several concatenated XML documents.

    Returns ``stem, n, source_file, doc`` – the document (declaration removed,
    trimmed), named by its first IPv4 address; repeats of a name are numbered
    ``n = 1, 2, ...``.  Documents without an address have a null ``stem``
    (see :func:`documents_without_address`).  The last document is kept.

    Names are numbered on places alone; only the places of repeats meet the documents again.
    """
    docs = _documents(spark, paths)
    places = docs.where(F.col("stem").isNotNull()).select("stem", *_PLACE)
    repeats = materialized(numbered_names(places).where("n > 1").select(*_PLACE, "n"), "repeats")
    if repeats.count() <= BROADCAST_REPEATS:
        repeats = F.broadcast(repeats)
    return docs.join(repeats, _PLACE, "left").select("stem", F.coalesce("n", F.lit(1)).alias("n"), "source_file", "doc")


def write_split_documents(spark: SparkSession, paths, folder: str) -> DataFrame:
    """Write each document of concatenated XML files as ``<ip>.xml`` (repeats as ``<ip>_<n>.xml``) in ``folder``; returns
    the documents without an address.

    Each task writes its own documents under their places, so no document crosses the network; what is listed
    there is numbered and given its name.
    """
    docs = _documents(spark, paths)
    at = F.concat_ws("-", F.sha1("source_file"), F.lpad(F.col("block_start").cast("string"), 20, "0"),
                     F.lpad(F.col("row_id").cast("string"), 20, "0"))
    written = new_path(spark, "split")
    docs.where(F.col("stem").isNotNull()).select("stem", at.alias("at"), F.concat(F.lit(XML_DECL + "\n"), F.col("doc")).alias("value")) \
        .write.partitionBy("stem", "at").text(written)
    names = _listed(spark, written).select(
        "path", F.regexp_extract("path", "/stem=([^/]*)/", 1).alias("stem"), F.regexp_extract("path", "/at=([^/]*)/", 1).alias("at"))
    names = names.select("path", "stem", F.split("at", "-")[0].alias("source_file"), F.split("at", "-")[1].alias("block_start"),
                         F.split("at", "-")[2].alias("row_id"))
    n = F.when(F.col("n") == 1, "").otherwise(F.concat(F.lit("_"), F.col("n").cast("string")))
    place_files(numbered_names(names).select("path", F.concat("stem", n, F.lit(".xml")).alias("name")), folder)
    return documents_without_address(docs.select("stem", F.lit(1).alias("n"), "source_file", "doc"))


def _listed(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(folder).select("path")


def place_files(names: DataFrame, folder: str, threads: int = 16) -> int:
    """Move files (``path``) to ``folder/name`` through the session's file system; returns how many.

    A move is one call to the file system and moves no data through Spark; names come to the driver a partition at a time.
    """
    from concurrent.futures import ThreadPoolExecutor

    spark = names.sparkSession
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(Path(folder))

    def move(r):
        to = Path(f"{folder}/{r.name}")
        if fs.exists(to):
            fs.delete(to, False)
        if not fs.rename(Path(r.path), to):
            raise OSError(f"cannot move {r.path} to {folder}/{r.name}")

    with ThreadPoolExecutor(threads) as pool:
        return sum(1 for _ in pool.map(move, names.toLocalIterator()))


def write_named_files(df: DataFrame, folder: str) -> int:
    """Write ``name, content`` rows as one file each under ``folder`` (a closing line end is added where there is none);
    returns the number of files."""
    spark, written = df.sparkSession, new_path(df.sparkSession, "named")
    df.select("name", F.regexp_replace("content", "\n\\z", "").alias("value")).write.partitionBy("name").text(written)
    name = F.url_decode(F.replace(F.regexp_extract("path", "/name=([^/]*)/", 1), F.lit("+"), F.lit("%2B")))
    return place_files(_listed(spark, written).select("path", name.alias("name")), folder)


def documents_without_address(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("stem").isNull())


# --------------------------------------------------------------------- S21
def _unescape(c):
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


HEADER_FIELDS = ("scanner", "args", "version", "xmloutputversion", "type", "protocol")


def header_struct(value) -> "F.Column":
    """Header attributes of a record holding ``<nmaprun ...>`` (null for other records):
    root and ``scaninfo`` attributes, ``scaninfo`` winning a clash, escaped
    again for an attribute; a missing attribute is empty."""
    v = F.col(value) if isinstance(value, str) else value
    root = F.regexp_extract(v, r"(?s)(<nmaprun\b[^>]*>)", 1)
    info = F.regexp_extract(v, r"(?s)(<scaninfo\b[^>]*>)", 1)

    def attr(el, name):
        return F.regexp_extract(el, rf'\s{name}="([^"]*)"', 1)

    def pick(name):
        v_info, v_root = attr(info, name), attr(root, name)
        val = F.when(F.regexp_extract(info, rf'\s({name})="', 1) != "", v_info).otherwise(
            F.when(F.regexp_extract(root, rf'\s({name})="', 1) != "", v_root))
        return escape_attr(_unescape(F.coalesce(val, F.lit("")))).alias(name)

    return F.when(v.contains("<nmaprun"), F.struct(*[pick(n) for n in HEADER_FIELDS]))


def file_number(name) -> "F.Column":
    """A number of a report's file name that puts addresses in order, then ports, then other names in any order."""
    return let(F.regexp_extract(name, r"^(.*)\.[^.]*$", 1), lambda stem: F.coalesce(
        ip_num(stem), (F.regexp_extract(stem, "^port([0-9]{1,9})$", 1).try_cast("bigint") + (1 << 33)),
        F.pmod(F.xxhash64(stem), F.lit(1 << 30)) + (1 << 34)))


def near_names(cover: list[tuple[int, int]]):
    """For ``read_records``: a condition on a file's name, which leaves files out when Spark lists them."""
    return lambda name: F.exists(F.array(file_number(name)), lambda k: within(k, cover))


def read_records(spark: SparkSession, paths, names: str | None = None, near=None) -> DataFrame:
    """XML files split at ``</host>``: ``value, source_file, block_start, row_id``.

    ``names`` picks a folder's files by pattern, ``near`` by a condition on the file name.
    """
    if isinstance(paths, str):
        paths = [paths]
    reader = spark.read.option("lineSep", "</host>")
    if names:
        reader = reader.option("pathGlobFilter", names)
    read = reader.text(list(paths))
    if near is not None:
        read = read.where(near(F.col("_metadata.file_name")))
    return read.select(
        "value", F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_id"))


def host_fragment(value) -> "F.Column":
    """The ``<host>`` element a record ends with (null when it holds none)."""
    v = F.col(value) if isinstance(value, str) else value
    frag = F.regexp_extract(v, r"(?s)(<host[\s>].*)$", 1)
    return F.when(frag != "", F.concat(frag, F.lit("</host>")))


def read_headers(spark: SparkSession, paths) -> DataFrame:
    """Header of each XML report: ``source_file`` plus ``scanner, args, version,
    xmloutputversion, type, protocol``."""
    recs = read_records(spark, paths).where(F.col("value").contains("<nmaprun"))
    return recs.select("source_file", header_struct("value").alias("h")).select("source_file", "h.*")
