"""Operator 11: WARC archives without repeated payloads.

1. Headers alone (digest, length, page_id, place of the row) are shuffled by
   payload digest; the least page_id of a digest becomes its original, the
   others become revisits.  The grouping is summed per task before the shuffle,
   and only digests that occur again go on, so a hot payload is one row a task.
2. Pages are written with fresh headers: a ``response`` with its payload, or a
   ``revisit`` that names the original's record, URI and digest and has none.
   Pages meet the revisits (not the originals) by their place, a key of one row.
3. Read back, revisits are joined to the responses whose record id they name,
   which gives them their full length.

Archives are WARC/1.1 in gzip, one stream a file, written by Spark's own text
writer (so committed by task, on any file system): each record's two closing
line ends are the line separator.  The reader takes the same separator, puts the
pieces together again and parses by Content-Length, so payloads may hold
anything, record headers and separators included.  It streams: a task holds a
batch and one record.

Defined cases: null html is an empty payload, a null url leaves the URI out, line
ends in a url are percent-encoded.  A null page_id comes after all others; of rows with
equal page_id and payload one is the original.  A revisit whose response is in no
archive keeps its digest, with null length and refers_to.  Empty tables give
archives without records.  Columns besides page_id, url, html (and the place) are not read.
"""

from __future__ import annotations

import datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.llm.components import written
from scanlake.session import new_path

LEAST_BYTES = 0             # smaller payloads are written each time
# Fixed values of WARC/1.1: line end, separator between records, and the profile of revisits by digest.
CRLF = "\r\n"
BETWEEN = CRLF * 2
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Extension header that carries the page's id.
PAGE_ID = "X-Page-ID"

_RECORD = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
                     ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_to_id", pa.string()),
                     ("payload", pa.binary())])
RECORD = ("record_id string, record_type string, page_id long, url string, payload_digest string, payload_bytes long, "
          "refers_to_id string, payload binary")


def base32_sha1(payload) -> F.Column:
    """Upper-case base32 of the SHA-1: four digits for each twenty of its bits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def records(pages: DataFrame, row: str | None = None) -> DataFrame:
    """page_id, url, payload, payload_digest, payload_bytes, row.

    ``row`` names a column that is one row's own and the same in every pass, such as a place in a file; without
    one, pages are written first.
    """
    if row is None:
        pages = written(pages.select("page_id", "url", "html").withColumn("row", F.monotonically_increasing_id()), "pages")
        row = "row"
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload"), base32_sha1(payload.cast("binary")).alias("payload_digest"),
                        F.octet_length(payload).cast("long").alias("payload_bytes"), F.col(row).alias("row"))


def revisits(recs: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """row, original (page_id, url, row): the records whose payload an earlier one has."""
    heads = recs.filter(F.col("payload_bytes") >= least_bytes).select("payload_digest", "page_id", "url", "row")
    key = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row")
    first = heads.groupBy("payload_digest").agg(F.min_by(F.struct("page_id", "url", "row"), key).alias("original"),
                                                F.count("*").alias("n"))
    return heads.select("payload_digest", "row").join(first.filter("n > 1").drop("n"), "payload_digest") \
        .filter(F.col("row") != F.col("original.row")).select("row", "original")


def _record_id(digest, row, salt: str) -> F.Column:
    h = F.md5(F.concat_ws("|", F.lit(salt), digest, F.to_json(F.struct(row.alias("row")))).cast("binary"))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _uri(url) -> F.Column:
    return F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def write_archives(recs: DataFrame, folder: str, least_bytes: int = LEAST_BYTES,
                   date: datetime.datetime | None = None) -> str:
    """Write the records (see ``records``) as deduplicated archives; returns the folder."""
    date_text = F.lit((date or datetime.datetime.now(datetime.timezone.utc)).strftime("%Y-%m-%dT%H:%M:%SZ"))
    again = revisits(recs, least_bytes).withColumnRenamed("row", "again")
    r = recs.join(again, F.col("row") == F.col("again"), "left")
    is_again, of = F.col("again").isNotNull(), F.col("original")

    def field(name, value):
        """A header line; none where the value is null."""
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))

    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(BETWEEN))
    block = F.concat(http, F.when(is_again, F.lit("")).otherwise(F.col("payload")))
    def only_again(value):
        return F.when(is_again, value)

    text = F.concat(
        F.lit(f"WARC/1.1{CRLF}"), field("WARC-Type", F.when(is_again, F.lit("revisit")).otherwise(F.lit("response"))),
        field("WARC-Record-ID", _record_id(F.col("payload_digest"), F.col("row"), folder)),
        field("WARC-Date", date_text), field("WARC-Target-URI", _uri(F.col("url"))),
        field(PAGE_ID, F.col("page_id").cast("string")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        field("WARC-Profile", only_again(F.lit(PROFILE))),
        field("WARC-Refers-To", only_again(_record_id(F.col("payload_digest"), of["row"], folder))),
        field("WARC-Refers-To-Target-URI", only_again(_uri(of["url"]))),
        field("WARC-Refers-To-Date", only_again(date_text)),
        field("Content-Type", F.lit("application/http; msgtype=response")),
        field("Content-Length", F.octet_length(block).cast("string")), F.lit(CRLF), block)
    r.select(text.alias("value")).write.option("lineSep", BETWEEN).option("compression", "gzip").text(folder)
    return folder


def parsed(data: bytes) -> tuple[list[tuple[dict[str, str], bytes]], int]:
    """(headers, block) of the whole records that data begins with, and the place behind them."""
    out, at, end = [], 0, BETWEEN.encode()
    while (head := data.find(end, at)) >= 0:
        lines = data[at:head].decode("utf-8", "surrogateescape").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record: {lines[0][:40]!r}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        size = int(fields["Content-Length"])
        if head + 4 + size + 4 > len(data):
            break
        out.append((fields, data[head + 4: head + 4 + size]))
        at = head + 4 + size + 4
    return out, at


def _row(fields: dict[str, str], block: bytes) -> dict:
    head, _, payload = block.partition(BETWEEN.encode())
    response = fields["WARC-Type"] == "response"
    page = fields.get(PAGE_ID)
    return {"record_id": fields["WARC-Record-ID"], "record_type": fields["WARC-Type"],
            "page_id": None if page is None else int(page), "url": fields.get("WARC-Target-URI"),
            "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
            "payload_bytes": len(payload) if response else None, "refers_to_id": fields.get("WARC-Refers-To"),
            "payload": payload if response else None}


def _read(payload: bool):
    names = [f.name for f in _RECORD if payload or f.name != "payload"]
    schema = pa.schema([_RECORD.field(n) for n in names])
    sep = BETWEEN.encode()

    def read(batches):
        rest, last = b"", None
        for batch in batches:
            files, pieces = batch["file"].to_pylist(), batch["value"].cast(pa.binary()).to_pylist()
            at = 0
            while at < len(files):                          # a task may read several files, one after the other
                to = at
                while to < len(files) and files[to] == files[at]:
                    to += 1
                if files[at] != last and rest:
                    raise ValueError(f"{last} ends within a record")
                last = files[at]
                data = rest + sep.join(pieces[at:to]) + sep
                found, behind = parsed(data)
                rest = data[behind:]
                rows = [_row(*x) for x in found]
                if rows:
                    yield pa.record_batch([pa.array([r[n] for r in rows], _RECORD.field(n).type) for n in names], schema=schema)
                at = to
        if rest:
            raise ValueError(f"{last} ends within a record")

    return read


def read_archives(spark: SparkSession, folder: str, payload: bool = False) -> DataFrame:
    """One row per record of the folder's gzip archives: the columns of ``RECORD``, payload only on request."""
    pieces = spark.read.option("lineSep", BETWEEN).text(folder).select(F.col("_metadata.file_path").alias("file"), "value")
    return pieces.mapInArrow(_read(payload), RECORD if payload else RECORD.rsplit(",", 1)[0])


def resolved(read: DataFrame) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to: revisits joined to their original responses."""
    original = read.filter("record_type = 'response'").select(
        F.col("record_id").alias("original"), F.col("page_id").alias("refers_to"), F.col("payload_bytes").alias("n"))
    return read.join(original, (F.col("refers_to_id") == F.col("original")) & (F.col("record_type") == "revisit"), "left") \
        .select("page_id", "url", F.coalesce("payload_bytes", "n").alias("payload_bytes"), "payload_digest", "record_type",
                "refers_to")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html", place.alias("row"))
    folder = write_archives(records(pages, "row"), new_path(spark, "llm_warc"))
    return resolved(read_archives(spark, folder)).drop("url")


ORACLE = """
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, strlen(html) as n, sha1(html) as h, min(page_id) over (partition by sha1(html)) as first from p)
select page_id, cast(n as bigint) as payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((cast(concat('0x', substr(h, 1 + 5 * (i // 4), 5)) as bigint)
    >> (15 - 5 * (i % 4))) & 31), 1) for i in range(0, 32)], '') as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id <> first then first end as refers_to
from d
"""
