"""Legacy archive converter: ARC files (versions 1 and 2) to WARC 1.0.

An ARC file starts with a version block, whose second line names the version;
each document has one header line (version 1: url, IP, date, type, length;
version 2 adds result code, checksum, location, offset and file name before
the length) and as many bytes as it declares. The converter parses by these
declared lengths and synthesises for each document a WARC record: identifier
(a name-based UUID of the record's content and key), timestamp, type, payload
and block digests (SHA-1). Of documents with equal payloads of at least
``min_bytes``, that with the largest key is a response; the others become
revisits that refer to its record and hold the HTTP header only. Documents that
are no HTTP message (of ``dns:`` or ``ftp:`` urls) become resource records of the
ARC line's type. The line's IP is kept, and each file begins with a warcinfo record.

Spark writes and reads the archives: its text writer ends each ARC document
with a line feed and each WARC record with two line ends, as the formats want;
files are read as binary rows. A file holds one task's rows, so its size is
bounded by the input splits. Equal payloads are found on (digest, key) rows in
a map-side aggregate; payloads are shuffled only if the duplicated digests are
too many to broadcast.

Defined results: null payloads are empty; a null url is written as ``-``;
null keys are written without a key and never name a response; rows that
repeat a key and a payload are all responses or all revisits; an IP that is
none, or ``0.0.0.0``, is left out; an empty table
gives empty archives; extra columns are ignored."""

from __future__ import annotations

import base64
import hashlib
import ipaddress
import re
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curatio.operators.util import ship_by_value

ARC_FIELDS = {
    "1": ("url", "ip", "date", "mime", "length"),
    "2": ("url", "ip", "date", "mime", "status", "checksum", "location", "offset", "file", "length"),
}
ARC_TITLES = {
    "1": "URL IP-address Archive-date Content-type Archive-length",
    "2": "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
#: Namespace of synthesised record identifiers.
SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:arc-to-warc")
#: Header fields that carry a record's key through both formats.
KEY = "X-Archive-Key"
REFERS_KEY = "X-Refers-To-Key"
#: Duplicated digests up to this many are broadcast (with a url each).
BROADCAST_DIGESTS = 100_000


@dataclass(frozen=True)
class ArcRules:
    min_bytes: int = 1000
    date: str = "20200101000000"
    mime: str = "text/html"
    ip: str = "0.0.0.0"


def _line(value) -> str:
    """A header value without spaces and line ends."""
    return re.sub(r"[\s\x00-\x1f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), value or "-") or "-"


def arc_header(version: str, **f) -> str:
    return " ".join(str(f[k]) for k in ARC_FIELDS[version])


def write_arc(pages: DataFrame, path: str, rules: ArcRules, key_col: str = "page_id", url_col: str = "url",
              html_col: str = "html") -> None:
    """One gzip ARC file per task, of version 1 or 2 by turns."""
    ship_by_value(__name__)
    src = pages.select(F.col(key_col).cast("string").alias("key"), F.col(url_col).alias("url"),
                       F.coalesce(html_col, F.lit("")).alias("html"), F.spark_partition_id().alias("file"))

    def run(batches):
        version, at = None, 0
        for batch in batches:
            out = []
            for key, url, html, file in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if version is None:
                    version, name = "12"[file % 2], f"part-{file:05d}.arc.gz"
                    block = f"{version} 0 curatio\n{ARC_TITLES[version]}\n"
                    head = arc_header(version, url=f"filedesc://{name}", ip=rules.ip, date=rules.date, mime="text/plain",
                                      status=200, checksum="-", location="-", offset=0, file=name, length=len(block))
                    out.append(f"{head}\n{block}")
                    at += len(out[-1]) + 1
                raw = len(html.encode("utf-8"))
                http = "HTTP/1.1 200 OK\r\n" + f"Content-Type: {rules.mime}\r\nContent-Length: {raw}\r\n" + (
                    f"{KEY}: {key}\r\n" if key is not None else "") + "\r\n"
                head = arc_header(version, url=_line(url), ip=rules.ip, date=rules.date, mime=rules.mime, status=200,
                                  checksum="-", location="-", offset=at, file=name, length=len(http) + raw)
                out.append(f"{head}\n{http}{html}")
                at += len(head.encode()) + 1 + len(http) + raw + 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["value"])

    src.mapInArrow(run, "value string").write.option("compression", "gzip").option("lineSep", "\n").text(path)


def _inflate(content: bytes) -> bytes:
    """All members of a gzip file; other content as it is."""
    if content[:2] != b"\x1f\x8b":
        return content
    out = []
    while content:
        d = zlib.decompressobj(31)
        out.append(d.decompress(content))
        content = d.unused_data.lstrip(b"\0")
    return b"".join(out)


def _http(block: bytes) -> tuple[dict, bytes, bytes]:
    """(fields, header with its empty line, payload) of an HTTP message."""
    end = block.find(b"\r\n\r\n")
    if not block.startswith(b"HTTP/") or end < 0:
        return {}, b"", block
    fields = dict(x.split(": ", 1) for x in block[:end].decode("latin-1").split("\r\n")[1:] if ": " in x)
    return fields, block[:end + 4], block[end + 4:]


def arc_records(data: bytes):
    """(header dict, block) of each document of an ARC file, by declared
    lengths; a version block may come again where files were joined."""
    at, fields = 0, None
    while at < len(data):
        end = data.find(b"\n", at)
        if end < 0:
            break
        line = data[at:end].decode("utf-8", "replace").rstrip("\r")
        if not line:
            at = end + 1                       # the line ends between documents
            continue
        parts = line.split(" ")
        if not parts[-1].isdigit():
            raise ValueError(f"no declared length in ARC header line: {line[:200]}")
        size = int(parts[-1])
        block = data[end + 1:end + 1 + size]
        if len(block) < size:
            raise ValueError(f"ARC document is cut off: {line[:200]}")
        if line.startswith("filedesc://"):
            version = block.split(b" ", 1)[0].decode()
            if version not in ARC_FIELDS:
                raise ValueError(f"ARC version {version!r}")
            fields = ARC_FIELDS[version]
        else:
            if fields is None:
                raise ValueError("ARC document before the version block")
            tail = len(fields) - 1             # the url takes what the others leave
            if len(parts) < len(fields):
                raise ValueError(f"ARC header line with too few fields: {line[:200]}")
            yield dict(zip(fields, [" ".join(parts[:-tail]), *parts[-tail:]])), block
        at = end + 1 + size


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")


def read_arc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Parsed ARC documents: key, url, date, mime, ip, message (is it HTTP),
    http (header), payload (null if not wanted), bytes, digest (SHA-1 hex of
    the payload)."""
    ship_by_value(__name__)

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows, held = [], 0
                for f, block in arc_records(_inflate(content.as_py())):
                    fields, http, payload = _http(block)
                    rows.append((fields.get(KEY), f["url"], f["date"], f["mime"], f["ip"], http != b"", http if payloads else None,
                                 payload if payloads else None, len(payload), hashlib.sha1(payload).hexdigest()))
                    held += len(block) * payloads + 100
                    if held > 8 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
                yield _batch(rows)

    kinds = [pa.string()] * 5 + [pa.bool_()] + [pa.binary()] * 2 + [pa.int64(), pa.string()]
    names = ["key", "url", "date", "mime", "ip", "message", "http", "payload", "bytes", "digest"]

    def _batch(rows):
        cols = list(zip(*rows)) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)

    return _files(spark, path).mapInArrow(
        run, "key string, url string, date string, mime string, ip string, message boolean, http binary, "
             "payload binary, bytes long, digest string")


def record_id(key, url: str, date: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'{key} {url} {date} {digest}')}>"


def _stamp(date: str) -> str:
    d = date.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def _sha32(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _address(ip: str | None) -> str | None:
    try:
        found = ipaddress.ip_address(ip or "")
    except ValueError:
        return None
    return None if found.is_unspecified else str(found)


def warc_record(key, url, date, http: bytes, payload: bytes, digest: str, response=None, ip: str | None = None,
                mime: str | None = None) -> bytes:
    """A response; a revisit of the ``response`` (key, url, date), if given;
    a resource, if there is no HTTP header."""
    kind = "resource" if not http else "response" if response is None else "revisit"
    block = http if kind == "revisit" else http + payload
    head = ["WARC/1.0", f"WARC-Type: {kind}",
            f"WARC-Record-ID: {record_id(key, url, date, digest)}", f"WARC-Date: {_stamp(date)}",
            f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
            f"WARC-Block-Digest: {_sha32(block)}"]
    if _address(ip):
        head.append(f"WARC-IP-Address: {_address(ip)}")
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(*response, digest)}", f"WARC-Refers-To-Target-URI: {response[1]}",
                 f"WARC-Refers-To-Date: {_stamp(response[2])}", f"{REFERS_KEY}: {response[0]}"]
    if key is not None:
        head.append(f"{KEY}: {key}")
    if kind == "resource":
        content = mime if mime and "/" in mime else "application/octet-stream"
    else:
        content = "application/http; msgtype=response"
    head += [f"Content-Type: {content}", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block


def info_record(first: str, date: str) -> bytes:
    """The warcinfo record of a file, named after the file's first record."""
    block = b"software: curatio\r\nformat: WARC File Format 1.0\r\ndescription: converted from ARC\r\n"
    head = ["WARC/1.0", "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(SPACE, 'warcinfo ' + first)}>",
            f"WARC-Date: {_stamp(date)}", f"WARC-Block-Digest: {_sha32(block)}",
            "Content-Type: application/warc-fields", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + block


def convert(spark: SparkSession, arc_path: str, warc_path: str, rules: ArcRules) -> None:
    """ARC files to WARC files, file by task; equal payloads become revisits."""
    ship_by_value(__name__)
    narrow = read_arc(spark, arc_path, payloads=False).filter(F.col("message") & (F.col("bytes") >= rules.min_bytes))
    named = F.when(F.col("key").isNotNull(), F.struct(F.col("key").cast("long").alias("key"), "url", "date"))
    keeper = (narrow.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max(named).alias("response"))
              .filter("n > 1 AND response.key IS NOT NULL").select("digest", "response"))
    few = keeper.limit(BROADCAST_DIGESTS + 1).count() <= BROADCAST_DIGESTS
    rows = read_arc(spark, arc_path).join(F.broadcast(keeper) if few else keeper, "digest", "left")
    own = ~F.col("message") | F.col("response").isNull() | F.col("response.key").eqNullSafe(F.col("key").cast("long"))
    rows = rows.select("key", "url", "date", "http", "payload", "digest",
                       F.when(~own, F.col("response")).alias("response"), "ip", "mime")

    def run(batches):
        fresh = True
        for batch in batches:
            out = []
            for key, url, date, http, payload, digest, response, ip, mime in zip(
                    *(batch.column(i).to_pylist() for i in range(9))):
                if fresh:
                    out.append(info_record(record_id(key, url, date, digest), date))
                    fresh = False
                of = (response["key"], response["url"], response["date"]) if response else None
                out.append(warc_record(key, url, date, http, payload, digest, of, ip, mime))
            yield pa.RecordBatch.from_arrays([pa.array([r.decode("utf-8", "surrogateescape") for r in out], pa.string())],
                                             ["value"])

    (rows.mapInArrow(run, "value string").write.option("compression", "gzip")
     .option("lineSep", "\r\n\r\n").text(warc_path))


def warc_records(data: bytes):
    """(fields, block) of each record of a WARC file, by declared lengths."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        if end < 0 or not data.startswith(b"WARC/", at):
            raise ValueError("not a WARC record")
        fields = dict(x.split(": ", 1) for x in data[at:end].decode("utf-8").split("\r\n")[1:])
        size = int(fields["Content-Length"])
        block = data[end + 4:end + 4 + size]
        if len(block) < size:
            raise ValueError("WARC record is cut off")
        yield fields, block
        at = end + 4 + size + 4


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Per record: key, record_type, payload_bytes, payload_digest, refers_to
    (key), record_id, target. Digests of blocks and payloads are checked."""
    ship_by_value(__name__)
    names = ["key", "record_type", "payload_bytes", "payload_digest", "refers_to", "record_id", "target"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for f, block in warc_records(_inflate(content.as_py())):
                    if f["WARC-Block-Digest"] != _sha32(block):
                        raise ValueError(f"block digest of {f['WARC-Record-ID']}")
                    if f["WARC-Type"] == "warcinfo":
                        continue
                    http, _, payload = _http(block)
                    digest = base64.b32decode(f["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    size = int(http["Content-Length"]) if "Content-Length" in http else len(payload)
                    if f["WARC-Type"] != "revisit":
                        size = len(payload)
                        if hashlib.sha1(payload).hexdigest() != digest:
                            raise ValueError(f"payload digest of {f['WARC-Record-ID']}")
                    rows.append((f.get(KEY), f["WARC-Type"], size, digest, f.get(REFERS_KEY), f["WARC-Record-ID"],
                                 f["WARC-Target-URI"]))
                cols = list(zip(*rows)) if rows else [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)

    return _files(spark, path).mapInArrow(run, "key string, record_type string, payload_bytes long, "
                                               "payload_digest string, refers_to string, record_id string, target string")
