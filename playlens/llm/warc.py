"""WARC archives: monolithic gzip files made into files of one gzip member per record.

``write`` puts records into archives that are each one gzip stream, as many crawlers leave
them; such a file can only be read from its start. ``normalise`` inflates each of these files
once, from start to end, writes every record as a gzip member of its own, and beside the new
archive a sidecar index, a line per record with its offset and length. ``read`` uses the
index: any record, or any range of them, is read without what stands before it.

Records follow WARC/1.1. A payload is the body of an HTTP response. Of rows with equal payloads
(by SHA-256) one is written as ``response``; the others are ``revisit`` records of the profile
identical-payload-digest, whose block is the HTTP head only, with ``WARC-Refers-To`` naming the
response. Digests are the SHA-1 of the payload in base32; reading checks that of a response
against its payload, and the lengths of both kinds.

Files are streamed in and out in chunks. An archive ends after ``FILE_BYTES`` of payload. Every
attempt of a task writes to names of its own, and only those of the attempt that Spark
commits are listed in the tables that ``write`` and ``normalise`` return; what a lost executor
left is never read. Folders must be reachable by all executors and by Arrow's file systems.

Defined results: a null payload is empty; empty payloads are equal. Rows with equal payloads
refer to the one with the smallest id, null last, and among equal ids to one of them.
Repeated rows give a record each. A null id is written as an empty one and read back as
null. A null address is left out; control characters and spaces in one are percent-encoded.
Other columns are ignored; an empty table gives no archives and no rows.
"""

import gzip
import hashlib
import io
import json
import re
import zlib
from base64 import b32encode
from urllib.parse import quote
from uuid import uuid4

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import functions as F

from playlens.llm.common import met, numbered, placed, stored, text_blocks
from playlens.session import temporary_dir, work_dir

FILE_BYTES, BLOCK_BYTES, CHUNK = 32 << 20, 4 << 20, 1 << 20
#: Records read by one call of the reader; a larger archive is read by several.
RANGE = 20_000
LEVEL = 6
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "urn:page:"


# ---- which record holds a payload ------------------------------------------------------------

def planned(pages, key="page_id", payload="html", address="url", least_bytes=0):
    """row, page_id, url, payload, refers_to_row, refers_to: a record per row of ``pages``.

    ``refers_to_row`` is null for a response. Payloads below ``least_bytes`` are never
    compared."""
    pages = placed(pages)
    marked, place = numbered(pages)
    body = F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary"))
    rows = marked.select(F.col(place).alias("row"), F.col(key).cast("long").alias("page_id"),
                         F.col(address).cast("string").alias("url"), body.alias("payload"))
    names = stored(rows.filter(F.octet_length("payload") >= least_bytes).select(
        "row", "page_id", F.unhex(F.sha2("payload", 256)).alias("digest")), "warc_payloads")
    groups = stored(names.groupBy("digest").agg(
        F.count("*").alias("n"),
        F.min(F.struct(F.col("page_id").isNull().alias("unnamed"), "page_id", "row")).alias("first"),
    ).filter("n > 1"), "warc_groups")
    copies = met(names, groups, "digest", "n")
    revisits = copies.filter(F.col("row") != F.col("first.row")).select(
        "row", F.col("first.row").alias("refers_to_row"),
        F.col("first.page_id").alias("refers_to"))
    return rows.join(revisits, "row", "left")


# ---- writing -----------------------------------------------------------------------------------

def base32_sha1(payload):
    return b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id, row):
    return f"<{_ID}{'' if page_id is None else page_id}:{row & (1 << 64) - 1:x}>"


def page_of(name):
    page = name[len(_ID) + 1:-1].split(":")[0]
    return int(page) if page else None


def head(fields):
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode()


def record(row, page_id, url, payload, refers_to_row, refers_to):
    """The bytes of one record."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    revisit = refers_to_row is not None
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, row)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", url and quote(url, safe="!#$%&'()*+,/:;=?@[]~")),
        ("WARC-Payload-Digest", "sha1:" + base32_sha1(payload)),
        ("WARC-Profile", PROFILE if revisit else None),
        ("WARC-Refers-To", record_id(refers_to, refers_to_row) if revisit else None),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", len(http) + (0 if revisit else len(payload)))]
    return b"".join([head(fields), http, b"" if revisit else payload, b"\r\n\r\n"])


def about():
    """The record that begins an archive."""
    body = b"format: WARC file version 1.1\r\n"
    return head([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<{uuid4().urn}>"),
                 ("WARC-Date", DATE), ("Content-Type", "application/warc-fields"),
                 ("Content-Length", len(body))]) + body + b"\r\n\r\n"


def opened(folder):
    """(file system, path) of a folder."""
    return pyarrow.fs.FileSystem.from_uri(re.sub("^s3a:", "s3:", folder))


_FILES = "archive string, records long"


def _written(folder):
    def write(batches):
        files, path = opened(folder)
        out = None

        def closed():
            out.write(squeeze.flush())
            out.close()
            return pa.RecordBatch.from_pydict({"archive": [name], "records": [records]})

        for block, payloads in text_blocks(batches, BLOCK_BYTES, "payload"):
            rest = [block.column(c).to_pylist()
                    for c in ("row", "page_id", "url", "refers_to_row", "refers_to")]
            for row, page_id, url, refers_to_row, refers_to, payload in zip(*rest, payloads):
                if out is None:
                    name, records, held = f"{uuid4().hex}.warc.gz", 0, 0
                    out = files.open_output_stream(f"{path}/{name}", compression=None)
                    squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                    out.write(squeeze.compress(about()))
                out.write(squeeze.compress(
                    record(row, page_id, url, payload, refers_to_row, refers_to)))
                records, held = records + 1, held + len(payload)
                if held >= FILE_BYTES:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()
    return write


def made(folder):
    files, path = opened(folder)
    files.create_dir(path, recursive=True)
    return folder


def write(records, folder):
    """Writes ``records`` (see ``planned``) as archives of one gzip stream each, into ``folder``.

    Returns the archives: archive (name in the folder), records."""
    made(folder)
    return stored(records.select("row", "page_id", "url", "refers_to_row", "refers_to", "payload")
                  .mapInArrow(_written(folder), _FILES), "warc_files")


# ---- one member per record -----------------------------------------------------------------------

def header(stream):
    """The fields of the next record, by lower-case name, and its head's bytes; None at the end."""
    line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/1."):
        raise ValueError(f"no record here: {line[:40]!r}")
    lines = [line]
    while lines[-1] not in (b"\r\n", b"\n"):
        lines.append(stream.readline())
        if not lines[-1]:
            raise ValueError("an archive ends inside a record's head")
    fields = (x.decode().partition(":") for x in lines[1:-1])
    return {name.strip().lower(): value.strip() for name, _, value in fields}, b"".join(lines)


def normalise_stream(source, target):
    """Rewrites the records of ``source``, gzip in any members, as members of ``target``.

    Yields an index line (dict) per record."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=source), CHUNK)
    offset = 0
    while found := header(stream):
        fields, top = found
        squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        length = target.write(squeeze.compress(top))
        left = int(fields["content-length"]) + 4  # the block and the two line ends after it
        while left:
            part = stream.read(min(left, CHUNK))
            if not part:
                raise ValueError("an archive ends inside a record")
            left -= len(part)
            length += target.write(squeeze.compress(part))
        if not part.endswith(b"\r\n\r\n"[-len(part):]):
            raise ValueError("a record does not end where its length says")
        length += target.write(squeeze.flush())
        yield {"offset": offset, "length": length, "type": fields.get("warc-type"),
               "id": fields.get("warc-record-id"), "uri": fields.get("warc-target-uri")}
        offset += length


_NORMAL = "archive string, sidecar string, records long, bytes long"


def _normalised(source, target):
    def normalise(batches):
        old, old_path = opened(source)
        new, new_path = opened(target)
        for batch in batches:
            for name in batch.column("archive").to_pylist():
                stem = uuid4().hex
                archive, sidecar = f"{stem}.warc.gz", f"{stem}.warc.gz.idx"
                records = size = 0
                with old.open_input_stream(f"{old_path}/{name}", compression=None) as raw, \
                        new.open_output_stream(f"{new_path}/{archive}", compression=None) as out, \
                        new.open_output_stream(f"{new_path}/{sidecar}", compression=None) as index:
                    for line in normalise_stream(raw, out):
                        index.write(json.dumps(line).encode() + b"\n")
                        records, size = records + 1, line["offset"] + line["length"]
                yield pa.RecordBatch.from_pydict({
                    "archive": [archive], "sidecar": [sidecar], "records": [records],
                    "bytes": [size]})
    return normalise


def normalise(archives, source, target):
    """Rewrites ``archives`` (archive: names in ``source``) into ``target``, a task per few files.

    Returns archive, sidecar, records (with each archive's own) and bytes per new file."""
    made(target)
    return stored(archives.select("archive").repartitionByRange(
        max(1, archives.count()), "archive").mapInArrow(_normalised(source, target), _NORMAL),
        "warc_normalised")


# ---- reading -------------------------------------------------------------------------------------

def member(file, offset, length):
    """(fields, block) of the record at ``offset`` of an open archive."""
    raw = file.read_at(length, offset)
    stream = io.BytesIO(gzip.decompress(raw))
    fields, _ = header(stream)
    return fields, stream.read(int(fields["content-length"]))


def _checked(fields, block):
    """(payload or None, its length) of a record, after checks."""
    http, _, payload = block.partition(b"\r\n\r\n")
    said = re.search(rb"\r\nContent-Length: (\d+)", http)
    size, revisit = int(said[1]), fields["warc-type"] == "revisit"
    if not revisit and (size != len(payload)
                        or fields["warc-payload-digest"] != "sha1:" + base32_sha1(payload)):
        raise ValueError(f"payload of {fields['warc-record-id']} is not what its head says")
    return None if revisit else payload, size


_READ = ("page_id long, url string, payload_bytes long, payload_digest string, "
         "record_type string, refers_to long, payload binary")
_READ_SCHEMA = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("payload", pa.binary())])


def _read(folder, payloads):
    def read(batches):
        files, path = opened(folder)
        for batch in batches:
            for part in batch.to_pylist():  # a few names a row
                with files.open_input_stream(f"{path}/{part['sidecar']}", compression=None) as f:
                    lines = f.read().splitlines()[part["first"]:part["first"] + RANGE]
                with files.open_input_file(f"{path}/{part['archive']}") as archive:
                    rows, held = [], 0
                    for line in map(json.loads, lines):
                        if line["type"] not in ("response", "revisit"):
                            continue
                        fields, block = member(archive, line["offset"], line["length"])
                        payload, size = _checked(fields, block)
                        refers_to = fields.get("warc-refers-to")
                        rows.append((
                            page_of(fields["warc-record-id"]), fields.get("warc-target-uri"), size,
                            fields["warc-payload-digest"].removeprefix("sha1:"), line["type"],
                            refers_to and page_of(refers_to), payload if payloads else None))
                        held += len(payload or b"") if payloads else 64
                        if held > BLOCK_BYTES:
                            yield _batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows)
    return read


def _batch(rows):
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), _READ_SCHEMA.types)], schema=_READ_SCHEMA)


def read(files, folder, payloads=True):
    """The records of normalised archives in ``folder``, by their sidecars.

    page_id, url, payload_bytes, payload_digest, record_type, refers_to (the page of the record
    that holds a revisit's payload) and payload (null for revisits, and without ``payloads``)."""
    ranges = files.select("archive", "sidecar", F.explode(F.sequence(
        F.lit(0).cast("long"), F.greatest(F.col("records") - 1, F.lit(0)), F.lit(RANGE).cast("long"))).alias("first"))
    n = files.agg(F.sum(F.ceil(F.col("records") / RANGE))).first()[0] or 1
    return ranges.repartitionByRange(int(n), "archive", "first").mapInArrow(
        _read(folder, payloads), _READ)


def digests(pages):
    """page_id, payload_bytes, payload_digest, record_type, refers_to of each page, read back
    from archives that were written and normalised."""
    spark = pages.sparkSession
    normal = work_dir(spark, "warc_normal")
    with temporary_dir(spark, "warc") as monolithic:
        files = normalise(write(planned(pages), monolithic), monolithic, normal)
    return read(files, normal, payloads=False).drop("url", "payload")
