"""WARC archives with an index of every record.

Writing comes first with the index: for each record its file, offset, length,
URL and digest. Reading takes the selected rows of the index, sorts them by
file and offset, joins neighbours into byte ranges and reads each range once.
Each record is a gzip member of its own, so that any range can be read alone.
A record whose payload another record has is written as a revisit of it.

Each attempt of a task writes a file of its own name, and the index names
only files of attempts that ended well, so lost executors leave nothing in the
result. Files go through the file system of the shared folder's address.

Defined results: null html is an empty payload; rows with the page_id of the
response and its payload are responses too; a null page_id is never referred
to unless no row with that payload has one; null URLs are written as empty
ones; extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stepledger.llm._shared import keep_track, materialise, open_folder, scratch, slices

#: Payloads below this size are never revisits.
MIN_BYTES = 1000
#: Bytes of one archive file, of one byte range and of a gap that a range may span.
FILE_BYTES, RANGE_BYTES, GAP_BYTES = 1 << 30, 8 << 20, 64 << 10
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "file string, offset long, length long, page_id long, url string, digest string, record_type string"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def roles(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """page_id, url, html, digest and, for revisits, refers_to.

    Only digests are grouped. The pages join the digests that several of them
    have; where these are many, a payload that a large part of the pages have
    is a skewed key of a left join, which adaptive execution splits.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), html.alias("html"), F.sha1(html.cast("binary")).alias("digest"))
    shared = (
        rows.where(F.octet_length("html") >= min_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
        .where("n > 1 AND keeper IS NOT NULL")
        .select(F.col("digest").alias("shared"), "keeper")
    )
    joined = rows.join(shared, rows["digest"] == shared["shared"], "left")
    return joined.select("page_id", "url", "html", "digest", F.when(~F.col("keeper").eqNullSafe(F.col("page_id")), F.col("keeper")).alias("refers_to"))


def record_id(page_id: int | None, digest: str) -> str:
    """The id of a page's response record."""
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{page_id}:{digest}')}>"


def record(page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record as bytes."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>" if revisit else record_id(page_id, digest),
        "WARC-Date": DATE,
        "WARC-Target-URI": " ".join(url.split()),
        "Page-Url": quote(url, safe=""),
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
        "Content-Type": "application/http; msgtype=response",
        "Page-Id": "" if page_id is None else str(page_id),
    }
    if revisit:
        head |= {"WARC-Profile": PROFILE, "WARC-Refers-To": record_id(refers_to, digest), "Refers-To-Page-Id": str(refers_to)}
    head["Content-Length"] = str(len(block))
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes, int]:
    """Headers, payload and the payload's full length of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a record: {lines[0]!r}")
    fields = {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    http, _, payload = rest[: int(fields["content-length"])].partition(b"\r\n\r\n")
    length = next(int(v) for k, _, v in (line.partition(b":") for line in http.split(b"\r\n")) if k.lower() == b"content-length")
    return fields, payload, length


def write(marked: DataFrame, folder: str) -> DataFrame:
    """Write what roles() gives to archives in the folder; the index of all records, itself written."""

    def run(batches):
        system, base = open_folder(folder)
        out = name = None
        at = 0
        try:
            for batch in slices(batches):
                rows = []
                for page_id, url, html, digest, refers_to in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        system.create_dir(base, recursive=True)
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = system.open_output_stream(f"{base}/{name}", compression=None)
                    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                    raw = packer.compress(record(page_id, url, html.encode(), digest, refers_to)) + packer.flush()
                    out.write(raw)
                    rows.append((name, at, len(raw), page_id, url, digest, "response" if refers_to is None else "revisit"))
                    at += len(raw)
                if rows:
                    types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=[x.split()[0] for x in INDEX.split(", ")])
        finally:
            if out is not None:
                out.close()

    return materialise(marked.mapInArrow(run, INDEX), "warc-index")


def ranges(entries, gap: int = GAP_BYTES, most: int = RANGE_BYTES):
    """Join (file, offset, length) entries, sorted, into lists that one read covers."""
    held: list = []
    for entry in entries:
        name, offset, length = entry[:3]
        if held and (held[-1][0] != name or offset - (held[-1][1] + held[-1][2]) > gap or offset + length - held[0][1] > most):
            yield held
            held = []
        held.append(entry)
    if held:
        yield held


def read(index: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """The records of index rows; with their payloads (empty for revisits) if wanted.

    A response's digest and length are those of the payload that was read; a
    digest that differs from the record's own raises an error.
    """
    schema = RECORDS + (", payload binary" if payloads else "")

    def take(found):
        rows = []
        for fields, payload, length in found:
            digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
            kind = fields["warc-type"]
            if kind == "response":
                length = len(payload)
                if hashlib.sha1(payload).hexdigest() != digest:
                    raise ValueError(f"record {fields['warc-record-id']} has another digest")
            page_id, refers = fields["page-id"], fields.get("refers-to-page-id")
            rows.append((int(page_id) if page_id else None, unquote(fields["page-url"]), length, digest, kind, int(refers) if refers else None, payload)[: 7 if payloads else 6])
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()][: 7 if payloads else 6]
        names = [x.split()[0] for x in schema.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    def run(batches):
        system, base = open_folder(folder)
        entries = (row for b in batches for row in zip(*[c.to_pylist() for c in b.columns], strict=True))
        name = file = None
        for group in ranges(entries):
            if group[0][0] != name:
                name = group[0][0]
                file = system.open_input_file(f"{base}/{name}")
            start = group[0][1]
            raw = file.read_at(max(e[1] + e[2] for e in group) - start, start)
            yield take(parse(zlib.decompress(raw[o - start : o - start + n], 31)) for _, o, n in group)

    # the rows are small, but each stands for bytes to read: tasks follow these
    tasks = (index.agg(F.sum("length")).first()[0] or 0) // (2 * RANGE_BYTES) + 2
    spread = index.select("file", "offset", "length").repartition(tasks, "file", F.floor(F.col("offset") / RANGE_BYTES))
    return spread.sortWithinPartitions("file", "offset").mapInArrow(run, schema)


def round_trip(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Archive every page and read all records back; a revisit has size and digest of the response that it refers to."""
    folder = scratch(pages.sparkSession, "warc")
    keep_track(pages.sparkSession, folder)
    back = materialise(read(write(roles(pages, min_bytes), folder), folder), "warc-read")
    whole = back.where("record_type = 'response'")
    targets = whole.groupBy(F.col("page_id").alias("target"), F.col("payload_digest").alias("target_digest")).agg(F.max("payload_bytes").alias("target_bytes"))
    again = back.where("record_type = 'revisit'").join(targets, (F.col("refers_to") == F.col("target")) & (F.col("payload_digest") == F.col("target_digest")), "left")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
    return whole.select(names).unionByName(again.select("page_id", F.col("target_bytes").alias("payload_bytes"), F.col("target_digest").alias("payload_digest"), "record_type", "refers_to", "url"))


ORACLE_SQL = f"""
WITH rows AS (
  SELECT page_id, coalesce(url, '') AS url, sha1(coalesce(html, '')) AS digest, CAST(strlen(coalesce(html, '')) AS BIGINT) AS size FROM pages
), shared AS (
  SELECT digest, max(page_id) AS keeper FROM rows WHERE size >= {MIN_BYTES} GROUP BY digest
), marked AS (
  SELECT r.*, CASE WHEN s.keeper IS DISTINCT FROM r.page_id THEN s.keeper END AS refers_to FROM rows r LEFT JOIN shared s ON s.digest = r.digest
)
SELECT page_id, size AS payload_bytes, digest AS payload_digest, CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to, url FROM marked
"""
