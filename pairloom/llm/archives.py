"""ARC to WARC: version-specific ARC headers and declared lengths in, WARC records out.

Archives are written by Spark's text writer and read as binary files, so every path that Spark knows will do. Within a
file, records are read one by one from the compressed bytes. A file holds what one task wrote.

What comes from an archive stays bytes: payloads of any kind, heads as Latin-1. In a WARC file every record is a gzip member of its own,
so that other tools can seek; its last byte, 0 for members of less than 16 MB, is what the text writer puts after each row.

A malformed archive is an error that names what is wrong: a file without its version block, a header line with other fields than its
version has, a declared length that the file does not reach, a record that does not begin as one. An empty folder
gives no records.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from datetime import datetime
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pairloom.llm.blocks import column_bytes
from pairloom.llm.ship import prepare, tidy
from pairloom.session import stage

#: Fields of a record's header line by ARC version; the declared length is the last. (Fixed by the format.)
FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
        "Filename", "Archive-length"],
}
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URL_KEPT = "/:?#[]@!$&'()*+,;=%~"
#: Payloads of fewer bytes are never revisits.
LEAST_BYTES = 100
#: Revisits whose targets are sent to every task, some 200 bytes each at most.
MOST_DECISIONS = 200_000


def arc_opening(version: int, name: str, date: str) -> bytes:
    """The version block with which every ARC file begins."""
    body = f"{version} 0 converted\n{' '.join(FIELDS[version])}\n".encode()
    middle = "text/plain" if version == 1 else f"text/plain 200 - - 0 {name}"
    return f"filedesc://{name} 0.0.0.0 {date} {middle} {len(body)}\n".encode() + body


def write_arc(pages: DataFrame, path: str, version: int | None = None, date: str = "20240101000000",
              id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Gzipped ARC files of HTTP responses, one per partition; without ``version`` both versions alternate.

    The page id travels in the response's header X-Page-Id. Null html is an empty payload, a null url "-"
    (blanks and other unsafe characters are percent-encoded), a null id has no header; repeated rows are
    records of their own; an empty partition holds its version block alone; other columns are ignored.
    """
    prepare(pages.sparkSession)
    rows = pages.select(F.col(id_col).cast("string"), F.col(url_col).cast("string"), F.col(html_col).cast("string"))

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        kind = version or 1 + number % 2
        name = f"pages-{number:06d}.arc"
        yield pa.RecordBatch.from_arrays([pa.array([arc_opening(kind, name, date)], pa.string())], names=["value"])
        for batch in batches:
            data, offsets = column_bytes(batch.column(2))
            body, edges, out = data.tobytes(), offsets.tolist(), []
            for page, url, a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), edges, edges[1:]):
                head = f"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {b - a}\r\n"
                head += f"X-Page-Id: {page}\r\n\r\n" if page is not None else "\r\n"
                length = len(head) + b - a
                address = quote(url, safe=URL_KEPT) if url else "-"
                middle = "text/html" if kind == 1 else f"text/html 200 - - 0 {name}"
                out.append(f"{address} 0.0.0.0 {date} {middle} {length}\n{head}".encode() + body[a:b])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])

    rows.mapInArrow(tidy(records), "value string").write.option("lineSep", "\n").option("compression", "gzip").text(path)


def _exactly(file, size: int) -> bytes:
    data = file.read(size)
    if len(data) != size:
        raise ValueError(f"the archive ends {size - len(data)} bytes before a declared length")
    return data


def _opened(content: bytes) -> io.BufferedIOBase:
    """The bytes of a file, of one or many gzip members or not compressed."""
    raw = io.BytesIO(content)
    return gzip.GzipFile(fileobj=raw) if raw.getbuffer()[:2] == b"\x1f\x8b" else raw


def arc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields and archive name, network document) of the records of an ARC file.

    Every file opens with its version block, which fixes the fields of the header lines after it.
    """
    fields, name = None, ""
    with _opened(content) as file:
        while line := file.readline():
            if not line.strip(b"\r\n"):
                continue
            parts = line.decode("latin-1").rstrip("\r\n").split(" ")
            if not parts[-1].isdigit():
                raise ValueError(f"a record header without a length: {line[:200]!r}")
            body = _exactly(file, int(parts[-1]))
            if parts[0].startswith("filedesc://"):
                fields, name = FIELDS[int(body.split(b" ", 1)[0])], parts[0].removeprefix("filedesc://")
                continue
            if fields is None or len(parts) != len(fields):
                raise ValueError(f"not a record header of this version: {line[:200]!r}")
            yield dict(zip(fields, parts)) | {"archive": name}, body


def split_http(document: bytes) -> tuple[bytes, bytes, dict[str, str]]:
    """Head with its blank line, payload, and header values by lower-case name; a document of another protocol is all payload."""
    if not document.startswith(b"HTTP/"):
        return b"", document, {}
    found = re.search(rb"\r?\n\r?\n", document)
    end = found.end() if found else len(document)
    values = (line.partition(":") for line in document[:end].decode("latin-1").splitlines()[1:])
    return document[:end], document[end:], {k.strip().lower(): v.strip() for k, _, v in values}


def warc_record(kind: str, fields: dict[str, str], block: bytes) -> bytes:
    """One record without the two line ends that close it."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}"] + [f"{k}: {v}" for k, v in fields.items()] + [f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("latin-1", "replace") + b"\r\n\r\n" + block


def gzip_members(record: bytes, most: int = 15 << 20) -> bytes:
    """A record with the line ends that close it, compressed, without the last byte, which is 0.

    A gzip member ends with the four bytes of its length, the highest last; a record of 16 MB and more takes several members.
    """
    whole = record + b"\r\n\r\n"
    made = b"".join([gzip.compress(whole[i:i + most], 6, mtime=0) for i in range(0, len(whole), most)])
    return made[:-1]


def record_id(*parts: str) -> str:
    """The same identifier for the same record in every run."""
    digest = hashlib.sha256("\n".join(parts).encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=digest[:16], version=5)}>"


def convert(spark: SparkSession, arc_path: str, warc_path: str) -> None:
    """Turn each ARC file into WARC records: identifier, timestamp, type and digests are made from its fields.

    Each file begins with a warcinfo record. Of HTTP records with equal payloads of at least ``LEAST_BYTES`` bytes, that with the smallest page id is a
    response and all with other page ids revisit it (with a null id too, unless no record has one). A
    revisit keeps the HTTP head, length and digest of its payload, and names the response: its record id, address and time. Records of
    other protocols become resources. What is shuffled is one row per file
    and digest, so a payload that fills a third of all files meets once per file. The decisions come to the files, not
    the other way round, as long as there are ``MOST_DECISIONS`` at most; only beyond that files move by their names.
    """
    prepare(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "[!._]*").load(arc_path).select("path", "content")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                seen: dict[bytes, list] = {}
                for at, (fields, document) in enumerate(arc_records(content.as_buffer())):
                    head, payload, values = split_http(document)
                    if head and len(payload) >= LEAST_BYTES:
                        page = _page(values)
                        names = _names(fields, hashlib.sha256(payload).hexdigest(), at)
                        seen.setdefault(hashlib.sha256(payload).digest(), []).append((at, page, names))
                least = [min(((p, *n) for _, p, n in r if p is not None), default=None) for r in seen.values()]
                yield pa.RecordBatch.from_arrays([
                    pa.array([path] * len(seen), pa.string()), pa.array(seen, pa.binary()),
                    pa.array([x and dict(zip(("page", "id", "uri", "date"), x)) for x in least], first_kind),
                    pa.array([[{"at": a, "page": p} for a, p, _ in r] for r in seen.values()],
                             pa.list_(pa.struct([("at", pa.int64()), ("page", pa.int64())]))),
                ], names=["path", "digest", "least", "records"])

    first_kind = pa.struct([("page", pa.int64()), ("id", pa.string()), ("uri", pa.string()), ("date", pa.string())])
    found = files.mapInArrow(tidy(digests), "path string, digest binary, least struct<page:long,id:string,uri:string,date:string>, "
                                            "records array<struct<at:long,page:long>>")
    firsts = found.groupBy("digest").agg(F.min("least").alias("first")).filter("first IS NOT NULL")   # null is skipped
    decided = found.select("path", "digest", "records").join(firsts, "digest").select(
        "path", "first", F.filter("records", lambda r: ~r["page"].eqNullSafe(F.col("first.page"))).alias("records")).filter(F.size("records") > 0)
    revisits = stage(decided.groupBy("path").agg(F.collect_list(F.struct("first", F.col("records.at").alias("at"))).alias("revisits")), "revisits")
    total = revisits.agg(F.sum(F.expr("aggregate(revisits, 0L, (n, r) -> n + size(r.at))"))).first()[0] or 0
    if total <= MOST_DECISIONS:
        revisits = F.broadcast(revisits)

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, decided in zip(batch.column(0), batch.column(1).to_pylist()):
                target = {at: d["first"] for d in decided or () for at in d["at"]}
                out, size = [], 0
                for at, (fields, document) in enumerate(arc_records(content.as_buffer())):
                    if at == 0:
                        out.append(gzip_members(_opening(fields)))
                    out.append(gzip_members(_converted(fields, document, at, target.get(at))))
                    size += len(out[-1])
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])
                        out, size = [], 0
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    made = files.join(revisits, "path", "left").select("content", "revisits").mapInArrow(tidy(records), "value binary")
    # The cast to text keeps bytes as they are, and so does the text writer.
    made.select(F.col("value").cast("string")).write.option("lineSep", "\0").option("compression", "none").text(warc_path)


def _page(values: dict[str, str]) -> int | None:
    """The page id that ``write_arc`` puts into a response's head; archives from elsewhere have none."""
    found = values.get("x-page-id", "")
    return int(found) if re.fullmatch(r"-?\d+", found) else None


def _names(fields: dict[str, str], digest: str, at: int) -> tuple[str, str, str]:
    """Record id, address and time of a record; a date of 12 digits has no seconds."""
    moment = datetime.strptime(fields["Archive-date"].ljust(14, "0"), "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
    return record_id(fields["URL"], moment, digest, fields["archive"], str(at)), fields["URL"], moment


def _opening(fields: dict[str, str]) -> bytes:
    """The record that describes the file."""
    ident, _, moment = _names(fields, "warcinfo", 0)
    block = f"software: pairloom\r\nformat: WARC File Format 1.1\r\nisPartOf: {fields['archive']}\r\n".encode("latin-1", "replace")
    return warc_record("warcinfo", {"WARC-Record-ID": ident, "WARC-Date": moment, "Content-Type": "application/warc-fields"}, block)


def _converted(fields: dict[str, str], document: bytes, at: int, revisited: dict | None) -> bytes:
    head, payload, _ = split_http(document)
    digest = hashlib.sha256(payload).hexdigest()
    ident, uri, moment = _names(fields, digest, at)
    out = {"WARC-Record-ID": ident, "WARC-Date": moment}
    if uri != "-":
        out["WARC-Target-URI"] = uri
    if fields["IP-address"] not in ("-", "0.0.0.0"):
        out["WARC-IP-Address"] = fields["IP-address"]
    out["WARC-Payload-Digest"] = f"sha256:{digest}"
    if not head:
        out["Content-Type"] = fields["Content-type"]
        return warc_record("resource", out | {"WARC-Block-Digest": f"sha256:{digest}"}, document)
    out["Content-Type"] = "application/http;msgtype=response"
    if revisited is None:
        out["WARC-Block-Digest"] = f"sha256:{hashlib.sha256(document).hexdigest()}"
        return warc_record("response", out, document)
    out |= {"WARC-Profile": REVISIT, "WARC-Refers-To": revisited["id"], "WARC-Refers-To-Date": revisited["date"]}
    if revisited["uri"] != "-":
        out["WARC-Refers-To-Target-URI"] = revisited["uri"]
    out |= {"X-Refers-To-Page-Id": str(revisited["page"]), "X-Payload-Length": str(len(payload))}
    return warc_record("revisit", out, head)


def warc_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of the records of a WARC file, by declared lengths."""
    with _opened(content) as file:
        while line := file.readline():
            if line == b"\r\n":
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"not the start of a record: {line[:200]!r}")
            fields: dict[str, str] = {}
            while (line := file.readline()) not in (b"\r\n", b""):
                name, _, value = line.decode("latin-1").partition(":")
                fields[name.strip()] = value.strip()
            yield fields, _exactly(file, int(fields["Content-Length"]))


def read_warc(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """(record_id, record_type, target_uri, date, page_id, payload_bytes, payload_digest, refers_to[, payload]).

    Size and digest of a response or resource are taken from the payload that was read, those of a revisit from its headers, null where
    it has none. A digest that differs from the stored one is an error. Records about the file are left out.
    """
    prepare(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "[!._]*").load(path).select("content")
    schema = T.StructType([
        T.StructField("record_id", T.StringType()), T.StructField("record_type", T.StringType()),
        T.StructField("target_uri", T.StringType()), T.StructField("date", T.StringType()),
        T.StructField("page_id", T.LongType()), T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload_digest", T.StringType()), T.StructField("refers_to", T.LongType()),
    ])
    if payloads:
        schema.add("payload", T.BinaryType())
    kinds = [pa.string()] * 4 + [pa.int64()] * 2 + [pa.string(), pa.int64(), pa.binary()]
    number = lambda x: None if x is None else int(x)

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [[]] * len(schema)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=schema.names)

        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for fields, block in warc_records(content.as_buffer()):
                    if fields["WARC-Type"] not in ("response", "revisit", "resource"):
                        continue
                    _, payload, values = split_http(block)
                    stored = fields.get("WARC-Payload-Digest", "").removeprefix("sha256:") or None
                    digest, length = stored, number(fields.get("X-Payload-Length"))
                    if fields["WARC-Type"] != "revisit":
                        digest, length = hashlib.sha256(payload).hexdigest(), len(payload)
                        if stored is not None and digest != stored:
                            raise ValueError(f"{fields['WARC-Record-ID']}: the payload has another digest")
                    row = (fields["WARC-Record-ID"], fields["WARC-Type"], fields.get("WARC-Target-URI"), fields["WARC-Date"],
                           _page(values), length, digest, number(fields.get("X-Refers-To-Page-Id")))
                    rows.append((*row, payload) if payloads else row)
                    size += len(block) * payloads
                    if len(rows) >= 10_000 or size > 4 << 20:
                        yield flush(rows)
                        rows, size = [], 0
                yield flush(rows)

    return files.mapInArrow(tidy(parsed), schema)
