"""ARC and WARC files."""

import gzip
import hashlib
import zlib

import pytest

from pairloom.llm import archives, queries
from tests.llm.tables import SMALL, collected


def by_hand(pages):
    least = {}
    for page, html in pages:
        raw = (html or "").encode()
        if len(raw) >= 100 and page is not None:
            least[raw] = min(least.get(raw, page), page)
    out = []
    for page, html in pages:
        raw = (html or "").encode()
        first = least.get(raw)
        again = first is not None and page != first
        out.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=lambda r: [(x is not None, x) for x in r])


def test_op3_on_the_table(spark):
    pages = [(r.page_id, r.html) for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    assert collected(queries.op3_arc_to_warc(spark, SMALL)) == by_hand(pages)


@pytest.mark.parametrize("version", [1, 2, None])
def test_awkward_pages(spark, tmp_path, version):
    long = "<p>" + "é\r\n\r\nWARC/1.1\r\n" * 30
    rows = [(1, "http://a/ b\n", long), (2, None, long), (2, "http://a", long), (None, "http://n", long), (3, "http://s", "x" * 99),
            (4, "http://s", "x" * 99), (5, "http://e", None), (6, "http://e", ""), (7, "ü", "y" * 100), (8, "ü", "y" * 100), (8, "ü", "y" * 100)]
    pages = spark.createDataFrame([(*r, "z", 1) for r in rows], "page_id long, url string, html string, value string, at int").repartition(3)
    arc, warc = str(tmp_path / "arc"), str(tmp_path / "warc")
    archives.write_arc(pages, arc, version)
    archives.convert(spark, arc, warc)
    back = archives.read_warc(spark, warc, payloads=True)
    made = back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert collected(made) == by_hand([(r[0], r[2]) for r in rows])
    found = back.collect()
    assert len({r.record_id for r in found}) == len(rows) and {r.date for r in found} == {"2024-01-01T00:00:00Z"}
    assert {bytes(r.payload).decode() for r in found if r.record_type == "response"} == {r[2] or "" for r in rows}
    assert {r.target_uri for r in found if r.page_id == 1} == {"http://a/%20b%0A"}


def test_declared_lengths_are_held():
    opening = archives.arc_opening(1, "x.arc", "20240101000000")
    good = opening + b"\nhttp://a 0.0.0.0 20240101000000 text/html 5\nab\ncd\n"
    assert [(f["URL"], b) for f, b in archives.arc_records(gzip.compress(good))] == [("http://a", b"ab\ncd")]
    for bad in (good[:-4], good.replace(b" text/html 5", b" 5"), good[len(opening):]):
        with pytest.raises(ValueError):
            list(archives.arc_records(gzip.compress(bad)))


def test_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    archives.write_arc(pages, str(tmp_path / "a"))
    archives.convert(spark, str(tmp_path / "a"), str(tmp_path / "w"))
    assert archives.read_warc(spark, str(tmp_path / "w")).count() == 0


GIF = b"GIF89a\x01\x00\x01\x00\x80\x00\x00\xff\xfe\x00" * 20


def archive(version, records):
    """A legacy file of (url, type, document); every record a gzip member."""
    out = [archives.arc_opening(version, f"old-{version}.arc", "20010203040506")]
    for url, kind, document in records:
        middle = kind if version == 1 else f"{kind} 200 - - 0 old.arc"
        out.append(f"{url} 10.0.0.1 20010203040506 {middle} {len(document)}\n".encode("latin-1") + document + b"\n")
    return b"".join(map(gzip.compress, out))


def test_legacy_archives(spark, tmp_path):
    page = b"<p>" + b"same " * 40
    records = [
        ("http://a/x.gif", "image/gif", b"HTTP/1.0 200 OK\r\nContent-Type: image/gif\r\n\r\n" + GIF),
        ("dns:a", "text/dns", b"20010203040506\na. 1 IN A 10.0.0.1\n"),
        ("http://\xe9/", "text/html", b"HTTP/1.1 200 Tr\xe8s bien\r\nX-Page-Id: 7\r\n\r\n" + page),
        ("http://b/", "text/html", b"HTTP/1.0 200 OK\nX-Page-Id: 9\n\n" + page),
        ("http://c/", "text/html", b"HTTP/1.0 204 No\r\nX-Page-Id: none\r\n\r\n"), ("http://d/", "text/html", b"HTTP/1.0 500"),
    ]
    (tmp_path / "arc").mkdir()
    for version in (1, 2):
        (tmp_path / "arc" / f"{version}.arc.gz").write_bytes(archive(version, records))
    (tmp_path / "arc" / "3.arc").write_bytes(gzip.decompress(archive(1, records[:2])).replace(b"old-1.arc", b"new-3.arc"))
    archives.convert(spark, str(tmp_path / "arc"), str(tmp_path / "warc"))
    found = archives.read_warc(spark, str(tmp_path / "warc"), payloads=True).collect()
    kinds = sorted(map(str, ((r.target_uri, r.record_type, r.payload_bytes, r.page_id, r.refers_to) for r in found if r.target_uri != "http://a/x.gif")))
    assert kinds == sorted(map(str, [("dns:a", "resource", 34, None, None)] * 3 + [("http://b/", "revisit", len(page), 9, 7)] * 2
                           + [("http://c/", "response", 0, None, None)] * 2 + [("http://d/", "response", 0, None, None)] * 2
                           + [("http://\xe9/", "response", len(page), 7, None)] * 2))
    assert [bytes(r.payload) for r in found if r.target_uri == "http://a/x.gif"] == [GIF] * 3
    assert {r.payload_digest for r in found if r.target_uri == "http://b/"} == {hashlib.sha256(page).hexdigest()}
    by_id = {r.record_id: r for r in found}
    assert len(by_id) == len(found) == 14
    members = 0
    for path in (tmp_path / "warc").glob("part-*"):
        raw = path.read_bytes()
        records_ = list(archives.warc_records(raw))
        assert records_[0][0]["WARC-Type"] == "warcinfo"
        for fields, _ in records_:
            if fields["WARC-Type"] == "revisit":
                target = by_id[fields["WARC-Refers-To"]]
                assert (target.target_uri, target.date) == (fields["WARC-Refers-To-Target-URI"], fields["WARC-Refers-To-Date"])
        while raw:  # every record is a member of its own
            part = zlib.decompressobj(31)
            assert part.decompress(raw).startswith(b"WARC/1.1\r\n")
            raw, members = part.unused_data, members + 1
    assert members == len(found) + 3


def test_large_records_end_with_a_zero():
    for size in (0, 10, (16 << 20) + 5):
        made = archives.gzip_members(b"x" * size) + b"\0"
        assert gzip.decompress(made) == b"x" * size + b"\r\n\r\n"
