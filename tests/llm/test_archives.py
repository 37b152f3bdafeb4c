import hashlib
import io
import zipfile

import pytest

from retention_engine.llm import archives


def reader(data):
    return archives.Package(lambda at, n: data[at:at + n], len(data))


def test_package_is_a_zip_file():
    data = archives.package([(b"a/b.txt", b"hello"), (b"c", b"")])
    z = zipfile.ZipFile(io.BytesIO(data))
    assert z.testzip() is None and z.read("a/b.txt") == b"hello" and z.namelist() == ["a/b.txt", "c"]


@pytest.mark.parametrize("wide", [False, True])
def test_reads_packages_of_other_writers(wide):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_STORED) as z:
        z.comment = b"a comment PK\x05\x06 that looks like an end record"
        with z.open("x.warc", "w", force_zip64=wide) as f:
            f.write(b"0123456789")
        z.writestr("packed", b"q" * 100, zipfile.ZIP_DEFLATED)
    p = reader(buf.getvalue())
    at, n = p.span("x.warc")
    assert buf.getvalue()[at:at + n] == b"0123456789"
    with pytest.raises(ValueError):
        p.span("packed")
    with pytest.raises(ValueError):
        reader(b"no archive")


PAGES = [(5, "http://a/\r\nX: y", "p" * 120), (3, None, "p" * 120), (9, "u", "p" * 120), (1, "u", "short"), (2, "u", "short"),
         (4, "u", None), (6, "u", "ü" * 50), (7, "u", "ü" * 50), (8, "u", "a\r\n\r\nb" * 30), (None, "u", "n" * 200),
         (8, "u", "a\r\n\r\nb" * 30), (10, "u", "v" * 99), (11, "u", "v" * 99), (12, "u", "big" * 5000)]


def test_round_trip_against_brute_force(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(archives, "PACKAGE_BYTES", 500)
    df = spark.createDataFrame([(*p, "clash", 1) for p in PAGES], "page_id long, url string, html string, digest string, n int")
    path = str(tmp_path / "w")
    archives.write(archives.plan_records(df), path, package_bytes=500)
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload)
                  for r in archives.read(spark, path).collect()), key=str)
    want, first = [], {}
    for i, _, t in PAGES:
        b = (t or "").encode()
        if len(b) >= 100 and i is not None:
            first[b] = min(i, first.get(b, i))
    for i, _, t in PAGES:
        b = (t or "").encode()
        again = b in first and first[b] != i
        want.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response",
                     first[b] if again else None, None if again else bytearray(b)))
    assert got == sorted(want, key=str)


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert archives.write_and_read(df).count() == 0
