import hashlib
import io
import json
import zipfile

import pyarrow as pa
import pytest

from msgstream.llm import registry, warc
from msgstream.llm.common import table
from msgstream.scratch import shared_folder

SF = "/root/testdata/sf0.001"


def expected(pages):
    first, result = {}, []
    for page_id, html in pages:
        data = (html or "").encode()
        if len(data) >= 100 and page_id is not None:
            first[data] = min(first.get(data, page_id), page_id)
    for page_id, html in pages:
        data = (html or "").encode()
        refers = first.get(data) if first.get(data) != page_id else None
        kind = "response" if refers is None else "revisit"
        result.append((page_id, len(data), hashlib.sha256(data).hexdigest(), kind, refers))
    return sorted(result, key=str)


def found(df):
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return sorted((tuple(r) for r in df.select(columns).collect()), key=str)


def test_query(spark):
    pages = [tuple(r) for r in table(spark, SF, "pages").select("page_id", "html").collect()]
    assert found(registry.op9_zip_warc(spark, SF)) == expected(pages)


def test_odd_pages_over_several_packages(spark):
    long = "é" * 50
    pages = [(5, long), (3, long), (3, long), (4, long + "x"), (6, None), (7, ""), (8, ""), (9, "y" * 99), (10, "y" * 99)]
    pages += [(None, long), (11, "z\r\n\r\n" * 200_000), (12, "z\r\n\r\n" * 200_000), (None, "only" * 40), (None, "only" * 40)]
    rows = [(i, f"http://x/{i}\r\nA: b é" if i != 4 else None, h, "extra") for i, h in pages]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, payload string")
    records = warc.archived(df, shared_folder(spark, "test-warc"), package_bytes=2000)
    assert found(records) == expected(pages)
    assert records.select("package").distinct().count() > 1
    by_id = {r.page_id: r for r in records.collect()}
    assert by_id[3].payload.decode() == long and by_id[5].payload is None
    assert by_id[5].url == "http://x/5%0D%0AA:%20b%20é" and by_id[4].url is None


def test_no_pages(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archived(df, shared_folder(spark, "test-warc")).collect() == []


def opened(data):
    return pa.BufferReader(data)


def test_packages_are_read_by_others_and_others_are_read():
    members = {"archive/a.gz": b"abc" * 100, "indexes/i": b"{}", "é": b""}
    data = warc.zip_stored(members)
    with zipfile.ZipFile(io.BytesIO(data)) as other:
        assert {n: other.read(n) for n in other.namelist()} == members
    plain = io.BytesIO()
    with zipfile.ZipFile(plain, "w") as other:
        for name, value in members.items():
            other.writestr(name, value)
        other.comment = b"PK\x05\x06 a comment that looks like an end record"
    for raw in (data, plain.getvalue()):
        file = opened(raw)
        assert {m.name: raw[m.start : m.start + m.size] for m in warc.zip_members(file)} == members


def test_broken_packages_are_errors():
    data = warc.zip_stored({"archive/a": b"abc"})
    for broken in (data[:-1], b"", data[:40]):
        with pytest.raises((ValueError, OSError)):
            warc.zip_members(opened(broken))


def test_a_changed_payload_is_an_error():
    record = warc.warc_record(1, None, b"payload", hashlib.sha256(b"other").hexdigest(), None)
    with pytest.raises(ValueError, match="digest"):
        warc.parse_record(record)


@pytest.mark.parametrize("named", [True, False])
def test_a_package_of_two_archives(spark, tmp_path, named):
    """Each index entry is read from the archive it names; one that names none of two is an error."""
    members, expected = {}, set()
    for k, texts in enumerate((["first page " * 20, "second"], ["third page, which is longer " * 30, "4"])):
        archive, index = b"", ""
        for n, text in enumerate(texts):
            page, data = 10 * k + n, text.encode()
            record = warc.warc_record(page, f"http://x/{page}", data, hashlib.sha256(data).hexdigest(), None)
            name = {"filename": f"part{k}.warc.gz"} if named else {}
            index += json.dumps({"offset": len(archive), "length": len(record)} | name) + "\n"
            archive += record
            expected.add((page, text))
        members |= {f"archive/part{k}.warc.gz": archive, f"indexes/part{k}.cdxj": index.encode()}
    (tmp_path / "two.wacz").write_bytes(warc.zip_stored(members))
    packages = spark.createDataFrame([("two.wacz", 1, 4)], warc.PACKAGES)
    records = warc.read_packages(packages, f"file://{tmp_path}")
    if named:
        assert {(r.page_id, r.payload.decode()) for r in records.collect()} == expected
    else:
        with pytest.raises(Exception, match="not there"):
            records.collect()
