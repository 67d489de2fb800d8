"""Archives are written and read back whole."""

import base64
import gzip
import hashlib
import io

import pytest

from newsatlas.llm import warc


def sha1(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def expected(pages, least=0):
    first = {}
    for page_id, html in pages:
        data = (html or "").encode()
        if page_id is not None and len(data) >= least:
            first[data] = min(page_id, first.get(data, page_id))
    out = []
    for page_id, html in pages:
        data = (html or "").encode()
        head = first.get(data) if page_id is not None and len(data) >= least else None
        again = head is not None and head != page_id
        out.append((page_id, len(data), sha1(data), "revisit" if again else "response", head if again else None))
    return sorted(out, key=repr)


def test_whole_table(result, duck):
    pages = duck.execute("SELECT page_id, html FROM pages").fetchall()
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[n] for n in names) for r in result("op6_warc")), key=repr) == expected(pages)


@pytest.mark.parametrize("least", [0, 5])
def test_edges(spark, tmp_path, least):
    pages = [
        (1, "http://a", "same page"), (2, None, "same page"), (3, "u\r\nX: y", None), (4, "u", ""), (-5, "u", "same page"), (6, "u", "ab"),
        (7, "u", "ab"), (8, "u", "é" * 700_000), (9, "u", "a\r\n\r\nb\r\n"), (9, "u", "a\r\n\r\nb\r\n"), (None, "u", "same page"), (None, "u", "x"),
    ]
    frame = spark.createDataFrame([(*p, "html") for p in pages], "page_id long, url string, html string, archive string")
    archives = warc.write_archives(frame.repartition(3), f"file://{tmp_path}/out", least, archive_bytes=2_000)
    rows = warc.read_archives(archives).collect()
    found = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows]
    assert sorted(found, key=repr) == expected([(p, h) for p, _, h in pages], least)
    for r in rows:
        assert (r["payload"] is None) == (r["record_type"] == "revisit")
    for path in (tmp_path / "out").iterdir():
        assert gzip.open(path).read().startswith(b"WARC/1.1\r\n")


def test_empty_table(spark, tmp_path):
    frame = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(frame, str(tmp_path / "none"))).collect() == []


def test_damage_is_found():
    good = warc.record_member("response", "urn:page:1", "u", b"payload")
    assert [p for _, _, p in warc.records(io.BytesIO(good * 3))] == [b"payload"] * 3
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(good + good[: len(good) // 2])))
    text = gzip.decompress(good)
    for bad in (text.replace(b"payload", b"Payload"), text.replace(b"WARC/1.1", b"WARC/0.9"), text[:-1], text + b"x"):
        with pytest.raises(ValueError):
            list(warc.records(io.BytesIO(gzip.compress(bad))))


def test_small_reads():
    class Slow(io.BytesIO):
        def read(self, n=-1):
            return super().read(1)

    data = b"".join(warc.record_member("response", f"urn:page:{i}", "u", b"x" * i) for i in range(4))
    assert [len(p) for _, _, p in warc.records(Slow(data))] == [0, 1, 2, 3]
