import gzip
import hashlib
import random
import zlib

import pytest

from fareflow.llm import arc
from fareflow.llm.common import prepare


def test_versions_lengths_and_urls_with_blanks():
    tricky = b"HTTP/1.1 200 OK\r\n\r\nhttp://x 0.0.0.0 20010101000000 text/html 5\nWARC/1.1\r\n\r\n"
    records = [("http://a/ b", "20050607080910", tricky), ("dns:a", "20050607080911", b"a 1.2.3.4"), ("http://c", "20050607080912", b"")]
    for version in (1, 2):
        got = list(arc.parse_arc(arc.arc_archive(version, "x.arc", records)))
        assert [r.version for r in got] == [version] * 4 and got[0].fields["URL"] == "filedesc://x.arc"
        assert [(r.block, r.fields["Archive-date"]) for r in got[1:]] == [(b, d) for _, d, b in records]
        kinds = [arc.to_warc(r).fields["WARC-Type"] for r in got]
        assert kinds == ["warcinfo", "response", "resource", "resource"]
        assert arc.to_warc(got[1]).fields["WARC-Date"] == "2005-06-07T08:09:10Z"


def test_url_fields_are_read_from_the_right():
    line = b"filedesc://n 0.0.0.0 20010101000000 text/plain 4\n1 0 \n" + b"\nhttp://old url 1.2.3.4 19990101000000 text/html 2\nhi\n"
    assert [r.fields["URL"] for r in arc.parse_arc(line)] == ["filedesc://n", "http://old url"]


@pytest.mark.parametrize("data", [b"no version 1 2 3\n", b"filedesc://n 0.0.0.0 20010101000000 text/plain 40\n1 0 \n", b"filedesc://n"])
def test_broken_archives_raise(data):
    with pytest.raises(ValueError):
        list(arc.parse_arc(data))


def test_warc_round_trip_in_small_pieces():
    rnd = random.Random(1)
    blocks = [bytes(rnd.randrange(256) for _ in range(rnd.randint(0, 300))) for _ in range(40)] + [b"\r\n\r\nWARC/1.1\r\n\r\n"]
    records = [arc.Record({"WARC-Type": "resource", "N": str(i)}, b) for i, b in enumerate(blocks)]
    data = b"".join(arc.warc_bytes(r) + b"\r\n\r\n" for r in records)
    for size in (1, 7, 1000, len(data)):
        got = list(arc.parse_warc(iter([data[i:i + size] for i in range(0, len(data), size)])))
        assert [r.block for r in got] == blocks
    two = gzip.compress(data[:500]) + gzip.compress(data[500:])
    assert b"".join(arc.unzipped(two, 64)) == data
    with pytest.raises(ValueError):
        list(arc.parse_warc(iter([data[:-30]])))


def expected(rows):
    body = {}
    for i, (page, _, html) in enumerate(rows):
        body[i] = (html or "").encode()
    first = {}
    for i, (page, *_) in enumerate(rows):
        if len(body[i]) >= 100 and page is not None:
            first[body[i]] = min(page, first.get(body[i], page))
    out = []
    for i, (page, *_) in enumerate(rows):
        original = first.get(body[i])
        again = original is not None and original != page
        out.append((page, len(body[i]), hashlib.sha256(body[i]).hexdigest(), "revisit" if again else "response", original if again else None))
    return sorted(out, key=str)


def test_pages_against_plain_rules(spark, tmp_path, monkeypatch):
    prepare(spark)
    same = "é<p>\r\n\r\nWARC/1.1\r\n" + "x" * 100
    rows = [(5, "http://a", same), (3, "http://b c", same), (9, None, same), (9, "http://d", same), (None, "http://e", same),
            (1, "http://f", "short"), (2, "http://f", "short"), (4, "http://g", None), (6, "http://g", ""),
            (3, "http://b", "another text " * 20), (8, "http://z", "another text " * 20), (None, "u", "y" * 200), (None, "u", "y" * 200),
            (7, "http://big", "WARC-Refers-To-Page: @\r\n" * 300_000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")
    for i, bound in enumerate((200_000, 0)):
        monkeypatch.setattr(arc, "BROADCAST_ROWS", bound)
        path = f"file://{tmp_path}/w{i}"
        arc.convert(arc.page_archives(df), path)
        got = arc.read_warc(spark, path).collect()
        assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=str) == expected(rows)
        # A revisit names the record of its original.
        ids = {(r.page_id, r.payload_digest): r.record_id for r in got if r.record_type == "response"}
        for r in got:
            assert (r.refers_to_record is None) == (r.record_type == "response")
            assert r.record_type == "response" or r.refers_to_record == ids[r.refers_to, r.payload_digest]
        assert all(r.payload is None or bytes(r.payload) in {(h or "").encode() for _, _, h in rows} for r in got)


def test_no_pages(spark, tmp_path):
    prepare(spark)
    df = spark.createDataFrame([], "page_id long, url string, html string")
    arc.convert(arc.page_archives(df), f"file://{tmp_path}/none")
    assert arc.read_warc(spark, f"file://{tmp_path}/none").collect() == []


@pytest.mark.parametrize("members", [True, False])
def test_compressed_archives(spark, tmp_path, members):
    prepare(spark)
    records = [("http://a", "20050607080910", b"HTTP/1.1 200 OK\r\nX-Page-Id: 4\r\n\r\n" + b"z" * 200), ("http://b", "2005", b"plain")]
    plain = arc.arc_archive(1, "x.arc", records)
    cuts = [0, plain.index(b"http://a"), plain.index(b"http://b"), len(plain)]
    parts = [plain[a:b] for a, b in zip(cuts, cuts[1:])] if members else [plain]
    data = b"".join(gzip.compress(p) for p in parts)
    assert [r.block for r in arc.parse_arc(data)][1:] == [b for _, _, b in records]
    (tmp_path / "old.arc.gz").write_bytes(data)
    arc.convert(arc.read_archives(spark, f"file://{tmp_path}", "*.arc.gz"), f"file://{tmp_path}/out")
    got = {r.target_uri: r for r in arc.read_warc(spark, f"file://{tmp_path}/out").collect()}
    assert got["http://a"].page_id == 4 and got["http://a"].payload_bytes == 200 and got["http://b"].date == "2005-01-01T00:00:00Z"


def test_short_dates_name_their_first_instant():
    assert arc.warc_date("2001") == "2001-01-01T00:00:00Z"
    assert arc.warc_date("200112") == "2001-12-01T00:00:00Z"
    assert arc.warc_date("20011231235958") == "2001-12-31T23:59:58Z"


def archives(path):
    return [f.read_bytes() for f in sorted(path.glob("part-*"))]


def members(data):
    """Contents of the gzip members of an archive, one by one."""
    out = []
    while data:
        z = zlib.decompressobj(31)
        out.append(z.decompress(data))
        assert z.eof
        data = z.unused_data
    return out


def test_every_record_is_a_member_and_files_are_bounded_by_bytes(spark, tmp_path, monkeypatch):
    prepare(spark)
    rnd = random.Random(2)
    texts = [bytes(rnd.randrange(256) for _ in range(2_000)).hex() for _ in range(60)]
    texts[7] = bytes(rnd.randrange(256) for _ in range(100_000)).hex()
    rows = [(i, f"http://h/{i}", texts[i % 50]) for i in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    monkeypatch.setattr(arc, "FILE_BYTES", 20_000)
    arc.convert(arc.page_archives(df), f"file://{tmp_path}/w")
    found = archives(tmp_path / "w")
    assert len(found) > 5
    longest = max(len(arc.member(t.encode())) for t in texts)
    assert max(map(len, found)) < 20_000 + longest + 1_000
    kinds = []
    for data in found:
        *records, end = members(data)
        assert end == b"" and records
        for record in records:
            [one] = arc.parse_warc(iter([record]))
            assert int(one.fields["Content-Length"]) == len(one.block)
            assert record.endswith(b"\r\n\r\n" + one.block + b"\r\n\r\n")
            kinds.append(one.fields["WARC-Type"])
        assert gzip.decompress(data) == b"".join(records)
    assert {k: kinds.count(k) for k in set(kinds)} == {"warcinfo": 2, "response": 50, "revisit": 10}
    got = arc.read_warc(spark, f"file://{tmp_path}/w").collect()
    assert sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=str) == expected(rows)


def test_blocks_that_are_not_text_come_back_byte_by_byte(spark, tmp_path):
    prepare(spark)
    rnd = random.Random(3)
    bodies = [bytes(rnd.randrange(256) for _ in range(n)) for n in (0, 1, 300, 5_000)] + [b"\xff\xfe\x00\x1f\x8b" * 50]
    records = [(f"http://h/{i}", "20050607080910", b"HTTP/1.1 200 OK\r\n\r\n" + b) for i, b in enumerate(bodies)]
    (tmp_path / "old.arc").write_bytes(arc.arc_archive(2, "old.arc", records))
    arc.convert(arc.read_archives(spark, f"file://{tmp_path}", "*.arc"), f"file://{tmp_path}/out")
    got = {r.target_uri: bytes(r.payload) for r in arc.read_warc(spark, f"file://{tmp_path}/out").collect()}
    assert got == {f"http://h/{i}": b for i, b in enumerate(bodies)}
