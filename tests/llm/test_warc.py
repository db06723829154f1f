import gzip
import hashlib
import io
import os

import pytest

from logquarry.llm.warc import read_archives, read_records, round_trip, write_archives, write_record


def brute(pages):
    out = []
    for page_id, html in pages:
        data = (html or "").encode()
        same = [i for i, h in pages if (h or "") == (html or "") and i is not None]
        keep = max(same, default=None) if len(data) >= 1000 else None
        revisit = keep is not None and keep != page_id
        out.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", keep if revisit else None))
    return sorted(out, key=str)


PAGES = [(i, f"<p>é {i % 4}</p>" * (200 if i % 2 else 3)) for i in range(40)]
PAGES += [(100, None), (101, ""), (102, "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" * 90), (103, "x" * 999), (104, "x" * 999), (105, "y" * 1000), (106, "y" * 1000)]
PAGES += [(None, "z" * 2000), (None, "z" * 2000), (None, "y" * 1000), (7, PAGES[7][1]), (200, "long " * 700000), (106, "y" * 1000)]


def test_round_trip(make):
    frame = make([(i, f"http://a/{i}\r\nX: y", h, "clash", 1) for i, h in PAGES], "page_id long, url string, html string, digest string, size int")
    assert sorted((tuple(r) for r in round_trip(frame.repartition(3), archive_bytes=5000).collect()), key=str) == brute(PAGES)
    assert round_trip(frame.limit(0)).count() == 0


def test_archives_are_warc_files_and_chunks_join_to_the_payloads(make, tmp_path):
    frame = make([(i, f"http://a/{i}", h) for i, h in PAGES[:40]], "page_id long, url string, html string")
    archives = write_archives(frame, str(tmp_path))
    assert sorted(os.listdir(tmp_path)) == sorted(r["path"] for r in archives.collect())
    assert sum(r["records"] for r in archives.collect()) == 40
    rows = read_archives(archives, str(tmp_path), chunk=64).orderBy("record_id", "chunk_no").collect()
    payloads, html = {}, dict(PAGES[:40])
    for r in rows:
        if r["record_type"] == "response":
            before = payloads.get(r["record_id"], b"")
            assert r["start"] == len(before) and len(r["chunk"]) == r["chunk_bytes"] <= 64
            payloads[r["record_id"]] = before + bytes(r["chunk"])
            assert hashlib.sha1(payloads[r["record_id"]]).hexdigest() == r["digest_so_far"]
            assert r["last"] == (len(payloads[r["record_id"]]) == len(html[int(r["record_id"].split(":")[-1])].encode()))
        else:
            assert r["refers_to"] and r["last"] and r["chunk_bytes"] == 0
    assert all(payloads[k] == html[int(k.split(":")[-1])].encode() for k in payloads)
    # each record is a gzip member with the fields the format prescribes
    data = b"".join(gzip.decompress((tmp_path / p).read_bytes()) for p in os.listdir(tmp_path))
    for field in (b"WARC-Type: revisit", b"WARC-Refers-To: <urn:page:", b"WARC-Profile: ", b"WARC-Payload-Digest: sha1:", b"WARC-Target-URI: http://a/1\r\n"):
        assert field in data


def test_damage_is_noticed():
    out = io.BytesIO()
    write_record(out, 1, None, b"some payload", 12, hashlib.sha1(b"some payload").hexdigest(), None, False)
    plain = gzip.decompress(out.getvalue())
    assert [r["last"] for r in read_records(io.BytesIO(plain), 5)] == [False, False, True]
    for broken in (plain.replace(b"some", b"same"), plain[:-10], b"junk\r\n" + plain):
        with pytest.raises(ValueError):
            list(read_records(io.BytesIO(broken)))


def test_a_long_payload_is_never_held_whole():
    class Endless(io.RawIOBase):
        """A payload of 64 MB that is made as it is read."""

        def __init__(self):
            self.head = io.BytesIO(b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <a>\r\nContent-Length: 67108864\r\n\r\n")
            self.left, self.most = 1 << 26, 0

        def readline(self, size=-1):
            return self.head.readline() if self.left else b""

        def read(self, n):
            self.most, n = max(self.most, n), min(n, self.left)
            self.left -= n
            return bytes(n)

    stream = Endless()
    rows = list(read_records(stream, 1 << 16, with_data=False))
    assert len(rows) == 1024 and stream.most <= 1 << 16 and rows[-1]["digest_so_far"] == hashlib.sha1(bytes(1 << 26)).hexdigest()


def test_a_hot_payload_travels_without_its_html(make, monkeypatch, spark):
    """Two thirds of the pages hold one payload: no shuffle but that of responses has an html column."""
    hot = "<p>" + "same " * 600
    rows = [(i if i % 50 else None, f"http://a/{i}", hot if i % 3 else f"<p>{i} " + "own " * 400) for i in range(600)]
    rows += [(7000 + i, None, f"twice {i // 2} " * 200) for i in range(60)] + [(9000, None, hot)] * 2
    frame = make(rows, "page_id long, url string, html string").repartition(5)
    got = sorted((tuple(r) for r in round_trip(frame).collect()), key=str)
    assert got == brute([(i, h) for i, _, h in rows])
    assert sum(r[3] == "response" and r[1] == len(hot) for r in got) == 2
