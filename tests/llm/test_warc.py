import gzip
import io

import pytest

from tarnwork.llm import warc
from tarnwork.llm.storage import open_store


def pages(frame, rows):
    return frame([(*r, "x", 5) for r in rows], "page_id long, url string, html string, payload string, refers_to int")


def back(files, **how):
    return warc.read_warc(files, **how).collect()


ROWS = [
    (5, "http://a/é\r\nb", "same"), (2, None, "same"), (9, "http://c", "same"), (1, "u", None), (3, "u", ""), (None, "u", "same"),
    (None, "u", "alone"), (4, "u", "x" * 300_000), (6, "u", "WARC/1.1\r\n\r\n\x1f\x8b\x08"), (8, "u", "twin"), (8, "u", "twin"),
]


@pytest.mark.parametrize("split_bytes", [7, 100, 1 << 20])
def test_round_trip_under_any_split(frame, tmp_path, split_bytes):
    files = warc.archive_pages(pages(frame, ROWS).coalesce(2), str(tmp_path / "w"))
    found = back(files, split_bytes=split_bytes)
    assert len(found) == len(ROWS)
    text = {r.record_id: bytes(r.payload).decode() for r in found if r.record_type == "response"}
    for r in found:
        whole = text[r.refers_to or r.record_id] if r.record_id != "urn:page:none" or r.refers_to else "alone"
        assert r.payload_bytes == len(whole.encode()) and r.payload_digest == warc.digest_of(whole.encode())
    by_id = sorted((r.record_id, r.record_type, r.refers_to) for r in found if r.record_id != "urn:page:none")
    assert by_id == [
        ("urn:page:1", "response", None), ("urn:page:2", "response", None), ("urn:page:3", "revisit", "urn:page:1"), ("urn:page:4", "response", None),
        ("urn:page:5", "revisit", "urn:page:2"), ("urn:page:6", "response", None), ("urn:page:8", "response", None), ("urn:page:8", "response", None),
        ("urn:page:9", "revisit", "urn:page:2"),
    ]


def test_least_bytes_and_empty_table(frame, tmp_path):
    files = warc.archive_pages(pages(frame, [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]), str(tmp_path / "w"), least_bytes=3)
    assert sorted((r.record_id, r.record_type) for r in back(files)) == [("urn:page:1", "response"), ("urn:page:2", "response"), ("urn:page:3", "response"), ("urn:page:4", "revisit")]
    assert back(warc.archive_pages(pages(frame, []), str(tmp_path / "e"))) == []


def test_files_are_plain_gzip(frame, tmp_path):
    files = warc.archive_pages(pages(frame, ROWS[:3]).coalesce(1), str(tmp_path / "w")).collect()
    data = b"".join(gzip.decompress(open(f.file, "rb").read()) for f in files)
    assert data.count(b"WARC/1.1\r\n") == 3 and sum(f.records for f in files) == 3


def test_only_members_with_a_header_count(tmp_path):
    good = [warc.member(warc.record(f"urn:x:{i}", "u", "2024-01-01T00:00:00Z", b"p" * i, None), 6) for i in range(4)]
    noise = warc.MAGIC * 3 + b"noise" + gzip.compress(b"no record") + good[0][:20]
    path = tmp_path / "n"
    path.write_bytes(noise + good[1] + noise + good[2] + warc.MAGIC + good[3])
    size = path.stat().st_size
    for step in (1, 13, size):
        found = []
        for start in range(0, size, step):
            found += [warc.parse(w)["record_id"] for _, w in warc.records_in(*open_store(str(path)), start, min(size, start + step))]
        assert found == ["urn:x:1", "urn:x:2", "urn:x:3"]


def test_a_changed_payload_is_refused():
    whole = warc.record("urn:x:1", None, "2024-01-01T00:00:00Z", b"payload", None)
    with pytest.raises(ValueError, match="digest"):
        warc.parse(whole.replace(b"payload\r\n", b"paylaod\r\n"))
    assert io.BytesIO(whole).readline() == b"WARC/1.1\r\n"
