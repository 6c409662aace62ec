"""Archives: round trip, and salvage of every sound record around damage."""

import base64
import hashlib

import pytest

from spanlake.llm import warc
from spanlake.session import scratch_path

PAGES = [
    (1, "http://a/", "same"),
    (2, "http://b/", "same"),
    (None, "http://n/", "same"),
    (3, None, None),
    (4, "http://e/", ""),
    (5, "http://bad/\r\nWARC-Type: x %41", "WARC/1.1\r\nlooks like a record\r\n\r\n"),
    (6, "http://long/", "é" * 300_000),
    (1, "http://a/", "same"),
    (None, "http://alone/", "only"),
]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def test_round_trip(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    pages = pages.selectExpr("*", "'x' AS first", "1 AS sha")
    folder = scratch_path(spark, "warc")
    found = warc.read_archives(warc.write_archives(pages, folder), folder).collect()
    first = {None: 3, "": 3, "same": 1}
    wanted = []
    for page, _, html in PAGES:
        at = first.get(html, page)
        kind = "response" if at == page else "revisit"
        size = len((html or "").encode())
        wanted.append((page, size, digest(html), kind, None if at == page else at))
    made = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    assert sorted(made, key=repr) == sorted(wanted, key=repr)
    assert all(r.gap is None for r in found)
    assert [bytes(r.payload) for r in found if r.page_id == 6] == [("é" * 300_000).encode()]


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = scratch_path(spark, "warc")
    assert warc.read_archives(warc.write_archives(pages, folder), folder).count() == 0


class Bytes:
    def __init__(self, data):
        self.data, self.fetched, self.requests = data, 0, 0

    def read_at(self, count, at):
        found = self.data[at : at + count]
        self.fetched, self.requests = self.fetched + len(found), self.requests + 1
        return found


def salvaged(data):
    reader = warc.Reader(Bytes(data), len(data))
    return [int(r.headers[warc.PAGE]) for r in reader.records()], reader.gaps


def records(packed, count=12):
    made = [warc.page_record(i, f"http://x/{i}", f"page {i} ".encode() * (200 * (i + 1)), i) for i in range(count)]
    return [warc.gzip_member(r) for r in made] if packed else made


@pytest.mark.parametrize("packed", [True, False])
def test_each_damaged_record_is_the_only_one_lost(packed):
    parts = records(packed)
    for hurt in range(len(parts)):
        at = len(parts[hurt]) // 2
        for damage in (
            lambda p: p[:at] + bytes([p[at] ^ 255]) + p[at + 1 :],
            lambda p: p[:at],
            lambda p: b"\x00" * len(p),
            lambda p: b"junk" + warc.GZIP_START + b"more" + warc.VERSION_START,
        ):
            broken = [damage(p) if i == hurt else p for i, p in enumerate(parts)]
            found, gaps = salvaged(b"".join(broken))
            begin = sum(map(len, broken[:hurt]))
            assert found == [i for i in range(len(parts)) if i != hurt]
            assert [g[:2] for g in gaps] == [(begin, begin + len(broken[hurt]))]


@pytest.mark.parametrize("packed", [True, False])
def test_junk_before_between_and_after(packed):
    parts = records(packed, 3)
    found, gaps = salvaged(b"??" + parts[0] + b"!!!" + parts[1] + parts[2] + b"tail")
    assert found == [0, 1, 2] and [b - a for a, b, _ in gaps] == [2, 3, 4]
    assert salvaged(b"") == ([], []) and salvaged(b"none")[0] == []


def test_several_records_in_one_member():
    data = warc.gzip_member(b"".join(records(False, 4)))
    assert salvaged(data) == ([0, 1, 2, 3], [])


@pytest.mark.parametrize("hurt", range(5))
def test_the_other_records_of_a_damaged_member_are_kept(hurt):
    parts = records(False, 5)
    at = len(parts[hurt]) // 2
    parts[hurt] = parts[hurt][:at] + b"\x00" + parts[hurt][at + 1 :]
    after = records(True, 7)[6]
    member = warc.gzip_member(b"".join(parts))
    found, ((begin, end, why),) = salvaged(member + after)
    assert found == [i for i in range(5) if i != hurt] + [6]
    assert (begin, end) == (0, len(member)) and "inflated bytes" in why


def test_what_was_inflated_before_an_error_is_kept():
    member = warc.gzip_member(b"".join(records(False, 40)))
    after = records(True, 41)[40]
    for broken, whole in (
        (member[: len(member) * 3 // 4], range(1, 40)),
        (member[: len(member) // 2] + b"\xff" * 99 + member[len(member) // 2 + 99 :], range(1, 40)),
    ):
        found, gaps = salvaged(broken + after)
        kept = found[:-1]
        assert found[-1] == 40 and kept == list(range(len(kept))) and len(kept) in whole
        assert [g[:2] for g in gaps] == [(0, len(broken))]


def test_a_wrong_checksum_alone_leaves_every_head_in_doubt():
    member = warc.gzip_member(b"".join(records(False, 4)))
    found, gaps = salvaged(member[:-8] + b"\x00" * 8 + records(True, 5)[4])
    assert found == [4] and [g[:2] for g in gaps] == [(0, len(member))]


def test_records_without_digest_are_not_taken_from_a_damaged_member():
    plain = warc.record_bytes({warc.PAGE: "1", "Content-Length": "3"}, b"abc")
    member = warc.gzip_member(plain)
    assert salvaged(member)[0] == [1]
    assert salvaged(member[:-4])[0] == []


@pytest.mark.parametrize("packed", [True, False])
def test_header_names_in_any_case(packed):
    head = f"WARC/1.0\r\nx-page-id: 4\r\nCONTENT-length: 2\r\nx: {'y' * (3 << 20)}\r\n\r\nhi\r\n\r\n".encode()
    assert salvaged(warc.gzip_member(head) if packed else head) == ([4], [])


@pytest.mark.parametrize("packed", [True, False])
def test_each_byte_is_fetched_once(packed):
    made = [warc.page_record(i, f"http://x/{i}", f"page {i}".encode(), i) for i in range(5000)]
    data = b"".join(map(warc.gzip_member, made) if packed else made)
    file = Bytes(data)
    assert sum(1 for _ in warc.Reader(file, len(data)).records()) == 5000
    assert file.fetched == len(data) and file.requests <= len(data) // warc.READ_BYTES + 1


def test_gaps_are_logged_as_rows(spark):
    folder = scratch_path(spark, "warc")
    files, root = warc.store(folder)
    files.create_dir(root, recursive=True)
    parts = records(True, 3)
    with files.open_output_stream(f"{root}/a.warc.gz", compression=None) as out:
        out.write(parts[0] + parts[1][:-9] + parts[2])
    rows = warc.read_archives(spark.createDataFrame([("a.warc.gz",)], "file string"), folder).collect()
    # The cut took the checksum only: the record is whole by its digest, and the gap tells of it.
    assert sorted(r.page_id for r in rows if r.gap is None) == [0, 1, 2]
    (gap,) = [r for r in rows if r.gap]
    assert (gap.begin, gap.end) == (len(parts[0]), len(parts[0]) + len(parts[1]) - 9)
