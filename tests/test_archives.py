"""Damaged archives: every sound record is read, and every damaged place is reported."""

import gzip
import random
import zlib

import pytest
from hypothesis import given, settings, strategies as st

from pagelens import schemas
from pagelens.sources import warc


def record(number, block, kind=b"response", length=None):
    head = [b"WARC/1.0", b"WARC-Type: " + kind, b"WARC-Target-URI: http://p/%d" % number, b"WARC-Record-ID: <urn:%d>" % number,
            b"WARC-Date: 2024-01-01T00:00:00Z", b"Content-Length: " + (str(len(block)).encode() if length is None else length)]
    return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def blocks(n, seed=1):
    r = random.Random(seed)
    return [bytes(r.choices(b"abcdefgh <>\n", k=r.randint(50, 3000))) + r.randbytes(200) for _ in range(n)]


def spoilt(member, at=None, size=6):
    at = len(member) // 2 if at is None else at
    return member[:at] + bytes(255 - b for b in member[at:at + size]) + member[at + size:]


def read(spark, path):
    rows = warc.read_warc(spark, str(path), rejects=True).collect()
    return [r for r in rows if r.status == warc.OK], [r for r in rows if r.status != warc.OK]


@pytest.mark.parametrize("damaged", [[10], [0], [99], [3, 4, 5], [0, 50, 99]])
def test_damaged_members_cost_only_themselves(spark, tmp_path, damaged):
    data = blocks(100)
    members = [gzip.compress(record(i, b)) for i, b in enumerate(data)]
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"".join(spoilt(m) if i in damaged else m for i, m in enumerate(members)))
    sound, lost = read(spark, path)
    assert [(r.url, bytes(r.payload)) for r in sound] == [(f"http://p/{i}", b) for i, b in enumerate(data) if i not in damaged]
    assert [r.record_no for r in sound] == list(range(1, len(sound) + 1))
    assert {r.status for r in lost} == {warc.DAMAGED} and all(r.payload is None and r.record_no is None for r in lost)
    starts = [sum(map(len, members[:i])) for i in damaged]
    # Neighbouring damaged members are one place, as nothing sound lies between them.
    assert [r.offset for r in lost] == [s for i, s in zip(damaged, starts) if i - 1 not in damaged or len(lost) == len(damaged)]
    plain = warc.read_warc(spark, str(path))
    assert plain.schema == schemas.WARC_RECORD and plain.count() == len(sound)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**9), st.integers(0, 7), st.integers(0, 255))
def test_any_spoilt_byte_costs_at_most_one_record(seed, number, change):
    """Whatever byte of a member changes, all other records are read and nothing wrong is."""
    import io
    data = blocks(8, seed)
    members = [gzip.compress(record(i, b), mtime=0) for i, b in enumerate(data)]
    at = random.Random(seed).randrange(len(members[number]))
    member = members[number]
    members[number] = member[:at] + bytes([member[at] ^ (change or 1)]) + member[at + 1:]
    with warc._Members(io.BytesIO(b"".join(members))) as stream:
        found = list(warc.warc_records(stream))
    good = {int(h["warc-record-id"][5:-1]): payload for status, _, h, payload in found if status == warc.OK}
    assert set(range(8)) - {number} <= set(good) and all(data[i] == p for i, p in good.items())
    # A change may make the last member endless, which looks like a cut file.
    assert all(status == warc.DAMAGED or (number == 7 and status == warc.CUT) for status, *_ in found if status != warc.OK)
    assert len(found) == 8


def test_what_lies_between_members(spark, tmp_path):
    data = blocks(4)
    members = [gzip.compress(record(i, b)) for i, b in enumerate(data)]
    (tmp_path / "a.warc.gz").write_bytes(members[0] + b"no member at all" + members[1] + b"\x1f\x8b\x08 not one either" + members[2] + members[3] + b"\0" * 9000)
    sound, lost = read(spark, tmp_path / "a.warc.gz")
    assert [bytes(r.payload) for r in sound] == data and [r.status for r in lost] == [warc.DAMAGED] * 2
    (tmp_path / "b.warc.gz").write_bytes(b"\0" * 100 + members[0] + b"\0" * 3)
    assert [len(x) for x in read(spark, tmp_path / "b.warc.gz")] == [1, 1]


def test_cut_files_wrong_lengths_and_no_archives(spark, tmp_path):
    data = blocks(3)
    members = [gzip.compress(record(i, b)) for i, b in enumerate(data)]
    (tmp_path / "cut.warc.gz").write_bytes(members[0] + members[1] + members[2][:-300])
    sound, lost = read(spark, tmp_path / "cut.warc.gz")
    assert len(sound) == 2 and [r.status for r in lost] == [warc.CUT] and data[2].startswith(bytes(lost[0].payload))
    long = gzip.compress(record(7, b"short", length=b"5000"))
    (tmp_path / "long.warc.gz").write_bytes(long + members[0] + members[1])
    sound, lost = read(spark, tmp_path / "long.warc.gz")
    assert [bytes(r.payload) for r in sound] == data[:2] and [(r.status, r.url) for r in lost] == [(warc.CUT, "http://p/7")]
    none = gzip.compress(record(7, b"x", length=b"many"))
    (tmp_path / "none.warc.gz").write_bytes(members[0] + none + members[1])
    sound, lost = read(spark, tmp_path / "none.warc.gz")
    assert len(sound) == 2 and [(r.status, r.url) for r in lost] == [(warc.BROKEN, "http://p/7")]
    (tmp_path / "text.warc").write_bytes(b"no archive\nat all\n" + record(1, b"one") + b"noise\n" + record(2, b"two"))
    sound, lost = read(spark, tmp_path / "text.warc")
    assert [bytes(r.payload) for r in sound] == [b"one", b"two"] and [r.status for r in lost] == [warc.BROKEN] * 2
    (tmp_path / "empty.warc.gz").write_bytes(b"")
    assert read(spark, tmp_path / "empty.warc.gz") == ([], [])


def test_one_member_for_all_records_and_members_that_cut_records(spark, tmp_path):
    data = blocks(20)
    whole = b"".join(record(i, b) for i, b in enumerate(data))
    (tmp_path / "one.warc.gz").write_bytes(gzip.compress(whole))
    (tmp_path / "parts.warc.gz").write_bytes(b"".join(gzip.compress(whole[i:i + 700]) for i in range(0, len(whole), 700)))
    for name in ("one", "parts"):
        sound, lost = read(spark, tmp_path / f"{name}.warc.gz")
        assert [bytes(r.payload) for r in sound] == data and not lost


def test_wrong_checksum(spark, tmp_path):
    member = gzip.compress(record(1, b"text" * 100))
    assert zlib.crc32(b"") == 0
    (tmp_path / "a.warc.gz").write_bytes(spoilt(member, len(member) - 8, 4) + gzip.compress(record(2, b"next")))
    sound, lost = read(spark, tmp_path / "a.warc.gz")
    assert [bytes(r.payload) for r in sound] == [b"next"] and [r.url for r in lost] == ["http://p/1"]


def test_requests_do_not_count_and_missing_files(spark, tmp_path):
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(record(1, b"GET", b"request")) + gzip.compress(record(2, b"ok")))
    listed = spark.createDataFrame([(str(tmp_path / "a.warc.gz"),), (str(tmp_path / "b.warc.gz"),)], "path string")
    found = warc.read_warc_files(listed, rejects=True)
    assert found.schema == schemas.WARC_STATUS
    assert sorted(r.status for r in found.collect()) == [warc.MISSING, warc.OK]
    sound, lost = warc.split_rejects(found)
    assert sound.schema == schemas.WARC_RECORD and sound.count() == 1 and lost.columns == ["warc_file", "offset", "url", "status"]
