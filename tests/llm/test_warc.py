"""Archives: round trips, refusal of damaged ones, and roles by brute force."""

import hashlib

import pytest
import zstandard

from kiln.llm import warc
from kiln.llm.common import shared_dir


def reader(data):
    at = [0]

    def read(n):
        at[0] += n
        return data[at[0] - n : at[0]]

    return read


def test_archive_round_trip_and_damage():
    records = [warc.record(i, f"http://a/{i}", f"<p>{i}</p>".encode() * 40, hashlib.sha256(f"<p>{i}</p>".encode() * 40).hexdigest(), "response", None) for i in range(300)]
    data = b"".join(warc.archive(records))
    assert data[:4] == b"\x5d\x2a\x4d\x18" and int.from_bytes(data[4:8], "little") > 0
    assert list(warc.frames(reader(data))) == records
    assert warc.parse(records[7])["page_id"] == 7
    for bad in (data[:-3], data[8:], b"\0" * 20):
        with pytest.raises((ValueError, zstandard.ZstdError)):
            list(warc.frames(reader(bad)))
    for a, b in ((b"WARC/1.1", b"WARC/0.9"), (b"<p>7", b"<p>8"), (b"WARC-Type: response", b"WARC-Type: revisit"), (b"\r\n\r\n", b"\r\n\r\n\r\n")):
        with pytest.raises(ValueError):
            warc.parse(records[7].replace(a, b))


def test_pages(spark):
    long = "é" * 60
    rows = [(5, "u", long), (3, "u", long), (9, None, long), (None, "u", long), (1, "a b\nc", None), (2, "", ""), (4, "x", "short"), (6, "x", "short"), (3, "u", long), (8, "big", "z" * 3_000_000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string").repartition(3)
    got = warc.read_archives(warc.write_archives(warc.with_roles(df), shared_dir(spark))).collect()
    expected = []
    for page, _, html in rows:
        raw = (html or "").encode()
        revisit = html == long and page != 3
        expected.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None, None if revisit else raw))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload if r.payload is None else bytes(r.payload)) for r in got), key=repr) == sorted(expected, key=repr)
    assert warc.read_archives(warc.write_archives(warc.with_roles(df.limit(0)), shared_dir(spark))).count() == 0
