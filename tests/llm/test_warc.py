import gzip
import hashlib
import io
import zlib

import pytest

from scenaria.llm.common import scratch_path
from scenaria.llm.warc import END, _open, normalise, plan_records, read_archives, record, records_of, round_trip, write_archives

PAGES = "page_id long, url string, html string, digest string, payload string, archive string"


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y", "z") for i, u, h in rows], PAGES)


def wanted(rows):
    first = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 100 and i is not None:
            first[b] = min(first.get(b, i), i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        whole = b not in first or first[b] == i
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "response" if whole else "revisit", None if whole else first[b]))
    return out


def key(r):
    return tuple(str(x) for x in r)


def test_round_trip(spark):
    big = "<p>ünï\r\n\r\nWARC/1.1\r\n</p>" * 20000
    rows = [(i, f"http://h/{i}", f"<html>{i}" + "x" * (i % 300)) for i in range(200)]
    rows += [(900 - i, "http://hot/", "same " * 40) for i in range(300)] + [(901, None, None), (902, "a b\r\nc: d", ""), (903, "u", big), (904, "u", big)]
    rows += [(905, "u", "s" * 99), (906, "u", "s" * 99), (907, "u", "é" * 50), (908, "u", "é" * 50), (907, "u", "é" * 50), (None, "u", "é" * 50), (None, "u", "n" * 200)]
    got = round_trip(frame(spark, rows), "page_id", "url", "html", roll_bytes=50_000).collect()
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(wanted(rows), key=key)


def test_members_and_index(spark):
    folder = scratch_path(spark, "warc")
    rows = [(i, "u", "text " * i) for i in range(50)]
    raw = write_archives(plan_records(frame(spark, rows).coalesce(1), "page_id", "url", "html"), folder).collect()
    fs, path = _open(raw[0].archive)
    data = fs.open_input_stream(path, compression=None).read()
    one = zlib.decompressobj(31)
    one.decompress(data)
    assert one.eof and not one.unused_data  # a single stream
    normal = normalise(spark.createDataFrame(raw), folder).collect()
    path = _open(normal[0].archive)[1]
    members, data2 = 0, fs.open_input_stream(path, compression=None).read()
    assert gzip.decompress(data2) == gzip.decompress(data)
    while data2:
        one = zlib.decompressobj(31)
        assert one.decompress(data2).startswith(b"WARC/1.1\r\n")
        data2, members = one.unused_data, members + 1
    assert members == 50 == normal[0].records
    assert read_archives(spark.createDataFrame(normal)).count() == 50


def test_broken_streams():
    whole = gzip.compress(record(1, "u", b"abc", "d", None) + record(2, "u", b"", "d", 1))
    assert [h["warc-type"] for h, _ in records_of(io.BytesIO(whole))] == ["response", "revisit"]
    with pytest.raises(ValueError, match="ends early"):
        list(records_of(io.BytesIO(whole[:-12])))
    with pytest.raises(ValueError, match="not a WARC"):
        list(records_of(io.BytesIO(gzip.compress(b"no record" + END))))
    with pytest.raises(ValueError, match="cut off"):
        list(records_of(io.BytesIO(gzip.compress(record(1, "u", b"abc", "d", None)[:-3]))))


def test_empty_table(spark):
    assert round_trip(frame(spark, []), "page_id", "url", "html").count() == 0
