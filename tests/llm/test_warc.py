import base64
import hashlib
import io
import random
import struct
import zipfile

import pytest

from tablescope.llm import warc as W
from tablescope.llm import zip_reader as Z

SCHEMA = "page_id long, url string, html string, key string, first long, payload string"


def b32(raw):
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def expected(rows, min_bytes=0):
    first = {}
    for i, _, h in rows:
        if i is not None:
            raw = (h or "").encode()
            first[raw] = min(first.get(raw, i), i)
    out = []
    for i, _, h in rows:
        raw = (h or "").encode()
        revisit = i is not None and len(raw) >= min_bytes and first[raw] != i
        out.append((i, len(raw), b32(raw), "revisit" if revisit else "response", first[raw] if revisit else None))
    return sorted(out, key=repr)


def found(spark, rows, **more):
    pages = spark.createDataFrame([(*r, "k", 1, "p") for r in rows], SCHEMA)
    read = W.read_packages(W.write_packages(pages, **more))
    return sorted((tuple(r) for r in read.drop("url").collect()), key=repr)


ROWS = [(5, "http://a/", "<p>x</p>"), (3, None, "<p>x</p>"), (3, None, "<p>x</p>"), (9, "http://ü/ \n", None), (1, "u", ""),
        (None, "n", "<p>x</p>"), (None, None, None), (7, "long", "y\r\n\r\nz😀" * 40_000), (8, "long", "y\r\n\r\nz😀" * 40_000)]


@pytest.mark.parametrize("min_bytes", [0, 5])
def test_edge_cases(spark, min_bytes):
    assert found(spark, ROWS, min_bytes=min_bytes) == expected(ROWS, min_bytes)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_many_copies_members_and_packages(spark, monkeypatch):
    rnd = random.Random(4)
    rows = [(i, f"u{i}", rnd.choice(["hot", f"copy {i % 50}", f"own {i}"])) for i in rnd.sample(range(10_000), 1500)]
    assert found(spark, rows) == expected(rows)


def test_only_payloads_that_may_be_repeated_move(spark):
    """And every package is a task of its own when it is read."""
    from tablescope.llm import skew
    rows = spark.range(4000).selectExpr("id", "sha2(cast(id as string), 256) as key", "repeat('x', 100) as payload")
    keys = rows.where("id % 100 = 0").select("key")
    maybe, once = skew.split_by_keys(rows, keys, "key", 40)
    assert maybe.where("id % 100 = 0").count() == 40 and once.where("id % 100 = 0").count() == 0
    assert maybe.count() + once.count() == 4000 and maybe.count() < 200
    assert skew.with_key_in(rows, keys, "key", 40).count() == 40
    nothing = skew.split_by_keys(rows, keys.where("false"), "key", 0)
    assert nothing[0].count() == 0 and nothing[1].count() == 4000
    pages = spark.createDataFrame([(i, f"u{i}", f"p{i}") for i in range(40)], "page_id long, url string, html string").repartition(5)
    packages = W.write_packages(pages)
    assert W.read_packages(packages).rdd.getNumPartitions() == packages.count() > 1


def test_pages_round_trip(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    read = W.read_packages(W.write_packages(pages), with_payload=True).collect()
    want = {r.page_id: (r.url, (r.html or "").encode()) for r in pages.collect()}
    assert {r.id: r.url for r in read} == {i: u for i, (u, _) in want.items()}
    assert all(bytes(r.payload) == want[r.id][1] for r in read if r.record_type == "response")


def test_members_roll_and_a_standard_reader_agrees(tmp_path, monkeypatch):
    monkeypatch.setattr(W, "MEMBER_BYTES", 200)
    package = W._Package(str(tmp_path), 0)
    for i in range(20):
        package.add(i, f"u{i}", W.record(i, f"u{i}", b"payload %d" % i, None, False))
    path = package.close().column("package")[0].as_py()
    with zipfile.ZipFile(path) as z:
        assert z.testzip() is None and len(z.namelist()) > 4
    reader = W.PackageReader(path)
    got = [(line["page_id"], W.parse_record(raw)[2]) for line, raw in reader.records()]
    reader.close()
    assert got == [(i, b"payload %d" % i) for i in range(20)]


def reads(raw):
    return lambda at, n: raw[at: at + n]


def test_directory_with_comment_and_prefix_bytes():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a.txt", b"alpha")
        z.writestr("ü.txt", b"beta")
        z.writestr(zipfile.ZipInfo("packed"), b"gamma" * 100, zipfile.ZIP_DEFLATED)
        z.comment = b"a comment with PK\5\6 inside" + b"\0" * 30
    raw = out.getvalue()
    found = Z.members(reads(raw), len(raw))
    assert [m.name for m in found] == ["a.txt", "ü.txt", "packed"]
    for m, data in zip(found, (b"alpha", b"beta"), strict=False):
        at = Z.data_at(reads(raw), m)
        assert raw[at: at + m.size] == data
    with pytest.raises(ValueError, match="compressed"):
        Z.data_at(reads(raw), found[2])


def test_zip64_records():
    """Directory fields that are full, with their values in ZIP64 records."""
    name, data, gap = b"big", b"stored bytes", b"\0" * 50
    local = b"PK\3\4" + struct.pack("<HHHHHIIIHH", 45, 0, 0, 0, 0, zipfile.crc32(data), 0xFFFFFFFF, 0xFFFFFFFF, len(name), 20)
    local += name + struct.pack("<HHQQ", 1, 16, len(data), len(data)) + data
    extra = struct.pack("<HHI", 9, 4, 0) + struct.pack("<HHQQQ", 1, 24, len(data), len(data), len(gap))
    central = b"PK\1\2" + struct.pack("<HHHHHHIIIHHHHHII", 45, 45, 0, 0, 0, 0, zipfile.crc32(data), 0xFFFFFFFF, 0xFFFFFFFF,
                                      len(name), len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    central_at = len(gap) + len(local)
    end64_at = central_at + len(central)
    end64 = b"PK\6\6" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, 1, 1, len(central), central_at)
    locator = b"PK\6\7" + struct.pack("<IQI", 0, end64_at, 1)
    end = b"PK\5\6" + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    raw = gap + local + central + end64 + locator + end
    m, = Z.members(reads(raw), len(raw))
    assert (m.name, m.size, m.header_at) == ("big", len(data), len(gap))
    at = Z.data_at(reads(raw), m)
    assert raw[at: at + m.size] == data
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        assert z.read("big") == data


@pytest.mark.parametrize("raw", [b"", b"no zip at all", b"PK\5\6" + b"\0" * 10])
def test_what_is_no_zip_is_an_error(raw):
    with pytest.raises(ValueError):
        Z.members(reads(raw), len(raw))
