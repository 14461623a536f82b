import gzip
import random
import hashlib

import pytest

from pricetrend.llm import warc

P = warc.WarcParams()


def one(i, payload, kind="response", refers=None):
    digest = hashlib.sha1(payload).hexdigest()
    return warc.record_bytes(kind, i, f"http://x/{i} y", b"" if refers is not None else payload, len(payload), digest, refers, P)


def ids(rows):
    return [r["id"] for r in rows if "reason" not in r]


def gaps(rows):
    return [(r["start"], r["end"]) for r in rows if "reason" in r]


def sample(compress):
    random.seed(1)
    records = [one(i, bytes(random.choices(b"abcdef <>\r\n", k=3000))) for i in range(6)]
    return [warc.member(r, 6) if compress else r for r in records]


def test_members_are_plain_gzip():
    parts = sample(True)
    assert gzip.decompress(b"\0".join(parts) + b"\0").count(b"WARC/1.1") == 6


@pytest.mark.parametrize("compress", [True, False])
def test_salvage(compress):
    parts = sample(compress)
    joint = b"\0"
    whole = joint.join(parts) + joint
    assert ids(warc.salvage(whole)) == list(range(6)) and not gaps(warc.salvage(whole))
    starts = [sum(len(p) + 1 for p in parts[:i]) for i in range(7)]
    # a flipped byte, a record cut short, junk between records, and a missing start
    flipped = bytearray(whole)
    flipped[starts[2] + len(parts[2]) // 2] ^= 0x55
    rows = list(warc.salvage(bytes(flipped)))
    assert ids(rows) == [0, 1, 3, 4, 5] and gaps(rows) == [(starts[2], starts[3])]
    short = joint.join([*parts[:3], parts[3][:-700], *parts[4:]]) + joint
    rows = list(warc.salvage(short))
    assert ids(rows) == [0, 1, 2, 4, 5] and gaps(rows) == [(starts[3], starts[4] - 700)]
    junk = b"\x1f\x8b\x08 no member WARC/1.1 no record"
    rows = list(warc.salvage(whole[:starts[1]] + junk + whole[starts[1]:]))
    assert ids(rows) == list(range(6)) and gaps(rows) == [(starts[1], starts[1] + len(junk))]
    rows = list(warc.salvage(whole[100:]))
    assert ids(rows) == [1, 2, 3, 4, 5] and gaps(rows) == [(0, starts[1] - 100)]
    rows = list(warc.salvage(whole[:-400]))
    assert ids(rows) == [0, 1, 2, 3, 4] and len(gaps(rows)) == 1
    assert list(warc.salvage(b"")) == [] and gaps(warc.salvage(b"nothing here")) == [(0, 12)]


def test_a_changed_payload_fails_its_digest():
    record = one(4, b"payload " * 300).replace(b"payload payload", b"PAYLOAD payload", 1)
    assert [r["reason"] for r in warc.salvage(warc.member(record, 6))] == ["block digest differs"]


def test_a_member_of_many_records():
    records = sample(False)
    good, joint = warc.member(one(50, b"last"), 6), warc.member(b"".join(records), 6)
    cut = joint[:len(joint) * 3 // 4]
    rows = list(warc.salvage(cut))
    assert ids(rows) == [0, 1, 2, 3] and len(gaps(rows)) == 1
    assert rows[-1]["reason"].startswith("gzip member ends early; inflated bytes ")
    rows = list(warc.salvage(b"junk" + cut + good))
    assert ids(rows) == [0, 1, 2, 3, 50] and gaps(rows) == [(0, 4), (4, 4 + len(cut))]
    late = joint[:-6] + bytes([joint[-6] ^ 1]) + joint[-5:]     # the checksum
    rows = list(warc.salvage(late + good))
    assert ids(rows) == [0, 1, 2, 3, 4, 5, 50] and gaps(rows) == [(0, len(late))]
    wrong = bytearray(b"".join(records))
    wrong[len(records[0]) + len(records[1]) - 100] ^= 1
    rows = list(warc.salvage(warc.member(bytes(wrong), 6) + good))
    assert ids(rows) == [0, 2, 3, 4, 5, 50] and len(gaps(rows)) == 1


def rows_of(spark):
    big, other = "x" * 1500, "é" * 700
    return [(1, "http://a", big), (2, None, big), (5, "http://c\n\td", big), (3, "http://d", other), (4, "http://e", other), (6, "f", "small"),
            (7, "g", "small"), (8, "h", None), (9, "i", ""), (None, "j", big), (None, "k", "z" * 2000), (11, "l", "WARC/1.1\r\nWARC-Type: response\r\n\r\n"),
            (5, "http://c\n\td", big), (12, "m", "y" * 3_000_000)]


@pytest.mark.parametrize("params", [P, warc.WarcParams(compress=False, file_bytes=2000)])
def test_round_trip(spark, tmp_path, params):
    rows = rows_of(spark)
    df = spark.createDataFrame(rows, "id long, url string, html string").selectExpr("*", "encode(html, 'utf-8') AS payload", "'x' AS its_id")
    path = str(tmp_path / "w")
    warc.write(df, path, params)
    got = warc.read(spark, path).collect()
    assert len(got) == len(rows) and not [r for r in got if r["reason"]]
    for r in got:
        same = [x for x in rows if x[0] == r["id"] and hashlib.sha1((x[2] or "").encode()).hexdigest() == r["payload_digest"]]
        payload = (same[0][2] or "").encode()
        assert r["payload_bytes"] == len(payload)
        equal = [x[0] for x in rows if x[2] == same[0][2] and x[0] is not None]
        keeper = max(equal, default=None)
        if len(payload) >= 1000 and len([x for x in rows if x[2] == same[0][2]]) > 1 and r["id"] != keeper and keeper is not None:
            assert (r["record_type"], r["refers_to"], r["payload"]) == ("revisit", keeper, b"")
        else:
            assert (r["record_type"], r["refers_to"], r["payload"]) == ("response", None, payload)


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "id long, url string, payload binary")
    warc.write(df, str(tmp_path / "e"))
    assert warc.read(spark, str(tmp_path / "e")).count() == 0


def test_archives_of_any_name_are_read(spark, tmp_path):
    parts = sample(True)
    (tmp_path / "crawl-0001.warc.gz").write_bytes(b"".join(parts[:4]))
    (tmp_path / "more.warc").write_bytes(b"".join(sample(False)[4:]))
    (tmp_path / "_SUCCESS").write_bytes(b"")
    got = warc.read(spark, str(tmp_path)).collect()
    assert sorted(r["id"] for r in got) == list(range(6)) and not [r for r in got if r["reason"]]
    assert sorted(r["id"] for r in warc.read(spark, str(tmp_path), glob="*.warc").collect()) == [4, 5]
