"""WARC writing and the salvage reader."""

from __future__ import annotations

import base64
import hashlib
import io
import random

import pytest

from stationday.llm import warc
from stationday.llm.common import scratch_path

SCHEMA = "page_id bigint, url string, html string, head string, place bigint, digest string, block binary"


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 7, "y", b"z") for r in rows], SCHEMA).repartition(3)


def round_trip(spark, rows):
    # a table of files: the writer reads its input twice
    at = scratch_path(spark, "pages")
    pages(spark, rows).write.parquet(at)
    path = scratch_path(spark, "warc-test")
    warc.write_archives(spark.read.parquet(at), path)
    return warc.read_archives(spark, path)


def expected(rows):
    """Plain version: of equal payloads the smallest page_id is the response."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    first, out = {}, []
    for page_id, _, html in order:
        data = (html or "").encode()
        again = data in first
        out.append((page_id, len(data), sha1(data), "revisit" if again else "response", first[data] if again else None))
        first.setdefault(data, page_id)
    return out


def odd_pages():
    rng = random.Random(3)
    rows = [(1, None, None), (2, "http://a/\r\nX: y", ""), (3, "http://ü.de/ä b", "ä€😀\x00\r\n\r\nWARC/1.1\r\n"), (None, "u", "<p>null id</p>"), (None, "u", "<p>null id</p>")]
    rows += [(50 - i, "http://hot", "<html>same</html>") for i in range(40)]
    rows += [(60, "http://twice", "twice"), (60, "http://twice", "twice"), (60, "http://other", "twice"), (-5, "n", "twice")]
    rows += [(70, "http://long", "long " + "".join(rng.choice("abc \n") for _ in range(5_000_000)))]
    rows += [(100 + i, f"http://x/{i}", "t" * rng.randrange(2000) + str(i)) for i in range(60)]
    return rows


def test_round_trip_of_odd_pages(spark):
    rows = odd_pages()
    read = round_trip(spark, rows)
    assert warc.gaps(read).count() == 0
    records = warc.http_records(read)
    got = [tuple(r) for r in warc.read_pages(records).collect()]
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(got, key=key) == sorted(expected(rows), key=key)
    found = {r["record_id"].split(":")[2]: r for r in records.collect()}
    assert bytes(found["70"]["payload"]) == rows[49][2].encode()
    assert found["2"]["target"] == "http://a/%0D%0AX:%20y" and found["1"]["target"] is None


def test_empty_table(spark):
    read = round_trip(spark, [])
    assert read.count() == 0 and warc.read_pages(warc.http_records(read)).count() == 0


def test_blocks_are_whole_records(spark):
    read = round_trip(spark, odd_pages()[5:30])
    for r in read.collect():
        assert r["head"]["content-length"] == str(len(r["block"]))
        assert r["head"]["warc-block-digest"] == "sha1:" + sha1(bytes(r["block"]))


# --- salvage ------------------------------------------------------------------


def archive(n: int, gzip: bool, seed: int = 1) -> tuple[bytes, list[tuple[int, int, bytes]]]:
    """(file, places of its records): offset, length and id of each."""
    rng = random.Random(seed)
    out, places = b"", []
    for i in range(n):
        payload = bytes(rng.randrange(256) for _ in range(rng.randrange(600))) if i % 3 else b"see WARC/1.0\r\n and \x1f\x8b\x08 here"
        raw = warc.record("response", f"<urn:page:{i}:0>", f"http://x/{i}", payload)
        raw = warc.member(raw) if gzip else raw
        places.append((len(out), len(raw), f"<urn:page:{i}:0>"))
        out += raw + (warc.EMPTY_MEMBER if gzip else b"")
    return out, places


def salvaged(data: bytes):
    found = list(warc.salvage(io.BytesIO(data), len(data)))
    return [x for x in found if isinstance(x, warc.Record)], [x for x in found if isinstance(x, warc.Gap)]


def covered(data: bytes, records, gaps):
    """Bytes in no record and no gap."""
    hit = bytearray(len(data))
    for x in [*records, *gaps]:
        assert not any(hit[x.offset : x.offset + x.length]), "overlap"
        hit[x.offset : x.offset + x.length] = b"\1" * x.length
    return bytes(b for b, h in zip(data, hit) if not h)


@pytest.mark.parametrize("gzip", [True, False])
def test_sound_archives_have_no_gap(gzip):
    data, places = archive(20, gzip)
    records, gaps = salvaged(data)
    assert [(r.offset, r.length, r.head["warc-record-id"]) for r in records] == places and not gaps


@pytest.mark.parametrize("gzip", [True, False])
@pytest.mark.parametrize("piece", [64, 1 << 18])
def test_every_sound_record_survives_random_damage(gzip, piece, monkeypatch):
    """Bytes changed, cut out, put in, doubled or cut off: all records that the
    damage does not touch are found where they are, and the rest is gaps."""
    monkeypatch.setattr(warc, "PIECE", piece)
    rng = random.Random(9)
    data, places = archive(12, gzip)
    for _ in range(60):
        lo = rng.randrange(len(data))
        hi = min(len(data), lo + rng.choice([1, 3, 40, 700]))
        kind = rng.choice(["change", "cut", "put", "end"])
        if kind == "change":
            broken = data[:lo] + bytes((b + rng.randrange(1, 256)) % 256 for b in data[lo:hi]) + data[hi:]
        elif kind == "cut":
            broken = data[:lo] + data[hi:]
        elif kind == "put":
            hi = lo
            broken = data[:lo] + rng.choice([b"\x1f\x8b\x08junk", b"WARC/1.1\r\njunk: x\r\n\r\n", b"\0" * 99]) + data[lo:]
        else:
            hi = len(data)
            broken = data[:lo]
        shift = len(broken) - len(data)
        # untouched records, where they are now
        sound = {(o, n, i) for o, n, i in places if o + n <= lo} | {(o + shift, n, i) for o, n, i in places if o >= hi and kind != "end"}
        records, gaps = salvaged(broken)
        assert sound <= {(r.offset, r.length, r.head.get("warc-record-id")) for r in records}, (kind, lo, hi)
        assert not covered(broken, records, gaps).replace(warc.EMPTY_MEMBER, b"")
        for r in records:  # nothing false: what came back was written
            assert r.head["warc-block-digest"] == "sha1:" + sha1(r.block)


def test_gap_reasons_and_bounds():
    data, places = archive(5, True)
    o, n, _ = places[2]
    wrong = warc.member(warc.record("response", "<urn:page:9:0>", None, b"abc").replace(b"abc", b"abd"))
    broken = data[:o] + wrong + data[o + n :]
    records, gaps = salvaged(broken)
    assert [(g.offset, g.length, g.reason) for g in gaps] == [(o, len(wrong), "block digest differs")]
    assert len(records) == 4
    cases = {
        b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabcde": "record longer than the file",
        b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabcdefgh": "no end mark after the block",
        b"WARC/1.1\r\nContent-Length: x\r\n\r\nabc\r\n\r\n": "no content length",
        b"WARC/1.1\r\nno colon\r\n\r\nabc\r\n\r\n": "header line without a name",
        b"WARC/1.1\r\nContent-Length: 3\r\n": "header without an end",
        b"WARC/one": "no version line",
        b"hello": "neither a member nor a version line",
        warc.member(b"x" * 1000)[:-9]: "member without an end",
        warc.member(b"x" * 1000)[:-8] + bytes(8): "member damaged",
        warc.member(b"not a record"): "no version line",
    }
    for raw, reason in cases.items():
        records, gaps = salvaged(raw)
        assert not records and [(g.offset, g.length, g.reason) for g in gaps] == [(0, len(raw), reason)], raw


def test_several_records_in_a_member_and_folded_headers():
    one = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nx: a\r\n b\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    records, gaps = salvaged(warc.member(one * 3) + one)
    assert not gaps and [r.head["x"] for r in records] == ["a b"] * 4 and records[3].block == b"hi"


def test_damaged_files_through_spark(spark, scratch):
    import os

    data, places = archive(30, True, seed=4)
    os.makedirs(scratch, exist_ok=True)
    o, n, _ = places[10]
    with open(f"{scratch}/a [1] ä.warc.gz", "wb") as f:
        f.write(data[: o + 20] + data[o + n :])
    with open(f"{scratch}/b.warc", "wb") as f:
        f.write(b"junk" + archive(4, False)[0])
    with open(f"{scratch}/empty.warc", "wb"):
        pass
    read = warc.read_archives(spark, "file:" + scratch)
    assert warc.http_records(read).count() == 29 + 4
    log = sorted((r["path"].rsplit("/", 1)[1], r["offset"], r["length"]) for r in warc.gaps(read).collect())
    assert [x[1:] for x in log] == [(o, 20), (0, 4)]
