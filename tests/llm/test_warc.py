"""Archives: exact round trip, and recovery around damage."""

import base64
import gzip
import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from glyphmill.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, payload string, refers_to long, kind string"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "d", "p", 0, "k") for r in rows], SCHEMA)


def read_back(spark, rows, tmp_path, **options):
    path = str(tmp_path / "archives")
    warc.write_archives(pages_of(spark, rows), path, **options)
    return warc.read_archives(spark, path)


def brute(rows, least=0):
    first = {}
    for page, _, html in rows:
        body = (html or "").encode()
        if page is not None and len(body) >= least:
            first[body] = min(first.get(body, page), page)
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        refers = first.get(body) if page is not None else None
        refers = None if refers == page else refers
        out.append((page, len(body), digest, "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


ROWS = [
    (1, "http://a/1", "<p>é 😀</p>"),
    (2, None, None),
    (3, "http://a/\r\nx", ""),
    (4, "http://a/4", "<p>é 😀</p>"),
    (4, "http://a/4", "<p>é 😀</p>"),
    (-1, "http://a/5", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
    (None, "http://a/6", "<p>é 😀</p>"),
    (7, "http://a/7", "x" * 300_000),
    (8, "http://a/8", "\r\n\r\n\x00\x1f"),
]


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, tmp_path, least):
    back = read_back(spark, ROWS, tmp_path, least_bytes=least)
    rows = back.collect()
    assert all(r["kind"] == "record" for r in rows)
    found = back.select(
        warc.page_number(back["record_id"]), "payload_bytes", "payload_digest", "record_type",
        warc.page_number(back["refers_to"]),
    ).collect()
    assert sorted(map(tuple, found), key=repr) == brute(ROWS, least)
    bodies = {r["record_id"]: bytes(r["payload"]) for r in rows if r["record_type"] == "response"}
    assert bodies["<urn:page:7>"] == b"x" * 300_000 and bodies["<urn:page:8>"] == b"\r\n\r\n\x00\x1f"


def test_many_copies_refer_to_the_least(spark, tmp_path):
    rows = [(i, f"http://a/{i}", "same") for i in range(500, 0, -1)]
    found = read_back(spark, rows, tmp_path).groupBy("record_type", "refers_to").count().collect()
    assert {(r["record_type"], r["refers_to"], r["count"]) for r in found} == {
        ("response", None, 1),
        ("revisit", "<urn:page:1>", 499),
    }


def test_no_pages(spark, tmp_path):
    assert read_back(spark, [], tmp_path).count() == 0


def records(n, seed=0):
    rng = random.Random(seed)
    bodies = [bytes(rng.choices(range(256), k=rng.randint(0, 400))) for _ in range(n)]
    return [warc.record_bytes(i, f"http://a/{i}", body, None, "d") for i, body in enumerate(bodies)]


def numbers(items):
    return [int(i[3]["warc-record-id"][10:-1]) for i in items if i[0] == "record"]


@pytest.mark.parametrize("pack", [gzip.compress, bytes, warc.member])
def test_salvage_recovers_records_after_damage(pack):
    parts = [pack(r) for r in records(8)]
    whole = b"".join(parts)
    assert numbers(warc.salvage(whole)) == list(range(8))
    at = [sum(map(len, parts[:i])) for i in range(9)]
    damaged = bytearray(whole)
    damaged[at[3] + 20 : at[3] + 60] = b"\x00" * 40
    items = list(warc.salvage(bytes(damaged)))
    assert numbers(items) == [0, 1, 2, 4, 5, 6, 7]
    gaps = [i for i in items if i[0] == "gap"]
    assert [(g[1], g[2]) for g in gaps] == [(at[3], at[4])]
    cut = list(warc.salvage(whole[: at[7] + 30]))
    assert numbers(cut) == list(range(7)) and cut[-1][:3] == ("gap", at[7], at[7] + 30)


def test_salvage_skips_leading_garbage_and_changed_payload():
    one, two = records(2, seed=4)
    assert numbers(warc.salvage(b"garbage\n" + one + two)) == [0, 1]
    changed = bytearray(one + two)
    changed[one.index(b"\r\n\r\nHTTP") + 8] ^= 1  # same length, other content
    items = list(warc.salvage(bytes(changed)))
    assert numbers(items) == [1] and items[0][:3] == ("gap", 0, len(one))
    assert "digest" in items[0][3]
    assert list(warc.salvage(b"")) == [] and list(warc.salvage(b"junk")) == [("gap", 0, 4, "no version line")]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3000), st.integers(0, 255)), max_size=6), st.booleans())
def test_salvage_covers_every_byte(changes, packed):
    data = bytearray(b"".join(gzip.compress(r) if packed else r for r in records(6, seed=1)))
    for place, value in changes:
        data[place % len(data)] = value
    at = 0
    for item in warc.salvage(bytes(data)):
        assert item[1] >= 0 and item[2] <= len(data)
        if item[2] > item[1]:
            assert item[1] == at
            at = item[2]
    assert at == len(data)


def test_archives_with_damage_in_spark(spark, tmp_path):
    parts = [warc.member(r) for r in records(4)]
    data = parts[0] + b"\x1f\x8b\x08broken" + parts[1] + parts[2][:-5] + parts[3]
    (tmp_path / "x.warc.gz").write_bytes(data)
    rows = warc.read_archives(spark, str(tmp_path)).orderBy("start").collect()
    assert [r["kind"] for r in rows] == ["record", "gap", "record", "gap", "record"]
    assert rows[1]["start"] == len(parts[0]) and rows[1]["end"] == len(parts[0]) + 9


def test_a_very_long_url_is_kept(spark, tmp_path):
    url = "http://a/" + "x" * 200_000
    rows = read_back(spark, [(1, url, "body"), (2, url + "\x01", "other"), (3, "http://a/3", "third")], tmp_path).collect()
    assert sorted((r["kind"], r["record_id"], r["target_uri"]) for r in rows) == [
        ("record", "<urn:page:1>", url), ("record", "<urn:page:2>", url + "%01"), ("record", "<urn:page:3>", "http://a/3"),
    ]
    one, two = (warc.record_bytes(i, url, b"body", None, "d") for i in range(2))
    assert numbers(warc.salvage(one + two)) == [0, 1]
    assert numbers(warc.salvage(one[:100_000] + b"\n" + two)) == [1]


def test_salvage_inside_members_of_many_records():
    parts = records(12, seed=5)
    at = [sum(map(len, parts[:i])) for i in range(13)]
    # a bad record in the middle of a sound member
    bad = bytearray(b"".join(parts))
    bad[at[4] : at[4] + 60] = b"\x00" * 60
    one = gzip.compress(bytes(bad))
    items = list(warc.salvage(one + gzip.compress(parts[0])))
    assert numbers(items) == [0, 1, 2, 3, 5, 6, 7, 8, 9, 10, 11, 0]
    gaps = [i for i in items if i[0] == "gap"]
    assert [g[1:3] for g in gaps] == [(0, len(one))] and f"bytes {at[4]} to {at[5]}" in gaps[0][3]
    # a cut end, a wrong checksum, and a member stored as it is, whose lines are not read twice
    whole = gzip.compress(b"".join(parts))
    cut = list(warc.salvage(whole[: len(whole) // 2]))
    assert len(numbers(cut)) >= 4 and numbers(cut) == list(range(len(numbers(cut))))
    assert cut[-1][:3] == ("gap", 0, len(whole) // 2)
    for level in (0, 6):
        wrong = bytearray(gzip.compress(b"".join(parts), level))
        wrong[-8] ^= 1
        items = list(warc.salvage(bytes(wrong) + gzip.compress(parts[3])))
        assert numbers(items) == [*range(12), 3]
        assert [i[1:3] for i in items if i[0] == "gap"] == [(0, len(wrong))]


def test_salvage_finds_older_version_lines():
    parts = [r.replace(b"WARC/1.1", b"WARC/0.9", 1) for r in records(3, seed=6)]
    assert numbers(warc.salvage(parts[0] + b"garbage\n" + parts[1] + parts[2])) == [0, 1, 2]


def test_archives_are_cut_by_bytes(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, f"http://a/{i}", "".join(rng.choices("abcdefgh ", k=rng.choice([10, 5000, 60_000])))) for i in range(120)]
    back = read_back(spark, rows, tmp_path, file_bytes=20_000)
    found = back.select(
        warc.page_number(back["record_id"]), "payload_bytes", "payload_digest", "record_type",
        warc.page_number(back["refers_to"]),
    ).collect()
    assert sorted(map(tuple, found), key=repr) == brute(rows)
    sizes = [f.stat().st_size for f in (tmp_path / "archives").rglob("part-*")]
    largest = max(len(warc.member(warc.record_bytes(i, url, html.encode(), None, "1970-01-01T00:00:00Z"))) for i, url, html in rows)
    assert len(sizes) > 20 and max(sizes) <= 20_000 + largest


def test_a_hot_payload_among_others(spark, tmp_path):
    rows = [(i, None, None if i % 3 == 0 else f"page {i // 2}") for i in range(1500)]
    back = read_back(spark, rows, tmp_path)
    found = back.select(
        warc.page_number(back["record_id"]), "payload_bytes", "payload_digest", "record_type",
        warc.page_number(back["refers_to"]),
    ).collect()
    assert sorted(map(tuple, found), key=repr) == brute(rows)
