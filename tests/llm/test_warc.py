"""WARC archives: format, round trip, revisits; marks by position."""

import base64
import glob
import hashlib

import pytest
import zstandard
from conftest import SF_SMALL
from pyspark.sql import functions as F

from streamlake.llm import marks, warc

SCHEMA = "page_id long, url string, html string, file string, at string, row string, `to` string, _metadata string"
PAGES = [(1, "http://a.org/x", "<p>same</p>"), (5, "http://b.org/y z\r\nEvil: 1", "<p>same</p>"), (3, None, "<p>same</p>"),
         (5, "http://c.org", "<p>same</p>"), (7, "http://d.org", None), (8, "http://e.org", ""), (None, "http://f.org", ""),
         (None, None, None), (9, "", "x" * 3_000_000), (10, "http://é.org/ü", "Ünï\r\n\r\ncode \U0001F600 \x00 WARC/1.1\r\n"),
         (11, "u", "\r\n\r\n"), (-4, "u", "only once")]


def frame(ctx, rows):
    return ctx.createDataFrame([(*r, *["clash"] * 5) for r in rows], SCHEMA)


def brute(rows, least=0):
    groups = {}
    for k, (i, _, h) in enumerate(rows):
        groups.setdefault(h or "", []).append((i is not None, i or 0, k))
    out = []
    for text, own in groups.items():
        raw = text.encode()
        top = max(own)
        for has, i, k in own:
            first = (has, i, k) == top or len(raw) < least
            out.append((i if has else None, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                        "response" if first else "revisit", None if first or not top[0] else top[1]))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 1, 12])
def test_pages_read_back(ctx, least):
    got = warc.archived(frame(ctx, PAGES).repartition(3), least).collect()
    assert all(r["intact"] for r in got)
    assert sorted((tuple(r)[:5] for r in got), key=str) == brute(PAGES, least)


def test_no_pages(ctx):
    empty = warc.archived(frame(ctx, []))
    assert empty.collect() == [] and empty.columns[:2] == ["page_id", "payload_bytes"]


def test_archives_on_disk(ctx, tmp_path):
    pages = ctx.read.parquet(f"{SF_SMALL}/pages.parquet")
    folder, listed = warc.write(pages, str(tmp_path / "warc"), archive_bytes=100_000)
    rows = listed.collect()
    files = sorted(glob.glob(f"{folder}/*"))
    assert sorted(r["path"] for r in rows) == [f.rsplit("/", 1)[1] for f in files] and len(files) > 1
    assert sum(r["records"] for r in rows) == pages.count()
    assert all(r["dictionary_bytes"] > 0 for r in rows if r["records"] > 50)
    plain = 0
    for f in files:
        data = open(f, "rb").read()
        if data[:4] == b"\x5d\x2a\x4d\x18":  # a plain zstd reader takes the stream with the dictionary it starts with
            size = int.from_bytes(data[4:8], "little")
            fitted = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompressobj().decompress(data[8:8 + size]))
            whole = zstandard.ZstdDecompressor(dict_data=fitted).stream_reader(
                data[8 + size:], read_across_frames=True).read()
            assert whole == b"".join(text for _, _, text in warc.frames(data))
        plain += sum(len(zstandard.ZstdCompressor(level=warc.LEVEL).compress(t)) for _, _, t in warc.frames(data))
        for at, n, text in warc.frames(data):
            assert text.startswith(b"WARC/1.1\r\nWARC-Type: ")
    assert sum(r["bytes"] for r in rows) < plain  # the dictionaries pay for themselves
    back = warc.read(ctx, folder)
    assert back.filter("not intact").isEmpty()
    texts = {r["id"]: bytes(r["payload"]) for r in back.filter("payload is not null").collect()}
    ids = {r["record_id"]: r["id"] for r in back.collect()}
    want = {r["page_id"]: (r["html"] or "").encode() for r in pages.collect()}
    assert all(want[i] == t for i, t in texts.items())
    for r in back.filter("record_type = 'revisit'").collect():
        assert ids[r["refers_to"]] == r["refers_to_id"] and texts[r["refers_to_id"]] == want[r["id"]]


def test_a_task_that_runs_again_replaces_its_files(ctx, tmp_path):
    pages = frame(ctx, PAGES).coalesce(1)
    folder, first = warc.write(pages, str(tmp_path / "warc"))
    _, second = warc.write(pages, folder)
    assert len(glob.glob(f"{folder}/*")) == first.count() == second.count()


def test_a_damaged_archive_raises():
    data = warc.archive([warc.record([("WARC-Type", "response")], b"x" * 100)])
    with pytest.raises(ValueError):
        list(warc.frames(data[:-9]))
    assert [warc.parse(t)[1] for _, _, t in warc.frames(data)] == [b"x" * 100]


# marks by position

def test_marks_follow_rows(ctx, monkeypatch):
    monkeypatch.setattr(marks, "SEGMENT_BITS", 3)
    docs = ctx.range(200).select("id", F.lit("a").alias("file"), F.lit("b").alias("at")).repartition(3)
    docs = marks.scan(docs)
    assert marks.scan(docs.filter("id > 3").select("id")) is not docs
    at = marks.placed(docs).select("file", "at", "row.id")
    saved = marks.save(at.filter("id % 3 = 0").select("file", "at", (F.col("id") * 2).alias("twice")), "m")
    got = marks.placed(docs).withColumn("m", saved.of(F.col("file"), F.col("at"))).select("row.id", "m.twice").collect()
    assert sorted(map(tuple, got), key=lambda r: r[0]) == [(k, 2 * k if k % 3 == 0 else None) for k in range(200)]
    assert sorted(r["id"] for r in marks.without(docs, at.filter("id < 190"), "m").collect()) == list(range(190, 200))
    assert marks.only(docs, at.limit(0), "m").count() == 0
    plan = marks.without(docs, at, "m")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_rows_that_a_plan_repeats_are_written_first(ctx):
    docs = marks.scan(ctx.range(5).repartition(1))
    twice = docs.union(docs)
    assert marks.scan(twice) is not twice and marks.scan(docs) is docs
    narrow = docs.filter("id > 1")
    assert marks.scan(narrow) is narrow
