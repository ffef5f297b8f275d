"""WARC archives, neighbours and URL lists."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from datetime import datetime, timedelta

import duckdb
import numpy as np
import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from shopmart.llm import neighbours, queries, url_lists, warc
from shopmart.llm.common import new_folder, open_folder

TINY = "/root/testdata/sf0.001"


def digest(html: str | None) -> str:
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


@pytest.fixture()
def odd_pages(llm):
    rows = [
        (3, "http://a.example/", "<p>same</p>"),
        (1, "http://b.example/x\r\nInjected: yes", "<p>same</p>"),
        (2, None, None),
        (7, "http://c.example/", ""),
        (4, "http://é.example/ü", "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\n"),
        (5, "http://d.example/", "x" * 300_000),
        (6, "http://d.example/", "x" * 300_000),
        (None, "http://e.example/", "<p>same</p>"),
    ]
    return llm.createDataFrame(rows, "page_id long, url string, html string")


def archived(llm, pages, compression: str, min_bytes: int = 0) -> str:
    warc.register(llm)
    folder = new_folder(llm, "warc")
    records = warc.to_records(pages, min_bytes)
    records.write.format("warc").mode("append").option("compression", compression).save(folder)
    return folder


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_archives_round_trip(llm, odd_pages, compression):
    folder = archived(llm, odd_pages.repartition(3), compression)
    rows = llm.read.format("warc").load(folder).collect()
    pages = {r.page_id: r for r in odd_pages.collect()}
    found = {int(x) if (x := r.record_id.rpartition(":")[2]) != "none" else None: r for r in rows}
    assert set(found) == set(pages)
    first: dict = {}
    for key in sorted(k for k in pages if k is not None):
        first.setdefault(pages[key].html or "", key)
    for key, page in pages.items():
        r, html = found[key], page.html or ""
        assert r.payload_digest == digest(html) and r.payload_bytes == len(html.encode())
        if first[html] == key:
            assert r.record_type == "response" and bytes(r.payload).decode() == html
        else:
            assert (r.record_type, r.refers_to_id, r.payload) == ("revisit", f"urn:page:{first[html]}", None)
    assert found[1].target_uri == "http://b.example/x%0D%0AInjected: yes"
    assert found[4].target_uri == "http://é.example/ü" and found[2].target_uri is None


def test_short_payloads_are_all_responses(llm, odd_pages):
    rows = llm.read.format("warc").load(archived(llm, odd_pages, "none", min_bytes=100)).collect()
    assert sorted(r.record_id for r in rows if r.record_type == "revisit") == ["urn:page:6"]


def test_pushed_filters_and_payload_modes(llm, odd_pages):
    folder = archived(llm, odd_pages, "gzip")
    read = llm.read.format("warc")
    archive = read.load(folder)
    assert archive.where("record_type = 'revisit'").count() == 4
    assert archive.where("record_type in ('response', 'revisit') and target_uri = 'http://d.example/'").count() == 2
    assert archive.where("target_uri like 'http://d%'").count() == 2
    assert archive.where("record_type = 'revisit' and record_type = 'response'").count() == 0
    reader = warc.WarcReader({"path": folder})
    left = list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit"), warc.EqualTo(("offset",), 3)]))
    assert reader.kinds == {"revisit"} and left == [warc.EqualTo(("offset",), 3)]
    for mode in ("digest", "false"):
        rows = read.option("payload", mode).load(folder).collect()
        assert all(r.payload is None and r.payload_digest and r.payload_bytes is not None for r in rows)
    with pytest.raises(ValueError, match="payload"):
        warc.WarcReader({"path": folder, "payload": "maybe"})


def test_files_are_dealt_by_size_and_damage_raises(llm, odd_pages):
    assert warc._deal({"a": 5, "b": 5, "c": 20, "d": 1}, 10) == [["a", "b"], ["c"], ["d"]]
    assert warc._deal({}, 10) == []
    empty = archived(llm, odd_pages.limit(0), "none")
    assert llm.read.format("warc").load(empty).count() == 0
    folder = archived(llm, odd_pages, "none")
    files, base = open_folder(folder)
    assert any(x.path.endswith(".warc") for x in files.get_file_info(pafs.FileSelector(base)))
    with files.open_output_stream(f"{base}/bad.warc") as out:
        out.write(b"not a record\r\n")
    with pytest.raises(Exception, match="no WARC record"):
        llm.read.format("warc").load(folder).count()


def test_a_foreign_archive_is_read(llm):
    """Folded lines, line feeds alone, no digest, a record of another type."""
    folder = new_folder(llm, "warc")
    files, base = open_folder(folder)
    files.create_dir(base, recursive=True)
    data = (
        b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
        b"WARC/1.0\nwarc-type: resource\nWARC-Target-URI: http://x/\nX-Long: a\n b\nContent-Length: 5\n\nhello\n\n"
    )
    with files.open_output_stream(f"{base}/one.warc.gz", compression=None) as out:
        out.write(gzip.compress(data))
    warc.register(llm)
    rows = llm.read.format("warc").load(folder).orderBy("offset").collect()
    assert [r.record_type for r in rows] == ["warcinfo", "resource"]
    assert bytes(rows[1].payload) == b"hello" and rows[1].headers["x-long"] == "a b"


@pytest.mark.parametrize("compression", ["none", "gzip"])
@pytest.mark.parametrize("where", ["body", "header", "end"])
def test_cut_off_archives_raise(llm, odd_pages, compression, where):
    """A record cut in its body or header, whether or not its body is wanted."""
    pages = llm.createDataFrame([(1, "http://x/", "x" * 5000 + "y" * 5000)], "page_id long, url string, html string")
    folder = archived(llm, pages, compression)
    files, base = open_folder(folder)
    (info,) = files.get_file_info(pafs.FileSelector(base))
    with files.open_input_stream(info.path, compression=None) as stream:
        data = stream.read()
    keep = {"body": len(data) - 40, "header": 60, "end": len(data) - 4 - 9 * (compression == "gzip")}[where]
    with files.open_output_stream(info.path, compression=None) as out:
        out.write(data[:keep])
    archive = llm.read.format("warc").load(folder)
    for asked in (archive, archive.where("record_type = 'revisit'")):
        with pytest.raises(Exception, match="cut off"):
            asked.count()


def test_cut_off_members_without_lengths_raise(llm, odd_pages):
    folder = archived(llm, odd_pages.where("page_id = 5"), "none")
    files, base = open_folder(folder)
    (info,) = files.get_file_info(pafs.FileSelector(base))
    with files.open_input_stream(info.path) as stream:
        data = gzip.compress(stream.read())
    with files.open_output_stream(f"{info.path}.gz", compression=None) as out:
        out.write(data[:-60])
    files.delete_file(info.path)
    with pytest.raises(Exception, match="cut off"):
        llm.read.format("warc").load(folder).count()


def test_a_payload_that_differs_from_its_digest_raises(llm, odd_pages):
    folder = archived(llm, odd_pages, "none")
    files, base = open_folder(folder)
    for info in files.get_file_info(pafs.FileSelector(base)):
        with files.open_input_stream(info.path) as stream:
            data = stream.read()
        with files.open_output_stream(info.path) as out:
            out.write(data.replace(b"<p>same</p>", b"<p>SAME</p>"))
    read = llm.read.format("warc")
    with pytest.raises(Exception, match="differs from its digest"):
        read.load(folder).count()
    assert read.option("verify", "false").load(folder).count() == odd_pages.count()


def test_unwanted_members_are_not_inflated():
    """The reader goes from member to member by their lengths."""
    bodies = [warc.record_bytes(f"urn:page:{k}", kind, "http://x/", "urn:page:0", b"<p>" * 20_000)
              for k, kind in enumerate(["response", "revisit", "response"])]
    data = b"".join(map(warc.member_bytes, bodies))
    assert gzip.decompress(data) == b"".join(bodies)
    at = 0
    for body in bodies:
        length = warc.member_length(data[at : at + 64])
        assert gzip.decompress(data[at : at + length]) == body
        at += length
    assert at == len(data) and warc.member_length(gzip.compress(b"x")) is None
    damaged = bytearray(data)
    first = warc.member_length(data[:64])
    damaged[first // 2 : first - 20] = b"\0" * (first - 20 - first // 2)  # the body of the first member
    reader = warc.WarcReader({"path": "file:///nowhere"})
    reader.kinds = {"revisit"}
    rows = list(reader._members(io.BufferedReader(io.BytesIO(bytes(damaged))), "a.warc.gz", len(damaged)))
    assert [r[0] for r in rows] == ["urn:page:1"] and rows[0][-1] == first


def brute_neighbours(rows: list, k: int = 10) -> dict:
    good = [(i, np.array(v, float)) for i, v in rows if v and None not in v]
    good = [(i, v) for i, v in good if np.isfinite(v).all() and v.any()]
    out = {}
    for name, q in good:
        if name % 100 == 0:
            near = sorted((float(np.sqrt(((v - q) ** 2).sum())), i) for i, v in good if i != name)
            out[name] = near[:k]
    return out


def test_neighbours_recall_and_scores(llm):
    vectors = llm.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    expected = brute_neighbours(rows)
    found: dict = {}
    for r in neighbours.search(vectors, lambda i: i % 100 == 0, leaf_rows=150).collect():
        found.setdefault(r.query_id, []).append(r)
    assert set(found) == set(expected)
    hits = 0
    for name, near in expected.items():
        own = sorted(found[name], key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in own] == sorted((r.score, r.vec_id) for r in own)
        score_of = dict((i, s) for s, i in near)
        hits += sum(r.vec_id in score_of for r in own)
        assert all(abs(r.score - score_of[r.vec_id]) < 1e-12 for r in own if r.vec_id in score_of)
    assert hits / (10 * len(expected)) >= 0.9


def test_neighbours_of_odd_vectors(llm):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (1, [1.0, 0.5]), (2, [1.0, -0.5]), (3, None), (4, [nan, 1.0]),
            (5, [0.0, 0.0]), (6, [inf, 1.0]), (7, [1.0, None]), (8, [1.0]), (9, [])]
    vectors = llm.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = neighbours.search(vectors, lambda i: i % 100 == 0).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in found] == [
        (0, 1, 100, 0.0), (0, 2, 1, 0.5), (0, 3, 2, 0.5), (100, 1, 0, 0.0), (100, 2, 1, 0.5), (100, 3, 2, 0.5),
    ]
    assert neighbours.search(vectors.limit(0), lambda i: i % 100 == 0).count() == 0


@pytest.mark.parametrize("queries_a_block", [1024, 1])
def test_neighbours_in_a_hot_leaf(llm, monkeypatch, queries_a_block):
    """A third of all vectors are equal; leaves are cut into blocks, and so are their queries."""
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", queries_a_block)
    rng = np.random.default_rng(5)
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else rng.normal(size=3).tolist()) for i in range(600)]
    vectors = llm.createDataFrame(rows, "vec_id long, embedding array<double>")
    expected = brute_neighbours(rows)
    found: dict = {}
    for r in neighbours.search(vectors, lambda i: i % 100 == 0, leaf_rows=20).collect():
        found.setdefault(r.query_id, []).append((r.score, r.vec_id))
    hits = sum(len(set(found[q]) & set(near)) for q, near in expected.items())
    assert hits >= 0.9 * 10 * len(expected)
    assert sorted(found[0]) == expected[0]


def test_chi_square():
    assert abs(float(neighbours.chi_square(np.array(15.507))) - 0.95) < 1e-4
    assert abs(float(neighbours.chi_square(np.array(neighbours.REACH**2))) - neighbours.SURE) < 1e-6


def test_url_lists_equal_sql(llm):
    rows = queries.op8_url_lists(llm, TINY).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{TINY}/pages.parquet'")
    expected = con.execute(f"SELECT page_id, fetched_s, lists, is_blocked FROM ({queries.OP8_SQL})").fetchall()
    assert sorted(tuple(r) for r in rows) == sorted(expected)


def test_keys_of_addresses(llm):
    urls = ["HTTP://user@WWW.Example.COM:80/a/b/?q#f", "https://localhost", "mailto:x@y", None, "", "http://x.y."]
    df = llm.createDataFrame([(u,) for u in urls], "u string").select(url_lists.keys(F.col("u")).alias("k"))
    assert [r.k for r in df.collect()] == [
        ["domain:www.example.com", "domain:example.com", "page:www.example.com/a/b"],
        ["domain:localhost", "page:localhost"], [], [], [], ["domain:x.y", "page:x.y"],
    ]


def brute_lists(captures: list, entries: list) -> dict:
    out = {}
    for key, host, at in captures:
        found = set()
        for name, of in {(e[0], e[1]) for e in entries if None not in e}:
            if at is None or of != f"domain:{host}":
                continue
            before = [(e[2], not e[3]) for e in entries if None not in e and e[:2] == (name, of) and e[2] <= at]
            if before and not max(before)[1]:
                found.add(name)
        out[key] = sorted(found)
    return out


def test_lists_as_of_the_fetch(llm):
    start = datetime(2024, 1, 1)
    rng = np.random.default_rng(2)
    hosts = ["hot.example"] * 6 + ["b.example", "c.example"]
    entries = [
        (f"l{rng.integers(0, 3)}", f"domain:{rng.choice(hosts)}", start + timedelta(hours=int(rng.integers(0, 300))), bool(rng.integers(0, 2)))
        for _ in range(120)
    ]
    entries += [entries[0], (None, "domain:b.example", start, True), ("l1", None, start, True), ("l2", "domain:b.example", None, True)]
    captures = [(k, str(rng.choice(hosts)), start + timedelta(hours=int(rng.integers(0, 400)))) for k in range(150)]
    captures += [(900, "hot.example", None), (901, "none.example", start)]
    found = url_lists.filter_captures(
        llm.createDataFrame([(k, f"http://{h}/", t, "own") for k, h, t in captures], "page_id long, url string, fetched_at timestamp, day string"),
        llm.createDataFrame(entries, "list string, key string, at timestamp, is_listed boolean"),
    )
    assert found.columns == ["page_id", "url", "fetched_at", "day", "lists", "is_blocked"]
    rows = found.collect()
    assert {r.page_id: r.lists for r in rows} == brute_lists(captures, entries)
    assert all(r.is_blocked == bool(r.lists) for r in rows)


def test_intervals_and_empty_lists(llm):
    days = [datetime(2024, 1, d) for d in range(1, 6)]
    rows = [("l", "k", days[0], True), ("l", "k", days[1], False), ("l", "k", days[2], True), ("l", "k", days[2], False), ("l", "k", days[3], True)]
    entries = llm.createDataFrame(rows, "list string, key string, at timestamp, is_listed boolean")
    found = url_lists.intervals(entries).orderBy("valid_from").collect()
    assert [(r.valid_from.day, r.valid_to and r.valid_to.day) for r in found] == [(1, 2), (4, None)]
    captures = llm.createDataFrame([(1, "http://x.y/", days[0])], "page_id long, url string, fetched_at timestamp")
    listed = entries.withColumn("key", F.lit("domain:x.y"))
    names = ("lists", "is_blocked", "key", "list", "at", "id", "interval", "range", "found", "own", "valid_to")
    clash = captures.withColumns({c: F.lit("own") for c in names})
    (row,) = url_lists.filter_captures(clash, listed).collect()
    assert row.lists == ["l"] and row.is_blocked and row.key == row.id == row["range"] == "own"
    repeated = captures.union(captures).unionByName(captures.withColumn("page_id", F.lit(None).cast("long")))
    assert [r.lists for r in url_lists.filter_captures(repeated, listed).collect()] == [["l"]] * 3
    assert [r.is_blocked for r in url_lists.filter_captures(captures, entries.limit(0)).collect()] == [False]
    assert url_lists.filter_captures(captures.limit(0), entries).count() == 0
