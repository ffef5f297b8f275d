"""Fingerprints and near-duplicates against brute force."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from shopmart.llm import fingerprints, simhash
from shopmart.llm.components import components


def shingles(text: str, n: int) -> set:
    words = text.split()
    return {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


def jaccard(a: str, b: str) -> float:
    x, y = shingles(a, 5), shingles(b, 5)
    return len(x & y) / len(x | y) if x | y else 1.0


def test_edited_texts_and_likeness(tiny_docs):
    docs = sorted(tiny_docs.select("doc_id", "text").collect())
    rows = {
        r.doc_id: r
        for r in fingerprints.edited(tiny_docs.repartition(5))
        .withColumn("other", fingerprints.minhash(F.col("edited")))
        .withColumn("near_edited", fingerprints.likeness(F.col("fingerprint"), F.col("other")))
        .withColumn("near_next", fingerprints.likeness(F.col("fingerprint"), F.col("next_fingerprint")))
        .collect()
    }
    assert len(rows) == len(docs)
    errors = []
    for k, (key, text) in enumerate(docs):
        after = docs[(k + 1) % len(docs)].text
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        assert rows[key].edited == edited and rows[key].n_chars == len(text)
        errors.append(rows[key].near_edited - jaccard(text, edited))
        errors.append(rows[key].near_next - jaccard(text, after))
    assert np.sqrt(np.mean(np.square(errors))) < 0.04 and np.max(np.abs(errors)) < 0.17


def test_fingerprint_edge_cases(llm, odd_docs, no_docs):
    rows = odd_docs.select("doc_id", fingerprints.minhash(F.col("text")).alias("f")).collect()
    of = {r.doc_id: list(r.f) for r in rows}
    assert of[1] == of[2] == of[3] == [0] * 16
    assert of[4] != of[5] and len(of[6]) == 16
    assert all(list(r.f) == of[r.doc_id] for r in rows)
    pairs = llm.createDataFrame([(of[1], of[2]), (of[1], of[4]), (of[4], of[4]), (of[4], of[5])], "a array<long>, b array<long>")
    near = [r[0] for r in pairs.select(fingerprints.likeness(F.col("a"), F.col("b"))).collect()]
    assert near[:3] == [1.0, 0.0, 1.0] and near[3] < 0.2
    assert fingerprints.edited(no_docs).count() == 0
    found = fingerprints.edited(odd_docs).collect()
    assert len(found) == odd_docs.count()
    after_last = [r for r in found if r.doc_id == 7]
    assert after_last[0].edited.endswith("no id here"[: len(after_last[0].text) // 4])


def test_fingerprint_plan_is_native(tiny_docs):
    plan = tiny_docs.select(fingerprints.minhash(F.col("text")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def brute_fingerprint(text: str | None) -> int:
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    parts = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids: list, fps: list[int]) -> dict:
    root = list(range(len(fps)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                root[find(a)] = find(b)
    groups: dict = {}
    for k in range(len(fps)):
        groups.setdefault(find(k), []).append(ids[k])
    return {i: min((x for x in g if x is not None), default=None) for g in groups.values() for i in g}


def test_simhash_equals_brute_force(tiny_docs):
    docs = tiny_docs.select("doc_id", "text").collect()
    fps = [brute_fingerprint(r.text) for r in docs]
    expected = brute_components([r.doc_id for r in docs], fps)
    rows = simhash.near_components(tiny_docs.repartition(3)).collect()
    assert {r.doc_id: r.component_id for r in rows} == expected
    assert {r.doc_id: r.fp % (1 << 64) for r in rows} == dict(zip((r.doc_id for r in docs), fps, strict=True))


def test_simhash_of_odd_rows(odd_docs, no_docs):
    rows = simhash.near_components(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    of = {r.doc_id: r for r in rows}
    assert of[1].fp == of[2].fp == of[3].fp == 0 and of[3].component_id == 1
    assert of[None].component_id is None and of[5].component_id == 5
    assert simhash.near_components(no_docs).count() == 0
    kept = simhash.deduplicate(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 4, 5, 6, 7]
    assert kept.where("doc_id is null").count() == 1


def test_rows_are_told_apart_by_id_and_text(llm):
    words = " ".join(f"w{k}" for k in range(200))
    other = " ".join(f"v{k}" for k in range(200))
    rows = [
        (3, words, "copy"), (2, words, "kept"), (2, other, "kept, another text with the id"), (2, words, "kept twice"),
        (5, other, "copy"), (None, words, "copy"), (None, "alone " * 50, "no id"), (7, "", "empty"), (8, None, "empty"),
    ]
    docs = llm.createDataFrame(rows, "doc_id long, text string, key string")
    found = sorted((r.doc_id is not None, r.doc_id or 0, r.text or "") for r in simhash.deduplicate(docs).collect())
    assert found == [(False, 0, "alone " * 50), (True, 2, other), (True, 2, words), (True, 7, "")]


@pytest.mark.parametrize("n", [300, 3000])
def test_links_find_every_component(llm, n):
    """Clusters around centres, chains, and a group far larger than is compared at once."""
    rng = np.random.default_rng(n)
    centres = rng.integers(0, 1 << 63, 12, np.uint64)
    fps = set(rng.integers(0, 1 << 63, 200, np.uint64).tolist())
    for _ in range(n):
        x = int(centres[min(11, rng.integers(0, 40))])
        for bit in rng.integers(0, 64, rng.integers(0, 5)):
            x ^= 1 << int(bit)
        fps.add(x)
    chain = int(centres[0]) ^ 0xFFFF
    for bit in range(0, 60, 2):
        chain ^= 3 << bit
        fps.add(chain)
    values = sorted(np.array(sorted(fps), np.uint64).view(np.int64).tolist())
    table = llm.createDataFrame([(v,) for v in values], "fp long")
    roots = {r.node: r.root for r in components(simhash.links(table)).collect()}
    array = np.array(values, np.int64).view(np.uint64)
    root = np.arange(len(array))

    def find(k):
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for a in range(len(array)):
        for b in np.flatnonzero(np.bitwise_count(array[:a] ^ array[a]) <= 2).tolist():
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    expected = {values[k]: values[find(k)] for k in range(len(array))}
    assert {v: roots.get(v, v) for v in values} == expected


def test_components_of_a_long_path(llm):
    links = llm.range(0, 200).selectExpr("(id * 37) % 201 as u", "((id + 1) * 37) % 201 as v")
    found = components(links.union(links)).collect()
    assert len(found) == 200 and {r.root for r in found} == {0}
    assert components(llm.createDataFrame([], "u long, v long")).count() == 0


def test_edited_digest(tiny_docs):
    row = fingerprints.edited(tiny_docs).select(F.sha2(F.col("edited").cast("binary"), 256).alias("s"), "edited").first()
    assert row.s == hashlib.sha256(row.edited.encode()).hexdigest()
