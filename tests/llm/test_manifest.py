"""The manifest against its SQL and a tree built by hand."""

from __future__ import annotations

import random
from hashlib import sha256

import duckdb
import pytest
from oracle_check import duck_rows, spark_rows
from pyspark.sql import functions as F

from shopmart.llm import manifest, queries

TINY = "/root/testdata/sf0.001"


def h(text: str) -> str:
    return sha256(text.encode("utf-8")).hexdigest()


def leaf(row) -> str:
    fields = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row]
    return h("".join(fields))


def tree(hashes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root, and of each leaf its path of (hashes before, hashes behind)."""
    paths = [[] for _ in hashes]
    level = [(x, [k]) for k, x in enumerate(hashes)]
    while len(level) > 1:
        above = []
        for a in range(0, len(level), 16):
            run = level[a : a + 16]
            for k, (_, own) in enumerate(run):
                sides = ("".join(x for x, _ in run[:k]), "".join(x for x, _ in run[k + 1 :]))
                for i in own:
                    paths[i].append(sides)
            above.append((h("".join(x for x, _ in run)), [i for _, own in run for i in own]))
        level = above
    return level[0][0], paths


def brute(rows: list[tuple], tampered) -> list[tuple]:
    """``rows``: doc_id, source, lang, n_chars, text."""
    groups: dict = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for own in groups.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {s: tree([leaf(r) for r in groups[s]]) for s in order}
    root, top = tree([trees[s][0] for s in order])
    out = []
    for s, above in zip(order, top, strict=True):
        for row, path in zip(groups[s], trees[s][1], strict=True):
            text = row[4]
            if text is not None and tampered(row):
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            folded = leaf((*row[:4], text))
            for left, right in path + above:
                folded = h(left + folded + right)
            proof = h("".join(a + b for a, b in path + above))
            out.append((row[0], leaf(row), trees[s][0], root, proof, folded, folded == root))
    return out


def check(spark, rows, shuffles=None):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    docs = spark.createDataFrame(rows, schema)
    if shuffles:
        docs = docs.repartition(shuffles)
    tampered = F.coalesce(F.col("doc_id"), F.lit(1)) % 3 == 0
    found = manifest.verified_manifest(docs, tampered)
    assert found.columns == [
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    ]
    key = lambda r: [str(x) for x in r]
    expected = brute(rows, lambda r: (1 if r[0] is None else r[0]) % 3 == 0)
    assert sorted((tuple(r) for r in found.collect()), key=key) == sorted(expected, key=key)


def test_query_equals_sql(llm):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{TINY}/documents.parquet'")
    expected = duck_rows(con, queries.oracle_sql()["op13_manifest"])
    found = spark_rows(queries.op13_manifest(llm, TINY))
    assert found == expected
    verified = [dict(zip(found[0], r, strict=True))["verified"] for r in found[1]]
    assert len(set(verified)) == 2


@pytest.mark.parametrize("sizes", [(1,), (16,), (17,), (1, 1), (300, 2, 16, 33, 257), (4100, 1)])
def test_trees_of_all_shapes(llm, sizes):
    rng = random.Random(sum(sizes))
    ids = rng.sample(range(100_000), sum(sizes))
    rows = [
        (ids.pop(), f"s{k}", "en", n, f"Text {n} of {k}" if n % 2 else f"text {n}")
        for k, size in enumerate(sizes)
        for n in range(size)
    ]
    check(llm, rows, shuffles=5)


def test_many_groups(llm):
    check(llm, [(k, f"source {k % 290}", None, k, f"T{k}") for k in range(600)])


def test_odd_rows(llm, odd_docs, no_docs):
    rows = [
        (5, None, None, None, None), (None, None, "x", 3, "No Id"), (5, "a", "b", 1, "Twice"),
        (5, "a", "b", 1, "Twice"), (5, "a", "b", 1, "Other"), (6, "", "", 0, ""), (7, "é", "b", 1, "Ünï A"),
        (3, "z", "b", 1, "X" * 400_000), (9, "Z", "1:a", -4, "-"), (12, "\U0001f642", "b", 1, "3:"),
    ]
    check(llm, rows)
    empty = no_docs.withColumn("n_chars", F.lit(1).cast("long"))
    assert manifest.verified_manifest(empty, F.lit(True)).count() == 0
    columns = ["doc_id", "text", "id", "n"]
    found = manifest.verified_manifest(odd_docs, F.lit(False), columns, group_col="id")
    assert found.count() == odd_docs.count()
    assert found.where("not verified").count() == 0
    clash = odd_docs.withColumns({c: F.lit(1) for c in ("g", "lo", "hi", "total", "range", "hash", "path")})
    again = manifest.verified_manifest(clash, F.lit(False), columns, group_col="id")
    assert sorted(r.leaf for r in again.collect()) == sorted(r.leaf for r in found.collect())
