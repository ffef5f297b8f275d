"""License scans against their SQL and brute force."""

from __future__ import annotations

import random
import re

import duckdb
import pytest
from oracle_check import duck_rows, spark_rows

from shopmart.llm import license_scan as scan
from shopmart.llm import oracle_sql, queries

TINY = "/root/testdata/sf0.001"


def words(text: str) -> list[str]:
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(text: str | None, templates, containment: float) -> tuple:
    w = words(text or "")
    starts, base, labels, score = [], set(), set(), 0.0
    for phrase, label in scan.PHRASES.items():
        p = phrase.split()
        own = [i for i in range(len(w)) if w[i : i + len(p)] == p]
        starts += own
        base |= {label} if own else set()
    for label, notice in templates:
        t = words(notice)
        s = 8
        while s < len(t):
            s *= 2
        for at in range(0, len(w), s):
            share = len(set(t) & set(w[at : at + 2 * s])) / len(set(t))
            if share >= containment - 1e-9:
                labels.add(label)
                score = max(score, share)
    ends = (min(starts), max(starts)) if starts else (None, None)
    return (
        len(w), len(starts), *ends, ",".join(sorted(base)), ",".join(sorted(base | labels)),
        1.0 if starts else score,
    )


def as_tuple(row) -> tuple:
    return tuple(row)[1:6] + (row.labels, row.score)


def test_query_equals_sql(llm):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{TINY}/documents.parquet'")
    assert spark_rows(queries.op12_licenses(llm, TINY)) == duck_rows(con, queries.oracle_sql()["op12_licenses"])


def test_main_path_has_no_python(llm):
    plan = queries.op12_licenses(llm, TINY)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


@pytest.mark.parametrize("containment", [0.9, 0.6])
def test_passages_at_any_place(llm, containment):
    """Notices whole, with words lost or put between, across block limits, and texts of template words alone."""
    rng = random.Random(5)
    filler = [f"f{k}" for k in range(300)] + ["the", "of", "to", "this"]
    texts = []
    for _, notice in scan.TEMPLATES:
        for lost in (0, 1, 3):
            body = words(notice)
            for _ in range(lost):
                body.pop(rng.randrange(len(body)))
            before = [rng.choice(filler) for _ in range(rng.randrange(0, 150))]
            texts.append(" ".join([*before, *body, *(rng.choice(filler) for _ in range(rng.randrange(40)))]))
    vocabulary = sorted({w for _, t in scan.TEMPLATES for w in words(t)})
    for n in (5, 60, 700):
        texts.append(" ".join(rng.choice(vocabulary) for _ in range(n)))
    texts += ["cc by nc cc by nc", "Under The MIT License", "under the mit licenses", "CC-BY-NC/cc by\nnc", "Kİ cc by nc é"]
    rows = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = scan.scan(rows, containment=containment)
    matched = 0
    for row in found.collect():
        expected = brute(texts[row.doc_id], scan.TEMPLATES, containment)
        assert as_tuple(row) == pytest.approx(expected), texts[row.doc_id]
        matched += bool(row.labels)
    assert matched > 20


def test_filters_lose_nothing_on_random_sets(llm):
    """Small vocabularies, where prefixes and positions matter most."""
    rng = random.Random(3)
    letters = "abcdefghij"
    templates = [(f"t{k}", " ".join(rng.sample(letters, rng.randrange(1, 9)))) for k in range(12)]
    texts = [" ".join(rng.choice(letters + "xyz") for _ in range(rng.randrange(0, 40))) for _ in range(80)]
    rows = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for containment in (0.5, 0.75, 1.0):
        for row in scan.scan(rows, templates=templates, containment=containment).collect():
            assert as_tuple(row) == pytest.approx(brute(texts[row.doc_id], templates, containment))


def test_odd_rows(odd_docs, no_docs, llm):
    found = scan.scan(odd_docs)
    rows = {r.doc_id: as_tuple(r) for r in found.collect()}
    assert found.count() == odd_docs.count()
    texts = {r.doc_id: r.text for r in odd_docs.collect()}
    assert all(rows[k] == pytest.approx(brute(texts[k], scan.TEMPLATES, 0.9)) for k in texts)
    assert scan.scan(no_docs).count() == 0
    clash = llm.createDataFrame(
        [("a", "cc by nc", 1, "x", 2)], "name string, body string, row long, hits string, n_words long"
    )
    (row,) = scan.scan(clash, "name", "body").collect()
    assert (row.name, row.labels, row.n_base) == ("a", "cc-by-nc", 1)
    (row,) = scan.scan(clash, "name", "body", templates=()).collect()
    assert row.labels == row.base_labels == "cc-by-nc"
    with pytest.raises(ValueError, match="more than"):
        scan.scan(no_docs, templates=[("x", "word " * (scan.MAX_TEMPLATE_WORDS + 1))])


def test_sql_names_every_template():
    sql = oracle_sql.licenses(scan.PHRASES, scan.TEMPLATES, scan.CONTAINMENT, scan.LEAST_STRIDE)
    assert all(text in sql for _, text in scan.TEMPLATES)
