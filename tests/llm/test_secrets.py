"""Secrets of kinds that the documents do not teach, or teach wrongly."""

from __future__ import annotations

import hashlib
import re
import time

import pytest
from pyspark.sql import functions as F

from shopmart.llm import queries, secret_scan

HEX = hashlib.sha256(b"held out").hexdigest()[:40]
MIXED = "q7Zt0LmWx4Rb9VcKe2NsYd81"
BASE64 = "pT4x+Jk9/wQz1mVb7RcHn3Yd6sLe0GaUf2XoIi8t"
KINDS = {
    f"AWS_SECRET_ACCESS_KEY={BASE64}": True,
    f"Authorization: Bearer {MIXED}": True,
    f"commit {HEX} merged": False,
    f'"integrity": "sha256-{BASE64}"': False,
    "id: 7c9e6679-7425-40de-944b-e07fc1f90ae7,": False,
    "see https://www.example.com/en/38120455der/2669109448945250 and": False,
}


def judged(llm, forest, texts) -> dict[str, bool]:
    """Whether a text has a secret."""
    docs = llm.createDataFrame([(k, t, "") for k, t in enumerate(texts)], "doc_id long, text string, source string")
    rows = secret_scan.scan(docs, forest, queries.dictionary()).where("is_secret").collect()
    found = {r.doc_id for r in rows}
    return {t: k in found for k, t in enumerate(texts)}


def one_sided(llm, n):
    """A corpus whose secrets and other strings are each of one kind."""
    digits = F.lpad((F.col("id") * 7919 + 1_000_000_007).cast("string"), 16, "26691094")
    secret = F.concat(F.lit('Ing the token = "'), F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 40), F.lit('" and on'))
    other = F.concat(F.lit("see https://www.example.com/en/de/"), digits, F.lit(" and"))
    text = F.when(F.col("id") % 2 == 0, secret).otherwise(other)
    return llm.range(n).select(F.col("id").alias("doc_id"), text.alias("text"), F.lit("").alias("source"))


@pytest.fixture(scope="module")
def large_forest(llm):
    return queries.secret_forest(queries.secret_findings(one_sided(llm, 3 * secret_scan.MAX_FINDINGS)))


def test_references_count_beside_a_large_corpus(llm, large_forest):
    small = judged(llm, queries.secret_forest(queries.secret_findings(one_sided(llm, 400))), KINDS)
    assert judged(llm, large_forest, KINDS) == small == KINDS


def test_unquoted_secrets_are_not_taught_as_others(llm):
    """Many unquoted secrets in a corpus, which the rule cannot judge."""
    n = 2000
    base64 = F.regexp_replace(F.base64(F.unhex(F.sha2(F.col("id").cast("string"), 256))), "=", "")
    shapes = [("AWS_SECRET_ACCESS_KEY=", ""), ("Authorization: Bearer ", ""), ("password: ", " #")]
    text = F.element_at(F.array(*[F.concat(F.lit(a), base64, F.lit(b)) for a, b in shapes]), (F.col("id") % 3 + 1).cast("int"))
    corpus = llm.range(n).select((F.col("id") + n).alias("doc_id"), text.alias("text"), F.lit("").alias("source"))
    corpus = corpus.unionByName(one_sided(llm, n))
    labels = secret_scan.findings(corpus, queries.dictionary()).groupBy("label").count().collect()
    counts = {r.label: r["count"] for r in labels}
    assert counts[0.0] <= n // 2 and counts[1.0] == n // 2
    unquoted = {f"{a}{MIXED}{b}": True for a, b in shapes}
    assert judged(llm, queries.secret_forest(queries.secret_findings(corpus)), KINDS | unquoted) == KINDS | unquoted


ASSIGNED = {
    'password = "Tr0ub4dor"': "Tr0ub4dor",
    "password: p@ss!w0rd#91,": "p@ss!w0rd#91",
    'secret = "qwertzuiopasdfghjklyx"': "qwertzuiopasdfghjklyx",
    "DB_PASSWORD=xK3vq9Lw\n": "xK3vq9Lw",
}


def test_short_and_marked_values_are_seen(llm, large_forest):
    words = queries.dictionary()
    for text, value in ASSIGNED.items():
        found = [c for c in secret_scan.candidates(text, "", words) if c.text == value]
        assert [c.start for c in found] == [text.index(value)]
    assert all(judged(llm, large_forest, ASSIGNED).values())
    plain = ["the password: remember of", 'the key = "question and answer" of', "secret: ${vault}"]
    assert not any(judged(llm, large_forest, plain).values())
    docs = llm.createDataFrame([(t,) for t in ASSIGNED], "text string")
    masked = {r.text for r in secret_scan.mask(docs, large_forest, words).collect()}
    assert masked == {t.replace(v, "[secret]") for t, v in ASSIGNED.items()}
    long = MIXED * 60
    docs = llm.createDataFrame([(f'token = "{long}" and {HEX[:20]} on',)], "text string")
    assert secret_scan.mask(docs, large_forest, words).first().text.startswith('token = "[secret]" and ')
    nested = f'token = "see {HEX} there"'
    assert {c.text for c in secret_scan.candidates(nested, "", words)} == {f"see {HEX} there", HEX}


@pytest.mark.parametrize(
    "text",
    [
        "key=" + "q7Zt0LmWx4Rb9VcKe2NsYd81" * 200_000,
        "&".join(f"api_key={MIXED}{k}" for k in range(60_000)),
        "function(){" + "a.token=b;c={secret:'x',key:d[1]};" * 100_000,
        "password=" * 60_000,
        "x:" * 1_500_000,
    ],
)
def test_long_texts_without_spaces(text):
    """Candidates are bounded, leave nothing out, and cost in proportion to the text."""
    words = queries.dictionary()
    start = time.perf_counter()
    found = list(secret_scan.candidates(text, "a.js", words))
    assert time.perf_counter() - start < 60
    assert all(len(c.text) <= secret_scan.MAX_LENGTH and text.startswith(c.text, c.start) for c in found)
    assert sum(len(c.text) for c in found) <= 4 * len(text)
    if text.startswith("key="):
        assert "".join(c.text for c in found) == text[4:]
    if text.startswith("api_key="):
        assert {c.text for c in found} >= {f"{MIXED}{k}" for k in range(60_000)}


def plain_candidates(text: str) -> set[tuple[int, int]]:
    """The same spans, by rules applied to the whole text."""
    spans = set()
    for run in re.finditer(r"[A-Za-z0-9+/_\-]+", text):
        stop = run.end()
        while stop < len(text) and text[stop] == "=" and stop < run.end() + 2:
            stop += 1
        if len(run.group()) >= 16 and re.search(r"[0-9]|[a-z][A-Z]", run.group()):
            spans.add((run.start(), stop))
    found = list(secret_scan._ASSIGNED.finditer(text))
    for match in found:
        start, quote = match.end(), match.group(1)
        line = text[start:].split("\n", 1)[0]
        if quote and quote in line:
            value = line[: line.index(quote)]
        else:
            later = [m.start() for m in found if m.start() >= start + 6]
            value = re.split(r"[\s;&,)}\]<>\"'`]", text[start : min(later, default=len(text))], maxsplit=1)[0].rstrip(".")
        if len(value) >= 6:
            spans.add((start, start + len(value)))
    return {(a, min(a + 512, stop)) for start, stop in spans for a in range(start, stop, 512)}


def test_query_equals_plain_rules_and_the_library(llm):
    """Every candidate of every document, found by plain rules and scored by the library's own model."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    docs = llm.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: (r.text or "", r.source or "") for r in docs.collect()}
    texts |= {f"extra {k}": (t, "") for k, t in enumerate([*KINDS, *ASSIGNED, "key=a.b;token: 'x y z 1'", "auth=>qwerty.uiop."])}
    words = queries.dictionary()
    for text, path in texts.values():
        assert {(c.start, c.start + len(c.text)) for c in secret_scan.candidates(text, path, words)} == plain_candidates(text)
    fitted = []
    export = secret_scan._exported

    def keep(spark, model):
        fitted.append(model)
        return export(spark, model)

    secret_scan._exported = keep
    try:
        rows = queries.op3_secrets(llm, "/root/testdata/sf0.001").collect()
    finally:
        secret_scan._exported = export
    expected = []
    for key, (text, path) in texts.items():
        if isinstance(key, str):
            continue
        for a, b in plain_candidates(text):
            vector = secret_scan.features(text, a, text[a:b], path, words)
            expected.append((key, a, b - a, hashlib.sha256(text[a:b].encode()).hexdigest(), vector))
    frame = llm.createDataFrame(expected, "doc_id long, start long, length long, sha string, v array<double>")
    scored = fitted[0].transform(frame.withColumn("features", array_to_vector("v")))
    share = F.round(vector_to_array("probability")[1], 6)
    scored = scored.select("doc_id", "start", "length", "sha", share.alias("score"))
    assert sorted(tuple(r)[:5] for r in rows) == sorted(map(tuple, scored.collect())) and rows
    assert all(r.is_secret == (r.score >= 0.5) for r in rows)
