"""Quality classifier, secret scan and pipeline."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shopmart.llm import queries, quality, secret_scan, simhash

TINY = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"


class BruteModel:
    """The same model, by the textbook: dictionaries and a recursion."""

    def __init__(self, texts: list[str], order: int) -> None:
        self.counts = {k: Counter() for k in range(1, order + 1)}
        for text in texts:
            padded = "\n" * (order - 1) + text
            for k in range(len(text)):
                self.counts[order][padded[k : k + order]] += 1
        for k in range(order - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.order, self.discount, self.contexts = order, {}, {}
        for k in range(1, order + 1):
            of = Counter(self.counts[k].values())
            if all(of[n] for n in (1, 2, 3, 4)):
                y = of[1] / (of[1] + 2 * of[2])
                raw = [n - (n + 1) * y * of[n + 1] / of[n] for n in (1, 2, 3)]
                self.discount[k] = [min(max(d, 0.01), n - 0.01) for n, d in zip((1, 2, 3), raw, strict=True)]
            else:
                self.discount[k] = [0.5, 0.75, 0.9]
            found = defaultdict(lambda: [0, 0.0])
            for gram, n in self.counts[k].items():
                found[gram[:-1]][0] += n
                found[gram[:-1]][1] += self.discount[k][min(n, 3) - 1]
            self.contexts[k] = dict(found)

    def probability(self, gram: str) -> float:
        k = len(gram)
        if k == 0:
            return 1 / (len(self.counts[1]) + 1)
        if gram[:-1] not in self.contexts[k]:
            return self.probability(gram[1:])
        total, given = self.contexts[k][gram[:-1]]
        n = self.counts[k][gram]
        own = (n - self.discount[k][min(n, 3) - 1]) / total if n else 0.0
        return own + given / total * self.probability(gram[1:])

    def log_probability(self, text: str) -> float:
        padded = "\n" * (self.order - 1) + text
        return sum(math.log(self.probability(padded[k : k + self.order])) for k in range(len(text)))


@pytest.mark.parametrize("block", [300, 1_000_000])
def test_scores_equal_the_textbook(llm, tiny_docs, monkeypatch, block):
    monkeypatch.setattr(quality, "BLOCK_CHARS", block)
    texts = [t[:400] for (t,) in tiny_docs.where("doc_id < 60").select("text").collect()]
    brute = BruteModel(texts, quality.ORDER)
    model = quality.train(llm.createDataFrame([(t,) for t in texts], "text string"))
    new = [*texts[:20], "", None, "\U0001f642 never seen \x00 characters ￾", "zzzz"]
    docs = llm.createDataFrame(list(enumerate(new)), "doc_id long, text string").repartition(3)
    rows = {r.doc_id: r for r in quality.score(docs, model, ["doc_id"]).collect()}
    for key, text in enumerate(new):
        assert rows[key].n_scored == len(text or "")
        # Characters beyond 16 bits count as one, which the textbook does not know either.
        assert rows[key].log_probability == pytest.approx(brute.log_probability(text or ""), abs=1e-6)


def test_probabilities_sum_to_one(llm):
    brute = BruteModel(["abcabd aab", "bca cab"], quality.ORDER)
    total = sum(brute.probability("ab" + "c" + x) for x in [*brute.counts[1], "?"])
    assert total == pytest.approx(1.0)


def test_held_out_documents_are_told_apart(llm):
    docs, labels = (llm.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    train, held_out = labels.where("doc_id % 2 = 0"), {r.doc_id: r.quality for r in labels.where("doc_id % 2 = 1").collect()}
    rows = [r for r in quality.classify(docs, train).collect() if r.doc_id in held_out]
    good = [r.is_kept for r in rows if held_out[r.doc_id] == 1]
    bad = [r.is_kept for r in rows if held_out[r.doc_id] == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.2


def test_quality_of_odd_rows(llm, odd_docs, no_docs, tiny_docs):
    labels = llm.createDataFrame([(5, 1), (6, 1), (6, 0), (None, 1)], "doc_id long, quality int")
    with_lang = odd_docs.withColumnRenamed("id", "lang")
    rows = quality.classify(with_lang, labels).collect()
    assert len(rows) == odd_docs.count()
    assert all(r.is_kept and r.perplexity is None for r in rows if r.doc_id in (1, 2))
    assert all(r.is_kept for r in rows if r.doc_id is None)
    assert quality.classify(no_docs, labels).count() == 0
    kept = quality.keep_good(with_lang, labels.limit(0))
    assert kept.columns == with_lang.columns and kept.count() == odd_docs.count()


def test_rows_go_by_their_own_text(llm, tiny_docs):
    """Of rows that share an id, one is rejected and the others stay; ids may be text."""
    labels = llm.read.parquet(f"{TINY}/labels.parquet")
    rejected = quality.classify(tiny_docs, labels).where("not is_kept").select("doc_id")
    bad = tiny_docs.join(rejected, "doc_id", "left_semi").limit(3)
    good = tiny_docs.join(rejected, "doc_id", "left_anti").where("n_chars > 500")
    shared = bad.withColumn("doc_id", F.lit(good.first().doc_id))
    mixed = tiny_docs.unionByName(shared).withColumns({"digest": F.lit(1), "own": F.lit(2), "key": F.lit("k")})
    kept = quality.keep_good(mixed, labels)
    assert kept.columns == mixed.columns
    texts = sorted(r.text for r in kept.collect())
    assert texts == sorted(r.text for r in quality.keep_good(tiny_docs, labels).collect())
    named = "concat('doc-', doc_id) AS doc_id"
    as_text = quality.keep_good(
        tiny_docs.selectExpr(named, "text", "lang"), labels.selectExpr(named, "quality")
    )
    assert as_text.where("doc_id like 'doc-%'").count() == as_text.count() > 0


def test_bitmap_leaves_the_join_whole(llm, tiny_docs):
    labels = llm.read.parquet(f"{TINY}/labels.parquet")
    found = quality.trusted_documents(tiny_docs, labels).collect()
    good = {r.doc_id for r in labels.where("quality = 1").where(quality.trains(labels.doc_id)).collect()}
    expected = [t for i, t in tiny_docs.select("doc_id", "text").collect() if i in good]
    assert sorted(r.text for r in found) == sorted(expected)


@pytest.fixture(scope="module")
def forest(llm):
    docs = llm.read.parquet("/root/testdata/sf0.1/documents.parquet")
    return queries.secret_forest(queries.secret_findings(docs))


def test_secrets_are_told_from_other_strings(llm, forest):
    """Held out: other values, and strings that look alike."""
    secret, other = "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b", "2b5e151628aed2a6abf7158809cf4f3c762e7160"
    texts = [
        f'Ing the token = "{secret}" and on',
        f'api_key = "{other}"',
        "https://tion.example.com/en/7817aanderethe/2669109448945250",
        "thehaandedingesthTheHaandEdingesther of the",
        "see nt.26aaaaaaaaaaaaaaaaa@mail6.example.com now",
        None,
        "",
    ]
    docs = llm.createDataFrame([(k, t, "a.txt") for k, t in enumerate(texts)], "doc_id long, text string, source string")
    rows = secret_scan.scan(docs, forest, queries.dictionary()).collect()
    assert {r.doc_id for r in rows if r.is_secret} == {0, 1}
    assert all(texts[r.doc_id][r.start :].startswith(r.candidate) for r in rows)
    masked = {r.doc_id: r.text for r in secret_scan.mask(docs, forest, queries.dictionary()).collect()}
    assert masked[0] == 'Ing the token = "[secret]" and on' and secret not in masked[0]
    assert [masked[k] for k in (2, 3, 4, 5, 6)] == texts[2:]


def test_exported_forest_equals_the_library(llm, tiny_docs):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    rng = np.random.default_rng(3)
    data = [([float(x) for x in v], float(v[0] + v[1] ** 2 > 1)) for v in rng.normal(size=(300, 4))]
    rows = llm.createDataFrame(data, "features array<double>, label double")
    vectors = rows.select(array_to_vector("features").alias("features"), "label")
    fitted = RandomForestClassifier(numTrees=5, maxDepth=4, seed=1).fit(vectors)
    own = secret_scan._exported(llm, fitted)
    for row in fitted.transform(vectors).collect():
        assert own.score(list(row.features)) == pytest.approx(row.probability[1])


def test_training_without_both_kinds(llm, odd_docs, no_docs):
    rows = llm.createDataFrame([([1.0], 1.0, "x", 0)], "features array<double>, label double, candidate string, start long")
    assert secret_scan.train(rows).score([0.0]) == 1.0
    words = queries.dictionary()
    assert secret_scan.findings(no_docs, words).count() == 0
    assert secret_scan.mask(odd_docs, secret_scan.Forest([]), words).columns == odd_docs.columns


def test_pipeline_stages(llm):
    docs = corpus_pipeline.documents(llm, SMALL)
    texts = dict(docs.select("doc_id", "text").collect())
    labels = {r.doc_id: r.quality for r in corpus_pipeline.table(llm, SMALL, "labels").collect()}
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "SimHash near-dedup", "secret scans", "packing"]

    first = corpus_pipeline.good_quality(llm, docs, SMALL)
    assert first.columns == docs.columns
    kept = {r.doc_id for r in first.select("doc_id").collect()}
    assert np.mean([i in kept for i, q in labels.items() if q == 1]) > 0.99
    assert np.mean([i in kept for i, q in labels.items() if q == 0]) < 0.2

    second = corpus_pipeline.near_dedup(llm, docs, SMALL)
    keys = sorted(texts)
    fps = simhash.fingerprint_all([texts[i] for i in keys])
    root = list(range(len(keys)))  # the smallest place of each component
    changed = True
    while changed:
        changed = False
        for k in range(len(keys)):
            near = np.flatnonzero(np.bitwise_count(fps ^ fps[k]) <= simhash.BITS)
            least = min(root[j] for j in near)
            for j in near:
                changed |= root[j] != least
                root[j] = least
    stays = {r.doc_id for r in second.select("doc_id").collect()}
    assert stays == {keys[k] for k in range(len(keys)) if root[k] == k} and len(stays) < len(keys)
    assert second.columns == docs.columns

    third = corpus_pipeline.mask_secrets(llm, docs, SMALL)
    rows = third.collect()
    assert third.columns == docs.columns and len(rows) == len(texts)
    assert all(r.n_chars == len(r.text) for r in rows)
    changed = [r for r in rows if r.text != texts[r.doc_id]]
    assert changed and all("token = " in texts[r.doc_id].lower() for r in changed)


def test_pipeline_runs_whole(llm):
    pieces = corpus_pipeline.run(llm, TINY)
    lengths = [r.n for r in pieces.groupBy("sequence_id").agg({"length": "sum"}).toDF("s", "n").collect()]
    assert all(n <= 1024 and n & (n - 1) == 0 for n in lengths)
    assert corpus_pipeline.ORACLE_SQL is None
