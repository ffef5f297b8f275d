"""Bounds on what the encoder, and with it packing and token files, hold and do."""

from __future__ import annotations

import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from shopmart.llm import quality, token_files, tokens
from shopmart.llm.common import new_folder

IDS = public_tokenizers.path("byte_bpe_50k.json")

MEMORY = """
import re, sys
sys.path.insert(0, sys.argv[1])
import numpy as np, pyarrow as pa
from shopmart.llm import tokens
peak = lambda: int(re.search(r"VmHWM:\\s+(\\d+)", open("/proc/self/status").read())[1]) // 1024
encoder = tokens.text_encoder(sys.argv[2])
encoder.encode(pa.array(["a b"]))
rng, before = np.random.default_rng(1), peak()
for _ in range(5):
    words = rng.integers(97, 123, (100_000, 8), np.uint8)
    words[:, -1] = 32
    encoder.encode(pa.array([words.tobytes().decode() + "x"]))
print(peak() - before)
"""


def test_memory_of_new_pieces_is_small():
    """Half a million pieces took over 200 MB of a worker as Python strings, beside the executor's own memory."""
    repo = str(Path(__file__).resolve().parents[2])
    done = subprocess.run(
        [sys.executable, "-c", MEMORY, repo, IDS], capture_output=True, text=True, check=True, timeout=300
    )
    assert int(done.stdout) < 150


def test_frequent_pieces_stay_when_the_memory_is_full(monkeypatch):
    monkeypatch.setattr(tokens, "MAX_BYTES", 30_000)
    encoder = tokens.text_encoder.__wrapped__(IDS)
    library = Tokenizer.from_file(IDS)
    asked = []
    whole = encoder.whole
    monkeypatch.setattr(encoder, "whole", lambda text: asked.append(text) or whole(text))
    rng = random.Random(7)
    for k in range(40):
        new = [f"{rng.choice('abcdef')}{rng.randrange(10**6)}x{k}" for _ in range(50)]
        text = " ".join(f"common {x}" for x in new)
        ids, _ = encoder.encode(pa.array([f"first {text}"]))
        assert ids.tolist() == library.encode(f"first {text}", add_special_tokens=False).ids
        assert encoder._held <= 30_000
    assert sum(" common" in x for x in asked) == 1


def test_python_work_does_not_follow_the_pieces():
    """What was called for each new piece made the most of the time of packing and token files."""
    encoder = tokens.text_encoder.__wrapped__(IDS)
    words = [f"w{k}" for k in range(20_000)]
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    text = pa.array([" ".join(words)])
    sys.setprofile(count)
    try:
        ids, _ = encoder.encode(text)
    finally:
        sys.setprofile(None)
    assert len(encoder._known) >= len(words)
    assert calls < len(words) // 4
    assert ids.tolist() == Tokenizer.from_file(IDS).encode(" ".join(words), add_special_tokens=False).ids


def test_short_batches_are_encoded_together(monkeypatch):
    monkeypatch.setattr(tokens, "ENCODE_CHARS", 1000)
    texts = [None, "", "x" * 3000, *("ab " * (k % 70) for k in range(200)), "end"]
    table = pa.table({"id": list(range(len(texts))), "text": pa.array(texts, pa.string())})
    found = list(tokens.encode_batches(iter(table.to_batches(max_chunksize=7))))
    assert [x for b in found for x in b.column("text").to_pylist()] == texts
    assert [x for b in found for x in b.column("id").to_pylist()] == list(range(len(texts)))
    assert all(b.column("text").nbytes < 6000 for b in found)
    assert len(found) < len(texts) // 7
    assert list(tokens.encode_batches(iter([]))) == []


def test_token_files_over_many_short_batches(llm, monkeypatch):
    """Rows of batches that are put together keep their ids."""
    llm.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        docs = llm.range(50).selectExpr("id doc_id", "repeat(concat('word', id, ' '), int(id % 5)) text").coalesce(1)
        folder = token_files.write_tokens(docs, new_folder(llm, "t"), IDS)
        rows = sorted(token_files.read_tokens(llm, folder).collect())
        texts = dict(docs.select("doc_id", "text").collect())
    finally:
        llm.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    library = Tokenizer.from_file(IDS)
    assert [r.doc_id for r in rows] == sorted(texts)
    for r in rows:
        own = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == [*own, 0]


def test_training_texts_take_no_second_worker(llm, tiny_docs, monkeypatch):
    """Two Python steps in a task keep two workers for each core, whose memory later stages have to spare."""
    seen = []
    train = quality.train

    def trained(texts):
        seen.append(texts._jdf.queryExecution().toString())
        return train(texts)

    monkeypatch.setattr(quality, "train", trained)
    quality.classify(tiny_docs, llm.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    assert seen and "MapInArrow" not in seen[0]
