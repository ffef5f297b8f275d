"""Token ids, packing, token files and BPE against the libraries themselves."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from shopmart.llm import bpe, packing, token_files
from shopmart.llm.common import new_folder
from shopmart.llm.tokens import text_encoder, text_slices

IDS = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(IDS)
    found.encode_special_tokens = True
    return lambda text: found.encode(text or "", add_special_tokens=False).ids


def random_texts(n: int) -> list[str]:
    rng = random.Random(3)
    alphabet = "ab \n\t .,'s1é\x1c\xa0Z"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(n)]


ODD = [
    None, "", " ", "  ", "a  b", "a   b", " a ", "a  ", "\ta \n b", "x\n\n y", "x\n\n\ny", "it's we're",
    "<|endoftext|> a <|endoftext|>", "\xa0", "\n", "a\n", "tab\t\tx", "日本 語 \U0001f642x", "héé \x1c b",
]


def test_encoder_equals_the_library(library):
    texts = ODD + random_texts(2000)
    ids, counts = text_encoder(IDS).encode(pa.array(texts, pa.string()))
    for text, own in zip(texts, np.split(ids, np.cumsum(counts)[:-1]), strict=True):
        assert own.tolist() == library(text), repr(text)


def test_encoder_forgets_when_full(library, monkeypatch):
    monkeypatch.setattr("shopmart.llm.tokens.MAX_BYTES", 1000)
    encoder = text_encoder.__wrapped__(IDS)
    for text in ("one two three four five six", "seven eight nine ten eleven twelve thirteen", "one two"):
        ids, _ = encoder.encode(pa.array([text]))
        assert ids.tolist() == library(text)
        assert encoder._held < 3000


def test_long_pieces_are_not_kept(library):
    encoder = text_encoder.__wrapped__(IDS)
    long = "x1é" * 40_000
    ids, _ = encoder.encode(pa.array([f"a {long} b"]))
    assert ids.tolist() == library(f"a {long} b")
    assert encoder._held < 2000 and max(map(len, encoder._known)) < 10


def test_bpe_memory_is_bounded_by_bytes(monkeypatch):
    codec = bpe.codec.__wrapped__(RANKS, public_tokenizers.PATTERN)
    ranks = bpe.read_ranks(RANKS)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    monkeypatch.setattr(bpe, "MAX_BYTES", 2000)
    for text in ("one two " * 5, "x" * 5000 + " three", "four five six seven eight nine ten", "one two", "é" * 400):
        assert codec.encode(text) == plain.encode_ordinary(text)
        assert codec._held < 6000
    assert all(len(x) <= bpe.LONGEST for x in codec._known)


def test_slices_cover_all_rows_once():
    texts = pa.array(["x" * 1_500_000, None, "y" * 900_000, "z", "w" * 5_000_000, ""])
    spans = list(text_slices(texts))
    assert [r for a, b in spans for r in range(a, b)] == list(range(6))
    assert list(text_slices(pa.array([], pa.string()))) == []


def check_pieces(rows, texts: dict, library, size: int) -> None:
    by_doc: dict = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for key, text in texts.items():
        own = np.array([*library(text), 0], "<u4")
        at = 0
        for piece in sorted(by_doc.pop(key), key=lambda r: r.start):
            assert piece.start == at and piece.doc_tokens == len(own)
            data = own[at : at + piece.length].tobytes()
            assert piece.ids_crc32 == zlib.crc32(data) and bytes(piece.ids) == data
            at += piece.length
        assert at == len(own)
    assert not by_doc
    bins: dict = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append(r)
    for pieces in bins.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size and at & (at - 1) == 0  # full or a power of two: no padding


def test_packing_covers_every_id_without_padding(tiny_docs, library):
    texts = dict(tiny_docs.select("doc_id", "text").collect())
    rows = packing.pack(tiny_docs.repartition(3), IDS).collect()
    check_pieces(rows, texts, library, 1024)


@pytest.mark.parametrize("size", [1, 2, 64, 1024])
def test_rests_stay_whole_in_their_class(size):
    """Of many documents, few rests are cut, each sequence is cut for one document, and what a task holds is bounded."""
    rng = random.Random(size)
    bins = packing._Bins(size, 0, True)
    lengths = [rng.choice([1, 2, rng.randrange(1, size + 1), rng.randrange(1, 4 * size + 1)]) for _ in range(4000)]
    most = 0
    for k, n in enumerate(lengths):
        bins.add(packing._Piece(k, n, np.arange(n, dtype="<u4").tobytes(), 0, 0, n))
        held = sum(len(p) for x in (*bins.open.values(), *bins.waiting) for p in x)
        most = max(most, held)
        assert len(bins.waiting) <= 1
    assert most <= size * (2 * size**0.5 + 2)
    closed = len(bins.full)
    bins.finish()
    rows: dict = {}
    for key, start, length, crc, total, sequence, offset, data in bins.full:
        assert total == lengths[key] and zlib.crc32(data) == crc
        assert data == np.arange(start, start + length, dtype="<u4").tobytes()
        rows.setdefault(sequence, []).append((key, start, length, offset))
    assert sum(length for r in rows.values() for _, _, length, _ in r) == sum(lengths)
    cut = {k: 0 for k in range(len(lengths))}
    for key, start, length, *_ in bins.full[:closed]:
        rest = lengths[key] % size
        cut[key] += length < rest and start >= lengths[key] - rest
    if size >= 64:
        whole = sum(1 for k, n in cut.items() if not n)
        assert whole > 0.7 * len(lengths)
    sums = [sum(length for _, _, length, _ in r) for r in rows.values()]
    assert sum(s != size for s in sums) <= size.bit_length() and all(s & (s - 1) == 0 for s in sums)


def test_packing_of_odd_rows(odd_docs, no_docs, library):
    once = odd_docs.dropDuplicates()
    texts = dict(once.select("doc_id", "text").collect())
    check_pieces(packing.pack(once, IDS, size=64).collect(), texts, library, 64)
    assert packing.pack(no_docs, IDS).count() == 0
    doubled = packing.pack(odd_docs.where("doc_id = 5"), IDS).collect()
    assert sum(r.length for r in doubled) == 2 * doubled[0].doc_tokens
    with pytest.raises(ValueError, match="power of two"):
        packing.pack(odd_docs, IDS, size=100)


def test_sequences_join_their_pieces(tiny_docs):
    pieces = packing.pack(tiny_docs, IDS)
    held = {r.sequence_id: r for r in packing.sequences(pieces).collect()}
    for r in pieces.collect():
        whole = bytes(held[r.sequence_id].ids)
        assert whole[4 * r.offset : 4 * (r.offset + r.length)] == bytes(r.ids)


def test_value_coding_round_trips():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        values = (rng.integers(0, 1 << 32, n) >> rng.integers(0, 32, n)).astype(np.uint32)
        control, data = token_files.encode_values(values)
        assert len(control) == -(-n // 4)
        assert token_files.decode_values(control, data, n).tolist() == values.tolist()


def test_token_files_round_trip(llm, tiny_docs, library):
    folder = token_files.write_tokens(tiny_docs.repartition(4), new_folder(llm, "t"), IDS)
    rows = sorted(token_files.read_tokens(llm, folder).collect())
    texts = dict(tiny_docs.select("doc_id", "text").collect())
    assert [r.doc_id for r in rows] == sorted(texts)
    start = 0
    for r in rows:
        own = np.array([*library(texts[r.doc_id]), 0], "<u4").tobytes()
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(own) // 4, zlib.crc32(own))
        assert bytes(r.ids) == own
        start += r.n_tokens


def test_token_files_of_odd_rows(llm, odd_docs, no_docs, library, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 50)
    folder = token_files.write_tokens(odd_docs, new_folder(llm, "t"), IDS)
    rows = token_files.read_tokens(llm, folder).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 4, 5, 5, 6, 7]
    assert [r.n_tokens for r in rows][1:3] == [1, 1]
    assert rows[7].n_tokens == len(library(" ".join(f"w{k}" for k in range(30_000)))) + 1
    empty = token_files.write_tokens(no_docs, new_folder(llm, "t"), IDS)
    assert token_files.read_tokens(llm, empty).count() == 0


def test_damaged_token_file_raises():
    import io

    block = bytearray(token_files._block([1], [3], np.array([5, 6, 7], np.uint32)))
    assert next(token_files._blocks(io.BytesIO(bytes(block))))[0] == [1]
    block[-1] ^= 1
    with pytest.raises(ValueError, match="damaged"):
        next(token_files._blocks(io.BytesIO(bytes(block))))


@pytest.fixture(scope="module")
def merges():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def test_bpe_equals_the_library(merges):
    codec = bpe.codec(RANKS, public_tokenizers.PATTERN)
    for text in [t or "" for t in ODD] + random_texts(1500):
        ids = codec.encode(text)
        assert ids == merges.encode_ordinary(text), repr(text)
        assert codec.decode(ids) == text.encode()


def test_bpe_query_and_columns(odd_docs, no_docs, tiny_docs, merges):
    args = (RANKS, public_tokenizers.PATTERN)
    for docs in (odd_docs, tiny_docs):
        texts = [t or "" for (t,) in docs.select("text").collect()]
        expected = sorted(
            hashlib.sha256(",".join(map(str, merges.encode_ordinary(t))).encode()).hexdigest() for t in texts
        )
        rows = bpe.round_trip(docs, *args).collect()
        assert sorted(r.ids_sha256 for r in rows) == expected
        assert sorted(r.decoded_sha256 for r in rows) == sorted(
            hashlib.sha256(t.encode()).hexdigest() for t in texts
        )
    assert bpe.round_trip(no_docs, *args).count() == 0
    kept = bpe.decode_column(bpe.encode_column(odd_docs, *args), *args)
    assert kept.columns == [*odd_docs.columns, "ids", "decoded"]
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in kept.collect())
    with pytest.raises(ValueError, match="ids"):
        bpe.encode_column(kept, *args)


def test_serialise_asks_for_whole_ranks():
    singles = {bytes([b]): b for b in range(256)}
    with pytest.raises(ValueError, match="gaps"):
        bpe.serialise(singles | {b"ab": 300})
    with pytest.raises(ValueError, match="bytes"):
        bpe.serialise({b"a": 0})
