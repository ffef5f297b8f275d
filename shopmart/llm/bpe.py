"""Byte-level BPE by a sentencepiece model that is made from a rank file.

The model is serialised directly: every token becomes a piece whose characters
stand for its bytes, with minus its rank as score, so that the library merges
in the order of ranks; normalisation is the identity. The pattern splits a text
into pre-tokens, each is encoded on its own, and ids are decoded by the inverse
mapping from pieces to bytes.

Nulls: a null text is an empty one. Repeated rows each get a row, an empty
table gives none. Extra columns stay; output names that clash raise.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopmart.llm.tokens import shown_bytes, text_slices

# Bytes of the pre-tokens kept per Python worker. Beyond, the memory starts anew.
MAX_BYTES = 200_000_000
# Longer pre-tokens are encoded each time.
LONGEST = 200
ENTRY_BYTES = 230  # of a pre-token kept, beside its characters and ids


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a file with a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, n: int) -> bytes:
    # Negative numbers are sent as 64-bit two's complement.
    return _varint(field << 3) + _varint(n % (1 << 64))


def _message(field: int, body: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(body)) + body


def serialise(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece model whose piece at place k is the token of rank k.

    The unknown piece, which the library asks for, comes last. Ranks must run
    from 0 without gaps and cover all single bytes.
    """
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks must run from 0 without gaps")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("ranks must cover all bytes")
    shown = shown_bytes()
    # Field numbers and enumerations of the public model format.
    normal, unknown, bpe = 1, 2, 2

    def piece(text: str, score: float, kind: int) -> bytes:
        body = _message(1, text.encode()) + b"\x15" + struct.pack("<f", score) + _number(3, kind)
        return _message(1, body)

    pieces = [
        piece(token.decode("latin-1").translate(shown), -float(rank), normal)
        for rank, token in enumerate(tokens)
    ]
    pieces.append(piece("<unk>", 0.0, unknown))
    trainer = (
        _number(3, bpe)
        + _number(4, len(pieces))
        + _number(40, len(tokens))  # unknown
        + _number(41, -1)  # begin, end and padding: none
        + _number(42, -1)
        + _number(43, -1)
    )
    normalizer = _message(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(pieces) + _message(2, trainer) + _message(3, normalizer)


class BpeCodec:
    """Encodes and decodes with a rank file and a pattern."""

    def __init__(self, path: str, pattern: str) -> None:
        ranks = read_ranks(path)
        self._model = sentencepiece.SentencePieceProcessor(model_proto=serialise(ranks))
        self._ranks = ranks
        self._pattern = regex.compile(pattern)
        self._shown = shown_bytes()
        back = {chr(shown): byte for byte, shown in self._shown.items()}
        size = self._model.get_piece_size() - 1
        self._bytes = [
            bytes([back[c] for c in self._model.id_to_piece(k)]) for k in range(size)
        ]
        self._known: dict[str, tuple[int, ...]] = {}
        self._held = 0

    def _learn(self, pre_tokens: list[str]) -> dict[str, tuple[int, ...]]:
        """Ids of the pre-tokens that are too long to be kept; all others are kept."""
        raw = [x.encode() for x in pre_tokens]
        shown = [x.decode("latin-1").translate(self._shown) for x in raw]
        found = self._model.encode(shown, out_type=int, num_threads=1)
        long = {}
        for text, data, ids in zip(pre_tokens, raw, found, strict=True):
            rank = self._ranks.get(data)  # a token as a whole needs no merges
            own = tuple(ids) if rank is None else (rank,)
            if len(text) > LONGEST:
                long[text] = own
            else:
                self._known[text] = own
                self._held += ENTRY_BYTES + len(text) + 8 * len(own)
        return long

    def encode(self, text: str) -> list[int]:
        pre_tokens = self._pattern.findall(text)
        missing = set(pre_tokens).difference(self._known)
        long = {}
        if missing:
            if self._held > MAX_BYTES:
                self._known.clear()
                self._held = 0
                missing = set(pre_tokens)
            long = self._learn(list(missing))
        if long:
            return [i for x in pre_tokens for i in (long.get(x) or self._known[x])]
        return list(chain.from_iterable(map(self._known.__getitem__, pre_tokens)))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self._bytes.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> BpeCodec:
    """One codec per Python worker, file and pattern."""
    return BpeCodec(path, pattern)


def encode_column(docs: DataFrame, ranks: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``ids`` (array of int), for texts of any length."""
    if "ids" in docs.columns:
        raise ValueError("docs already has a column ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        for batch in batches:
            for a, b in text_slices(batch.column(text_col)):
                part = batch.slice(a, b - a)
                ids = [own.encode(t or "") for t in part.column(text_col).to_pylist()]
                yield part.append_column("ids", pa.array(ids, pa.list_(pa.int32())))

    schema = T.StructType([*docs.schema, T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return docs.mapInArrow(run, schema)


def decode_column(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``encoded`` with a column ``decoded`` (binary) of its ``ids``; null ids stay null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        for batch in batches:
            raw = [None if x is None else own.decode(x) for x in batch.column("ids").to_pylist()]
            yield batch.append_column("decoded", pa.array(raw, pa.binary()))

    schema = T.StructType([*encoded.schema, T.StructField("decoded", T.BinaryType())])
    return encoded.mapInArrow(run, schema)


def round_trip(
    docs: DataFrame,
    ranks: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Digests of each text's ids and of the bytes they decode to, in one pass."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        decimal = [str(k) for k in range(len(own._bytes))]
        for batch in batches:
            for a, b in text_slices(batch.column("text")):
                part = batch.slice(a, b - a)
                counts, of_ids, of_text = [], [], []
                for text in part.column("text").to_pylist():
                    ids = own.encode(text or "")
                    listed = ",".join(map(decimal.__getitem__, ids))
                    counts.append(len(ids))
                    of_ids.append(hashlib.sha256(listed.encode()).hexdigest())
                    of_text.append(hashlib.sha256(own.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_text)],
                    [id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return source.mapInArrow(
        run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
