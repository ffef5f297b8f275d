"""Token ids of whole texts, by a byte-level BPE file of the tokenizers library.

The pattern that splits a text before the merges lets no match run across a
space or line end which follows a non-space, nor across the last character of a run
of white space. Texts are therefore cut before spaces and line ends, each distinct
new piece is encoded once by the library and kept, and a text's ids are its pieces' ids one after
another. Pieces and ids are held and looked up as Arrow arrays; where they are too many, the half
used most often stays. Texts in which a cut would fall
inside a run of white space are encoded whole. The result is always that of the
library for the whole text; the tests compare the two.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

# Bytes of the pieces kept per Python worker. Beyond, the half used most often stays.
MAX_BYTES = 100_000_000
# Longer pieces are encoded each time.
LONGEST = 200
ENTRY_BYTES = 100  # of a piece kept and looked up, beside its characters and ids
# Bytes of the texts that an operator takes at a time.
MAX_CHARS = 2_000_000
# Bytes of the texts that are encoded at a time, and of the new pieces in a call of the library.
ENCODE_CHARS = 4_000_000
LEARN_CHARS = 50_000

# All characters that any of the libraries takes for white space.
_SPACE = r"\t-\r \x1c-\x1f\x85\xa0\x{1680}\x{180e}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# A cut that is neither before the first nor before the last of a run.
_RUN = rf"[{_SPACE}][ \n](?:[{_SPACE}]|\z)|\A\n[{_SPACE}]"
# White space at an end, or nothing at all.
_AT_END = rf"\A(?:[{_SPACE}]|\z)|[{_SPACE}]\z"


def shown_bytes() -> dict[int, int]:
    """The character that stands for each byte in a byte-level vocabulary: the byte's
    own where that is printable, else the next one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + k for k, b in enumerate(others)}


_SHOWN_SPACE = chr(shown_bytes()[ord(" ")])


class TextEncoder:
    """Encodes texts to unsigned 32-bit ids."""

    def __init__(self, path: str) -> None:
        self._tokenizer = Tokenizer.from_file(path)
        # Strings of special tokens in a text are ordinary text.
        self._tokenizer.encode_special_tokens = True
        self._keep(pa.array([], pa.large_string()), pa.array([], pa.large_binary()), np.zeros(0, np.int64))
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        space, line_end = (self.whole(x) for x in (" ", "\n"))
        self._cuts = len(space) == len(line_end) == 4
        self._line_end = int.from_bytes(line_end[:4], "little")
        # Whether a token begins with a space.
        self._spaced = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self._spaced[[k for t, k in vocabulary.items() if t.startswith(_SHOWN_SPACE)]] = True
        self.n_vocab = self._tokenizer.get_vocab_size(with_added_tokens=True)

    def whole(self, text: str) -> bytes:
        """The library's ids of one text, each as four little-endian bytes."""
        (encoded,) = self._tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return array("I", encoded.ids).tobytes()

    def _each(self, pieces: list[str], begins_line: bool) -> tuple[bytes, list[int]]:
        """Ids of pieces, each from a space or a line end on, one after another, and the bytes of each.

        One call of the library for all: a piece begins where an id begins with a space or is a line end.
        """
        data = self.whole("".join(pieces) if begins_line else f" {' '.join(pieces)}")
        ids = np.frombuffer(data, "<u4")
        begins = np.flatnonzero(ids == self._line_end if begins_line else self._spaced[ids])
        if len(begins) != len(pieces) or begins[0]:
            return self._alone(pieces)
        return data, (4 * np.diff(begins, append=len(ids))).tolist()

    def _alone(self, pieces: list[str]) -> tuple[bytes, list[int]]:
        """The same by one call of the library for each piece."""
        found = [self.whole(x if x[:1] == "\n" else f" {x}") for x in pieces]
        return b"".join(found), list(map(len, found))

    def _learn(self, pieces: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Pieces, in another order, and their ids: one that begins with a line end as it is, others behind a space.

        Pieces that have white space at an end, which might belong with a neighbour's, go alone.
        """
        line = pc.starts_with(pieces, "\n")
        alone = pc.match_substring_regex(pc.replace_substring(pieces, "\n", ""), _AT_END)
        kinds = (
            (alone, self._alone),
            (pc.and_not(line, alone), lambda x: self._each(x, True)),
            (pc.invert(pc.or_(line, alone)), lambda x: self._each(x, False)),
        )
        order, data, sizes = [], [], [0]
        for chosen, encoded in kinds:
            own = pieces.filter(chosen)
            order.append(own)
            for a, b in text_slices(own, LEARN_CHARS):
                found, lengths = encoded(own[a:b].to_pylist())
                data.append(found)
                sizes += lengths
        buffers = [None, pa.py_buffer(np.cumsum(sizes, dtype=np.int64)), pa.py_buffer(b"".join(data))]
        return pa.concat_arrays(order), pa.Array.from_buffers(pa.large_binary(), len(pieces), buffers)

    def _keep(self, pieces: pa.Array, ids: pa.Array, uses: np.ndarray) -> None:
        """Hold pieces for later texts: no long ones and, where all are too many, the half used most often."""
        sizes = pc.binary_length(pieces).to_numpy()
        held = sizes + pc.binary_length(ids).to_numpy() + ENTRY_BYTES
        kept = sizes <= LONGEST
        if held[kept].sum() > MAX_BYTES:
            by_use = np.lexsort((-uses, ~kept))
            kept[by_use[np.cumsum(held[by_use]) > MAX_BYTES // 2]] = False
            uses = uses // 2
        if not kept.all():
            chosen = pa.array(kept)
            pieces, ids, uses, held = pieces.filter(chosen), ids.filter(chosen), uses[kept], held[kept]
        self._pieces, self._ids, self._uses, self._held = pieces, ids, uses, int(held.sum())

    @property
    def _known(self) -> list[str]:
        """The pieces held."""
        return self._pieces.to_pylist()

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids and counts of texts, each begun by a line end, that may be cut."""
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        pieces = lists.flatten()
        places = pc.index_in(pieces, value_set=self._pieces)
        known, ids = self._pieces, self._ids
        missing = pieces.filter(places.is_null())
        if len(missing):
            learnt, own = self._learn(missing.unique())
            later = pc.add(pc.index_in(missing, value_set=learnt), pa.scalar(len(known), pa.int32()))
            places = pc.replace_with_mask(places, places.is_null(), later)
            known, ids = pa.concat_arrays([known, learnt]), pa.concat_arrays([ids, own])
        found = ids.take(places)
        uses = np.bincount(places.to_numpy(), minlength=len(known))
        uses[: len(self._uses)] += self._uses
        self._keep(known, ids, uses)
        ends = np.frombuffer(found.buffers()[1], np.int64)[: len(found) + 1] // 4
        total = int(ends[-1])
        data = np.frombuffer(found.buffers()[2], "<u4", total) if total else np.zeros(0, "<u4")
        bounds = ends[np.asarray(lists.offsets)]
        # The line end before the text and the empty piece before that.
        keep = np.ones(total, bool)
        keep[bounds[:-1]] = keep[bounds[:-1] + 1] = False
        return data[keep], np.diff(bounds) - 2

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids, one text after another, and each text's number of ids.

        A null is taken for an empty text.
        """
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        line_end, nothing = (pa.scalar(x, pa.large_string()) for x in ("\n", ""))
        begun = pc.binary_join_element_wise(line_end, texts, nothing)
        odd = pc.match_substring_regex(begun, _RUN).to_numpy(zero_copy_only=False)
        if not self._cuts:
            odd = np.ones(len(texts), bool)
        if not odd.any():
            return self._cut(begun)
        ids, counts = self._cut(begun.filter(pa.array(~odd)))
        cut, ends = iter(np.split(ids, np.cumsum(counts)[:-1])), []
        for text, is_odd in zip(texts, odd, strict=True):
            ends.append(np.frombuffer(self.whole(text.as_py()), "<u4") if is_odd else next(cut))
        return np.concatenate(ends), np.fromiter(map(len, ends), np.int64, len(ends))


@lru_cache(maxsize=2)
def text_encoder(path: str) -> TextEncoder:
    """One encoder per Python worker and file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks in parallel
    return TextEncoder(path)


def text_slices(texts: pa.Array, most: int = 0) -> Iterator[tuple[int, int]]:
    """Rows from, to: runs of texts with ``most`` bytes (by default ``MAX_CHARS``), or of one longer text."""
    most = most or MAX_CHARS
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if row > start and held + size > most:
            yield start, row
            start, held = row, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def encode_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of batches with a column ``text``, as many at a time as are encoded at a time.

    Batches of short texts are put together, as each call of the encoder costs a look at all pieces held.
    """
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column("text").nbytes
        if size >= ENCODE_CHARS:
            *full, last = _slices(held)
            yield from full
            held, size = [last], last.column("text").nbytes
            if size >= ENCODE_CHARS:
                yield last
                held, size = [], 0
    yield from _slices(held)


def _slices(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if len(held) > 1:
        held = pa.Table.from_batches(held).combine_chunks().to_batches()
    for batch in held:
        for a, b in text_slices(batch.column("text"), ENCODE_CHARS):
            yield batch.slice(a, b - a)
