"""Texts as codes of their different words, and token ids of words looked up instead of encoded again."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from annolake.llm.windows import new_values, page_slices

#: Bytes of words that are given to a tokenizer as one text.
SLICE_BYTES = 256 << 10
#: Words that a task remembers before it starts afresh, and the bytes of one that it may remember.
MEMORY_WORDS = 300_000
MEMORY_BYTES = 32


def give_back() -> None:
    """Hand memory that a long-lived worker has freed back to the machine, where the C library can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def gathered(begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices of the runs ``[begin, begin + count)``, one run after the other."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(begins - (ends - counts), counts) + np.arange(total)


def run_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values[bounds[i]:bounds[i + 1]]`` for every ``i``; empty runs give 0."""
    upto = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return upto[bounds[1:]] - upto[bounds[:-1]]


def different(values: np.ndarray) -> np.ndarray:
    """Each value once, in order."""
    values = np.sort(values)
    return values[new_values(values)] if len(values) else values


def coded(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``(different words, code of each word)``."""
    found = words.dictionary_encode()
    return found.dictionary, found.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def one_text(words: pa.Array, between: str) -> str:
    """All words, ``between`` standing between any two; no Python string is made for a word."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), between)[0].as_py()


def joined_slices(words: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """``(first word, words, bytes of each)`` of runs of words that are short enough to be encoded as one text."""
    sizes = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    for start, stop in page_slices(words, limit):
        yield start, words.slice(start, stop - start), sizes[start:stop]


def in_one_text(
    words: pa.Array, odd: np.ndarray, as_one: Callable[[pa.Array, np.ndarray], tuple | None], each: Callable[[list[str]], tuple]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(flat ids, begin, count)`` of every word.

    ``as_one`` encodes many words as one text and gives ``(ids, ids per word)``, or None where it cannot
    tell where a word ends; those slices and the ``odd`` words are encoded one by one by ``each``.
    """
    begins, counts = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    parts, base = [np.zeros(0, np.uint32)], 0
    plain, strange = np.flatnonzero(~odd), np.flatnonzero(odd)
    for where, known in ((plain, True), (strange, False)):
        for start, some, sizes in joined_slices(words.take(pa.array(where))):
            ids, found = (as_one(some, sizes) if known else None) or each(some.to_pylist())
            at = where[start : start + len(some)]
            counts[at] = found
            begins[at] = base + np.cumsum(found) - found
            parts.append(ids)
            base += len(ids)
    return np.concatenate(parts), begins, counts


class Memory:
    """Ids of words met before in a task; ``encode`` gives ``(flat ids, begin, count)`` of new ones."""

    def __init__(self, encode: Callable[[pa.Array], tuple]) -> None:
        self.encode = encode
        self.forget()

    def forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.flat, self.counts = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def lookup(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(flat ids, begin, count)`` of every word; words are different."""
        if len(self.slots) > MEMORY_WORDS:
            self.forget()
        listed = words.to_pylist()
        slot = np.fromiter((self.slots.get(w, -1) for w in listed), np.int64, len(words))
        new = np.flatnonzero(slot < 0)
        some = words.take(pa.array(new))
        flat, begins, counts = self.encode(some)
        before = len(self.flat)
        known = np.cumsum(self.counts) - self.counts
        ids = np.concatenate([self.flat, flat])
        every_begin, every_count = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
        old = slot >= 0
        every_begin[old], every_count[old] = known[slot[old]], self.counts[slot[old]]
        every_begin[new], every_count[new] = before + begins, counts
        short = np.flatnonzero(pc.less_equal(pc.binary_length(some), MEMORY_BYTES).to_numpy(zero_copy_only=False))
        at = len(self.counts)
        self.slots.update(zip((listed[i] for i in new[short].tolist()), range(at, at + len(short)), strict=True))
        self.flat = np.concatenate([self.flat, flat[gathered(begins[short], counts[short])]])
        self.counts = np.concatenate([self.counts, counts[short]])
        return ids, every_begin, every_count


def squeezed(values: np.ndarray) -> bytes:
    """32-bit integers, compressed."""
    data = values.astype("<i4").tobytes()
    return len(data).to_bytes(8, "little") + pa.Codec("zstd").compress(data, asbytes=True)


def loosened(data: bytes | pa.Buffer) -> np.ndarray:
    data = memoryview(data)
    size = int.from_bytes(data[:8], "little")
    return np.frombuffer(pa.Codec("zstd").decompress(data[8:], size) if size else b"", "<i4").astype(np.int64)
