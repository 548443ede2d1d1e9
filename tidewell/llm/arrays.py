"""Texts of an Arrow batch as flat numpy arrays, and hashes of many slices at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on together; one longer text is a batch of its own.
BATCH_BYTES = 1 << 18

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def text_batches(batches, column: str, limit: int = BATCH_BYTES):
    """Cut record batches so that the texts of ``column`` stay near ``limit`` bytes."""
    for batch in batches:
        lengths = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for row, size in enumerate(lengths):
            if held and held + size > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)


def flat_text(array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string array and the n + 1 offsets of its texts; null is empty."""
    texts = array.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]] if len(offsets) else data, offsets - offsets[0]


def flat_codepoints(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes and the offsets counted in code points."""
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    return points, heads[offsets]


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every input bit moves every output bit."""
    x = values.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, base=_BASE) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def slice_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each slice, from differences of one running sum."""
    n = len(values)
    terms = mix(values.astype(np.uint64) + np.uint64(seed * 0x1F123BB5 + 1)) * powers(n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
    shift = powers(n + 1, _BASE_INVERSE)
    return mix((sums[ends] - sums[starts]) * shift[starts] + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every run of bytes outside ``[\\x20\\x09-\\x0D]``."""
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = solid[cuts]
    last[cuts - 1] = solid[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every run of ``size`` words; a shorter text is one run of all its words."""
    starts, ends, owner = word_spans(data, offsets)
    words = slice_hashes(data, starts, ends)
    n = len(words)
    counts = np.bincount(owner, minlength=len(offsets) - 1)
    at = np.concatenate([[0], np.cumsum(counts)])
    left = at[owner + 1] - np.arange(n)  # words from here to the text's end
    total = np.zeros(n, np.uint64)
    for k in range(size):
        follow = np.zeros(n, np.uint64)
        follow[: n - k] = words[k:]
        total = np.where(left > k, mix(total * _BASE + follow), total)
    kept = (left >= size) | ((counts[owner] < size) & (np.arange(n) == at[owner]))
    return total[kept], owner[kept]


def ragged_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of ``range(start, start + length)`` for each pair."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    return np.arange(total) + shift
