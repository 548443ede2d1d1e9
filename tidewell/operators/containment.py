"""Which texts contain which terms, as plain substrings, ignoring case.

The result is exactly that of ``lower(text) LIKE '%' || lower(term) || '%'``
without wildcards; a nested loop over texts and terms is never formed, and no
text is shuffled.

* A term of L bytes is known by its length and the hashes of its first and its
  last 2^k bytes, the largest power of two within L: together they cover it.
  Terms mark their hashes in two bitmaps of fixed size, whatever their number.
* Texts are scanned as byte arrays. Hashes of windows of 1, 2, 4, … bytes come
  by doubling; a position whose window is marked is tried with each length that
  terms of this size have, by two lookups of hashes. Only slices that pass both
  bitmaps are made into strings, and an equi join with the terms decides.
"""

from __future__ import annotations

import sys
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators.sizing import Bound, salted_join

# Functions of this module travel to the workers with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TERM_BOUND = Bound(max_rows=1_000_000, max_bytes=64 * 1024 * 1024)
#: log2 of the slots of a bitmap (2 MB each), bytes of text that are hashed together, and matches that are strings at once.
SLOT_BITS = 24
CHUNK_BYTES = 1 << 18
HITS = 50_000

_WORDS = 1 << (SLOT_BITS - 6)
_ONE, _TWO = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two pieces in a row, from their hashes."""
    x = a * _ONE + (b ^ (b >> np.uint64(32))) * _TWO
    return x ^ (x >> np.uint64(29))


def _window_hashes(data: np.ndarray, levels):
    """(level, size, hashes of all windows of ``size`` = 2^level bytes) for each of ``levels``."""
    each = np.arange(1, 257, dtype=np.uint64)
    hashes, size = _joined(each * _TWO, each)[data], 1
    for level in range(max(levels, default=-1) + 1):
        if level in levels:
            yield level, size, hashes
        hashes, size = _joined(hashes[:-size], hashes[size:]), size * 2


def _whole_hash(first: np.ndarray, last: np.ndarray, length) -> np.ndarray:
    return _joined(_joined(first, last), np.atleast_1d(length).astype(np.uint64))


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def _flat(texts) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each begins and the last one ends."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + len(texts) + 1]
    held = texts.buffers()[2]
    return np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8), offsets


def _mark_terms(batches):
    """(word, bits, rows, bytes): marks of both bitmaps; words below 0 stand for lengths of terms."""
    for batch in batches:
        data, offsets = _flat(batch.column(0))
        starts, lengths = offsets[:-1], np.diff(offsets)
        levels = np.frexp(lengths)[1] - 1
        for level, size, hashes in _window_hashes(data, set(levels.tolist())):
            own = levels == level
            first, last = hashes[starts[own]], hashes[starts[own] + lengths[own] - size]
            slots = np.concatenate([_slot(first), _slot(_whole_hash(first, last, lengths[own])) + (1 << SLOT_BITS)])
            some = np.unique(lengths[own], return_counts=True)
            nothing = np.zeros(len(slots), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([slots >> 6, -some[0]])),
                 pa.array(np.concatenate([(np.uint64(1) << (slots & 63).astype(np.uint64)).view(np.int64), np.zeros(len(some[0]), np.int64)])),
                 pa.array(np.concatenate([nothing, some[1]])), pa.array(np.concatenate([nothing, some[0] * some[1]]))],
                names=["word", "bits", "rows", "bytes"])


def _slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    lengths = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    taken = data[np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)]
    return pa.LargeStringArray.from_buffers(len(lengths), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(taken))


def _distinct(met: pa.Table | None, rows: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Table | None:
    """``met`` (row, term_text) with further slices, each once; few are strings at a time."""
    parts = [] if met is None else [met]
    for first in range(0, len(rows), HITS):
        some = slice(first, first + HITS)
        parts.append(pa.table({"row": rows[some], "term_text": _slices(data, starts[some], ends[some])}).group_by(["row", "term_text"]).aggregate([]))
    return pa.concat_tables(parts).group_by(["row", "term_text"]).aggregate([]) if parts else None


def _sought(found: pa.Table) -> tuple[np.ndarray, dict[int, list[int]]]:
    """Both bitmaps, and the lengths of terms by their level, from all marks."""
    words, bits = found.column("word").to_numpy(), found.column("bits").to_numpy()
    bitmaps = np.zeros(2 * _WORDS, np.int64)
    bitmaps[words[words >= 0]] = bits[words >= 0]
    lengths = defaultdict(list)
    for length in sorted(-words[words < 0]):
        lengths[int(length).bit_length() - 1].append(int(length))
    return bitmaps, dict(lengths)


def _scan(batches, bitmaps: np.ndarray, lengths: dict[int, list[int]]):
    """(key, term_text), each once, for batches of (key, text); what is held grows with a chunk and with one text's terms."""
    firsts, wholes = np.unpackbits(bitmaps.view(np.uint8), bitorder="little").view(bool).reshape(2, -1)
    longest = max((some[-1] for some in lengths.values()), default=1)
    for batch in batches:
        keys = batch.column(0)
        data, offsets = _flat(batch.column(1))
        met = None
        for start in range(int(offsets[0]), int(offsets[-1]), CHUNK_BYTES):
            end = min(start + CHUNK_BYTES, int(offsets[-1]))
            block = data[start: min(end + longest - 1, int(offsets[-1]))]
            at, until = [], []
            for level, size, hashes in _window_hashes(block, set(lengths)):
                marked = np.flatnonzero(firsts[_slot(hashes[: end - start])])
                for length in lengths[level] if len(marked) else ():
                    inside = marked[: np.searchsorted(marked, len(block) - length, side="right")]
                    whole = _whole_hash(hashes[inside], hashes[inside + length - size], length)
                    inside = inside[wholes[_slot(whole)]]
                    at.append(inside + start)
                    until.append(inside + (start + length))
            if at:
                at, until = np.concatenate(at), np.concatenate(until)
                row = np.searchsorted(offsets, at, side="right") - 1
                kept = until <= offsets[row + 1]
                met = _distinct(met, row[kept], data, at[kept], until[kept])
            if met is None:
                continue
            # Texts that end here are done; only what the one that goes on has met is kept.
            going = int(np.searchsorted(offsets, end, side="right")) - 1 if end < offsets[-1] else len(keys)
            done, met = met.filter(pc.less(met["row"], going)), met.filter(pc.greater_equal(met["row"], going))
            for some in done.to_batches(max_chunksize=HITS):
                yield pa.RecordBatch.from_arrays([keys.take(some.column(0)), some.column(1).cast(pa.string())], names=["key", "term_text"])


def _candidates(texts: DataFrame, key: str, text: str, names: DataFrame) -> tuple[DataFrame, int, int]:
    """Distinct (key, term_text) per row of ``texts``, which hold all that are terms; and rows and bytes of ``names``."""
    marks = (names.select("term_text").mapInArrow(_mark_terms, "word long, bits long, rows long, bytes long")
             .groupBy("word").agg(F.bit_or("bits").alias("bits"), F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")))
    # At most the words of two bitmaps and one row per length of a term.
    found = marks.toArrow()
    bitmaps, lengths = _sought(found)
    shared = names.sparkSession.sparkContext.broadcast(bitmaps)
    low = texts.filter(F.col(text).isNotNull()).select(F.col(key), F.lower(F.col(text)).alias("_text"))
    hits = low.mapInArrow(lambda batches: _scan(batches, shared.value, lengths), f"key {low.schema[key].dataType.simpleString()}, term_text string")
    return hits.withColumnRenamed("key", key), sum(found.column("rows").to_pylist()), sum(found.column("bytes").to_pylist())


def _names(terms: DataFrame, term_key: str, term: str) -> DataFrame:
    return (terms.select(F.col(term_key).alias("_term_key"), F.lower(F.col(term)).alias("term_text"))
            .filter(F.octet_length("term_text") > 0).distinct())


# ── uses ─────────────────────────────────────────────────────────────────────

def mention_pairs(texts: DataFrame, key: str, text: str, terms: DataFrame, term_key: str,
                  term: str, bound: Bound = TERM_BOUND) -> DataFrame:
    """Distinct (key, term_key) for every term whose name is mentioned in the text.

    ``key`` is unique in ``texts``. Blank names match nothing.
    """
    names = _names(terms, term_key, term)
    hits, rows, used = _candidates(texts, key, text, names)
    if rows <= bound.max_rows and used <= bound.max_bytes:
        named = hits.join(F.broadcast(names), "term_text")
    else:
        named = salted_join(hits, names, ["term_text"], F.col(key))
    return named.select(key, F.col("_term_key").alias(term_key)).distinct()


def mention_counts(texts: DataFrame, key: str, text: str, terms: DataFrame, term_key: str,
                   term: str, out: str) -> DataFrame:
    """Texts per term: (term_key, out); terms without a mention are absent.

    ``terms`` has one name per key. Counted per distinct name first, so a name
    shared by several terms is counted once, and a name that most texts mention
    is counted map-side.
    """
    names = _names(terms, term_key, term)
    hits, _, _ = _candidates(texts, key, text, names)
    counts = hits.groupBy("term_text").agg(F.count(F.lit(1)).alias(out))
    return counts.join(names, "term_text").select(F.col("_term_key").alias(term_key), out)


def name_match(a: DataFrame, a_key: str, a_name: str, b: DataFrame, b_key: str, b_name: str,
               bound: Bound = TERM_BOUND) -> DataFrame:
    """Distinct (a_key, b_key) where either name contains the other, ignoring case."""
    def one_way(long: DataFrame, long_key: str, long_name: str,
                short: DataFrame, short_key: str, short_name: str) -> DataFrame:
        # Work on distinct names: many keys may share one.
        keyed = long.select(long_key, F.lower(F.col(long_name)).alias("_name"))
        names = keyed.select("_name", F.col("_name").alias("_copy")).distinct()
        pairs = mention_pairs(names, "_name", "_copy", short, short_key, short_name, bound)
        return pairs.join(keyed, "_name").select(a_key, b_key)

    return one_way(a, a_key, a_name, b, b_key, b_name).unionByName(
        one_way(b, b_key, b_name, a, a_key, a_name)).distinct()
