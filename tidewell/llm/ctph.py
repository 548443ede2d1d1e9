"""Context-triggered piecewise hashing: a fingerprint that stays alike where texts stay alike.

A rolling hash over seven code points ends a piece wherever it hits a value
that occurs once per block size on average, so that pieces realign after an
edit. Each piece gives one character. Fingerprints hold the pieces at one block
size and at its double, and are compared by edit distance where sizes meet.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.arrays import mix, slice_hashes, text_batches
from tidewell.session import cut_lineage

WINDOW = 7
LEAST_BLOCK = 3
#: Pieces aimed at: the block size is the smallest LEAST_BLOCK * 2^k that gives no more on average.
PIECES = 64
_LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)


def fingerprints(texts: list[str]) -> list[str]:
    """``block:pieces:pieces at twice the block`` of each text; an empty text has no pieces."""
    lengths = np.array([len(t) for t in texts], np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    doublings = np.ceil(np.log2(np.maximum(lengths / (LEAST_BLOCK * PIECES), 1))).astype(np.int64)
    blocks = LEAST_BLOCK << doublings
    if not len(points):
        return [f"{b}::" for b in blocks]
    owner = np.repeat(np.arange(len(texts)), lengths)
    since_start = np.arange(len(points)) - offsets[owner]
    spread = mix(points.astype(np.uint64))
    rolled = np.zeros(len(points), np.uint64)
    for back in range(min(WINDOW, len(points))):
        rolled[back:] += np.where(since_start[back:] >= back, spread[: len(points) - back], np.uint64(0)) * np.uint64(2 * back + 0x9E3779B1)
    rolled = mix(rolled)
    sides = []
    for factor in (1, 2):
        size = (blocks * factor)[owner].astype(np.uint64)
        last = rolled % size == size - np.uint64(1)
        last[offsets[1:][lengths > 0] - 1] = True
        ends = np.flatnonzero(last) + 1
        starts = np.concatenate([[0], ends[:-1]])
        letters = _LETTERS[(slice_hashes(points, starts, ends) >> np.uint64(58)).astype(np.int64)].tobytes().decode("ascii")
        at = np.searchsorted(ends, offsets, side="right")  # pieces that end at or before each text's start
        sides.append([letters[a:b] for a, b in zip(at[:-1], at[1:])])
    return [f"{b}:{one}:{two}" for b, one, two in zip(blocks, *sides)]


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, one bit per character of ``a``."""
    places = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = rest = (1 << len(a)) - 1
    for c in b:
        hit = rest & places.get(c, 0)
        rest = (rest + hit | rest - hit) & full
    return len(a) - rest.bit_count()


def _piece_likeness(a: str, b: str) -> float:
    """1 - edits / (len(a) + len(b)); an edit inserts or deletes, a change is both.

    Zero unless a run of seven pieces is common (of a third of the shorter
    one's, if it has under 21): chance matches of single letters mean nothing.
    """
    if not a or not b:
        return 0.0
    run = max(1, min(WINDOW, min(len(a), len(b)) // 3))
    seen = {a[i: i + run] for i in range(len(a) - run + 1)}
    if not any(b[i: i + run] in seen for i in range(len(b) - run + 1)):
        return 0.0
    return 2 * _common(a, b) / (len(a) + len(b))


def likeness(a: str, b: str) -> float:
    """0 to 1; fingerprints whose block sizes are not equal, double or half have nothing to compare."""
    if a == b:
        return 1.0
    (size_a, a1, a2), (size_b, b1, b2) = a.split(":"), b.split(":")
    size_a, size_b = int(size_a), int(size_b)
    if size_a == size_b:
        return max(_piece_likeness(a1, b1), _piece_likeness(a2, b2))
    if size_a == 2 * size_b:
        return _piece_likeness(a1, b2)
    return _piece_likeness(a2, b1) if size_b == 2 * size_a else 0.0


def fingerprint_texts(docs: DataFrame, column: str = "text") -> DataFrame:
    """``docs`` with a column ``fingerprint``; null text is empty. A column of that name is replaced."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "fingerprint")

    def stamp(batches):
        for batch in text_batches(batches, column):
            prints = fingerprints([t or "" for t in batch.column(column).to_pylist()])
            yield batch.append_column("fingerprint", pa.array(prints, pa.string()))

    return docs.drop("fingerprint").mapInArrow(stamp, schema + ", fingerprint string")


def _chain(batches):
    """Pairs of rows that follow each other in a partition; its first row, and its last, wait for their neighbours."""
    ids, texts, part = [], [], None
    for batch in text_batches(batches, "text"):
        part = batch.column("part")[0].as_py()
        if not ids:
            first = batch.column("doc_id")[0].as_py(), batch.column("text")[0].as_py() or ""
            yield _edge(part, "first", *first)
        ids += batch.column("doc_id").to_pylist()
        texts += [t or "" for t in batch.column("text").to_pylist()]
        yield _compared(ids[:-1], texts[:-1], texts[1:])
        ids, texts = ids[-1:], texts[-1:]
    if ids:
        yield _edge(part, "last", ids[0], texts[0])


_RESULT = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
           ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
_EDGE = [("part", pa.int32()), ("edge", pa.string()), ("text", pa.string())]
_RESULT_DDL = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
               "near_edited double, near_next double")


def _edge(part, edge, doc_id, text):
    values = {"doc_id": doc_id, "part": part, "edge": edge, "text": text}
    return pa.RecordBatch.from_arrays([pa.array([values.get(n)], t) for n, t in _RESULT + _EDGE], schema=pa.schema(_RESULT + _EDGE))


def _compared(ids, texts, following, edges: bool = True):
    edited = []
    for text, after in zip(texts, following):
        half = len(text) // 2
        edited.append(text[: len(text) - half] + after[:half])
    n = len(texts)
    prints = fingerprints([*texts, *following[-1:]])
    changed = fingerprints(edited)
    near = [likeness(a, b) for a, b in zip(prints, prints[1:])] if n else []
    columns = [ids, [len(t) for t in texts], [hashlib.sha256(t.encode()).hexdigest() for t in edited], prints[:n], changed,
               [likeness(a, b) for a, b in zip(prints, changed)], near]
    fields = _RESULT + (_EDGE if edges else [])
    columns += [[None] * n] * (len(fields) - len(columns))
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], schema=pa.schema(fields))


def _pairs(batches):
    for batch in text_batches(batches, "text"):
        following = batch.column("following").to_pylist()
        for i, (doc_id, text) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist())):
            yield _compared([doc_id], [text], [following[i]], edges=False)


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Each document against the next by doc_id, and against a text whose latter half is the next one's beginning.

    The edited text is the document without its last floor(n_chars / 2) code
    points, followed by as many (or all) first ones of the next document; the
    last document's next is the first. Rows are ordered by doc_id, null first,
    and among equal ids by a hash of the text, so equal rows are neighbours.
    Null text is empty; a single document follows itself. Texts are shuffled
    once, by range; only the two ends of each range meet a row of another one.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.char_length("text")]
    n = int(own.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = own.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    done = cut_lineage(dealt.mapInArrow(_chain, _RESULT_DDL + ", part int, edge string, text string"))
    edges = done.where(F.col("edge").isNotNull())
    firsts = edges.where("edge = 'first'").select(F.col("part").alias("first_part"), F.col("text").alias("following"))
    # One row per range; the last range goes on with the first.
    following_range = Window.orderBy("part")
    after = edges.where("edge = 'first'").select("part", F.coalesce(
        F.lead("part").over(following_range),
        F.first("part").over(following_range.rowsBetween(Window.unboundedPreceding, 0))).alias("first_part"))
    meeting = (edges.where("edge = 'last'").join(after, "part").join(firsts, "first_part")
               .select("doc_id", "text", "following").mapInArrow(_pairs, _RESULT_DDL))
    return done.where(F.col("edge").isNull()).select(*[name for name, _ in _RESULT]).unionByName(meeting)
