"""Byte-level BPE in batches of texts: boundaries by scans over code point classes, cached pair merging, decoding.

The pattern that splits a text reads one code point at a time and needs little
memory, so it is a small automaton. Its steps are functions from state to
state; composing them is associative, and a prefix scan gives the state at all
code points at once, without a regular expression.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tidewell.llm.arrays import flat_codepoints, flat_text, ragged_ranges, slice_hashes, text_batches

# Classes of a code point and what follows it.
LETTER, NUMBER, OTHER, SPACE, LAST_BLANK, BLANK, SHORT, LONG = range(8)
# SPACE: U+0020, the last of its run before a non-blank; LAST_BLANK: another blank there; BLANK: all other blanks.
# SHORT, LONG: an apostrophe before a contraction of one or two letters.

# What was read last. JOINER: a space that joins what follows; ONE, TWO: letters left of a contraction; OVER: one has ended.
START, LETTERS, NUMBERS, OTHERS, JOINER, BLANKS, ONE, TWO, OVER = range(9)

#: Distinct pieces whose merges a worker remembers, and the length above which a piece is merged by a heap.
CACHE_PIECES = 100_000
LONG_PIECE = 128

_NONE = np.int32(2**31 - 1)


def _step(state: int, kind: int) -> tuple[int, bool]:
    """Next state, and whether a piece begins with this code point."""
    if kind in (SPACE, LAST_BLANK):
        return (JOINER if kind == SPACE else OVER), True
    if kind == BLANK:
        return BLANKS, state != BLANKS
    if state in (ONE, TWO):
        return (OVER if state == ONE else ONE), False
    if kind in (SHORT, LONG) and state not in (OTHERS, JOINER):
        return (ONE if kind == SHORT else TWO), True
    reached = {LETTER: LETTERS, NUMBER: NUMBERS}.get(kind, OTHERS)
    return reached, state not in (reached, JOINER)


def _automaton() -> dict:
    """Functions between states that compositions of steps can give, numbered, with their products."""
    steps = [tuple(_step(s, k)[0] for s in range(9)) for k in range(8)]
    firsts = [(f[START],) * 9 for f in steps]  # at a text's first code point
    known = list(dict.fromkeys(steps + firsts))
    for f in known:  # grows while new products turn up
        for g in steps + firsts:
            for h in (tuple(g[s] for s in f), tuple(f[s] for s in g)):
                if h not in known:
                    known.append(h)
    number = {f: i for i, f in enumerate(known)}
    compose = np.array([[number[tuple(g[s] for s in f)] for g in known] for f in known], np.uint16)
    return {
        "first": np.array([number[f] for f in firsts], np.uint16), "later": np.array([number[f] for f in steps], np.uint16),
        "compose": compose.ravel(), "n": len(known), "reached": np.array([f[START] for f in known], np.uint8),
        "begins": np.array([[_step(s, k)[1] for k in range(8)] for s in range(9)]).ravel(),
    }


def _scan(f: np.ndarray, compose: np.ndarray, n: int) -> np.ndarray:
    """Running compositions: within blocks of 64 by doubling, then over the blocks in the same way."""
    size = len(f)
    if size == 1:
        return f
    width = min(64, 1 << (size - 1).bit_length())
    rows = np.concatenate([f, np.repeat(f[-1:], -size % width)]).reshape(-1, width)
    step = 1
    while step < width:
        rows[:, step:] = compose[rows[:, :-step].astype(np.int32) * n + rows[:, step:]]
        step *= 2
    if len(rows) > 1:
        before = _scan(rows[:, -1].copy(), compose, n)[:-1]
        rows[1:] = compose[before[:, None].astype(np.int32) * n + rows[1:]]
    return rows.ravel()[:size]


def _classes() -> np.ndarray:
    """Letter, number, other or blank for every code point."""
    table = np.full(0x110000, OTHER, np.uint8)
    for point in range(0x110000):
        char = chr(point)
        kind = unicodedata.category(char)[0]
        if kind == "L":
            table[point] = LETTER
        elif kind == "N":
            table[point] = NUMBER
        elif char.isspace() and not 0x1C <= point <= 0x1F:
            table[point] = BLANK
    return table


def piece_starts(points: np.ndarray, offsets: np.ndarray, tables: dict) -> np.ndarray:
    """Indexes of the code points that begin a piece; ``offsets`` bound the texts."""
    if not len(points):
        return np.zeros(0, np.int64)
    base = tables["classes"][points]
    ends = offsets[1:][np.diff(offsets) > 0]
    starts = np.concatenate([[0], ends[:-1]])
    after = np.concatenate([points[1:], points[:1]])
    after_kind = np.concatenate([base[1:], base[:1]])
    after[ends - 1], after_kind[ends - 1] = 0, BLANK
    second = np.concatenate([after[1:], after[:1]])
    kind = base.copy()
    last = (base == BLANK) & (after_kind != BLANK)
    kind[last] = np.where(points[last] == 32, SPACE, LAST_BLANK)
    quote = np.flatnonzero(points == 39)
    one, two = after[quote], second[quote]
    kind[quote[np.isin(one, [ord(c) for c in "stmd"])]] = SHORT
    kind[quote[((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))]] = LONG
    functions = tables["later"][kind]
    functions[starts] = tables["first"][kind[starts]]
    state = tables["reached"][_scan(functions, tables["compose"], tables["n"])]
    before = np.concatenate([[START], state[:-1]])
    before[starts] = START
    begins = tables["begins"][before.astype(np.int32) * 8 + kind]
    begins[starts] = True
    return np.flatnonzero(begins)


def load_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a rank file (base64 token, rank; one a line)."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def build_tables(ranks: dict[bytes, int]) -> dict:
    """What the workers need, built once: fixed in size by the vocabulary, a few MB."""
    size = max(ranks.values()) + 1
    tokens = [b""] * size
    for token, rank in ranks.items():
        tokens[rank] = token
    pairs = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                pairs[left * size + right] = rank
    keys = np.array(sorted(pairs), np.int64)
    lengths = np.array([len(t) for t in tokens], np.int64)
    return {
        **_automaton(), "classes": _classes(), "ranks": ranks, "size": size,
        "pair_keys": keys, "pair_ranks": np.array([pairs[k] for k in keys.tolist()], np.int32),
        "bytes": np.array([ranks[bytes([b])] for b in range(256)], np.int32),
        "token_bytes": np.frombuffer(b"".join(tokens), np.uint8),
        "token_starts": np.concatenate([[0], np.cumsum(lengths)[:-1]]), "token_lengths": lengths,
    }


def _pair_ranks(left, right, tables):
    keys = left.astype(np.int64) * tables["size"] + right
    at = np.minimum(np.searchsorted(tables["pair_keys"], keys), len(tables["pair_keys"]) - 1)
    return np.where(tables["pair_keys"][at] == keys, tables["pair_ranks"][at], _NONE)


def _merge_long(ids: list[int], tables: dict) -> list[int]:
    """Merges of one long piece, lowest rank first, then leftmost."""
    n = len(ids)
    following, before, waiting = list(range(1, n + 1)), list(range(-1, n - 1)), []
    ranks = _pair_ranks(np.array(ids[:-1]), np.array(ids[1:]), tables)
    waiting = [(int(r), i, ids[i], ids[i + 1]) for i, r in enumerate(ranks) if r != _NONE]
    heapq.heapify(waiting)
    alive = [True] * n
    while waiting:
        rank, i, a, b = heapq.heappop(waiting)
        j = following[i] if alive[i] else n
        if not alive[i] or ids[i] != a or j >= n or ids[j] != b:
            continue
        ids[i], alive[j], following[i] = rank, False, following[j]
        if following[j] < n:
            before[following[j]] = i
        for left, right in ((before[i], i), (i, following[i])):
            if left >= 0 and right < n:
                found = int(_pair_ranks(np.array([ids[left]]), np.array([ids[right]]), tables)[0])
                if found != _NONE:
                    heapq.heappush(waiting, (found, left, ids[left], ids[right]))
    return [x for x, a in zip(ids, alive) if a]


def merge_pieces(pieces: list[bytes], tables: dict) -> list[list[int]]:
    """Token ids of every piece: all pieces take one merge a round, each its lowest rank, leftmost."""
    out: list = [None] * len(pieces)
    open_ = []
    for i, piece in enumerate(pieces):
        whole = tables["ranks"].get(piece)
        if whole is not None:
            out[i] = [whole]
        elif len(piece) > LONG_PIECE:
            out[i] = _merge_long(tables["bytes"][np.frombuffer(piece, np.uint8)].tolist(), tables)
        else:
            open_.append(i)
    if not open_:
        return out
    lengths = np.array([len(pieces[i]) for i in open_], np.int64)
    ids = tables["bytes"][np.frombuffer(b"".join(pieces[i] for i in open_), np.uint8)]
    owner = np.repeat(np.array(open_), lengths)
    ranks = np.full(len(ids), _NONE, np.int32)
    inner = np.flatnonzero(owner[1:] == owner[:-1])
    ranks[inner] = _pair_ranks(ids[inner], ids[inner + 1], tables)
    while len(ids):
        heads = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        sizes = np.diff(np.concatenate([heads, [len(ids)]]))
        least = np.minimum.reduceat(ranks, heads)
        over = least == _NONE
        if over.any():
            flat = ids.tolist()
            for a, size in zip(heads[over].tolist(), sizes[over].tolist()):
                out[owner[a]] = flat[a: a + size]
            kept = np.repeat(~over, sizes)
            ids, owner, ranks, least, sizes = ids[kept], owner[kept], ranks[kept], least[~over], sizes[~over]
            if not len(ids):
                break
        at = np.flatnonzero(ranks == np.repeat(least, sizes))
        at = at[np.concatenate([[True], owner[at[1:]] != owner[at[:-1]]])]
        ids[at] = ranks[at]
        kept = np.ones(len(ids), bool)
        kept[at + 1] = False
        at -= np.arange(len(at))  # each merge before it has taken one place
        ids, owner, ranks = ids[kept], owner[kept], ranks[kept]
        for left in (at - 1, at):
            ok = (left >= 0) & (left + 1 < len(ids))
            left = left[ok]
            same = owner[left] == owner[left + 1]
            ranks[left[same]] = _pair_ranks(ids[left[same]], ids[left[same] + 1], tables)
            ranks[left[~same]] = _NONE
        if owner[-1] == owner[len(ids) - 1]:
            ranks[-1] = _NONE
    return out


def encode_texts(data: np.ndarray, offsets: np.ndarray, tables: dict) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all tokens of flat UTF-8 texts, and the number of tokens of each text."""
    points, bounds = flat_codepoints(data, offsets)
    heads = np.flatnonzero((data & 0xC0) != 0x80)
    starts = heads[piece_starts(points, bounds, tables)]
    if not len(starts):
        return np.zeros(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
    ends = np.concatenate([starts[1:], [len(data)]])
    owner = np.searchsorted(offsets, starts, side="right") - 1
    distinct, first, inverse = np.unique(slice_hashes(data, starts, ends), return_index=True, return_inverse=True)
    cache = tables.setdefault("cache", {})
    keys = distinct.tolist()
    missing = [i for i, k in enumerate(keys) if k not in cache]
    if missing:
        if len(cache) + len(missing) > CACHE_PIECES:
            cache.clear()
            missing = range(len(keys))
        text = data.tobytes()
        at = first[missing]
        merged = merge_pieces([text[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())], tables)
        # Ids as packed bytes: a fifth of the memory of lists.
        cache.update(zip([keys[i] for i in missing], [array("i", ids).tobytes() for ids in merged]))
    pieces = [cache[k] for k in keys]
    lengths = np.array([len(p) for p in pieces], np.int64) // 4
    flat = np.frombuffer(b"".join(pieces), np.int32)
    begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    ids = flat[ragged_ranges(begin[inverse], lengths[inverse])]
    return ids, np.bincount(owner, lengths[inverse], len(offsets) - 1).astype(np.int64)


def decode_ids(ids: np.ndarray, tables: dict) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all tokens in order, and the offset at which each token begins (one more at the end)."""
    lengths = tables["token_lengths"][ids]
    data = tables["token_bytes"][ragged_ranges(tables["token_starts"][ids], lengths)]
    return data, np.concatenate([[0], np.cumsum(lengths)])


def share_tables(spark: SparkSession, path: str):
    """The vocabulary's tables for the workers: a few MB, whatever the data."""
    return spark.sparkContext.broadcast(build_tables(load_ranks(path)))


def _list_array(values: np.ndarray, counts: np.ndarray):
    bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(values))


def _fields(df: DataFrame) -> str:
    return "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema)


def _encoded(batches, column: str, tables: dict):
    for batch in text_batches(batches, column):
        data, offsets = flat_text(batch.column(column))
        ids, counts = encode_texts(data, offsets, tables)
        ends = np.cumsum(tables["token_lengths"][ids]) - np.repeat(offsets[:-1], counts)
        yield batch.append_column("ids", _list_array(ids, counts)).append_column(
            "token_ends", _list_array(ends.astype(np.int32), counts))


def _decoded(batches, tables: dict):
    for whole in batches:
        for start in range(0, whole.num_rows, 256):
            batch = whole.slice(start, 256)
            ids, ends = batch.column("ids"), batch.column("token_ends")
            data, _ = decode_ids(ids.flatten().to_numpy(), tables)
            counts = np.diff(ids.offsets.to_numpy())
            flat_ends = ends.flatten().to_numpy()
            sizes = np.where(counts > 0, flat_ends[np.maximum(np.cumsum(counts) - 1, 0)] if len(flat_ends) else 0, 0)
            bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            array = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
            yield batch.append_column("decoded", array.cast(pa.binary()))


def encode(docs: DataFrame, shared, column: str = "text") -> DataFrame:
    """``docs`` with ``ids`` and ``token_ends`` (byte offset in the text's UTF-8 at which each token ends).

    Null and empty texts have no tokens. Special tokens are ordinary text.
    Columns of docs named ids or token_ends are replaced.
    """
    docs = docs.drop("ids", "token_ends")
    return docs.mapInArrow(lambda batches: _encoded(batches, column, shared.value), _fields(docs) + "ids array<int>, token_ends array<int>")


def decode(encoded: DataFrame, shared) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of its ids; ``token_ends`` give the size of each text."""
    encoded = encoded.drop("decoded")
    return encoded.mapInArrow(lambda batches: _decoded(batches, shared.value), _fields(encoded) + "decoded binary")


def round_trip(docs: DataFrame, shared, column: str = "text") -> DataFrame:
    """``encode`` and ``decode`` one after the other on each batch, so that ids do not leave the worker in between."""
    docs = docs.drop("ids", "token_ends", "decoded")
    return docs.mapInArrow(lambda batches: _decoded(_encoded(batches, column, shared.value), shared.value),
                           _fields(docs) + "ids array<int>, token_ends array<int>, decoded binary")
