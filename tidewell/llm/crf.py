"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. What a line looks like, and what its neighbours look
like, speaks for one of the two; a step from line to line favours staying or
changing. Forward-backward gives each line's probability of being good, and the
mean over the document, weighted by length, is its quality.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.arrays import flat_text, slice_hashes, text_batches, word_spans
from tidewell.llm.labelled import SAMPLE_ROWS, labelled_texts

#: Documents of each label whose lines come to the driver for the fit.
FIT_ROWS = 1_500

_LOWER, _UPPER, _DIGIT, _BLANK, _PLAIN, _ODD = range(6)
_BASE = 13


def char_kinds() -> np.ndarray:
    """Kind of every code point: other letter, upper case, digit, blank, plain punctuation, other sign."""
    table = np.full(0x110000, _ODD, np.uint8)
    for point in range(0x110000):
        category = unicodedata.category(chr(point))
        if category[0] in "LM":
            table[point] = _UPPER if category in ("Lu", "Lt") else _LOWER
        elif category[0] == "N":
            table[point] = _DIGIT
        elif category[0] == "Z" or 9 <= point <= 13:
            table[point] = _BLANK
    table[[ord(c) for c in ".,;:?'\"()-"]] = _PLAIN
    return table


def line_features(data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line (as it looks, not yet its neighbours), its code points, and the lines of each text."""
    breaks = np.flatnonzero(data == 10)
    n_texts = len(offsets) - 1
    owner = np.concatenate([np.searchsorted(offsets, breaks, side="right") - 1, np.arange(n_texts)])
    ends = np.concatenate([breaks, offsets[1:]])
    order = np.lexsort((ends, owner))
    owner, ends = owner[order], ends[order]
    first = np.concatenate([[True], owner[1:] != owner[:-1]]) if n_texts else np.zeros(0, bool)
    starts = np.where(first, offsets[owner], np.concatenate([[0], ends[:-1]]) + 1)
    n_lines = np.bincount(owner, minlength=n_texts)

    heads = (data & 0xC0) != 0x80
    at = np.concatenate([[0], np.cumsum(heads)])
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    kind = kinds[points]
    a, b = at[starts], at[ends]
    size = np.maximum(b - a, 1)

    def share(mask):
        sums = np.concatenate([[0], np.cumsum(mask)])
        return (sums[b] - sums[a]) / size

    repeated = np.zeros(len(kind), bool)
    repeated[1:] = (points[1:] == points[:-1]) & (kind[1:] != _BLANK)
    word_starts, word_ends, _ = word_spans(data, offsets)
    line_of = np.searchsorted(starts, word_starts, side="right") - 1
    words = slice_hashes(data, word_starts, word_ends)
    n_words = np.bincount(line_of, minlength=len(starts))
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (line_of[1:] == line_of[:-1])
    by_word = np.lexsort((words, line_of))
    new = np.ones(len(words), bool)
    new[1:] = (words[by_word][1:] != words[by_word][:-1]) | (line_of[by_word][1:] != line_of[by_word][:-1])
    distinct = np.bincount(line_of[by_word][new], minlength=len(starts))
    lines = slice_hashes(data, starts, ends)
    by_line = np.lexsort((lines, owner))
    new = np.ones(len(lines), bool)
    new[1:] = (lines[by_line][1:] != lines[by_line][:-1]) | (owner[by_line][1:] != owner[by_line][:-1])
    group = np.cumsum(new) - 1
    copies = np.empty(len(lines), np.int64)
    copies[by_line] = np.bincount(group)[group] if len(group) else 0
    letters = share((kind == _LOWER) | (kind == _UPPER))
    upper = share(kind == _UPPER)
    many = np.maximum(n_words, 1)
    base = np.stack([
        np.log1p(b - a), np.log1p(n_words), letters, upper / np.maximum(letters, 1e-3), share(kind == _DIGIT), share(kind == _BLANK),
        share(kind == _PLAIN), np.sqrt(share(kind == _ODD)), np.sqrt(share(repeated)), np.minimum((b - a) / many, 40),
        np.sqrt(np.bincount(line_of, again, len(starts)) / many), distinct / many * np.minimum(n_words, 30) / 30 + (1 - np.minimum(n_words, 30) / 30),
        np.log(copies),
    ], axis=1)
    return base, b - a, n_lines


def with_neighbours(base: np.ndarray, n_lines: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised features of a line, of the line before and the line after (zero at a text's ends), and 1."""
    own = np.clip((base - mean) / scale, -5, 5)
    last = np.cumsum(n_lines) - 1
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    if len(last):
        before[last[:-1] + 1], after[last] = 0, 0
    return np.hstack([own, before, after, np.ones((len(own), 1))])


def marginals(emit: np.ndarray, step: np.ndarray, n_lines: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of every line, and expected counts of the four steps; ``emit`` is log score (bad, good) per line.

    All texts move one line at a time together, those with most lines first.
    """
    order = np.argsort(-n_lines, kind="stable")
    first = (np.cumsum(n_lines) - n_lines)[order]
    sizes = n_lines[order]
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")  # texts with more than t lines
    local, move = np.exp(np.maximum(emit - emit.max(axis=1, keepdims=True), -60)), np.exp(step)
    forward, backward = np.empty_like(local), np.ones_like(local)
    for t in range(longest):
        rows = first[: active[t]] + t
        now = local[rows] * (forward[rows - 1] @ move) if t else local[rows].copy()
        forward[rows] = now / now.sum(axis=1, keepdims=True)
    pairs = np.zeros((2, 2))
    for t in range(longest - 2, -1, -1):
        rows = first[: active[t + 1]] + t
        ahead = local[rows + 1] * backward[rows + 1]
        joint = forward[rows][:, :, None] * move[None] * ahead[:, None, :]
        pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        now = ahead @ move.T
        backward[rows] = now / now.sum(axis=1, keepdims=True)
    both = forward * backward
    return both[:, 1] / both.sum(axis=1), pairs


def _fit(base, n_lines, labels, rounds: int = 120) -> dict:
    """Weights by gradient ascent of the labelled lines' likelihood; each document, and each label, weighs the same."""
    mean, scale = base.mean(axis=0), base.std(axis=0) + 1e-3
    x = with_neighbours(base, n_lines, mean, scale)
    good = np.repeat(labels > 0, n_lines)
    share = np.where(labels > 0, 0.5 / max((labels > 0).mean(), 1e-9), 0.5 / max((labels <= 0).mean(), 1e-9)) / len(labels)
    per_line = np.repeat(share / n_lines, n_lines)
    w, step = np.zeros(x.shape[1]), np.zeros((2, 2))
    m, v = np.zeros(len(w) + 4), np.zeros(len(w) + 4)
    seen = np.zeros((2, 2))
    seen[1, 1], seen[0, 0] = (n_lines - 1)[labels > 0].sum(), (n_lines - 1)[labels <= 0].sum()
    for k in range(1, rounds + 1):
        score = x @ w
        chance, pairs = marginals(np.stack([np.zeros_like(score), score], axis=1), step, n_lines)
        slope = x.T @ (per_line * (good - chance)) - 1e-4 * w
        steps = (seen - pairs) / max(seen.sum(), 1) - 1e-2 * step
        gradient = np.append(slope, steps.ravel())
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        move = 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
        w, step = w + move[:-4], step + move[-4:].reshape(2, 2)
    return {"mean": mean, "scale": scale, "weights": w, "step": step}


def quality_of(data, offsets, model: dict) -> np.ndarray:
    """Quality of each text: probabilities of its lines, weighted by their code points plus one."""
    base, chars, n_lines = line_features(data, offsets, model["kinds"])
    score = with_neighbours(base, n_lines, model["mean"], model["scale"]) @ model["weights"]
    chance, _ = marginals(np.stack([np.zeros_like(score), score], axis=1), model["step"], n_lines)
    owner = np.repeat(np.arange(len(n_lines)), n_lines)
    return np.bincount(owner, chance * (chars + 1), len(n_lines)) / np.bincount(owner, chars + 1, len(n_lines))


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, fit_rows: int = FIT_ROWS) -> dict:
    """A model of fixed size, fitted on up to ``fit_rows`` documents of each label among ``rows`` labelled ones.

    A document's label is that of all its lines. Held-out documents are never
    read. With one label only, or none, all scores are 1, 0, or 0.5.
    """
    kinds = char_kinds()
    known = labelled_texts(docs, labels, "quality", rows)
    shared = docs.sparkSession.sparkContext.broadcast(kinds)

    def describe(batches):
        for batch in text_batches(batches, "text"):
            base, _, n_lines = line_features(*flat_text(batch.column("text")), shared.value)
            bounds = np.concatenate([[0], np.cumsum(n_lines)]) * _BASE
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(base.astype(np.float32).ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("label"), lists], names=["label", "lines"])

    parts = [known.where(side).orderBy(F.xxhash64("doc_id", F.lit("fit")), "doc_id").limit(fit_rows) for side in ("label > 0", "label <= 0")]
    fit = parts[0].unionByName(parts[1]).mapInArrow(describe, "label int, lines array<float>").toArrow()
    labels_ = fit.column("label").to_numpy()
    lists = fit.column("lines").combine_chunks()
    n_lines = np.diff(lists.offsets.to_numpy()) // _BASE
    good, bad = int((labels_ > 0).sum()), int((labels_ <= 0).sum())
    if not good or not bad:
        flat = {"mean": np.zeros(_BASE), "scale": np.ones(_BASE), "weights": np.zeros(3 * _BASE + 1), "step": np.zeros((2, 2)), "kinds": kinds}
        flat["weights"][-1] = 30.0 * ((good > 0) - (bad > 0))
        return flat
    return _fit(lists.flatten().to_numpy().reshape(-1, _BASE).astype(np.float64), n_lines, labels_) | {"kinds": kinds}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with ``quality`` from 0 to 1; null text is empty, an empty text one empty line.

    A column of that name is replaced; others are carried along untouched.
    """
    docs = docs.drop("quality")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in text_batches(batches, "text"):
            yield batch.append_column("quality", pa.array(np.clip(quality_of(*flat_text(batch.column("text")), shared.value), 0, 1)))

    return docs.mapInArrow(run, f"{schema}, quality double")
