"""Operators without SQL against plain loops written from their descriptions, without their array code."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from tests.llm.data import documents, prose, rows
from tests.llm.test_classifiers import fixture
from tidewell.llm import arrays, ctph, html_text, toxicity

FULL = (1 << 64) - 1
BASE = int(arrays._BASE)
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def scrambled(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & FULL
    x = (x ^ x >> 27) * 0x94D049BB133111EB & FULL
    return x ^ x >> 31


# ── context-triggered piecewise hashes ───────────────────────────────────────

def plain_fingerprint(text):
    block = 3
    while len(text) > 64 * block:
        block *= 2
    spread = [scrambled(ord(c)) for c in text]
    single = [scrambled(ord(c) + 1) for c in text]
    sides = []
    for size in (block, 2 * block):
        letters, total, power, length = "", 0, 1, 0
        for i in range(len(text)):
            total, power, length = total + single[i] * power & FULL, power * BASE & FULL, length + 1
            window = sum(spread[i - back] * (2 * back + 0x9E3779B1) for back in range(min(7, i + 1))) & FULL
            if scrambled(window) % size == size - 1 or i == len(text) - 1:
                letters += LETTERS[scrambled(total + length & FULL) >> 58]
                total, power, length = 0, 1, 0
        sides.append(letters)
    return f"{block}:{sides[0]}:{sides[1]}"


def plain_pieces(a, b):
    run = max(1, min(7, min(len(a), len(b)) // 3))
    if not a or not b or not any(a[i: i + run] in b for i in range(len(a) - run + 1)):
        return 0.0
    row = list(range(len(b) + 1))  # insertions and deletions
    for i, c in enumerate(a, 1):
        before, row = row, [i]
        for j, d in enumerate(b, 1):
            row.append(before[j - 1] if c == d else 1 + min(before[j], row[-1]))
    return 1 - row[-1] / (len(a) + len(b))


def plain_likeness(a, b):
    if a == b:
        return 1.0
    sides = [{int(x.split(":")[0]) * f: x.split(":")[f] for f in (1, 2)} for x in (a, b)]
    return max((plain_pieces(sides[0][s], sides[1][s]) for s in sides[0].keys() & sides[1].keys()), default=0.0)


def test_fingerprints_by_a_plain_loop():
    pick = random.Random(3)
    texts = ["", "a", "aaaaaaaaaa" * 40, "é 日本 𝒳" * 60] + [prose(n, n) for n in (1, 5, 31, 200, 900)]
    texts += ["".join(pick.choice("ab \n") for _ in range(n)) for n in (6, 7, 8, 192, 193, 384, 385)]
    assert ctph.fingerprints(texts) == [plain_fingerprint(t) for t in texts]
    words = prose(500, 7).split()
    family = [" ".join(words[:n] + prose(m, n).split() + words[n + cut:]) for n, m, cut in ((0, 0, 0), (100, 9, 4), (250, 60, 0), (20, 300, 300), (250, 0, 250), (125, 0, 375))]
    prints = ctph.fingerprints(family + texts)
    for a in prints:
        for b in prints:
            assert ctph.likeness(a, b) == pytest.approx(plain_likeness(a, b), abs=1e-12)
    assert sum(0 < ctph.likeness(prints[0], b) < 1 for b in prints) >= 3


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_all_rows_meet_their_next(spark, partitions):
    """Null and repeated ids take their places, and the last row goes on with the first."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = ctph.compare_with_next(documents(spark, True)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    texts = spark.createDataFrame([(i, t or "") for i, t, *_ in rows()], "i long, t string").selectExpr("i", "t", "xxhash64(t) AS h").collect()
    order = sorted(texts, key=lambda r: (r.i is not None, r.i or 0, r.h, len(r.t)))
    known = {t: plain_fingerprint(t) for t in {r.t for r in order}}
    want = []
    for row, after in zip(order, order[1:] + order[:1]):
        edited = row.t[: len(row.t) - len(row.t) // 2] + after.t[: len(row.t) // 2]
        its = plain_fingerprint(edited)
        want.append((row.i, len(row.t), hashlib.sha256(edited.encode()).hexdigest(), known[row.t], its,
                     round(plain_likeness(known[row.t], its), 9), round(plain_likeness(known[row.t], known[after.t]), 9)))
    assert Counter(want) == Counter((*tuple(r)[:5], round(r.near_edited, 9), round(r.near_next, 9)) for r in got)


# ── toxicity ─────────────────────────────────────────────────────────────────

def plain_features(text):
    padded, found = f" {text.lower()} ", set()
    for size in (3, 4, 5):
        for i in range(len(padded) - size + 1):
            total = sum(scrambled(ord(c) + (k << 32)) for k, c in enumerate(padded[i: i + size])) & FULL
            found.add(scrambled(total + size - 1 & FULL) >> 44)
    return found


def test_features_by_a_plain_loop():
    texts = ["", "x", "abab", "É日本𝒳 É日本𝒳", prose(40, 1), "İ" * 9]
    flat, bounds = toxicity.features(texts)
    for text, a, b in zip(texts, bounds, bounds[1:]):
        found = flat[a:b].tolist()
        assert len(found) == len(set(found)) and set(found) == plain_features(text)


def test_toxicity_by_a_plain_loop(spark):
    """Which features count, by counting over all labelled rows; and the score of a text, by adding its weights."""
    docs, labels = fixture(spark)
    model = toxicity.train(docs, labels)
    truth = {}
    for r in labels.collect():
        if r.doc_id is not None and r.toxic is not None and zlib.crc32(str(r.doc_id).encode()) % 5:
            truth[r.doc_id] = max(truth.get(r.doc_id, 0), r.toxic)
    texts = {r.doc_id: r.text for r in docs.collect()}
    held = {i: plain_features(t) for i, t in texts.items()}
    counts = defaultdict(lambda: [0, 0])
    for i, label in truth.items():
        for f in held[i]:
            counts[f][label] += 1
    toxic = sum(truth.values())
    clean, share = len(truth) - toxic, toxic / len(truth)
    counted = set()
    for f, (c, t) in counts.items():
        ratio = math.log((t + share) / toxic) - math.log((c + 1 - share) / clean)
        if abs(t - (c + t) * share) / math.sqrt((c + t) * share * (1 - share)) >= 6 and abs(ratio) >= 0.7:
            counted.add(f)
    assert counted and set(model["weights"].nonzero()[0].tolist()) == counted
    for row in toxicity.score(docs, model).collect():
        z = model["bias"] + sum(float(model["weights"][f]) for f in held[row.doc_id])
        assert row.toxicity == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)


# ── main text ────────────────────────────────────────────────────────────────

@pytest.mark.parametrize("seed", range(20))
def test_surge_and_dive_by_definition(seed):
    """Without an article element a line stays if it has length and lies between a surge and the next dive."""
    pick = random.Random(seed)
    lines, page = [], ""
    for n in range(40):
        text = f"{n} " + "w" * pick.choice([0, 1, 5, 20, 26, 40, 79, 80, 200])
        linked = pick.random() < 0.45
        lines.append((text.strip(), 0 if linked else len(text.strip())))
        page += f"<p><a href='#'>{text}</a></p>" if linked else f"<div>{text}</div>"

    def window(i):
        return sum(length for _, length in lines[i: i + 3])

    def stays(i):
        surges = (j for j in range(i + 1) if lines[j][1] and window(j) >= 80)
        return lines[i][1] > 0 and any(all(window(m) > 0 for m in range(j, i + 1)) for j in surges)

    want = [text for i, (text, _) in enumerate(lines) if stays(i)]
    assert html_text.main_text(page) == "\n\n".join(want)
