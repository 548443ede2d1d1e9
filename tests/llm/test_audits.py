import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from tests.llm.data import documents, empty, prose, rows
from tidewell.llm import divergence, terms
from tidewell.llm.divergence import audit_sources
from tidewell.llm.filter_audit import audit_filters, walk_subsets

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, lang string, source string"


def brute_divergence(table, min_docs, top):
    docs = []
    for _, text, lang, source, *_ in table:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        docs.append((lang or "", source or "", Counter(TERM.findall(low))))
    out = []
    for lang in {d[0] for d in docs}:
        held = Counter(t for d in docs if d[0] == lang for t in d[2])
        kept = [t for t, n in held.items() if n >= min_docs]
        def shares(groups):
            n = Counter()
            for d in groups:
                n.update({t: d[2][t] for t in kept if t in d[2]})
            total = sum(n.values()) + 2 * len(kept)
            return n, {t: 1 + 10 ** 9 * (n[t] + 2) // total for t in kept}
        own = {s: shares([d for d in docs if d[:2] == (lang, s)]) for s in {d[1] for d in docs if d[0] == lang}}
        q = shares([d for d in docs if d[0] == lang])[1]
        gap = lambda a, b: (a - b) ** 2 // (a + b)
        for s, (n, p) in own.items():
            pairs = sorted((-sum(gap(p[t], other[t]) for t in kept), o.encode()) for o, (_, other) in own.items() if o != s)
            best = sorted((-gap(p[t], q[t]), t.encode()) for t in kept if n[t] and p[t] > q[t])[:top]
            out += [(lang, s, part, item.decode(), -v, i + 1) for part, some in (("pair", pairs), ("term", best)) for i, (v, item) in enumerate(some)]
    return sorted(out)


def found_divergence(df, **options):
    return sorted(map(tuple, audit_sources(df, **options).select("lang", "source", "part", "item", "value", "rank").collect()))


@pytest.mark.parametrize("clashing", [False, True])
@pytest.mark.parametrize("min_docs", [1, 2, 10])
def test_divergence_of_all_cases(spark, clashing, min_docs):
    df = documents(spark, clashing)
    if clashing:
        df = df.selectExpr("*", "'x' AS term", "'x' AS n", "'x' AS p", "'x' AS docs")
    assert found_divergence(df, min_docs=min_docs) == brute_divergence(rows(), min_docs, 10)


def test_divergence_in_many_shards_and_small_partials(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SHARD_CELLS", 8)
    monkeypatch.setattr(divergence, "TEXT_BYTES", 200)
    pick = random.Random(3)
    vocabulary = ["été", "日本", "naïve", "Ärger", "Z", "[", "x-y", "a1b"] + [f"w{chr(97 + i)}" for i in range(20)]
    table = [(i, " ".join(pick.choices(vocabulary, k=pick.randint(0, 40))), pick.choice(["en", "de", None, ""]), pick.choice(["a", "b", "c", "é", None]))
             for i in range(150)]
    assert found_divergence(spark.createDataFrame(table, DOCS)) == brute_divergence(table, 10, 10)


def test_divergence_without_documents(spark):
    assert audit_sources(empty(spark)).count() == 0


def test_partial_counts_are_added_up_in_bounded_steps():
    import pyarrow as pa
    parts = [pa.table({"term": pa.array([f"t{i % 7}", f"u{i}"]).dictionary_encode(), "n": pa.array([1, 2], pa.int64())}) for i in range(50)]
    total = Counter()
    for batch in terms.merged_counts(iter(parts), ["term"], ["n"], held_rows=10):
        assert batch.num_rows <= 20
        for row in batch.to_pylist():
            total[row["term"]] += row["n"]
    assert total == Counter({**{f"t{k}": len(range(k, 50, 7)) for k in range(7)}, **{f"u{i}": 2 for i in range(50)}})


def brute_filters(table, labels):
    docs = []
    texts = [(d, t or "") for d, t, *_ in table]
    for doc_id, text, _, source, *_ in table:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text), "D": bool(re.search("[#$%&*|]", text)),
                 "E": doc_id is not None and any(d is not None and d < doc_id and t == text for d, t in texts)}
        known = [x for x in labels if x[0] == doc_id and doc_id is not None]
        docs.append((source or "", {f for f in fails if fails[f]}, any(x[1] == 1 for x in known), any(x[2] == 1 for x in known)))
    out = []
    for part in {d[0] for d in docs}:
        own, removed_by = [d for d in docs if d[0] == part], Counter()
        lines = []
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                removed_by[f] += len(gone)
                lines.append([part, "".join(order), step + 1, len(left), len(gone), sum(f in d[1] for d in own) - len(gone),
                              sum(d[1] == {f} for d in own), sum(d[2] for d in gone), sum(d[3] for d in gone), f])
        out += [tuple(line[:-1]) + (removed_by[line[-1]],) for line in lines]
    return sorted(out)


LABELS = [(1, 1, 0), (1, 0, 1), (3, 0, 1), (6, 1, None), (8, None, None), (None, 1, 1), (10, 1, 1), (99, 1, 1)]
CASES = [*rows(), (20, None, "en", "a", 0), (21, prose(250, 9), "en", "a", 0), (22, prose(250, 9), "en", None, 0), (22, prose(250, 9), "en", "b", 0),
         (23, prose(250, 9), "en", "", 0), (24, "word " * 300, "en", "b", 0), (25, "A" * 50 + " é" * 2450, "en", "b", 0), (26, "a\x1fb \x85c $", "en", "b", 0)]


@pytest.mark.parametrize("clashing", [False, True])
def test_filters_of_all_cases(spark, clashing):
    df = spark.createDataFrame(CASES, "doc_id long, text string, lang string, source string, n_chars long")
    if clashing:
        df = df.selectExpr("*", *[f"'x' AS {n}" for n in ("part", "mask", "digest", "copies", "repeats", "good", "toxic", "n")])
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert sorted(map(tuple, audit_filters(df, labels).collect())) == brute_filters(CASES, LABELS)


def test_filters_without_documents_or_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit_filters(empty(spark), labels).count() == 0
    got = sorted(map(tuple, audit_filters(documents(spark), labels).collect()))
    assert got == brute_filters(rows(), [])


def test_walk_visits_every_set():
    pick = np.random.default_rng(2)
    masks, counts = np.arange(32), pick.integers(0, 100, (32, 3))
    states = walk_subsets(masks, counts, 5)
    for chosen in range(32):
        assert (states[chosen] == counts[masks & chosen == 0].sum(axis=0)).all()
