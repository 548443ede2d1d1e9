import random

import numpy as np
import pytest

from tests.llm.data import documents, empty, rows
from tidewell.llm import perfect_hash
from tidewell.llm.line_dedup import dedup_lines

BLANKS = " \t\n\x0b\x0c\r"


def brute(table, min_chars=20, min_docs=3):
    def key(line):
        stripped = line.strip(BLANKS)
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in stripped)
    holders = {}
    for doc_id, text, *_ in table:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(doc_id)
    out = []
    for doc_id, text, *_ in table:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < min_docs
                or doc_id == max((h for h in holders[key(x)] if h is not None), default=None)]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def found(df, **options):
    got = dedup_lines(df, **options).select("row.doc_id", "n_lines", "n_dropped", "kept").collect()
    return sorted(map(tuple, got), key=repr)


@pytest.mark.parametrize("clashing", [False, True])
def test_lines_against_brute_force(spark, clashing):
    assert found(documents(spark, clashing)) == brute(rows())


def test_random_lines(spark):
    pick = random.Random(5)
    lines = [f"line number {i} of them all" for i in range(40)] + ["short", ""]
    table = [(i, "\n".join(pick.choice(lines) for _ in range(pick.randint(0, 8)))) for i in range(200)]
    assert found(spark.createDataFrame(table, "doc_id long, text string")) == brute(table)


def test_empty_table(spark):
    assert dedup_lines(empty(spark)).count() == 0


def test_perfect_hash_is_minimal():
    pick = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 20_000):
        h1, h2 = pick.integers(0, 1 << 63, n, dtype=np.uint64), pick.integers(0, 1 << 63, n, dtype=np.uint64)
        h1[: n // 10] = h1[:1].repeat(n // 10) if n else h1[:0]  # equal first halves are told apart by the second
        table = perfect_hash.build(h1, h2)
        assert sorted(perfect_hash.slots(*table, h1, h2).tolist()) == list(range(n))
