import hashlib
import re
from collections import defaultdict

import pytest

from tests.llm.data import documents, empty, prose, rows
from tidewell.llm.ctph import compare_with_next, fingerprint_texts, fingerprints, likeness
from tidewell.llm.mixing import mix_sources, repeat_as_taken, source_targets


@pytest.mark.parametrize("clashing", [False, True])
def test_next_documents(spark, clashing):
    table = [(i, t) for i, t, *_ in rows()]
    got = compare_with_next(documents(spark, clashing)).collect()
    assert len(got) == len(table)
    known = [(i, t or "") for i, t in table if i is not None and i not in (4, 10)]
    known.sort()
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    for (i, text), (j, following) in zip(known, known[1:]):
        if (i, j) not in ((3, 5), (9, 11)):  # whose next documents are left out above
            half = len(text) // 2
            edited = text[: len(text) - half] + following[:half]
            row = by_id[i]
            mine, its, other = (fingerprints([t])[0] for t in (text, edited, following))
            assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
            assert (row.fingerprint, row.edited_fingerprint) == (mine, its)
            assert (row.near_edited, row.near_next) == (likeness(mine, its), likeness(mine, other))


def test_one_document_follows_itself(spark):
    one = compare_with_next(spark.createDataFrame([(1, prose(100, 1))], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert compare_with_next(empty(spark)).count() == 0


def test_likeness_falls_with_edits():
    text = prose(600, 4)
    a, same, half, other = fingerprints([text, text, text[:2000] + prose(300, 5), prose(600, 6)])
    assert likeness(a, same) == 1.0 and a == same
    assert 0.3 < likeness(a, half) < 1.0 and likeness(a, other) == 0.0
    assert fingerprints(["", "a"])[0] == "3::"


def test_fingerprint_column_is_replaced(spark):
    df = fingerprint_texts(documents(spark, True))
    assert df.columns.count("fingerprint") == 1
    assert {r.fingerprint for r in df.where("text IS NULL OR text = ''").collect()} == {"3::"}


def test_targets_share_the_budget(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 5), (None, 200), ("d", 0)], "source string, size long")
    targets = {r.source: r.target for r in source_targets(sizes).collect()}
    assert targets["a"] == 20.0 and targets["c"] == 10.0 and targets["d"] == 0.0
    assert abs(sum(targets.values()) - 1.5 * 1215) < 1e-6 and all(t <= 2 * s for t, s in ((targets["b"], 1000), (targets[None], 200)))


@pytest.mark.parametrize("clashing", [False, True])
def test_mix_of_odd_rows(spark, clashing):
    mix = mix_sources(documents(spark, clashing)).collect()
    words = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, *_ in rows()]
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size) for r in mix) == sorted((r[0] is None, r[0] or 0, n) for r, n in zip(rows(), words))
    assert all(r.taken in (0, r.size, 2 * r.size) for r in mix)
    assert abs(sum(r.taken for r in mix) - 1.5 * sum(words)) <= max(words)
    again = mix_sources(documents(spark)).collect()
    assert sorted(map(repr, mix)) == sorted(map(repr, again))


def test_mix_comes_near_its_targets(spark):
    docs = spark.createDataFrame([(i, prose(5 + i % 40, i), None, f"s{i % 7 if i % 3 else 0}", 0) for i in range(900)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    mix = mix_sources(docs)
    taken, targets = defaultdict(int), {}
    for r in mix.collect():
        taken[r.source] += r.taken
        targets[r.source] = r.target
    assert all(abs(taken[s] - targets[s]) <= 60 for s in targets)
    out = repeat_as_taken(docs, mix)
    assert out.columns == docs.columns
    assert out.count() == sum(r.taken // r.size for r in mix.collect())
    assert mix_sources(empty(spark)).count() == 0
