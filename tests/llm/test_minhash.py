import collections
import itertools
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.data import documents, empty, prose, rows
from tidewell.llm import minhash
from tidewell.llm.arrays import flat_text


def weights(text, size=5):
    words = (text or "").lower().split()
    grams = [tuple(words[k: k + size]) for k in range(max(1, len(words) - size + 1))] if words else []
    return {g: 1 + math.log(n) for g, n in collections.Counter(grams).items()}


def similarity(a, b):
    if not a and not b:
        return 1.0
    return sum(1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in a.keys() | b.keys()) for i in a.keys() & b.keys())


def classes(table):
    sets = [weights(r[1]) for r in table]
    group = list(range(len(table)))
    for i, j in itertools.combinations(range(len(table)), 2):
        if similarity(sets[i], sets[j]) >= 0.8:
            group = [group[i] if g == group[j] else g for g in group]
    least = {}
    for g, r in zip(group, table):
        if r[0] is not None:
            least[g] = min(least.get(g, r[0]), r[0])
    return sorted(((r[0], least.get(g)) for g, r in zip(group, table)), key=repr)


def found(df):
    return sorted(((r.doc_id, r.class_id) for r in minhash.near_duplicate_classes(df).collect()), key=repr)


@pytest.mark.parametrize("clashing", [False, True])
def test_classes_against_brute_force(spark, clashing):
    assert found(documents(spark, clashing)) == classes(rows())


def test_chains_of_edits_and_a_large_group(spark):
    """Copies with more and more edits: links exist between neighbours only, and many nodes share all buckets."""
    pick, table = random.Random(8), []
    for group in range(3):
        words = prose(80, 20 + group).split()
        for i in range(25):
            words = list(words)
            words[pick.randrange(80)] = f"edit{i}"
            table.append((group * 100 + i, " ".join(words)))
        seed = prose(80, 30 + group).split()
        for i in range(25):
            copy = list(seed)
            for _ in range(i % 6):
                copy[pick.randrange(80)] = f"other{i}"
            table.append((group * 100 + 50 + i, " ".join(copy)))
    assert found(spark.createDataFrame(table, "doc_id long, text string")) == classes(table)


def test_one_of_each_stays(spark):
    kept = minhash.keep_one_of_each(documents(spark, True))
    assert kept.columns == documents(spark, True).columns
    want = sorted({c for d, c in classes(rows()) if c is not None}) + [None]
    assert sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is None, x)) == want


def test_empty_table(spark):
    assert minhash.near_duplicate_classes(empty(spark)).count() == 0
    assert minhash.keep_one_of_each(empty(spark)).count() == 0


def test_sketch_estimates_probability_jaccard():
    a, b = prose(400, 1).split(), prose(400, 1).split()
    b[100:160] = prose(60, 9).split()
    data, offsets = flat_text(pa.array([" ".join(a), " ".join(b)]))
    owner, hashes, weight = minhash.weighted_shingles(data, offsets, 5)
    signature = minhash.sketch(owner, hashes, weight, 2, 4096)
    exact = similarity(weights(" ".join(a)), weights(" ".join(b)))
    assert abs((signature[0] == signature[1]).mean() - exact) < 0.03
    cut = np.searchsorted(owner, 1)
    assert abs(minhash.probability_jaccard(hashes[:cut], weight[:cut], hashes[cut:], weight[cut:]) - exact) < 1e-9


@pytest.mark.parametrize("common, union", [(12, 15), (48, 60), (52, 65)])
def test_pairs_of_exactly_the_threshold_are_linked(spark, common, union):
    """By the leader of a bucket, and where two components meet in a tile."""
    words = [f"w{i}" for i in range(union + 4)]
    table = [(1, " ".join(words)), (2, " ".join(words[: common + 4]))]
    assert found(spark.createDataFrame(table, "doc_id long, text string")) == [(1, 1), (2, 1)]
    texts = spark.createDataFrame([(bytes([i]), text) for i, text in table], "node binary, normal string")
    rows = minhash._profiles(texts, 5).collect()
    key = min(set(np.frombuffer(rows[0].own_bands, np.int64)) & set(np.frombuffer(rows[1].own_bands, np.int64)))
    rows = [r.asDict() | {"root": r.node, "is_open": i == 0} for i, r in enumerate(rows)]
    assert len(list(minhash._tile_links(key, rows, 0.8))) == 1


def test_profiles_keep_weights_exactly(spark):
    text = " ".join(["one two three"] * 700 + ["four five"] * 3)
    row = minhash._profiles(spark.createDataFrame([(b"n", text)], "node binary, normal string"), 5).first()
    _, hashes, weight = minhash.weighted_shingles(*flat_text(pa.array([text])), 5)
    kept = minhash._weighted(row.asDict())
    assert (kept[0] == hashes).all() and (kept[1] == weight).all()


def test_one_of_each_class_stays_where_ids_repeat_or_miss(spark):
    """Unrelated texts under one doc_id both stay; of near copies without ids one stays."""
    text, copy = prose(60, 41), prose(60, 41) + " end"
    table = [(5, prose(60, 42)), (5, prose(60, 43)), (None, text), (None, copy), (6, prose(60, 44)), (5, prose(60, 44) + " end")]
    kept = [tuple(r) for r in minhash.keep_one_of_each(spark.createDataFrame(table, "doc_id long, text string")).collect()]
    assert len(kept) == 4 and {table[0], table[1], table[5]} < set(kept)
    assert [r for r in kept if r[0] is None][0] in table[2:4]


def test_query_keeps_classes_of_one_doc_id_apart(spark, tmp_path):
    """Two unrelated texts under one doc_id share a class_id; their roots differ, and copies share both."""
    from tidewell.llm.queries import QUERIES
    one, other = prose(40, 1), prose(40, 2)
    spark.createDataFrame([(5, one), (5, other), (6, one), (7, other)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op1_near_dedup"](spark, str(tmp_path)).collect()
    assert {r.class_id for r in got} == {5} and len(got) == 4
    roots = {d: {r.root for r in got if r.doc_id == d} for d in (5, 6, 7)}
    assert len(roots[5]) == 2 and len(roots[6]) == len(roots[7]) == 1 and roots[6] | roots[7] == roots[5]
