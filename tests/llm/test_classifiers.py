import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import tidewell.llm.queries as q
from tests.llm.data import documents, empty, prose
from tidewell.llm import crf, toxicity
from tidewell.llm.arrays import flat_text
from tidewell.llm.labelled import held_out, labelled_texts

FOLDER = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def fixture(spark):
    pick = random.Random(2)
    docs, labels = [], []
    for i in range(400):
        text, toxic, good = prose(60, i), i % 5 == 0, i % 7 != 0
        if toxic:
            words = text.split()
            words[pick.randrange(60)] = "dreadfool"
            text = " ".join(words)
        if not good:
            text = prose(5, i) + "\n" + " ".join(w.upper() + "!!!" for w in prose(60, i).split()) + "\n" + "la " * 40
        docs.append((i, text, "en", "a", 1))
        labels.append((i, int(good), int(toxic)))
    labels += [(5, 1, None), (None, 1, 1), (7, None, 0)]
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"),
            spark.createDataFrame(labels, LABELS))


@pytest.mark.parametrize("module, label, column", [(toxicity, "toxic", "toxicity"), (crf, "quality", "quality")])
def test_held_out_rows(spark, module, label, column):
    docs, labels = fixture(spark)
    scored = module.score(docs, module.train(docs, labels))
    known = labels.where(f"{label} IS NOT NULL").select("doc_id", F.col(label).alias("truth"))
    out = scored.join(known, "doc_id").where(held_out(F.col("doc_id"))).collect()
    right = sum((r[column] >= 0.5) == bool(r.truth) for r in out)
    assert len(out) > 50 and right >= 0.95 * len(out)
    assert all(0 <= r[column] <= 1 for r in out)


@pytest.mark.parametrize("module, label, column", [(toxicity, "toxic", "toxicity"), (crf, "quality", "quality")])
def test_odd_rows_and_missing_labels(spark, module, label, column):
    docs, labels = fixture(spark)
    model = module.train(docs, labels)
    scored = module.score(documents(spark, True), model)
    assert scored.count() == documents(spark).count() and scored.columns.count(column) == 1
    assert scored.where(f"{column} IS NULL OR {column} < 0 OR {column} > 1").count() == 0
    assert module.score(empty(spark), model).count() == 0
    for known in (labels.limit(0), labels.where(f"{label} = 1"), labels.where(f"{label} = 0")):
        assert module.score(docs.limit(3), module.train(docs, known)).where(f"{column} BETWEEN 0 AND 1").count() == 3


def test_nothing_is_learned_from_held_out_rows(spark):
    docs, labels = fixture(spark)
    known = labelled_texts(docs, labels, "toxic")
    assert known.where(held_out(F.col("doc_id"))).count() == 0
    assert labelled_texts(docs, labels, "toxic", rows=10).count() == 10
    assert known.where("doc_id = 5 AND label = 0").count() == 0  # of two labels the higher counts


def test_forward_backward_against_all_paths():
    pick = np.random.default_rng(4)
    n_lines = np.array([1, 4, 0, 3])
    emit, step = pick.normal(size=(8, 2)), pick.normal(size=(2, 2))
    chance, pairs = crf.marginals(emit, step, n_lines)
    want, counted = [], np.zeros((2, 2))
    for rows in np.split(emit, np.cumsum(n_lines)[:-1]):
        paths = list(itertools.product((0, 1), repeat=len(rows)))
        score = np.array([np.exp(sum(r[s] for r, s in zip(rows, p)) + sum(step[a, b] for a, b in zip(p, p[1:]))) for p in paths])
        score /= score.sum()
        want += [sum(w for w, p in zip(score, paths) if p[i]) for i in range(len(rows))]
        for w, p in zip(score, paths):
            for a, b in zip(p, p[1:]):
                counted[a, b] += w
    assert np.allclose(chance, want) and np.allclose(pairs, counted)


def test_lines_of_texts():
    texts = ["", "one\ntwo words\n", None, "\n", "ÄÖ | x\nÄÖ | x"]
    base, chars, n_lines = crf.line_features(*flat_text(pa.array(texts)), crf.char_kinds())
    assert n_lines.tolist() == [1, 3, 1, 2, 2] and chars.tolist() == [0, 3, 9, 0, 0, 0, 0, 6, 6]
    assert base.shape == (9, crf._BASE) and base[-1, -1] == np.log(2) and np.allclose(base[-1], base[-2])


@pytest.mark.parametrize("name, label, least", [("op8_toxicity", "toxic", 0.9), ("op5_quality", "quality", 0.95)])
def test_queries_on_held_out_documents(spark, name, label, least):
    out = q.QUERIES[name](spark, FOLDER)
    assert [f"{n} {t}" for n, t in out.dtypes] == ["doc_id bigint", "held_out boolean", "score double", "predicted int"]
    both = out.join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(both) > 50 and sum(r.predicted == r[label] for r in both) >= least * len(both)


def test_toxicity_of_short_texts_alone(spark):
    for text, n in (("", 0), ("x", 1), ("xy", 3)):
        found, bounds = toxicity.features([text])
        assert len(found) == n and bounds.tolist() == [0, n]
    docs, labels = fixture(spark)
    model = toxicity.train(docs, labels)
    for text in ("", None, "x"):
        alone = spark.createDataFrame([(1, text)], "doc_id long, text string").coalesce(1)
        assert 0 <= toxicity.score(alone, model).first().toxicity <= 1
