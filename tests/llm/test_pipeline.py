from collections import Counter

import pytest

import corpus_pipeline as pipeline
from tests.llm.data import SCHEMA, documents, empty, prose
from tests.llm.test_bpe import REAL
from tests.llm.test_line_dedup import brute
from tests.llm.test_minhash import classes

COLUMNS = SCHEMA.replace(" long", "").replace(" string", "").split(", ")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Odd rows, clean prose, and documents with a word that only toxic ones hold."""
    path = str(tmp_path_factory.mktemp("tables"))
    more = [(100 + i, prose(50, 200 + i) + (" dreadfool" if i % 3 == 0 else ""), "en", "ab"[i % 2], 1) for i in range(120)]
    docs = documents(spark).unionByName(spark.createDataFrame(more, SCHEMA))
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(d, 1, int(t.endswith("dreadfool"))) for d, t, *_ in more[:100]], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{path}/labels.parquet")
    return path


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stages_take_effect(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for i, (name, stage) in enumerate(pipeline.STAGES):
        before = rows_of(docs)
        stage(spark, docs, folder).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = rows_of(docs)
        if name != "byte_bpe":
            assert docs.columns == COLUMNS
        if name == "toxicity":
            assert set(after) == {r for r in before if not (r[1] or "").endswith("dreadfool")}
            assert len(after) == len(before) - 40
        elif name == "line_dedup":
            kept = [(d, k) for d, _, _, k in brute(before)]
            assert sorted(((d, t or "") for d, t, *_ in after), key=repr) == sorted(kept, key=repr)
            assert all(r[4] == len(r[1] or "") for r in after)
        elif name == "near_dedup":
            assert set(after) <= set(before)
            want = [c for c in {c for _, c in classes(before)} if c is not None]
            assert sorted(d for d, *_ in after if d is not None) == sorted(want)
        elif name == "mixing":
            times = Counter(after)
            assert set(times) <= set(before) and max(times.values()) <= 2
            words = {r: len((r[1] or "").split()) for r in before}
            assert abs(sum(words[r] * n for r, n in times.items()) - 1.5 * sum(words.values())) <= max(words.values())
        else:
            texts = {r[0]: r[1] for r in before}
            assert len(after) == len(before)
            assert all(r.ids == REAL.encode_ordinary(texts[r.doc_id] or "") for r in docs.collect() if r.doc_id is not None)


def test_run_gives_the_last_stage(spark, folder):
    out = pipeline.run(spark, folder)
    assert {"doc_id", "ids", "ids_sha256", "decoded_sha256"} <= set(out.columns)
    first, again = (sorted(map(repr, pipeline.run(spark, folder).collect())) for _ in range(2))
    assert first == again and len(first) > 50


def test_empty_tables(spark, folder, tmp_path):
    empty(spark).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{folder}/labels.parquet").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_clashing_columns_ride_along(spark, folder):
    docs = documents(spark, clashing=True)
    for name, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == [c for c in docs.columns if not (name == "toxicity" and c == "toxicity")]


@pytest.mark.parametrize("known", ["false", "toxic = 1"])
def test_no_document_goes_as_toxic_without_labels_of_both_kinds(spark, folder, tmp_path, known):
    spark.read.parquet(f"{folder}/labels.parquet").where(known).write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert rows_of(pipeline.drop_toxic(spark, docs, str(tmp_path))) == rows_of(docs)
