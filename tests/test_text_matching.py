import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewell.functions.text import clean_text, words
from tidewell.operators import containment, dedup, matching
from tidewell.operators.sizing import Bound
from tidewell.operators.sentiment import score_sentiment
from tidewell.session import cut_lineage

NONE = Bound(max_rows=0, max_bytes=0)
BOUNDS = pytest.mark.parametrize("bound", [Bound(), NONE], ids=["small", "large"])


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    letters = "abAB é\n."
    found = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(60)]
    return list(enumerate(found + ["𝒳ab 𝒳", "Crohn's disease", "100%_sure", "İstanbul"]))


@pytest.fixture(scope="module")
def terms(texts):
    rng = random.Random(4)
    cut = [t[i:i + rng.randint(1, 9)] for _, t in texts for i in [rng.randint(0, max(0, len(t) - 3))]]
    return sorted(set(cut + ["a", "𝒳", "%", "_s", "zzz", "", "AB"]))


@pytest.mark.parametrize("bound, chunk, bits", [(Bound(), 1 << 20, 24), (NONE, 1 << 20, 24), (Bound(), 64, 24), (Bound(), 1, 7)],
                         ids=["small", "large", "chunks", "full bitmaps"])
def test_containment_equals_brute_force(spark, texts, terms, bound, chunk, bits, monkeypatch):
    for name, value in {"CHUNK_BYTES": chunk, "SLOT_BITS": bits, "_WORDS": 1 << (bits - 6)}.items():
        monkeypatch.setattr(containment, name, value)
    df = spark.createDataFrame(texts + [(999, None)], "id int, text string")
    words_df = spark.createDataFrame([(t,) for t in terms], "term string")
    lower = {t: r[0] for t, r in zip(terms, words_df.select(F.lower("term")).collect())}
    low = {i: r[0] for i, r in zip([i for i, _ in texts], spark.createDataFrame(texts, "id int, text string").orderBy("id").select(F.lower("text")).collect())}
    want = {(i, t) for i, x in low.items() for t in terms if t and lower[t] in x}
    got = containment.mention_pairs(df, "id", "text", words_df, "term", "term", bound)
    assert {tuple(r) for r in got.collect()} == want
    counts = {r[0]: r[1] for r in containment.mention_counts(df, "id", "text", words_df, "term", "term", "n").collect()}
    assert counts == {t: sum(1 for _, u in want if u == t) for t in {u for _, u in want}}


def test_containment_hands_on_what_a_text_holds_when_it_ends(monkeypatch):
    """What is held does not grow with the texts of a batch: 80,000 matches in one batch of texts leave chunk by chunk, a long text's once."""
    monkeypatch.setattr(containment, "CHUNK_BYTES", 4096)
    terms = [f"w{n:03d}" for n in range(500)]
    marks = pa.Table.from_batches(containment._mark_terms([pa.RecordBatch.from_pydict({"t": terms})])).group_by("word").aggregate([("bits", "list")])
    marks = pa.table({"word": marks["word"], "bits": [int(np.bitwise_or.reduce(bits)) for bits in marks["bits_list"].to_pylist()]})
    texts = [" ".join(terms[(n + k) % 500] for k in range(3_000 if n == 7 else 400)) for n in range(200)]
    batch = pa.RecordBatch.from_pydict({"key": list(range(200)), "text": texts})
    parts = list(containment._scan(iter([batch]), *containment._sought(marks)))
    found = [(k, t) for part in parts for k, t in zip(part["key"].to_pylist(), part["term_text"].to_pylist())]
    assert sorted(found) == sorted({(n, t) for n, text in enumerate(texts) for t in text.split()})
    assert max(part.num_rows for part in parts) <= 4 * 500


def test_containment_of_long_texts_and_terms(spark):
    """Terms longer than a chunk, over its ends, repeated, and in a text that is one of many in a batch."""
    rng = random.Random(6)
    long = "".join(rng.choice("abcdé ") for _ in range(300_000))
    texts = [(0, ""), (1, long), (2, long[150_000:] + long[:150_000]), (3, "b"), (4, long[:70])]
    terms = [long[i: i + n] for i, n in ((0, 299_999), (5, 70_000), (65_500, 100), (131_072, 17), (200_000, 1), (299_990, 10), (0, 64), (0, 65), (0, 71))]
    got = containment.mention_pairs(spark.createDataFrame(texts, "id int, text string"), "id", "text",
                                    spark.createDataFrame([(t,) for t in terms], "term string"), "term", "term")
    assert {tuple(r) for r in got.collect()} == {(i, t) for i, x in texts for t in terms if t in x}


def test_name_match_is_two_way(spark):
    a = spark.createDataFrame([(1, "Malaria"), (2, "Breast cancer"), (3, "flu")], "a int, an string")
    b = spark.createDataFrame([(1, "cerebral MALARIA"), (2, "cancer"), (3, "cancer"), (4, "x")], "b int, bn string")
    got = {tuple(r) for r in containment.name_match(a, "a", "an", b, "b", "bn").collect()}
    assert got == {(1, 1), (2, 2), (2, 3)}


@pytest.fixture(scope="module")
def catalogue(spark):
    return spark.createDataFrame([
        ("1A00", "Cholera", ["vibrio infection", "asiatic cholera"], "certain_infectious"),
        ("2C61", "Malignant neoplasm of breast", ["breast cancer", "carcinoma of the breast"], "neoplasms"),
        ("5A11", "Type 2 diabetes mellitus", ["adult onset diabetes"], "endocrine"),
        ("DA42", "Gastritis", [], "digestive"), ("XA01", "Cholera vaccine", ["cholera shot"], "x"),
        ("6A02", "Autism spectrum disorder", ["adult onset diabetes"], "mental"),
    ], "icd_code string, title string, index_terms array<string>, chapter string")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([
        ("a", "Outbreak coded 1A00 and 9Z99", "see also é5A11, 2c61"),
        ("b", "Adult-onset diabetes in breast cancer", "carcinoma of the breast, asiatic cholera"),
        ("c", "type 2 diabetes mellitus cohort", None), ("d", None, None), ("e", "gastritis", "x"),
        ("f", "Gastritises", "choleraic shots"),
    ], "work_id string, title string, abstract string")


def test_code_mentions(docs, catalogue):
    usable = matching.searchable(catalogue)
    got = matching.match_codes(docs, "work_id", matching.title_and_abstract(), usable, "icd_code")
    # A letter with an accent is part of a word, so é5A11 is no mention.
    assert sorted(tuple(r) for r in got.collect()) == [("a", "1A00"), ("a", "2C61")]


@BOUNDS
def test_dictionary_longest_then_title(spark, docs, catalogue, bound):
    terms = matching.build_terms(matching.searchable(catalogue))
    got = matching.match_dictionary(docs, "work_id", F.col("title"), matching.title_and_abstract(), terms, bound)
    found = {r["work_id"]: (r["icd_code"], r["name"]) for r in got.collect()}
    assert found["b"] == ("2C61", "carcinoma of the breast")  # 4 words beat 3
    assert found["c"] == ("5A11", "type 2 diabetes mellitus")
    assert found["e"] == ("DA42", "gastritis")
    assert "f" not in found and "d" not in found  # single words match whole words; excluded chapter
    names = {r["name"]: r["icd_code"] for r in terms.collect()}
    assert names["adult onset diabetes"] == "5A11"  # shared name: smallest code


@BOUNDS
def test_dictionary_equals_brute_force(spark, bound):
    """Terms that begin or end inside words, share first words, stand in titles only, or begin with short words."""
    rng = random.Random(21)
    parts = ["heart", "heart attack", "art", "attack", "the", "of", "the heart", "art of the", "hearts", "x-ray", "zig\nzag", ""]
    def line(k):
        return " ".join(rng.choice(parts) for _ in range(rng.randint(0, k)))
    rows = [(i, line(2), line(9)) for i in range(80)] + [(80, None, None), (81, "the heart", None), (82, None, "THE, HEART")]
    names = sorted({t for t in (line(3) for _ in range(40)) if len(t) >= 5})
    cat = spark.createDataFrame([(f"c{i % 9}", t, []) for i, t in enumerate(names)], "icd_code string, title string, index_terms array<string>")
    terms = matching.build_terms(cat, clean_terms=True)
    d = spark.createDataFrame(rows, "id int, title string, text string")
    clean = {r["id"]: (f" {r['a'].strip(' ')} ", f" {r['b'].strip(' ')} ") for r in
             d.select("id", clean_text(F.col("title")).alias("a"), clean_text(F.col("text")).alias("b")).collect()}
    want = set()
    for key, (title, text) in clean.items():
        met = [(-r["wc"], r["search_name"] not in title, r["name"], r["icd_code"]) for r in terms.collect()
               if len(r["first_word"]) >= 3 and r["first_word"] in text.split(" ") and r["search_name"] in text]
        want |= {(key, min(met)[3], min(met)[2])} if met else set()
    got = matching.match_dictionary(d, "id", F.col("title"), F.col("text"), terms, bound)
    assert len(want) > 40 and {tuple(r) for r in got.collect()} == want


def test_dictionary_shuffles_no_text(spark, docs, catalogue):
    plan = matching.match_dictionary(docs, "work_id", F.col("title"), matching.title_and_abstract(), matching.build_terms(catalogue))
    lines = plan._jdf.queryExecution().executedPlan().toString().splitlines()
    scans = [i for i, line in enumerate(lines) if "MapInArrow" in line]
    assert len(scans) == 1 and any("Exchange" in line for line in lines[: scans[0]])
    depth = lines[scans[0]].index("MapInArrow")
    below = itertools.takewhile(lambda line: len(line) - len(line.lstrip(" :+-")) >= depth, lines[scans[0] + 1:])
    assert not any("Exchange" in line for line in below)  # what is scanned gives keys and terms only


def jaccard_brute(docs, cats, least, min_tokens):
    best = {}
    for key, a in docs.items():
        for code, b in cats.items():
            if len(a) < max(min_tokens, 1) or not a & b:
                continue
            score = len(a & b) / len(a | b)
            if score >= least:
                best.setdefault(key, []).append((score, code))
    return {(k, c) for k, v in best.items() for s, c in v if s == max(v)[0]}


@pytest.mark.parametrize("bound, frequent", [(Bound(), 4_096), (NONE, 4_096), (Bound(), 3), (Bound(), 0)], ids=["small", "large", "three", "none"])
@pytest.mark.parametrize("least", [0.2, 0.45, 0.5, 1.0])
def test_jaccard_equals_brute_force(spark, bound, frequent, least, monkeypatch):
    monkeypatch.setattr(matching, "FREQUENT_WORDS", frequent)
    rng = random.Random(9)
    vocabulary = [f"tok{i}" for i in range(25)]
    def bag():
        return " ".join(rng.choices(vocabulary, weights=[30 - i for i in range(25)], k=rng.randint(1, 9)))
    titles, cats = [(i, bag()) for i in range(80)], [(f"c{i}", bag()) for i in range(50)]
    d = spark.createDataFrame(titles, "id int, title string")
    c = spark.createDataFrame(cats, "icd_code string, title string").select(
        "icd_code", words(clean_text(F.col("title"))).alias("cat_tokens"))
    got = matching.match_jaccard(d, "id", F.col("title"), c, least, 3, bound)
    sets = {i: set(t.split()) for i, t in titles}
    want = jaccard_brute(sets, {k: set(t.split()) for k, t in cats}, least, 3)
    assert {(r["id"], r["icd_code"]) for r in got.collect()} == want


def test_cascade(spark, docs, catalogue):
    from tidewell.plans.publications import code_works
    from tidewell.schemas import PUBLICATIONS
    full = docs
    for f in PUBLICATIONS.fields:
        if f.name not in (*docs.columns, "icd_11_codes", "icd_11_titles", "icd_chapters", "match_method"):
            full = full.withColumn(f.name, F.lit(None).cast(f.dataType))
    found = {r["work_id"]: r for r in code_works(full, catalogue).collect()}
    assert found["a"]["match_method"] == "regex" and found["a"]["icd_11_codes"] == ["1A00", "2C61"]
    assert found["a"]["icd_11_titles"] == ["Cholera", "Malignant neoplasm of breast"]
    assert found["b"]["match_method"] == "substring" and found["b"]["icd_chapters"] == ["neoplasms"]
    assert found["d"]["match_method"] == "none" and found["d"]["icd_11_codes"] == []


def test_dedup_id_or_url_equals_a_loop(spark):
    rng = random.Random(11)
    rows = [(i, rng.choice(["", None] + [f"i{n}" for n in range(25)]), rng.choice(["", None] + [f"u{n}" for n in range(25)]))
            for i in range(150)]
    seen_ids, seen_urls, want = set(), set(), []
    for pos, id_, url in rows:
        if (id_ and id_ in seen_ids) or (url and url in seen_urls):
            continue
        seen_ids |= {id_} if id_ else set()
        seen_urls |= {url} if url else set()
        want.append(pos)
    got = dedup.dedup_id_or_url(spark.createDataFrame(rows, "pos int, id string, url string"), "id", "url", ["pos"])
    assert sorted(r["pos"] for r in got.collect()) == want


@BOUNDS
def test_sentiment_formula(spark, bound):
    lexicon = spark.createDataFrame([("good", 1.9), ("bad", -2.5)], "word string, score double")
    df = spark.createDataFrame([(1, "Good, GOOD news"), (2, "bad"), (3, "nothing"), (4, None), (5, ""), (6, "...")], "id int, t string")
    found = {r[0]: r[1] for r in score_sentiment(df, "id", "t", lexicon, bound).collect()}
    assert found == {1: 0.7003, 2: -0.5423, 3: 0.0, 6: 0.0}


@pytest.mark.parametrize("shuffled", [False, True])
def test_dedup_id_or_url_on_random_groups(spark, shuffled):
    """Chains of all lengths, stars, and keys that most rows share."""
    rng = random.Random(12)
    rows = [(i, f"i{i // 2}", f"u{(i + 1) // 2}") for i in range(60)] + [(i, "hub", f"v{rng.randint(0, 60)}") for i in range(60, 160)]
    rows += [(i, f"i{rng.randint(0, 120)}", rng.choice([None, "w", f"u{rng.randint(0, 120)}"])) for i in range(160, 400)]
    if shuffled:
        places = list(range(len(rows)))
        rng.shuffle(places)
        rows = sorted((places[i], a, b) for i, a, b in rows)
    seen, want = set(), []
    for pos, *keys in rows:
        if not any(k in seen for k in keys if k):
            seen.update(k for k in keys if k)
            want.append(pos)
    got = dedup.dedup_id_or_url(spark.createDataFrame(rows, "pos int, id string, url string"), "id", "url", ["pos"])
    assert sorted(r["pos"] for r in got.collect()) == want


def test_dedup_id_or_url_on_a_long_chain(spark, monkeypatch):
    """Each row shares a key with the next; the rounds grow with the logarithm."""
    n, written = 5_000, []
    monkeypatch.setattr(dedup, "cut_lineage", lambda df: written.append(1) or cut_lineage(df))
    rows = [(i, f"i{i // 2}", f"u{(i + 1) // 2}") for i in range(n)]
    got = dedup.dedup_id_or_url(spark.createDataFrame(rows, "pos int, id string, url string"), "id", "url", ["pos"])
    assert sorted(r["pos"] for r in got.collect()) == list(range(0, n, 2))
    assert len(written) <= 4 + 15  # the pairs, a round, its chains' rows, their settling; and the steps


def test_dedup_id_or_url_reads_two_rows_of_a_key(spark):
    """No task takes all rows of a key: they are cut to two before the shuffle."""
    rows = spark.createDataFrame([(1, "a", "b")], "pos int, id string, url string").selectExpr("id AS _id", "url AS _url", "struct(pos) AS _ord")
    plan = dedup._first_in_line(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 4 and "Python" not in plan and "Pandas" not in plan
