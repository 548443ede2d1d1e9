"""Scores worked out by hand from the rules; and both ways to reach the lexicon."""

import time
from math import sqrt

import pytest
from pyspark.sql import functions as F

from tidewell.operators import sentiment
from tidewell.operators.inplace import IN_PLACE
from tidewell.operators.sentiment import Rules, score_by_rules
from tidewell.operators.sizing import Bound

LEXICON = {"good": 1.9, "bad": -2.5, "great": 3.1, "kind": 2.4, "no": -1.2, "like": 1.5, ":)": 2.0, "very": 0.5}
RULES = Rules({"very": 0.293, "slightly": -0.293, "so": 0.293}, {"not", "never", "without", "nor"})
N = -0.74


def squeezed(x):
    return round(x / sqrt(x * x + 15), 4)


CASES = {
    "good": 1.9, "Good, bad.": 1.9 - 2.5, "nothing here": 0, "...": 0,
    "it was GOOD": 1.9 + 0.733, "it was BAD": -2.5 - 0.733, "GOOD BAD": -0.6,
    "so good": 1.9 + 0.293, "so bad": -2.5 - 0.293, "slightly good": 1.9 - 0.293,
    "so a good": 1.9 + 0.293 * 0.95, "so a x good": 1.9 + 0.293 * 0.9, "so a x y good": 1.9, "SO good": 1.9 + 0.293 + 0.733,
    "slightly so good": (1.9 + 0.293) - 0.293 * 0.95,
    "not good": 1.9 * N, "not a good": 1.9 * N, "not a x good": 1.9 * N, "not a x y good": 1.9, "isn't good": 1.9 * N,
    "not so good": (1.9 + 0.293) * N, "never so good": (1.9 + 0.293) * 1.25, "never this good": 1.9 * 1.25, "never good": 1.9 * N,
    "never x so good": (1.9 + 0.293) * 1.25, "without doubt good": 1.9, "without a doubt good": 1.9, "without good": 1.9 * N,
    "not bad good": -2.5 * N + 1.9 * N, "bad good": -0.6, "not like good": 1.5 * N + 1.9 * N,
    "least good": 1.9 * N, "at least good": 1.9, "the least good": 1.9 * N, "very least good": 1.9 + 0.0,
    "no good": 0 + 1.9 * N, "no": -1.2, "no x": -1.2, "no a good": -1.2 + 1.9 * N, "no bad nor good": 0 + -2.5 * N + (1.9 * N) * N,
    "kind of good": 1.9, "kind man": 2.4, "kind": 2.4,
    "good but bad": 1.9 * 0.5 - 2.5 * 1.5, "but good": 1.9 * 1.5, "good but": 1.9 * 0.5, "good but bad but good": 1.9 * 0.5 + (-2.5 + 1.9) * 1.5,
    "good!": 1.9 + 0.292, "good!!!!!!": 1.9 + 4 * 0.292, "bad!!": -2.5 - 2 * 0.292, "good?": 1.9, "good??": 1.9 + 0.36, "good????": 1.9 + 0.96, "x!!": 0,
    "good :)": 3.9, "(great)": 3.1, "\tgreat good\n": 5.0,
}


@pytest.mark.parametrize("bound", [IN_PLACE, Bound(max_rows=0)], ids=["in place", "joined"])
def test_cases_by_hand(spark, bound):
    lexicon = spark.createDataFrame(list(LEXICON.items()), "word string, score double")
    df = spark.createDataFrame([(t,) for t in [*CASES, "", None]], "t string").selectExpr("t", "t AS text")
    got = {r[0]: r[1] for r in score_by_rules(df, "t", "text", lexicon, RULES, bound).collect()}
    want = {t: squeezed(x) for t, x in CASES.items()}
    assert {t: (got.get(t), w) for t, w in want.items() if got.get(t) != w} == {} and len(got) == len(want)


def test_long_texts_and_no_lists(spark):
    lexicon = spark.createDataFrame(list(LEXICON.items()), "word string, score double")
    df = spark.createDataFrame([(1, "good bad " * 20_000), (2, "not very good")], "id int, t string")
    got = {r[0]: r[1] for r in score_by_rules(df, "id", "t", lexicon, Rules()).collect()}
    assert got[1] == -1.0 and got[2] == squeezed(1.9 + 0.5)


def test_small_pieces_blocks_and_caches(spark, monkeypatch):
    for name, value in {"PIECE_CHARS": 1, "BLOCK_WORDS": 2, "KNOWN_WORDS": 3}.items():
        monkeypatch.setattr(sentiment, name, value)
    lexicon = spark.createDataFrame(list(LEXICON.items()), "word string, score double")
    df = spark.createDataFrame([(t,) for t in CASES], "t string").selectExpr("t", "t AS text").coalesce(1)
    scores = score_by_rules(df, "t", "text", lexicon, RULES)
    assert {r[0]: r[1] for r in scores.collect()} == {t: squeezed(x) for t, x in CASES.items()}


def test_rules_keep_pace(spark):
    """Rules as expressions inside the row took seconds a MB; 32 MB in one task must not take a minute."""
    lexicon = spark.createDataFrame(list(LEXICON.items()), "word string, score double")
    words = "a plain word or two and then something very good but NOT a bad one, isn't it?\n" * 1_000
    df = spark.range(400).select("id", F.lit(words).alias("t")).coalesce(1)
    start = time.monotonic()
    assert {r[1] for r in score_by_rules(df, "id", "t", lexicon, RULES).collect()} == {1.0}
    assert time.monotonic() - start < 60


@pytest.mark.parametrize("text", ["good\x1cbad", "good\x85bad", "good　bad", "good​bad"])
def test_white_space_of_unicode(spark, text):
    lexicon = spark.createDataFrame(list(LEXICON.items()), "word string, score double")
    apart = text[4] in "\x85　"
    got = score_by_rules(spark.createDataFrame([(1, text)], "id int, t string"), "id", "t", lexicon, RULES).first()[1]
    assert got == (squeezed(-0.6) if apart else 0.0)
