"""Lexicon sentiment: the plain sum of word scores, and the full rules."""

from __future__ import annotations

import re
import sys
from collections.abc import Collection, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.operators.inplace import IN_PLACE
from tidewell.operators.sizing import Bound, salted_join

# Functions of this module travel to the workers with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NORMALISER = 15.0


def compound(total: Column) -> Column:
    """Sum of word scores squeezed to (-1, 1): ``x / sqrt(x^2 + 15)``."""
    return F.round(total / F.sqrt(total * total + F.lit(NORMALISER)), 4)


def score_sentiment(df: DataFrame, key: str, text: str, lexicon: DataFrame,
                    bound: Bound = Bound()) -> DataFrame:
    """(key, media_sentiment_score) for every row with a text.

    ``lexicon`` has (word, score), one row per word. Every occurrence of a
    word counts. ``key`` is unique in ``df``. This is the word-sum part of the
    published rule-based method, for which see :func:`score_by_rules`.
    """
    spoken = df.filter(F.col(text).isNotNull() & (F.col(text) != ""))
    # Outer punctuation is not part of a word; inner apostrophes and hyphens are.
    found = F.regexp_extract_all(
        F.lower(F.col(text)), F.lit(r"(?U)[\p{L}\p{N}](?:[\p{L}\p{N}'’-]*[\p{L}\p{N}])?"), F.lit(0))
    # The outer form keeps texts without any word.
    words = spoken.select(key, F.explode_outer(found).alias("word"))
    if bound.holds(lexicon):
        scored = words.join(F.broadcast(lexicon), "word", "left")
    else:
        scored = salted_join(words, lexicon, ["word"], F.col(key), how="left")
    total = F.coalesce(F.sum("score"), F.lit(0.0))
    return scored.groupBy(key).agg(compound(total).alias("media_sentiment_score"))


def with_sentiment(df: DataFrame, key: str, text: str, lexicon: DataFrame, rules: Rules | None = None) -> DataFrame:
    """``df`` plus ``media_sentiment_score``, by ``rules`` or as the word sum; null where there is no text."""
    scores = score_by_rules(df, key, text, lexicon, rules) if rules else score_sentiment(df, key, text, lexicon)
    return df.join(scores, key, "left")


# Fixed values of the published rule-based method.
CAPITALS = 0.733
NEGATED, INTENSIFIED = -0.74, 1.25
DAMPING = (1.0, 0.95, 0.9)
BEFORE_BUT, AFTER_BUT = 0.5, 1.5
EXCLAMATION, MOST_EXCLAMATIONS, QUESTION, MANY_QUESTIONS = 0.292, 4, 0.18, 0.96
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


@dataclass(frozen=True)
class Rules:
    """Word lists of the rule-based method, in lower case.

    ``boosters`` add their number to the strength of one of the three words
    after them (dampers have a negative one). ``negations`` turn it round, as
    does every word with ``n't``.
    """

    boosters: Mapping[str, float] = field(default_factory=dict)
    negations: Collection[str] = ()


# White space as Unicode has it; Python's own also counts four control characters.
_SPACES = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Characters of text that are cut into words at once, words that are scored together, and words whose marks are kept.
PIECE_CHARS, BLOCK_WORDS, KNOWN_WORDS = 1 << 20, 1 << 18, 1 << 16
_LONGEST_KNOWN = 64
#: Words that the rules name.
_NAMED = ("no", "or", "nor", "so", "this", "doubt", "never", "without", "kind", "of", "least", "at", "very", "but")


def _tokens(text: str):
    """Lists of the words of a text, with their punctuation; a long text is cut at white space."""
    find, space, start = re.compile(f"[^{_SPACES}]+").findall, re.compile(f"[{_SPACES}]").search, 0
    while start < len(text):
        cut = space(text, start + PIECE_CHARS)
        end = cut.start() if cut else len(text)
        yield find(text[start:end])
        start = end


def _word(token: str) -> str:
    bare = token.strip(PUNCTUATION)
    # Of one or two characters the punctuation may be all the sense.
    return token if len(bare) <= 2 else bare


class _Marks(dict):
    """Number of a token's mark, which is all that the rules know of it; 0 stands beyond both ends of a text."""

    def __init__(self, scores: Mapping[str, float | None], boosters: Mapping[str, float], negations: Collection[str]):
        self.scores, self.boosters, self.negations = scores, boosters, negations
        self.lists = {*scores, *boosters, *negations, *_NAMED}
        self.numbers = {("", None, False, None, False): 0}

    def __missing__(self, token: str) -> int:
        word = _word(token)
        low = word.lower()
        caps, negates = low != word and word.upper() == word, "n't" in low
        mark = (None, None, caps, None, negates)
        if low in self.lists:
            mark = (low if low in _NAMED else None, self.scores.get(low), caps, self.boosters.get(low), negates or low in self.negations)
        number = self.numbers.setdefault(mark, len(self.numbers))
        if len(self) < KNOWN_WORDS and len(token) <= _LONGEST_KNOWN:
            self[token] = number
        return number

    def of(self, text: str) -> np.ndarray:
        return np.concatenate([np.fromiter(map(self.__getitem__, some), np.int32, len(some)) for some in _tokens(text)])

    def columns(self):
        """By number: named word, score and whether it has one, capitals, boost and whether it has one, negates."""
        named, scores, caps, boosts, negates = zip(*self.numbers)
        return (np.array([_NAMED.index(w) if w in _NAMED else -1 for w in named]),
                np.array([0.0 if x is None else x for x in scores]), np.array([x is not None for x in scores]), np.array(caps),
                np.array([0.0 if x is None else x for x in boosts]), np.array([x is not None for x in boosts]), np.array(negates))


def _sums(texts: list[np.ndarray], marks: _Marks) -> np.ndarray:
    """For each text the sum of what its words add, by the marks of its words: their scores, changed by the three words before them."""
    named, score, scored, caps, boost, boosts, negates = marks.columns()
    # Three empty places between texts: words beyond an end are never those of another text.
    gap = np.zeros(3, np.int32)
    word = np.concatenate([x for text in texts for x in (gap, text)] + [gap])
    sizes = np.array([len(text) for text in texts])
    row = np.repeat(np.arange(len(texts) + 1), [*(sizes + 3), 3])
    loud_words = np.bincount(row[caps[word]], minlength=len(texts))[: len(texts)]
    mixed_case = (loud_words > 0) & (loud_words < sizes)
    but = np.full(len(texts), -1)
    turns = np.flatnonzero(named[word] == _NAMED.index("but"))
    turning, first = np.unique(row[turns], return_index=True)
    but[turning] = turns[first]

    # Words that are boosters, and "kind" before "of", add nothing.
    at = np.flatnonzero((scored & ~boosts)[word])
    one, after = word[at], word[at + 1]

    def said(words: np.ndarray, *some: str) -> np.ndarray:
        return np.isin(named, [_NAMED.index(w) for w in some])[words]

    heard = ~(said(one, "kind") & said(after, "of"))
    at, one, after = at[heard], one[heard], after[heard]
    before = [None, word[at - 1], word[at - 2], word[at - 3]]
    mixed = mixed_case[row[at]]

    def loud(strength: np.ndarray) -> np.ndarray:
        return np.where(strength > 0, CAPITALS, -CAPITALS)

    turned = said(before[1], "no") | said(before[2], "no") | (said(before[3], "no") & said(before[1], "or", "nor"))
    strength = np.where(said(one, "no") & scored[after], 0.0, np.where(turned, score[one] * NEGATED, score[one]))
    strength = strength + np.where(caps[one] & mixed, loud(strength), 0.0)
    so = [None, said(before[1], "so", "this"), said(before[2], "so", "this")]
    doubt = [None, said(before[1], "doubt"), said(before[2], "doubt")]
    plain = [None, *(np.where(negates[w], NEGATED, 1.0) for w in before[1:])]

    def factor(n: int, so: np.ndarray, doubt: np.ndarray) -> np.ndarray:
        return np.where(said(before[n], "never") & so, INTENSIFIED, np.where(said(before[n], "without") & doubt, 1.0, plain[n]))

    factors = [plain[1], factor(2, so[1], doubt[1]), factor(3, so[1] | so[2], doubt[1] | doubt[2])]
    for earlier, damp, change in zip(before[1:], DAMPING, factors):
        boosted = boost[earlier] * damp
        boosted = np.where(strength < 0, -boosted, boosted) + loud(strength) * np.where(caps[earlier] & mixed, damp, 0.0)
        # Words of the lexicon change nothing, nor do those before the text's start.
        acts = (earlier > 0) & ~scored[earlier]
        strength = np.where(acts, (strength + np.where(boosts[earlier], boosted, 0.0)) * change, strength)
    strength = strength * np.where(said(before[1], "least") & ~scored[before[1]] & ~said(before[2], "at", "very"), NEGATED, 1.0)
    turn = but[row[at]]
    strength = strength * np.where((turn < 0) | (at == turn), 1.0, np.where(at < turn, BEFORE_BUT, AFTER_BUT))
    # Added one after the other, as they stand in the text.
    return np.bincount(row[at], weights=strength, minlength=len(texts))[: len(texts)]


def _text(value: pa.BinaryScalar) -> str:
    return value.as_py().decode("utf-8", "replace")


def _distinct_words(batches):
    """(key, word) for every different word of a text, in lower case."""
    for batch in batches:
        for n, value in enumerate(batch.column(1).cast(pa.binary())):
            found = list({_word(token).lower() for some in _tokens(_text(value)) for token in some})
            for start in range(0, len(found), KNOWN_WORDS):
                some = found[start: start + KNOWN_WORDS]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([n] * len(some), pa.int64())), pa.array(some, pa.string())], names=["key", "word"])


def score_by_rules(df: DataFrame, key: str, text: str, lexicon: DataFrame, rules: Rules, bound: Bound = IN_PLACE) -> DataFrame:
    """(key, media_sentiment_score) for every row with a text, by the published rules.

    A word of the lexicon counts with its score; written in capitals amid other
    words it counts more. Boosters and negations among the three words before
    it change it, "least" turns it round, and so does "no". Words before the
    first "but" count half, those after it one and a half times. Exclamation
    marks (up to four) and two or more question marks add to the sum's size,
    which is then squeezed to (-1, 1). Idioms and emoji names are not known.

    ``lexicon`` has (word, score) in lower case, one row per word. ``key`` is
    unique in ``df``. A lexicon within ``bound`` travels to the tasks; beyond
    it a text first gets the scores of its own words by a join. Texts are cut
    into words once, a word becomes the number of what the rules know of it,
    and the rules work on arrays of these numbers, many texts at a time.
    """
    spoken = df.filter(F.col(text).isNotNull() & (F.col(text) != "")).select(F.col(key).alias("key"), F.col(text).alias("_text"))
    kind = spoken.schema["key"].dataType.simpleString()
    entries = lexicon.select(F.col("word").cast("string").alias("word"), F.col("score").cast("double").alias("score")).where("word IS NOT NULL").distinct()
    if bound.holds(entries):
        # Of several scores of a word the least counts.
        held = dict(entries.orderBy("word", F.col("score").desc()).collect())
    else:
        held, used = None, spoken.mapInArrow(_distinct_words, f"key {kind}, word string")
        known = salted_join(used, lexicon.select("word", F.col("score").cast("double").alias("score")), ["word"], F.col("key"))
        scores = known.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("word", "score"))).alias("_scores"))
        spoken = spoken.join(scores, "key", "left").select("key", "_text", "_scores")
    boosters, negations = {w: float(x) for w, x in rules.boosters.items()}, frozenset(rules.negations)

    def scan(batches):
        marks = _Marks(held or {}, boosters, negations)
        for batch in batches:
            start, texts, calls, asks, words = 0, [], [], [], 0
            for n, value in enumerate(batch.column(1).cast(pa.binary()), 1):
                if held is None:
                    marks = _Marks(dict(batch.column(2)[n - 1].as_py() or ()), boosters, negations)
                spelled = _text(value)
                texts.append(marks.of(spelled))
                calls.append(spelled.count("!"))
                asks.append(spelled.count("?"))
                words += len(texts[-1])
                if held is None or words >= BLOCK_WORDS or n == batch.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(start, n - start), pa.array(_sums(texts, marks), pa.float64()), pa.array(calls, pa.int64()), pa.array(asks, pa.int64())],
                        names=["key", "_sum", "_calls", "_asks"])
                    start, texts, calls, asks, words = n, [], [], [], 0

    summed = spoken.mapInArrow(scan, f"key {kind}, _sum double, _calls long, _asks long")
    emphasis = F.least("_calls", F.lit(MOST_EXCLAMATIONS)) * EXCLAMATION + F.when(
        F.col("_asks") > 3, MANY_QUESTIONS).when(F.col("_asks") > 1, F.col("_asks") * QUESTION).otherwise(0.0)
    return summed.select(F.col("key").alias(key), compound(F.col("_sum") + F.signum("_sum") * emphasis).alias("media_sentiment_score"))
