"""Text expressions: cleaning, tokens, keys, labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.fixed_values import CHAPTER_OF_LETTER, NA_TOKENS

NBSP = "\u00a0"


def literal_map(pairs: Mapping) -> Column:
    """A map literal from a small dict of fixed values."""
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def mapped(value: Column, pairs: Mapping, default: Column | None = None) -> Column:
    """``pairs[value]``, else ``default`` (null when none is given)."""
    found = F.try_element_at(literal_map(pairs), value)
    return found if default is None else F.coalesce(found, default)


def null_if_in(value: Column, tokens: Sequence[str] = NA_TOKENS) -> Column:
    return F.when(value.isin(*tokens), None).otherwise(value)


def null_tokens(df: DataFrame, tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Turn "no value" texts into null in every string column."""
    return df.select(*[
        null_if_in(F.col(f"`{name}`"), tokens).alias(name) if kind == "string" else F.col(f"`{name}`")
        for name, kind in df.dtypes
    ])


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def canonical_url(url: Column) -> Column:
    """Cut the query string, then one trailing slash."""
    return F.regexp_replace(F.regexp_replace(url, r"\?.*", ""), r"/$", "")


def absolute_url(path: Column, base: str) -> Column:
    """Empty stays empty, absolute stays, anything else is put under ``base``."""
    return (
        F.when(path.isNull() | (path == ""), F.lit(""))
        .when(path.startswith("http"), path)
        .otherwise(F.concat(F.lit(base), path))
    )


def https(uri: Column) -> Column:
    return F.replace(uri, F.lit("http://"), F.lit("https://"))


def extract_or_null(value: Column, pattern: str, group: int = 1) -> Column:
    """Regex group, null (not empty) when nothing matches."""
    return F.nullif(F.regexp_extract(value, pattern, group), F.lit(""))


def clean_text(value: Column) -> Column:
    """Lower-case; everything but ASCII letters, digits and blanks becomes a blank."""
    return F.regexp_replace(F.lower(F.coalesce(value, F.lit(""))), r"(?U)[^a-z0-9\s]", " ")


def words(cleaned: Column, min_len: int = 3) -> Column:
    """Distinct words of at least ``min_len`` characters, split at single blanks."""
    return F.array_distinct(
        F.filter(F.split(cleaned, " "), lambda w: F.char_length(w) >= min_len)
    )


def title_case(value: Column) -> Column:
    """Capitalise each run of letters and digits (``OTHER_GOV`` -> ``Other_Gov``)."""
    runs = F.regexp_extract_all(value, F.lit(r"(?U)\p{Alnum}+|[^\p{Alnum}]+"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def row_key(columns: Sequence[str], null_marker: str | None = None) -> Column:
    """``|``-joined key. Nulls are skipped, or shown as ``null_marker`` if given."""
    parts = [F.col(c).cast("string") for c in columns]
    if null_marker is not None:
        parts = [F.coalesce(p, F.lit(null_marker)) for p in parts]
    return F.concat_ws("|", *parts)


def icd_chapter(code: Column) -> Column:
    """Chapter of a code by its first character; unknown characters stay as they are."""
    first = F.lower(F.substring(code, 1, 1))
    return mapped(first, CHAPTER_OF_LETTER, first)


def no_nbsp(value: Column) -> Column:
    return F.replace(value, F.lit(NBSP), F.lit(" "))


def tag_topic(title: Column, description: Column, topics: Mapping[str, Sequence[str]],
              fallback: Column) -> Column:
    """First label, in the order of ``topics``, with a phrase in title or description."""
    haystack = F.lower(F.concat(
        F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(description, F.lit(""))
    ))
    tag = None
    for label, phrases in topics.items():
        hit = F.contains(haystack, F.lit(phrases[0]))
        for phrase in phrases[1:]:
            hit = hit | F.contains(haystack, F.lit(phrase))
        tag = F.when(hit, label) if tag is None else tag.when(hit, label)
    return fallback if tag is None else tag.otherwise(fallback)


def label_of(value: Column) -> Column:
    """Plain text of a JSON-LD label that was read as a string.

    The label may be a text, an object with ``@value`` (or ``label``), or a
    list of these, where the first English entry wins, else the first entry.
    """
    entry = "struct<`@language`: string, `@value`: string, label: string>"
    one = F.from_json(value, entry)
    items = F.from_json(value, "array<string>")
    english = F.get(F.filter(items, lambda x: F.get_json_object(x, "$.@language") == "en"), F.lit(0))
    first = F.get(items, F.lit(0))
    first_text = F.when(first.startswith("{"), F.get_json_object(first, "$.@value")).otherwise(first)
    text = (
        F.when(value.startswith("{") & one.isNotNull(),
               F.coalesce(blank_to_null(one["@value"]), one["label"], F.lit("")))
        .when(value.startswith("[") & items.isNotNull(),
              F.coalesce(F.get_json_object(english, "$.@value"), first_text, F.lit("")))
        .otherwise(value)
    )
    return F.coalesce(text, F.lit(""))
