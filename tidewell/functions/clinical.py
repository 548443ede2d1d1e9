"""Expressions for trial fields: ages, phases, locations, statuses, interventions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewell.functions.fixed_values import (
    AGE_BUCKETS, LOCATION_STATUS_DEFAULT, TRIAL_STATUS, UNIT_DAYS,
)
from tidewell.functions.text import extract_or_null, mapped, null_if_in

_NUMBER = r"(\d+(?:\.\d+)?)\s+\w+"
_UNIT = r"\d+(?:\.\d+)?\s+(\w+)"


def age_number(text: Column) -> Column:
    return extract_or_null(text, _NUMBER)


def age_unit(text: Column) -> Column:
    """Unit word in lower case, always plural."""
    unit = F.lower(extract_or_null(text, _UNIT))
    return F.when(unit.endswith("s"), unit).otherwise(F.concat(unit, F.lit("s")))


def age_days(text: Column) -> Column:
    """``18 Years`` -> 6570."""
    days = age_number(text).try_cast("double") * mapped(age_unit(text), UNIT_DAYS)
    return F.round(days, 0).cast("bigint")


def age_label(low: Column, high: Column) -> Column:
    """``18-65 years``, ``18+ years`` or ``<18 years``."""
    return (
        F.when(low.isNotNull() & high.isNotNull(),
               F.concat(age_number(low), F.lit("-"), age_number(high), F.lit(" "), age_unit(low)))
        .when(low.isNotNull(), F.concat(age_number(low), F.lit("+ "), age_unit(low)))
        .when(high.isNotNull(), F.concat(F.lit("<"), age_number(high), F.lit(" "), age_unit(high)))
    )


def days_struct(low: Column, high: Column) -> Column:
    return F.struct(low.cast("bigint").alias("min"), high.cast("bigint").alias("max"))


def age_bucket(label: Column) -> Column:
    """Bucket text -> struct(label, min, max); unknown texts get null bounds."""
    low = mapped(label, {k: v[0] for k, v in AGE_BUCKETS.items() if v[0] is not None})
    high = mapped(label, {k: v[1] for k, v in AGE_BUCKETS.items() if v[1] is not None})
    return F.struct(
        label.alias("label"), low.cast("bigint").alias("min"), high.cast("bigint").alias("max")
    )


def age_bucket_list(text: Column) -> Column:
    """Comma list of buckets -> list of structs; quotes and NA marks are dropped."""
    bare = F.regexp_replace(F.replace(text, F.lit('"'), F.lit("")), r"(?i)\bN/?A\b", "")
    bare = F.btrim(F.regexp_replace(F.trim(bare), r",+", ","), F.lit(","))
    labels = F.transform(F.split(F.trim(bare), ","), lambda x: F.lower(F.trim(x)))
    return F.transform(F.filter(labels, lambda x: x != ""), age_bucket)


def roman_phases(text: Column) -> Column:
    """``Phase II and Phase III`` -> [2, 3]; parts without a numeral give null."""
    numerals = {"IV": 4, "III": 3, "II": 2, "I": 1}
    return F.transform(
        F.split(text, "and"),
        lambda part: mapped(
            extract_or_null(F.trim(part), r"\b(IV|III|II|I)\b"), numerals
        ).cast("tinyint"),
    )


def coded_phases(phases: Column) -> Column:
    """``[EARLY_PHASE1, PHASE2, NA]`` -> [1, 2]."""
    numbers = F.transform(phases, lambda p: F.regexp_replace(
        F.regexp_replace(null_if_in(p), "^EARLY_", ""), "^PHASE", ""
    ).try_cast("tinyint"))
    return F.array_compact(numbers)


def map_status(status: Column, default: Column | None = None) -> Column:
    """Harmonised status; ``default`` is the value itself unless given."""
    return mapped(F.upper(status), TRIAL_STATUS, status if default is None else default)


def _place(country: Column, status_text: Column) -> Column:
    return F.struct(
        country.alias("country"),
        F.trim(extract_or_null(status_text, r"^([^,]+)")).alias("approval"),
        F.trim(extract_or_null(status_text, r",(.+)$")).alias("status"),
    )


def parse_locations(text: Column) -> Column:
    """``Spain:Ongoing, recruiting, France:Ended`` -> list of {country, approval, status}."""
    marked = F.regexp_replace(text, r", ([A-Z])", "||$1")
    parts = F.split(F.replace(marked, F.lit("Ended"), F.lit("ended, ended")), r"\|\|")

    def place(part: Column) -> Column:
        return F.struct(
            F.trim(extract_or_null(part, r"^([^:]+)")).alias("country"),
            F.trim(extract_or_null(part, r":([^,]+)")).alias("approval"),
            F.trim(extract_or_null(part, r",(.+)$")).alias("status"),
        )

    return F.transform(parts, place)


def location_statuses(locations: Column) -> Column:
    """Per-site records -> distinct list of {country, approval, status}."""
    return F.array_distinct(F.transform(locations, lambda loc: _place(
        loc["country"], map_status(loc["recruitment_status"], F.lit(LOCATION_STATUS_DEFAULT))
    )))


def padded_types(types: Column, names: Column) -> Column:
    """Types padded with ``OTHER`` to the number of names; empty when there are more types."""
    missing = F.size(names) - F.size(types)
    return (
        F.when(missing > 0, F.concat(types, F.array_repeat(F.lit("OTHER"), missing)))
        .when(missing == 0, types)
        .otherwise(F.array().cast("array<string>"))
    )


def genders(sex: Column, title_cased: Column) -> Column:
    """``all`` stands for both."""
    return F.when(F.lower(sex) == "all", F.array(F.lit("Female"), F.lit("Male"))) \
        .when(sex.isNotNull(), F.array(title_cased))


def outcomes(primary: Column, secondary: Column) -> Column:
    """Two-entry list {text, type, label}; entries without a text list are dropped."""
    def entry(text: Column, kind: str) -> Column:
        return F.struct(
            text.alias("text"), F.lit(kind).alias("type"),
            F.array().cast("array<string>").alias("label"),
        )
    return F.filter(F.array(entry(primary, "primary"), entry(secondary, "secondary")),
                    lambda o: o["text"].isNotNull())
