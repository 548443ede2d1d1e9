"""Date and time parsing; the session zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZULU = "yyyy-MM-dd'T'HH:mm:ss'Z'"
BLANK_OFFSET = "yyyy-MM-dd HH:mm:ss Z"
ISO_OFFSET = "yyyy-MM-dd'T'HH:mm:ssXXX"
ISO_LOCAL = "yyyy-MM-dd'T'HH:mm:ss"
DAY_FIRST = "dd/MM/yyyy"
YEAR_FIRST = "yyyy-MM-dd"


def parse_time(text: Column, *formats: str) -> Column:
    """First format that fits, null when none does."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def parse_day(text: Column, fmt: str) -> Column:
    return F.try_to_timestamp(text, F.lit(fmt)).cast("date")


def complete_date(text: Column) -> Column:
    """``2024-05`` becomes ``2024-05-01``; other texts stay."""
    return F.regexp_replace(text, r"^(\d{4}-\d{2})$", "$1-01")


def day_text(text: Column, fmt: str = ZULU) -> Column:
    """The day part of a time text, as text."""
    return F.date_format(F.try_to_timestamp(text, F.lit(fmt)), "yyyy-MM-dd")


def first_month(year: Column) -> Column:
    """``year_month`` label of a year's first month."""
    return F.concat(F.lpad(year.cast("string"), 4, "0"), F.lit("-01"))
