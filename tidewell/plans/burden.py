"""Disease-burden data: indicator records, burden exports, their metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions.dates import ISO_OFFSET, parse_time
from tidewell.functions.fixed_values import (
    BURDEN_KEY, INDICATOR_CAUSE, INDICATOR_CONSTANTS, SEX_ID,
)
from tidewell.functions.text import row_key
from tidewell.operators.lookups import (
    append_swapped, id_name_pairs, lookup, lookup_when, make_lookup, static_rows, unmapped,
    with_parent,
)
from tidewell.schemas import HEALTH


def _is_country():
    return F.lower("spatial_dim_type") == "country"


def _is_sex():
    return F.lower("dim1_type") == "sex"


def map_indicator_ids(records: DataFrame, metadata: DataFrame) -> DataFrame:
    """Add cause, location and sex ids; places and dimensions of other types get none."""
    cause = make_lookup(metadata, "gho_ihme_cause", "cause")
    place = make_lookup(metadata, "gho_ihme_country", "location")
    sex = make_lookup(metadata, "gho_ihme_sex", "sex")
    df = lookup(records, F.col("indicator_code"), cause, "id", ["cause"])
    df = lookup_when(df, _is_country(), "country_code", place, "id", ["location"])
    return lookup_when(df, _is_sex(), "dim1", sex, "id", ["sex"])


def normalise_gho(records: DataFrame, metadata: DataFrame) -> DataFrame:
    """Indicator records -> burden rows; see :data:`tidewell.schemas.HEALTH`."""
    df = map_indicator_ids(records, metadata).withColumns({
        "etiology": F.lit(None).cast("bigint"),
        **{name: F.lit(value).cast("bigint") for name, value in INDICATOR_CONSTANTS.items()},
        "source_data": F.lit("GHO"), "year": F.col("year").cast("bigint"),
        "val": F.coalesce(F.col("numeric_value").cast("double"),
                          F.col("value_display").try_cast("double")),
        "lower": F.col("low").cast("double"), "upper": F.col("high").cast("double"),
        "last_updated": parse_time(F.col("last_updated"), ISO_OFFSET),
    })
    return df.withColumn("row_key", row_key(BURDEN_KEY)).select(*HEALTH.names)


def unmapped_report(records: DataFrame, metadata: DataFrame) -> DataFrame:
    """(dimension, value): source values without an id."""
    df = map_indicator_ids(records, metadata)
    parts = [
        ("cause", unmapped(df, "indicator_code", "cause")),
        ("location", unmapped(df, "spatial_dim", "location", _is_country())),
        ("sex", unmapped(df, "dim1", "sex", _is_sex())),
    ]
    report = None
    for name, part in parts:
        rows = part.toDF("value").select(F.lit(name).alias("dimension"), "value")
        report = rows if report is None else report.unionByName(rows)
    return report


def normalise_gbd(df: DataFrame, now: str, null_marker: str | None = None) -> DataFrame:
    """Burden export: names dropped, ids renamed, key and stamp added.

    ``null_marker`` shows nulls in the row key, where the plain key skips them.
    """
    pairs = id_name_pairs(df.columns)
    kept = df.select(*[c for c in df.columns if not c.endswith("_name")]) \
             .withColumnsRenamed({f"{base}_id": base for base in pairs})
    if "etiology" not in kept.columns:
        kept = kept.withColumn("etiology", F.lit(None).cast("bigint"))
    return kept.withColumns({
        "source_data": F.lit("IHME"), "last_updated": F.to_timestamp(F.lit(now)),
    }).withColumn("row_key", row_key(BURDEN_KEY, null_marker)).select(*HEALTH.names)


def build_gho_metadata(spark: SparkSession, catalogue: DataFrame) -> DataFrame:
    """Indicators, places, and the fixed cause and sex maps as one tall table."""
    indicators = catalogue.select(F.inline("indicator_catalogue")).select(
        F.col("code").alias("id"), "name", F.lit("indicator").alias("dimension"))
    places = catalogue.select(F.inline(F.map_values("geo_catalogue"))).select(
        F.col("code").alias("id"), "name", F.lower("type").alias("dimension"))
    return (
        indicators.unionByName(places)
        .unionByName(static_rows(spark, INDICATOR_CAUSE, "gho_ihme_cause"))
        .unionByName(static_rows(spark, SEX_ID, "gho_ihme_sex"))
    )


def enrich_gho_metadata(gho: DataFrame, gbd: DataFrame) -> DataFrame:
    """Add the burden data's places under ``gho_ihme_country``."""
    return append_swapped(gho, gbd)


def geo_catalogue(places: DataFrame) -> DataFrame:
    """Raw region and country rows (Code, Title, Dimension, ParentCode) -> places.

    A region is its own region; a country takes its parent's name.
    """
    known = places.filter(F.coalesce("Code", F.lit("")) != "").select(
        F.col("Code").alias("code"), F.coalesce("Title", "Code").alias("name"),
        F.col("Dimension").alias("type"), F.coalesce("ParentCode", F.lit("")).alias("parent"))
    named = with_parent(known, "code", "name", "parent")
    region = F.col("type") == "REGION"
    return named.select(
        "code", "name", "type",
        F.when(region, F.col("code")).otherwise(F.col("parent")).alias("region_code"),
        F.when(region, F.col("name")).otherwise(F.col("parent_name")).alias("region_name"))


def clean_gho_record(raw: DataFrame) -> DataFrame:
    """Raw indicator values -> records; the place type decides country and region."""
    kind = F.coalesce("SpatialDimType", F.lit(""))
    place = F.coalesce("SpatialDim", F.lit(""))
    return raw.select(
        F.col("IndicatorCode").alias("indicator_code"), kind.alias("spatial_dim_type"),
        place.alias("spatial_dim"),
        F.when(kind == "COUNTRY", place).otherwise("").alias("country_code"),
        F.when(kind == "REGION", place)
        .when(kind == "COUNTRY", F.coalesce("ParenLocationCode", F.lit("")))
        .otherwise("").alias("region_code"),
        F.col("TimeDim").alias("year"), F.col("Dim1Type").alias("dim1_type"),
        F.col("Dim1").alias("dim1"), F.col("Value").alias("value_display"),
        F.col("NumericValue").alias("numeric_value"), F.col("Low").alias("low"),
        F.col("High").alias("high"), F.col("Comments").alias("comments"),
        F.col("Date").alias("last_updated"), F.col("TimeDimensionBegin").alias("period_begin"),
        F.col("TimeDimensionEnd").alias("period_end"))


def filter_gho(records: DataFrame, years: Sequence[int] | None = None,
               regions: Sequence[str] | None = None,
               spatial_type: str | None = None) -> DataFrame:
    """Records of the given years, places and place type; None leaves a filter out."""
    kept = records
    if years:
        kept = kept.filter(F.col("year").isin(*years))
    if regions:
        kept = kept.filter(F.upper("spatial_dim").isin(*[r.upper() for r in regions]))
    if spatial_type:
        kept = kept.filter(F.upper("spatial_dim_type") == spatial_type.upper())
    return kept


def gho_available(records: DataFrame) -> DataFrame:
    """One row: sorted years, places and place types; blanks do not count."""
    def filled(name: str):
        return F.array_sort(F.collect_set(F.nullif(F.col(name), F.lit(""))))
    return records.agg(
        F.array_sort(F.collect_set("year")).alias("available_years"),
        filled("spatial_dim").alias("available_regions"),
        filled("spatial_dim_type").alias("available_spatial_types"))
