"""Masters -> star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.dates import first_month
from tidewell.functions.fixed_values import SOURCE_KEY
from tidewell.functions.text import mapped
from tidewell.operators.containment import name_match
from tidewell.operators.upsert import assign_keys, insert_missing, upsert_dim, upsert_fact
from tidewell.schemas import DIM_DISEASE, DIM_REGION, DIM_TIME, DIM_TRIALS, FACT


def source_key(name: Column) -> Column:
    return mapped(name, SOURCE_KEY)


def location_bridge(gho_metadata: DataFrame) -> DataFrame:
    """(location_id, country_code), one row per country code."""
    return (
        gho_metadata.filter(F.lower("dimension") == "gho_ihme_country")
        .select(F.col("name").try_cast("int").alias("location_id"), F.col("id").alias("country_code"))
        .groupBy("country_code").agg(F.min("location_id").alias("location_id"))
    )


def _names(gbd_metadata: DataFrame, dimension: str, key: str, name: str) -> DataFrame:
    return (
        gbd_metadata.filter(F.lower("dimension") == dimension)
        .groupBy(F.col("id").cast("int").alias(key)).agg(F.min("name").alias(name))
    )


def dim_region_candidates(gbd_metadata: DataFrame, gho_metadata: DataFrame) -> DataFrame:
    """Countries known to both metadata tables, by three-letter code."""
    names = _names(gbd_metadata, "location", "location_id", "country_name")
    bridge = location_bridge(gho_metadata).filter(F.char_length("country_code") == 3)
    return names.join(bridge, "location_id").select(
        F.trim("country_code").alias("country_code"), "country_name",
        F.lit(None).cast("string").alias("who_region"),
        F.lit(None).cast("string").alias("income_group"), F.lit(False).alias("is_global"))


def build_dim_region(old: DataFrame, gbd_metadata: DataFrame, gho_metadata: DataFrame) -> DataFrame:
    new = dim_region_candidates(gbd_metadata, gho_metadata)
    keyed = assign_keys(new, old, ["country_code"], "region_key")
    return upsert_dim(old, keyed, ["country_code"], ["country_name"],
                      ["who_region", "income_group"]).select(*DIM_REGION.names)


def dim_disease_candidates(flat: DataFrame, catalogue: DataFrame) -> DataFrame:
    """One row per (icd10_code, icd11_code); the code stands in for a missing title."""
    codes = (
        flat.filter(F.col("icd11Code").isNotNull() & (F.col("icd11Code") != ""))
        .select(F.col("icd10Code").alias("icd10_code"),
                F.explode(F.split("icd11Code", "&")).alias("icd11_code"),
                F.try_element_at("icd11_chapter", F.lit(1)).alias("disease_category"))
        .withColumn("icd11_code", F.trim("icd11_code"))
        .filter((F.col("icd11_code") != "") & (F.char_length("icd11_code") <= 20))
        .groupBy("icd10_code", "icd11_code")
        .agg(F.min("disease_category").alias("disease_category"))
    )
    titles = catalogue.groupBy(F.col("icd_code").alias("icd11_code")).agg(F.min("title").alias("title"))
    return codes.join(titles, "icd11_code", "left").select(
        F.coalesce("title", "icd11_code").alias("disease_name"), "icd10_code", "icd11_code",
        F.coalesce("disease_category", F.lit("Unclassified")).alias("disease_category"),
        F.lit(False).alias("is_neglected"))


def build_dim_disease(old: DataFrame, flat: DataFrame, catalogue: DataFrame) -> DataFrame:
    new = dim_disease_candidates(flat, catalogue)
    keyed = assign_keys(new, old, ["icd10_code", "icd11_code"], "disease_key")
    return upsert_dim(old, keyed, ["icd10_code", "icd11_code"], ["disease_name"],
                      ["disease_category"]).select(*DIM_DISEASE.names)


def build_dim_time(old: DataFrame, years: DataFrame) -> DataFrame:
    """Add the first month of each year in ``years`` that has no row yet."""
    new = years.select(F.col("year").cast("int").alias("year")).filter(F.col("year").isNotNull()) \
               .distinct().select("year", F.lit(1).alias("month"), F.lit(1).alias("quarter"),
                                  first_month(F.col("year")).alias("year_month"))
    keyed = assign_keys(new, old, ["year_month"], "time_key")
    return insert_missing(old, keyed.select(*DIM_TIME.names), ["year_month"])


def agg_burden(health: DataFrame) -> DataFrame:
    """Mean value per cause, location, year and source, over sex, age and metric."""
    return (
        health.filter(F.col("val").isNotNull() & F.col("cause").isNotNull() & F.col("year").isNotNull())
        .groupBy(F.col("cause").cast("int").alias("cause_id"),
                 F.col("location").cast("int").alias("location_id"),
                 F.col("year").cast("int").alias("year"), "source_data")
        .agg(F.avg("val").alias("avg_daly"))
    )


def fact_candidates(health: DataFrame, gbd_metadata: DataFrame, gho_metadata: DataFrame,
                    dim_disease: DataFrame, dim_region: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Mean burden per (disease, time, region, source).

    Causes meet disease names once, as dimensions; facts then join on keys.
    Where several causes hit one grain, the smallest cause id wins, and the
    smallest mean where sources without a key meet.
    """
    causes = _names(gbd_metadata, "cause", "cause_id", "cause_name")
    named = dim_disease.select("disease_key", "disease_name")
    matches = name_match(causes, "cause_id", "cause_name",
                         named.select("disease_name").distinct(), "disease_name", "disease_name")
    regions = location_bridge(gho_metadata).select("location_id", F.trim("country_code").alias("country_code")) \
        .join(dim_region.select("region_key", F.trim("country_code").alias("country_code")), "country_code")
    times = dim_time.filter(F.col("month") == 1).select("time_key", "year")
    grain = ["time_key", "region_key", "source_key"]
    by_cause = (
        agg_burden(health).join(regions, "location_id").join(times, "year")
        .withColumn("source_key", source_key(F.col("source_data")))
        .groupBy("cause_id", *grain).agg(F.min("avg_daly").alias("avg_daly"))
    )
    # Reduced per name; the diseases that share a name fan out afterwards.
    by_name = by_cause.join(matches, "cause_id").groupBy("disease_name", *grain) \
                      .agg(F.min_by("avg_daly", "cause_id").alias("daly_value"))
    return by_name.join(named, "disease_name").select(
        "disease_key", *grain, "daly_value", F.col("daly_value").alias("daly_per_100k"))


def build_fact(old: DataFrame, candidates: DataFrame, now: str) -> DataFrame:
    stamp = F.to_timestamp(F.lit(now))
    return upsert_fact(old, candidates, ["disease_key", "time_key", "region_key", "source_key"],
                       ["daly_value", "daly_per_100k"], stamp).select(*FACT.names)


def trial_diseases(trials: DataFrame, dim_disease: DataFrame) -> DataFrame:
    """(trial_id, disease_key): the smallest disease key among a trial's codes."""
    diseases = dim_disease.groupBy("icd11_code").agg(F.min("disease_key").alias("disease_key"))
    codes = trials.select("trial_id", F.explode("codes.icd_11").alias("c")) \
                  .select("trial_id", F.col("c.code").alias("icd11_code"))
    return codes.join(diseases, "icd11_code").groupBy("trial_id").agg(F.min("disease_key").alias("disease_key"))


def trial_places(trials: DataFrame) -> DataFrame:
    """One row per (trial, country) with stage, activity and the first status."""
    places = trials.select(
        "trial_id", F.array_join(F.transform("phases", lambda p: p.cast("string")), ",").alias("stage"),
        F.col("end_date").isNull().alias("active"), F.explode("countries_status").alias("cs"))
    return (
        places.filter(F.trim("cs.country") != "")
        .groupBy("trial_id", "stage", "active", F.trim("cs.country").alias("country"))
        .agg(F.min("cs.status").alias("status"))
    )


def build_dim_trials(trials: DataFrame, dim_region: DataFrame, dim_disease: DataFrame,
                     now: str) -> DataFrame:
    """One row per (trial, region): the smallest disease key, null where no code is known.

    The disease is chosen per trial and the status per place, so places and
    codes of a trial are never paired. ``trial_id`` is unique in ``trials``.
    """
    regions = dim_region.select("region_key", F.trim("country_code").alias("country"))
    return (
        trial_places(trials).join(regions, "country")
        .join(trial_diseases(trials, dim_disease), "trial_id", "left")
        .withColumn("loaded_at", F.to_timestamp(F.lit(now)))
        .select(*DIM_TRIALS.names)
    )


def verify(dim_region: DataFrame, dim_disease: DataFrame, fact: DataFrame,
           dim_trials: DataFrame) -> DataFrame:
    """One row of table counts after a load."""
    def rows(df: DataFrame) -> Column:
        return df.agg(F.count(F.lit(1))).scalar()
    return dim_region.sparkSession.range(1).select(
        rows(dim_region).alias("regions"), rows(dim_disease).alias("diseases"),
        fact.agg(F.count_if(F.col("daly_value") > 0)).scalar().alias("fact_with_daly"),
        rows(dim_trials).alias("trials"))
