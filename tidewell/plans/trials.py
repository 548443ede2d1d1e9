"""EU register exports and US registry records -> one trial schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions import clinical as c
from tidewell.functions.dates import DAY_FIRST, YEAR_FIRST, complete_date, parse_day
from tidewell.functions.fixed_values import CTIS_COLUMNS, ICD10_PATTERN, ICD11_PATTERN
from tidewell.functions.text import null_tokens, title_case
from tidewell.operators.inplace import IN_PLACE, in_place, mapped
from tidewell.operators.lookups import conform, with_matching
from tidewell.operators.rows import explode_once
from tidewell.operators.sizing import Bound
from tidewell.schemas import TRIALS

_DATES = r"(?i)(date|updated)$"
_NONE = "array<string>"


def _none() -> Column:
    return F.array().cast(_NONE)


def _single(value: Column) -> Column:
    return F.when(value.isNotNull(), F.array(value)).otherwise(_none())


# ── EU register ──────────────────────────────────────────────────────────────

def ctis_core(df: DataFrame) -> DataFrame:
    """Fields of the EU export that need no lookup."""
    dated = with_matching(df, _DATES, "string", lambda x: parse_day(x, DAY_FIRST))
    no_arms = F.array().cast("array<struct<name: array<string>, type: array<string>>>")
    derived = {
        "Trial results": F.when(F.col("Trial results") == "Yes", True)
                          .when(F.col("Trial results") == "No", False),
        "methods": F.struct(_single(F.col("Product")).alias("products"),
                            no_arms.alias("interventions")),
        "gender": F.transform(F.split("Gender", ","), lambda x: F.trim(x)),
        "keywords": _none(),
        "conditions": F.split("Medical conditions", r"\."),
        "phases": c.roman_phases(F.col("Trial phase")),
        "countries_status": c.parse_locations(F.col("`Location(s) and recruitment status`")),
        "outcomes": c.outcomes(_single(F.col("Primary endpoint")),
                               _single(F.col("Secondary endpoints"))),
    }
    return dated.withColumns(derived).withColumnsRenamed(CTIS_COLUMNS)


def ctis_age_ranges(df: DataFrame) -> DataFrame:
    """Age buckets: secondary buckets refine a primary bucket they share a bound with.

    A primary bucket that shares both bounds is replaced, one that shares a
    single bound stays next to the secondary ones. Sorted by lower bound, open
    lower bounds first.
    """
    secondary = c.age_bucket_list(F.col("Age range secondary identifier"))
    other = F.coalesce(secondary, F.array().cast("array<struct<label: string, min: bigint, max: bigint>>"))

    def merged(bucket: Column) -> Column:
        low = F.exists("_secondary", lambda s: s["min"] == bucket["min"])
        high = F.exists("_secondary", lambda s: s["max"] == bucket["max"])
        low, high = F.coalesce(low, F.lit(False)), F.coalesce(high, F.lit(False))
        own = F.array(bucket)
        return (
            F.when(low & high, F.col("_secondary")).when(low | high, F.concat(own, "_secondary"))
            .otherwise(own)
        )

    # Bounds lead the struct, so that sorting is by bound; label and position break ties.
    ranges = F.array_sort(F.transform(
        F.flatten(F.transform("_primary", merged)),
        lambda b, i: F.struct(b["min"].alias("min"), b["max"].alias("max"), b["label"].alias("label"),
                              i.alias("i"))))
    return (
        df.withColumn("_primary", c.age_bucket_list(F.col("Age group")))
        .withColumn("_secondary", other)
        .withColumn("_ranges", ranges)
        .withColumn("range_in_days", F.transform("_ranges", lambda r: c.days_struct(r["min"], r["max"])))
        .withColumn("groupings", F.transform("_ranges", lambda r: r["label"]))
        .drop("_primary", "_secondary", "_ranges")
    )


def _bracketed(text: Column, pattern: str) -> Column:
    inner = pattern.replace(r"\b", "")
    return F.transform(F.regexp_extract_all(text, F.lit(rf"\[{inner}\]"), F.lit(0)),
                       lambda x: F.btrim(x, F.lit("[]")))


def _code_struct(tens: DataFrame, elevens: DataFrame, key: str, catalogue: DataFrame) -> DataFrame:
    """(key, codes) from (key, ten) and (key, eleven) rows; each code with its own chapter."""
    chapters = catalogue.select(F.col("icd_code").alias("eleven"), "chapter")
    pairs = elevens.join(chapters, "eleven", "left").select(
        key, F.struct(F.col("eleven").alias("code"), "chapter").alias("pair"))
    both = tens.select(key, "ten").unionByName(pairs, allowMissingColumns=True)
    return both.groupBy(key).agg(
        F.struct(F.array_sort(F.collect_set("ten")).alias("icd_10"),
                 F.array_sort(F.collect_set("pair")).alias("icd_11")).alias("codes"))


def _with_codes(df: DataFrame, codes: DataFrame, key: str) -> DataFrame:
    empty = F.struct(_none().alias("icd_10"),
                     F.array().cast("array<struct<code: string, chapter: string>>").alias("icd_11"))
    return df.join(codes, key, "left").withColumn("codes", F.coalesce("codes", empty))


def _codes_in_place(tens: Column, elevens: Column, chapter) -> Column:
    """The struct of codes from lists that lie in the row."""
    pairs = mapped(F.array_compact(elevens), chapter, lambda code, v: F.struct(code.alias("code"), v.cast("string").alias("chapter")))
    return F.struct(F.array_sort(F.array_distinct(F.array_compact(tens))).alias("icd_10"),
                    F.array_sort(F.array_distinct(pairs)).alias("icd_11"))


def _through(codes: Column, find) -> Column:
    """All targets of a list of codes; codes without one give nulls."""
    return mapped(F.array_compact(codes), find, lambda _, v: v)


def ctis_codes(df: DataFrame, key: str, area: str, to_11: DataFrame, to_10: DataFrame,
               catalogue: DataFrame, icd10: str = ICD10_PATTERN,
               icd11: str = ICD11_PATTERN, bound: Bound = IN_PLACE) -> DataFrame:
    """``df`` with ``codes``: bracketed codes of ``area``, completed through crosswalks; empty lists where there are none.

    ``to_11`` has (icd10Code, icd11Code), ``to_10`` (icd11Code, icd10Code), one
    row per pair. ICD-11 codes are extended from the ICD-10 codes, then ICD-10
    codes from all ICD-11 codes. A code that has the ICD-10 shape is taken as
    ICD-10 only. ``key`` is unique in ``df``. Tables within ``bound`` are
    applied inside the row; beyond it, codes are joined and regrouped.
    """
    found = _bracketed(F.col(area), icd10)
    other = F.array_except(_bracketed(F.col(area), icd11), found)
    finds = _all_in_place([(to_11, "icd10Code", "icd11Code"), (to_10, "icd11Code", "icd10Code"), (catalogue, "icd_code", "chapter")], bound)
    if finds is not None:
        up, down, chapter = finds
        # Columns of their own, so that each list is made once.
        staged = df.withColumn("_tens", F.coalesce(found, _none())).withColumn("_other", F.coalesce(other, _none()))
        staged = staged.withColumn("_elevens", F.concat("_other", _through(F.col("_tens"), up)))
        tens = F.concat("_tens", _through(F.col("_elevens"), down))
        return staged.withColumn("codes", _codes_in_place(tens, F.col("_elevens"), chapter)).drop("_tens", "_other", "_elevens")
    tens, own = explode_once(df, [key], found, "ten"), explode_once(df, [key], other, "eleven")
    up = to_11.select(F.col("icd10Code").alias("ten"), F.col("icd11Code").alias("eleven"))
    down = to_10.select(F.col("icd11Code").alias("eleven"), F.col("icd10Code").alias("ten"))
    elevens = own.unionByName(tens.join(up, "ten").select(key, "eleven"))
    more = elevens.join(down, "eleven").select(key, "ten")
    return _with_codes(df, _code_struct(tens.unionByName(more), elevens, key, catalogue), key)


def _all_in_place(tables: list[tuple[DataFrame, str, str]], bound: Bound) -> list | None:
    """A function for each lookup, or None if one of them is beyond the bound."""
    finds = []
    for table, key, value in tables:
        find = in_place(table, key, value, bound)
        if find is None:
            return None
        finds.append(find)
    return finds


# ── US registry ──────────────────────────────────────────────────────────────

def flatten_study(raw: DataFrame, group: str) -> DataFrame:
    """Nested registry studies -> flat trial records of one query group."""
    p = "protocolSection."
    ident, status, design = p + "identificationModule.", p + "statusModule.", p + "designModule."
    arms = F.col(p + "armsInterventionsModule.interventions")
    outcome = p + "outcomesModule."
    sites = F.col(p + "contactsLocationsModule.locations")

    def filled(value: Column) -> Column:
        return F.coalesce(value, F.lit(""))

    def each(items: Column, field: str) -> Column:
        return F.coalesce(F.transform(items, lambda x: x[field]), _none())

    site = F.transform(sites, lambda s: F.struct(
        filled(s["facility"]).alias("facility"), filled(s["city"]).alias("city"),
        filled(s["country"]).alias("country"), filled(s["status"]).alias("recruitment_status")))
    return raw.select(
        F.col(ident + "nctId").alias("nct_id"), F.col(ident + "orgStudyIdInfo.id").alias("sponsor_code"),
        F.lit(group).alias("query_group"), F.col(status + "overallStatus").alias("overall_status"),
        F.trim(filled(F.col(ident + "officialTitle"))).alias("title"),
        F.coalesce(F.col(status + "hasResults"), F.lit(False)).alias("results"),
        F.col(status + "startDateStruct.date").alias("start_date"),
        F.col(status + "primaryCompletionDateStruct.date").alias("end_date"),
        F.col(status + "completionDateStruct.date").alias("global_end_date"),
        F.col(status + "studyFirstPostDateStruct.date").alias("decision_date"),
        F.col(status + "lastUpdatePostDateStruct.date").alias("last_updated"),
        F.coalesce(F.col(design + "phases"), _none()).alias("phases"),
        F.col(design + "enrollmentInfo.count").alias("enrollment"),
        F.coalesce(F.col(p + "conditionsModule.conditions"), _none()).alias("conditions"),
        F.coalesce(F.col(p + "conditionsModule.keywords"), _none()).alias("keywords"),
        F.array_sort(F.array_distinct(each(F.col("derivedSection.conditionBrowseModule.meshes"), "id")))
        .alias("mesh_ids"),
        each(arms, "type").alias("intervention_types"), each(arms, "name").alias("intervention_names"),
        F.col(p + "eligibilityModule.minimumAge").alias("min_age"),
        F.col(p + "eligibilityModule.maximumAge").alias("max_age"),
        F.col(p + "eligibilityModule.sex").alias("sex"),
        F.coalesce(site, F.array().cast(
            "array<struct<facility: string, city: string, country: string, recruitment_status: string>>"
        )).alias("locations"),
        F.col(p + "sponsorCollaboratorsModule.leadSponsor.name").alias("sponsor"),
        F.col(p + "sponsorCollaboratorsModule.leadSponsor.class").alias("sponsor_type"),
        each(F.col(outcome + "primaryOutcomes"), "measure").alias("primary_outcomes"),
        each(F.col(outcome + "secondaryOutcomes"), "measure").alias("secondary_outcomes"),
        F.lit("ClinicalTrials.gov").alias("source"))


def ctus_core(df: DataFrame) -> DataFrame:
    """Fields of the US records that need no lookup."""
    dated = with_matching(df, _DATES, "string", lambda x: parse_day(complete_date(x), YEAR_FIRST))
    return dated.withColumns({
        "trial_id": F.col("nct_id"), "overall_status": c.map_status(F.col("overall_status")),
        "phases": c.coded_phases(F.col("phases")),
        "sponsor_type": title_case(F.col("sponsor_type")),
        "outcomes": c.outcomes(F.col("primary_outcomes"), F.col("secondary_outcomes")),
        "gender": c.genders(F.col("sex"), title_case(F.col("sex"))),
        "countries_status": c.location_statuses(F.col("locations")),
    })


def ctus_methods() -> Column:
    types = c.padded_types(F.col("intervention_types"), F.col("intervention_names"))
    arm = F.struct(F.col("intervention_names").alias("name"), types.alias("type"))
    return F.struct(_none().alias("products"), F.array(arm).alias("interventions")).alias("methods")


def ctus_age_ranges(df: DataFrame) -> DataFrame:
    low, high = c.age_days(F.col("min_age")), c.age_days(F.col("max_age"))
    empty = F.array().cast("array<struct<min: bigint, max: bigint>>")
    label = c.age_label(F.col("min_age"), F.col("max_age"))
    return df.withColumns({
        "range_in_days": F.when(low.isNotNull() | high.isNotNull(), F.array(c.days_struct(low, high)))
                          .otherwise(empty),
        "groupings": _single(label),
    })


def ctus_codes(df: DataFrame, key: str, ids: str, to_11: DataFrame, catalogue: DataFrame,
               prefix_len: int = 3, bound: Bound = IN_PLACE) -> DataFrame:
    """``df`` with ``codes``: prefixes of the subject ids taken as ICD-10 codes, extended to ICD-11.

    A proxy: the ids are headings of another vocabulary. ``bound`` as in
    :func:`ctis_codes`.
    """
    prefixes = F.array_distinct(F.transform(ids, lambda x: F.substring(x, 1, prefix_len)))
    finds = _all_in_place([(to_11, "icd10Code", "icd11Code"), (catalogue, "icd_code", "chapter")], bound)
    if finds is not None:
        up, chapter = finds
        staged = df.withColumn("_tens", F.coalesce(prefixes, _none()))
        return staged.withColumn("codes", _codes_in_place(F.col("_tens"), _through(F.col("_tens"), up), chapter)).drop("_tens")
    tens = explode_once(df, [key], prefixes, "ten")
    up = to_11.select(F.col("icd10Code").alias("ten"), F.col("icd11Code").alias("eleven"))
    return _with_codes(df, _code_struct(tens, tens.join(up, "ten").select(key, "eleven"), key, catalogue), key)


# ── both ─────────────────────────────────────────────────────────────────────

def with_countries(df: DataFrame, key: str, countries: DataFrame, bound: Bound = IN_PLACE) -> DataFrame:
    """``df`` with the places of ``countries_status`` distinct and with ISO-3 codes; unknown names stay.

    ``countries`` has (name, iso3), one row per name. ``key`` is unique. Within
    ``bound`` the names are looked up inside the row; beyond it, places are
    joined and regrouped.
    """
    def entry(place: Column, iso3: Column) -> Column:
        return F.struct(F.coalesce(iso3.cast("string"), place["country"]).alias("country"),
                        place["approval"].alias("approval"), place["status"].alias("status"))

    find = in_place(countries, "name", "iso3", bound)
    if find is not None:
        return df.withColumn("countries_status", F.array_distinct(
            mapped(F.col("countries_status"), lambda place: find(place["country"]), entry)))
    rows = df.select(key, F.posexplode_outer("countries_status").alias("_pos", "_c")).filter(F.col("_pos").isNotNull())
    named = rows.join(countries.select(F.col("name").alias("_name"), "iso3"), F.col("_c.country") == F.col("_name"), "left")
    placed = F.array_sort(F.collect_list(F.struct("_pos", entry(F.col("_c"), F.col("iso3")).alias("e"))))
    places = named.groupBy(key).agg(F.array_distinct(F.transform(placed, lambda x: x["e"])).alias("countries_status"))
    return (df.withColumnRenamed("countries_status", "_raw").join(places, key, "left")
            .withColumn("countries_status", F.coalesce("countries_status", "_raw")).drop("_raw"))


def harmonise_ctis(raw: DataFrame, to_11: DataFrame, to_10: DataFrame, catalogue: DataFrame,
                   countries: DataFrame, bound: Bound = IN_PLACE) -> DataFrame:
    """EU export (one row per trial number) -> :data:`tidewell.schemas.TRIALS`."""
    core = with_countries(ctis_core(ctis_age_ranges(raw)), "trial_id", countries, bound)
    return conform(ctis_codes(core, "trial_id", "Therapeutic area", to_11, to_10, catalogue, bound=bound), TRIALS)


def harmonise_ctus(raw: DataFrame, to_11: DataFrame, catalogue: DataFrame,
                   countries: DataFrame, bound: Bound = IN_PLACE) -> DataFrame:
    """US records (one row per ``nct_id``) -> :data:`tidewell.schemas.TRIALS`."""
    core = ctus_core(ctus_age_ranges(null_tokens(raw))).withColumn("methods", ctus_methods())
    core = with_countries(core, "trial_id", countries, bound)
    return conform(ctus_codes(core, "trial_id", "mesh_ids", to_11, catalogue, bound=bound), TRIALS)
