"""Landed works -> coded publications; award records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.dates import ISO_LOCAL, parse_time
from tidewell.functions.fixed_values import SPENDING_CATEGORIES
from tidewell.operators import matching as m
from tidewell.schemas import AWARD, PUBLICATIONS


def first_of_type(identifiers: Column, kind: str) -> Column:
    """First non-null identifier of one type."""
    hits = F.filter(identifiers, lambda i: (i["type"] == kind) & i["identifier"].isNotNull())
    return F.get(hits, F.lit(0))["identifier"]


def normalise_works(records: DataFrame, now: str) -> DataFrame:
    """Exploded work records -> flat works; works without an id are dropped."""
    ids = F.col("identifiers")
    journal = F.get(F.filter(F.transform("journals", lambda j: j["title"]),
                             lambda t: t.isNotNull()), F.lit(0))
    return records.select(
        first_of_type(ids, "CORE_ID").alias("work_id"),
        first_of_type(ids, "DOI").alias("doi"),
        first_of_type(ids, "PUBMED_ID").alias("pubmed_id"),
        "title", "abstract",
        parse_time(F.col("publishedDate"), ISO_LOCAL).alias("published_at"),
        F.col("yearPublished").try_cast("int").alias("year_published"),
        F.transform("authors", lambda a: a["name"]).alias("authors"),
        journal.alias("journal"), F.col("fieldOfStudy").alias("field_of_study"),
        F.col("downloadUrl").alias("download_url"), F.array("source_api").alias("source_apis"),
        F.lit(now).alias("first_seen_at"), F.lit(now).alias("last_seen_at"),
        F.lit(1).alias("version"),
    ).filter(F.col("work_id").isNotNull())


def code_works(works: DataFrame, catalogue: DataFrame, min_score: float = 0.45,
               min_tokens: int = 3) -> DataFrame:
    """Attach catalogue codes to works; ``work_id`` is unique in ``works``."""
    usable = m.searchable(catalogue)
    tokens = m.code_tokens(usable)
    both, title = m.title_and_abstract(), F.coalesce("title", F.lit(""))
    by_code = m.match_codes(works, "work_id", both, tokens, "icd_code")
    by_term = m.match_dictionary(works, "work_id", title, both, m.build_terms(usable))
    by_tokens = m.match_jaccard(works, "work_id", title, tokens, min_score, min_tokens)
    return m.resolve_codes(works, "work_id", by_code, by_term, by_tokens, catalogue) \
            .select(*PUBLICATIONS.names)


def flatten_award(raw: DataFrame, categories: DataFrame | None = None) -> DataFrame:
    """Raw award records -> flat awards.

    ``categories`` has (category_id, category_name); without it the service's
    known categories count. Category names come from the ``;`` text, else from
    the name list unless it is empty, else from the ids.
    """
    if categories is None:
        categories = raw.sparkSession.createDataFrame(list(SPENDING_CATEGORIES.items()), "category_id bigint, category_name string")

    def names(people: str) -> Column:
        full = F.transform(F.coalesce(people, F.array().cast("array<struct<full_name: string>>")),
                           lambda p: p["full_name"])
        return F.filter(full, lambda n: n.isNotNull() & (n != ""))

    def text(name: str) -> Column:
        return F.trim(F.coalesce(F.col(name), F.lit("")))

    def trimmed(items: Column) -> Column:
        return F.filter(F.transform(items, lambda x: F.trim(x)), lambda n: n != "")

    # The service's list of categories: a few hundred names, as one map.
    by_category = categories.where("category_id IS NOT NULL").groupBy("category_id").agg(F.min("category_name").alias("name"))
    known = by_category.agg(F.map_from_entries(F.collect_list(F.struct(F.col("category_id").cast("bigint"), "name")))).scalar()
    by_id = F.transform("spending_categories", lambda i: F.coalesce(
        F.try_element_at(F.col("_known"), i.cast("bigint")), F.concat(F.lit("Category "), i.cast("string"))))
    desc = F.col("spending_categories_desc")
    listed = F.from_json(desc, "array<string>")
    spending = (
        F.when(desc.startswith("[") & listed.isNotNull() & (F.size(listed) > 0), trimmed(listed))
        .when((F.coalesce(desc, F.lit("")) != "") & ~(desc.startswith("[") & listed.isNotNull()), trimmed(F.split(desc, ";")))
        .otherwise(F.coalesce(by_id, F.array().cast("array<string>")))
    )
    return raw.withColumn("_known", known).select(
        "appl_id", "project_num", text("project_title").alias("title"),
        text("abstract_text").alias("abstract"), text("phr_text").alias("public_health_relevance"),
        "fiscal_year", F.col("project_start_date").alias("project_start"),
        F.col("project_end_date").alias("project_end"), "award_amount",
        F.col("direct_cost_amt").alias("direct_cost"),
        F.col("indirect_cost_amt").alias("indirect_cost"),
        "org_name", "org_city", "org_state", "org_country",
        names("principal_investigators").alias("principal_investigators"),
        names("program_officers").alias("program_officers"),
        "agency_code", "activity_code", "funding_mechanism",
        spending.alias("spending_categories"), "rcdc_terms", "project_terms",
        "award_notice_date", "budget_start", "budget_end",
        F.col("project_detail_url").alias("detail_url"), F.lit("NIH RePORTER").alias("source"),
    ).select(*AWARD.names)
