"""Explicit schemas of landed files and of the processed tables."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType, BooleanType, ByteType, DataType, DoubleType, IntegerType, LongType, MapType,
    StringType, StructField, StructType, TimestampNTZType, TimestampType,
)

S, INT, LONG, DBL = StringType(), IntegerType(), LongType(), DoubleType()
BOOL, BYTE, TIME, TIME_NTZ = BooleanType(), ByteType(), TimestampType(), TimestampNTZType()


def record(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


def many(kind: DataType) -> ArrayType:
    return ArrayType(kind)


NEWS_ARTICLE = record(
    topic=S, category=many(S), source=S, author=S, title=S, description=S, url=S, image_url=S,
    published_at=S, content=S,
)
CURRENTS_ARTICLE = record(
    id=S, topic=S, title=S, description=S, url=S, image_url=S, published_at=S, author=S,
    category=many(S), language=S,
)
# Either article format: fields that a file lacks are null.
ARTICLE = record(
    id=S, topic=S, category=many(S), source=S, author=S, title=S, description=S, url=S,
    image_url=S, published_at=S, content=S, language=S,
)
WHO_EMERGENCY = record(
    title=S, published=S, start_date=S, end_date=S, rating=S, summary=S, url=S, provider=S,
)
WHO_OUTBREAK = record(
    title=S, published=S, url=S, summary=S, provider=S,
)
WHO_GENERAL = record(
    title=S, news_type=S, published=S, url=S, source_key=S, provider=S,
)
TRIAL_US = record(
    nct_id=S, sponsor_code=S, query_group=S, overall_status=S, title=S, results=BOOL,
    start_date=S, end_date=S, global_end_date=S, decision_date=S, last_updated=S,
    phases=many(S), enrollment=LONG, conditions=many(S), keywords=many(S), mesh_ids=many(S),
    intervention_types=many(S), intervention_names=many(S), min_age=S, max_age=S, sex=S,
    locations=many(record(facility=S, city=S, country=S, recruitment_status=S)), sponsor=S,
    sponsor_type=S, primary_outcomes=many(S), secondary_outcomes=many(S), source=S,
)
WORK = record(
    identifiers=many(record(type=S, identifier=S)), authors=many(record(name=S)),
    journals=many(record(title=S)), title=S, abstract=S, publishedDate=S, yearPublished=LONG,
    fieldOfStudy=S, downloadUrl=S,
)
GHO_RECORD = record(
    indicator_code=S, spatial_dim_type=S, spatial_dim=S, country_code=S, region_code=S,
    year=INT, dim1_type=S, dim1=S, value_display=S, numeric_value=DBL, low=DBL, high=DBL,
    comments=S, last_updated=S, period_begin=S, period_end=S,
)
GHO_CATALOGUE = record(
    indicator_catalogue=many(record(code=S, name=S)), geo_catalogue=MapType(S, record(code=S,
    name=S, type=S, region_code=S, region_name=S)),
)
AWARD = record(
    appl_id=LONG, project_num=S, title=S, abstract=S, public_health_relevance=S,
    fiscal_year=INT, project_start=S, project_end=S, award_amount=DBL, direct_cost=DBL,
    indirect_cost=DBL, org_name=S, org_city=S, org_state=S, org_country=S,
    principal_investigators=many(S), program_officers=many(S), agency_code=S, activity_code=S,
    funding_mechanism=S, spending_categories=many(S), rcdc_terms=S, project_terms=S,
    award_notice_date=S, budget_start=S, budget_end=S, detail_url=S, source=S,
)
ICD_RECORD = record(
    icd_code=S, icd_uri=S, browser_url=S, class_kind=S, title=S, definition=S,
    long_definition=S, fully_specified_name=S, synonyms=many(S), inclusion=many(record(label=S,
    linearization_uri=S, foundation_uri=S)), exclusion=many(record(label=S, linearization_uri=S,
    foundation_uri=S)), index_terms=many(S), parent_uris=many(S), child_uris=many(S),
    foundation_uri=S, source=S, search_context=S,
)
ICD_MAP = record(
    icd10Code=S, icd11Code=S, icd11Chapter=S,
)
ARTICLES = record(
    url=S, topic=S, author=S, title=S, description=S, image_url=S, published_at=TIME,
    language=S, category=many(S), source_apis=many(S), first_seen_at=S, last_seen_at=S,
    version=INT, media_sentiment_score=DBL,
)
PUBLICATIONS = record(
    work_id=S, doi=S, pubmed_id=S, title=S, abstract=S, published_at=TIME, year_published=INT,
    authors=many(S), journal=S, field_of_study=S, download_url=S, source_apis=many(S),
    icd_11_codes=many(S), icd_11_titles=many(S), icd_chapters=many(S), match_method=S,
    first_seen_at=S, last_seen_at=S, version=INT,
)
TRIALS = record(
    trial_id=S, title=S, overall_status=S, phases=many(BYTE), groupings=many(S),
    range_in_days=many(record(min=LONG, max=LONG)), gender=many(S), enrollment=LONG,
    countries_status=many(record(country=S, approval=S, status=S)), conditions=many(S),
    keywords=many(S), start_date=TIME_NTZ, end_date=TIME_NTZ, last_updated=TIME_NTZ,
    global_end_date=TIME_NTZ, decision_date=TIME_NTZ, sponsor=S, sponsor_type=S, sponsor_code=S,
    methods=record(products=many(S), interventions=many(record(name=many(S), type=many(S)))),
    outcomes=many(record(text=many(S), type=S, label=many(S))), results=BOOL,
    codes=record(icd_10=many(S), icd_11=many(record(code=S, chapter=S))),
)
HEALTH = record(
    age=LONG, cause=LONG, etiology=LONG, location=LONG, measure=LONG, metric=LONG,
    population_group=LONG, sex=LONG, year=LONG, val=DBL, upper=DBL, lower=DBL, source_data=S,
    last_updated=TIME, row_key=S,
)
METADATA = record(
    dimension=S, id=LONG, name=S,
)
DIM_REGION = record(
    region_key=LONG, country_code=S, country_name=S, who_region=S, income_group=S,
    is_global=BOOL,
)
DIM_DISEASE = record(
    disease_key=LONG, disease_name=S, icd10_code=S, icd11_code=S, disease_category=S,
    is_neglected=BOOL,
)
DIM_TIME = record(
    time_key=LONG, year=INT, month=INT, quarter=INT, year_month=S,
)
FACT = record(
    disease_key=LONG, time_key=LONG, region_key=LONG, source_key=INT, daly_value=DBL,
    daly_per_100k=DBL, loaded_at=TIME, trial_count=LONG, media_mention_count=LONG,
    publication_count=LONG, media_sentiment_score=DBL, norm_media_score=DBL,
    norm_research_score=DBL,
)
DIM_TRIALS = record(
    trial_id=S, region_key=LONG, disease_key=LONG, stage=S, status=S, active=BOOL,
    loaded_at=TIME,
)

CTIS_HEADERS = (
    "Trial number", "Title of the trial", "Overall trial status", "Trial phase", "Trial results",
    "Product", "Gender", "Medical conditions", "Location(s) and recruitment status",
    "Primary endpoint", "Secondary endpoints", "Therapeutic area", "Age group",
    "Age range secondary identifier", "Number of participants enrolled", "Protocol code",
    "Sponsor/Co-Sponsors", "Sponsor type", "Last updated", "Start date", "End date",
    "Decision date", "Global end of the trial",
)
GBD_MEASURES = ("val", "upper", "lower")

