"""Raw classification entities and search hits -> flat code records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.text import blank_to_null, https, label_of
from tidewell.schemas import DBL, ICD_RECORD, S, many, record

# Label-like fields are read as text, since they may be a text, an object or a list.
ENTITY = record(
    **{"@id": S, "id": S, "code": S, "browserUrl": S, "classKind": S, "title": S, "definition":
    S, "longDefinition": S, "fullySpecifiedName": S, "synonym": many(S), "inclusion": many(S),
    "exclusion": many(S), "indexTerm": many(S), "parent": many(S), "child": many(S), "source":
    S}
)
SEARCH_HIT = record(
    id=S, theCode=S, title=S, definition=S, synonyms=many(S), matchingPVs=many(record(label=S)),
    foundationUri=S, score=DBL,
)


def _blank(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def _code(code: Column, uri: Column) -> Column:
    """The code, else the last segment of the uri."""
    return F.coalesce(blank_to_null(code), F.element_at(F.split(uri, "/"), -1))


def _list(name: str) -> Column:
    return F.coalesce(F.col(name), F.array().cast("array<string>"))


def _labels(name: str) -> Column:
    """Labels of terms that are a text or an object with ``label``."""
    def label(term: Column) -> Column:
        inner = F.when(term.startswith("{"), F.get_json_object(term, "$.label")).otherwise(term)
        return label_of(inner)
    return F.filter(F.transform(_list(name), label), lambda t: t != "")


def _links(name: str) -> Column:
    def link(item: Column) -> Column:
        obj = item.startswith("{")
        inner = F.when(obj, F.get_json_object(item, "$.label")).otherwise(item)
        return F.struct(
            label_of(inner).alias("label"),
            _blank(F.when(obj, F.get_json_object(item, "$.linearizationReference"))).alias("linearization_uri"),
            _blank(F.when(obj, F.get_json_object(item, "$.foundationReference"))).alias("foundation_uri"))
    return F.transform(_list(name), link)


def _uri(item: Column) -> Column:
    """A uri that is a text or an object with ``@id`` or ``id``."""
    inner = F.coalesce(F.get_json_object(item, "$.@id"), F.get_json_object(item, "$.id"))
    return https(F.when(item.startswith("{"), inner).otherwise(item))


def _uris(name: str) -> Column:
    return F.filter(F.transform(_list(name), _uri), lambda u: u.isNotNull() & (u != ""))


def release(uri: Column) -> Column:
    old = F.contains(uri, F.lit("icd10")) | F.contains(uri, F.lit("/release/10/"))
    return F.when(old, "ICD-10").otherwise("ICD-11")


def flatten_icd_entity(raw: DataFrame, search_context: str = "") -> DataFrame:
    """Entities read with :data:`ENTITY` -> code records."""
    uri = _blank(F.coalesce(blank_to_null(F.col("@id")), F.col("id")))
    return raw.select(
        _code(label_of(F.col("code")), uri).alias("icd_code"), https(uri).alias("icd_uri"),
        _blank(F.col("browserUrl")).alias("browser_url"),
        _blank(F.col("classKind")).alias("class_kind"),
        label_of(F.col("title")).alias("title"),
        label_of(F.col("definition")).alias("definition"),
        label_of(F.col("longDefinition")).alias("long_definition"),
        label_of(F.col("fullySpecifiedName")).alias("fully_specified_name"),
        _labels("synonym").alias("synonyms"), _links("inclusion").alias("inclusion"),
        _links("exclusion").alias("exclusion"), _labels("indexTerm").alias("index_terms"),
        _uris("parent").alias("parent_uris"), _uris("child").alias("child_uris"),
        _blank(_uri(F.col("source"))).alias("foundation_uri"), release(uri).alias("source"),
        F.lit(search_context).alias("search_context"),
    ).select(*ICD_RECORD.names)


def flatten_icd_hit(raw: DataFrame, search_context: str = "") -> DataFrame:
    """Search hits read with :data:`SEARCH_HIT` -> light code records."""
    uri = _blank(F.col("id"))
    terms = F.filter(F.transform("matchingPVs", lambda t: _blank(t["label"])), lambda t: t.isNotNull())
    return raw.select(
        _code(F.col("theCode"), uri).alias("icd_code"), https(uri).alias("icd_uri"),
        label_of(F.col("title")).alias("title"), label_of(F.col("definition")).alias("definition"),
        _labels("synonyms").alias("synonyms"),
        F.coalesce(terms, F.array().cast("array<string>")).alias("matching_terms"),
        https(_blank(F.col("foundationUri"))).alias("foundation_uri"),
        F.coalesce("score", F.lit(0.0)).alias("score"), release(uri).alias("source"),
        F.lit(search_context).alias("search_context"))


def hierarchy_edges(records: DataFrame) -> DataFrame:
    """(parent, child) uris of flat code records."""
    return records.select(F.col("icd_uri").alias("parent"), F.explode("child_uris").alias("child"))
