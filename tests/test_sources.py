import json
import random

import pytest
from pyspark.sql import functions as F

from tidewell.functions.text import label_of, title_case
from tidewell.operators import crosswalk, lookups
from tidewell.operators.inplace import IN_PLACE
from tidewell.operators.sizing import Bound
from tidewell.plans import articles, burden, trials
from tidewell.schemas import ARTICLE, ARTICLES, CTIS_HEADERS, GHO_RECORD, TRIAL_US, TRIALS, WHO_EMERGENCY, WHO_OUTBREAK, record, S
from tidewell.session import cut_lineage
from tidewell.sources import files
from tidewell.sources.master import Master
from tidewell.streaming import ingest

NOW = "2026-03-28T06:00:00+00:00"


def article(url, day, title="Good news", author="#author.fullName}", **more):
    return {"url": url, "published_at": day, "title": title, "author": author, "category": ["health"], **more}


def write_envelope(folder, name, source, **lists):
    folder.mkdir(parents=True, exist_ok=True)
    doc = {"fetched_at": NOW, "source_api": source, "fetch_params": {}, "data": lists}
    (folder / name).write_text(json.dumps(doc, indent=2), encoding="utf-8")


@pytest.fixture
def landed(tmp_path):
    write_envelope(tmp_path / "2026-03-26", "news_1.json", "newsapi.org/v2", articles=[
        article("https://x.org/a/?q=1", "2026-03-26T15:58:54Z"), article("https://x.org/b", "soon", author="Jo"),
        article("https://x.org/a", "2026-03-26T10:00:00Z", title="Older copy")])
    write_envelope(tmp_path / "2026-03-27", "currentapi_1.json", "api.currentsapi.services/v1", articles=[
        article("https://x.org/a/", "2026-03-27 13:18:05 +0000", title="Newer", language="de"),
        article("https://x.org/c", "2026-03-27 13:18:05 +0200", language="fr")])
    write_envelope(tmp_path / "2026-03-27", "news_empty.json", "newsapi.org/v2", articles=[])
    return tmp_path


def test_articles(spark, landed):
    records = files.read_envelope(spark, str(landed / "*" / "*.json"), "articles", ARTICLE)
    got = {(r["url"], r["title"]): r for r in articles.normalise_articles(records, NOW).withColumn(
        "published_at", F.col("published_at").cast("string")).collect()}
    assert len(got) == 5
    first = got["https://x.org/a", "Good news"]
    assert (first["author"], first["language"], first["published_at"]) == (None, "en", "2026-03-26 15:58:54")
    assert got["https://x.org/b", "Good news"]["published_at"] is None
    assert got["https://x.org/c", "Good news"]["published_at"] == "2026-03-27 11:18:05"
    assert got["https://x.org/c", "Good news"]["language"] == "fr"


def test_who_sections(spark, tmp_path):
    write_envelope(tmp_path, "who_1.json", "www.who.int", emergencies=[
        {"title": "E", "published": "2026-01-02T00:00:00Z", "start_date": "2026-01-01T00:00:00Z", "end_date": "", "rating": "Grade 2", "summary": "", "url": "https://w/e/"},
        {"title": "S", "published": "x", "summary": "told", "url": "https://w/s?x"}],
        disease_outbreak_news=[{"title": "D", "published": "2026-01-03T00:00:00Z", "summary": "out", "url": "https://w/d"}])
    path = str(tmp_path / "who_1.json")
    urgent = files.read_envelope(spark, path, "emergencies", WHO_EMERGENCY)
    news = files.read_envelope(spark, path, "disease_outbreak_news", WHO_OUTBREAK)
    got = {r["title"]: r for r in articles.normalise_who(urgent, news, NOW).collect()}
    assert got["E"]["description"] == "Start Date 2026-01-01 Rating Grade 2" and got["E"]["topic"] == "emergencies"
    assert got["S"]["description"] == "told" and got["S"]["url"] == "https://w/s" and got["S"]["published_at"] is None
    assert got["D"]["topic"] == "disease_outbreak" and got["D"]["category"] == ["health_emergency"]


def article_rows(documents):
    return articles.normalise_articles(files.explode_envelope(documents, "articles"), NOW) \
        .withColumn("media_sentiment_score", F.lit(None).cast("double"))


def contents(master):
    return sorted((r["url"], r["title"], sorted(r["source_apis"])) for r in master.read().collect())


def test_stream_equals_batch_and_replay_changes_nothing(spark, landed, tmp_path_factory):
    out = tmp_path_factory.mktemp("masters")
    route = ingest.Route("{news,currentapi}_*.json", "articles", lists={"articles": ARTICLE})
    def master(name):
        return Master(spark, str(out / name), ARTICLES, "url", "published_at", "source_apis", buckets=2)
    streamed, folded = master("streamed"), master("folded")
    query = ingest.ingest_stream(spark, str(landed), route, article_rows, streamed, str(out / "state"), max_files=1)
    query.awaitTermination()
    for day in ("2026-03-26", "2026-03-27"):
        ingest.backfill(spark, str(landed), day, route, article_rows, folded)
    assert contents(streamed) == contents(folded) == [
        ("https://x.org/a", "Newer", ["api.currentsapi.services/v1", "newsapi.org/v2"]),
        ("https://x.org/b", "Good news", ["newsapi.org/v2"]),
        ("https://x.org/c", "Good news", ["api.currentsapi.services/v1"])]
    before = folded.read().select("url", "version").collect()
    counts = ingest.backfill(spark, str(landed), "2026-03-27", route, article_rows, folded)
    assert counts["new"] == counts["updated"] == 0
    assert sorted(folded.read().select("url", "version").collect()) == sorted(before)


def test_two_routes_one_master(spark, tmp_path):
    """Indicator and burden files meet in one stream, so the master has one writer."""
    raw = tmp_path / "raw"
    write_envelope(raw, "gho_1.json", "gho", records=[
        {"indicator_code": "SA_0000001419", "spatial_dim_type": "COUNTRY", "spatial_dim": "DEU", "country_code": "DEU", "year": 2020,
         "dim1_type": "SEX", "dim1": "SEX_MLE", "value_display": "7.5", "last_updated": "2024-05-01T10:00:00+02:00"}])
    (raw / "IHME_1.csv").write_text("cause_id,cause_name,location_id,location_name,age_id,age_name,measure_id,measure_name,metric_id,metric_name,"
                                    "population_group_id,population_group_name,sex_id,sex_name,year,val,upper,lower\n"
                                    "429,Breast cancer,81,Germany,27,All,2,DALYs,3,Rate,1,All,1,Male,2021,1.5,2,1\n")
    meta = lookups.static_rows(spark, {"SA_0000001419": 429}, "gho_ihme_cause") \
        .unionByName(lookups.static_rows(spark, {"DEU": 81}, "gho_ihme_country")).unionByName(lookups.static_rows(spark, {"SEX_MLE": 1}, "gho_ihme_sex"))
    from tidewell.schemas import HEALTH
    gho = ingest.open_files(spark, str(raw), ingest.ROUTES["gho"])
    columns = spark.read.option("header", True).csv(str(raw / "IHME_1.csv")).columns
    ihme = ingest.open_files(spark, str(raw), ingest.ROUTES["ihme"], schema=files.gbd_schema(columns))
    rows = burden.normalise_gho(files.explode_envelope(gho, "records"), meta).unionByName(burden.normalise_gbd(ihme, NOW))
    master = Master(spark, str(tmp_path / "health"), HEALTH, "row_key", "last_updated", buckets=2)
    ingest.merge_stream(rows, master, str(tmp_path / "state")).awaitTermination()
    got = {r["row_key"]: r for r in master.read().collect()}
    assert set(got) == {"27|429|81|2|3|1|1|2020", "27|429|81|2|3|1|1|2021"}
    assert got["27|429|81|2|3|1|1|2020"]["val"] == 7.5


def test_ndjson_keeps_whole_lines_only(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"icd_code": "1A00", "title": "x"}\n{"icd_code": "1A\n{"_queue": ["u"]}\n{"icd_code": null, "title": "y"}\n')
    got = files.read_ndjson_tolerant(spark, str(tmp_path / "c.json"), record(icd_code=S, title=S))
    assert sorted(r["title"] for r in got.collect()) == ["x", "y"]


BOUNDS = pytest.mark.parametrize("bound", [IN_PLACE, Bound(max_rows=0)], ids=["in place", "joined"])


@BOUNDS
def test_ctis_csv_with_bom_and_harmonise(spark, tmp_path, bound):
    values = {h: "" for h in CTIS_HEADERS}
    values.update({
        "Trial number": "2023-1", "Title of the trial": 'A "quoted"\ntitle', "Trial phase": "Phase II and Phase III", "Trial results": "Yes",
        "Gender": "Female, Male", "Location(s) and recruitment status": "Spain:Authorised, recruitment pending, Nowhere:Ended",
        "Therapeutic area": "Diseases [C01] and [1A00]", "Age group": "18-64 years,65+ years", "Age range secondary identifier": "N/A",
        "Last updated": "05/03/2024", "Start date": "01/02/2023", "End date": "N/A", "Number of participants enrolled": "12", "Product": "P"})
    def quote(v):
        return '"' + v.replace('"', '""') + '"'
    text = "﻿" + ",".join(quote(h + " ") for h in CTIS_HEADERS) + "\r\n" + ",".join(quote(v) for v in values.values()) + "\r\n"
    (tmp_path / "CTIS_1.csv").write_bytes(text.encode())
    raw = files.read_ctis_csv(spark, str(tmp_path / "CTIS_1.csv"))
    assert raw.columns == list(CTIS_HEADERS)
    to_11 = spark.createDataFrame([("C01", "2B00"), ("C01", "2B01")], "icd10Code string, icd11Code string")
    to_10 = spark.createDataFrame([("1A00", "A00")], "icd11Code string, icd10Code string")
    catalogue = spark.createDataFrame([("1A00", "certain_infectious"), ("2B00", "neoplasms")], "icd_code string, chapter string")
    countries = spark.createDataFrame([("Spain", "ESP")], "name string, iso3 string")
    df = trials.harmonise_ctis(raw, to_11, to_10, catalogue, countries, bound)
    assert df.schema.simpleString() == TRIALS.simpleString()
    row = df.first()
    assert row["title"] == 'A "quoted"\ntitle' and row["phases"] == [2, 3] and row["results"] is True
    assert [tuple(c) for c in row["countries_status"]] == [("ESP", "Authorised", "recruitment pending"), ("Nowhere", "ended", "ended")]
    assert row["codes"]["icd_10"] == ["A00", "C01"]
    assert [tuple(p) for p in row["codes"]["icd_11"]] == [("1A00", "certain_infectious"), ("2B00", "neoplasms"), ("2B01", None)]
    assert row["groupings"] == ["18-64 years", "65+ years"] and row["enrollment"] == 12 and row["end_date"] is None


@BOUNDS
def test_us_trial_edges(spark, bound):
    base = dict.fromkeys(TRIAL_US.names)
    rows = [
        {**base, "nct_id": "N1", "overall_status": "recruiting", "phases": ["EARLY_PHASE1", "NA"], "start_date": "2024-05",
         "end_date": "NA", "last_updated": "2024-05-07", "sponsor_type": "OTHER_GOV", "sex": "ALL", "min_age": "18 Years",
         "intervention_types": ["DRUG"], "intervention_names": ["a", "b", "c"], "mesh_ids": ["C01.2", "C01.3"],
         "locations": [{"country": "Spain", "recruitment_status": "RECRUITING"}, {"country": "Spain", "recruitment_status": "RECRUITING"},
                       {"country": "Mars", "recruitment_status": "odd"}]},
        {**base, "nct_id": "N2", "overall_status": "odd", "max_age": "6 Months", "intervention_types": ["X", "Y"], "intervention_names": ["a"]}]
    raw = spark.createDataFrame([tuple(r[n] if n != "locations" or r[n] is None else
                                       [(None, None, x["country"], x["recruitment_status"]) for x in r[n]] for n in TRIAL_US.names)
                                 for r in rows], TRIAL_US)
    to_11 = spark.createDataFrame([("C01", "2B00")], "icd10Code string, icd11Code string")
    catalogue = spark.createDataFrame([("2B00", "neoplasms")], "icd_code string, chapter string")
    countries = spark.createDataFrame([("Spain", "ESP")], "name string, iso3 string")
    got = {r["trial_id"]: r for r in trials.harmonise_ctus(raw, to_11, catalogue, countries, bound).collect()}
    one, two = got["N1"], got["N2"]
    assert one["overall_status"] == "Ongoing, recruiting" and one["phases"] == [1] and str(one["start_date"]) == "2024-05-01 00:00:00"
    assert one["sponsor_type"] == "Other_Gov" and one["gender"] == ["Female", "Male"] and one["groupings"] == ["18+ years"]
    assert [tuple(c) for c in one["countries_status"]] == [("ESP", "Ongoing", "recruiting"), ("Mars", "Ended", "ended")]
    assert one["methods"]["interventions"][0]["type"] == ["DRUG", "OTHER", "OTHER"]
    assert one["codes"]["icd_10"] == ["C01"] and [tuple(p) for p in one["codes"]["icd_11"]] == [("2B00", "neoplasms")]
    assert two["overall_status"] == "odd" and two["groupings"] == ["<6 months"] and tuple(two["range_in_days"][0]) == (None, 180)
    assert two["methods"]["interventions"][0]["type"] == [] and two["codes"]["icd_11"] == []


def test_labels(spark):
    rows = [("plain",), ('{"@language":"en","@value":"obj"}',), ('{"label":"lab"}',), ('[{"@language":"fr","@value":"un"},{"@language":"en","@value":"one"}]',),
            ('[{"@language":"fr","@value":"un"}]',), ('["text"]',), ("[not json",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "v string").coalesce(1).select(label_of(F.col("v"))).collect()]
    assert got == ["plain", "obj", "lab", "one", "un", "text", "[not json", ""]
    assert spark.range(1).select(title_case(F.lit("OTHER_GOV éCOLE-x"))).first()[0] == "Other_Gov École-X"


def test_catalogue_document(spark, tmp_path):
    doc = {"data": {"indicator_catalogue": [{"code": "SA_1", "name": "one"}],
                    "geo_catalogue": {"DEU": {"code": "DEU", "name": "Germany", "type": "COUNTRY", "region_code": "EUR", "region_name": "Europe"}}}}
    (tmp_path / "gho_catalogue.json").write_text(json.dumps(doc, indent=2))
    built = burden.build_gho_metadata(spark, files.read_gho_catalogue(spark, str(tmp_path / "gho_catalogue.json")))
    rows = {tuple(r) for r in built.select("id", "name", "dimension").collect()}
    assert {("SA_1", "one", "indicator"), ("DEU", "Germany", "country"), ("SEX_MLE", "1", "gho_ihme_sex")} <= rows
    assert len(rows) == 2 + 19 + 3


def test_hierarchy_visits_each_node_once(spark):
    edges = spark.createDataFrame([("r", "a"), ("r", "b"), ("a", "c"), ("b", "c"), ("c", "r"), ("z", "y")], "parent string, child string")
    roots = spark.createDataFrame([("r",)], "node string")
    assert sorted(tuple(r) for r in crosswalk.reachable(edges, roots).collect()) == [("a", 1), ("b", 1), ("c", 2), ("r", 0)]


def test_hierarchy_equals_breadth_first_search(spark):
    """Random graphs with chains, joints, cycles in and out of reach, null ends and several roots."""
    for seed in range(3):
        rng = random.Random(seed)
        edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)]
        edges += [(200, 201), (201, 200), (7, 100), (120, 5), (None, 3), (4, None), (100, 101)]
        roots = [0, 9, 110, 300]
        depth, queue = dict.fromkeys(roots, 0), list(roots)
        for node in queue:
            for parent, child in edges:
                if parent == node and child is not None and child not in depth:
                    depth[child] = depth[node] + 1
                    queue.append(child)
        got = crosswalk.reachable(spark.createDataFrame(edges, "parent int, child int"),
                                  spark.createDataFrame([(r,) for r in roots + [9, None]], "node int"))
        assert sorted(tuple(r) for r in got.collect()) == sorted(depth.items())


def test_hierarchy_of_a_long_chain(spark, monkeypatch):
    """Rounds grow with the logarithm of the depth; no edges, no rounds."""
    n, written = 5_000, []
    monkeypatch.setattr(crosswalk, "cut_lineage", lambda df: written.append(1) or cut_lineage(df))
    edges = spark.range(n).selectExpr("id AS parent", "id + 1 AS child")
    got = crosswalk.reachable(edges, spark.createDataFrame([(0,)], "node long"))
    assert got.where("node = depth").count() == got.count() == n + 1
    assert len(written) <= 4 + 15  # edges, roots, first pointers, edges of joints; and the rounds
    nothing = crosswalk.reachable(edges.limit(0), spark.createDataFrame([(3,)], "node long"))
    assert [tuple(r) for r in nothing.collect()] == [(3, 0)]


def test_gho_record_with_odd_value(spark):
    row = dict.fromkeys(GHO_RECORD.names)
    row.update(indicator_code="none", spatial_dim_type="REGION", spatial_dim="EUR", country_code="DEU", year=2020, value_display="No data")
    meta = lookups.static_rows(spark, {"DEU": 81}, "gho_ihme_country")
    got = burden.normalise_gho(spark.createDataFrame([tuple(row.values())], GHO_RECORD), meta).first()
    assert got["val"] is None and got["location"] is None and got["row_key"] == "27|2|3|1|2020"


def test_headers_in_any_order(spark, tmp_path):
    for name, text in (("a.csv", "cause_id,location_id,val\n1,2,3.5\n"), ("b.csv", "location_id,cause_id,val\n20,10,7.5\n"),
                       ("c.csv", "year,val,cause_id\n1990,1.5,5\n"), ("d.csv", "")):
        (tmp_path / name).write_text(text)
    got = {tuple(r) for r in files.read_gbd_csv(spark, str(tmp_path)).select("cause_id", "location_id", "year", "val").collect()}
    assert got == {(1, 2, None, 3.5), (10, 20, None, 7.5), (5, None, 1990, 1.5)}


def test_first_lines_without_sort(spark, tmp_path):
    """Many small files in one task, one of two blocks, one without lines: one header each, and no row is sorted or shuffled."""
    texts = {f"f{n}": f"h{n % 3},x\n" + f"{n},1\n" * n for n in range(20)} | {"bom": "\ufeffh0,x\r\n1,2\r\n", "none": "", "blank": "\n1\n", "big": "h1,x\n" + "12345,1\n" * 300_000}
    for name, text in texts.items():
        (tmp_path / f"{name}.csv").write_bytes(text.encode())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        lines = files.first_lines(spark, str(tmp_path))
        plan = lines._jdf.queryExecution().executedPlan().toString()
        found = {r["file"].rsplit("/", 1)[1].removesuffix(".csv"): r["header"] for r in lines.collect()}
        groups = files.files_by_header(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == {name: text.removeprefix("\ufeff").split("\n")[0].rstrip("\r") for name, text in texts.items() if text}
    assert not any(step in plan for step in ("Sort", "Aggregate", "Exchange"))
    assert {h: len(some) for h, some in groups.items()} == {"h0,x": 8, "h1,x": 8, "h2,x": 6, "": 1}
