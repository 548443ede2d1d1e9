import datetime

import pytest
from pyspark.sql import functions as F

from tidewell.plans import enrichment, warehouse
from tidewell.schemas import DIM_DISEASE, DIM_REGION, DIM_TIME, FACT, HEALTH, METADATA, TRIALS

NOW = "2026-03-28T06:00:00+00:00"


@pytest.fixture(scope="module")
def star(spark):
    gbd = spark.createDataFrame([("cause", 429, "Breast cancer"), ("cause", 500, "Malaria"), ("location", 81, "Germany"), ("location", 9, "Nowhere")], METADATA)
    gho = spark.createDataFrame([("DEU", "81", "GHO_IHME_COUNTRY"), ("LONG", "9", "gho_ihme_country"), ("SEX_MLE", "1", "gho_ihme_sex")],
                                "id string, name string, dimension string")
    flat = spark.createDataFrame([("C50", "2C61& 2C62", ["neoplasms"]), ("B54", "1F45", []), ("X", "", ["x"]), ("Y", "ZZZZZZZZZZZZZZZZZZZZZZZZ", ["x"])],
                                 "icd10Code string, icd11Code string, icd11_chapter array<string>")
    catalogue = spark.createDataFrame([("2C61", "invasive breast cancer"), ("1F45", "malaria")], "icd_code string, title string")
    empty = {n: spark.createDataFrame([], s) for n, s in (("region", DIM_REGION), ("disease", DIM_DISEASE), ("time", DIM_TIME), ("fact", FACT))}
    region = warehouse.build_dim_region(empty["region"], gbd, gho)
    disease = warehouse.build_dim_disease(empty["disease"], flat, catalogue)
    rows = [(27, 429, None, 81, 2, 3, 1, sex, 2020, float(v), 1.0, 0.0, "IHME", None, f"k{sex}") for sex, v in ((1, 2), (2, 4))]
    rows += [(27, 500, None, 81, 2, 3, 1, 3, 2021, 9.0, 1.0, 0.0, "GHO", None, "m"), (27, 500, None, 9, 2, 3, 1, 3, 2021, 9.0, 1.0, 0.0, "GHO", None, "n")]
    health = spark.createDataFrame(rows, HEALTH)
    time = warehouse.build_dim_time(empty["time"], health.select("year"))
    fact = warehouse.build_fact(empty["fact"], warehouse.fact_candidates(health, gbd, gho, disease, region, time), NOW)
    return {"region": region, "disease": disease, "time": time, "fact": fact}


def test_dimensions(star):
    assert [(r["country_code"], r["country_name"], r["is_global"]) for r in star["region"].collect()] == [("DEU", "Germany", False)]
    diseases = {r["icd11_code"]: r for r in star["disease"].collect()}
    assert set(diseases) == {"2C61", "2C62", "1F45"}
    assert diseases["2C62"]["disease_name"] == "2C62" and diseases["1F45"]["disease_category"] == "Unclassified"
    assert sorted(r["disease_key"] for r in diseases.values()) == [1, 2, 3]
    assert sorted((r["time_key"], r["year_month"]) for r in star["time"].collect()) == [(1, "2020-01"), (2, "2021-01")]


def test_fact_by_name_and_second_load(spark, star):
    named = star["fact"].join(star["disease"], "disease_key").join(star["time"], "time_key")
    found = {(r["icd11_code"], r["year"]): (r["daly_value"], r["source_key"]) for r in named.collect()}
    assert found == {("2C61", 2020): (3.0, 9), ("1F45", 2021): (9.0, 7)}
    again = warehouse.build_dim_disease(star["disease"], spark.createDataFrame([("C50", "2C61", None)], "icd10Code string, icd11Code string, icd11_chapter array<string>"),
                                        spark.createDataFrame([("2C61", "renamed")], "icd_code string, title string"))
    old = {r["icd11_code"]: r["disease_key"] for r in star["disease"].collect()}
    new = {r["icd11_code"]: r for r in again.collect()}
    assert {k: v["disease_key"] for k, v in new.items()} == old and new["2C61"]["disease_name"] == "renamed"


def test_dim_trials(spark, star):
    def trial(key, places, codes, end=None):
        row = dict.fromkeys(TRIALS.names)
        row.update(trial_id=key, phases=[1, 2], countries_status=places, end_date=end, codes=([], [(c, "x") for c in codes]))
        return tuple(row.values())
    trials = spark.createDataFrame([
        trial("a", [("DEU", "o", "s2"), ("DEU ", "o", "s1"), ("FRA", "o", "s")], ["1F45", "2C61", "none"]),
        trial("b", [("DEU", "o", "s")], [], datetime.datetime(2024, 1, 1)), trial("c", [], ["1F45"])], TRIALS)
    keys = {r["icd11_code"]: r["disease_key"] for r in star["disease"].collect()}
    got = {r["trial_id"]: r for r in warehouse.build_dim_trials(trials, star["region"], star["disease"], NOW).collect()}
    assert set(got) == {"a", "b"}
    assert (got["a"]["disease_key"], got["a"]["status"], got["a"]["stage"], got["a"]["active"]) == (min(keys["1F45"], keys["2C61"]), "s1", "1,2", True)
    assert got["b"]["disease_key"] is None and got["b"]["active"] is False
    counts = warehouse.verify(star["region"], star["disease"], star["fact"], warehouse.build_dim_trials(trials, star["region"], star["disease"], NOW)).first()
    assert counts.asDict() == {"regions": 1, "diseases": 3, "fact_with_daly": 2, "trials": 2}


def test_enrichment_keeps_or_resets(spark, star):
    fact = star["fact"].withColumn("trial_count", F.lit(5).cast("bigint"))
    trials = spark.createDataFrame([("t1", ["x", "cerebral MALARIA"]), ("t2", ["malaria"]), ("t3", None)], "trial_id string, conditions array<string>")
    articles = spark.createDataFrame([("u1", "Malaria is bad", None), ("u2", "ok", "malaria good"), ("u3", None, "malaria")], "url string, title string, description string")
    works = spark.createDataFrame([("w1", "Invasive breast cancer"), ("w2", None)], "work_id string, title string")
    lexicon = spark.createDataFrame([("bad", -2.5), ("good", 1.9)], "word string, score double")
    def run(reset):
        out = enrichment.enrich(fact, trials, articles, works, star["disease"], lexicon, reset)
        return {r["icd11_code"]: r for r in out.join(star["disease"].select("disease_key", "icd11_code"), "disease_key").collect()}
    kept = run(False)
    assert (kept["1F45"]["trial_count"], kept["1F45"]["media_mention_count"], kept["1F45"]["publication_count"]) == (2, 3, None)
    assert (kept["2C61"]["trial_count"], kept["2C61"]["publication_count"], kept["2C61"]["norm_research_score"]) == (5, 1, 1.0)
    assert kept["1F45"]["media_sentiment_score"] == round((-0.5423 + 0.4404) / 2, 4) and kept["1F45"]["norm_media_score"] == 1.0
    assert run(True)["2C61"]["trial_count"] is None
