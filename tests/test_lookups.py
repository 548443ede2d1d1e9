import pytest
from pyspark.sql import functions as F

from tidewell.operators import dedup, lookups
from tidewell.operators.inplace import IN_PLACE, in_place
from tidewell.operators.sizing import Bound, salted_join
from tidewell.schemas import BOOL, INT, S, many, record


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_join_under_skew(spark, how):
    """One key holds most rows."""
    many_rows = spark.range(3000).select("id", F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"))
    few = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("k9", 4)], "k string, v int")
    plain = many_rows.join(few, "k", how)
    salted = salted_join(many_rows, few, ["k"], F.col("id"), how=how, salts=8)
    assert sorted(map(tuple, salted.select(*plain.columns).collect())) == sorted(map(tuple, plain.collect()))


def test_bound_counts_rows_and_bytes(spark):
    df = spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert Bound(10, 20_000).holds(df) and not Bound(9, 20_000).holds(df) and not Bound(10, 9_000).holds(df)
    assert Bound().holds(df.limit(0))


def test_conform_casts_what_it_can(spark):
    df = spark.createDataFrame([("7", "yes", ["a"]), ("x", None, None)], "n string, b string, l array<string>")
    got = lookups.conform(df.select("l", "n", "b"), record(n=INT, b=BOOL, l=many(S))).collect()
    assert [tuple(r) for r in got] == [(7, True, ["a"]), (None, None, None)]


def test_lookup_when_and_unmapped(spark):
    df = spark.createDataFrame([("COUNTRY", "DEU"), ("REGION", "DEU"), ("country", "XXX"), (None, "DEU")], "t string, c string")
    table = spark.createDataFrame([("DEU", 81)], "id string, loc int")
    is_country = F.lower("t") == "country"
    got = lookups.lookup_when(df, is_country, "c", table, "id", ["loc"])
    assert [r["loc"] for r in got.orderBy(F.col("t").asc_nulls_last(), "c").collect()] == [81, None, None, None]
    assert [r["c"] for r in lookups.unmapped(got, "c", "loc", is_country).collect()] == ["XXX"]


@pytest.mark.parametrize("bound", [IN_PLACE, Bound(max_rows=0)], ids=["in place", "joined"])
def test_map_list_keeps_order_and_unmapped(spark, bound):
    df = spark.createDataFrame([(1, ["b", "z", "a", "b"]), (2, []), (3, None)], "id int, l array<string>")
    table = spark.createDataFrame([("a", "A"), ("b", "B2"), ("b", "B1")], "f string, t string")
    keep = {r["id"]: r["o"] for r in lookups.map_list(df, "id", "l", table, "f", "t", "o", bound=bound).collect()}
    assert keep == {1: ["B1", "B2", "z", "A", "B1", "B2"], 2: [], 3: []}
    drop = {r["id"]: r["o"] for r in lookups.map_list(df, "id", "l", table, "f", "t", "o", keep_unmapped=False, bound=bound).collect()}
    assert drop[1] == ["B1", "B2", "A", "B1", "B2"]


def test_lookup_in_place(spark):
    pairs = [(f"k{i % 500}", None if i % 7 == 0 else i) for i in range(2000)] + [(None, 1)]
    table = spark.createDataFrame(pairs, "a string, b int")
    find = in_place(table, "a", "b")
    got = spark.createDataFrame([(f"k{i}",) for i in range(510)] + [(None,)], "k string").select("k", find(F.col("k")).alias("v"))
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    for k, v in got.collect():
        want = {b for a, b in pairs if a == k and k is not None}
        assert (v is None) if not want else ({x["v"] for x in v} == want and len(v) == len(want))
    assert in_place(table, "a", "b", Bound(max_rows=3)) is None
    none = in_place(table.where("false"), "a", "b")
    assert spark.range(1).select(none(F.lit("x"))).first()[0] is None


def test_append_swapped_is_idempotent(spark):
    meta = spark.createDataFrame([("x", "1", "other")], "id string, name string, dimension string")
    gbd = spark.createDataFrame([("location", 81, "DEU"), ("sex", 1, "Male")], "dimension string, id bigint, name string")
    once = lookups.append_swapped(meta, gbd)
    assert sorted(map(tuple, once.collect())) == [("DEU", "81", "gho_ihme_country"), ("x", "1", "other")]
    assert lookups.append_swapped(once, gbd).count() == 2


def test_latest_per_key_with_a_hot_key(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), (F.col("id") * 7 % 5000).alias("d"), "id")
    got = dedup.latest_per_key(df, ["k"], "d", ["id"])
    want = df.groupBy("k").agg(F.max(F.struct("d", "id")).alias("m")).select("k", "m.d", "m.id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
