import random

import pytest
from pyspark.sql import functions as F

from tidewell.operators import upsert
from tidewell.schemas import INT, S, many, record
from tidewell.sources.master import Master

COLUMNS = "url string, published_at string, title string, source_apis array<string>, " \
          "first_seen_at string, last_seen_at string, version int"


def rows(spark, *values):
    return spark.createDataFrame(list(values), COLUMNS)


def by_url(df):
    return {r["url"]: r.asDict() for r in df.collect()}


@pytest.fixture
def existing(spark):
    return rows(
        spark,
        ("same", "2024-01-02", "old", ["A"], "t0", "t0", 3),
        ("newer", "2024-01-02", "old", ["A"], "t0", "t0", 1),
        ("older", "2024-01-02", "old", ["A"], "t0", "t0", 1),
        ("idle", "2024-01-02", "old", ["A"], "t0", "t0", 1),
        ("undated", None, "old", None, "t0", "t0", 1),
        ("nodate", "2024-01-02", "old", ["A"], "t0", "t0", 1))


@pytest.fixture
def incoming(spark):
    return rows(
        spark,
        ("same", "2024-01-02", "inc", ["B"], "t1", "t1", 1),
        ("newer", "2024-01-03", "inc", ["B"], "t1", "t1", 1),
        ("older", "2024-01-01", "inc", ["A", "B"], "t1", "t1", 1),
        ("undated", "2024-01-01", "inc", ["B"], "t1", "t1", 1),
        ("nodate", None, "inc", ["B"], "t1", "t1", 1),
        ("fresh", "2024-01-01", "first", ["B"], "t1", "t1", 1),
        ("fresh", "2024-01-05", "second", ["C"], "t1", "t2", 1),
        (None, "2024-01-05", "keyless", ["C"], "t1", "t1", 1))


def test_four_cases(existing, incoming):
    found = by_url(upsert.upsert_by_date(existing, incoming, "url", "published_at", "source_apis"))
    assert len(found) == 7
    assert (found["newer"]["title"], found["newer"]["version"], found["newer"]["first_seen_at"]) == ("inc", 2, "t0")
    assert found["newer"]["source_apis"] == ["A", "B"]
    for key in ("same", "older"):
        assert found[key]["title"] == "old" and found[key]["last_seen_at"] == "t1"
        assert found[key]["source_apis"] == ["A", "B"]
    assert found["same"]["version"] == 3
    assert found["idle"]["last_seen_at"] == "t0" and found["idle"]["source_apis"] == ["A"]
    # A stored row without a date is older than any date; an incoming one without changes nothing.
    assert (found["undated"]["title"], found["undated"]["version"]) == ("inc", 2)
    assert found["undated"]["source_apis"] == ["B"]
    assert found["nodate"]["title"] == "old" and found["nodate"]["source_apis"] == ["A"]
    # Copies in one batch: the newest content, all sources, one row.
    assert (found["fresh"]["title"], found["fresh"]["version"]) == ("second", 1)
    assert found["fresh"]["source_apis"] == ["B", "C"] and found["fresh"]["last_seen_at"] == "t2"


def test_stats_and_first_run(existing, incoming):
    batch = upsert.collapse_incoming(incoming, "url", "published_at", "source_apis")
    merged = upsert.merge_with_status(existing, batch, "url", "published_at", "source_apis")
    stats = upsert.upsert_stats(merged).first().asDict()
    assert stats == {"total": 7, "new": 1, "updated": 2, "source_only": 2}
    assert upsert.upsert_by_date(None, incoming, "url", "published_at", "source_apis").count() == 6


def test_columns_of_existing_rule(spark, existing, incoming):
    extra = incoming.withColumn("added", F.lit("x")).drop("title")
    merged = upsert.upsert_by_date(existing, extra, "url", "published_at", "source_apis")
    assert merged.columns == existing.columns
    assert by_url(merged)["newer"]["title"] == "old"


def test_without_version_new_rows_keep_content(spark, existing, incoming):
    merged = upsert.upsert_by_date(existing.drop("version"), incoming.drop("version"), "url", "published_at")
    assert by_url(merged)["fresh"]["title"] == "second"


def test_idempotent_and_order_free_content(spark):
    rng = random.Random(5)
    base = [(f"k{i}", f"2024-01-{rng.randint(1, 28):02d}", f"t{i}", ["A"], "s", "s", 1) for i in range(40)]
    one = [(f"k{rng.randint(0, 60)}", f"2024-02-{i % 28 + 1:02d}", f"x{i}", ["B"], "s", "s", 1) for i in range(28)]
    two = [(f"k{rng.randint(0, 60)}", f"2024-03-{i % 28 + 1:02d}", f"y{i}", ["C"], "s", "s", 1) for i in range(28)]
    b, x, y = rows(spark, *base), rows(spark, *one), rows(spark, *two)

    def merge(old, new):
        return upsert.upsert_by_date(old, new, "url", "published_at", "source_apis")

    once = by_url(merge(b, x))
    assert once == by_url(merge(merge(b, x), x))
    assert set(once) == {r[0] for r in base} | {r[0] for r in one}
    xy, yx = by_url(merge(merge(b, x), y)), by_url(merge(merge(b, y), x))
    assert {k: v["title"] for k, v in xy.items()} == {k: v["title"] for k, v in yx.items()}


def test_dimension_upsert_keeps_value_when_new_is_null(spark):
    old = spark.createDataFrame([(1, "a", "x", "p"), (2, "b", "y", None)], "k int, code string, name string, grp string")
    new = spark.createDataFrame([("b", "z", "q"), ("a", "w", None), ("c", "v", "r")], "code string, name string, grp string")
    found = {r["code"]: tuple(r) for r in upsert.upsert_dim(old, new, ["code"], ["name"], ["grp"]).collect()}
    assert found == {"a": (1, "a", "w", "p"), "b": (2, "b", "z", "q"), "c": (None, "c", "v", "r")}


def test_assigned_keys_are_dense(spark):
    old = spark.createDataFrame([(7, "n3"), (9, "n5")], "id bigint, name string")
    df = spark.createDataFrame([(f"n{i}",) for i in range(200)], "name string")
    keyed = {r["name"]: r["id"] for r in upsert.assign_keys(df, old, ["name"], "id").collect()}
    assert keyed["n3"] == 7 and keyed["n5"] == 9
    assert sorted(v for k, v in keyed.items() if k not in ("n3", "n5")) == list(range(10, 208))


def test_master_refuses_another_number_of_buckets_and_compacts(spark, tmp_path):
    schema = record(url=S, published_at=S, title=S, source_apis=many(S), first_seen_at=S, last_seen_at=S, version=INT)

    def opened(buckets=None):
        return Master(spark, str(tmp_path / "m"), schema, "url", "published_at", "source_apis", buckets=buckets)
    opened(4).overwrite(rows(spark, *[(f"u{i}", "2024-01-01", "a", ["A"], "t", "t", 1) for i in range(40)]))
    with pytest.raises(ValueError):
        opened(8)
    master = opened()
    assert master.buckets == 4
    for day in range(2, 5):
        counts = master.upsert(rows(spark, ("u7", f"2024-01-0{day}", "b", ["B"], "t", "t", 1), ("new", "2024-01-01", "c", ["C"], "t", "t", 1)))
        assert counts["total"] == 2  # what is written follows the batch
    before = by_url(master.read())
    assert before["u7"]["version"] == 4 and len(before) == 41
    assert master.compact() == 5 and master.compact() is None
    assert by_url(opened().read()) == before


def test_many_batches_leave_few_files(spark, tmp_path):
    schema = record(url=S, published_at=S, title=S, source_apis=many(S), first_seen_at=S, last_seen_at=S, version=INT)
    master = Master(spark, str(tmp_path / "m"), schema, "url", "published_at", "source_apis", buckets=2)
    plain, folders = {}, []
    for n in range(1, 16):
        batch = [(f"u{i}", f"2024-01-{n:02d}", f"t{n}", ["A"], "t", "t", 1) for i in {n % 5, n % 7, 100 + n}]
        master.upsert(rows(spark, *batch), fold_at=3)
        plain |= {b[0]: b[2] for b in batch}
        assert {r["url"]: r["title"] for r in master.read().select("url", "title").collect()} == plain
        folders.append(len(list((tmp_path / "m").glob("v=*"))))
        assert max(len(v) for v in master._current().values()) < 3
    assert max(folders) <= 8 and folders[-1] <= 8  # 15 batches and their foldings wrote over 20
    assert master.upsert(rows(spark, ("u1", "2024-02-01", "last", ["A"], "t", "t", 1)))["updated"] == 1
    # The rest of a write that may still run is left alone.
    running = tmp_path / "m" / f"v={master.versions()[-1] + 1}" / "data"
    running.mkdir(parents=True)
    master.remove_unused(keep=1)
    assert running.exists() and len(master.versions()) <= 3 and master.read().count() == len(plain)


def test_master_rewrites_touched_buckets_and_skips_unfinished_versions(spark, tmp_path):
    schema = record(url=S, published_at=S, title=S, source_apis=many(S), first_seen_at=S, last_seen_at=S, version=INT)
    master = Master(spark, str(tmp_path / "m"), schema, "url", "published_at", "source_apis", buckets=8)
    assert master.read().count() == 0
    first = rows(spark, *[(f"u{i}", "2024-01-01", "a", ["A"], "t", "t", 1) for i in range(50)])
    assert master.upsert(first)["new"] == 50
    counts = master.upsert(rows(spark, ("u7", "2024-01-02", "b", ["B"], "t", "t", 1)))
    assert counts["updated"] == 1 and counts["total"] < 50
    assert master.read().count() == 50 and by_url(master.read())["u7"]["version"] == 2
    # A version without its `current` table is the rest of a job that died.
    (tmp_path / "m" / "v=3" / "data").mkdir(parents=True)
    assert master.versions() == [1, 2] and master.read().count() == 50
    assert master.upsert(first)["source_only"] == 50
    assert master.versions() == [1, 2, 4]
    assert by_url(master.read())["u7"]["title"] == "b"
    assert master.upsert(first.limit(0)) == {"total": 0, "new": 0, "updated": 0, "source_only": 0}
