import glob
from collections import Counter
from datetime import datetime, timedelta

from tidewell.queries import files
from tidewell.streaming.dedup import append_once, drop_repeats, late_rows

SCHEMA = "k string, ts timestamp, v int"
START = datetime(2024, 1, 1)


def at(hours):
    return START + timedelta(hours=hours)


def test_repeats_over_a_restart_and_late_rows(spark, tmp_path):
    landed, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))

    def land(*rows):
        spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(landed)

    def run():
        rows = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(landed)
        query = append_once(drop_repeats(rows, ["k"], "ts", "2 hours"), out, state)
        query.awaitTermination()
        return sorted(r["v"] for r in spark.read.schema(SCHEMA).parquet(out).collect()), late_rows(query)

    land(("a", at(0), 1), ("a", at(0), 1), ("b", at(1), 2), (None, at(1), 3), (None, at(1), 3), ("untimed", None, 4))
    assert run() == ([1, 2, 3], 0)
    # After the restart: repeats of both, one of them under another time, and a new row.
    land(("b", at(1), 2), ("a", at(2), 9), ("c", at(10), 5))
    assert run() == ([1, 2, 3, 5], 0)
    # The watermark is at hour 8: the new row d is too late, e is not.
    land(("d", at(3), 6), ("e", at(9), 7), ("c", at(10), 5))
    assert run() == ([1, 2, 3, 5, 7], 1)
    assert run() == ([1, 2, 3, 5, 7], 0)


def test_query_lands_files_by_many_tasks(spark, tmp_path, monkeypatch):
    """Events in four input files: no file of the stream comes from one task that reads them all."""
    monkeypatch.setattr(files, "scratch_path", lambda _, stem: str(tmp_path / stem))
    events = [(n, n % 5, START + timedelta(hours=n * 30 * 24 / 400), n / 2) for n in range(400)]
    schema = "event_id long, user_id long, ts timestamp, value double"
    spark.createDataFrame(events, schema).repartition(4, "event_id").write.parquet(str(tmp_path / "in" / "events.parquet"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        got = {tuple(r) for r in files.stream_dedup_watermark(spark, str(tmp_path / "in")).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    ends = {c: max(e[2] for e in events if (e[2] - START).days // 10 == c) for c in range(3)}
    late = sum(1 for e in events if e[0] % 10 == 0 and (e[2] - START).days < 10 and e[2] < ends[0] - timedelta(days=3))
    users = Counter(e[1] for e in events)
    assert got == {(u, n, n, late) for u, n in users.items()} and late > 0
    assert len(glob.glob(str(tmp_path / "landed-events" / "part-*"))) >= 2 * len(ends)
