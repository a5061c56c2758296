"""Streaming forms, driven to completion over files."""

import time

from pyspark.sql import functions as F

from seqframe.streaming import reads as R

SCHEMA = "read_id string, seq string, qual array<int>, arrived timestamp"


def put(spark, path, rows):
    spark.createDataFrame(rows, "read_id string, seq string, qual array<int>, t string").withColumn("arrived", F.to_timestamp("t")).drop("t").coalesce(1).write.mode("append").parquet(path)


def drain(df, name, mode="append"):
    q = df.writeStream.outputMode(mode).format("memory").queryName(name).start()
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return df.sparkSession.table(name).collect()


def test_statistics_and_first_wins(spark, tmp_path):
    path = str(tmp_path / "in")
    put(spark, path, [("a", "ACGG", [1, 2, 3, 4], "2024-01-01 00:10:00"), ("b", "AA", [5, 5], "2024-01-01 00:20:00")])
    put(spark, path, [("a", "TTTT", [1, 1, 1, 1], "2024-01-01 00:30:00"), ("c", "CC", [2, 2], "2024-01-01 01:30:00")])
    stream = R.stream_table(spark, path, SCHEMA)
    last = {}
    for r in drain(R.running_statistics(stream), "s1", "update"):
        last[r["start"]] = (r["n_reads"], r["n_bases"])
    assert sorted(last.values()) == [(1, 2), (3, 10)]
    assert sorted(r["read_id"] for r in drain(R.first_wins(R.stream_table(spark, path, SCHEMA)), "s2")) == ["a", "b", "c"]
    ids = spark.createDataFrame([("a",)], "read_id string")
    assert {r["read_id"] for r in drain(R.pick_ids(R.stream_table(spark, path, SCHEMA), ids), "s3")} == {"a"}
    assert {r["read_id"] for r in drain(R.pick_ids(R.stream_table(spark, path, SCHEMA), ids, keep=False), "s4")} == {"b", "c"}


def test_cut_states(spark, tmp_path):
    path = str(tmp_path / "runs")
    for rows in ([(1, 1, 0), (2, 1, 1), (3, 1, 1)], [(1, 2, 2), (2, 2, 1), (3, 2, 2)]):
        spark.createDataFrame(rows, "project long, ord long, cls int").coalesce(1).write.mode("append").parquet(path)
    stream = R.stream_table(spark, path, "project long, ord long, cls int")
    last = {}
    for r in drain(R.cut_states(stream), "s5", "update"):
        last.setdefault(r["project"], []).append(r["state"])
    assert last[1][-1] == 2 and last[2][-1] == 1 and -1 in last[3]


def test_quiet_projects_are_closed(spark, tmp_path):
    """A project without runs for a while comes out closed, and begins anew if it comes again."""
    path = str(tmp_path / "runs")
    add = lambda *rows: spark.createDataFrame(list(rows), "project long, ord long, cls int").coalesce(1).write.mode("append").parquet(path)

    def seen(row):
        """Whether the row comes out in time; a query with timers always has another batch, so it is not driven to its end."""
        deadline = time.time() + 60
        while time.time() < deadline:
            if row in {tuple(r) for r in spark.table("s7").collect()}:
                return True
            time.sleep(1)
        return False

    add((1, 1, 2), (2, 1, 1))
    q = R.cut_states(R.stream_table(spark, path, "project long, ord long, cls int"), quiet_ms=500).writeStream.outputMode("update").format("memory").queryName("s7").start()
    try:
        assert seen((1, 2, True)) and seen((2, 1, True))
        add((1, 2, 1))
        assert seen((1, 1, False))
    finally:
        q.stop()
