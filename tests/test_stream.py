"""Broken lines, touched buckets, replays."""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators import publish as PUB
from ledgerline.plans.load_job import read_monitoring
from ledgerline.streaming import landing_stream as ST

SCHEMA = T.StructType([T.StructField("k", T.StringType()), T.StructField("ts", T.LongType()), T.StructField("v", T.StringType())])


def _drop(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_broken_lines_never_become_rows(spark, tmp_dir):
    landing, root, ckpt = (os.path.join(tmp_dir, x) for x in ("landing", "tables", "ckpt"))
    good = ['{"k": "a", "ts": 1, "v": "x"}', '{"k": "b", "ts": 5, "v": null, "more": 1}']
    bad = ['{"k": "a", "ts": 9, "v": "late"} trailing', '{"k": "c", "ts": 2', "null", "7", "oops", '[{"k": "d"}]', '{"k": "e"},{"k": "f"}']
    _drop(landing, "1.json", [good[0], bad[0], "", bad[1], *bad[2:], good[1], "   "])
    run = lambda: ST.run_landing_merge(spark, landing, SCHEMA, root, "t", ["k"], "ts", "2025-01-01 00:00:00", ckpt)
    assert run() == 1
    assert sorted((r["k"], r["ts"], r["v"]) for r in PUB.read_published(spark, root, "t").collect()) == [("a", 1, "x"), ("b", 5, None)]
    assert sorted(r["preview"] for r in ST.quarantined(spark, root, "t").collect()) == sorted(bad)
    _drop(landing, "2.json", ["broken only"])  # a batch without a row publishes nothing
    assert run() == 1 and ST.quarantined(spark, root, "t").count() == len(bad) + 1


def test_untouched_buckets_are_not_read(spark, tmp_dir, monkeypatch):
    landing, root, ckpt = (os.path.join(tmp_dir, x) for x in ("landing", "tables", "ckpt"))
    _drop(landing, "1.json", [f'{{"k": "k{i}", "ts": 1, "v": "one"}}' for i in range(400)])
    run = lambda: ST.run_landing_merge(spark, landing, SCHEMA, root, "t", ["k"], "ts", "2025-01-01 00:00:00", ckpt, buckets=16)
    assert run() == 1
    read = []
    whole = PUB.read_buckets

    def watched(*a, **kw):
        df = whole(*a, **kw)
        read.extend(df.inputFiles() if df is not None else [])
        return df

    monkeypatch.setattr(PUB, "read_buckets", watched)
    _drop(landing, "2.json", ['{"k": "k7", "ts": 2, "v": "two"}', '{"k": "k8", "ts": 0, "v": "old"}', '{"k": "new", "ts": 1, "v": "x"}'])
    assert run() == 2
    keys = spark.createDataFrame([("k7",), ("k8",), ("new",)], "k string")
    touched = {r[0] for r in PUB.with_bucket(keys, ["k"], 16).select(PUB.BUCKET).collect()}
    assert {int(f.split("_bucket=")[1].split("/")[0]) for f in read} == touched and len(touched) < 4
    second = PUB.tenant_versions(spark, root).where("version = 2").collect()
    assert {int(r["tenant"]) for r in second} == touched
    got = {r["k"]: (r["ts"], r["v"]) for r in PUB.read_published(spark, root, "t").collect()}
    assert len(got) == 401 and got["k7"] == (2, "two") and got["k8"] == (1, "one") and got["new"] == (1, "x")


def test_replayed_batch_does_nothing(spark, tmp_dir):
    root = os.path.join(tmp_dir, "tables")
    lines = spark.createDataFrame([("f", '{"k": "a", "ts": 1, "v": "x"}'), ("f", "broken")], "file_path string, value string")
    for _ in range(2):
        ST.merge_batch(lines, SCHEMA, root, "t", ["k"], "ts", "2025-01-01 00:00:00", 0, stream_id="s")
    ST.merge_batch(lines, SCHEMA, root, "t", ["k"], "ts", "2025-01-02 00:00:00", 0, stream_id="another")
    assert PUB.tenant_versions(spark, root).agg(F.max("version")).first()[0] == 2
    assert PUB.read_published(spark, root, "t").count() == 1 and ST.quarantined(spark, root, "t").count() == 2
    mon = read_monitoring(spark, root).collect()
    assert [(r["actual_rows"], r["last_rows"], str(r["max_sync"])[:10]) for r in mon] == [(1, 1, "2025-01-02")]


def test_drops_make_as_many_batches_at_any_number_of_scan_tasks(spark, tmp_dir):
    from ledgerline import suite
    events = spark.range(0, 600, 1, 6).selectExpr("id AS event_id", "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS ts",
                                                  "id % 20 AS user_id", "'click' AS event_type", "double(id) AS value")
    events.write.parquet(os.path.join(tmp_dir, "events.parquet"))
    assert spark.read.parquet(os.path.join(tmp_dir, "events.parquet")).rdd.getNumPartitions() > 1
    root = suite._streamed_events(spark, tmp_dir)
    assert PUB.tenant_versions(spark, root).agg(F.max("version")).first()[0] == 2   # four drops, two a batch
    got = {r["user_id"]: r["event_id"] for r in PUB.read_published(spark, root, "events_latest").collect()}
    assert got == {u: 580 + u for u in range(20)} and ST.quarantined(spark, root, "events_latest").count() == 12
