import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions import values as V
from ledgerline.operators import keys as K
from ledgerline.operators import merge as M
from ledgerline.operators import publish as PUB
from ledgerline.operators import schema as SC


def test_dedupe_and_guard(spark):
    t = M.with_audit(spark.createDataFrame([(1, "a", 1)], "id bigint, v string, ts bigint"), "INSERT",
                     "2024-12-31 00:00:00")
    s = spark.createDataFrame([(1, "b", 2), (1, "c", 3), (2, "d", 1)], "id bigint, v string, ts bigint")
    with pytest.raises(ValueError, match="duplicate source keys"):
        K.assert_unique_keys(s, ["id"])
    out = {r["id"]: r["v"] for r in M.merge_soft_delete(t, s, "2025-01-01 00:00:00",
                                                         dedupe_order=["ts"]).collect()}
    assert out == {1: "c", 2: "d"}


def test_require_key(spark):
    with pytest.raises(ValueError):
        M.require_key(spark.createDataFrame([(1,)], "x int"))


def test_publish_versions_and_retry(spark, tmp_dir):
    root = os.path.join(tmp_dir, "pub")
    df = spark.range(10).withColumn("company_id", F.col("id") % 2)
    PUB.publish(df, root, "t", 1, partition_by=["company_id"])
    PUB.publish(df.where("id < 5"), root, "t", 1)          # retry of version 1: no-op
    assert PUB.read_published(spark, root, "t").count() == 10
    PUB.publish(df.where("id < 5"), root, "t", 2)
    assert PUB.latest_version(spark, root, "t") == 2
    assert PUB.read_published(spark, root, "t").count() == 5
    assert PUB.read_published(spark, root, "missing") is None


def test_schema_diff_rows():
    st = T.StructType([T.StructField("id", T.LongType()), T.StructField("p", T.StringType()),
                       T.StructField("n", T.StringType()), T.StructField("_etl_synced", T.StringType())])
    tt = T.StructType([T.StructField("id", T.LongType()), T.StructField("p", T.DoubleType()),
                       T.StructField("o", T.StringType()), T.StructField("_etl_synced", T.TimestampType())])
    assert SC.schema_diff_rows(st, tt) == [("n", "string", None, "add_column"), ("o", None, "string", "keep"),
                                           ("p", "string", "double", "safe_cast")]


def test_replace_field_type_any_depth():
    st = T.StructType([T.StructField("a", T.StructType([T.StructField("x", T.LongType())])),
                       T.StructField("b", T.ArrayType(T.StructType([T.StructField("x", T.LongType())])))])
    out = SC.replace_field_type(st, "x")
    assert out["a"].dataType["x"].dataType == T.StringType()
    assert out["b"].dataType.elementType["x"].dataType == T.StringType()


def test_numbers_are_decimal_text(spark):
    df = spark.createDataFrame([("12D",), ("7f",), (" 1.5e3 ",), ("-3",), (".5",), ("NaN",), ("x",), (None,)], "t string")
    got = [r[0] for r in df.select(V.coerce_float(F.col("t"))).collect()]
    assert got[:2] == [None, None] and got[2:5] == [1500.0, -3.0, 0.5] and got[5] != got[5] and got[6:] == [None, None]
    assert [r[0] for r in df.select(V.coerce_int(F.col("t"))).collect()] == [None, None, 1500, -3, 0, None, None, None]


def test_first_load_keeps_target_only_columns(spark):
    st = spark.createDataFrame([(1, "a")], "id bigint, v string")
    like = T._parse_datatype_string("id bigint, extra int, v string, _etl_synced timestamp, _etl_operation string")
    out = M.first_load(st, "2025-01-01 00:00:00", target_schema=like)
    assert out.columns[:3] == ["id", "extra", "v"] and out.select("id", "extra", "v").collect() == [(1, None, "a")]


def test_lists_of_variants_can_be_ordered_and_compared(spark):
    df = spark.createDataFrame([(1, "[1]"), (1, "[2]")], "id bigint, j string").select(
        "id", F.array(F.parse_json("j")).alias("items"))
    assert K.latest_per_key(df, ["id"], ["items"]).select(F.to_json("items")).collect()[0][0] == "[[2]]"
    t = M.with_audit(df.limit(1), "INSERT", "2024-12-31 00:00:00")
    out = M.merge_soft_delete(t, df.limit(1), "2025-01-01 00:00:00", only_changed=True)
    assert out.select("_etl_operation").collect()[0][0] == "INSERT"


def test_added_column_survives_storage(spark, tmp_dir):
    root = os.path.join(tmp_dir, "pub")
    PUB.publish_tenants(spark.createDataFrame([(1, 1), (2, 1)], "company_id bigint, id bigint"), root, "t", 1, "company_id")
    PUB.publish_tenants(spark.createDataFrame([(1, 1, "x")], "company_id bigint, id bigint, x string"), root, "t", 2, "company_id")
    live = {r["company_id"]: r["x"] for r in PUB.read_tenants(spark, root, "t", "company_id").collect()}
    assert live == {1: "x", 2: None}


def test_publish_by_token(spark, tmp_dir):
    root = os.path.join(tmp_dir, "pub")
    PUB.publish(spark.range(1), root, "t", token="a:0")
    PUB.publish(spark.range(2), root, "t", token="a:0")    # replayed batch: nothing
    assert PUB.read_published(spark, root, "t").count() == 1
    PUB.publish(spark.range(3), root, "t", token="b:0")    # a fresh checkpoint starts at batch 0 again
    assert PUB.read_published(spark, root, "t").count() == 3 and PUB.latest_version(spark, root, "t") == 2


def test_log_clean_cases(spark):
    cases = [
        ("POST https://x.io/v2/jobs: 400 Bad; reason: invalid, location: query\nmore\nJob ID: 1\n\nLocation: US",
         '400 Bad\nmore'),
        ("plain text", 'plain text'),
        ("a Location: b\n\nLocation: c", 'a Location: b'),
        ("  Job ID: x\nkeep, location: q me\r\nend  ", 'keep me\nend'),
        ("GET http://h/p?q=1: boom\n\n\nline; reason: r", 'boom\nline'),
        ("x\x0bLocation: y", 'x'),
    ]
    df = spark.createDataFrame([(m,) for m, _ in cases], "m string")
    got = [r[0] for r in df.select(V.clean_log_text(F.col("m"))).collect()]
    assert got == [want for _, want in cases]


def test_coerce_values(spark):
    df = spark.createDataFrame([("3.0",), ("-2.7",), ("N/A",), ("inf",), ("yes",), ("0",)], "s string")
    rows = df.select(V.coerce_int(F.col("s")), V.coerce_bool(F.col("s"))).collect()
    assert [r[0] for r in rows] == [3, -2, None, None, None, 0]
    assert [r[1] for r in rows] == [None, None, None, None, True, False]


def test_stream_replay_is_idempotent(spark, tmp_dir):
    from ledgerline.sources.writers import write_ndjson_append
    from ledgerline.streaming.landing_stream import run_landing_merge
    landing, root, ckpt = (os.path.join(tmp_dir, x) for x in ("landing", "tables", "ckpt"))
    e = spark.createDataFrame([(1, "a", 1, 1.0), (2, "a", 2, 2.0), (3, "b", 1, 3.0)],
                              "event_id bigint, k string, ts bigint, value double")
    write_ndjson_append(e.where("event_id < 3").coalesce(1), landing)
    write_ndjson_append(e.where("event_id = 3").coalesce(1), landing)
    schema = T._parse_datatype_string("event_id bigint, k string, ts bigint, value double")
    v1 = run_landing_merge(spark, landing, schema, root, "latest", ["k"], "ts", "2025-01-01 00:00:00", ckpt)
    v2 = run_landing_merge(spark, landing, schema, root, "latest", ["k"], "ts", "2025-01-01 00:00:00", ckpt)
    assert v1 == v2 == 2
    got = {r["k"]: r["event_id"] for r in PUB.read_published(spark, root, "latest").collect()}
    assert got == {"a": 2, "b": 3}
    from ledgerline.plans.load_job import read_monitoring
    mon = read_monitoring(spark, root).collect()
    assert [(r["actual_rows"], r["last_rows"]) for r in mon] == [(1, 1)]   # batch 2: key b; batch 1: key a


def test_declared_columns_and_the_rest_as_a_map(spark):
    from ledgerline.operators import normalize as NZ
    from ledgerline.sources import landing as LD
    df = spark.range(30).select(F.format_string('{"rowId": %d, "k%d": 1}', "id", "id").alias("value"))
    recs = LD.parse_records(df)
    assert len(NZ.infer_plan(recs).columns) == 31
    plan = NZ.infer_plan(recs, declared=["row_id"])
    assert plan.names() == ["row_id"]
    rest = recs.select(NZ.undeclared(["row_id"]).alias("m")).select(F.explode(F.map_keys("m")).alias("k"))
    assert sorted(r[0] for r in rest.collect()) == sorted(f"k{i}" for i in range(30))
    assert recs.where(NZ.undeclared(["row_id"]).isNull()).count() == 0
    none = LD.parse_records(spark.createDataFrame([('{"rowId": 1}',)], "value string"))
    assert none.where(NZ.undeclared(["row_id"]).isNull()).count() == 1


def test_publish_tenants_rewrites_only_touched(spark, tmp_dir):
    root = os.path.join(tmp_dir, "pt")
    df = spark.range(30).select(F.col("id"), (F.col("id") % 3).alias("company_id"), F.lit("v1").alias("tag"))
    PUB.publish_tenants(df, root, "t", 1, "company_id")
    upd = df.where("company_id = 1").withColumn("tag", F.lit("v2"))
    PUB.publish_tenants(upd, root, "t", 2, "company_id")
    PUB.publish_tenants(upd.limit(1), root, "t", 2, "company_id")      # retry: no-op
    v2 = sorted(d for d in os.listdir(os.path.join(root, "t", "v=2")) if d.startswith("company_id="))
    assert v2 == ["company_id=1"]
    live = PUB.read_tenants(spark, root, "t", "company_id", like=df.schema)
    tags = {(r["company_id"], r["tag"]) for r in live.collect()}
    assert tags == {(0, "v1"), (1, "v2"), (2, "v1")} and live.count() == 30
    assert dict(live.dtypes)["company_id"] == "bigint"
    only1 = PUB.read_tenants(spark, root, "t", "company_id", tenants=[1])
    assert only1.count() == 10


def test_load_job_never_deletes_tenants_without_good_files(spark, tmp_dir):
    from ledgerline.plans.load_job import read_monitoring, run_endpoint_load

    def land(path, rows):
        for tenant, lines in rows.items():
            d = os.path.join(path, f"company_id={tenant}")
            os.makedirs(d, exist_ok=True)
            with open(os.path.join(d, "part-0.json"), "w") as f:
                f.write("\n".join(lines) + "\n")

    root = os.path.join(tmp_dir, "tables")
    day1 = os.path.join(tmp_dir, "d1")
    land(day1, {0: ['{"id": 1, "v": "a"}', '{"id": 2, "v": "b"}'],
                1: ['{"id": 3, "v": "c"}'], 2: ['{"id": 4, "v": "d"}']})
    s1 = run_endpoint_load(spark, landed=day1, layout="ndjson", root=root, table="t", version=1,
                           synced_at="2025-01-01 00:00:00")
    assert {r["company_id"]: r["write_mode"] for r in s1.collect()} == {0: "first_load", 1: "first_load",
                                                                        2: "first_load"}
    day2 = os.path.join(tmp_dir, "d2")
    land(day2, {0: ['{"id": 1, "v": "a2"}'], 1: ['{"id": 3, "v": broken}']})   # tenant 2: no file
    s2 = {r["company_id"]: r for r in run_endpoint_load(
        spark, landed=day2, layout="ndjson", root=root, table="t", version=2,
        synced_at="2025-01-02 00:00:00").collect()}
    # tenant 1 had only bad records: it is reported with no rows; tenant 2 had no file
    assert set(s2) == {0, 1} and s2[1]["rows_processed"] == 0 and s2[1]["bad_records"] > 0
    assert (s2[0]["n_update"], s2[0]["n_delete"]) == (1, 1)
    from ledgerline.operators.publish import read_tenants
    live = {(r["company_id"], r["id"]): r["_etl_operation"] for r in read_tenants(
        spark, root, "t", "company_id").collect()}
    assert live == {(0, 1): "UPDATE", (0, 2): "DELETE", (1, 3): "INSERT", (2, 4): "INSERT"}
    mon = {r["company_id"]: (r["actual_rows"], r["last_rows"]) for r in read_monitoring(spark, root).collect()}
    assert mon == {0: (1, 2), 1: (0, 1), 2: (1, None)}
    assert {r["company_id"]: r["actual_status"] for r in read_monitoring(spark, root).collect()} == {
        0: "SUCCESS", 1: "FAILED", 2: "SUCCESS"}
    # the same load again changes neither the table nor the monitoring rows
    before = sorted(read_monitoring(spark, root).drop("actual_duration").collect())
    run_endpoint_load(spark, landed=day2, layout="ndjson", root=root, table="t", version=2,
                      synced_at="2025-01-02 00:00:00").collect()
    assert sorted(read_monitoring(spark, root).drop("actual_duration").collect()) == before
    # nothing parses at all: no crash, the table stays
    day3 = os.path.join(tmp_dir, "d3")
    land(day3, {0: ["broken"], 5: ["[1"]})
    s3 = run_endpoint_load(spark, landed=day3, layout="ndjson", root=root, table="t", version=3,
                           synced_at="2025-01-03 00:00:00").collect()
    assert {(r["company_id"], r["write_mode"], r["rows_processed"]) for r in s3} == {(0, "none", 0), (5, "none", 0)}
    assert read_tenants(spark, root, "t", "company_id").count() == 4


def test_export_cursor_table(spark, tmp_dir):
    from ledgerline.sources import pages as PG
    pages = spark.createDataFrame(
        [("jobs", 1, '{"data": [1, 2], "hasMore": true, "continueFrom": "t1"}'),
         ("jobs", 2, '{"data": [3], "hasMore": false, "continueFrom": "t2"}'),
         ("calls", 1, "[1, 2, 3]")], "endpoint string, page_seq int, payload string")
    cur = PG.export_cursor(pages, ["endpoint"])
    root = os.path.join(tmp_dir, "cur")
    PG.save_cursors(cur, root, 1)
    got = {r["endpoint"]: (r["n_items"], r["last_token"]) for r in PG.read_cursors(spark, root).collect()}
    assert got == {"jobs": (3, "t2"), "calls": (3, None)}
