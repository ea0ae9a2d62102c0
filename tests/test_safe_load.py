"""Loads that must lose nothing: types, layouts, malformed records."""

import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators import publish as PUB
from ledgerline.operators import schema as SC
from ledgerline.plans.load_job import read_events, read_monitoring, run_endpoint_load
from ledgerline.sources import landing as LD
from ledgerline.sources import writers as WR

L, D, S, B, V = T.LongType(), T.DoubleType(), T.StringType(), T.BooleanType(), T.VariantType()


def _st(**fields):
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


@pytest.mark.parametrize("a,b,want", [
    (L, D, D), (L, S, S), (T.NullType(), L, L), (B, L, S), (B, B, B), (T.IntegerType(), L, L), (L, T.FloatType(), D),
    (T.DecimalType(10, 2), L, D), (T.DateType(), T.TimestampNTZType(), T.TimestampNTZType()), (T.DateType(), L, S), (V, L, S),
    (_st(a=L), _st(a=S, b=D), _st(a=S, b=D)), (_st(a=L), S, S), (T.ArrayType(L), T.ArrayType(D), T.ArrayType(D)),
    (T.ArrayType(_st(a=L)), T.ArrayType(_st(b=L)), T.ArrayType(_st(a=L, b=L))), (T.ArrayType(L), L, S)])
def test_lattice(a, b, want):
    assert SC.join_types(a, b) == want
    assert SC.join_types(want, a) == want and SC.join_types(want, b) == want  # an upper bound
    assert sorted(SC.join_types(b, a).simpleString()) == sorted(want.simpleString())  # but for the order of fields


def test_widen_keeps_values(spark):
    df = spark.sql("""SELECT 7L AS n, named_struct('a', 1L, 'b', CAST(NULL AS STRING)) AS s, array(1L, NULL) AS l, parse_json('"x"') AS v,
                      parse_json('{"k": 2}') AS o, true AS t, CAST(NULL AS struct<a: bigint>) AS z""")
    st = _st(a=S, c=D)
    types = {f.name: f.dataType for f in df.schema.fields}
    out = df.select(SC.widen(F.col("n"), L, S), SC.widen(F.col("n"), L, D), SC.widen(F.col("s"), types["s"], S), SC.widen(F.col("s"), types["s"], st),
                    SC.widen(F.col("l"), types["l"], T.ArrayType(S)), SC.widen(F.col("v"), V, S), SC.widen(F.col("o"), V, S),
                    SC.widen(F.col("t"), B, S), SC.widen(F.col("z"), types["z"], st)).first()
    assert list(out) == ["7", 7.0, '{"a":1,"b":null}', T.Row(a="1", c=None), ["1", None], "x", '{"k":2}', "true", None]


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


RECS = [{"id": i, "note": "a ] [ { \" x", "deep": {"l": [1, {"k": 2}]}} for i in range(5)]
FILES = {
    "nd.json": "\n".join(json.dumps(r) for r in RECS), "blank.json": "\n \n" + json.dumps(RECS[0]) + "\n\n",
    "bom.json": "﻿" + json.dumps(RECS[0]) + "\n" + json.dumps(RECS[1]),
    "dump.json": json.dumps(RECS, indent=2), "wide.json": json.dumps(RECS, indent=4), "line.json": json.dumps(RECS),
    "stream.json": "[\n" + ",\n".join(json.dumps(r) for r in RECS) + "\n]", "tight.json": "[" + ",\n".join(json.dumps(r) for r in RECS) + "]",
    "none.json": "[]", "open.json": "[\n]", "empty.json": "", "one.json": "[" + json.dumps(RECS[0]) + "]"}
WANT = {"nd": 5, "blank": 1, "bom": 2, "dump": 5, "wide": 5, "line": 5, "stream": 5, "tight": 5, "none": 0, "open": 0, "empty": 0, "one": 1}


def test_every_layout_beside_the_others(spark, tmp_dir):
    for name, text in FILES.items():
        _write(os.path.join(tmp_dir, "in", name[0], name), text)
    back = LD.parse_records(LD.read_landed(spark, os.path.join(tmp_dir, "in"))).collect()
    assert not [r for r in back if r["is_bad"]]
    got = dict.fromkeys(WANT, 0)
    for r in back:
        got[os.path.basename(r["file_path"]).split(".")[0]] += 1
    assert got == WANT
    lay = {os.path.basename(r["file_path"]): r["layout"] for r in LD.detect_layouts(spark, os.path.join(tmp_dir, "in")).collect()}
    assert lay["dump.json"] == "indent2" and lay["stream.json"] == lay["tight.json"] == "streamed" and lay["wide.json"] == lay["line.json"] == "whole"
    # one layout stated: the files of others are one malformed record each
    said = LD.parse_records(LD.read_landed(spark, os.path.join(tmp_dir, "in"), "ndjson")).groupBy("is_bad").count().collect()
    assert {r["is_bad"]: r["count"] for r in said} == {False: 8, True: 8}


def test_written_arrays_come_back(spark, tmp_dir):
    df = spark.range(0, 2500, 1, 3).select("id", F.concat(F.lit("a\n\"[{"), F.col("id")).alias("t"), (F.col("id") % 2).alias("part"))
    for layout, own in (("indent2", "indent2"), ("streamed", "streamed"), ("compact", "whole")):
        path = os.path.join(tmp_dir, layout)
        WR.write_json_array(df, path, layout, by=["part"], file_records=300)
        assert {r["layout"] for r in LD.detect_layouts(spark, path).collect()} == {own}
        assert LD.detect_layouts(spark, path).count() > 8
        recs = LD.parse_records(LD.read_landed(spark, path))
        out = recs.select(F.try_variant_get(F.col("obj")["id"], "$", "bigint").alias("id"), "is_bad").collect()
        assert sorted(r["id"] for r in out) == list(range(2500)) and not any(r["is_bad"] for r in out)


@pytest.mark.parametrize("text,want", [
    ('{"id": 7, "x": 1} trailing', "7"), ('{"x": "id", "id": "A\\"7", broken', 'A"7'), ('{"id": 12', None), ('{"id": "12', None),
    ('{"c": {"id": 5}, "id": 7, oops', "7"), ('{"c": {"id": 5}, oops', None), ('{"c": [{"id": 5}], "Id": 8 }}', None), ('{"c": [5], "Id": 8 }}', "8"), ("oops", None), ("", None),
    ('{"s": "\\"id\\": 9,", x', None), ('{"c": {"d": {"id": 5}}, "id": 7, x', None), ('{"id" : -3.5e1 , x', "-35.0"), ('{"xid": 5, y', None),
    ('{"pad": "' + "q" * 3000 + '", "id": 4, x', "4"), ('{"pad": "' + "q" * 9000 + '", "id": 4, x', None), ('{' + '"k": 1, ' * 400 + '"id": 4, x', "4"),
    ('{"t": "a } b [", "id": 6, x', "6"), ('{"id": null, x', None)])
def test_recovered_key(spark, text, want):
    df = spark.createDataFrame([(text,)], "value string")
    assert df.select(LD.recovered_key(F.col("value"), ["id", "Id"])).first()[0] == want


def _land(path, rows):
    for tenant, lines in rows.items():
        _write(os.path.join(path, f"company_id={tenant}", "part-0.json"), "\n".join(lines) + "\n")
    return path


def _live(spark, root, cols=("company_id", "id", "_etl_operation")):
    return sorted(map(str, (tuple(r) for r in PUB.read_tenants(spark, root, "t", "company_id").select(*cols).collect())))


def test_malformed_records_delete_nothing(spark, tmp_dir):
    root = os.path.join(tmp_dir, "tables")
    load = lambda v, rows: run_endpoint_load(
        spark, landed=_land(os.path.join(tmp_dir, f"d{v}"), rows), root=root, table="t", version=v, synced_at=f"2025-01-0{v} 00:00:00")
    load(1, {0: [f'{{"id": {i}}}' for i in (1, 2, 3)], 1: [f'{{"id": {i}}}' for i in (4, 5, 6)], 2: ['{"id": 7}', '{"id": 8}']})
    load(2, {0: ['{"id": 1}', '{"id": 2} x'], 1: ['{"id": 4}', '{"id": 55'], 2: ['{"id": 7}']}).collect()
    assert _live(spark, root) == sorted(map(str, [
        (0, 1, "UPDATE"), (0, 2, "INSERT"), (0, 3, "DELETE"), (1, 4, "UPDATE"), (1, 5, "INSERT"), (1, 6, "INSERT"),
        (2, 7, "UPDATE"), (2, 8, "DELETE")]))
    said = {r["company_id"]: r["event_message"] for r in read_events(spark, root).where("load = 2").collect()}
    assert said == {None: "1 rows", "1": "1 rows, deletes withheld", "2": "1 rows"}


def test_replacing_modes_refuse_malformed_tenants(spark, tmp_dir):
    root = os.path.join(tmp_dir, "tables")
    load = lambda v, rows: run_endpoint_load(
        spark, landed=_land(os.path.join(tmp_dir, f"d{v}"), rows), root=root, table="t", version=v, synced_at=f"2025-01-0{v} 00:00:00")
    load(1, {0: ['{"v": 1}', '{"v": 2}'], 1: ['{"v": 3}']})
    out = {r["company_id"]: r["write_mode"] for r in load(2, {0: ['{"v": 9}', '{"v": 2'], 1: ['{"v": 4}'], 2: ['{"v": 5}', "x"]}).collect()}
    assert out == {0: "none", 1: "replace_all", 2: "replace_all"}  # tenant 2 has nothing to lose
    assert _live(spark, root, ("company_id", "v")) == ["(0, 1)", "(0, 2)", "(1, 4)", "(2, 5)"]
    said = {r["company_id"]: (r["event_type"], r["event_message"]) for r in read_events(spark, root).where("load = 2").collect()}
    assert said[None] == ("ERROR", "malformed records") and said["2"][0] == "SUCCESS"


def test_tenants_with_different_types(spark, tmp_dir):
    root = os.path.join(tmp_dir, "tables")
    load = lambda v, rows: run_endpoint_load(
        spark, landed=_land(os.path.join(tmp_dir, f"d{v}"), rows), root=root, table="t", version=v, synced_at=f"2025-01-0{v} 00:00:00")
    load(1, {1: ['{"id": 1, "zip": 7, "a": {"x": 1}}']})
    load(2, {2: ['{"id": 1, "zip": "A7", "a": {"y": "q"}}']})
    assert _live(spark, root, ("company_id", "id", "zip")) == ["(1, 1, '7')", "(2, 1, 'A7')"]
    one = PUB.read_tenants(spark, root, "t", "company_id", tenants=[1])
    assert one.schema["zip"].dataType == L and one.schema["a"].dataType == _st(x=L)  # a tenant keeps its own types
    load(3, {1: ['{"id": 1, "zip": 8}', '{"id": 2, "zip": "B"}'], 2: ['{"id": 2, "zip": 9}']})
    assert _live(spark, root, ("company_id", "id", "zip", "_etl_operation")) == [
        "(1, 1, '8', 'UPDATE')", "(1, 2, None, 'INSERT')", "(2, 1, 'A7', 'DELETE')", "(2, 2, '9', 'INSERT')"]
    assert PUB.read_tenants(spark, root, "t", "company_id", tenants=[1]).schema["zip"].dataType == L
    load(4, {1: ['{"id": 2, "zip": 10}']})
    assert _live(spark, root, ("company_id", "id", "zip"))[:2] == ["(1, 1, '8')", "(1, 2, '10')"]
    a = {(r["company_id"], r["id"]): r["a"] for r in PUB.read_tenants(spark, root, "t", "company_id").collect()}
    assert a[2, 1].asDict() == {"x": None, "y": "q"}


def test_text_and_null_tenants(spark, tmp_dir):
    root = os.path.join(tmp_dir, "tables")
    rows = {"acme%2Fx": ['{"id": 1}'], "7": ['{"id": 2}'], "__HIVE_DEFAULT_PARTITION__": ['{"id": 3}'], "a b+c": ['{"id": 4}']}
    for v in (1, 2):
        out = run_endpoint_load(spark, landed=_land(os.path.join(tmp_dir, f"d{v}"), rows), root=root, table="t", version=v,
                                synced_at=f"2025-01-0{v} 00:00:00").collect()
        assert {r["company_id"]: r["rows_processed"] for r in out} == {"acme/x": 1, "7": 1, None: 0, "a b+c": 1}
    assert _live(spark, root) == sorted(map(str, [("acme/x", 1, "UPDATE"), ("7", 2, "UPDATE"), ("a b+c", 4, "UPDATE")]))
    PUB.publish_tenants(spark.createDataFrame([("acme/x", 5), (None, 6), ("", 7)], "company_id string, id bigint"), root, "u", 1, "company_id")
    back = PUB.read_tenants(spark, root, "u", "company_id").collect()
    assert sorted((str(r["company_id"]), r["id"]) for r in back) == [("None", 6), ("None", 7), ("acme/x", 5)]
    assert PUB.read_tenants(spark, root, "u", "company_id", tenants=["acme/x"]).count() == 1
    assert {r["company_id"] for r in read_monitoring(spark, root).collect()} >= {"acme/x", "7", "a b+c"}


def test_numbers_and_numeric_texts_are_text(spark):
    from ledgerline.operators import normalize as NZ
    recs = LD.parse_records(spark.createDataFrame([('{"zip": 7}',), ('{"zip": "08"}',), ('{"zip": "9"}',)], "value string"))
    out = NZ.normalize(recs, NZ.infer_plan(recs))
    assert out.schema["zip"].dataType == S and sorted(r["zip"] for r in out.collect()) == ["08", "7", "9"]


def test_retried_snapshot_is_kept_once(spark, tmp_dir):
    df = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    for stamp in ("2025-01-01", "2025-01-02", "2025-01-02"):
        path = WR.land_snapshot(df if stamp.endswith("1") else df.limit(2), tmp_dir, "jobs", stamp)
    assert spark.read.parquet(path).count() == 5 and LD.read_latest_snapshot(spark, path).count() == 2


@pytest.mark.parametrize("text,good", [
    ('{"a": 1}', True), (' {"a": {"b": [1]}} ', True), ("{}", True), ('{"a": 1}\t', True), ('{"a": 1} x', False), ('{"a": 1}]', False),
    ('{"a": 1}] {}', False), ('{"a": 1},{"b": 2}', False), ('{"a": 1},', False), ("[1]", False), ("null", False), ("7", False), ("", False), ("}", False),
    ('{"a": 1}}', False), ('{"a": "]}"}', True), ('{"a": 1', False), ('{"a": 1},null', False)])
def test_exactly_one_object(spark, text, good):
    df = spark.createDataFrame([(text,)], "value string")
    assert LD.parse_records(df).first()["is_bad"] == (not good)
    rec = LD.one_object(F.col("r"), F.col("value"))
    assert (df.withColumn("r", LD.one_object_array(F.col("value"), _st(a=S))).select(rec.isNotNull()).first()[0]) == good


def test_interleaved_publishers_take_different_versions(spark, tmp_dir):
    df = spark.range(3)
    first = PUB.claim_version(spark, tmp_dir, "t", 1)       # one has looked up the newest version and claimed the next,
    second = PUB.publish(df, tmp_dir, "t", token="other")   # another publishes before the first writes
    assert first == 1 and second.endswith("v=2")
    assert PUB.publish(df.limit(1), tmp_dir, "t", token="other") == second
    assert PUB.publish(df, tmp_dir, "t", token="third").endswith("v=3") and PUB.latest_version(spark, tmp_dir, "t") == 3


def test_number_ids_that_meet_text_ids(spark, tmp_dir):
    root = os.path.join(tmp_dir, "tables")
    load = lambda v, rows: run_endpoint_load(
        spark, landed=_land(os.path.join(tmp_dir, f"d{v}"), rows), root=root, table="t", version=v, synced_at=f"2025-01-0{v} 00:00:00")
    load(1, {7: ['{"id": 1}', '{"id": 2}'], 8: ['{"id": 3}']})
    load(2, {7: ['{"id": 1}'], "acme": ['{"id": 4}']})
    load(3, {7: ['{"id": 2}', '{"id": 5} x'], 8: ['{"id": 3}', '{"id": 6}']}).collect()
    assert _live(spark, root) == sorted(map(str, [("7", 1, "DELETE"), ("7", 2, "UPDATE"), ("8", 3, "UPDATE"), ("8", 6, "INSERT"), ("acme", 4, "INSERT")]))
