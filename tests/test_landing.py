import json
import os

from pyspark.sql import functions as F

from ledgerline.operators import normalize as NZ
from ledgerline.sources import csv as CSV
from ledgerline.sources import landing as LD
from ledgerline.sources import writers as WR

# FIXTURES section 2: the landed rows every normalize test must include.
LINES = [
    '{"id": 1, "businessUnitId": 10, "zip": 12345,    "items": [{"skuName": "a"}], "job": {"items": null}}',
    '{"id": 2, "businessUnitId": 11, "zip": "Tester", "items": null,               "job": {"items": {"skuName": "b"}}}',
    '{"id": 3, "businessUnitId": null,                "items": {},                 "job": null}',
    '{"id": 4, "businessUnitId": 12, "business_unit_id": 99, "items": [[], [1, 2]], "flag": true}',
    '{"id": null, "zip": "-", "items": [{"skuName": "línea\\r\\ndos"}]}',
    '{"id": 5, "zip": "00123"',
]
GOOD = [json.loads(x) for x in LINES[:5]]


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def _normalized(spark, path, layout):
    recs = LD.parse_records(LD.read_text_records(spark, path, layout))
    good, bad = LD.split_quarantine(recs)
    plan = NZ.infer_plan(good)
    return NZ.normalize(good, plan), bad, plan


def _check(rows):
    by_id = {r["id"]: r for r in rows}
    assert by_id[1]["business_unit_id"] == 10
    assert by_id[3]["business_unit_id"] is None
    assert by_id[4]["business_unit_id"] == 99          # last key wins (P2)
    assert by_id[2]["zip"] == "Tester" and by_id[1]["zip"] == "12345"   # mixed -> text (A11/P4)
    assert by_id[None]["zip"] == "-"
    assert len(by_id[2]["items"]) == 0 and len(by_id[3]["items"]) == 0  # null and {} -> [] (P3/N2)
    assert len(by_id[4]["items"]) == 1                  # [] dropped, [1,2] -> text (N3)
    assert by_id[4]["flag"] is True and by_id[1]["flag"] is None


def test_ndjson_with_bad_line(spark, tmp_dir):
    p = os.path.join(tmp_dir, "a.json")
    _write(p, "\n".join(LINES) + "\n\n")
    out, bad, plan = _normalized(spark, p, "ndjson")
    kinds = {c.name: c.kind for c in plan.columns}
    assert kinds["zip"] == "text" and kinds["items"] == "array" and kinds["id"] == "bigint"
    rows = out.collect()
    assert len(rows) == 5
    _check(rows)
    b = bad.collect()
    assert len(b) == 1 and b[0]["preview"].startswith('{"id": 5')
    txt = [r for r in rows if r["id"] is None][0]["items"][0]
    assert txt.toPython()["skuName"] == "línea\r\ndos"


def test_list_dump_indent2(spark, tmp_dir):
    p = os.path.join(tmp_dir, "dump.json")
    _write(p, json.dumps(GOOD, indent=2, ensure_ascii=False))
    out, bad, _ = _normalized(spark, p, "indent2")
    assert bad.count() == 0
    _check(out.collect())


def test_streamed_array(spark, tmp_dir):
    p = os.path.join(tmp_dir, "stream.json")
    _write(p, "[\n" + ",\n".join(json.dumps(x, indent=2, ensure_ascii=False) for x in GOOD) + "\n]")
    out, bad, _ = _normalized(spark, p, "streamed")
    assert bad.count() == 0
    _check(out.collect())


def test_empty_layouts(spark, tmp_dir):
    d = os.path.join(tmp_dir, "empties")
    os.makedirs(d)
    _write(os.path.join(d, "a.json"), "[]")
    _write(os.path.join(d, "b.json"), "")
    _write(os.path.join(d, "c.json"), "[\n]\n")
    assert LD.read_text_records(spark, d, "indent2").count() == 0


def test_leading_blank_is_ndjson_in_report(spark, tmp_dir):
    d = os.path.join(tmp_dir, "rep")
    os.makedirs(d)
    _write(os.path.join(d, "lead.json"), " [\n" + json.dumps(GOOD[0]) + "\n]")
    _write(os.path.join(d, "nd.json"), "\n".join(LINES))
    _write(os.path.join(d, "arr.json"), json.dumps(GOOD, indent=2))
    rep = {os.path.basename(r["file_path"]): r for r in LD.file_report(spark, d, "ndjson").collect()}
    assert rep["lead.json"]["layout_seen"] == "ndjson"
    assert rep["arr.json"]["layout_seen"] == "array"
    assert rep["nd.json"]["n_bad"] == 1 and rep["nd.json"]["status"] == "malformed"


def test_writer_roundtrip_both_layouts(spark, tmp_dir):
    df = spark.range(0, 1000, numPartitions=5).select(F.col("id"), (F.col("id") * 2).alias("x"),
                                                      F.concat(F.lit("a\nb"), F.col("id").cast("string")).alias("s"))
    for layout in ("indent2", "streamed"):
        p = os.path.join(tmp_dir, layout)
        WR.write_json_array(df, p, layout)
        back = LD.read_text_records(spark, p, layout).select(
            F.from_json("value", "id bigint, x bigint, s string").alias("r")).select("r.*")
        assert back.exceptAll(df).count() == 0 and back.count() == 1000
        for f in os.listdir(p):
            if f.startswith("part-") and os.path.getsize(os.path.join(p, f)) > 0:
                with open(os.path.join(p, f), encoding="utf-8") as fh:
                    json.load(fh)   # every file is one valid JSON array


def test_csv_header_schema(spark, tmp_dir):
    p = os.path.join(tmp_dir, "ts.csv")
    _write(p, '﻿Employee ID,Date ,2nd Col,Año\n7,2025-01-02,"multi\nline",x\n8,2025-01-03,b,y\n')
    df = CSV.read_landed_csv(spark, p)
    assert df.columns == ["employee_id", "date", "c_2nd_col", "a_o"]
    assert dict(df.dtypes)["employee_id"] == "int" and dict(df.dtypes)["date"] == "date"
    rows = df.orderBy("employee_id").collect()
    assert rows[0]["c_2nd_col"] == "multi\nline"


def test_csv_files_meet_by_column_name(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "a b.csv"), "Name,City\nann,rome\n")
    _write(os.path.join(tmp_dir, "b.csv"), "City,Name,Date\noslo,bob,2025-01-02\n")
    _write(os.path.join(tmp_dir, "c.csv"), "Name,City\ncid,bonn\n")
    df = CSV.read_landed_csv(spark, tmp_dir)
    assert sorted((r["name"], r["city"], str(r["date"])) for r in df.collect()) == [
        ("ann", "rome", "None"), ("bob", "oslo", "2025-01-02"), ("cid", "bonn", "None")]


def test_resolve_landed_files(spark):
    listing = spark.createDataFrame([("export_a_b.csv",), ("a_b.csv",), ("C D.csv",), ("x.csv",)],
                                    "file_name string")
    tables = spark.createDataFrame([("a_b",), ("c_d",), ("x",), ("nope",)], "table_name string")
    got = {r["table_name"]: r["file_name"] for r in LD.resolve_landed_files(listing, tables).collect()}
    assert got == {"a_b": "export_a_b.csv", "c_d": "C D.csv", "x": "x.csv"}


def test_nested_known_array_repaired(spark, tmp_dir):
    p = os.path.join(tmp_dir, "nested.json")
    _write(p, "\n".join(LINES[:5]) + "\n" + '{"id": 6, "job": {"items": [[], [3]], "jobName": "x"}}\n')
    out, _, plan = _normalized(spark, p, "ndjson")
    kinds = {c.name: c.kind for c in plan.columns}
    assert kinds["job"] == "struct"
    by_id = {r["id"]: r for r in out.collect()}
    assert by_id[1]["job"]["items"] == []                     # nested null -> [] (N1)
    assert len(by_id[2]["job"]["items"]) == 1                 # nested object -> [object] (N2)
    assert by_id[3]["job"] is None
    assert by_id[6]["job"]["jobName"] == "x"                  # names inside structs keep their case
    assert [str(x.toPython()) for x in by_id[6]["job"]["items"]] == ["[3]"]   # N3 at depth


def test_array_of_objects_typed_and_repaired(spark, tmp_dir):
    p = os.path.join(tmp_dir, "objs.json")
    _write(p, "\n".join([
        '{"id": 1, "items": [{"skuName": "a", "tags": null, "qty": 2}]}',
        '{"id": 2, "items": {"skuName": "b", "tags": {"t": 1}, "qty": 3.5}}',
        '{"id": 3, "items": null}',
        '{"id": 4, "items": [{"skuName": "c", "tags": [{"t": 2}], "extra": true}]}']))
    recs = LD.parse_records(LD.read_text_records(spark, p, "ndjson"))
    plan = NZ.infer_plan(recs, array_fields={"tags"})
    out = NZ.normalize(recs, plan)
    items_type = dict(out.dtypes)["items"]
    assert items_type.startswith("array<struct<"), items_type
    by_id = {r["id"]: r for r in out.collect()}
    assert by_id[1]["items"][0]["skuName"] == "a" and by_id[1]["items"][0]["tags"] == []
    assert len(by_id[2]["items"]) == 1 and len(by_id[2]["items"][0]["tags"]) == 1   # object -> [object]
    assert by_id[2]["items"][0]["qty"] == 3.5
    assert by_id[3]["items"] == []
    assert by_id[4]["items"][0]["extra"] is True and by_id[1]["items"][0]["extra"] is None


def test_compact_array_whole_layout(spark, tmp_dir):
    p = os.path.join(tmp_dir, "compact.json")
    _write(p, json.dumps(GOOD, ensure_ascii=False))          # one line, no separators
    out, bad, _ = _normalized(spark, p, "whole")
    assert bad.count() == 0
    _check(out.collect())


def test_resolve_on_real_listing(spark, tmp_dir):
    d = os.path.join(tmp_dir, "bucket")
    os.makedirs(d)
    for name in ["export_jobs.csv", "jobs.csv", "Time Sheets.csv", "other.txt"]:
        _write(os.path.join(d, name), "a\n1\n")
    listing = LD.list_landed(spark, d, "*.csv")
    assert listing.count() == 3
    tables = spark.createDataFrame([("jobs",), ("time_sheets",), ("missing",)], "table_name string")
    got = {r["table_name"]: r["file_name"] for r in LD.resolve_landed_files(listing, tables).collect()}
    assert got == {"jobs": "export_jobs.csv", "time_sheets": "Time Sheets.csv"}


def test_type_map_coercion_through_normalize(spark, tmp_dir):
    p = os.path.join(tmp_dir, "coerce.json")
    _write(p, "\n".join(['{"id": 1, "qty": "3.0", "ok": "yes", "zip": "-"}',
                         '{"id": 2, "qty": "-4.5", "ok": "No", "zip": 12}',
                         '{"id": 3, "qty": "", "ok": "maybe"}']))
    recs = LD.parse_records(LD.read_text_records(spark, p, "ndjson"))
    plan = NZ.infer_plan(recs, type_map={"qty": "INT64", "ok": "BOOL", "zip": "INT64"})
    kinds = {c.name: (c.kind, c.coerce) for c in plan.columns}
    assert kinds["zip"][0] == "text"                 # mixed: stringified, the map does not apply
    out = {r["id"]: r for r in NZ.normalize(recs, plan).collect()}
    assert (out[1]["qty"], out[2]["qty"], out[3]["qty"]) == (3, -4, None)
    assert (out[1]["ok"], out[2]["ok"], out[3]["ok"]) == (True, False, None)
    assert (out[1]["zip"], out[2]["zip"]) == ("-", "12")


def test_whole_layout_reads_multiline_arrays(spark, tmp_dir):
    d = os.path.join(tmp_dir, "whole")
    os.makedirs(d)
    _write(os.path.join(d, "pretty.json"), json.dumps(GOOD, indent=2, ensure_ascii=False))
    _write(os.path.join(d, "compact.json"), json.dumps(GOOD, ensure_ascii=False))
    _write(os.path.join(d, "empty.json"), "")
    out, bad, _ = _normalized(spark, d, "whole")
    assert bad.count() == 0 and out.count() == 2 * len(GOOD)


def test_snapshot_sink_and_latest_alias(spark, tmp_dir):
    from ledgerline.sources.writers import land_snapshot
    root = os.path.join(tmp_dir, "snaps")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string")
    p = land_snapshot(first, root, "jobs", "20250101_050000")
    land_snapshot(first.where("id = 1").withColumn("v", F.lit("a2")), root, "jobs", "20250101_110000")
    latest = LD.read_latest_snapshot(spark, p).collect()
    assert [(r["id"], r["v"]) for r in latest] == [(1, "a2")]
    assert spark.read.parquet(p).count() == 3          # every copy kept


def test_file_report_numbers_the_first_bad_line(spark, tmp_dir):
    """Lines are numbered through all splits of a file, blank ones included."""
    d = os.path.join(tmp_dir, "numbered")
    os.makedirs(d)
    lines = [json.dumps({"id": i, "pad": "x" * (i % 40)}) if i % 7 else "" for i in range(4000)]
    lines[3210] = "broken"
    lines[3900] = "also broken"
    _write(os.path.join(d, "many.json"), "\n".join(lines) + "\n")
    _write(os.path.join(d, "first.json"), "oops\n{}\n")
    _write(os.path.join(d, "good.json"), "{}\n")
    _write(os.path.join(d, "empty.json"), "\n \n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
        assert spark.read.text(os.path.join(d, "many.json")).rdd.getNumPartitions() > 5
        rep = {os.path.basename(r["file_path"]): r for r in LD.file_report(spark, d, "ndjson").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {k: (r["first_bad_line"], r["first_bad_preview"], r["n_bad"]) for k, r in rep.items()} == {
        "many.json": (3211, "broken", 2), "first.json": (1, "oops", 1), "good.json": (None, None, 0), "empty.json": (None, None, 0)}
    assert rep["empty.json"]["status"] == "empty"
    os.makedirs(os.path.join(tmp_dir, "arr"))
    _write(os.path.join(tmp_dir, "arr", "a.json"), "[\n" + ",\n".join(["{}"] * 5 + ['{"a": }'] + ["{}"] * 3) + "\n]")
    row = LD.file_report(spark, os.path.join(tmp_dir, "arr"), "streamed").first()
    assert (row["n_records"], row["n_bad"], row["first_bad_line"], row["layout_seen"]) == (9, 1, 6, "array")


def test_open_keys_become_one_map(spark):
    lines = [json.dumps({"id": i, f"k{i}": {"v": i}, "often": i % 2, **({"Rare": 1} if i % 300 == 0 else {})}) for i in range(1500)]
    recs = LD.parse_records(spark.createDataFrame([(t,) for t in lines], "value string"))
    plan = NZ.infer_plan(recs)
    assert plan.names() == ["id", "often", "rare", NZ.REST]
    out = {r["id"]: r for r in NZ.normalize(recs, plan).select(
        "id", "rare", F.map_keys(NZ.REST).alias("keys"), F.try_variant_get(F.try_element_at(NZ.REST, F.concat(F.lit("k"), "id")), "$.v", "int").alias("v")).collect()}
    assert all(out[i]["keys"] == [f"k{i}"] and out[i]["v"] == i and out[i]["rare"] == (1 if i % 300 == 0 else None) for i in range(1500))


def test_snapshot_keys(spark):
    from ledgerline.operators import quality as QA
    rows = [("a", '{"x": 1, "y": 2, "x": 3}'), ("a", '{"x": 1}'), ("b", '{"x": 1, "z": null}'), ("b", "{}"), ("c", '{"w": 1}')]
    recs = LD.parse_records(spark.createDataFrame(rows, "snap string, value string"))
    got = {tuple(r) for r in QA.snapshot_keys(recs, "snap", "obj", "a", "b").collect()}
    assert got >= {("x", 2, 1, "both"), ("y", 1, 0, "first"), ("z", 0, 1, "second")}


def test_values_without_a_schema_are_repaired(spark):
    text = ('{"list": [1, "t", null, [], [2], {"tags": {"a": 1}, "x": {"y": {"tags": null, "Tags": [[], {"tags": {}}]}}, "e": {}, "n": null, "l": [[1], []]}]}')
    recs = LD.parse_records(spark.createDataFrame([(text,)], "value string"))
    out = NZ.normalize(recs, NZ.infer_plan(recs, array_fields={"tags"})).select(F.to_json(F.col("list")).alias("j")).first()["j"]
    assert json.loads(out) == [1, "t", None, "[2]", {"tags": [{"a": 1}], "x": {"y": {"tags": [], "Tags": [{"tags": {}}]}}, "e": {}, "n": None, "l": ["[1]"]}]


def test_layouts_are_found_in_one_scan_without_a_sort(spark, tmp_dir, monkeypatch):
    texts = {"a.json": '﻿  {"id": 1}\n{"id": 2}\n', "b.json": '[\n{"id": 3},\n{"id": 4}]', "c.json": '\n [{"id": 5}]', "d.json": "\n"}
    for name, text in texts.items():
        with open(os.path.join(tmp_dir, name), "w", encoding="utf-8") as f:
            f.write(text)
    found = LD.detect_layouts(spark, tmp_dir)
    assert {r["file_path"].rsplit("/", 1)[1]: r["layout"] for r in found.collect()} == {"a.json": "ndjson", "b.json": "streamed", "c.json": "whole"}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
    scans, detect = [], LD.detect_layouts
    monkeypatch.setattr(LD, "detect_layouts", lambda *a: scans.append(a) or detect(*a))
    assert LD.read_landed(spark, tmp_dir).count() == 5 and len(scans) == 1


def test_tenant_of_each_folder_name(spark):
    from ledgerline.plans import load_job as LJ
    paths = ["/l/company_id=7/a", "/l/company_id=a%252Fb/a", "/l/company_id=a+b/a", "/l/company_id=__HIVE_DEFAULT_PARTITION__/a", "/l/a", "/l/company_id=a%2520c/a"]
    files = spark.createDataFrame([(p,) for p in paths], "file_path string")
    own = LJ.tenant_names(files, "company_id")
    assert [r[1] for r in own.collect()] == ["7", "a/b", "a+b", None, None, "a c"]
    # Nothing is decoded that has nothing to decode.
    plan = own._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RegExpExtract") + plan.count("regexp_extract") == 1
