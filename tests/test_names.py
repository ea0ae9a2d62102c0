from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.functions import names as N

CASES = {"businessUnitId": "business_unit_id", "URLPath": "url_path", "HTTPServerID": "http_server_id",
         "jobV2Name": "job_v2_name", "already_snake": "already_snake"}
HEADERS = {"﻿Employee ID": "employee_id", "Date ": "date", "2nd Col": "c_2nd_col", "Año": "a_o"}


def test_snake_driver():
    for raw, want in CASES.items():
        assert N.snake(raw) == want


def test_snake_column_matches_driver(spark):
    df = spark.createDataFrame([(k,) for k in CASES], "n string")
    got = {r[0]: r[1] for r in df.select("n", N.snake_col(F.col("n"))).collect()}
    assert got == CASES


def test_header_clean_both_forms(spark):
    for raw, want in HEADERS.items():
        assert N.clean_header(raw) == want
    df = spark.createDataFrame([(k,) for k in HEADERS], "h string")
    got = {r[0]: r[1] for r in df.select("h", N.clean_header_col(F.col("h"))).collect()}
    assert got == HEADERS


def _one(spark, form, names):
    df = spark.createDataFrame([(n,) for n in names], "n string")
    return {r["n"]: r["x"] for r in df.select("n", form(F.col("n")).alias("x")).collect()}


def test_camel_and_class(spark):
    camel = {"invoice_id": "invoiceId", "a__b": "aB", "x_yZ": "xYz", "": "", "_a": "A"}
    assert _one(spark, N.camel_col, camel) == camel
    kinds = {"invoice_id": "snake_case", "invoiceId": "camelCase", "Invoice": "other", "a": "snake_case", "": "other"}
    assert _one(spark, N.naming_class_col, kinds) == kinds


def test_table_name_fallback(spark):
    want = {"/jobs//time-sheets/": "jobs_time_sheets", "a": "a", "-": "", "a_-_b": "a_b"}
    assert _one(spark, N.table_name_fallback_col, want) == want


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abcXYZ019_", max_size=12))
def test_snake_idempotent(name):
    assert N.snake(N.snake(name)) == N.snake(name)


def test_snake_column_random_agrees(spark):
    names = ["aB", "ABc", "a1B", "HTTPRequest", "getHTTPResponseCode", "_x", "ÁbC", "x__Y", "XMLHttp2Go"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r[0]: r[1] for r in df.select("n", N.snake_col(F.col("n"))).collect()}
    assert got == {n: N.snake(n) for n in names}


def test_column_forms_match_driver_twins_on_random_names(spark):
    import random
    rnd = random.Random(11)
    alphabet = "abcxyzABCXYZ0129_-/ #ñ"
    names = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 14))) for _ in range(400)]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    rows = df.select("n", N.snake_col(F.col("n")).alias("s"), N.clean_header_col(F.col("n")).alias("h")).collect()
    for r in rows:
        assert r["s"] == N.snake(r["n"]), r["n"]
        assert r["h"] == N.clean_header(r["n"]), r["n"]


def test_title_matches_python_title(spark):
    names = ["tbl_12", "job2go_v3", "a__b", "", "x", "ÁbC dE", "2nd_col", "o'neil_x", "gross-pay-items"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r[0]: r[1] for r in df.select("n", N.title_file_name_col(F.col("n"))).collect()}
    assert got == {n: n.replace("_", " ").title() for n in names}
