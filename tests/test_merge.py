import datetime as dt

from pyspark.sql import functions as F

from ledgerline import fixtures as fx
from ledgerline.operators import merge as M
from ledgerline.operators.keys import duplicate_keys, latest_per_key

SF01 = "/root/testdata/sf0.01"
T0 = dt.datetime(2024, 12, 31)
T1 = "2025-01-01 00:00:00"


def _counts(df):
    return {r[0]: r[1] for r in df.collect()}


def test_fa_counts_match_survey(spark):
    merged = M.merge_soft_delete(fx.fa_target(spark, SF01), fx.fa_staging(spark, SF01), fx.SYNCED_AT)
    assert _counts(M.merge_counts(merged, fx.SYNCED_AT)) == {"DELETE": 1384, "INSERT": 1038, "UPDATE": 12462}


def _target(spark, rows):
    return spark.createDataFrame(rows, "id bigint, company_id bigint, a string, t_only string, "
                                       "_etl_synced timestamp_ntz, _etl_operation string")


def _staging(spark, rows):
    return spark.createDataFrame(rows, "id string, company_id bigint, a string, s_only bigint")


def test_merge_semantics_literal(spark):
    t = _target(spark, [(1, 7, "old", "keep", T0, "INSERT"), (2, 7, "gone", "k2", T0, "INSERT"),
                        (None, 7, "nullkey", None, T0, "INSERT"), (3, 8, "other tenant", None, T0, "INSERT"),
                        (4, 7, "was deleted", None, T0, "DELETE")])
    s = _staging(spark, [("1", 7, "new", 10), ("5", 7, "fresh", 11), (None, 7, "null again", 12),
                         ("4", 7, "back", 13)])
    out = M.merge_soft_delete(t, s, T1, key="id", tenant_col="company_id")
    assert out.columns == ["id", "company_id", "a", "t_only", "s_only", "_etl_synced", "_etl_operation"]
    rows = {(r["id"], r["a"]): r for r in out.collect()}
    assert rows[(1, "new")]["_etl_operation"] == "UPDATE" and rows[(1, "new")]["t_only"] == "keep"
    assert rows[(1, "new")]["s_only"] == 10
    assert rows[(5, "fresh")]["_etl_operation"] == "INSERT" and rows[(5, "fresh")]["t_only"] is None
    assert rows[(2, "gone")]["_etl_operation"] == "DELETE"
    assert rows[(2, "gone")]["_etl_synced"] == dt.datetime(2025, 1, 1)
    # null ids never match: the old one is deleted, the new one inserted
    assert rows[(None, "nullkey")]["_etl_operation"] == "DELETE"
    assert rows[(None, "null again")]["_etl_operation"] == "INSERT"
    # tenant 8 is not in this load: untouched
    assert rows[(3, "other tenant")]["_etl_operation"] == "INSERT"
    assert rows[(3, "other tenant")]["_etl_synced"] == T0
    # a returning id becomes UPDATE
    assert rows[(4, "back")]["_etl_operation"] == "UPDATE"
    assert out.count() == 7


def test_merge_no_delete_and_only_changed(spark):
    t = _target(spark, [(1, 7, "same", None, T0, "INSERT"), (2, 7, "x", None, T0, "INSERT")])
    s = _staging(spark, [("1", 7, "same", None)]).drop("s_only")
    out = M.merge_soft_delete(t, s, T1, soft_delete=False, only_changed=True)
    rows = {r["id"]: r for r in out.collect()}
    assert rows[1]["_etl_operation"] == "INSERT" and rows[1]["_etl_synced"] == T0
    assert rows[2]["_etl_operation"] == "INSERT"


def test_merge_twice_only_restamps(spark):
    t = fx.fa_target(spark, SF01)
    s = fx.fa_staging(spark, SF01)
    once = M.merge_soft_delete(t, s, fx.SYNCED_AT)
    twice = M.merge_soft_delete(once, s, "2025-01-02 00:00:00")
    data = [c for c in once.columns if not c.startswith("_etl_")]
    assert once.select(*data).exceptAll(twice.select(*data)).count() == 0
    ops = _counts(twice.groupBy("_etl_operation").count())
    assert ops == {"UPDATE": 13500, "DELETE": 1384}
    # |T union S| rows
    ids = t.select("id").union(s.select("id")).distinct().count()
    assert once.count() == ids


def test_newer_col_keeps_newest(spark):
    t = spark.createDataFrame([(1, "b", 5)], "id bigint, v string, ts bigint")
    t = M.with_audit(t, "INSERT", T1)
    s = spark.createDataFrame([(1, "a", 3)], "id bigint, v string, ts bigint")
    out = M.merge_soft_delete(t, s, "2025-02-01 00:00:00", soft_delete=False, newer_col="ts").collect()
    assert out[0]["v"] == "b" and out[0]["_etl_operation"] == "INSERT"


def test_replace_dates_keeps_null_dates(spark):
    t = spark.createDataFrame([(1, dt.date(2025, 1, 1)), (2, dt.date(2025, 1, 2)), (3, None)],
                              "k bigint, _report_date date")
    s = spark.createDataFrame([(9, dt.date(2025, 1, 2)), (10, None)], "k bigint, _report_date date")
    out = M.replace_dates(t, s, T1)
    got = sorted((r["k"], r["_etl_operation"]) for r in out.collect())
    assert got == [(1, None), (3, None), (9, "INSERT"), (10, "INSERT")]


def test_write_mode_column(spark):
    rows = [(False, True, 5, True, False, False), (True, False, 5, True, False, False),
            (True, True, 0, True, False, False), (True, True, 5, False, True, True),
            (True, True, 5, False, True, False), (True, True, 5, True, True, True),
            (None, None, None, True, False, False)]
    df = spark.createDataFrame(rows, "p boolean, m boolean, n bigint, sid boolean, sd boolean, td boolean")
    got = [r[0] for r in df.select(M.write_mode(*[F.col(c) for c in df.columns])).collect()]
    assert got == ["overwrite", "overwrite", "first_load", "replace_dates", "replace_all", "merge",
                   "overwrite"]


def test_duplicate_guard_and_latest(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k bigint, ts bigint, v string")
    assert [tuple(r) for r in duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    got = sorted(tuple(r) for r in latest_per_key(df, ["k"], ["ts"]).collect())
    assert got == [(1, 2, "b"), (2, 1, "c")]


def test_upsert_catalog_keeps_user_columns(spark):
    from ledgerline.plans.load_plan import catalog_merge
    cat = fx.catalog(spark, SF01)
    out = catalog_merge(cat, fx.discovered(spark, SF01))
    j = out.join(cat.select("company_id", "report_category", "report_id",
                            F.col("is_active").alias("was_active")),
                 ["company_id", "report_category", "report_id"])
    assert j.where(~F.col("is_active").eqNullSafe(F.col("was_active"))).count() == 0


def test_replace_dates_is_per_tenant(spark):
    d1, d2 = dt.date(2025, 1, 1), dt.date(2025, 1, 2)
    t = spark.createDataFrame([(1, 0, d1), (2, 0, d2), (3, 1, d1), (4, 1, d2)],
                              "k bigint, company_id bigint, _report_date date")
    s = spark.createDataFrame([(9, 0, d2), (10, 1, d1)], "k bigint, company_id bigint, _report_date date")
    out = M.replace_dates(t, s, T1, tenant_col="company_id")
    got = sorted((r["k"], r["_etl_operation"]) for r in out.collect())
    # tenant 0 replaces only 01-02, tenant 1 only 01-01
    assert got == [(1, None), (4, None), (9, "INSERT"), (10, "INSERT")]
