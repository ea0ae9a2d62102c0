"""Plan-shape checks: the physical plan we want at scale."""

from ledgerline import fixtures as fx
from ledgerline.operators import merge as M

SF = "/root/testdata/sf0.01"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_merge_is_one_full_outer_join_without_python(spark):
    df = M.merge_soft_delete(fx.fa_target(spark, SF), fx.fa_staging(spark, SF), fx.SYNCED_AT)
    plan = _plan(df)
    assert "FullOuter" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # both sides shuffled on the key once
    assert plan.count("Exchange hashpartitioning") <= 2


def test_scan_prunes_and_pushes(spark):
    from pyspark.sql import functions as F
    df = fx.table(spark, SF, "orders").where(F.col("o_orderkey") > 10).select("o_orderkey")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(o_orderkey), GreaterThan(o_orderkey,10)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan


def test_no_python_in_landing_plans(spark):
    from __spark_entry__ import queries
    q = queries()
    for name in ["rename_fill_stringify", "log_clean", "mixed_type_probe", "snapshot_compare",
                 "replace_dates", "monitor_upsert", "tree_walk"]:
        plan = _plan(q[name](spark, SF))
        assert "EvalPython" not in plan, name


def test_no_cross_joins_and_python_only_where_intended(spark):
    """Every registered query: no cartesian / nested-loop joins and no
    Python execution nodes at all."""
    from ledgerline.suite import QUERIES
    python_ok: set[str] = set()
    for name, fn in sorted(QUERIES.items()):
        plan = _plan(fn(spark, "/root/testdata/sf0.001"))
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name
        if name not in python_ok:
            assert "EvalPython" not in plan and "InPandas" not in plan, name


def test_normalize_reads_fields_by_name(spark):
    """Without naming collisions no column scans the entry list: fields come
    from one struct parse (cost does not grow with columns x keys)."""
    from ledgerline.operators import normalize as NZ
    from ledgerline.sources import landing as LD
    from pyspark.sql import functions as F
    df = spark.range(100).select(F.concat(F.lit('{"aB": '), F.col("id").cast("string"),
                                          F.lit(', "c": "x", "d": [1]}')).alias("value"))
    parsed = LD.parse_records(df)
    out = NZ.normalize(parsed, NZ.infer_plan(parsed))
    plan = _plan(out)
    assert "__entries" not in plan and "map_entries" not in plan
    assert out.where("a_b = 5").count() == 1
