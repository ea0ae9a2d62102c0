"""Registered queries: one per operator family of the inventory.

Each callable takes ``(spark, sf_dir)``, reads the driver tables (or data
Spark derives from them) and returns a DataFrame whose column names match
the DuckDB text in ``ledgerline.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import fixtures as fx
from ledgerline.session import scratch_dir
from ledgerline.functions import names as NM
from ledgerline.functions import values as V
from ledgerline.operators import keys as K
from ledgerline.operators import merge as M
from ledgerline.operators import monitor as MO
from ledgerline.operators import normalize as NZ
from ledgerline.operators import publish as PUB
from ledgerline.operators import quality as QA
from ledgerline.operators import schema as SC
from ledgerline.plans import load_plan as LP
from ledgerline.sources import csv as CSV
from ledgerline.sources import landing as LD
from ledgerline.sources import pages as PG
from ledgerline.sources import writers as WR
from ledgerline.streaming import landing_stream as ST

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ============================================================ write modes
@query("merge_soft_delete")
def q_merge_soft_delete(spark, sf):
    """W5 on F-A."""
    return M.merge_soft_delete(fx.fa_target(spark, sf), fx.fa_staging(spark, sf), fx.SYNCED_AT)


@query("merge_no_delete")
def q_merge_no_delete(spark, sf):
    """W6 on F-A: target-only rows stay as they were."""
    return M.merge_soft_delete(fx.fa_target(spark, sf), fx.fa_staging(spark, sf), fx.SYNCED_AT,
                               soft_delete=False)


@query("merge_counts")
def q_merge_counts(spark, sf):
    merged = M.merge_soft_delete(fx.fa_target(spark, sf), fx.fa_staging(spark, sf), fx.SYNCED_AT)
    return M.merge_counts(merged, fx.SYNCED_AT)


@query("merge_tenant_scoped")
def q_merge_tenant_scoped(spark, sf):
    """F-F: two tenants merged together; tenant 2's file is missing, so its
    rows must stay untouched (soft delete is scoped to staged tenants)."""
    return M.merge_soft_delete(fx.ff_target(spark, sf), fx.ff_staging(spark, sf), fx.SYNCED_AT,
                               tenant_col="company_id")


@query("merge_resurrect")
def q_merge_resurrect(spark, sf):
    """F-G: F-A applied, then the deleted ids come back: they become UPDATE."""
    once = M.merge_soft_delete(fx.fa_target(spark, sf), fx.fa_staging(spark, sf), fx.SYNCED_AT)
    again = fx.orders_base(spark, sf)
    return M.merge_counts(M.merge_soft_delete(once, again, fx.RUN_DATE + " 00:00:00"),
                          fx.RUN_DATE + " 00:00:00")


@query("overwrite")
def q_overwrite(spark, sf):
    """Target := staging + audit (OVERWRITE)."""
    return M.overwrite(fx.fa_staging(spark, sf), fx.SYNCED_AT)


@query("first_load")
def q_first_load(spark, sf):
    """W2 into an empty pre-created target whose price is text: id first,
    other columns by name, safe casts to the target's types."""
    target = fx.fd_staging(spark, sf).limit(0)
    return M.first_load(fx.fa_staging(spark, sf), fx.SYNCED_AT, target_schema=target.schema)


@query("replace_all")
def q_replace_all(spark, sf):
    """W4 on part: no id on either side, no date -> truncate + insert."""
    p = fx.table(spark, sf, "part")
    target = p.select("p_partkey", "p_name", "p_brand", "p_retailprice",
                      F.lit("old").alias("p_note"),
                      fx.ts(fx.T0).alias("_etl_synced"), F.lit("INSERT").alias("_etl_operation"))
    staging = p.select("p_partkey", "p_name", "p_brand",
                       F.round(F.col("p_retailprice") * 1.1, 2).alias("p_retailprice"),
                       F.col("p_size").alias("p_size"))
    return M.replace_all(target, staging, fx.SYNCED_AT)


@query("replace_dates")
def q_replace_dates(spark, sf):
    """W3 + J4 on F-B."""
    return M.replace_dates(fx.fb_target(spark, sf), fx.fb_staging(spark, sf), fx.SYNCED_AT)


@query("semi_delete")
def q_semi_delete(spark, sf):
    """Orders without any line item."""
    o = fx.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    li = fx.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return M.semi_delete(o, li, "o_orderkey")


@query("merge_dup_guard")
def q_merge_dup_guard(spark, sf):
    """(order, line) keys that occur more than once in lineitem."""
    return K.duplicate_keys(fx.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("safe_cast_align")
def q_safe_cast_align(spark, sf):
    """P6 + C3 on F-D: staging price text is safe-cast to the target's
    double, the staging-only column is added, the target-only one is null
    for new rows."""
    return M.merge_soft_delete(fx.fd_target(spark, sf), fx.fd_staging(spark, sf), fx.SYNCED_AT)


@query("surrogate_key")
def q_surrogate_key(spark, sf):
    """P9 over (customer, order date, priority with gaps)."""
    o = fx.table(spark, sf, "orders")
    o = o.withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 17 != 0, F.col("o_orderpriority")))
    return K.with_surrogate_key(o, ["o_custkey", "o_orderdate", "o_orderpriority"]).select(
        "o_orderkey", "id")


@query("coerce_types")
def q_coerce_types(spark, sf):
    """P5 over text built from events.props and fixed spellings."""
    e = fx.table(spark, sf, "events")
    k = F.col("event_id") % 9
    raw = (F.when(k == 0, F.lit("N/A")).when(k == 1, F.lit("3.0")).when(k == 2, F.lit("yes"))
           .when(k == 3, F.lit("No")).when(k == 4, F.lit("-2.7")).when(k == 5, F.lit("0"))
           .otherwise(F.get_json_object("props", "$.k")))
    r = e.select("event_id", raw.alias("raw"))
    return r.select("event_id", "raw", V.coerce_to(F.col("raw"), "INT64").alias("as_int"),
                    V.coerce_to(F.col("raw"), "FLOAT64").alias("as_float"),
                    V.coerce_to(F.col("raw"), "BOOL").alias("as_bool"))


@query("write_mode_plan")
def q_write_mode_plan(spark, sf):
    """P16 over part as the load plan joined to target facts from orders."""
    p = fx.table(spark, sf, "part")
    k = F.col("p_partkey")
    plan = p.select(
        k, F.concat(F.lit("tbl_"), k.cast("string")).alias("table_name"),
        F.when(k % 4 == 0, F.lit(False)).when(k % 7 == 0, F.lit(None)).otherwise(F.lit(True))
        .alias("use_merge"),
        F.when(k % 5 == 0, F.lit(False)).when(k % 11 == 0, F.lit(None)).otherwise(F.lit(True))
        .alias("is_production"),
        (k % 3 != 0).alias("staging_has_id"), (F.col("p_size") % 2 == 0).alias("staging_has_date"),
        (F.col("p_size") % 3 == 0).alias("target_has_date"))
    facts = (fx.table(spark, sf, "orders").groupBy("o_custkey")
             .agg(F.count(F.lit(1)).alias("target_rows")))
    j = plan.join(facts, plan["p_partkey"] == facts["o_custkey"], "left")
    return j.select("table_name", F.coalesce("target_rows", F.lit(0)).alias("target_rows"),
                    M.write_mode(F.col("is_production"), F.col("use_merge"), F.col("target_rows"),
                                 F.col("staging_has_id"), F.col("staging_has_date"),
                                 F.col("target_has_date")).alias("write_mode"))


# ============================================================ catalog / registry
_CATALOG_OUT = ["company_id", "report_category", "report_id", "report_name", "report_description",
                "report_modified_on", "parameters", "fields", "is_active", "table_name",
                "history_from", "discovered_at"]


@query("catalog_merge")
def q_catalog_merge(spark, sf):
    """Discovery columns updated, user columns kept, new reports inactive."""
    return LP.catalog_merge(fx.catalog(spark, sf), fx.discovered(spark, sf)).select(*_CATALOG_OUT)


def _flat_registry(df):
    return df.select(*[F.col("endpoint." + f).alias("ep_" + f)
                       for f in ["module", "version", "submodule", "name", "endpoint_type"]],
                     *[c for c in df.columns if c != "endpoint"])


@query("registry_upsert")
def q_registry_upsert(spark, sf):
    """W11 on table_name: every third part gets a new endpoint name and
    active flag; every tenth adds a new table."""
    reg = fx.registry(spark, sf)
    p = fx.table(spark, sf, "part").where((F.col("p_partkey") % 3 == 0) | (F.col("p_partkey") % 10 == 0))
    k = F.col("p_partkey")
    changes = p.select(
        F.struct(F.lower("p_type").alias("module"), F.lit("v3").alias("version"),
                 F.lit(None).cast("string").alias("submodule"),
                 F.concat(F.replace(F.col("p_name"), F.lit(" "), F.lit("-")), F.lit("-v3")).alias("name"),
                 F.lit("normal").alias("endpoint_type")).alias("endpoint"),
        F.when(k % 3 == 0, F.concat(F.lit("tbl_"), k.cast("string")))
        .otherwise(F.concat(F.lit("tbl_new_"), k.cast("string"))).alias("table_name"),
        (F.col("p_size") > 25).alias("active"))
    return _flat_registry(LP.registry_upsert(reg, changes))


@query("conditional_update")
def q_conditional_update(spark, sf):
    """Activate reports by name pattern; set a flag by table."""
    cat = fx.catalog(spark, sf)
    pred = F.col("report_name").like("%1%") & (F.col("is_active") == F.lit(False))
    out = LP.conditional_update(cat, pred, {
        "is_active": F.lit(True),
        "table_name": F.concat(F.lit("rep_"), F.col("report_id").cast("string")),
        "history_from": F.lit("2025-01-01").cast("date")})
    return out.select(*_CATALOG_OUT)


@query("registry_flags")
def q_registry_flags(spark, sf):
    """W12 on the registry: silver_use_bronze set for tables ending in 7."""
    reg = fx.registry(spark, sf)
    out = LP.conditional_update(reg, F.col("table_name").like("%7"),
                                {"silver_use_bronze": F.lit(True)})
    return _flat_registry(out)


@query("struct_rename")
def q_struct_rename(spark, sf):
    """Registry struct field ``submodule`` renamed ``prefix`` and back."""
    reg = fx.registry(spark, sf)
    renamed = LP.rename_struct_field(reg, "endpoint", "submodule", "prefix")
    return renamed.select("table_name", F.col("endpoint.prefix").alias("ep_prefix"),
                          F.col("endpoint.name").alias("ep_name"))


@query("load_plan")
def q_load_plan(spark, sf):
    """S9 + U1 + O2 + P15: registry endpoints UNION ALL active reports."""
    return LP.load_plan(fx.registry(spark, sf), fx.catalog(spark, sf))


@query("endpoint_subset")
def q_endpoint_subset(spark, sf):
    """P10: keep plan rows whose endpoint or table is listed (the list is
    the plan's own tables ending in 1)."""
    plan = LP.load_plan(fx.registry(spark, sf), fx.catalog(spark, sf))
    return LP.endpoint_subset(plan, fx.SUBSET_NAMES)


@query("request_path")
def q_request_path(spark, sf):
    """P11 + P12 over registry endpoints for every page's host and tenant."""
    pg = fx.table(spark, sf, "pages")
    k = F.col("page_id")
    parts = LP.api_parts(F.concat(F.lit("/"), F.regexp_extract("url", r"^https?://[^/]+/([^/]+)/", 1),
                                  F.lit("/")),
                         F.lit("v2/"),
                         F.when(k % 3 == 0, F.lit("/jobs/")).when(k % 3 == 1, F.lit("")),
                         F.regexp_extract("url", r"^https?://[^/]+/[^/]+/(.*)$", 1))
    base = F.concat(F.regexp_extract("url", r"^(https?://[^/]+)", 1), F.lit("/"))
    return pg.select("page_id", parts["api_url_base"].alias("api_url_base"),
                     parts["api_data"].alias("api_data"),
                     LP.request_url(base, parts["api_url_base"], k, parts["api_data"]).alias("request_url"),
                     LP.extraction_mode(F.when(k % 4 == 0, F.concat(F.lit("export/"), parts["api_data"]))
                                        .when(k % 4 == 1, F.concat(parts["api_data"], F.lit("/gross-pay-items")))
                                        .otherwise(parts["api_data"])).alias("mode"))


@query("active_companies")
def q_active_companies(spark, sf):
    """S7 + O1: load-side flag, inbox needs a project."""
    return LP.active_companies(fx.companies(spark, sf), "company_load_status",
                               require_project=True).select(
        "company_id", "company_name", "company_project_id")


@query("lookup_table_name")
def q_lookup_table_name(spark, sf):
    """Endpoint -> table name from a registry with gaps, else F5."""
    p = fx.table(spark, sf, "part")
    k = F.col("p_partkey")
    ep = F.concat(F.col("p_type"), F.lit("/"), F.replace(F.col("p_name"), F.lit(" "), F.lit("-")))
    endpoints = p.select("p_partkey", ep.alias("endpoint"))
    reg = p.where(k % 4 != 0).select(
        F.when(k % 2 == 0, F.upper(ep)).otherwise(ep).alias("endpoint_name"),
        F.concat(F.lit("tbl_"), k.cast("string")).alias("table_name"),
        (k % 3 != 0).alias("silver_use_bronze"))
    return LP.lookup_table_name(endpoints, reg)


# ============================================================ monitoring
def _now(spark, sf):
    return fx.events_now(spark, sf)


@query("company_weights")
def q_company_weights(spark, sf):
    """A1: duration per company over the last 7 days of history."""
    w = MO.company_weights(fx.history(spark, sf), _now(spark, sf))
    return w.select("company_id", F.round("total_duration", 2).alias("total_duration"))


@query("total_weight")
def q_total_weight(spark, sf):
    """A2: total weight with the 2,400 s default."""
    t = MO.total_weight(fx.history(spark, sf), _now(spark, sf))
    return t.select(F.round("total_weight", 2).alias("total_weight"))


@query("task_counts")
def q_task_counts(spark, sf):
    """A4: task counts from the total weight."""
    t = MO.total_weight(fx.history(spark, sf), _now(spark, sf))
    return MO.task_counts(t).select(F.round("total_weight", 2).alias("total_weight"),
                                    "pull_tasks", "load_tasks")


@query("company_weight_lookup")
def q_company_weight_lookup(spark, sf):
    """J2 + A3: every tenant's weight, else the mean, else 60 s."""
    w = MO.company_weights(fx.history(spark, sf), _now(spark, sf))
    out = MO.weighted_companies(fx.companies(spark, sf), w)
    return out.select("company_id", F.round("weight", 2).alias("weight"))


@query("monitor_upsert")
def q_monitor_upsert(spark, sf):
    """W10 (+A6 max_sync, A7 rows) on F-C."""
    out = MO.monitor_upsert(fx.fc_snapshot(spark, sf), fx.fc_run(spark, sf), _now(spark, sf))
    return out


@query("max_synced")
def q_max_synced(spark, sf):
    """A6 + A7 over the merged F-A target per order status."""
    merged = M.merge_soft_delete(fx.fa_target(spark, sf), fx.fa_staging(spark, sf), fx.SYNCED_AT)
    ms = MO.max_synced(merged, ["o_orderstatus"], fx.SYNCED_AT)
    rp = MO.rows_processed(fx.fa_staging(spark, sf), ["o_orderstatus"])
    return ms.join(rp, "o_orderstatus", "full_outer")


@query("catalog_summary")
def q_catalog_summary(spark, sf):
    """A8 after J1: reports and active reports per company and category."""
    n = fx.table(spark, sf, "nation").select(F.col("n_nationkey").cast("bigint").alias("company_id"),
                                             F.col("n_name").alias("company_name"))
    return MO.catalog_summary(fx.catalog(spark, sf), n)


@query("catalog_join")
def q_catalog_join(spark, sf):
    """Catalog x companies (nation) on company_id."""
    n = fx.table(spark, sf, "nation").select(F.col("n_nationkey").cast("bigint").alias("company_id"),
                                             F.col("n_name").alias("company_name"))
    return LP.catalog_with_companies(fx.catalog(spark, sf), n).select(
        "company_name", "report_category", "report_id", "report_name", "is_active", "table_name")


# ============================================================ names
def _names(spark, sf):
    return fx.part_names(spark, sf)


@query("snake_case")
def q_snake_case(spark, sf):
    n = _names(spark, sf)
    cols = ["n_camel", "n_pascal", "n_acronym", "n_upper"]
    return n.select("p_partkey", *cols, *[NM.snake_col(F.col(c)).alias("snake_" + c[2:]) for c in cols])


@query("camel_case")
def q_camel_case(spark, sf):
    n = _names(spark, sf)
    return n.select("p_partkey", NM.camel_col(NM.snake_col(F.col("n_pascal"))).alias("camel_a"),
                    NM.camel_col(F.col("s_long")).alias("camel_b"))


@query("naming_class")
def q_naming_class(spark, sf):
    """F3 + F4."""
    n = _names(spark, sf).withColumn("snake_pascal", NM.snake_col(F.col("n_pascal")))
    return n.select(
        "p_partkey", *[NM.naming_class_col(F.col(c)).alias(a) for c, a in [
            ("n_camel", "class_camel"), ("n_pascal", "class_pascal"), ("snake_pascal", "class_pascal_snake"),
            ("n_upper", "class_upper")]],
        NM.camel_guess_col(F.col("snake_pascal")).alias("guess_snake"),
        NM.camel_guess_col(F.col("n_camel")).alias("guess_camel"))


@query("table_name_norm")
def q_table_name_norm(spark, sf):
    """F5 over endpoint paths."""
    n = _names(spark, sf)
    return n.select("p_partkey", NM.table_name_fallback_col(F.col("e_slash")).alias("t_slash"),
                    NM.table_name_fallback_col(F.col("e_dash")).alias("t_dash"))


@query("header_clean")
def q_header_clean(spark, sf):
    """F6 over CSV headers with a BOM, padding, leading digits, non-ASCII."""
    n = _names(spark, sf)
    return n.select("p_partkey", "header", NM.clean_header_col(F.col("header")).alias("clean"))


@query("log_clean")
def q_log_clean(spark, sf):
    """F13 over whole document texts wrapped as warehouse error messages."""
    d = fx.table(spark, sf, "documents")
    return d.select("doc_id", V.clean_log_text(F.expr(fx.LOG_MSG)).alias("cleaned"))


# ============================================================ landing / normalize
@query("json_props")
def q_json_props(spark, sf):
    """S2 + F11: events.props as NDJSON records, every 100th with an
    unquoted key (quarantined)."""
    e = fx.table(spark, sf, "events")
    raw = F.when(F.col("event_id") % 100 == 0, F.replace(F.col("props"), F.lit('"k"'), F.lit("k"))) \
        .otherwise(F.col("props"))
    parsed = LD.parse_records(e.select("event_id", raw.alias("value")))
    return parsed.select("event_id", F.try_variant_get(F.try_element_at("obj", F.lit("k")), "$", "bigint")
                         .alias("k"), "is_bad")


def _event_objects(spark, sf):
    e = fx.table(spark, sf, "events")
    return LD.parse_records(e.select("event_id", F.expr(fx.OBJ_EXPR).alias("value")))


@query("mixed_type_probe")
def q_mixed_type_probe(spark, sf):
    """A11 over objects built from events (some values landed as text)."""
    pr = NZ.probe(_event_objects(spark, sf))
    return (pr.groupBy("column_name")
            .agg(F.bool_or("saw_number").alias("saw_number"), F.bool_or("saw_text").alias("saw_text"),
                 F.bool_or("saw_list").alias("saw_list"))
            .withColumn("is_mixed", F.col("saw_number") & F.col("saw_text")))


def _order_objects(spark, sf):
    o = fx.table(spark, sf, "orders")
    return LD.parse_records(o.select(F.expr(fx.ORDER_OBJ_EXPR).alias("value")))


@query("rename_fill_stringify")
def q_rename_fill_stringify(spark, sf):
    """P1-P4 (+N1-N3) over objects built from orders with camelCase keys,
    a key collision, a mixed-type price and ragged arrays."""
    parsed = _order_objects(spark, sf)
    plan = NZ.infer_plan(parsed)
    out = NZ.normalize(parsed, plan)
    return out.select("id", "cust_key", "order_status", "total_price", "order_date", "order_priority",
                      F.size("line_items").cast("bigint").alias("line_items_n"))


@query("infer_schema")
def q_infer_schema(spark, sf):
    """Decided column plan for the order objects (one aggregate over all
    rows)."""
    parsed = _order_objects(spark, sf)
    pr = NZ.probe(parsed)
    return pr.select("column_name", "source_key", "saw_number", "saw_text", "saw_list",
                     "variant_type", "n_present")


def _conv_pages(spark, sf, size: int):
    c = fx.table(spark, sf, "conversations")
    return (c.groupBy("conv_id", F.expr(f"turn div {size}").alias("page_no"))
            .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("items")))


def _nested_objects(spark, sf):
    pg = _conv_pages(spark, sf, 4)
    k = F.col("conv_id") % 5
    items = (F.when(k == 0, F.lit("null")).when(k == 1, F.to_json("items"))
             .when(k == 2, F.to_json(F.element_at("items", 1))).when(k == 3, F.lit("{}"))
             .otherwise(F.concat(F.lit("[[], "), F.to_json("items"), F.lit("]"))))
    text = F.concat(F.lit('{"id": '), F.col("conv_id").cast("string"), F.lit(', "page": '),
                    F.col("page_no").cast("string"), F.lit(', "items": '), items, F.lit("}"))
    parsed = LD.parse_records(pg.select(text.alias("value")))
    plan = NZ.infer_plan(parsed, array_fields={"items"})
    return NZ.normalize(parsed, plan)


@query("nested_fix")
def q_nested_fix(spark, sf):
    """Null / object / {} / nested arrays in a known array field."""
    out = _nested_objects(spark, sf)
    return out.select(F.col("id").alias("conv_id"), F.col("page").alias("page_no"),
                      F.size("items").cast("bigint").alias("n_items"),
                      F.size(F.filter("items", lambda x: F.schema_of_variant(x) == "STRING"))
                      .cast("bigint").alias("n_text_items"))


@query("explode_items")
def q_explode_items(spark, sf):
    """Explode repaired items, keep those whose text has line breaks."""
    out = _nested_objects(spark, sf)
    it = out.select(F.col("id").alias("conv_id"), F.explode("items").alias("it"))
    it = it.where(F.schema_of_variant("it").startswith("OBJECT"))
    txt = F.try_variant_get("it", "$.text", "string")
    return it.where(txt.rlike("[\r\n]")).select(
        "conv_id", F.try_variant_get("it", "$.turn", "bigint").alias("turn"))


# ============================================================ pages
def _landed_pages(spark, sf):
    pg = _conv_pages(spark, sf, 3)
    bare = F.col("conv_id") % 3 == 0
    env = F.to_json(F.struct(
        F.col("items").alias("data"), (F.size("items") == 3).alias("hasMore"),
        F.concat(F.lit("tok-"), F.col("conv_id").cast("string"), F.lit("-"),
                 (F.col("page_no") + 1).cast("string")).alias("continueFrom")))
    return pg.select("conv_id", "page_no", F.when(bare, F.to_json("items")).otherwise(env).alias("payload"))


@query("unwrap_pages")
def q_unwrap_pages(spark, sf):
    """Bare-list and envelope pages unwrapped to one row per item."""
    items = PG.unwrap_pages(_landed_pages(spark, sf))
    return items.select("conv_id", "page_no",
                        F.try_variant_get("item", "$.turn", "bigint").alias("turn"),
                        F.try_variant_get("item", "$.role", "string").alias("role"),
                        F.try_variant_get("item", "$.text", "string").alias("text"))


@query("export_cursor")
def q_export_cursor(spark, sf):
    """Items and last continuation token per conversation endpoint."""
    return PG.export_cursor(_landed_pages(spark, sf), ["conv_id"], seq="page_no")


@query("cursor_table")
def q_cursor_table(spark, sf):
    """The cursors of two export runs kept in the cursor table (the
    second run's pages end earlier, and its save is repeated); the table gives
    those of the newest run."""
    root = scratch_dir(spark, "cursors")
    pages = _landed_pages(spark, sf)
    first = PG.export_cursor(pages, ["conv_id"], seq="page_no")
    second = PG.export_cursor(pages.where(F.col("page_no") == 0), ["conv_id"], seq="page_no")
    for run, cursors in ((1, first), (2, second), (2, first)):
        PG.save_cursors(cursors, root, run)
    return PG.read_cursors(spark, root)


@query("snapshot_sink")
def q_snapshot_sink(spark, sf):
    """Every pulled snapshot is kept under its stamp; a pull that is
    retried replaces its own; the stable alias reads the newest."""
    o = fx.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    root = scratch_dir(spark, "snapshots")
    for stamp, keep in (("2025-01-01", F.lit(True)), ("2025-01-02", F.col("o_orderkey") % 3 != 0), ("2025-01-02", F.col("o_orderkey") % 10 != 0)):
        path = WR.land_snapshot(o.where(keep), root, "orders", stamp)
    kept = spark.read.parquet(path).groupBy(F.col("snapshot_ts").cast("string").alias("stamp")).agg(F.count(F.lit(1)).alias("n_rows"))
    newest = LD.read_latest_snapshot(spark, path).agg(F.count(F.lit(1)).alias("n_newest"), F.sum("o_orderkey").alias("sum_newest"))
    return kept.select("*", newest.select("n_newest").scalar().alias("n_newest"), newest.select("sum_newest").scalar().alias("sum_newest"))


@query("report_zip")
def q_report_zip(spark, sf):
    """Positional report rows (some short, some long) zipped with the
    field list; ``_report_date`` injected."""
    li = fx.table(spark, sf, "lineitem")
    n = F.col("l_linenumber")
    vals = F.when(n == 1, F.concat_ws(", ", F.col("l_orderkey").cast("string"), n.cast("string"))) \
        .when(n == 2, F.concat_ws(", ", F.col("l_orderkey").cast("string"), n.cast("string"),
                                  F.col("l_quantity").cast("string"),
                                  F.concat(F.lit('"'), F.col("l_returnflag"), F.lit('"')))) \
        .otherwise(F.concat_ws(", ", F.col("l_orderkey").cast("string"), n.cast("string"),
                               F.col("l_quantity").cast("string")))
    rows = li.select("l_orderkey", F.concat(F.lit("["), vals, F.lit("]")).alias("r"))
    pages = rows.groupBy("l_orderkey").agg(F.concat(
        F.lit('{"data": ['), F.array_join(F.collect_list("r"), ", "), F.lit('], "hasMore": false}'))
        .alias("payload")).select("payload")
    return PG.report_rows(pages, ["OrderKey", "Line", "Qty"],
                          {"OrderKey": "bigint", "Line": "bigint", "Qty": "double"},
                          F.lit(fx.SYNCED_AT[:10]).cast("date"))


@query("snapshot_latest")
def q_snapshot_latest(spark, sf):
    """Rows of the newest daily snapshot per endpoint (event type)."""
    e = fx.table(spark, sf, "events").select("event_id", "event_type",
                                             F.to_date("ts").alias("snapshot_date"))
    return LD.latest_snapshot(e, ["event_type"], "snapshot_date")


# ============================================================ schema drift
def _column_catalog(spark, sf):
    p = fx.table(spark, sf, "part")
    return p.select(F.expr(fx.CATALOG_TABLE_EXPR).alias("table_name"),
                    F.expr(fx.CATALOG_COL_EXPR).alias("column_name"))


@query("drift_pairs")
def q_drift_pairs(spark, sf):
    """C6 over a column catalog derived from part (50 tables)."""
    return SC.duplicate_style_pairs(_column_catalog(spark, sf))


@query("drift_summary")
def q_drift_summary(spark, sf):
    """Affected tables and their pair counts."""
    return SC.drift_summary(SC.duplicate_style_pairs(_column_catalog(spark, sf))).select(
        "table_name", "n_pairs")


@query("drift_totals")
def q_drift_totals(spark, sf):
    """Tenants and tables with both styles, over all tenants' catalogs."""
    cat = fx.table(spark, sf, "part").select((F.col("p_partkey") % 70).alias("company_id"),
                                             F.expr(fx.CATALOG_TABLE_EXPR).alias("table_name"),
                                             F.expr(fx.CATALOG_COL_EXPR).alias("column_name"))
    return SC.drift_totals(cat, SC.duplicate_style_pairs(cat, ["company_id", "table_name"]), "company_id")


@query("drop_duplicate_style")
def q_drop_duplicate_style(spark, sf):
    """Orders landed with both naming styles; keep snake_case, copy the
    camelCase value where the snake one is missing, drop camelCase."""
    o = fx.table(spark, sf, "orders")
    k = F.col("o_orderkey")
    df = o.select("o_orderkey", F.when(k % 2 == 0, F.col("o_orderstatus")).alias("order_status"),
                  F.col("o_orderstatus").alias("orderStatus"),
                  F.when(k % 3 != 0, F.col("o_totalprice")).alias("total_price"),
                  F.col("o_totalprice").alias("totalPrice"))
    pairs = SC.duplicate_style_pairs(SC.column_catalog(spark, {"orders": df})).collect()
    return SC.drop_duplicate_style(df, [(r["snake_case"], r["camel_case"]) for r in pairs])


# ============================================================ quality
@query("snapshot_compare")
def q_snapshot_compare(spark, sf):
    """Q1 + F14 + N5 over documents split in two snapshots by doc_id."""
    d = fx.table(spark, sf, "documents").select(
        F.when(F.col("doc_id") % 2 == 0, F.lit("return_1")).otherwise(F.lit("return_2")).alias("snap"),
        "text")
    return QA.snapshot_metrics(d, "snap", "text")


@query("snapshot_keys")
def q_snapshot_keys(spark, sf):
    """Q1: top-level keys of two snapshots of the order objects, of which the
    second lacks a key, has one renamed and another only now and then."""
    o = fx.table(spark, sf, "orders")
    k = F.col("o_orderkey")
    text = F.expr(fx.ORDER_OBJ_EXPR)
    second = F.regexp_replace(F.regexp_replace(text, '"custKey"', '"customerKey"'), ', "order_priority": null', "")
    second = F.when(k % 9 == 0, F.regexp_replace(second, r"\}$", ', "note": {"id": 1}}')).otherwise(second)
    both = o.select(F.explode(F.array(F.struct(F.lit("return_1").alias("snap"), text.alias("value")),
                                      F.struct(F.lit("return_2").alias("snap"), second.alias("value")))).alias("x")).select("x.*")
    return QA.snapshot_keys(LD.parse_records(both), "snap", "obj", "return_1", "return_2")


@query("open_keys")
def q_open_keys(spark, sf):
    """C1 for a feed with data as keys: each order has its number in two of
    its keys.  The plan stays small and these keys come as one map."""
    o = fx.table(spark, sf, "orders")
    k = F.col("o_orderkey")
    text = F.concat(F.lit('{"id": '), k.cast("string"), F.lit(', "order-'), k.cast("string"), F.lit('": {"total": '),
                    F.col("o_totalprice").cast("string"), F.lit('}, "'), k.cast("string"), F.lit('": "'),
                    F.col("o_orderstatus"), F.lit('"}'))
    parsed = LD.parse_records(o.select(text.alias("value")))
    out = NZ.normalize(parsed, NZ.infer_plan(parsed))
    rest = F.col(NZ.REST)
    own = F.try_element_at(rest, F.concat(F.lit("order-"), F.col("id").cast("string")))
    return out.select("id", F.size(rest).cast("bigint").alias("n_other"), F.try_variant_get(own, "$.total", "double").alias("total"))


@query("nested_known_arrays")
def q_nested_known_arrays(spark, sf):
    """A known array field below an object and below the objects of a
    list: null, absent or {} become [], an object one element, empty inner
    lists go."""
    o = fx.table(spark, sf, "orders")
    k = F.col("o_orderkey")
    tags = (F.when(k % 5 == 0, F.lit("null")).when(k % 5 == 1, F.lit('{"n": 1}')).when(k % 5 == 2, F.lit("{}"))
            .when(k % 5 == 3, F.lit('[{"n": 1}, [], [1, 2], {"n": 2}]')))
    below = F.coalesce(F.concat(F.lit('"lineTags": '), tags, F.lit(", ")), F.lit(""))
    text = F.concat(F.lit('{"id": '), k.cast("string"), F.lit(', "detail": {'), below, F.lit('"code": "'), F.col("o_orderstatus"),
                    F.lit('"}, "parts": [{"no": 1, "deep": {'), below, F.lit('"z": 1}}, {"no": 2, "deep": null}]}'))
    parsed = LD.parse_records(o.select(text.alias("value")))
    out = NZ.normalize(parsed, NZ.infer_plan(parsed, array_fields={"line_tags"}))

    def size(c):
        return F.size(c).cast("bigint")
    return out.select("id", size(F.col("detail.lineTags")).alias("n_detail"), F.col("detail.code").alias("code"),
                      size(F.get("parts", F.lit(0))["deep"]["lineTags"]).alias("n_first"),
                      F.get("parts", F.lit(1))["no"].alias("second_no"))


@query("mixed_list_repair")
def q_mixed_list_repair(spark, sf):
    """N1-N4 below a list that mixes numbers, texts, lists and objects: the
    known array fields of its objects, at every depth, are repaired."""
    o = fx.table(spark, sf, "orders")
    k = F.col("o_orderkey")
    tags = (F.when(k % 5 == 0, F.lit("null")).when(k % 5 == 1, F.lit('{"n": 1}')).when(k % 5 == 2, F.lit("{}"))
            .when(k % 5 == 3, F.lit('[{"n": 1}, [], [1, 2]]')).otherwise(F.lit("7")))
    text = F.concat(F.lit('{"id": '), k.cast("string"), F.lit(', "parts": [5, "x", [], {"no": 1, "lineTags": '), tags,
                    F.lit(', "deep": {"code": "'), F.col("o_orderstatus"), F.lit('", "lineTags": '), tags,
                    F.lit(', "plain": [[], [1, 2], 3]}}]}'))
    parsed = LD.parse_records(o.select(text.alias("value")))
    out = NZ.normalize(parsed, NZ.infer_plan(parsed, array_fields={"line_tags"}))
    last = F.element_at("parts", -1)

    def size(path):
        return F.size(F.try_variant_get(last, path, "array<variant>")).cast("bigint")
    return out.select("id", F.size("parts").cast("bigint").alias("n_parts"), size("$.lineTags").alias("n_tags"),
                      size("$.deep.lineTags").alias("n_deep"), F.try_variant_get(last, "$.deep.code", "string").alias("code"),
                      F.to_json(F.try_variant_get(last, "$.deep.plain", "variant")).alias("plain"))


@query("stringify_json")
def q_stringify_json(spark, sf):
    """P4 in json mode: a column of objects, lists, numbers and texts as the
    JSON text that the source's serialiser gives, keys in their order."""
    o = fx.table(spark, sf, "orders")
    k = F.col("o_orderkey")
    status = F.col("o_orderstatus")
    detail = (F.when(k % 5 == 0, F.concat(F.lit('{"z":1,"a":[1,{"y":null,"b":"q, r: \\"s\\""}],  "m" :5000.0}')))
              .when(k % 5 == 1, F.concat(F.lit('"'), status, F.lit(': \\"x\\", \\n"'))).when(k % 5 == 2, F.lit("12.50"))
              .when(k % 5 == 3, F.lit("null")).otherwise(F.lit("[true,{}]")))
    text = F.concat(F.lit('{"id": '), k.cast("string"), F.lit(', "Detail": "first", "detail": '), detail, F.lit("}"))
    parsed = LD.parse_records(o.select(text.alias("value")))
    plan = NZ.infer_plan(parsed, stringify={"detail"})
    return NZ.normalize(parsed, plan, stringify_mode="json").select("id", "detail")


@query("snapshot_difference")
def q_snapshot_difference(spark, sf):
    """Q1: differences and ratios of the two snapshots' metrics."""
    return QA.snapshot_difference(q_snapshot_compare(spark, sf), "return_1", "return_2")


@query("item_counts")
def q_item_counts(spark, sf):
    """Documents per language against English."""
    return QA.item_counts(fx.table(spark, sf, "documents"), "lang", "en")


@query("charset_diff")
def q_charset_diff(spark, sf):
    """Non-ASCII characters each language uses that English never does."""
    return QA.charset_diff(fx.table(spark, sf, "documents"), "lang", "text", "en")


# ============================================================ scans
def _orders_as_text(spark, sf):
    o = fx.table(spark, sf, "orders")
    return o.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


_ORDERS_DDL = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate string, o_orderpriority string")


def _scan_back(spark, path, layout, ddl):
    recs = LD.read_text_records(spark, path, layout)
    parsed = recs.select(F.from_json("value", ddl).alias("r"))
    return parsed.select("r.*")


@query("json_array_scan")
def q_json_array_scan(spark, sf):
    """Orders landed as list dumps (one array per file, indent 2), read
    back split on the record separator."""
    path = scratch_dir(spark, "landed-orders")
    WR.write_json_array(_orders_as_text(spark, sf), path, "indent2")
    out = _scan_back(spark, path, "indent2", _ORDERS_DDL)
    return out.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


@query("json_streamed_scan")
def q_json_streamed_scan(spark, sf):
    """Customers landed as streamed arrays (``,\\n{`` separators)."""
    path = scratch_dir(spark, "landed-customers")
    c = fx.table(spark, sf, "customer")
    WR.write_json_array(c, path, "streamed")
    ddl = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    return _scan_back(spark, path, "streamed", ddl)


@query("csv_scan")
def q_csv_scan(spark, sf):
    """A timesheet export with messy headers (BOM, padding, leading
    digit, non-ASCII) and quoted multi-line values, read with the
    header-derived schema."""
    path = scratch_dir(spark, "landed-csv")
    _timesheet_export(spark, sf).write.option("header", True).mode("overwrite").csv(path)
    return CSV.read_landed_csv(spark, path)


def _timesheet_export(spark, sf):
    li = fx.table(spark, sf, "lineitem")
    return li.select(
        F.col("l_suppkey").cast("int").alias("﻿Employee ID"),
        F.to_date("l_shipdate").alias("Date "),
        F.col("l_orderkey").alias("Order Key"), F.col("l_linenumber").alias("2nd Line"),
        F.col("l_quantity").alias("Año Qty"),
        F.concat(F.lit("line "), F.col("l_linenumber").cast("string"), F.lit("\nflag, "),
                 F.col("l_returnflag"), F.lit(' "q"')).alias("Notes"))


TIMESHEET_KEYS = ["employee_id", "date", "order_key", "c_2nd_line"]


@query("csv_report_load")
def q_csv_report_load(spark, sf):
    """The CSV report job end to end: landed export -> header schema
    -> MD5 surrogate key (P9) -> newest copy per key (W9) -> merge without
    soft delete (W6) into the previous load; rows stamped per operation."""
    path = scratch_dir(spark, "landed-timesheet")
    _timesheet_export(spark, sf).write.option("header", True).mode("overwrite").csv(path)
    staging = K.with_surrogate_key(CSV.read_landed_csv(spark, path), TIMESHEET_KEYS)
    M.require_key(staging)
    li = fx.table(spark, sf, "lineitem").where(F.col("l_orderkey") % 13 != 0)
    prev = li.select(F.col("l_suppkey").cast("int").alias("employee_id"),
                     F.to_date("l_shipdate").alias("date"),
                     F.col("l_orderkey").cast("string").alias("order_key"),
                     F.col("l_linenumber").cast("string").alias("c_2nd_line"),
                     F.col("l_quantity").cast("string").alias("a_o_qty"))
    prev = K.latest_per_key(K.with_surrogate_key(prev, TIMESHEET_KEYS), ["id"], ["a_o_qty"])
    target = M.with_audit(prev, M.OP_INSERT, fx.T0)
    merged = M.merge_soft_delete(target, staging, fx.SYNCED_AT, soft_delete=False,
                                 dedupe_order=["a_o_qty", "notes"])
    return M.merge_counts(merged, fx.SYNCED_AT)


@query("file_report")
def q_file_report(spark, sf):
    """S3: per landed NDJSON file (one for each kind of event, blank lines in
    between): records, bad records, layout, status, first bad line."""
    path = scratch_dir(spark, "landed-events")
    e = fx.table(spark, sf, "events")
    raw = F.when(F.col("event_id") % 100 == 0, F.replace(F.col("props"), F.lit('"k"'), F.lit("k"))) \
        .otherwise(F.col("props"))
    blank = F.when(F.col("event_id") % 30 == 0, "\n").otherwise("")
    kind = F.coalesce("event_type", F.lit("none")).alias("kind")
    lines = e.select(kind, "event_id", F.concat(blank, raw).alias("value")).repartition("kind").sortWithinPartitions("kind", "event_id")
    lines.select("kind", "value").write.mode("overwrite").partitionBy("kind").text(path)
    rep = LD.file_report(spark, path, "ndjson")
    return rep.select(F.regexp_extract("file_path", r"kind=([^/]+)", 1).alias("kind"), "n_records",
                      "n_bad", "layout_seen", "status", "first_bad_line")


@query("append_load")
def q_append_load(spark, sf):
    """Two drops of orders staged one after the other into one staging
    table, the second added to the first; malformed records stay aside."""
    o = fx.table(spark, sf, "orders")
    k = F.col("o_orderkey")
    path = scratch_dir(spark, "append") + "/staging"
    for drop in (0, 1):
        rec = F.to_json(F.struct(k.alias("id"), F.col("o_custkey").alias("custKey"), F.lit(drop).alias("drop")))
        text = F.when(k % 100 == drop, F.concat(rec, F.lit("]"))).otherwise(rec)
        parsed = LD.parse_records(o.where(k % 2 == drop).select(text.alias("value")))
        NZ.stage_landed(parsed, NZ.infer_plan(parsed), path, append=drop > 0)
    good, bad = LD.read_staging(spark, path)
    return good.groupBy("drop").agg(F.count("id").alias("n_rows"), F.sum("cust_key").alias("sum_cust")).join(
        bad.select(F.regexp_extract("preview", '"drop":([0-9]+)', 1).cast("bigint").alias("drop")).groupBy("drop").agg(
            F.count(F.lit(1)).alias("n_bad")), "drop", "left")


@query("ensure_table")
def q_ensure_table(spark, sf):
    """S17 + W2 + P6: the final table is created with the first staging's
    types, only once, and the first load is cast to them (a quantity that is
    no number becomes null)."""
    li = fx.table(spark, sf, "lineitem")
    root = scratch_dir(spark, "ensure")
    key = F.concat_ws("-", F.col("l_orderkey"), F.col("l_linenumber"))
    first = li.select(key.alias("id"), F.col("l_quantity").cast("double").alias("qty"), F.col("l_returnflag").alias("mode"))
    made = PUB.ensure_table(spark, root, "lines", first.schema)
    again = PUB.ensure_table(spark, root, "lines", li.schema)
    text = F.when(F.col("l_linenumber") == 7, F.lit("n/a")).otherwise(F.col("l_quantity").cast("double").cast("string"))
    staging = li.select(key.alias("id"), text.alias("qty"), F.col("l_returnflag").alias("mode"))
    PUB.publish(M.first_load(staging, fx.SYNCED_AT, PUB.read_published(spark, root, "lines").schema), root, "lines", token="load")
    out = PUB.read_published(spark, root, "lines")
    return out.groupBy("mode", F.col("_etl_operation").alias("operation")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("qty").alias("qty"), F.lit(made and not again).alias("created_once"))


@query("absent_known_arrays")
def q_absent_known_arrays(spark, sf):
    """Known array fields that no record has become empty lists, those
    that some have stay."""
    o = fx.table(spark, sf, "orders")
    k = F.col("o_orderkey")
    text = F.concat(F.lit('{"id": '), k.cast("string"), F.when(k % 3 == 0, F.lit(', "tagList": [1, "x"]')).otherwise(F.lit("")), F.lit("}"))
    parsed = LD.parse_records(o.select(text.alias("value")))
    out = NZ.normalize(parsed, NZ.infer_plan(parsed, array_fields={"tag_list", "notes"}))
    return out.select("id", F.size("tag_list").cast("bigint").alias("n_tags"), F.size("notes").cast("bigint").alias("n_notes"))


@query("csv_listed_load")
def q_csv_listed_load(spark, sf):
    """S6 + S5: report exports landed under any of their three names; each
    report's file is resolved from the listing of the folder and read by its
    own header."""
    base = scratch_dir(spark, "listed-csv")
    li = fx.table(spark, sf, "lineitem")
    tables = ["ship_report", "rail_report", "air_report"]
    # The stems that the exports have: with prefix, plain, in title case.
    stems = dict(zip(tables, ("export_ship_report", "rail_report", "Air Report")))
    modes = dict(zip(tables, ("N", "R", "A")))
    for t in tables:
        own = li.where(F.col("l_returnflag") == modes[t]).select(F.col("l_orderkey").alias("Order Key"), F.col("l_quantity").alias(f"{t} Qty"))
        own.write.option("header", True).csv(f"{base}/{stems[t]}.csv")
    # Spark writes a folder of files under each name.
    listing = LD.list_landed(spark, base).select(F.regexp_extract(F.try_url_decode("path"), r"([^/]+\.csv)/[^/]+$", 1).alias("file_name"))
    names = spark.createDataFrame([(t,) for t in tables], "table_name string")
    out = None
    for r in sorted(LD.resolve_landed_files(listing, names).collect()):   # one row a report
        df = CSV.read_landed_csv(spark, f"{base}/{r['file_name']}", multi_line=False)
        df = df.select(F.lit(r["table_name"]).alias("table_name"), F.lit(r["priority"]).alias("priority"),
                       F.col("order_key").cast("bigint").alias("order_key"), F.col(f"{r['table_name']}_qty").cast("double").alias("qty"))
        out = df if out is None else out.unionByName(df)
    return out.groupBy("table_name", "priority").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("qty").alias("qty"), F.min("order_key").alias("least_key"))


@query("landed_file_resolution")
def q_landed_file_resolution(spark, sf):
    """First existing landed file per table among the three name variants."""
    reg = fx.registry(spark, sf).select("table_name")
    k = F.regexp_extract("table_name", r"(\d+)$", 1).cast("bigint")
    t = F.col("table_name")
    title = NM.title_file_name_col(t)
    listing = reg.select(F.explode(F.array(
        F.when(k % 4 == 0, F.concat(F.lit("export_"), t, F.lit(".csv"))),
        F.when((k % 4 == 1) | (k % 8 == 0), F.concat(t, F.lit(".csv"))),
        F.when(k % 4 == 2, F.concat(title, F.lit(".csv"))))).alias("file_name")).where(
        F.col("file_name").isNotNull())
    return LD.resolve_landed_files(listing, reg)


# ============================================================ reports
@query("report_windows")
def q_report_windows(spark, sf):
    """Incremental window for reports whose table exists, backfill from
    history_from (default 2025-01-01) otherwise."""
    cat = fx.catalog(spark, sf)
    s = fx.table(spark, sf, "supplier")
    existing = s.where(F.col("s_suppkey") % 2 == 0).select(
        F.concat(F.lit("rep_"), F.col("s_suppkey").cast("string")).alias("table_name"))
    reports = cat.select("company_id", "report_id", F.concat(F.lit("rep_"), F.col("report_id").cast("string"))
                         .alias("table_name"), "history_from")
    return LP.report_windows(reports, existing, fx.RUN_DATE)


@query("param_binding")
def q_param_binding(spark, sf):
    """Date parameters bound to the report window by name."""
    s = fx.table(spark, sf, "supplier")
    reports = s.select(F.col("s_suppkey").alias("report_id"), F.expr(fx.REPORT_PARAMS_EXPR).alias("params"),
                       F.lit("2025-01-01").cast("date").alias("from_date"),
                       F.date_sub(F.lit(fx.RUN_DATE).cast("date"), 1).alias("to_date"))
    out = LP.bind_date_params(reports, "params", "from_date", "to_date")
    return out.select("report_id", F.col("param_pos").cast("bigint").alias("param_pos"),
                      "param_name", "param_value")


def _tree_payloads(spark, sf):
    n = fx.table(spark, sf, "nation")
    s = fx.table(spark, sf, "supplier")
    cat_id = F.when(F.col("n_nationkey") % 2 == 0, F.lower("n_name")).otherwise(F.col("n_name"))
    node = F.when(F.col("n_nationkey") % 2 == 0,
                  F.to_json(F.struct(cat_id.alias("id"), F.col("n_name").alias("name")))) \
        .otherwise(F.to_json(F.array(F.col("n_name"))).substr(F.lit(2), F.length(F.col("n_name")) + 2))
    cats = (n.groupBy(F.col("n_regionkey").cast("bigint").alias("company_id"))
            .agg(F.concat(F.lit("["), F.array_join(F.sort_array(F.collect_list(node)), ", "), F.lit("]"))
                 .alias("payload")))
    sn = s.join(n.select("n_nationkey", "n_regionkey", "n_name"), s["s_nationkey"] == n["n_nationkey"])
    sn = sn.withColumn("category", cat_id).withColumn("company_id", F.col("n_regionkey").cast("bigint"))
    rid = F.when(F.col("s_suppkey") % 17 != 0, F.col("s_suppkey"))
    reports = (sn.groupBy("company_id", "category", F.expr("s_suppkey div 50"))
               .agg(F.to_json(F.struct(F.collect_list(F.struct(rid.alias("id"), F.col("s_name").alias("name")))
                                       .alias("data"))).alias("payload"))
               .select("company_id", "category", "payload"))
    det = sn.where(F.col("s_suppkey") % 19 != 0).select(
        "company_id", "category", F.col("s_suppkey").alias("report_id"),
        F.to_json(F.struct(
            F.array(F.struct(F.lit("From").alias("name"), F.lit("Date").alias("dataType")),
                    F.struct(F.lit("To").alias("name"), F.lit("Date").alias("dataType"))).alias("parameters"),
            F.array(F.struct(F.lit("Id").alias("name"), F.lit("Number").alias("dataType"))).alias("fields"),
            F.concat(F.lit("2025-01-"), F.lpad((F.col("s_suppkey") % 28 + 1).cast("string"), 2, "0"))
            .alias("modifiedOn"),
            F.concat(F.lit("nation "), F.col("n_name")).alias("description"))).alias("payload"))
    return cats, reports, det


def _tree_out(df):
    return df.select("company_id", "report_category", "report_id", "report_name", "report_description",
                     "report_modified_on",
                     F.json_array_length("parameters").cast("bigint").alias("n_params"),
                     F.json_array_length("fields").cast("bigint").alias("n_fields"))


@query("tree_walk")
def q_tree_walk(spark, sf):
    """Categories -> report pages -> details, bad nodes skipped."""
    return _tree_out(LP.tree_walk(*_tree_payloads(spark, sf)))


@query("tree_walk_filtered")
def q_tree_walk_filtered(spark, sf):
    """J6 + P19: one category by id or name, ignoring case."""
    return _tree_out(LP.tree_walk(*_tree_payloads(spark, sf), category_filter="nation_3"))


# ============================================================ logs
@query("run_summary")
def q_run_summary(spark, sf):
    """A10: units per run day, ok and failed (type error = failed)."""
    e = fx.table(spark, sf, "events").select(F.to_date("ts").alias("run_id"), "event_type")
    return MO.run_summary(e)


@query("log_events")
def q_log_events(spark, sf):
    """Event-log rows built from events (id as text, info as JSON)."""
    e = fx.table(spark, sf, "events")
    return MO.log_events(
        e, timestamp=F.col("ts"), company_id=F.col("user_id"), event_type=F.upper("event_type"),
        event_title=F.concat(F.lit("Load "), F.col("event_type")), source="ledgerline_load",
        endpoint=F.col("event_type"),
        event_message=F.concat(F.lit("value "), F.format_number("value", 2)),
        info=F.struct(F.col("user_id").alias("user"), F.col("event_type").alias("type")))


# ============================================================ streaming
DROP_ROWS = 4_000_000   # events in a landed file
_EVENTS_DDL = "event_id bigint, ts string, user_id bigint, event_type string, value double"


@query("stream_merge")
def q_stream_merge(spark, sf):
    """All events landed as NDJSON in four drops, broken lines among
    them, merged incrementally (two files per micro-batch; newest per (user,
    type), W6, then the monitoring snapshot) into a published target."""
    root = _streamed_events(spark, sf)
    out = PUB.read_published(spark, root, "events_latest")
    return out.select("user_id", "event_type", "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"),
                      "value")


@query("stream_quarantine")
def q_stream_quarantine(spark, sf):
    """T1 + S2/S4: the broken lines that the stream's batches put aside."""
    bad = ST.quarantined(spark, _streamed_events(spark, sf), "events_latest")
    return bad.select(F.regexp_extract("preview", '"event_id":([0-9]+)', 1).cast("bigint").alias("event_id"),
                      F.regexp_extract("preview", "([a-z]+)$", 1).alias("tail"))


def _streamed_events(spark, sf):
    """Run the stream over all events, with a broken line after every 50th:
    the event with a later stamp, cut off or followed by more text."""
    from pyspark.sql import types as T
    base = scratch_dir(spark, "stream")
    landing, root, ckpt = f"{base}/landing", f"{base}/tables", f"{base}/checkpoint"
    e = fx.table(spark, sf, "events").select("event_id", F.col("ts").cast("string").alias("ts"),
                                             "user_id", "event_type", "value")
    line = F.to_json(F.struct(*e.columns))
    late = F.to_json(F.struct(*[F.lit("2999-01-01 00:00:00").alias(c) if c == "ts" else F.col(c) for c in e.columns]))
    broken = F.when(F.col("event_id") % 100 == 0, F.concat(late, F.lit(" trailing"))).when(
        F.col("event_id") % 50 == 0, F.regexp_replace(late, r"\}$", ",cut"))
    for drop in range(4):
        own = e.where(F.coalesce(F.pmod("event_id", F.lit(4)), F.lit(0)) == drop)
        # A drop is a file of up to DROP_ROWS events, not one a scan task: the
        # files make the batches, and each batch merges.
        files = -(-max(1, own.count()) // DROP_ROWS)
        own.select(F.explode(F.filter(F.array(line, broken), lambda x: x.isNotNull())).alias("value")) \
            .repartition(files).write.mode("append").text(landing)
    schema = T._parse_datatype_string(_EVENTS_DDL)
    ST.run_landing_merge(spark, landing, schema, root, "events_latest", ["user_id", "event_type"], "ts",
                         fx.SYNCED_AT, ckpt, max_files_per_trigger=2)
    return root


# ============================================================ more sources / schema
@query("bad_row_preview")
def q_bad_row_preview(spark, sf):
    """Quarantined NDJSON records with their 200-character preview
    (unquoted keys, and text trailing a complete object)."""
    e = fx.table(spark, sf, "events")
    raw = F.when(F.col("event_id") % 100 == 0, F.replace(F.col("props"), F.lit('"k"'), F.lit("k"))) \
        .otherwise(F.col("props"))
    tail = F.when(F.col("event_id") % 37 == 0, F.concat(F.lit(" "), F.col("event_type"))).otherwise(F.lit(""))
    parsed = LD.parse_records(e.select("event_id", F.concat(raw, tail).alias("value")))
    _, bad = LD.split_quarantine(parsed)
    return bad


@query("registry_scan")
def q_registry_scan(spark, sf):
    """S8 + P11 + P12 + P15: active registry endpoints with their request
    path template and extraction mode."""
    ep = LP.registry_endpoints(fx.registry(spark, sf))
    parts = LP.api_parts(F.col("module"), F.col("version"), F.col("submodule"), F.col("name"))
    return ep.select("table_name", "module", "version", "submodule", "name", "endpoint_type",
                     parts["api_url_base"].alias("api_url_base"), parts["api_data"].alias("api_data"),
                     LP.request_url(F.lit("https://api.example.com/"), parts["api_url_base"],
                                    F.lit("{tenant}"), parts["api_data"]).alias("url_template"),
                     LP.extraction_mode(parts["api_data"]).alias("mode"))


@query("report_catalog_scan")
def q_report_catalog_scan(spark, sf):
    """Active catalog reports of all companies at once."""
    return LP.report_catalog_scan(fx.catalog(spark, sf)).select(
        "company_id", "report_category", "report_id", "report_name", "table_name", "history_from")


@query("publish_roundtrip")
def q_publish_roundtrip(spark, sf):
    """S15/S17 + H1: the tenant-scoped merge published as a new version
    (partitioned by tenant), published again with the same version id (a
    no-op retry) and read back through the pointer table."""
    merged = M.merge_soft_delete(fx.ff_target(spark, sf), fx.ff_staging(spark, sf), fx.SYNCED_AT,
                                 tenant_col="company_id")
    root = scratch_dir(spark, "published")
    PUB.publish(merged, root, "orders_bronze", 1, partition_by=["company_id"])
    PUB.publish(merged, root, "orders_bronze", 1, partition_by=["company_id"])
    return PUB.read_published(spark, root, "orders_bronze", like=merged.schema)


@query("publish_touched_tenants")
def q_publish_touched_tenants(spark, sf):
    """H1: per-tenant copy-on-write.  Version 1 holds every tenant; the
    next load (tenant 2's file missing) reads and merges only the staged
    tenants' target rows and writes only their partitions as version 2;
    the live table is each tenant's newest version."""
    root = scratch_dir(spark, "published-tenants")
    first = fx.ff_target(spark, sf)
    PUB.publish_tenants(first, root, "orders_bronze", 1, "company_id")
    staging = fx.ff_staging(spark, sf)
    # the load plan's tenant list (tenant-sized)
    tenants = [r[0] for r in staging.select("company_id").distinct().collect()]
    target = PUB.read_tenants(spark, root, "orders_bronze", "company_id", tenants, like=first.schema)
    merged = M.merge_soft_delete(target, staging, fx.SYNCED_AT, tenant_col="company_id", tenants=tenants)
    PUB.publish_tenants(merged, root, "orders_bronze", 2, "company_id")
    return PUB.read_tenants(spark, root, "orders_bronze", "company_id", like=merged.schema)


@query("field_to_text")
def q_field_to_text(spark, sf):
    """Every field called ``status`` becomes text, at any depth (a
    struct becomes its JSON text, array elements are rewritten in place)."""
    o = fx.table(spark, sf, "orders")
    df = o.select(
        F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 5).alias("status"),
        F.struct(F.col("o_orderstatus").alias("status"),
                 F.struct(F.struct(F.col("o_orderpriority").alias("code")).alias("status")).alias("detail"),
                 F.array(F.struct(F.col("o_custkey").alias("status")),
                         F.struct((F.col("o_orderkey") % 7).alias("status"))).alias("items")).alias("info"))
    out = SC.cast_field_to_text(df, "status")
    return out.select("id", "status", F.col("info.status").alias("info_status"),
                      F.col("info.detail.status").alias("detail_status"),
                      F.array_join(F.transform("info.items", lambda x: x["status"]), ",").alias("items_status"))


@query("merge_add_key")
def q_merge_add_key(spark, sf):
    """C4 + C5: the target has neither ``id`` nor audit columns: both are
    added; old rows (null id) never match and are soft-deleted, staging
    rows are inserted."""
    target = fx.orders_base(spark, sf).where(F.col("id") % 13 != 0).drop("id")
    return M.merge_soft_delete(target, fx.fa_staging(spark, sf), fx.SYNCED_AT)


# ============================================================ end-to-end load cycle
N_TENANTS = 30


@query("tenant_load_cycle")
def q_tenant_load_cycle(spark, sf):
    """The load job for 30 tenants at once: landed camelCase JSON ->
    strict parse + quarantine -> full-scan probe -> normalise (P1-P4) ->
    tenant-scoped merge with soft delete (W5) -> per-tenant operation counts
    (the monitoring rows' numbers)."""
    o = fx.table(spark, sf, "orders")
    k = F.col("o_orderkey")
    landed = o.where(k % 10 != 0).select(F.to_json(F.struct(
        k.alias("id"), (F.col("o_custkey") % N_TENANTS).alias("companyId"),
        F.col("o_custkey").alias("custKey"), F.col("o_orderstatus").alias("orderStatus"),
        F.when(k % 7 == 1, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("totalPrice"),
        F.col("o_orderdate").cast("date").cast("string").alias("orderDate"))).alias("value"))
    parsed = LD.parse_records(landed)
    path = scratch_dir(spark, "staging-orders")
    NZ.stage_landed(parsed, NZ.infer_plan(parsed), path)
    staging, _ = LD.read_staging(spark, path)
    K.assert_unique_keys(staging, ["company_id", "id"])   # W9: refuse what MERGE would refuse
    target = o.where(k % 13 != 0).select(
        k.alias("id"), (F.col("o_custkey") % N_TENANTS).alias("company_id"),
        F.col("o_custkey").alias("cust_key"), F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").alias("total_price"),
        F.col("o_orderdate").cast("date").cast("string").alias("order_date"),
        fx.ts(fx.T0).alias("_etl_synced"), F.lit("INSERT").alias("_etl_operation"))
    merged = M.merge_soft_delete(target, staging, fx.SYNCED_AT, tenant_col="company_id")
    return (merged.where(F.col("_etl_synced") == fx.ts(fx.SYNCED_AT))
            .groupBy("company_id", "_etl_operation").agg(F.count(F.lit(1)).alias("n_rows")))


def _two_loads(spark, sf, added=None, twice=None, replay=False):
    """Run the endpoint load twice (first load, then merge); returns the
    second summary and the table root.  The second day's records may have an
    ``added`` field, and those of ``twice`` come two times; with ``replay``
    the second load is run again."""
    from ledgerline.plans.load_job import run_endpoint_load
    o = fx.table(spark, sf, "orders")
    k = F.col("o_orderkey")
    base = scratch_dir(spark, "endpoint-load")

    def land(df, path, *more):
        rec = F.to_json(F.struct(
            k.alias("id"), F.col("o_custkey").alias("custKey"), F.col("o_orderstatus").alias("orderStatus"),
            F.col("price").alias("totalPrice"), F.col("o_orderdate").cast("date").cast("string")
            .alias("orderDate"), *more))
        bad = k % 1000 == 7
        text = F.when(bad, F.concat(rec, F.lit(" trailing"))).otherwise(rec)
        (df.select((F.col("o_custkey") % N_TENANTS).alias("company_id"), text.alias("value"))
         .write.mode("overwrite").partitionBy("company_id").text(path))

    def load(version, stamp):
        return run_endpoint_load(spark, landed=f"{base}/landed-{version}", layout="ndjson", root=f"{base}/tables",
                                 table="orders_bronze", version=version, synced_at=stamp)

    day1 = o.where(k % 13 != 0).withColumn("price", F.col("o_totalprice"))
    day2 = o.where(k % 10 != 0).withColumn(
        "price", F.when(k % 7 == 1, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    if twice is not None:
        day2 = day2.unionByName(day2.where(twice))
    land(day1, f"{base}/landed-1")
    load(1, fx.T0)
    land(day2, f"{base}/landed-2", *([] if added is None else [added]))
    summary = load(2, fx.SYNCED_AT)
    if replay:
        summary = load(2, fx.SYNCED_AT)
    return summary, f"{base}/tables"


@query("endpoint_load_job")
def q_endpoint_load_job(spark, sf):
    """The load job for one endpoint and 30 tenants, run twice: landed
    NDJSON per tenant folder -> first load (version 1), then the next day's
    files (every 10th order gone, some prices changed, a few malformed
    records) -> merge with soft delete (version 2).  Returns the second
    run's per-tenant summary."""
    return _two_loads(spark, sf)[0]


@query("load_monitoring")
def q_load_monitoring(spark, sf):
    """A6 + A7 + W10 inside the load job: after the two runs, each tenant's
    monitoring row holds the second run (rows, newest stamp) and the first
    run's rows as ``last_rows`` (durations are wall-clock, left out)."""
    from ledgerline.plans.load_job import read_monitoring
    _, root = _two_loads(spark, sf)
    mon = read_monitoring(spark, root)
    return mon.select("company_id", "endpoint_name", "max_sync", "actual_rows", "actual_status",
                      "last_rows", "last_status")


@query("load_duplicate_ids")
def q_load_duplicate_ids(spark, sf):
    """W9 + S18 inside the load job: one tenant's second file holds records
    twice.  The tenant is refused and keeps its rows; the others load.  Per
    tenant: the event of the second load and the live rows by operation."""
    from ledgerline.plans.load_job import read_events
    tenant = F.col("o_custkey") % N_TENANTS
    _, root = _two_loads(spark, sf, twice=(tenant == 4) & (F.col("o_orderkey") % 3 == 0))
    events = read_events(spark, root).where("load = 2").select(
        F.coalesce(F.col("company_id").cast("bigint"), F.lit(0)).alias("company_id"),   # the log has no id 0
        "endpoint", "event_type", "event_message", "source")
    live = PUB.read_tenants(spark, root, "orders_bronze", "company_id")
    n = live.groupBy(F.col("company_id").cast("bigint").alias("company_id")).agg(
        *[F.count_if(F.col("_etl_operation") == op).alias(f"live_{op.lower()}")
          for op in ("INSERT", "UPDATE", "DELETE")])
    return n.join(events, "company_id", "left")


@query("load_new_column")
def q_load_new_column(spark, sf):
    """C3 + H1 inside the load job: the second day's records of some tenants
    have a new field, and the second load is run twice.  Each tenant's live
    rows, and how many carry the field."""
    new = F.when((F.col("o_custkey") % N_TENANTS) % 3 == 1, F.col("o_orderpriority")).alias("orderPriority")
    _, root = _two_loads(spark, sf, added=new, replay=True)
    live = PUB.read_tenants(spark, root, "orders_bronze", "company_id")
    return live.groupBy(F.col("company_id").cast("bigint").alias("company_id")).agg(
        F.count(F.lit(1)).alias("n_live"), F.count("order_priority").alias("n_priority"),
        F.min("order_priority").alias("least_priority"))


def _ops_by_tenant(spark, root, *more):
    live = PUB.read_tenants(spark, root, "orders_bronze", "company_id")
    return live.groupBy(F.col("company_id").cast("bigint").alias("company_id")).agg(
        *[F.count_if(F.col("_etl_operation") == op).alias(f"live_{op.lower()}") for op in ("INSERT", "UPDATE", "DELETE")], *more)


def _land_and_load(spark, base, version, stamp, rows, layout="auto"):
    """Land (company_id, value) lines in tenant folders and load them."""
    from ledgerline.plans.load_job import run_endpoint_load
    path = f"{base}/landed-{version}"
    rows.write.mode("overwrite").partitionBy("company_id").text(path)
    return run_endpoint_load(spark, landed=path, layout=layout, root=f"{base}/tables", table="orders_bronze", version=version,
                             synced_at=stamp)


@query("load_bad_records")
def q_load_bad_records(spark, sf):
    """W5 + S4 inside the load job: records malformed on the second day only.
    A row whose malformed record still shows its key stays as it is; a tenant
    with a record cut off within its key gets no deletes.  Per tenant: live
    rows by operation, rows untouched since the first day, the second event."""
    from ledgerline.plans.load_job import read_events
    o = fx.table(spark, sf, "orders")
    k, tenant = F.col("o_orderkey"), (F.col("o_custkey") % N_TENANTS)
    rec = F.to_json(F.struct(F.struct(F.col("o_orderstatus").alias("id"), F.lit("a } b").alias("note")).alias("status"),
                             k.alias("id"), F.col("o_totalprice").alias("total")))
    base = scratch_dir(spark, "bad-records")
    _land_and_load(spark, base, 1, fx.T0, o.where(k % 13 != 0).select(tenant.alias("company_id"), rec.alias("value")))
    bad = (F.when(k % 50 == 7, F.concat(rec, F.lit(" trailing")))
           .when((k % 50 == 9) & (tenant % 5 == 2), F.regexp_extract(rec, '^.*"id":[0-9]', 0)).otherwise(rec))
    _land_and_load(spark, base, 2, fx.SYNCED_AT, o.where(k % 10 != 0).select(tenant.alias("company_id"), bad.alias("value")))
    events = read_events(spark, f"{base}/tables").where("load = 2").select(
        F.coalesce(F.col("company_id").cast("bigint"), F.lit(0)).alias("company_id"), "event_message")
    same = F.count_if(F.col("_etl_synced") == F.lit(fx.T0).cast("timestamp_ntz")).alias("untouched")
    return _ops_by_tenant(spark, f"{base}/tables", same).join(events, "company_id", "left")


@query("load_type_change")
def q_load_type_change(spark, sf):
    """C2 + C3 inside the load job: tenants disagree on a column's type.
    Even tenants load numbers, odd ones text; a third load of some tenants
    brings texts for numbers, too, which are no numbers (P6).  All tenants are
    read together, each version as it was written."""
    o = fx.table(spark, sf, "orders")
    k, tenant = F.col("o_orderkey"), (F.col("o_custkey") % N_TENANTS)
    number, text = F.col("o_custkey"), F.col("o_custkey").cast("string")

    def rows(zip_code, keep):
        rec = F.to_json(F.struct(k.alias("id"), zip_code))
        return o.where(keep).select(tenant.alias("company_id"), rec.alias("value"))

    base = scratch_dir(spark, "type-change")
    _land_and_load(spark, base, 1, fx.T0, rows(number.alias("zip"), (k % 13 != 0) & (tenant % 2 == 0)))
    _land_and_load(spark, base, 2, fx.T0, rows(F.concat(F.lit("A"), text).alias("zip"), (k % 13 != 0) & (tenant % 2 == 1)))
    third = (k % 10 != 0) & (tenant % 3 == 0)
    odd = F.when(tenant % 2 == 1, F.concat(F.lit("C"), text)).when(k % 7 == 1, F.concat(F.lit("B"), text))
    mixed = rows(F.coalesce(odd, (number + 1).cast("string")).alias("zip"), third)
    plain = rows((number + 1).alias("zip"), third & (tenant % 2 == 0) & (k % 7 != 1))
    _land_and_load(spark, base, 3, fx.SYNCED_AT, mixed.where(~F.col("value").rlike('"zip":"[0-9]')).unionByName(plain))
    z = F.col("zip")
    return _ops_by_tenant(spark, f"{base}/tables", F.count(z).alias("n_zip"), F.min(z).alias("least_zip"), F.max(z).alias("most_zip"))


@query("load_mixed_layouts")
def q_load_mixed_layouts(spark, sf):
    """S1-S3 inside the load job: tenants land in different layouts (NDJSON,
    list dump, streamed array, compact array) side by side, and change them
    from one day to the next.  Returns the second run's summary."""
    from ledgerline.plans.load_job import run_endpoint_load
    o = fx.table(spark, sf, "orders")
    k, tenant = F.col("o_orderkey"), (F.col("o_custkey") % N_TENANTS)
    base = scratch_dir(spark, "mixed-layouts")
    for version, keep, stamp in ((1, k % 13 != 0, fx.T0), (2, k % 10 != 0, fx.SYNCED_AT)):
        rows = o.where(keep).select(tenant.alias("company_id"), k.alias("id"), F.col("o_totalprice").alias("totalPrice"),
                                    F.struct(F.col("o_orderstatus").alias("code")).alias("status"))
        path = f"{base}/landed-{version}"
        rows.where((tenant + version) % 4 == 0).select("company_id", F.to_json(F.struct("id", "totalPrice", "status")).alias("value")) \
            .write.partitionBy("company_id").text(path)
        for i, layout in enumerate(("indent2", "streamed", "compact"), 1):
            WR.write_json_array(rows.where((F.col("company_id") + version) % 4 == i), path, layout, by=["company_id"])
        out = run_endpoint_load(spark, landed=path, root=f"{base}/tables", table="orders_bronze", version=version, synced_at=stamp)
    return out


@query("merge_only_changed")
def q_merge_only_changed(spark, sf):
    """W5 with ``only_changed=True`` (finding 1): matches whose values are
    equal (null-safe) keep the target row and stamp; only the re-priced
    orders become UPDATE."""
    return M.merge_soft_delete(fx.fa_target(spark, sf), fx.fa_staging(spark, sf), fx.SYNCED_AT,
                               only_changed=True)


@query("schema_drift_catalog")
def q_schema_drift_catalog(spark, sf):
    """C2 for many tables at once over column catalogs derived from part:
    retyped columns (safe_cast), new staging columns (add_column), columns
    only the final tables have (keep)."""
    p = fx.table(spark, sf, "part")
    tbl = F.expr(fx.CATALOG_TABLE_EXPR).alias("table_name")
    col = F.expr(fx.CAT_COL).alias("column_name")
    final = p.where(F.col("p_size") <= 45).select(tbl, col, F.expr(fx.CAT_TYPE).alias("data_type"))
    final = final.unionByName(final.select("table_name", F.lit("_etl_synced").alias("column_name"),
                                           F.lit("timestamp").alias("data_type")))
    staging = p.where(F.col("p_partkey") % 5 != 0).select(tbl, col, F.expr(fx.STAGING_TYPE).alias("data_type"))
    return SC.schema_diff_catalog(staging.distinct(), final.distinct())


@query("landing_layouts")
def q_landing_layouts(spark, sf):
    """Orders landed in every layout (NDJSON, list dump, streamed
    array, compact one-line arrays), each read back with its reader."""
    base = scratch_dir(spark, "layouts")
    o = _orders_as_text(spark, sf)
    WR.write_ndjson(o, f"{base}/ndjson")
    outs = []
    for layout in ("indent2", "streamed", "compact"):
        WR.write_json_array(o, f"{base}/{layout}", layout)
    for layout, reader in (("ndjson", "ndjson"), ("indent2", "indent2"), ("streamed", "streamed"),
                           ("compact", "whole")):
        back = _scan_back(spark, f"{base}/{layout}", reader, _ORDERS_DDL)
        outs.append(back.withColumn("layout", F.lit(layout)))
    out = outs[0]
    for df in outs[1:]:
        out = out.unionByName(df)
    return out.withColumn("o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))
