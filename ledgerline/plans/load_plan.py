"""Load planning over tenants, the endpoint registry and the report catalog
(S7-S10, P10-P15, P17, P19, J1, J3, J6, U1, W11, W12).

A plan is a DataFrame of (tenant x endpoint) rows; only its few rows may be
collected to decide which endpoint jobs to start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.names import table_name_fallback_col
from ledgerline.operators import merge as M

# Fixed values.
LARGE_ENDPOINTS = ["gross-pay-items"]
DATE_PARAM_TYPES = ["Date", "DateTime", "DateOnly", "System.DateTime"]
FROM_WORDS = ["from", "start", "begin"]
TO_WORDS = ["to", "end"]
DEFAULT_HISTORY_FROM = "2025-01-01"
REPORT_PREFIX = "report/"


# Fixed pattern: slashes at either end.
OUTER_SLASHES = "^/+|/+$"


def strip_slashes(c: Column) -> Column:
    return F.regexp_replace(c, OUTER_SLASHES, "")


# ----------------------------------------------------------------- S7, O1
def active_companies(companies: DataFrame, flag: str, *, require_project: bool = False,
                     company_id=None) -> DataFrame:
    """Tenants whose ``flag`` is TRUE, by id; the inbox mode also needs a
    project; the test mode picks one id."""
    df = companies.where(F.col(flag) == F.lit(True))
    if require_project:
        df = df.where(F.col("company_project_id").isNotNull())
    if company_id is not None:
        df = df.where(F.col("company_id") == F.lit(company_id))
    return df.orderBy("company_id")


# ----------------------------------------------------------------- S8, P11
def registry_endpoints(registry: DataFrame) -> DataFrame:
    """S8 + P15: active registry rows handled here, flattened."""
    ep = F.col("endpoint")
    return (registry.where(ep.isNotNull() & (F.col("active") == True)  # noqa: E712
                           & (F.col("silver_use_bronze") == True))     # noqa: E712
            .select(ep["module"].alias("module"), ep["version"].alias("version"),
                    ep["submodule"].alias("submodule"), ep["name"].alias("name"),
                    F.coalesce(F.nullif(ep["endpoint_type"], F.lit("")), F.lit("normal"))
                    .alias("endpoint_type"),
                    "table_name"))


def api_parts(module: Column, version: Column, submodule: Column, name: Column) -> dict:
    """``{module}/{version}/tenant`` and ``{submodule}/{name}`` (slashes
    trimmed; an empty submodule counts as none)."""
    base = F.concat_ws("/", strip_slashes(module), strip_slashes(version), F.lit("tenant"))
    sub = strip_slashes(submodule)
    data = F.when(F.coalesce(sub, F.lit("")) != "",
                  F.concat_ws("/", sub, strip_slashes(name))).otherwise(strip_slashes(name))
    return {"api_url_base": base, "api_data": data}


def request_url(base_url: Column, api_url_base: Column, tenant: Column, api_data: Column) -> Column:
    """Join, collapse repeated slashes, restore the scheme."""
    url = F.concat_ws("/", F.regexp_replace(base_url, "/+$", ""), strip_slashes(api_url_base),
                      strip_slashes(tenant.cast("string")), strip_slashes(api_data))
    # Fixed patterns: runs of slashes, and the scheme that lost one of its two.
    url = F.regexp_replace(url, "/+", "/")
    return F.regexp_replace(url, "(https?):/", "$1://")


def extraction_mode(api_data: Column) -> Column:
    """Export cursor, streamed large endpoint, or normal paging."""
    large = F.lit(False)
    for name in LARGE_ENDPOINTS:
        large = large | api_data.contains(name)
    return (F.when(api_data.startswith("export/"), F.lit("export"))
            .when(large, F.lit("streaming"))
            .otherwise(F.lit("normal")))


# ----------------------------------------------------------- S9, U1, O2
def load_plan(registry: DataFrame, catalog: DataFrame) -> DataFrame:
    """Registry endpoints (flags defaulted, P15) UNION ALL active
    reports as ``report/<name>``; sorted case-insensitively (O2)."""
    ep = F.col("endpoint")
    reg = (registry.where(ep.isNotNull() & ep["name"].isNotNull() & F.col("table_name").isNotNull()
                          & (F.col("active") == True) & (F.col("silver_use_bronze") == True))  # noqa
           .select(ep["name"].alias("endpoint_name"), "table_name",
                   F.coalesce(F.col("use_merge"), F.lit(True)).alias("use_merge"),
                   F.coalesce(F.col("is_production"), F.lit(False)).alias("is_production"))
           .distinct())
    rep = (catalog.where(F.col("is_active") == True)  # noqa: E712
           .select(F.concat(F.lit(REPORT_PREFIX), F.col("report_name")).alias("endpoint_name"),
                   "table_name", F.lit(True).alias("use_merge"), F.lit(True).alias("is_production"))
           .distinct())
    return reg.unionByName(rep).orderBy(F.lower("endpoint_name"), "endpoint_name")


def endpoint_subset(plan: DataFrame, names: list[str]) -> DataFrame:
    """P10: keep a plan row when its endpoint or its table is listed."""
    return plan.where(F.col("endpoint_name").isin(names) | F.col("table_name").isin(names))


# ---------------------------------------------------------------- S10
def report_catalog_scan(catalog: DataFrame, company_id=None) -> DataFrame:
    """S10 for all companies at once (or one)."""
    df = catalog.where(F.col("is_active") == True)  # noqa: E712
    if company_id is not None:
        df = df.where(F.col("company_id") == F.lit(company_id))
    return df


# ---------------------------------------------------------------- P13
def report_windows(reports: DataFrame, existing_tables: DataFrame, run_date) -> DataFrame:
    """Table exists -> yesterday..yesterday; else history_from (default
    2025-01-01)..yesterday.  ``existing_tables`` has one ``table_name`` column."""
    yesterday = F.date_sub(F.lit(run_date).cast("date"), 1)
    ex = existing_tables.select(F.col("table_name").alias("existing__"),
                                F.lit(True).alias("exists__")).distinct()
    j = reports.join(ex, reports["table_name"] == ex["existing__"], "left")
    exists = F.col("exists__").isNotNull()
    start = F.coalesce(F.col("history_from"), F.lit(DEFAULT_HISTORY_FROM).cast("date"))
    return j.select(*reports.columns, exists.alias("table_exists"),
                    F.when(exists, yesterday).otherwise(start).alias("from_date"),
                    yesterday.alias("to_date"))


# ---------------------------------------------------------------- P14
def bind_date_params(df: DataFrame, params_col: str, from_col: str, to_col: str) -> DataFrame:
    """One row per bound parameter (name, value, position).

    ``params_col`` holds the parameter list as JSON text; bad text binds
    nothing.  Date-typed names containing from/start/begin get the window
    start, else to/end the window end, else exactly ``date`` the end.
    """
    arr = F.coalesce(
        F.from_json(F.col(params_col), "array<struct<name:string,dataType:string>>"),
        F.array().cast("array<struct<name:string,dataType:string>>"))
    keep = [c for c in df.columns if c != params_col]
    ex = df.select(*keep, F.posexplode(arr).alias("param_pos", "p"))
    low = F.lower(F.coalesce(F.col("p.name"), F.lit("")))
    is_from = F.lit(False)
    for w in FROM_WORDS:
        is_from = is_from | low.contains(w)
    is_to = F.lit(False)
    for w in TO_WORDS:
        is_to = is_to | low.contains(w)
    value = (F.when(is_from, F.col(from_col).cast("string"))
             .when(is_to, F.col(to_col).cast("string"))
             .when(low == "date", F.col(to_col).cast("string")))
    return (ex.where(F.col("p.dataType").isin(DATE_PARAM_TYPES) & value.isNotNull())
            .select(*keep, "param_pos", F.coalesce(F.col("p.name"), F.lit("")).alias("param_name"),
                    value.alias("param_value")))


# ---------------------------------------------------------------- J1
def catalog_with_companies(catalog: DataFrame, companies: DataFrame) -> DataFrame:
    """Catalog x companies on company_id, ordered for review."""
    j = catalog.join(companies.select("company_id", "company_name"), "company_id")
    return j.orderBy("company_name", "report_category", "report_name")


# ---------------------------------------------------------------- J3
def lookup_table_name(endpoints: DataFrame, registry_names: DataFrame,
                      endpoint_col: str = "endpoint") -> DataFrame:
    """Endpoint -> table name, case-insensitive, one match per endpoint
    (the smallest name), else the F5 fallback.

    The registry side is reduced to one row per lower-cased endpoint by a
    partial+final aggregate before the join.
    """
    reg = (registry_names.where((F.col("silver_use_bronze") == True)  # noqa: E712
                                & F.col("table_name").isNotNull())
           .groupBy(F.lower("endpoint_name").alias("ep_lower__"))
           .agg(F.min("table_name").alias("registry_table")))
    j = endpoints.join(reg, F.lower(F.col(endpoint_col)) == F.col("ep_lower__"), "left")
    return j.select(*endpoints.columns, F.coalesce(
        F.col("registry_table"), table_name_fallback_col(F.col(endpoint_col))).alias("table_name"))


# ---------------------------------------------------------------- P17/W13
def rename_struct_field(df: DataFrame, col: str, old: str, new: str) -> DataFrame:
    """Rebuild a struct with one field renamed, order kept; a null
    struct stays null."""
    st = df.schema[col].dataType
    fields = [F.col(f"{col}.{f.name}").alias(new if f.name == old else f.name) for f in st.fields]
    return df.withColumn(col, F.when(F.col(col).isNotNull(), F.struct(*fields)))


# ---------------------------------------------------------------- W11, W12
def registry_upsert(registry: DataFrame, changes: DataFrame) -> DataFrame:
    """W11 on table_name: set endpoint and active; insert new rows with the
    other flags null."""
    return M.upsert(registry, changes, ["table_name"],
                    set_exprs={"endpoint": M.s_col("endpoint"), "active": M.s_col("active")})


def conditional_update(df: DataFrame, predicate: Column, assignments: dict[str, Column]) -> DataFrame:
    """``UPDATE ... SET a = v WHERE predicate`` as a projection."""
    return df.withColumns({c: F.when(predicate, v.cast(df.schema[c].dataType)).otherwise(F.col(c))
                           for c, v in assignments.items()})


# ---------------------------------------------------------------- W8
# The catalog's columns that discovery fills, and its key.
DISCOVERY_COLUMNS = ["report_name", "report_description", "report_modified_on",
                     "parameters", "fields", "discovered_at"]
CATALOG_KEYS = ["company_id", "report_category", "report_id"]


def catalog_merge(catalog: DataFrame, discovered: DataFrame) -> DataFrame:
    """Update the six discovery columns, keep the user-owned ones;
    new reports arrive inactive with no table or history start."""
    return M.upsert(
        catalog, discovered, CATALOG_KEYS,
        set_exprs={c: M.s_col(c) for c in DISCOVERY_COLUMNS},
        insert_exprs={"is_active": F.lit(False), "table_name": F.lit(None),
                      "history_from": F.lit(None)})


# ---------------------------------------------------------------- J6, P19
def _cat_id(v: Column) -> Column:
    """Category id: the string itself, or the object's ``id``."""
    return F.coalesce(F.try_variant_get(v, "$.id", "string"), F.try_variant_get(v, "$", "string"))


def _cat_name(v: Column) -> Column:
    return F.coalesce(F.try_variant_get(v, "$.name", "string"), F.try_variant_get(v, "$", "string"))


def tree_walk(categories: DataFrame, reports: DataFrame, details: DataFrame,
              category_filter: str | None = None) -> DataFrame:
    """Categories -> reports -> details, from landed payloads.

    ``categories``: (company_id, payload) with a JSON list of strings or
    ``{id, name}`` objects.  ``reports``: (company_id, category, payload) with
    ``{"data": [{id, name}, ...]}`` pages.  ``details``: (company_id,
    category, report_id, payload) with parameters, fields, modifiedOn,
    description.  Unparsable nodes and id-less reports are skipped; a report
    without details is skipped (inner join).
    """
    cats = categories.select("company_id", F.explode(
        F.try_variant_get(F.try_parse_json("payload"), "$", "array<variant>")).alias("c"))
    cats = cats.select("company_id", _cat_id(F.col("c")).alias("report_category"),
                       _cat_name(F.col("c")).alias("category_name"))
    if category_filter is not None:
        f = category_filter.lower()
        cats = cats.where((F.lower("report_category") == f) | (F.lower("category_name") == f))
    reps = reports.select(
        "company_id", F.col("category").alias("report_category"),
        F.explode(F.try_variant_get(F.try_parse_json("payload"), "$.data", "array<variant>"))
        .alias("r"))
    reps = reps.select("company_id", "report_category",
                       F.try_variant_get("r", "$.id", "bigint").alias("report_id"),
                       F.coalesce(F.try_variant_get("r", "$.name", "string"), F.lit(""))
                       .alias("report_name")).where(F.col("report_id").isNotNull()
                                                    & (F.col("report_id") != 0))
    det = details.select("company_id", F.col("category").alias("report_category"), "report_id",
                         F.try_parse_json("payload").alias("d")).where(F.col("d").isNotNull())
    det = det.select(
        "company_id", "report_category", "report_id",
        F.coalesce(F.to_json(F.try_variant_get("d", "$.parameters", "variant")), F.lit("[]"))
        .alias("parameters"),
        F.coalesce(F.to_json(F.try_variant_get("d", "$.fields", "variant")), F.lit("[]"))
        .alias("fields"),
        F.try_variant_get("d", "$.modifiedOn", "string").alias("report_modified_on"),
        F.try_variant_get("d", "$.description", "string").alias("report_description"))
    keys = ["company_id", "report_category"]
    return (cats.join(reps, keys).join(det, keys + ["report_id"])
            .select("company_id", "report_category", "report_id", "report_name",
                    "report_description", "report_modified_on", "parameters", "fields"))
