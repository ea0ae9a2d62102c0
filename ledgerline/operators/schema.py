"""Schema operators: diff (C2), column addition (C3-C5 live in merge),
duplicate naming styles (C6-C8) and field-type replacement (N6).

Schemas are metadata: C2 and N6 walk ``StructType`` objects on the driver.
C6-C8 run over a *column catalog* DataFrame (one row per table column,
like an information schema), so one job covers every table and tenant.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.names import SNAKE_CLASS, camel_col

AUDIT_PREFIX = "_etl_"

# The chain of numbers; each fits into the next.
_NUMBERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)
_TIMES = (T.DateType, T.TimestampNTZType, T.TimestampType)


def join_types(a: T.DataType, b: T.DataType) -> T.DataType:
    """The smallest type that holds the values of both: a lattice with null
    below and text above.  Numbers widen to bigint and double (an exact
    decimal beside another number to double), dates to timestamps, structs
    field by field, lists by element; any other two meet in text."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    for chain in (_NUMBERS, _TIMES):
        if isinstance(a, chain) and isinstance(b, chain):
            top = max(chain.index(type(a)), chain.index(type(b)))
            # A long does not fit into a float.
            return T.DoubleType() if chain is _NUMBERS and top == 4 and not type(a) is type(b) else chain[top]()
    number = (*_NUMBERS, T.DecimalType)
    if isinstance(a, number) and isinstance(b, number):
        return T.DoubleType()
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return join_schemas(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(join_types(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType) and a.keyType == b.keyType:
        return T.MapType(a.keyType, join_types(a.valueType, b.valueType))
    return T.StringType()


def join_schemas(a: T.StructType, b: T.StructType) -> T.StructType:
    """Field by field; fields of ``b`` alone come last.  All may be null."""
    other = {f.name: f.dataType for f in b.fields}
    out = [T.StructField(f.name, join_types(f.dataType, other[f.name]) if f.name in other else f.dataType) for f in a.fields]
    have = {f.name for f in a.fields}
    return T.StructType(out + [T.StructField(f.name, f.dataType) for f in b.fields if f.name not in have])


def widen(c: Column, src: T.DataType, dst: T.DataType) -> Column:
    """A value of ``src`` as ``dst``, a type above it in the lattice.  Nothing
    is lost: values that become text are their JSON text, strings as they
    are."""
    if src == dst:
        return c
    if isinstance(src, T.NullType):
        return c.cast(dst)
    if isinstance(src, T.StructType) and isinstance(dst, T.StructType):
        have = {f.name: f.dataType for f in src.fields}
        return F.when(c.isNotNull(), F.struct(*[
            (widen(c[f.name], have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in dst.fields]))
    if isinstance(src, T.ArrayType) and isinstance(dst, T.ArrayType):
        return F.transform(c, lambda x: widen(x, src.elementType, dst.elementType))
    if isinstance(src, T.MapType) and isinstance(dst, T.MapType):
        return F.transform_values(c, lambda k, x: widen(x, src.valueType, dst.valueType))
    if isinstance(dst, T.StringType):
        if isinstance(src, T.VariantType):
            kind = F.schema_of_variant(c)
            return F.when(kind == "STRING", F.try_variant_get(c, "$", "string")).when(kind != "VOID", F.to_json(c))
        if isinstance(src, (T.StructType, T.ArrayType, T.MapType)):
            return F.to_json(c, {"ignoreNullFields": "false"})
    return c.cast(dst)


def narrow(c: Column, src: T.DataType, dst: T.DataType) -> Column:
    """Back from ``src`` to ``dst``, a type below it that the values came
    from; other values become null."""
    if src == dst:
        return c
    if isinstance(src, T.StructType) and isinstance(dst, T.StructType):
        have = {f.name: f.dataType for f in src.fields}
        return F.when(c.isNotNull(), F.struct(*[
            (narrow(c[f.name], have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in dst.fields]))
    if isinstance(src, T.ArrayType) and isinstance(dst, T.ArrayType):
        return F.transform(c, lambda x: narrow(x, src.elementType, dst.elementType))
    if isinstance(src, T.MapType) and isinstance(dst, T.MapType):
        return F.transform_values(c, lambda k, x: narrow(x, src.valueType, dst.valueType))
    if isinstance(src, T.StringType) and isinstance(dst, (T.StructType, T.ArrayType, T.MapType)):
        return F.from_json(c, dst.json())
    return c.try_cast(dst)


# ----------------------------------------------------------------------- C2
def schema_diff_rows(staging: T.StructType, target: T.StructType) -> list[tuple]:
    """One row per column: common with another type (action safe_cast),
    staging only (add_column) or target only (keep).  Audit columns are
    skipped; full types are compared (findings 20, 21)."""
    s = {f.name: f.dataType for f in staging.fields if not f.name.startswith(AUDIT_PREFIX)}
    t = {f.name: f.dataType for f in target.fields if not f.name.startswith(AUDIT_PREFIX)}
    rows = []
    for name in sorted(set(s) | set(t)):
        st, tt = s.get(name), t.get(name)
        if st is not None and tt is not None:
            if st != tt:
                action = "merge_fields" if isinstance(st, T.StructType) and isinstance(tt, T.StructType) \
                    else "safe_cast"
                rows.append((name, st.simpleString(), tt.simpleString(), action))
        elif st is not None:
            rows.append((name, st.simpleString(), None, "add_column"))
        else:
            rows.append((name, None, tt.simpleString(), "keep"))
    return rows


def schema_diff(spark: SparkSession, staging: DataFrame, target: DataFrame) -> DataFrame:
    return spark.createDataFrame(
        schema_diff_rows(staging.schema, target.schema),
        "column_name string, staging_type string, final_type string, action string")


def column_catalog(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Information-schema style rows (table_name, column_name, data_type)
    from DataFrame schemas (driver metadata only)."""
    rows = [(t, f.name, f.dataType.simpleString()) for t, df in tables.items() for f in df.schema.fields]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string")


# ------------------------------------------------------------------ C6, C8
def duplicate_style_pairs(catalog: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Columns present in both styles within one table.

    A snake name (``^[a-z][a-z0-9_]*$``) whose camel twin differs from it and
    is also a column of the same table.  One equi-join over the distinct
    columns of all tables; audit columns are left out.
    """
    by = by or ["table_name"]
    cols = (catalog.where(~F.col("column_name").startswith(AUDIT_PREFIX))
            .select(*by, "column_name").distinct())
    snake_side = cols.where(F.col("column_name").rlike(SNAKE_CLASS)).select(
        *by, F.col("column_name").alias("snake_case"),
        camel_col(F.col("column_name")).alias("camel_twin"))
    snake_side = snake_side.where(F.col("camel_twin") != F.col("snake_case"))
    other = cols.select(*by, F.col("column_name").alias("camel_twin"))
    return snake_side.join(other, by + ["camel_twin"]).select(
        *by, "snake_case", F.col("camel_twin").alias("camel_case"))


def drift_summary(pairs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Pairs per table."""
    by = by or ["table_name"]
    return pairs.groupBy(*by).agg(F.count(F.lit(1)).alias("n_pairs"),
                                  F.sort_array(F.collect_set("snake_case")).alias("snake_columns"))


def drift_totals(catalog: DataFrame, pairs: DataFrame, tenant_col: str) -> DataFrame:
    """One row: tenants and tables (of a tenant) with pairs, all tenants,
    and pairs.  Both sides are aggregates; the total is a scalar subquery."""
    total = catalog.agg(F.count_distinct(tenant_col)).scalar()
    return pairs.agg(F.count_distinct(tenant_col).alias("tenants_affected"),
                     F.count_distinct(tenant_col, "table_name").alias("tables_affected"),
                     F.count(F.lit(1)).alias("n_pairs")).withColumn("n_tenants", total)


# ----------------------------------------------------------------------- C7
def drop_duplicate_style(df: DataFrame, pairs: list[tuple[str, str]], keep: str = "snake_case",
                         copy_first: bool = True) -> DataFrame:
    """Keep one style of each (snake, camel) pair.

    With ``copy_first`` the kept column takes the other one's value where it
    is null (``coalesce``), then the other is dropped: a projection, written
    out as a new version since parquet has no DROP COLUMN.
    """
    out = df
    for snake_name, camel_name in pairs:
        keep_c, drop_c = (snake_name, camel_name) if keep == "snake_case" else (camel_name, snake_name)
        if keep_c in out.columns and drop_c in out.columns:
            if copy_first:
                out = out.withColumn(keep_c, F.coalesce(F.col(keep_c), F.col(drop_c)))
            out = out.drop(drop_c)
    return out


# ----------------------------------------------------------------------- N6
def replace_field_type(schema: T.StructType, name: str, new: T.DataType = T.StringType()) -> T.StructType:
    """Every field called ``name`` at any depth becomes ``new``."""
    def walk(dt: T.DataType) -> T.DataType:
        if isinstance(dt, T.StructType):
            return T.StructType([T.StructField(f.name, new if f.name == name else walk(f.dataType),
                                               f.nullable) for f in dt.fields])
        if isinstance(dt, T.ArrayType):
            return T.ArrayType(walk(dt.elementType), dt.containsNull)
        return dt
    return walk(schema)


def cast_field_to_text(df: DataFrame, name: str) -> DataFrame:
    """N6 on data: top-level ``name`` to text (JSON text for nested values),
    nested occurrences rebuilt through ``transform`` / ``withField``."""
    def conv(c: Column, dt: T.DataType) -> Column:
        if isinstance(dt, T.StructType):
            out = c
            for f in dt.fields:
                if f.name == name:
                    val = c[f.name]
                    txt = F.to_json(val) if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) \
                        else val.cast("string")
                    out = out.withField(f.name, txt)
                elif isinstance(f.dataType, (T.StructType, T.ArrayType)):
                    out = out.withField(f.name, conv(c[f.name], f.dataType))
            return F.when(c.isNotNull(), out)
        if isinstance(dt, T.ArrayType) and isinstance(dt.elementType, (T.StructType, T.ArrayType)):
            return F.transform(c, lambda x: conv(x, dt.elementType))
        return c

    exprs = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name == name:
            c = F.to_json(c) if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) \
                else c.cast("string")
        elif isinstance(f.dataType, (T.StructType, T.ArrayType)):
            c = conv(c, f.dataType)
        exprs.append(c.alias(f.name))
    return df.select(*exprs)


def schema_diff_catalog(staging_cat: DataFrame, final_cat: DataFrame,
                        by: list[str] | None = None) -> DataFrame:
    """C2 over column catalogs (table_name, column_name, data_type) of many
    tables at once: common columns with another type (safe_cast),
    staging-only (add_column) and final-only (keep) rows; audit columns are
    skipped.  One full outer join on (table, column)."""
    by = by or ["table_name"]
    s = staging_cat.where(~F.col("column_name").startswith(AUDIT_PREFIX)).select(
        *by, "column_name", F.col("data_type").alias("staging_type"))
    f = final_cat.where(~F.col("column_name").startswith(AUDIT_PREFIX)).select(
        *by, "column_name", F.col("data_type").alias("final_type"))
    j = s.join(f, by + ["column_name"], "full_outer")
    action = (F.when(F.col("final_type").isNull(), F.lit("add_column"))
              .when(F.col("staging_type").isNull(), F.lit("keep"))
              .when(F.col("staging_type") != F.col("final_type"), F.lit("safe_cast")))
    return j.select(*by, "column_name", "staging_type", "final_type", action.alias("action")) \
        .where(F.col("action").isNotNull())
