"""Versioned publishing (H1): copy-on-write without a table format.

Each publish writes a new version folder under the shared root and then
appends one pointer row; readers follow the newest pointer, so a path being
read is never overwritten and a failed write leaves the old version live.
Re-running a publish with the same version id is a no-op (idempotent
retries after a lost executor or a restarted micro-batch).
"""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators import schema as SC

POINTERS = "_pointers"
POINTER_SCHEMA = "table_name string, version bigint, path string, token string"


def _pointer_path(root: str) -> str:
    return f"{root.rstrip('/')}/{POINTERS}"


def published_versions(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(POINTER_SCHEMA).parquet(_pointer_path(root))
    except AnalysisException as e:  # no pointer table yet
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        return spark.createDataFrame([], POINTER_SCHEMA)


def latest_version(spark: SparkSession, root: str, table: str) -> int | None:
    row = (published_versions(spark, root).where(F.col("table_name") == table)
           .agg(F.max("version")).first())
    return row[0] if row else None


CLAIMS = "_claims"


def claim_version(spark: SparkSession, root: str, table: str, least: int) -> int:
    """The first number from ``least`` that no other publisher has: its file is
    created only if absent, so of two publishers at once one moves on.  A
    claim without a version is a gap."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while True:
        path = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{CLAIMS}/{table}/{least}")
        fs = path.getFileSystem(conf)
        fs.mkdirs(path.getParent())
        try:
            fs.create(path, False).close()
            return least
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in e.java_exception.getClass().getName():
                raise
            least += 1


def publish(df: DataFrame, root: str, table: str, version: int | None = None,
            partition_by: list[str] | None = None, token: str | None = None) -> str:
    """Write ``df`` as a version of ``table`` and switch the pointer.

    With ``version``, a version that is there already is left as it is.
    With ``token`` instead, the publisher numbers the versions and a token
    that was published already does nothing: the token names the work (a
    stream and its batch), so a new stream never meets an old number.
    """
    spark = df.sparkSession
    same = F.col("token") == token if token is not None else F.col("version") == version
    existing = published_versions(spark, root).where((F.col("table_name") == table) & same).limit(1).collect()
    if existing:
        return existing[0]["path"]
    if version is None:
        version = claim_version(spark, root, table, (latest_version(spark, root, table) or 0) + 1)
    path = f"{root.rstrip('/')}/{table}/v={version}"
    if partition_by:   # see publish_tenants: sized files per partition value
        df.hint("rebalance", *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)
    spark.createDataFrame([(table, int(version), path, token)], POINTER_SCHEMA) \
        .write.mode("append").parquet(_pointer_path(root))
    return path


def conform(df: DataFrame, like: T.StructType | None) -> DataFrame:
    """Column order and types of the written schema (partition columns come
    back with inferred types, e.g. ``int`` for a ``bigint`` tenant id)."""
    if like is None:
        return df
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in like.fields])


def read_published(spark: SparkSession, root: str, table: str,
                   like: T.StructType | None = None) -> DataFrame | None:
    v = latest_version(spark, root, table)
    if v is None:   # perhaps a table of buckets
        return read_buckets(spark, root, table, like=like)
    return conform(spark.read.parquet(f"{root.rstrip('/')}/{table}/v={v}"), like)


def ensure_table(spark: SparkSession, root: str, table: str, staging: T.StructType) -> bool:
    """Create the final table, empty, with staging's columns and the audit
    columns, unless it is there.  Returns whether it was created."""
    if read_published(spark, root, table) is not None:
        return False
    own = [f for f in staging.fields if not f.name.startswith("_etl_")]
    audit = [T.StructField("_etl_synced", T.TimestampNTZType()), T.StructField("_etl_operation", T.StringType())]
    publish(spark.createDataFrame([], T.StructType(own + audit)), root, table, token="create")
    return True


# ------------------------------------------------------------ per-tenant versions
TENANT_POINTERS = "_tenant_pointers"
# ``written``: the schema of the version's files; ``own``: the tenant's own
# types, which other tenants in the version may have widened in the files.
TENANT_POINTER_SCHEMA = ("table_name string, tenant string, version bigint, path string, written string, own string, "
                         "null_tenant boolean, token string")
# The characters that are escaped in partition folder names, and
# the folder of null.
_ESCAPED = frozenset([chr(c) for c in range(1, 32)] + list("\"#%'*/:=?\\\x7f{[]^"))
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _tenant_pointer_path(root: str) -> str:
    return f"{root.rstrip('/')}/{TENANT_POINTERS}"


def partition_folder(col: str, value) -> str:
    """The folder name of a partition value."""
    text = "" if value is None else str(value)
    return f"{col}=" + ("".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in text) or _NULL_FOLDER)


def literal_path(path: str) -> str:
    """A path as readers take it that expand wildcards."""
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in path)


def tenant_versions(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(TENANT_POINTER_SCHEMA).parquet(_tenant_pointer_path(root))
    except AnalysisException as e:  # no pointer table yet
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        return spark.createDataFrame([], TENANT_POINTER_SCHEMA)


def publish_tenants(df: DataFrame, root: str, table: str, version: int | None, tenant_col: str,
                    tenants: list | None = None, own: dict | None = None, token: str | None = None) -> str:
    """H1: copy-on-write of the tenants present in ``df`` only.

    ``df`` holds the new rows of the touched tenants (e.g. a merge over the
    target rows of this load's tenants).  They are written as one new
    version folder partitioned by tenant, then one pointer row per touched
    tenant is appended; untouched tenants keep pointing at their older
    version and are neither read nor rewritten.  Retrying a version that is
    already recorded does nothing.

    The pointer rows keep the schema of the files and, from ``own`` (tenant ->
    schema), the types that a tenant's columns have by themselves.  With a
    ``token`` in place of a version, versions are numbered here and work that
    was published under the token does nothing, as in ``publish``.
    """
    spark = df.sparkSession
    known = tenant_versions(spark, root).where(F.col("table_name") == table)
    same = F.col("version") == version if token is None else F.col("token") == token
    done, last = known.agg(F.max(F.when(same, F.col("version"))), F.max("version")).first()
    if done is not None:
        return f"{root.rstrip('/')}/{table}/v={done}"
    version = claim_version(spark, root, table, (last or 0) + 1) if version is None else version
    base = f"{root.rstrip('/')}/{table}/v={version}"
    # rebalance on the tenant: rows of one tenant meet in few tasks (not one
    # file per task per tenant), while AQE splits a hot tenant and merges
    # small ones into evenly sized files
    df.hint("rebalance", tenant_col).write.mode("overwrite").partitionBy(tenant_col).parquet(base)
    # one pointer row per tenant folder written: the caller's tenant list
    # (the load plan knows it), else a distinct over the written partition
    # column (tenant-sized)
    if tenants is None:
        tenants = [r[0] for r in spark.read.schema(df.schema).parquet(base).select(tenant_col).distinct().collect()]
    written = df.schema.json()
    rows = [(table, None if t is None else str(t), int(version), f"{base}/{partition_folder(tenant_col, t)}", written,
             (own or {}).get(t, df.schema).json(), t is None, token) for t in tenants]
    spark.createDataFrame(rows, TENANT_POINTER_SCHEMA).coalesce(1).write.mode("append").parquet(_tenant_pointer_path(root))
    return base


def live_tenants(spark: SparkSession, root: str, table: str, tenants: list | None = None) -> list:
    """The newest pointer of each tenant (tenant-sized): tenant, path, and the
    schemas ``written`` and ``own`` (null in pointers of older libraries)."""
    ptr = tenant_versions(spark, root).where(F.col("table_name") == table)
    if tenants is not None:
        named = F.col("tenant").isin([str(t) for t in tenants if t is not None])
        ptr = ptr.where(F.coalesce(named, F.lit(None in tenants)))
    return ptr.groupBy("tenant").agg(F.max_by(F.struct("path", "written", "own"), "version").alias("p")).select("tenant", "p.*").collect()


def own_schemas(live: list, tenant_col: str) -> dict:
    """{tenant: its own column types}, audit and tenant columns included."""
    return {r["tenant"]: T.StructType.fromJson(json.loads(r["own"])) for r in live if r["own"]}


def read_tenants(spark: SparkSession, root: str, table: str, tenant_col: str,
                 tenants: list | None = None, like: T.StructType | None = None, live: list | None = None) -> DataFrame | None:
    """The live rows of ``table``: each tenant's newest version (only the
    listed tenants when given, so a load reads just what it merges).

    Versions may differ in columns and types.  Versions with the same schemas
    are one scan with that schema; each scan is cast to the least types that
    hold all of them (``schema.join_types``), so no version becomes
    unreadable and none is rewritten.
    """
    live = live_tenants(spark, root, table, tenants) if live is None else live
    if not live:
        return None
    groups: dict[tuple, list[str]] = {}
    for r in live:
        # Without a schema in the pointer, the version's files tell it; and a
        # scan over versions would take their level for a column named v.
        base = r["path"].rsplit("/", 1)[0]
        apart = not r["written"] or "v" in T.StructType.fromJson(json.loads(r["written"])).names
        groups.setdefault((r["written"], r["own"], base if apart else base.rsplit("/", 1)[0]), []).append(literal_path(r["path"]))
    parts = []
    for (written, own, base), paths in sorted(groups.items(), key=lambda g: g[1][0]):
        reader = spark.read.option("basePath", literal_path(base))
        df = reader.schema(T.StructType.fromJson(json.loads(written))).parquet(*paths) if own else reader.parquet(*paths)
        parts.append((df, T.StructType.fromJson(json.loads(own)) if own else df.schema))
    types = parts[0][1]
    for _, own in parts[1:]:
        types = SC.join_schemas(types, own)
    out = None
    for df, own in parts:
        have = {f.name: f.dataType for f in df.schema.fields}
        narrow = {f.name: f.dataType for f in own.fields}
        cols = []
        for f in types.fields:
            c = F.lit(None).cast(f.dataType)
            if f.name in have:  # back to the tenant's own type, then to the joint one
                c = SC.widen(SC.narrow(F.col(f.name), have[f.name], narrow[f.name]), narrow[f.name], f.dataType)
            cols.append(c.alias(f.name))
        df = df.select(*cols)
        out = df if out is None else out.unionByName(df)
    return conform(out, like)


# ------------------------------------------------------------ buckets of keys
BUCKET = "_bucket"


def with_bucket(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """Add the bucket of each row's keys, the same in every version."""
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int"))


def publish_buckets(df: DataFrame, root: str, table: str, touched: list[int], token: str) -> str:
    """H1 for small changes to a large table: write the ``touched`` buckets
    (all of their rows) as a new version; the others keep their files."""
    return publish_tenants(df, root, table, None, BUCKET, tenants=touched, token=token)


def read_buckets(spark: SparkSession, root: str, table: str, touched: list[int] | None = None,
                 like: T.StructType | None = None) -> DataFrame | None:
    """The live rows of a table of buckets, or of the ``touched`` ones only."""
    live = live_tenants(spark, root, table, touched)
    if not live or not live[0]["path"].rsplit("/", 1)[1].startswith(BUCKET + "="):
        return None
    return conform(read_tenants(spark, root, table, BUCKET, live=live).drop(BUCKET), like)
