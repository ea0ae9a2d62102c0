"""Incremental landing merge with Structured Streaming.

New NDJSON files under a landing folder are read as a stream of lines with
checkpointed offsets.  Each micro-batch

1. parses its lines strictly (exactly one object) against the declared schema
   and quarantines the others with their file and a preview: a broken line
   never becomes a row;
2. keeps the newest row per key (``max_by``, map-side combined);
3. merges it without soft delete (a micro-batch is partial) into the buckets
   of keys that it touches, and publishes these as the next version; the other
   buckets are neither read nor rewritten, so a batch costs what it touches;
4. updates the monitoring snapshot (W10).

A version carries the stream's id and the batch id, and so does a batch's
quarantine: a batch that is replayed after a failure does nothing twice, while
a new stream over the same table goes on from its newest version.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.operators import merge as M
from ledgerline.operators import publish as PUB
from ledgerline.operators.keys import latest_per_key
from ledgerline.sources.landing import PREVIEW_CHARS, one_object, one_object_array

# Buckets of a target.  More make smaller rewrites and more files; the number
# belongs to the table and must not change.
BUCKETS = 64
QUARANTINE = "_quarantine"


def parse_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """(file_path, value, rec) of every line that is not blank; ``rec`` is null
    unless the line is exactly one object."""
    recs = lines.where(F.trim("value") != "").withColumn("recs", one_object_array(F.col("value"), schema))
    return recs.select("file_path", "value", one_object(F.col("recs"), F.col("value")).alias("rec"))


def merge_batch(lines: DataFrame, schema: T.StructType, root: str, table: str, keys: list[str], order_col: str,
                synced_at, batch_id: int, tenant_col: str | None = None, stream_id: str = "", buckets: int = BUCKETS) -> None:
    """foreachBatch body over lines (file_path, value)."""
    spark = lines.sparkSession
    token = f"{stream_id}:{batch_id}"
    # The parsed batch is written once: the quarantine, the touched buckets
    # and the merge all read it.
    path = f"{root.rstrip('/')}/_staging/{table}"
    parse_lines(lines, schema).write.mode("overwrite").parquet(path)
    parsed = spark.read.parquet(path)
    name = F.lit(None).cast("string") if not stream_id else F.lit(stream_id)
    (parsed.where("rec IS NULL").select("file_path", F.substring("value", 1, PREVIEW_CHARS).alias("preview"), name.alias("stream"))
     .write.mode("overwrite").parquet(f"{root.rstrip('/')}/{QUARANTINE}/table={table}/batch={_folder(token)}"))
    newest = latest_per_key(parsed.where("rec IS NOT NULL").select("rec.*"), keys, [order_col])
    # So are the newest rows, which the buckets, the merge and the monitoring
    # read: the keys are grouped once.
    PUB.with_bucket(newest, keys, buckets).write.mode("overwrite").parquet(f"{path}_newest")
    newest = spark.read.parquet(f"{path}_newest")
    touched = [r[0] for r in newest.select(PUB.BUCKET).distinct().collect()]   # at most ``buckets``
    if not touched:
        return
    newest = newest.drop(PUB.BUCKET)
    target = PUB.read_buckets(spark, root, table, touched)
    if target is None:
        out = M.first_load(newest, synced_at)
    else:
        out = M.merge_soft_delete(target, newest, synced_at, keys=keys, soft_delete=False, newer_col=order_col)
    PUB.publish_buckets(PUB.with_bucket(out, keys, buckets), root, table, touched, token)
    _monitor(spark, root, table, newest, touched, tenant_col, synced_at, token)


def _folder(token: str) -> str:
    return "".join(c if c.isalnum() or c in "-." else "_" for c in token)


def quarantined(spark: SparkSession, root: str, table: str) -> DataFrame:
    """(file_path, preview) of the broken lines of all batches."""
    try:
        return spark.read.parquet(f"{root.rstrip('/')}/{QUARANTINE}/table={table}").select("file_path", "preview")
    except AnalysisException as e:  # no batch yet
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        return spark.createDataFrame([], "file_path string, preview string")


def _monitor(spark: SparkSession, root: str, table: str, newest: DataFrame, touched: list[int], tenant_col: str | None,
             synced_at, token: str) -> None:
    """The batch's rows per tenant (one row when there is none), and the
    newest stamp: that of the touched buckets or the one recorded before."""
    from ledgerline.operators.monitor import rows_processed
    from ledgerline.plans.load_job import read_endpoint_monitoring, update_monitoring
    tcol = tenant_col or "company_id"

    def with_tenant(df: DataFrame) -> DataFrame:
        return df if tenant_col else df.withColumn(tcol, F.lit(0).cast("bigint"))

    rows = rows_processed(with_tenant(newest), [tcol])
    live = with_tenant(PUB.read_buckets(spark, root, table, touched)).groupBy(tcol).agg(F.max(M.SYNCED).alias("max_sync"))
    before = read_endpoint_monitoring(spark, root, table)
    if before is not None:
        was = before.select(F.col("company_id").alias("_was"), F.col("max_sync").alias("_max"))
        live = live.join(was, F.col(tcol).cast("string") == F.col("_was").cast("string"), "left").select(
            tcol, F.greatest("max_sync", "_max").alias("max_sync"))
    # the micro-batch's own duration is not measured here; 0.0 marks it
    update_monitoring(spark, root, live, rows, tcol, table, token, 0.0, synced_at)


def run_landing_merge(spark: SparkSession, landing: str, schema: T.StructType, root: str,
                      table: str, keys: list[str], order_col: str, synced_at,
                      checkpoint: str, max_files_per_trigger: int = 1,
                      tenant_col: str | None = None, buckets: int = BUCKETS) -> int:
    """Process every file now in ``landing`` (``availableNow``); return the
    latest published version."""
    stream = (spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(landing)
              .select(F.col("_metadata.file_path").alias("file_path"), "value"))

    def body(df: DataFrame, batch_id: int) -> None:
        stream_id = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
        merge_batch(df, schema, root, table, keys, order_col, synced_at, batch_id, tenant_col, stream_id, buckets)

    q = (stream.writeStream.foreachBatch(body)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    newest = PUB.tenant_versions(spark, root).where(F.col("table_name") == table).agg(F.max("version")).first()
    return newest[0] or 0
