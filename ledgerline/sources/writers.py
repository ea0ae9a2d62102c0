"""Writers for landed layouts (used to land data the way the puller does, and
by tests).  Files are independent: each holds one complete array."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.sources.landing import SEP_INDENT2, SEP_STREAMED

# Records in an array file.
FILE_RECORDS = 20_000


def write_json_array(df: DataFrame, path: str, layout: str = "indent2", by: list[str] | None = None,
                     file_records: int = FILE_RECORDS) -> None:
    """JSON arrays of up to ``file_records`` records, each a file below
    ``path``; records joined by the layout's separator (``,\\n  {`` for list
    dumps, ``,\\n{`` for streamed dumps), or all on one line (``compact``).
    ``by`` columns become folders instead of fields.

    A file is one row of bounded size, written by the built-in text writer.
    """
    by = list(by or [])
    own = [c for c in df.columns if c not in by]
    at = F.monotonically_increasing_id()
    rows = df.select(*by, F.to_json(F.struct(*own)).alias("rec"), at.alias("at"))
    # The rows of a task are numbered without gaps from (task << 33).
    part, number = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    files = rows.groupBy(*by, F.concat_ws("-", part, F.floor(number / file_records)).alias("file")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("at", "rec"))), lambda x: x["rec"]).alias("recs"))
    first, sep, last = {"indent2": ("[\n  ", SEP_INDENT2[:-1], "\n]"), "streamed": ("[\n", SEP_STREAMED[:-1], "\n]"),
                        "compact": ("[", ",", "]")}[layout]
    files = files.select(*by, "file", F.concat(F.lit(first), F.array_join("recs", sep), F.lit(last)).alias("value"))
    files.write.mode("append" if by else "overwrite").partitionBy(*by, "file").text(path)


def write_ndjson(df: DataFrame, path: str) -> None:
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(path)


def write_ndjson_append(df: DataFrame, path: str) -> None:
    """Add one more drop of NDJSON files to a landing folder."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("append").text(path)


def land_snapshot(df: DataFrame, root: str, endpoint: str, snapshot_ts: str) -> str:
    """Keep every pulled snapshot, a partition for each stamp; a retried
    pull replaces its own stamp only.  The stable alias is
    ``landing.latest_snapshot`` over the folder."""
    path = f"{root.rstrip('/')}/{endpoint}"
    (df.withColumn("snapshot_ts", F.lit(snapshot_ts)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_ts").parquet(path))
    return path
