"""Landed CSV reports.

The schema comes from the header: names cleaned by F6, ``employee_id`` ->
int, ``date`` -> date, every other column text.  Quoted fields may hold
line breaks, so files are read with ``multiLine`` unless told otherwise
(one task per file; the exports are one file per tenant and report).  A bad value fails the file.
"""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.names import clean_header

# Fixed typed columns of the header-derived schema.
TYPED_COLUMNS = {"employee_id": T.IntegerType(), "date": T.DateType()}


def header_names(spark: SparkSession, path: str) -> list[str]:
    """Raw header names (reads the header line only)."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path).columns


def header_schema(headers: list[str]) -> T.StructType:
    return T.StructType([T.StructField(h, TYPED_COLUMNS.get(h, T.StringType()), True)
                         for h in (clean_header(x) for x in headers)])


def files_by_header(spark: SparkSession, path: str) -> list[list[str]]:
    """The landed files grouped by their header line (one row per file comes
    to the driver, as with any file listing).  The first line is the one
    with the smallest id in the split at byte 0."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value"),
                                         F.col("_metadata.file_block_start").alias("start"),
                                         F.monotonically_increasing_id().alias("at"))
    heads = lines.where("start = 0").groupBy("file").agg(F.min_by("value", "at").alias("head")).collect()
    groups: dict[str, list[str]] = {}
    for r in sorted(heads):
        groups.setdefault(r["head"], []).append(re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(r["file"])))
    return list(groups.values())


def read_landed_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
                    mode: str = "FAILFAST", multi_line: bool = True) -> DataFrame:
    """Read with the header-derived schema, header skipped.

    Without ``schema``, files whose headers differ are read by their own
    header and meet by column name; a column that a file lacks is null.
    ``multi_line=False`` splits large files, for exports without quoted line
    breaks.
    """
    def read(paths: str | list[str], own: T.StructType) -> DataFrame:
        return (spark.read.schema(own).option("header", True).option("enforceSchema", True)
                .option("multiLine", multi_line).option("mode", mode).csv(paths))

    groups = files_by_header(spark, path) if schema is None else []
    if len(groups) < 2:
        return read(path, schema or header_schema(header_names(spark, path)))
    parts = [read(g, header_schema(header_names(spark, g[0]))) for g in groups]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
