"""Landed snapshot scans and reports.

Landed JSON comes in three layouts: NDJSON (one object per line), a list
dumped with indent 2 and a streamed array (items joined by ``,\\n{``).  Files
of different layouts may lie side by side (``read_landed``).  The dumped
layouts are split on their record separator with Hadoop's custom
line separator, so a 1 GB array file is read by many tasks instead of one.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.names import title_file_name_col
from ledgerline.operators.publish import literal_path

# Record separators of the two dumped layouts (fixed by the writers).
SEP_INDENT2 = ",\n  {"
SEP_STREAMED = ",\n{"
PREVIEW_CHARS = 200
# A malformed record's key is looked for in so many characters; one further on
# counts as unreadable, which only withholds deletes.
RECOVER_CHARS = 4096


def _files(spark: SparkSession):
    """Landed files lie in folders of any names and depths; none is a column."""
    return spark.read.option("recursiveFileLookup", "true")


def read_text_records(spark: SparkSession, path: str | list[str], layout: str = "ndjson", places: bool = False) -> DataFrame:
    """Text of every record with its source file: (file_path, value).

    ``layout``: ``ndjson``, ``indent2`` (list dump), ``streamed`` or
    ``whole`` (compact one-line arrays, one task per file).
    Blank chunks (empty files, empty arrays, blank lines) are skipped.
    ``places`` keeps them and adds the byte at which the chunk's split of the
    file starts, ``at``, which numbers the chunks of a split as the scan reads
    them, and the chunk's first character.
    """
    where = [F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"),
             F.substring("value", 1, 1).alias("char")] if places else []
    file = F.col("_metadata.file_path").alias("file_path")
    extra = ["start", "at", "char"] if places else []
    v = F.col("value")
    if layout == "whole":
        # compact one-line arrays (H7): one task per file, memory-bound by the
        # file; each element's raw text comes back as a string and is then
        # parsed like any other record.  Land NDJSON when the writer is ours.
        whole = _files(spark).text(path, wholetext=True).select(file, v, *where)
        elems = F.coalesce(F.from_json("value", "array<string>"), F.array("value"))
        df = whole.select("file_path", F.posexplode(elems).alias("i", "value"), *extra)
        if places:
            df = df.withColumn("at", F.col("at") + F.col("i"))
        df = df.select("file_path", "value", *extra)
    elif layout == "ndjson":
        df = _files(spark).text(path).select(file, v, *where)
    else:
        sep = SEP_INDENT2 if layout == "indent2" else SEP_STREAMED
        df = _files(spark).option("lineSep", sep).text(path).select(file, v, *where)
        v = F.regexp_replace(v, r"^\s*\[\s*", "")            # opening bracket of the file
        v = F.regexp_replace(v, r"(\})\s*\]\s*$", "$1")       # closing bracket after the last record
        v = F.regexp_replace(v, r"^\s*\]\s*$", "")            # an empty array
        v = F.when(F.trim(v).startswith("{") | (F.trim(v) == ""), v).otherwise(F.concat(F.lit("{"), v))
        df = df.select("file_path", v.alias("value"), *extra)
    return df if places else df.where(F.trim(F.col("value")) != "")


LAYOUTS = ("ndjson", "indent2", "streamed", "whole")


def detect_layouts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file_path, layout) of every file that is not blank.

    One scan of the text, without a parse.  What starts the file, and its
    lines within the split at byte 0, tell the layout: an array whose records
    start lines (``streamed``) or lines after two spaces (``indent2``), any
    other array (``whole``), else one record a line (``ndjson``).  Rows are
    numbered as the scan reads them, so the first is the first at any
    delivery order.
    """
    v = F.col("value")
    bare = F.ltrim(F.when(v.startswith("\ufeff"), F.substring(v, 2, 1 << 30)).otherwise(v))
    lines = (_files(spark).text(path)
             .select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("start"),
                     F.monotonically_increasing_id().alias("at"), (bare != "").alias("told"), bare.startswith("[").alias("array"),
                     v.startswith("{").alias("flush"), v.startswith("  {").alias("indented"))
             .where((F.col("start") == 0) & F.col("told")))
    # Buffers of a fixed width: the lines are hashed by file, not sorted.
    seen = lines.groupBy("file_path").agg(F.min_by("array", "at").alias("array"), F.bool_or("flush").alias("flush"),
                                          F.bool_or("indented").alias("indented"))
    return seen.select("file_path", F.when(~F.col("array"), "ndjson").when(F.col("flush"), "streamed")
                       .when(F.col("indented"), "indent2").otherwise("whole").alias("layout"))


def read_landed(spark: SparkSession, path: str | list[str], layout: str = "auto") -> DataFrame:
    """(file_path, value) of every record below ``path``, each file read by
    its own layout.

    With a stated ``layout``, a file of another one is contained: it is one
    malformed record that says so, since the wrong reader would find some of
    an array's records and lose the rest.  Only where layouts are mixed, files
    are listed one by one, as Spark's own file index holds them.
    """
    found = detect_layouts(spark, path).coalesce(16).persist()   # a row a file; the text is scanned once
    seen = [r["layout"] for r in found.select("layout").distinct().collect()]
    if len(seen) <= 1 and layout in ("auto", *seen):
        found.unpersist()
        return read_text_records(spark, path, seen[0] if seen else "ndjson")
    files: dict[str, list[str]] = {}
    for r in found.orderBy("file_path").collect():
        files.setdefault(r["layout"], []).append(r["file_path"])
    found.unpersist()
    out = None
    for own, paths in sorted(files.items()):
        if layout in ("auto", own):
            df = read_text_records(spark, [literal_path(unquote(f)) for f in paths], own)
        else:
            df = spark.createDataFrame([(f, f"a file of layout {own}, not {layout}") for f in paths], "file_path string, value string")
        out = df if out is None else out.unionByName(df)
    return out if out is not None else read_text_records(spark, path, layout)


def recovered_key(value: Column, names: list[str]) -> Column:
    """The key of a malformed record, as text, if it can be trusted.

    It stands at the record's top level before any deeper nesting than one
    level, and its value is complete: a string with both quotes, or a number
    with something after it.  Else null.
    """
    # Runs, not characters, are repeated: the matcher nests once a repetition.
    string = r'"(?:[^"\\]++|\\.)*+"'
    flat = rf'(?:[^{{}}\[\]"]++|{string})*+'
    skipped = rf'(?:[^{{}}\[\]"]++|{string}|\{{{flat}\}}|\[{flat}\])*?'
    key = "|".join(re.escape(n) for n in names)
    found = F.regexp_extract(F.substring(value, 1, RECOVER_CHARS),
                             rf'^\s*\{{{skipped}(?<=[,{{\s])"(?:{key})"\s*:\s*({string}|-?[0-9.eE+-]+(?=[\s,}}\]]))', 1)
    return F.when(found != "", F.get(F.from_json(F.concat(F.lit("["), found, F.lit("]")), "array<string>"), F.lit(0)))


def one_object_array(value: Column, kind: str | T.DataType) -> Column:
    """The text as a list of ``kind``, to be read with ``one_object``.

    The JSON reader stops after the first complete value and ignores what
    follows (``{"k": 1} x`` would pass), so the text is parsed as the first of
    two elements: any other trailing token then breaks the list, and a
    bracket in the text ends it before the second.
    """
    kind = T.ArrayType(kind) if isinstance(kind, T.DataType) else f"array<{kind}>"
    return F.from_json(F.concat(F.lit("["), value, F.lit(",null]")), kind)


def one_object(array: Column, value: Column) -> Column:
    """The object that ``value`` is; null if it is not exactly one."""
    closed = F.rtrim(value, F.lit(" \t\n\x0b\f\r")).endswith("}")
    whole = (F.size(array) == 2) & F.get(array, F.lit(1)).isNull() & closed
    return F.when(whole, F.get(array, F.lit(0)))


def parse_records(df: DataFrame, value: str = "value") -> DataFrame:
    """Add ``obj`` (key -> variant map, duplicate keys kept in order) and
    ``is_bad`` (text that is not exactly one JSON object)."""
    # two projections: the parsed array is computed once and read twice
    staged = df.withColumn("__arr", one_object_array(F.col(value), "map<string,variant>"))
    return (staged.withColumn("obj", one_object(F.col("__arr"), F.col(value))).drop("__arr")
            .withColumn("is_bad", F.col("obj").isNull()))


def split_quarantine(parsed: DataFrame, mode: str = "quarantine") -> tuple[DataFrame, DataFrame]:
    """Good rows, and bad rows with a 200-character preview.

    ``failfast`` raises when a bad row exists (one small aggregate);
    ``drop`` returns an empty quarantine.
    """
    good = parsed.where(~F.col("is_bad"))
    keep = [c for c in parsed.columns if c not in ("obj", "is_bad", "value")]
    bad = parsed.where(F.col("is_bad")).select(
        *keep, F.substring("value", 1, PREVIEW_CHARS).alias("preview"))
    if mode == "failfast":
        first = bad.limit(1).collect()
        if first:
            raise ValueError(f"malformed record: {first[0]['preview']!r}")
    if mode == "drop":
        bad = bad.limit(0)
    return good, bad


def file_report(spark: SparkSession, path: str, layout: str = "ndjson") -> DataFrame:
    """S3: per landed file: size, layout seen, record count, bad records, and
    the number and preview of the first bad one.  Every record is checked, not
    a sample.

    ``first_bad_line`` counts from 1: lines of NDJSON, blank ones included,
    and records of the array layouts.  Each split of a file counts its own
    lines; the running sum over a file's splits numbers them.  The layout seen
    is the file's first character (``[`` -> array, else NDJSON; a BOM or
    leading blank counts as NDJSON, as in the source), that of the first chunk
    of the split at byte 0.  Files of no bytes are not listed: Spark's readers
    have no split of them.
    """
    files = (_files(spark).format("binaryFile").load(path)
             .select(F.col("path").alias("file_path"), "length"))
    recs = parse_records(read_text_records(spark, path, layout, places=True))
    told = F.trim(F.col("value")) != ""
    bad = told & F.col("is_bad")
    splits = recs.groupBy("file_path", "start").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(told).alias("n_records"), F.count_if(bad).alias("n_bad"),
        F.min("at").alias("first"), F.min(F.when(bad, F.struct("at", F.substring("value", 1, PREVIEW_CHARS).alias("text")))).alias("worst"),
        F.min_by("char", "at").alias("char"))
    before = Window.partitionBy("file_path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("lines", F.coalesce(F.sum("n").over(before), F.lit(0)))
    stats = splits.groupBy("file_path").agg(
        F.sum("n_records").alias("n_records"), F.sum("n_bad").alias("n_bad"),
        F.min(F.when(F.col("worst").isNotNull(), F.struct(
            (F.col("lines") + F.col("worst.at") - F.col("first") + 1).alias("line"), F.col("worst.text").alias("text")))).alias("worst"),
        F.min_by("char", "start").alias("first_char"))
    out = files.join(stats, "file_path", "left")
    n = F.coalesce(F.col("n_records"), F.lit(0))
    status = (F.when((F.col("length") == 0) | (n == 0), F.lit("empty"))
              .when(F.col("n_bad") > 0, F.lit("malformed"))
              .otherwise(F.lit("ok")))
    return out.select("file_path", "length", n.alias("n_records"),
                      F.coalesce("n_bad", F.lit(0)).alias("n_bad"),
                      F.when(F.col("first_char") == "[", F.lit("array"))
                      .when(F.col("length") > 0, F.lit("ndjson")).alias("layout_seen"),
                      status.alias("status"), F.col("worst.line").alias("first_bad_line"),
                      F.col("worst.text").alias("first_bad_preview"))


def list_landed(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """File listing as a DataFrame (path, name, length, modification time);
    the ``binaryFile`` content column is never selected, so no file is read."""
    return (_files(spark).format("binaryFile").option("pathGlobFilter", glob).load(path)
            .select(F.col("path"), F.element_at(F.split("path", "/"), -1).alias("file_name"),
                    "length", "modificationTime"))


# Default prefix of the puller's standard export names (configurable).
EXPORT_PREFIX = "export_"


def resolve_landed_files(listing: DataFrame, tables: DataFrame, prefix: str = EXPORT_PREFIX) -> DataFrame:
    """For each table the first existing file of ``{prefix}{t}.csv``,
    ``{t}.csv``, ``Title Case.csv``.

    ``listing`` has ``file_name``; ``tables`` has ``table_name``.  Both are
    joined on the candidate name (one row per candidate), and the best
    priority per table is kept with ``min_by`` (an aggregate, no window).
    """
    t = F.col("table_name")
    title = title_file_name_col(t)
    cands = tables.select("table_name", F.explode(F.array(
        F.struct(F.lit(1).alias("priority"), F.concat(F.lit(prefix), t, F.lit(".csv")).alias("file_name")),
        F.struct(F.lit(2).alias("priority"), F.concat(t, F.lit(".csv")).alias("file_name")),
        F.struct(F.lit(3).alias("priority"), F.concat(title, F.lit(".csv")).alias("file_name")),
    )).alias("c")).select("table_name", "c.priority", "c.file_name")
    hit = cands.join(listing.select("file_name").distinct(), "file_name")
    return hit.groupBy("table_name").agg(
        F.min_by("file_name", "priority").alias("file_name"), F.min("priority").alias("priority"))


def latest_snapshot(df: DataFrame, by: list[str], snapshot_col: str = "snapshot_ts") -> DataFrame:
    """Rows of the newest snapshot per endpoint (the stable alias).

    The newest stamp per endpoint is a partial+final aggregate; the semi
    join against it is broadcast by AQE once measured.
    """
    newest = df.groupBy(*by).agg(F.max(snapshot_col).alias(snapshot_col))
    return df.join(newest, by + [snapshot_col], "left_semi")


def read_staging(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Good staging rows, and the quarantine (preview of bad records)."""
    st = spark.read.parquet(path)
    data = [c for c in st.columns if c not in ("is_bad", "__preview", "__key")]
    return (st.where(~F.col("is_bad")).select(*data),
            st.where(F.col("is_bad")).select(F.col("__preview").alias("preview")))


def read_latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """S14 stable alias: the rows of the newest ``snapshot_ts`` partition
    (a max over the partition column, then partition pruning)."""
    df = spark.read.parquet(path)
    newest = df.agg(F.max("snapshot_ts")).scalar()
    return df.where(F.col("snapshot_ts") == newest).drop("snapshot_ts")
