"""Snapshot comparison (Q1, F14, N5) and character-set difference."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.values import control_counts

NON_ASCII = r"[^\x00-\x7F]"


def _distinct_non_ascii(t):
    """Distinct non-ASCII characters of one text (deduplicated per row
    before the explode, so a long French text adds a few rows, not
    thousands)."""
    return F.array_distinct(F.regexp_extract_all(t, F.lit(f"({NON_ASCII})"), 1))


def snapshot_metrics(items: DataFrame, snapshot_col: str, text_col: str) -> DataFrame:
    """Q1: one metrics row per snapshot.

    items, characters and bytes; escaped (``\\r\\n``, ``\\r``, ``\\n``, ``\\t``
    as two-character text) and real control characters; items with line
    breaks (N5); distinct non-ASCII characters.  Per-item counts are summed
    with a partial aggregate; the non-ASCII set comes from extracting only
    non-ASCII characters (not every character) before ``count(distinct)``.
    """
    t = F.col(text_col)
    counts = control_counts(t)
    per_item = items.select(
        F.col(snapshot_col).alias("snapshot"), F.length(t).alias("n_chars"),
        *[v.alias(k) for k, v in counts.items()],
        t.rlike("[\r\n]").alias("multiline"))
    agg = per_item.groupBy("snapshot").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sum("n_chars").cast("bigint").alias("n_chars"),
        *[F.sum(k).cast("bigint").alias(k) for k in counts],
        F.count_if("multiline").alias("multiline_items"))
    chars = (items.select(F.col(snapshot_col).alias("snapshot"),
                          F.explode(_distinct_non_ascii(t)).alias("ch"))
             .groupBy("snapshot").agg(F.count_distinct("ch").alias("non_ascii_chars")))
    return agg.join(chars, "snapshot", "left").select(
        "*").fillna(0, subset=["non_ascii_chars"])


def snapshot_difference(metrics: DataFrame, first: str, second: str) -> DataFrame:
    """Q1: per metric the value of both snapshots, second minus first, and
    their ratio (null where the first has none).  A snapshot that is absent
    counts as 0 everywhere."""
    names = [c for c in metrics.columns if c != "snapshot"]
    long = metrics.select("snapshot", *[F.col(c).cast("bigint").alias(c) for c in names]).unpivot(
        ["snapshot"], names, "metric", "value")

    def of(which: str):
        return F.coalesce(F.sum(F.when(F.col("snapshot") == which, F.col("value"))), F.lit(0))

    both = long.groupBy("metric").agg(of(first).alias("first_value"), of(second).alias("second_value"))
    return both.select("metric", "first_value", "second_value",
                       (F.col("second_value") - F.col("first_value")).alias("difference"),
                       F.try_divide("second_value", "first_value").alias("ratio"))


def item_counts(items: DataFrame, group_col: str, base_group) -> DataFrame:
    """Items per group and how many more they are than the base group's."""
    n = items.groupBy(group_col).agg(F.count(F.lit(1)).alias("n_items"))
    base = n.where(F.col(group_col) == F.lit(base_group)).agg(F.max("n_items")).scalar()
    return n.withColumn("difference", F.col("n_items") - F.coalesce(base, F.lit(0)))


def non_ascii_set(items: DataFrame, group_col: str, text_col: str) -> DataFrame:
    """Distinct non-ASCII characters per group."""
    return (items.select(F.col(group_col).alias("grp"),
                         F.explode(_distinct_non_ascii(F.col(text_col))).alias("ch"))
            .distinct())


def charset_diff(items: DataFrame, group_col: str, text_col: str, base_group) -> DataFrame:
    """Characters a group uses that the base group never uses
    (``EXCEPT`` as a ``left_anti`` join on the small distinct sets)."""
    s = non_ascii_set(items, group_col, text_col)
    base = s.where(F.col("grp") == F.lit(base_group)).select("ch")
    return s.where(F.col("grp") != F.lit(base_group)).join(base, "ch", "left_anti") \
        .select(F.col("grp").alias(group_col), "ch")


def snapshot_keys(items: DataFrame, snapshot_col: str, obj: str, first: str, second: str) -> DataFrame:
    """Q1: the top-level keys of the records of two snapshots, with the number
    of records that have each, and where they stand (``both``, ``first`` or
    ``second``).  A key twice in a record counts once."""
    keys = F.explode(F.array_distinct(F.map_keys(obj)))
    n = items.select(F.col(snapshot_col).alias("snapshot"), keys.alias("key")).groupBy("key").agg(
        F.count_if(F.col("snapshot") == first).alias("n_first"), F.count_if(F.col("snapshot") == second).alias("n_second"))
    return n.select("key", "n_first", "n_second", F.when(F.col("n_second") == 0, "first").when(F.col("n_first") == 0, "second")
                    .otherwise("both").alias("found_in"))
