"""Cross-site boilerplate lines by their distinct-site spread."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import apart, cut, land, small

# A line on this many sites or more is boilerplate.
MIN_SITES = 10
# Sketches of 2^LOG_K registers; their standard error is about 1.04 / sqrt(2^LOG_K).
LOG_K = 8
# Spreads within so many standard errors of the threshold are counted exactly.
MARGIN = 5.0


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _line_key(line: Column) -> Column:
    """Lines are compared without white space at their ends; blank lines have
    no key."""
    bare = F.trim(line, F.lit(" \t\r\f\x0b"))
    return F.when(F.length(bare) > 0, F.struct(F.xxhash64(bare).alias("h"), F.octet_length(bare).alias("n")))


def _line_rows(docs: DataFrame, site: str) -> DataFrame:
    """(id, tkey, site, h, n) of each distinct line that a row holds."""
    keys = F.array_distinct(F.filter(F.transform(_lines(F.col("text")), _line_key), lambda k: k.isNotNull()))
    return docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("tkey"),
                       F.xxhash64(F.col(site)).alias("site"), F.explode(keys).alias("k")).select(
        "id", "tkey", "site", "k.h", "k.n")


def boilerplate(rows: DataFrame, min_sites: int = MIN_SITES, log_k: int = LOG_K) -> DataFrame:
    """(h, n) of the lines in ``rows`` (site, h, n) that stand on ``min_sites``
    or more distinct sites.

    One sketch of the sites per line, merged by aggregation, so that a line
    shared by all documents costs a sketch per task.  A sketch well below or
    above the threshold decides; the lines near it are joined to the rows
    again and their sites counted one by one.
    """
    error = MARGIN * 1.04 / (1 << log_k) ** 0.5
    spread = cut(rows.groupBy("h", "n").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(log_k))).alias("sites"))
                 .filter(F.col("sites") >= min_sites * (1 - error)))
    sure = F.col("sites") > min_sites * (1 + error)
    near = spread.filter(~sure).select("h", "n")
    exact = (rows.select("site", "h", "n").join(small(near), ["h", "n"]).distinct()
             .groupBy("h", "n").count().filter(F.col("count") >= min_sites).select("h", "n"))
    return cut(spread.filter(sure).select("h", "n").unionByName(exact))


def remove_boilerplate(docs: DataFrame, site: str = "source", min_sites: int = MIN_SITES,
                       log_k: int = LOG_K) -> DataFrame:
    """``docs`` with the text freed of boilerplate lines, and n_lines and
    n_removed.

    Sites are the values of ``site``; null is a site of its own.  Every copy
    of a boilerplate line goes, in every document; blank lines stay; the
    rest keeps its order and wording.  Null texts stay null with no lines,
    an empty text has one blank line.  Rows with equal ids are told apart by
    their texts.  Mirrored documents are boilerplate by this rule: remove
    near duplicates first.
    """
    # Hashes of the lines, written once: a small part of the texts.
    rows = land(_line_rows(docs, site), "lines")
    bad = boilerplate(rows, min_sites, log_k)
    i, t, lines_bad, ls, left = apart(docs, "_id", "_tkey", "_bad", "_ls", "_kept")
    held = rows.join(small(bad), ["h", "n"]).groupBy(F.col("id").alias(i), F.col("tkey").alias(t)).agg(
        F.collect_set(F.struct("h", "n")).alias(lines_bad))
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    d = docs.select(*names).join(held, F.col("doc_id").eqNullSafe(F.col(i)) & (F.xxhash64("text") == F.col(t)), "left")
    d = d.withColumn(ls, _lines(F.col("text")))
    kept = F.filter(ls, lambda x: F.coalesce(~F.array_contains(lines_bad, _line_key(x)), F.lit(True)))
    d = d.withColumn(left, F.when(F.col(lines_bad).isNotNull(), kept))
    n = F.coalesce(F.when(F.col("text").isNotNull(), F.size(ls)), F.lit(0)).cast("long")
    gone = F.when(F.col(left).isNotNull(), F.size(ls) - F.size(left)).otherwise(F.lit(0)).cast("long")
    text = F.coalesce(F.array_join(left, "\n"), "text").alias("text")
    return d.select(*[c if c != "text" else text for c in names], n.alias("n_lines"), gone.alias("n_removed"))
