"""SimHash near-duplicates through pivot distance tables."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations
from operator import and_

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import apart, components, cut, ship

SHINGLE = 3
MAX_BITS = 2
SEED = 42
# Words in one block of bit counts; bounds the memory that a long text needs.
BLOCK = 1 << 15
# References: distances to WIDE of them over all 64 bits discard pairs, and
# distances to NARROW of them within each segment make the join keys.
WIDE, NARROW = 12, 8
SEGMENTS = MAX_BITS + 3


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The signed 64-bit fingerprint of one text.

    Words are runs of anything but ASCII white space, A-Z in lower case.
    Texts of fewer words than ``shingle`` are one shingle; null texts and
    texts without words have fingerprint 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, BLOCK):
        hashes = [digest(b" ".join(words[i:i + shingle]), SEED) for i in range(at, min(n, at + BLOCK))]
        ones += np.unpackbits(np.array(hashes, ">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def with_fingerprint(docs: DataFrame, shingle: int = SHINGLE, *more: Column) -> DataFrame:
    """(doc_id, fp) of every row, and ``more``."""

    def tasks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return docs.select("doc_id", F.pandas_udf(tasks, "long")("text").alias("fp"), *more)


def _references(n: int, seed: int) -> list[int]:
    return [int(x) for x in np.random.default_rng(seed).integers(-(1 << 63), (1 << 63) - 1, n)]


def _distance(ref: int, mask: int = -1) -> Column:
    return F.bit_count(F.col("fp").bitwiseXOR(F.lit(ref)).bitwiseAND(F.lit(mask)))


def _segments(n: int) -> list[int]:
    """Masks that split 64 bits into n runs, as signed longs."""
    edge = [round(i * 64 / n) for i in range(n + 1)]
    bits = [((1 << (b - a)) - 1) << a for a, b in zip(edge, edge[1:])]
    return [x - (1 << 64) if x >> 63 else x for x in bits]


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b), a < b, of the distinct fingerprints ``fp`` that differ in
    at most ``max_bits`` bits; each pair may come more than once.

    Two tables of distances are computed for each fingerprint.  Over all 64
    bits, by the triangle inequality, the distances of a linked pair to any
    reference differ by at most ``max_bits``: larger differences discard the
    pair.  Within a segment of bits where a pair agrees, its distances to
    every reference are equal.  Of ``max_bits + 3`` segments a linked pair
    agrees in at least 3, so the distances of some 3 segments, taken
    together, are a join key that no linked pair misses.  The survivors are
    verified on the bits.  The checks are part of the join, so only links
    leave it, and each fingerprint has a bounded number of those, even in a
    group of thousands of near copies.
    """
    segments = _segments(max_bits + 3)
    wide = [_distance(r).cast("byte").alias(f"d{j}") for j, r in enumerate(_references(WIDE, 1))]
    narrow = [F.xxhash64(*[_distance(r, m) for r in _references(NARROW, 2 + s)]).alias(f"s{s}")
              for s, m in enumerate(segments)]
    t = fps.select("fp", *wide, *narrow)
    keys = F.array(*[F.xxhash64(F.lit(i), *[f"s{s}" for s in three])
                     for i, three in enumerate(combinations(range(len(segments)), 3))])
    t = t.select("fp", *[f"d{j}" for j in range(WIDE)], F.explode(keys).alias("key"))
    a, b = t.alias("a"), t.alias("b")
    near = reduce(and_, [F.abs(F.col(f"a.d{j}") - F.col(f"b.d{j}")) <= max_bits for j in range(WIDE)])
    verified = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits
    on = (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp")) & near & verified
    return a.join(b, on).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))


def _grouped(rows: DataFrame, max_bits: int) -> DataFrame:
    """``rows`` (doc_id, fp, ...) with the fingerprint that names their group,
    ``root``, and the group's smallest doc_id, ``component_id``."""
    classes = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(classes, max_bits).distinct())
    known = cut(classes.join(roots, classes.fp == roots.node, "left")
                .select("fp", "least", F.coalesce("root", "fp").alias("root")))
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = cut(known.join(least, "root").select(F.col("fp").alias("_fp"), "root", "component_id"))
    return rows.join(known, rows.fp == F.col("_fp")).drop("_fp")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs`` (doc_id, text, ...).

    Fingerprints link at ``max_bits`` or fewer differing bits; component_id
    is the smallest doc_id reachable by links, itself included.  Equal
    fingerprints are one vertex, so groups of copies cost one row.  Empty
    and null texts share fingerprint 0 and link like any other; repeated
    rows come as often as they are; null ids never are the smallest.
    """
    return _grouped(cut(with_fingerprint(docs, shingle)), max_bits).select("doc_id", "fp", "component_id")


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group, in the columns of ``docs``: the one with the
    smallest doc_id, of those the one with the smallest text hash, and of
    equal rows one.  A row without an id stays only if its group has no id.
    Rows are told apart by id and text, so groups may share an id."""
    # Two hashes of the text: rows that agree in them and the id are copies.
    text = F.struct(F.xxhash64("text").alias("t"), F.xxhash64(F.lit("text"), "text").alias("u"))
    rows = cut(with_fingerprint(docs, shingle, text.alias("text")))
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text")
    i, t, u, whole = apart(docs, "_id", "_t", "_u", "_text")
    kept = cut(_grouped(rows, max_bits).groupBy("root").agg(F.min(first).alias("k")).select(
        F.col("k.doc_id").alias(i), F.col("k.text.t").alias(t), F.col("k.text.u").alias(u)))
    same = F.col("doc_id").eqNullSafe(F.col(i)) & (text["t"] == F.col(t)) & (text["u"] == F.col(u))
    out = docs.join(kept, same, "left_semi")
    twice = rows.groupBy("doc_id", "text").count().filter("count > 1")
    if twice.isEmpty():
        return out
    # Of rows equal in id and text, the first by a hash of all columns.
    one = F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("row")
    return out.groupBy(F.col("doc_id").alias(i), text.alias(whole)).agg(one).select("row.*")


ship(__name__)
