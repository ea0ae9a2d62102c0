"""Weighted rendezvous sharding of stable record keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, small


def _score(key: list[Column], shard: Column, weight: Column) -> Column:
    """-w / ln(u): the largest of these over the shards falls on a shard with
    a chance in proportion to its weight."""
    u = (F.shiftrightunsigned(F.xxhash64(*key, shard), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return -weight / F.log(u)


def _best(key: list[Column], weights: list[float], first: int = 0) -> Column:
    """(score, -shard) of the winning shard; equal scores go to the smaller
    number."""
    shards = F.array(*[F.struct(F.lit(first + i).alias("s"), F.lit(float(w)).alias("w"))
                       for i, w in enumerate(weights)])
    return F.array_max(F.transform(shards, lambda x: F.struct(
        _score(key, x["s"], x["w"]).alias("score"), (-x["s"]).alias("n"))))


def assign_shards(df: DataFrame, key: str, weights: list[float],
                  grown_by: list[float] | None = None) -> DataFrame:
    """Add ``shard``, and ``grown_shard``: the shard if the shards with the
    weights ``grown_by`` were added.

    Only the key and the shards decide.  A shard that is added or removed
    moves just the rows that it wins or had won.  A null key hashes like any
    other value.  Rows with one key share a shard.
    """
    if not weights or min(weights + (grown_by or [])) <= 0:
        raise ValueError("shards need positive weights")
    # The type tag keeps a null key apart from no key at all.
    k = [F.col(key), F.col(key).isNull()]
    out = df.withColumn("_best", _best(k, weights))
    out = out.withColumn("shard", (-F.col("_best.n")).cast("int"))
    if grown_by:
        out = out.withColumn("_more", _best(k, grown_by, first=len(weights)))
        out = out.withColumn("grown_shard", (-F.greatest("_best", "_more").getField("n")).cast("int")).drop("_more")
    return out.drop("_best")


def number_slots(df: DataFrame, shard: str = "shard") -> DataFrame:
    """Add ``slot``: gapless positions from 0 within each shard.

    Rows are numbered within (shard, task that wrote them) and each task's
    range is shifted by the rows of the tasks before it.  No window holds
    more than one task's rows, whatever the keys: a shard or a key with a
    third of all rows is no hot spot.  The rows are materialised first, so
    the numbering survives lost executors.
    """
    d = cut(df.withColumn("_part", F.spark_partition_id())
            .withColumn("_seq", F.monotonically_increasing_id()))
    n = cut(d.groupBy(shard, "_part").count())
    before = Window.partitionBy(shard).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = n.select(F.col(shard).alias("_s"), F.col("_part").alias("_p"),
                       F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_from"))
    own = Window.partitionBy(shard, "_part").orderBy("_seq")
    d = d.withColumn("_rn", F.row_number().over(own))
    return (d.join(small(cut(offsets)), (d[shard] == F.col("_s")) & (d["_part"] == F.col("_p")))
            .withColumn("slot", (F.col("_from") + F.col("_rn") - 1).cast("long"))
            .drop("_part", "_seq", "_s", "_p", "_from", "_rn"))


def shard_documents(docs: DataFrame, shards: int = 40, weights: list[float] | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row.

    ``size`` is the text's UTF-8 bytes plus 16; a null text counts as empty
    (size 16, crc32 0).  Repeated rows get slots of their own; an empty table
    gives no rows; other columns of the input are ignored.
    """
    w = weights or [1.0] * shards
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text).cast("long") + 16).alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    rows = assign_shards(rows, "doc_id", w, grown_by=[1.0])
    return number_slots(rows).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
