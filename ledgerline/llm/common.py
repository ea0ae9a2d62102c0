"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import string
import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.session import ensure_checkpoint_dir, scratch_dir

# A side is broadcast only when it was counted and has at most this many rows.
BROADCAST_ROWS = 200_000


def ship(module: str) -> None:
    """Send the task functions of ``module`` to executors by value, so that
    they need not have this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise a narrow intermediate in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def land(df: DataFrame, name: str) -> DataFrame:
    """Write a table below the shared checkpoint folder and read it back."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a materialised table for broadcast if it has few rows; beyond the
    bound the join stays a shuffle join that AQE may split."""
    return F.broadcast(df) if len(df.limit(rows + 1).select(F.lit(1)).take(rows + 1)) <= rows else df


def apart(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns beside those of ``df``: underscores are put
    before a name that ``df`` has."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else.  Pure ASCII texts take the built-in
    fast path, which is the same there."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, string.ascii_uppercase, string.ascii_lowercase))


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with the gapless rank from 0 by ``order`` as ``name``.

    Rows are sorted into ranges and counted by range; the running sum is over
    one row a range.  The sorted rows are materialised first, so that ranks
    survive lost executors.  ``order`` should be total: equal keys share a
    range.
    """
    own = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33).alias("_part")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = own.groupBy(part).count().select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_from"))
    return own.withColumn("_part", part).join(F.broadcast(cut(starts)), "_part").select(
        *df.columns, (F.col("_from") + F.col("_at").bitwiseAND((1 << 33) - 1)).alias(name))


def unit_hash(*cols: Column) -> Column:
    """A stable fraction in [0, 1) of the given columns."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) / F.lit(float(1 << 53))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the undirected ``edges`` (a, b): (node, root)
    for every node that has an edge.

    Each round every live vertex hooks to the member of its closed
    neighbourhood with the smallest priority, a hash drawn anew per round;
    the edges are then contracted.  Random priorities shrink long chains by a
    constant factor, so the rounds grow with the logarithm of the input.
    Hooks are map-side combined minima, so a hub costs no more than its
    edges.  Nothing is gathered in the driver.
    """
    e = edges.select("a", "b").filter(F.col("a") != F.col("b"))
    e = cut(e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = e.select(F.col("a").alias("node")).distinct().withColumn("root", F.col("node"))
    salt = 0
    while not e.isEmpty():
        salt += 1

        def rank(c: str, salt: int = salt) -> Column:
            return F.struct(F.xxhash64(F.col(c), F.lit(salt)).alias("k"), F.col(c).alias("v"))

        hook = cut(e.groupBy(F.col("a").alias("h")).agg(F.min(rank("b")).alias("m"))
                   .select("h", F.least("m", rank("h")).getField("v").alias("p")))
        labels = cut(labels.join(hook, labels.root == hook.h, "left")
                     .select("node", F.coalesce("p", "root").alias("root")))
        left = e.join(hook, e.a == hook.h).select(F.col("p").alias("a"), "b")
        e = cut(left.join(hook, left.b == hook.h).select("a", F.col("p").alias("b"))
                .filter(F.col("a") != F.col("b")).distinct())
    return labels
