"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import apart, cut, land, ship, small, unit_hash

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
GROUP = 1024
# What stands between words; fixed by the contract.
GAP = r"[\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, source_size, n_rows, rank, target) from (source, source_size, n_rows).

    Sources in code-point order, null last, take the weights in turn and
    share the sum of all sizes.  A target stops at ``max_copies`` times its
    source's size and the excess goes to the rest by weight: there is one
    level per unit of weight at which everything is shared, and it follows
    from running sums over the sources in order of cap per weight.  One row
    a source; no document passes here.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights)).cast("int") + 1)
    cap = F.col("source_size") * F.lit(float(max_copies))
    d = ranked.withColumn("w", w).withColumn("cap", cap).withColumn("_r", F.col("cap") / F.col("w"))
    whole = Window.partitionBy()
    before = Window.orderBy("_r", "rank").rowsBetween(Window.unboundedPreceding, -1)
    d = (d.withColumn("_total", F.sum("source_size").over(whole).cast("double"))
         .withColumn("_left", F.col("_total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
         .withColumn("_w", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
         .withColumn("_level", F.col("_left") / F.col("_w")))
    # The first source, by cap per weight, that stays below its cap sets the level.
    level = F.min(F.when(F.col("_level") <= F.col("_r"), F.struct("_r", "rank", "_level"))).over(whole)["_level"]
    return d.withColumn("target", F.least("cap", F.coalesce(level * F.col("w"), F.col("cap")))).select(
        "source", "source_size", "n_rows", "rank", "target")


def pivot(sizes: np.ndarray, p: np.ndarray, draw) -> np.ndarray:
    """Round copy probabilities, largest row first; one may stay fractional.

    Mass is size times probability.  A row is paired with what is still
    fractional of the smaller ones, and mass goes from one side to the other
    until the row is 0 or 1 or one of the others is.  The sum of all mass
    stays as it is.  The direction is drawn so that each probability keeps
    its mean: the others share a transfer by p (1 - p), alike in either
    direction.  Taking the rest together leaves a small row at the end,
    where pairs of two rows would leave a large one.
    """
    p = p.copy()
    for i in range(len(p)):
        while 0.0 < p[i] < 1.0:
            q = p[i + 1:]
            share = q * (1 - q)
            room = float(share @ sizes[i + 1:])
            if room <= 0:
                return p
            some = q[(q > 0) & (q < 1)]
            up = min(sizes[i] * (1 - p[i]), room / (1 - some.min()))
            down = min(sizes[i] * p[i], room / some.max())
            moved = up if draw() * (up + down) < down else -down
            p[i] += moved / sizes[i]
            q -= moved / room * share
            near = p[i:]
            near[near < 1e-9] = 0.0
            near[near > 1 - 1e-9] = 1.0
    return p


def _round_group(rows: pa.Table, salt: int) -> pa.Table:
    """One group of one source; its draws are seeded by its rows."""
    size, key = rows["size"].to_numpy().astype(float), rows["key"].to_numpy()
    order = np.lexsort((key, -size))
    draw = np.random.default_rng([salt, *np.unique(key).view(np.uint64)[:4].tolist(), len(key)]).random
    p = np.empty(len(size))
    p[order] = pivot(size[order], rows["p"].to_numpy()[order], draw)
    return rows.set_column(rows.column_names.index("p"), "p", pa.array(p))


def _rounder(salt: int, cols: list[str]):
    return lambda rows: _round_group(rows, salt).select(cols)


def mix(docs: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES, group: int = GROUP,
        carry: list[str] | None = None) -> DataFrame:
    """(carry..., size, source_size, target, copies, taken) for every row.

    ``carry`` names the columns of ``docs`` to keep (default: all but text);
    their values are passed through.

    Each row of a source is taken floor(target / source size) times and once
    more with the remaining probability, which is rounded within random
    groups of about ``group`` rows; the at most one fractional row of each
    group goes up to the next level of the tree, until a source has one.
    That one is drawn.  So a source misses its target by less than one
    document.  A hot source only has more groups.

    Draws hash the row's id and text, so reruns agree.  Null texts and texts
    without words have size 0 and are copies of nothing; a null source is a
    source; repeated rows are rounded one by one,
    many of them in several groups.
    """
    carry = [c for c in docs.columns if c != "text"] if carry is None else carry
    own = [f"c{i}" for i in range(len(carry))]
    d = docs.select(*[F.col(c).alias(o) for c, o in zip(carry, own)], "source",
                    F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(F.array_remove(F.split("text", GAP), ""))).cast("long").alias("size"),
                    F.xxhash64("doc_id", "text").alias("key"), F.monotonically_increasing_id().alias("place"))
    d = cut(d)
    # Rows that repeat more often than a group is large are dealt into parts, an
    # eighth of a group each; they are alike, so it doesn't matter which is in which.
    many = cut(d.groupBy("key").count().filter(F.col("count") > group).select(
        F.col("key").alias("many"), F.ceil(8 * F.col("count") / group).alias("parts")))
    d = d.join(small(many), F.col("key") == F.col("many"), "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64("place"), F.col("parts")), F.lit(0))).drop("place", "many", "parts")
    targets = cut(source_targets(d.groupBy("source").agg(F.sum("size").alias("source_size"),
                                                         F.count(F.lit(1)).alias("n_rows")), weights, max_copies))
    t = small(targets.withColumnRenamed("source", "_source"))
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"),
                                                    F.lit(float(max_copies)))).otherwise(F.lit(0.0))
    cols = [*own, "size", "source_size", "target", "base", "p", "key", "part", "rank", "n_rows"]
    d = (d.join(t, F.col("source").eqNullSafe(F.col("_source"))).withColumn("rate", rate)
         .withColumn("base", F.floor("rate")).withColumn("p", F.col("rate") - F.col("base")).select(*cols))
    is_open = (F.col("p") > 0) & (F.col("p") < 1) & (F.col("size") > 0)
    done, rest = [d.filter(~is_open).withColumn("p", F.when(F.col("size") > 0, F.col("p")).otherwise(0.0))], d.filter(is_open)
    most = targets.agg(F.max("n_rows")).first()[0] or 0
    salt = 0
    while most > 1:
        salt += 1
        most = -(-most // group)
        groups = F.ceil(F.col("n_rows") / F.lit(float(group) ** salt)).cast("long")
        keyed = rest.withColumn("_g", F.pmod(F.xxhash64("key", "part", F.lit(salt)), groups))
        rounded = cut(keyed.groupBy("rank", "_g").applyInArrow(_rounder(salt, cols), rest.schema))
        done.append(rounded.filter(~is_open))
        rest = rounded.filter(is_open)
    done.append(rest.withColumn("p", F.when(unit_hash(F.col("key"), F.lit(-1)) < F.col("p"), 1.0).otherwise(0.0)))
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    copies = (F.col("base") + F.col("p")).cast("int")
    return out.select(*[F.col(o).alias(c) for o, c in zip(own, carry)], "size", "source_size", "target",
                      copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"))


def take_mix(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, in the
    same columns.  Rows without words carry nothing and are left out.

    The rows are written once with a number each, so that repeated rows stay
    apart and the texts need not travel through the rounding.
    """
    row, copies = apart(docs, "_row", "_copies")
    numbered = land(docs.withColumn(row, F.monotonically_increasing_id()), "mix")
    taken = mix(numbered, carry=[row], **how).filter(F.col("taken") > 0)
    return (numbered.join(taken.select(row, F.col("copies").alias(copies)), row)
            .select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(copies))).alias(copies)).select(*docs.columns))


ship(__name__)
