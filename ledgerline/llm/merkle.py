"""Merkle manifest of a dataset with nested-interval labels.

Every node carries the interval of leaf ranks that it covers: a leaf [r, r], a
parent from its first child's low end to its last child's high end, a source's
tree the ranks of its rows, the root all ranks.  A is an ancestor of B where
A's interval contains B's.  So ancestors are attached by containment joins,
and what is left of a parent's interval without the child's are the siblings.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, land, numbered, small

FAN = 3
# Levels in a band.  Joins go from band to band: the nodes of a band are
# bucketed by their node of the next band, which covers at most WIDTH of them.
DEPTH = 5
WIDTH = FAN ** DEPTH


def _field(c: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and value."""
    s = c.cast("string")
    return F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[_field(v) for v in values]), 256)


def row_leaf(text: Column) -> Column:
    """The leaf of a ``documents`` row that holds ``text``."""
    return leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)


def _joined(nodes: Column) -> Column:
    return F.array_join(F.transform(nodes, lambda x: x["digest"]), "")


def _parents(nodes: Column) -> Column:
    """One level up: every FAN consecutive nodes become one."""
    def parent(i: Column) -> Column:
        run = F.slice(nodes, i * FAN + 1, FAN)
        return F.struct(F.get(run, F.lit(0))["lo"].alias("lo"), F.element_at(run, -1)["hi"].alias("hi"),
                        F.sha2(_joined(run), 256).alias("digest"))
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FAN).cast("int")), parent)


def _built(d: Column | int, band: int, n: Column) -> Column:
    """Whether a tree of ``n`` leaves has a level ``d`` (1 or more) of ``band``."""
    return F.lit(float(FAN)) ** (d + F.lit(DEPTH * band - 1)) < n


def _levels(nodes: Column, band: int, n: Column) -> Column:
    """The levels over the nodes of one bucket, as (lo, hi, digest), from the
    nodes themselves up.  A level is built while the tree has more than one
    node; beyond that the list repeats the last."""
    bare = F.transform(nodes, lambda x: F.struct(x["lo"].alias("lo"), x["hi"].alias("hi"), x["digest"].alias("digest")))
    return F.aggregate(F.sequence(F.lit(1), F.lit(DEPTH)), F.array(bare), lambda acc, d: F.concat(acc, F.array(
        F.when(_built(d, band, n), _parents(F.element_at(acc, -1))).otherwise(F.element_at(acc, -1)))))


def _path(levels: Column, node: Column, at: Column, band: int, n: Column) -> Column:
    """Siblings (left, right) of a node and of its ancestors in the bucket,
    from below: at each level the children of the parent, without the one
    whose interval contains the node's."""
    def step(d: Column) -> Column:
        run = F.slice(F.get(levels, d - 1), (F.floor(at / F.lit(float(FAN)) ** d) * FAN + 1).cast("int"), FAN)
        return F.struct(_joined(F.filter(run, lambda x: x["hi"] < node["lo"])).alias("left"),
                        _joined(F.filter(run, lambda x: x["lo"] > node["hi"])).alias("right"))
    return F.transform(F.filter(F.sequence(F.lit(1), F.lit(DEPTH)), lambda d: _built(d, band, n)), step)


NO_PATH = "cast(array() as array<struct<left: string, right: string>>)"


def _climb(nodes: DataFrame, most: int) -> tuple[list[DataFrame], DataFrame]:
    """From ``nodes`` (tree, pos, lo, hi, digest, n, carry), the n leaves of
    each tree with ``most`` in the largest, up to one node a tree: the buckets
    of each band, and the tops.

    Each band is one grouping on (tree, bucket); a bucket holds at most WIDTH
    nodes, so a tree with a third of all leaves is spread like the others, and
    the next band is WIDTH times smaller.
    """
    buckets: list[DataFrame] = []
    while True:
        b = cut(nodes.groupBy("tree", F.floor(F.col("pos") / WIDTH).alias("pos")).agg(
            F.sort_array(F.collect_list(F.struct("lo", "hi", "digest", "carry"))).alias("nodes"), F.max("n").alias("n")))
        top = F.get(F.element_at(_levels(F.col("nodes"), len(buckets), F.col("n")), -1), F.lit(0)).alias("top")
        nodes = b.select("tree", "pos", top, "n").select(
            "tree", "pos", "top.lo", "top.hi", "top.digest", "n", F.lit(None).cast("int").alias("carry"))
        buckets.append(b)
        if most <= WIDTH ** len(buckets):
            return buckets, cut(nodes)


def _descend(buckets: list[DataFrame], above: DataFrame) -> DataFrame:
    """Attach to the nodes of the lowest band the siblings up to the tops.

    ``above``: (tree, pos, lo, hi, path, subroot, root) of the tops.  Band by
    band, from the top, a bucket joins the node above that contains it.
    """
    n = F.col("n")

    def with_paths(band: int) -> Callable[[Column], Column]:
        return lambda levels: F.transform(F.col("nodes"), lambda x, i: F.struct(
            (F.col("pos") * WIDTH + i).alias("pos"), x["lo"].alias("lo"), x["hi"].alias("hi"), x["digest"].alias("digest"),
            x["carry"].alias("carry"), F.concat(_path(levels, x, i, band, n), F.col("path")).alias("path")))

    for band in range(len(buckets) - 1, -1, -1):
        first, last = F.get(F.col("nodes"), F.lit(0))["lo"], F.element_at("nodes", -1)["hi"]
        held = buckets[band].join(
            above.withColumnsRenamed({"tree": "a_tree", "pos": "a_pos"}),
            (F.col("tree") == F.col("a_tree")) & (F.col("pos") == F.col("a_pos")) & (F.col("lo") <= first) & (last <= F.col("hi")))
        # The array of one makes a bucket's levels once for all its nodes.
        rows = F.get(F.transform(F.array(_levels(F.col("nodes"), band, n)), with_paths(band)), F.lit(0))
        above = held.select("tree", "subroot", "root", F.explode(rows).alias("x")).select(
            "tree", "x.pos", "x.lo", "x.hi", "x.digest", "x.carry", "x.path", "subroot", "root")
        if band:
            above = cut(above)
    return above


@dataclass
class Manifest:
    """``leaves``: (lo, hi, digest, carry, path, subroot, root) of every row;
    path holds the siblings (left, right) level by level up to the root.
    ``nodes``: (tree, level, lo, hi, digest) of every node; tree is the lowest
    rank of its source, null in the tree over the sources; level 0 are its
    leaves."""
    leaves: DataFrame
    nodes: DataFrame


def _all_nodes(buckets: list[DataFrame], tree: Column) -> DataFrame:
    out = None
    for band, b in enumerate(buckets):
        d = F.col("d")
        rows = b.select(tree.alias("tree"), "n", F.posexplode(_levels(F.col("nodes"), band, F.col("n"))).alias("d", "own")).filter(
            ((d == 0) & (band == 0)) | _built(d, band, F.col("n")))
        if band + 1 < len(buckets):
            rows = rows.filter(d < DEPTH)  # the last level is the next band's first
        rows = rows.select("tree", (d + band * DEPTH).alias("level"), F.inline("own"))
        out = rows if out is None else out.unionByName(rows)
    return out


def build(rows: DataFrame, group: str, order: list[str], leaf: str, carry: list[str]) -> Manifest:
    """The manifest of ``rows``: a tree per value of ``group`` (null first) over
    its rows by ``order`` (nulls first; equal rows by leaf), and a tree over
    these.  ``leaf`` names the column of leaf digests; ``carry`` columns go
    along in ``carry``.
    """
    own = rows.select(group, leaf, F.struct(*carry).alias("carry"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      F.monotonically_increasing_id().alias("_row"))
    # Equal rows may come in any order; by their place, many of them are spread.
    ranked = numbered(own, [F.col(group).asc_nulls_first(), *[F.col(f"_o{i}").asc_nulls_first() for i in range(len(order))],
                            F.col(leaf), F.col("_row")], "_rank")
    trees = cut(ranked.groupBy(F.col(group).alias("_group")).agg(F.min("_rank").alias("tree"), F.count(F.lit(1)).alias("n")))
    nodes = ranked.join(small(trees), ranked[group].eqNullSafe(F.col("_group"))).select(
        "tree", (F.col("_rank") - F.col("tree")).alias("pos"), F.col("_rank").alias("lo"), F.col("_rank").alias("hi"),
        F.col(leaf).alias("digest"), "n", "carry")
    sizes = trees.agg(F.max("n"), F.count(F.lit(1))).first()
    buckets, tops = _climb(nodes, sizes[0] or 1)

    # The tree over the trees, whose leaves are the tops.
    placed = numbered(trees.select("tree", "n"), [F.col("tree")], "_rank")
    upper = placed.join(tops.select("tree", "digest"), "tree").select(
        F.lit(0).alias("tree"), F.col("_rank").alias("pos"), F.col("tree").alias("lo"),
        (F.col("tree") + F.col("n") - 1).alias("hi"), "digest", F.lit(sizes[1]).alias("n"), F.struct("tree").alias("carry"))
    upper_buckets, whole = _climb(upper, sizes[1])
    start = whole.select("tree", "pos", "lo", "hi", F.expr(NO_PATH).alias("path"), F.lit(None).cast("string").alias("subroot"),
                         F.col("digest").alias("root"))
    paths = cut(_descend(upper_buckets, start).select("carry.tree", F.lit(0).cast("long").alias("pos"), "lo", "hi", "path",
                                                      F.col("digest").alias("subroot"), "root"))
    return Manifest(_descend(buckets, paths).drop("tree", "pos"),
                    _all_nodes(buckets, F.col("tree")).unionByName(_all_nodes(upper_buckets, F.lit(None).cast("long"))))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda acc, s: F.sha2(F.concat(s["left"], acc, s["right"]), 256))


def documents_manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, path, folded_root, verified) of every row
    of ``documents``; with ``tampered`` the text that a checker is shown.

    Null values have a form of their own in the leaf; null sources and ids
    come first.  Repeated rows are leaves of their own, next to one another.
    An empty table gives no rows, and columns beyond the five of the contract
    play no part.
    """
    leaf = row_leaf(F.col("text"))
    shown = leaf if tampered is None else row_leaf(tampered)
    rows = land(docs.select("doc_id", "source", leaf.alias("leaf"), shown.alias("shown")), "leaves")
    made = build(rows, "source", ["doc_id"], "leaf", ["doc_id", "shown"]).leaves
    return made.select("carry.doc_id", F.col("digest").alias("leaf"), "subroot", "root", "path",
                       fold(F.col("carry.shown"), F.col("path")).alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root"))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)
