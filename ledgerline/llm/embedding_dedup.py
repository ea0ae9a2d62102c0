"""Embedding near-duplicates by NN-descent."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import components, cut, land, ship, unit_hash

COSINE = 0.9
# Length of a neighbour list to begin with; doubled while recall is short.
NEIGHBOURS = 10
# Orders by random hyperplanes that start the graph.
ORDERS = 4
# Vectors compared at once: neighbours in an order, lists of a centre, tiles.
RUN, LOCAL, TILE = 128, 64, 1024
# Rounds of refinement; they stop when less than CHANGED of the entries change.
ROUNDS, CHANGED = 6, 0.01
# Vectors that the audit draws first, at once at most and in all at most, the
# linked ones it wants among them, and the recall at which it is content.
AUDIT, DRAW, DRAWN, LINKED, RECALL = 400, 1 << 13, 1 << 15, 200, 0.97
# Angle of the pieces that components of full lists are cut into, and the
# pieces whose centres are compared at once.
PIECE, CENTRES = 0.2, 8192


@dataclass
class Found:
    """links: (vec_id, n_links, component_id, kept); recall: the audited share
    of a vector's true links that were found, on average over linked vectors."""

    links: DataFrame
    recall: float


def _matrix(column, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _in_runs(batches: Iterator[pa.RecordBatch], most: int, key: Callable | None = None) -> Iterator[pa.Table]:
    """The ordered rows cut into runs of at most ``most``; with ``key``, a run
    also ends where the key changes."""
    left: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        left.append(batch)
        held += len(batch)
        if held < 8 * most:
            continue
        t = pa.Table.from_batches(left)
        left, held = [], 0
        cuts = _cuts(t, most, key)
        for a, b in zip(cuts[:-2], cuts[1:-1]):
            yield t.slice(a, b - a)
        rest = t.slice(cuts[-2])
        left, held = rest.to_batches(), len(rest)
    if held:
        t = pa.Table.from_batches(left)
        cuts = _cuts(t, most, key)
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield t.slice(a, b - a)


def _cuts(t: pa.Table, most: int, key: Callable | None) -> list[int]:
    if key is None:
        return [*range(0, len(t), most), len(t)]
    k = key(t)
    change = np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1
    out = [0]
    for e in [*change.tolist(), len(t)]:
        out += [*range(out[-1] + most, e, most), e]
    return out


def _top(pairs: DataFrame, k: int) -> DataFrame:
    """The k most similar v of each u."""
    best = pairs.groupBy("u", "v").agg(F.max("s").alias("s"), F.min("new").alias("new"))
    own = Window.partitionBy("u").orderBy(F.col("s").desc(), "v")
    return best.withColumn("_k", F.row_number().over(own)).filter(F.col("_k") <= k).drop("_k")


_PAIR = "u long, v long, s float, new boolean"


def _pairs(ids: np.ndarray, s: np.ndarray, i: np.ndarray, j: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"u": pa.array(ids[i], pa.int64()), "v": pa.array(ids[j], pa.int64()),
                                       "s": pa.array(s[i, j], pa.float32()), "new": pa.array(np.ones(len(i), bool))})


def _start(vecs: DataFrame, dim: int, k: int, orders: range, partitions: int) -> DataFrame:
    """Neighbour lists from some random orders: vectors are sorted by the side
    of 62 random hyperplanes on which they lie, the first ones first, and
    each is compared with those of its run."""
    found = None
    for order in orders:
        planes = np.random.default_rng(order + 17).normal(size=(dim, 62)).astype(np.float32)

        def code(batches: Iterator[pa.RecordBatch], planes=planes) -> Iterator[pa.RecordBatch]:
            for b in batches:
                side = (_matrix(b["x"], dim) @ planes > 0).astype(np.int64) @ (1 << np.arange(61, -1, -1, dtype=np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(side, pa.int64()), b["id"], b["x"]], ["code", "id", "x"])

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for t in _in_runs(batches, RUN):
                x, ids = _unit(_matrix(t["x"], dim)).astype(np.float32), t["id"].to_numpy()
                s = x @ x.T
                np.fill_diagonal(s, -2)
                most = min(k, len(ids) - 1)
                if most > 0:
                    j = np.argpartition(-s, most - 1, axis=1)[:, :most].ravel()
                    yield _pairs(ids, s, np.repeat(np.arange(len(ids)), most), j)

        coded = vecs.select("id", "x").mapInArrow(code, "code long, id long, x array<float>")
        runs = coded.repartitionByRange(partitions, "code", "id").sortWithinPartitions("code", "id")
        own = runs.select("id", "x").mapInArrow(compare, _PAIR)
        found = own if found is None else found.unionByName(own)
    return found


def _refine(vecs: DataFrame, graph: DataFrame, dim: int, k: int, salt: int) -> tuple[DataFrame, int]:
    """One round: the neighbours of a centre, in either direction, are compared
    with one another; pairs that both were neighbours before are not.  A
    centre with many neighbours is dealt into groups of LOCAL, anew in each
    round, so none of them is dropped and no task gets a hub whole.  Only
    pairs that improve one of the two lists come back."""
    both = graph.select(F.col("u").alias("w"), "v", "new").union(graph.select(F.col("v"), F.col("u"), "new"))
    both = both.groupBy("w", "v").agg(F.max("new").alias("new"))
    deal = Window.partitionBy("w").orderBy(F.xxhash64("v", F.lit(salt)), "v")
    both = both.withColumn("g", F.floor((F.row_number().over(deal) - 1) / LOCAL).cast("int"))
    worst = graph.groupBy("u").agg(F.when(F.count(F.lit(1)) < k, F.lit(-2.0)).otherwise(F.min("s")).cast("float").alias("worst"))
    known = vecs.select("id", "x").join(worst, F.col("id") == F.col("u"), "left").select(
        "id", "x", F.coalesce("worst", F.lit(-2.0)).cast("float").alias("worst"))
    rows = both.join(known, F.col("v") == F.col("id")).select("w", "g", "id", "new", "worst", "x")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = lambda t: np.stack([t["w"].to_numpy(), t["g"].to_numpy()], 1)
        got: list[tuple[np.ndarray, ...]] = []
        held = 0
        for t in _in_runs(batches, LOCAL, key):
            new = t["new"].to_numpy()
            if len(t) < 2 or not new.any():
                continue
            ids, worst = t["id"].to_numpy(), t["worst"].to_numpy()
            x = _unit(_matrix(t["x"], dim)).astype(np.float32)
            s = x @ x.T
            np.fill_diagonal(s, -2)
            i, j = np.nonzero((s > worst[:, None]) & (new[:, None] | new[None]))
            got.append((ids[i], ids[j], s[i, j]))
            held += len(i)
            if held > 1 << 16:
                yield _batch(got)
                got, held = [], 0
        if got:
            yield _batch(got)

    better = (rows.repartition("w", "g").sortWithinPartitions("w", "g").select("w", "g", "id", "new", "worst", "x")
              .mapInArrow(compare, _PAIR))
    old = graph.withColumn("new", F.lit(False))
    after = cut(_top(better.unionByName(old), k))
    return after, after.filter("new").count()


def _batch(got: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    u, v, s = (np.concatenate([g[k] for g in got]) for k in range(3))
    return pa.RecordBatch.from_pydict({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64()),
                                       "s": pa.array(s, pa.float32()), "new": pa.array(np.ones(len(u), bool))})


def _verified(vecs: DataFrame, pairs: DataFrame, dim: int, least: float) -> DataFrame:
    """The pairs (a, b) whose cosine, in double precision, is enough."""
    left = vecs.select(F.col("id").alias("a"), F.col("x").alias("xa"))
    right = vecs.select(F.col("id").alias("b"), F.col("x").alias("xb"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            if len(t):
                c = np.einsum("ij,ij->i", _unit(_matrix(t["xa"], dim)), _unit(_matrix(t["xb"], dim)))
                yield t.select(["a", "b"]).filter(pa.array(c >= least))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "xa", "xb").mapInArrow(check, "a long, b long")


def _dealt(rows: DataFrame) -> DataFrame:
    """``rows`` (id, n, ...) dealt into n tiles and sent to every pair (p, q) of
    tiles, p <= q, that theirs is in; ``first``: theirs is p."""
    rows = rows.withColumn("i", F.pmod(F.xxhash64("id"), F.col("n")).cast("int")).withColumn("j", F.explode(F.expr("sequence(0, n - 1)")))
    return rows.withColumns({"p": F.least("i", "j"), "q": F.greatest("i", "j"), "first": F.col("i") <= F.col("j")}).drop("i", "j", "n")


def _within(vecs: DataFrame, groups: DataFrame, dim: int, least: float) -> DataFrame:
    """(id, links) of the vectors of the components ``groups`` (id, root): the
    rows, counted with their copies, of their component that link with them.

    Members are dealt into tiles, and pairs of tiles are compared in tasks of
    their own that return one count a row.
    """
    tiles = groups.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("n"))
    g = _dealt(groups.join(tiles, "root")).join(vecs, "id").select("root", "p", "q", "first", "id", "m", "x")

    def count(t: pa.Table) -> pa.Table:
        x, m, ids = _unit(_matrix(t["x"], dim)), t["m"].to_numpy(), t["id"].to_numpy()
        first = t["first"].to_numpy()
        same = t["p"][0].as_py() == t["q"][0].as_py()
        a = np.flatnonzero(first)
        b = a if same else np.flatnonzero(~first)
        near = x[a] @ x[b].T >= least
        if same:
            np.fill_diagonal(near, False)
            own, n = ids[a], near @ m[b]
        else:
            own, n = np.concatenate([ids[a], ids[b]]), np.concatenate([near @ m[b], m[a] @ near])
        return pa.table({"id": pa.array(own, pa.int64()), "links": pa.array(n, pa.int64())})

    counts = g.groupBy("root", "p", "q").applyInArrow(count, "id long, links long")
    return counts.groupBy("id").agg(F.sum("links").alias("links"))


def _pieces(vecs: DataFrame, groups: DataFrame, dim: int) -> DataFrame:
    """(id, root, piece, r, x): the vectors of ``groups`` (id, root) cut into
    pieces of one component.  A piece is named by the id of its centre; r is
    its radius, at most PIECE."""
    tiles = groups.groupBy("root").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("n"))
    g = groups.join(tiles, "root").withColumn("i", F.pmod(F.xxhash64("id"), F.col("n"))).join(vecs, "id").select("root", "i", "id", "x")

    def gather(t: pa.Table) -> pa.Table:
        x, ids = _unit(_matrix(t["x"], dim)), t["id"].to_numpy()
        piece, r, left = np.zeros(len(ids), np.int64), np.zeros(len(ids)), np.arange(len(ids))
        while len(left):
            c = np.clip(x[left] @ x[left[0]], -1, 1)
            own = c >= np.cos(PIECE)
            own[0] = True
            piece[left[own]], r[left[own]] = ids[left[0]], np.arccos(c[own].min())
            left = left[~own]
        return pa.table({"id": t["id"], "root": t["root"], "piece": pa.array(piece), "r": pa.array(r), "x": t["x"]})

    return g.groupBy("root", "i").applyInArrow(gather, "id long, root long, piece long, r double, x array<float>")


def _across(vecs: DataFrame, groups: DataFrame, dim: int, least: float) -> DataFrame | None:
    """Pairs (a, b) of roots whose vectors in ``groups`` (id, root) link, found
    without neighbour lists: enough of them to connect all that link.

    By the triangle inequality, pieces can only link if the angle of their
    centres is at most that of ``least`` and their radii; all centres are
    compared in tiles.  Linked centres connect their roots; where no such pair
    connects two roots, the pieces that may link are compared whole.
    """
    pieces = land(_pieces(vecs, groups, dim), "pieces")
    centres = pieces.filter("id = piece").select("id", "root", "r", "x")
    n = centres.count()
    if centres.select("root").distinct().count() < 2:
        return None
    reach = float(np.arccos(least))

    def near(t: pa.Table) -> pa.Table:
        x, ids, root, r = _unit(_matrix(t["x"], dim)), t["id"].to_numpy(), t["root"].to_numpy(), t["r"].to_numpy()
        first = t["first"].to_numpy(zero_copy_only=False)
        a = np.flatnonzero(first)
        b = a if t["p"][0].as_py() == t["q"][0].as_py() else np.flatnonzero(~first)
        got = [np.zeros((0, 5), np.int64)]
        for at in range(0, len(a), TILE):
            own = a[at:at + TILE]
            c = x[own] @ x[b].T
            far = np.minimum(reach + r[own][:, None] + r[b][None], np.pi)
            i, j = np.nonzero((c >= np.cos(far) - 1e-9) & (root[own][:, None] != root[b][None]))
            pair = np.stack([ids[own[i]], ids[b[j]], root[own[i]], root[b[j]], c[i, j] >= least], 1)
            turned = pair[:, 2] > pair[:, 3]
            pair[turned] = pair[turned][:, [1, 0, 3, 2, 4]]
            # One row of roots whose centres link says all about them.
            pair = pair[np.lexsort((-pair[:, 4], pair[:, 3], pair[:, 2]))]
            new = np.ones(len(pair), bool)
            new[1:] = (pair[1:, 2:4] != pair[:-1, 2:4]).any(1)
            sure = pair[np.flatnonzero(new)][np.cumsum(new) - 1, 4] if len(pair) else pair[:, 4]
            got.append(np.unique(pair[new | (sure == 0)], axis=0))
        found = np.unique(np.concatenate(got), axis=0)
        return pa.table({k: pa.array(np.ascontiguousarray(found[:, i])) for i, k in enumerate(["pa", "pb", "a", "b", "sure"])})

    dealt = _dealt(centres.withColumn("n", F.lit(-(-n // CENTRES)))).select("p", "q", "first", "id", "root", "r", "x")
    found = cut(dealt.groupBy("p", "q").applyInArrow(near, "pa long, pb long, a long, b long, sure long"))
    sure = cut(found.filter("sure = 1").select("a", "b").distinct())
    joined = cut(components(sure))
    top = lambda c: joined.select(F.col("node").alias(c), F.col("root").alias(f"_{c}"))
    open_ = found.filter("sure = 0").join(top("a"), "a", "left").join(top("b"), "b", "left").filter(
        F.coalesce("_a", "a") != F.coalesce("_b", "b")).select("pa", "pb", "a", "b").distinct()
    open_ = cut(open_)
    if open_.isEmpty():
        return sure
    members = pieces.select("piece", "x")
    both = open_.join(members, F.col("pa") == F.col("piece")).withColumn("first", F.lit(True)).unionByName(
        open_.join(members, F.col("pb") == F.col("piece")).withColumn("first", F.lit(False)))

    def link(t: pa.Table) -> pa.Table:
        x, first = _unit(_matrix(t["x"], dim)), t["first"].to_numpy(zero_copy_only=False)
        return t.select(["a", "b"]).slice(0, int((x[first] @ x[~first].T >= least).any()))

    linked = both.groupBy("pa", "pb").applyInArrow(link, "a long, b long")
    return cut(sure.unionByName(linked).distinct())


def _audit(vecs: DataFrame, counts: DataFrame, dim: int, least: float) -> float:
    """The share of its true links that a linked vector has in ``counts``, on
    average: each linked vector weighs the same.

    Vectors are drawn by their hashes and compared with all vectors until
    LINKED of them have a link, or about DRAWN or all are drawn: so the work
    grows with the table, also where hardly a vector has a link.  There the
    share rests on fewer linked vectors: on about DRAWN times their rate, or
    on none (1.0).  A draw is an Arrow table of at most about DRAW vectors and
    goes to the tasks as a broadcast variable.
    """
    spark = vecs.sparkSession
    n, u = max(1, vecs.count()), unit_hash(F.col("id"), F.lit("audit"))
    shares: list[float] = []
    low, size = 0.0, AUDIT
    while low < min(1.0, DRAWN / n) and len(shares) < LINKED:
        high = min(1.0, low + min(size, DRAW) / n)
        drawn = vecs.filter((u >= low) & (u < high)).select("id", "x").toArrow()
        low, size = high, 2 * size
        if not len(drawn):
            continue
        sent = spark.sparkContext.broadcast((drawn["id"].to_numpy(), _unit(_matrix(drawn["x"], dim))))

        def brute(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ids, x = sent.value
            links = np.zeros(len(ids), np.int64)
            for t in batches:
                if len(t):
                    other, own, m = _unit(_matrix(t["x"], dim)).T, t["id"].to_numpy()[None], t["m"].to_numpy()
                    for at in range(0, len(ids), TILE):
                        near = x[at:at + TILE] @ other >= least
                        near &= ids[at:at + TILE, None] != own
                        links[at:at + TILE] += near @ m
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_pydict({"id": pa.array(ids[some], pa.int64()), "links": pa.array(links[some], pa.int64())})

        true = vecs.select("id", "m", "x").mapInArrow(brute, "id long, links long").groupBy("id").agg(F.sum("links").alias("true"))
        both = true.join(counts.select("id", F.col("links").alias("found")), "id", "left").collect()
        shares += [min(1.0, (r["found"] or 0) / r["true"]) for r in both]
        sent.unpersist()
    return float(np.mean(shares)) if shares else 1.0


def _one_length(vecs: DataFrame, dim: int, least: float, k: int) -> tuple[DataFrame, float]:
    """(id, links, root) of the linked vectors of one length, and the recall."""
    n = vecs.count()
    # Few vectors stay together: those of different partitions aren't compared at the start.
    wide = max(vecs.sparkSession.sparkContext.defaultParallelism, -(-n * dim * 4 // (32 << 20)))
    partitions = min(1 + n // (8 * RUN), wide)
    graph, attempt = None, 0
    while True:
        start = _start(vecs, dim, k, range(attempt * ORDERS, (attempt + 1) * ORDERS), partitions)
        graph = cut(_top(start if graph is None else start.unionByName(graph), k))
        for r in range(ROUNDS):
            graph, changed = _refine(vecs, graph, dim, k, 100 * attempt + r)
            if changed <= CHANGED * n * k:
                break
        near = graph.filter(F.col("s") >= least - 1e-3).select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()
        edges = cut(_verified(vecs, near, dim, least))
        roots = cut(components(edges).withColumnRenamed("node", "id"))
        full = graph.filter(F.col("s") >= least - 1e-3).groupBy("u").count().filter(F.col("count") >= k).select(F.col("u").alias("id"))
        # A list full of links may have cut some off.  Those to vectors of other
        # components whose lists are full too are in no list: their components
        # are joined.  Then the lists grow to the whole component.
        full = cut(full.join(roots, "id").select("id", "root"))
        across = _across(vecs, full, dim, least)
        if across is not None:
            joined = components(across).withColumnRenamed("root", "_root")
            roots, full = (cut(d.join(joined, d.root == joined.node, "left").select("id", F.coalesce("_root", "root").alias("root")))
                           for d in (roots, full))
        grown = cut(full.select("root").distinct())
        sides = edges.union(edges.select("b", "a")).toDF("id", "other").join(roots, "id").join(grown, "root", "left_anti")
        plain = sides.join(vecs.select(F.col("id").alias("other"), "m"), "other").groupBy("id").agg(F.sum("m").alias("links"))
        counts = cut(plain.unionByName(_within(vecs, roots.join(grown, "root", "left_semi"), dim, least)))
        recall = _audit(vecs, counts, dim, least)
        if recall >= RECALL:
            return counts.join(roots, "id").select("id", "links", "root"), recall
        if k >= n:
            raise RuntimeError(f"lists of all {n} vectors of length {dim} find only {recall:.3f} of the links")
        attempt, k = attempt + 1, 2 * k


def _valid(x: Column) -> Column:
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(fine & F.exists(x, lambda c: c != 0), F.lit(False))


def near_duplicates(emb: DataFrame, least: float = COSINE, neighbours: int = NEIGHBOURS) -> Found:
    """Links of cosine ``least`` or more among the rows (vec_id, embedding).

    Equal vectors are one vertex with a weight.  A graph of nearest
    neighbours starts from random orders and is refined by joining the
    neighbours of each vector.  Its edges of enough cosine, checked in
    double precision, are links.  Where lists are full of them, components
    that link with one another are joined by an exact search, and the lists
    grow to the whole component.  The recall is audited against brute force
    on a bounded sample, and the graph refined with longer lists while it is short;
    if lists of all vectors don't suffice, that is an error.

    Vectors that are null, empty, zero or hold null or non-finite components
    link with nothing and are their own component; so do vectors of another
    length.  Rows with a null id count as links but are never the smallest
    id.  Repeated rows link with one another.
    """
    rows = emb.select("vec_id", F.col("embedding").cast("array<float>").alias("x"))
    good = F.when(_valid(F.col("x")), F.col("x"))
    classes = rows.withColumn("x", good).filter("x is not null").groupBy("x").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("m"))
    vecs = land(classes.withColumn("id", F.monotonically_increasing_id()), "vectors")
    linked, recalls = None, []
    for (dim,) in sorted(vecs.select(F.size("x")).distinct().collect()):
        own, recall = _one_length(vecs.filter(F.size("x") == dim), dim, least, neighbours)
        recalls.append(recall)
        linked = own if linked is None else linked.unionByName(own)
    known = vecs.select("id", "least", "m", "x")
    if linked is None:
        known = known.withColumn("links", F.lit(0)).withColumn("root", F.col("id"))
    else:
        known = known.join(linked, "id", "left").withColumn("root", F.coalesce("root", "id"))
    known = cut(known.select("x", "root", "least", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).cast("long").alias("n_links")))
    small_id = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(small_id, "root").select(F.col("x").alias("_x"), "n_links", "component_id")
    out = rows.withColumn("x", good).join(known, F.col("x") == F.col("_x"), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("_x").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).cast("long").alias("component_id"))
    return Found(out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))), min(recalls, default=1.0))


ship(__name__)
