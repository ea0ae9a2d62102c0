"""Benchmark decontamination by a broadcast set of test n-grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import apart, ascii_lower, cut, small

WINDOW = 13
# What stands between the words of a text; fixed by the contract.  With A-Z
# made lower case first, words are runs of [^\x00-\x2F\x3A-\x60\x7B-\x7F].
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words in order.  One split of the text: collecting or counting the
    matches of a pattern copies the text for each match."""
    return F.array_remove(F.split(ascii_lower(text), GAP), "")


def _gram(ws: Column, at: Column, n: Column | int) -> Column:
    """n words from the 0-based position ``at``, joined by one space."""
    return F.array_join(F.slice(ws, at + 1, n), " ")


def benchmark_windows(bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, n, gram): every run of ``window`` words of an item; an item
    of fewer words, but not none, is one window.  n is the words in it."""
    w = bench.select("item_id", words(F.col("text")).alias("ws"))
    n = F.least(F.size("ws"), F.lit(window))
    w = w.filter(F.size("ws") > 0).select("item_id", "ws", n.alias("n"))
    return w.withColumn("at", F.explode(F.expr("sequence(0, size(ws) - n)"))).select(
        "item_id", "n", _gram(F.col("ws"), F.col("at"), F.col("n")).alias("gram")).distinct()


def _row_key() -> list[Column]:
    """Rows are told apart by id and text, so ids need not be unique."""
    return [F.col("doc_id").alias("id"), F.xxhash64("text").alias("tkey")]


def hits(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """(id, tkey, at, n, item_id): every occurrence of a window in a text.

    A run of n words holds, wherever it starts, one whole block of
    b = (n + 1) // 2 words whose position is a multiple of b.  So all blocks
    of b words of the windows form the hash set, and of a document only each
    b-th position is looked up: a small part of its windows, and no
    occurrence is missed.  Around the blocks that are found, the windows
    themselves are cut out and compared word by word.
    """
    windows = cut(windows)
    lengths = sorted(r[0] for r in windows.select("n").distinct().collect())  # at most WINDOW values
    found = None
    for n in lengths:
        b = (n + 1) // 2
        mine = windows.filter(F.col("n") == n).select("item_id", "gram")
        blocks = cut(mine.select(F.split("gram", " ").alias("ws")).select(
            F.explode(F.expr(f"transform(sequence(0, {n - b}), i -> xxhash64(array_join(slice(ws, i + 1, {b}), ' ')))"))
            .alias("block")).distinct())
        w = docs.select(*_row_key(), words(F.col("text")).alias("ws")).filter(F.size("ws") >= n)
        # Position and hash of each b-th block.
        looked = w.select("id", "tkey", F.posexplode(F.expr(
            f"transform(sequence(0, (size(ws) - {b}) div {b}), i -> xxhash64(array_join(slice(ws, i * {b} + 1, {b}), ' ')))"))
            .alias("i", "block"))
        near = cut(looked.join(small(blocks), "block").groupBy("id", "tkey").agg(
            F.collect_set((F.col("i") * b).cast("int")).alias("seen")))
        starts = F.array_distinct(F.flatten(F.transform("seen", lambda p: F.sequence(
            F.greatest(p - (n - b), F.lit(0)), p))))
        k = near.select(F.col("id").alias("_id"), F.col("tkey").alias("_tkey"), starts.alias("starts"))
        texts = docs.select(*_row_key(), "text").join(
            k, F.col("id").eqNullSafe(F.col("_id")) & F.col("tkey").eqNullSafe(F.col("_tkey")))
        cand = texts.select("id", "tkey", words(F.col("text")).alias("ws"), "starts")
        cand = cand.select("id", "tkey", "ws", F.explode("starts").alias("at")).filter(F.col("at") <= F.size("ws") - n)
        cand = cand.select("id", "tkey", "at", _gram(F.col("ws"), F.col("at"), n).alias("gram"))
        # Repeated rows would bring each occurrence again.
        got = cand.join(small(cut(mine)), "gram").select("id", "tkey", "at", F.lit(n).alias("n"), "item_id")
        found = got if found is None else found.unionByName(got)
    return found


def _covered() -> Column:
    """Words inside the runs (at, n) of the sorted set ``runs``."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("sum"))
    return F.aggregate(
        F.array_sort("runs"), start,
        lambda acc, r: F.struct(
            F.greatest(acc["end"], r["at"] + r["n"]).alias("end"),
            (acc["sum"] + F.greatest(r["at"] + r["n"] - F.greatest(acc["end"], r["at"]), F.lit(0))).alias("sum")),
        lambda acc: acc["sum"])


def contamination(docs: DataFrame, bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, tkey, n_words, n_hit, n_items, items_sha256, contaminated, spans)
    for every row of ``docs``; spans are the hit runs (at, n) in words.

    A row is contaminated if words are hit and they are at least a twentieth
    of its words.  Null and empty texts have no words and no hits; an empty
    benchmark hits nothing; repeated rows all get their result; null ids are
    matched like others.  A repeated benchmark item counts by its id.
    """
    item = benchmark_windows(bench, window)
    d = docs.select("doc_id", F.xxhash64("text").alias("tkey"),
                    F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(words(F.col("text")))).cast("long").alias("n_words"))
    found = hits(docs, item)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "id long, tkey long, at int, n int, item_id long")
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    found = cut(found)
    spans = found.select("id", "tkey", "at", "n").distinct().groupBy("id", "tkey").agg(
        F.collect_set(F.struct("at", "n")).alias("runs"))
    items = found.select("id", "tkey", "item_id").distinct().groupBy("id", "tkey").agg(
        F.collect_set("item_id").alias("items"))
    per = cut(spans.select("id", "tkey", _covered().alias("n_hit"), F.array_sort("runs").alias("spans"))
              .withColumnRenamed("id", "_id").withColumnRenamed("tkey", "_tkey")
              .join(items, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_tkey") == F.col("tkey")))
              .select("_id", "_tkey", "n_hit", "spans", F.size("items").cast("long").alias("n_items"),
                      F.sha2(ids, 256).alias("items_sha256")))
    out = d.join(per, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tkey") == F.col("_tkey")), "left")
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select("doc_id", "tkey", "n_words", hit.alias("n_hit"),
                      F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                      F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
                      ((hit > 0) & (hit * 20 >= F.col("n_words"))).alias("contaminated"), "spans")


def remove_contaminated(docs: DataFrame, bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, in its columns."""
    i, t = apart(docs, "_id", "_tkey")
    bad = contamination(docs, bench, window).filter("contaminated").select(
        F.col("doc_id").alias(i), F.col("tkey").alias(t)).distinct()
    return docs.join(small(cut(bad)), F.col("doc_id").eqNullSafe(F.col(i)) & (F.xxhash64("text") == F.col(t)), "left_anti")


def remove_spans(docs: DataFrame, bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text) of the rows with hits, with each hit word cut out and
    what is left joined as it was; the other rows as they are."""
    found = contamination(docs, bench, window).filter("n_hit > 0").select(
        F.col("doc_id").alias("_id"), F.col("tkey").alias("_tkey"), "spans").dropDuplicates(["_id", "_tkey"])
    d = docs.select("doc_id", "text").join(
        small(cut(found)), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_tkey")), "left")
    # The text as gap, word, gap, word, ..., gap.
    any_word, gap = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    gaps, ws = F.split("text", any_word), F.array_remove(F.split("text", gap), "")
    hit = F.flatten(F.transform("spans", lambda s: F.sequence(s["at"], s["at"] + s["n"] - 1)))
    parts = F.transform("gaps", lambda g, i: F.concat(g, F.when(
        (i < F.size("ws")) & ~F.array_contains("hit", i.cast("int")), F.element_at("ws", i + 1)).otherwise("")))
    cutout = d.withColumns({"gaps": gaps, "ws": ws, "hit": hit}).withColumn("new", F.array_join(parts, ""))
    return cutout.select("doc_id", F.when(F.col("spans").isNull(), F.col("text")).otherwise(F.col("new")).alias("text"))
