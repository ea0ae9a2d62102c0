"""Toxicity: a convolutional network over hashed word embeddings in numpy."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, ship, small

# One in this many labelled rows calibrates and is not fitted.
CALIBRATE = 4
# Labelled rows of a fit task (expected number).  More rows make more tasks.
TASK_ROWS = 8192
# All tasks fit from the same network, on all of their rows; their networks
# are averaged, and the next round goes on from there.
ROUNDS = 3
# Passes over the rows: about so many texts are fitted in all, each at least
# once a round and at most MOST_EPOCHS times.
FIT_TEXTS, MOST_EPOCHS = 90_000, 18
# Pieces in which the networks' parameters are averaged.
PIECES = 32
# Steps of the scores that the calibration tells apart.
STEPS = 10_000
# A word's embedding is the sum of rows of one table: two hashes of the word,
# so that hardly another shares both, and those of its beginnings, which the
# forms of a word have in common.
ROWS, DIM, PREFIXES = 1 << 15, 8, (4, 6)
WIDTHS, FILTERS, HIDDEN = (1, 2, 3), 8, 8
# The largest and second largest response of each filter are kept: words that
# come about by chance come alone.
KEEP = 2
# Words convolved at once; bounds memory.  A longer text goes in overlapping
# parts, and the pooled values of its parts are pooled again.
BLOCK = 1 << 17
# Weight of label 1 against label 0 in the fit.
POSITIVE = 0.6
THRESHOLD = 0.7
_WORD = re.compile(r"[^\W\d_]+")
_LOW = np.float32(-1e9)


def _rows_of(words: list[str]) -> np.ndarray:
    """The table rows of each word."""
    out = np.empty((len(words), 2 + len(PREFIXES)), np.int32)
    for i, w in enumerate(words):
        b = w.encode("utf-8", "surrogatepass")
        h = zlib.crc32(b)
        out[i] = h % ROWS, (h >> 16) % ROWS, *[zlib.crc32(b"^%d" % n + w[:n].encode("utf-8", "surrogatepass")) % ROWS for n in PREFIXES]
    return out


def _words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def _largest(y: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The KEEP largest values of every column in each run of rows, and their
    row numbers, both (KEEP, runs, columns).  Empty runs don't occur."""
    y = y.copy()
    runs = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(y))))
    number = np.arange(len(y), dtype=np.int32)[:, None]
    best, where = [], []
    for _ in range(KEEP):
        m = np.maximum.reduceat(y, starts)
        at = np.minimum.reduceat(np.where(y == m[runs], number, np.int32(len(y))), starts)
        best.append(m)
        where.append(at)
        y[at, np.arange(y.shape[1])] = _LOW
    return np.stack(best), np.stack(where)


class WordCNN:
    """Filters of several widths over word embeddings, rectified; the KEEP
    largest responses of each go through one hidden layer to one probability."""

    def __init__(self, seed: int = 17):
        r = np.random.default_rng(seed)
        n = len(WIDTHS) * FILTERS * KEEP
        self.p = {"table": r.normal(0, 0.02, (ROWS, DIM)), "bias": np.zeros(len(WIDTHS) * FILTERS),
                  "w1": r.normal(0, 0.3, (n, HIDDEN)), "b1": np.zeros(HIDDEN), "w2": r.normal(0, 0.3, HIDDEN), "b2": np.zeros(1)}
        for w in WIDTHS:
            self.p[f"f{w}"] = r.normal(0, 0.5, (w, DIM, FILTERS))
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _responses(self, rows: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Responses (position, filter) of all filters that start at each
        position of ``ids``, numbers of words with table rows ``rows``."""
        e = self.p["table"][rows].sum(1)
        e[-1] = 0  # the empty word
        out = np.empty((len(ids), len(WIDTHS) * FILTERS), e.dtype)
        for k, w in enumerate(WIDTHS):
            own = out[:, k * FILTERS:(k + 1) * FILTERS]
            f = self.p[f"f{w}"]
            own[:] = (e @ f[0])[ids]
            for i in range(1, w):
                own[:-i] += (e @ f[i])[ids[i:]]
        out += self.p["bias"]
        return out

    def _head(self, x: np.ndarray):
        h = np.maximum(x @ self.p["w1"] + self.p["b1"], 0)
        return h, 1 / (1 + np.exp(-np.clip(h @ self.p["w2"] + self.p["b2"], -30, 30)))

    def _pool(self, rows: np.ndarray, parts: list[np.ndarray], most: int = 1 << 62) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pooled responses of each part (a run of word numbers), where they
        are, and the word numbers of all parts in a row.  Empty words part the
        parts; filters start at the first ``most`` words of each."""
        pad = np.full(max(WIDTHS) - 1, len(rows) - 1, np.int32)
        ids = np.concatenate([x for p in parts for x in (p, pad)])
        size = np.array([len(p) + len(pad) for p in parts])
        starts = np.concatenate([[0], np.cumsum(size)[:-1]])
        y = np.maximum(self._responses(rows, ids), 0)
        own = np.array([min(len(p), most) for p in parts])
        y[np.arange(len(ids)) - np.repeat(starts, size) >= np.repeat(own, size)] = 0
        best, where = _largest(y, starts)
        return best, where, ids

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Probability of each whole text."""
        out, at, overlap = np.empty(len(texts)), 0, max(WIDTHS) - 1
        while at < len(texts):
            number: dict[str, int] = {}
            first, held = at, 0
            docs: list[np.ndarray] = []
            while at < len(texts) and held < BLOCK:  # texts of about a block
                words = _words(texts[at])
                docs.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words)))
                held += len(words)
                at += 1
            rows = _rows_of([*number, ""])
            parts = [(i, d[a:a + BLOCK + overlap]) for i, d in enumerate(docs) for a in range(0, max(1, len(d)), BLOCK)]
            pooled = np.zeros((at - first, KEEP, len(WIDTHS) * FILTERS), np.float32)
            group: list[tuple[int, np.ndarray]] = []
            for k, part in enumerate(parts):
                group.append(part)
                if k + 1 == len(parts) or sum(len(p) for _, p in group) + len(parts[k + 1][1]) > 2 * BLOCK:
                    best = self._pool(rows, [p for _, p in group], BLOCK)[0]
                    for j, (i, _) in enumerate(group):
                        both = np.concatenate([pooled[i], best[:, j]])
                        pooled[i] = -np.sort(-both, 0)[:KEEP]
                    group = []
            out[first:at] = self._head(pooled.reshape(at - first, -1))[1]
        return out

    def fit(self, texts: list[str], labels: np.ndarray, epochs: int, share: float, batch: int = 64, rate: float = 0.006, seed: int = 23):
        """Adam over whole texts; a text of more than a block of words is
        fitted on a block drawn anew each time.  ``share`` is that of label 1
        in all rows of the fit, of which these may be a part."""
        r = np.random.default_rng(seed)
        number: dict[str, int] = {}
        docs = [np.fromiter((number.setdefault(w, len(number)) for w in _words(t)), np.int32) for t in texts]
        all_rows = _rows_of([*number, ""])
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        weight = np.where(labels == 1, POSITIVE / max(share, 1e-9), (1 - POSITIVE) / max(1 - share, 1e-9))
        t = 0
        for _ in range(epochs):
            order = r.permutation(len(docs))
            for at in range(0, len(order), batch):
                own = order[at:at + batch]
                parts = [docs[i] for i in own]
                parts = [d if len(d) <= BLOCK else d[(s := int(r.integers(len(d) - BLOCK))):s + BLOCK] for d in parts]
                used, inverse = np.unique(np.concatenate([*parts, [len(all_rows) - 1]]), return_inverse=True)
                ends = np.cumsum([len(d) for d in parts])
                parts = [x.astype(np.int32) for x in np.split(inverse[:-1], ends[:-1])]
                g = self._gradient(all_rows[used], parts, labels[own], weight[own] / len(own))
                t += 1
                for k in self.p:
                    m[k] += 0.1 * (g[k] - m[k])
                    v[k] += 0.01 * (g[k] ** 2 - v[k])
                    self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.99 ** t)) + 1e-6)).astype(np.float32)
        return self

    def _gradient(self, rows: np.ndarray, parts: list[np.ndarray], labels: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the weighted cross-entropy; only the words under the
        kept responses get a share."""
        best, where, ids = self._pool(rows, parts)
        x = best.transpose(1, 0, 2).reshape(len(parts), -1)
        h, prob = self._head(x)
        d = ((prob - labels) * weight).astype(x.dtype)
        g = {k: np.zeros_like(p) for k, p in self.p.items()}
        g["w2"], g["b2"] = h.T @ d, d.sum(keepdims=True)
        dh = np.outer(d, self.p["w2"]) * (h > 0)
        g["w1"], g["b1"] = x.T @ dh, dh.sum(0)
        dy = (dh @ self.p["w1"].T).reshape(len(parts), KEEP, -1).transpose(1, 0, 2) * (best > 0)
        g["bias"] = dy.sum((0, 1))
        e = self.p["table"][rows].sum(1)
        e[-1] = 0
        de = np.zeros_like(e)
        for k, w in enumerate(WIDTHS):
            own = slice(k * FILTERS, (k + 1) * FILTERS)
            for i in range(w):
                word = ids[np.minimum(where[:, :, own] + i, len(ids) - 1)]  # (KEEP, text, filter)
                g[f"f{w}"][i] = np.einsum("ktfd,ktf->df", e[word], dy[:, :, own])
                np.add.at(de, word, dy[:, :, own, None] * self.p[f"f{w}"][i].T)
        de[-1] = 0
        np.add.at(g["table"], rows, de[:, None])
        return g


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, lang, toxic) of every labelled row that is not held out."""
    own = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    own = small(cut(own.groupBy("doc_id").agg(F.min("toxic").alias("toxic"))))
    return docs.select("doc_id", "text", "lang").join(own, "doc_id").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "lang", "toxic")


def fit_rows(docs: DataFrame, labels: DataFrame) -> list[tuple]:
    """The rows of ``labelled`` as a list, to look at few of them; the fit
    itself gathers none."""
    return sorted((tuple(r) for r in labelled(docs, labels).collect()), key=lambda x: (x[0], x[1], x[2] or ""))


def best_threshold(scores: np.ndarray, labels: np.ndarray, counts: np.ndarray | None = None) -> float:
    """The threshold with the best F1; in a gap of equal F1 its middle.
    ``counts`` tells how often each score with its label is there."""
    counts = np.ones(len(scores), int) if counts is None else counts
    positive, total = int(counts[labels == 1].sum()), int(counts.sum())
    if positive in (0, total):
        return THRESHOLD
    marks = np.unique(np.append(scores, [0.0, 1.0]))
    middles = (marks[1:] + marks[:-1]) / 2
    order = np.argsort(scores, kind="stable")
    at = np.searchsorted(scores[order], middles)
    above = total - np.append(0, np.cumsum(counts[order]))[at]
    hits = positive - np.append(0, np.cumsum((counts * (labels == 1))[order]))[at]
    f1 = 2 * hits / (above + positive)
    top = np.flatnonzero(f1 == f1.max())
    return float(middles[top[np.argmax((marks[1:] - marks[:-1])[top])]])


def _flat(net: WordCNN) -> np.ndarray:
    return np.concatenate([net.p[k].ravel() for k in sorted(net.p)])


def _shaped(net: WordCNN, flat: np.ndarray) -> WordCNN:
    """A network like ``net`` with the parameters ``flat``."""
    out, at = WordCNN(), 0
    for k in sorted(net.p):
        out.p[k] = flat[at:at + net.p[k].size].astype(np.float32).reshape(net.p[k].shape)
        at += net.p[k].size
    return out


def fit_round(rows: DataFrame, net: WordCNN, epochs: int, share: float, rate: float, seed: int) -> WordCNN:
    """``net`` after one round: every partition of ``rows`` (text, toxic)
    fits a copy of it on all of its rows, TASK_ROWS or so at a time, and the
    changes are averaged.  A parameter that a partition never met, such as
    that of a word that it lacks, stays out of the average.  Each piece of the
    parameters is averaged by itself, so one network comes to the driver.
    """
    start = _flat(net)
    width = -(-len(start) // PIECES)

    def tasks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, texts, labels, n = _shaped(net, start), [], [], 0
        for batch in batches:
            texts.extend(batch["text"])
            labels.extend(batch["toxic"])
            while len(texts) >= 2 * TASK_ROWS:  # what one task holds stays bounded
                own.fit(texts[:TASK_ROWS], np.array(labels[:TASK_ROWS]), epochs, share, rate=rate, seed=seed + n)
                texts, labels, n = texts[TASK_ROWS:], labels[TASK_ROWS:], n + TASK_ROWS
        if texts:
            own.fit(texts, np.array(labels), epochs, share, rate=rate, seed=seed + n)
            n += len(texts)
        if n:
            change = _flat(own) - start
            yield pd.DataFrame({"piece": range(PIECES), "n": n, "change": [change[i * width:(i + 1) * width].tobytes() for i in range(PIECES)]})

    def mean(key: tuple, changes: pd.DataFrame) -> pd.DataFrame:
        # In a fixed order, so that reruns agree to the last bit.
        changes = changes.sort_values(["n", "change"])
        total, seen = 0.0, 0.0
        for n, raw in zip(changes["n"], changes["change"]):
            c = np.frombuffer(raw, np.float32).astype(np.float64)
            total, seen = total + n * c, seen + n * (c != 0)
        return pd.DataFrame({"piece": [key[0]], "change": [(total / np.maximum(seen, 1)).tobytes()]})

    changes = rows.mapInPandas(tasks, "piece int, n long, change binary").groupBy("piece").applyInPandas(mean, "piece int, change binary")
    pieces = sorted((r["piece"], r["change"]) for r in changes.collect())  # one network
    return _shaped(net, start + np.concatenate([np.frombuffer(c) for _, c in pieces])) if pieces else net


def calibrate(rows: DataFrame, net: WordCNN) -> dict[str | None, float]:
    """The threshold of each language (None: of the others) with the best F1
    on all ``rows`` (text, lang, toxic), their scores in STEPS steps."""
    step = F.round(_scored(net)("text") * STEPS).cast("int")
    seen = rows.select(F.coalesce("lang", F.lit("")).alias("lang"), step.alias("step"), "toxic").groupBy("lang", "step", "toxic").count()
    found = pd.DataFrame([tuple(r) for r in seen.collect()], columns=["lang", "step", "toxic", "n"])  # STEPS rows a language at most

    def best(own: pd.DataFrame) -> float:
        return best_threshold(own["step"].to_numpy(float) / STEPS, own["toxic"].to_numpy(int), own["n"].to_numpy(int))

    thresholds: dict[str | None, float] = {None: best(found)}
    for lang, own in found.groupby("lang"):
        if lang and own["n"][own["toxic"] == 1].sum() >= 5:  # too few say nothing
            thresholds[lang] = best(own)
    return thresholds


def fit(docs: DataFrame, labels: DataFrame) -> tuple[WordCNN, dict[str | None, float]]:
    """The network, and the threshold of each language (None: of the others).

    All labelled rows that are not held out take part: one in CALIBRATE
    calibrates, the others are fitted, dealt into tasks of about TASK_ROWS by
    a hash of the row.  Without labelled rows the network stays as drawn and
    the threshold is THRESHOLD.
    """
    rows = labelled(docs, labels)
    calibrates = F.crc32(F.concat(F.lit("calibrate:"), F.col("doc_id").cast("string")).cast("binary")) % CALIBRATE == 0
    rows = cut(rows.withColumn("calibrates", calibrates))
    fitted = rows.filter(~F.col("calibrates")).select("doc_id", "text", "toxic")
    count = {r["toxic"]: r["count"] for r in fitted.groupBy("toxic").count().collect()}
    net, n = WordCNN(), sum(count.values())
    if n:
        # In a fixed order, so that reruns fit alike.
        order = F.xxhash64("doc_id", "text"), F.col("doc_id"), F.col("text"), F.col("toxic")
        own = cut(fitted.repartition(-(-n // TASK_ROWS), F.xxhash64("doc_id", "text")).sortWithinPartitions(*order).select("text", "toxic"))
        epochs = max(1, min(MOST_EPOCHS, -(-FIT_TEXTS // n)) // ROUNDS)
        for k in range(ROUNDS):
            net = fit_round(own, net, epochs, count.get(1, 0) / n, 0.006 if k + 1 < ROUNDS else 0.002, 23 + 1000 * k)
    return net, calibrate(rows.filter("calibrates"), net)


def _scored(net: WordCNN):
    def tasks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(net.score(list(texts)), dtype="float64")

    return F.pandas_udf(tasks, "double")


def score_toxicity(docs: DataFrame, net: WordCNN, thresholds: dict[str | None, float] | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted, threshold, flagged) of every whole
    text.

    Only the text's words are an input of the score; ``predicted`` is its
    comparison with THRESHOLD, ``flagged`` that with the calibrated threshold
    of the row's language.  Null texts score like empty ones; repeated rows
    score alike; a text of any length is scored in parts; other columns of the
    input play no part.
    """

    known = {None: THRESHOLD, **(thresholds or {})}
    per_lang = F.lit(known[None])
    for lang, least in known.items():
        if lang is not None:
            per_lang = F.when(F.col("lang") == lang, F.lit(least)).otherwise(per_lang)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), _scored(net)("text").alias("score"),
                         per_lang.alias("threshold"))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "threshold",
                         (F.col("score") >= F.col("threshold")).cast("int").alias("flagged"))


ship(__name__)
