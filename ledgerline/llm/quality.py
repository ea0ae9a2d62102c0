"""Quality classifier: a byte-level convolutional network in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, ship, small, unit_hash

# Labelled rows that the fit sees, of label 0 and 1 (expected numbers).
FIT_ROWS = (1500, 3000)
WIDTH, FILTERS, HIDDEN = 4, 16, 16
# Weight of label 1 against label 0 in the fit: to reject a good document is
# the worse error.
POSITIVE = 3.0
# Bytes in a chunk; chunks overlap by WIDTH - 1, so that every run of WIDTH
# bytes lies in one.
CHUNK = 512
STEP = CHUNK - WIDTH + 1
# Chunks convolved at once; bounds memory whatever the length of a text.
BLOCK = 96


def _chunks(text: str | None) -> np.ndarray:
    """The overlapping chunks (n, CHUNK) that cover the whole text, zero-padded;
    an empty text is one chunk of padding."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    n = max(1, -(-(len(raw) - WIDTH + 1) // STEP))
    padded = np.zeros((n - 1) * STEP + CHUNK, np.uint8)
    padded[:len(raw)] = raw
    return np.lib.stride_tricks.as_strided(padded, (n, CHUNK), (STEP, 1))


class ByteCNN:
    """Filters over WIDTH bytes, rectified and max-pooled within each chunk;
    the maximum and the mean over the chunks go through one hidden layer to
    one probability."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.p = {"filters": r.normal(0, 0.25, (WIDTH, 256, FILTERS)), "bias": np.zeros(FILTERS),
                  "w1": r.normal(0, 0.2, (2 * FILTERS, HIDDEN)), "b1": np.zeros(HIDDEN),
                  "w2": r.normal(0, 0.2, HIDDEN), "b2": np.zeros(1)}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _pooled(self, chunks: np.ndarray, argmax: bool = False):
        """Max over the positions of each chunk.  Two bytes at a time look up
        their part of all filters."""
        f = self.p["filters"]
        ab, cd = [(f[i][:, None] + f[i + 1][None]).reshape(-1, FILTERS) for i in (0, 2)]
        best, where = [], []
        for at in range(0, len(chunks), BLOCK):
            c = chunks[at:at + BLOCK].astype(np.int32)
            pair = c[:, :-1] * 256 + c[:, 1:]
            y = ab[pair[:, :-2]]
            y += cd[pair[:, 2:]]
            if argmax:
                where.append(y.argmax(1))
            best.append(y.max(1))
        best = np.maximum(np.concatenate(best) + self.p["bias"], 0)
        return (best, np.concatenate(where)) if argmax else best

    def _head(self, pooled: np.ndarray, starts: np.ndarray):
        n = np.diff(np.append(starts, len(pooled)))[:, None]
        x = np.concatenate([np.maximum.reduceat(pooled, starts), np.add.reduceat(pooled, starts) / n], 1)
        h = np.maximum(x @ self.p["w1"] + self.p["b1"], 0)
        return x, h, 1 / (1 + np.exp(-np.clip(h @ self.p["w2"] + self.p["b2"], -30, 30)))

    def score(self, texts: list[str | None]) -> np.ndarray:
        out, at = np.empty(len(texts)), 0
        while at < len(texts):  # so many texts that their chunks fill a few blocks
            rows, held = [], 0
            while at + len(rows) < len(texts) and held < 8 * BLOCK:
                rows.append(_chunks(texts[at + len(rows)]))
                held += len(rows[-1])
            starts = np.cumsum([0] + [len(r) for r in rows[:-1]])
            pooled = np.concatenate([self._pooled(r) for r in rows]) if held > 64 * BLOCK else self._pooled(np.concatenate(rows))
            out[at:at + len(rows)] = self._head(pooled, starts)[2]
            at += len(rows)
        return out

    def fit(self, texts: list[str], labels: np.ndarray, epochs: int = 10, batch: int = 48, rate: float = 0.004, seed: int = 11):
        r = np.random.default_rng(seed)
        chunks = [_chunks(t) for t in texts]
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        weight = np.where(labels == 1, POSITIVE / max(1, (labels == 1).sum()), 1 / max(1, (labels == 0).sum())) * len(labels) / (1 + POSITIVE)
        t = 0
        for epoch in range(epochs):
            order = r.permutation(len(texts))
            for at in range(0, len(order), batch):
                own = order[at:at + batch]
                rows = [chunks[i] for i in own]
                # Of a long text, a fit step sees at most 24 chunks drawn anew.
                rows = [c if len(c) <= 24 else c[np.sort(r.choice(len(c), 24, replace=False))] for c in rows]
                starts = np.cumsum([0] + [len(c) for c in rows[:-1]])
                c = np.concatenate(rows)
                pooled, where = self._pooled(c, argmax=True)
                x, h, prob = self._head(pooled, starts)
                g = {}
                d = ((prob - labels[own]) * weight[own] / len(own)).astype(np.float32)
                g["w2"], g["b2"] = h.T @ d, d.sum(keepdims=True)
                dh = np.outer(d, self.p["w2"]) * (h > 0)
                g["w1"], g["b1"] = x.T @ dh, dh.sum(0)
                dx = dh @ self.p["w1"].T
                n = np.array([len(k) for k in rows])
                dp = np.repeat(dx[:, FILTERS:] / n[:, None], n, 0)
                owner = np.repeat(np.arange(len(rows)), n)
                dp += np.where(pooled == x[owner, :FILTERS], dx[owner, :FILTERS], 0)
                dp *= pooled > 0
                g["bias"] = dp.sum(0)
                g["filters"] = np.zeros_like(self.p["filters"])
                f = np.broadcast_to(np.arange(FILTERS), where.shape)
                for k in range(WIDTH):
                    np.add.at(g["filters"][k], (np.take_along_axis(c, where + k, 1), f), dp)
                t += 1
                step = rate * (0.5 if epoch >= epochs * 2 // 3 else 1)
                for k in self.p:
                    m[k] += 0.1 * (g[k] - m[k])
                    v[k] += 0.01 * (g[k] ** 2 - v[k])
                    self.p[k] = (self.p[k] - step * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.99 ** t)) + 1e-6)).astype(np.float32)
        return self


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_rows(docs: DataFrame, labels: DataFrame, per_label: tuple[int, int] = FIT_ROWS) -> list:
    """(doc_id, text, quality) of about ``per_label`` rows of each label, drawn
    by a hash of the id among the rows that are not held out."""
    own = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter(
        F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    counts = {r["quality"]: r["count"] for r in own.groupBy("quality").count().collect()}
    chance = F.create_map(*[F.lit(x) for q in (0, 1) for x in (q, min(1.0, per_label[q] / counts.get(q, 1)))])
    drawn = own.filter(unit_hash(F.col("doc_id"), F.lit("quality")) < chance[F.col("quality")])
    # A few thousand ids at every size, so the texts need no shuffle.
    drawn = small(cut(drawn.groupBy("doc_id").agg(F.min("quality").alias("quality"))))
    rows = docs.select("doc_id", "text").join(drawn, "doc_id").select("doc_id", "text", "quality")
    return sorted(((r["doc_id"], r["text"] or "", r["quality"]) for r in rows.collect()), key=lambda x: (x[0], x[1]))


def fit(docs: DataFrame, labels: DataFrame, per_label: tuple[int, int] = FIT_ROWS) -> ByteCNN:
    """Fit on a bounded sample of labelled rows (``per_label`` rows of each).
    Without labelled rows the network stays as drawn."""
    rows = fit_rows(docs, labels, per_label)
    net = ByteCNN()
    return net.fit([t for _, t, _ in rows], np.array([q for _, _, q in rows])) if rows else net


def score_quality(docs: DataFrame, net: ByteCNN) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every whole text.

    Only the text's bytes are an input.  Null texts score like empty ones;
    repeated rows score alike; long texts are scored in chunks.
    """

    def tasks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(net.score(list(texts)), dtype="float64")

    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                         F.pandas_udf(tasks, "double")("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


ship(__name__)
