"""Language ID: a bidirectional gated recurrent network over bytes."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, unit_hash

# Labelled rows that the fit sees, per language (expected number).
FIT_ROWS = 400
HIDDEN = 8
# Bytes that the network reads from a state of zero, in both directions.
# Such windows tile the whole text; the last is zero-padded.
WINDOW = 64
# Windows read at once; bounds memory whatever the length of a text.
BLOCK = 1 << 11
UNKNOWN = "und"
_WORDLIKE = re.compile(r"[^\W\d_]")  # letters, and some signs of numbers


def _windows(raw: bytes) -> np.ndarray:
    n = -(-len(raw) // WINDOW)
    return np.frombuffer(raw + b"\0" * (n * WINDOW - len(raw)), np.uint8).reshape(n, WINDOW)


class ByteGRU:
    """Two gated recurrent layers, one in each direction, and a softmax over
    the languages at every byte.  Arrays are (feature, window)."""

    def __init__(self, langs: list[str], hidden: int = HIDDEN, seed: int = 5):
        r = np.random.default_rng(seed)
        self.langs, self.h = langs, hidden
        self.p: dict[str, np.ndarray] = {}
        for d in "fb":
            self.p["x" + d] = r.normal(0, 0.3, (3 * hidden, 256))  # input weights of each byte, with the bias
            self.p["u" + d] = r.normal(0, 1 / np.sqrt(hidden), (3 * hidden, hidden))
        self.p["o"] = r.normal(0, 0.3, (len(langs), 2 * hidden))
        self.p["c"] = np.zeros((len(langs), 1))
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _states(self, x: np.ndarray, d: str, keep: bool):
        """States after each byte (time, hidden, window); with ``keep`` also
        what backpropagation needs."""
        h2, n, t = 2 * self.h, x.shape[0], x.shape[1]
        table, u = self.p["x" + d], self.p["u" + d]
        state, kept = np.zeros((self.h, n), np.float32), []
        out = np.empty((t, self.h, n), np.float32)
        for i in (range(t) if d == "f" else range(t - 1, -1, -1)):
            a = np.take(table, x[:, i], axis=1)
            b = u @ state
            g = a[:h2]
            g += b[:h2]
            g *= 0.5
            np.tanh(g, g)
            g += 1
            g *= 0.5  # update and reset gates
            z, r = g[:self.h], g[self.h:]
            c = r * b[h2:]
            c += a[h2:]
            np.tanh(c, c)
            new = state - c
            new *= z
            new += c
            if keep:
                kept.append((i, state, z, r, b[h2:], c))
            out[i] = state = new
        return (out, kept) if keep else out

    def positions(self, x: np.ndarray) -> np.ndarray:
        """Probabilities (time, language, window) at every byte."""
        f, b = self._states(x, "f", False), self._states(x, "b", False)
        y = np.matmul(self.p["o"][:, :self.h], f)
        y += np.matmul(self.p["o"][:, self.h:], b)
        y += self.p["c"]
        np.exp(y, y)  # states are within -1 and 1, so this can't overflow
        y /= y.sum(1, keepdims=True)
        return y

    def pooled(self, raws: list[bytes]) -> np.ndarray:
        """Mean probabilities (text, language) over all bytes of each text."""
        sums = np.zeros((len(raws), len(self.langs)))
        sizes = np.array([len(r) for r in raws])
        at = 0
        while at < len(raws):
            rows = []
            held = 0
            first = at
            while at < len(raws) and held < BLOCK:
                rows.append(_windows(raws[at]))
                held += len(rows[-1])
                at += 1
            owner = np.repeat(np.arange(first, at), [len(r) for r in rows])
            used = np.concatenate([np.minimum(WINDOW, sizes[first + i] - WINDOW * np.arange(len(r))) for i, r in enumerate(rows)]) if held else np.zeros(0)
            x = np.concatenate(rows)
            for k in range(0, held, BLOCK):
                y = self.positions(x[k:k + BLOCK])
                y *= (np.arange(WINDOW)[:, None] < used[None, k:k + BLOCK])[:, None, :]
                np.add.at(sums, owner[k:k + BLOCK], y.sum(0).T)
        return sums / np.maximum(sizes, 1)[:, None]

    def fit(self, texts: list[bytes], labels: np.ndarray, steps: int = 500, batch: int = 192, rate: float = 0.02, seed: int = 3):
        """Backpropagation through time over windows drawn from all of each text."""
        r = np.random.default_rng(seed)
        by = [np.flatnonzero(labels == k) for k in range(len(self.langs))]
        by = [b for b in by if len(b)]
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        for t in range(1, steps + 1):
            own = np.array([r.choice(by[i % len(by)]) for i in range(batch)])
            x, used = np.zeros((batch, WINDOW), np.uint8), np.zeros(batch, int)
            for i, k in enumerate(own):
                a = WINDOW * int(r.integers(-(-len(texts[k]) // WINDOW)))
                part = texts[k][a:a + WINDOW]
                used[i] = len(part)
                x[i, :len(part)] = np.frombuffer(part, np.uint8)
            g = self._gradient(x, labels[own], used)
            step = rate * min(1.0, 2 * (1 - t / steps) + 0.05)
            norm = np.sqrt(sum(float((q ** 2).sum()) for q in g.values()))
            for k in self.p:
                q = g[k] * min(1.0, 1.0 / (norm + 1e-9))
                m[k] += 0.1 * (q - m[k])
                v[k] += 0.01 * (q ** 2 - v[k])
                self.p[k] = (self.p[k] - step * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.99 ** t)) + 1e-6)).astype(np.float32)
        return self

    def _gradient(self, x: np.ndarray, labels: np.ndarray, used: np.ndarray) -> dict[str, np.ndarray]:
        n, t, h, h2 = len(x), x.shape[1], self.h, 2 * self.h
        passed = {d: self._states(x, d, True) for d in "fb"}
        s = np.concatenate([passed["f"][0], passed["b"][0]], 1)
        y = np.exp(np.matmul(self.p["o"], s) + self.p["c"])
        y /= y.sum(1, keepdims=True)
        y[:, labels, np.arange(n)] -= 1
        y *= ((np.arange(t)[:, None] < used[None]) / used.sum())[:, None, :]
        y = y.astype(np.float32)
        g = {"o": np.einsum("tln,thn->lh", y, s), "c": y.sum((0, 2))[:, None]}
        ds = np.matmul(self.p["o"].T, y)
        for d, part in (("f", ds[:, :h]), ("b", ds[:, h:])):
            u = self.p["u" + d]
            gx, gu, carry = np.zeros_like(self.p["x" + d]), np.zeros_like(u), np.zeros((h, n), np.float32)
            for i, old, z, r, b, c in reversed(passed[d][1]):
                dn = part[i] + carry
                dc = dn * (1 - z) * (1 - c * c)
                da = np.concatenate([dn * (old - c) * z * (1 - z), dc * b * r * (1 - r), dc])
                db = np.concatenate([da[:h2], dc * r])
                np.add.at(gx.T, x[:, i], da.T)
                gu += db @ old.T
                carry = dn * z + u.T @ db
            g["x" + d], g["u" + d] = gx, gu
        return g


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, per_lang: int = FIT_ROWS) -> ByteGRU:
    """Fit on a bounded sample, about ``per_lang`` rows of each language, of
    the rows with a language that are not held out."""
    own = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["count"] for r in own.groupBy("lang").count().collect()}
    langs = sorted(counts)
    if not langs:
        return ByteGRU([UNKNOWN])
    chance = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, per_lang / counts[k]))])
    rows = own.filter(unit_hash(F.col("doc_id"), F.lit("lang")) < chance[F.col("lang")]).select("doc_id", "text", "lang").collect()
    rows = sorted((r["doc_id"] or 0, r["text"].encode("utf-8", "surrogatepass"), r["lang"]) for r in rows if r["text"])
    net = ByteGRU(langs)
    return net.fit([t for _, t, _ in rows], np.array([langs.index(k) for _, _, k in rows])) if rows else net


def _has_letter(text: str | None) -> bool:
    """Whether a character is a letter by its Unicode category."""
    return bool(text) and any(m[0].isalpha() for m in _WORDLIKE.finditer(text))


def _label(net: ByteGRU, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    raws = [t.encode("utf-8", "surrogatepass") if _has_letter(t) else b"" for t in texts]
    p = net.pooled(raws)
    best = p.argmax(1)
    return ([net.langs[k] if raw else UNKNOWN for k, raw in zip(best, raws)],
            np.clip(np.where([len(r) > 0 for r in raws], p.max(1), 0.0), 0.0, 1.0))


def label(docs: DataFrame, net: ByteGRU) -> DataFrame:
    """(row, found) of every row of ``docs``: all of its columns, and the
    lang_pred and score of its whole text."""
    kind = "struct<lang_pred: string, score: double>"

    def tasks(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            found, score = _label(net, list(texts))
            yield pd.DataFrame({"lang_pred": found, "score": score})

    return docs.select(F.struct(*docs.columns).alias("row"), F.pandas_udf(tasks, kind)("text").alias("found"))


def identify(docs: DataFrame, net: ByteGRU) -> DataFrame:
    """``docs`` with lang_pred and score, of every whole text; columns of
    these names are replaced.

    lang_pred is a learned language, or ``und`` with score 0 if the text is
    null, empty or has no letter.  Every byte gets a probability of each
    language; the text's are their means.  Only the text is an input;
    repeated rows get the same result.
    """
    names = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    return label(docs, net).select(*[F.col("row")[c].alias(c) for c in names], "found.lang_pred", "found.score")


ship(__name__)
