"""The networks and hashes against plain loops over one element at a time."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import language_id, quality, sharding


def _signed(x):
    return x - 2**64 if x >> 63 else x


def test_rendezvous_is_the_best_score(spark):
    """The winning shard, from Spark's own hashes, one shard at a time."""
    weights = [1.0, 2.0, 0.5, 1.0, 3.0]
    docs = spark.range(400).select(F.when(F.col("id") % 50 != 0, F.col("id")).alias("doc_id"))
    hashes = docs.select("doc_id", *[F.xxhash64("doc_id", F.col("doc_id").isNull(), F.lit(s)).alias(f"h{s}") for s in range(len(weights) + 1)])
    want = []
    for r in hashes.collect():
        score = []
        for s, w in enumerate(weights + [1.0]):
            u = ((r[f"h{s}"] & (2**64 - 1)) >> 11) + 0.5
            score.append(-w / math.log(u / 2.0**53))
        best = max(range(len(weights)), key=lambda s: (score[s], -s))
        grown = max(range(len(weights) + 1), key=lambda s: (score[s], -s))
        want.append((r["doc_id"], best, grown))
    got = sharding.assign_shards(docs, "doc_id", weights, grown_by=[1.0]).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want)) and len({g[1] for g in want}) == 5


def _plain_quality(net, text):
    raw = (text or "").encode()
    pooled = []
    for a in range(0, max(1, len(raw) - quality.WIDTH + 1), quality.STEP):
        part = raw[a:a + quality.CHUNK].ljust(quality.CHUNK, b"\0")
        best = [max(sum(float(net.p["filters"][i, part[at + i], f]) for i in range(quality.WIDTH)) for at in range(quality.CHUNK - quality.WIDTH + 1))
                for f in range(quality.FILTERS)]
        pooled.append([max(0.0, b + float(net.p["bias"][f])) for f, b in enumerate(best)])
    p = np.array(pooled)
    x = np.concatenate([p.max(0), p.mean(0)])
    h = np.maximum(x @ net.p["w1"] + net.p["b1"], 0)
    return 1 / (1 + math.exp(-(h @ net.p["w2"] + net.p["b2"][0])))


def test_quality_is_the_plain_convolution():
    net = quality.ByteCNN()
    net.p["bias"] += np.linspace(-1, 1, quality.FILTERS).astype(np.float32)
    r = np.random.default_rng(0)
    texts = ["", None, "a", "naïve 日本", *["".join(chr(x) for x in r.integers(32, 400, n)) for n in (3, 509, 700, 2600)]]
    assert np.allclose(net.score(texts), [_plain_quality(net, t) for t in texts], atol=1e-5)


def test_quality_of_long_texts():
    """A text of many blocks scores as its chunks say, whatever it is scored with."""
    net = quality.ByteCNN()
    long = "".join(f"w{i * i % 997} " for i in range(40_000))
    alone = net.score([long])[0]
    assert np.allclose(net.score(["x", long, "", long[:100]])[1], alone) and 0 < alone < 1
    pooled = np.concatenate([net._pooled(quality._chunks(long)[a:a + 7]) for a in range(0, len(quality._chunks(long)), 7)])
    assert np.allclose(net._head(pooled, np.array([0]))[2][0], alone, atol=1e-6)


def _sigmoid(x):
    return 1 / (1 + math.exp(-x))


def _plain_language(net, raw):
    """Mean probabilities, one byte and unit at a time."""
    total, h = np.zeros(len(net.langs)), net.h
    for a in range(0, len(raw), language_id.WINDOW):
        part = raw[a:a + language_id.WINDOW].ljust(language_id.WINDOW, b"\0")
        states = {}
        for d, order in (("f", range(len(part))), ("b", range(len(part) - 1, -1, -1))):
            s, table, u = [0.0] * h, net.p["x" + d], net.p["u" + d]
            for t in order:
                ins = [float(table[k, part[t]]) for k in range(3 * h)]
                rec = [sum(float(u[k, j]) * s[j] for j in range(h)) for k in range(3 * h)]
                z, r = ([_sigmoid(ins[g * h + k] + rec[g * h + k]) for k in range(h)] for g in (0, 1))
                c = [math.tanh(ins[2 * h + k] + r[k] * rec[2 * h + k]) for k in range(h)]
                s = [z[k] * s[k] + (1 - z[k]) * c[k] for k in range(h)]
                states[d, t] = s
        for t in range(min(len(part), len(raw) - a)):
            both = states["f", t] + states["b", t]
            y = [math.exp(sum(float(net.p["o"][k, j]) * both[j] for j in range(2 * h)) + float(net.p["c"][k, 0])) for k in range(len(net.langs))]
            total += np.array(y) / sum(y)
    return total / max(1, len(raw))


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 200])
def test_language_is_the_plain_recurrence(n):
    net = language_id.ByteGRU(["a", "b", "c"], hidden=3)
    raws = [bytes(np.random.default_rng(n).integers(0, 256, n).astype(np.uint8)), b"other"]
    assert np.allclose(net.pooled(raws), [_plain_language(net, r) for r in raws], atol=1e-4)
