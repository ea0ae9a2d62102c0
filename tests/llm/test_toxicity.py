"""The word network against a plain one, and what it learns."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import toxicity


def _plain(net, text):
    """The score, one position and filter at a time."""
    words = [w for w in toxicity._words(text)]
    gap = [None] * (max(toxicity.WIDTHS) - 1)
    e = [np.zeros(toxicity.DIM) if w is None else sum(net.p["table"][r].astype(float) for r in toxicity._rows_of([w])[0]) for w in words + gap]
    x = []
    for w in toxicity.WIDTHS:
        y = [[max(0.0, sum(float(e[a + i] @ net.p[f"f{w}"][i][:, f]) for i in range(w)) + float(net.p["bias"][k]))
              for a in range(len(words))]
             for k, f in ((toxicity.WIDTHS.index(w) * toxicity.FILTERS + f, f) for f in range(toxicity.FILTERS))]
        x.append([sorted(v + [0.0] * toxicity.KEEP, reverse=True)[:toxicity.KEEP] for v in y])
    flat = np.array([x[k][f][n] for n in range(toxicity.KEEP) for k in range(len(x)) for f in range(toxicity.FILTERS)])
    h = np.maximum(flat @ net.p["w1"] + net.p["b1"], 0)
    return 1 / (1 + np.exp(-(h @ net.p["w2"] + net.p["b2"][0])))


@pytest.fixture
def strong():
    """A network whose responses differ from 0."""
    net = toxicity.WordCNN()
    r = np.random.default_rng(1)
    net.p["table"] = r.normal(0, 0.5, net.p["table"].shape).astype(np.float32)
    for k in ("bias", "b1"):  # an empty text must not stand on the kink at 0
        net.p[k] = r.normal(0, 0.3, net.p[k].shape).astype(np.float32)
    return net


TEXTS = ["", None, "one", "one two", "Ein Wort, zwei Worte; drei! drei drei", "a b c d e f g a b c 12 é ß", " ".join(f"w{i % 7}x" for i in range(60))]


def test_score_is_the_plain_forward_pass(strong, monkeypatch):
    words = [" ".join(f"{c}{'xyz'[i % 3]}" for i, c in enumerate(t or "")) for t in TEXTS]
    for block in (1 << 17, 8, 3, 1):  # texts in one part, and in many
        monkeypatch.setattr(toxicity, "BLOCK", block)
        for texts in (TEXTS, words):
            assert np.allclose(strong.score(texts), [_plain(strong, t) for t in texts], atol=1e-5)


def test_gradient(strong):
    net = strong
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    texts, labels, weight = ["aa bb cc aa", "bb dd", "ee ff gg hh ii bb", ""], np.array([1, 0, 1, 0]), np.array([0.4, 0.3, 0.2, 0.1])
    number = {}
    parts = [np.array([number.setdefault(w, len(number)) for w in t.split()], np.int32) for t in texts]
    rows = toxicity._rows_of([*number, ""])

    def loss():
        p = net._head(net._pool(rows, parts)[0].transpose(1, 0, 2).reshape(4, -1))[1]
        return -(weight * np.log(np.where(labels == 1, p, 1 - p))).sum()

    g = net._gradient(rows, parts, labels, weight)
    for k in net.p:
        at = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        keep = net.p[k][at]
        net.p[k][at] = keep + 1e-6
        up = loss()
        net.p[k][at] = keep - 1e-6
        down = loss()
        net.p[k][at] = keep
        assert abs((up - down) / 2e-6 - g[k][at]) < 1e-3 * abs(g[k][at]) + 1e-4, k


def _texts(n):
    r = np.random.default_rng(3)
    rows = []
    for i in range(n):
        words = [f"w{x}" .replace("1", "a").replace("2", "b") + "xyz"[x % 3] for x in r.integers(0, 3000, int(r.integers(5, 80)))]
        lang, toxic = ("en", "de")[i % 2], int(i % 5 == 0)
        if toxic:
            for _ in range(int(r.integers(2, 5))):
                words.insert(int(r.integers(len(words))), {"en": ("nasty", "awful"), "de": ("garstig", "fies")}[lang][int(r.integers(2))])
        rows.append((i, " ".join(words), lang, toxic))
    return rows


def test_learns_and_calibrates(spark):
    rows = _texts(1500)
    docs = spark.createDataFrame([(i, t, k, "old") for i, t, k, _ in rows], "doc_id long, text string, lang string, score string")
    labels = spark.createDataFrame([(i, q) for i, _, _, q in rows], "doc_id long, toxic int")
    net, thresholds = toxicity.fit(docs, labels)
    assert set(thresholds) == {None, "en", "de"} and all(0 < t < 1 for t in thresholds.values())
    out = toxicity.score_toxicity(docs, net, thresholds).collect()
    toxic = {i: q for i, _, _, q in rows}
    held = [r for r in out if r["held_out"]]
    assert len(out) == len(rows) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in out)
    assert np.mean([r["flagged"] == toxic[r["doc_id"]] for r in held]) > 0.97
    assert all(r["predicted"] == int(r["score"] >= 0.7) and r["flagged"] == int(r["score"] >= r["threshold"]) for r in out)


def test_fit_never_sees_held_out_labels(spark):
    rows = _texts(300)
    docs = spark.createDataFrame([(i, t, k) for i, t, k, _ in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, q) for i, _, _, q in rows], "doc_id long, toxic int")
    assert all(zlib.crc32(str(r[0]).encode()) % 3 != 1 for r in toxicity.fit_rows(docs, labels))
    assert len(toxicity.fit_rows(docs, labels)) == labels.filter(~toxicity.held_out(F.col("doc_id"))).count()


def test_threshold_lies_in_the_widest_gap():
    assert toxicity.best_threshold(np.array([0.1, 0.2, 0.8]), np.array([0, 0, 1])) == pytest.approx(0.5)
    assert toxicity.best_threshold(np.array([0.1, 0.2]), np.array([0, 0])) == toxicity.THRESHOLD


def test_odd_rows(spark, odd, none, strong):
    out = toxicity.score_toxicity(odd, strong).collect()
    assert len(out) == odd.count() and all(0 <= r["score"] <= 1 for r in out)
    empty = [r["score"] for r in out if r["doc_id"] in (2, 3, 6)]
    assert len(set(empty)) == 1
    assert toxicity.score_toxicity(none, strong).count() == 0
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fit(none, labels)[1] == {None: toxicity.THRESHOLD}
    clash = spark.createDataFrame([(1, None, "x"), (None, 1, "y"), (1, 1, "z")], "doc_id long, toxic int, lang string")
    net, _ = toxicity.fit(odd, clash)
    assert net.score(["some text"]).shape == (1,)


def test_fit_takes_every_labelled_row(spark, monkeypatch):
    n = 15_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 5 == 0, "some nasty words").otherwise("some plain words").alias("text"),
                                 F.lit("en").alias("lang"))
    labels = docs.select("doc_id", (F.col("doc_id") % 5 == 0).cast("int").alias("toxic"))
    seen, whole, calibrate = [], toxicity.fit_round, toxicity.calibrate
    monkeypatch.setattr(toxicity, "TASK_ROWS", 2000)
    monkeypatch.setattr(toxicity, "FIT_TEXTS", 1)
    monkeypatch.setattr(toxicity, "fit_round", lambda rows, *a: (seen.append((rows.count(), rows.rdd.getNumPartitions())), whole(rows, *a))[1])
    monkeypatch.setattr(toxicity, "calibrate", lambda rows, net: (seen.append((rows.count(), 1)), calibrate(rows, net))[1])
    net, thresholds = toxicity.fit(docs, labels)
    own = labels.filter(~toxicity.held_out(F.col("doc_id"))).count()
    assert {a + seen[-1][0] for a, _ in seen[:-1]} == {own} and {p for _, p in seen[:-1]} == {-(-seen[0][0] // 2000)} and len(seen) == toxicity.ROUNDS + 1
    nasty, plain = net.score(["some nasty words", "some plain words"])
    assert nasty > thresholds["en"] > plain
    again, _ = toxicity.fit(docs, labels)
    assert all((again.p[k] == net.p[k]).all() for k in net.p)


def test_threshold_counts_repeated_scores():
    r = np.random.default_rng(2)
    scores, labels, counts = np.arange(1, 40) / 40, r.integers(0, 2, 39), r.integers(1, 5, 39)
    assert toxicity.best_threshold(scores, labels, counts) == toxicity.best_threshold(np.repeat(scores, counts), np.repeat(labels, counts))
