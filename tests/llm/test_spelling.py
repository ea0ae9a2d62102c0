"""Spelling variants against brute force."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm import spelling


def _lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def _counts(docs, least=3):
    seen = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = _lower(run)
            h = zlib.crc32(f"{i}:{run}".encode()) if i is not None else 1
            if h % 97 == 0:
                p = h % len(run)
                run = run[:p] + run[p + 1:]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 5 and n >= least}


def _near(words):
    """{word: near words}, by all words with one letter less or masked."""
    pairs = set()
    by = {}
    for w in words:
        for i in range(len(w)):
            by.setdefault((w[:i], w[i + 1:]), set()).add(w)
    for group in by.values():
        pairs.update((a, b) for a in group for b in group if a != b)
    have = set(words)
    for w in words:
        for i in range(len(w)):
            less = w[:i] + w[i + 1:]
            if less in have:
                pairs |= {(w, less), (less, w)}
    out = {w: set() for w in words}
    for a, b in pairs:
        out[a].add(b)
    return out


def _variants(counts):
    near, form = _near(counts), {}
    for w, n in counts.items():
        best = min(near[w], key=lambda b: (-counts[b], b), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    rows = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, n, form[w], counts[form[w]] if form[w] else None, root, len(near[w])))
    return sorted(rows)


def _words(r, n, letters, size):
    return {"".join(r.choice(list(letters), int(r.integers(*size)))) for _ in range(n)}


@pytest.mark.parametrize("letters,size,cell", [
    ("abcd", (5, 9), 1 << 19),  # many anagrams and many near pairs
    ("abcd", (5, 9), 600),      # cells divided often, some only by hash
    ("aab", (5, 8), 40),
    ("abcdefghijklmnopéÿ×", (5, 14), 2000),
    ("xy", (118, 124), 1 << 12)])
def test_pairs(spark, monkeypatch, letters, size, cell):
    r = np.random.default_rng(5)
    words = _words(r, 700, letters, size)
    words |= {w[:k] + w[k + 1:] for w in list(words)[:200] for k in (1, 4)}
    words |= {w[:3] + "a" + w[4:] for w in list(words)[:200]}
    words = {w for w in words if len(w) >= 5}
    monkeypatch.setattr(spelling, "BLOCK", 1 << 9)
    monkeypatch.setattr(spelling, "PAIRS", 50)
    monkeypatch.setattr(spelling, "LEAF", 4)
    got = spelling.near_pairs(spark.createDataFrame([(w,) for w in words], "word string"), cell_letters=cell).collect()
    want = {frozenset((a, b)) for a, bs in _near(words).items() for b in bs}
    assert len(got) == len(want) and {frozenset(x) for x in got} == want  # each pair once


def test_removal_hashes_match():
    r = np.random.default_rng(2)
    words = sorted(_words(r, 60, "abc", (7, 8)))
    h = spelling._removals(spelling._matrix([w.encode() for w in words]))
    seen = {}
    for i, w in enumerate(words):
        for k in range(7):
            assert seen.setdefault(w[:k] + w[k + 1:], h[i, k]) == h[i, k]
    assert len(set(seen.values())) == len(seen)


def test_counts_and_forms(spark):
    r = np.random.default_rng(8)
    vocabulary = sorted(_words(r, 60, "abcdeé", (5, 8)) | {"tiny", "KLEINÀ"})
    docs = [(i if i % 9 else None, " ".join(vocabulary[int(k)] if k % 3 else vocabulary[int(k)].upper() for k in r.zipf(1.3, 300) % len(vocabulary)))
            for i in range(250)]
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, n int, word string")
    got = sorted(tuple(x) for x in spelling.document_variants(frame).collect())
    assert got == _variants(_counts(docs)) and any(x[2] for x in got)


def test_chain_goes_to_the_last_form(spark):
    chain = ["aaaaaaa" + "b" * k for k in range(12)]
    counts = {w: 3 * 2 ** k for k, w in enumerate(chain)}
    out = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()
    assert {x["root"] for x in out} == {chain[-1]} and sorted(tuple(x) for x in out) == _variants(counts)


def test_odd_rows(spark, odd, none):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert sorted(tuple(x) for x in spelling.document_variants(odd).collect()) == _variants(_counts(docs))
    assert spelling.document_variants(none).count() == 0
    long = "x" * 40_000  # very long words
    rows = [(i, f"{long} {long}y {long[:-1]}z") for i in range(4)]
    got = spelling.document_variants(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(x) for x in got) == _variants(_counts(rows))


def test_registered_query(spark):
    from ledgerline.llm.queries import op13_kd_trees
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(x) for x in op13_kd_trees(spark, sf).collect()) == _variants(_counts(docs))
