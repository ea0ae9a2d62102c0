"""The Merkle manifest against one built by hand."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import merkle


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row):
    return _h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def _tree(nodes):
    """The root, and the siblings (left, right) of every node level by level."""
    paths, owner = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [list(range(a, min(a + 3, len(nodes)))) for a in range(0, len(nodes), 3)]
        for run in runs:
            for k in run:
                for i in owner[k]:
                    paths[i].append(("".join(nodes[j] for j in run if j < k), "".join(nodes[j] for j in run if j > k)))
        owner = [[i for k in run for i in owner[k]] for run in runs]
        nodes = [_h(*[nodes[k] for k in run]) for run in runs]
    return nodes[0], paths


def _manifest(rows):
    """[(doc_id, leaf, subroot, root, proof)] of (doc_id, source, lang, n_chars, text)."""
    low = (0, b"")
    rows = sorted(rows, key=lambda r: (low if r[1] is None else (1, r[1].encode()), (0, 0) if r[0] is None else (1, r[0]), _leaf(r)))
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    made = {s: _tree([_leaf(r) for r in g]) for s, g in groups.items()}
    root, upper = _tree([made[s][0] for s in groups])
    return [(r[0], _leaf(r), made[s][0], root, own + upper[k])
            for k, (s, g) in enumerate(groups.items()) for r, own in zip(g, made[s][1])]


DDL = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("sizes", [[1], [2], [3, 4], [243, 1, 244], [1000, 7, 9, 28, 1, 2], [3] * 11])
def test_against_brute_force(spark, sizes):
    rows = [(i, f"s{k:02d}", "en", i, f"text {k} {i}\n") for k, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows[::-1], DDL).repartition(5)
    shown = F.when(F.col("doc_id") % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    got = merkle.documents_manifest(docs, tampered=shown).collect()
    want = _manifest(rows)
    assert sorted((r["doc_id"], r["leaf"], r["subroot"], r["root"], [tuple(p) for p in r["path"]]) for r in got) == sorted(want)
    by_leaf, by_row = {w[1]: w for w in want}, {_leaf(x): x for x in rows}
    for r in got:
        assert r["verified"] == (r["doc_id"] % 2 == 1)
        at = by_leaf[r["leaf"]][1]
        if r["doc_id"] % 2 == 0:  # the tampered leaf, folded by hand
            row = by_row[r["leaf"]]
            at = _leaf((*row[:4], row[4].replace("\n", "")))
        for left, right in by_leaf[r["leaf"]][4]:
            at = _h(left, at, right)
        assert at == r["folded_root"]
    proof = merkle.documents_manifest(docs).select("leaf", merkle.proof_digest(F.col("path")).alias("p")).collect()
    assert all(r["p"] == _h(*[x + y for x, y in by_leaf[r["leaf"]][4]]) for r in proof)


def test_intervals_nest(spark):
    rows = [(i, f"s{i % 3}", None, 0, "t") for i in range(900)]
    docs = spark.createDataFrame(rows, DDL).withColumn("leaf", F.sha2(F.col("doc_id").cast("string"), 256))
    nodes = merkle.build(docs, "source", ["doc_id"], "leaf", ["doc_id"]).nodes.collect()
    for tree in (0, 300, 600):
        level = {}
        for r in nodes:
            if r["tree"] == tree:
                level.setdefault(r["level"], []).append((r["lo"], r["hi"]))
        assert sorted(len(v) for v in level.values()) == [1, 2, 4, 12, 34, 100, 300]
        for v in level.values():  # each level tiles the tree's ranks
            v.sort()
            assert v[0][0] == tree and v[-1][1] == tree + 299 and all(a[1] + 1 == b[0] for a, b in zip(v, v[1:]))
    assert sorted((r["level"], r["lo"], r["hi"]) for r in nodes if r["tree"] is None) == [
        (0, 0, 299), (0, 300, 599), (0, 600, 899), (1, 0, 899)]


def test_many_equal_rows(spark):
    rows = [(None, None, "en", 1, "same")] * 2000 + [(i, None, "en", 1, "own") for i in range(20)]
    got = merkle.documents_manifest(spark.createDataFrame(rows, DDL)).collect()
    assert sorted((str(r["doc_id"]), r["leaf"], r["root"], [tuple(p) for p in r["path"]]) for r in got) == sorted(
        (str(w[0]), w[1], w[3], w[4]) for w in _manifest(rows))


def test_odd_rows(spark, odd, none):
    got = merkle.documents_manifest(odd).collect()
    want = _manifest([(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in odd.collect()])
    assert sorted((str(r["doc_id"]), r["leaf"], r["subroot"], r["root"], [tuple(p) for p in r["path"]]) for r in got) == sorted(
        (str(w[0]), *w[1:]) for w in want)
    assert all(r["verified"] for r in got) and merkle.documents_manifest(none).count() == 0


def test_registered_query(spark):
    from ledgerline.llm.queries import op11_nested_intervals
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    want = {w[0]: w for w in _manifest(rows)}
    got = op11_nested_intervals(spark, sf).collect()
    assert len(got) == len(rows)
    text = {r[0]: r[4] or "" for r in rows}
    for r in got:
        _, leaf, subroot, root, path = want[r["doc_id"]]
        assert (r["leaf"], r["subroot"], r["root"]) == (leaf, subroot, root) and r["proof_sha256"] == _h(*[a + b for a, b in path])
        same = zlib.crc32(str(r["doc_id"]).encode()) % 2 == 1 or "\n" not in text[r["doc_id"]]
        assert r["verified"] == same
