"""The registered query of each operator, and its DuckDB text where SQL can
say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, embedding_dedup, html_extract, language_id, line_dedup, merkle, mixing, quality, sharding, simhash, spelling, token_output, toxicity
from .common import table


def op1_site_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return line_dedup.remove_boilerplate(docs).select("doc_id", "n_lines", "n_removed", "text")


def op2_rendezvous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=40)


def op3_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op4_host_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract(pages).select("page_id", "url", "text", "n_chars")


def op5_ngram_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op6_byte_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs.select("doc_id", "text"), language_id.fit(docs))
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op7_elias_fano(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.tokenize(table(spark, sf_dir, "documents"))


def op8_pivot_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op9_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.9).links


def op10_pivotal(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op11_nested_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    without_breaks = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0,
                            F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = merkle.documents_manifest(table(spark, sf_dir, "documents"), tampered=without_breaks)
    return found.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
                        "folded_root", "verified")


def op12_word_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net, thresholds = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, net, thresholds)


def op13_kd_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.document_variants(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_site_spread, op2_rendezvous, op3_byte_cnn, op4_host_paths, op5_ngram_set, op6_byte_gru, op7_elias_fano,
                                   op8_pivot_tables, op9_nn_descent, op10_pivotal, op11_nested_intervals, op12_word_cnn, op13_kd_trees)}

ORACLE = {"op1_site_spread": r"""
WITH d AS (SELECT doc_id, source, row_number() OVER () AS rid, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT rid, source, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM d),
k AS (SELECT rid, source, line, i, trim(line, ' ' || chr(9) || chr(13) || chr(12) || chr(11)) AS bare FROM l),
bad AS (SELECT bare FROM k WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT coalesce(source, chr(0))) >= 10),
kept AS (SELECT rid, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS text FROM k
         WHERE bare NOT IN (SELECT bare FROM bad) GROUP BY rid)
SELECT doc_id, coalesce(len(ls), 0) AS n_lines, coalesce(len(ls), 0) - coalesce(n, 0) AS n_removed,
       CASE WHEN ls IS NOT NULL THEN coalesce(text, '') END AS text
FROM d LEFT JOIN kept USING (rid)
""", "op5_ngram_set": r"""
WITH pat AS (SELECT '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+' AS p),
d AS (SELECT doc_id, row_number() OVER () AS rid,
             CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), p) END AS ws
      FROM documents, pat),
b AS (SELECT item_id, regexp_extract_all(
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), p) AS ws
      FROM benchmark, pat WHERE text IS NOT NULL),
bw AS (SELECT item_id, ws, least(13, len(ws)) AS n, unnest(range(len(ws) - least(13, len(ws)) + 1)) AS pos0
       FROM b WHERE len(ws) > 0),
g AS (SELECT DISTINCT item_id, n, array_to_string(ws[pos0 + 1 : pos0 + n], ' ') AS gram FROM bw),
ns AS (SELECT DISTINCT n FROM g),
dw AS (SELECT rid, ws, ns.n, unnest(range(len(ws) - ns.n + 1)) AS pos0 FROM d, ns WHERE len(ws) >= ns.n),
h AS (SELECT rid, pos0, dg.n, item_id
      FROM (SELECT rid, pos0, n, array_to_string(ws[pos0 + 1 : pos0 + n], ' ') AS gram FROM dw) dg
      JOIN g ON g.n = dg.n AND g.gram = dg.gram),
w AS (SELECT DISTINCT rid, unnest(range(pos0, pos0 + n)) AS pos FROM h),
hw AS (SELECT rid, count(*) AS n_hit FROM w GROUP BY rid),
it AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hw USING (rid) LEFT JOIN it USING (rid)
"""}


def _merkle_sql(leaf_levels: int = 20, source_levels: int = 12) -> str:
    """The manifest level by level: enough levels for 3 ** leaf_levels rows a
    source and 3 ** source_levels sources; a level over one node changes
    nothing."""
    def leaf(text: str) -> str:
        fields = [f"CASE WHEN {c} IS NULL THEN '-' ELSE concat(strlen({c}::VARCHAR), ':', {c}::VARCHAR) END"
                  for c in ("doc_id", "source", "lang", "n_chars", text)]
        return f"sha256(concat({', '.join(fields)}))"

    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    crc = f"""list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: unicode(x)::BIGINT)),
           lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda c, i: {step}))"""

    def levels(name: str, count: int) -> list[str]:
        out = []
        for k in range(count):
            out.append(f"""{name}n{k} AS (SELECT *, coalesce(string_agg(digest, '') OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
             coalesce(string_agg(digest, '') OVER (o ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
             FROM {name}{k} WINDOW o AS (PARTITION BY g, pos // 3 ORDER BY pos))""")
            out.append(f"""{name}{k + 1} AS (SELECT g, pos // 3 AS pos, max((n + 2) // 3) AS n,
             CASE WHEN max(n) = 1 THEN max(digest) ELSE sha256(string_agg(digest, '' ORDER BY pos)) END AS digest
             FROM {name}{k} GROUP BY g, pos // 3)""")
            out.append(f"""{name}w{k + 1} AS (SELECT w.* REPLACE (CASE WHEN n > 1 THEN sha256(concat(l, folded, r)) ELSE folded END AS folded,
             CASE WHEN n > 1 THEN concat(proof, l, r) ELSE proof END AS proof, w.{name}pos // 3 AS {name}pos)
             FROM {name}w{k} w JOIN {name}n{k} x ON x.g = w.{name}g AND x.pos = w.{name}pos)""")
        return out

    parts = [f"""d AS (SELECT doc_id, source, {leaf('text')} AS leaf,
             CASE WHEN xor({crc}, 4294967295) % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf('text')} END AS shown FROM documents)""",
             "s AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS g, count(*) AS n FROM d GROUP BY source)",
             """a AS (SELECT d.*, g, n, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
             FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source)""",
             "t0 AS (SELECT g, pos, n, leaf AS digest FROM a)",
             "tw0 AS (SELECT doc_id, leaf, g AS tg, pos AS tpos, 0 AS ug, g AS upos, shown AS folded, '' AS proof FROM a)",
             *levels("t", leaf_levels),
             f"u0 AS (SELECT 0 AS g, g AS pos, (SELECT count(*) FROM s) AS n, digest FROM t{leaf_levels})",
             f"uw0 AS (SELECT * FROM tw{leaf_levels})", *levels("u", source_levels)]
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, x.digest AS subroot, y.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = y.digest AS verified
FROM uw{source_levels} w JOIN t{leaf_levels} x ON x.g = w.tg CROSS JOIN u{source_levels} y"""


ORACLE["op11_nested_intervals"] = _merkle_sql()

ORACLE["op13_kd_trees"] = r"""
WITH RECURSIVE r AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents),
g AS (SELECT doc_id, run, count(*) AS k, hex(encode(concat(doc_id, ':', run))) AS x FROM r WHERE length(run) >= 5 GROUP BY doc_id, run),
h AS (SELECT run, k, CASE WHEN doc_id IS NOT NULL THEN xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(0, length(x) // 2), lambda i: ('0x' || x[2 * i + 1 : 2 * i + 2])::BIGINT)),
        lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
                                 lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))) END AS h FROM g),
w AS (SELECT CASE WHEN h % 97 = 0 THEN run[1 : h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, k FROM h),
v AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM w WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
p AS (SELECT word, n, i, word[1 : i - 1] AS front, word[i + 1 :] AS back FROM v, LATERAL unnest(range(1, length(word) + 1)) AS t(i)),
e AS (SELECT DISTINCT a.word AS a, b.word AS b FROM p a JOIN p b ON a.i = b.i AND a.front = b.front AND a.back = b.back AND a.word <> b.word
      UNION SELECT p.word, v.word FROM p JOIN v ON v.word = p.front || p.back
      UNION SELECT v.word, p.word FROM p JOIN v ON v.word = p.front || p.back),
best AS (SELECT a AS word, count(*) AS n_near, min(struct_pack(k := -v.n, form := e.b)) AS best FROM e JOIN v ON v.word = e.b GROUP BY a),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.k >= 2 * v.n THEN best.form END AS form,
             CASE WHEN -best.k >= 2 * v.n THEN -best.k END AS form_n FROM v LEFT JOIN best USING (word)),
up AS (SELECT word, word AS root, form FROM f UNION ALL SELECT up.word, f.word, f.form FROM up JOIN f ON f.word = up.form)
SELECT f.word, f.n, f.form, f.form_n, up.root, f.n_near FROM f JOIN up ON up.word = f.word AND up.form IS NULL
"""
