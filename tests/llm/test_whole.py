"""Inputs on which an operator once did less than the whole job."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import (decontaminate, embedding_dedup, html_extract, language_id, line_dedup, merkle, mixing, quality, sharding, simhash,
                            spelling, token_output, toxicity)

# Names of columns that operators add, on the way or at the end.
CLASHES = ("_bad _id _tkey _t _u _text _ls _kept _row _n _copies copies paths _paths _host host _found found row lang_pred word n run h cell "
           "piece tree pos lo hi digest carry path _rank _part _at leaf shown threshold flagged size spans tkey hit ws gaps fp root").split()

VECS = "vec_id long, embedding array<float>"


def _groups(r, cosines, size, noise, dim=64):
    """Tight groups around a first centre and others at the given cosines to it."""
    q = np.linalg.qr(r.normal(size=(dim, dim)))[0]
    centres = [q[0]] + [c * q[0] + np.sqrt(1 - c * c) * q[i + 1] for i, c in enumerate(cosines)]
    return np.concatenate([c + r.normal(size=(size, dim)) * noise / np.sqrt(dim) for c in centres]).astype(np.float32)


def _links(x, least=0.9):
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    return (u @ u.T >= least).sum(1) - 1


@pytest.mark.parametrize("cosine", [0.93, 0.905])
def test_embeddings_full_lists_link_across(spark, cosine):
    r = np.random.default_rng(3)
    x = np.concatenate([_groups(r, [cosine], 60, 0.1), r.normal(size=(300, 64)).astype(np.float32)])
    want = _links(x)
    assert want[:60].max() > 59  # some links go across
    found = embedding_dedup.near_duplicates(spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], VECS))
    got = {y["vec_id"]: y for y in found.links.collect()}
    assert [got[i]["n_links"] for i in range(len(x))] == want.tolist()
    assert {got[i]["component_id"] for i in range(120)} == {0}


def _vecs(spark, x):
    return spark.createDataFrame([(i, 1, [float(c) for c in v]) for i, v in enumerate(x)], "id long, m long, x array<float>")


def test_audit_weighs_vectors_alike(spark):
    r = np.random.default_rng(5)
    pairs = np.repeat(r.normal(size=(50, 64)).astype(np.float32), 2, 0)
    x = np.concatenate([_groups(r, [], 100, 0.1), pairs])
    counts = spark.createDataFrame([(i, 99) for i in range(100)], "id long, links long")  # no pair was found
    assert embedding_dedup._audit(_vecs(spark, x), counts, 64, 0.9) < 0.6


def test_audit_looks_until_it_sees_links(spark):
    x = np.random.default_rng(6).normal(size=(2000, 64)).astype(np.float32)
    x[1] = x[0]
    none = spark.createDataFrame([], "id long, links long")
    assert embedding_dedup._audit(_vecs(spark, x), none, 64, 0.9) == 0.0


def test_audit_of_a_table_without_links_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "DRAWN", 800)
    x = np.random.default_rng(6).normal(size=(4000, 16)).astype(np.float32)
    drawn = []
    real = type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, v: (drawn.append(len(v[0])), real(self, v))[1])
    none = spark.createDataFrame([], "id long, links long")
    assert embedding_dedup._audit(_vecs(spark, x), none, 16, 0.999) == 1.0 and 600 < sum(drawn) < 1800


def test_embeddings_never_return_short_of_recall(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "_audit", lambda *a: 0.5)
    x = np.random.default_rng(7).normal(size=(30, 8)).astype(np.float32)
    with pytest.raises(RuntimeError):
        embedding_dedup.near_duplicates(spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], VECS))


def test_keep_one_of_each_group(spark):
    r = np.random.default_rng(8)
    text = [" ".join(f"t{w}" for w in r.integers(0, 5000, 80)) for _ in range(12)]
    rows = [(None, t, i) for i, t in enumerate(text[:8])]  # clean documents without ids
    rows += [(1, text[8], 8), (1, text[9], 9)]  # two texts share an id
    rows += [(None, text[10], 10), (5, text[10], 11), (4, text[10], 12), (4, text[10], 12), (1, text[10] + " ", 13)]
    rows += [(7, text[11], 14), (7, text[11], 14)]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, n long"))
    assert sorted(x["n"] for x in kept.collect()) == [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 13, 14]


@pytest.mark.parametrize("page", [
    "<article><h1>Title</h1><p>Lead</p><div class=body><p>{long}</p></div><p>End</p></article>",
    "<div class=site><div class=post><h1>Title</h1><p>Lead</p><div class=body><div><p>{long}</p></div></div><p>End</p></div></div>",
    "<main><section><h1>Title</h1></section><section><p>Lead</p></section><section><p>{long}</p></section><section><p>End</p></section></main>",
    "<article><h1>Title</h1><p>Lead</p><blockquote><p>{long}</p></blockquote><p>End</p></article>",
    "<article><h1>Title</h1><p>Lead</p><ul><li>{long}</ul><p>End</p></article>"])
def test_html_climbs_to_the_whole_article(page):
    long = "Words of a long body. " * 20
    html = "<body><nav><a href=/>Home</a></nav>" + page.format(long=long) + "<div><a href=/x>More</a></div><footer>(c)</footer>"
    p = html_extract.Page(html)
    assert p.text([p.vote()[0]]).split("\n\n") == ["Title", "Lead", long.strip(), "End"]


@pytest.mark.parametrize("beside,want", [
    ("<table><tr><td>one</td><td>two</td></tr></table>", ["one", "two"]), ("<ul><li>first</li><li>second</li></ul>", ["first", "second"]),
    ("Plain text of a good many words without any paragraph around it.", ["Plain text of a good many words without any paragraph around it."]),
    ("<blockquote>Short words</blockquote>", ["Short words"]), ("<dl><dt>Term</dt><dd>Meaning</dd></dl>", ["Term", "Meaning"]),
    ("<pre>x = 1</pre>", ["x = 1"]), ("&copy; Somebody", []), ("<ul><li><a href=/a>Other page</a></li><li><a href=/b>One more</a></li></ul>", [])])
def test_html_climbs_over_tables_lists_and_plain_text(beside, want):
    body = "".join(f"<p>Paragraph {i} has a few words of its own.</p>" for i in range(6))
    p = html_extract.Page(f"<body><nav><a href=/>Home</a></nav><div class=wrap><div class=a>{body}</div><div class=t>{beside}</div></div>")
    assert p.text([p.vote()[0]]).split("\n\n") == [f"Paragraph {i} has a few words of its own." for i in range(6)] + want


def test_html_judges_inline_elements():
    html = ("<article><p>One <span hidden>secret <span>deep</span> more</span>two <span style='display:none'>x</span><b class=ad>Buy!</b> three "
            "<i class='notice of-death'>four</i> <em class=intro>five</em> <span aria-hidden=true>&#9733;</span><b hidden>open</p><p>Six</p></article>")
    assert html_extract.Page(html).text([]).split("\n\n") == ["One two three four five open", "Six"]


@pytest.mark.parametrize("tag", ["title", "textarea", "iframe", "noscript"])
def test_html_open_raw_elements_skip_their_tag(tag):
    assert html_extract.Page(f"<article><p>One</p><{tag}><p>Two</p></article>").text([]).split("\n\n") == ["One", "Two"]
    assert html_extract.Page(f"<article><p>One</p><{tag}>gone</{tag}><p>Two</p></article>").text([]).split("\n\n") == ["One", "Two"]


def test_html_of_very_long_pages():
    body = "".join(f"<p>Line {i} &amp; <b class=ad>ad</b>more" for i in range(30_000))
    text = html_extract.Page(f"<body><article>{body}</article><footer>x</footer>").text([])
    assert text.split("\n\n") == [f"Line {i} & more" for i in range(30_000)]


@pytest.mark.parametrize("page", [
    "<div class='site has-sidebar'><h1>Title</h1><p>{long}</p><div class=sidebar><p>Buy</p></div></div>",
    "<div class='site-header-menu'><h1>Title</h1><p>{long}</p></div><div id=sidebar><p>Buy</p></div>",
    "<article class='post tag-cookies category-social'><h1>Title</h1><p>{long}</p></article><div id=comments><p>Nice</p></div>",
    "<form id=aspnet><div><h1>Title</h1><p>{long}</p></div><div class=newsletter-signup><p>Mail</p></div></form>",
    "<article><h1>Title</h1><p>{long}</p></article><section id=comments><ol><li><div class=x><p>{long}{long}</p></div></ol></section>"])
def test_html_words_drop_parts_but_no_wrappers(page):
    long = "Words of a long body. " * 20
    p = html_extract.Page("<body>" + page.format(long=long))
    assert p.text([]).split("\n\n") == ["Title", long.strip()]


def test_html_slugs_and_open_elements_keep_the_text():
    html = ("<article><h1>Title</h1><p>One.</p><h2 id=related-work>Related work</h2><p>Two <math><mi>x</mi><mo>=</mo><mn>1</mn></math>.</p>"
            "<section id=social-impact><p>Three.</p></section><div id=alert-systems><p>Four.</p></div><button>Ad</button>{open}<p>Five.</p></article>")
    want = ["Title", "One.", "Related work", "Two x=1.", "Three.", "Four.", "Five."]
    for tag in ("", "<button>", "<select>", "<svg>", "<math>", "<object>", "<canvas>"):
        for rest in ("", "<div><button>Ad</button></div><div><canvas>Ad</canvas></div>"):
            p = html_extract.Page(html.replace("{open}", tag) + rest)
            assert p.text([]).split("\n\n") == want, (tag, rest)


def test_clashing_columns(spark, odd):
    docs = odd.select("*", *[F.lit("own").alias(c) for c in CLASHES])
    bench = spark.createDataFrame([(1, "quick brown fox", "own")], "item_id long, text string, _bad string")
    labels = spark.createDataFrame([(1, 1, 1, "own"), (2, 0, 0, "own")], "doc_id long, quality int, toxic int, text string")

    def owned(df):
        """Every clashing column is still there as it came."""
        assert all({r[c] for r in df.select(c).collect()} == {"own"} for c in CLASHES)
        return df

    assert owned(line_dedup.remove_boilerplate(docs, min_sites=2)).count() == odd.count()
    assert owned(mixing.take_mix(docs)).columns == docs.columns
    assert owned(simhash.keep_one(docs)).columns == docs.columns
    assert owned(decontaminate.remove_contaminated(docs, bench)).columns == docs.columns
    assert {r["word"] for r in language_id.identify(docs, language_id.fit(docs)).collect()} == {"own"}
    n = odd.count()
    for out in (sharding.shard_documents(docs), decontaminate.contamination(docs, bench), decontaminate.remove_spans(docs, bench),
                quality.score_quality(docs, quality.fit(docs, labels)), simhash.near_duplicates(docs), token_output.tokenize(docs),
                mixing.mix(docs), merkle.documents_manifest(docs), toxicity.score_toxicity(docs, *toxicity.fit(docs, labels))):
        assert out.count() == n
    assert spelling.document_variants(docs).count() == spelling.document_variants(odd).count()
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("http://a.example").alias("url"), F.col("text").alias("html"), *CLASHES)
    assert owned(html_extract.extract(pages)).count() == n
    vecs = spark.range(30).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.col("id").cast("double")).alias("embedding"),
                                  *[F.lit("own").alias(c) for c in CLASHES if c != "id"], F.lit("own").alias("x"), F.lit("own").alias("m"))
    assert embedding_dedup.near_duplicates(vecs).links.count() == 30


def test_pipeline_on_odd_rows(spark, odd, none):
    import corpus_pipeline
    say = {"en": "the and with this that shall think ", "de": "und nicht über schön ich größer "}
    rows = [(1000 + i, " ".join(np.random.default_rng(i).permutation(say[k].split())) * 3 + f" x{i}y", k, f"s{i % 3}")
            for i in range(320) for k in [("en", "de")[i % 2]]]
    foreign, unfiled, signs = 5001, 5006, 5013  # none of them is fitted on
    rows += [(foreign, say["de"] * 8, "en", "s0"), (unfiled, say["de"] * 8, None, "s0"), (signs, "12 34 ½", "en", "s0")]
    plain = spark.createDataFrame([(*r, None, "x", "y") for r in rows], odd.schema)
    docs = plain.unionByName(odd).select("*", *[F.lit("own").alias(c) for c in CLASHES])
    first = corpus_pipeline.known_language(spark, docs, "/root/testdata/sf0.001")
    kept = {r["doc_id"]: r for r in first.collect()}
    assert foreign not in kept and unfiled in kept and signs not in kept
    assert all(r[0] in kept for r in rows[:320]) and first.columns == docs.columns and kept[unfiled]["lang_pred"] == "own"
    assert not {2, 3, 4, 6} & set(kept)  # null, empty, without letters
    d = first
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        d = stage(spark, d, "/root/testdata/sf0.001")
        assert d.columns == docs.columns
    assert corpus_pipeline.STAGES[-1][1](spark, d, "").count() == d.count() > 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, "/root/testdata/sf0.001").count() == 0
