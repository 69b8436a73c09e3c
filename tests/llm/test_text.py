"""BPE, classifiers, page extraction: against a library, by round trip, on held-out rows."""

import hashlib
import random

import numpy as np
import pytest
import tokenizers
from pyspark.sql import functions as F

from ledgerspark.llm import bpe, html_text, quality, queries, toxicity
from ledgerspark.llm.common import bounded_sample
from ledgerspark.llm.html_blocks import blocks

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, ids string"


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(queries.vocabulary_path())


def test_encoding_equals_the_library(codec):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.vocabulary_path())
    rng = random.Random(3)
    pool = list("aA'sd tlvermé ß\u0085\u3000\n\t\x1c1²٣你👍🏽́ǅ_-\x00\U0010ffff") + ["<|endoftext|>", "'ll", "\r\n", "aaaa"]
    texts = ["", " ", "a" * 5000, "\n" * 300 + "x", *("".join(rng.choices(pool, k=rng.randint(1, 40))) for _ in range(800))]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == ids
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False) == text


def test_fragments_join_to_the_piece_and_no_token_spans_a_cut(codec):
    for piece in (" thanedble", "&&&\n$$", "naïve", "x\x00y"):
        parts = codec.fragments(piece.encode())
        assert b"".join(parts) == piece.encode()
        assert all((a[-1], b[0]) not in codec.joined for a, b in zip(parts, parts[1:]))


def test_encode_rows_of_all_kinds(spark, codec):
    rows = [(1, "a b", None, None, None, None, None), (1, "a b", *[None] * 5), (None, None, *[None] * 5), (3, "", *[None] * 5)]
    docs = spark.createDataFrame(rows, DOCS)
    found = bpe.encode_documents(docs, queries.vocabulary_path()).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, r.decoded) for r in found) == [(0, 0, ""), (1, 2, "a b"), (1, 2, "a b"), (3, 0, "")]
    digests = bpe.encode_digests(docs, queries.vocabulary_path())
    assert digests.count() == 4 and digests.select("ids_sha256").distinct().count() == 2
    assert bpe.encode_digests(docs.limit(0), queries.vocabulary_path()).count() == 0


@pytest.mark.parametrize("name,label,least", [("op9_toxicity", "toxic", 0.85), ("op2_quality", "quality", 0.95)])
def test_classifiers_on_held_out_rows(spark, name, label, least):
    folder = "/root/testdata/sf0.01"
    scored = queries.queries()[name](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", F.col(label).alias("y"))
    held = scored.filter("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.y for r in held]) >= least
    assert scored.count() == 1000 and scored.filter("score < 0 or score > 1 or score is null").isEmpty()


def test_classifiers_without_rows_and_with_odd_rows(spark):
    rows = [(i, "good plain words here." if i % 3 else "idiot words", *[None] * 5) for i in range(60)]
    docs = spark.createDataFrame([*rows, (None, None, *[None] * 5), (5, "", *[None] * 5)], DOCS)
    labels = spark.createDataFrame([(i, i % 3 != 0, i % 3 == 0) for i in range(60)] + [(None, None, None)], "doc_id long, quality boolean, toxic boolean")
    model = toxicity.fit_toxicity(docs, labels)
    assert toxicity.score_toxicity(docs, model).count() == 62
    assert toxicity.keep_clean(docs, model).columns == docs.columns
    assert toxicity.keep_clean(docs, model).filter("text like '%idiot%'").isEmpty()
    assert quality.score_quality(docs, quality.fit_quality(docs, labels)).filter("score is null").isEmpty()
    for fit, keep in ((toxicity.fit_toxicity, toxicity.keep_clean), (quality.fit_quality, quality.keep_good)):
        assert keep(docs, fit(docs, labels.limit(0))).count() == 62
        assert keep(docs.limit(0), fit(docs.limit(0), labels)).count() == 0


def test_a_rare_toxic_word_counts_beside_thousands_of_commoner_slots(spark):
    rng = random.Random(6)
    junk = ["".join(rng.choices("bcdfghjk", k=8)) for _ in range(300)]
    plain = "we met at the old mill and talked about the harvest until it rained on the road home".split()
    rows = [(i, " ".join(rng.choices(plain, k=12) + rng.sample(junk, 60 if i < 300 else 6))) for i in range(1200)]
    rows += [(i, " ".join([*rng.choices(plain, k=12), "zorgulant"])) for i in range(1200, 1212)]
    docs = spark.createDataFrame([(i, t, *[None] * 5) for i, t in rows], DOCS)
    labels = spark.createDataFrame([(i, i < 300 or i >= 1200) for i, _ in rows], "doc_id long, toxic boolean")
    model = toxicity.fit_toxicity(docs, labels)
    assert model.score("a zorgulant went home") >= 0.5 > model.score("the mill on the road")
    assert min(model.score(t) for _, t in rows[:300]) >= 0.5 > max(model.score(t) for _, t in rows[300:1200])


def test_prior_and_non_negative_risk_on_known_mixtures():
    rng = np.random.default_rng(0)
    positive = rng.normal(2, 1, (1500, quality.WIDTH))
    unlabelled = np.vstack([rng.normal(2, 1, (1200, quality.WIDTH)), rng.normal(-2, 1, (800, quality.WIDTH))])
    model = quality.fit_measures(positive, unlabelled)
    assert abs(model.prior - 0.6) < 0.08
    assert (model.logits(unlabelled[1200:]) < 0).mean() > 0.95 and (model.logits(positive) > 0).mean() > 0.9


PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><script>var t='</p>';</script></head><body><nav><ul><li><a href='/'>Home</a>"
    "</li><li><a href='/x'>More</a></li></ul></nav><!-- ad --><div class=\"ad\">Buy this now.</div><article><h1>The  title</h1>"
    "<p><b>One &amp; two.<br><p>Three\nfour&nbsp;five.</article><div class='comments'><p>First!</p></div><footer>&copy; me</footer>"
)


def test_blocks_of_a_page():
    texts = ["T", "Home", "More", "Buy this now.", "The title", "One & two.", "Three four five.", "First!", "© me"]
    assert [b.text for b in blocks(PAGE)] == texts
    assert blocks("") == [] and [b.text for b in blocks("a<br>b<p>c <i>d</i>e</p><a hre")] == ["a b", "c de"]


@pytest.mark.parametrize("name", "noscript template iframe svg math object audio video canvas".split())
def test_only_scripts_and_styles_are_no_content(name):
    closed = blocks(f"<article><p>One.</p><{name} class='x'><p>Inside.</p></{name}><p>Two.</p></article>")
    assert [b.text for b in closed] == ["One.", "Inside.", "Two."]
    assert name in closed[1].path and name not in closed[2].path
    assert [b.text for b in blocks(f"<article><p>One.</p><{name}><p>Two.</p></article><p>Three.")] == ["One.", "Two.", "Three."]
    assert [b.text for b in blocks(f"<p>a</p><{name}/><p>b</p>")] == ["a", "b"]
    assert [(b.path, b.text) for b in blocks(f"<p>a <{name}><g>x</g></{name}> b</p>")] == [(("p",), "a"), (("p", name, "g"), "x"), (("p",), "b")]
    assert [b.path for b in blocks("<p>a<svg/><p>b<svg><path d='M0'/><text>c</text></svg><p>d")] == [("p",), ("p",), ("p", "svg", "text"), ("p",)]


@pytest.mark.parametrize(
    ("page", "texts"),
    [
        ("<article><p title=it's>We don't know</p><p>second</p></article>", ["We don't know", "second"]),
        ("<p title=it's>No other quote", ["No other quote"]),
        ('<p a=5" b>Five "inches" wide</p>', ['Five "inches" wide']),
        ("<p>one</p><!--> <p>two</p>", ["one", "two"]),
        ("<p>one</p><!---> <p>two</p>", ["one", "two"]),
        ("<p>one</p><!-- x --!> <p>two</p><!-- -- > --><p>three</p>", ["one", "two", "three"]),
        ('<p>See <a href="x>this</a> text</p><p class="y">next</p>', ["See this text", "next"]),
        ("<p>See <a href='x>that</a> it's so</p>", ["See that it's so"]),
        ('<p title="a > b" data-x = \'<i>no</i>\'>body</p>', ["body"]),
        ('<p class="a"id="b">body</p><img alt="a > b"/>end', ["body", "end"]),
        ("<script>a</script x><p>one</p><style>b</style/><p>two</p>", ["one", "two"]),
    ],
)
def test_quotes_and_comments_swallow_no_text(page, texts):
    assert [b.text for b in blocks(page)] == texts


def test_samples_are_bounded_where_one_row_fills_a_third(spark):
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("url"), F.lit("x").alias("html"))
    for bound in (0, 1, 400, 9000, 10_000):
        assert bounded_sample(rows, ["url", "html"], bound).count() == min(bound, 9000)
    assert sorted(bounded_sample(rows, ["url"], 50).collect()) == sorted(bounded_sample(rows.repartition(5), ["url"], 50).collect())
    assert bounded_sample(rows.limit(0), ["url"], 5).count() == 0


def test_digests_equal_the_library_s(spark):
    folder = "/root/testdata/sf0.001"
    library = tokenizers.Tokenizer.from_file(queries.vocabulary_path())
    library.no_truncation()
    library.no_padding()
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = queries.op3_bpe(spark, folder).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_labeller_on_unseen_layouts_and_the_table(spark):
    model = html_text.fit_labeller(*html_text.written_examples(200), rounds=20)
    pages, labels = html_text.written_examples(100, seed=5)
    assert np.mean(np.concatenate([a == b for a, b in zip(model.label(pages), labels)])) > 0.97
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    odd = spark.createDataFrame([(None, None, None), (7, "u", PAGE), (7, "u", PAGE), (8, "u", "")], "page_id long, url string, html string")
    found = {r.page_id: r for r in html_text.extract_text(odd, html_text.fit_on_pages(pages)).collect()}
    assert found[7].text == "The title\nOne & two.\nThree four five." and found[7].n_chars == len(found[7].text)
    assert found[None].text == found[8].text == ""


def test_every_page_keeps_its_marked_article(spark):
    folder = "/root/testdata/sf0.01"
    html = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    for r in queries.op8_main_text(spark, folder).collect():
        page = blocks(html[r.page_id])
        assert r.text == "\n".join(b.text for b, ok in zip(page, html_text.marked_labels(page)) if ok)
