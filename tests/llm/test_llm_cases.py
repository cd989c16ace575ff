"""Cases that once went wrong: clashing names, relative links, texts of marks only, places beyond 24 bits."""

import itertools

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import language, quality, urls


def test_quality_stage_keeps_columns_of_any_name(spark):
    rows = [(i, "en", "s", f"word{i} " * 60 if i % 9 else None, i, i, "a", 1.5, "b", True) for i in range(40)]
    names = "doc_id long, lang string, source string, text string, _k1 int, n_words int, distance string, `a.b` double, _g string, kept boolean"
    docs = spark.createDataFrame([*rows, rows[1], (None, None, None, " ".join(f"w{k}" for k in range(70)), 0, 0, "", 0.0, "", None)], names)
    kept = quality.reject(docs)
    assert kept.schema == docs.schema
    # every text repeats its three-word windows but the last row's
    assert [r.doc_id for r in kept.collect()] == [None]
    assert quality.reject(docs.limit(0)).count() == 0
    stages = dict(corpus_pipeline.STAGES)
    assert stages["quality rules"](spark, docs, "").columns == docs.columns


@pytest.mark.parametrize("bits", [24, 3])
def test_places_of_windows_take_as_many_bits_as_needed(spark, bits, monkeypatch):
    monkeypatch.setattr(quality, "_PLACE_BITS", bits)
    text = " ".join(itertools.chain((f"w{i}" for i in range(700)), ["a", "b", "c", "d", "x", "a", "b", "c", "d"], (f"v{i}" for i in range(400))))
    row = quality.statistics(spark.createDataFrame([(text,)], "text string")).first()
    assert (row.n_words, row.n_repeat_words) == (1109, 8)


def test_texts_of_marks_have_no_language(spark):
    rows = [("de", "ein text auf deutsch"), ("xx", "́̂ ̃"), ("fr", "un texté")]
    model = language.fit(spark.createDataFrame(rows, "lang string, text string"))
    assert sorted(model) == ["de", "fr"]
    got = language.predict(spark.createDataFrame([(1, "́̂"), (2, "12 ́"), (3, "é")], "doc_id long, text string"), model).collect()
    assert [r.lang_pred == "und" for r in got] == [True, True, False]


def canonical(*targets):
    return "".join(f'<link rel="canonical" href="{t}">' for t in targets)


@pytest.mark.parametrize("url,target,blocked", [
    ("http://c.net/a/x", "y", "c.net/a/y"), ("http://c.net/a/x?q=1", "../b", "c.net/b"), ("http://c.net/a/b/", "./../z/", "c.net/a/z/"), ("http://c.net/a/x", "?q=2&amp;r", "c.net/a/x?q=2&r"),
    ("http://c.net", "only", "c.net/only"), ("http://c.net/a", "//D.net/x/../y", "d.net/y"), ("http://c.net/a", "/go?u=http://x/", "c.net/go?u=http://x/"), ("http://c.net/a/", "https://e.net/..", "e.net/"),
    ("http://c.net/a/../k", "/k2", "c.net/k2"),
])
def test_links_relative_to_the_page(spark, url, target, blocked):
    pages = spark.createDataFrame([(1, url, canonical(target))], "page_id long, url string, html string")
    assert [r.b for r in urls.page_links(pages).collect()] == [blocked]
    host, _, path = blocked.partition("/")
    rules = (urls.Rule("block", host, "/" + path.split("?")[0]),)
    verdict = urls.filter_urls(pages, rules).first()
    own = urls.address(F.lit(url))
    assert verdict.verdict == "block" or spark.range(1).select(own).first()[0].split("?")[0].startswith(blocked.split("?")[0])


def test_all_tags_count_and_others_do_not(spark):
    html = canonical("one", "/two") + '<link rel="shortlink canonical" href="three"><meta http-equiv=refresh content="0; url=four"><link rel="icon" href="five">' + canonical("mailto:x@y", "#top")
    pages = spark.createDataFrame([(1, "http://c.net/p", html), (2, None, html), (3, "no url", html)], "page_id long, url string, html string")
    found = urls.page_links(pages).collect()
    assert {r.b for r in found if r.b != r.a} == {f"c.net/{n}" for n in ("one", "two", "three", "four")} and {r.a for r in found} == {"c.net/p"}
    rules = (urls.Rule("block", "c.net", "/three"),)
    assert [r.verdict for r in urls.filter_urls(pages, rules).orderBy("page_id").collect()] == ["block", "allow", "allow"]
