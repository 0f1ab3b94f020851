import itertools
import random
import re
from html import unescape

import corpus_pipeline
import numpy as np
import pytest

from helpers import linked_components, prose, table
from waybill.llm import decontamination, html, queries, sharding
from waybill.session import scratch_path

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a = "</p><p>no";</script></head><body class="page">
<header><p>Welcome to the site that has news for all.</p></header><nav><ul><li><a href="/a">Alpha</a></li><li><a href="/b">Beta</a></li></ul></nav>
<div id="cookie-notice"><p>We use cookies, do you agree with all of that?</p></div>
<article><h1>Head &amp; line</h1><p>First  <b>bold</b>&nbsp;text &lt;here&gt;.<p>Short</p><div class="ad-box"><p>Buy now, it is cheap, it is good.</p></div>
<ul><li>one</li><li>two</li></ul><p>Last words, with a comma.</article>
<aside><p>Other things to read, of all sorts.</p></aside><section class="comments"><p>Great text, I read all of it with joy.</p></section>
<form><p>Sign up for the letter.</p></form><footer>&copy; 2020 <p>All of it ours.</p></footer>"""


def test_article_without_the_rest():
    assert html.main_text(PAGE).split("\n") == ["Head & line", "First bold text <here>.", "Short", "one", "two", "Last words, with a comma."]


def test_broken_and_empty_pages():
    assert html.main_text(None) == html.main_text("") == html.main_text("<p></p>") == ""
    assert html.main_text("plain words only") == "plain words only"
    assert html.main_text("<article><p>a < b and c<") == "a < b and c<"
    assert html.main_text("<article><p>a</p><p") == "a" and html.main_text("<article><script>x") == ""
    assert html.main_text("<article><p>" + "w " * 50_000 + "</p></article>").count("w") == 50_000


def test_deep_and_wide_pages():
    assert html.main_text("<div>" * 3000 + "<p>deep text, here.</p>") == "deep text, here."
    wide = html.main_text("<article>" + "".join(f"<p>p{k}.</p>" for k in range(5000)) + "</article>")
    assert len(wide.split("\n")) == 5000


def test_cut_is_the_least(monkeypatch):
    rng = random.Random(4)
    for _ in range(60):
        n = rng.randrange(1, 9)
        keep, drop = ([rng.randrange(0, 9) / 2 for _ in range(n)] for _ in range(2))
        edges = [(a, b, rng.randrange(1, 5) / 2) for a, b in itertools.combinations(range(n), 2) if rng.random() < 0.4]

        def cost(side):
            return sum(drop[k] if s else keep[k] for k, s in enumerate(side)) + sum(w for a, b, w in edges if side[a] != side[b])

        least = min(cost(s) for s in itertools.product([False, True], repeat=n))
        assert cost(html.source_side(keep, drop, edges)) == pytest.approx(least)


def test_given_pages(spark, folder):
    pages = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = queries.op9_main_text(spark, folder).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id].html, re.S)[1]
        parts = (" ".join(unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in re.split(r"</?p>|</?h1>", article))
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_leaks_with_substitutions(spark):
    tests = [(k, prose(f"item{k}", 12 + 3 * k, 5000)) for k in range(8)] + [(90, None), (91, "too short"), (92, "")]
    rng = random.Random(1)
    rows = [(k, prose(f"doc{k}", 300, 5000)) for k in range(40)]
    planted = {}
    for k in range(8):
        words = tests[k][1].split()
        for at in rng.sample(range(len(words)), len(words) // 12):
            words[at] = "other"
        body = rows[k][1].split()
        rows[k] = (k, " ".join(body[:100] + [w.upper() if k % 2 else w + "," for w in words] + body[100:]))
        planted[k] = {k}
    rows += [(100, None), (101, ""), (None, tests[3][1]), (102, tests[2][1] + " " + tests[5][1]), (103, " ".join(tests[7][1].split()[:5]))]
    found = {r.doc_id: set(r.item_ids) for r in decontamination.report(table(spark, rows), items(spark, tests)).collect()}
    assert found == planted | {None: {3}, 102: {2, 5}}
    kept = {r.doc_id for r in decontamination.clean(table(spark, rows), items(spark, tests)).collect()}
    assert kept == {i for i, _ in rows} - found.keys()


def test_leaks_of_nothing(spark):
    assert decontamination.report(table(spark, []), items(spark, [(1, prose(1, 20))])).count() == 0
    assert decontamination.report(table(spark, [(1, prose(1, 20))]), items(spark, [])).count() == 0


def test_best_run():
    equal = np.array([1, 0, 1, 1, 1, 1, 0, 1, 1, 1, 1, 0, 0, 1], bool)
    assert decontamination.best_run(equal) == (2, 11, 8)
    assert decontamination.best_run(np.zeros(3, bool))[2] == 0


def test_pipeline_stage_by_stage(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = scratch_path(spark, f"test-{number}")
        stage(spark, docs, folder).write.parquet(path)
        before, docs = docs.collect(), spark.read.parquet(path)
        after = docs.collect()
        if name != "sharding":
            assert docs.columns == columns
        kept = {r.doc_id for r in after}
        if name == "ngram_join":
            assert kept == {least for _, least in linked_components([(r.doc_id, r.text) for r in before]).values()}
        if name == "decontamination":
            leaks = {r.doc_id for r in decontamination.report(spark.createDataFrame(before, docs.schema), spark.read.parquet(f"{folder}/benchmark.parquet")).collect()}
            assert kept == {r.doc_id for r in before} - leaks
        if name == "toxicity":
            toxic = {r.doc_id for r in queries.op6_toxic_grammar(spark, folder).where("predicted = 1").collect()}
            assert toxic and kept == {r.doc_id for r in before} - toxic
        if name == "sharding":
            assert len(after) == len(before) and docs.columns == sharding.shard_sheet(spark.createDataFrame(before, spark.createDataFrame(before).schema), [1.0]).columns


def test_texts_are_searched_in_small_batches(spark, monkeypatch):
    """Batches of 10,000 texts, Spark's default, held far more memory than the search needs."""
    name, sizes, save = "spark.sql.execution.arrow.maxRecordsPerBatch", {}, decontamination.cut_lineage
    before = spark.conf.get(name)

    def watched(df):
        if "hits" in df.columns:
            sizes["hits"] = int(spark.conf.get(name))
        return save(df)

    monkeypatch.setattr(decontamination, "cut_lineage", watched)
    items = spark.createDataFrame([(1, prose("item", 30, 5000))], "item_id long, text string")
    rows = [(k, prose(k, 40, 5000)) for k in range(30)] + [(99, prose(99, 20, 5000) + " " + prose("item", 30, 5000))]
    assert [r.doc_id for r in decontamination.leaks(table(spark, rows), items).collect()] == [99]
    assert sizes["hits"] <= 1000 and spark.conf.get(name) == before
