"""Main text of pages, and quality rules."""

import html
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from supplierlens.llm import html_extract, quality_rules
from supplierlens.llm.common import documents, pages
from tests.llm.conftest import cases

PAGE = """<!DOCTYPE html><html class="no-js has-sidebar"><head><title>T</title><script>a</script></head>
<body class="with-sidebar"><header class="site"><h1>Site name</h1><p>tag line of the site</p></header>
<div class="cookie-notice"><p>We use cookies &amp; such for a long text that goes on and on and on and on.</p></div>
<div id="page" class="layout sidebar-right"><div class="content"><h1>Real title</h1>
<p>First <b>par</b>agraph with a<br>break &lt;tag&gt; caf&eacute; &#x41;&#66;.</p><div class="ad">Buy now buy now</div>
<p>Second   para
graph here with <a href="x>y">link text</a> and more.<ul><li>item one<li>item two</ul><aside>side note</aside>
<script>if (a<b) {"</p>"}</script><!-- a > comment --><p hidden>secret</p>
<P>Last words of the text.</P></div><div class="sidebar"><p>Popular posts and many other words</p></div></div>
<section id="comments"><h2>Comments</h2><p>Great post thank you so much for all of this text</p>
<form><textarea>x</textarea><button>Send</button></form></section><footer>Copyright words</footer></body></html>"""
TEXT = ("Real title First paragraph with a break <tag> café AB. Second para graph here with link text and more. "
        "item one item two Last words of the text.")


def article_by_hand(page):
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    return " ".join(html.unescape(" ".join(re.sub(r"<[^>]*>", "", b) for b in re.split(r"</?(?:p|h1|br)>", inner))).split())


def test_pages_of_the_corpus(spark, corpus):
    out = html_extract.extract_main_text(pages(spark, corpus)).collect()
    want = {r["page_id"]: article_by_hand(r["html"]) for r in pages(spark, corpus).collect()}
    assert {r["page_id"]: r["text"] for r in out} == want
    assert all(r["n_chars"] == len(r["text"]) for r in out)


def test_page_without_marks(spark, corpus):
    assert html_extract.main_text(PAGE, {}) == TEXT
    assert html_extract.main_text(PAGE, html_extract.fit_weights(pages(spark, corpus))) == TEXT


@pytest.mark.parametrize(("page", "text"), [
    ("", ""), ("plain words only", "plain words only"), ("<p>a < b and <b>c", "a < b and c"),
    ("<nav>menu</nav>", ""), ("<script>x", ""), ("<p>&am &amp &#0;", "&am & �"), ("<p>a<p", "a"),
    ("<p title='>'>one</p><p title=\"unclosed>two</p>", "one two"),
    ("<article><p>one two three</p><div class=comments><p>four</p></div><p>five</p></article>", "one two three five"),
])
def test_small_pages(page, text):
    assert html_extract.main_text(page, {}) == text


def words_of(n):
    return " ".join(f"w{i}" for i in range(n))


@pytest.mark.parametrize(("page", "text"), [
    (f"<div class='content header-image'><p>{words_of(80)}</p></div>", words_of(80)),
    (f"<div class='share-price'>{words_of(72)}</div>", words_of(72)),
    (f"<main><p>a b c</p><section class='related-work'><p>{words_of(32)}</p></section></main>", "a b c " + words_of(32)),
    (f"<main><p>{words_of(9)}</p></main><div class='related-work'><p>{words_of(90)}</p></div>", words_of(9)),
    (f"<div><p>{words_of(30)}</p><div class='post-comments'><p>a {words_of(90)}</p></div></div>", words_of(30)),
    (f"<p>{words_of(30)}<p>b<table><tr><td><b><i><p>{words_of(40)}</table>", f"{words_of(30)} b {words_of(40)}"),
])
def test_names_are_evidence(spark, corpus, page, text):
    assert html_extract.main_text(page, {}) == text
    assert html_extract.main_text(page, html_extract.fit_weights(pages(spark, corpus))) == text


def test_names_learned_from_labelled_pages():
    """A name that is in no list is noise where labelled pages hold it outside the mark only."""
    page = ("<div class='kasten'><p>{0} x</p></div><article><h1>t</h1><p class='vorspann'>{0}</p>"
            "<p>{0}</p><p>{0}</p><p>{0}</p></article>").format(words_of(12))
    found = Counter()
    for _ in range(40):
        found.update(html_extract.counts(page))
    weights = html_extract.fitted([(f, found[f, True], found[f, False]) for f in {k[0] for k in found}])
    assert weights["name:kasten"] < -2 and weights["name:vorspann"] > 2
    other = f"<div><p>one two three four</p><div class='kasten'><p>{words_of(5)}</p></div><p class='vorspann'>five six seven</p></div>"
    assert html_extract.main_text(other, weights) == "one two three four five six seven"
    assert html_extract.main_text(other, {}) == f"one two three four {words_of(5)} five six seven"


def without_marks(page):
    """``page`` without classes, ids, and the elements that mark its content."""
    return re.sub(r"\s(class|id)=\"[^\"]*\"", "", re.sub(r"<(/?)(article|main)\b", r"<\1div", page))


def test_fitted_weights_beat_the_prior_on_held_out_pages(spark, corpus):
    """Fitted on half of the pages, tried on the others with marks, classes and ids gone."""
    table = pages(spark, corpus)
    weights = html_extract.fit_weights(table.where("page_id % 2 = 0"))
    held_out = [r["html"] for r in table.where("page_id % 2 = 1").collect()]

    def right(w):
        return sum(html_extract.main_text(without_marks(p), w) == article_by_hand(p) for p in held_out)

    assert right(weights) >= 0.95 * len(held_out) > right({})


def test_fit_looks_at_a_bounded_number_of_pages(spark, corpus):
    table = pages(spark, corpus)
    assert html_extract.fit_weights(table.limit(0)) == {}
    few = html_extract.fit_weights(table, labelled=4)
    assert few and few["text:p in div"] > 0
    assert few == html_extract.fit_weights(table.union(table).repartition(5), labelled=4) or table.count() > 8


def test_page_rows(spark):
    rows = [(1, "u", "<p>one two</p>"), (1, "u", "<p>one two</p>"), (2, None, None), (None, "v", ""), (3, "w", "<p>" + "long words " * 50_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    out = html_extract.extract_main_text(df).collect()
    assert Counter((r["page_id"], r["url"], r["n_chars"]) for r in out) == Counter(
        [(1, "u", 7), (1, "u", 7), (2, None, 0), (None, "v", 0), (3, "w", 549_999)])
    assert html_extract.extract_main_text(df.limit(0)).collect() == []


def measured(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    runs = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    often = {r for r, n in Counter(runs).items() if n > 1}
    inside = {i + j for i, r in enumerate(runs) if r in often for j in range(8)}
    n, chars, symbols, repeated = len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(inside)
    kept = not (n < 20 or 100 * repeated > 30 * n or 10 * symbols > n or not 2 * n <= chars <= 15 * n or 100 * dup > 10 * n)
    return n, chars, symbols, dup, repeated, kept


def test_measures_and_verdict(spark, docs, corpus):
    for df, rows in ((docs, [c[:2] for c in cases()]),
                     (documents(spark, corpus), [(r["doc_id"], r["text"]) for r in documents(spark, corpus).collect()])):
        out = quality_rules.quality_cascade(df, measures=tuple(quality_rules.MEASURES)).collect()
        assert Counter(map(tuple, out)) == Counter((i, *measured(t)) for i, t in rows)
        kept = Counter(r["doc_id"] for r in quality_rules.passing(df).collect())
        assert kept == Counter(r["doc_id"] for r in out if r["kept"])


def test_order_decides_nothing_but_the_cost(spark, corpus):
    df = documents(spark, corpus)
    ordered = quality_rules.order_rules(df)
    assert sorted(r.name for r in ordered) == sorted(r.name for r in quality_rules.RULES)
    one = {r["doc_id"]: r["kept"] for r in quality_rules.quality_cascade(df, quality_rules.RULES).collect()}
    two = {r["doc_id"]: r["kept"] for r in quality_rules.quality_cascade(df, quality_rules.RULES[::-1]).collect()}
    assert one == two


def test_labelled_documents(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    out = quality_rules.quality_cascade(documents(spark, folder)).join(labels, "doc_id").groupBy("quality").agg(
        F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    share = {r["quality"]: r["kept"] for r in out}
    assert share[1] >= 0.97 and share[0] <= 0.5


def test_empty_table(empty):
    assert quality_rules.quality_cascade(empty).collect() == []
    assert quality_rules.passing(empty).collect() == []
