"""The stages one by one against brute force, and the whole run."""

import re
from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from supplierlens.llm.common import documents, written
from tests.llm.test_dedup import near_by_hand, spans_by_hand
from tests.llm.test_pages_and_rules import measured

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, corpus):
    docs, found = documents(spark, corpus), []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, corpus), "stage")
        found.append(docs)
    return [documents(spark, corpus), *found]


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages(stages):
    before, good, single, apart, cut = stages
    assert all(x.columns == COLUMNS for x in stages)
    assert Counter(rows(good)) == Counter(r for r in rows(before) if measured(r[1])[-1])
    best = {}
    for i, t in rows(good):
        key = re.sub(r"[\x20\x09-\x0D]", "", t)
        best[key] = min(best.get(key, (1, 0)), (-len(t), i))
    assert Counter(i for i, _ in rows(single)) == Counter(i for _, i in best.values())
    kept = {i for (i, _, _, stays) in near_by_hand(rows(single), 5) if stays}
    assert {i for i, _ in rows(apart)} == kept
    assert Counter(rows(cut)) == Counter({(i, t): n for (i, t, *_), n in spans_by_hand(rows(apart), 3, 25).items()})
    assert all(r["n_chars"] == len(r["text"]) for r in cut.collect())


def test_run(spark, corpus, stages):
    out = corpus_pipeline.run(spark, corpus).collect()
    assert {r["doc_id"] for r in out} == {i for i, _ in rows(stages[-1])}
    assert entry.queries()["pipeline"] is corpus_pipeline.run


def test_stages_on_odd_rows(spark, docs, empty):
    for df in (docs.select(*COLUMNS), empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            df = written(stage(spark, df, ""), "stage")
        corpus_pipeline.STAGES[-1][1](spark, df, "").collect()


def test_exact_drops_rows_by_their_own_text(spark, empty):
    texts = [(3, "A a"), (5, "A a"), (5, "B b"), (5, "B  b"), (None, "A a"), (None, "C c"), (None, "C  c"),
             (None, "D d"), (7, "E e"), (None, "E  e"), (8, None), (9, " ")]
    df = spark.createDataFrame([(i, t, "en", "s", None) for i, t in texts], empty.schema)
    out = corpus_pipeline.exact(spark, df, "")
    assert out.columns == COLUMNS
    assert Counter(rows(out)) == Counter([(3, "A a"), (5, "B  b"), (None, "C  c"), (None, "D d"), (None, "E  e"), (9, " ")])


def test_every_operator_is_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
