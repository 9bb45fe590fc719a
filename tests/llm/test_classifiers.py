"""Held-out accuracy over the given tables, and edge cases with a defined result."""

import pytest

from hirelens.llm import language, quality, queries, toxicity

SF = "/root/testdata/sf0.1"
EDGES = [(1, None), (2, ""), (3, "12 34 !!"), (4, "the and of " * 50_000), (None, "the the"), (4, "idiot"), (4, "idiot")]


@pytest.fixture(scope="module")
def tables(spark):
    return queries.read(spark, SF, "documents"), queries.read(spark, SF, "labels")


def test_language_held_out(spark, tables):
    found = queries.op2_language_id(spark, SF).filter("held_out").join(tables[0].select("doc_id", "lang"), "doc_id")
    assert found.selectExpr("avg(cast(lang = lang_pred as int)) a").first()["a"] > 0.97
    assert found.filter("score < 0 or score > 1").isEmpty()


def test_quality_held_out(spark, tables):
    found = queries.op5_quality_classifier(spark, SF).filter("held_out").join(tables[1], "doc_id")
    assert found.selectExpr("avg(cast(predicted = quality as int)) a").first()["a"] > 0.95
    assert found.filter("(score >= 0.3) <> (predicted = 1)").isEmpty()


def test_toxicity_held_out(spark, tables):
    found = queries.op6_toxicity(spark, SF).filter("held_out").join(tables[1].withColumnRenamed("toxic", "mark"), "doc_id")
    row = found.selectExpr(
        "avg(if(toxic = (mark = 1), 1, 0)) a", "sum(if(toxic and mark = 0, 1, 0)) / sum(if(mark = 0, 1, 0)) f",
        "sum(if(toxic and mark = 1, 1, 0)) / sum(mark) r",
    ).first()
    assert row["a"] > 0.93 and row["f"] < 0.03 and row["r"] > 0.5


def test_language_edges(docs_of, empty_docs, spark):
    from pyspark.sql import functions as F

    train = docs_of([(i, "the and of with that") for i in range(5)]).unionByName(docs_of([(9, "der und die das nicht")], "de"))
    model = language.fit_language_model(train, F.col("text"), F.col("lang"))
    rows = language.identify(docs_of(EDGES).withColumn("score", F.lit("old")), model).collect()
    assert len(rows) == len(EDGES)
    by = {(r["doc_id"], r["text"] and r["text"][:5]): r for r in rows}
    for key in ((1, None), (2, ""), (3, "12 34")):
        assert (by[key]["lang_pred"], by[key]["score"]) == ("und", 0.0)
    assert by[4, "the a"]["lang_pred"] == "en"
    nothing = language.fit_language_model(empty_docs, F.col("text"), F.col("lang"))
    assert language.identify(docs_of([(1, "abc")]), nothing).first()["lang_pred"] == "und"
    assert language.identify(empty_docs, model).count() == 0


@pytest.mark.parametrize("with_rows", [True, False])
def test_score_edges(spark, docs_of, empty_docs, with_rows):
    train = [(i, "idiot scum of the day" if i % 3 == 0 else "a fine day and walk of the park") for i in range(60)]
    labels = spark.createDataFrame(
        [(i, int(i % 3 != 0), int(i % 3 == 0), None) for i in range(60)] * with_rows + [(None, 1, 1, None), (3, None, None, None)],
        "doc_id long, quality int, toxic int, text string",
    )
    chain = toxicity.fit_toxicity(docs_of(train), labels, ("toxic",), graded="severe")
    got = toxicity.score_toxicity(docs_of(EDGES), chain).collect()
    assert len(got) == len(EDGES)
    flags = {r["doc_id"]: r["toxic"] for r in got if r["doc_id"] in (1, 2)}
    assert flags == {1: False, 2: False}
    if with_rows:
        assert [r["toxic"] for r in got if r["doc_id"] == 4].count(True) == 2
    model = quality.fit_quality(docs_of(train), labels)
    scored = quality.score_quality(docs_of(EDGES), model).collect()
    assert len(scored) == len(EDGES) and all(0 <= r["score"] <= 1 for r in scored)
    if not with_rows:
        assert {r["score"] for r in scored if r["doc_id"] in (1, 2)} == {0.5}
    assert quality.score_quality(empty_docs, model).count() == 0
    assert toxicity.score_toxicity(empty_docs, chain).count() == 0


def test_later_category_sees_the_earlier():
    import numpy as np

    words = [np.array([1, 2] if i % 2 else [3, 4], np.uint64) for i in range(80)]
    y = np.array([[i % 2, i % 2] for i in range(80)], float)
    chain = toxicity.train_chain(words, y, ("a", "b"))
    assert chain.links[1, 0] > 0 and chain.links[0].sum() == 0
