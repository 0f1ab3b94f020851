"""Columns that are named like helpers of the operators which return all columns."""

import pytest
from pyspark.sql import functions as F

from helpers import prose, table
from waybill.llm import decontamination, mixing, ngram_join

NAMES = ["_mix_source", "_rate", "_salt", "_key", "_leak", "_again", "_n", "_LEAK_", "best", "words", "hits", "component_id", "n_shingles", "cls"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, prose(1, 40)), (2, prose(2, 40)), (3, prose(2, 40)), (4, None), (4, None), (5, ""), (None, prose(5, 30)), (7, prose(7, 40)), (7, prose(8, 40))]
    out = table(spark, rows)
    for k, name in enumerate(NAMES):
        out = out.withColumn(name, F.lit(k))
    return out


def check(rows, docs, extra=()):
    assert [c for c in rows.columns if c not in extra] == docs.columns
    for r in rows.collect():
        assert [r[name] for name in NAMES] == list(range(len(NAMES)))


def test_mixed(docs):
    out = mixing.mixed(docs, {}, epochs=3.0)
    check(out, docs, ("repeats", "copy", "shuffle_key"))
    assert out.count() == out.agg(F.sum(F.lit(1.0) * F.col("repeats") / F.col("repeats"))).first()[0] > 0


def test_clean(spark, docs):
    items = spark.createDataFrame([(1, prose(7, 40))], "item_id long, text string")
    out = decontamination.clean(docs, items)
    check(out, docs)
    assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "2", "3", "4", "4", "5", "None"]


def test_one_of_each(docs):
    out = ngram_join.one_of_each(docs)
    check(out, docs)
    assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "2", "4", "5", "7", "7", "None"]
