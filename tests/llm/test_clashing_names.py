"""Columns of the input that are called like inner columns of an operator or a stage."""

from pyspark.sql import functions as F

import corpus_pipeline
from touchline.llm import lm, pii
from touchline.llm.text import unused


def _docs(spark, *names):
    rows = [(1, "mail me at a@b.org now", "web", 9), (2, None, "web", 8), (3, "", "book", 7), (4, "x y z x y z", None, 6), (4, "x y z x y z", None, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, tag int")
    return docs.select("*", *(F.col("tag").alias(n) for n in names))


def test_unused_names():
    assert unused(["a", "B", "b_"], "a", "b", "c") == ("a_", "b__", "c")


def test_scores_keep_inner_names(spark):
    names = ["_base", "_sum", "_found", "_train", "_lm_row", "_in1", "score"]
    plain = lm.score_whole(_docs(spark), F.lit(True))
    got = lm.score_whole(_docs(spark, *names), F.lit(True))
    assert got.columns == ["doc_id", "source", "tag", *names[:-1], *plain.columns[3:]]
    assert all(r[n] == r.tag for r in got.collect() for n in names[:-1])
    key = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    rows = sorted(tuple(r) for r in got.select(*key).collect())
    assert rows == sorted(tuple(r) for r in plain.select(*key).collect()) and len(rows) == 5
    assert rows[1][1] == rows[2][1] == 1  # null and empty: the end alone
    assert lm.score_whole(_docs(spark, *names).limit(0), F.lit(True)).collect() == []


def test_redaction_keeps_inner_names(spark):
    docs = _docs(spark, "_base_spans", "_all_spans")
    out = pii.redact(docs, pii.fit_pii(docs))
    assert out.columns == docs.columns
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[1].text == "mail me at [EMAIL] now" and rows[1]._base_spans == rows[1]._all_spans == 9


def test_mix_replaces_a_copy_column(spark):
    docs = _docs(spark, "copy")
    mixed = corpus_pipeline.mix(spark, docs, "")
    assert mixed.columns == ["doc_id", "text", "source", "tag", "copy"]
    assert all(r["copy"] in (1, 2, 3) for r in mixed.collect())
    assert corpus_pipeline.mix(spark, docs.limit(0), "").collect() == []
