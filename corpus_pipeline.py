"""From raw documents to a training mix: five stages, each written before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.decontam import question_and_answer, without_leaks
from touchline.llm.mixing import mix_sources
from touchline.llm.neardup import near_duplicates
from touchline.llm.pii import redact
from touchline.llm.quality import fit_quality, score_quality
from touchline.llm.text import read, stored


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of 0.5 and more).

    Null and empty texts have a score too, repeated rows have the same one; an empty table stays empty.
    """
    scored = score_quality(docs, fit_quality(docs, read(spark, sf_dir, "labels")))
    return scored.filter("predicted = 1").select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity of 0.8): the one with the least id.

    Rows with one id count as one document. Rows without an id are told apart by their text.
    """
    kept = near_duplicates(docs).filter("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    named = docs.filter("doc_id IS NOT NULL").join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    nameless = docs.filter("doc_id IS NULL").dropDuplicates(["text"])
    return named.select(*docs.columns).union(nameless.select(*docs.columns))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts hold none; of repeated rows all stay or all go."""
    return without_leaks(docs, question_and_answer(read(spark, sf_dir, "benchmark")))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind. Null and empty texts stay as they are."""
    return redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's target asks for, numbered by ``copy``; 0 times means it goes.

    An input column ``copy`` is replaced. A null text has size 0; an empty table gives an empty mix.
    """
    mixed = mix_sources(docs)
    return mixed.filter("repeats > 0").select(
        *(c for c in docs.columns if c.lower() != "copy"), F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int"))).alias("copy"))


STAGES = [("quality", keep_good), ("near_duplicates", keep_one_of_each), ("decontamination", drop_leaks),
          ("pii", hide_personal_data), ("mixing", mix)]
ORACLE_SQL = None  # learnt stages are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
