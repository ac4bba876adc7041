"""Mix sources to target weights with hash-threshold histograms.

A document's hash decides whether it is in a mix, so the documents of a smaller mix are also in a larger one. Tokens are
summed by source and hash bucket; the bucket in which a source's budget ends is the only one that is looked at again,
with finer buckets. No source is sorted, and a source with a third of all rows costs one partial sum per task and bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.text import WORD, read, stored

WEIGHTS = (5, 2, 1)
HASH_BITS = 60
LEVEL_BITS = 12
MAX_REPEATS = 3


def document_hash() -> Column:
    """60 bits from id and text."""
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce(F.col("text"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def source_targets(sources: DataFrame, weights=WEIGHTS, most: float = MAX_REPEATS) -> DataFrame:
    """``source, source_size`` with ``target``: weights repeat over the sources by code point, null last.

    A target stops at ``most`` times its source's size and the excess goes to the others by weight. That settles at
    min(most * size, weight * level), with the level at which the targets add up to all sizes. One row per source.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((rank - 1) % len(weights) + 1).cast("int"))
    rows = sources.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * most)
    by_cap = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before, rest = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    total, everything = F.sum("source_size").over(Window.partitionBy()), Window.partitionBy()
    rows = (rows.withColumn("_level", (total - F.coalesce(F.sum("_cap").over(before), F.lit(0))) / F.sum("_w").over(rest))
                .withColumn("_free", F.when(F.col("_w") * F.col("_level") < F.col("_cap"), F.col("_cap") / F.col("_w"))))
    level = F.min(F.when(F.col("_free").isNotNull(), F.struct("_free", "_level"))).over(everything)
    return rows.withColumn("_settled", level).select(
        "source", "source_size",
        F.least(F.col("_cap").cast("double"), F.col("_w") * F.col("_settled._level")).alias("target"))


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: whole repeats, and the hash below which a document is taken once more.

    Each level sums tokens by source and hash bucket, finds the bucket in which the rest of the budget ends and goes on
    inside it, until it holds one document only (or rows with the same hash, which are taken together). The last
    bucket goes in if at least half of its tokens are wanted.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    state = targets.select(
        "source", "source_size", "target", whole.alias("whole"),
        (F.col("target") - whole * F.col("source_size")).alias("need"), F.lit(0).cast("long").alias("prefix"),
        F.lit(False).alias("done"), F.lit(0).cast("long").alias("below"))
    for level in range(1, HASH_BITS // LEVEL_BITS + 1):
        shift = HASH_BITS - level * LEVEL_BITS
        wider = F.expr(f"shiftright(h, {shift + LEVEL_BITS})")
        open_ = state.filter("need > 0 AND NOT done").select(F.col("source").alias("_s"), "prefix", "need")
        inside = sized.join(open_, sized.source.eqNullSafe(F.col("_s")) & (wider == F.col("prefix")))
        ordered = Window.partitionBy("_s").orderBy("bucket")
        edge = (inside.groupBy("_s", F.expr(f"shiftright(h, {shift})").alias("bucket"))
                .agg(F.sum("size").alias("tokens"), F.count("*").alias("docs"), F.first("need").alias("need"))
                .withColumn("cum", F.sum("tokens").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
                .filter("cum >= need").groupBy("_s")
                .agg(F.min(F.struct("bucket", "tokens", "docs", F.expr("need - (cum - tokens)").alias("need"))).alias("e")))
        last = (F.col("e.docs") == 1) | F.lit(shift == 0)
        taken = (F.col("e.need") * 2 >= F.col("e.tokens")).cast("long")
        state = state.join(edge, state.source.eqNullSafe(F.col("_s")), "left").select(
            "source", "source_size", "target", "whole",
            F.coalesce(F.col("e.need"), F.col("need")).alias("need"),
            F.coalesce(F.col("e.bucket"), F.col("prefix")).alias("prefix"),
            (F.col("done") | F.col("e").isNull() | last).alias("done"),
            F.when(~F.col("done") & last, (F.col("e.bucket") + taken) * (1 << shift))
             .otherwise(F.col("below")).cast("long").alias("below"))
        state = stored(state, "mix_level")
        if not state.filter("NOT done").take(1):
            break
    return state.select("source", "source_size", "target", "whole", "below")


def mix_sources(docs: DataFrame, weights=WEIGHTS) -> DataFrame:
    """``docs`` with ``size, source_size, target, repeats, taken``; every row stays.

    Size is the number of words (text of null: 0). ``taken`` is the size times the repeats the mix takes, 0 to 3. A null
    source is a source of its own, after all others. Repeated rows share a hash and are taken together; an empty table
    gives an empty table; further columns pass through unless they have one of the five names, which are replaced.
    """
    own = ["size", "source_size", "target", "repeats", "taken"]
    base = docs.drop(*own)
    measured = base.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))
    sized = stored(measured.select("source", "size", document_hash().alias("h")), "mix_sizes")
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights)
    cut = thresholds(sized, stored(targets, "mix_targets")).withColumnRenamed("source", "_src")
    rows = measured.withColumn("_h", document_hash()).join(cut, F.col("source").eqNullSafe(F.col("_src")))
    repeats = F.col("whole") + (F.col("_h") < F.col("below")).cast("long")
    return rows.select(*base.columns, "size", "source_size", "target", repeats.alias("repeats"),
                       (F.col("size") * repeats).alias("taken"))


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return mix_sources(docs.select("doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken")


OP4_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(COALESCE(LEN(REGEXP_EXTRACT_ALL(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    CAST('0x' || SUBSTR(MD5(COALESCE(CAST(doc_id AS VARCHAR), '') || ':' || COALESCE(text, '')), 1, 15) AS BIGINT) AS h
  FROM documents),
sources AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, [5, 2, 1][(ROW_NUMBER() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w, 3 * source_size AS cap
  FROM sources),
levels AS (
  SELECT *, (SUM(source_size) OVER () - COALESCE(SUM(cap) OVER (ORDER BY cap / w, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / SUM(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
settled AS (SELECT ARG_MIN(level, cap / w) AS level FROM levels WHERE w * level < cap),
targets AS (
  SELECT source, source_size, CAST(LEAST(cap, w * (SELECT level FROM settled)) AS DOUBLE) AS target,
    CASE WHEN source_size > 0 THEN CAST(FLOOR(LEAST(cap, w * (SELECT level FROM settled)) / source_size) AS BIGINT)
      ELSE 0 END AS whole FROM levels),
steps AS (
  SELECT source, h, SUM(size) AS s, SUM(SUM(size)) OVER (PARTITION BY source ORDER BY h) AS cum
  FROM sized GROUP BY source, h),
picked AS (
  SELECT steps.source, h,
    target - whole * source_size > cum - s AND (target - whole * source_size - (cum - s)) * 2 >= s AS once_more
  FROM steps JOIN targets ON steps.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, source_size, target, size * (whole + CAST(once_more AS BIGINT)) AS taken
FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
  JOIN picked ON sized.source IS NOT DISTINCT FROM picked.source AND sized.h = picked.h
"""
