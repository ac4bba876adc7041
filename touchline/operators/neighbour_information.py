"""Mutual information between a class and numbers by nearest neighbours.

For each row: the distance to the k-th nearest row of its class, how many rows of the class lie within it (more than k only if
values tie), and how many rows of any class do. Equal values of one class have equal counts, so all work is on value counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.tails import digamma
from touchline.operators.quantiles import unpivot_values
from touchline.operators.ranges import PART, border_rows, in_ranges, running_sums
from touchline.operators.statistics import complete_cases
from touchline.schema import TARGET
from touchline.session import scratch_root

# About this many value counts make a range.
RANGE_ROWS = 1_000_000


def _within(near: Column, own: Column, value: Column, k: Column) -> Column:
    """(count, dist, lo, hi): same-class rows up to the k-th nearest distance, that distance, and the ends of what it holds."""
    start = F.struct((own - 1).alias("count"), F.lit(0.0).alias("dist"), value.alias("lo"), value.alias("hi"))

    def step(acc: Column, x: Column) -> Column:
        taken = F.struct((acc["count"] + x["n"]).alias("count"), x["dist"].alias("dist"), F.least(acc["lo"], x["value"]).alias("lo"),
                         F.greatest(acc["hi"], x["value"]).alias("hi"))
        return F.when((acc["count"] < k) | (x["dist"] == acc["dist"]), taken).otherwise(acc)
    return F.aggregate(F.sort_array(near), start, step)


def class_distances(counts: DataFrame, k: int, pieces: int) -> DataFrame:
    """(feature, class, value, n, near, lo, hi): for each value of a class, how many rows of it lie in the reach [lo, hi].

    ``counts`` has feature, class, value, n and ``most``, the class's rows; a class of one row has no neighbour and is left out.
    """
    rows = in_ranges(counts.filter("most > 1"), ["feature", "class", "value"], pieces)
    group = ["feature", "class"]
    borders = [border_rows(rows, group, ["value"], ["n"], k, after).withColumn("_border", F.lit(True)) for after in (False, True)]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), borders, rows.withColumn("_border", F.lit(False)))
    along = Window.partitionBy(*group, PART).orderBy("value")
    entry = F.struct("value", "n")
    sides = F.concat(F.collect_list(entry).over(along.rowsBetween(-k, -1)), F.collect_list(entry).over(along.rowsBetween(1, k)))
    near = F.transform(F.col("_sides"), lambda s: F.struct(F.abs(s["value"] - F.col("value")).alias("dist"), s["value"].alias("value"), s["n"].alias("n")))
    found = (both.withColumn("_sides", sides).filter(~F.col("_border"))
                 .select(*group, "value", "n", _within(near, F.col("n"), F.col("value"), F.least(F.lit(k), F.col("most") - 1)).alias("_w"))
                 .checkpoint())  # the fields are used many times below, and would each repeat the search
    w, v = F.col("_w"), F.col("value")
    return found.select(*group, "value", "n", w["count"].alias("near"), F.least(w["lo"], v - w["dist"]).alias("lo"),
                        F.greatest(w["hi"], v + w["dist"]).alias("hi"))


def rows_within(points: DataFrame, reaches: DataFrame, pieces: int) -> DataFrame:
    """``reaches`` (feature, lo, hi and more) with ``m``: the rows of ``points`` (feature, value, n) in [lo, hi].

    Points and both ends of every reach are put in one order and summed along it. Of equal values lower ends come first, then
    points, then upper ends.
    """
    kept = [c for c in reaches.columns if c != "feature"]
    payload = F.struct(*kept)
    blank = F.lit(None).cast(reaches.select(payload.alias("p")).schema["p"].dataType)
    ends = reaches.select("feature", F.explode(F.array(
        F.struct(F.col("lo").alias("value"), F.lit(0).alias("side"), payload.alias("_reach")),
        F.struct(F.col("hi").alias("value"), F.lit(2).alias("side"), payload.alias("_reach")))).alias("_e"))
    events = ends.select("feature", "_e.value", "_e.side", F.lit(0).cast("long").alias("n"), "_e._reach").unionByName(
        points.select("feature", "value", F.lit(1).alias("side"), "n", blank.alias("_reach")))
    summed = running_sums(events, "feature", ["value", "side"], "n", "_upto", pieces).filter("side <> 1")
    return (summed.groupBy("feature", "_reach")
                  .agg((F.max(F.when(F.col("side") == 2, F.col("_upto"))) - F.max(F.when(F.col("side") == 0, F.col("_upto")))).alias("m"))
                  .select("feature", "_reach.*", "m"))


def neighbour_information(df: DataFrame, features: list[str], label: str = TARGET, k: int = 3, range_rows: int = RANGE_ROWS) -> DataFrame:
    """(feature, mi): mutual information in nats of each feature with the class, from k nearest neighbours; at least 0.

    A row counts psi(N) + psi(its class's rows within reach) - psi(N of its class) - psi(all rows within reach), itself left out of
    both. Without ties this is the estimator for a class and a continuous number; with ties the reach holds all rows at its
    distance, as in the estimator for mixtures. Rows with a null are left out, and so are classes of one row; a table without
    rows gives none. No task holds a whole column: ranges hold about ``range_rows`` value counts.
    """
    scratch_root(df.sparkSession)
    long = unpivot_values(complete_cases(df, features, label), features, keep=[label])
    counts = long.groupBy("feature", F.col(label).alias("class"), "value").agg(F.count("*").alias("n")).checkpoint()
    sizes = counts.groupBy("feature", "class").agg(F.sum("n").alias("most")).filter("most > 1")
    rows = counts.join(F.broadcast(sizes), ["feature", "class"])  # a row per feature and class
    pieces = max(df.sparkSession.sparkContext.defaultParallelism, -(-counts.count() // range_rows))
    reaches = class_distances(rows, k, pieces)
    points = rows.groupBy("feature", "value").agg(F.sum("n").alias("n"))
    within = rows_within(points, reaches, pieces)
    terms = within.groupBy("feature").agg(F.sum(F.col("n") * (digamma("near") - digamma(F.col("m") - 1))).alias("_t"))
    totals = sizes.groupBy("feature").agg(F.sum("most").alias("_n"), F.sum(F.col("most") * digamma("most")).alias("_c"))
    mi = digamma("_n") + (F.col("_t") - F.col("_c")) / F.col("_n")
    return terms.join(F.broadcast(totals), "feature").select("feature", F.greatest(F.lit(0.0), mi).alias("mi"))
