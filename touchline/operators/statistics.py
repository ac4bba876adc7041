"""How columns relate to the outcome, and how they are distributed."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.tails import f_upper_p, t_two_sided_p
from touchline.operators.quantiles import exact_quantiles, unpivot_values, value_ranks
from touchline.schema import LABELS, OUTCOMES, TARGET

# Columns with more distinct values are not counted by value before they are used.
FEW_VALUES = 10_000


def pearson(df: DataFrame, a: str | Column, b: str | Column, name: str = "r") -> DataFrame:
    return df.agg(F.corr(a, b).alias(name))


def point_biserial(df: DataFrame, flag: str, value: str, with_p: bool = False) -> DataFrame:
    """Correlation of a 0/1 column with a number, its t statistic and optionally p, on one result row."""
    out = df.agg(F.corr(flag, value).alias("r"), F.count(F.when(F.col(flag).isNotNull(), F.col(value))).alias("n"))
    r, n = F.col("r"), F.col("n")
    out = out.withColumn("t", F.try_divide(r * F.sqrt(n - 2), F.sqrt(1 - r * r)))
    return out.withColumn("p", t_two_sided_p(F.col("t"), n - 2)) if with_p else out


# --- feature scores --------------------------------------------------------------------------

def complete_cases(df: DataFrame, features: list[str], label: str = TARGET) -> DataFrame:
    """Features as doubles with the label in the same row; rows with a null are left out."""
    return df.select(label, *[F.col(f).cast("double").alias(f) for f in features]).dropna()


def point_biserial_scores(df: DataFrame, flag: Column, features: list[str]) -> DataFrame:
    """Correlation of every feature with one 0/1 column: feature, r, n, t and p. One aggregate over all features."""
    rows = df.select(flag.cast("double").alias("_flag"), *[F.col(f).cast("double").alias(f) for f in features]).filter("_flag IS NOT NULL")
    parts = [F.struct(F.lit(f).alias("feature"), F.corr("_flag", f).alias("r"), F.count(f).alias("n")) for f in features]
    r, n = F.col("r"), F.col("n")
    out = rows.agg(F.array(*parts).alias("_a")).select(F.inline("_a")).withColumn("t", F.try_divide(r * F.sqrt(n - 2), F.sqrt(1 - r * r)))
    return out.withColumn("p", t_two_sided_p(F.col("t"), n - 2))


def spearman_by_outcome(df: DataFrame, features: list[str], label: str = TARGET, outcomes=OUTCOMES) -> DataFrame:
    """Rank correlation (mid-ranks for ties) of every feature with every outcome's 0/1 indicator.

    The ranks of an indicator are a linear function of it, so rho is Pearson's r of
    the mid-rank and the indicator, and all its sums can be taken over value counts.
    """
    ranks = value_ranks(complete_cases(df, features, label), features, label, outcomes)
    totals = ranks.groupBy("feature").agg(F.sum("n").alias("total"))
    rows = ranks.join(F.broadcast(totals), "feature")
    centred = F.col("before") + (F.col("n") + 1) / 2 - (F.col("total") + 1) / 2
    out = rows.groupBy("feature", "total").agg(
        F.sum(F.col("n") * centred * centred).alias("_ss"),
        *[F.sum(F.col(f"n_{o}") * centred).alias(f"_xy_{o}") for o in outcomes],
        *[F.sum(f"n_{o}").alias(f"_n_{o}") for o in outcomes])

    def rho(o: str) -> Column:
        n_o = F.col(f"_n_{o}")
        return F.try_divide(F.col(f"_xy_{o}"), F.sqrt(F.col("_ss") * (n_o * (F.col("total") - n_o) / F.col("total"))))
    return out.select("feature", *[rho(o).alias(f"rho_{o}") for o in outcomes])


def anova_f(df: DataFrame, features: list[str], label: str = TARGET, with_p: bool = False) -> DataFrame:
    """One-way ANOVA of every feature against the classes, from class means and variances."""
    long = unpivot_values(complete_cases(df, features, label), features, keep=[label])
    per_class = long.groupBy("feature", label).agg(
        F.count("*").alias("n"), F.avg("value").alias("m"), F.var_pop("value").alias("v"))
    # As many rows per feature as there are classes.
    over = Window.partitionBy("feature")
    parts = (per_class.withColumns({"total": F.sum("n").over(over), "k": F.count("*").over(over),
                                    "grand": F.sum(F.col("n") * F.col("m")).over(over) / F.sum("n").over(over)})
             .groupBy("feature", "total", "k").agg(
                 F.sum(F.col("n") * (F.col("m") - F.col("grand")) * (F.col("m") - F.col("grand"))).alias("between"),
                 F.sum(F.col("n") * F.col("v")).alias("within")))
    out = parts.select("feature", F.try_divide(F.col("between") / (F.col("k") - 1),
                                               F.col("within") / (F.col("total") - F.col("k"))).alias("f"),
                       (F.col("k") - 1).alias("df_between"), (F.col("total") - F.col("k")).alias("df_within"))
    if with_p:
        out = out.withColumn("p", f_upper_p(F.col("f"), F.col("df_between"), F.col("df_within")))
    return out


def mutual_information(df: DataFrame, features: list[str], label: str = TARGET, labels=LABELS,
                       bins: int = 32) -> DataFrame:
    """Mutual information in nats between the class and each feature cut into equal-count bins.

    A bin is decided by the number of smaller values, so equal values share one.
    """
    ranks = value_ranks(complete_cases(df, features, label), features, label, labels)
    totals = ranks.groupBy("feature").agg(F.sum("n").alias("total"), *[F.sum(f"n_{c}").alias(f"total_{c}") for c in labels])
    binned = (ranks.join(F.broadcast(totals.select("feature", "total")), "feature")
                   .groupBy("feature", F.floor(F.col("before") * bins / F.col("total")).alias("bin"))
                   .agg(F.sum("n").alias("nb"), *[F.sum(f"n_{c}").alias(f"n_{c}") for c in labels]))
    terms = F.lit(0.0)
    for c in labels:
        n_cb, ratio = F.col(f"n_{c}"), F.col(f"n_{c}") * F.col("total") / (F.col("nb") * F.col(f"total_{c}"))
        terms = terms + F.when(n_cb > 0, n_cb / F.col("total") * F.ln(ratio)).otherwise(0.0)
    return binned.join(F.broadcast(totals), "feature").groupBy("feature").agg(F.sum(terms).alias("mi"))


# --- distributions ---------------------------------------------------------------------------

def column_mean_median(df: DataFrame, columns: list[str]) -> DataFrame:
    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in columns]).unpivot([], columns, "feature", "mean")
    medians = exact_quantiles(df, columns, {"median": 0.5}).select("feature", "median")
    return means.join(F.broadcast(medians), "feature")


def value_range(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, least, greatest and sample standard deviation per column, in long form: one row per column."""
    aggs = [F.struct(F.lit(c).alias("feature"), F.count(F.col(c)).alias("n"), F.min(F.col(c).cast("double")).alias("lo"),
                     F.max(F.col(c).cast("double")).alias("hi"), F.stddev_samp(F.col(c).cast("double")).alias("sd"))
            for c in columns]
    return df.agg(F.array(*aggs).alias("_a")).select(F.inline("_a"))


def histogram_density(df: DataFrame, columns: list[str], bins: int = 40) -> DataFrame:
    """Density per equal-width bin; the greatest value belongs to the last bin. Empty bins have no row."""
    rows = unpivot_values(df, columns).join(F.broadcast(value_range(df, columns)), "feature")
    width = (F.col("hi") - F.col("lo")) / bins
    slot = F.least(F.lit(bins - 1), F.floor(F.try_divide(F.col("value") - F.col("lo"), width))).cast("int")
    counts = (rows.select("feature", F.coalesce(slot, F.lit(0)).alias("bin"), "n", "lo", width.alias("w"))
                  .groupBy("feature", "bin", "n", "lo", "w").agg(F.count("*").alias("count")))
    return counts.select("feature", "bin", (F.col("lo") + F.col("bin") * F.col("w")).alias("left_edge"), "count",
                         F.try_divide(F.col("count"), F.col("n") * F.col("w")).alias("density"))


def kernel_density(df: DataFrame, columns: list[str], grid: int = 300, reach: float = 9.0) -> DataFrame:
    """Gaussian kernel density on an even grid between least and greatest value, Scott's bandwidth.

    A value adds to the grid points within ``reach`` bandwidths (a Gaussian is below 3e-18 of its peak beyond 9). Each task
    sums its own grid per column, and these grids are shuffled. The bandwidth falls with the number of rows, so a value
    of a large table meets few points. Columns of few values (about ``FEW_VALUES``) are counted by value first; of the
    others no value is shuffled. Columns with one value only have no rows.
    """
    kinds = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    few, many = [c for c in columns if kinds[c] <= FEW_VALUES], [c for c in columns if kinds[c] > FEW_VALUES]
    counted = [unpivot_values(df, few).groupBy("feature", "value").agg(F.count("*").alias("m"))] if few else []
    counted += [unpivot_values(df, many).withColumn("m", F.lit(1).cast("long"))] if many else []
    ranges = (value_range(df, columns).filter("hi > lo")
              .withColumn("h", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
              .withColumn("step", (F.col("hi") - F.col("lo")) / (grid - 1)))
    rows = reduce(DataFrame.union, counted).join(F.broadcast(ranges), "feature")  # a row per column
    first = F.greatest(F.lit(0), F.ceil((F.col("value") - reach * F.col("h") - F.col("lo")) / F.col("step")))
    last = F.least(F.lit(grid - 1), F.floor((F.col("value") + reach * F.col("h") - F.col("lo")) / F.col("step")))
    points = rows.filter(first <= last).withColumn("i", F.explode(F.sequence(first.cast("int"), last.cast("int"))))
    z = (F.col("lo") + F.col("i") * F.col("step") - F.col("value")) / F.col("h")
    sums = points.groupBy("feature", "i").agg(F.sum(F.col("m") * F.exp(-0.5 * z * z)).alias("s"))
    axis = ranges.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    norm = F.col("n") * F.col("h") * math.sqrt(2 * math.pi)
    return axis.join(F.broadcast(sums), ["feature", "i"], "left").select(
        "feature", "i", (F.col("lo") + F.col("i") * F.col("step")).alias("x"),
        (F.coalesce("s", F.lit(0.0)) / norm).alias("density"))


def box_stats(df: DataFrame, col: str | Column, by: str = TARGET, groups=OUTCOMES, name: str = "value") -> DataFrame:
    """Quartiles per group and whiskers at the last values within 1.5 IQR of the box; outliers are not listed."""
    value = F.col(col) if isinstance(col, str) else col
    rows = df.filter(F.col(by).isin(list(groups))).select(by, value.cast("double").alias(name)).dropna()
    q = exact_quantiles(rows, [name], {"q1": 0.25, "median": 0.5, "q3": 0.75}, by=(by, groups)).drop("feature")
    v, reach = F.col(name), 1.5 * (F.col("q3") - F.col("q1"))
    return (rows.join(F.broadcast(q), by).groupBy(by, "n", "q1", "median", "q3")
                .agg(F.min(F.when(v >= F.col("q1") - reach, v)).alias("whisker_low"),
                     F.max(F.when(v <= F.col("q3") + reach, v)).alias("whisker_high")))


def elo_gap_rows(df: DataFrame, literal: bool = False) -> DataFrame:
    """Absolute Elo gap with ``StrongerTeamWon``: 1 stronger side, 0 draw, -1 weaker side.

    A decisive result between equal sides has no stronger one and gives null. With
    ``literal=True`` every decisive result counts as 1.
    """
    gap = F.col("HomeElo") - F.col("AwayElo")
    home, away = F.col(TARGET) == "H", F.col(TARGET) == "A"
    code = F.when(F.col(TARGET) == "D", 0).when((gap > 0) & home | (gap < 0) & away, 1)
    code = code.otherwise(1) if literal else code.when((gap > 0) & away | (gap < 0) & home, -1)
    return df.select(F.abs(gap).alias("AbsoluteEloDiff"), code.alias("StrongerTeamWon"))
