"""Outcome rates and means by group.

Each is one hash aggregate: partial sums are made before the shuffle, so a group
that holds most of the rows costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.expressions import share
from touchline.schema import OUTCOMES, TARGET


def _key(by: str | Column, name: str | None) -> Column:
    col = F.col(by) if isinstance(by, str) else by
    return col.alias(name) if name else col


def outcome_rates(df: DataFrame, by: str | Column, name: str | None = None, outcome: str = TARGET,
                  outcomes=OUTCOMES, labels: dict[str, str] | None = None, min_n: int | None = None,
                  scale: float = 100, count_name: str = "n") -> DataFrame:
    """Share of each outcome per group, with the group size; ``min_n`` keeps groups above it."""
    labels = labels or {o: f"{o}_pct" for o in outcomes}
    out = df.groupBy(_key(by, name)).agg(
        *[share(F.col(outcome) == o, scale).alias(labels[o]) for o in outcomes],
        F.count("*").alias(count_name))
    return out.filter(F.col(count_name) > min_n) if min_n is not None else out


def group_summary(df: DataFrame, by: str | Column, aggs: dict[str, Column], name: str | None = None,
                  min_n: int | None = None, count_name: str = "n_matches") -> DataFrame:
    """Any aggregates per group, with an optional size filter."""
    out = df.groupBy(_key(by, name)).agg(
        *[c.alias(n) for n, c in aggs.items()], F.count("*").alias(count_name))
    return out.filter(F.col(count_name) > min_n) if min_n is not None else out


def reindex(df: DataFrame, key: str, domain) -> DataFrame:
    """Rows for a fixed list of keys; a missing key gives a row of nulls. ``position`` keeps the order."""
    spark = df.sparkSession
    order = spark.createDataFrame([(v, i) for i, v in enumerate(domain)], f"{key} string, position int")
    return order.join(F.broadcast(df.filter(F.col(key).isin(list(domain)))), key, "left")


def mean_by_outcome(df: DataFrame, col: str | Column, outcome: str = TARGET, outcomes=OUTCOMES) -> DataFrame:
    """Mean and size per outcome, one row for each outcome of the list."""
    value = F.col(col) if isinstance(col, str) else col
    out = df.groupBy(outcome).agg(F.avg(value).alias("avg_val"), F.count("*").alias("n"))
    return reindex(out, outcome, outcomes)


def advantage_rates(df: DataFrame, a: str, b: str, per_unit: float = 5, name: str = "FormAdvBin",
                    outcome: str = TARGET, value: str = "H", min_n: int | None = 40) -> DataFrame:
    """Percent of one outcome per bin of the difference of two columns."""
    adv = F.round((F.col(a) - F.col(b)) * per_unit) / per_unit
    return group_summary(df, adv, {"home_win_pct": share(F.col(outcome) == value)}, name, min_n)


def feature_bins(df: DataFrame, features: list[str], per_unit: float = 50, outcome: str = TARGET,
                 outcomes=OUTCOMES, min_n: int | None = 30) -> DataFrame:
    """Outcome probabilities per (feature, bin) for many features in one aggregation."""
    long = df.select(outcome, *[F.col(f).cast("double").alias(f) for f in features]).unpivot(
        [outcome], features, "feature", "value")
    out = long.groupBy("feature", (F.round(F.col("value") * per_unit) / per_unit).alias("bin")).agg(
        F.count("*").alias("n"), *[share(F.col(outcome) == o, 1).alias(f"P_{o}") for o in outcomes])
    return out.filter(F.col("n") > min_n) if min_n is not None else out
