"""Exact quantiles and ranks without sorting a whole column in one task.

Ranks start from value counts, made by a hash aggregate with partial sums, so that
equal values, however many, become one row. Quantiles refine intervals around their ranks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.session import scratch_root

# A quantile's last step sorts up to this many values; larger intervals are cut into so many ranges first.
MOST_VALUES = 200_000
CUTS = 1024
# Up to this many distinct values of a column are ranked in one window partition.
ONE_WINDOW = 2_000_000


def unpivot_values(df: DataFrame, columns: list[str], keep=()) -> DataFrame:
    """(keep..., feature, value) rows of the non-null numeric values."""
    long = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        list(keep), columns, "feature", "value")
    return long.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def _scale(v: Column, by_log: Column) -> Column:
    """The value itself, or a logarithmic scale on both sides of zero; both rise with the value."""
    tiny = 1e-300
    log = F.signum(v) * F.least(F.log(F.abs(v) + tiny) - math.log(tiny), F.lit(1e6))
    return F.when(by_log, log).otherwise(v)


def rank_intervals(long: DataFrame, keys: list[str], ranks: dict[tuple, set[int]], ends: dict[tuple, tuple[float, float, int]],
                   most: int = MOST_VALUES, cuts: int = CUTS) -> dict[tuple, tuple[float, float, int, int]]:
    """For each (keys, rank): (low, high, values below low, values inside) of an interval that holds the value of that rank.

    An interval with more than ``most`` values is cut into ``cuts`` ranges; one pass counts the values of all ranges of all
    groups and columns, and the range in which the rank falls, between its least and greatest value, is the next interval. If
    a cut of equal widths leaves more than half of the values, the next one is logarithmic. An interval of one value is done.
    """
    found = {(k, r): (*ends[k][:2], 0, ends[k][2]) for k, some in ranks.items() for r in some}
    spark, slow, settled = long.sparkSession, {}, set()
    names = {f.name: f.dataType.simpleString() for f in long.schema.fields}
    head = ", ".join(f"{k} {names[k]}" for k in keys)
    while True:
        wide = {at: f for at, f in found.items() if f[3] > most and f[0] < f[1] and at not in settled}
        if not wide:
            return found
        spans = {}
        for (k, _), f in wide.items():
            spans.setdefault((k, f[0], f[1]), len(spans))
        tables = (spark.createDataFrame(
            [(*k, i, lo, hi, slow.get((k, lo, hi), 0) == 1 or not math.isfinite(hi - lo)) for (k, lo, hi), i in spans.items()],
            f"{head}, _i int, _lo double, _hi double, _log boolean"),
            spark.createDataFrame([(spans[k, f[0], f[1]], r, r - f[2]) for (k, r), f in wide.items()], "_i int, _rank long, _at long"))
        v, lo, hi, log = F.col("value"), F.col("_lo"), F.col("_hi"), F.col("_log")
        share = (_scale(v, log) - _scale(lo, log)) / (_scale(hi, log) - _scale(lo, log))
        place = F.least(F.greatest(F.floor(share * cuts), F.lit(0)), F.lit(cuts - 1))
        counts = (long.join(F.broadcast(tables[0]), keys).filter(v.between(lo, hi))  # a row per rank asked for
                      .groupBy("_i", place.alias("_place")).agg(F.count("*").alias("_n"), F.min("value").alias("_lo"), F.max("value").alias("_hi")))
        upto = Window.partitionBy("_i").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)  # as many rows as cuts
        hits = (counts.withColumn("_upto", F.sum("_n").over(upto)).join(F.broadcast(tables[1]), "_i")
                      .filter((F.col("_at") <= F.col("_upto")) & (F.col("_at") > F.col("_upto") - F.col("_n"))).collect())
        by_span = {(h["_i"], h["_rank"]): h for h in hits}
        for (k, r), f in wide.items():
            h = by_span[spans[k, f[0], f[1]], r]
            new = (h["_lo"], h["_hi"], f[2] + h["_upto"] - h["_n"], h["_n"])
            if new[3] * 2 > f[3]:  # little progress: another scale, then the values themselves
                slow[k, new[0], new[1]] = slow.get((k, f[0], f[1]), 0) + 1
                if slow[k, new[0], new[1]] > 2:
                    settled.add((k, r))
            found[k, r] = new


def exact_quantiles(df: DataFrame, columns: list[str], probs: dict[str, float], by: tuple[str, tuple] | None = None,
                    method: str = "cont", most: int = MOST_VALUES, cuts: int = CUTS) -> DataFrame:
    """One row per (group, column) with ``n`` and an exact quantile for each name in ``probs``.

    ``method`` is 'cont' (interpolated) or 'disc' (an existing value). ``by`` is a column with its list of values, which
    bounds the number of groups. Intervals around the ranks are refined until they hold at most ``most`` values, for all
    groups and columns at once; only these values are shuffled and sorted. Columns without a value have no row.
    """
    spark, keys = df.sparkSession, ["feature"] if by is None else [by[0], "feature"]
    if by is not None:
        df = df.filter(F.col(by[0]).isin(list(by[1])))
    long = unpivot_values(df, columns, keep=keys[:-1])
    sizes = long.groupBy(*keys).agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.count("*").alias("n")).collect()
    ends = {tuple(r[k] for k in keys): (r.lo, r.hi, r.n) for r in sizes}
    where: dict[tuple, dict[str, tuple[int, int, float]]] = {}
    for k, (_, _, n) in ends.items():
        for name, p in probs.items():
            pos = float(p) * (n - 1)
            low, high = (math.floor(pos) + 1, math.ceil(pos) + 1) if method == "cont" else (max(1, math.ceil(float(p) * n)),) * 2
            where.setdefault(k, {})[name] = (low, high, pos - math.floor(pos) if method == "cont" else 0.0)
    ranks = {k: {r for low, high, _ in some.values() for r in (low, high)} for k, some in where.items()}
    found = rank_intervals(long, keys, ranks, ends, most, cuts)

    values = {at: f[0] for at, f in found.items() if f[0] == f[1]}
    spans: dict[tuple, int] = {}
    for at, f in found.items():
        if at not in values:
            spans.setdefault((at[0], f[0], f[1]), len(spans))
    names = {f.name: f.dataType.simpleString() for f in long.schema.fields}
    head = ", ".join(f"{k} {names[k]}" for k in keys)
    if spans:
        bounds = spark.createDataFrame([(*k, i, lo, hi) for (k, lo, hi), i in spans.items()], f"{head}, _i int, _lo double, _hi double")
        wanted = spark.createDataFrame([(spans[k, f[0], f[1]], r, r - f[2]) for (k, r), f in found.items() if (k, r) not in values],
                                       "_i int, _rank long, _at long")
        inside = (long.join(F.broadcast(bounds), keys).filter(F.col("value").between(F.col("_lo"), F.col("_hi")))
                      .groupBy("_i", "value").agg(F.count("*").alias("_n")))
        upto = Window.partitionBy("_i").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)  # up to ``most`` values
        hits = (inside.withColumn("_upto", F.sum("_n").over(upto)).join(F.broadcast(wanted), "_i")
                      .filter((F.col("_at") <= F.col("_upto")) & (F.col("_at") > F.col("_upto") - F.col("_n"))).collect())
        at_span = {i: k for k, i in spans.items()}
        values |= {(at_span[h["_i"]][0], h["_rank"]): h["value"] for h in hits}
    rows = []
    for k, some in where.items():
        picked = []
        for low, high, frac in some.values():
            a, b = values[k, low], values[k, high]
            picked.append(a if a == b else a + (b - a) * frac)
        rows.append((*k, ends[k][2], *picked))
    return spark.createDataFrame(rows, ", ".join([head, "n long", *[f"`{name}` double" for name in probs]]))


def _cuts_below(cuts: str, coarse: str, value: Column, step: int) -> Column:
    """How many of the sorted cuts are below the value: every ``step``-th cut first, then the few in between."""
    blocks = F.size(F.filter(coarse, lambda c: c < value))
    return blocks * step + F.size(F.filter(F.slice(cuts, blocks * step + 1, step), lambda c: c < value))


def value_ranks(df: DataFrame, columns: list[str], label: str | None = None, labels=(), buckets: int = 128,
                one_window: int = ONE_WINDOW) -> DataFrame:
    """Distinct values of each column with counts and the number of smaller values (``before``).

    With ``label``, also the count per label as ``n_<label>``. The data is read once;
    the value counts are checkpointed and the rest works on them. If a column has
    more than ``one_window`` distinct values, running counts are made in two levels:
    within ranges of about equally many distinct values, cut by a sketch, and over
    the few range totals. No task then sorts a whole column.
    """
    long = unpivot_values(df, columns, keep=[label] if label else ())
    scratch_root(df.sparkSession)
    counts = long.groupBy("feature", "value").agg(
        F.count("*").alias("n"), *[F.count_if(F.col(label) == v).alias(f"n_{v}") for v in labels]).checkpoint()
    upto = (Window.unboundedPreceding, 0)
    most = counts.groupBy("feature").agg(F.count("*").alias("d")).agg(F.max("d")).first()[0] or 0
    if most <= one_window:
        running = F.sum("n").over(Window.partitionBy("feature").orderBy("value").rowsBetween(*upto))
        return counts.withColumn("before", running - F.col("n"))

    buckets = max(buckets, math.ceil(2 * most / one_window))  # about half a window's worth of values in each range
    step = max(2, math.isqrt(buckets))
    marks = [i / buckets for i in range(1, buckets)]
    cuts = counts.groupBy("feature").agg(F.array_distinct(F.percentile_approx("value", marks, 20 * buckets)).alias("_cuts"))
    cuts = cuts.withColumn("_coarse", F.filter("_cuts", lambda c, i: i % step == step - 1))
    placed = (counts.join(F.broadcast(cuts), "feature")
                    .withColumn("_bucket", _cuts_below("_cuts", "_coarse", F.col("value"), step)).drop("_cuts", "_coarse"))
    totals = placed.groupBy("feature", "_bucket").agg(F.sum("n").alias("_t"))
    ranges = Window.partitionBy("feature").orderBy("_bucket").rowsBetween(*upto)
    offsets = totals.select("feature", "_bucket", (F.sum("_t").over(ranges) - F.col("_t")).alias("_offset"))
    inner = Window.partitionBy("feature", "_bucket").orderBy("value").rowsBetween(*upto)
    return (placed.join(F.broadcast(offsets), ["feature", "_bucket"])
                  .withColumn("before", F.col("_offset") + F.sum("n").over(inner) - F.col("n"))
                  .drop("_bucket", "_offset"))
