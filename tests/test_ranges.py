"""Ranges with carried borders, running sums and nearest-neighbour information against plain versions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.functions.tails import digamma
from touchline.operators import neighbour_information as nb
from touchline.operators import ranges


def test_digamma(spark):
    gamma = 0.57721566490153286
    got = [r[0] for r in spark.range(1, 60).select(digamma("id")).collect()]
    want = [-gamma + sum(1 / i for i in range(1, n)) for n in range(1, 60)]
    assert np.allclose(got, want, rtol=0, atol=1e-9)


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("pieces", [1, 3, 17])
def test_border_rows(spark, pieces, after):
    """Three groups, one with two thirds of the rows and one with a single row."""
    df = spark.range(120).selectExpr("id AS k", "IF(id = 7, 'one', IF(id % 3 = 0, 'b', 'hot')) AS g", "id * 10 AS v")
    rows = ranges.in_ranges(df, ["g", "k"], pieces)
    assert rows.count() == 120
    held = [r.asDict() for r in rows.collect()]
    got = sorted((r.g, r[ranges.PART], r.k, r.v) for r in ranges.border_rows(rows, ["g"], ["k"], ["v"], 4, after).collect())
    want = []
    for g, p in {(r["g"], r[ranges.PART]) for r in held}:
        own = [r["k"] for r in held if (r["g"], r[ranges.PART]) == (g, p)]
        others = sorted(r["k"] for r in held if r["g"] == g and (r["k"] > max(own) if after else r["k"] < min(own)))
        want += [(g, p, k, k * 10) for k in (others[:4] if after else others[-4:])]
    assert got == sorted(want)


def test_running_sums(spark):
    df = spark.range(200).selectExpr("IF(id < 150, 'a', 'b') AS g", "pmod(id * 37, 200) AS k", "id AS n")
    got = {(r.g, r.k): r.s for r in ranges.running_sums(df, "g", ["k"], "n", "s", 9).collect()}
    total = {}
    for r in sorted(df.collect(), key=lambda r: (r.g, r.k)):
        total[r.g] = total.get(r.g, 0) + r.n
        assert got[r.g, r.k] == total[r.g]


def _psi(n):
    return -0.57721566490153286 + sum(1 / i for i in range(1, n))


def brute_force(values, classes, k=3):
    """Every row against every row."""
    keep = [i for i, c in enumerate(classes) if classes.count(c) > 1]
    v, c = [values[i] for i in keep], [classes[i] for i in keep]
    total = 0.0
    for i in range(len(v)):
        same = sorted(abs(v[j] - v[i]) for j in range(len(v)) if j != i and c[j] == c[i])
        reach = same[min(k, len(same)) - 1]
        total += _psi(sum(d <= reach for d in same)) - _psi(len(same) + 1)
        total -= _psi(sum(abs(v[j] - v[i]) <= reach for j in range(len(v)) if j != i))
    return max(0.0, _psi(len(v)) + total / len(v))


@pytest.mark.parametrize("range_rows", [1_000_000, 20])
def test_neighbour_information_equals_brute_force(spark, range_rows):
    draw = np.random.default_rng(2)
    n = 260
    c = [str(x) for x in draw.choice(["H", "D", "A"], n, p=[0.6, 0.25, 0.15])]
    c[5] = "lonely"
    columns = {"smooth": [math.floor((draw.normal() + 2 * (x == "H")) * 4096) / 4096 for x in c],  # differences are exact
               "tied": [float(draw.integers(0, 4)) + (x == "A") for x in c], "mixed": [float(i % 2) * (i % 50) / 8 for i in range(n)],
               "constant": [1.0] * n}
    rows = spark.createDataFrame([(*r, y) for *r, y in zip(*columns.values(), c, strict=True)],
                                 ", ".join(f"{f} double" for f in columns) + ", FTResult string")
    holes = rows.unionByName(spark.createDataFrame([(None, 1.0, 1.0, 1.0, "H"), (1.0, 1.0, 1.0, 1.0, None)], rows.schema))
    got = {r.feature: r.mi for r in nb.neighbour_information(holes, list(columns), range_rows=range_rows).collect()}
    want = {f: brute_force(v, c) for f, v in columns.items()}
    assert got.keys() == want.keys()
    for f in columns:
        assert got[f] == pytest.approx(want[f], abs=1e-8), f
    assert got["smooth"] > 0.2 and got["constant"] < 1e-6
    assert nb.neighbour_information(rows.limit(0), list(columns)).count() == 0


def test_no_range_holds_a_whole_column(spark):
    """200,000 distinct values of one class and feature: ranges stay near the wanted size."""
    rows = spark.range(200_000).select(F.lit("f").alias("feature"), F.lit("H").alias("class"), (F.col("id") / 7).alias("value"))
    cut = ranges.in_ranges(rows, ["feature", "class", "value"], 20)
    assert cut.groupBy(ranges.PART).count().agg(F.max("count")).first()[0] < 20_000
