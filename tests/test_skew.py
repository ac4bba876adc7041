"""Paths for large or skewed inputs give the same rows as the plain ones and as brute force."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from touchline.operators import features as feat
from touchline.operators import knn, quantiles, rolling, sampling, statistics
from touchline.schema import ENGINEERED_FEATURES


@pytest.fixture(scope="module")
def hot(matches):
    """More than a third of all rows belong to one home team, many on one day."""
    return (matches.withColumn("HomeTeam", F.when(F.col("MatchId") % 3 < 2, "Hot").otherwise(F.col("HomeTeam")))
                   .withColumn("MatchDate", F.when(F.col("MatchId") % 5 == 0, F.to_date(F.lit("2000-01-01")))
                               .otherwise(F.col("MatchDate"))).persist())


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


@pytest.mark.parametrize("n,limit", [(5, 40), (3, 40), (5, 3), (3, 7)])
def test_rolling_chunks_equal_plain(hot, n, limit):
    names = list(rolling.side_sums("home", n))
    plain = rolling.rolling_home_form(hot, n)
    cut = rolling.rolling_home_form(hot, n, max_group_rows=limit)
    assert rows(cut, "MatchId", *names) == rows(plain, "MatchId", *names)
    assert set(cut.columns) == set(plain.columns)


def test_rolling_matches_pandas(hot):
    pdf = hot.select("MatchId", "HomeTeam", "MatchDate", "FTHome").toPandas().sort_values(["HomeTeam", "MatchDate", "MatchId"])
    want = pdf.groupby("HomeTeam")["FTHome"].transform(lambda s: s.shift(1).rolling(5, min_periods=1).sum()).fillna(0)
    want = dict(zip(pdf["MatchId"], want.astype(int)))
    got = rolling.rolling_home_form(hot, 5, max_group_rows=25)
    assert {r["MatchId"]: r["home_goals_last5_sum"] for r in got.collect()} == want


def test_rolling_keeps_every_row_and_first_is_zero(hot):
    out = rolling.rolling_home_form(hot, 5, max_group_rows=10)
    assert out.count() == hot.count()
    first = out.orderBy("MatchDate", "MatchId").filter("HomeTeam = 'Hot'").first()
    assert first["home_goals_last5_sum"] == 0


@pytest.mark.parametrize("method", ["cont", "disc"])
def test_quantiles_by_refined_intervals(spark, method):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 7.0).otherwise((F.xxhash64("id") % 100_000) / 7.0).alias("a"),
        (F.col("id") % 5).cast("int").alias("b"))
    probs = {"q1": 0.25, "median": 0.5, "q3": 0.75, "low": 0.0, "high": 1.0}
    got = {r["feature"]: r for r in quantiles.exact_quantiles(df, ["a", "b"], probs, method=method, most=100, cuts=16).collect()}
    pdf = df.toPandas()
    for c in ("a", "b"):
        for name, p in probs.items():
            how = "linear" if method == "cont" else "inverted_cdf"
            assert got[c][name] == pytest.approx(np.quantile(pdf[c], p, method=how), rel=1e-12), (c, name)


def test_no_interval_holds_many_values(spark):
    """Ten million distinct values: what is sorted in the end stays below the bound, and the ranks are exact."""
    n, most = 10_000_000, 2_000
    long = spark.range(n).select(F.lit("a").alias("feature"), ((F.col("id") * 7_777_777) % n * 0.25).alias("value"))
    ranks = {("a",): {1, 12_345, n // 2, n - 1, n}}
    found = quantiles.rank_intervals(long, ["feature"], ranks, {("a",): (0.0, (n - 1) * 0.25, n)}, most, 512)
    for (_, rank), (low, high, below, inside) in found.items():
        assert inside <= most and below < rank <= below + inside and low <= (rank - 1) * 0.25 <= high
    got = quantiles.exact_quantiles(long.select(F.col("value").alias("a")), ["a"], {"x": 0.5, "y": 0.9}, most=most).first()
    assert got.x == (n - 1) * 0.125 and got.y == pytest.approx(0.9 * (n - 1) * 0.25, rel=1e-12)


def test_quantiles_of_awkward_values(spark):
    """Many binades, both signs, infinities, one value only, ties beyond the bound, nulls and NaN."""
    inf = float("inf")
    wild = [s * 2.0 ** e for e in range(-1000, 1000, 7) for s in (1, -1)] + [0.0] * 40 + [inf, -inf, inf]
    data = [(float(v), 3.5, float(i % 2), None) for i, v in enumerate(wild)] + [(float("nan"), None, 1.0, None)]
    df = spark.createDataFrame(data, "a double, b double, c double, d double")
    probs = {f"p{i}": i / 20 for i in range(21)}
    for method in ("disc", "cont"):
        got = {r.feature: r for r in quantiles.exact_quantiles(df, ["a", "b", "c", "d"], probs, method=method, most=5, cuts=8).collect()}
        assert set(got) == {"a", "b", "c"}
        for c, values in (("a", sorted(wild)), ("b", [3.5] * len(wild)), ("c", sorted(r[2] for r in data))):
            assert got[c].n == len(values)
            for name, p in probs.items():
                pos = p * (len(values) - 1)
                if method == "disc":
                    assert got[c][name] == values[max(1, math.ceil(p * len(values))) - 1]
                elif pos == int(pos):
                    assert got[c][name] == values[int(pos)]


def test_density_moves_grids_only(spark, monkeypatch):
    """Of a column of many values, a grid per task is shuffled and no value."""
    monkeypatch.setattr(statistics, "FEW_VALUES", 5)
    df = spark.range(40_000).select((F.xxhash64("id") % 100_000 / 1000).alias("a"), (F.col("id") % 7).cast("double").alias("b")).repartition(4)
    out = statistics.kernel_density(df, ["a", "b"], grid=30)
    got = {(r.feature, r.i): r.density for r in out.collect()}
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(feature" in text and "hashpartitioning(feature#" in text and ", value#" not in "".join(
        line for line in text.splitlines() if "hashpartitioning" in line)
    assert len(got) == 60
    monkeypatch.setattr(statistics, "FEW_VALUES", 1000)
    by_value = {(r.feature, r.i): r.density for r in statistics.kernel_density(df, ["a", "b"], grid=30).collect()}
    assert by_value == pytest.approx(got, rel=1e-9)
    pdf = df.toPandas()
    for c in "ab":
        v = pdf[c].to_numpy()
        h = v.std(ddof=1) * len(v) ** -0.2
        for i, x in enumerate(np.linspace(v.min(), v.max(), 30)):
            want = np.exp(-0.5 * ((x - v) / h) ** 2).sum() / (len(v) * h * math.sqrt(2 * math.pi))
            assert got[c, i] == pytest.approx(want, rel=1e-9)


def test_value_ranks_in_two_levels(matches):
    rows_ = rolling.engineered_features(matches)
    cols = ENGINEERED_FEATURES[:12]
    key = ("feature", "value", "n", "n_H", "before")
    one = quantiles.value_ranks(rows_, cols, "FTResult", ("H",))
    two = quantiles.value_ranks(rows_, cols, "FTResult", ("H",), buckets=50, one_window=10)
    assert rows(one, *key) == rows(two, *key)


def test_stratified_sample_is_exact_for_any_bucket_count(matches):
    sizes = {r["FTResult"]: r["count"] for r in matches.groupBy("FTResult").count().collect()}
    picks = [sampling.stratified_sample(matches, 0.1, buckets=b).select("MatchId", "FTResult").collect() for b in (1, 16, 4096)]
    assert len({frozenset(r["MatchId"] for r in p) for p in picks}) == 1
    for c, n in sizes.items():
        assert sum(r["FTResult"] == c for r in picks[0]) == math.floor(n * 0.1 + 0.5)


def test_encoders_beyond_the_vocabulary_bound(matches):
    small = feat.fit_encoders([matches], ["HomeTeam", "Division"])
    large = feat.fit_encoders([matches], ["HomeTeam", "Division"], bound=3)
    assert not large["HomeTeam"][1]
    for c in small:
        assert rows(small[c][0], "value", "code") == rows(large[c][0], "value", "code")
    names = [r["value"] for r in large["HomeTeam"][0].orderBy("code").collect()]
    assert names == sorted(names)
    assert rows(feat.apply_encoders(matches, small), "MatchId", "HomeTeam") == rows(
        feat.apply_encoders(matches, large), "MatchId", "HomeTeam")


def test_team_stats_beyond_the_broadcast_bound(hot):
    from touchline.operators.teams import apply_team_stats, fit_team_stats
    aggs = {"hs": F.avg("FTHome")}, {"as_": F.avg("FTAway")}
    got = [apply_team_stats(hot, *fit_team_stats(hot, *aggs, bound=b), {"hs": 0.0, "as_": 0.0}) for b in (10, 10**6)]
    assert rows(got[0], "MatchId", "hs", "as_") == rows(got[1], "MatchId", "hs", "as_")


@pytest.fixture(scope="module")
def points(spark):
    """Clustered points; a third of the train rows are copies of one point."""
    rng = np.random.default_rng(0)
    train = pd.DataFrame(rng.normal(size=(900, 4)) + rng.integers(0, 4, size=(900, 1)) * 3.0, columns=list("abcd"))
    train.iloc[:300] = train.iloc[0].to_numpy()
    train["MatchId"], train["label"] = np.arange(900), rng.integers(0, 3, 900)
    queries = pd.DataFrame(rng.normal(size=(80, 4)) + rng.integers(0, 4, size=(80, 1)) * 3.0, columns=list("abcd"))
    queries.iloc[0] = train.iloc[0, :4].to_numpy(dtype=float)
    queries["MatchId"] = np.arange(5000, 5080)
    return train, queries, spark.createDataFrame(train).repartition(7), spark.createDataFrame(queries)


def brute_force(train, queries, k):
    x, out = train[list("abcd")].to_numpy(), set()
    for _, q in queries.iterrows():
        d = np.round(np.sqrt(((x - q[list("abcd")].to_numpy(dtype=float)) ** 2).sum(axis=1)), 9)
        for i in sorted(range(len(x)), key=lambda i: (d[i], train["MatchId"][i]))[:k]:
            out.add((int(q["MatchId"]), int(train["MatchId"][i]), int(train["label"][i]), float(d[i])))
    return out


@pytest.mark.parametrize("options", [
    {}, {"bound_above_tasks": 0.0}, {"max_query_bytes": 2000},
    {"max_query_bytes": 9000, "bound_above_tasks": 0.0}])
def test_neighbours_equal_brute_force(points, options):
    train, queries, t, q = points
    got = knn.knn_neighbours(t, q, list("abcd"), "label", 8, **options).collect()
    assert {(r["query_id"], r["train_id"], r["label"], r["dist"]) for r in got} == brute_force(train, queries, 8)
    assert len(got) == 8 * len(queries)


def test_train_rows_are_not_shuffled(points):
    """A round reads the train rows where they are; only each task's best rows move."""
    train, queries, t, q = points
    side, block = knn._side(t, "MatchId", list("abcd"), "label"), knn._side(q, "MatchId", list("abcd")).toPandas()
    plan = knn._searched(side, block, 8, 0, 512)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("MapInArrow"):]
    assert "hashpartitioning(query_id" in plan[:plan.index("MapInArrow")]
    assert "hashpartitioning" not in below and "Broadcast" not in below  # the fixture deals its rows out itself


def test_others_leave_the_row_itself_out(points):
    train, _, t, _ = points
    got = knn.knn_others(t, list("abcd"), "label", 3, max_query_bytes=4000).collect()
    assert len(got) == 4 * len(train)
    assert {(r.query_id, r.train_id, r.dist) for r in got if r.rank == 0} == {(i, i, 0.0) for i in train["MatchId"]}
    others = {(r.query_id, r.train_id, r.label, r.dist) for r in got if r["rank"] > 0}
    assert not any(a == b for a, b, _, _ in others)
    full = brute_force(train, train, 4)
    assert others <= full


def test_blocks_with_fewer_rows_than_k(points, spark):
    train, queries, _, q = points
    few = train.tail(5).reset_index(drop=True)
    for options in ({}, {"max_query_bytes": 100}):
        got = knn.knn_neighbours(spark.createDataFrame(few), q, list("abcd"), "label", 8, **options).collect()
        assert {(r["query_id"], r["train_id"], r["label"], r["dist"]) for r in got} == brute_force(few, queries, 8)


def test_rolling_cuts_a_hot_day(spark):
    """One team, nearly all rows on one day: no chunk is much larger than the limit."""
    from pyspark.sql import functions as F
    rows = spark.range(20_000).select(
        F.col("id").alias("MatchId"), F.lit("a").alias("HomeTeam"),
        F.expr("date_add(DATE '2020-01-01', IF(id < 20, CAST(id AS INT), 30))").alias("MatchDate"))
    hot = rolling._hot_groups(rows, "HomeTeam", 1000)
    chunks = rolling._chunked(rows, hot, "HomeTeam", ("MatchDate", "MatchId"), 1000)
    assert chunks.groupBy("HomeTeam", "_chunk").count().agg(F.max("count")).first()[0] <= 2000
