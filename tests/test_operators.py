"""Edge cases and properties of the operators."""

import datetime
import math

import pytest
from pyspark.sql import functions as F

from touchline.functions import tails
from touchline.functions.dates import date_parts, parse_date
from touchline.functions.expressions import argmin, floor_bin, reciprocal, round_bin
from touchline.operators import cleaning as cl
from touchline.operators import evaluation as ev
from touchline.operators import features as feat
from touchline.operators import kmeans as km
from touchline.operators import knn, models, outcomes, sampling, statistics, teams
from touchline.schema import MODEL_FEATURES
from touchline.sources import tables


def one(df):
    return [tuple(r) for r in df.collect()]


def test_bins(spark):
    df = spark.createDataFrame([(12.5,), (-12.5,), (-1.0,), (0.0,)], "x double")
    assert [r[0] for r in df.select(round_bin("x", width=25)).collect()][:2] == [25.0, -25.0]
    assert df.select(floor_bin("x", 100)).collect()[2][0] == -100
    assert df.select(reciprocal("x")).collect()[3][0] is None
    with pytest.raises(ValueError):
        round_bin("x")


def test_argmin_tie_goes_to_lowest_index(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0), (3.0, 1.0, 1.0), (5.0, 4.0, 1.0)], "a double, b double, c double")
    assert [r[0] for r in df.select(argmin([F.col(c) for c in "abc"])).collect()] == [0, 1, 2]


def test_dates(spark):
    df = spark.createDataFrame([("25/12/2020",), ("2020-12-25",), ("soon",)], "d string").select(parse_date("d").alias("d"))
    day = datetime.date(2020, 12, 25)
    assert [r[0] for r in df.collect()] == [day, day, None]
    assert one(df.limit(1).select(*[c.alias(n) for n, c in date_parts("d").items()])) == [(4, 12, 2020, 360)]


def test_csv_reader_and_nan(spark, tmp_path):
    (tmp_path / "m.csv").write_text("Division,MatchDate,HomeTeam,AwayTeam,HomeElo\nE0,05/08/2001,A,B,1500.5\nE0,2001-08-06,C,D,NaN\n")
    from pyspark.sql import types as T
    schema = T.StructType(tables.MATCH_SCHEMA.fields[:5])
    got = one(tables.read_matches(spark, str(tmp_path / "m.csv"), schema=schema))
    assert got[0][1] == datetime.date(2001, 8, 5) and got[1][1] == datetime.date(2001, 8, 6)
    assert got[0][4] == 1500.5 and got[1][4] is None
    inferred = tables.read_matches(spark, str(tmp_path / "m.csv"), infer=True)
    assert inferred.schema["MatchDate"].dataType == T.DateType() and inferred.count() == 2


def test_partitioned_write(spark, matches, tmp_path):
    tables.write_table(matches, str(tmp_path / "out"), partition_by="Division")
    back = tables.read_matches(spark, str(tmp_path / "out"), fmt="parquet")
    assert back.count() == matches.count() and set(back.columns) == set(matches.columns)


def test_object_store_settings():
    conf = tables.s3a_options("http://store:9000", "key", "secret", path_style=True, tls=False)
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert conf["spark.hadoop.fs.s3a.secret.key"] == "secret"
    assert not any("key" in k for k in tables.s3a_options())


# --- cleaning --------------------------------------------------------------------------------

def test_cleaned_rows_have_no_nulls_and_a_second_pass_changes_nothing(inputs):
    stats = cl.fit_cleaning(inputs.raw_train)
    once = cl.apply_cleaning(inputs.raw, stats).persist()
    assert once.count() > 0 and "HandiAway" not in once.columns
    assert {r["null_count"] for r in cl.null_profile(once).collect()} == {0}
    assert once.exceptAll(cl.apply_cleaning(once, stats)).isEmpty()
    assert once.filter("HomeElo <= 0 OR AwayElo <= 0 OR Form3Home < 0 OR HomeTeam = AwayTeam").isEmpty()


def test_cleaning_audit_counts_removed_rows(inputs):
    stats = cl.fit_cleaning(inputs.raw_train)
    out, log = cl.apply_cleaning(inputs.raw, stats, audit=True)
    n = out.count()
    seen, removed = log.rows(), log.removed()
    assert log.dropped_columns == ["HandiAway"]
    assert seen["read"] == inputs.raw.count() and seen["same_team"] == n
    assert removed["drop_copies"] == inputs.raw.count() - inputs.raw.distinct().count()
    assert sum(removed.values()) == seen["read"] - n


def test_fit_survives_an_empty_column_and_round_trips(spark):
    df = spark.createDataFrame([(1, 2.0, None, "x", "H"), (2, 4.0, None, None, "D")],
                               "MatchId bigint, HomeElo double, OddHome double, Division string, FTResult string")
    stats = cl.fit_cleaning(df)
    assert "OddHome" not in stats.medians and stats.means["HomeElo"] == 3.0
    assert "OddHome" not in stats.keep_columns
    assert cl.CleaningStats.from_json(stats.to_json()) == stats
    assert stats.to_frame(spark).count() == 5


def test_fill_keeps_integer_type(spark):
    stats = cl.CleaningStats(2, {}, {"a": 2.7}, {}, {"a": 1}, (), ("a",))
    df = spark.createDataFrame([(None,), (5,)], "a int")
    assert sorted(one(cl.apply_cleaning(df, stats, ("fill_median",)))) == [(2,), (5,)]


def test_approximate_and_exact_fits_agree(inputs):
    exact = cl.fit_cleaning(inputs.raw_train)
    approx = cl.fit_cleaning(inputs.raw_train, cl.CleaningConfig(quantiles="approx"))
    assert approx.means == pytest.approx(exact.means) and approx.null_counts == exact.null_counts
    assert approx.medians["OddHome"] == pytest.approx(exact.medians["OddHome"], abs=0.05)


def test_form_fill_zero(inputs):
    cfg = cl.CleaningConfig(form_fill="zero")
    out = cl.apply_cleaning(inputs.deduped, cl.fit_cleaning(inputs.raw_train, cfg))
    ids = [r[0] for r in inputs.deduped.filter("Form3Home < 0").select("MatchId").collect()]
    assert {r[0] for r in out.filter(F.col("MatchId").isin(ids)).select("Form3Home").collect()} <= {0.0}


# --- outcomes and teams ----------------------------------------------------------------------

def test_rates_sum_to_hundred_and_counts_to_rows(matches):
    rates = outcomes.outcome_rates(matches, round_bin(F.col("HomeElo") - F.col("AwayElo"), width=25), "bin").collect()
    assert all(math.isclose(r["H_pct"] + r["D_pct"] + r["A_pct"], 100) for r in rates)
    assert sum(r["n"] for r in rates) == matches.count()


def test_reindex_gives_null_rows(matches):
    got = outcomes.mean_by_outcome(matches.filter("FTResult <> 'D'"), "FTHome").orderBy("position").collect()
    assert [r["FTResult"] for r in got] == ["H", "D", "A"] and got[1]["n"] is None


def test_team_seen_on_one_side_only_is_left_out(spark):
    df = spark.createDataFrame([("A", "B", 1, 0), ("B", "C", 2, 2)], "HomeTeam string, AwayTeam string, HTHome int, HTAway int")
    assert one(teams.home_away_totals(df, "HTHome", "HTAway")) == [("B", 2, 0)]


def test_unseen_team_gets_the_default(spark, matches):
    home, away = teams.fit_team_stats(matches, {"hs": F.avg("FTHome")}, {"as_": F.avg("FTAway")})
    df = spark.createDataFrame([("nobody", "no one")], "HomeTeam string, AwayTeam string")
    row = teams.apply_team_stats(df, home, away, {"hs": 1.25, "as_": 0.5}).first()
    assert (row["hs"], row["as_"]) == (1.25, 0.5)


def test_repartitioning_leaves_results_equal(matches):
    def run(df):
        return sorted(one(outcomes.outcome_rates(df, "Division"))), sorted(one(sampling.hash_sample(df, 0.2).select("MatchId")))
    assert run(matches) == run(matches.repartition(13))


def test_split_is_a_partition_of_the_rows(matches):
    train, test = sampling.hash_split(matches)
    assert train.count() + test.count() == matches.count() and train.join(test, "MatchId").isEmpty()
    assert 0.7 < train.count() / matches.count() < 0.9


# --- statistics ------------------------------------------------------------------------------

def test_tail_probabilities(spark):
    c = lambda x: F.lit(float(x))
    cases = [(tails.t_two_sided_p(c(2.0), c(10)), 0.0733880, 1e-6), (tails.t_two_sided_p(c(1.959964), c(1e7)), 0.05, 1e-6),
             (tails.f_upper_p(c(3.0), c(2), c(20)), 0.0724979, 1e-4), (tails.f_upper_p(c(0.0), c(2), c(20)), 1.0, 0)]
    # Closed forms: t with 1 and 2 degrees, F with 2 degrees above.
    for t in (0.0, 0.3, 1.0, 4.0, 60.0):
        cases += [(tails.t_two_sided_p(c(t), c(1)), 1 - 2 / math.pi * math.atan(t), 1e-12),
                  (tails.t_two_sided_p(c(t), c(2)), 1 - t / math.sqrt(2 + t * t), 1e-12)]
    for f, d in ((0.01, 5), (1.0, 7), (2.5, 150_000), (0.7, 10_000_000)):
        cases.append((tails.f_upper_p(c(f), c(2), c(d)), math.exp(-d / 2 * math.log1p(2 * f / d)), 1e-8))
    got = spark.range(1).select(*[col.alias(f"c{i}") for i, (col, _, _) in enumerate(cases)]).first()
    for value, (_, want, tolerance) in zip(got, cases, strict=True):
        assert value == pytest.approx(want, abs=tolerance)
    null = spark.range(1).select(tails.t_two_sided_p(F.lit(None).cast("double"), c(3)), tails.f_upper_p(c(1), c(2), c(0))).first()
    assert tuple(null) == (None, None)


def test_log_gamma(spark):
    points = [0.5, 1.0, 1.5, 2.0, 7.3, 29.9, 30.1, 1234.5, 1e7]
    got = spark.range(1).select(*[tails.log_gamma(F.lit(z)).alias(f"c{i}") for i, z in enumerate(points)]).first()
    assert list(got) == pytest.approx([math.lgamma(z) for z in points], rel=1e-13, abs=1e-12)


def test_point_biserial_p(matches):
    row = statistics.point_biserial(matches.select((F.col("FTResult") == "H").cast("int").alias("f"), "OddHome"), "f",
                                    "OddHome", with_p=True).first()
    assert -1 < row["r"] < 0 and row["t"] < 0 and 0 <= row["p"] < 0.01


def test_spearman_of_a_monotone_column(spark):
    df = spark.createDataFrame([(float(i) ** 3, "H" if i > 5 else "A") for i in range(10)], "x double, FTResult string")
    row = statistics.spearman_by_outcome(df, ["x"]).first()
    assert row["rho_H"] == pytest.approx(math.sqrt(0.5 * 0.5 * 100 / 33) , abs=0.01) or row["rho_H"] > 0.8
    assert row["rho_H"] == pytest.approx(-row["rho_A"]) and row["rho_D"] is None


def test_density_integrates_to_one(matches):
    got = statistics.kernel_density(matches, ["HomeElo"], grid=300).orderBy("i").collect()
    area = sum((a["density"] + b["density"]) / 2 * (b["x"] - a["x"]) for a, b in zip(got, got[1:]))
    assert len(got) == 300 and 0.8 < area <= 1.0


def test_histogram_counts_every_row(matches):
    got = statistics.histogram_density(matches, ["OddHome", "HomeRed"])
    assert {r["feature"]: r["s"] for r in got.groupBy("feature").agg(F.sum("count").alias("s")).collect()} == {
        "OddHome": matches.count(), "HomeRed": matches.count()}


# --- learners and evaluation -----------------------------------------------------------------

def test_report_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (2, 0), (0, 0)], "label int, prediction int")
    got = {r["class"]: r for r in ev.classification_report(df, {0: "A", 1: "D", 2: "H"}).collect()}
    assert got["D"]["precision"] == got["D"]["recall"] == got["D"]["f1"] == 0.0
    assert got["A"]["recall"] == 1.0 and got["accuracy"]["f1"] == 0.5 and got["macro avg"]["support"] == 4


def test_vote_ties_and_exact_matches(spark):
    cols = "query_id bigint, rank int, train_id bigint, label int, dist double"
    tie = spark.createDataFrame([(1, 1, 10, 2, 0.1), (1, 2, 11, 0, 0.2), (1, 3, 12, 0, 0.3), (1, 4, 13, 2, 0.4)], cols)
    assert one(knn.knn_vote(tie)) == [(1, 2)]
    exact = spark.createDataFrame([(1, 1, 10, 1, 0.0), (1, 2, 11, 0, 1e-9), (1, 3, 12, 0, 1e-9)], cols)
    assert one(knn.knn_vote(exact, "distance")) == [(1, 1)]
    assert one(knn.knn_vote(exact)) == [(1, 0)]


def test_nearest_train_row_of_itself(inputs):
    train = inputs.scaled[0]
    got = knn.knn_predict(train, train, MODEL_FEATURES, "label", k=1)
    wrong = got.join(train.select(F.col("MatchId").alias("query_id"), "label"), "query_id").filter("label <> prediction")
    assert wrong.isEmpty()


def test_neighbours_use_a_fixed_number_of_jobs(spark, inputs):
    train, test = (df.persist() for df in inputs.scaled)
    train.count(), test.count()
    tracker = spark.sparkContext.statusTracker()

    def jobs(queries, group):
        spark.sparkContext.setJobGroup(group, group)
        knn.knn_predict(train, queries, MODEL_FEATURES, "label").collect()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(group))
    assert jobs(test.limit(5), "few") >= jobs(test, "many") - 1


def test_empty_cluster_keeps_its_centre_and_inertia_falls(spark):
    df = spark.createDataFrame([(i, float(i % 10)) for i in range(100)], "MatchId bigint, x double")
    assert km.update_centres(df, ["x"], [[0.0], [1000.0]]) == [[4.5], [1000.0]]
    centres, last = [[0.0], [1.0], [2.0]], float("inf")
    for _ in range(4):
        inertia = km.assign_clusters(df, ["x"], centres).select(F.sum(F.least(*[
            (F.col("x") - c[0]) * (F.col("x") - c[0]) for c in centres]))).first()[0]
        assert inertia <= last
        last, centres = inertia, km.update_centres(df, ["x"], centres)
    fit = km.fit_kmeans(df, ["x"], 3)
    assert fit.iterations <= 20 and fit.shifts[-1] < 1e-4
    spread = df.withColumn("x", F.col("MatchId") * 1.5)
    assert len(km.fit_kmeans_ml(spread, ["x"], 3).clusterCenters()) == 3


def test_agreement_of_equal_and_split_labels(spark):
    same = spark.createDataFrame([(0, 5), (0, 5), (1, 6), (1, 6), (2, 7)], "cluster int, label int")
    row = km.cluster_agreement(same, "label").first()
    assert row["ari"] == pytest.approx(1.0) and row["nmi"] == pytest.approx(1.0)


def test_constant_column_scales_to_zero(spark):
    df = spark.createDataFrame([(1.0, 3.0), (3.0, 3.0)], "a double, b double")
    got = one(feat.standardize(df, feat.fit_scaling(df, ["a", "b"])))
    assert got == [(-1.0, 0.0), (1.0, 0.0)]


def test_unknown_category_gets_the_reserved_code(spark):
    enc = feat.fit_encoders([spark.createDataFrame([("b",), ("a",)], "t string")], ["t"])
    got = one(feat.apply_encoders(spark.createDataFrame([("a",), ("z",)], "t string"), enc))
    assert sorted(got) == [(-1,), (0,)]


def test_knn_evaluation_document(inputs, tmp_path, spark):
    train, test = inputs.scaled
    done = models.knn_evaluate(train, test, MODEL_FEATURES, k=5, fraction=0.5)
    tables.write_metrics(done.metrics, str(tmp_path / "m"))
    row = tables.read_metrics(spark, str(tmp_path / "m")).first()
    assert row["k"] == 5 and row["n_test"] == done.predictions.count() and row["n_train"] == train.count()
    assert set(row["classification_report"]) == {"A", "D", "H", "macro avg", "weighted avg"}
    assert row["elapsed_seconds"] > 0


def test_softmax_beats_the_largest_class(inputs):
    train, test = inputs.split
    numeric = ["HomeElo", "AwayElo", "OddHome", "OddAway", "OddDraw", "Form3Home", "Form3Away"]
    done = models.softmax_evaluate(train, test, numeric, max_iter=20)
    assert done.metrics.first()["accuracy"] > 0.34


def test_balanced_rows_even_out_classes(inputs):
    train = inputs.split[0]
    rows = models.prepare(train, ["HomeElo"], feat.weight_column(train))
    sizes = [r["count"] for r in models.balanced_rows(rows).groupBy("label").count().collect()]
    assert max(sizes) / min(sizes) < 1.05


def test_a_null_feature_has_no_cluster(spark):
    from touchline.operators import kmeans
    rows = spark.createDataFrame([(i, float(i % 3), None if i % 4 == 0 else 1.0) for i in range(40)], "MatchId long, a double, b double")
    fit = kmeans.fit_kmeans(rows, ["a", "b"], 2)
    found = kmeans.assign_clusters(rows, ["a", "b"], fit.centres).collect()
    assert all((r.cluster is None) == (r.b is None) for r in found) and len(fit.centres) == 2


def test_a_cluster_without_shared_folder_is_an_error():
    from types import SimpleNamespace

    from touchline.session import scratch_root
    context = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="checkpoint"):
        scratch_root(SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context))


# --- plans -----------------------------------------------------------------------------------

def test_feature_bins_shuffle_once_after_the_windows(matches):
    from touchline.operators.rolling import match_differences
    rows = matches.withColumns(match_differences())
    plan = outcomes.feature_bins(rows, ["EloDiff", "OddDiff", "OddHome"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_only_neighbours_and_clusters_run_python(spark):
    from conftest import SF

    from touchline.plans import QUERIES
    for name in ("elo_diff_bins", "top_scoring_teams", "rolling_diffs", "feature_bins_all", "clean_same_team", "box_stats",
                 "standardize", "kmeans_assign", "kde"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan, name
