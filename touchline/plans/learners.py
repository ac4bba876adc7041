"""Model inputs, nearest neighbours, clusters, classifiers and their evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.functions.expressions import HASH_RANGE, key_hash, key_hash_sql
from touchline.operators import boosting as bo
from touchline.operators import evaluation as ev
from touchline.operators import features as feat
from touchline.operators import kmeans as km
from touchline.operators import knn
from touchline.operators import models as ml
from touchline.operators import network as nw
from touchline.operators import trees as tr
from touchline.operators.teams import apply_team_stats, fit_team_stats
from touchline.plans.registry import add_cte, fitted, query
from touchline.schema import CATEGORICAL, KEY, MODEL_FEATURES, NUMERIC
from touchline.session import scratch_path, scratch_root
from touchline.sources.tables import read_metrics, write_metrics

K = 8
CLUSTERS = 3
ALL = ", ".join(MODEL_FEATURES)


# --- features --------------------------------------------------------------------------------

@query("pre_match_features", f"""SELECT MatchId, {', '.join(CATEGORICAL + NUMERIC)}, CAST(ISODOW(MatchDate) - 1 AS INT) AS DayOfWeek,
    CAST(MONTH(MatchDate) AS INT) AS Month, CAST(YEAR(MatchDate) AS INT) AS Year, CAST(DAYOFYEAR(MatchDate) AS INT) AS DayOfYear,
    FTResult FROM matches""")
def pre_match_features(t):
    return feat.pre_match_features(t.matches)


@query("label_encode", f"SELECT MatchId, {', '.join(CATEGORICAL)} FROM encoded")
def label_encode(t):
    train, test = t.split
    encoders = feat.fit_encoders([train, test])
    return feat.apply_encoders(t.matches.select("MatchId", *CATEGORICAL), encoders)


@query("label_index_map", """SELECT HomeTeam AS value, CAST(ROW_NUMBER() OVER (ORDER BY HomeTeam) - 1 AS INT) AS code
    FROM (SELECT HomeTeam FROM train UNION SELECT HomeTeam FROM test)""")
def label_index_map(t):
    return feat.label_index(list(t.split), "HomeTeam")


@query("encode_target", "SELECT MatchId, label FROM encoded")
def encode_target(t):
    return t.matches.select("MatchId", feat.encode_target().alias("label"))


@query("standardize", f"SELECT MatchId, {ALL} FROM scaled WHERE NOT is_train", rounded=MODEL_FEATURES)
def standardize(t):
    return t.scaled[1].select("MatchId", *MODEL_FEATURES)


@query("class_weights", """SELECT FTResult, COUNT(*) AS n, SUM(COUNT(*)) OVER () / (COUNT(*) OVER () * COUNT(*)) AS weight
    FROM train GROUP BY FTResult""", rounded=["weight"])
def class_weights(t):
    return feat.class_weights(t.split[0])


_ASSEMBLED = ["Division_code", *NUMERIC]


@query("feature_assembly", f"""WITH codes AS (SELECT Division, ROW_NUMBER() OVER (ORDER BY Division) - 1 AS code FROM (SELECT DISTINCT Division FROM train)),
    r AS (SELECT p.MatchId, p.FTResult, p.part, CAST(COALESCE(c.code, (SELECT COUNT(*) FROM codes)) AS DOUBLE) AS Division_code,
      {', '.join(f'p.{c}' for c in NUMERIC)} FROM (SELECT *, 1 AS part FROM train UNION ALL SELECT *, 2 FROM test) p
      LEFT JOIN codes c ON p.Division = c.Division),
    s AS (SELECT {', '.join(f'AVG({c}) AS m_{c}, STDDEV_SAMP({c}) AS s_{c}' for c in _ASSEMBLED)} FROM r WHERE part = 1)
    SELECT MatchId, CASE FTResult WHEN 'A' THEN 0 WHEN 'D' THEN 1 ELSE 2 END AS label,
      {', '.join(f'CASE WHEN s_{c} > 0 THEN (CAST({c} AS DOUBLE) - m_{c}) / s_{c} ELSE 0 END AS {c}' for c in _ASSEMBLED)}
    FROM r, s WHERE part = 2""", rounded=_ASSEMBLED)
def feature_assembly(t):
    from pyspark.ml.functions import vector_to_array
    train, test = t.split
    out = feat.feature_assembly(NUMERIC).fit(train).transform(test).withColumn("f", vector_to_array("features"))
    return out.select("MatchId", F.col("label").cast("int").alias("label"), *[F.col("f")[i].alias(c) for i, c in enumerate(_ASSEMBLED)])


@query("team_stats_join", """WITH h AS (SELECT HomeTeam, AVG(FTHome) AS home_scored, AVG(FTAway) AS home_conceded FROM train GROUP BY HomeTeam),
    a AS (SELECT AwayTeam, AVG(FTAway) AS away_scored, AVG(FTHome) AS away_conceded FROM train GROUP BY AwayTeam),
    g AS (SELECT AVG(FTHome) AS gh, AVG(FTAway) AS ga FROM train)
    SELECT MatchId, COALESCE(home_scored, gh) AS home_scored, COALESCE(home_conceded, ga) AS home_conceded,
      COALESCE(away_scored, ga) AS away_scored, COALESCE(away_conceded, gh) AS away_conceded
    FROM test LEFT JOIN h ON test.HomeTeam = h.HomeTeam LEFT JOIN a ON test.AwayTeam = a.AwayTeam, g""",
       rounded=["home_scored", "home_conceded", "away_scored", "away_conceded"])
def team_stats_join(t):
    train, test = t.split
    home, away = fit_team_stats(train, {"home_scored": F.avg("FTHome"), "home_conceded": F.avg("FTAway")},
                                {"away_scored": F.avg("FTAway"), "away_conceded": F.avg("FTHome")})
    g = train.agg(F.avg("FTHome"), F.avg("FTAway")).first()
    defaults = {"home_scored": g[0], "home_conceded": g[1], "away_scored": g[1], "away_conceded": g[0]}
    return apply_team_stats(test, home, away, defaults).select("MatchId", *defaults)


# --- nearest neighbours ----------------------------------------------------------------------

_VECTOR = f"CAST([{ALL}] AS DOUBLE[{len(MODEL_FEATURES)}])"
add_cte("knn_near", f"""SELECT query_id, n.t AS train_id, n.y AS label, n.d AS dist,
      ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY n.d, n.t) AS rank FROM (
        SELECT query_id, UNNEST(near) AS n FROM (
          SELECT q.MatchId AS query_id, MIN({{'d': ROUND(ARRAY_DISTANCE(q.v, t.v), 9), 't': t.MatchId, 'y': t.label}}, {K}) AS near
          FROM (SELECT MatchId, {_VECTOR} AS v FROM scaled WHERE NOT is_train) q,
               (SELECT MatchId, label, {_VECTOR} AS v FROM scaled WHERE is_train) t GROUP BY q.MatchId))""")
add_cte("knn_uniform", """SELECT query_id, label AS prediction FROM (SELECT query_id, label,
      ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY COUNT(*) DESC, MIN(rank)) AS place
      FROM knn_near GROUP BY query_id, label) WHERE place = 1""")


def neighbours(t):
    train, test = t.scaled
    return knn.knn_neighbours(train, test, MODEL_FEATURES, "label", K)


@query("knn_neighbours", "SELECT query_id, CAST(rank AS INT) AS rank, train_id, label, dist FROM knn_near", rounded=["dist"])
def knn_neighbours(t):
    return neighbours(t)


@query("knn_predict", "SELECT * FROM knn_uniform")
def knn_predict(t):
    return knn.knn_vote(neighbours(t))


@query("knn_weighted", """SELECT query_id, label AS prediction FROM (SELECT query_id, label, ROW_NUMBER() OVER (PARTITION BY query_id
      ORDER BY COUNT(*) FILTER (WHERE dist = 0) DESC, SUM(1 / NULLIF(dist, 0)) DESC, label) AS place
      FROM knn_near GROUP BY query_id, label) WHERE place = 1""")
def knn_weighted(t):
    return knn.knn_vote(neighbours(t), "distance")


# The same for train rows: each against the others (rank from 1), and itself at rank 0.
add_cte("knn_self", f"""SELECT query_id, n.t AS train_id, n.y AS label, n.d AS dist,
      ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY n.d, n.t) AS rank FROM (
        SELECT query_id, UNNEST(near) AS n FROM (
          SELECT q.MatchId AS query_id, MIN({{'d': ROUND(ARRAY_DISTANCE(q.v, t.v), 9), 't': t.MatchId, 'y': t.label}}, {K}) AS near
          FROM (SELECT MatchId, {_VECTOR} AS v FROM scaled WHERE is_train) q,
               (SELECT MatchId, label, {_VECTOR} AS v FROM scaled WHERE is_train) t WHERE q.MatchId <> t.MatchId GROUP BY q.MatchId))""")
_WEIGHTED_VOTE = """SELECT query_id, label AS prediction FROM (SELECT query_id, label, ROW_NUMBER() OVER (PARTITION BY query_id
      ORDER BY COUNT(*) FILTER (WHERE dist = 0) DESC, SUM(1 / NULLIF(dist, 0)) DESC, label) AS place
      FROM ({0}) GROUP BY query_id, label) WHERE place = 1"""
_TRAIN_ITSELF = f"""SELECT query_id, label, dist FROM knn_self WHERE rank < {K}
      UNION ALL SELECT MatchId, label, 0 FROM scaled WHERE is_train"""


def _score_sql(votes: str) -> str:
    return f"SELECT AVG(CASE WHEN e.label = p.prediction THEN 1 ELSE 0 END) FROM ({votes}) p JOIN encoded e ON e.MatchId = p.query_id"


@query("knn_overfit_gap", f"""SELECT a AS train_accuracy, b AS test_accuracy, a - b AS gap, a - b > 0.1 AS overfit, c AS leave_one_out_accuracy
    FROM (SELECT ({_score_sql(_WEIGHTED_VOTE.format(_TRAIN_ITSELF))}) AS a, ({_score_sql(_WEIGHTED_VOTE.format('SELECT * FROM knn_near'))}) AS b,
      ({_score_sql(_WEIGHTED_VOTE.format('SELECT * FROM knn_self'))}) AS c)""",
       rounded=["train_accuracy", "test_accuracy", "gap", "leave_one_out_accuracy"])
def knn_overfit_gap(t):
    """Distance-weighted votes: train rows with themselves among their neighbours, test rows, and train rows without themselves."""
    train, test = t.scaled
    near = knn.knn_others(train, MODEL_FEATURES, "label", K)
    scratch_root(t.spark)
    near = near.checkpoint()
    names = {c: F.col(c).alias(c if c != "MatchId" else "query_id") for c in ("MatchId", "label")}

    def scored(rows, votes):
        return rows.select(*names.values()).join(votes, "query_id")
    gap = ev.overfit_gap(scored(train, knn.knn_vote(near.filter(F.col("rank") < K), "distance")), scored(test, knn.knn_vote(neighbours(t), "distance")))
    alone = ev.accuracy(scored(train, knn.knn_vote(near.filter("rank > 0"), "distance"))).first()[0]
    return gap.withColumn("leave_one_out_accuracy", F.lit(alone).cast("double"))


def report_sql(rows: str) -> str:
    """SQL: the classification report over rows of (label, prediction)."""
    return f"""WITH p AS ({rows}), c AS (SELECT * FROM (VALUES (0, 'A'), (1, 'D'), (2, 'H')) v(code, name)),
      m AS (SELECT name, COUNT(*) FILTER (WHERE label = code AND prediction = code) AS tp,
              COUNT(*) FILTER (WHERE prediction = code) AS pp, COUNT(*) FILTER (WHERE label = code) AS support FROM p, c GROUP BY name),
      s AS (SELECT name, COALESCE(tp / NULLIF(pp, 0), 0) AS pr, COALESCE(tp / NULLIF(support, 0), 0) AS rc, support FROM m),
      f AS (SELECT *, COALESCE(2 * pr * rc / NULLIF(pr + rc, 0), 0) AS f1 FROM s)
    SELECT name AS class, pr AS precision, rc AS recall, f1, support FROM f UNION ALL
    SELECT 'accuracy', NULL, NULL, AVG(CASE WHEN label = prediction THEN 1 ELSE 0 END), COUNT(*) FROM p UNION ALL
    SELECT 'macro avg', AVG(pr), AVG(rc), AVG(f1), CAST(SUM(support) AS BIGINT) FROM f UNION ALL
    SELECT 'weighted avg', SUM(pr * support) / SUM(support), SUM(rc * support) / SUM(support), SUM(f1 * support) / SUM(support),
      CAST(SUM(support) AS BIGINT) FROM f"""


_KNN_ROWS = "SELECT e.label, k.prediction FROM knn_uniform k JOIN encoded e ON e.MatchId = k.query_id"


@query("knn_report", report_sql(_KNN_ROWS), rounded=["precision", "recall", "f1"])
def knn_report(t):
    train, test = t.scaled
    done = ml.knn_evaluate(train, test, MODEL_FEATURES, k=K)
    return ev.classification_report(done.predictions, ml.CLASS_NAMES)


add_cte("sampled", f"""SELECT MatchId FROM (SELECT MatchId, ROW_NUMBER() OVER (PARTITION BY label
      ORDER BY {key_hash_sql('MatchId', 'strata42')}, MatchId) AS rn, COUNT(*) OVER (PARTITION BY label) AS n
    FROM encoded WHERE NOT is_train) WHERE rn <= ROUND(n * 0.1)""")


@query("knn_report_sampled", report_sql(f"SELECT label, prediction FROM ({_KNN_ROWS.replace('e.label', 'e.MatchId, e.label')}) WHERE MatchId IN (SELECT MatchId FROM sampled)"),
       rounded=["precision", "recall", "f1"])
def knn_report_sampled(t):
    """The service call: a tenth of the test rows, class by class, and its report."""
    train, test = t.scaled
    done = ml.knn_evaluate(train, test, MODEL_FEATURES, k=K, fraction=0.1)
    return ev.classification_report(done.predictions, ml.CLASS_NAMES)


# Half-time leader taken as the prediction: a fixed predictor whose scores any engine can compute.
_HALF_TIME = "SELECT CASE FTResult WHEN 'A' THEN 0 WHEN 'D' THEN 1 ELSE 2 END AS label, CASE HTResult WHEN 'A' THEN 0 WHEN 'D' THEN 1 ELSE 2 END AS prediction FROM {0}"


def half_time(df):
    return df.select(feat.encode_target("FTResult").alias("label"), feat.encode_target("HTResult").alias("prediction"))


@query("confusion_matrix", f"SELECT label, prediction, COUNT(*) AS n FROM ({_HALF_TIME.format('matches')}) GROUP BY ALL")
def confusion_matrix(t):
    return ev.confusion_matrix(half_time(t.matches))


@query("accuracy", f"SELECT AVG(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS accuracy FROM ({_HALF_TIME.format('matches')})",
       rounded=["accuracy"])
def accuracy(t):
    return ev.accuracy(half_time(t.matches))


@query("classification_report", report_sql(_HALF_TIME.format("matches")), rounded=["precision", "recall", "f1"])
def classification_report(t):
    return ev.classification_report(half_time(t.matches), ml.CLASS_NAMES)


_REPORT = report_sql(_KNN_ROWS)


@query("metrics_roundtrip", f"""SELECT a.f1 AS accuracy, a.support AS n_test, {K} AS k,
    (SELECT COUNT(*) FROM encoded WHERE is_train) AS n_train, r.class, r.precision, r.recall, r.f1, r.support
    FROM ({_REPORT}) r, (SELECT f1, support FROM ({_REPORT}) WHERE class = 'accuracy') a WHERE r.class <> 'accuracy'""",
       rounded=["accuracy", "precision", "recall", "f1"])
def metrics_roundtrip(t):
    train, test = t.scaled
    path = scratch_path(t.spark, "metrics")
    write_metrics(ml.knn_evaluate(train, test, MODEL_FEATURES, k=K).metrics, path)
    return read_metrics(t.spark, path).select(
        "accuracy", "n_test", "k", "n_train", F.explode("classification_report").alias("class", "m")).select(
        "accuracy", "n_test", F.col("k").cast("int").alias("k"), F.col("n_train").cast("long").alias("n_train"), "class", "m.precision", "m.recall", F.col("m.f1-score").alias("f1"), "m.support")


@query("overfit_gap", f"""SELECT train_accuracy, test_accuracy, train_accuracy - test_accuracy AS gap,
    train_accuracy - test_accuracy > 0.1 AS overfit FROM
    (SELECT AVG(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS train_accuracy FROM ({_HALF_TIME.format('train')})),
    (SELECT AVG(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS test_accuracy FROM ({_HALF_TIME.format('test')}))""",
       rounded=["train_accuracy", "test_accuracy", "gap"])
def overfit_gap(t):
    train, test = t.split
    return ev.overfit_gap(half_time(train), half_time(test))


# --- clusters --------------------------------------------------------------------------------

def _distance_sql(features) -> str:
    return " + ".join(f"(s.{c} - k.{c}) * (s.{c} - k.{c})" for c in features)


add_cte("centres", f"""SELECT CAST(ROW_NUMBER() OVER (ORDER BY h, MatchId) - 1 AS INT) AS cluster, * EXCLUDE (h) FROM (
    SELECT MatchId, {ALL}, {key_hash_sql('MatchId', 'draw42')} AS h FROM scaled WHERE is_train ORDER BY h, MatchId LIMIT {CLUSTERS})""")
add_cte("assigned", f"""SELECT MatchId, label, is_train, cluster FROM (SELECT s.MatchId, s.label, s.is_train, k.cluster, ROW_NUMBER() OVER
      (PARTITION BY s.MatchId ORDER BY {_distance_sql(MODEL_FEATURES)}, k.cluster) AS place FROM scaled s, centres k) WHERE place = 1""")


def first_centres(t):
    rows = km.initial_centres(t.scaled[0], MODEL_FEATURES, CLUSTERS).collect()
    return [[r[c] for c in MODEL_FEATURES] for r in rows]


def whole(t):
    train, test = t.scaled
    return train.unionByName(test)


@query("kmeans_init", f"SELECT MatchId, {ALL} FROM centres", rounded=MODEL_FEATURES)
def kmeans_init(t):
    return km.initial_centres(t.scaled[0], MODEL_FEATURES, CLUSTERS)


@query("kmeans_assign", "SELECT MatchId, cluster FROM assigned")
def kmeans_assign(t):
    return km.assign_clusters(whole(t), MODEL_FEATURES, first_centres(t)).select("MatchId", "cluster")


@query("kmeans_step", f"""SELECT a.cluster, COUNT(*) AS n, {', '.join(f'AVG(s.{c}) AS {c}' for c in MODEL_FEATURES)}
    FROM assigned a JOIN scaled s ON a.MatchId = s.MatchId WHERE s.is_train GROUP BY a.cluster""", rounded=MODEL_FEATURES)
def kmeans_step(t):
    return km.cluster_means(t.scaled[0], MODEL_FEATURES, first_centres(t))


ROUNDS, TOLERANCE = 20, 1e-4
_SHIFT = " + ".join(f"(n.{c} - k.{c}) * (n.{c} - k.{c})" for c in MODEL_FEATURES)
add_cte("km_centres_0", f"SELECT cluster, {ALL} FROM centres")
add_cte("km_state_0", "SELECT FALSE AS done, CAST(NULL AS DOUBLE) AS shift")
for _i in range(1, ROUNDS + 1):
    add_cte(f"km_near_{_i}", f"""SELECT s.MatchId, ARG_MIN(k.cluster, {_distance_sql(MODEL_FEATURES)}) AS cluster
        FROM scaled s, km_centres_{_i - 1} k WHERE s.is_train GROUP BY s.MatchId""")
    add_cte(f"km_means_{_i}", f"""SELECT a.cluster, {', '.join(f'AVG(s.{c}) AS {c}' for c in MODEL_FEATURES)}
        FROM km_near_{_i} a JOIN scaled s ON a.MatchId = s.MatchId GROUP BY a.cluster""")
    _moved = ", ".join(f"CASE WHEN d.done THEN k.{c} ELSE COALESCE(m.{c}, k.{c}) END AS {c}" for c in MODEL_FEATURES)
    add_cte(f"km_centres_{_i}", f"""SELECT k.cluster, {_moved} FROM km_centres_{_i - 1} k
        LEFT JOIN km_means_{_i} m ON k.cluster = m.cluster, km_state_{_i - 1} d""")
    add_cte(f"km_state_{_i}", f"""SELECT d.done OR MAX(SQRT({_SHIFT})) < {TOLERANCE} AS done,
        CASE WHEN NOT d.done THEN MAX(SQRT({_SHIFT})) END AS shift
        FROM km_centres_{_i} n JOIN km_centres_{_i - 1} k ON n.cluster = k.cluster, km_state_{_i - 1} d GROUP BY d.done""")
add_cte("fitted", f"""SELECT s.MatchId, s.label, s.is_train, ARG_MIN(k.cluster, {_distance_sql(MODEL_FEATURES)}) AS cluster
    FROM scaled s, km_centres_{ROUNDS} k GROUP BY ALL""")


def fitted_centres(t):
    return fitted(t, "kmeans", lambda: km.fit_kmeans(t.scaled[0], MODEL_FEATURES, CLUSTERS, max_iter=ROUNDS, tol=TOLERANCE))


@query("kmeans_fit", f"SELECT cluster, {ALL} FROM km_centres_{ROUNDS}", rounded=MODEL_FEATURES)
def kmeans_fit(t):
    rows = fitted_centres(t).to_frame(t.spark)
    return rows.select("cluster", *[F.col("centre")[i].alias(c) for i, c in enumerate(MODEL_FEATURES)])


@query("kmeans_trace", " UNION ALL ".join(f"SELECT {i} AS iteration, shift FROM km_state_{i} WHERE shift IS NOT NULL"
                                          for i in range(1, ROUNDS + 1)), rounded=["shift"])
def kmeans_trace(t):
    return fitted_centres(t).trace(t.spark)


_MAJORITY_OF = """SELECT cluster, label AS majority, n FROM (SELECT cluster, label, COUNT(*) AS n,
    ROW_NUMBER() OVER (PARTITION BY cluster ORDER BY COUNT(*) DESC, label) AS place FROM {0} WHERE is_train GROUP BY cluster, label)
    WHERE place = 1"""
_MAJORITY, _MAJORITY_FITTED = _MAJORITY_OF.format("assigned"), _MAJORITY_OF.format("fitted")


@query("cluster_majority", _MAJORITY)
def cluster_majority(t):
    return km.cluster_majority(km.assign_clusters(t.scaled[0], MODEL_FEATURES, first_centres(t)), "label")


@query("kmeans_classify", f"""SELECT a.MatchId, a.label, a.cluster, COALESCE(m.majority, 0) AS prediction
    FROM assigned a LEFT JOIN ({_MAJORITY}) m ON a.cluster = m.cluster WHERE NOT a.is_train""")
def kmeans_classify(t):
    train, test = t.scaled
    return km.kmeans_classify(train, test, MODEL_FEATURES, "label", first_centres(t)).select(
        "MatchId", "label", "cluster", "prediction")


_AGREEMENT = """WITH c AS (SELECT cluster, label, CAST(COUNT(*) AS DOUBLE) AS n FROM {0} GROUP BY ALL),
    a AS (SELECT cluster, SUM(n) AS m FROM c GROUP BY cluster), b AS (SELECT label, SUM(n) AS m FROM c GROUP BY label),
    s AS (SELECT (SELECT SUM(n) FROM c) AS t, (SELECT SUM(n * (n - 1) / 2) FROM c) AS ij,
      (SELECT SUM(m * (m - 1) / 2) FROM a) AS ai, (SELECT SUM(m * (m - 1) / 2) FROM b) AS bj,
      (SELECT SUM(c.n / t.t * LN(c.n * t.t / (a.m * b.m))) FROM c JOIN a ON c.cluster = a.cluster JOIN b ON c.label = b.label,
        (SELECT SUM(n) AS t FROM c) t) AS mi,
      (SELECT -SUM(m / t.t * LN(m / t.t)) FROM a, (SELECT SUM(n) AS t FROM c) t) AS ha,
      (SELECT -SUM(m / t.t * LN(m / t.t)) FROM b, (SELECT SUM(n) AS t FROM c) t) AS hb)
    SELECT (ij - ai * bj / (t * (t - 1) / 2)) / ((ai + bj) / 2 - ai * bj / (t * (t - 1) / 2)) AS ari, mi / ((ha + hb) / 2) AS nmi FROM s"""


@query("cluster_agreement", _AGREEMENT.format("assigned"), rounded=["ari", "nmi"])
def cluster_agreement(t):
    return km.cluster_agreement(km.assign_clusters(whole(t), MODEL_FEATURES, first_centres(t)), "label")


@query("cluster_majority_fitted", _MAJORITY_FITTED)
def cluster_majority_fitted(t):
    return km.cluster_majority(km.assign_clusters(t.scaled[0], MODEL_FEATURES, fitted_centres(t).centres), "label")


_CLASSIFIED = f"""SELECT a.MatchId, a.label, a.cluster, COALESCE(m.majority, 0) AS prediction
    FROM fitted a LEFT JOIN ({_MAJORITY_FITTED}) m ON a.cluster = m.cluster WHERE NOT a.is_train"""


def classified(t):
    train, test = t.scaled
    return km.kmeans_classify(train, test, MODEL_FEATURES, "label", fitted_centres(t).centres)


@query("kmeans_classify_fitted", _CLASSIFIED)
def kmeans_classify_fitted(t):
    return classified(t).select("MatchId", "label", "cluster", "prediction")


@query("kmeans_accuracy", f"SELECT AVG(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS accuracy FROM ({_CLASSIFIED})",
       rounded=["accuracy"])
def kmeans_accuracy(t):
    return ev.accuracy(classified(t))


@query("cluster_agreement_fitted", _AGREEMENT.format("fitted"), rounded=["ari", "nmi"])
def cluster_agreement_fitted(t):
    return km.cluster_agreement(km.assign_clusters(whole(t), MODEL_FEATURES, fitted_centres(t).centres), "label")


# --- classifiers -----------------------------------------------------------------------------

def learning_rows(t, weighted: bool = True, scaled: bool = False):
    train, test = t.split
    weights = feat.weight_column(train) if weighted else None
    coded = t.scaled if scaled else t.encoded
    name = F.element_at(F.array(*[F.lit(v) for v in ml.CLASS_NAMES.values()]), F.col("label") + 1)
    return [ml.prepare(df.withColumn("FTResult", name), MODEL_FEATURES, weights) for df in coded]


# A learner runs thousands of jobs over its rows, and each costs a task per partition: few rows lie in few partitions.
FIT_TASKS, MOST_FIT_TASKS, FIT_TASK_ROWS = 4, 64, 20_000


def fit_rows(rows):
    """All rows that a learner is fitted on, written once in partitions that their number asks for."""
    scratch_root(rows.sparkSession)
    tasks = min(MOST_FIT_TASKS, max(FIT_TASKS, -(-rows.count() // FIT_TASK_ROWS)))
    return rows.repartition(tasks, KEY).sortWithinPartitions(KEY).checkpoint()


def fit_sample(rows, most: int):
    """About ``most`` of the rows, drawn by all tasks by a hash of the key. For trials: the queries fit on every row."""
    share = min(1.0, most / max(1, rows.count()))
    return fit_rows(rows.filter(key_hash(KEY, "fit42") < int(share * HASH_RANGE)))


def _fit_on(train, learner):
    kept = fit_rows(train).persist()
    try:
        return learner.fit(kept)
    finally:
        kept.unpersist()


def forest(t, weighted: bool = True):
    learner = ml.random_forest() if weighted else ml.random_forest(None)
    return fitted(t, f"forest-{weighted}", lambda: tr.forest_trees(_fit_on(learning_rows(t, weighted)[0], learner), t.spark))


def boosted(t):
    return fitted(t, "boosted", lambda: tr.boosted_trees_by_class(_fit_on(learning_rows(t)[0], ml.boosted_trees()), t.spark))


def net(t):
    rows = lambda: ml.balanced_rows(fit_rows(learning_rows(t, scaled=True)[0]))
    return fitted(t, "net", lambda: ml.neural_net(len(MODEL_FEATURES)).fit(rows()))


def softmax(t):
    return fitted(t, "softmax", lambda: _fit_on(learning_rows(t, scaled=True)[0], ml.softmax_regression()))


@query("rf_classify")
def rf_classify(t):
    return tr.predict_trees(forest(t), learning_rows(t)[1])


@query("rf_classify_unweighted")
def rf_classify_unweighted(t):
    return tr.predict_trees(forest(t, weighted=False), learning_rows(t, weighted=False)[1])


@query("gbt_classify")
def gbt_classify(t):
    return tr.predict_trees(boosted(t), learning_rows(t)[1])


@query("gbt_learning_curve")
def gbt_learning_curve(t):
    return tr.boosting_curve(boosted(t), learning_rows(t)[1], ml.CLASS_NAMES, ml.WEIGHT)


def coded_rows(t):
    """Train and test with the 26 features as numbers, the label and its class weight."""
    weights = feat.weight_column(t.split[0])
    name = F.element_at(F.array(*[F.lit(v) for v in ml.CLASS_NAMES.values()]), F.col("label") + 1)
    return [df.withColumn("FTResult", name).withColumn(ml.WEIGHT, weights) for df in t.encoded]


def joint_boosted(t):
    """300 rounds of one softmax loss over the three classes, on all train rows."""
    def fit():
        return bo.fit_boosted(coded_rows(t)[0], MODEL_FEATURES, weight=ml.WEIGHT)
    return fitted(t, "joint-boosted", fit)


@query("gbt_softmax_classify")
def gbt_softmax_classify(t):
    return bo.predict_boosted(joint_boosted(t), coded_rows(t)[1])


@query("gbt_softmax_curve")
def gbt_softmax_curve(t):
    """Multi-class log loss and accuracy on the test rows after each round."""
    return bo.loss_curve(joint_boosted(t), coded_rows(t)[1])


@query("gbt_overfit_gap")
def gbt_overfit_gap(t):
    train, test = coded_rows(t)
    return ev.overfit_gap(bo.predict_boosted(joint_boosted(t), train), bo.predict_boosted(joint_boosted(t), test))


_FEW_VALUES = ["Form3Home", "Form5Home", "Form3Away", "Form5Away", "DayOfWeek", "Month"]


@query("gbt_first_gains", f"""WITH v AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value, label FROM encoded WHERE is_train" for c in _FEW_VALUES)}),
    g AS (SELECT k.c AS class, feature, value, SUM(CAST(1 AS DOUBLE) / 3 - CASE WHEN label = k.c THEN 1 ELSE 0 END) AS g,
        SUM(CAST(4 AS DOUBLE) / 9) AS h FROM v, (SELECT CAST(RANGE AS INT) AS c FROM RANGE(3)) k GROUP BY ALL),
    a AS (SELECT class, feature, value, SUM(g) OVER w AS lg, SUM(h) OVER w AS lh, SUM(g) OVER p AS tg, SUM(h) OVER p AS th,
        MAX(value) OVER p AS top FROM g WINDOW w AS (PARTITION BY class, feature ORDER BY value), p AS (PARTITION BY class, feature))
    SELECT class, feature, value AS upto, CASE WHEN lh < 1 OR th - lh < 1 THEN 0
      ELSE lg * lg / (lh + 1) + (tg - lg) * (tg - lg) / (th - lh + 1) - tg * tg / (th + 1) END AS gain FROM a WHERE value < top""", rounded=["gain"])
def gbt_first_gains(t):
    """Second-order gains of the first round's cuts on features of few values: what a round is made of, checked in full."""
    return bo.first_gains(t.encoded[0], _FEW_VALUES)


def relu_net(t):
    """Relu layers with batch normalisation and dropout, early stop by a tenth held back; on all train rows."""
    def fit():
        train, weights = t.scaled[0], feat.weight_column(t.split[0])
        name = F.element_at(F.array(*[F.lit(v) for v in ml.CLASS_NAMES.values()]), F.col("label") + 1)
        rows = train.withColumn("FTResult", name).withColumn(ml.WEIGHT, weights)
        return nw.fit_network(rows, MODEL_FEATURES, weight=ml.WEIGHT)
    return fitted(t, "relu-net", fit)


@query("net_classify")
def net_classify(t):
    return nw.predict_network(relu_net(t), t.scaled[1])


@query("net_history")
def net_history(t):
    """Train and validation loss and accuracy after each epoch."""
    return nw.network_history(relu_net(t), t.spark)


@query("net_overfit_gap")
def net_overfit_gap(t):
    """Train and test accuracy of the net."""
    train, test = t.scaled
    return ev.overfit_gap(nw.predict_network(relu_net(t), train), nw.predict_network(relu_net(t), test))


@query("mlp_classify")
def mlp_classify(t):
    return ml.predict(net(t), learning_rows(t, scaled=True)[1])


@query("softmax_classify")
def softmax_classify(t):
    return ml.predict(softmax(t), learning_rows(t, scaled=True)[1])


@query("softmax_coefficients")
def softmax_coefficients(t):
    return ml.softmax_coefficients(softmax(t), MODEL_FEATURES, t.spark)


@query("training_history")
def training_history(t):
    return ml.training_history(softmax(t), t.spark)


# What any fit must give: one prediction for each test row, always a class that the train rows have.
_COVERAGE_SQL = """SELECT COUNT(*) AS n_test, COUNT(*) AS n_known, (SELECT COUNT(DISTINCT label) FROM encoded WHERE is_train) AS classes
    FROM encoded WHERE NOT is_train"""


def coverage(t, predictions):
    classes = t.encoded[0].select(F.col("label").alias("prediction")).distinct().withColumn("known", F.lit(1))
    rows = predictions.join(F.broadcast(classes), "prediction", "left")  # three classes
    return rows.agg(F.count("*").alias("n_test"), F.count("known").alias("n_known")).withColumn("classes", F.lit(classes.count()).cast("long"))


for _name, _predict in {"rf_coverage": rf_classify, "mlp_coverage": mlp_classify, "softmax_coverage": softmax_classify,
                        "gbt_coverage": gbt_classify, "gbt_softmax_coverage": gbt_softmax_classify,
                        "net_coverage": net_classify}.items():
    query(_name, _COVERAGE_SQL)(lambda t, predict=_predict: coverage(t, predict(t)))


@query("forest_overfit_gap")
def forest_overfit_gap(t):
    """Train and test accuracy of the fitted forest."""
    train, test = learning_rows(t)
    return ev.overfit_gap(tr.predict_trees(forest(t), train), tr.predict_trees(forest(t), test))


@query("forest_gap_sides", """SELECT COUNT(*) FILTER (WHERE is_train) AS n_train, COUNT(*) FILTER (WHERE NOT is_train) AS n_test,
    COUNT(*) > 0 AS train_is_better FROM encoded""")
def forest_gap_sides(t):
    """A forest knows its train rows at least as well as the test rows: both sides scored in full, and their order."""
    train, test = (tr.predict_trees(forest(t), rows).withColumn("part", F.lit(n)) for n, rows in zip(("train", "test"), learning_rows(t), strict=True))
    hit = (F.col("label") == F.col("prediction")).cast("double")
    of = {n: F.when(F.col("part") == n, hit) for n in ("train", "test")}
    return train.unionByName(test).agg(F.count(of["train"]).alias("n_train"), F.count(of["test"]).alias("n_test"),
                                       (F.avg(of["train"]) >= F.avg(of["test"])).alias("train_is_better"))
