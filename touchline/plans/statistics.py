"""Rolling form, engineered features, feature scores and distributions."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from touchline.operators import neighbour_information as nb
from touchline.operators import rolling as ro
from touchline.operators import statistics as st
from touchline.operators.forest import forest_importance
from touchline.operators.outcomes import feature_bins
from touchline.operators.teams import team_rows
from touchline.plans.registry import add_cte, fitted, query, share_sql, t_tail_sql
from touchline.schema import DISTRIBUTION_COLUMNS, ENGINEERED_FEATURES, KEY, ROLLING_FEATURES, TARGET
from touchline.session import scratch_root


def _rolling_sql(side: str) -> str:
    team = f"{side.title()}Team"
    sums = ", ".join(f"CAST(COALESCE(SUM({src}) OVER w_{side}, 0) AS BIGINT) AS {name}" for name, src in ro.side_sums(side, 5).items())
    return sums, f"w_{side} AS (PARTITION BY {team} ORDER BY MatchDate, MatchId ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)"


_HOME_SUMS, _HOME_W = _rolling_sql("home")
_AWAY_SUMS, _AWAY_W = _rolling_sql("away")

add_cte("engineered", f"""SELECT *, home_goals_last5_sum - away_goals_last5_sum AS goals_last5_diff,
    home_yellows_last5_sum + away_yellows_last5_sum + home_reds_last5_sum + away_reds_last5_sum AS cards_last5_sum FROM (
      SELECT *, {_HOME_SUMS}, {_AWAY_SUMS}, HomeElo - AwayElo AS EloDiff, Form3Home - Form3Away AS Form3Diff,
        Form5Home - Form5Away AS Form5Diff, OddHome - OddAway AS OddDiff, HandiHome - HandiAway AS HandiOddDiff
      FROM matches WINDOW {_HOME_W}, {_AWAY_W})""")
add_cte("feature_values", " UNION ALL ".join(
    f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS value, FTResult FROM engineered" for f in ENGINEERED_FEATURES))
add_cte("column_values", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM matches" for c in DISTRIBUTION_COLUMNS))
add_cte("column_range", "SELECT feature, COUNT(*) AS n, MIN(value) AS lo, MAX(value) AS hi, STDDEV_SAMP(value) AS sd "
                        "FROM column_values GROUP BY feature")


@query("rolling_home_form", f"SELECT MatchId, HomeTeam, {_HOME_SUMS} FROM matches WINDOW {_HOME_W}")
def rolling_home_form(t):
    return ro.rolling_home_form(t.stored).select("MatchId", "HomeTeam", *ro.side_sums("home", 5))


@query("rolling_away_form", f"SELECT MatchId, AwayTeam, {_AWAY_SUMS} FROM matches WINDOW {_AWAY_W}")
def rolling_away_form(t):
    return ro.rolling_away_form(t.stored).select("MatchId", "AwayTeam", *ro.side_sums("away", 5))


@query("rolling_diffs", "SELECT MatchId, goals_last5_diff, cards_last5_sum FROM engineered")
def rolling_diffs(t):
    return ro.engineered_features(t.stored).select("MatchId", "goals_last5_diff", "cards_last5_sum")


@query("rolling_diffs_of_3", """SELECT MatchId, CAST(COALESCE(SUM(FTHome) OVER h, 0) - COALESCE(SUM(FTAway) OVER a, 0) AS BIGINT) AS goals_last3_diff,
    CAST(COALESCE(SUM(HomeYellow) OVER h, 0) + COALESCE(SUM(AwayYellow) OVER a, 0) + COALESCE(SUM(HomeRed) OVER h, 0)
      + COALESCE(SUM(AwayRed) OVER a, 0) AS BIGINT) AS cards_last3_sum FROM matches
    WINDOW h AS (PARTITION BY HomeTeam ORDER BY MatchDate, MatchId ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING),
      a AS (PARTITION BY AwayTeam ORDER BY MatchDate, MatchId ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)""")
def rolling_diffs_of_3(t):
    return ro.engineered_features(t.stored, n=3).select("MatchId", "goals_last3_diff", "cards_last3_sum")


@query("rolling_team_form", """SELECT MatchId, Team, Side, CAST(COALESCE(SUM(gf) OVER w, 0) AS BIGINT) AS goals_for_last5,
    CAST(COALESCE(SUM(ga) OVER w, 0) AS BIGINT) AS goals_against_last5 FROM (
      SELECT MatchId, MatchDate, HomeTeam AS Team, 'H' AS Side, FTHome AS gf, FTAway AS ga FROM matches UNION ALL
      SELECT MatchId, MatchDate, AwayTeam, 'A', FTAway, FTHome FROM matches)
    WINDOW w AS (PARTITION BY Team ORDER BY MatchDate, MatchId, Side ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)""")
def rolling_team_form(t):
    rows = team_rows(t.stored)
    return ro.rolling_team_form(rows).select("MatchId", "Team", "Side", "goals_for_last5", "goals_against_last5")


@query("feature_bins_all", f"""SELECT feature, ROUND(value * 50) / 50 + 0.0 AS bin, COUNT(*) AS n,
    {', '.join(share_sql(o, f'P_{o}', 1) for o in 'HDA')} FROM feature_values GROUP BY feature, bin HAVING COUNT(*) > 30""",
       rounded=["bin", "P_H", "P_D", "P_A"])
def feature_bins_all(t):
    return feature_bins(ro.engineered_features(t.stored), ENGINEERED_FEATURES)


@query("pearson", "SELECT CORR(HomeElo - AwayElo, OddHome) AS r FROM matches", rounded=["r"])
def pearson(t):
    return st.pearson(t.stored, F.col("HomeElo") - F.col("AwayElo"), F.col("OddHome"))


@query("spearman_all", """WITH r AS (SELECT feature, FTResult, RANK() OVER (PARTITION BY feature ORDER BY value)
      + (COUNT(*) OVER (PARTITION BY feature, value) - 1) / 2 AS mid FROM feature_values)
    SELECT feature, CORR(mid, CASE WHEN FTResult = 'H' THEN 1 ELSE 0 END) AS rho_H,
      CORR(mid, CASE WHEN FTResult = 'D' THEN 1 ELSE 0 END) AS rho_D,
      CORR(mid, CASE WHEN FTResult = 'A' THEN 1 ELSE 0 END) AS rho_A FROM r GROUP BY feature""",
       rounded=["rho_H", "rho_D", "rho_A"])
def spearman_all(t):
    return st.spearman_by_outcome(ro.engineered_features(t.stored), ENGINEERED_FEATURES)


@query("anova_f", """WITH c AS (SELECT feature, FTResult, COUNT(*) AS n, AVG(value) AS m, VAR_POP(value) AS v FROM feature_values GROUP BY ALL),
    g AS (SELECT feature, AVG(value) AS grand, COUNT(*) AS total, COUNT(DISTINCT FTResult) AS k FROM feature_values GROUP BY feature)
    SELECT c.feature, (SUM(n * (m - grand) * (m - grand)) / (k - 1)) / (SUM(n * v) / (total - k)) AS f, k - 1 AS df_between,
      total - k AS df_within FROM c JOIN g ON c.feature = g.feature GROUP BY c.feature, total, k""", rounded=["f"])
def anova_f(t):
    return st.anova_f(ro.engineered_features(t.stored), ENGINEERED_FEATURES)


@query("anova_p", """WITH c AS (SELECT feature, FTResult, COUNT(*) AS n, AVG(value) AS m, VAR_POP(value) AS v FROM feature_values GROUP BY ALL),
    g AS (SELECT feature, AVG(value) AS grand, COUNT(*) AS total FROM feature_values GROUP BY feature),
    a AS (SELECT c.feature, (SUM(n * (m - grand) * (m - grand)) / 2) / (SUM(n * v) / (total - 3)) AS f, total - 3 AS d
      FROM c JOIN g ON c.feature = g.feature GROUP BY c.feature, total)
    SELECT feature, f, POW(d / (d + 2 * f), d / 2) AS p FROM a""", rounded=["f", "p"])
def anova_p(t):
    """F and its upper tail; with three classes the tail has a closed form, which the check uses."""
    return st.anova_f(ro.engineered_features(t.stored), ENGINEERED_FEATURES, with_p=True).select("feature", "f", "p")


@query("point_biserial_scores", t_tail_sql("""SELECT feature, r, n, r * SQRT(n - 2) / SQRT(1 - r * r) AS t FROM (
      SELECT feature, CORR(CASE WHEN FTResult = 'H' THEN 1 ELSE 0 END, value) AS r, COUNT(*) AS n FROM feature_values GROUP BY feature)""", "feature"),
       rounded=["r", "t", "p"])
def point_biserial_scores(t):
    return st.point_biserial_scores(ro.engineered_features(t.stored), F.col(TARGET) == "H", ENGINEERED_FEATURES)


@query("mutual_information", """WITH r AS (SELECT feature, FTResult, COUNT(*) OVER (PARTITION BY feature) AS total,
      RANK() OVER (PARTITION BY feature ORDER BY value) - 1 AS before FROM feature_values),
    b AS (SELECT feature, FTResult, total, CAST(FLOOR(before * 32 / total) AS BIGINT) AS bin, COUNT(*) AS n FROM r GROUP BY ALL),
    m AS (SELECT *, SUM(n) OVER (PARTITION BY feature, bin) AS nb, SUM(n) OVER (PARTITION BY feature, FTResult) AS nc FROM b)
    SELECT feature, SUM(n / total * LN(n * total / (nb * nc))) AS mi FROM m GROUP BY feature""", rounded=["mi"])
def mutual_information(t):
    return st.mutual_information(ro.engineered_features(t.stored), ENGINEERED_FEATURES)


def _digamma_sql(x: str) -> str:
    steps = " - ".join(f"1 / ({x} + {i})" for i in range(6))
    y = f"CAST({x} + 6 AS DOUBLE)"
    return f"(LN({y}) - 0.5 / {y} - 1 / (12 * POW({y}, 2)) + 1 / (120 * POW({y}, 4)) - 1 / (252 * POW({y}, 6)) + 1 / (240 * POW({y}, 8)) - {steps})"


_PER_SIDE = "(PARTITION BY feature, class ORDER BY value ROWS BETWEEN {0} AND {1})"


@query("neighbour_information", f"""WITH c AS (SELECT feature, FTResult AS class, value, COUNT(*) AS n FROM feature_values GROUP BY ALL),
    s AS (SELECT *, SUM(n) OVER (PARTITION BY feature, class) AS most,
        LIST({{'value': value, 'n': n}}) OVER {_PER_SIDE.format('3 PRECEDING', '1 PRECEDING')} AS below,
        LIST({{'value': value, 'n': n}}) OVER {_PER_SIDE.format('1 FOLLOWING', '3 FOLLOWING')} AS above FROM c),
    x AS (SELECT feature, class, value, n, most, UNNEST(LIST_CONCAT(COALESCE(below, []), COALESCE(above, []),
        [{{'value': value, 'n': n - 1}}])) AS o FROM s),
    y AS (SELECT *, ABS(o.value - value) AS d, SUM(o.n) OVER (PARTITION BY feature, class, value ORDER BY ABS(o.value - value)) AS upto FROM x),
    r AS (SELECT feature, class, value, n, MIN(d) AS d, CAST(MIN(upto) AS BIGINT) AS near FROM y WHERE upto >= LEAST(3, most - 1) GROUP BY feature, class, value, n),
    e AS (SELECT r.*, LEAST(r.value - r.d, MIN(y.o.value)) AS lo, GREATEST(r.value + r.d, MAX(y.o.value)) AS hi FROM r JOIN y
        ON r.feature = y.feature AND r.class = y.class AND r.value = y.value AND y.d <= r.d
      GROUP BY r.feature, r.class, r.value, r.n, r.d, r.near),
    p AS (SELECT feature, value, SUM(n) AS n FROM c GROUP BY ALL),
    q AS (SELECT feature, value, SUM(n) OVER (PARTITION BY feature ORDER BY value) AS upto FROM p),
    m AS (SELECT e.feature, e.n, e.near, h.upto - COALESCE(l.upto, 0) AS m FROM e ASOF JOIN q h ON e.feature = h.feature AND e.hi >= h.value
        ASOF LEFT JOIN q l ON e.feature = l.feature AND e.lo > l.value),
    t AS (SELECT feature, SUM(n * ({_digamma_sql('near')} - {_digamma_sql('(m - 1)')})) AS t FROM m GROUP BY feature),
    k AS (SELECT feature, SUM(most) AS total, SUM(most * {_digamma_sql('most')}) AS ck FROM (SELECT feature, class, SUM(n) AS most FROM c GROUP BY ALL)
        GROUP BY feature)
    SELECT feature, GREATEST(0, {_digamma_sql('total')} + (t - ck) / total) AS mi FROM t JOIN k USING (feature)""", rounded=["mi"])
def neighbour_information(t):
    """Mutual information of each feature with the outcome from three nearest neighbours."""
    return nb.neighbour_information(ro.engineered_features(t.stored), ENGINEERED_FEATURES)


@query("rf_importance")
def rf_importance(t):
    return fitted(t, "importance", lambda: forest_importance(ro.engineered_features(t.stored), ENGINEERED_FEATURES))


@query("feature_scores")
def feature_scores(t):
    scratch_root(t.spark)
    # Read by three learners: kept once, so that the windows are not computed for each.
    rows = ro.engineered_features(t.stored).select(TARGET, KEY, *ENGINEERED_FEATURES).checkpoint()
    scores = fitted(t, "importance", lambda: forest_importance(rows, ENGINEERED_FEATURES))
    mi, anova = st.mutual_information(rows, ENGINEERED_FEATURES), st.anova_f(rows, ENGINEERED_FEATURES, with_p=True)
    return scores.join(mi, "feature").join(anova.select("feature", "f", "p"), "feature").orderBy(
        F.col("importance").desc(), "feature")


@query("histogram_density", """WITH b AS (SELECT v.feature, LEAST(39, CAST(FLOOR((value - lo) / ((hi - lo) / 40)) AS INT)) AS bin, n, lo,
      (hi - lo) / 40 AS w FROM column_values v JOIN column_range r ON v.feature = r.feature)
    SELECT feature, bin, lo + bin * w AS left_edge, COUNT(*) AS count, COUNT(*) / (n * w) AS density FROM b GROUP BY feature, bin, n, lo, w""",
       rounded=["left_edge", "density"])
def histogram_density(t):
    return st.histogram_density(t.stored, DISTRIBUTION_COLUMNS)


@query("kde", f"""WITH c AS (SELECT feature, value, COUNT(*) AS m FROM column_values GROUP BY feature, value),
    r AS (SELECT *, sd * POW(n, CAST(-0.2 AS DOUBLE)) AS h, (hi - lo) / 299 AS step FROM column_range),
    g AS (SELECT r.*, CAST(i AS INT) AS i FROM r, RANGE(300) s(i))
    SELECT g.feature, g.i, g.lo + g.i * g.step AS x,
      SUM(c.m * EXP(-0.5 * POW((g.lo + g.i * g.step - c.value) / g.h, 2))) / (g.n * g.h * {math.sqrt(2 * math.pi)!r}) AS density
    FROM g JOIN c ON g.feature = c.feature GROUP BY g.feature, g.i, g.lo, g.step, g.n, g.h""", rounded=["x", "density"])
def kde(t):
    return st.kernel_density(t.stored, DISTRIBUTION_COLUMNS)


@query("column_mean_median", "SELECT feature, AVG(value) AS mean, MEDIAN(value) AS median FROM column_values GROUP BY feature",
       rounded=["mean", "median"])
def column_mean_median(t):
    return st.column_mean_median(t.stored, DISTRIBUTION_COLUMNS)


assert set(ROLLING_FEATURES) == set(ro.side_sums("home", 5)) | set(ro.side_sums("away", 5))
