"""The descriptive questions: rankings, group means, binned outcome rates, calibration."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.functions.expressions import HASH_RANGE, floor_bin, key_hash_sql, reciprocal, round_bin, share
from touchline.operators import outcomes as oc
from touchline.operators import teams as tm
from touchline.operators.sampling import hash_sample
from touchline.operators.statistics import box_stats, elo_gap_rows, point_biserial
from touchline.plans.base import advantage_type
from touchline.plans.registry import query, share_sql, t_tail_sql

NAMED = {"H": "home_win_pct", "D": "draw_pct", "A": "away_win_pct"}
NAMED_SQL = ", ".join(share_sql(o, n) for o, n in NAMED.items())
PCT = ("H_pct", "D_pct", "A_pct")
PCT_SQL = ", ".join(share_sql(o, f"{o}_pct") for o in "HDA")
PROB = ("P_H", "P_D", "P_A")
PROB_SQL = ", ".join(share_sql(o, f"P_{o}", 1) for o in "HDA")


def result(outcome: str):
    return F.col("FTResult") == outcome


def both_sides(home: str, away: str, name: str, where=("TRUE", "TRUE"), as_type: str = "BIGINT") -> str:
    """SQL: per-team sum over the home and the away column."""
    return (f"SELECT Team, CAST(SUM(v) AS {as_type}) AS {name} FROM (SELECT HomeTeam AS Team, {home} AS v FROM matches WHERE {where[0]} "
            f"UNION ALL SELECT AwayTeam, {away} FROM matches WHERE {where[1]}) GROUP BY Team")


def top_sql(sql: str, measure: str, n: int, *keys: str) -> str:
    return f"SELECT * FROM ({sql}) ORDER BY {measure} DESC, {', '.join(keys)} LIMIT {n}"


# --- counts, totals and rankings -------------------------------------------------------------

@query("matches_per_division", "SELECT Division, COUNT(*) AS match_count FROM matches GROUP BY Division")
def matches_per_division(t):
    return tm.top(t.matches.groupBy("Division").agg(F.count("*").alias("match_count")), "match_count", None, "Division")


@query("top_scoring_teams", top_sql(both_sides("HTHome", "HTAway", "total_goals"), "total_goals", 10, "Team"))
def top_scoring_teams(t):
    return tm.top(tm.team_totals(t.matches, ("HTHome", "HTAway"), "total_goals"), "total_goals", 10, "Team")


@query("top_scoring_teams_ft", top_sql(both_sides("FTHome", "FTAway", "total_goals"), "total_goals", 10, "Team"))
def top_scoring_teams_ft(t):
    return tm.top(tm.team_totals(t.matches, ("FTHome", "FTAway"), "total_goals"), "total_goals", 10, "Team")


@query("home_away_goals", top_sql("""SELECT h.Team, home_goals, away_goals FROM
    (SELECT HomeTeam AS Team, CAST(SUM(HTHome) AS BIGINT) AS home_goals FROM matches GROUP BY HomeTeam) h JOIN
    (SELECT AwayTeam AS Team, CAST(SUM(HTAway) AS BIGINT) AS away_goals FROM matches GROUP BY AwayTeam) a
    ON h.Team = a.Team""", "home_goals", 15, "Team"))
def home_away_goals(t):
    return tm.top(tm.home_away_totals(t.matches, "HTHome", "HTAway"), "home_goals", 15, "Team")


_DIVISION_GOALS = "SELECT Division, AVG(HTHome + HTAway) AS avg_goals_per_match FROM matches GROUP BY Division"


@query("avg_goals_by_division", _DIVISION_GOALS, rounded=["avg_goals_per_match"])
def avg_goals_by_division(t):
    return tm.top(division_goals(t), "avg_goals_per_match", None, "Division")


def division_goals(t):
    return t.matches.groupBy("Division").agg(F.avg(F.col("HTHome") + F.col("HTAway")).alias("avg_goals_per_match"))


@query("mean_of_division_means", f"SELECT AVG(avg_goals_per_match) AS overall_avg FROM ({_DIVISION_GOALS})",
       rounded=["overall_avg"])
def mean_of_division_means(t):
    return division_goals(t).agg(F.avg("avg_goals_per_match").alias("overall_avg"))


@query("most_active_teams", top_sql(both_sides("1", "1", "total_matches"), "total_matches", 10, "Team"))
def most_active_teams(t):
    return tm.top(tm.team_counts(t.matches, None, "total_matches"), "total_matches", 10, "Team")


@query("top_winning_teams", top_sql(both_sides("CASE WHEN FTResult = 'H' THEN 1 ELSE 0 END",
                                               "CASE WHEN FTResult = 'A' THEN 1 ELSE 0 END", "total_wins"),
                                    "total_wins", 10, "Team"))
def top_winning_teams(t):
    return tm.top(tm.team_counts(t.matches, (result("H"), result("A")), "total_wins"), "total_wins", 10, "Team")


@query("top_home_winners", """SELECT HomeTeam, COUNT(*) AS home_wins FROM matches WHERE FTResult = 'H' GROUP BY HomeTeam
    ORDER BY home_wins DESC, HomeTeam LIMIT 10""")
def top_home_winners(t):
    return tm.top(t.matches.filter(result("H")).groupBy("HomeTeam").agg(F.count("*").alias("home_wins")), "home_wins", 10, "HomeTeam")


@query("team_year_elo", """SELECT Team, Year, MeanElo, Team || ' (' || Year || ')' AS label FROM (
      SELECT Team, Year, ROUND(AVG(Elo), 6) AS MeanElo FROM (
        SELECT HomeTeam AS Team, CAST(YEAR(MatchDate) AS INT) AS Year, HomeElo AS Elo FROM matches UNION ALL
        SELECT AwayTeam, CAST(YEAR(MatchDate) AS INT), AwayElo FROM matches) GROUP BY Team, Year)
    ORDER BY MeanElo DESC, Team, Year LIMIT 10""", rounded=["MeanElo"])
def team_year_elo(t):
    year = F.year("MatchDate")
    rows = tm.side_rows(t.matches, {"Team": ("HomeTeam", "AwayTeam"), "Year": (year, year), "Elo": ("HomeElo", "AwayElo")})
    # Rounded before ranking: equal means must tie whatever the order of summation.
    means = rows.groupBy("Team", "Year").agg(F.round(F.avg("Elo"), 6).alias("MeanElo"))
    return tm.top(means, "MeanElo", 10, "Team", "Year").withColumn("label", F.format_string("%s (%d)", "Team", "Year"))


@query("yellow_cards_by_team", top_sql(both_sides("HomeYellow", "AwayYellow", "total_yellows"), "total_yellows", 10, "Team"))
def yellow_cards_by_team(t):
    return tm.top(tm.team_totals(t.matches, ("HomeYellow", "AwayYellow"), "total_yellows"), "total_yellows", 10, "Team")


@query("red_cards_by_team", top_sql(both_sides("HomeRed", "AwayRed", "total_reds", as_type="DOUBLE"), "total_reds", 10, "Team"))
def red_cards_by_team(t):
    reds = (F.col("HomeRed").cast("double"), F.col("AwayRed").cast("double"))
    return tm.top(tm.team_totals(t.matches, reds, "total_reds"), "total_reds", 10, "Team")


@query("cards_by_division", """SELECT Division, AVG(HomeYellow + AwayYellow) AS avg_yellows_per_match,
    AVG(HomeRed + AwayRed) AS avg_reds_per_match FROM matches GROUP BY Division""",
       rounded=["avg_yellows_per_match", "avg_reds_per_match"])
def cards_by_division(t):
    out = t.matches.groupBy("Division").agg(
        F.avg(F.col("HomeYellow") + F.col("AwayYellow")).alias("avg_yellows_per_match"),
        F.avg(F.col("HomeRed") + F.col("AwayRed")).alias("avg_reds_per_match"))
    return tm.top(out, "avg_yellows_per_match", None, "Division")


@query("scorelines", """SELECT FTHome || '-' || FTAway AS Scoreline, COUNT(*) AS n FROM matches GROUP BY Scoreline
    ORDER BY n DESC, Scoreline LIMIT 15""")
def scorelines(t):
    line = F.concat_ws("-", F.col("FTHome").cast("string"), F.col("FTAway").cast("string"))
    return tm.top(t.matches.groupBy(line.alias("Scoreline")).agg(F.count("*").alias("n")), "n", 15, "Scoreline")


@query("comebacks", top_sql(both_sides("1", "1", "comebacks", ("HTResult = 'A' AND FTResult = 'H'", "HTResult = 'H' AND FTResult = 'A'")),
                            "comebacks", 10, "Team"))
def comebacks(t):
    ht = F.col("HTResult")
    return tm.top(tm.team_counts(t.matches, ((ht == "A") & result("H"), (ht == "H") & result("A")), "comebacks", drop_zero=True), "comebacks", 10, "Team")


@query("blown_leads", top_sql(both_sides("1", "1", "blown_leads", ("HTResult = 'H' AND FTResult = 'A'", "HTResult = 'A' AND FTResult = 'H'")),
                              "blown_leads", 10, "Team"))
def blown_leads(t):
    ht = F.col("HTResult")
    return tm.top(tm.team_counts(t.matches, ((ht == "H") & result("A"), (ht == "A") & result("H")), "blown_leads", drop_zero=True), "blown_leads", 10, "Team")


# --- overall outcomes ------------------------------------------------------------------------

@query("outcome_distribution", f"SELECT COUNT(*) AS n, {NAMED_SQL} FROM matches", rounded=NAMED.values())
def outcome_distribution(t):
    return t.matches.agg(F.count("*").alias("n"), *[share(F.col("FTResult") == o).alias(n) for o, n in NAMED.items()])


@query("goals_by_outcome", "SELECT FTResult, AVG(FTHome + FTAway) AS avg_goals FROM matches GROUP BY FTResult", rounded=["avg_goals"])
def goals_by_outcome(t):
    return t.matches.groupBy("FTResult").agg(F.avg(F.col("FTHome") + F.col("FTAway")).alias("avg_goals"))


@query("home_away_goals_by_division", """SELECT Division, AVG(FTHome) AS avg_home_goals, AVG(FTAway) AS avg_away_goals,
    AVG(FTHome - FTAway) AS home_advantage_margin, COUNT(*) AS n_matches FROM matches GROUP BY Division""",
       rounded=["avg_home_goals", "avg_away_goals", "home_advantage_margin"])
def home_away_goals_by_division(t):
    out = oc.group_summary(t.matches, "Division", {
        "avg_home_goals": F.avg("FTHome"), "avg_away_goals": F.avg("FTAway"),
        "home_advantage_margin": F.avg(F.col("FTHome") - F.col("FTAway"))})
    return tm.top(out, "home_advantage_margin", None, "Division")


@query("outcome_pct_by_division", f"SELECT Division, {NAMED_SQL}, COUNT(*) AS n_matches FROM matches GROUP BY Division",
       rounded=NAMED.values())
def outcome_pct_by_division(t):
    return tm.top(oc.outcome_rates(t.matches, "Division", labels=NAMED, count_name="n_matches"), "home_win_pct", None, "Division")


# --- strength and form -----------------------------------------------------------------------

@query("elo_diff_bins", f"""SELECT ROUND((HomeElo - AwayElo) / 25) * 25 + 0.0 AS EloBin, {NAMED_SQL}, COUNT(*) AS n_matches
    FROM matches GROUP BY EloBin HAVING COUNT(*) > 50""", rounded=("EloBin", *NAMED.values()))
def elo_diff_bins(t):
    bins = round_bin(F.col("HomeElo") - F.col("AwayElo"), width=25)
    return oc.outcome_rates(t.matches, bins, "EloBin", labels=NAMED, min_n=50, count_name="n_matches").orderBy("EloBin")


def _register_elo(side: str) -> None:
    own, other = ("FTHome", "FTAway") if side == "home" else ("FTAway", "FTHome")
    win, loss = ("H", "A") if side == "home" else ("A", "H")
    col = f"{side.title()}Elo"
    bin_sql = f"ROUND({col} / 100) * 100 + 0.0 AS EloBin"

    @query(f"elo_goals_{side}", f"""SELECT {bin_sql}, AVG({own}) AS avg_goals_scored, AVG({other}) AS avg_goals_conceded,
        COUNT(*) AS n_matches FROM matches GROUP BY EloBin HAVING COUNT(*) > 30""",
           rounded=["avg_goals_scored", "avg_goals_conceded"])
    def elo_goals(t):
        return oc.group_summary(t.matches, round_bin(col, width=100), {
            "avg_goals_scored": F.avg(own), "avg_goals_conceded": F.avg(other)}, "EloBin", 30).orderBy("EloBin")

    labels = {win: "win_rate", "D": "draw_rate", loss: "loss_rate"}
    rates = ", ".join(share_sql(o, n) for o, n in labels.items())

    @query(f"elo_outcome_{side}", f"SELECT {bin_sql}, {rates}, COUNT(*) AS n_matches FROM matches GROUP BY EloBin HAVING COUNT(*) > 30",
           rounded=labels.values())
    def elo_outcome(t):
        return oc.outcome_rates(t.matches, round_bin(col, width=100), "EloBin", outcomes=tuple(labels), labels=labels,
                                min_n=30, count_name="n_matches").orderBy("EloBin")

    form = f"Form3{side.title()}"

    @query(f"form3_{side}", f"""SELECT ROUND({form} * 10) / 10 + 0.0 AS FormBin, AVG({own}) AS avg_goals, {share_sql(win, 'win_pct')},
        COUNT(*) AS n_matches FROM matches GROUP BY FormBin HAVING COUNT(*) > 30""", rounded=["avg_goals", "win_pct"])
    def form3(t):
        return oc.group_summary(t.matches, round_bin(form, per_unit=10), {
            "avg_goals": F.avg(own), "win_pct": share(F.col("FTResult") == win)}, "FormBin", 30).orderBy("FormBin")


for _side in ("home", "away"):
    _register_elo(_side)

_GAP = """SELECT ABS(HomeElo - AwayElo) AS gap, CASE WHEN FTResult = 'D' THEN 0
      WHEN (HomeElo > AwayElo AND FTResult = 'H') OR (HomeElo < AwayElo AND FTResult = 'A') THEN 1
      WHEN (HomeElo > AwayElo AND FTResult = 'A') OR (HomeElo < AwayElo AND FTResult = 'H') THEN -1 END AS won FROM matches"""


def box_sql(rows: str, by: str, value: str) -> str:
    """SQL: quartiles per group and whiskers at the last values within 1.5 IQR."""
    return f"""WITH r AS ({rows}), q AS (SELECT {by}, COUNT(*) AS n, QUANTILE_CONT({value}, 0.25) AS q1,
        QUANTILE_CONT({value}, 0.5) AS median, QUANTILE_CONT({value}, 0.75) AS q3 FROM r GROUP BY {by})
      SELECT q.{by}, q.n, q.q1, q.median, q.q3, MIN(r.{value}) FILTER (WHERE r.{value} >= q1 - 1.5 * (q3 - q1)) AS whisker_low,
        MAX(r.{value}) FILTER (WHERE r.{value} <= q3 + 1.5 * (q3 - q1)) AS whisker_high
      FROM r JOIN q ON r.{by} = q.{by} GROUP BY q.{by}, q.n, q.q1, q.median, q.q3"""


BOX = ("q1", "median", "q3", "whisker_low", "whisker_high")


@query("elo_gap_by_outcome", box_sql(f"SELECT won AS StrongerTeamWon, gap FROM ({_GAP}) WHERE won IS NOT NULL", "StrongerTeamWon", "gap"),
       rounded=BOX)
def elo_gap_by_outcome(t):
    return box_stats(elo_gap_rows(t.stored), "AbsoluteEloDiff", "StrongerTeamWon", (1, 0, -1))


@query("elo_gap_literal", box_sql("SELECT CASE WHEN FTResult = 'D' THEN 0 ELSE 1 END AS StrongerTeamWon, ABS(HomeElo - AwayElo) AS gap FROM matches",
                                  "StrongerTeamWon", "gap"), rounded=BOX)
def elo_gap_literal(t):
    return box_stats(elo_gap_rows(t.stored, literal=True), "AbsoluteEloDiff", "StrongerTeamWon", (1, 0))


@query("elo_gap_correlation", f"""SELECT r, n, r * SQRT(n - 2) / SQRT(1 - r * r) AS t FROM
    (SELECT CORR(won, gap) AS r, COUNT(*) AS n FROM ({_GAP}) WHERE won <> 0)""", rounded=["r", "t"])
def elo_gap_correlation(t):
    return point_biserial(elo_gap_rows(t.matches).filter("StrongerTeamWon <> 0"), "StrongerTeamWon", "AbsoluteEloDiff")


@query("elo_gap_correlation_p", t_tail_sql(f"""SELECT 'AbsoluteEloDiff' AS feature, r, n, r * SQRT(n - 2) / SQRT(1 - r * r) AS t FROM
    (SELECT CORR(won, gap) AS r, COUNT(*) AS n FROM ({_GAP}) WHERE won <> 0)""", "feature"), rounded=["r", "t", "p"])
def elo_gap_correlation_p(t):
    rows = elo_gap_rows(t.matches).filter("StrongerTeamWon <> 0")
    out = point_biserial(rows, "StrongerTeamWon", "AbsoluteEloDiff", with_p=True)
    return out.select(F.lit("AbsoluteEloDiff").alias("feature"), "*")


def _signal_sql(n: int) -> str:
    return f"""SELECT ROUND((Form{n}Home - Form{n}Away) * 5) / 5 + 0.0 AS FormAdvBin, {share_sql('H', 'home_win_pct')},
        COUNT(*) AS n_matches FROM matches GROUP BY FormAdvBin HAVING COUNT(*) > 40"""


def _signal(t, n: int):
    return oc.advantage_rates(t.matches, f"Form{n}Home", f"Form{n}Away")


@query("form3_signal", _signal_sql(3), rounded=["FormAdvBin", "home_win_pct"])
def form3_signal(t):
    return _signal(t, 3).orderBy("FormAdvBin")


@query("form5_signal", _signal_sql(5), rounded=["FormAdvBin", "home_win_pct"])
def form5_signal(t):
    return _signal(t, 5).orderBy("FormAdvBin")


@query("form_signal_pearson", " UNION ALL ".join(
    f"SELECT {n} AS matches_back, CORR(FormAdvBin, home_win_pct) AS r FROM ({_signal_sql(n)})" for n in (3, 5)), rounded=["r"])
def form_signal_pearson(t):
    r = [_signal(t, n).agg(F.lit(n).alias("matches_back"), F.corr("FormAdvBin", "home_win_pct").alias("r")) for n in (3, 5)]
    return r[0].unionByName(r[1])


@query("advantage_type", f"""WITH o AS (SELECT * FROM (VALUES ('Both', 0), ('Elo Only', 1), ('Form Only', 2), ('None', 3)) v(AdvantageType, position)),
    m AS (SELECT CASE WHEN HomeElo > AwayElo AND Form3Home > Form3Away THEN 'Both' WHEN HomeElo > AwayElo THEN 'Elo Only'
            WHEN Form3Home > Form3Away THEN 'Form Only' ELSE 'None' END AS AdvantageType, {NAMED_SQL}, COUNT(*) AS total
          FROM matches GROUP BY 1)
    SELECT o.AdvantageType, o.position, home_win_pct, draw_pct, away_win_pct, total FROM o LEFT JOIN m ON o.AdvantageType = m.AdvantageType""",
       rounded=NAMED.values())
def advantage(t):
    rates = oc.outcome_rates(t.matches, advantage_type(), "AdvantageType", labels=NAMED, count_name="total")
    return oc.reindex(rates, "AdvantageType", ("Both", "Elo Only", "Form Only", "None")).orderBy("position")


# --- odds ------------------------------------------------------------------------------------

@query("odds_calibration", f"""SELECT ROUND(1 / OddHome * 10) / 10 + 0.0 AS ImpliedHomeBin, {share_sql('H', 'actual_pct')}, COUNT(*) AS n,
    AVG(1 / OddHome) AS implied_mean, AVG(1 / OddHome) * 100 AS implied_pct FROM matches GROUP BY ImpliedHomeBin HAVING COUNT(*) > 50""",
       rounded=["actual_pct", "implied_mean", "implied_pct"])
def odds_calibration(t):
    implied = reciprocal("OddHome")
    out = oc.group_summary(t.matches, round_bin(implied, per_unit=10), {
        "actual_pct": share(result("H")), "implied_mean": F.avg(implied)}, "ImpliedHomeBin", 50, "n")
    return out.withColumn("implied_pct", F.col("implied_mean") * 100).orderBy("ImpliedHomeBin")


@query("favourite_accuracy", """SELECT FavType, COUNT(*) FILTER (WHERE (FavType = 'Home Favourite' AND FTResult = 'H') OR
      (FavType = 'Away Favourite' AND FTResult = 'A')) / COUNT(*) * 100 AS accuracy, COUNT(*) AS n FROM (
      SELECT FTResult, CASE WHEN OddHome < OddAway THEN 'Home Favourite' WHEN OddAway < OddHome THEN 'Away Favourite'
        ELSE 'Even Odds' END AS FavType FROM matches) GROUP BY FavType""", rounded=["accuracy"])
def favourite_accuracy(t):
    home, away = F.col("OddHome") < F.col("OddAway"), F.col("OddAway") < F.col("OddHome")
    fav = F.when(home, "Home Favourite").when(away, "Away Favourite").otherwise("Even Odds")
    return oc.group_summary(t.matches, fav, {"accuracy": share(home & result("H") | away & result("A"))}, "FavType", count_name="n")


@query("underdog_home", """SELECT COUNT(*) FILTER (WHERE FTResult = 'H') AS wins, COUNT(*) AS n,
    COUNT(*) FILTER (WHERE FTResult = 'H') / COUNT(*) * 100 AS win_pct FROM matches WHERE OddHome > OddAway""", rounded=["win_pct"])
def underdog_home(t):
    return t.matches.filter(F.col("OddHome") > F.col("OddAway")).agg(
        F.count_if(result("H")).alias("wins"), F.count("*").alias("n"), (F.try_divide(F.count_if(result("H")), F.count("*")) * 100).alias("win_pct"))


@query("over25_by_elo", """SELECT ROUND((HomeElo + AwayElo) / 2 / 100) * 100 + 0.0 AS EloBin,
    COUNT(*) FILTER (WHERE FTHome + FTAway > 2) / COUNT(*) * 100 AS over_pct, COUNT(*) AS n FROM matches
    GROUP BY EloBin HAVING COUNT(*) > 30""", rounded=["over_pct"])
def over25_by_elo(t):
    avg_elo = (F.col("HomeElo") + F.col("AwayElo")) / 2
    return oc.group_summary(t.matches, round_bin(avg_elo, width=100), {
        "over_pct": share(F.col("FTHome") + F.col("FTAway") > 2)}, "EloBin", 30, "n").orderBy("EloBin")


@query("elo_odds_sample", f"""SELECT MatchId, HomeElo - AwayElo AS EloDiff, OddHome, FTResult FROM matches
    WHERE {key_hash_sql('MatchId', 'sample42')} < {int(0.05 * HASH_RANGE)}""")
def elo_odds_sample(t):
    rows = t.matches.select("MatchId", (F.col("HomeElo") - F.col("AwayElo")).alias("EloDiff"), "OddHome", "FTResult").dropna()
    return hash_sample(rows, 0.05)


# --- one feature against the outcome ---------------------------------------------------------

_BY_OUTCOME = """WITH o AS (SELECT * FROM (VALUES ('H', 0), ('D', 1), ('A', 2)) v(FTResult, position)),
    m AS (SELECT FTResult, AVG({0}) AS avg_val, COUNT(*) AS n FROM matches GROUP BY FTResult)
    SELECT o.FTResult, o.position, m.avg_val, m.n FROM o LEFT JOIN m ON o.FTResult = m.FTResult"""


def _register_mean(name: str, col: str) -> None:
    @query(name, _BY_OUTCOME.format(col), rounded=["avg_val"])
    def build(t):
        return oc.mean_by_outcome(t.matches, col).orderBy("position")


def _register_rates(name: str, alias: str, sql_bin: str, make_bin, within=None, min_n: int | None = 30, round_key: bool = True) -> None:
    where = f"WHERE {alias} BETWEEN {within[0]} AND {within[1]}" if within else ""
    having = f"HAVING COUNT(*) > {min_n}" if min_n is not None else ""
    sql = f"""SELECT {alias}, {PCT_SQL}, COUNT(*) AS n FROM (SELECT {sql_bin} AS {alias}, FTResult FROM matches)
        {where} GROUP BY {alias} {having}"""

    @query(name, sql, rounded=(alias, *PCT) if round_key else PCT)
    def build(t):
        rows = t.matches.select(make_bin().alias(alias), "FTResult")
        if within:
            rows = rows.filter(F.col(alias).between(*within))
        return oc.outcome_rates(rows, alias, min_n=min_n).orderBy(alias)


def _register_prob(name: str, alias: str, sql_value: str, value) -> None:
    @query(name, f"""SELECT CAST(FLOOR(({sql_value}) / 100) AS BIGINT) * 100 AS {alias}, COUNT(*) AS n, {PROB_SQL} FROM matches
        GROUP BY {alias} HAVING COUNT(*) > 30""", rounded=PROB)
    def build(t):
        return oc.outcome_rates(t.matches, floor_bin(value(), 100), alias, labels={o: f"P_{o}" for o in "HDA"},
                                min_n=30, scale=1).orderBy(alias)


def _register_box(name: str, col: str) -> None:
    @query(name, box_sql(f"SELECT FTResult, {col} AS v FROM matches WHERE {col} IS NOT NULL", "FTResult", "v"), rounded=BOX)
    def build(t):
        return box_stats(t.stored, col)


def _rounded(col: str, per_unit: int):
    return f"ROUND({col} * {per_unit}) / {per_unit} + 0.0", lambda: round_bin(col, per_unit=per_unit)


_register_mean("avg_by_outcome", "OddHome")
_register_box("box_stats", "OddHome")
_register_rates("outcome_pct_by_bin", "AwayYellow", "AwayYellow", lambda: F.col("AwayYellow"), round_key=False)
_register_rates("f01_division", "Division", "Division", lambda: F.col("Division"), round_key=False)
_register_rates("f02_year", "Year", "CAST(YEAR(MatchDate) AS INT)", lambda: F.year("MatchDate"), round_key=False)
_register_prob("f05_home_elo", "HomeEloBin", "HomeElo", lambda: F.col("HomeElo"))
_register_prob("f05_away_elo", "AwayEloBin", "AwayElo", lambda: F.col("AwayElo"))
_register_prob("f05_elo_diff", "HomeAwayDiffEloBin", "HomeElo - AwayElo", lambda: F.col("HomeElo") - F.col("AwayElo"))
_register_prob("outcome_prob_home_elo", "EloBin", "HomeElo", lambda: F.col("HomeElo"))


@query("favourite_win_prob", """SELECT CAST(FLOOR(HomeElo / 100) AS BIGINT) * 100 AS EloBin, COUNT(*) FILTER (WHERE HomeElo > AwayElo) AS n_favourite,
    COUNT(*) FILTER (WHERE HomeElo < AwayElo) AS n_outsider,
    COUNT(*) FILTER (WHERE HomeElo > AwayElo AND FTResult = 'H') / NULLIF(COUNT(*) FILTER (WHERE HomeElo > AwayElo), 0) AS p_favourite,
    COUNT(*) FILTER (WHERE HomeElo < AwayElo AND FTResult = 'H') / NULLIF(COUNT(*) FILTER (WHERE HomeElo < AwayElo), 0) AS p_outsider
    FROM matches GROUP BY EloBin HAVING COUNT(*) > 30""", rounded=["p_favourite", "p_outsider"])
def favourite_win_prob(t):
    """P(home win | home side is rated higher) and P(home win | lower) for each bin of the home side's rating."""
    above, below, won = F.col("HomeElo") > F.col("AwayElo"), F.col("HomeElo") < F.col("AwayElo"), F.col("FTResult") == "H"
    counts = t.matches.groupBy(floor_bin(F.col("HomeElo"), 100).alias("EloBin")).agg(
        F.count("*").alias("n"), F.count_if(above).alias("n_favourite"), F.count_if(below).alias("n_outsider"),
        F.count_if(above & won).alias("w_favourite"), F.count_if(below & won).alias("w_outsider"))
    return counts.filter("n > 30").select("EloBin", "n_favourite", "n_outsider", *[
        F.try_divide(F.col(f"w_{s}"), F.col(f"n_{s}")).alias(f"p_{s}") for s in ("favourite", "outsider")])


for _name, _col in {"f07_form3_home": "Form3Home", "f08_form5_home": "Form5Home", "f09_form3_away": "Form3Away",
                    "f10_form5_away": "Form5Away"}.items():
    _register_rates(_name, f"{_col}Bin", *_rounded(_col, 10))
_register_mean("f11_ft_home", "FTHome")
_register_mean("f12_ft_away", "FTAway")
_register_rates("f20_odd_home", "OddHomeBin", *_rounded("OddHome", 2), within=(1.0, 10.0))
_register_rates("f21_odd_draw", "OddDrawBin", *_rounded("OddDraw", 2), within=(2.0, 8.0))
_register_rates("f22_odd_away", "OddAwayBin", *_rounded("OddAway", 2), within=(1.0, 10.0))
_register_box("f23_max_home", "MaxHome")
_register_box("f24_max_draw", "MaxDraw")
_register_box("f25_max_away", "MaxAway")
_register_rates("f26_over_under", "Over25Flag", "CASE WHEN FTHome + FTAway > 2 THEN 'Over 2.5' ELSE 'Under 2.5' END",
                lambda: F.when(F.col("FTHome") + F.col("FTAway") > 2, "Over 2.5").otherwise("Under 2.5"),
                min_n=None, round_key=False)
_register_rates("f27_handicap", "HandiBin", *_rounded("HandiSize", 4), within=(-3.0, 3.0))
_register_box("f28_handi_home", "HandiHome")
_register_box("f28_handi_away", "HandiAway")
