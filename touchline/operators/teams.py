"""Team-perspective rows and rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.session import BROADCAST_ROWS, keep_for_join


def side_rows(df: DataFrame, columns: dict[str, tuple], keep=()) -> DataFrame:
    """Two rows per match, one for each side, from a single scan.

    ``columns`` maps an output name to its (home, away) source, given as a column
    name or an expression. The result is that of a UNION ALL of two projections.
    """
    def side(i: int) -> Column:
        picked = [(pair[i] if isinstance(pair[i], Column) else F.col(pair[i])).alias(n) for n, pair in columns.items()]
        return F.struct(*picked)

    return df.select(*keep, F.explode(F.array(side(0), side(1))).alias("_side")).select(*keep, "_side.*")


TEAM_COLUMNS = {
    "Team": ("HomeTeam", "AwayTeam"),
    "GoalsFor": ("FTHome", "FTAway"), "GoalsAgainst": ("FTAway", "FTHome"),
    "Yellow": ("HomeYellow", "AwayYellow"), "Red": ("HomeRed", "AwayRed"), "Elo": ("HomeElo", "AwayElo"),
}


def team_rows(df: DataFrame, key: str = "MatchId", date: str = "MatchDate") -> DataFrame:
    """The match table as team rows; ``Result`` is W, D or L from the team's view."""
    won = {"H": ("W", "L"), "A": ("L", "W")}
    def result(i: int) -> Column:
        return (F.when(F.col("FTResult") == "H", won["H"][i]).when(F.col("FTResult") == "A", won["A"][i])
                 .when(F.col("FTResult") == "D", "D"))
    columns = {**TEAM_COLUMNS, "Side": (F.lit("H"), F.lit("A")), "Result": (result(0), result(1))}
    return side_rows(df, columns, keep=(key, date))


def team_totals(df: DataFrame, value: tuple, name: str, by=("Team",), agg=F.sum, extra: dict | None = None) -> DataFrame:
    """Aggregate a (home, away) pair of values over both sides with one shuffle."""
    columns = {"Team": ("HomeTeam", "AwayTeam"), "_v": value, **(extra or {})}
    return side_rows(df, columns).groupBy(*by).agg(agg("_v").alias(name))


def team_counts(df: DataFrame, conditions: tuple[Column, Column] | None, name: str, drop_zero: bool = False) -> DataFrame:
    """Matches per team, or matches that meet the side's condition.

    ``drop_zero`` leaves out teams that never meet it, as a filter before the count does.
    """
    if conditions is None:
        pair = (F.lit(1).cast("bigint"), F.lit(1).cast("bigint"))
    else:
        pair = tuple(F.when(c, 1).otherwise(0).cast("bigint") for c in conditions)
    rows = side_rows(df, {"Team": ("HomeTeam", "AwayTeam"), "_v": pair})
    if drop_zero:
        rows = rows.filter("_v > 0")
    return rows.groupBy("Team").agg(F.sum("_v").alias(name))


def top(df: DataFrame, measure: str, n: int | None, *keys: str) -> DataFrame:
    """Highest measure first; the keys settle ties, so that a limit is deterministic."""
    out = df.orderBy(F.col(measure).desc(), *keys)
    return out.limit(n) if n is not None else out


def home_away_totals(df: DataFrame, home: str, away: str, names=("home_goals", "away_goals")) -> DataFrame:
    """Home total beside away total for teams seen on both sides.

    Equal to joining two grouped tables; both totals come from one aggregation.
    """
    zero = F.lit(None).cast("int")
    rows = side_rows(df, {"Team": ("HomeTeam", "AwayTeam"), "_home": (F.lit(True), F.lit(False)),
                          "_h": (home, zero), "_a": (zero, away)})
    both = rows.groupBy("Team").agg(F.sum("_h").alias(names[0]), F.sum("_a").alias(names[1]),
                                    F.bool_or("_home").alias("_at_home"), F.bool_and("_home").alias("_only_home"))
    return both.filter("_at_home AND NOT _only_home").select("Team", *names)


def fit_team_stats(train: DataFrame, home: dict[str, Column], away: dict[str, Column],
                   bound: int = BROADCAST_ROWS) -> tuple[DataFrame, DataFrame]:
    """Per-team aggregates of train rows: one table by home team, one by away team, each kept for joins."""
    return (keep_for_join(train.groupBy("HomeTeam").agg(*[c.alias(n) for n, c in home.items()]), bound),
            keep_for_join(train.groupBy("AwayTeam").agg(*[c.alias(n) for n, c in away.items()]), bound))


def apply_team_stats(df: DataFrame, home_stats: DataFrame, away_stats: DataFrame,
                     defaults: dict[str, float]) -> DataFrame:
    """Attach team aggregates; unseen teams get the default (the global train mean). Match rows are not shuffled
    if the team tables were small enough to broadcast."""
    out = df.join(home_stats, "HomeTeam", "left").join(away_stats, "AwayTeam", "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})
