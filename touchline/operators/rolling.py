"""Rolling sums over a team's previous matches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators.ranges import border_rows, in_ranges
from touchline.schema import DATE, KEY

# A task sorts at most about this many rows of one team.
MAX_GROUP_ROWS = 5_000_000


def _previous(group: list, order: tuple[str, ...], n: int):
    return Window.partitionBy(*group).orderBy(*order).rowsBetween(-n, -1)


def _hot_groups(df: DataFrame, group: str, max_rows: int) -> DataFrame:
    """Groups above ``max_rows``; at most total rows / ``max_rows`` can qualify."""
    return df.groupBy(group).agg(F.count("*").alias("_n")).filter(F.col("_n") > max_rows).select(group)


def _chunked(df: DataFrame, hot: DataFrame, group: str, order: tuple[str, ...], max_rows: int) -> DataFrame:
    """Add ``_chunk``: for hot groups the number of a range of about ``max_rows`` counted rows along (group, order), else 0.

    The cuts follow the rows, whatever days and keys look like. Only rows of hot groups are moved for them.
    """
    names = hot.select(F.col(group).alias("_name"))
    is_hot = F.col(group).eqNullSafe(F.col("_name"))
    rows = df.join(F.broadcast(names), is_hot, "left_semi")
    ranges = in_ranges(rows, [group, *order], -(-rows.count() // max_rows), "_chunk")
    others = df.join(F.broadcast(names), is_hot, "left_anti").withColumn("_chunk", F.lit(0))
    return ranges.withColumn("_hot", F.lit(True)).unionByName(others.withColumn("_hot", F.lit(False)))


def rolling_sums(df: DataFrame, group: str, sums: dict[str, str], n: int = 5, order: tuple[str, ...] = (DATE, KEY),
                 max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """For each row, sums over the group's previous ``n`` rows; an empty frame gives 0.

    A group of ordinary size is one window partition. If some group is larger than
    ``max_group_rows``, its rows are cut into counted ranges along the order. Each
    range starts with the last ``n`` rows before it, so the sums stay exact.
    """
    hot = _hot_groups(df, group, max_group_rows)
    if not hot.isEmpty():
        return _rolling_sums_chunked(_chunked(df, hot, group, order, max_group_rows), group, sums, n, order)
    frame = _previous([group], order, n)
    return df.withColumns({name: F.coalesce(F.sum(c).over(frame), F.lit(0)) for name, c in sums.items()})


def _rolling_sums_chunked(rows: DataFrame, group: str, sums: dict[str, str], n: int, order: tuple[str, ...]) -> DataFrame:
    halo = border_rows(rows.filter("_hot"), [group], list(order), sorted(set(sums.values())), n, part="_chunk")
    both = rows.drop("_hot").withColumn("_halo", F.lit(False)).unionByName(halo.withColumn("_halo", F.lit(True)), allowMissingColumns=True)
    frame = _previous([group, "_chunk"], order, n)
    out = both.withColumns({name: F.coalesce(F.sum(c).over(frame), F.lit(0)) for name, c in sums.items()})
    return out.filter(~F.col("_halo")).drop("_halo", "_chunk")


def side_sums(side: str, n: int) -> dict[str, str]:
    """Names and sources of one side's rolling sums."""
    own, other = ("FTHome", "FTAway") if side == "home" else ("FTAway", "FTHome")
    cards = "Home" if side == "home" else "Away"
    return {f"{side}_goals_last{n}_sum": own, f"{side}_conceded_last{n}_sum": other,
            f"{side}_reds_last{n}_sum": f"{cards}Red", f"{side}_yellows_last{n}_sum": f"{cards}Yellow"}


def rolling_home_form(df: DataFrame, n: int = 5, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    return rolling_sums(df, "HomeTeam", side_sums("home", n), n, max_group_rows=max_group_rows)


def rolling_away_form(df: DataFrame, n: int = 5, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    return rolling_sums(df, "AwayTeam", side_sums("away", n), n, max_group_rows=max_group_rows)


def rolling_diffs(n: int = 5) -> dict[str, Column]:
    """Goal difference and card total of both sides' rolling sums."""
    cards = [F.col(f"{s}_{c}_last{n}_sum") for c in ("yellows", "reds") for s in ("home", "away")]
    return {f"goals_last{n}_diff": F.col(f"home_goals_last{n}_sum") - F.col(f"away_goals_last{n}_sum"),
            f"cards_last{n}_sum": cards[0] + cards[1] + cards[2] + cards[3]}


def match_differences() -> dict[str, Column]:
    return {"EloDiff": F.col("HomeElo") - F.col("AwayElo"), "Form3Diff": F.col("Form3Home") - F.col("Form3Away"),
            "Form5Diff": F.col("Form5Home") - F.col("Form5Away"), "OddDiff": F.col("OddHome") - F.col("OddAway"),
            "HandiOddDiff": F.col("HandiHome") - F.col("HandiAway")}


def engineered_features(df: DataFrame, n: int = 5, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Rolling sums of both sides, their differences, and the plain column differences."""
    out = rolling_away_form(rolling_home_form(df, n, max_group_rows), n, max_group_rows)
    return out.withColumns({**match_differences(), **rolling_diffs(n)})


def rolling_team_form(rows: DataFrame, n: int = 5, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """The same over all matches of a team, for team rows (home and away together)."""
    sums = {f"goals_for_last{n}": "GoalsFor", f"goals_against_last{n}": "GoalsAgainst",
            f"yellows_last{n}": "Yellow", f"reds_last{n}": "Red"}
    return rolling_sums(rows, "Team", sums, n, (DATE, KEY, "Side"), max_group_rows)
