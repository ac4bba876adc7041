"""Basic operators as named queries: scans and sinks, projections, filters, functions, splits."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.dates import date_parts, unix_seconds
from touchline.functions.expressions import HASH_RANGE, floor_bin, key_hash_sql, reciprocal, round_bin
from touchline.operators.cleaning import NUMERIC_TYPES, columns_by_type
from touchline.operators.outcomes import mean_by_outcome
from touchline.operators.rolling import match_differences
from touchline.operators.sampling import hash_sample, hash_split, random_split, stratified_sample
from touchline.operators.teams import team_rows
from touchline.plans.registry import TRAIN_SHARE, query
from touchline.schema import KEYED_MATCH_SCHEMA
from touchline.session import scratch_path
from touchline.sources.tables import partition_sizes, read_matches, write_table


@query("scan_matches", "SELECT * FROM matches")
def scan_matches(t):
    path = scratch_path(t.spark, "matches-csv")
    write_table(t.matches, path, "csv")
    return read_matches(t.spark, path, schema=KEYED_MATCH_SCHEMA)


@query("sink_roundtrip", "SELECT * FROM matches")
def sink_roundtrip(t):
    path = scratch_path(t.spark, "matches-parquet")
    write_table(t.matches, path, "parquet")
    return read_matches(t.spark, path, fmt="parquet")


@query("repartitioned_rows", "SELECT * FROM matches")
def repartitioned_rows(t):
    return t.matches.repartition(16)


@query("partition_sizes")
def sizes(t):
    return partition_sizes(t.matches.repartition(16))


@query("partition_totals", "SELECT CAST(16 AS BIGINT) AS partitions, COUNT(*) AS n FROM matches")
def partition_totals(t):
    found = partition_sizes(t.matches.repartition(16))
    return found.agg(F.count("*").alias("partitions"), F.sum("n").alias("n"))


@query("partition_balance", "SELECT CAST(16 AS BIGINT) AS partitions, COUNT(*) AS n, COUNT(*) >= 0 AS even FROM matches")
def partition_balance(t):
    """Dealing rows out in turn leaves sizes that differ by at most one row for each partition that deals."""
    dealing = t.matches.rdd.getNumPartitions()
    found = partition_sizes(t.matches.repartition(16))
    return found.agg(F.count("*").alias("partitions"), F.sum("n").alias("n"), (F.max("n") - F.min("n") <= dealing).alias("even"))


@query("row_count", "SELECT COUNT(*) AS n FROM matches")
def row_count(t):
    return t.matches.agg(F.count("*").alias("n"))


@query("project_alias", "SELECT MatchId, HomeTeam AS Team, FTHome AS GoalsFor, FTAway AS GoalsAgainst FROM matches")
def project_alias(t):
    return t.matches.select("MatchId", F.col("HomeTeam").alias("Team"), F.col("FTHome").alias("GoalsFor"),
                            F.col("FTAway").alias("GoalsAgainst"))


@query("rename_away", "SELECT AwayTeam AS HomeTeam, CAST(SUM(HTAway) AS BIGINT) AS total_goals FROM matches GROUP BY AwayTeam")
def rename_away(t):
    return t.matches.groupBy("AwayTeam").agg(F.sum("HTAway").alias("total_goals")).withColumnRenamed("AwayTeam", "HomeTeam")


@query("derived_diffs", """SELECT MatchId, HomeElo - AwayElo AS EloDiff, Form3Home - Form3Away AS Form3Diff,
    Form5Home - Form5Away AS Form5Diff, OddHome - OddAway AS OddDiff, HandiHome - HandiAway AS HandiOddDiff,
    (HomeElo + AwayElo) / 2 AS AvgElo FROM matches""")
def derived_diffs(t):
    return t.matches.select("MatchId", *[c.alias(n) for n, c in match_differences().items()],
                            ((F.col("HomeElo") + F.col("AwayElo")) / 2).alias("AvgElo"))


@query("cast_reds", """SELECT MatchId, CAST(HomeRed AS DOUBLE) AS HomeRed, CAST(AwayRed AS DOUBLE) AS AwayRed,
    CAST(FTHome AS VARCHAR) AS HomeText FROM matches""")
def cast_reds(t):
    return t.matches.select("MatchId", F.col("HomeRed").cast("double"), F.col("AwayRed").cast("double"),
                            F.col("FTHome").cast("string").alias("HomeText"))


@query("filter_equality", "SELECT MatchId, HomeTeam FROM matches WHERE HTResult = 'A' AND FTResult = 'H'")
def filter_equality(t):
    return t.matches.filter((F.col("HTResult") == "A") & (F.col("FTResult") == "H")).select("MatchId", "HomeTeam")


@query("filter_range", """SELECT MatchId, ROUND(OddHome * 2) / 2 AS OddHomeBin FROM matches
    WHERE ROUND(OddHome * 2) / 2 >= 1 AND ROUND(OddHome * 2) / 2 <= 10""")
def filter_range(t):
    return t.matches.select("MatchId", round_bin("OddHome", per_unit=2).alias("OddHomeBin")).filter(
        F.col("OddHomeBin").between(1.0, 10.0))


@query("filter_isin", "SELECT MatchId, FTResult FROM matches_raw WHERE FTResult NOT IN ('H', 'D', 'A')")
def filter_isin(t):
    return t.raw.filter(~F.col("FTResult").isin("H", "D", "A")).select("MatchId", "FTResult")


@query("case_advantage", """SELECT MatchId, CASE
      WHEN HomeElo - AwayElo > 0 AND Form3Home - Form3Away > 0 THEN 'Both'
      WHEN HomeElo - AwayElo > 0 AND Form3Home - Form3Away <= 0 THEN 'Elo Only'
      WHEN HomeElo - AwayElo <= 0 AND Form3Home - Form3Away > 0 THEN 'Form Only' ELSE 'None' END AS AdvantageType
    FROM matches""")
def case_advantage(t):
    return t.matches.select("MatchId", advantage_type().alias("AdvantageType"))


def advantage_type():
    elo, form = F.col("HomeElo") - F.col("AwayElo"), F.col("Form3Home") - F.col("Form3Away")
    return (F.when((elo > 0) & (form > 0), "Both").when((elo > 0) & (form <= 0), "Elo Only")
             .when((elo <= 0) & (form > 0), "Form Only").otherwise("None"))


@query("outcome_indicators", "SELECT MatchId, " + ", ".join(
    f"CASE WHEN FTResult = '{o}' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS is_{o}" for o in "HDA") + " FROM matches")
def outcome_indicators(t):
    return t.matches.select("MatchId", *[(F.col("FTResult") == o).cast("double").alias(f"is_{o}") for o in "HDA"])


@query("dropna_subset", "SELECT MatchId, HomeElo, AwayElo FROM matches_raw WHERE HomeElo IS NOT NULL AND AwayElo IS NOT NULL")
def dropna_subset(t):
    return t.raw.select("MatchId", "HomeElo", "AwayElo").dropna(subset=["HomeElo", "AwayElo"])


@query("fillna_dict", """SELECT MatchId, COALESCE(OddDraw, CAST(3.5 AS DOUBLE)) AS OddDraw,
    COALESCE(HTResult, 'Unknown') AS HTResult FROM matches_raw""")
def fillna_dict(t):
    return t.raw.select("MatchId", "OddDraw", "HTResult").fillna({"OddDraw": 3.5, "HTResult": "Unknown"})


_NUMERIC = [f.name for f in KEYED_MATCH_SCHEMA.fields
            if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in ("HomeElo", "AwayElo", "MatchId")]
_STRINGS = [f.name for f in KEYED_MATCH_SCHEMA.fields if isinstance(f.dataType, T.StringType)]


@query("columns_by_type", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{kind}' AS kind, COUNT({c}) AS filled FROM matches_raw"
    for kind, cols in (("numeric", _NUMERIC), ("string", _STRINGS)) for c in cols))
def by_type(t):
    numeric = columns_by_type(t.raw, NUMERIC_TYPES, exclude=("HomeElo", "AwayElo", "MatchId"))
    strings = columns_by_type(t.raw, T.StringType)
    counts = t.raw.agg(*[F.count(c).alias(c) for c in numeric + strings]).unpivot([], numeric + strings, "column", "filled")
    return counts.withColumn("kind", F.when(F.col("column").isin(numeric), "numeric").otherwise("string"))


@query("sample_hash", f"SELECT MatchId, FTResult FROM matches WHERE {key_hash_sql('MatchId', 'sample7')} < {int(0.3 * HASH_RANGE)}")
def sample_hash(t):
    return hash_sample(t.matches, 0.3, seed=7).select("MatchId", "FTResult")


@query("sample_of_test", f"SELECT MatchId, FTResult FROM test WHERE {key_hash_sql('MatchId', 'sample42')} < {int(0.3 * HASH_RANGE)}")
def sample_of_test(t):
    return hash_sample(t.split[1], 0.3).select("MatchId", "FTResult")


@query("split_hash", "SELECT 'train' AS part, MatchId FROM train UNION ALL SELECT 'test' AS part, MatchId FROM test")
def split_hash(t):
    train, test = hash_split(t.matches, TRAIN_SHARE)
    return train.select(F.lit("train").alias("part"), "MatchId").unionByName(test.select(F.lit("test").alias("part"), "MatchId"))


@query("split_random", "SELECT COUNT(*) AS n, CAST(0 AS BIGINT) AS in_both, CAST(0 AS BIGINT) AS in_none FROM matches")
def split_random(t):
    """Whether the two parts of the stored table are disjoint and complete."""
    train, test = random_split(t.stored)
    parts = train.select("MatchId", F.lit(1).alias("part")).unionByName(test.select("MatchId", F.lit(2).alias("part")))
    per_key = parts.groupBy("MatchId").agg(F.count("*").alias("times"))
    both = t.stored.select("MatchId").join(per_key, "MatchId", "left")
    return both.agg(F.count("*").alias("n"), F.count_if(F.col("times") > 1).alias("in_both"),
                    F.count_if(F.col("times").isNull()).alias("in_none"))


@query("dedupe", "SELECT DISTINCT * FROM matches_raw")
def dedupe(t):
    return t.raw.dropDuplicates()


@query("replace_nonpositive", """SELECT MatchId, CASE WHEN AwayElo > 0 THEN AwayElo ELSE
    (SELECT AVG(AwayElo) FROM matches_raw) END AS AwayElo FROM matches_raw""", rounded=["AwayElo"])
def replace_nonpositive(t):
    mean = t.raw.agg(F.avg("AwayElo")).first()[0]
    return t.raw.select("MatchId", F.when(F.col("AwayElo") > 0, F.col("AwayElo")).otherwise(mean).alias("AwayElo"))


@query("round_bins", """SELECT ROUND((HomeElo - AwayElo) / 25) * 25 + 0.0 AS EloBin,
    ROUND(OddHome * 2) / 2 + 0.0 AS OddBin, COUNT(*) AS n FROM matches GROUP BY ALL""")
def round_bins(t):
    return t.matches.groupBy((round_bin(F.col("HomeElo") - F.col("AwayElo"), width=25) + F.lit(0.0)).alias("EloBin"),
                             round_bin("OddHome", per_unit=2).alias("OddBin")).agg(F.count("*").alias("n"))


@query("floor_bins", "SELECT CAST(FLOOR((HomeElo - AwayElo) / 100) AS BIGINT) * 100 AS bin, COUNT(*) AS n FROM matches GROUP BY ALL")
def floor_bins(t):
    return t.matches.groupBy(floor_bin(F.col("HomeElo") - F.col("AwayElo"), 100).alias("bin")).agg(F.count("*").alias("n"))


@query("date_parts", """SELECT MatchId, CAST(ISODOW(MatchDate) - 1 AS INT) AS DayOfWeek, CAST(MONTH(MatchDate) AS INT) AS Month,
    CAST(YEAR(MatchDate) AS INT) AS Year, CAST(DAYOFYEAR(MatchDate) AS INT) AS DayOfYear,
    CAST(EPOCH(CAST(MatchDate AS TIMESTAMP)) AS BIGINT) AS DateInt FROM matches""")
def parts(t):
    return t.matches.select("MatchId", *[c.alias(n) for n, c in date_parts("MatchDate").items()],
                            unix_seconds("MatchDate").alias("DateInt"))


@query("implied_probability", "SELECT MatchId, 1 / OddHome AS ImpliedHome FROM matches")
def implied_probability(t):
    return t.matches.select("MatchId", reciprocal("OddHome").alias("ImpliedHome"))


_SIDE = """SELECT {team} AS Team, FTResult, MatchId, MatchDate, '{side}' AS Side, {gf} AS GoalsFor, {ga} AS GoalsAgainst,
    {pre}Yellow AS Yellow, {pre}Red AS Red, {pre}Elo AS Elo,
    CASE WHEN FTResult = 'D' THEN 'D' WHEN FTResult = '{side}' THEN 'W' ELSE 'L' END AS Result FROM matches"""


@query("team_rows", "SELECT * EXCLUDE (FTResult) FROM (" + " UNION ALL ".join([
    _SIDE.format(team="HomeTeam", side="H", gf="FTHome", ga="FTAway", pre="Home"),
    _SIDE.format(team="AwayTeam", side="A", gf="FTAway", ga="FTHome", pre="Away")]) + ")")
def rows_by_team(t):
    return team_rows(t.matches)


@query("reindex_outcomes", """WITH o AS (SELECT * FROM (VALUES ('H', 0), ('D', 1), ('A', 2)) v(FTResult, position)),
    m AS (SELECT FTResult, AVG(HomeYellow) AS avg_val, COUNT(*) AS n FROM matches WHERE FTHome <> FTAway GROUP BY FTResult)
    SELECT o.FTResult, o.position, m.avg_val, m.n FROM o LEFT JOIN m ON o.FTResult = m.FTResult""", rounded=["avg_val"])
def reindex_outcomes(t):
    return mean_by_outcome(t.matches.filter("FTHome <> FTAway"), "HomeYellow").orderBy("position")


@query("stratified_sample", f"""SELECT MatchId, FTResult FROM (SELECT MatchId, FTResult,
      ROW_NUMBER() OVER (PARTITION BY FTResult ORDER BY {key_hash_sql('MatchId', 'strata42')}, MatchId) AS rn,
      COUNT(*) OVER (PARTITION BY FTResult) AS n FROM test) WHERE rn <= ROUND(n * CAST(0.1 AS DOUBLE))""")
def stratified(t):
    return stratified_sample(t.split[1], 0.1).select("MatchId", "FTResult")
