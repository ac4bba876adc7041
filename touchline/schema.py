"""Column names, types and feature lists of the match table."""

from __future__ import annotations

from pyspark.sql import types as T

# Names and order of the match table's columns.
MATCH_COLUMNS = [
    ("Division", T.StringType()), ("MatchDate", T.DateType()),
    ("HomeTeam", T.StringType()), ("AwayTeam", T.StringType()),
    ("HomeElo", T.DoubleType()), ("AwayElo", T.DoubleType()),
    ("Form3Home", T.DoubleType()), ("Form5Home", T.DoubleType()),
    ("Form3Away", T.DoubleType()), ("Form5Away", T.DoubleType()),
    ("FTHome", T.IntegerType()), ("FTAway", T.IntegerType()), ("FTResult", T.StringType()),
    ("HTHome", T.IntegerType()), ("HTAway", T.IntegerType()), ("HTResult", T.StringType()),
    ("HomeYellow", T.IntegerType()), ("AwayYellow", T.IntegerType()),
    ("HomeRed", T.IntegerType()), ("AwayRed", T.IntegerType()),
    ("OddHome", T.DoubleType()), ("OddDraw", T.DoubleType()), ("OddAway", T.DoubleType()),
    ("MaxHome", T.DoubleType()), ("MaxDraw", T.DoubleType()), ("MaxAway", T.DoubleType()),
    ("Over25", T.DoubleType()), ("Under25", T.DoubleType()),
    ("MaxOver25", T.DoubleType()), ("MaxUnder25", T.DoubleType()),
    ("HandiSize", T.DoubleType()), ("HandiHome", T.DoubleType()), ("HandiAway", T.DoubleType()),
]

MATCH_SCHEMA = T.StructType([T.StructField(n, t) for n, t in MATCH_COLUMNS])
KEYED_MATCH_SCHEMA = T.StructType([T.StructField("MatchId", T.LongType()), *MATCH_SCHEMA.fields])

KEY = "MatchId"
DATE = "MatchDate"
TARGET = "FTResult"

# Outcomes in report order, and in label-code order (A=0, D=1, H=2).
OUTCOMES = ("H", "D", "A")
LABELS = ("A", "D", "H")

# Model inputs known before kick-off.
CATEGORICAL = ["Division", "HomeTeam", "AwayTeam"]
NUMERIC = [
    "HomeElo", "AwayElo", "Form3Home", "Form5Home", "Form3Away", "Form5Away",
    "OddHome", "OddDraw", "OddAway", "MaxHome", "MaxDraw", "MaxAway",
    "Over25", "Under25", "MaxOver25", "MaxUnder25", "HandiSize", "HandiHome", "HandiAway",
]
DATE_PARTS = ["DayOfWeek", "Month", "Year", "DayOfYear"]
MODEL_FEATURES = CATEGORICAL + NUMERIC + DATE_PARTS

# Columns described by histograms and densities.
DISTRIBUTION_COLUMNS = [
    "HomeElo", "AwayElo", "Form3Home", "Form5Home", "Form3Away", "Form5Away",
    "FTHome", "FTAway", "HTHome", "HTAway", "HomeYellow", "AwayYellow", "HomeRed", "AwayRed",
    "OddHome", "OddDraw", "OddAway", "MaxHome", "MaxDraw", "MaxAway",
    "Over25", "Under25", "MaxOver25", "MaxUnder25", "HandiSize", "HandiHome", "HandiAway",
]

# The engineered features scored against the outcome.
ROLLING_FEATURES = [
    "home_goals_last5_sum", "home_conceded_last5_sum", "home_reds_last5_sum", "home_yellows_last5_sum",
    "away_goals_last5_sum", "away_conceded_last5_sum", "away_reds_last5_sum", "away_yellows_last5_sum",
]
ENGINEERED_FEATURES = ROLLING_FEATURES + [
    "HomeElo", "AwayElo", "Form3Home", "Form5Home", "Form3Away", "Form5Away",
    "OddHome", "OddDraw", "OddAway", "MaxHome", "MaxDraw", "MaxAway",
    "HandiSize", "HandiHome", "HandiAway",
    "EloDiff", "Form3Diff", "Form5Diff", "OddDiff", "HandiOddDiff",
    "goals_last5_diff", "cards_last5_sum",
]
