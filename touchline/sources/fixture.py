"""The match table as a view over the star-schema tables orders, supplier and nation.

One row per order. The SQL text runs unchanged in Spark and in DuckDB, so the
same text is the input of every query and of its check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MATCHES_SQL = """
WITH o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS d,
             CAST(ROUND(o_totalprice * 100) AS BIGINT) AS c FROM {orders}),
k AS (SELECT o.*, CAST(FLOOR(c / 7) AS BIGINT) AS c7, CAST(FLOOR(c / 11) AS BIGINT) AS c11,
             CAST(FLOOR(c / 37) AS BIGINT) AS c37,
             o_custkey % (SELECT COUNT(*) FROM {supplier}) AS hk,
             CAST(FLOOR(c / 37) AS BIGINT) % (SELECT COUNT(*) FROM {supplier}) AS ak FROM o),
t AS (SELECT k.*, n.n_name AS Division, h.s_name AS HomeTeam, a.s_name AS AwayTeam,
             1500 + h.s_acctbal / 20 AS HomeElo, 1500 + a.s_acctbal / 20 AS AwayElo
      FROM k JOIN {supplier} h ON h.s_suppkey = k.hk JOIN {supplier} a ON a.s_suppkey = k.ak
             JOIN {nation} n ON n.n_nationkey = h.s_nationkey),
g AS (SELECT t.*, CAST(c % 4 + CASE WHEN HomeElo > AwayElo AND c % 3 = 0 THEN 2 ELSE 0 END AS INT) AS FTHome,
             CAST(c7 % 4 + CASE WHEN AwayElo > HomeElo AND c7 % 3 = 0 THEN 1 ELSE 0 END AS INT) AS FTAway FROM t),
h AS (SELECT g.*, CAST(c11 % (FTHome + 1) AS INT) AS HTHome, CAST(c37 % (FTAway + 1) AS INT) AS HTAway,
             CAST(1.2 AS DOUBLE) + GREATEST(CAST(0 AS DOUBLE), 400 - (HomeElo - AwayElo)) / 200 + CAST(c % 50 AS DOUBLE) / 100 AS OddHome,
             CAST(1.2 AS DOUBLE) + GREATEST(CAST(0 AS DOUBLE), 400 - (AwayElo - HomeElo)) / 200 + CAST(c7 % 50 AS DOUBLE) / 100 AS OddAway,
             CAST(2.5 AS DOUBLE) + CAST(c11 % 200 AS DOUBLE) / 100 AS OddDraw FROM g)
SELECT o_orderkey AS MatchId, Division, d AS MatchDate, HomeTeam, AwayTeam, HomeElo, AwayElo,
  CAST(c % 10 AS DOUBLE) AS Form3Home, CAST(c % 16 AS DOUBLE) AS Form5Home,
  CAST(c7 % 10 AS DOUBLE) AS Form3Away, CAST(c7 % 16 AS DOUBLE) AS Form5Away,
  FTHome, FTAway, CASE WHEN FTHome > FTAway THEN 'H' WHEN FTHome < FTAway THEN 'A' ELSE 'D' END AS FTResult,
  HTHome, HTAway, CASE WHEN HTHome > HTAway THEN 'H' WHEN HTHome < HTAway THEN 'A' ELSE 'D' END AS HTResult,
  CAST(c11 % 5 AS INT) AS HomeYellow, CAST(c37 % 6 AS INT) AS AwayYellow,
  CAST(CASE WHEN c11 % 17 = 0 THEN 1 ELSE 0 END AS INT) AS HomeRed,
  CAST(CASE WHEN c37 % 13 = 0 THEN 1 ELSE 0 END AS INT) AS AwayRed,
  OddHome, OddDraw, OddAway,
  OddHome * CAST(1.0625 AS DOUBLE) AS MaxHome, OddDraw * CAST(1.0625 AS DOUBLE) AS MaxDraw, OddAway * CAST(1.0625 AS DOUBLE) AS MaxAway,
  CAST(1.5 AS DOUBLE) + CAST(c % 128 AS DOUBLE) / 128 AS Over25, CAST(1.5 AS DOUBLE) + CAST(c7 % 128 AS DOUBLE) / 128 AS Under25,
  CAST(1.625 AS DOUBLE) + CAST(c % 128 AS DOUBLE) / 128 AS MaxOver25, CAST(1.625 AS DOUBLE) + CAST(c7 % 128 AS DOUBLE) / 128 AS MaxUnder25,
  CAST(c11 % 33 - 16 AS DOUBLE) / 4 AS HandiSize,
  CAST(1.5 AS DOUBLE) + CAST(c11 % 64 AS DOUBLE) / 64 AS HandiHome, CAST(1.5 AS DOUBLE) + CAST(c37 % 64 AS DOUBLE) / 64 AS HandiAway
FROM h
"""

# Blemishes of the raw table: column -> expression. Other columns are unchanged.
RAW_BLEMISHES = {
    "HomeElo": "CASE WHEN MatchId % 23 = 0 THEN NULL ELSE HomeElo END",
    "AwayElo": "CASE WHEN MatchId % 11 = 0 THEN NULL WHEN MatchId % 211 = 0 THEN CAST(-1 AS DOUBLE) ELSE AwayElo END",
    "Form3Home": "CASE WHEN MatchId % 307 = 0 THEN -1 - Form3Home ELSE Form3Home END",
    "FTResult": "CASE WHEN MatchId % 499 = 0 THEN 'X' ELSE FTResult END",
    "HTResult": "CASE WHEN MatchId % 13 = 0 THEN NULL ELSE HTResult END",
    "OddDraw": "CASE WHEN MatchId % 7 = 0 THEN NULL ELSE OddDraw END",
    "HandiAway": "CASE WHEN MatchId % 3 = 0 THEN HandiAway END",
}
RAW_COPIES = "MatchId % 101 = 0"  # rows that appear twice

TABLES = ("orders", "supplier", "nation")


def matches_sql(**names: str) -> str:
    """The view text with table names filled in (default: the tables' own names)."""
    return MATCHES_SQL.format(**{t: names.get(t, t) for t in TABLES}).strip()


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES}
    return spark.sql(MATCHES_SQL, **tables)


def matches_raw(clean: DataFrame) -> DataFrame:
    """The match table with nulls, bad values and exact copies; one scan of the input."""
    cols = [F.expr(RAW_BLEMISHES[c]).alias(c) if c in RAW_BLEMISHES else F.col(c) for c in clean.columns]
    copies = F.expr(f"CASE WHEN {RAW_COPIES} THEN array(0, 1) ELSE array(0) END")
    return clean.select(*cols, F.explode(copies).alias("_copy")).drop("_copy")


def matches_raw_sql(columns: list[str], source: str = "matches") -> str:
    body = ", ".join(f"{RAW_BLEMISHES[c]} AS {c}" if c in RAW_BLEMISHES else c for c in columns)
    return (f"SELECT {body} FROM {source} UNION ALL "
            f"SELECT {body} FROM {source} WHERE {RAW_COPIES}")
