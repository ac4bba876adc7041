"""Cleaning steps: fitted on the train part of the raw table, applied to all of it."""

from __future__ import annotations

from pyspark.sql import functions as F

from touchline.operators import cleaning as cl
from touchline.plans.registry import add_cte, query
from touchline.schema import KEYED_MATCH_SCHEMA

COLUMNS = [f.name for f in KEYED_MATCH_SCHEMA.fields]
ELO = ["HomeElo", "AwayElo"]
FORM = ["Form3Home", "Form5Home", "Form3Away", "Form5Away"]
NUMERIC = [f.name for f in KEYED_MATCH_SCHEMA.fields
           if isinstance(f.dataType, cl.NUMERIC_TYPES) and f.name not in (*ELO, "MatchId")]
STRINGS = ["Division", "HomeTeam", "AwayTeam", "FTResult", "HTResult"]
# What the null shares of the raw table come to; checked by the queries null_profile and column_selection.
SPARSE = ["HandiAway"]
OFTEN_NULL = ["AwayElo", "HTResult", "OddDraw"]
LOW_NULL = [c for c in COLUMNS if c not in SPARSE + OFTEN_NULL]
KEPT_NUMERIC = [c for c in NUMERIC if c not in SPARSE]


def _per_column(columns, template: str) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in columns)


def _replace(pairs: dict[str, str], source: str) -> str:
    return f"SELECT * REPLACE ({', '.join(f'{e} AS {c}' for c, e in pairs.items())}) FROM {source}"


def _mean(c: str) -> str:
    return f"(SELECT AVG({c}) FROM raw_train)"


def _quantile(c: str, p: float) -> str:
    return f"(SELECT QUANTILE_DISC({c}, {p}) FROM raw_train)"


add_cte("clean2", f"SELECT * EXCLUDE ({', '.join(SPARSE)}) FROM deduped")
add_cte("clean3", "SELECT * FROM clean2 WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in LOW_NULL))
add_cte("clean4", _replace({c: f"COALESCE({c}, {_mean(c)})" for c in ELO}, "clean3"))
add_cte("clean5", _replace({c: f"COALESCE({c}, {_quantile(c, 0.5)})" for c in KEPT_NUMERIC}, "clean4"))
add_cte("clean6", _replace({c: f"COALESCE({c}, 'Unknown')" for c in STRINGS}, "clean5"))
add_cte("clean7", "SELECT * FROM clean6 WHERE FTResult IN ('H', 'D', 'A')")
add_cte("clean8", _replace({c: f"CASE WHEN {c} > 0 THEN {c} ELSE {_mean(c)} END" for c in ELO}, "clean7"))
add_cte("clean9", _replace({c: f"CASE WHEN {c} < 0 THEN {_mean(c)} ELSE {c} END" for c in FORM}, "clean8"))
add_cte("clean11", "SELECT * FROM clean9 WHERE HomeTeam <> AwayTeam")

_Q1, _Q3 = "QUANTILE_DISC({c}, 0.25)", "QUANTILE_DISC({c}, 0.75)"


def upto(last: str) -> tuple[str, ...]:
    return cl.DEFAULT_STEPS[: cl.DEFAULT_STEPS.index(last) + 1]


def cleaned(t, last: str = "same_team"):
    """Steps up to ``last``; the copies are gone before the split already."""
    return cl.apply_cleaning(t.deduped, cl.fit_cleaning(t.raw_train), upto(last)[1:])


@query("fit_means", _per_column(ELO, "SELECT '{c}' AS \"column\", AVG({c}) AS mean FROM raw_train"), rounded=["mean"])
def fit_means(t):
    return cl.column_means(t.raw_train, ELO)


@query("fit_medians", _per_column(NUMERIC, "SELECT '{c}' AS \"column\", CAST(QUANTILE_DISC({c}, 0.5) AS DOUBLE) AS median FROM raw_train"))
def fit_medians(t):
    return cl.column_quartiles(t.raw_train, NUMERIC).select("column", "median")


@query("fit_iqr", _per_column(ELO + NUMERIC, f"""SELECT '{{c}}' AS "column", CAST({_Q1} - 1.5 * ({_Q3} - {_Q1}) AS DOUBLE) AS lower,
    CAST({_Q3} + 1.5 * ({_Q3} - {_Q1}) AS DOUBLE) AS upper FROM raw_train"""), rounded=["lower", "upper"])
def fit_iqr(t):
    return cl.column_quartiles(t.raw_train, ELO + NUMERIC).select("column", "lower", "upper")


_NULLS = _per_column(COLUMNS, "SELECT '{c}' AS \"column\", COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count, "
                              "COUNT(*) FILTER (WHERE {c} IS NULL) / COUNT(*) AS null_frac FROM raw_train")


@query("null_profile", _NULLS, rounded=["null_frac"])
def null_profile(t):
    return cl.null_profile(t.raw_train)


@query("column_selection", f'SELECT "column", null_frac <= 0.5 AS keep, null_frac < 0.05 AS low_null FROM ({_NULLS})')
def column_selection(t):
    return cl.null_profile(t.raw_train).select("column", (F.col("null_frac") <= 0.5).alias("keep"),
                                               (F.col("null_frac") < 0.05).alias("low_null"))


@query("clean_dedupe", "SELECT * FROM deduped")
def clean_dedupe(t):
    return t.deduped


@query("clean_drop_columns", "SELECT * FROM clean2")
def clean_drop_columns(t):
    return cleaned(t, "drop_columns")


@query("clean_drop_rows", "SELECT * FROM clean3")
def clean_drop_rows(t):
    return cleaned(t, "drop_rows")


@query("clean_fill_mean", "SELECT * FROM clean4", rounded=ELO)
def clean_fill_mean(t):
    return cleaned(t, "fill_mean")


@query("clean_fill_median", "SELECT * FROM clean5", rounded=ELO)
def clean_fill_median(t):
    return cleaned(t, "fill_median")


@query("clean_fill_unknown", "SELECT * FROM clean6", rounded=ELO)
def clean_fill_unknown(t):
    return cleaned(t, "fill_unknown")


@query("clean_valid_target", "SELECT * FROM clean7", rounded=ELO)
def clean_valid_target(t):
    return cleaned(t, "valid_target")


@query("clean_elo", "SELECT * FROM clean8", rounded=ELO)
def clean_elo(t):
    return cleaned(t, "elo")


@query("clean_form", "SELECT * FROM clean9", rounded=ELO + FORM)
def clean_form(t):
    return cleaned(t, "form")


@query("clean_form_zero", _replace({c: f"CASE WHEN {c} < 0 THEN 0 ELSE {c} END" for c in FORM}, "clean8"), rounded=ELO + FORM)
def clean_form_zero(t):
    stats = cl.fit_cleaning(t.raw_train, cl.CleaningConfig(form_fill="zero"))
    return cl.apply_cleaning(t.deduped, stats, upto("form")[1:])


@query("cleaning_audit", " UNION ALL ".join(
    f"SELECT '{step}' AS step, (SELECT COUNT(*) FROM {before}) - (SELECT COUNT(*) FROM {after}) AS removed"
    for step, before, after in [("drop_copies", "matches_raw", "deduped"), ("drop_rows", "clean2", "clean3"),
                                ("valid_target", "clean6", "clean7"), ("same_team", "clean9", "clean11")]))
def cleaning_audit(t):
    rows, audit = cl.apply_cleaning(t.raw, cl.fit_cleaning(t.raw_train), audit=True)
    rows.write.format("noop").mode("overwrite").save()
    return t.spark.createDataFrame(list(audit.removed().items()), "step string, removed long")


_CAPS = {c: f"LEAST({_quantile(c, 0.75)} + 1.5 * ({_quantile(c, 0.75)} - {_quantile(c, 0.25)}), "
            f"GREATEST({_quantile(c, 0.25)} - 1.5 * ({_quantile(c, 0.75)} - {_quantile(c, 0.25)}), CAST({c} AS DOUBLE)))"
         for c in ELO + KEPT_NUMERIC}


@query("cap_outliers", _replace(_CAPS, "clean9"), rounded=ELO + FORM)
def cap_outliers(t):
    return cl.apply_cleaning(t.deduped, cl.fit_cleaning(t.raw_train), (*upto("form")[1:], "cap_outliers"))


@query("clean_same_team", "SELECT * FROM clean11", rounded=ELO + FORM)
def clean_same_team(t):
    return cleaned(t, "same_team")


@query("clean_null_audit", _per_column([c for c in COLUMNS if c not in SPARSE],
                                       "SELECT '{c}' AS \"column\", COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count FROM clean11"))
def clean_null_audit(t):
    return cl.null_profile(cleaned(t)).select("column", "null_count")


@query("clean_all_steps", "SELECT FTResult, COUNT(*) AS n, AVG(HomeElo) AS home_elo, AVG(AwayElo) AS away_elo, "
                          "AVG(Form3Home) AS form3_home, AVG(OddDraw) AS odd_draw, "
                          "COUNT(*) FILTER (WHERE HTResult = 'Unknown') AS unknown_ht FROM clean11 GROUP BY FTResult",
       rounded=["home_elo", "away_elo", "form3_home", "odd_draw"])
def clean_all_steps(t):
    return cleaned(t).groupBy("FTResult").agg(
        F.count("*").alias("n"), F.avg("HomeElo").alias("home_elo"), F.avg("AwayElo").alias("away_elo"),
        F.avg("Form3Home").alias("form3_home"), F.avg("OddDraw").alias("odd_draw"),
        F.count_if(F.col("HTResult") == "Unknown").alias("unknown_ht"))
