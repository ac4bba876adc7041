"""Cleaning fitted on train rows and applied to any rows."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.operators.quantiles import exact_quantiles
from touchline.schema import OUTCOMES, TARGET
from touchline.session import keep_for_join

NUMERIC_TYPES = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class CleaningConfig:
    mean_columns: tuple[str, ...] = ("HomeElo", "AwayElo")
    form_columns: tuple[str, ...] = ("Form3Home", "Form5Home", "Form3Away", "Form5Away")
    target: str = TARGET
    valid: tuple[str, ...] = OUTCOMES
    teams: tuple[str, str] = ("HomeTeam", "AwayTeam")
    skip: tuple[str, ...] = ("MatchId",)  # keys are neither filled nor capped
    drop_above: float = 0.50
    low_null_below: float = 0.05
    form_fill: str = "mean"  # or "zero"
    quantiles: str = "exact"  # or "approx": one pass, with the error below
    approx_error: float = 0.001


@dataclass(frozen=True)
class CleaningStats:
    n_rows: int
    means: dict[str, float]
    medians: dict[str, float]
    bounds: dict[str, tuple[float, float]]
    null_counts: dict[str, int]
    string_columns: tuple[str, ...]
    numeric_columns: tuple[str, ...]
    config: CleaningConfig = field(default_factory=CleaningConfig)

    def null_fraction(self, col: str) -> float:
        return self.null_counts.get(col, 0) / self.n_rows if self.n_rows else 0.0

    @property
    def keep_columns(self) -> list[str]:
        return [c for c in self.null_counts if self.null_fraction(c) <= self.config.drop_above]

    @property
    def low_null_columns(self) -> list[str]:
        return [c for c in self.null_counts if self.null_fraction(c) < self.config.low_null_below]

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> CleaningStats:
        raw = json.loads(text)
        cfg = {k: tuple(v) if isinstance(v, list) else v for k, v in raw.pop("config").items()}
        raw["bounds"] = {c: tuple(b) for c, b in raw["bounds"].items()}
        for name in ("string_columns", "numeric_columns"):
            raw[name] = tuple(raw[name])
        return cls(config=CleaningConfig(**cfg), **raw)

    def to_frame(self, spark) -> DataFrame:
        """One row per column."""
        keep, low = set(self.keep_columns), set(self.low_null_columns)
        rows = [(c, self.means.get(c), self.medians.get(c), *self.bounds.get(c, (None, None)),
                 self.null_fraction(c), c in keep, c in low) for c in self.null_counts]
        return spark.createDataFrame(rows, "column string, mean double, median double, lower double, upper double, "
                                           "null_frac double, keep boolean, low_null boolean")


def columns_by_type(df: DataFrame, types=NUMERIC_TYPES, exclude=()) -> list[str]:
    """Column names of the given types, read from the schema without a job."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types) and f.name not in exclude]


def drop_copies(df: DataFrame) -> DataFrame:
    """``dropDuplicates()`` that moves whole rows only where copies may be: the others are let through by a hash of all columns.

    Equal rows have equal hashes. Rows whose hash occurs once are kept as they are; the rest is compared in full.
    """
    h = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    # Hashes hardly ever repeat, so that summing them up before they move would only fill memory.
    twice = keep_for_join(df.select(h.alias("_h")).repartition("_h").groupBy("_h").agg(F.count("*").alias("_n")).filter("_n > 1").select("_h"))
    rows = df.withColumn("_h", h)
    return rows.join(twice, "_h", "left_anti").drop("_h").unionByName(rows.join(twice, "_h", "left_semi").drop("_h").dropDuplicates())


def null_counts(df: DataFrame) -> list[Column]:
    return [F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]


def null_profile(df: DataFrame) -> DataFrame:
    """Null count and share per column, in long form, from one aggregate."""
    wide = df.agg(F.count("*").alias("_rows"), *null_counts(df))
    return wide.unpivot(["_rows"], list(df.columns), "column", "null_count").select(
        "column", "null_count", F.try_divide(F.col("null_count"), F.col("_rows")).alias("null_frac"))


def column_means(df: DataFrame, columns) -> DataFrame:
    return df.agg(*[F.avg(c).alias(c) for c in columns]).unpivot([], list(columns), "column", "mean")


def column_quartiles(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exact quartiles (existing values) of each column and the 1.5 IQR fences."""
    q = exact_quantiles(df, columns, {"q1": 0.25, "median": 0.5, "q3": 0.75}, method="disc")
    iqr = F.col("q3") - F.col("q1")
    return q.select(F.col("feature").alias("column"), "q1", "median", "q3",
                    (F.col("q1") - 1.5 * iqr).alias("lower"), (F.col("q3") + 1.5 * iqr).alias("upper"))


def fit_cleaning(train: DataFrame, config: CleaningConfig | None = None) -> CleaningStats:
    """Means, medians, fences and null shares of the train rows.

    Two jobs however many columns there are; what reaches the driver is one row
    and one row per column. A column without values gets no median and no fence.
    """
    cfg = config or CleaningConfig()
    means_of = [c for c in cfg.mean_columns + cfg.form_columns if c in train.columns]
    numeric = columns_by_type(train, exclude=cfg.mean_columns + cfg.skip)
    strings = columns_by_type(train, T.StringType, exclude=cfg.skip)
    measured = [c for c in cfg.mean_columns if c in train.columns] + numeric

    aggs = [F.count("*").alias("rows"), F.struct(*null_counts(train)).alias("nulls"),
            F.struct(*[F.avg(c).alias(c) for c in means_of]).alias("means")]
    if cfg.quantiles == "approx":
        accuracy = round(1 / cfg.approx_error)
        aggs += [F.percentile_approx(F.col(c).cast("double"), [0.25, 0.5, 0.75], accuracy).alias(f"q_{c}")
                 for c in measured]
    row = train.agg(*aggs).first()
    if cfg.quantiles == "approx":
        quartiles = {c: tuple(row[f"q_{c}"]) for c in measured if row[f"q_{c}"] is not None}
    else:
        quartiles = {r["column"]: (r["q1"], r["median"], r["q3"]) for r in column_quartiles(train, measured).collect()}
    bounds = {c: (a - 1.5 * (b - a), b + 1.5 * (b - a)) for c, (a, _, b) in quartiles.items()}
    return CleaningStats(
        n_rows=row["rows"],
        means={c: v for c, v in row["means"].asDict().items() if v is not None},
        medians={c: quartiles[c][1] for c in numeric if c in quartiles},
        bounds=bounds, null_counts=row["nulls"].asDict(),
        string_columns=tuple(strings), numeric_columns=tuple(numeric), config=cfg)


# --- the steps, in order ---------------------------------------------------------------------
#
# A step either changes the rows or rewrites column expressions. Rewrites are only
# collected, and projected once at the end: row filters then sit below a single
# projection, next to the scan, and the optimizer handles one wide layer, not nine.

@dataclass
class _Rows:
    df: DataFrame
    stats: CleaningStats
    exprs: dict[str, Column]

    def rewrite(self, c: str, make) -> None:
        if c in self.exprs:
            self.exprs[c] = make(self.exprs[c])

    def keep(self, condition: Column) -> None:
        self.df = self.df.filter(condition)

    def fill(self, c: str, value) -> None:
        kind = self.df.schema[c].dataType if c in self.exprs else None
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            self.rewrite(c, lambda e: F.coalesce(F.nanvl(e, F.lit(None).cast(kind)), F.lit(value).cast(kind)))
        elif kind is not None:
            self.rewrite(c, lambda e: F.coalesce(e, F.lit(value).cast(kind)))


def _drop_copies(r: _Rows) -> None:
    r.df = r.df.dropDuplicates()


def _drop_columns(r: _Rows) -> None:
    keep = [c for c in r.stats.keep_columns if c in r.exprs]
    r.exprs = {c: r.exprs[c] for c in keep}


def _drop_rows(r: _Rows) -> None:
    r.df = r.df.dropna(subset=[c for c in r.stats.low_null_columns if c in r.exprs])


def _fill_mean(r: _Rows) -> None:
    for c in r.stats.config.mean_columns:
        if c in r.stats.means:
            r.fill(c, r.stats.means[c])


def _fill_median(r: _Rows) -> None:
    for c, v in r.stats.medians.items():
        r.fill(c, v)


def _fill_unknown(r: _Rows) -> None:
    for c in r.stats.string_columns:
        r.fill(c, "Unknown")


def _valid_target(r: _Rows) -> None:
    r.keep(r.exprs[r.stats.config.target].isin(list(r.stats.config.valid)))


def _elo(r: _Rows) -> None:
    for c in r.stats.config.mean_columns:
        if c in r.stats.means:
            r.rewrite(c, lambda e, v=r.stats.means[c]: F.when(e > 0, e).otherwise(F.lit(v)))


def _form(r: _Rows) -> None:
    for c in r.stats.config.form_columns:
        if c in r.stats.means:
            v = r.stats.means[c] if r.stats.config.form_fill == "mean" else 0.0
            r.rewrite(c, lambda e, v=v: F.when(e < 0, F.lit(v)).otherwise(e))


def _cap_outliers(r: _Rows) -> None:
    """Move values outside the fences onto them. Nulls stay null."""
    for c, (low, high) in r.stats.bounds.items():
        r.rewrite(c, lambda e, low=low, high=high: F.when(
            e.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), e.cast("double")))))


def _same_team(r: _Rows) -> None:
    home, away = r.stats.config.teams
    r.keep(r.exprs[home] != r.exprs[away])


STEPS = {
    "drop_copies": _drop_copies, "drop_columns": _drop_columns, "drop_rows": _drop_rows,
    "fill_mean": _fill_mean, "fill_median": _fill_median, "fill_unknown": _fill_unknown,
    "valid_target": _valid_target, "elo": _elo, "form": _form,
    "cap_outliers": _cap_outliers, "same_team": _same_team,
}
DEFAULT_STEPS = tuple(s for s in STEPS if s != "cap_outliers")


class CleaningAudit:
    """Rows after each step, read from the job that used the cleaned rows; no job of its own."""

    def __init__(self, dropped_columns: list[str]):
        self.dropped_columns = dropped_columns
        self._seen: dict[str, Observation] = {}

    def watch(self, df: DataFrame, step: str) -> DataFrame:
        self._seen[step] = Observation(f"after_{step}")
        return df.observe(self._seen[step], F.count(F.lit(1)).alias("rows"))

    def rows(self) -> dict[str, int]:
        """Waits until the cleaned rows have been used in an action."""
        return {step: o.get["rows"] for step, o in self._seen.items()}

    def removed(self) -> dict[str, int]:
        rows = list(self.rows().items())
        return {name: before - after for (_, before), (name, after) in zip(rows, rows[1:], strict=False)}


def apply_cleaning(df: DataFrame, stats: CleaningStats, steps=DEFAULT_STEPS, audit: bool = False):
    """Run the steps as one lazy plan.

    With ``audit=True`` returns (rows, audit): each step that removes rows is
    counted inside the same job.
    """
    rows = _Rows(df, stats, {c: F.col(c) for c in df.columns})
    log = CleaningAudit([c for c in df.columns if c not in stats.keep_columns])
    if audit:
        rows.df = log.watch(rows.df, "read")
    for step in steps:
        STEPS[step](rows)
        if audit and step in ("drop_copies", "drop_rows", "valid_target", "same_team"):
            rows.df = log.watch(rows.df, step)
    out = rows.df.select(*[e.alias(c) for c, e in rows.exprs.items()])
    return (out, log) if audit else out
