"""Model inputs: date parts, category codes, scaling, class weights."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions.dates import date_parts
from touchline.schema import CATEGORICAL, DATE, DATE_PARTS, KEY, LABELS, NUMERIC, TARGET
from touchline.session import BROADCAST_ROWS, scratch_root

# Up to this many distinct values are numbered in one task and broadcast.
VOCABULARY_BOUND = BROADCAST_ROWS


def pre_match_features(df: DataFrame, key: str = KEY) -> DataFrame:
    """Only what is known before kick-off, with date parts and the target."""
    parts = date_parts(DATE)
    return df.select(key, *CATEGORICAL, *NUMERIC, *[parts[p].alias(p) for p in DATE_PARTS], TARGET)


def _numbered(values: DataFrame, small: bool) -> DataFrame:
    """(value, code) in sorted order from 0."""
    if small:
        return values.select("value", (F.row_number().over(Window.orderBy("value")) - 1).alias("code"))
    # Range-sorted on disk, so that partition numbers are the same each time they are read.
    ordered = (values.repartitionByRange("value").sortWithinPartitions("value")
                     .select("value", F.monotonically_increasing_id().alias("_id")).checkpoint())
    part = F.shiftright("_id", 33)
    sizes = ordered.groupBy(part.alias("_p")).agg(F.count("*").alias("_n"))
    starts = sizes.select("_p", (F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, 0))
                                 - F.col("_n")).alias("_start"))
    rows = ordered.select("value", part.alias("_p"), F.col("_id").bitwiseAND((1 << 33) - 1).alias("_i"))
    return rows.join(F.broadcast(starts), "_p").select(
        "value", (F.col("_start") + F.col("_i")).cast("int").alias("code"))


def fit_encoders(frames: list[DataFrame], columns=CATEGORICAL, bound: int = VOCABULARY_BOUND) -> dict:
    """Per column, codes of the sorted distinct values, and whether the table may be broadcast.

    Pass train and test for shared codes, or train alone. All vocabularies are found
    in one pass and kept in a checkpoint, so that using the codes never reads the data again.
    """
    scratch_root(frames[0].sparkSession)
    pairs = None
    for df in frames:
        both = df.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])))
        pairs = both if pairs is None else pairs.unionByName(both)
    vocabulary = pairs.filter(F.col("value").isNotNull()).distinct().checkpoint()
    sizes = {r["column"]: r["count"] for r in vocabulary.groupBy("column").count().collect()}
    out = {}
    for c in columns:
        small = sizes.get(c, 0) <= bound
        out[c] = (_numbered(vocabulary.filter(F.col("column") == c).select("value"), small), small)
    return out


def label_index(frames: list[DataFrame], col: str, bound: int = VOCABULARY_BOUND) -> DataFrame:
    """(value, code) of one column over all frames."""
    return fit_encoders(frames, [col], bound)[col][0]


def apply_encoders(df: DataFrame, encoders: dict, unknown: int = -1) -> DataFrame:
    """Replace categories by codes; a value the encoder has not seen gets ``unknown``."""
    order = df.columns
    for c, (codes, small) in encoders.items():
        table = codes.select(F.col("value").alias(c), F.col("code").alias("_code"))
        df = df.join(F.broadcast(table) if small else table, c, "left")
        df = df.withColumn(c, F.coalesce("_code", F.lit(unknown))).drop("_code")
    return df.select(*order)


def encode_target(col: str | Column = TARGET, labels=LABELS) -> Column:
    """0, 1, 2 in the order of ``labels``; other values give null."""
    out = None
    for i, v in enumerate(labels):
        cond = (F.col(col) if isinstance(col, str) else col) == v
        out = F.when(cond, i) if out is None else out.when(cond, i)
    return out


@dataclass(frozen=True)
class Scaling:
    means: dict[str, float]
    stds: dict[str, float]

    def column(self, c: str) -> Column:
        return (F.col(c).cast("double") - self.means[c]) / self.stds[c]


def fit_scaling(train: DataFrame, columns: list[str]) -> Scaling:
    """Means and population deviations (zero acts as 1), one aggregate over all columns."""
    row = train.agg(*[F.expr(f"{f}(`{c}`) AS `{p}_{c}`") for c in columns for p, f in (("m", "AVG"), ("s", "STDDEV_POP"))]).first()
    return Scaling({c: row[f"m_{c}"] for c in columns}, {c: row[f"s_{c}"] or 1.0 for c in columns})


def standardize(df: DataFrame, scaling: Scaling) -> DataFrame:
    return df.withColumns({c: scaling.column(c) for c in scaling.means})


def feature_array(columns: list[str], scaling: Scaling | None = None) -> Column:
    return F.array(*[scaling.column(c) if scaling else F.col(c).cast("double") for c in columns])


def class_weights(train: DataFrame, label: str = TARGET) -> DataFrame:
    """Balanced weight n / (classes * n_class) per class."""
    counts = train.groupBy(label).agg(F.count("*").alias("n"))
    over_all = Window.partitionBy()  # as many rows as classes
    return counts.withColumn("weight", F.sum("n").over(over_all) / (F.count("*").over(over_all) * F.col("n")))


def weight_column(train: DataFrame, label: str = TARGET) -> Column:
    """The weights as an expression over the label, for a learner's weight column."""
    out = None
    for r in class_weights(train, label).collect():
        cond = F.col(label) == r[label]
        out = F.when(cond, r["weight"]) if out is None else out.when(cond, r["weight"])
    return out


def feature_assembly(numeric: list[str], categorical=("Division",), label: str = TARGET) -> Pipeline:
    """Spark ML stages that give ``features`` (scaled) and ``label``."""
    codes = [f"{c}_code" for c in categorical]
    return Pipeline(stages=[
        StringIndexer(inputCols=list(categorical), outputCols=codes, stringOrderType="alphabetAsc", handleInvalid="keep"),
        StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc", handleInvalid="skip"),
        VectorAssembler(inputCols=codes + list(numeric), outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
    ])
