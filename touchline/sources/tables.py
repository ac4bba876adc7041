"""Readers, writers and the metrics document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.dates import parse_date
from touchline.schema import DATE, MATCH_SCHEMA

CLASS_METRICS = T.StructType([
    T.StructField("precision", T.DoubleType()),
    T.StructField("recall", T.DoubleType()),
    T.StructField("f1-score", T.DoubleType()),
    T.StructField("support", T.LongType()),
])
METRICS_SCHEMA = T.StructType([
    T.StructField("accuracy", T.DoubleType()),
    T.StructField("elapsed_seconds", T.DoubleType()),
    T.StructField("k", T.IntegerType()),
    T.StructField("n_train", T.LongType()),
    T.StructField("n_test", T.LongType()),
    T.StructField("classification_report", T.MapType(T.StringType(), CLASS_METRICS)),
])


def nan_to_null(df: DataFrame) -> DataFrame:
    """One missing-value rule: NaN becomes null in every floating column."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def read_matches(spark: SparkSession, path, fmt: str = "csv", schema: T.StructType | None = MATCH_SCHEMA,
                 infer: bool = False) -> DataFrame:
    """Read match rows from any Hadoop path.

    CSV uses the declared schema (one pass); ``infer=True`` asks Spark to infer
    types instead, at the cost of a second pass. Text dates may be day-first or ISO.
    """
    if fmt != "csv":
        return nan_to_null(spark.read.format(fmt).load(path))
    reader = spark.read.option("header", True)
    if infer:
        df = reader.option("inferSchema", True).csv(path)
    else:
        text_dates = T.StructType([
            T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.DateType) else f.dataType)
            for f in schema.fields])
        df = reader.schema(text_dates).csv(path)
    if DATE in df.columns and isinstance(df.schema[DATE].dataType, T.StringType):
        df = df.withColumn(DATE, parse_date(DATE))
    return nan_to_null(df)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by=None, mode: str = "overwrite") -> None:
    """Every task writes its own files; nothing passes through the driver."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    writer.save(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("overwrite").json(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRICS_SCHEMA).json(path)


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per partition, counted where the rows are."""
    return (df.groupBy(F.spark_partition_id().alias("partition_id")).agg(F.count("*").alias("n"))
              .orderBy("partition_id"))


def s3a_options(endpoint: str | None = None, access_key: str | None = None, secret_key: str | None = None,
                path_style: bool = True, tls: bool = True) -> dict[str, str]:
    """Session settings for an S3-compatible store. Without keys, Spark's own credential chain applies.

    ``hadoop-aws`` must be on the class path in the version of the Hadoop that Spark ships with.
    """
    conf = {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(tls).lower(),
    }
    if endpoint:
        conf["spark.hadoop.fs.s3a.endpoint"] = endpoint
    if access_key and secret_key:
        conf["spark.hadoop.fs.s3a.access.key"] = access_key
        conf["spark.hadoop.fs.s3a.secret.key"] = secret_key
    return conf
