"""Named queries: a DataFrame builder and, where SQL can say the same, its check in SQL."""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions.expressions import HASH_RANGE, key_hash_sql
from touchline.operators import features as feat
from touchline.operators.cleaning import drop_copies
from touchline.operators.sampling import hash_split
from touchline.schema import CATEGORICAL, DATE, DATE_PARTS, KEY, KEYED_MATCH_SCHEMA, MODEL_FEATURES, NUMERIC
from touchline.session import scratch_path
from touchline.sources.fixture import matches, matches_raw, matches_raw_sql, matches_sql
from touchline.sources.tables import write_table

TRAIN_SHARE = 0.8


class Inputs:
    """The tables a query may use, all derived lazily from one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def matches(self) -> DataFrame:
        return matches(self.spark, self.sf_dir)

    @cached_property
    def stored(self) -> DataFrame:
        """The match table written once per session, for queries that pass over it more than once."""
        return self._written("matches", lambda: matches(self.spark, self.sf_dir).select(*KEYED_MATCH_SCHEMA.names))

    @cached_property
    def raw(self) -> DataFrame:
        return matches_raw(self.stored)

    @cached_property
    def deduped(self) -> DataFrame:
        """The raw table without copies, also written once: fitting and applying would each repeat that shuffle."""
        return self._written("deduped", lambda: drop_copies(self.raw), deal=False)

    def _written(self, name: str, make: Callable[[], DataFrame], deal: bool = True) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name, self.version)
        if key not in _WRITTEN:
            path = scratch_path(self.spark, name)
            df, cores = make(), self.spark.sparkContext.defaultParallelism
            orders = self.spark.read.parquet(f"{self.sf_dir}/orders.parquet")
            if deal and orders.rdd.getNumPartitions() < cores:  # a small input: give every core a file
                df = df.repartition(cores, KEY)
            write_table(df, path)
            _drop(self.spark, _outdated(_WRITTEN, key))  # of an input that has changed since
            _WRITTEN[key], _SCHEMAS[path] = path, df.schema
            _drop_at_end(self.spark)
        return self.spark.read.schema(_SCHEMAS[_WRITTEN[key]]).parquet(_WRITTEN[key])

    @cached_property
    def version(self) -> tuple:
        """Files, sizes and change times of the input tables: what is kept holds only as long as they stay the same."""
        return tuple(f for table in INPUT_TABLES for f in _files(self.spark, f"{self.sf_dir}/{table}.parquet"))

    @cached_property
    def split(self) -> tuple[DataFrame, DataFrame]:
        return hash_split(self.stored, TRAIN_SHARE)

    @cached_property
    def raw_train(self) -> DataFrame:
        return hash_split(self.deduped, TRAIN_SHARE)[0]

    @cached_property
    def encoded(self) -> tuple[DataFrame, DataFrame]:
        """Train and test with the 26 model features as numbers and an integer ``label``."""
        def code() -> DataFrame:
            # Incomplete rows go first: a filter below the wide projections is cheap to plan and to run.
            whole = feat.pre_match_features(self.stored.dropna(subset=[*CATEGORICAL, *NUMERIC, DATE]))
            encoders = feat.fit_encoders([whole])
            return feat.apply_encoders(whole, encoders).withColumn("label", feat.encode_target())
        # Written once per session: learners read it many times, and each would join the codes again.
        return hash_split(self._written("encoded", code, deal=False), TRAIN_SHARE)

    @cached_property
    def scaled(self) -> tuple[DataFrame, DataFrame]:
        """The same, standardised with train means and deviations."""
        train, test = self.encoded
        scaling = feat.fit_scaling(train, MODEL_FEATURES)
        return feat.standardize(train, scaling), feat.standardize(test, scaling)


INPUT_TABLES = ("orders", "supplier", "nation")
_WRITTEN: dict[tuple, str] = {}
_SCHEMAS: dict[str, T.StructType] = {}
_FITTED: dict[tuple, object] = {}


def _files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Name, size and change time of each file of a table, in any store that Spark reads."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    found = root.getFileSystem(conf).listStatus(root)
    return sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in found)


def _outdated(kept: dict[tuple, object], key: tuple) -> list:
    """Take out what an earlier version of the same input left; the version is the key's last part."""
    old = [k for k in kept if k[:-1] == key[:-1] and k != key]
    return [kept.pop(k) for k in old]


def _drop(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        _SCHEMAS.pop(path, None)
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _drop_at_end(spark: SparkSession) -> None:
    """Delete the session's stored tables when its context stops."""
    context = spark.sparkContext
    if getattr(context, "_touchline_drops", False):
        return
    context._touchline_drops, stop = True, context.stop

    def stop_and_drop() -> None:
        try:
            forget(spark)
        except (Py4JError, OSError):  # the context is gone already
            pass
        stop()
    context.stop = stop_and_drop


def forget(spark: SparkSession) -> None:
    """Delete the session's stored tables and forget its models."""
    own = spark.sparkContext.applicationId
    _drop(spark, [_WRITTEN.pop(k) for k in list(_WRITTEN) if k[0] == own])
    for k in [k for k in _FITTED if k[0] == own]:
        del _FITTED[k]


def fitted(t, name: str, fit):
    """A model that several queries use is fitted once per session and state of the input."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir, name, t.version)
    if key not in _FITTED:
        _FITTED[key] = fit()
        _outdated(_FITTED, key)
    return _FITTED[key]


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Inputs], DataFrame]
    sql: str | None
    rounded: tuple[str, ...]

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(Inputs(spark, sf_dir))
        # Sums of doubles depend on row order in their last digits; both engines report six places.
        return df.withColumns({c: F.round(c, 6) + F.lit(0.0) for c in self.rounded}) if self.rounded else df

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        body = with_inputs(self.sql)
        if not self.rounded:
            return body
        fixed = ", ".join(f"ROUND({c}, 6) + 0.0 AS {c}" for c in self.rounded)
        return f"SELECT * REPLACE ({fixed}) FROM ({body})"


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None, rounded=()):
    """Register a builder under ``name``."""
    def register(build):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, build, sql, tuple(rounded))
        return build
    return register


# --- SQL inputs ------------------------------------------------------------------------------

_COLUMNS = [f.name for f in KEYED_MATCH_SCHEMA.fields]
_EDGE = int(TRAIN_SHARE * HASH_RANGE)
_HASH = key_hash_sql("MatchId")
_DATE_SQL = {"DayOfWeek": "CAST(ISODOW(MatchDate) - 1 AS INT)", "Month": "CAST(MONTH(MatchDate) AS INT)",
             "Year": "CAST(YEAR(MatchDate) AS INT)", "DayOfYear": "CAST(DAYOFYEAR(MatchDate) AS INT)"}

CTES = {
    "matches": matches_sql(),
    "matches_raw": matches_raw_sql(_COLUMNS),
    "train": f"SELECT * FROM matches WHERE {_HASH} < {_EDGE}",
    "test": f"SELECT * FROM matches WHERE {_HASH} >= {_EDGE}",
    "deduped": "SELECT DISTINCT * FROM matches_raw",
    "raw_train": f"SELECT * FROM deduped WHERE {_HASH} < {_EDGE}",
    "encoded": "SELECT MatchId, CASE FTResult WHEN 'A' THEN 0 WHEN 'D' THEN 1 WHEN 'H' THEN 2 END AS label, "
               f"{_HASH} < {_EDGE} AS is_train, "
               + ", ".join(f"CAST(DENSE_RANK() OVER (ORDER BY {c}) - 1 AS INT) AS {c}" for c in CATEGORICAL) + ", "
               + ", ".join(NUMERIC) + ", " + ", ".join(f"{_DATE_SQL[p]} AS {p}" for p in DATE_PARTS) + " FROM matches",
    "scaling": "SELECT " + ", ".join(f"AVG({c}) AS m_{c}, STDDEV_POP({c}) AS s_{c}" for c in MODEL_FEATURES)
               + " FROM encoded WHERE is_train",
    "scaled": "SELECT MatchId, label, is_train, "
              + ", ".join(f"(CAST({c} AS DOUBLE) - m_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END AS {c}"
                          for c in MODEL_FEATURES) + " FROM encoded, scaling",
}


def add_cte(name: str, sql: str) -> None:
    """Make a SQL input available to the checks."""
    CTES[name] = sql


def with_inputs(sql: str) -> str:
    """Put the definitions of all inputs that a statement names in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                if name != "matches":
                    visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    head = ", ".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in needed)
    body = sql.strip()
    if not head:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {head}, {body[5:]}"
    return f"WITH {head} {body}"


def double(sql: str) -> str:
    return f"CAST({sql} AS DOUBLE)"


def share_sql(outcome: str, alias: str, scale: int = 100) -> str:
    part = f"COUNT(*) FILTER (WHERE FTResult = '{outcome}') / COUNT(*)"
    return f"{part}{f' * {scale}' if scale != 1 else ''} AS {alias}"


def t_tail_sql(rows: str, keys: str) -> str:
    """SQL: two-sided p of t with n - 2 degrees, by Simpson's rule over the density between 0 and |t|."""
    return f"""WITH s AS ({rows}), u AS (SELECT {keys}, r, n, t, n - 2 AS d, ABS(t) / 4000 AS w, CAST(i AS INT) AS i FROM s, RANGE(4001) x(i)),
      y AS (SELECT *, CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * w / 3
          * EXP(LGAMMA((d + 1) / 2) - LGAMMA(d / 2)) / SQRT(d * {math.pi!r}) * POW(1 + i * w * i * w / d, -(d + 1) / 2) AS part FROM u)
    SELECT {keys}, r, n, t, 1 - 2 * SUM(part) AS p FROM y GROUP BY {keys}, r, n, t"""
