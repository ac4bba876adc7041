"""Column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def round_bin(col: str | Column, width: float | None = None, per_unit: float | None = None) -> Column:
    """Nearest multiple of ``width``, or of ``1 / per_unit`` (halves go away from zero)."""
    if (width is None) == (per_unit is None):
        raise ValueError("give exactly one of width and per_unit")
    if width is not None:
        return F.round(_c(col) / width) * width
    return F.round(_c(col) * per_unit) / per_unit


def floor_bin(col: str | Column, width: int) -> Column:
    """Lower edge of the bin, as bigint."""
    return F.floor(_c(col) / width) * width


def share(condition: Column, scale: float = 100) -> Column:
    """Aggregate: part of the group's rows that meet the condition."""
    part = F.count_if(condition) / F.count("*")
    return part * scale if scale != 1 else part


def reciprocal(col: str | Column) -> Column:
    """``1 / col``; zero gives null."""
    return F.try_divide(F.lit(1.0), _c(col))


def squared_distance(a: list[Column], b: list[Column]) -> Column:
    total = F.lit(0.0)
    for x, y in zip(a, b, strict=True):
        total = total + (x - y) * (x - y)
    return total


def argmin(values: list[Column]) -> Column:
    """Index of the least value; a tie goes to the lowest index."""
    least = F.least(*values) if len(values) > 1 else values[0]
    out = F.lit(len(values) - 1)
    for i in range(len(values) - 2, -1, -1):
        out = F.when(values[i] <= least, F.lit(i)).otherwise(out)
    return out


def key_hash(key: str | Column, seed: int | str = 42) -> Column:
    """32 random-looking bits from a key, as bigint in [0, 2^32).

    MD5-based, so that other SQL engines can compute the same number, and
    independent of how rows are partitioned. Splits use the bare seed; samples,
    draws and balancing put their purpose in front of it, so that none of them
    follows from another.
    """
    text = F.concat_ws(":", _c(key).cast("string"), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def key_hash_sql(key: str, seed: int | str = 42) -> str:
    """The same number in DuckDB SQL."""
    return f"CAST('0x' || SUBSTR(MD5(CAST({key} AS VARCHAR) || ':{seed}'), 1, 8) AS BIGINT)"


HASH_RANGE = 1 << 32
