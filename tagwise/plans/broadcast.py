"""Joins with fitted state tables whose size is checked before anything is broadcast.

Fitted state is materialised and counted at its fit barrier. A table whose estimated bytes are under the limit is
broadcast; beyond it the join is a salted shuffle join, so a feature or term that holds a large share of the rows is
spread over ``SALTS`` tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 << 20
SALTS = 32
# estimated bytes of a value of variable length (terms, labels, short arrays)
VARIABLE_BYTES = 64


def row_bytes(schema: T.StructType) -> int:
    fixed = {"int": 4, "bigint": 8, "double": 8, "float": 4, "boolean": 1}
    return 16 + sum(fixed.get(f.dataType.simpleString(), VARIABLE_BYTES) for f in schema.fields)


def fits_broadcast(df: DataFrame, n_rows: int | None) -> bool:
    return n_rows is not None and n_rows * row_bytes(df.schema) <= BROADCAST_BYTES


def small(df: DataFrame, n_rows: int | None) -> DataFrame:
    """``df`` marked for broadcast if its counted size allows it; else as it is (for keys without skew)."""
    return F.broadcast(df) if fits_broadcast(df, n_rows) else df


def join_state(big: DataFrame, state: DataFrame, key: str, n_rows: int | None) -> DataFrame:
    """Inner join of ``big`` (with a ``row_id``) with a state table on ``key``, which may be skewed in ``big``."""
    if fits_broadcast(state, n_rows):
        return big.join(F.broadcast(state), key)
    salted = big.withColumn("_salt", F.pmod(F.xxhash64("row_id"), F.lit(SALTS)).cast("int"))
    spread = state.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(spread, [key, "_salt"]).drop("_salt")
