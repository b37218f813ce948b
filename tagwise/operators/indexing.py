"""Dense 0..n-1 numbering of a table in sort order, without a single-partition window on big input."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagwise.session import materialize

# At or below this many rows a global window (one task) is cheap and exact.
WINDOW_LIMIT = 100_000
_LOCAL_BITS = (1 << 33) - 1  # monotonically_increasing_id = partition id << 33 | position in partition


def dense_index(df: DataFrame, order_col: str, idx_name: str, n_rows: int | None = None) -> DataFrame:
    """Number rows 0..n-1 by ``order_col`` (unique key). Big tables: range sort + per-partition offsets."""
    cols = df.columns
    if n_rows is not None and n_rows <= WINDOW_LIMIT:
        w = Window.orderBy(order_col)
        return df.select((F.row_number().over(w) - 1).cast("int").alias(idx_name), *cols)
    ranged = df.repartitionByRange(order_col).sortWithinPartitions(order_col)
    local = materialize(
        ranged.select(
            *cols,
            F.spark_partition_id().alias("_pid"),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_LOCAL_BITS)).alias("_pos"),
        )
    )
    counts = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))  # one row per partition
    offsets = counts.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    return local.join(F.broadcast(offsets), "_pid").select(
        (F.col("_off") + F.col("_pos")).cast("int").alias(idx_name), *cols
    )
