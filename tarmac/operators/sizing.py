"""Broadcast only behind a checked size bound.

``broadcast_if_bounded`` measures at most ``max_rows + 1`` rows of the side,
in rows and in bytes of their text form; if both fit it is hinted for a broadcast
hash join, otherwise it is returned untouched and Spark plans a shuffle join
(AQE may still switch to a broadcast at run time when the shuffled side turns
out small).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# dimension tables (airports, station maps, per-group statistics) stay far below these
DEFAULT_MAX_BROADCAST_ROWS = 200_000
DEFAULT_MAX_BROADCAST_BYTES = 32 << 20


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def size_at_most(df: DataFrame, max_rows: int, max_bytes: int) -> bool:
    row = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))).alias("b")).first()
    return row.n <= max_rows and (row.b or 0) <= max_bytes


def broadcast_if_bounded(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                         materialize: bool = False,
                         max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``materialize`` first writes the side to the shared scratch folder so that
    a dimension derived from a large scan - e.g. the station map, which reads
    the flights' origins - is computed once for the size check and the join."""
    if materialize:
        from tarmac.session import written
        df = written(df, "dimension")
    return F.broadcast(df) if size_at_most(df, max_rows, max_bytes) else df
