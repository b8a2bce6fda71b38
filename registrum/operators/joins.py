"""Join helpers with an explicit, measured broadcast decision."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrum.operators.frequent import holding

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
# Upper bound on rows worth measuring at all; above it the side is joined by
# shuffle without a measuring pass.
MEASURE_ROW_LIMIT = 2_000_000

# Fixed in-memory widths (bytes) of non-string types.
_WIDTH = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.DateType: 4, T.FloatType: 4,
    T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8, T.DecimalType: 16,
}


def _width(dt: T.DataType) -> int:
    return _WIDTH.get(type(dt), 64)


def _size_aggregates(df: DataFrame):
    fixed = 0
    var = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            var.append(F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)))
        else:
            fixed += _width(f.dataType)
    per_row = fixed + 8 * len(df.schema.fields)  # unsafe-row word per field
    rows = F.count(F.lit(1))
    size = rows * F.lit(per_row)
    if var:
        size = size + F.coalesce(F.sum(sum(var[1:], var[0]).cast("long")), F.lit(0))
    return rows.alias("rows"), size.alias("bytes")


def measured_bytes(df: DataFrame) -> int:
    """In-memory row payload of ``df`` as Spark holds it (an 8-byte word per
    field, fixed widths, plus the exact string/binary octets), measured over
    every row."""
    return int(df.agg(*_size_aggregates(df)).first()["bytes"])


def fits_broadcast(df: DataFrame, max_bytes: int, known_rows: int | None = None) -> bool:
    """Whether ``df`` is measured under ``max_bytes``.

    With ``known_rows`` (e.g. from a commit marker) a side with too many rows
    is ruled out without touching the data; otherwise rows and bytes are
    measured together in one aggregate pass.
    """
    if known_rows is not None:
        if known_rows > MEASURE_ROW_LIMIT:
            return False
        return measured_bytes(df) <= max_bytes
    r = df.agg(*_size_aggregates(df)).first()
    return r["rows"] <= MEASURE_ROW_LIMIT and r["bytes"] <= max_bytes


# A key holding at least this share of the left rows is "hot"; there are at
# most 1 / HOT_SHARE such keys, which bounds everything broadcast below.
HOT_SHARE = 0.001


def hot_keys(df: DataFrame, on: str, share: float = HOT_SHARE, min_rows: int = 0) -> DataFrame:
    """Keys holding at least ``share`` of the rows and at least ``min_rows``
    rows (never more than 1/share keys).

    No count of all keys and no shuffle by key: rows are counted per hash class,
    and only classes that hold enough rows are grouped by key
    (``registrum.operators.frequent``).
    """
    return holding(df, on, share, min_rows).select(on)


def hot_key_values(df: DataFrame, on: str, share: float = HOT_SHARE, min_rows: int = 0) -> list:
    """The hot keys as values. Each holds at least ``share`` of the rows, so
    there are at most 1/share of them: a bounded list, not data."""
    values = [r[0] for r in hot_keys(df, on, share, min_rows).collect()]
    if len(values) > round(1 / share):
        raise RuntimeError(f"{len(values)} hot keys; at most {round(1 / share)} can hold {share:.1%} of the rows each")
    return values


def left_join_skew_split(
    left: DataFrame, right: DataFrame, on: str, share: float = HOT_SHARE, min_rows: int = 0
) -> DataFrame:
    """Left equi-join that sends hot keys through a broadcast join and all
    other keys through the shuffle join.

    ``right`` must be unique per key (the Silver contract guarantees it for
    legal units), so its hot part has at most 1/share rows: a proven bound for
    the broadcast. Hot left rows are never shuffled by key, so a key holding a
    third of all rows does not land in one task. The hot/cold split is a
    pushed ``IN`` filter on each branch. Output columns: ``left``'s, then
    ``right``'s without the key.
    """
    r = right.withColumnRenamed(on, "_rk")
    hot = hot_key_values(left, on, share, min_rows)
    if not hot:
        return left.join(r, left[on] == r["_rk"], "left").drop("_rk")
    is_hot = F.col(on).isin(hot)
    left_hot = left.filter(is_hot)
    left_cold = left.filter(~is_hot | F.col(on).isNull())
    r_hot = F.broadcast(r.filter(F.col("_rk").isin(hot)))
    hot_part = left_hot.join(r_hot, left_hot[on] == r_hot["_rk"], "left").drop("_rk")
    cold_part = left_cold.join(r, left_cold[on] == r["_rk"], "left").drop("_rk")
    return cold_part.unionByName(hot_part)


def left_join_checked(
    left: DataFrame,
    right: DataFrame,
    on: str,
    max_broadcast_bytes: int | None,
    split_hot_keys: bool = False,
    right_rows: int | None = None,
    hot_min_rows: int = 0,
    left_rows: int | None = None,
) -> DataFrame:
    """Left equi-join; ``right`` is broadcast only if measured under the bound.

    Otherwise, with ``split_hot_keys`` the hot keys are split off
    (``left_join_skew_split``); without it the choice is left to AQE, which
    broadcasts only from measured shuffle sizes and otherwise keeps a
    sort-merge join with skewed partitions split. ``max_broadcast_bytes=None``
    skips the measuring pass. Output columns: ``left``'s, then ``right``'s
    without the key.
    """
    if max_broadcast_bytes is not None and fits_broadcast(right, max_broadcast_bytes, right_rows):
        r = F.broadcast(right.withColumnRenamed(on, "_rk"))
        return left.join(r, left[on] == r["_rk"], "left").drop("_rk")
    # with fewer left rows than the floor no key can be hot: skip the search
    if split_hot_keys and not (left_rows is not None and left_rows < hot_min_rows):
        return left_join_skew_split(left, right, on, HOT_SHARE, hot_min_rows)
    r = right.withColumnRenamed(on, "_rk")
    return left.join(r, left[on] == r["_rk"], "left").drop("_rk")


PROBE_BROADCAST_BYTES = 64 * 1024 * 1024


def keys_overlap(new_keys: DataFrame, old_keys: DataFrame, on: str, max_bytes: int = PROBE_BROADCAST_BYTES) -> bool:
    """Whether any of ``new_keys`` occurs in ``old_keys``. The new keys are
    broadcast when measured under the bound, so the (large) old key column is
    only scanned, never shuffled; otherwise a shuffle semi-join."""
    if fits_broadcast(new_keys, max_bytes):
        return not old_keys.join(F.broadcast(new_keys), on, "left_semi").isEmpty()
    # distinct first: a key that very many old rows hold is one row of that side
    return not new_keys.join(old_keys.distinct(), on, "left_semi").isEmpty()
