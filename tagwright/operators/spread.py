"""Equi-joins that keep their speed when one key holds a large share of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

HotKeys = dict[str, DataFrame]


# Values a sketch keeps in a task, and values it reports. A value with over a
# 30,000th of the rows is always among them.
TRACKED, REPORTED = 262_144, 65_536


def find_hot_keys(
    rows: DataFrame, keys: Sequence[str], rows_per_slot: int
) -> HotKeys:
    """Looks for the values to spread; worth it where AQE's skew join, which
    splits a large partition after the shuffle, does not help enough.

    Values of each key column with more than ``rows_per_slot`` rows, and the
    slots each of them needs. Columns without such a value have no entry.

    One narrow scan keeps a heavy-hitter sketch of fixed size per column and task;
    the sketches are merged, and no key is shuffled. Counts are exact while a task
    sees fewer than ``TRACKED`` values; beyond that they are upper estimates, and
    a value too rare for the sketch is left to AQE. At most ``REPORTED`` values per
    column reach the driver, and later the broadcast.
    """
    spark = rows.sparkSession
    kinds = {key: rows.schema[key].dataType for key in keys}
    plain = [
        (F.hex(key) if isinstance(kinds[key], T.BinaryType) else F.col(key)).alias(f"_{i}")
        for i, key in enumerate(keys)
    ]
    top = [
        F.expr(f"filter(approx_top_k(_{i}, {REPORTED}, {TRACKED}), t -> t.count > {int(rows_per_slot)})")
        for i in range(len(keys))
    ]
    found = rows.select(*plain).agg(*[t.alias(key) for t, key in zip(top, keys)]).first()
    hot = {}
    for key, values in zip(keys, found):
        # A missing key matches nothing; it needs no slots.
        values = [(v["item"], -(-v["count"] // rows_per_slot)) for v in values or [] if v["item"] is not None]
        if isinstance(kinds[key], T.BinaryType):
            values = [(bytearray.fromhex(value), slots) for value, slots in values]
        if values:
            schema = rows.select(key).schema.add("_slots", T.IntegerType())
            hot[key] = spark.createDataFrame(values, schema)
    return hot


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    *,
    hot: HotKeys,
    spread_by: Sequence[str],
) -> DataFrame:
    """``left`` joined to ``right`` on ``on``, spreading the left rows that hold a
    hot value in the first of these columns.

    Without hot values this is the plain join. Otherwise a hot value's left rows
    go to one of its slots by a hash of ``spread_by`` (a stable choice, so a
    recomputed task places rows alike), and the few right rows of that value are
    repeated per slot. Every pair meets exactly once, so inner, left, semi and
    anti joins keep their results.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type: {how}")
    on = list(on)
    key = on[0]
    if key not in hot:
        return left.join(right, on, how)
    values = F.broadcast(hot[key])
    last_slot = F.coalesce(F.col("_slots"), F.lit(1)) - 1
    slotted_left = (
        left.join(values, key, "left")
        .withColumn("_slot", _left_slot(key, spread_by))
        .drop("_slots")
    )
    slotted_right = (
        right.join(values, key, "left")
        .withColumn("_slot", F.explode(F.sequence(F.lit(0), last_slot)))
        .drop("_slots")
    )
    return slotted_left.join(slotted_right, [*on, "_slot"], how).drop("_slot")


def _left_slot(key: str, spread_by: Sequence[str]) -> Column:
    row_hash = F.xxhash64(*spread_by)
    # Rows without a key match nothing; any slot is right, so they spread widely.
    free = F.pmod(row_hash, F.lit(1_000_003)).cast("int")
    hot = F.pmod(row_hash, F.col("_slots")).cast("int")
    return F.when(F.col(key).isNull(), free).otherwise(F.coalesce(hot, F.lit(0)))
