"""Positions of rows in a total order, without a global window."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import DataFrame, Window, functions as F

from tagwright.session import shared_path, write_shared

SLOT = "_slot"  # partition number in the high bits, row number in the low 33
_ROW_BITS = 33


@dataclass(frozen=True)
class OrderedRows:
    """A stored table in total order, with the first position of each of its
    range partitions. ``parts`` has one entry per partition of the write."""

    stored: DataFrame
    path: str
    parts: tuple[tuple[int, int, int], ...]  # (partition, first position, rows)

    @property
    def total(self) -> int:
        return self.parts[-1][1] + self.parts[-1][2] if self.parts else 0

    @property
    def rows(self) -> DataFrame:
        return self.stored.drop(SLOT)

    def with_position(self) -> DataFrame:
        """Rows with their 0-based ``position``; no shuffle, the partition
        starts are joined in as a broadcast of one row per partition."""
        spark = self.stored.sparkSession
        starts = spark.createDataFrame(
            [(part, first) for part, first, _ in self.parts], "_part long, _first long"
        )
        in_part = F.col(SLOT).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
        return (
            self.stored.withColumn("_part", F.shiftright(F.col(SLOT), _ROW_BITS))
            .join(F.broadcast(starts), "_part")
            .withColumn("position", F.col("_first") + in_part)
            .drop("_part", "_first", SLOT)
        )

    def with_batch(self, batch_size: int, start_offset: int = 0) -> DataFrame:
        """Rows from ``start_offset`` on with their ``batch_id``: consecutive
        runs of ``batch_size`` rows, numbered as in a run from the start."""
        rows = self.with_position()
        if start_offset > 0:
            rows = rows.filter(F.col("position") >= start_offset)
        number = F.floor((F.col("position") - start_offset) / F.lit(batch_size)).cast("long")
        return rows.withColumn("batch_id", number + F.lit(start_offset // batch_size)).drop(
            "position"
        )

    def page(self, limit: int, offset: int = 0) -> DataFrame:
        """``limit`` rows from ``offset``, in order.

        The slot range is pushed down, so only the row groups that hold them are
        read; the page alone is sorted.
        """
        end = min(offset + limit, self.total)
        if offset >= end:
            return self.rows.filter(F.lit(False))
        wanted = F.col(SLOT).between(self._slot_at(offset), self._slot_at(end - 1))
        return self.stored.filter(wanted).orderBy(SLOT).drop(SLOT)

    def batch_count(self, batch_size: int) -> int:
        return -(-self.total // batch_size)

    def _slot_at(self, position: int) -> int:
        for part, first, n in self.parts:
            if first <= position < first + n:
                return (part << _ROW_BITS) | (position - first)
        raise IndexError(position)


def order_rows(df: DataFrame, order: Sequence[str], path: str | None = None) -> OrderedRows:
    """Sort by range partitions, write once, and count the partitions.

    One range shuffle and a sort inside each partition; the table is written to
    the shared folder so that numbering and rows come from the same run, also
    after an executor is lost. The driver gets one count per partition.
    """
    keys = [F.col(c).asc_nulls_last() for c in order]
    numbered = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn(SLOT, F.monotonically_increasing_id())
    )
    path = path or shared_path(df.sparkSession)
    stored = write_shared(numbered, path)
    counts = (
        stored.groupBy(F.shiftright(F.col(SLOT), _ROW_BITS).alias("part"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    )
    sizes = sorted((r["part"], r["n"]) for r in counts)
    firsts = [0, *accumulate(n for _, n in sizes)]
    return OrderedRows(
        stored, path, tuple((part, first, n) for (part, n), first in zip(sizes, firsts))
    )


def with_running_totals(
    df: DataFrame, order: str, totals: dict[str, str], group_size: int = 65_536
) -> DataFrame:
    """Running sums over a dense integer column in two levels: inside groups of
    ``group_size`` consecutive numbers, plus the total of all earlier groups.

    ``totals`` maps an output column to the summed column. Only the group totals
    (rows / group_size) meet in one task.
    """
    group = F.floor(F.col(order) / F.lit(group_size)).cast("long")
    grouped = df.withColumn("_group", group)
    inside = Window.partitionBy("_group").orderBy(order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    sums = grouped.groupBy("_group").agg(
        *[F.sum(src).alias(f"_sum_{out}") for out, src in totals.items()]
    )
    # One row per group of batches: the only relation ordered as a whole.
    before = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    earlier = sums.select(
        "_group",
        *[F.coalesce(F.sum(f"_sum_{o}").over(before), F.lit(0)).alias(f"_before_{o}") for o in totals],
    )
    result = grouped.join(earlier, "_group")
    for out, src in totals.items():
        result = result.withColumn(out, F.sum(src).over(inside) + F.col(f"_before_{out}"))
    return result.drop("_group", *[f"_before_{o}" for o in totals])

