"""The commit journal of a delivery store: what is in it exists, all else does not.

A batch writes its partitions of several tables under the next commit number and
then appends one record here; the append is a single file that Spark's writer puts
in place at the end. Partitions without a record are invisible: they are what a
killed batch left, and the next one overwrites them, as it takes the same number.
A partition recorded again (the same kind, run, batch and attempt) replaces the
earlier one. One process writes to a store at a time.

There is one record for each micro-batch, set of results, retry and fold, so the
journal is small beside any of the tables; a record also carries the totals up to
it, so that the next one needs no earlier batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession, functions as F
from pyspark.sql.types import Row

from tagwright.session import files_like

SCHEMA = (
    "commit long, kind string, run_id long, batch_id long, attempt int, n_batches long, n_rows long, "
    "n_skipped long, n_successful long, total_rows long, total_successful long, through long, "
    "buckets array<int>, written_at timestamp"
)
BATCH, OUTCOMES, RETRY, FOLD = "batch", "outcomes", "retry", "fold"


class Journal:
    """The records in order of commit. They are read again whenever the folder has
    other files than before, so that any reader sees what any writer committed."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self._files: frozenset[str] = frozenset()
        self._records: list[Row] = []

    def records(self) -> list[Row]:
        files = files_like(self.spark, f"{self.path}/part-*")
        if files != self._files:
            rows = self.spark.read.schema(SCHEMA).parquet(self.path).collect()
            self._records, self._files = sorted(rows, key=lambda r: r["commit"]), files
        return self._records

    def live(self) -> list[Row]:
        """Records of partitions that no later record replaces."""
        parts = {(r["kind"], r["run_id"], r["batch_id"], r["attempt"]): r for r in self.records() if r["kind"] != FOLD}
        return sorted(parts.values(), key=lambda r: r["commit"])

    def next_commit(self) -> int:
        records = self.records()
        return 1 + (records[-1]["commit"] if records else 0)

    def last(self, where: Callable[[Row], bool]) -> Row | None:
        """The newest record of some kind."""
        return next((r for r in reversed(self.records()) if where(r)), None)

    def find(self, kind: str, run_id: int, batch_id: int, attempt: int) -> Row | None:
        own = (kind, run_id, batch_id, attempt)
        return self.last(lambda r: (r["kind"], r["run_id"], r["batch_id"], r["attempt"]) == own)

    def append(self, commit: int, kind: str, **record) -> None:
        row = {"commit": commit, "kind": kind, **record}
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        df = self.spark.createDataFrame([tuple(row.get(n) for n in names)], SCHEMA)
        df.withColumn("written_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(self.path)
