"""Progress records: an append-only table, the latest record counts. Records that
belong to a commit count when it is in the journal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import Row

from tagwright.session import path_exists
from tagwright.streaming.journal import BATCH, Journal

SCHEMA = (
    "run_id long, batch_id long, batch_num long, total_batches long, batch_size long, "
    "offset long, n_skipped long, n_processed long, started_at timestamp_ntz, "
    "finished_at timestamp_ntz, finished boolean, commit long"
)


class ProgressLog:
    """Save, load and clear the progress of runs, without rewriting a file."""

    def __init__(self, spark: SparkSession, path: str, journal: Journal | None = None):
        self.spark = spark
        self.path = path
        self.journal = journal

    def _write(self, rows: list[dict]) -> None:
        df = self.spark.createDataFrame(
            [tuple(r.get(c) for c in self._columns()) for r in rows], SCHEMA
        )
        df.coalesce(1).write.mode("append").parquet(self.path)

    @staticmethod
    def _columns() -> list[str]:
        return [part.split()[0] for part in SCHEMA.split(", ")]

    def save(self, **record) -> None:
        """Append one record; ``run_id``, ``batch_num`` and ``started_at`` order it."""
        self._write([{"finished": False, **record}])

    def clear(self, run_id: int, **record) -> None:
        """Mark a run as finished, so that nothing is left to resume."""
        self._write([{"run_id": run_id, "finished": True, **record}])

    def save_batches(
        self,
        labelled: DataFrame,
        *,
        batch_size: int | None,
        batches_before: int,
        rows_before: int,
        n_batches: int,
        n_rows: int,
        **record,
    ) -> None:
        """Append one record for each batch of a micro-batch: its number in the run,
        the batches known of so far, and the offset behind its last row."""
        batches = self.spark.range(n_batches).withColumnRenamed("id", "sub_batch")
        counted = labelled.groupBy("sub_batch").agg(
            F.count_if("already_sent").alias("n_skipped"), F.count_if(~F.col("already_sent")).alias("n_processed")
        )
        number = F.col("sub_batch") + 1
        behind = F.lit(n_rows) if batch_size is None else F.least(F.lit(n_rows), number * F.lit(batch_size))
        own = {
            **{name: F.lit(value) for name, value in record.items()},
            "batch_num": number + batches_before,
            "total_batches": F.lit(batches_before + n_batches),
            "batch_size": F.lit(batch_size),
            "offset": behind + rows_before,
            "n_skipped": F.coalesce("n_skipped", F.lit(0)),
            "n_processed": F.coalesce("n_processed", F.lit(0)),
            "finished": F.lit(False),
        }
        types = dict(part.split() for part in SCHEMA.split(", "))
        rows = batches.join(counted, "sub_batch", "left")
        rows.select(*[own[c].cast(types[c]).alias(c) for c in self._columns()]).coalesce(1).write.mode("append").parquet(
            self.path
        )

    def records(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], SCHEMA)
        rows = self.spark.read.schema(SCHEMA).parquet(self.path)
        if self.journal is None:
            return rows
        commits = [r["commit"] for r in self.journal.live()]
        return rows.filter(F.col("commit").isNull() | F.col("commit").isin(commits))

    def before(self, run_id: int, batch_id: int) -> dict[str, int]:
        """Batches and rows of a run in the committed micro-batches before one."""
        own = [r for r in self.journal.live() if r["kind"] == BATCH and r["run_id"] == run_id and r["batch_id"] < batch_id]
        return {c: sum(r[c] for r in own) for c in ("n_batches", "n_rows")}

    def load(self) -> Row | None:
        """Latest record of the latest run, or nothing if that run has finished."""
        order = [
            F.desc("run_id"),
            F.desc("finished"),
            F.desc_nulls_last("batch_num"),
            F.desc_nulls_last("started_at"),
        ]
        last = self.records().orderBy(*order).first()
        return None if last is None or last["finished"] else last
