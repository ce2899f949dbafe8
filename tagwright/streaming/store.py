"""Folders a delivery run reads and writes.

Tables are folders by run, batch, attempt and commit (``journal``). Readers see
committed partitions only. Attempts and outcomes are also split by a hash of their
key into ``n_buckets`` folders, as is the folded ledger, so a reader that knows
which keys it asks for opens the buckets of these and no others, and a fold
rewrites only buckets that something was recorded for.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tagwright.operators.ledger import KEY, SUCCESS, current_state
from tagwright.session import folders_like, path_exists
from tagwright.streaming.journal import BATCH, FOLD, Journal

ATTEMPT_SCHEMA = (
    "address string, chain_id long, status string, attempted_at timestamp_ntz, "
    "tx_hash string, error_message string, tags_json string, step int, "
    "run_id long, batch_id long, commit long"
)
# Later records win; within one, the later step.
ATTEMPT_ORDER = ("commit", "step")
ATTEMPT_COLUMNS = [c.split()[0] for c in ATTEMPT_SCHEMA.split(", ")]
BUCKETED = ("attempts", "outcomes")
BUCKETS = 64


def bucket_of(n_buckets: int) -> Column:
    """The bucket of a key (lower-case address, chain)."""
    hashed = F.xxhash64(F.lower("address"), F.col("chain_id").cast("long"))
    return F.pmod(hashed, F.lit(n_buckets)).cast("int")


class DeliveryStore:
    def __init__(self, spark: SparkSession, root: str, n_buckets: int = BUCKETS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.n_buckets = n_buckets
        self.journal = Journal(spark, self.path("journal"))

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def partition(self, table: str, run_id: int, batch_id: int, attempt: int, commit: int) -> str:
        return f"{self.path(table)}/run_id={run_id}/batch_id={batch_id}/attempt={attempt}/commit={commit}"

    def write_batch(
        self, table: str, rows: DataFrame, run_id: int, batch_id: int, commit: int, attempt: int = 1
    ) -> DataFrame:
        """Write one batch's partition of a commit and return it as stored."""
        path = self.partition(table, run_id, batch_id, attempt, commit)
        if table in BUCKETED:
            rows = rows.withColumn("bucket", bucket_of(self.n_buckets))
            rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
        else:
            rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def read_batch(self, table: str, run_id: int, batch_id: int, attempt: int = 1) -> DataFrame:
        """The committed rows of one batch."""
        kept = self.read(table)
        own = (F.col("run_id") == run_id) & (F.col("batch_id") == batch_id) & (F.col("attempt") == attempt)
        return kept.filter(own).drop("run_id", "batch_id", "attempt", "commit")

    def begun(self, table: str, batch_id: int) -> list[int]:
        """The runs that have a partition of this batch, committed or not."""
        found = folders_like(self.spark, f"{self.path(table)}/run_id=*/batch_id={batch_id}")
        return sorted(int(f.rsplit("/", 2)[1].removeprefix("run_id=")) for f in found)

    def committed_runs(self, batch_id: int) -> set[int]:
        """The runs that have finished this batch."""
        return {r["run_id"] for r in self.journal.records() if r["kind"] == BATCH and r["batch_id"] == batch_id}

    def write_failures(
        self, rows: DataFrame, run_id: int, batch_id: int, commit: int, attempt: int = 0
    ) -> None:
        """Failure log of one batch as CSV with a header, quotes doubled.
        Attempt 0 holds the labels that failed validation."""
        path = self.partition("failures", run_id, batch_id, attempt, commit)
        rows.write.mode("overwrite").csv(path, header=True, quoteAll=True, escape='"')

    def read(self, table: str, schema: T.StructType | str | None = None) -> DataFrame:
        """The committed rows of a table, with its folder columns; empty before the
        first batch was written."""
        if table in BUCKETED:
            schema = f"{ATTEMPT_SCHEMA}, attempt int, bucket int"
        if not path_exists(self.spark, self.path(table)):
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return self._committed(reader.parquet(self.path(table)))

    def _committed(self, rows: DataFrame) -> DataFrame:
        """The filter is on a folder column, so other folders are not opened."""
        commits = [r["commit"] for r in self.journal.live()]
        return rows.filter(F.col("commit").isin(commits)).withColumn("commit", F.col("commit").cast("long"))

    def failures(self) -> DataFrame:
        schema = (
            "attempted_at timestamp_ntz, address string, chain_id long, "
            "error_message string, tags_json string, run_id long, batch_id long, attempt int, commit long"
        )
        rows = (
            self.spark.read.schema(schema)
            .option("header", True)
            .option("escape", '"')
            .csv(self.path("failures"))
        )
        return self._committed(rows)

    # -- ledger -------------------------------------------------------------

    def attempts(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """Attempts written by the runs and the outcomes reported to them."""
        kept = [self.read(table).select(*ATTEMPT_COLUMNS, "bucket") for table in BUCKETED]
        rows = kept[0].unionByName(kept[1])
        if buckets is not None:
            rows = rows.filter(F.col("bucket").isin([int(b) for b in buckets]))
        return rows

    def folded(self) -> dict[int, tuple[int, int]]:
        """By bucket: the version of its folded state, and the last commit in it."""
        found: dict[int, tuple[int, int]] = {}
        for r in self.journal.records():
            if r["kind"] == FOLD:
                found |= {b: (r["commit"], r["through"]) for b in r["buckets"]}
        return found

    def _version(self, commit: int) -> str:
        return f"{self.path('ledger')}/version={commit}"

    def _parts(self, buckets: Sequence[int] | None, through: int | None = None) -> DataFrame:
        """Folded rows of buckets and the attempts recorded since each fold."""
        known = self.folded()
        recorded = self.attempts(buckets)
        if through is not None:
            recorded = recorded.filter(F.col("commit") <= through)
        if not known:
            return recorded
        # Buckets folded at the same time share a mark.
        marks = {t: sorted(b for b, (_, own) in known.items() if own == t) for t in {t for _, t in known.values()}}
        later = recorded.filter(
            reduce(
                lambda kept, mark: kept & (~F.col("bucket").isin(mark[1]) | (F.col("commit") > mark[0])),
                sorted(marks.items()),
                F.lit(True),
            )
        )
        wanted = sorted(known) if buckets is None else sorted(set(buckets) & set(known))
        paths = [f"{self._version(known[b][0])}/bucket={b}" for b in wanted]
        paths = [p for p in paths if path_exists(self.spark, p)]  # a bucket may be empty
        if not paths:
            return later
        folded = self.spark.read.schema(ATTEMPT_SCHEMA).parquet(*paths)
        folded = folded.select(*ATTEMPT_COLUMNS).withColumn("bucket", bucket_of(self.n_buckets))
        return folded.unionByName(later)

    def state(
        self, details: Sequence[str] | None = None, buckets: Sequence[int] | None = None
    ) -> DataFrame:
        """Latest attempt per key, of all keys or of those in ``buckets``. Only the
        ``details`` named are read; all of them otherwise."""
        return _current(self._parts(buckets).drop("bucket"), details)

    def compact(self, through_run: int | None = None) -> int:
        """Fold what was recorded up to a finished run (all of it, if none is named)
        into a new version of the buckets that it touches, and return the number of
        folds so far. It counts once its record is written, so a fold that dies
        half-way changes nothing. Whatever is recorded later, for whichever run, has
        a higher commit number and so comes on top."""
        commits = [r["commit"] for r in self.journal.live()]
        if through_run is not None:
            later = [r["commit"] for r in self.journal.live() if r["run_id"] > through_run]
            commits = [c for c in commits if not later or c < later[0]]
        through = max(commits, default=0)
        known = self.folded()
        folds = sum(r["kind"] == FOLD for r in self.journal.records())
        recorded = self.attempts().filter(F.col("commit") <= through)
        seen = recorded.groupBy("bucket").agg(F.max("commit").alias("last")).collect()
        touched = sorted(r["bucket"] for r in seen if r["last"] > known.get(r["bucket"], (0, 0))[1])
        if not touched:
            return folds
        commit = self.journal.next_commit()
        rows = _current(self._parts(touched, through).drop("bucket")).withColumn("bucket", bucket_of(self.n_buckets))
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(self._version(commit))
        self.journal.append(commit, FOLD, through=through, buckets=touched)
        return folds + 1


def _current(attempts: DataFrame, details: Sequence[str] | None = None) -> DataFrame:
    """Latest attempt per key; a delivered key stays delivered, whatever later
    runs have put in the outbox before its result was known."""
    ranked = attempts.withColumn("_delivered", (F.col("status") == SUCCESS).cast("int"))
    return current_state(ranked, ["_delivered", *ATTEMPT_ORDER], details).drop("_delivered")
