"""Delivery runs: new verified files in micro-batches, labels out to an outbox."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from tagwright.functions.columns import percentage
from tagwright.functions.tags import tags_json, validated, with_tags
from tagwright.operators import ledger
from tagwright.operators.batching import RETRY_SHARE, payloads, running_rates
from tagwright.operators.labels import LABEL_ORDER, label_rows, one_per_key
from tagwright.operators.ordering import order_rows
from tagwright.session import scratch, write_shared
from tagwright.streaming.journal import BATCH, OUTCOMES, RETRY
from tagwright.streaming.progress import ProgressLog
from tagwright.streaming.store import DeliveryStore, bucket_of

# Streaming batch ids count up from 0 over all runs of a store; the backlogs of a
# run sort behind them.
BACKLOG_BATCH = 1 << 40

OUTBOX_COLUMNS = ("verified_contract_id", "address", "chain_id", "chain_ref", "tags", "tags_json")

LACKS = ("lacks_deployment", "lacks_compilation")

NO_RESULT = {
    "result_status": "string",
    "result_tx_hash": "string",
    "result_error": "string",
    "reported_at": "timestamp_ntz",
}


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def _without_result(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.lit(None).cast(t) for c, t in NO_RESULT.items()})


def _attempts(rows: DataFrame, at: Column, first_step: int) -> DataFrame:
    return ledger.attempt_rows(rows, at, first_step).drop("verified_contract_id", "shown_address")


@dataclass
class DeliveryRun:
    """One run over everything new in the verified-contracts folder.

    Each micro-batch of files is labelled once and stored with its verdicts; the
    outbox, the payloads, the attempts and the failure log are read off that stored
    partition. All of them count from the moment the micro-batch is committed
    (``journal``): a run that is killed in between leaves nothing that a reader
    sees, and the next one does the micro-batch again, under the number of the run
    that began it.

    With ``batch_size`` the labels of a micro-batch are cut into batches of so many
    rows by their position in label order, numbered on from the batches before; a
    cut depends on the rows alone, so that it is the same when it is done again.
    Without it a micro-batch is one batch. All waiting files make one micro-batch
    unless ``files_per_batch`` cuts them up: every micro-batch scans the two
    dimensions, so large ones are the cheap ones.

    ``waiting`` is the index of rows without a label: which side each lacks. The
    backlog joins these rows alone; those that lack neither can never be labelled
    and are left out, until ``recheck`` makes the index anew from all rows.
    """

    spark: SparkSession
    verified_path: str
    verified_schema: T.StructType
    deployments: DataFrame
    compilations: DataFrame
    store: DeliveryStore
    verifier: str
    run_id: int
    files_per_batch: int | None = None
    batch_size: int | None = None
    extra_check: Callable[[DataFrame], Column] | None = None
    clock: Callable[[], datetime] = utc_now
    recheck: bool = False

    def __post_init__(self) -> None:
        self.progress = ProgressLog(self.spark, self.store.path("progress"), self.store.journal)
        self.resumed: set[int] = set()  # batches of earlier runs that this one finishes

    def run(self) -> None:
        self.process_new_files()
        self.process_backlog()
        self.progress.clear(self.run_id, finished_at=self.clock())

    def process_new_files(self) -> None:
        """Label every file not seen before, then stop."""
        reader = self.spark.readStream.schema(self.verified_schema).option(
            "pathGlobFilter", "*.parquet"
        ).option("maxFileAge", "36500d")  # old files count; the default leaves them out
        if self.files_per_batch is not None:
            reader = reader.option("maxFilesPerTrigger", self.files_per_batch)
        query = (
            reader.parquet(self.verified_path)
            .writeStream.trigger(availableNow=True)
            .option("checkpointLocation", self.store.path("checkpoint"))
            .foreachBatch(lambda rows, batch_id: self.deliver(rows, batch_id))
            .start()
        )
        query.awaitTermination()

    # -- rows that wait ------------------------------------------------------

    def _waiting_schema(self) -> T.StructType:
        fields = ("id", "deployment_id", "compilation_id", "created_at")
        schema = T.StructType([self.verified_schema[f] for f in fields])
        for side in LACKS:
            schema = schema.add(side, T.BooleanType())
        return schema.add("run_id", T.LongType()).add("batch_id", T.LongType()).add("commit", T.LongType())

    def lacking(self, verified: DataFrame, labelled: DataFrame) -> DataFrame:
        """Rows without a label, and which dimension they find no row in. Only their
        own ids meet the dimensions' ids."""
        rows = verified.select(*self._waiting_schema().names[:4]).join(
            labelled.select(F.col("verified_contract_id").alias("id")), "id", "left_anti"
        )
        for side, key, table in zip(LACKS, ("deployment_id", "compilation_id"), (self.deployments, self.compilations)):
            ids = table.select(F.col("id").alias(key)).join(rows.select(key), key, "left_semi").distinct()
            rows = rows.join(ids.withColumn("_found", F.lit(True)), key, "left")
            rows = rows.withColumn(side, F.col("_found").isNull()).drop("_found")
        return rows.select(*self._waiting_schema().names[:6])

    def waiting(self) -> DataFrame:
        """The committed index: what the last backlog left, and what came later."""
        rows = self.store.read("waiting", self._waiting_schema())
        last = self.store.journal.last(lambda r: r["kind"] == BATCH and r["batch_id"] >= BACKLOG_BATCH)
        return rows if last is None else rows.filter(F.col("commit") >= last["commit"])

    def process_backlog(self) -> None:
        """Label verified rows whose deployment or compilation arrived after them."""
        if self.recheck:
            done = self.store.read("labelled", _labelled_ids(self.verified_schema))
            verified = self.spark.read.schema(self.verified_schema).parquet(self.verified_path)
            ids = done.select(F.col("verified_contract_id").alias("id"))
            rows = verified.join(ids, "id", "left_anti")
        else:
            rows = self.waiting().filter(" or ".join(LACKS)).select(*self._waiting_schema().names[:4])
        done = [r for r in self.store.journal.live() if r["kind"] == BATCH and r["run_id"] == self.run_id]
        self.deliver(rows, BACKLOG_BATCH + sum(r["batch_id"] >= BACKLOG_BATCH for r in done))

    # -- batches -------------------------------------------------------------

    def _begun_in(self, batch_id: int) -> int:
        """The run under whose number a batch is written: the one that left it
        unfinished, or this one."""
        runs = set(self.store.begun("labelled", batch_id)) - self.store.committed_runs(batch_id)
        return max(runs, default=self.run_id)

    def blocked_keys(self, batch_id: int, buckets: Sequence[int] | None = None) -> DataFrame:
        """Keys this batch must not send: delivered before, or handed to the
        outbox by an earlier batch of this run. Only ``buckets`` of the ledger are
        folded, where they are named."""
        state = self.store.state(("status", "run_id", "batch_id"), buckets)
        earlier = (
            (F.col("status") == ledger.PENDING)
            & ((F.col("run_id") == self.run_id) | F.col("batch_id").isin(*self.resumed))
            & (F.col("batch_id") < batch_id)
        )
        return state.filter((F.col("status") == ledger.SUCCESS) | earlier).select(*ledger.KEY)

    def _cut(self, rows: DataFrame) -> tuple[DataFrame, list[int]]:
        """Rows with the number of their batch in the micro-batch, stored, and the
        buckets of the ledger that their keys are in."""
        seen = Observation()
        rows = rows.observe(seen, F.collect_set(bucket_of(self.store.n_buckets)).alias("buckets"))
        if self.batch_size is None:
            cut = write_shared(rows).withColumn("sub_batch", F.lit(0).cast("long"))
        else:
            cut = order_rows(rows, LABEL_ORDER).with_batch(self.batch_size).withColumnRenamed("batch_id", "sub_batch")
        return cut, sorted(seen.get["buckets"])

    def deliver(self, verified: DataFrame, batch_id: int) -> None:
        """Label one micro-batch, write its partitions and commit them."""
        if batch_id < BACKLOG_BATCH and self.store.committed_runs(batch_id):
            return  # committed, but the stream was killed before it took note
        with scratch(self.spark):
            self._deliver(verified, batch_id)

    def _deliver(self, verified: DataFrame, batch_id: int) -> None:
        started = self.clock()
        run_id, commit = self._begun_in(batch_id), self.store.journal.next_commit()

        def write(table: str, rows: DataFrame) -> DataFrame:
            return self.store.write_batch(table, rows, run_id, batch_id, commit)

        rows = label_rows(verified, self.deployments, self.compilations, self.verifier)
        checked = validated(with_tags(rows), self.extra_check).withColumn("tags_json", tags_json())
        cut, touched = self._cut(checked)
        counts = Observation()
        marked = _mark_sent(cut, self.blocked_keys(batch_id, touched)).observe(
            counts,
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if("already_sent").alias("n_skipped"),
            F.coalesce(F.max("sub_batch") + 1, F.lit(0)).alias("n_batches"),
        )
        stored = write("labelled", marked)
        seen = counts.get

        fresh = stored.filter(~F.col("already_sent"))
        rejected = fresh.filter(~F.col("valid"))
        chosen = one_per_key(fresh.filter("valid"))
        outbox = write("outbox", chosen.select(*OUTBOX_COLUMNS, "sub_batch"))
        write("payloads", payload_rows(outbox, rejected))
        at = F.lit(started).cast("timestamp_ntz")
        failed = _attempts(_without_result(one_per_key(rejected)), at, 0)
        pending = _attempts(_without_result(outbox.withColumn("valid", F.lit(True))), at, 2)
        write("attempts", failed.unionByName(pending))
        self.store.write_failures(_rejections(rejected, at), run_id, batch_id, commit)
        write("waiting", self.lacking(verified, stored))
        before = self.progress.before(run_id, batch_id)
        self.progress.save_batches(
            stored,
            commit=commit,
            run_id=run_id,
            batch_id=batch_id,
            batch_size=self.batch_size,
            batches_before=before["n_batches"],
            rows_before=before["n_rows"],
            n_batches=max(seen["n_batches"], 1),
            n_rows=seen["n_rows"],
            started_at=started,
            finished_at=self.clock(),
        )
        self.store.journal.append(
            commit,
            BATCH,
            run_id=run_id,
            batch_id=batch_id,
            attempt=1,
            n_batches=max(seen["n_batches"], 1),
            n_rows=seen["n_rows"],
            n_skipped=seen["n_skipped"],
        )
        if run_id != self.run_id and batch_id < BACKLOG_BATCH:
            self.resumed.add(batch_id)


def _labelled_ids(verified: T.StructType) -> T.StructType:
    schema = T.StructType().add("verified_contract_id", verified["id"].dataType)
    return schema.add("run_id", T.LongType()).add("batch_id", T.LongType()).add("commit", T.LongType())


def _mark_sent(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows with ``already_sent``: is their key among ``keys``, which hold each
    (address, chain_id) once. Of the ledger only keys that the rows may have are
    shuffled, where Spark finds its Bloom filter worth it."""
    named = keys.select(F.col("address").alias("_address"), F.col("chain_id").alias("_chain"), F.lit(True).alias("_sent"))
    same = (F.lower(rows["address"]) == F.col("_address")) & (rows["chain_id"].cast("long") == F.col("_chain"))
    return rows.join(named, same, "left").withColumn("already_sent", F.coalesce("_sent", F.lit(False))).drop(
        "_address", "_chain", "_sent"
    )


def payload_rows(outbox: DataFrame, rejected: DataFrame) -> DataFrame:
    """One row for each batch with labels to send: these as one list, and how many
    were left out as invalid. Labels sent before are in neither."""
    columns = ("sub_batch", "address", "chain_ref", "tags", "valid")
    sent = outbox.withColumn("valid", F.lit(True)).select(*columns)
    return payloads(sent.unionByName(rejected.select(*columns)).withColumnRenamed("sub_batch", "batch_id")).withColumnRenamed(
        "batch_id", "sub_batch"
    )


def _rejections(rejected: DataFrame, at: Column) -> DataFrame:
    return ledger.failure_log_rows(
        rejected.select(
            at.alias("attempted_at"),
            "address",
            "chain_id",
            F.lit(ledger.FAILED).alias("status"),
            F.lit(ledger.VALIDATION_ERROR).alias("error_message"),
            "tags_json",
        )
    )


def record_results(
    store: DeliveryStore, results: DataFrame, run_id: int, batch_id: int, attempt: int = 1
) -> None:
    """Write the delivery results of one outbox partition to the ledger, and the
    success rates of its batches.

    The results of a partition are written as a whole, so recording them again,
    or a fuller set of them, replaces the earlier rows. Results for labels that
    were not in the outbox are ignored. The totals over all batches go on from those
    in the last record of the journal; no earlier batch is read.
    """
    outbox = store.read_batch("outbox", run_id, batch_id, attempt).select(
        F.col("address").alias("_shown"),
        F.lower("address").alias("address"),
        F.col("chain_id").cast("long").alias("chain_id"),
        "tags_json",
        "sub_batch",
    )
    commit = store.journal.next_commit()
    outcome = outbox.join(ledger.latest_results(results), list(ledger.KEY)).select(
        "_shown",
        *ledger.KEY,
        F.col("result_status").alias("status"),
        F.col("reported_at").cast("timestamp_ntz").alias("attempted_at"),
        F.col("result_tx_hash").alias("tx_hash"),
        F.col("result_error").alias("error_message"),
        "tags_json",
        F.lit(2 * attempt + 1).alias("step"),
        "sub_batch",
    )
    stored = store.write_batch("outcomes", outcome, run_id, batch_id, commit, attempt)
    shown = stored.withColumn("address", F.col("_shown"))
    store.write_failures(ledger.failure_log_rows(shown), run_id, batch_id, commit, attempt)

    # A retry adds its successes to batches whose rows were counted before.
    counted = store.read_batch("labelled", run_id, batch_id) if attempt == 1 else None
    own = _batch_counts(counted, stored)
    before = store.journal.last(lambda r: r["kind"] == OUTCOMES)
    replaced = store.journal.find(OUTCOMES, run_id, batch_id, attempt)
    totals = [
        (before[f"total_{c}"] if before else 0) - (replaced[f"n_{c}"] if replaced else 0) for c in ("rows", "successful")
    ]
    metrics = store.write_batch("metrics", _rates(own, *totals), run_id, batch_id, commit, attempt)
    sums = metrics.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_rows", "n_successful")]).first()
    store.journal.append(
        commit,
        OUTCOMES,
        run_id=run_id,
        batch_id=batch_id,
        attempt=attempt,
        n_rows=sums[0],
        n_successful=sums[1],
        total_rows=totals[0] + sums[0],
        total_successful=totals[1] + sums[1],
    )


def _batch_counts(labelled: DataFrame | None, outcomes: DataFrame) -> DataFrame:
    """Rows and successes of each batch; rows that were sent before are successes."""
    good = outcomes.groupBy("sub_batch").agg(F.count_if(F.col("status") == ledger.SUCCESS).alias("_good"))
    if labelled is None:
        return good.select("sub_batch", F.lit(0).cast("long").alias("n_rows"), F.col("_good").alias("n_successful"))
    rows = labelled.groupBy("sub_batch").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("already_sent").alias("_skipped")
    )
    return rows.join(good, "sub_batch", "left").select(
        "sub_batch", "n_rows", (F.col("_skipped") + F.coalesce("_good", F.lit(0))).alias("n_successful")
    )


def _rates(counts: DataFrame, rows_before: int, successful_before: int) -> DataFrame:
    """Success rate of each batch and of all up to it, from stored totals."""
    own = running_rates(counts.withColumnRenamed("sub_batch", "batch_id"))
    total_rows, good = F.col("total_rows") + rows_before, F.col("total_successful") + successful_before
    return own.select(
        F.col("batch_id").alias("sub_batch"),
        "n_rows",
        "n_successful",
        percentage(F.col("n_successful"), F.col("n_rows")).alias("success_rate"),
        total_rows.alias("total_rows"),
        good.alias("total_successful"),
        percentage(good, total_rows).alias("overall_rate"),
        "low_success",
    )


def retry_failures(store: DeliveryStore, run_id: int, batch_id: int, at: datetime) -> bool:
    """Put the failed labels of a batch into the outbox once more, if some but
    under 10 % of its processed rows failed. Says whether there was anything."""
    processed = store.read_batch("labelled", run_id, batch_id).filter(~F.col("already_sent"))
    outcomes = store.read_batch("outcomes", run_id, batch_id)
    failed = outcomes.filter(F.col("status") == ledger.FAILED)
    n_processed = processed.count()
    n_failed = failed.count() + processed.filter(~F.col("valid")).count()
    if not 0 < n_failed < n_processed * RETRY_SHARE:
        return False
    commit = store.journal.next_commit()
    keys = failed.select(F.col("address").alias("_address"), "chain_id")
    again = (
        store.read_batch("outbox", run_id, batch_id)
        .withColumn("_address", F.lower("address"))
        .join(keys, ["_address", "chain_id"], "left_semi")
        .select(*OUTBOX_COLUMNS, "sub_batch")
    )
    stored = store.write_batch("outbox", again, run_id, batch_id, commit, attempt=2)
    pending = _attempts(
        _without_result(stored.withColumn("valid", F.lit(True))),
        F.lit(at).cast("timestamp_ntz"),
        4,
    )
    store.write_batch("attempts", pending, run_id, batch_id, commit, attempt=2)
    store.journal.append(commit, RETRY, run_id=run_id, batch_id=batch_id, attempt=2)
    return True
