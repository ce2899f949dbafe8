"""Batches of labels: outcomes, running rates, payloads, resume and retry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tagwright.functions.columns import (
    packed_hex,
    percentage,
    seconds_between,
    unpacked_hex,
    with_packed_hex,
)
from tagwright.functions.tags import TAG_HASHES
from tagwright.operators.ordering import with_running_totals

# A batch below this success share warns; a batch with a smaller
# failure share than the second gets its failures retried once.
LOW_SUCCESS_SHARE = 0.5
RETRY_SHARE = 0.1


def batch_bounds(batches: DataFrame, row_id: str = "verified_contract_id") -> DataFrame:
    return batches.groupBy("batch_id").agg(
        F.min(row_id).alias("first_id"),
        F.max(row_id).alias("last_id"),
        F.count(F.lit(1)).alias("n_rows"),
    )


# -- outcome ----------------------------------------------------------------


def delivered() -> Column:
    """A label counts as delivered in this run when it was not sent before, is
    valid, and a success came back for its key."""
    ok = F.coalesce(F.col("result_status") == "success", F.lit(False))
    return ~F.col("already_sent") & F.col("valid") & ok


def batch_outcome(batches: DataFrame) -> DataFrame:
    """Per batch: size, rows skipped as sent, rows processed, successes (skipped
    rows count as such) and their rate."""
    counted = batches.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if("already_sent").alias("n_skipped"),
        F.count_if(~F.col("already_sent")).alias("n_processed"),
        F.count_if(F.col("already_sent") | delivered()).alias("n_successful"),
    )
    return counted.withColumn(
        "success_rate", percentage(F.col("n_successful"), F.col("n_rows"))
    )


def running_rates(outcome: DataFrame, group_size: int = 65_536) -> DataFrame:
    """Overall successes, rows and rate up to each batch, and the warning for a
    batch with under half its rows successful."""
    totals = with_running_totals(
        outcome,
        "batch_id",
        {"total_successful": "n_successful", "total_rows": "n_rows"},
        group_size,
    )
    return totals.withColumn(
        "overall_rate", percentage(F.col("total_successful"), F.col("total_rows"))
    ).withColumn(
        "low_success",
        F.col("n_successful") < F.col("n_rows").cast("double") * F.lit(LOW_SUCCESS_SHARE),
    )


def retry_rows(batches: DataFrame) -> DataFrame:
    """Failed rows of batches in which some, but under 10 %, of the processed
    rows failed. They re-enter delivery once, as attempt 2."""
    processed = batches.filter(~F.col("already_sent"))
    shares = processed.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(~delivered()).alias("_failed")
    )
    retried = shares.filter(
        F.col("_failed") < F.col("_n").cast("double") * F.lit(RETRY_SHARE)
    ).select("batch_id")
    return (
        processed.filter(~delivered())
        .join(retried, "batch_id", "left_semi")
        .withColumn("attempt", F.lit(2))
    )


# -- payloads ---------------------------------------------------------------


def payloads(batches: DataFrame) -> DataFrame:
    """One row per batch: the valid labels as a list, and the invalid skipped. Leave
    out the labels that were sent before first.

    The list is as long as a batch at most, because batches are cut by position.
    Addresses and hashes are shuffled as the bytes they stand for.
    """
    packed = with_packed_hex(batches, [f"tags.{tag}" for tag in TAG_HASHES])
    label = F.struct(
        packed_hex(F.col("address")).alias("address"),
        F.col("chain_ref").alias("chain_id"),
        "tags",
    )
    lists = packed.groupBy("batch_id").agg(
        F.collect_list(F.when(F.col("valid"), label)).alias("labels"),
        F.count_if(~F.col("valid")).alias("n_skipped"),
    )
    return lists.withColumn("labels", F.transform("labels", _unpacked_label))


def _unpacked_label(label: Column) -> Column:
    tags = label["tags"]
    for tag in TAG_HASHES:
        tags = tags.withField(tag, unpacked_hex(label["tags"][tag]))
    return F.struct(
        unpacked_hex(label["address"]).alias("address"),
        label["chain_id"].alias("chain_id"),
        tags.alias("tags"),
    )


def payload_sizes(payload: DataFrame) -> DataFrame:
    return payload.select(
        "batch_id", F.size("labels").cast("long").alias("n_labels"), "n_skipped"
    )


def payload_results(batches: DataFrame) -> DataFrame:
    """Returned ids against labels sent, per batch; fewer ids is a partial result."""
    sent = batches.filter(F.col("valid") & ~F.col("already_sent"))
    return (
        sent.groupBy("batch_id")
        .agg(F.count(F.lit(1)).alias("n_sent"), F.count("result_uid").alias("n_returned"))
        .withColumn("partial", F.col("n_returned") < F.col("n_sent"))
    )


# -- progress and resume ------------------------------------------------------


def _column(value: int | Column) -> Column:
    """``total_rows`` may be a scalar subquery, so that counting is part of the plan."""
    return value if isinstance(value, Column) else F.lit(value)


def progress_rows(batches: DataFrame, batch_size: int, total_rows: int | Column) -> DataFrame:
    """The progress record written before each batch: its 1-based number, the
    number of batches, and the offset behind the batch. ``batches`` needs one
    row per batch."""
    number = F.col("batch_id") + 1
    return batches.select(
        number.alias("batch_num"),
        F.ceil(_column(total_rows) / F.lit(batch_size)).cast("long").alias("total_batches"),
        F.lit(batch_size).cast("long").alias("batch_size"),
        (number * F.lit(batch_size)).cast("long").alias("offset"),
    )


def resume_points(progress: DataFrame, total_rows: int | Column) -> DataFrame:
    """Where a run restarts after each progress record: one batch before the
    recorded offset, so the batch in flight is done again."""
    offset = F.greatest(F.lit(0).cast("long"), F.col("offset") - F.col("batch_size"))
    return progress.withColumn("resume_offset", offset).withColumn(
        "remaining", _column(total_rows).cast("long") - F.col("resume_offset")
    )


def session_stats(progress: DataFrame) -> DataFrame:
    """Per run: rows skipped and processed, skip rate, and hours from the first
    start to the last finish."""
    seconds = seconds_between(F.min("started_at"), F.max("finished_at"))
    summed = progress.groupBy("run_id").agg(
        F.sum("n_skipped").alias("total_skipped"),
        F.sum("n_processed").alias("total_processed"),
        (seconds / F.lit(3600.0)).alias("session_hours"),
    )
    handled = F.col("total_skipped") + F.col("total_processed")
    return summed.withColumn("skip_rate", percentage(F.col("total_skipped"), handled))
