"""The attempt ledger: append-only attempts, latest attempt decides."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tagwright.functions.columns import one_line, percentage
from tagwright.operators.spread import HotKeys, spread_join
from tagwright.session import scratch, write_shared

SUCCESS, FAILED, PENDING = "success", "failed", "pending"
VALIDATION_ERROR = "Validation failed"

KEY = ("address", "chain_id")
DETAILS = ("status", "attempted_at", "tx_hash", "error_message", "tags_json")
REPORT_COLUMNS = ("address", "chain_id", "attempted_at", "error_message", "tags_json")


def _order_column(order: Sequence[str]) -> Column:
    """One sortable value; a single column stays as it is, which lets a
    fixed-width one be aggregated by hash."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def current_state(
    attempts: DataFrame, order: Sequence[str] = ("seq",), details: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: its latest attempt by ``order``, which must be unique
    per key. Aggregated on the map side, so a key that is retried without end
    does not pile up in one task. ``details`` limits the columns that are read
    and carried; all of them otherwise."""
    kept = [c for c in attempts.columns if c not in KEY] if details is None else list(details)
    latest = F.max_by(F.struct(*kept), _order_column(order))
    return (
        attempts.groupBy(F.lower("address").alias("address"), "chain_id")
        .agg(latest.alias("_latest"))
        .select(*KEY, "_latest.*")
    )


def sent_keys(state: DataFrame) -> DataFrame:
    """Keys that need no further delivery. Failed and pending keys are retried."""
    return state.filter(F.col("status") == SUCCESS).select(*KEY)


def sent_keys_of(attempts: DataFrame, order: Sequence[str] = ("seq",)) -> DataFrame:
    """The same keys straight from the attempts: reads key, status and order
    only, and keeps one flag per key."""
    last_ok = F.max_by(F.col("status") == SUCCESS, _order_column(order))
    return (
        attempts.groupBy(F.lower("address").alias("address"), "chain_id")
        .agg(last_ok.alias("_sent"))
        .filter("_sent")
        .select(*KEY)
    )


def ledger_stats(state: DataFrame, as_of) -> DataFrame:
    """Totals per status, attempts in the hour before ``as_of``, success rate."""
    status = F.col("status")
    counted = state.agg(
        F.count(F.lit(1)).alias("total_submissions"),
        F.count_if(status == SUCCESS).alias("successful"),
        F.count_if(status == FAILED).alias("failed"),
        F.count_if(status == PENDING).alias("pending"),
        F.count_if(_in_last_hour(as_of)).alias("recent_hour"),
    )
    rate = percentage(F.col("successful"), F.col("total_submissions"))
    return counted.withColumn("success_rate", rate)


def recent_attempts(attempts: DataFrame, as_of) -> DataFrame:
    return attempts.filter(_in_last_hour(as_of))


def _in_last_hour(as_of):
    """``as_of`` is a timestamp text or column, in UTC like ``attempted_at``."""
    moment = F.lit(as_of).cast("timestamp_ntz") if isinstance(as_of, str) else as_of
    return F.col("attempted_at").cast("timestamp_ntz") > moment - F.expr("INTERVAL 1 HOUR")


# -- labels against the ledger ----------------------------------------------


def unsent(
    labels: DataFrame,
    sent: DataFrame,
    row_id: str = "verified_contract_id",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Labels whose key is not among the ``sent`` keys. Meant for a stored label
    table; straight from the three tables, filter the deployments instead."""
    return _against_sent(labels, sent, "left_anti", row_id, hot)


def already_sent(
    labels: DataFrame,
    sent: DataFrame,
    row_id: str = "verified_contract_id",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Labels whose key is among the ``sent`` keys: the rows a run skips."""
    return _against_sent(labels, sent, "left_semi", row_id, hot)


def _against_sent(
    labels: DataFrame, sent: DataFrame, how: str, row_id: str, hot: HotKeys | None
) -> DataFrame:
    """``hot`` are the hot values of ``_address``, the lower-case address."""
    keyed = labels.withColumn("_address", F.lower("address"))
    keys = sent.withColumnRenamed("address", "_address")
    return spread_join(
        keyed,
        keys,
        ["_address", "chain_id"],
        how,
        hot=hot or {},
        spread_by=[row_id],
    ).select(*labels.columns)


def _binary_key(keys: DataFrame) -> DataFrame:
    """Ledger rows with the address as the bytes it stands for, so that
    deployments are compared as they are stored."""
    digits = F.substr("address", F.lit(3))
    whole = F.col("address").startswith("0x") & (F.length("address") % 2 == 0)
    return keys.withColumn("address", F.when(whole, F.unhex(digits)))


def _join_deployments(
    deployments: DataFrame, keyed: DataFrame, how: str, hot: HotKeys | None
) -> DataFrame:
    """The key of a label comes from its deployment alone, so the ledger meets
    the deployments before the fact table is joined: fewer, narrower rows."""
    return spread_join(
        deployments, _binary_key(keyed), list(KEY), how, hot=hot or {}, spread_by=["id"]
    )


def unsent_deployments(
    deployments: DataFrame, sent: DataFrame, hot: HotKeys | None = None
) -> DataFrame:
    """Deployments whose key is not among the ``sent`` keys."""
    joined = _join_deployments(deployments, sent, "left_anti", hot)
    return joined.select(*deployments.columns)


def sent_deployments(
    deployments: DataFrame, sent: DataFrame, hot: HotKeys | None = None
) -> DataFrame:
    joined = _join_deployments(deployments, sent, "left_semi", hot)
    return joined.select(*deployments.columns)


def deployments_with_sent(
    deployments: DataFrame, keys: DataFrame, hot: HotKeys | None = None
) -> DataFrame:
    """Deployments with ``already_sent``: is their key among ``keys``, which hold
    each (address, chain_id) once."""
    marked = keys.withColumn("_sent", F.lit(True))
    return _join_deployments(deployments, marked, "left", hot).select(
        *deployments.columns, F.coalesce("_sent", F.lit(False)).alias("already_sent")
    )


_RESULT = ("status", "uid", "tx_hash", "error_message", "reported_at")


def _result_columns(result: str) -> list[Column]:
    return [F.col(f"{result}.{n}").alias(c) for n, c in zip(_RESULT, DELIVERY_COLUMNS[1:])]


def _last_result() -> Column:
    return F.max_by(F.struct(*_RESULT), "seq")


def latest_results(results: DataFrame) -> DataFrame:
    """One delivery result per key: ``result_status``, ``uid``, ``tx_hash``,
    ``error_message``; the last one by ``seq`` when several came back."""
    return (
        results.groupBy(F.lower("address").alias("address"), "chain_id")
        .agg(_last_result().alias("_result"))
        .select(*KEY, *_result_columns("_result"))
    )


DELIVERY_COLUMNS = (
    "already_sent",
    "result_status",
    "result_uid",
    "result_tx_hash",
    "result_error",
    "reported_at",
)


def deployments_with_delivery(
    deployments: DataFrame, sent: DataFrame, results: DataFrame, hot: HotKeys | None = None
) -> DataFrame:
    """Deployments with ``already_sent`` and their delivery result, to be carried
    into the label rows. Ledger and results are folded by key together and as the
    deployments store it, so that nothing is shuffled again before the join."""
    reported = results.select(
        F.lower("address").alias("address"), "chain_id", "seq", *_RESULT
    ).withColumn("_sent", F.lit(None).cast("boolean"))
    marked = sent.select(*KEY).withColumn("_sent", F.lit(True))
    outcome = (
        _binary_key(reported.unionByName(marked, allowMissingColumns=True))
        .filter(F.col("address").isNotNull())  # no deployment has it
        .groupBy(*KEY)
        .agg(_last_result().alias("_result"), F.max("_sent").alias("_sent"))
    )
    joined = spread_join(
        deployments, outcome, list(KEY), "left", hot=hot or {}, spread_by=["id"]
    )
    return joined.select(
        *deployments.columns,
        F.coalesce("_sent", F.lit(False)).alias("already_sent"),
        *_result_columns("_result"),
    )


# -- attempts and reports ---------------------------------------------------


def attempt_rows(labels: DataFrame, started_at, first_step: int = 0) -> DataFrame:
    """Ledger transitions of validated labels that carry a delivery result.

    ``shown_address`` is the address as the label has it, for the failure log.
    Every label is pending first. An invalid one then fails validation; a valid
    one takes the status that came back, if any.
    """
    moment = F.lit(started_at).cast("timestamp_ntz") if isinstance(started_at, str) else started_at
    no_text = F.lit(None).cast("string")

    def step(number, status, at, tx_hash, error):
        return F.struct(
            F.lit(first_step + number).alias("step"),
            status.alias("status"),
            at.alias("attempted_at"),
            tx_hash.alias("tx_hash"),
            error.alias("error_message"),
        )

    pending = step(0, F.lit(PENDING), moment, no_text, no_text)
    rejected = step(1, F.lit(FAILED), moment, no_text, F.lit(VALIDATION_ERROR))
    reported = F.coalesce(F.col("reported_at").cast("timestamp_ntz"), moment)
    outcome = step(
        1, F.col("result_status"), reported, F.col("result_tx_hash"), F.col("result_error")
    )
    steps = (
        F.when(~F.col("valid"), F.array(pending, rejected))
        .when(F.col("result_status").isNotNull(), F.array(pending, outcome))
        .otherwise(F.array(pending))
    )
    return labels.select(
        "verified_contract_id",
        F.lower("address").alias("address"),
        F.col("address").alias("shown_address"),
        "chain_id",
        "tags_json",
        F.explode(steps).alias("_step"),
    ).select("verified_contract_id", *KEY, "shown_address", "_step.*", "tags_json")


def failed_keys(state: DataFrame) -> DataFrame:
    return state.filter(F.col("status") == FAILED).select(*REPORT_COLUMNS)


def failed_report(state: DataFrame) -> DataFrame:
    """Failed keys, newest first."""
    return failed_keys(state).orderBy(F.desc("attempted_at"), *KEY)


def export_failed(state: DataFrame, path: str) -> str | None:
    """Write the failure report as CSV with a header; nothing when none failed.
    The failed keys are computed once and kept in the shared folder meanwhile."""
    with scratch(state.sparkSession):
        failed = write_shared(failed_keys(state))
        if failed.isEmpty():
            return None
        failed.orderBy(F.desc("attempted_at"), *KEY).write.mode("overwrite").csv(
            path, header=True, quoteAll=True, escape='"'
        )
    return path


def failure_log_rows(attempts: DataFrame, *more: str) -> DataFrame:
    """Failed attempts as the live log shows them: address as given, the error
    on one line. ``more`` names further columns to keep in front."""
    return attempts.filter(F.col("status") == FAILED).select(
        *more,
        "attempted_at",
        "address",
        "chain_id",
        one_line(F.col("error_message")).alias("error_message"),
        "tags_json",
    )
