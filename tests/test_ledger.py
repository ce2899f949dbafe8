from __future__ import annotations

import csv
import datetime as dt
import glob

import pytest
from pyspark.sql import functions as F

from tagwright import LabelEngine
from tagwright.operators import ledger
from tagwright.operators.spread import find_hot_keys
from tests.star import as_dicts, hex_text, address, in_order

SCHEMA = (
    "seq long, address string, chain_id long, status string, attempted_at timestamp_ntz, "
    "tx_hash string, error_message string, tags_json string"
)
NOON = dt.datetime(2024, 3, 1, 12, 0, 0)
A = hex_text(address(0xAB)).lower()
B = hex_text(address(0xCD)).lower()
C = hex_text(address(6)).lower()


def attempts(spark, rows):
    full = [
        (i, a, chain, status, NOON + dt.timedelta(minutes=i), None, error, '{"is_contract":true}')
        for i, (a, chain, status, error) in enumerate(rows)
    ]
    return spark.createDataFrame(full, SCHEMA)


HISTORY = [
    (A, 1, "pending", None),
    (A, 1, "failed", "first"),
    (A.upper().replace("0X", "0x"), 1, "pending", None),
    (A, 1, "success", None),
    (A, 10, "pending", None),  # same address on another chain
    (B, 10, "success", None),
    (B, 10, "failed", 'say "x",\nagain'),
    (C, 1, "failed", None),
]


def test_latest_attempt_decides(spark):
    state = {(r["address"], r["chain_id"]): r for r in as_dicts(
        ledger.current_state(attempts(spark, HISTORY)))}
    assert {k: r["status"] for k, r in state.items()} == {
        (A, 1): "success",
        (A, 10): "pending",
        (B, 10): "failed",
        (C, 1): "failed",
    }
    assert state[(A, 1)]["seq"] == 3


def test_order_of_several_columns(spark):
    rows = [(A, 1, "pending", 2, 0), (A, 1, "success", 1, 9), (A, 1, "failed", 2, 1)]
    df = spark.createDataFrame(rows, "address string, chain_id long, status string, run int, step int")
    assert ledger.current_state(df, ["run", "step"]).first()["status"] == "failed"


def test_stats(spark):
    state = ledger.current_state(attempts(spark, HISTORY))
    as_of = str(NOON + dt.timedelta(minutes=65))
    (row,) = as_dicts(ledger.ledger_stats(state, as_of))
    assert row == {
        "total_submissions": 4,
        "successful": 1,
        "failed": 2,
        "pending": 1,
        "recent_hour": 2,  # strictly after 12:05
        "success_rate": 25.0,
    }


def test_stats_of_an_empty_ledger(spark):
    state = ledger.current_state(attempts(spark, HISTORY).filter("false"))
    (row,) = as_dicts(ledger.ledger_stats(state, str(NOON)))
    assert set(row.values()) == {0, 0.0}


@pytest.mark.parametrize("hot", [False, True])
def test_only_success_keeps_a_label_back(star, hot):
    engine = LabelEngine(star.tables(), "registry")
    if hot:
        engine.__dict__["hot_addresses"] = find_hot_keys(
            engine.deployments.unionByName(engine.deployments),
            ["address"],
            rows_per_slot=1,
        )
    state = ledger.current_state(attempts(star.spark, HISTORY))
    rows = as_dicts(engine.labels())
    sent = [r for r in rows if (r["address"].lower(), r["chain_id"]) == (A, 1)]
    left = [r for r in rows if r not in sent]
    assert len(sent) == 2 and left
    done = ledger.sent_keys_of(attempts(star.spark, HISTORY))
    assert as_dicts(done) == as_dicts(ledger.sent_keys(state)) == [{"address": A, "chain_id": 1}]
    assert in_order(as_dicts(engine.unsent_labels(done))) == in_order(left)
    assert in_order(as_dicts(engine.already_sent_labels(done))) == in_order(sent)
    stored = engine.labels()
    assert in_order(as_dicts(ledger.unsent(stored, done))) == in_order(left)
    assert in_order(as_dicts(ledger.already_sent(stored, done))) == in_order(sent)


def test_malformed_ledger_addresses_match_nothing(star):
    engine = LabelEngine(star.tables(), "registry")
    odd = [("0xabc", 1, "success", None), ("abcd", 1, "success", None), ("0xzz", 1, "success", None)]
    assert engine.already_sent_labels(ledger.sent_keys_of(attempts(star.spark, odd))).count() == 0
    short = ledger.sent_keys_of(attempts(star.spark, [("0xabcd", 1, "success", None)]))
    assert engine.already_sent_labels(short).count() == 1


def test_delivery_joins_ledger_and_results(star):
    spark = star.spark
    engine = LabelEngine(star.tables(), "registry")
    sent = ledger.sent_keys_of(attempts(spark, HISTORY))
    results = spark.createDataFrame(
        [
            (B.upper(), 10, "failed", None, None, "late", NOON, 2),
            (B, 10, "success", "u", "0xt", None, NOON, 3),
            (A, 1, "failed", None, None, "x", NOON, 1),
        ],
        "address string, chain_id long, status string, uid string, tx_hash string, "
        "error_message string, reported_at timestamp_ntz, seq long",
    ).withColumn("address", F.regexp_replace("address", "^0X", "0x"))
    rows = {
        r["verified_contract_id"]: r
        for r in as_dicts(engine.labels_with_delivery(sent, results))
    }
    assert len(rows) == engine.labels().count()
    assert rows["v03"]["result_status"] == "success" and rows["v03"]["result_uid"] == "u"
    assert rows["v01"]["already_sent"] and rows["v01"]["result_status"] == "failed"
    assert rows["v08"]["result_status"] is None and not rows["v08"]["already_sent"]


def test_transitions(star):
    spark = star.spark
    rows = spark.createDataFrame(
        [
            ("v1", A.upper(), 1, True, "success", "0xt", None, NOON, "{}"),
            ("v2", B, 1, True, "failed", None, "no", None, "{}"),
            ("v3", C, 1, True, None, None, None, None, "{}"),
            ("v4", "0x", 1, False, "success", None, None, None, "{}"),
        ],
        "verified_contract_id string, address string, chain_id long, valid boolean, "
        "result_status string, result_tx_hash string, result_error string, "
        "reported_at timestamp_ntz, tags_json string",
    )
    got = as_dicts(ledger.attempt_rows(rows, "2024-01-01 00:00:00", first_step=2))
    steps = {}
    for r in sorted(got, key=lambda r: r["step"]):
        steps.setdefault(r["verified_contract_id"], []).append((r["step"], r["status"]))
    assert steps == {
        "v1": [(2, "pending"), (3, "success")],
        "v2": [(2, "pending"), (3, "failed")],
        "v3": [(2, "pending")],
        "v4": [(2, "pending"), (3, "failed")],
    }
    last = {r["verified_contract_id"]: r for r in got if r["step"] == 3}
    assert last["v4"]["error_message"] == "Validation failed"
    assert last["v1"]["attempted_at"] == NOON and last["v1"]["tx_hash"] == "0xt"
    assert last["v1"]["address"] == A.lower()


def test_failure_report_as_csv(spark, tmp_path):
    state = ledger.current_state(attempts(spark, HISTORY))
    path = ledger.export_failed(state, str(tmp_path / "failed"))
    rows = []
    for part in glob.glob(f"{path}/*.csv"):
        with open(part, newline="") as f:
            rows += list(csv.DictReader(f))
    assert [r["address"] for r in rows] == [C, B]  # newest first
    assert rows[1]["error_message"] == 'say "x",\nagain'
    assert list(rows[0]) == list(ledger.REPORT_COLUMNS)
    back = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    assert back.filter(F.col("address") == B).first()["error_message"] == 'say "x",\nagain'


def test_no_report_without_failures(spark, tmp_path):
    state = ledger.current_state(attempts(spark, HISTORY[:1]))
    assert ledger.export_failed(state, str(tmp_path / "failed")) is None
    assert not (tmp_path / "failed").exists()


def test_failure_log_is_one_line_per_failure(spark, tmp_path):
    log = ledger.failure_log_rows(attempts(spark, HISTORY))
    rows = {r["address"]: r for r in as_dicts(log.filter(F.col("address") == B))}
    assert rows[B]["error_message"] == 'say "x", again'
    path = str(tmp_path / "log")
    log.coalesce(1).write.csv(path, header=True, quoteAll=True, escape='"')
    (part,) = glob.glob(f"{path}/*.csv")
    text = open(part).read()
    assert '"say ""x"", again"' in text
    assert text.count("\n") == 4  # header and three failures
