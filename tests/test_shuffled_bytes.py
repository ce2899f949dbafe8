"""What is shuffled: hashes once per deployment and as bytes, keys alone where keys
are asked for. Plus the rows that the packed forms must give back."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

import tagwright.plans.sample as sample_module
from tagwright.functions.columns import packed_hex, unpacked_hex
from tagwright.operators import batching, labels as label_ops, ledger
from tagwright.operators.labels import LABEL_COLUMNS
from tagwright.plans.registry import REGISTRY
from tagwright.plans.sample import Sample
from tests.star import as_dicts, in_order

SF_DIR = "/root/testdata/sf0.001"

ODD_ADDRESSES = [
    "0x" + "AB" * 20, "0x" + "ab" * 20, "0X" + "AB" * 20, "0xABC", "0x", "", "AB", "0xzz", "0xé", None,
]


def plan(df, capsys) -> str:
    df.explain("formatted")
    return capsys.readouterr().out


def exchanged(df, capsys) -> list[str]:
    """The columns that go into each shuffle of the plan."""
    return re.findall(r"\(\d+\) Exchange\s*\nInput \[\d+\]: \[(.*)\]", plan(df, capsys))


def odd_labels(spark):
    rows = [
        (10 * i + j, a, j % 2, f"solc-{j}" if j else None, None, tx)
        for i, a in enumerate(ODD_ADDRESSES)
        for j in range(4)
        for tx in ("0x" + "CD" * 32, "0xcd")[: 1 + j % 2]
    ]
    names = "verified_contract_id long, address string, chain_id int, code_compiler string, contract_name string, deployment_tx string"
    return spark.createDataFrame(rows + [(0, a, None, None, None, None) for a in ODD_ADDRESSES], names)


def test_packed_hex_gives_every_text_back(spark):
    texts = spark.createDataFrame([(a,) for a in ODD_ADDRESSES], "text string")
    got = texts.select("text", packed_hex(F.col("text")).alias("p")).select(
        "text", unpacked_hex(F.col("p")).alias("back"), "p.bytes"
    ).collect()
    assert all(r["text"] == r["back"] for r in got)
    assert [r["text"] for r in got if r["bytes"] is not None] == ["0x" + "AB" * 20, "0x"]


def test_label_rows_shuffle_hashes_with_deployments_alone(star, capsys):
    rows = label_ops.label_rows(star.verified(), star.deployments(), star.compilations(), "registry")
    wide = [c for c in exchanged(rows, capsys) if "transaction_hash" in c]
    assert wide
    assert not any("created_at" in c for c in wide)


def test_one_per_key_equals_a_plain_sort(spark):
    labels = odd_labels(spark)
    first = {}
    low = lambda v: (v is not None, v if v is not None else 0)
    for r in sorted(
        labels.collect(),
        key=lambda r: tuple(low(r[c]) for c in label_ops.LABEL_ORDER),
    ):
        first.setdefault((r["address"] and r["address"].lower(), r["chain_id"]), r)
    chosen = ("verified_contract_id", "chain_id", "address", "code_compiler", "contract_name")
    got = {tuple(r[c] for c in chosen) for r in label_ops.one_per_key(labels).collect()}
    assert got == {tuple(r[c] for c in chosen) for r in first.values()}
    assert label_ops.one_per_key(labels).columns == labels.columns


def test_one_per_key_of_the_key_columns_alone(spark):
    columns = ["address", "chain_id", "verified_contract_id"]
    got = label_ops.one_per_key(odd_labels(spark).select(columns))
    assert in_order(as_dicts(got)) == in_order(as_dicts(label_ops.one_per_key(odd_labels(spark)).select(columns)))


def test_one_per_key_shuffles_the_bytes_of_a_key(spark, capsys):
    (shuffled,) = exchanged(label_ops.one_per_key(odd_labels(spark)), capsys)
    assert "_bytes" in shuffled


def test_outbox_carries_keys_alone(spark, capsys):
    assert "to_json" not in plan(REGISTRY["delivery_outbox"](spark, SF_DIR), capsys)


@pytest.mark.parametrize(("limit", "offset"), [(3, 0), (4, 3), (5, 9), (6, 30), (50, 2), (5, 200)])
def test_deep_page_with_repeated_and_missing_ids(spark, limit, offset):
    labels = odd_labels(spark).withColumn(
        "verified_contract_id",
        F.when(F.col("verified_contract_id") < 60, F.floor(F.col("verified_contract_id") / 6)),
    )
    low = lambda v: (v is None, v if v is not None else 0)
    chosen = [tuple(r[c] for c in label_ops.LABEL_ORDER) for r in labels.collect()]
    want = sorted(chosen, key=lambda t: tuple(map(low, t)))[offset : offset + limit]
    got = label_ops.deep_label_page(labels, limit, offset)
    assert got.columns == labels.columns
    assert [tuple(r[c] for c in label_ops.LABEL_ORDER) for r in got.collect()] == want


def test_deep_page_orders_ids_alone(star, monkeypatch):
    seen = []
    plain = label_ops.order_rows
    monkeypatch.setattr(label_ops, "order_rows", lambda df, *a: seen.append(df.columns) or plain(df, *a))
    rows = label_ops.label_rows(star.verified(), star.deployments(), star.compilations(), "registry")
    assert rows.columns == list(LABEL_COLUMNS)
    label_ops.deep_label_page(rows, 2, 1).collect()
    assert seen == [["verified_contract_id"]]


def test_unsent_labels_shuffle_hashes_with_deployments_alone(spark, capsys):
    wide = [c for c in exchanged(REGISTRY["unsent_labels"](spark, SF_DIR), capsys) if "transaction_hash" in c]
    assert wide
    assert not any("created_at" in c for c in wide)


def test_delivery_folds_results_and_ledger_by_bytes(spark, capsys):
    deployments = spark.createDataFrame(
        [(1, 7, b"\xab\xcd"), (2, 7, b"\x01"), (3, 8, b"\x01"), (4, None, b"\x01"), (5, 7, None), (5, 7, b"\xab\xcd")],
        "id long, chain_id int, address binary",
    )
    results = spark.createDataFrame(
        [(1, "0xABCD", 7, "failed"), (2, "0xabcd", 7, "success"), (3, "0x1", 7, "success"), (4, None, 7, "success"), (5, "0x01", None, "success"), (6, "0x01", 8, "failed")],
        "seq long, address string, chain_id int, status string",
    ).selectExpr("*", "'u' || seq as uid", "string(null) as tx_hash", "string(null) as error_message", "cast(null as timestamp_ntz) as reported_at")
    sent = spark.createDataFrame([("0x01", 7), ("0x01", 8)], "address string, chain_id int")
    df = ledger.deployments_with_delivery(deployments, sent, results)
    got = {(r["id"], r["address"] and bytes(r["address"]).hex(), r["already_sent"], r["result_status"], r["result_uid"]) for r in df.collect()}
    assert got == {
        (1, "abcd", False, "success", "u2"), (2, "01", True, None, None), (3, "01", True, "failed", "u6"),
        (4, "01", False, None, None), (5, None, False, None, None), (5, "abcd", False, "success", "u2"),
    }
    assert df.count() == 6
    assert "FullOuter" not in plan(df, capsys)


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("session_stats", {"verified_contract_id", "already_sent", "verified_at"}),
        ("batch_payload_results", {"verified_contract_id", "already_sent", "valid", "result_uid"}),
    ],
)
def test_batches_hold_the_columns_of_their_report(spark, monkeypatch, name, columns):
    seen = []
    plain = sample_module.order_rows
    monkeypatch.setattr(sample_module, "order_rows", lambda df, *a: seen.append(set(df.columns)) or plain(df, *a))
    REGISTRY[name](spark, SF_DIR)
    assert seen == [columns]


def test_batches_store_bytes_and_show_text(spark, monkeypatch):
    seen = []
    plain = sample_module.order_rows
    monkeypatch.setattr(sample_module, "order_rows", lambda df, *a: seen.append(df.schema["address"].dataType.simpleString()) or plain(df, *a))
    s = Sample(spark, SF_DIR)
    got = s.batches(s.labels, "address").select("verified_contract_id", "address")
    assert seen == ["struct<bytes:binary,text:string>"]
    assert in_order(as_dicts(got)) == in_order(as_dicts(s.labels.select("verified_contract_id", "address")))


def test_payloads_give_labels_back_and_shuffle_bytes(spark, capsys):
    s = Sample(spark, SF_DIR)
    rows = s.engine.prepared().withColumn("batch_id", F.col("verified_contract_id") % 3)
    lists = batching.payloads(rows)
    (*_, last) = exchanged(lists, capsys)
    assert "batch_id" in last
    assert "unhex" in plan(lists, capsys).lower()
    got = lists.select("batch_id", F.inline("labels"))
    want = rows.filter("valid").select("batch_id", "address", F.col("chain_ref").alias("chain_id"), "tags")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
