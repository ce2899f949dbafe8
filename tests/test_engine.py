from __future__ import annotations

import datetime as dt

from tagwright import LabelEngine
from tagwright.operators import ledger
from tests.star import as_dicts, expected_labels

ORDERED = sorted(expected_labels(), key=lambda r: r["verified_contract_id"])


def test_batches_cover_all_labels_in_order(star):
    engine = LabelEngine(star.tables(), "registry")
    batches = [as_dicts(b) for b in engine.batches(2)]
    assert [len(b) for b in batches] == [2, 2, 1]
    assert [r for b in batches for r in b] == ORDERED


def test_batches_resume_at_an_offset(star):
    engine = LabelEngine(star.tables(), "registry")
    assert [as_dicts(b) for b in engine.batches(2, start_offset=4)] == [ORDERED[4:]]
    assert list(engine.batches(2, start_offset=50)) == []


def test_no_labels_make_no_batches(star):
    tables = {**star.tables(), "compiled_contracts": star.compilations().filter("false")}
    assert list(LabelEngine(tables, "registry").batches(2)) == []


def test_estimate_counts_what_is_left(star):
    spark = star.spark
    engine = LabelEngine(star.tables(), "registry")
    now = dt.datetime(2024, 1, 1)
    state = spark.createDataFrame(
        [("0x" + "ab" * 20, 1, ledger.SUCCESS, now)],
        "address string, chain_id long, status string, attempted_at timestamp_ntz",
    )
    (row,) = as_dicts(engine.run_estimate(state, str(now), batch_size=2, delay_seconds=1800))
    assert row == {
        "total_contracts": 6,  # with the zero address
        "successful": 1,
        "remaining": 5,
        "estimated_batches": 3,
        "estimated_hours": 1.5,
    }


def test_quality_reports(star):
    reports = LabelEngine(star.tables(), "registry").quality()
    assert {r["n_rows"] for df in reports.values() for r in as_dicts(df)} == {len(ORDERED)}
