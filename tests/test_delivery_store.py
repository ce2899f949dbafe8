"""The journal, the folded ledger, row-sized batches and the index of waiting rows."""

from __future__ import annotations

import pytest

from tagwright.operators.ledger import failed_report
from tagwright.streaming.delivery import BACKLOG_BATCH
from tagwright.streaming.journal import FOLD
from tagwright.streaming.store import DeliveryStore
from tests.star import as_dicts
from tests.test_delivery import Job


def numbered(star, root, n):
    """A job with ``n`` labels on as many keys."""
    job = Job(star, root, deployments=[(f"m{i}", 1, bytes([i + 1]) * 20, None, 1, None) for i in range(n)])
    job.add([(f"v{i:02}", f"m{i}", "c1", None) for i in range(n)])
    return job


def test_a_failure_after_a_fold_is_seen_and_only_its_bucket_is_folded_again(star, tmp_path, capsys):
    job = numbered(star, tmp_path, 6)
    job.run(1).process_new_files()
    assert job.store.compact(through_run=1) == 1
    assert job.store.compact() == 1  # nothing new, nothing folded
    late = job.outbox()[0]
    job.report(1, 0, [(late["address"], 1, "failed", "out of gas")])
    assert sorted(job.statuses().values()) == ["failed"] + ["pending"] * 5
    (row,) = failed_report(job.store.state()).collect()
    assert (row["address"], row["error_message"]) == (late["address"].lower(), "out of gas")
    before = job.statuses()
    assert job.store.compact() == 2
    fold = job.store.journal.last(lambda r: r["kind"] == FOLD)
    assert len(fold["buckets"]) == 1 and job.statuses() == before
    # A reader that asks for one bucket opens no folder of another.
    job.store.state(("status",), fold["buckets"]).explain("formatted")
    filters = [line for line in capsys.readouterr().out.splitlines() if line.startswith("PartitionFilters")]
    assert len(filters) == 2 and all("bucket#" in line for line in filters)
    again = DeliveryStore(star.spark, job.store.root)
    assert {(r["address"], r["chain_id"]): r["status"] for r in as_dicts(again.state())} == before


def test_a_batch_killed_between_outbox_and_attempts_is_invisible(star, tmp_path, monkeypatch):
    job = numbered(star, tmp_path, 4)
    write = DeliveryStore.write_batch

    def fail(self, table, *rest, **more):
        if table == "attempts":
            raise RuntimeError("lost")
        return write(self, table, *rest, **more)

    monkeypatch.setattr(DeliveryStore, "write_batch", fail)
    with pytest.raises(Exception, match="lost"):
        job.run(1).process_new_files()
    assert job.outbox() == [] and job.store.state().collect() == []
    assert job.store.read("payloads").collect() == []
    monkeypatch.undo()
    job.run(2).process_new_files()
    assert len(job.outbox()) == 4 and set(job.statuses().values()) == {"pending"}


def test_batches_of_rows_payloads_and_rates(star, tmp_path):
    job = numbered(star, tmp_path, 25)
    run = job.run(1, batch_size=10)
    run.process_new_files()
    cuts = {r["verified_contract_id"]: r["sub_batch"] for r in job.outbox()}
    assert cuts == {f"v{i:02}": i // 10 for i in range(25)}
    payloads = sorted(job.store.read("payloads").collect(), key=lambda r: r["sub_batch"])
    assert [(len(r["labels"]), r["n_skipped"]) for r in payloads] == [(10, 0), (10, 0), (5, 0)]
    progress = sorted(run.progress.records().collect(), key=lambda r: r["batch_num"])
    assert [(r["batch_num"], r["total_batches"], r["batch_size"], r["offset"]) for r in progress] == [
        (1, 3, 10, 10), (2, 3, 10, 20), (3, 3, 10, 25),
    ]

    # Nine of the first ten, then none, then all five.
    good = lambda i: i < 9 or i >= 20
    job.report(1, 0, [(r["address"], 1, "success" if good(int(r["verified_contract_id"][1:])) else "failed", None) for r in job.outbox()])
    rates = sorted(job.store.read("metrics").collect(), key=lambda r: r["sub_batch"])
    assert [(r["n_successful"], r["success_rate"], r["low_success"]) for r in rates] == [(9, 90.0, False), (0, 0.0, True), (5, 100.0, False)]
    assert [r["overall_rate"] for r in rates] == pytest.approx([90.0, 45.0, 56.0])

    # Labels sent before are skipped, count as successes and are in no payload.
    job.add([(f"w{i:02}", f"m{i}", "c1", None) for i in range(12)])
    run = job.run(2, batch_size=10)
    run.process_new_files()
    payloads = [r for r in job.store.read("payloads").collect() if r["run_id"] == 2]
    assert sorted((r["sub_batch"], len(r["labels"])) for r in payloads) == [(0, 1), (1, 2)]
    job.report(2, 1, [])
    rates = [r for r in job.store.read("metrics").collect() if r["run_id"] == 2]
    totals = {r["sub_batch"]: (r["n_rows"], r["n_successful"], r["total_rows"], r["total_successful"]) for r in rates}
    assert totals == {0: (10, 9, 35, 23), 1: (2, 0, 37, 23)}
    # The same results again replace the earlier ones in the totals.
    job.report(2, 1, [])
    last = job.store.journal.records()[-1]
    assert (last["total_rows"], last["total_successful"]) == (37, 23)


def test_rows_that_can_never_be_labelled_are_not_joined_again(star, tmp_path):
    deployments = [("m0", 1, bytes([9]) * 20, None, 1, None), ("m1", 1, None, None, 1, None)]
    early = Job(star, tmp_path, deployments=deployments)
    early.add([("v0", "m0", "c1", None), ("v1", "m1", "c1", None), ("v2", "m2", "c1", None), ("v3", "m0", "none", None), ("v4", None, "c1", None)])
    first = early.run(1)
    first.process_new_files()
    lacks = {r["id"]: (r["lacks_deployment"], r["lacks_compilation"]) for r in first.waiting().collect()}
    assert lacks == {"v1": (False, False), "v2": (True, False), "v3": (False, True), "v4": (True, False)}
    late = Job(star, tmp_path, deployments=[*deployments, ("m2", 1, bytes([7]) * 20, None, 1, None)])
    run, asked = late.run(2), []
    deliver = run.deliver
    run.deliver = lambda rows, batch_id: (asked.extend(sorted(r["id"] for r in rows.collect())), deliver(rows, batch_id))
    run.process_backlog()
    assert asked == ["v2", "v3", "v4"]
    assert [(r["verified_contract_id"], r["batch_id"]) for r in late.outbox() if r["run_id"] == 2] == [("v2", BACKLOG_BATCH)]
    assert sorted(r["id"] for r in run.waiting().collect()) == ["v3", "v4"]
