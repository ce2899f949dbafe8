from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tagwright.streaming.delivery import BACKLOG_BATCH, DeliveryRun, record_results, retry_failures
from tagwright.streaming.progress import ProgressLog
from tagwright.streaming.store import ATTEMPT_SCHEMA, DeliveryStore
from tests.star import COMPILATIONS, DEPLOYMENTS, VERIFIED, Star, as_dicts, expected_labels

NOW = dt.datetime(2024, 4, 1, 8, 0, 0)
RESULTS = (
    "address string, chain_id long, status string, uid string, tx_hash string, "
    "error_message string, reported_at timestamp_ntz, seq long"
)


class Job:
    """Two verified files and a store, in a folder of their own."""

    def __init__(self, star, root, deployments=DEPLOYMENTS, compilations=COMPILATIONS):
        self.star, self.spark, self.root = star, star.spark, str(root)
        self.deployments = star.deployments(deployments)
        self.compilations = star.compilations(compilations)
        self.store = DeliveryStore(self.spark, f"{self.root}/store")

    def add(self, rows) -> None:
        self.star.verified(rows).coalesce(1).write.mode("append").parquet(f"{self.root}/verified")

    def run(self, run_id, **options) -> DeliveryRun:
        return DeliveryRun(
            spark=self.spark,
            verified_path=f"{self.root}/verified",
            verified_schema=self.star.schemas["verified_contracts"],
            deployments=self.deployments,
            compilations=self.compilations,
            store=self.store,
            verifier="registry",
            run_id=run_id,
            clock=lambda: NOW,
            **{"files_per_batch": 1, **options},
        )

    def outbox(self) -> list[dict]:
        return as_dicts(self.store.read("outbox"))

    def report(self, run_id, batch_id, rows, attempt=1) -> None:
        full = [(a, c, s, None, None, e, NOW, i) for i, (a, c, s, e) in enumerate(rows)]
        results = self.spark.createDataFrame(full, RESULTS)
        record_results(self.store, results, run_id, batch_id, attempt)

    def statuses(self) -> dict:
        return {
            (r["address"], r["chain_id"]): r["status"] for r in as_dicts(self.store.state())
        }


@pytest.fixture()
def job(star, tmp_path):
    """A job with one file of verified contracts."""
    made = Job(star, tmp_path)
    made.add(VERIFIED)
    return made


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    """A finished run over two files, for tests that only look."""
    made = Job(Star(spark), tmp_path_factory.mktemp("done"))
    made.add(VERIFIED[:7])
    made.add(VERIFIED[7:])
    made.run(1).run()
    return made


def keys(rows):
    return sorted((r["address"].lower(), r["chain_id"]) for r in rows)


VALID = [r for r in expected_labels() if len(r["address"]) == 42]


def test_run_writes_each_key_once(done):
    rows = done.outbox()
    assert keys(rows) == sorted({(r["address"].lower(), r["chain_id"]) for r in VALID})
    by_id = {r["verified_contract_id"] for r in rows}
    assert "v01" in by_id and "v02" not in by_id  # lowest id of the key
    assert all(r["tags"]["source_code_verified"] == "registry" for r in rows)
    statuses = done.statuses()
    assert statuses[("0xabcd", 1)] == "failed"  # never sent, validation failed
    assert sorted(statuses.values()) == ["failed", "pending", "pending", "pending"]


def test_second_run_sends_nothing_after_success(job):
    job.run(1).process_new_files()
    for batch in {r["batch_id"] for r in job.outbox()}:
        rows = [r for r in job.outbox() if r["batch_id"] == batch]
        job.report(1, batch, [(r["address"], r["chain_id"], "success", None) for r in rows])
    assert sorted(job.statuses().values()) == ["failed", "success", "success", "success"]
    before = len(job.outbox())
    job.add([("w1", "d1", "c1", None), ("w2", "d2", "c2", None)])
    job.run(2).process_new_files()
    assert len(job.outbox()) == before
    last = job.run(3).progress.records().filter("run_id = 2 and not finished")
    assert last.agg(F.sum("n_skipped")).first()[0] == 2


def test_pending_and_failed_keys_are_sent_again_by_a_later_run(job):
    job.run(1).process_new_files()
    first = keys(job.outbox())
    job.add([(f"x{i}", d, "c1", None) for i, d in enumerate(["d1", "d2", "d6"])])
    job.run(2).process_new_files()
    assert keys(job.outbox()) == sorted(first * 2)


def test_a_key_in_two_batches_of_one_run_is_sent_once(star, tmp_path):
    job = Job(star, tmp_path)
    job.add([("v1", "d1", "c1", None)])
    job.add([("v2", "d1", "c1", None)])
    job.run(1).process_new_files()
    assert len(job.outbox()) == 1


def test_interrupted_batch_is_done_again_once(star, tmp_path, monkeypatch):
    job = Job(star, tmp_path)
    job.add(VERIFIED[:7])
    job.add(VERIFIED[7:])
    run = job.run(1)
    write = job.store.write_failures
    calls = []

    def fail_in_second_batch(rows, run_id, batch_id, commit, attempt=0):
        calls.append(batch_id)
        if batch_id == 1 and calls.count(1) == 1:
            raise RuntimeError("lost")
        write(rows, run_id, batch_id, commit, attempt)

    monkeypatch.setattr(job.store, "write_failures", fail_in_second_batch)
    with pytest.raises(Exception, match="lost"):
        run.process_new_files()
    job.run(1).process_new_files()
    assert calls == [0, 1, 1]
    assert keys(job.outbox()) == sorted({(r["address"].lower(), r["chain_id"]) for r in VALID})
    assert job.store.read("labelled").count() == len(expected_labels())


def stop_at(monkeypatch, store, batch):
    """Let a batch fail after its outbox and attempts were written."""

    def fail(rows, run_id, batch_id, commit, attempt=0):
        if batch_id == batch:
            raise RuntimeError("lost")
        DeliveryStore.write_failures(store, rows, run_id, batch_id, commit, attempt)

    monkeypatch.setattr(store, "write_failures", fail)


def test_interrupted_batch_goes_on_under_a_new_run(star, tmp_path, monkeypatch):
    job = Job(star, tmp_path)
    job.add(VERIFIED[:7])
    job.add(VERIFIED[7:])
    stop_at(monkeypatch, job.store, 0)
    with pytest.raises(Exception, match="lost"):
        job.run(1).process_new_files()
    monkeypatch.undo()
    job.run(2).run()
    assert keys(job.outbox()) == sorted({(r["address"].lower(), r["chain_id"]) for r in VALID})
    assert {(r["run_id"], r["batch_id"]) for r in job.outbox()} <= {(1, 0), (2, 1)}


def test_interrupted_backlog_goes_on_under_a_new_run(star, tmp_path, monkeypatch):
    early = Job(star, tmp_path, deployments=[d for d in DEPLOYMENTS if d[0] != "d2"])
    early.add(VERIFIED)
    early.run(1).run()
    job = Job(star, tmp_path)
    stop_at(monkeypatch, job.store, BACKLOG_BATCH)
    with pytest.raises(Exception, match="lost"):
        job.run(2).run()
    monkeypatch.undo()
    job.run(3).run()
    late = [r for r in job.outbox() if r["run_id"] > 1]
    assert [(r["verified_contract_id"], r["run_id"]) for r in late] == [("v03", 2)]
    job.run(4).run()
    assert len([r for r in job.outbox() if r["run_id"] > 1]) == 1


def test_backlog_takes_rows_whose_dimension_came_late(star, tmp_path):
    early = Job(star, tmp_path, deployments=[d for d in DEPLOYMENTS if d[0] != "d2"])
    early.add(VERIFIED)
    early.run(1).process_new_files()
    assert ("v03" in {r["verified_contract_id"] for r in early.outbox()}) is False
    late = Job(star, tmp_path)
    late.run(2).process_backlog()
    added = [r for r in late.outbox() if r["run_id"] == 2]
    assert [r["verified_contract_id"] for r in added] == ["v03"]
    assert {r["batch_id"] for r in added} == {BACKLOG_BATCH}
    late.run(2).process_backlog()  # done again under the same number
    assert len([r for r in late.outbox() if r["run_id"] == 2]) == 1


def test_waiting_files_make_one_batch_by_default(star, tmp_path):
    job = Job(star, tmp_path)
    job.add(VERIFIED[:7])
    job.add(VERIFIED[7:])
    job.run(1, files_per_batch=None).process_new_files()
    assert {r["batch_id"] for r in job.outbox()} == {0}
    assert len(job.outbox()) == 3


def test_results_for_unknown_labels_are_ignored(job):
    job.run(1).process_new_files()
    job.report(1, 0, [("0x" + "77" * 20, 1, "success", None)])
    assert ("0x" + "77" * 20, 1) not in job.statuses()


def test_results_recorded_twice_count_once(job):
    job.run(1).process_new_files()
    (first, *_) = [r for r in job.outbox() if r["batch_id"] == 0]
    row = (first["address"], first["chain_id"], "failed", 'no "gas",\nretry')
    job.report(1, 0, [row])
    job.report(1, 0, [row])
    assert job.store.attempts().filter("step = 3").count() == 1
    log = as_dicts(job.store.failures().filter("attempt = 1"))
    assert [r["error_message"] for r in log] == ['no "gas", retry']
    assert log[0]["address"] == first["address"]  # as given, not lower case


def test_validation_failures_are_logged(done):
    (row,) = as_dicts(done.store.failures().filter("attempt = 0"))
    assert (row["address"], row["error_message"]) == ("0xABCD", "Validation failed")


def test_external_check_keeps_labels_back(job):
    run = job.run(1, extra_check=lambda df: F.col("chain_id") == 10)
    run.process_new_files()
    assert {r["chain_id"] for r in job.outbox()} == {10}


def test_valid_label_wins_over_an_invalid_one_of_its_key(job):
    run = job.run(1, extra_check=lambda df: F.col("code_language") == "vyper")
    run.process_new_files()
    assert [r["verified_contract_id"] for r in job.outbox()] == ["v02"]
    assert job.statuses()[("0x" + "ab" * 20, 1)] == "pending"


def many_keys(star, tmp_path, n):
    deployments = [(f"m{i}", 1, bytes([i + 1]) * 20, None, 1, None) for i in range(n)]
    job = Job(star, tmp_path, deployments=deployments)
    job.add([(f"v{i:02}", f"m{i}", "c1", None) for i in range(n)])
    job.run(1).process_new_files()
    return job


@pytest.mark.parametrize(("n", "failures", "again"), [(21, 2, True), (20, 2, False), (20, 0, False)])
def test_failures_are_retried_once_below_ten_percent(star, tmp_path, n, failures, again):
    job = many_keys(star, tmp_path, n)
    rows = sorted(job.outbox(), key=lambda r: r["verified_contract_id"])
    job.report(1, 0, [
        (r["address"], 1, "failed" if i < failures else "success", None)
        for i, r in enumerate(rows)
    ])
    assert retry_failures(job.store, 1, 0, NOW) is again
    second = [r for r in job.outbox() if r["attempt"] == 2]
    assert len(second) == (failures if again else 0)
    if again:
        assert list(job.statuses().values()).count("pending") == failures
        job.report(1, 0, [(r["address"], 1, "success", None) for r in second], attempt=2)
        assert set(job.statuses().values()) == {"success"}


def test_compaction_keeps_the_state(job):
    job.run(1).process_new_files()
    rows = [r for r in job.outbox() if r["batch_id"] == 0]
    job.report(1, 0, [(r["address"], r["chain_id"], "success", None) for r in rows])
    before = job.statuses()
    assert job.store.compact(through_run=1) == 1
    assert job.statuses() == before
    job.add([("y1", "d6", "c1", None), ("y2", "d8", "c1", None)])
    job.run(2).process_new_files()
    after = job.statuses()
    assert after[("0x" + "08" * 20, 1)] == "pending"
    assert job.store.compact(through_run=2) == 2
    assert job.statuses() == after


def test_half_written_compaction_changes_nothing(job):
    job.run(1).process_new_files()
    before = job.statuses()
    wrong = job.spark.createDataFrame([], ATTEMPT_SCHEMA)
    wrong.write.parquet(f"{job.root}/store/ledger/version=1")
    assert job.statuses() == before
    assert job.store.compact(through_run=1) == 1
    assert job.statuses() == before


def test_state_of_a_new_store_is_empty(star, tmp_path):
    assert Job(star, tmp_path).store.state().collect() == []


def test_progress_save_load_clear(spark, tmp_path):
    log = ProgressLog(spark, str(tmp_path / "progress"))
    assert log.load() is None
    log.save(run_id=1, batch_num=1, total_batches=9, batch_size=10, offset=10, started_at=NOW)
    log.save(run_id=1, batch_num=2, total_batches=9, batch_size=10, offset=20, started_at=NOW)
    last = log.load()
    assert (last["batch_num"], last["offset"], last["total_batches"]) == (2, 20, 9)
    log.clear(1)
    assert log.load() is None
    log.save(run_id=2, batch_num=1, offset=10, started_at=NOW)
    assert log.load()["run_id"] == 2


def test_attempts_carry_time_and_tags(done):
    row = done.store.attempts().filter("status = 'pending'").first()
    assert row["attempted_at"] == NOW and row["tags_json"].startswith("{")


def test_finished_run_leaves_nothing_to_resume(done):
    progress = done.run(1).progress
    assert progress.load() is None
    batches = progress.records().filter("not finished").orderBy("batch_num").collect()
    assert [(r["batch_num"], r["batch_id"]) for r in batches] == [(1, 0), (2, 1), (3, BACKLOG_BATCH)]
    assert sum(r["n_processed"] for r in batches) == len(expected_labels())


def test_a_success_after_compaction_counts(job):
    job.run(1).process_new_files()
    rows = [r for r in job.outbox() if r["batch_id"] == 0]
    job.store.compact(through_run=1)
    job.report(1, 0, [(r["address"], r["chain_id"], "success", None) for r in rows])
    before = len(job.outbox())
    assert all(job.statuses()[k] == "success" for k in keys(rows))
    job.store.compact(through_run=1)
    assert all(job.statuses()[k] == "success" for k in keys(rows))
    job.add([("z1", "d1", "c1", None), ("z2", "d2", "c2", None)])
    job.run(2).process_new_files()
    assert len(job.outbox()) == before


def test_a_late_success_outranks_a_newer_pending(job):
    job.run(1).process_new_files()
    rows = [r for r in job.outbox() if r["batch_id"] == 0]
    job.add([("z1", "d1", "c1", None), ("z2", "d2", "c2", None)])
    job.run(2).process_new_files()
    job.report(1, 0, [(r["address"], r["chain_id"], "success", None) for r in rows])
    before = len(job.outbox())
    job.add([("z3", "d1", "c1", None), ("z4", "d2", "c2", None)])
    job.run(3).process_new_files()
    assert len(job.outbox()) == before
