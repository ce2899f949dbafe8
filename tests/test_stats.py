from __future__ import annotations

import pytest

from tagwright import LabelEngine
from tagwright.operators import batching, stats
from tagwright.operators.spread import find_hot_keys
from tests.star import COMPILATIONS, DEPLOYMENTS, VERIFIED, address, as_dicts


def brute_totals(verified, deployments, compilations):
    pairs_d = [(v, d) for v in verified for d in deployments if v[1] is not None and v[1] == d[0]]
    pairs_c = [
        (v, c) for v in verified for c in compilations if v[2] is not None and v[2] == c[0]
    ]
    triples = [(d, c) for v, d in pairs_d for c in compilations if v[2] is not None and v[2] == c[0]]
    base = [(d, c) for d, c in triples if d[1] is not None and d[2] is not None]
    return {
        "vc_to_deployments": sum(d[1] is not None for _, d in pairs_d),
        "vc_to_compiled": sum(c[1] is not None for _, c in pairs_c),
        "full_join": sum(c[1] is not None for _, c in base),
        "total_contracts": len(base),
        "with_deployment_tx": sum(d[3] is not None for d, _ in base),
        "with_deployment_block": sum(d[4] is not None for d, _ in base),
        "with_deployer_address": sum(d[5] is not None for d, _ in base),
        "with_code_language": sum(c[1] is not None for _, c in base),
        "with_code_compiler": sum(c[1] is not None and c[3] is not None for _, c in base),
    }


@pytest.mark.parametrize("repeated", [False, True])
@pytest.mark.parametrize("hot", [False, True])
def test_match_totals(star, repeated, hot):
    verified, deployments, compilations = list(VERIFIED), list(DEPLOYMENTS), list(COMPILATIONS)
    if repeated:
        deployments += [("d1", 3, address(1), None, None, None), ("d2", None, None, None, 1, None)]
        compilations += [("c1", None, "x", "y", "z"), ("c4", "Fe", "fe", "1", "n")]
    if hot:
        verified += [(f"h{i}", "d1", "c1", None) for i in range(50)]
    vc = star.verified(verified)
    keys = find_hot_keys(vc, ["deployment_id"], rows_per_slot=5) if hot else None
    totals = stats.match_totals(
        vc, star.deployments(deployments), star.compilations(compilations), keys
    )
    assert as_dicts(totals) == [brute_totals(verified, deployments, compilations)]


def test_empty_tables(star):
    engine = LabelEngine({n: df.filter("false") for n, df in star.tables().items()}, "registry")
    assert all(r["is_empty"] and r["n_rows"] == 0 for r in as_dicts(engine.table_counts()))
    (row,) = as_dicts(engine.completeness())
    assert row["total_contracts"] == 0 and row["with_deployment_tx_pct"] == 0.0
    (health,) = as_dicts(engine.join_health())
    assert health["no_match"] and not health["low_match"]
    assert engine.chain_distribution().collect() == []


def test_distributions(star):
    engine = LabelEngine(star.tables(), "registry")
    chains = [(r["chain_id"], r["contract_count"]) for r in engine.chain_distribution().collect()]
    assert chains == [(1, 7), (10, 3)]
    assert [r["chain_id"] for r in engine.chain_distribution(1).collect()] == [1]
    languages = {
        r["language"]: r["contract_count"] for r in engine.language_distribution().collect()
    }
    assert languages == {"solidity": 8, "vyper": 1, "rust": 1}


def test_health_warns_below_four_fifths(star):
    (row,) = as_dicts(LabelEngine(star.tables(), "registry").join_health())
    assert row["low_match"] == (
        row["full_join"] < min(row["vc_to_deployments"], row["vc_to_compiled"]) * 0.8
    )


def test_label_set(star):
    rows = LabelEngine(star.tables(), "registry").labels()
    (row,) = as_dicts(stats.label_set_stats(rows))
    assert row["total_contracts"] == 5 and row["unique_chains"] == 2
    assert row["contracts_with_deployment_tx"] == 4
    assert row["contracts_with_compiler"] == 4
    assert as_dicts(stats.label_set_chains(rows, 1)) == [{"chain_id": 1, "contract_count": 4}]
    assert as_dicts(stats.label_set_languages(rows))[0] == {
        "code_language": "solidity",
        "contract_count": 3,
    }


@pytest.mark.parametrize(
    ("remaining", "size", "batches"), [(0, 100, 0), (1, 100, 1), (100, 100, 1), (101, 100, 2)]
)
def test_estimate(spark, remaining, size, batches):
    df = spark.createDataFrame([(remaining,)], "remaining long")
    (row,) = as_dicts(stats.estimated(df, size, 1.5))
    assert row["estimated_batches"] == batches
    assert row["estimated_hours"] == pytest.approx(batches * 1.5 / 3600)


# -- batches --------------------------------------------------------------------


def outcome_rows(spark, batches):
    """(rows, sent, delivered, invalid) per batch; the rest failed."""
    rows = []
    for batch, (n, sent, ok, invalid) in enumerate(batches):
        for i in range(n):
            if i < sent:
                row = (True, True, None)
            elif i < sent + ok:
                row = (False, True, "success")
            elif i < sent + ok + invalid:
                row = (False, False, None)
            else:
                row = (False, True, "failed")
            rows.append((batch, f"{batch}-{i}", *row, "u" if row[2] == "success" else None))
    return spark.createDataFrame(
        rows,
        "batch_id long, verified_contract_id string, already_sent boolean, valid boolean, "
        "result_status string, result_uid string",
    )


def test_batch_outcome_and_rates(spark):
    df = outcome_rows(spark, [(10, 2, 5, 1), (10, 10, 0, 0), (10, 0, 4, 0)])
    rows = as_dicts(batching.running_rates(batching.batch_outcome(df), 2).orderBy("batch_id"))
    assert [r["n_skipped"] for r in rows] == [2, 10, 0]
    assert [r["n_successful"] for r in rows] == [7, 10, 4]
    assert [r["success_rate"] for r in rows] == [70.0, 100.0, 40.0]
    assert [r["total_successful"] for r in rows] == [7, 17, 21]
    assert [r["overall_rate"] for r in rows] == [70.0, 85.0, 70.0]
    assert [r["low_success"] for r in rows] == [False, False, True]


def test_retry_only_below_ten_percent(spark):
    df = outcome_rows(spark, [(20, 0, 19, 0), (20, 0, 18, 0), (20, 0, 20, 0), (40, 20, 19, 1)])
    rows = as_dicts(batching.retry_rows(df))
    # 5 % retried, exactly 10 % not, nothing failed, 5 % of the processed (one invalid)
    assert sorted(r["verified_contract_id"] for r in rows) == ["0-19", "3-39"]
    assert {r["attempt"] for r in rows} == {2}


def test_partial_payload(spark):
    df = outcome_rows(spark, [(5, 1, 4, 0), (5, 0, 3, 1)])
    rows = {r["batch_id"]: r for r in as_dicts(batching.payload_results(df))}
    assert (rows[0]["n_sent"], rows[0]["n_returned"], rows[0]["partial"]) == (4, 4, False)
    assert (rows[1]["n_sent"], rows[1]["n_returned"], rows[1]["partial"]) == (4, 3, True)


def test_payloads_skip_invalid_labels(star):
    engine = LabelEngine(star.tables(), "registry")
    batches = engine.ordered().with_batch(2)
    payload = batching.payloads(engine.prepared(batches))
    rows = {r["batch_id"]: r for r in as_dicts(payload)}
    assert sum(len(r["labels"]) for r in rows.values()) == 4
    assert sum(r["n_skipped"] for r in rows.values()) == 1
    label = rows[0]["labels"][0]
    assert label["chain_id"].startswith("eip155:")
    assert label["tags"]["source_code_verified"] == "registry"


def test_resume_is_one_batch_back(spark):
    batches = spark.createDataFrame([(0,), (1,), (7,)], "batch_id long")
    progress = batching.progress_rows(batches, 100, 1001)
    rows = as_dicts(batching.resume_points(progress, 1001).orderBy("batch_num"))
    assert [r["offset"] for r in rows] == [100, 200, 800]
    assert [r["resume_offset"] for r in rows] == [0, 100, 700]
    assert [r["remaining"] for r in rows] == [1001, 901, 301]
    assert {r["total_batches"] for r in rows} == {11}


def test_resume_never_goes_below_zero(spark):
    odd = spark.createDataFrame([(50, 100)], "offset long, batch_size long")
    assert as_dicts(batching.resume_points(odd, 10))[0]["resume_offset"] == 0


def test_session_stats(spark):
    rows = [
        (1, 5, 15, "2024-01-01 00:00:00", "2024-01-01 00:30:00"),
        (1, 0, 20, "2024-01-01 00:30:00", "2024-01-01 01:30:00"),
        (2, 0, 0, "2024-01-02 00:00:00", "2024-01-02 00:00:00"),
    ]
    df = spark.createDataFrame(
        rows, "run_id long, n_skipped long, n_processed long, started_at string, finished_at string"
    )
    got = {r["run_id"]: r for r in as_dicts(batching.session_stats(df))}
    assert got[1] == {
        "run_id": 1,
        "total_skipped": 5,
        "total_processed": 35,
        "session_hours": 1.5,
        "skip_rate": 12.5,
    }
    assert got[2]["skip_rate"] == 0.0
