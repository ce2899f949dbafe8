from __future__ import annotations

import pytest
from pyspark.sql import functions as F, types as T

from tagwright.operators import labels as ops, quality
from tagwright.operators.spread import find_hot_keys
from tagwright.sources.tables import table_schemas
from tests.star import (
    COMPILATIONS,
    DEPLOYMENTS,
    VERIFIED,
    address,
    as_dicts,
    expected_labels,
    in_order,
)


def rows_of(star, **options):
    return ops.label_rows(
        star.verified(), star.deployments(), star.compilations(), "registry", **options
    )


def test_label_rows(star):
    assert in_order(as_dicts(rows_of(star))) == in_order(expected_labels())


def test_zero_address_is_kept_on_request(star):
    got = as_dicts(rows_of(star, drop_zero_address=False))
    assert in_order(got) == in_order(expected_labels(drop_zero=False))
    assert any(r["address"] == "0x" + "0" * 40 for r in got)


def test_repeated_dimension_ids_multiply_like_a_join(star):
    deployments = [*DEPLOYMENTS, ("d1", 5, address(0x77), None, 1, None)]
    compilations = [*COMPILATIONS, ("c1", "Yul", "solc", "1", "Other")]
    got = ops.label_rows(
        star.verified(), star.deployments(deployments), star.compilations(compilations), "registry"
    )
    want = expected_labels(VERIFIED, deployments, compilations)
    assert in_order(as_dicts(got)) == in_order(want)


def test_hot_keys_do_not_change_the_labels(star):
    # A third of the rows on one compilation, another third on one deployment.
    rows = [(f"a{i:03}", "d1", "c1" if i % 3 else "c2", None) for i in range(120)]
    rows += [(f"b{i:03}", "d2" if i % 2 else "d6", "c1", None) for i in range(120)]
    rows += [(f"n{i:03}", None, "c1", None) for i in range(60)]
    verified = star.verified(rows)
    hot = find_hot_keys(verified, ops.FACT_KEYS, rows_per_slot=10)
    assert set(hot) == set(ops.FACT_KEYS)
    got = ops.label_rows(verified, star.deployments(), star.compilations(), "registry", hot=hot)
    assert in_order(as_dicts(got)) == in_order(expected_labels(rows))


def test_binary_uuid_ids(spark):
    schemas = table_schemas(T.BinaryType(), T.DecimalType(38, 0))
    from decimal import Decimal

    key = [bytes([i]) * 16 for i in range(3)]
    verified = spark.createDataFrame(
        [(key[0], key[1], key[2], None)], schemas["verified_contracts"]
    )
    deployments = spark.createDataFrame(
        [(key[1], 1, address(1), None, Decimal(12), None)], schemas["contract_deployments"]
    )
    compilations = spark.createDataFrame(
        [(key[2], "Fe", "fe", "1", "X")], schemas["compiled_contracts"]
    )
    got = as_dicts(ops.label_rows(verified, deployments, compilations, "registry"))
    assert [r["deployment_block"] for r in got] == [Decimal(12)]


def test_one_per_key_takes_the_lowest_id(star):
    got = as_dicts(ops.one_per_key(rows_of(star)))
    first = {}
    for r in sorted(expected_labels(), key=lambda r: r["verified_contract_id"]):
        first.setdefault((r["address"].lower(), r["chain_id"]), r)
    assert in_order(got) == in_order(list(first.values()))


def test_one_per_key_ignores_case(star):
    rows = rows_of(star)
    both = rows.unionByName(
        rows.withColumn("address", F.lower("address")).withColumn(
            "verified_contract_id", F.concat(F.lit("z"), "verified_contract_id")
        )
    )
    assert in_order(as_dicts(ops.one_per_key(both))) == in_order(as_dicts(ops.one_per_key(rows)))


@pytest.mark.parametrize(("limit", "offset"), [(2, 0), (2, 1), (3, 3), (10, 4), (5, 50), (0, 0)])
def test_pages_by_top_k_and_by_position_agree(star, limit, offset):
    want = sorted(expected_labels(), key=lambda r: r["verified_contract_id"])
    want = want[offset : offset + limit]
    assert as_dicts(ops.label_page(rows_of(star), limit, offset)) == want
    assert as_dicts(ops.deep_label_page(rows_of(star), limit, offset)) == want


def test_preview_is_nested(star):
    (row,) = as_dicts(ops.preview(rows_of(star), 2))
    assert row["sample_count"] == 2
    first = row["contracts"][0]
    assert first["address"] == "0x" + "AB" * 20
    assert first["verified_at"] == "2024-01-01 12:00:00"
    assert first["tags"]["contract_name"] == " Token "  # raw, not stripped
    assert len(first["tags"]) == 8


def test_preview_of_nothing(star):
    (row,) = as_dicts(ops.preview(rows_of(star).filter("false"), 2))
    assert row == {"sample_count": 0, "contracts": []}


def test_filters_and_columns_reach_the_scan(star, tmp_path):
    star.write(str(tmp_path))
    spark = star.spark
    frames = [
        spark.read.schema(star.schemas[n]).parquet(f"{tmp_path}/{n}") for n in star.schemas
    ]
    plan = ops.label_rows(*frames, "registry").select("verified_contract_id", "chain_id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(language)" in text and "IsNotNull(chain_id)" in text
    assert "ReadSchema: struct<id:string,language:string>" in text
    assert "transaction_hash" not in text and "created_at" not in text


def test_quality_checks(star):
    rows = rows_of(star)
    (nulls,) = as_dicts(quality.null_counts(rows.withColumn("chain_id", F.lit(None))))
    assert nulls["null_chain_id"] == nulls["n_rows"] and nulls["chain_id_pct"] == 0.0
    assert nulls["address_pct"] == 100.0
    (pattern,) = as_dicts(quality.address_pattern(rows))
    total = len(expected_labels())
    assert (pattern["n_rows"], pattern["n_valid"]) == (total, total - 1)
    assert pattern["low_share"]
    assert quality.missing_columns(rows) == []
    assert quality.missing_columns(rows.drop("address", "contract_name")) == [
        "address",
        "contract_name",
    ]


def test_quality_of_no_rows(star):
    rows = rows_of(star).filter("false")
    (nulls,) = as_dicts(quality.null_counts(rows))
    assert nulls["n_rows"] == 0 and nulls["address_pct"] is None
    (pattern,) = as_dicts(quality.address_pattern(rows))
    assert pattern["valid_pct"] is None and not pattern["low_share"]


def test_duplicate_addresses_count_missing_as_one_value(spark):
    rows = [(0, "a"), (0, "a"), (0, None), (0, None), (0, "b"), (1, "a")]
    df = spark.createDataFrame(rows, "batch_id long, address string")
    got = {r["batch_id"]: r for r in as_dicts(quality.duplicate_addresses(df))}
    assert got[0]["n_rows"] == 5 and got[0]["n_duplicates"] == 2 and got[0]["has_duplicates"]
    assert got[1]["n_duplicates"] == 0 and not got[1]["has_duplicates"]
