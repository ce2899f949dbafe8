from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tagwright.functions.columns import WHITESPACE
from tagwright.functions.tags import TAGS, tags_json, validated, with_complete_tags, with_tags

ADDRESS = "0x" + "aB" * 20
TX = "0x" + "1F" * 32
FULL = {
    "verified_contract_id": "v",
    "source_code_verified": "registry",
    "is_contract": True,
    "chain_id": 10,
    "address": ADDRESS,
    "deployment_tx": TX,
    "deployment_block": 12,
    "deployer_address": ADDRESS,
    "code_language": "solidity",
    "code_compiler": "solc-0.8.1",
    "contract_name": "Token",
}
SCHEMA = (
    "verified_contract_id string, source_code_verified string, is_contract boolean, "
    "chain_id long, address string, deployment_tx string, deployment_block long, "
    "deployer_address string, code_language string, code_compiler string, contract_name string"
)


def label(spark, **changes):
    row = {**FULL, **changes}
    return spark.createDataFrame([tuple(row.values())], SCHEMA)


# column, value, tag afterwards (None: tag left out)
RULES = [
    ("code_language", "solidity", "solidity"),
    ("code_language", "SOLIDITY", "solidity"),
    ("code_language", "Vyper", "vyper"),
    ("code_language", "yul", "yul"),
    ("code_language", "fe", "fe"),
    ("code_language", "HUFF", "huff"),
    ("code_language", "rust", None),
    ("code_language", "", None),
    ("code_language", None, None),
    ("code_compiler", "x", "x"),
    ("code_compiler", "", None),
    ("code_compiler", " ", " "),
    ("code_compiler", None, None),
    ("deployment_block", 7, 7),
    ("deployment_block", 0, None),
    ("deployment_block", None, None),
    ("deployment_tx", TX, TX),
    ("deployment_tx", TX[:-1], None),
    ("deployment_tx", TX + "0", None),
    ("deployment_tx", "1x" + TX[2:], None),
    ("deployment_tx", "0x" + "zz" * 32, "0x" + "zz" * 32),  # digits are not checked here
    ("deployment_tx", None, None),
    ("deployer_address", ADDRESS, ADDRESS),
    ("deployer_address", ADDRESS + "00", None),
    ("deployer_address", "xx" + ADDRESS[2:], None),
    ("deployer_address", "", None),
    ("deployer_address", None, None),
    ("contract_name", "  A B  ", "A B"),
    ("contract_name", "\t A \n", "A"),
    ("contract_name", WHITESPACE, None),
    ("contract_name", "   ", None),
    ("contract_name", "", None),
    ("contract_name", None, None),
    ("contract_name", "​A", "​A"),  # a zero-width space is not white space
]


@pytest.fixture(scope="module")
def prepared(spark):
    """All rule rows in one job."""
    rows = [
        tuple({**FULL, column: value, "verified_contract_id": str(i)}.values())
        for i, (column, value, _) in enumerate(RULES)
    ]
    df = with_tags(spark.createDataFrame(rows, SCHEMA)).withColumn("tags_json", tags_json())
    return {r["verified_contract_id"]: r.asDict(recursive=True) for r in df.collect()}


@pytest.mark.parametrize("number", range(len(RULES)))
def test_tag_rule(prepared, number):
    column, _, want = RULES[number]
    row = prepared[str(number)]
    assert row["tags"][column] == want
    assert row["tag_count"] == (7 if want is None else 8)
    others = [t for t in TAGS if t != column]
    assert [row["tags"][t] for t in others] == [FULL[t] for t in others]


@pytest.mark.parametrize("number", range(len(RULES)))
def test_json_holds_the_present_tags_in_key_order(prepared, number):
    row = prepared[str(number)]
    parsed = json.loads(row["tags_json"])
    assert parsed == {k: v for k, v in row["tags"].items() if v is not None}
    assert list(parsed) == sorted(parsed)


def test_wide_block_numbers_stay(spark):
    wide = 2**63 + 1
    for kind in ("string", "decimal(38,0)"):
        row = label(spark).withColumn("deployment_block", F.lit(str(wide)).cast(kind))
        tagged = with_tags(row).withColumn("json", tags_json())
        assert int(tagged.first()["tags"]["deployment_block"]) == wide
        assert f'"deployment_block":{wide}' in tagged.first()["json"]


def test_block_number_that_is_no_integer_is_left_out(spark):
    row = label(spark).withColumn("deployment_block", F.lit("12.5"))
    assert with_tags(row).first()["tags"]["deployment_block"] is None
    row = label(spark).withColumn("deployment_block", F.lit(" 12"))
    assert with_tags(row).first()["tags"]["deployment_block"] == 12


def test_complete_tags_counts_raw_values(spark):
    row = label(spark, contract_name="  ", deployment_block=0, code_language="rust")
    assert with_complete_tags(row).first()["complete_tags"] == 8
    assert with_tags(row).first()["tag_count"] == 5


@pytest.mark.parametrize(
    ("changes", "reason"),
    [
        ({}, None),
        ({"address": None}, "address"),
        ({"address": ""}, "address"),
        ({"address": "0xABCD"}, "address"),
        ({"address": "0X" + ADDRESS[2:]}, "address"),
        ({"address": ADDRESS + "0"}, "address"),
        ({"chain_id": None}, "chain"),
        ({"address": "0x", "chain_id": None}, "address"),
    ],
)
def test_validation(spark, changes, reason):
    row = validated(with_tags(label(spark, **changes))).first()
    assert (row["valid"], row["invalid_reason"]) == (reason is None, reason)


def test_validation_needs_two_tags(spark):
    row = with_tags(label(spark)).withColumn("tag_count", F.lit(1))
    assert validated(row).first()["invalid_reason"] == "tags"


@pytest.mark.parametrize(("answer", "reason"), [(True, None), (False, "external"), (None, "external")])
def test_external_check(spark, answer, reason):
    row = validated(with_tags(label(spark)), lambda df: F.lit(answer).cast("boolean")).first()
    assert row["invalid_reason"] == reason
    assert row["chain_ref"] == "eip155:10"
