"""Tag preparation and label validation as native columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tagwright.functions.columns import chain_ref, is_address, is_tx_hash, stripped

# Languages the label registry accepts; others carry no language tag.
LANGUAGES = ("solidity", "vyper", "yul", "fe", "huff")

# The eight tags, in the key order of the JSON form.
TAGS = (
    "code_compiler",
    "code_language",
    "contract_name",
    "deployer_address",
    "deployment_block",
    "deployment_tx",
    "is_contract",
    "source_code_verified",
)

# Those of them that are hex text.
TAG_HASHES = ("deployer_address", "deployment_tx")

MIN_TAGS = 2


def block_number(kind: T.DataType) -> Column:
    """The deployment block as a whole number. Whole-number columns keep their
    type, so that none is too wide; text that is no whole number is NULL."""
    block = F.col("deployment_block")
    if isinstance(kind, T.IntegralType) or isinstance(kind, T.DecimalType) and kind.scale == 0:
        return block
    if isinstance(kind, T.StringType):
        text = stripped(block)
        return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("decimal(38,0)"))
    return block.try_cast("bigint")


def tag_struct(block_kind: T.DataType) -> Column:
    """Struct of the tags of a label row, whose block is of type ``block_kind``. A
    tag that is missing, malformed or empty is NULL, which means: not part of the
    tag set."""
    language = F.lower("code_language")
    block = block_number(block_kind)
    name = stripped(F.col("contract_name"))
    values = {
        "source_code_verified": F.col("source_code_verified"),
        "is_contract": F.lit(True),
        "code_language": F.when(language.isin(*LANGUAGES), language),
        "code_compiler": F.when(F.col("code_compiler") != "", F.col("code_compiler")),
        "deployment_block": F.when(block != 0, block),
        "deployment_tx": F.when(is_tx_hash(F.col("deployment_tx")), F.col("deployment_tx")),
        "deployer_address": F.when(
            is_address(F.col("deployer_address")), F.col("deployer_address")
        ),
        "contract_name": F.when(name != "", name),
    }
    return F.struct(*[values[tag].alias(tag) for tag in TAGS])


def raw_tag_struct() -> Column:
    """The eight values as they stand in the label row, unchecked (preview)."""
    return F.struct(*[F.col(tag).alias(tag) for tag in TAGS])


def count_present(columns: list[Column]) -> Column:
    return sum((c.isNotNull().cast("int") for c in columns), F.lit(0))


def with_tags(labels: DataFrame) -> DataFrame:
    """Label rows with ``tags`` and ``tag_count``."""
    return labels.withColumn("tags", tag_struct(labels.schema["deployment_block"].dataType)).withColumn(
        "tag_count", count_present([F.col(f"tags.{tag}") for tag in TAGS])
    )


def with_complete_tags(labels: DataFrame) -> DataFrame:
    """Label rows with the number of filled raw values, out of eight."""
    return labels.withColumn("complete_tags", count_present([F.col(tag) for tag in TAGS]))


def tags_json(tags: str = "tags") -> Column:
    """JSON object with sorted keys; absent tags are left out."""
    return F.to_json(F.col(tags))


def validated(
    tagged: DataFrame, extra_check: Callable[[DataFrame], Column] | None = None
) -> DataFrame:
    """Add ``chain_ref``, ``valid`` and ``invalid_reason`` (first failing rule).

    ``extra_check`` builds a boolean column from the tagged rows; anything but
    true fails the label, as a rejected external check does.
    """
    checked = tagged.withColumn("chain_ref", chain_ref(F.col("chain_id")))
    reason = (
        F.when(~is_address(F.col("address")), "address")
        .when(F.col("chain_ref").isNull(), "chain")
        .when(F.col("tag_count") < MIN_TAGS, "tags")
    )
    if extra_check is not None:
        reason = reason.when(~F.coalesce(extra_check(checked), F.lit(False)), "external")
    return checked.withColumn("invalid_reason", reason).withColumn(
        "valid", F.col("invalid_reason").isNull()
    )
