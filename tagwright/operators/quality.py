"""Quality checks on label rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

ADDRESS_PATTERN = "^0x[0-9a-fA-F]{40}$"
MIN_VALID_SHARE = 0.95

REQUIRED_LABEL_COLUMNS = (
    "address",
    "chain_id",
    "source_code_verified",
    "is_contract",
    "code_language",
    "code_compiler",
    "deployment_block",
    "deployment_tx",
    "deployer_address",
    "contract_name",
)


def missing_columns(df: DataFrame, required: Sequence[str] = REQUIRED_LABEL_COLUMNS) -> list[str]:
    present = set(df.columns)
    return [c for c in required if c not in present]


def null_counts(
    labels: DataFrame, columns: Sequence[str] = ("address", "chain_id", "code_language")
) -> DataFrame:
    """Rows, and per column the NULLs and the percentage present."""
    n = F.count(F.lit(1))
    checks = []
    for c in columns:
        nulls = F.count_if(F.col(c).isNull())
        share = (F.lit(1.0) - nulls.cast("double") / n.cast("double")) * F.lit(100.0)
        checks += [nulls.alias(f"null_{c}"), F.when(n > 0, share).alias(f"{c}_pct")]
    return labels.agg(n.alias("n_rows"), *checks)


def address_pattern(labels: DataFrame) -> DataFrame:
    """Well-formed addresses, with a warning below 95 %."""
    counted = labels.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("address").rlike(ADDRESS_PATTERN)).alias("n_valid"),
    )
    rows = F.col("n_rows").cast("double")
    return counted.select(
        "*",
        F.when(F.col("n_rows") > 0, F.col("n_valid").cast("double") / rows * F.lit(100.0)).alias(
            "valid_pct"
        ),
        (F.col("n_valid") < rows * MIN_VALID_SHARE).alias("low_share"),
    )


def duplicate_addresses(batches: DataFrame, by: Sequence[str] = ("batch_id",)) -> DataFrame:
    """Rows per batch that repeat an address; missing addresses count as one
    value. Counts per (batch, address) come first, so copies of one address are
    combined before the shuffle."""
    per_address = batches.groupBy(*by, "address").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_address.groupBy(*by)
        .agg(
            F.sum("n").alias("n_rows"),
            F.sum(F.col("n") - 1).alias("n_duplicates"),
        )
        .withColumn("has_duplicates", F.col("n_duplicates") > 0)
    )
