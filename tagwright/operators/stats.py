"""Counts, distributions and completeness of the three tables and of labels.

The counting jobs aggregate the fact table by its join key first and join the
counts: the aggregation combines on the map side, so a key with a third of all
rows costs one row per task, and its shuffle is the one the join needs anyway.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tagwright.functions.columns import percentage
from tagwright.operators.spread import HotKeys, spread_join

# Shares below which a check warns.
JOIN_HEALTH_SHARE = 0.8
TOP_CHAINS = 20
LABEL_SET_TOP_CHAINS = 10

COMPLETENESS_PARTS = (
    "with_deployment_tx",
    "with_deployment_block",
    "with_deployer_address",
    "with_code_language",
    "with_code_compiler",
)


def _one_if(condition: Column) -> Column:
    return condition.cast("long")


# -- tables ---------------------------------------------------------------


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: ``table_name``, ``n_rows``, ``is_empty``."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts).withColumn("is_empty", F.col("n_rows") == 0)


def chain_distribution(
    verified: DataFrame, deployments: DataFrame, limit: int = TOP_CHAINS
) -> DataFrame:
    """Verified contracts per chain, the ``limit`` largest chains."""
    per_deployment = verified.groupBy("deployment_id").agg(F.count(F.lit(1)).alias("n"))
    chains = deployments.filter(F.col("chain_id").isNotNull()).select(
        F.col("id").alias("deployment_id"), "chain_id"
    )
    return (
        per_deployment.join(chains, "deployment_id")
        .groupBy("chain_id")
        .agg(F.sum("n").alias("contract_count"))
        .orderBy(F.desc("contract_count"), "chain_id")
        .limit(limit)
    )


def language_distribution(verified: DataFrame, compilations: DataFrame) -> DataFrame:
    """Verified contracts per language, case ignored, largest first."""
    per_compilation = verified.groupBy("compilation_id").agg(F.count(F.lit(1)).alias("n"))
    languages = compilations.filter(F.col("language").isNotNull()).select(
        F.col("id").alias("compilation_id"), F.lower("language").alias("language")
    )
    return (
        per_compilation.join(languages, "compilation_id")
        .groupBy("language")
        .agg(F.sum("n").alias("contract_count"))
        .orderBy(F.desc("contract_count"), "language")
    )


# -- joins ----------------------------------------------------------------


def match_totals(
    verified: DataFrame,
    deployments: DataFrame,
    compilations: DataFrame,
    hot: HotKeys | None = None,
) -> DataFrame:
    """All join and completeness counts in one row and one scan of each table.

    Flags are summed per deployment, those sums per compilation, and then
    weighted by how many rows of the compilation qualify. Repeated dimension ids
    therefore count as often as a plain join would return them.
    """
    located = F.col("address").isNotNull()
    flags = (
        deployments.filter(F.col("chain_id").isNotNull())
        .groupBy(F.col("id").alias("deployment_id"))
        .agg(
            F.count(F.lit(1)).alias("n_deployed"),
            F.count_if(located).alias("n_located"),
            F.count_if(located & F.col("transaction_hash").isNotNull()).alias("n_tx"),
            F.count_if(located & F.col("block_number").isNotNull()).alias("n_block"),
            F.count_if(located & F.col("deployer").isNotNull()).alias("n_deployer"),
        )
    )
    sums = flags.columns[1:]
    per_compilation = (
        spread_join(
            verified.select("id", "deployment_id", "compilation_id"),
            flags,
            ["deployment_id"],
            "left",
            hot=hot or {},
            spread_by=["id"],
        )
        .groupBy("compilation_id")
        .agg(
            F.count(F.lit(1)).alias("n_verified"),
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums],
        )
    )
    weights = compilations.groupBy(F.col("id").alias("compilation_id")).agg(
        F.count(F.lit(1)).alias("k_rows"),
        F.count("language").alias("k_language"),
        F.count(F.when(F.col("language").isNotNull(), F.col("version"))).alias("k_version"),
    )

    def total(count: str, weight: str | None = None) -> Column:
        value = F.col(count) if weight is None else F.col(count) * F.col(weight)
        return F.coalesce(F.sum(value), F.lit(0)).cast("long")

    return per_compilation.join(weights, "compilation_id", "left").agg(
        total("n_deployed").alias("vc_to_deployments"),
        total("n_verified", "k_language").alias("vc_to_compiled"),
        total("n_located", "k_language").alias("full_join"),
        total("n_located", "k_rows").alias("total_contracts"),
        total("n_tx", "k_rows").alias("with_deployment_tx"),
        total("n_block", "k_rows").alias("with_deployment_block"),
        total("n_deployer", "k_rows").alias("with_deployer_address"),
        total("n_located", "k_language").alias("with_code_language"),
        total("n_located", "k_version").alias("with_code_compiler"),
    )


def join_match_counts(totals: DataFrame) -> DataFrame:
    return totals.select("vc_to_deployments", "vc_to_compiled", "full_join")


def join_health(totals: DataFrame) -> DataFrame:
    """No three-way match fails; fewer than 80 % of the smaller two-way count warns."""
    smaller = F.least("vc_to_deployments", "vc_to_compiled").cast("double")
    return join_match_counts(totals).select(
        "*",
        (F.col("full_join") == 0).alias("no_match"),
        (F.col("full_join") < smaller * JOIN_HEALTH_SHARE).alias("low_match"),
    )


def completeness(totals: DataFrame) -> DataFrame:
    """Count and percentage of labels with each optional part."""
    shares = []
    for part in COMPLETENESS_PARTS:
        shares += [part, percentage(F.col(part), F.col("total_contracts")).alias(f"{part}_pct")]
    return totals.select("total_contracts", *shares)


def run_estimate(
    totals: DataFrame, ledger_stats: DataFrame, batch_size: int, delay_seconds: float
) -> DataFrame:
    """What is left to do and how long the pauses between batches will take."""
    counts = totals.select(
        F.col("full_join").alias("total_contracts"),
        ledger_stats.select("successful").scalar().alias("successful"),
    )
    return estimated(
        counts.withColumn("remaining", F.col("total_contracts") - F.col("successful")),
        batch_size,
        delay_seconds,
    )


def estimated(remaining: DataFrame, batch_size: int, delay_seconds: float) -> DataFrame:
    batches = F.ceil(F.col("remaining") / F.lit(batch_size)).cast("long")
    return remaining.withColumn("estimated_batches", batches).withColumn(
        "estimated_hours",
        F.col("estimated_batches").cast("double") * F.lit(float(delay_seconds)) / F.lit(3600.0),
    )


# -- label sets -----------------------------------------------------------


def label_set_stats(labels: DataFrame) -> DataFrame:
    """Size, distinct chains and filled optional columns of a label set."""
    return labels.agg(
        F.count(F.lit(1)).alias("total_contracts"),
        F.count_distinct("chain_id").alias("unique_chains"),
        F.count("deployment_tx").alias("contracts_with_deployment_tx"),
        F.count("deployment_block").alias("contracts_with_deployment_block"),
        F.count("deployer_address").alias("contracts_with_deployer"),
        F.count("code_language").alias("contracts_with_language"),
        F.count("code_compiler").alias("contracts_with_compiler"),
    )


def _value_counts(labels: DataFrame, column: str) -> DataFrame:
    return (
        labels.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("contract_count"))
        .orderBy(F.desc("contract_count"), column)
    )


def label_set_chains(labels: DataFrame, limit: int = LABEL_SET_TOP_CHAINS) -> DataFrame:
    return _value_counts(labels, "chain_id").limit(limit)


def label_set_languages(labels: DataFrame) -> DataFrame:
    return _value_counts(labels, "code_language")


def complete_tag_distribution(labels: DataFrame, column: str) -> DataFrame:
    """Labels per number of filled tags."""
    return labels.groupBy(column).agg(F.count(F.lit(1)).alias("n_labels"))
