"""The three-way join and the label rows built from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tagwright.functions.columns import packed_hex, prefixed_hex, unpacked_hex
from tagwright.functions.tags import TAG_HASHES, raw_tag_struct
from tagwright.operators.ordering import order_rows
from tagwright.operators.spread import HotKeys, spread_join

ZERO_ADDRESS = bytes(20)

# Join keys of the fact table, watched for hot values.
FACT_KEYS = ("deployment_id", "compilation_id")

LABEL_COLUMNS = (
    "verified_contract_id",
    "source_code_verified",
    "is_contract",
    "chain_id",
    "address",
    "deployment_tx",
    "deployment_block",
    "deployer_address",
    "code_language",
    "code_compiler",
    "verified_at",
    "contract_name",
)

# Total order of label rows: the id decides, the rest only breaks ties between
# rows of one id, which exist when a dimension repeats an id.
LABEL_ORDER = ("verified_contract_id", "chain_id", "address", "code_compiler", "contract_name")


def located_deployments(deployments: DataFrame, drop_zero_address: bool = True) -> DataFrame:
    """Deployments a label can be made of: chain and address known and, unless
    switched off, not at the zero address."""
    kept = deployments.filter(F.col("chain_id").isNotNull() & F.col("address").isNotNull())
    if drop_zero_address:
        kept = kept.filter(F.col("address") != F.lit(bytearray(ZERO_ADDRESS)))
    return kept


def joined(
    verified: DataFrame,
    deployments: DataFrame,
    compilations: DataFrame,
    *,
    drop_zero_address: bool = True,
    carry: Sequence[str] = (),
    hot: HotKeys | None = None,
) -> DataFrame:
    """Verified contracts with their deployment and compilation.

    Both dimensions are filtered and pruned before their join. Compilations come
    first: their columns are few and short, while addresses and hashes do not
    compress and are shuffled once per deployment, not again with every row.
    Rows of one deployment leave the join side by side. ``carry`` names
    further deployment columns to pass through; ``hot`` are the hot values of
    the fact table's keys (``find_hot_keys``); without them skew is left to AQE.
    """
    fact = verified.select("id", "deployment_id", "compilation_id", "created_at")
    deployed = located_deployments(deployments, drop_zero_address).select(
        F.col("id").alias("deployment_id"),
        "chain_id",
        "address",
        "transaction_hash",
        "block_number",
        "deployer",
        *carry,
    )
    compiled = compilations.filter(F.col("language").isNotNull()).select(
        F.col("id").alias("compilation_id"), "language", "compiler", "version", "name"
    )
    spread = {"hot": hot or {}, "spread_by": ["id"]}
    with_compilation = spread_join(fact, compiled, ["compilation_id"], **spread)
    return spread_join(with_compilation, deployed, ["deployment_id"], **spread)


def label_rows(
    verified: DataFrame,
    deployments: DataFrame,
    compilations: DataFrame,
    verifier: str,
    *,
    drop_zero_address: bool = True,
    carry: Sequence[str] = (),
    hot: HotKeys | None = None,
) -> DataFrame:
    """One label per verified contract. ``verifier`` is the value of the
    ``source_code_verified`` tag."""
    rows = joined(
        verified,
        deployments,
        compilations,
        drop_zero_address=drop_zero_address,
        carry=carry,
        hot=hot,
    )
    return rows.select(
        F.col("id").alias("verified_contract_id"),
        F.lit(verifier).alias("source_code_verified"),
        F.lit(True).alias("is_contract"),
        "chain_id",
        prefixed_hex(F.col("address")).alias("address"),
        prefixed_hex(F.col("transaction_hash")).alias("deployment_tx"),
        F.col("block_number").alias("deployment_block"),
        prefixed_hex(F.col("deployer")).alias("deployer_address"),
        F.lower("language").alias("code_language"),
        F.concat("compiler", F.lit("-"), "version").alias("code_compiler"),
        F.col("created_at").alias("verified_at"),
        F.col("name").alias("contract_name"),
        *carry,
    )


def one_per_key(labels: DataFrame) -> DataFrame:
    """The label with the lowest id for each (address, chain), case ignored.

    ``min_by`` combines on the map side, so a key with very many labels is one
    row per task when it is shuffled. Run it on valid labels only: an invalid
    one must not hide a valid one. All columns are carried, so select those that
    are needed before; of ``LABEL_ORDER``, the columns that are there decide.

    Addresses and hashes travel as the bytes they stand for, the address in the
    key alone; one that is written otherwise than in upper case goes along.
    """
    lower = F.lower("address")
    digits = F.unhex(F.substr(lower, F.lit(3)))
    is_hex = F.lower(prefixed_hex(digits)) == lower
    shown = F.coalesce(prefixed_hex(F.col("_bytes")), F.col("_text"))
    keyed = labels.withColumn("_bytes", F.when(is_hex, digits)).withColumn(
        "_text", F.when(is_hex, None).otherwise(lower)
    )
    address = F.col("address")
    # Where an address sorts against the usual way to write its key.
    side = F.when(address < shown, -1).when(address > shown, 1).otherwise(0)
    unusual = F.when(address == shown, None).otherwise(address)
    hashes = [c for c in TAG_HASHES if c in labels.columns]
    values = {c: packed_hex(F.col(c)) if c in hashes else F.col(c) for c in labels.columns}
    values["address"] = unusual
    order = {c: F.struct(side, unusual) if c == "address" else F.col(c) for c in LABEL_ORDER}
    row = F.struct(*[v.alias(c) for c, v in values.items() if c != "chain_id"])
    first = F.min_by(row, F.struct(*[v for c, v in order.items() if c in labels.columns and c != "chain_id"]))
    found = keyed.groupBy("_bytes", "_text", "chain_id").agg(first.alias("_row"))
    back = {c: unpacked_hex(F.col(f"_row.{c}")) if c in hashes else F.col(f"_row.{c}") for c in values}
    back |= {"address": F.coalesce("_row.address", shown), "chain_id": F.col("chain_id")}
    return found.select(*[v.alias(c) for c, v in back.items()])


def label_page(labels: DataFrame, limit: int, offset: int = 0) -> DataFrame:
    """``limit`` labels in id order after skipping ``offset``.

    A top-k: every task keeps offset + limit rows. For pages far down, or many of
    them, take ``deep_label_page`` or a stored order.
    """
    return labels.orderBy(*LABEL_ORDER).offset(offset).limit(limit)


def deep_label_page(labels: DataFrame, limit: int, offset: int) -> DataFrame:
    """The same page, found by position in a range-ordered table of the ids, which
    is written first; then only the labels between its first and last id are built
    and put in order. For many pages, store whole labels (``order_rows``)."""
    row_id = LABEL_ORDER[0]
    ordered = order_rows(labels.select(row_id), [row_id])
    ids = ordered.page(limit, offset)
    first, last, rows, missing = ids.agg(
        F.min(row_id), F.max(row_id), F.count(F.lit(1)), F.count_if(F.col(row_id).isNull())
    ).first()
    if rows == 0:
        return labels.filter(F.lit(False))
    here, none = F.col(row_id), F.lit(False)
    known = here.between(F.lit(first), F.lit(last)) if first is not None else none
    wanted = known | here.isNull() if missing else known
    earlier = here.isNotNull() if first is None else here < F.lit(first)
    skipped = ordered.rows.filter(earlier).count()
    return labels.filter(wanted).orderBy(*[F.col(c).asc_nulls_last() for c in LABEL_ORDER]).offset(
        offset - skipped
    ).limit(rows)


def preview(labels: DataFrame, limit: int = 5) -> DataFrame:
    """One row: ``sample_count`` and ``contracts``, the first ``limit`` labels as
    nested records. Bounded by ``limit``, which is a display size."""
    sample = labels.orderBy(*LABEL_ORDER).limit(limit)
    contract = F.struct(
        "verified_contract_id",
        "address",
        "chain_id",
        "contract_name",
        F.col("verified_at").cast("string").alias("verified_at"),
        raw_tag_struct().alias("tags"),
    )
    return sample.agg(
        F.count(F.lit(1)).alias("sample_count"),
        F.sort_array(F.collect_list(contract)).alias("contracts"),
    )
