"""Contract-shaped tables derived from the general test tables.

Missing values, orphans, blanks, zero and short addresses are set by a rule on
the key; every source row is kept. A dimension row that is to be an orphan gets
a negative id, which no verified contract refers to.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from tagwright.engine import LabelEngine
from tagwright.functions.columns import with_packed_hex, with_unpacked_hex
from tagwright.functions.tags import TAG_HASHES
from tagwright.operators import ledger
from tagwright.operators.ordering import order_rows
from tagwright.session import write_shared

# Columns of the source tables that the derived ones use, declared so that no
# job has to look into the files for them.
SOURCES = {
    "part": "p_partkey long, p_name string, p_size int",
    "orders": "o_orderkey long, o_custkey long",
    "lineitem": "l_orderkey long, l_partkey long, l_linenumber int, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, event_type string",
    "documents": "doc_id long, text string, n_chars long",
    "labels": "doc_id long, quality int, toxic int",
}

TABLES = ("verified", "deployments", "compilations", "attempts", "results")
VERIFIER = "registry"
BATCH_SIZE = 5_000


class Sample:
    """The derived tables of one scale-factor folder, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def source(self, name: str) -> DataFrame:
        return self.spark.read.schema(SOURCES[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def written(self) -> Sample:
        """The same sample with its derived tables written out first, as they
        would be delivered."""
        stored = Sample(self.spark, self.sf_dir)
        parts = self.spark.sparkContext.defaultParallelism
        for name in TABLES:
            setattr(stored, name, write_shared(getattr(self, name).repartition(parts)))
        return stored

    # -- the three tables ---------------------------------------------------

    @cached_property
    def compilations(self) -> DataFrame:
        return self.source("part").selectExpr(
            "if(p_partkey % 71 = 0, -1 - p_partkey, p_partkey) as id",
            "case p_partkey % 7 when 0 then 'Solidity' when 1 then 'SOLIDITY' when 2 then 'Vyper' "
            "when 3 then 'Yul' when 4 then 'Fe' when 5 then 'Rust' end as language",
            "'solc' as compiler",
            "if(p_partkey % 13 = 0, null, '0.8.' || p_size) as version",
            "case when p_partkey % 17 = 0 then '   ' when p_partkey % 19 = 0 then null "
            "else ' ' || p_name || ' ' end as name",
        )

    @cached_property
    def deployments(self) -> DataFrame:
        return self.source("orders").selectExpr(
            "if(o_orderkey % 53 = 0, -1 - o_orderkey, o_orderkey) as id",
            "if(o_orderkey % 97 = 0, null, o_custkey % 25) as chain_id",
            "case when o_orderkey % 89 = 0 then null "
            "when o_orderkey % 101 = 0 then unhex(repeat('00', 20)) "
            "when o_orderkey % 103 = 0 then unhex('abcd') "
            "else unhex(substr(sha2(cast(o_orderkey as string), 256), 1, 40)) end as address",
            "if(o_orderkey % 7 = 0, null, unhex(sha2('tx' || o_orderkey, 256))) "
            "as transaction_hash",
            "if(o_orderkey % 11 = 0, null, (o_orderkey % 5) * 1000) as block_number",
            "if(o_orderkey % 5 = 0, null, unhex(substr(sha2('d' || o_custkey, 256), 1, 40))) "
            "as deployer",
        )

    @cached_property
    def verified(self) -> DataFrame:
        return (
            self.source("lineitem")
            .groupBy("l_orderkey", "l_linenumber")
            .agg(
                F.min("l_partkey").alias("compilation_id"),
                F.min("l_shipdate").alias("created_at"),
            )
            .select(
                (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
                F.col("l_orderkey").alias("deployment_id"),
                "compilation_id",
                "created_at",
            )
        )

    @cached_property
    def engine(self) -> LabelEngine:
        tables = {
            "verified_contracts": self.verified,
            "contract_deployments": self.deployments,
            "compiled_contracts": self.compilations,
        }
        return LabelEngine(tables, VERIFIER)

    # -- ledger and delivery ------------------------------------------------

    @cached_property
    def attempts(self) -> DataFrame:
        """About three attempts per key; ``seq`` is the write order."""
        keyed = self.deployments.filter("address is not null and chain_id is not null").select(
            "id", "address", "chain_id"
        )
        events = self.source("events").withColumn("id", F.expr("event_id div 3"))
        return events.join(keyed, "id").selectExpr(
            "event_id as seq",
            "'0x' || lower(hex(address)) as address",
            "chain_id",
            "case event_type when 'purchase' then 'success' when 'error' then 'failed' "
            "else 'pending' end as status",
            "ts as attempted_at",
            "if(event_type = 'purchase', '0x' || sha2('a' || event_id, 256), null) as tx_hash",
            "if(event_type = 'error', 'call \"x\", failed', null) as error_message",
            "'{\"is_contract\":true}' as tags_json",
        )

    @cached_property
    def state(self) -> DataFrame:
        return ledger.current_state(self.attempts)

    @cached_property
    def narrow_state(self) -> DataFrame:
        """Latest status and time per key, all that statistics need."""
        return ledger.current_state(self.attempts, details=("status", "attempted_at"))

    @cached_property
    def sent(self) -> DataFrame:
        return ledger.sent_keys_of(self.attempts)

    @property
    def as_of(self):
        """The last attempt, as the moment reports are made."""
        return self.attempts.select(F.max("attempted_at")).scalar()

    @cached_property
    def results(self) -> DataFrame:
        """A delivery result per deployment; some stretches fail more often."""
        failed = "(id % 16 = 3 or (floor(id / 2000) % 3 = 1 and id % 4 = 1))"
        return self.deployments.filter("address is not null and chain_id is not null").selectExpr(
            "'0x' || lower(hex(address)) as address",
            "chain_id",
            f"if({failed}, 'failed', 'success') as status",
            f"if({failed} or id % 23 = 0, null, 'uid-' || id) as uid",
            "cast(null as string) as tx_hash",
            f"if({failed}, 'fee \"low\",' || char(10) || 'retry', null) as error_message",
            "timestamp_ntz'2024-02-01 00:00:00' as reported_at",
            "id as seq",
        )

    # -- label relations ----------------------------------------------------

    @cached_property
    def labels(self) -> DataFrame:
        return self.engine.labels()

    @cached_property
    def delivery(self) -> DataFrame:
        """Labels with verdict, sent flag and delivery result."""
        return self.engine.prepared(self.engine.labels_with_delivery(self.sent, self.results))

    def batches(self, rows: DataFrame, *columns: str) -> DataFrame:
        """Ids and the named columns of the rows, with their batch. The id is
        unique, so it orders the rows by itself. Addresses and hashes are sorted
        and written as the bytes they stand for."""
        row_id = "verified_contract_id"
        hexes = [c for c in ("address",) if c in columns]
        hexes += [f"tags.{tag}" for tag in TAG_HASHES if "tags" in columns]
        packed = with_packed_hex(rows.select(row_id, *columns), hexes)
        return with_unpacked_hex(order_rows(packed, [row_id]).with_batch(BATCH_SIZE), hexes)

    def delivery_batches(self, *columns: str) -> DataFrame:
        return self.batches(self.delivery, *columns)

    # -- file sets ------------------------------------------------------------

    @cached_property
    def wanted_files(self) -> DataFrame:
        """One wanted file per document, with its expected size."""
        return self.source("documents").selectExpr(
            "case doc_id % 4 when 0 then 'verified_contracts' when 1 then 'contract_deployments' "
            "when 2 then 'compiled_contracts' else 'sources' end as table_name",
            "'part_' || doc_id || '.parquet' as file_name",
            "n_chars as expected_length",
            "doc_id",
        )

    @cached_property
    def listing(self) -> DataFrame:
        """Documents with a label are there: empty if toxic, cut if of low quality."""
        return self.wanted_files.join(self.source("labels"), "doc_id").selectExpr(
            "table_name",
            "file_name",
            "table_name || '/' || file_name as path",
            "case when toxic = 1 then 0 when quality = 1 then expected_length "
            "else expected_length - 1 end as length",
        )

    @cached_property
    def manifests(self) -> DataFrame:
        """One export manifest per document: two files of one table, one or none
        of another, none of the third, and a table nobody asked for."""
        return self.source("documents").selectExpr(
            "'export-' || doc_id as dateStr",
            "map('verified_contracts', array("
            "'verified_contracts/' || doc_id || '_0.parquet', "
            "'verified_contracts/' || doc_id || '_1.parquet'), "
            "'contract_deployments', if(n_chars % 2 = 0, array(), array("
            "'contract_deployments/' || doc_id || '.parquet')), "
            "'sources', array('sources/' || doc_id || '.parquet')) as files",
        )
