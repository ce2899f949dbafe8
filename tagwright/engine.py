"""The engine as one object over the three tables of a data folder."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, types as T

from tagwright.functions.tags import tags_json, validated, with_tags
from tagwright.operators import labels as label_ops
from tagwright.operators import ledger, quality, stats
from tagwright.operators.ordering import OrderedRows, order_rows
from tagwright.operators.spread import HotKeys, find_hot_keys
from tagwright.sources import files
from tagwright.sources.tables import create_views, load_tables


class LabelEngine:
    """Every report and label relation, each as a lazy DataFrame.

    ``verifier`` is the value of the ``source_code_verified`` tag. Skewed keys are
    left to AQE unless ``rows_per_slot`` is given: then the keys of the fact table
    and the addresses are counted once, and one with more rows is spread over
    tasks of about that many.
    """

    def __init__(
        self,
        tables: dict[str, DataFrame],
        verifier: str,
        drop_zero_address: bool = True,
        rows_per_slot: int | None = None,
    ):
        self.rows_per_slot = rows_per_slot
        self.tables = tables
        self.verifier = verifier
        self.drop_zero_address = drop_zero_address
        self.verified = tables["verified_contracts"]
        self.deployments = tables["contract_deployments"]
        self.compilations = tables["compiled_contracts"]

    @classmethod
    def open(
        cls,
        spark: SparkSession,
        data_dir: str,
        verifier: str,
        schemas: dict[str, T.StructType] | None = None,
        **options,
    ) -> LabelEngine:
        """Check that every table has files, then load them."""
        files.check_required(files.file_listing(spark, data_dir))
        return cls(load_tables(spark, data_dir, schemas), verifier, **options)

    def create_views(self) -> None:
        create_views(self.tables)

    # -- hot keys, looked up once for all reports of this engine ---------------

    @cached_property
    def hot_fact_keys(self) -> HotKeys:
        return self._hot(self.verified, label_ops.FACT_KEYS)

    @cached_property
    def hot_addresses(self) -> HotKeys:
        return self._hot(self.deployments, ["address"])

    def _hot(self, rows: DataFrame, keys: Sequence[str]) -> HotKeys:
        return {} if self.rows_per_slot is None else find_hot_keys(rows, keys, self.rows_per_slot)

    # -- reports ------------------------------------------------------------

    def table_counts(self) -> DataFrame:
        return stats.table_counts(self.tables)

    def match_totals(self) -> DataFrame:
        return stats.match_totals(
            self.verified, self.deployments, self.compilations, self.hot_fact_keys
        )

    def join_match_counts(self) -> DataFrame:
        return stats.join_match_counts(self.match_totals())

    def join_health(self) -> DataFrame:
        return stats.join_health(self.match_totals())

    def completeness(self) -> DataFrame:
        return stats.completeness(self.match_totals())

    def chain_distribution(self, limit: int = stats.TOP_CHAINS) -> DataFrame:
        return stats.chain_distribution(self.verified, self.deployments, limit)

    def language_distribution(self) -> DataFrame:
        return stats.language_distribution(self.verified, self.compilations)

    def run_estimate(
        self, state: DataFrame, as_of, batch_size: int = 1_000, delay_seconds: float = 1.0
    ) -> DataFrame:
        totals = ledger.ledger_stats(state, as_of)
        return stats.run_estimate(self.match_totals(), totals, batch_size, delay_seconds)

    # -- labels -------------------------------------------------------------

    def labels(self, deployments: DataFrame | None = None, carry=()) -> DataFrame:
        return label_ops.label_rows(
            self.verified,
            self.deployments if deployments is None else deployments,
            self.compilations,
            self.verifier,
            drop_zero_address=self.drop_zero_address,
            carry=carry,
            hot=self.hot_fact_keys,
        )

    def unsent_labels(self, sent: DataFrame) -> DataFrame:
        return self.labels(ledger.unsent_deployments(self.deployments, sent, self.hot_addresses))

    def already_sent_labels(self, sent: DataFrame) -> DataFrame:
        return self.labels(ledger.sent_deployments(self.deployments, sent, self.hot_addresses))

    def labels_with_delivery(self, sent: DataFrame, results: DataFrame) -> DataFrame:
        deployed = ledger.deployments_with_delivery(
            self.deployments, sent, results, self.hot_addresses
        )
        return self.labels(deployed, carry=ledger.DELIVERY_COLUMNS)

    def page(self, limit: int = 100_000, offset: int = 0) -> DataFrame:
        return label_ops.label_page(self.labels(), limit, offset)

    def preview(self, limit: int = 5) -> DataFrame:
        return label_ops.preview(self.labels(), limit)

    def ordered(self, path: str | None = None) -> OrderedRows:
        """All labels in id order, computed and written once."""
        return order_rows(self.labels(), label_ops.LABEL_ORDER, path)

    def batches(
        self, batch_size: int = 100_000, start_offset: int = 0, path: str | None = None
    ) -> Iterator[DataFrame]:
        """One DataFrame per batch, read from the ordered table; the three tables
        are joined once, not once per batch."""
        ordered = self.ordered(path)
        for offset in range(start_offset, ordered.total, batch_size):
            yield ordered.page(batch_size, offset)

    def prepared(self, labels: DataFrame | None = None, extra_check=None) -> DataFrame:
        """Labels with tags, their JSON form and the validation verdict."""
        rows = self.labels() if labels is None else labels
        return validated(with_tags(rows), extra_check).withColumn("tags_json", tags_json())

    def quality(self) -> dict[str, DataFrame]:
        rows = self.labels()
        return {
            "null_counts": quality.null_counts(rows),
            "address_pattern": quality.address_pattern(rows),
        }
