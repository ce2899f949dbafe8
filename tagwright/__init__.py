"""Contract label engine on Spark: joins verified-contract tables into labels,
prepares and validates their tags, tracks delivery in an attempt ledger and
writes resumable batches."""

from tagwright.engine import LabelEngine

__all__ = ["LabelEngine"]
