"""Small hand-made star tables and a plain-Python view of what they mean."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tagwright.sources.tables import table_schemas

DAY = dt.datetime(2024, 1, 1, 12, 0, 0)
ZERO = bytes(20)


def address(n: int) -> bytes:
    return bytes([n]) * 20


def tx(n: int) -> bytes:
    return bytes([n]) * 32


# (id, deployment_id, compilation_id, created_at)
VERIFIED = [
    ("v01", "d1", "c1", DAY),
    ("v02", "d1", "c2", DAY),  # same key as v01
    ("v03", "d2", "c1", DAY),
    ("v04", "d3", "c1", DAY),  # no chain
    ("v05", "d4", "c1", DAY),  # no address
    ("v06", "d5", "c1", DAY),  # zero address
    ("v07", "d6", "c3", DAY),  # no language
    ("v08", "d6", "c4", DAY),  # no version: no compiler text
    ("v09", "gone", "c1", DAY),
    ("v10", "d2", "gone", DAY),
    ("v11", None, "c1", DAY),
    ("v12", "d2", None, DAY),
    ("v13", "d7", "c1", DAY),  # short address
]

# (id, chain_id, address, transaction_hash, block_number, deployer)
DEPLOYMENTS = [
    ("d1", 1, address(0xAB), tx(1), 100, address(9)),
    ("d2", 10, address(0xCD), None, 0, None),
    ("d3", None, address(3), tx(3), 3, None),
    ("d4", 1, None, tx(4), 4, address(9)),
    ("d5", 1, ZERO, tx(5), 5, address(9)),
    ("d6", 1, address(6), tx(6), 6, address(9)),
    ("d7", 1, b"\xab\xcd", tx(7), 7, address(9)),
    ("d8", 1, address(8), tx(8), 8, address(9)),
]

# (id, language, compiler, version, name)
COMPILATIONS = [
    ("c1", "Solidity", "solc", "0.8.1", " Token "),
    ("c2", "VYPER", "vyper", "0.3", "  "),
    ("c3", None, "solc", "0.8.2", "NoLanguage"),
    ("c4", "Rust", "rustc", None, None),
]


class Star:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.schemas = table_schemas()

    def table(self, name: str, rows) -> DataFrame:
        return self.spark.createDataFrame(rows, self.schemas[name])

    def verified(self, rows=VERIFIED) -> DataFrame:
        return self.table("verified_contracts", rows)

    def deployments(self, rows=DEPLOYMENTS) -> DataFrame:
        return self.table("contract_deployments", rows)

    def compilations(self, rows=COMPILATIONS) -> DataFrame:
        return self.table("compiled_contracts", rows)

    def tables(self) -> dict[str, DataFrame]:
        return {
            "verified_contracts": self.verified(),
            "contract_deployments": self.deployments(),
            "compiled_contracts": self.compilations(),
        }

    def write(self, root: str) -> None:
        for name, df in self.tables().items():
            df.coalesce(1).write.mode("append").parquet(f"{root}/{name}")


def hex_text(raw: bytes | None) -> str | None:
    return None if raw is None else "0x" + raw.hex().upper()


def expected_labels(
    verified=VERIFIED, deployments=DEPLOYMENTS, compilations=COMPILATIONS, drop_zero=True
) -> list[dict]:
    """Brute force over all combinations."""
    out = []
    for vid, did, cid, created in verified:
        for d_id, chain, addr, txh, block, deployer in deployments:
            if did is None or d_id != did or chain is None or addr is None:
                continue
            if drop_zero and addr == ZERO:
                continue
            for c_id, language, compiler, version, name in compilations:
                if cid is None or c_id != cid or language is None:
                    continue
                out.append(
                    {
                        "verified_contract_id": vid,
                        "source_code_verified": "registry",
                        "is_contract": True,
                        "chain_id": chain,
                        "address": hex_text(addr),
                        "deployment_tx": hex_text(txh),
                        "deployment_block": block,
                        "deployer_address": hex_text(deployer),
                        "code_language": language.lower(),
                        "code_compiler": None if version is None else f"{compiler}-{version}",
                        "verified_at": created,
                        "contract_name": name,
                    }
                )
    return out


def as_dicts(df: DataFrame) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]


def in_order(rows: list[dict]) -> list[dict]:
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r.values()))
