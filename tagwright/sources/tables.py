"""The three input tables: schemas, loading, views, required files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

REQUIRED_TABLES = ("verified_contracts", "contract_deployments", "compiled_contracts")


def table_schemas(
    id_type: T.DataType | None = None, block_type: T.DataType | None = None
) -> dict[str, T.StructType]:
    """Declared schemas. Ids are text unless said otherwise; parquet UUID columns
    need ``BinaryType``, and wide block numbers ``DecimalType(38, 0)``."""
    ident = id_type or T.StringType()
    return {
        "verified_contracts": T.StructType()
        .add("id", ident)
        .add("deployment_id", ident)
        .add("compilation_id", ident)
        .add("created_at", T.TimestampNTZType()),
        "contract_deployments": T.StructType()
        .add("id", ident)
        .add("chain_id", T.LongType())
        .add("address", T.BinaryType())
        .add("transaction_hash", T.BinaryType())
        .add("block_number", block_type or T.LongType())
        .add("deployer", T.BinaryType()),
        "compiled_contracts": T.StructType()
        .add("id", ident)
        .add("language", T.StringType())
        .add("compiler", T.StringType())
        .add("version", T.StringType())
        .add("name", T.StringType()),
    }


def load_table(
    spark: SparkSession, data_dir: str, name: str, schema: T.StructType | None = None
) -> DataFrame:
    """All parquet files of one table folder. Without a schema it is read from
    the files."""
    reader = spark.read.option("pathGlobFilter", "*.parquet")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(f"{data_dir.rstrip('/')}/{name}")


def load_tables(
    spark: SparkSession, data_dir: str, schemas: dict[str, T.StructType] | None = None
) -> dict[str, DataFrame]:
    schemas = table_schemas() if schemas is None else schemas
    return {name: load_table(spark, data_dir, name, schemas.get(name)) for name in REQUIRED_TABLES}


def create_views(tables: dict[str, DataFrame]) -> None:
    """Register (or replace) one temporary view per table."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
