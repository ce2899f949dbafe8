"""File sets: listings, export manifests, reconciliation, sizes, digests.

A listing has ``table_name, file_name, path, length``; manifest files have
``date_str, table_name, path, file_name``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tagwright.functions.columns import file_name, folder_name, megabytes
from tagwright.session import qualified
from tagwright.sources.tables import REQUIRED_TABLES

MANIFEST_SCHEMA = (
    T.StructType()
    .add("dateStr", T.StringType())
    .add("files", T.MapType(T.StringType(), T.ArrayType(T.StringType())))
)


def _files(spark: SparkSession, data_dir: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(data_dir)
    )


def _plain(path: str) -> str:
    """A path as the scan shows it: no slashes for a host that is not there."""
    return path.replace(":///", ":/", 1)


def _in_table_folder(spark: SparkSession, data_dir: str) -> Column:
    """Files directly inside a folder of ``data_dir``, told by their full names:
    folders of the same name further down do not count."""
    root = _plain(qualified(spark, data_dir)).rstrip("/") + "/"
    below = F.substr("path", F.lit(len(root) + 1))
    return F.col("path").startswith(root) & (F.size(F.split(below, "/")) == 2)


def file_listing(spark: SparkSession, data_dir: str) -> DataFrame:
    """Parquet files below ``data_dir``, one folder per table, empty ones too.

    Sizes come from a scan that never opens a file. Such a scan leaves empty
    files out, so the names come from the file index and a name without a size
    has zero bytes. The driver holds those names anyway: Spark keeps the file
    index of a folder there.
    """
    files = _files(spark, data_dir)
    names = spark.createDataFrame([(_plain(unquote(p)),) for p in files.inputFiles()], "path string")
    listed = names.filter(_in_table_folder(spark, data_dir))
    sizes = files.select("path", "length")
    sized = listed.join(sizes, "path", "left").fillna(0, ["length"])
    return as_listing(sized)


def as_listing(files: DataFrame) -> DataFrame:
    """Listing columns from ``path`` and ``length``."""
    return files.select(
        folder_name(F.col("path")).alias("table_name"),
        file_name(F.col("path")).alias("file_name"),
        "path",
        "length",
    )


# Files up to this size are one row of a scan; longer ones are read in pieces.
WHOLE_BYTES = 64 * 1024 * 1024
PIECE_BYTES = 8 * 1024 * 1024


def file_digests(spark: SparkSession, data_dir: str) -> DataFrame:
    """SHA-256 of each parquet file directly in a table folder, empty ones too.

    Files of at most ``WHOLE_BYTES`` are read by Spark; the size is pushed down to
    the scan, which opens no other file. Longer ones are streamed by the task that
    has their name, in pieces, so a task's memory does not grow with a file.
    """
    kept = _in_table_folder(spark, data_dir)
    short = _files(spark, data_dir).filter(kept & (F.col("length") <= WHOLE_BYTES))
    listing = file_listing(spark, data_dir).select("path", "length")
    empty = listing.filter(F.col("length") == 0).select("path", content_digest(F.lit(b"")).alias("sha256"))
    long = listing.filter(F.col("length") > WHOLE_BYTES).select("path")
    # One file is one unit of work: a name each, dealt over the tasks.
    dealt = long.repartition(spark.sparkContext.defaultParallelism, "path")
    streamed = dealt.mapInArrow(_stream_digests, "path string, sha256 string")
    whole = short.select("path", content_digest(F.col("content")).alias("sha256"))
    return whole.unionByName(empty).unionByName(streamed)


def _stream_digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            digest = hashlib.sha256()
            with _open_stream(path) as stream:
                while piece := stream.read(PIECE_BYTES):
                    digest.update(piece)
            row = {"path": [path], "sha256": [digest.hexdigest()]}
            yield pa.RecordBatch.from_pydict(row, schema=_DIGESTS)


_DIGESTS = pa.schema([("path", pa.string()), ("sha256", pa.string())])


def _open_stream(path: str) -> pa.NativeFile:
    """A file by its full name: local, HDFS or an object store. Names are as a scan
    shows them, so one slash stands for a host that is not there."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem().open_input_stream("/" + rest.lstrip("/"))
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    if not rest.startswith("//"):
        rest = "//" + rest
    system, name = fs.FileSystem.from_uri(f"{scheme}:{quote(rest, safe='/:@')}")
    return system.open_input_stream(name)


def content_digest(content: Column) -> Column:
    return F.sha2(content, 256)


# -- manifest -----------------------------------------------------------------


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).option("multiLine", "true").json(path)


def manifest_files(
    manifest: DataFrame, required: Sequence[str] = REQUIRED_TABLES
) -> DataFrame:
    """One row per file of a required table. A table without files keeps one row
    with a NULL path, which is what a caller warns about."""
    tables = manifest.select(
        F.col("dateStr").alias("date_str"),
        "files",
        F.explode(F.array(*[F.lit(t) for t in required])).alias("table_name"),
    )
    listed = F.try_element_at("files", F.col("table_name"))
    return tables.select(
        "date_str", "table_name", F.explode_outer(listed).alias("path")
    ).withColumn("file_name", file_name(F.col("path")))


# -- reconciliation -------------------------------------------------------------


def required_file_counts(
    listing: DataFrame, required: Sequence[str] = REQUIRED_TABLES
) -> DataFrame:
    """Files per required table, 0 for a table without any."""
    counts = listing.groupBy("table_name").agg(F.count(F.lit(1)).alias("n_files"))
    names = listing.sparkSession.createDataFrame([(t,) for t in required], "table_name string")
    return names.join(counts, "table_name", "left").select(
        "table_name",
        F.coalesce("n_files", F.lit(0)).cast("long").alias("n_files"),
        F.col("n_files").isNull().alias("is_missing"),
    )


def check_required(listing: DataFrame) -> dict[str, int]:
    """Files per required table; an error names the tables without files."""
    rows = required_file_counts(listing).collect()
    missing = sorted(r["table_name"] for r in rows if r["is_missing"])
    if missing:
        raise FileNotFoundError(f"no parquet files for: {', '.join(missing)}")
    return {r["table_name"]: r["n_files"] for r in rows}


def reconcile(wanted: DataFrame, listing: DataFrame) -> DataFrame:
    """Wanted files with a problem: ``missing``, or ``empty`` (zero bytes)."""
    present = listing.select("table_name", "file_name", "length")
    problem = F.when(F.col("length").isNull(), "missing").when(F.col("length") == 0, "empty")
    return (
        wanted.filter(F.col("file_name").isNotNull())
        .select("table_name", "file_name")
        .join(present, ["table_name", "file_name"], "left")
        .select("table_name", "file_name", problem.alias("problem"))
        .filter(F.col("problem").isNotNull())
    )


def is_complete(wanted: DataFrame, listing: DataFrame) -> bool:
    return reconcile(wanted, listing).isEmpty()


def with_completeness(expected: DataFrame, listing: DataFrame) -> DataFrame:
    """Expected files with ``complete``: the expected size is known, positive and
    equal to the local one. Others have to be fetched again."""
    present = listing.select("table_name", "file_name", "length")
    same = (F.col("expected_length") > 0) & (F.col("expected_length") == F.col("length"))
    return expected.join(present, ["table_name", "file_name"], "left").select(
        "table_name",
        "file_name",
        "expected_length",
        "length",
        F.coalesce(same, F.lit(False)).alias("complete"),
    )


def file_summary(listing: DataFrame, tables: Sequence[str] = ()) -> DataFrame:
    """Files and megabytes per table, and in total (``table_name`` is 'total').
    The total rounds the sum of bytes, not the rounded parts. ``tables`` names
    those to list even when they have no file."""
    sizes = listing.select("table_name", "length")
    if tables:
        empty = [(t, None) for t in tables]
        sizes = sizes.unionByName(
            listing.sparkSession.createDataFrame(empty, "table_name string, length long")
        )
    return (
        sizes.rollup("table_name")
        .agg(
            F.grouping("table_name").alias("_total"),
            F.count("length").alias("file_count"),
            F.coalesce(F.sum("length"), F.lit(0)).alias("_bytes"),
        )
        .select(
            F.when(F.col("_total") == 1, "total").otherwise(F.col("table_name")).alias("table_name"),
            "file_count",
            megabytes(F.col("_bytes")).alias("size_mb"),
        )
    )
