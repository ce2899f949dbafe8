"""Token ids of whole texts in compressed, checksummed blocks.

Documents lie in ascending id order: range partitions, each one stream of ids
(every document's ids and the end id), cut into blocks of ``coder.BLOCK`` ids
that can be read alone. A block of the file format:

    header   "TWTB", version, ids, pieces, bytes of outcomes, bytes after them,
             CRC-32 of the ids (little-endian unsigned 32-bit numbers)
    pieces   per piece of a document: doc_id, place of the document in the
             stream, number of the document, number of the piece, ids
    body     range-coded outcomes, then the bytes that follow them (see coder)

Blocks are rows of (part, block, ids, data) that Spark writes and commits, so a lost
executor leaves no half file. Reading checks every block; checksums of documents
that span blocks are combined from those of their pieces, so ids never travel.

Texts are encoded by their units (see units), each distinct one once; a worker
process keeps them from task to task, in a table bounded in bytes.

Defined results: a null or empty text has the end id alone; a null id comes
before all others; rows of one id stand in order of their texts' hashes; repeated
rows stand one after the other and are told apart by their place; very long texts
span blocks; columns of other names play no part; an empty table gives an empty
result.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tagwright.llm import coder
from tagwright.llm.units import UnitEncoder, encoder_of
from tagwright.llm.words import chunks
from tagwright.session import shared_path

END = 0

_MAGIC, _VERSION = b"TWTB", 1
_HEADER = struct.Struct("<4sHIIIII")
_PIECE = np.dtype([("doc", "<i8"), ("place", "<i8"), ("number", "<i8"), ("piece", "<i4"), ("n", "<i4")])
_NULL_ID = -(1 << 63)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode_documents(encoder: UnitEncoder, texts: pa.Array) -> list[np.ndarray]:
    """Ids of each text with the end id."""
    ids, bounds = encoder.encode(texts)
    if len(ids) and ids.max() > 0xFFFF:
        raise ValueError(f"token id {ids.max()} does not fit in 16 bits")
    ends = bounds[1:]
    ids = np.insert(ids.astype(np.uint16), ends, END)
    return np.split(ids, (ends + np.arange(1, len(ends) + 1))[:-1])


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def pack_block(ids: np.ndarray, pieces: list[tuple], outcomes: bytes, rest: bytes) -> bytes:
    header = _HEADER.pack(_MAGIC, _VERSION, len(ids), len(pieces), len(outcomes), len(rest), checksum(ids))
    return header + np.array(pieces, dtype=_PIECE).tobytes() + outcomes + rest


def encode_blocks(path: str):
    """Rows (part, block, ids, data) from rows (id, text) in order of id."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core for one task
        encoder, part = encoder_of(path, words=False), TaskContext.get().partitionId()
        waiting: list[tuple[np.ndarray, list[tuple]]] = []  # full blocks
        ids: list[np.ndarray] = []
        pieces: list[tuple] = []
        held = place = number = block = 0

        def close() -> None:
            nonlocal ids, pieces, held
            waiting.append((np.concatenate(ids), pieces))
            ids, pieces, held = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal block, waiting
            coded = coder.encode([i for i, _ in waiting])
            rows = [pack_block(own, parts, *body) for (own, parts), body in zip(waiting, coded)]
            numbers = np.arange(block, block + len(rows))
            sizes = np.array([len(own) for own, _ in waiting])
            block, waiting = block + len(rows), []
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(rows), part)), pa.array(numbers), pa.array(sizes), pa.array(rows, pa.binary())],
                ["part", "block", "ids", "data"],
            )

        for chunk in chunks(batches, "text"):
            for doc, own in zip(chunk.column("id").to_pylist(), encode_documents(encoder, chunk.column("text"))):
                at = piece = 0
                while at < len(own):
                    take = min(coder.BLOCK - held, len(own) - at)
                    ids.append(own[at : at + take])
                    pieces.append((doc, place, number, piece, take))
                    held, at, piece = held + take, at + take, piece + 1
                    if held == coder.BLOCK:
                        close()
                        if len(waiting) == coder.LANES:
                            yield flush()
                place += len(own)
                number += 1
        if held:
            close()
        if waiting:
            yield flush()

    return run


def open_block(data: bytes) -> tuple[np.ndarray, int, int, tuple[bytes, bytes]]:
    """Pieces, number of ids, checksum, and coded body of a block."""
    magic, version, n, n_pieces, outcomes, rest, crc = _HEADER.unpack_from(data)
    if (magic, version) != (_MAGIC, _VERSION):
        raise ValueError("not a block of token ids")
    pieces = np.frombuffer(data, _PIECE, n_pieces, _HEADER.size)
    body = _HEADER.size + pieces.nbytes
    if len(data) != body + outcomes + rest or pieces["n"].sum() != n:
        raise ValueError("a block of token ids is damaged")
    return pieces, n, crc, (data[body : body + outcomes], data[body + outcomes :])


def decode_blocks(blocks: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(pieces, ids) of each block, checked."""
    opened = sorted(map(open_block, blocks), key=lambda b: -b[1])
    for at in range(0, len(opened), coder.LANES):
        own = opened[at : at + coder.LANES]
        decoded = coder.decode([b[3] for b in own], [b[1] for b in own])
        for (pieces, _, crc, _), ids in zip(own, decoded):
            if checksum(ids) != crc:
                raise ValueError("the checksum of a block of token ids is wrong")
            yield pieces, ids


def read_pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        data, parts = batch.column("data").to_pylist(), batch.column("part").to_pylist()
        for part in sorted(set(parts)):
            found, crcs = [], []
            for pieces, ids in decode_blocks([d for d, p in zip(data, parts) if p == part]):
                ends = np.cumsum(pieces["n"])
                crcs += [checksum(ids[e - n : e]) for e, n in zip(ends, pieces["n"])]
                found.append(pieces)
            rows = np.concatenate(found)
            columns = [pa.array(np.ascontiguousarray(rows[name]).astype(np.int64)) for name in ("doc", "place", "number", "piece", "n")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(rows), part)), *columns, pa.array(np.array(crcs, dtype=np.int64))],
                ["part", "id", "place", "number", "piece", "n", "crc"],
            )


_POLYNOMIAL = np.uint32(0xEDB88320)


def _multiply(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Product of polynomials over GF(2) modulo the CRC's, bits reversed."""
    product = np.zeros_like(a)
    b = b.copy()
    for bit in range(31, -1, -1):
        product ^= np.where(a >> np.uint32(bit) & np.uint32(1), b, np.uint32(0))
        b = (b >> np.uint32(1)) ^ np.where(b & np.uint32(1), _POLYNOMIAL, np.uint32(0))
    return product


def join_checksums(first: np.ndarray, second: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    """CRC-32 of data whose parts have these, the second ``n_bytes`` long."""
    shift = np.full(len(first), 1 << 31, dtype=np.uint32)
    power = np.full(len(first), 1 << 23, dtype=np.uint32)  # x^8, one byte
    left = n_bytes.astype(np.int64)
    while left.any():
        shift = np.where(left & 1, _multiply(shift, power), shift)
        power = _multiply(power, power)
        left = left >> 1
    return _multiply(first, shift) ^ second


def join_pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("pieces")
        offsets, rows = np.asarray(lists.offsets), lists.flatten()
        n, crc = (np.asarray(rows.field(name)) for name in ("n", "crc"))
        counts, start = np.diff(offsets), offsets[:-1] - offsets[0]
        total, n_ids = crc[start].astype(np.uint32), n[start].copy()
        for k in range(1, int(counts.max(initial=0))):
            more = np.flatnonzero(counts > k)
            at = start[more] + k
            total[more] = join_checksums(total[more], crc[at].astype(np.uint32), 4 * n[at])
            n_ids[more] += n[at]
        yield pa.RecordBatch.from_arrays(
            [*batch.select(["part", "id", "place"]).columns, pa.array(n_ids), pa.array(total.astype(np.int64))],
            ["part", "id", "place", "n_tokens", "ids_crc32"],
        )


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None) -> None:
    """Write the ids of ``docs`` (doc_id, text) to ``path``."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("id"), "text")
    keys = [F.col("id"), F.xxhash64("text")]  # rows of one id are spread, too
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("id", "text")
    blocks = ordered.mapInArrow(encode_blocks(tokenizer or default_tokenizer()), "part long, block long, ids long, data binary")
    blocks.write.mode("overwrite").option("compression", "none").parquet(path)


def read_tokens(spark, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document in the files at ``path``."""
    blocks = spark.read.schema("part long, block long, ids long, data binary").parquet(path)
    pieces = blocks.select("part", "data").mapInArrow(
        read_pieces, "part long, id long, place long, number long, piece long, n long, crc long"
    )
    documents = pieces.groupBy("part", "number", "id", "place").agg(
        F.sort_array(F.collect_list(F.struct("piece", "n", "crc"))).alias("pieces")
    )
    whole = documents.mapInArrow(join_pieces, "part long, id long, place long, n_tokens long, ids_crc32 long")
    # One row per range partition is ordered as a whole.
    ends = blocks.groupBy("part").agg(F.sum("ids").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))
    return whole.join(ends, "part").select(
        F.when(F.col("id") != _NULL_ID, F.col("id")).alias("doc_id"),
        (F.col("before") + F.col("place")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


def token_files(docs: DataFrame, path: str | None = None, tokenizer: str | None = None) -> DataFrame:
    """Write the token files of ``docs``, in the shared folder unless named, and
    return what reading them back finds."""
    path = path or shared_path(docs.sparkSession)
    write_tokens(docs, path, tokenizer)
    return read_tokens(docs.sparkSession, path)
