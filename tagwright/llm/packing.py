"""Best-fit packing of tokenised documents into sequences of fixed length.

Documents are encoded once; only longer ones than a sequence are cut, into whole
sequences and a last piece. Best-fit decreasing takes pieces by falling length and
puts each into the open sequence with the least room that still takes it. Pieces
of one length are alike, and so are sequences with the same room, so the plan is
made on counts: a segment tree over the remaining capacities 1 to ``capacity``
holds how many sequences have each, and finds the tightest that takes a length in
logarithmic time. Once found, a sequence stays the tightest until it takes no
further piece of that length, so ``room // length`` pieces go in, for as many
sequences of that room as there are pieces. The outcome is that of one piece at a
time, over all documents.

The plan's size does not depend on the number of documents. At each length at
most three runs of sequences begin or are split, so there are at most 3 x capacity
runs; a run that takes pieces keeps less than half its room, so it is used at most
log2(capacity) times: 3 x 4,096 x 12 rows of 48 bytes, 7 MB, at worst (some
hundred in practice). It is made on the driver from one count a length, and goes
to every task.

Pieces of a length are numbered inside their task as they are written, and by
counts of (task, length) over all tasks, so a hot length is no one's group. The
plan tells sequence and offset by length and number; sequences meet in a shuffle,
at most ``capacity`` ids each.

Defined results: a null or empty text is its end id alone; a null or repeated
doc_id is packed as any row is; very long texts give many whole sequences; further
columns play no part; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tagwright.llm.units import encoder_of
from tagwright.llm.words import chunks
from tagwright.session import write_shared

CAPACITY = 4096
END = 1

_PIECES = "doc_id long, piece int, start long, length int, part int, number long, ids binary"
_PLACED = "doc_id long, piece int, start long, length int, ids binary, sequence_id long, offset int"
_SEQUENCES = (
    "sequence_id long, ids binary, pieces array<struct<doc_id:long,piece:int,start:long,length:int,offset:int>>"
)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class RoomTree:
    """How many open sequences have each remaining room, as a segment tree."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.counts = [0] * (2 * self.leaves)

    def add(self, room: int, n: int) -> None:
        at = room + self.leaves
        while at:
            self.counts[at] += n
            at >>= 1

    def tightest(self, length: int) -> int | None:
        """The least room of at least ``length`` that some sequence has."""
        at = length + self.leaves
        if self.counts[at]:
            return length
        while at > 1 and (at & 1 or not self.counts[at + 1]):
            at >>= 1
        if at <= 1:
            return None
        at += 1
        while at < self.leaves:
            at = 2 * at + (not self.counts[2 * at])
        return at - self.leaves


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """The plan for ``counts`` pieces of each length: rows (length, first number,
    pieces, first sequence, offset, pieces a sequence), by length and number."""
    tree, open_runs = RoomTree(capacity), {}  # room: runs of sequences
    plan, sequences = [], 0

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            open_runs.setdefault(room, []).append((first, n))
            tree.add(room, n)

    for length in sorted(counts, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a piece of {length} does not fit in {capacity}")
        number, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            each = (room or capacity) // length
            if room is None:
                room = capacity
                first, n = sequences, -(-left // each)
                sequences += n
            else:
                first, n = open_runs[room].pop()
                tree.add(room, -n)
            full = min(n, left // each)
            uses = [(full, each)] if full else []
            if full < n and left > full * each:
                uses.append((1, left - full * each))
            for size, taken in uses:
                plan.append((length, number, size * taken, first, capacity - room, taken))
                put(room - taken * length, first, size)
                number, left = number + size * taken, left - size * taken
                first, n = first + size, n - size
            put(room, first, n)
    return np.array(sorted(plan), dtype=np.int64).reshape(-1, 6)


def encode_pieces(path: str, capacity: int):
    """Rows of ``_PIECES`` from rows (doc_id, text)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core for one task
        encoder, part = encoder_of(path, words=True), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)  # pieces of each length so far
        for chunk in chunks(batches, "text"):
            ids, bounds = encoder.encode(chunk.column("text"))
            sizes = np.diff(bounds) + 1
            cuts = -(-sizes // capacity)
            doc = np.repeat(np.arange(len(sizes)), cuts)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
            start = piece * capacity
            length = np.minimum(sizes[doc] - start, capacity)
            order = np.argsort(length, kind="stable")
            new = np.bincount(length, minlength=capacity + 1)
            number = np.empty(len(doc), np.int64)
            number[order] = np.arange(len(doc)) - np.repeat(np.cumsum(new) - new, new) + seen[length[order]]
            seen += new
            bytes_of = np.insert(ids.astype("<u4"), bounds[1:], END).view(np.uint8)
            ends = np.append(0, np.cumsum(length * 4)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column("doc_id").take(pa.array(doc)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start),
                    pa.array(length.astype(np.int32)),
                    pa.array(np.full(len(doc), part, np.int32)),
                    pa.array(number),
                    pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(ends), pa.py_buffer(bytes_of)]),
                ],
                ["doc_id", "piece", "start", "length", "part", "number", "ids"],
            )

    return run


def place_pieces(plan: np.ndarray):
    """Sequence and offset from length and number (the task's first plus its own)."""
    key = plan[:, 0] << 40 | plan[:, 1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (np.asarray(batch.column(c)).astype(np.int64) for c in ("length", "number"))
            row = plan[np.searchsorted(key, length << 40 | number, "right") - 1]
            inside = number - row[:, 1]
            sequence, offset = row[:, 3] + inside // row[:, 5], row[:, 4] + inside % row[:, 5] * length
            columns = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence), pa.array(offset.astype(np.int32))],
                ["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"],
            )

    return run


def join_pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``_SEQUENCES`` from placed pieces in order of sequence and offset."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        sequence = rows["sequence_id"].to_numpy()
        whole = int(np.searchsorted(sequence, sequence[-1]))
        if whole:
            yield _joined(rows.slice(0, whole))
        held = rows.slice(whole)
    if held is not None:
        yield _joined(held)


def _joined(rows: pa.Table) -> pa.RecordBatch:
    rows = rows.combine_chunks()
    sequence, n = rows["sequence_id"].to_numpy(), rows.num_rows
    first = np.append(np.flatnonzero(np.diff(sequence, prepend=sequence[0] - 1)), n)
    ids = rows["ids"].chunk(0)
    ends = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset : ids.offset + n + 1]
    joined = pa.Array.from_buffers(
        pa.binary(), len(first) - 1, [None, pa.py_buffer(np.ascontiguousarray(ends[first])), ids.buffers()[2]]
    )
    names = ["doc_id", "piece", "start", "length", "offset"]
    pieces = pa.StructArray.from_arrays([rows[c].chunk(0) for c in names], names)
    lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pieces)
    return pa.RecordBatch.from_arrays([pa.array(sequence[first[:-1]]), joined, lists], ["sequence_id", "ids", "pieces"])


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """Sequences of ``docs`` (doc_id, text): sequence_id, ids (unsigned
    little-endian 32-bit numbers), and the pieces they hold, in order."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = write_shared(texts.mapInArrow(encode_pieces(tokenizer or default_tokenizer(), capacity), _PIECES))
    counts = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = write_shared(counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))))
    totals = {r["length"]: r["n"] for r in firsts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    numbered = pieces.join(firsts.select("length", "part", "first"), ["length", "part"]).select(
        "doc_id", "piece", "start", "length", (F.col("first") + F.col("number")).alias("number"), "ids"
    )
    placed = numbered.mapInArrow(place_pieces(best_fit(totals, capacity)), _PLACED)
    together = placed.repartition("sequence_id").sortWithinPartitions("sequence_id", "offset")
    return together.mapInArrow(join_pieces, _SEQUENCES)


def read_pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, lists = batch.column("ids"), batch.column("pieces")
        rows = lists.flatten()
        offset, length = (np.asarray(rows.field(c)).astype(np.int64) for c in ("offset", "length"))
        row = np.repeat(np.arange(len(ids)), np.diff(np.asarray(lists.offsets)))
        at = np.frombuffer(ids.buffers()[1], np.int32)[ids.offset + row].astype(np.int64) + 4 * offset
        data = memoryview(ids.buffers()[2]) if len(row) else b""
        crc = [zlib.crc32(data[a:b]) for a, b in zip(at.tolist(), (at + 4 * length).tolist())]
        yield pa.RecordBatch.from_arrays(
            [
                rows.field("doc_id"), rows.field("piece"), rows.field("start"), pa.array(length),
                pa.array(np.array(crc, dtype=np.int64)), batch.column("sequence_id").take(pa.array(row)), pa.array(offset),
            ],
            ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
        )


def piece_table(sequences: DataFrame) -> DataFrame:
    """Where each piece lies, and the checksum of the ids found there."""
    return sequences.mapInArrow(
        read_pieces, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
