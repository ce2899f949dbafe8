"""Ranked lexical search: an index in shards, searched by Block-Max MaxScore.

A shard holds about ``SHARD_DOCS`` consecutive rows of a task at most: ids and numbers
of terms of its documents, and for each term a list of (document, occurrences) in
blocks of ``BLOCK`` entries, packed as gaps and counts of one, two or four bytes.
Beside a block lie its last document and its impacts: the pairs (occurrences,
terms of the document) of which no other pair of the block has both more
occurrences and fewer terms. Whatever the corpus figures turn out to be, the
block's best score is that of one of its impacts. Terms are known by 64-bit hashes.

A search goes through a shard query by query. Each list has a bound, that of its
best block. Lists by rising bound whose sum stays below the worst score in the
query's heap are non-essential: no document is among the best by these alone. So
candidates come from the others, window by window; what they score there plus the
bounds of the blocks of non-essential lists that they fall into must reach that
score, or they are rejected before any such block is unpacked. The rest take the
non-essential lists from the highest bound down, with the same test in between. A
task keeps one heap for each query over all its shards; the heaps are merged in a
ranked shuffle of at most ``k`` rows a query and task.

Documents are read in their own partitions and never shuffled, whatever term or
source is frequent. Numbers sent to the driver are as many as the queries have
terms; queries go in groups of ``GROUP_TERMS`` terms (one query at least), each
with its own lists, so that what a task gets is bounded.

Defined results: a null or empty text has no term, is in no list and does not
count; a null or empty query has no result; every query row is ranked by itself,
also if another has its id; rows of one doc_id are documents of their own; equal
scores come by doc_id, null first; very long texts are read whole, in place;
further columns play no part; empty tables give an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tagwright.llm.words import buffer_of, chunks, mix, powers_of
from tagwright.session import write_shared

K = 10
SHARD_DOCS = 16_384
SHARD_ENTRIES = 2_000_000  # a shard is closed earlier where its lists have so many
BLOCK = 128
WINDOW = 4_096  # documents of a shard looked at together
GROUP_TERMS = 262_144

# A term is a run of letters, digits and whatever lies beyond ASCII.
_TERM = np.zeros(256, dtype=bool)
_TERM[48:58] = _TERM[65:91] = _TERM[97:123] = _TERM[128:] = True
_VALUE = np.random.Generator(np.random.PCG64(20250613)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2)
_VALUE += np.uint64(1)
_VALUE[65:91] = _VALUE[97:123]
_VALUE[~_TERM] = 0
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)

_INDEX = (
    "part int, shard int, doc_ids array<long>, lengths array<long>, terms array<long>, counts array<long>,"
    " blocks array<long>, last array<int>, impact_of array<int>, impact_tf array<long>, impact_length array<long>,"
    " place array<long>, data binary, total long, block int"
)
_HITS = "query long, doc_id long, score long"


def term_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of all texts, and the number of the text of each."""
    data, offsets = buffer_of(texts)
    inside = _TERM[data]
    if not inside.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    begins[heads] = inside[heads]
    starts = np.flatnonzero(begins)
    value = _VALUE[data]
    value *= powers_of(_BASE, len(data))
    hashes = mix(np.add.reduceat(value, starts) * powers_of(_BASE_INVERSE, len(data))[starts])
    return hashes.view(np.int64), np.searchsorted(offsets, starts, "right") - 1


class Members:
    """Which hashes belong to a sorted set: a table of bits first, then a search."""

    def __init__(self, wanted: np.ndarray):
        self.wanted = wanted
        self.bits = np.zeros(1 << 20, dtype=bool)
        self.bits[wanted & 0xFFFFF] = True

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Places in ``hashes`` of those that belong."""
        maybe = np.flatnonzero(self.bits[hashes & 0xFFFFF])
        found = np.searchsorted(self.wanted, hashes[maybe])
        return maybe[self.wanted.take(found, mode="clip") == hashes[maybe]]


def _width(most: np.ndarray) -> np.ndarray:
    return np.where(most < 1 << 8, 1, np.where(most < 1 << 16, 2, 4))


def _pack(values: np.ndarray, width: int) -> bytes:
    return values.astype(f"<u{width}").tobytes()


def pack_lists(docs: np.ndarray, terms: np.ndarray, tf: np.ndarray, lengths: np.ndarray, block: int) -> dict:
    """The lists of a shard from its entries in order of term and document."""
    starts = np.flatnonzero(np.diff(terms, prepend=terms[0] - 1) != 0)
    counts = np.diff(np.append(starts, len(terms)))
    blocks = -(-counts // block)
    list_of = np.repeat(np.arange(len(starts)), blocks)
    number = np.arange(len(list_of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    first = starts[list_of] + number * block
    size = np.minimum(counts[list_of] - number * block, block)
    block_of = np.repeat(np.arange(len(first)), size)

    # A block's first gap is from document 0.
    gaps = np.diff(docs, prepend=0)
    gaps[first] = docs[first]
    gap_width = _width(np.maximum.reduceat(gaps, first))
    tf_width = _width(np.maximum.reduceat(tf, first))
    packed = [
        bytes((g, t)) + _pack(gaps[a : a + n], g) + _pack(tf[a : a + n], t)
        for a, n, g, t in zip(first.tolist(), size.tolist(), gap_width.tolist(), tf_width.tolist())
    ]

    own = lengths[docs]
    order = np.lexsort((own, -tf, block_of))
    spread = int(own.max()) + 1
    below = own[order] - block_of[order] * spread  # falls from block to block
    least = np.minimum.accumulate(below)
    keep = np.append(True, least[1:] < least[:-1])
    return {
        "terms": terms[starts],
        "counts": counts,
        "blocks": blocks,
        "last": docs[first + size - 1].astype(np.int32),
        "impact_of": np.bincount(block_of[order][keep], minlength=len(first)).astype(np.int32),
        "impact_tf": tf[order][keep],
        "impact_length": own[order][keep],
        "place": np.cumsum([0] + [len(p) for p in packed][:-1]),
        "data": b"".join(packed),
    }


def index_shards(wanted: np.ndarray | None, shard_docs: int, block: int):
    """Rows of ``_INDEX`` from rows (doc_id, text)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members = None if wanted is None else Members(wanted)
        part, shard = TaskContext.get().partitionId(), 0
        ids: list[pa.Array] = []
        held: list[tuple[np.ndarray, ...]] = []
        n_docs = entries = 0

        def close() -> pa.RecordBatch:
            nonlocal ids, held, n_docs, entries, shard
            docs, terms, tf, lengths = (np.concatenate([h[i] for h in held]) for i in range(4))
            order = np.lexsort((docs, terms))
            row = {"part": part, "shard": shard, "doc_ids": pa.concat_arrays(ids), "lengths": lengths, "total": int(lengths.sum()), "block": block}
            if len(order):
                row |= pack_lists(docs[order], terms[order], tf[order], lengths, block)
            else:
                row |= dict.fromkeys(("terms", "counts", "blocks", "last", "impact_of", "impact_tf", "impact_length", "place"), [])
                row["data"] = b""
            ids, held, n_docs, entries, shard = [], [], 0, 0, shard + 1
            fields = [pa.field(f.split()[0], _ARROW[f.split()[1]]) for f in _INDEX.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in fields], schema=pa.schema(fields))

        for chunk in chunks(batches, "text"):
            hashes, text = term_hashes(chunk.column("text"))
            lengths = np.bincount(text, minlength=chunk.num_rows)
            if members is not None:
                at = members.places(hashes)
                hashes, text = hashes[at], text[at]
            order = np.lexsort((hashes, text))
            hashes, text = hashes[order], text[order]
            new = np.append(True, (np.diff(hashes) != 0) | (np.diff(text) != 0))[: len(hashes)]
            first = np.flatnonzero(new)
            tf = np.diff(np.append(first, len(hashes)))
            held.append((text[first] + n_docs, hashes[first], tf, lengths))
            ids.append(chunk.column("doc_id"))
            n_docs, entries = n_docs + chunk.num_rows, entries + len(first)
            if n_docs >= shard_docs or entries >= SHARD_ENTRIES:
                yield close()
        if n_docs:
            yield close()

    return run


_ARROW = {
    "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(),
    "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
}


def build_index(
    docs: DataFrame, terms: np.ndarray | None = None, *, shard_docs: int = SHARD_DOCS, block: int = BLOCK
) -> DataFrame:
    """The stored shards of ``docs`` (doc_id, text): lists of all terms, or of
    those whose hashes are named."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    wanted = None if terms is None else np.unique(terms)
    return write_shared(texts.mapInArrow(index_shards(wanted, shard_docs, block), _INDEX))


def scores(tf: np.ndarray, lengths: np.ndarray, n: int, total: int) -> np.ndarray:
    """A term's share of a document's score, before its weight."""
    m = 25 + 75 * lengths * n // total
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


class Heap:
    """The best ``k`` of a query so far."""

    def __init__(self, k: int):
        self.k, self.ids, self.scores = k, np.empty(0, np.int64), np.empty(0, np.int64)
        self.known = np.empty(0, bool)

    @property
    def worst(self) -> int:
        """What a document needs at least to come in."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, ids: np.ndarray, known: np.ndarray, own: np.ndarray) -> None:
        ids, known, own = (np.append(a, b) for a, b in ((self.ids, ids), (self.known, known), (self.scores, own)))
        best = np.lexsort((ids, known, -own))[: self.k]
        self.ids, self.known, self.scores = ids[best], known[best], own[best]


class Shard:
    """A shard's lists, unpacked as far as they are needed."""

    def __init__(self, row: dict, n: int, total: int, window: int = WINDOW):
        self.row, self.n, self.total, self.wide = row, n, total, window
        block = row["block"]
        self.list_of = {t: i for i, t in enumerate(row["terms"].tolist())}
        self.first = np.append(0, np.cumsum(row["blocks"]))
        self.entries = np.minimum(block, np.repeat(row["counts"], row["blocks"]) - block * (
            np.arange(self.first[-1]) - np.repeat(self.first[:-1], row["blocks"])))
        best = scores(row["impact_tf"], row["impact_length"], n, total)
        heads = np.append(0, np.cumsum(row["impact_of"]))[:-1]
        self.best = np.maximum.reduceat(best, heads) if len(best) else best
        self.bound = np.maximum.reduceat(self.best, self.first[:-1]) if len(self.best) else self.best
        self.unpacked: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.windows: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def block(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of a block and their scores."""
        if number not in self.unpacked:
            at, n = int(self.row["place"][number]), int(self.entries[number])
            gap, width = self.row["data"][at], self.row["data"][at + 1]
            docs = np.cumsum(np.frombuffer(self.row["data"], f"<u{gap}", n, at + 2), dtype=np.int64)
            tf = np.frombuffer(self.row["data"], f"<u{width}", n, at + 2 + n * gap).astype(np.int64)
            self.unpacked[number] = docs, scores(tf, self.row["lengths"][docs], self.n, self.total)
        return self.unpacked[number]

    def window(self, own: int, begin: int) -> tuple[np.ndarray, np.ndarray]:
        """Entries of a list in a window of documents."""
        if (own, begin) not in self.windows:
            a, b = self.first[own], self.first[own + 1]
            last = self.row["last"][a:b]
            blocks = range(a + np.searchsorted(last, begin), min(b, a + 1 + np.searchsorted(last, begin + self.wide - 1)))
            found = [self.block(i) for i in blocks]
            docs = np.concatenate([f[0] for f in found]) if found else np.empty(0, np.int64)
            own_scores = np.concatenate([f[1] for f in found]) if found else np.empty(0, np.int64)
            low, high = np.searchsorted(docs, (begin, begin + self.wide))
            self.windows[own, begin] = docs[low:high], own_scores[low:high]
        return self.windows[own, begin]

    def blocks_at(self, own: int, docs: np.ndarray) -> np.ndarray:
        """The block of a list that each document falls into, -1 after the last."""
        a, b = self.first[own], self.first[own + 1]
        at = a + np.searchsorted(self.row["last"][a:b], docs)
        return np.where(at < b, at, -1)

    def look_up(self, blocks: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Scores of documents in a list; 0 where it lacks them."""
        out = np.zeros(len(docs), np.int64)
        for number in np.unique(blocks[blocks >= 0]).tolist():
            here = np.flatnonzero(blocks == number)
            entries, own = self.block(number)
            at = np.searchsorted(entries, docs[here])
            out[here] = np.where(entries[at] == docs[here], own[at], 0)
        return out


def search_shard(shard: Shard, weights: Sequence[tuple[int, int]], heap: Heap) -> None:
    """Bring the best documents of a shard into a query's heap. ``weights``:
    (term, weight times occurrences in the query)."""
    lists = [(int(shard.bound[i]) * w, i, w) for t, w in weights if w and (i := shard.list_of.get(t)) is not None]
    if not lists:
        return
    lists.sort()
    sums = np.cumsum([bound for bound, _, _ in lists])
    n_docs = len(shard.row["lengths"])
    for begin in range(0, n_docs, shard.wide):
        essential = int(np.searchsorted(sums, heap.worst, "left"))  # lists before it stay below
        if essential == len(lists):
            return
        part = np.zeros(shard.wide, np.int64)
        for _, own, weight in lists[essential:]:
            docs, own_scores = shard.window(own, begin)
            part[docs - begin] += weight * own_scores
        docs = np.flatnonzero(part)
        so_far, docs = part[docs], docs + begin
        # What non-essential lists can add, by block.
        blocks = [shard.blocks_at(own, docs) for _, own, _ in lists[:essential]]
        most = [np.where(at >= 0, weight * shard.best[at], 0) for at, (_, _, weight) in zip(blocks, lists)]
        rest = np.sum(most, axis=0) if most else np.zeros(len(docs), np.int64)
        for i in range(essential - 1, -1, -1):
            keep = np.flatnonzero(so_far + rest >= heap.worst)
            if len(keep) < len(docs):
                docs, so_far, rest = docs[keep], so_far[keep], rest[keep]
                blocks, most = [b[keep] for b in blocks[: i + 1]], [m[keep] for m in most[: i + 1]]
            if not len(docs):
                break
            rest = rest - most[i]
            so_far = so_far + lists[i][2] * shard.look_up(blocks[i], docs)
        keep = so_far >= heap.worst
        if keep.any():
            docs, so_far = docs[keep], so_far[keep]
            heap.add(shard.row["doc_ids"][docs], shard.row["known"][docs], so_far)


def search_shards(queries: list[tuple[int, list[tuple[int, int]]]], n: int, total: int, k: int, window: int):
    """Rows of ``_HITS`` from rows of the index: the heaps of a task."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = {number: Heap(k) for number, _ in queries}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {}
                for field in batch.schema:
                    value = batch.column(field.name)[i]
                    if field.name in ("data", "block"):
                        row[field.name] = value.as_py()
                        continue
                    row[field.name] = value.values.fill_null(0).to_numpy(zero_copy_only=False)
                row["known"] = batch.column("doc_ids")[i].values.is_valid().to_numpy(zero_copy_only=False)
                shard = Shard(row, n, total, window)
                for number, weights in queries:
                    search_shard(shard, weights, heaps[number])
        numbers = np.concatenate([np.full(len(h.ids), q) for q, h in heaps.items()] or [np.empty(0)]).astype(np.int64)
        ids = np.concatenate([h.ids for h in heaps.values()] or [np.empty(0, np.int64)])
        known = np.concatenate([h.known for h in heaps.values()] or [np.empty(0, bool)])
        own = np.concatenate([h.scores for h in heaps.values()] or [np.empty(0, np.int64)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers), pa.array(ids, mask=~known), pa.array(own)], ["query", "doc_id", "score"]
        )

    return run


def search(index: DataFrame, queries: list[tuple[int, np.ndarray]], k: int = K, *, window: int = WINDOW) -> DataFrame:
    """(query, rank, doc_id, score) of the ``k`` best documents of each query
    (number, hashes of its terms, repeats included)."""
    figures = index.select(
        F.sum(F.size(F.filter("lengths", lambda x: x > 0))).alias("n"), F.sum("total").alias("total")
    ).first()
    n, total = figures["n"] or 0, figures["total"] or 0
    if not n:
        return index.sparkSession.createDataFrame([], "query long, rank int, doc_id long, score long")
    terms = np.unique(np.concatenate([t for _, t in queries])) if queries else np.empty(0, np.int64)
    lists = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("l")).select("l.terms", "l.counts")
    wanted = index.sparkSession.createDataFrame(pa.table({"terms": pa.array(terms)})) if len(terms) else None
    found = [] if wanted is None else lists.join(wanted, "terms").groupBy("terms").agg(F.sum("counts").alias("df")).collect()
    weight = {r["terms"]: math.floor(1000 * math.log((2 * n + 2) / (2 * r["df"] + 1))) for r in found}
    weighed = []
    for number, own in queries:
        own_terms, repeats = np.unique(own, return_counts=True)
        weighed.append((number, [(t, weight[t] * r) for t, r in zip(own_terms.tolist(), repeats.tolist()) if t in weight]))
    hits = index.drop("part", "shard", "total").mapInArrow(search_shards(weighed, n, total, k, window), _HITS)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query", "rank", "doc_id", "score"
    )


def query_groups(items: DataFrame, group_terms: int) -> Iterator[list[tuple[int, object, np.ndarray]]]:
    """Items (item_id, text) in groups of about ``group_terms`` terms: number,
    item_id, hashes of terms."""
    group, held = [], 0
    for number, row in enumerate(items.select("item_id", "text").toLocalIterator()):
        hashes, _ = term_hashes(pa.array([row["text"]], pa.string()))
        if not len(hashes):
            continue
        if group and held + len(hashes) > group_terms:
            yield group
            group, held = [], 0
        group.append((number, row["item_id"], hashes))
        held += len(hashes)
    if group:
        yield group


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = K,
    *,
    shard_docs: int = SHARD_DOCS,
    block: int = BLOCK,
    window: int = WINDOW,
    group_terms: int = GROUP_TERMS,
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents for each item. Each
    group of items has its own index, of the lists that it needs."""
    spark, found = docs.sparkSession, []
    for group in query_groups(items, group_terms):
        terms = np.concatenate([hashes for _, _, hashes in group])
        index = build_index(docs, terms, shard_docs=shard_docs, block=block)
        hits = search(index, [(number, hashes) for number, _, hashes in group], k, window=window)
        names = spark.createDataFrame([(number, item) for number, item, _ in group], "query long, item_id long")
        found.append(hits.join(names, "query").select("item_id", "rank", "doc_id", "score"))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.union, found)
