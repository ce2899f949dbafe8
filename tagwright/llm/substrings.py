"""Removal of passages that stand in an earlier document: seed and extend.

1. Exact copies meet first: the smallest id of each distinct text stands for it,
   and every other copy loses all its windows.
2. Seeds: each window of ``size`` words has one winnowed anchor, the ``seed``
   words with the smallest hash inside it, so equal windows share the anchor. An
   anchor counts if two documents have it.
3. Extension: around counting anchors, every window to both sides that belongs
   to the anchor is hashed; a window is repeated if a document with a smaller id
   has it. Runs of repeated windows are the maximal repeats of at least ``size``
   words, and their words go.

No pairs of documents are formed: a chunk of documents sends each anchor or
window once, with its smallest id, and settles its other occurrences itself, so
a passage in a third of all documents is one row per chunk. Groups are read in
sorted order with one row kept, never gathered. Anchors and windows are compared
by independent 64-bit hashes (expected false matches: repeated windows squared
over 2^65).

Defined results: null and empty texts have no words; a text below ``size`` words
keeps all; a null id counts as smaller than all others; repeated rows (same id)
are judged alike and do not remove each other; columns of other names play no
part; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tagwright.llm.words import Words, chunks, mix, windows, words_of

SIZE = 13
SEED = 5

_NULL_ID = -(1 << 63)
_KEYS = ["id", "tkey"]


def seeds_of(words: Words, size: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each window of ``size`` words inside a text: its first word, the hash
    of its anchor, and the hash of its words."""
    hashes = words.hashes()
    window, inside = windows(hashes, words.first, size)
    if not len(window):
        none = np.empty(0, dtype=np.int64)
        return none, none.astype(np.uint64), none.astype(np.uint64)
    grams = mix(windows(hashes, words.first, seed)[0] ^ np.uint64(0xD6E8FEB86659FD93))
    n = len(window)
    anchor = grams[:n].copy()
    for i in range(1, size - seed + 1):
        np.minimum(anchor, grams[i : i + n], out=anchor)
    at = np.flatnonzero(inside)
    return at, anchor[at], window[at]


def _rows_of(chunk: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return np.asarray(chunk.column("id")), np.asarray(chunk.column("tkey"))


def _signed(a: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(a).view(np.int64))


def send_anchors(size: int, seed: int):
    """Rows (key, id, tkey, kind). Kind 0 asks whether another chunk has the anchor; kind 2 also says that
    it is repeated; kind 1 is a repeated anchor's further document (anchor in
    ``value``, key free)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, "text"):
            words = words_of(chunk.column("text"))
            at, anchor, _ = seeds_of(words, size, seed)
            ids, tkeys = _rows_of(chunk)
            text = np.searchsorted(words.first, at, "right") - 1
            rank = np.empty(len(ids), dtype=np.int64)
            rank[np.lexsort((tkeys, ids))] = np.arange(len(ids))
            order = np.lexsort((rank[text], anchor))
            anchor, text = anchor[order], text[order]
            fresh = np.ones(len(anchor), dtype=bool)
            fresh[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
            anchor, text = anchor[fresh], text[fresh]
            first = np.ones(len(anchor), dtype=bool)
            first[1:] = anchor[1:] != anchor[:-1]
            again = ~first
            shared = np.zeros(len(anchor), dtype=bool)  # first of several in the chunk
            shared[:-1] = first[:-1] & again[1:]
            kind = np.where(again, 1, np.where(shared, 2, 0)).astype(np.int8)
            key = np.where(again, mix(anchor + text.astype(np.uint64) + np.uint64(1)), anchor)
            yield pa.RecordBatch.from_arrays(
                [_signed(key), pa.array(ids[text]), pa.array(tkeys[text]), pa.array(kind), _signed(np.where(again, anchor, 0))],
                ["key", "id", "tkey", "kind", "value"],
            )

    return run


def repeated_anchors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, tkey, anchor) of anchors that several documents have, from rows in
    order of key; of the group that is open one row is kept."""
    held, open_key = None, None  # the only row of the last key; a key known as repeated
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = {name: np.asarray(batch.column(name)) for name in ("key", "id", "tkey", "kind", "value")}
        passing = rows["kind"] == 1
        found = [(rows["id"][passing], rows["tkey"][passing], rows["value"][passing])]
        asks = ~passing
        key, ids, tkeys, kind = (rows[name][asks] for name in ("key", "id", "tkey", "kind"))
        if held is not None:
            key, ids, tkeys, kind = (np.concatenate([[h], a]) for h, a in zip(held, (key, ids, tkeys, kind)))
            held = None
        if len(key):
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            counts = np.diff(np.append(starts, len(key)))
            several = np.minimum.reduceat(ids, starts) != np.maximum.reduceat(ids, starts)
            several |= np.minimum.reduceat(tkeys, starts) != np.maximum.reduceat(tkeys, starts)
            several |= np.maximum.reduceat(kind, starts) == 2
            several |= key[starts] == open_key if open_key is not None else False
            keep = np.repeat(several, counts)
            found.append((ids[keep], tkeys[keep], key[keep]))
            if several[-1]:
                open_key = key[-1]
            else:
                held, open_key = (key[-1], ids[-1], tkeys[-1], kind[-1]), None
        out = [pa.array(np.concatenate(c)) for c in zip(*found)]
        yield pa.RecordBatch.from_arrays(out, ["id", "tkey", "anchor"])


def send_windows(size: int, seed: int):
    """Rows (key, id, tkey, kind, starts): each window of a counting anchor once
    per chunk, under the smallest id (kind 0), and as kind 1 the starts of windows
    that a smaller id of the chunk has."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, "text"):
            words = words_of(chunk.column("text"))
            at, anchor, window = seeds_of(words, size, seed)
            ids, tkeys = _rows_of(chunk)
            text = np.searchsorted(words.first, at, "right") - 1
            lists = chunk.column("anchors")
            counts = np.diff(np.asarray(lists.offsets))
            listed = np.asarray(lists.flatten()).view(np.uint64)
            in_text = mix(np.arange(len(ids), dtype=np.uint64) + np.uint64(7))
            counting = np.isin(anchor ^ in_text[text], listed ^ np.repeat(in_text, counts))
            start = (at - words.first[text])[counting]
            window, text = window[counting], text[counting]
            order = np.lexsort((start, text, tkeys[text], ids[text], window))
            window, text, start = window[order], text[order], start[order]
            same_window = np.zeros(len(window), dtype=bool)
            same_window[1:] = window[1:] == window[:-1]
            groups = np.flatnonzero(~same_window)
            least = np.repeat(ids[text[groups]], np.diff(np.append(groups, len(window)))) if len(groups) else ids[:0]
            later = ids[text] > least
            out = []
            w, t, s = window[~later], text[~later], start[~later]
            fresh = np.ones(len(w), dtype=bool)
            fresh[1:] = (w[1:] != w[:-1]) | (t[1:] != t[:-1])
            out.append((w, t, s, np.flatnonzero(fresh), 0))
            by_text = np.argsort(text[later], kind="stable")
            t, s = text[later][by_text], start[later][by_text]
            fresh = np.ones(len(t), dtype=bool)
            fresh[1:] = t[1:] != t[:-1]
            out.append((mix(t.astype(np.uint64) ^ window[:1].repeat(len(t))), t, s, np.flatnonzero(fresh), 1))
            for w, t, s, cuts, kind in out:
                starts = pa.ListArray.from_arrays(
                    pa.array(np.append(cuts, len(s)).astype(np.int32)), pa.array(s.astype(np.int32))
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        _signed(w[cuts]),
                        pa.array(ids[t[cuts]]),
                        pa.array(tkeys[t[cuts]]),
                        pa.array(np.full(len(cuts), kind, dtype=np.int8)),
                        starts,
                    ],
                    ["key", "id", "tkey", "kind", "starts"],
                )

    return run


def repeated_windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, tkey, starts) of windows that a smaller id has, from rows in order of
    (key, id): a key's first row names the smallest id."""
    last_key, last_id = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, ids, kind = (np.asarray(batch.column(name)) for name in ("key", "id", "kind"))
        asks = np.flatnonzero(kind == 0)
        keep = kind == 1
        if len(asks):
            k, i = key[asks], ids[asks]
            fresh = np.ones(len(k), dtype=bool)
            fresh[1:] = k[1:] != k[:-1]
            groups = np.flatnonzero(fresh)
            least = i[groups]
            if last_key is not None and k[0] == last_key:
                least[0] = last_id
            least = np.repeat(least, np.diff(np.append(groups, len(k))))
            keep[asks] = i > least
            last_key, last_id = k[-1], least[-1]
        kept = batch.select(["id", "tkey", "starts"]).filter(pa.array(keep))
        if kept.num_rows:
            yield kept


def drop_repeats(size: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, "text"):
            rows = []
            for text, rep, starts in zip(
                chunk.column("text").cast(pa.binary()).to_pylist(),
                chunk.column("rep").to_pylist(),
                chunk.column("starts"),
            ):
                words = (text or b"").split()
                kept = words
                if len(words) >= size and not rep:
                    kept = []
                elif starts.is_valid:
                    edge = np.zeros(len(words) + 1, dtype=np.int64)
                    first = np.unique(np.asarray(starts.values))
                    edge[first] += 1
                    edge[first + size] -= 1
                    kept = [w for w, gone in zip(words, np.cumsum(edge)) if not gone]
                rows.append((len(words), len(words) - len(kept), b" ".join(kept).decode()))
            n, removed, kept = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [chunk.column("id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                ["id", "n_words", "n_removed", "kept"],
            )

    return run


def remove_repeats(docs: DataFrame, size: int = SIZE, seed: int = SEED) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, n_removed and
    ``kept``, the words left, joined by one space."""
    text = F.coalesce("text", F.lit(""))
    placed = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("id"),
        F.xxhash64(text).alias("tkey"),
        text.alias("text"),
    )
    copies = placed.groupBy(F.md5("text").alias("digest"), "tkey").agg(F.min("id").alias("id"))
    reps = copies.select("id", "tkey", F.lit(True).alias("rep")).distinct()
    placed = placed.join(reps.hint("shuffle_hash"), _KEYS, "left")
    firsts = placed.filter("rep").select("id", "tkey", "text")

    sent = firsts.mapInArrow(send_anchors(size, seed), "key long, id long, tkey long, kind byte, value long")
    anchors = (
        sent.repartition("key").sortWithinPartitions("key").mapInArrow(repeated_anchors, "id long, tkey long, anchor long")
    )
    lists = anchors.groupBy(*_KEYS).agg(F.collect_list("anchor").alias("anchors"))
    near = firsts.join(lists.hint("shuffle_hash"), _KEYS)

    sent = near.mapInArrow(send_windows(size, seed), "key long, id long, tkey long, kind byte, starts array<int>")
    repeats = (
        sent.repartition("key").sortWithinPartitions("key", "id").mapInArrow(repeated_windows, "id long, tkey long, starts array<int>")
    )
    starts = repeats.groupBy(*_KEYS).agg(F.flatten(F.collect_list("starts")).alias("starts"))
    judged = placed.join(starts.hint("shuffle_hash"), _KEYS, "left").select("id", "text", "rep", "starts")
    kept = judged.mapInArrow(drop_repeats(size), "id long, n_words long, n_removed long, kept string")
    doc_id = F.when(F.col("id") != _NULL_ID, F.col("id")).alias("doc_id")
    return kept.select(doc_id, "n_words", "n_removed", "kept")
