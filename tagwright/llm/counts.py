"""Corpus counts in a table of fixed size."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tagwright.llm.words import chunks

_SLICE = 4096


def bucket_counts(docs: DataFrame, buckets: int, hashes_of: Callable[[pa.Array], np.ndarray]) -> np.ndarray:
    """How many hashes of all texts fall in each of ``buckets`` (a multiple of
    4096). Tasks send slices of counts, which are added up slice by slice; the
    driver gets the sums, one number per bucket."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, dtype=np.int64)
        for chunk in chunks(batches, "text"):
            own = (hashes_of(chunk.column("text")) % np.uint64(buckets)).astype(np.int64)
            counts += np.bincount(own, minlength=buckets)
        slices = counts.reshape(-1, _SLICE)
        used = np.flatnonzero(slices.any(axis=1))
        yield _slices(used, slices[used])

    counted = docs.select("text").mapInArrow(count, "slice long, counts array<long>")
    summed = counted.repartition("slice").sortWithinPartitions("slice").mapInArrow(_add, counted.schema).toArrow()
    counts = np.zeros(buckets, dtype=np.int64)
    for number, own in zip(summed["slice"].to_pylist(), summed["counts"]):
        counts[number * _SLICE : (number + 1) * _SLICE] = np.asarray(own.values)
    return counts


def _slices(numbers: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    offsets = np.arange(len(numbers) + 1, dtype=np.int32) * _SLICE
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(counts.ravel()))
    return pa.RecordBatch.from_arrays([pa.array(numbers), lists], ["slice", "counts"])


def _add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of counts by slice, from rows in order of slice."""
    number, total = None, None
    for batch in batches:
        for own, counts in zip(batch.column("slice").to_pylist(), batch.column("counts")):
            if own != number:
                if number is not None:
                    yield _slices(np.array([number]), total[None])
                number, total = own, np.zeros(_SLICE, dtype=np.int64)
            total += np.asarray(counts.values)
    if number is not None:
        yield _slices(np.array([number]), total[None])
