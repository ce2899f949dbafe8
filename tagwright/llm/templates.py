"""Benchmark decontamination by template canonicalisation.

Windows are compared in two ways, each with its own cover, of which the larger
counts: by template, and exactly, word by word without outer punctuation and case.
The exact way has no least number of plain words, and an item with fewer than
``WINDOW`` words is a window as a whole, so copies in capitals, short items and
items that are mostly numbers and names are found by it.

In templates numbers, names (a capital inside a sentence or line, but not among
three words in capitals or more) and units (after a number) become typed placeholders, neighbours of one
type a single one. Windows of canonical words are hash-joined with those of the
benchmark items, and matches of one document and item at one distance form an
alignment; alignments whose distances differ by at most ``NEAR`` from one to the
next, as inserted and removed words leave them, also count together. It is a leak
if enough of the item's windows are covered by matches whose slots agree: a value
of the item stands for the one value of the document that it has at more than
half of its places, and windows with any other value do not count. A value without
such a majority costs all its windows. So a question with its numbers and names
exchanged is caught, also if two become equal, one conflict does not free the rest
of the passage, and a text that merely has the same frame is no leak.

Before the join a bit per window hash (``BITS`` of them, whatever the size of
the benchmark) keeps windows back that no item has; the join itself is exact in
the 64-bit hashes and is left to the planner, whichever side is small.

Defined results: null and empty texts are clean; items without a word cannot be
found; items without a window of ``MIN_PLAIN`` plain words are only found
word by word; items of equal text are one, under
their smallest id; a null item id is smaller than all and reported as null;
repeated document rows are judged alike; an empty benchmark leaves all clean; an
empty table gives an empty result; columns of other names play no part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tagwright.llm.words import _BASE, _BASE_INVERSE, _LOWER_VALUE, Words, chunks, mix, powers_of, windows, words_of

WINDOW = 8
MIN_PLAIN = 4
MIN_COVER = 0.5
NEAR = 8
BITS = 1 << 22

UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams ton tons tonnes pound pounds ounce ounces "
    "ml l liter liters litre litres gallon gallons second seconds sec minute minutes min hour hours day days week weeks "
    "month months year years percent cent cents dollar dollars euro euros usd eur degree degrees celsius fahrenheit "
    "watt watts volt volts joule joules hertz mph kmh"
).split()

PLAIN, NUMBER, NAME, UNIT = range(4)

_code = np.arange(256)
_DIGIT = (_code >= 48) & (_code <= 57)
_UPPER = (_code >= 65) & (_code <= 90)
_LETTER = _UPPER | ((_code >= 97) & (_code <= 122)) | (_code >= 128)
_ENDS_SENTENCE = np.isin(_code, [ord(c) for c in ".!?:"])
_PLACEHOLDER = mix(np.arange(1, 5, dtype=np.uint64))


def core_hashes(words: Words, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    value = np.append(_LOWER_VALUE[words.data] * powers_of(_BASE, len(words.data)), np.uint64(0))
    sums = np.add.reduceat(value, np.stack([low, high], axis=1).ravel())[::2]
    return mix(sums * powers_of(_BASE_INVERSE, len(words.data))[low])


def in_capitals(words: Words, digits: np.ndarray) -> np.ndarray:
    """Whether a word stands among three neighbours or more of one text that have
    capitals or digits and no small letters."""
    upper = np.add.reduceat(_UPPER[words.data], words.starts, dtype=np.int32)
    small = np.add.reduceat(_LETTER[words.data] & ~_UPPER[words.data], words.starts, dtype=np.int32)
    large = (upper + digits > 0) & (small == 0)
    starts = np.ones(len(large), dtype=bool)
    starts[1:] = large[1:] != large[:-1]
    heads = words.first[:-1]
    starts[heads[heads < len(large)]] = True
    spots = np.flatnonzero(starts)
    sizes = np.diff(np.append(spots, len(large)))
    return large & np.repeat(sizes >= 3, sizes)


def plain_words(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word with a letter or digit, without outer punctuation and
    case, and the first such word of each text."""
    n = len(words.data)
    if not len(words.starts):
        return np.empty(0, np.uint64), np.zeros_like(words.first)
    solid = _DIGIT[words.data] | _LETTER[words.data]
    place = np.arange(n)
    low = np.minimum.reduceat(np.where(solid, place, n), words.starts)
    high = np.maximum.reduceat(np.where(solid, place, -1), words.starts) + 1
    real = low < words.ends
    return core_hashes(words, low[real], high[real]), np.append(0, np.cumsum(real))[words.first]


def canonical(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the words with a letter or digit, runs of one placeholder taken as one:
    hash of the canonical word, its type, hash of its own value, and the first
    such word of each text."""
    n = len(words.data)
    if not len(words.starts):
        none = np.empty(0, np.uint64)
        return none, none.astype(np.int8), none, np.zeros_like(words.first)
    digit, letter = _DIGIT[words.data], _LETTER[words.data]
    solid = digit | letter
    place = np.arange(n)
    low = np.minimum.reduceat(np.where(solid, place, n), words.starts)
    high = np.maximum.reduceat(np.where(solid, place, -1), words.starts) + 1
    digits = np.add.reduceat(digit, words.starts, dtype=np.int32)
    letters = np.add.reduceat(letter, words.starts, dtype=np.int32)
    begins = np.zeros(len(words.starts), dtype=bool)
    begins[1:] = _ENDS_SENTENCE[words.data[words.ends[:-1] - 1]]
    lines = np.append(0, np.cumsum((words.data == 10) | (words.data == 13)))
    begins[1:] |= lines[words.starts[1:]] > lines[words.ends[:-1]]
    heads = words.first[:-1]
    begins[heads[heads < len(begins)]] = True
    begins |= in_capitals(words, digits)
    real = low < words.ends
    low, high = low[real], high[real]
    value = core_hashes(words, low, high)
    number = (digits > 0) & ((letters == 0) | ((letters <= 3) & _DIGIT[words.data[np.minimum(words.starts, n - 1)]]))
    number = number[real]
    kind = np.where(number, NUMBER, np.where(_UPPER[words.data[low]] & ~begins[real], NAME, PLAIN)).astype(np.int8)
    after_number = np.append(False, number[:-1])
    kind[after_number & np.isin(value, unit_hashes())] = UNIT
    first = np.append(0, np.cumsum(real))[words.first]
    kind, value, first = merged(kind, value, first)
    return np.where(kind == PLAIN, value, _PLACEHOLDER[kind]), kind, value, first


def merged(kind: np.ndarray, value: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of one placeholder as one, whose value is that of all its words."""
    if not len(kind):
        return kind, value, first
    starts = np.ones(len(kind), dtype=bool)
    starts[1:] = (kind[1:] == PLAIN) | (kind[1:] != kind[:-1])
    starts[first[first < len(kind)]] = True
    spots = np.flatnonzero(starts)
    place = np.arange(len(kind)) - np.repeat(spots, np.diff(np.append(spots, len(kind))))
    value = np.add.reduceat(np.where(place == 0, value, mix(value + place.astype(np.uint64))), spots)
    return kind[spots], value, np.append(0, np.cumsum(starts))[first]


_units: list[np.ndarray] = []


def unit_hashes() -> np.ndarray:
    if not _units:
        words = words_of(pa.array([" ".join(UNITS)]))
        _units.append(core_hashes(words, words.starts, words.ends))
    return _units[0]


def template_windows(texts: pa.Array, sizes: list[int] | None, seen: np.ndarray | None):
    """Per window: text number, position, size, hash, slots (type and value of
    each placeholder), and the places of the slots in the text. Exact windows have
    the negative of their size and no slots. ``sizes``: those to make, or the size each text gets (at
    most ``WINDOW``). ``seen``: bits by hash; windows without theirs are left out."""
    words = words_of(texts)
    yield from exact_windows(words, sizes and [-s for s in sizes if s < 0], seen)
    token, kind, value, first = canonical(words)
    sizes = sizes and [s for s in sizes if s > 0]
    lengths = np.diff(first)
    text_of = np.repeat(np.arange(len(lengths)), lengths)
    own_size = np.minimum(lengths, WINDOW)
    plain = np.append(0, np.cumsum(kind == PLAIN))
    for size in sorted(set(own_size[own_size >= MIN_PLAIN].tolist())) if sizes is None else sizes:
        gram, inside = windows(token, first, size)
        gram = mix(gram + np.uint64(size))
        start = np.arange(len(gram))
        inside &= plain[start + size] - plain[start] >= MIN_PLAIN
        if sizes is None:
            inside &= own_size[text_of[: len(gram)]] == size
        if seen is not None:
            inside &= seen[(gram % np.uint64(BITS)).astype(np.int64)]
        at = np.flatnonzero(inside)
        slot = kind[at[:, None] + np.arange(size)] != PLAIN
        cuts = pa.array(np.append(0, np.cumsum(slot.sum(axis=1))).astype(np.int32))
        spots = (at[:, None] + np.arange(size))[slot]
        slots = pa.ListArray.from_arrays(cuts, pa.array(mix(value[spots] + kind[spots].astype(np.uint64)).view(np.int64)))
        places = pa.ListArray.from_arrays(cuts, pa.array(spots - first[text_of[spots]]))
        yield text_of[at], at - first[text_of[at]], size, gram[at], slots, places


def exact_windows(words: Words, sizes: list[int] | None, seen: np.ndarray | None):
    value, first = plain_words(words)
    lengths = np.diff(first)
    text_of = np.repeat(np.arange(len(lengths)), lengths)
    own_size = np.minimum(lengths, WINDOW)
    for size in sorted(set(own_size[own_size > 0].tolist())) if sizes is None else sizes:
        gram, inside = windows(value, first, size)
        gram = mix(~(gram + np.uint64(size)))
        if sizes is None:
            inside &= own_size[text_of[: len(gram)]] == size
        if seen is not None:
            inside &= seen[(gram % np.uint64(BITS)).astype(np.int64)]
        at = np.flatnonzero(inside)
        none = pa.ListArray.from_arrays(pa.array(np.zeros(len(at) + 1, np.int32)), pa.array([], pa.int64()))
        yield text_of[at], at - first[text_of[at]], -size, gram[at], none, none


def document_windows(sizes, bits):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.unpackbits(np.frombuffer(bits.value, np.uint8)).astype(bool)
        for chunk in chunks(batches, "text"):
            ids, tkeys = np.asarray(chunk.column("id")), np.asarray(chunk.column("tkey"))
            for text, at, size, gram, slots, _ in template_windows(chunk.column("text"), sizes, seen):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[text]), pa.array(tkeys[text]), pa.array(at), pa.array(gram.view(np.int64)), slots],
                    ["id", "tkey", "at", "gram", "slots"],
                )

    return run


def item_windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in chunks(batches, "text"):
        for text, at, size, gram, slots, places in template_windows(chunk.column("text"), None, None):
            sizes = pa.array(np.full(len(at), size))
            yield pa.RecordBatch.from_arrays(
                [chunk.column("item").take(pa.array(text)), pa.array(at), sizes, pa.array(gram.view(np.int64)), slots, places],
                ["item", "item_at", "size", "gram", "item_slots", "places"],
            )


def agreeing(matches: Column) -> Column:
    """The matches whose pairs all follow the majority of places of their item value."""

    def let(value: Column, then) -> Column:
        return F.get(F.transform(F.array(value), then), F.lit(0))

    def values(pairs: Column) -> Column:
        return F.transform(pairs, lambda p: F.struct(p["item_slots"].alias("item"), p["slots"].alias("own")))

    def majority(held: Column) -> Column:
        def most(v: Column) -> Column:
            same = F.filter(held, lambda p: p["item"] == v["item"])
            return 2 * F.size(F.filter(held, lambda p: p == v)) > F.size(same)

        return F.filter(F.array_distinct(held), most)

    # One entry for each place: pairs are distinct by place and values.
    held = values(F.array_distinct(F.flatten(F.transform(matches, lambda m: m["pairs"]))))
    return let(
        let(held, majority), lambda agreed: F.filter(matches, lambda m: F.size(F.array_except(values(m["pairs"]), agreed)) == 0)
    )


_NULL_ID = -(1 << 63)


def find_leaks(docs: DataFrame, benchmark: DataFrame, min_cover: float = MIN_COVER) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text) with the items of ``benchmark``
    (item_id, text) that it holds: doc_id, text_key (xxhash64 of the text),
    contaminated, item_ids, cover (largest share of an item's windows)."""
    spark = docs.sparkSession
    # The smallest possible number stands for a null item id.
    item_id = F.coalesce(F.col("item_id").cast("long"), F.lit(_NULL_ID))
    items = benchmark.select(item_id.alias("item"), F.coalesce("text", F.lit("")).alias("text"))
    items = items.groupBy("text").agg(F.min("item").alias("item"))
    own = items.mapInArrow(item_windows, "item long, item_at long, size long, gram long, item_slots array<long>, places array<long>")
    slot = F.pmod(F.col("gram"), F.lit(BITS))
    # pmod of the signed number is its low bits, as the modulus is a power of two.
    marks = own.groupBy(slot.alias("slot"), "size").agg(F.lit(1)).toArrow()
    seen = np.zeros(BITS, dtype=np.uint8)
    seen[np.asarray(marks["slot"]).astype(np.int64)] = 1
    sizes = sorted(set(np.asarray(marks["size"]).tolist())) or [WINDOW, -WINDOW]
    bits = spark.sparkContext.broadcast(np.packbits(seen).tobytes())

    texts = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("id"), F.xxhash64("text").alias("tkey"), "text"
    )
    found = texts.mapInArrow(document_windows(sizes, bits), "id long, tkey long, at long, gram long, slots array<long>")
    own = own.withColumn("exact", F.col("size") < 0)
    size_of = own.groupBy("item", "exact").agg(F.count("gram").alias("windows"))
    pairs = F.arrays_zip("places", "item_slots", "slots").alias("pairs")
    aligned = (
        found.join(own, "gram")
        .groupBy("id", "tkey", "item", "exact", (F.col("at") - F.col("item_at")).alias("shift"))
        .agg(F.collect_set(F.struct("item_at", pairs)).alias("matches"))
    )
    # Neighbouring distances have one number.
    by_shift = Window.partitionBy("id", "tkey", "item", "exact").orderBy("shift")
    apart = F.coalesce((F.col("shift") - F.lag("shift").over(by_shift) > NEAR).cast("long"), F.lit(0))
    near = aligned.withColumn("apart", apart).withColumn("near", F.sum("apart").over(by_shift))
    near = near.groupBy("id", "tkey", "item", "exact", "near").agg(F.count("shift").alias("shifts"), F.flatten(F.collect_list("matches")).alias("matches"))
    aligned = aligned.drop("shift").unionByName(near.filter("shifts > 1").drop("near", "shifts"))
    aligned = (
        aligned.join(size_of, ["item", "exact"])
        .filter(F.size(F.array_distinct("matches.item_at")) >= min_cover * F.col("windows"))
        .withColumn("agreed", agreeing(F.col("matches")))
        .withColumn("cover", F.size(F.array_distinct("agreed.item_at")) / F.col("windows"))
    )
    leaks = (
        aligned.filter(F.col("cover") >= min_cover)
        .groupBy("id", "tkey")
        .agg(
            F.sort_array(F.collect_set("item")).alias("items"),
            F.max("cover").alias("cover"),
        )
    )
    judged = texts.select("id", "tkey").join(leaks, ["id", "tkey"], "left")
    no_null = F.transform("items", lambda i: F.when(i != _NULL_ID, i))
    return judged.select(
        F.when(F.col("id") != _NULL_ID, F.col("id")).alias("doc_id"),
        F.col("tkey").alias("text_key"),
        F.col("items").isNotNull().alias("contaminated"),
        F.coalesce(no_null, F.array().cast("array<long>")).alias("item_ids"),
        F.coalesce("cover", F.lit(0.0)).alias("cover"),
    )
