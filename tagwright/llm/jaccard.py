"""N-gram Jaccard join of whole texts by prefix trees.

A document is the set of its word n-grams, written in one global order, rare
first: by the logarithm of the corpus count of a gram's bucket, then by hash.
Two sets whose Jaccard similarity reaches the threshold share a gram among the
first ``n - ceil(t n) + 1`` of each (prefix filter).

1. Equal sets are one class, held by its smallest id.
2. Classes that share a prefix gram and have fitting sizes form a run. In short
   runs a parity sketch, a lower bound of the grams that two sets do not share,
   rules out what merely has a passage in common; long runs are tied to their
   first set, never pair by pair. The connected groups hold every possible link.
3. The sets of a group are split into blocks of bounded size. In each block a
   prefix tree stores the sets in global order; a set walks the tree once,
   sharing the overlap counted along common paths, and leaves a subtree when
   sizes or the remaining lengths cannot reach the threshold. Subtrees whose only
   set is already connected to the walker are skipped, so a dense group of near
   copies costs about one comparison for each member. The group's first set
   visits all its blocks.
4. Sets of a split group that are not connected yet meet the others in blocks of
   two parts; two parts of one connected class never meet again.

Links and components are exact: every pair at or above the threshold is
connected. Hashes have 58 bits; they are only compared inside a pair.

Defined results: null and empty texts have an empty set and no links; with fewer
words than ``k`` the whole sequence is the one gram; rows of one id are one
document for linking (repeated rows, or other texts of that id); a null id counts
as smaller than all others and is given back as null; columns of other names play
no part; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tagwright.llm.counts import bucket_counts
from tagwright.llm.graph import components
from tagwright.llm.words import Words, chunks, mix, windows, words_of
from tagwright.session import write_shared

# Buckets of the corpus counts behind the global order: a fixed size. Any order
# gives the same result; this one only keeps common grams out of the prefixes.
COUNT_BUCKETS = 1 << 20
# Bits that keep back texts which are in no group, before an exact join: a fixed
# size; a fuller table lets more rows through to that join.
MEMBER_BITS = 1 << 24
# Sets and grams that one part of a block holds.
PART_SETS = 128
# Sets of a run that are compared by sketches; a longer run is tied to its first
# set, and the blocks compare it.
RUN_SETS = 2048
PART_GRAMS = 1 << 18

_NULL_ID = -(1 << 63)
_PIECE = 64


def grams_of(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-grams of a chunk, and the text each is in."""
    hashes = words.hashes(lower=True)
    gram, inside = windows(hashes, words.first, k)
    at = np.flatnonzero(inside)
    text = np.searchsorted(words.first, at, "right") - 1
    short = np.flatnonzero((np.diff(words.first) > 0) & (np.diff(words.first) < k))
    whole = []
    for t in short:
        own = hashes[words.first[t] : words.first[t + 1]]
        whole.append(mix(windows(own, np.array([0, len(own)]), len(own))[0][:1] + np.uint64(len(own))))
    if whole:
        return np.concatenate([gram[at], *whole]), np.concatenate([text, short])
    return gram[at], text


def ordered(gram: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """The gram as a number whose order is the global order."""
    bucket = (gram >> np.uint64(6)) % np.uint64(len(rarity))
    return (rarity[bucket].astype(np.uint64) << np.uint64(58)) | (gram >> np.uint64(6))


def rarity_of(docs: DataFrame, k: int, buckets: int = COUNT_BUCKETS) -> np.ndarray:
    """Per bucket the logarithm of how many grams of the corpus fall in it."""
    counts = bucket_counts(docs, buckets, lambda texts: grams_of(words_of(texts), k)[0] >> np.uint64(6))
    return np.minimum(np.log2(np.maximum(counts, 1)) + 1, 63).astype(np.uint8)


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n - -(-n * percent // 100) + 1


def sets_of(chunk: pa.RecordBatch, k: int, rarity: np.ndarray) -> list[np.ndarray]:
    """The set of each text in global order."""
    words = words_of(chunk.column("text"))
    gram, text = grams_of(words, k)
    gram = ordered(gram, rarity)
    order = np.argsort(text, kind="stable")
    cuts = np.searchsorted(text[order], np.arange(1, words.n_texts))
    return [np.unique(own) for own in np.split(gram[order], cuts)]


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*parts, np.empty(0, np.uint64)]).view(np.int64)))


def describe(k: int, percent: int, rarity):
    """(id, n, sig1, sig2, prefix, sketch) of each text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, "text"):
            sets = sets_of(chunk, k, rarity.value)
            n = np.array([len(s) for s in sets], dtype=np.int64)
            sig1 = np.array([mix(s).sum() for s in sets], dtype=np.uint64)
            sig2 = np.array([mix(s ^ np.uint64(0xA0761D6478BD642F)).sum() for s in sets], dtype=np.uint64)
            prefixes = [s[: p if len(s) else 0] for s, p in zip(sets, prefix_length(n, percent))]
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column("id"),
                    pa.array(n),
                    pa.array(sig1.view(np.int64)),
                    pa.array(sig2.view(np.int64)),
                    _lists(prefixes),
                    pa.array([sketch_of(s) for s in sets], pa.binary()),
                ],
                ["id", "n", "sig1", "sig2", "prefix", "sketch"],
            )

    return run


def _runs(gram: np.ndarray, low: np.ndarray, high: np.ndarray, percent: int) -> np.ndarray:
    """Starts of runs in rows by (gram, low): a run ends where the gram changes
    or the next size is beyond reach of all before it."""
    reach = np.ones(len(gram), dtype=bool)
    changed = np.ones(len(gram), dtype=bool)
    changed[1:] = gram[1:] != gram[:-1]
    # The largest size so far inside the gram: sizes offset by the gram's number.
    group = np.cumsum(changed).astype(np.int64) << 33
    most = np.maximum.accumulate(group + high)
    reach[1:] = (low[1:] * percent > 100 * (most[:-1] - group[:-1])) | changed[1:]
    return np.flatnonzero(reach)


def send_prefixes(percent: int):
    """Rows (gram, low, high, ids, other): a run of fitting sizes in the chunk,
    with its ids, or only the first if they are more than ``RUN_SETS``; then also
    edges ids[0] - other that tie the run together (gram free)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("prefix")
            counts = np.diff(np.asarray(lists.offsets))
            gram = np.asarray(lists.flatten())
            ids = np.repeat(np.asarray(batch.column("id")), counts)
            n = np.repeat(np.asarray(batch.column("n")), counts)
            order = np.lexsort((ids, n, gram))
            gram, ids, n = gram[order], ids[order], n[order]
            if not len(gram):
                continue
            starts = _runs(gram, n, n, percent)
            sizes = np.diff(np.append(starts, len(gram)))
            large = sizes > RUN_SETS
            keep = np.repeat(~large, sizes)
            keep[starts] = True
            hub = np.repeat(ids[starts], sizes)
            inner = np.unique(np.stack([ids, hub])[:, ~keep & (ids != hub)], axis=1)
            held = np.append(np.where(large, 1, sizes), np.ones(inner.shape[1], np.int64))
            listed = pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum(held)).astype(np.int32)), pa.array(np.append(ids[keep], inner[0]))
            )
            none = np.zeros(inner.shape[1], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.append(gram[starts], mix(inner[0].astype(np.uint64)).view(np.int64))),
                    pa.array(np.append(n[starts], none)),
                    pa.array(np.append(n[starts + sizes - 1], none)),
                    listed,
                    pa.concat_arrays([pa.nulls(len(starts), pa.int64()), pa.array(inner[1])]),
                    pa.array(np.append(large, none.astype(bool))),
                ],
                ["gram", "low", "high", "ids", "other", "large"],
            )

    return run


def join_runs(percent: int):
    """Rows (ids) from rows in order of (gram, low): the ids of a run of several
    sets, if they are at most ``RUN_SETS``; otherwise pairs of ids that tie the
    run to its first set, ``tied``. One open run is kept, with as many ids."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, most, held, large, hub = None, 0, [], False, None
        for batch in batches:
            out: set[tuple[tuple[int, ...], bool]] = set()

            def close() -> None:
                if not large and len(held) > 1:
                    out.add((tuple(held), False))

            rows = zip(*(batch.column(c).to_pylist() for c in ("gram", "low", "high", "ids", "other", "large")))
            for g, low, high, ids, other, many in rows:
                if other is not None:
                    out.add(((ids[0], other), True))
                    continue
                if g != gram or low * percent > 100 * most:
                    close()
                    gram, most, held, large, hub = g, 0, [], False, ids[0]
                most = max(most, high)
                if large or many or len(held) + len(ids) > RUN_SETS:
                    out.update(((i, hub), True) for i in [*held, *ids] if i != hub)
                    held, large = [], True
                else:
                    held = sorted({*held, *ids})
            yield _found(out)
        out = set()
        if not large and len(held) > 1:
            out.add((tuple(held), False))
        yield _found(out)

    return run


def _found(out: set[tuple[tuple[int, ...], bool]]) -> pa.RecordBatch:
    rows = sorted(out)
    return pa.RecordBatch.from_arrays(
        [pa.array([list(ids) for ids, _ in rows], pa.list_(pa.int64())), pa.array([tied for _, tied in rows], pa.bool_())],
        ["ids", "tied"],
    )


def sketch_of(grams: np.ndarray) -> bytes:
    """For each of 2^k slots, at least as many as grams, whether an odd number of
    grams falls in it. Two sketches differ in at most as many slots as grams
    stand in one set only; folding halves onto each other keeps that true."""
    slots = max(64, 1 << int(len(grams) - 1).bit_length())
    odd = np.bincount((mix(grams ^ np.uint64(0x8EBC6AF09C88C6E3)) % np.uint64(slots)).astype(np.int64), minlength=slots) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def near_pairs(percent: int):
    """Edges (a, b) that connect the sets of each run whose sketches do not rule
    the threshold out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edges: list[tuple[int, int]] = []
            for sets in batch.column("sets").to_pylist():
                edges += _near(sets, percent)
            pairs = sorted(set(edges))
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in pairs], pa.int64()), pa.array([b for _, b in pairs], pa.int64())], ["a", "b"]
            )

    return run


def _near(sets: list[dict], percent: int) -> list[tuple[int, int]]:
    sets = sorted(sets, key=lambda s: (s["n"], s["id"]))
    n = np.array([s["n"] for s in sets])
    label, edges = np.arange(len(sets)), []
    sketches = [np.frombuffer(s["sketch"], dtype=np.uint64) for s in sets]
    for i, own in enumerate(sketches):
        reach = np.flatnonzero((n * percent <= 100 * n[i]) & (np.arange(len(sets)) > i) & (label != label[i]))
        if not len(reach):
            continue
        others = np.stack([_fold(sketches[j], len(own)) for j in reach])
        differ = np.bitwise_count(others ^ own).sum(axis=1)
        total = n[reach] + n[i]
        allowed = total - 2 * -(-percent * total // (100 + percent))
        for j in reach[differ <= allowed]:
            if label[j] != label[i]:
                edges.append((sets[j]["id"], sets[i]["id"]))
                label[label == label[j]] = label[i]
    return edges


def _fold(sketch: np.ndarray, size: int) -> np.ndarray:
    while len(sketch) > size:
        half = len(sketch) // 2
        sketch = sketch[:half] ^ sketch[half:]
    return sketch


class PrefixTree:
    """Sets in global order, paths without a branch in one node.

    A node: the grams on its path, its depth at the end of the path, smallest and
    largest size below it, children by first gram, sets that end here, and the
    only set below it if there is one.
    """

    def __init__(self):
        self.root = [np.empty(0, np.uint64), 0, 1 << 62, 0, {}, [], None]

    def add(self, grams: np.ndarray, item: int) -> None:
        node, at, n = self.root, 0, len(grams)
        while True:
            node[2], node[3] = min(node[2], n), max(node[3], n)
            if at == n:
                node[5].append(item)
                return
            child = node[4].get(grams[at])
            if child is None:
                node[4][grams[at]] = [grams[at:], n, n, n, {}, [item], item]
                return
            path = child[0]
            m = min(len(path), n - at)
            differ = np.flatnonzero(path[:m] != grams[at : at + m])
            shared = int(differ[0]) if len(differ) else m
            if shared < len(path):  # the path branches here
                top = [path[:shared], at + shared, child[2], child[3], {path[shared]: child}, [], None]
                child[0] = path[shared:]
                node[4][grams[at]] = child = top
            child[6] = None
            node, at = child, at + shared

    def walk(self, grams: np.ndarray, percent: int, settled, found) -> None:
        """Call ``found(item)`` for every set that reaches the threshold, but for
        subtrees whose only set is ``settled(item)``."""
        n = len(grams)
        stack = [(child, 0, 0) for child in self.root[4].values()]
        while stack:
            node, overlap, at = stack.pop()
            path, depth, low, high, children, items, only = node
            if high * 100 < n * percent or n * 100 < low * percent:
                continue
            if only is not None and settled(only):
                continue
            # What any set below must share, at least.
            least = max(low, -(-n * percent // 100))
            needed = -(-percent * (n + least) // (100 + percent))
            start, left = 0, high - depth + len(path)
            while start < len(path):
                piece = path[start : start + (_PIECE if start == 0 else len(path))]
                spot = np.searchsorted(grams, piece)
                overlap += int(np.count_nonzero(grams[np.minimum(spot, n - 1)] == piece))
                at = int(spot[-1])
                start += len(piece)
                left -= len(piece)
                if overlap + min(n - at, left) < needed:
                    break
            else:
                for item in items:
                    if (100 + percent) * overlap >= percent * (n + depth) and not settled(item):
                        found(item)
                stack.extend((child, overlap, at) for child in children.values())


def links_of(ids: list[int], sets: list[np.ndarray], labels: list[int], percent: int) -> list[tuple[int, int]]:
    """Links that connect what is not connected yet; equal labels are connected."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while above.get(x, x) != x:
            above[x] = x = above.get(above[x], above[x])
        return x

    tree, links = PrefixTree(), []
    for me in sorted(range(len(ids)), key=lambda i: (len(sets[i]), ids[i])):

        def settled(item: int) -> bool:
            return top(labels[item]) == top(labels[me])

        def found(item: int) -> None:
            links.append((ids[me], ids[item]))
            above[top(labels[me])] = top(labels[item])

        tree.walk(sets[me], percent, settled, found)
        tree.add(sets[me], me)
    return links


def link_blocks(percent: int):
    def run(block: pa.Table) -> pa.Table:
        rows = block.combine_chunks()
        lists = rows["grams"].combine_chunks()
        offsets = np.asarray(lists.offsets)
        values = np.asarray(lists.values).view(np.uint64)
        sets = [values[a:b] for a, b in zip(offsets, offsets[1:])]
        links = links_of(rows["id"].to_pylist(), sets, rows["label"].to_pylist(), percent)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return run


def member_bits(ids: DataFrame) -> bytes:
    """A bit for each id in a table of ``MEMBER_BITS``; the driver gets the table."""
    slots = ids.select(F.pmod(F.xxhash64("id"), F.lit(MEMBER_BITS)).alias("slot"))
    bit = F.expr("shiftleft(1L, cast(slot % 64 as int))")
    words = slots.groupBy(F.shiftright("slot", 6).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    table = np.zeros(MEMBER_BITS // 64, dtype=np.int64)
    table[np.asarray(words["word"])] = np.asarray(words["bits"])
    return table.tobytes()


def whole_sets(texts: DataFrame, seats: DataFrame, k: int, rarity) -> DataFrame:
    """``seats`` (id, ...) with the sets (``grams``) of their texts."""
    bits = texts.sparkSession.sparkContext.broadcast(member_bits(seats))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(bits.value, dtype=np.uint64)
        for batch in batches:
            slot = np.asarray(batch.column("slot"))
            member = (table[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1)
            for chunk in chunks([batch.filter(pa.array(member.astype(bool)))], "text"):
                yield pa.RecordBatch.from_arrays([chunk.column("id"), _lists(sets_of(chunk, k, rarity.value))], ["id", "grams"])

    slotted = texts.withColumn("slot", F.pmod(F.xxhash64("id"), F.lit(MEMBER_BITS)))
    return seats.join(slotted.mapInArrow(run, "id long, grams array<long>"), "id")


def _parts(sets: str, grams: str):
    return F.greatest(F.ceil(F.col(sets) / PART_SETS), F.ceil(F.col(grams) / PART_GRAMS)).cast("long")


def _part_of(parts: str):
    return F.pmod(F.xxhash64("id"), F.col(parts))


def jaccard_components(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id,
    the smallest doc_id that links of at least ``percent`` / 100 reach."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("id"), "text")
    rarity = spark.sparkContext.broadcast(rarity_of(texts, k))
    described = write_shared(
        texts.mapInArrow(describe(k, percent, rarity), "id long, n long, sig1 long, sig2 long, prefix array<long>, sketch binary")
    )
    same = ["n", "sig1", "sig2"]
    classes = write_shared(described.filter("n > 0").groupBy(*same).agg(F.min("id").alias("rep")))
    firsts = described.join(classes.withColumnRenamed("rep", "id"), [*same, "id"], "left_semi")
    sent = firsts.select("id", "n", "prefix").mapInArrow(
        send_prefixes(percent), "gram long, low long, high long, ids array<long>, other long, large boolean"
    )
    runs = sent.repartition("gram").sortWithinPartitions("gram", "low").mapInArrow(join_runs(percent), "ids array<long>, tied boolean")
    runs = write_shared(runs.distinct())
    tied = runs.filter("tied").select(F.get("ids", F.lit(0)).alias("a"), F.get("ids", F.lit(1)).alias("b"))
    seats = runs.filter("not tied").select("ids", F.explode("ids").alias("id"))
    sketches = seats.join(firsts.select("id", "n", "sketch"), "id").groupBy("ids")
    sketches = sketches.agg(F.collect_list(F.struct("id", "n", "sketch")).alias("sets"))
    groups = components(tied.union(sketches.select("sets").mapInArrow(near_pairs(percent), "a long, b long")))

    sizes = classes.groupBy(F.col("rep").alias("node")).agg(F.sum("n").alias("n"))
    members = write_shared(groups.join(sizes, "node").select(F.col("node").alias("id"), F.col("label").alias("grp"), "n"))
    parts = members.groupBy("grp").agg(F.count("id").alias("sets"), F.sum("n").alias("grams"))
    parts = parts.select("grp", _parts("sets", "grams").alias("parts"))
    placed = members.join(parts, "grp")
    everywhere = F.when(F.col("id") == F.col("grp"), F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    blocks = placed.select(
        "id", "grp", F.explode(F.coalesce(everywhere, F.array(_part_of("parts")))).alias("block"), F.col("id").alias("label")
    )
    seated = whole_sets(texts, write_shared(blocks), k, rarity)
    links = write_shared(seated.groupBy("grp", "block").applyInArrow(link_blocks(percent), "a long, b long"))
    connected = components(links)

    # What blocks of split groups left apart meets across parts.
    split = placed.filter("parts > 1").join(connected.withColumnRenamed("node", "id"), "id", "left")
    split = write_shared(split.select("id", "grp", "n", F.coalesce("label", "id").alias("label")))
    by_label = split.groupBy("grp", "label").agg(F.count("id").alias("sets"), F.sum("n").alias("grams"))
    several = by_label.groupBy("grp").agg(F.count("label").alias("labels")).filter("labels > 1").select("grp")
    # A connected class that fills a part keeps parts of its own; small ones share.
    own = F.when((F.col("sets") >= PART_SETS) | (F.col("grams") >= PART_GRAMS), F.col("label"))
    by_label = by_label.join(several, "grp").withColumn("own", own)
    pools = by_label.groupBy("grp", "own").agg(F.sum("sets").alias("sets"), F.sum("grams").alias("grams"))
    pools = write_shared(pools.select("grp", "own", _parts("sets", "grams").alias("parts")))
    spots = pools.select("grp", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    spots = spots.withColumn("spot", F.struct("own", "part"))
    other = spots.select(F.col("grp"), F.col("own").alias("own2"), F.col("spot").alias("spot2"))
    meets = spots.join(other, "grp").filter(
        (F.col("spot") <= F.col("spot2")) & (F.col("own").isNull() | F.col("own2").isNull() | (F.col("own") != F.col("own2")))
    )
    meets = meets.select("grp", F.explode(F.array_distinct(F.array("spot", "spot2"))).alias("spot"), F.xxhash64("spot", "spot2").alias("block"))
    seated = (
        split.join(by_label.select("grp", "label", "own"), ["grp", "label"])
        .join(pools.withColumnRenamed("own", "_own").withColumnRenamed("grp", "_grp"), (F.col("grp") == F.col("_grp")) & F.col("own").eqNullSafe(F.col("_own")))
        .select("id", "grp", "label", F.struct("own", _part_of("parts").alias("part")).alias("spot"))
    )
    rest = write_shared(seated.join(meets, ["grp", "spot"]).select("id", "grp", "block", "label"))
    more = whole_sets(texts, rest, k, rarity).groupBy("grp", "block").applyInArrow(link_blocks(percent), "a long, b long")
    connected = components(links.union(more))

    labels = classes.select(*same, "rep").join(connected.withColumnRenamed("node", "rep"), "rep", "left")
    labels = labels.select(*same, F.coalesce("label", "rep").alias("component"))
    found = described.select("id", *same).join(labels, same, "left")
    component = F.coalesce("component", "id")
    return found.select(
        F.when(F.col("id") != _NULL_ID, F.col("id")).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(component != _NULL_ID, component).alias("component_id"),
    )
