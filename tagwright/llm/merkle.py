"""Merkle manifest of documents: a root for all, and a witness for each.

A leaf hashes the columns of a row. Leaves of a tree (a lang) are appended in
order to open subtrees, one for each level. A subtree holds at most ``RUN``
members; with its last one it is complete, each member's witness grows by the
digests of the others, and the subtree's digest is appended one level up. So a
witness starts as a part (the leaf's own run) and is extended whenever a subtree
above it is completed.

Appends are distributed by aligned blocks of ``RUN`` to the power ``LEVELS``
leaves: a block is a group of its own, whose root and partial witnesses depend on
nothing outside it. The roots of a tree's blocks are further appends, again in
blocks, until one node is left; the roots of the trees, in order of their names,
are appended to the tree of trees in the same way. Coming back down, the witness
of a node extends those of all nodes below. Only digests travel, never texts, and
eight leaves share a row and all of their witness but the first level.

Inputs of a digest are lower-case hex texts without anything between; tables hold
the 32 bytes. Positions come from range partitions over (lang, doc_id, leaf), so
a tree that holds most rows is spread over tasks as others are.

Defined results: null columns hash as ``-``; a null lang is a tree of its own
before all others, a null doc_id comes last in its tree and is never altered;
rows of one doc_id stand in order of their leaves; a tree of one leaf has it as
its root, and a table of one row as the root of all, with the digest of nothing
as proof; very long texts are hashed in place; further columns play no part; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tagwright.operators.ordering import order_rows
from tagwright.session import write_shared

RUN = 8
LEVELS = 3  # of subtrees in a block
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_CHUNK = 65_536  # positions that share a join key
_RUN_SCHEMA = (
    "tree string, place long, run long, n long, leaves array<binary>, doc_ids array<long>,"
    " altered array<binary>, witness array<binary>, root binary"
)


def leaf(*columns: Column) -> Column:
    """Digest of columns: ``-`` if null, else bytes of UTF-8, a colon, the value."""
    parts = []
    for column in columns:
        value = column.cast("string")
        size = F.octet_length(value).cast("string")
        parts.append(F.coalesce(F.concat(size, F.lit(":"), value), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def digest(members: Iterable[bytes]) -> bytes:
    return hashlib.sha256("".join(m.hex() for m in members).encode()).digest()


class Appender:
    """Nodes appended one by one. ``open[level]`` lists the members of the open
    subtree: (digest, runs below). A run is (leaves, witness); the witness gets one
    entry a level: the place among the members, then the others' digests."""

    def __init__(self):
        self.open: list[list[tuple[bytes, list]]] = [[]]

    def append(self, node: bytes, below: list | None = None, level: int = 0) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append((node, below))
        if len(self.open[level]) == RUN:
            self.complete(level)

    def complete(self, level: int) -> None:
        members, self.open[level] = self.open[level], []
        digests = [m[0] for m in members]
        if level == 0:
            runs = [(digests, [])]
        else:
            for at, (_, below) in enumerate(members):
                entry = bytes([at]) + b"".join(digests[:at] + digests[at + 1 :])
                for _, witness in below:
                    witness.append(entry)
            runs = [run for _, below in members for run in below]
        self.append(digest(digests), runs, level + 1)

    def close(self, levels: int) -> tuple[bytes, list]:
        """Complete what is open, up to the only node of the level reached."""
        for level in range(levels):
            if self.open[level]:
                self.complete(level)
        if not levels:
            (node, _), = self.open[0]
            return node, [([node], [])]
        (node, runs), = self.open[levels]
        return node, runs


def levels_over(n: int) -> int:
    """Levels until one node is left of ``n``."""
    levels = 0
    while n > 1:
        n, levels = -(-n // RUN), levels + 1
    return levels


def append_block(levels: int):
    """Rows of runs from the nodes of one block of a tree."""

    def run(key: tuple, nodes: pa.Table) -> pa.Table:
        nodes = nodes.sort_by("place")
        n = nodes["n"][0].as_py()
        block = Appender()
        for node in nodes["leaf"].to_pylist():
            block.append(node)
        root, runs = block.close(levels_over(n) if n <= RUN**levels else levels)
        firsts = range(0, nodes.num_rows, RUN)
        cut = lambda name: [nodes[name].slice(i, RUN).to_pylist() for i in firsts]
        return pa.table(
            {
                "tree": pa.array([key[0].as_py()] * len(runs), pa.string()),
                "place": pa.array([key[1].as_py()] * len(runs), pa.int64()),
                "run": pa.array(range(len(runs)), pa.int64()),
                "n": pa.array([n] * len(runs), pa.int64()),
                "leaves": pa.array([leaves for leaves, _ in runs], pa.list_(pa.binary())),
                "doc_ids": pa.array(cut("doc_id"), pa.list_(pa.int64())),
                "altered": pa.array(cut("altered"), pa.list_(pa.binary())),
                "witness": pa.array([witness for _, witness in runs], pa.list_(pa.binary())),
                "root": pa.array([root] * len(runs), pa.binary()),
            }
        )

    return run


def append_nodes(nodes: DataFrame, levels: int) -> DataFrame:
    """The stored runs of nodes (tree, place, n, leaf, doc_id, altered), block by
    block: ``place`` is then the block's, itself a place among the tree's blocks."""
    blocks = nodes.withColumn("block", F.floor(F.col("place") / RUN**levels).cast("long"))
    return write_shared(blocks.groupBy("tree", "block").applyInArrow(append_block(levels), _RUN_SCHEMA))


def block_roots(runs: DataFrame, levels: int) -> DataFrame:
    """The root of each block as a node to be appended."""
    return runs.filter("run = 0").select(
        "tree",
        "place",
        F.ceil(F.col("n") / RUN**levels).cast("long").alias("n"),
        F.col("root").alias("leaf"),
        F.lit(None).cast("long").alias("doc_id"),
        F.lit(None).cast("binary").alias("altered"),
    )


def node_witnesses(runs: DataFrame, levels: int) -> DataFrame:
    """(tree, place, above): the witness of each node that was appended."""

    def spread(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (row["tree"], row["place"] * RUN**levels + row["run"] * RUN + at, own + row["witness"])
                for row in batch.to_pylist()
                for at, own in enumerate(first_entries(row["leaves"], row["n"]))
            ]
            trees, places, above = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(trees, pa.string()), pa.array(places, pa.int64()), pa.array(above, pa.list_(pa.binary()))],
                ["tree", "place", "above"],
            )

    return runs.select("tree", "place", "run", "n", "leaves", "witness").mapInArrow(
        spread, "tree string, place long, above array<binary>"
    )


def first_entries(leaves: list[bytes], n: int) -> list[list[bytes]]:
    """A run's own level in its members' witnesses; none where the member is the root."""
    if n == 1:
        return [[]]
    return [[bytes([at]) + b"".join(leaves[:at] + leaves[at + 1 :])] for at in range(len(leaves))]


def grow(nodes: DataFrame, levels: int) -> tuple[DataFrame, list[DataFrame]]:
    """Append nodes until every tree has one. Returns these roots (tree, leaf) and
    the runs of each round, the lowest first."""
    rounds = [append_nodes(nodes, levels)]
    while not rounds[-1].filter(F.col("n") > RUN**levels).isEmpty():
        rounds.append(append_nodes(block_roots(rounds[-1], levels), levels))
    return rounds[-1].filter("run = 0").select("tree", F.col("root").alias("leaf")), rounds


def extend(above: DataFrame, runs: DataFrame) -> DataFrame:
    """Runs with what the witnesses (tree, place, above) of their blocks add;
    further columns of ``above`` go along."""
    over = above.withColumnsRenamed({"tree": "_tree", "place": "_place"})
    same = runs["tree"].eqNullSafe(F.col("_tree")) & (runs["place"] == F.col("_place"))
    joined = runs.join(over, same).withColumn("witness", F.concat("witness", "above"))
    return joined.drop("_tree", "_place", "above")


def places(leaves: DataFrame) -> DataFrame:
    """Nodes of leaves (lang, doc_id, leaf, altered, row) with their places."""
    keyed = leaves.withColumn("named", F.col("lang").isNotNull())
    at = order_rows(keyed, ["named", "lang", "doc_id", "leaf", "row"]).with_position()
    trees = at.groupBy(F.col("lang").alias("tree")).agg(F.min("position").alias("first"), F.count(F.lit(1)).alias("n"))
    chunk = lambda c: F.floor(c / _CHUNK).cast("long")
    last = F.col("first") + F.col("n") - 1
    trees = trees.withColumn("chunk", F.explode(F.sequence(chunk(F.col("first")), chunk(last))))
    # Keys by chunk, so that a large tree is many keys.
    same = F.col("lang").eqNullSafe(F.col("tree")) & (chunk(F.col("position")) == F.col("chunk"))
    return at.join(trees, same).select(
        "tree", (F.col("position") - F.col("first")).alias("place"), "n", "leaf", "doc_id", "altered"
    )


def fold(node: bytes, witness: list[bytes], known: dict) -> bytes:
    """The root that a node and the digests beside its way up give."""
    if node not in known:
        up = node
        for entry in witness:
            at = 1 + 32 * entry[0]
            up = hashlib.sha256((entry[1:at].hex() + up.hex() + entry[at:].hex()).encode()).digest()
        known[node] = up
    return known[node]


_PROOFS = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
)


def check_proofs(root: bytes) -> Callable:
    """Rows of ``_PROOFS`` from extended runs."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                known: dict[bytes, bytes] = {}
                rest = "".join(entry[1:].hex() for entry in r["witness"])
                for doc_id, node, altered, own in zip(r["doc_ids"], r["leaves"], r["altered"], first_entries(r["leaves"], r["n"])):
                    proof = "".join(entry[1:].hex() for entry in own) + rest
                    above = fold(altered or node, own, {})
                    folded = fold(above, r["witness"], known)
                    rows.append(
                        (doc_id, node.hex(), r["subroot"].hex(), root.hex(), hashlib.sha256(proof.encode()).hexdigest(), folded.hex(), folded == root)
                    )
            yield pa.RecordBatch.from_pylist(
                [dict(zip(_NAMES, row)) for row in rows],
                schema=pa.schema([(n, pa.int64() if n == "doc_id" else pa.bool_() if n == "verified" else pa.string()) for n in _NAMES]),
            )

    return run


_NAMES = [part.split()[0] for part in _PROOFS.split(", ")]


def manifest(docs: DataFrame, altered: Column | None = None, levels: int = LEVELS) -> tuple[DataFrame, bytes]:
    """Runs of all rows of ``docs`` with whole witnesses and their tree's
    ``subroot``, and the root of all (empty for an empty table). ``altered`` is
    the digest of another version of the row, null where there is none."""
    leaves = write_shared(
        docs.select(
            "lang",
            F.col("doc_id").cast("long").alias("doc_id"),
            leaf(*[F.col(c) for c in COLUMNS]).alias("leaf"),
            (F.lit(None).cast("binary") if altered is None else altered).alias("altered"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    subroots, rounds = grow(places(leaves), levels)
    subroots = write_shared(
        subroots.select(
            F.col("tree").alias("lang"), "leaf", F.lit(None).cast("long").alias("doc_id"),
            F.lit(None).cast("binary").alias("altered"), F.lit(0).alias("row"),
        )
    )
    keyed = subroots.withColumn("named", F.col("lang").isNotNull())
    ordered = order_rows(keyed, ["named", "lang"])
    at = ordered.with_position().withColumnRenamed("position", "place")
    trees = at.select(
        F.lit("").alias("tree"), "place", F.lit(ordered.total).cast("long").alias("n"), "leaf", "doc_id", "altered"
    )
    if not ordered.total:
        return extend_down(rounds, None, levels), b""
    tops, top_rounds = grow(trees, levels)
    root = bytes(tops.first()["leaf"])

    # The ways from the trees' roots to the root of all, then down the rounds.
    above = tops.select("tree", F.lit(0).cast("long").alias("place"), F.array().cast("array<binary>").alias("above"))
    for runs in reversed(top_rounds):
        above = node_witnesses(extend(above, runs), levels)
    named = at.select("lang", "place", F.col("leaf").alias("subroot")).withColumnRenamed("place", "_at")
    above = above.join(named, F.col("place") == F.col("_at")).select(
        F.col("lang").alias("tree"), F.lit(0).cast("long").alias("place"), "above", "subroot"
    )
    return extend_down(rounds, above, levels), root


def extend_down(rounds: list[DataFrame], above: DataFrame | None, levels: int) -> DataFrame:
    """The lowest runs with all that the rounds above them add. ``above`` has one
    row a tree, whose ``subroot`` goes along."""
    if above is None:
        return rounds[0].withColumn("subroot", F.lit(None).cast("binary"))
    roots = above.select(F.col("tree").alias("_name"), "subroot")
    above = above.drop("subroot")
    for runs in reversed(rounds[1:]):
        above = node_witnesses(extend(above, runs), levels)
    above = above.join(roots, F.col("tree").eqNullSafe(F.col("_name"))).drop("_name")
    return extend(above, rounds[0])


def verify(docs: DataFrame, altered: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """Per row: its leaf, its tree's root, the root, the digest of its witness, and
    the root recomputed from the altered (else the own) leaf and the witness."""
    runs, root = manifest(docs, altered, levels)
    return runs.select("leaves", "doc_ids", "altered", "witness", "n", "subroot").mapInArrow(check_proofs(root), _PROOFS)


def lower_cased() -> Column:
    """The leaf of a row whose text has a-z for A-Z, where three divides the
    CRC-32 of the id; null elsewhere."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    columns = [F.col(c) for c in COLUMNS[:-1]]
    other = leaf(*columns, F.translate(F.col("text"), upper, upper.lower()))
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, other)
