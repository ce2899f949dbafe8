"""Merkle manifest, packing and search against plain versions."""

from __future__ import annotations

import bisect
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tagwright.llm import merkle, packing, search, tokens, units
from tagwright.llm.units import UnitEncoder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, place long, length int"


def rows() -> list[tuple]:
    rng = random.Random(11)
    out = []
    for i in range(700):
        text = " ".join(rng.choices(["alpha", "Beta", "gamma7", "é", "don't", "x-y"], k=rng.randrange(0, 30)))
        out.append((i * 3, text, rng.choice(["en"] * 9 + ["de"]), "s", len(text), "t", 1, 2))
    out.append((5, "only one", "zu", "s", 8, None, None, None))
    out += [(7, None, None, None, None, "t", 1, 2), (8, "", None, "s", 0, "t", 1, 2), (8, "", None, "s", 0, "t", 1, 2)]
    out += [(None, "no id", "en", "s", 5, "t", 1, 2), (3, "another text of id 3", "en", "s", 1, "t", 1, 2)]
    out.append((9, "Word " * 30_000, "en", "s", 150_000, "t", 1, 2))
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(5)


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def value(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain_manifest(docs):
    def leaf_of(r, text):
        return h(*[value(v) for v in (r[0], r[3], r[2], r[4], text)])

    def climb(nodes):
        """Levels of a tree, each a list of nodes."""
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([h(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
        return levels

    def way(levels, at):
        for level in levels[:-1]:
            run = level[at // 8 * 8 : at // 8 * 8 + 8]
            yield run[: at % 8], run[at % 8 + 1 :]
            at //= 8

    trees = {}
    for r in docs:
        trees.setdefault(r[2], []).append((r[0] is None, r[0], leaf_of(r, r[1]), r))
    names = sorted(trees, key=lambda n: (n is not None, (n or "").encode()))
    for n in names:
        trees[n].sort(key=lambda t: t[:3] if t[1] is not None else (True, 0, t[2]))
    levels = {n: climb([t[2] for t in trees[n]]) for n in names}
    top = climb([levels[n][-1][0] for n in names])
    out = []
    for i, n in enumerate(names):
        for at, (_, doc_id, own, r) in enumerate(trees[n]):
            sides = [*way(levels[n], at), *way(top, i)]
            folded = own
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and r[1] is not None:
                folded = leaf_of(r, re.sub("[A-Z]", lambda m: m[0].lower(), r[1]))
            for before, after in sides:
                folded = h(*before, folded, *after)
            root = top[-1][0]
            proof = h(*[x for before, after in sides for x in before + after])
            out.append((doc_id, own, levels[n][-1][0], root, proof, folded, folded == root))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("levels", [1, 3])
def test_manifest(docs, levels):
    """With blocks of 8, roots of blocks are appended over several rounds."""
    got = [tuple(r) for r in merkle.verify(docs, merkle.lower_cased(), levels).collect()]
    assert order(got) == order(plain_manifest(rows()))
    assert 0 < sum(not r[-1] for r in got) < len(got)


def test_manifest_of_small_tables(spark, docs):
    assert merkle.verify(docs.limit(0), merkle.lower_cased()).collect() == []
    one = spark.createDataFrame(rows()[:1], SCHEMA)
    assert [tuple(r) for r in merkle.verify(one).collect()] == [
        (i, leaf, leaf, leaf, h(), leaf, True) for i, leaf, *_ in plain_manifest(rows()[:1])
    ]


def test_appending_completes_subtrees_as_they_fill():
    tree, leaves = merkle.Appender(), [hashlib.sha256(bytes([i])).digest() for i in range(20)]
    for i, leaf in enumerate(leaves):
        tree.append(leaf)
        assert len(tree.open[0]) == (i + 1) % 8
    root, runs = tree.close(merkle.levels_over(20))
    assert root == merkle.digest([merkle.digest(leaves[i : i + 8]) for i in (0, 8, 16)])
    for leaves_of, witness in runs:
        own = merkle.first_entries(leaves_of, 20)
        assert all(merkle.fold(leaf, first + witness, {}) == root for leaf, first in zip(leaves_of, own))


def plain_best_fit(lengths, capacity):
    rooms, used = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(rooms, length)
        used += at == len(rooms)
        room = (rooms.pop(at) if at < len(rooms) else capacity) - length
        bisect.insort(rooms, room)
    return used


@pytest.mark.parametrize("seed", range(40))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([5, 16, 100, 4096])
    counts = {n: rng.randint(1, 60) for n in rng.sample(range(1, capacity + 1), min(capacity, 40))}
    placed, numbered = {}, Counter()
    for length, number, n, first, offset, each in packing.best_fit(counts, capacity).tolist():
        assert numbered[length] == number
        numbered[length] += n
        for i in range(n):
            placed.setdefault(first + i // each, []).append((offset + i % each * length, length))
    assert numbered == counts
    for pieces in placed.values():
        ends = np.cumsum([0] + [n for _, n in sorted(pieces)])
        assert [at for at, _ in sorted(pieces)] == ends[:-1].tolist() and ends[-1] <= capacity
    assert len(placed) == plain_best_fit(counts.elements() if isinstance(counts, Counter) else Counter(counts).elements(), capacity)


def test_plan_does_not_grow_with_the_pieces():
    few = packing.best_fit({n: 1_000 + n for n in range(1, 4097)})
    many = packing.best_fit({n: 1_000_000_000 + n for n in range(1, 4097)})
    assert len(many) < 3 * 4096 * 12 and len(few) < 3 * 4096 * 12


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.default_tokenizer())


@pytest.mark.parametrize("words", [True, False])
def test_units_give_the_tokenizers_ids(monkeypatch, words):
    from tokenizers import Tokenizer

    monkeypatch.setattr(units, "KEPT_BYTES", 20_000)  # the table starts anew several times
    path = packing.default_tokenizer() if words else tokens.default_tokenizer()
    plain, own = Tokenizer.from_file(path), UnitEncoder(path, words)
    rng = random.Random(2)
    marks = "abXYZéÉßİΣσς̈́'’stred.,;:!0123$&_-\x85\xa0　​ \x1c\x00\t\n\r\x0b字ｱ🙂½²×÷ª<|>"
    few = "abXYZéÉß' st re.,;!?019$_-\t\n  "
    texts = ["", " ", "  ", "\n", "a\n\nb", "a \n b", " <|endoftext|>", "a  <|endoftext|>", "a<|startoftext|>b c"]
    texts += [None, "don't I'LL 'tis", "x" * 200 + " y " + "x" * 200, "x" * 200_000]
    texts += ["".join(rng.choice(marks if i % 2 else few) for _ in range(rng.randrange(60))) for i in range(2_000)]
    for some in ([t] for t in texts[:40]):
        ids, _ = own.encode(units.pa.array(some, units.pa.string()))
        assert ids.tolist() == plain.encode(some[0] or "", add_special_tokens=False).ids, some
    for at in range(0, len(texts), 100):
        some = texts[at : at + 100]
        ids, bounds = own.encode(units.pa.array(some, units.pa.string()))
        for text, a, b in zip(some, bounds, bounds[1:]):
            assert ids[a:b].tolist() == plain.encode(text or "", add_special_tokens=False).ids, text
        assert own.kept_bytes() < 200_000 + 20_000


def test_packing(docs):
    plain, want = tokenizer(), []
    lengths = []
    for r in rows():
        ids = np.array(plain.encode(r[1] or "", add_special_tokens=False).ids + [1], "<u4")
        for piece, start in enumerate(range(0, len(ids), 256)):
            own = ids[start : start + 256]
            lengths.append(len(own))
            want.append((r[0], piece, start, len(own), zlib.crc32(own.tobytes())))
    sequences = packing.pack_documents(docs, capacity=256)
    got = packing.piece_table(sequences).collect()
    assert order([tuple(r)[:5] for r in got]) == order(want)
    placed = {}
    for r in got:
        placed.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in placed.values():
        ends = np.cumsum([0] + [n for _, n in sorted(pieces)])
        assert [at for at, _ in sorted(pieces)] == ends[:-1].tolist() and ends[-1] <= 256
    assert len(placed) == plain_best_fit(lengths, 256)
    assert packing.piece_table(packing.pack_documents(docs.limit(0))).collect() == []


def terms_of(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text)


def plain_ranks(docs, items, k=10):
    counts = [(r[0], Counter(terms_of(r[1]))) for r in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n, total = len(counts), sum(x for _, _, x in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c, size in counts:
            m = 25 + 75 * size * n // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t in terms_of(text)
                if t in c
            )
            if score:
                found.append((-score, i is not None, i, score))
        found.sort(key=lambda f: (f[0], f[1], f[2] or 0))
        out += [(item, rank + 1, f[2], f[3]) for rank, f in enumerate(found[:k])]
    return out


def corpus(n=1_200):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(300)] + ["the", "The", "été", "naïve", "7"]
    weights = [1 / (i + 1) for i in range(300)] + [2, 1, 0.2, 0.2, 0.3]
    texts = [" ".join(rng.choices(words, weights, k=rng.choice([1, 5, 40, 200]))) for _ in range(n)]
    texts += [texts[3]] * 30 + [None, "", "--- !!", "rare " * 70_000, "été-naïve_w1"]
    return [(i, t) for i, t in enumerate(texts)] + [(None, texts[5]), (4, texts[6]), (4, texts[6])]


def questions():
    texts = ["w1 w5 the", "W250 w299 w298 the the", "été, naïve? 7", "rare", "unknown", "", None, "w0 " * 50 + "w120", "the"]
    return [(i % 7, t) for i, t in enumerate(texts)] + [(None, "w17 w3 w3")]


@pytest.mark.parametrize("shard, block, window, group", [(16_384, 128, 4_096, 262_144), (64, 4, 16, 3), (300, 16, 100, 1)])
def test_search(spark, shard, block, window, group):
    sizes = {"shard_docs": shard, "block": block, "window": window, "group_terms": group}
    docs = spark.createDataFrame([(*r, "a", "b") for r in corpus()], "doc_id long, text string, score string, shard string")
    items = spark.createDataFrame(questions(), "item_id long, text string")
    got = [tuple(r) for r in search.rank_documents(docs.repartition(3), items, **sizes).collect()]
    assert order(got) == order(plain_ranks(corpus(), questions()))


def test_search_reads_an_index_of_all_terms(spark):
    docs = spark.createDataFrame(corpus(300), "doc_id long, text string")
    index = search.build_index(docs)
    own = [(7, np.concatenate([search.term_hashes(search.pa.array(["w1 w5 the"]))[0]]))]
    got = [tuple(r) for r in search.search(index, own, 3).collect()]
    assert sorted(got) == sorted(plain_ranks(corpus(300), [(7, "w1 w5 the")], 3))


def test_blocks_that_cannot_reach_the_heap_stay_packed(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string").coalesce(1)
    text = "w250 the w0"
    hashes = search.term_hashes(search.pa.array([text]))[0]
    row = search.build_index(docs, hashes, block=8).drop("part", "shard", "total").toArrow().to_batches()[0]
    values = {f.name: row.column(f.name)[0] for f in row.schema}
    own = {c: v.as_py() if c in ("data", "block") else v.values.fill_null(0).to_numpy(zero_copy_only=False) for c, v in values.items()}
    own["known"] = np.ones(len(own["doc_ids"]), bool)
    shard = search.Shard(own, 1_000, 50_000, window=64)
    heap = search.Heap(2)
    search.search_shard(shard, [(t, w) for t, w in zip(hashes.tolist(), (5_000, 1, 1))], heap)
    assert len(heap.ids) == 2 and len(shard.unpacked) < len(own["last"])


def test_search_in_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame(questions(), "item_id long, text string")
    assert search.rank_documents(none, items).collect() == []
    assert search.rank_documents(spark.createDataFrame(corpus(9), "doc_id long, text string"), items.limit(0)).collect() == []
