"""Text operators against plain versions, on small tables with awkward rows."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tagwright.llm import coder, chat, jaccard, mixing, neighbours, pages, pseudo, quality, substrings, templates, tokens
from tagwright.llm.graph import components
from tagwright.llm.units import UnitEncoder

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n string, id string"


def texts() -> list[tuple]:
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choices(words, k=80)) for _ in range(12)]
    out = list(base)
    for i in range(12):  # near copies, exact copies, shared passages
        own = base[i % 4].split()
        own[rng.randrange(80)] = "changed"
        out += [" ".join(own), base[i % 3], base[i].upper(), " ".join(rng.choices(words, k=30)) + "\n" + base[5]]
    out += [None, "", " \t\n", "one", "one two", "one  two three", "ünï cödé " * 40, "x " * 5000]
    rows = [(i, t, "en", rng.choice(["a", "b", None]), "n", "i") for i, t in enumerate(out)]
    rows.append(rows[3])  # a repeated row
    rows.append((None, base[7], None, None, None, None))
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(texts(), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def grams(text, k):
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def plain_components(rows, k, percent):
    key = lambda i: -1 if i is None else i
    sets = [(key(r[0]), grams(r[1], k)) for r in rows]
    label = {i: i for i, _ in sets}
    for i, a in sets:
        for j, b in sets:
            if a and b and 100 * len(a & b) >= percent * len(a | b) and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = {n: low if x == high else x for n, x in label.items()}
    return sorted((i, len(s), label[i]) for i, s in sets)


@pytest.mark.parametrize("k, percent, part", [(3, 90, 128), (5, 80, 2)])
def test_jaccard_components(monkeypatch, docs, k, percent, part):
    monkeypatch.setattr(jaccard, "PART_SETS", part)
    got = jaccard.jaccard_components(docs, k, percent).collect()
    got = sorted((-1 if r[0] is None else r[0], r[1], -1 if r[2] is None else r[2]) for r in got)
    assert got == plain_components(texts(), k, percent)


def test_links_in_a_block_connect_what_all_pairs_connect():
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 1 << 60, 60, dtype=np.uint64))
    sets = []
    for _ in range(60):
        keep = base[rng.random(len(base)) > rng.choice([0.02, 0.3])]
        sets.append(np.unique(np.append(keep, rng.integers(0, 1 << 60, rng.integers(0, 4), dtype=np.uint64))))

    def groups(links):
        label = list(range(60))
        for a, b in links:
            label = [label[a] if x == label[b] else x for x in label]
        return [label.index(x) for x in label]

    pairs = [
        (i, j)
        for i in range(60)
        for j in range(i)
        if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))
    ]
    assert groups(jaccard.links_of(list(range(60)), sets, list(range(60)), 80)) == groups(pairs)


def test_sketches_never_differ_more_than_sets():
    rng = np.random.default_rng(2)
    for _ in range(50):
        a = np.unique(rng.integers(0, 1 << 60, rng.integers(1, 300), dtype=np.uint64))
        b = np.unique(np.append(a[rng.random(len(a)) > 0.2], rng.integers(0, 1 << 60, 5, dtype=np.uint64)))
        x, y = (np.frombuffer(jaccard.sketch_of(s), np.uint64) for s in (a, b))
        size = min(len(x), len(y))
        differ = np.bitwise_count(jaccard._fold(x, size) ^ jaccard._fold(y, size)).sum()
        assert differ <= len(np.setxor1d(a, b))


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, i) for i in range(101, 120)] + [(7, 7), (None, 3)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r.node, r.label) for r in got} == {(i, 0) for i in range(31)} | {(i, 100) for i in range(100, 120)}


def test_remove_repeats(docs):
    rows = [(-1 if r[0] is None else r[0], r[1] or "") for r in texts()]
    first: dict[tuple, int] = {}
    for i, t in rows:
        w = WORD.findall(t)
        for s in range(len(w) - 12):
            key = tuple(w[s : s + 13])
            first[key] = min(first.get(key, i), i)
    want = []
    for i, t in rows:
        w = WORD.findall(t)
        gone = {s + j for s in range(len(w) - 12) if first[tuple(w[s : s + 13])] < i for j in range(13)}
        want.append((i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    got = [(-1 if r[0] is None else r[0], *r[1:]) for r in substrings.remove_repeats(docs).collect()]
    assert sorted(got) == sorted(want)


def test_token_files_read_back(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(coder, "BLOCK", 64)
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokens.default_tokenizer())
    got = tokens.token_files(docs, f"file://{tmp_path}/ids").orderBy("start").collect()
    start, want = 0, []
    for i, t in sorted(((r[0], r[1] or "") for r in texts()), key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(tokenizer.encode(t, add_special_tokens=False).ids + [0], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert [tuple(r) for r in got] == want


@pytest.mark.parametrize("text", [" a  b\n c", "a \n\n b ", "\t x 's  y", "", "  ", "don't <|endoftext|> x", "a  b  c"])
def test_cut_texts_have_the_tokenizers_ids(text):
    encoder = UnitEncoder(tokens.default_tokenizer(), words=False)
    want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert tokens.encode_documents(encoder, pa.array([text]))[0].tolist() == [*want, 0]


def test_wide_ids_are_an_error():
    encoder = UnitEncoder(tokens.default_tokenizer(), words=False)
    encoder.encode = lambda texts: (np.array([70000], np.uint32), np.array([0, 1]))
    with pytest.raises(ValueError, match="16 bits"):
        tokens.encode_documents(encoder, pa.array(["b"]))


def test_coder_round_trip_and_damage():
    rng = np.random.default_rng(4)
    blocks = [np.zeros(500, np.uint16), rng.integers(0, 65536, 500).astype(np.uint16), rng.integers(0, 9, 77).astype(np.uint16)]
    coded = coder.encode(blocks)
    assert all((a == b).all() for a, b in zip(blocks, coder.decode(coded, [500, 500, 77])))
    assert len(coded[0][0]) < 60 and not coder.encode([])
    packed = bytearray(tokens.pack_block(blocks[1], [(1, 0, 0, 0, 500)], *coded[1]))
    packed[-1] ^= 1
    with pytest.raises(ValueError):
        list(tokens.decode_blocks([bytes(packed)]))


def test_leaks_by_template(spark):
    items = [(1, "The train with Anna leaves at 12 km per 3 hours and Anna waits for 12 minutes at home today.")]
    rows = [
        (1, "Some words first. " + items[0][1] + " And some after."),
        (2, items[0][1].replace("Anna", "Bert").replace("12", "40")),
        (3, items[0][1].replace("Anna waits", "Carl waits")),  # one name became two
        (4, "The train leaves."),
        (5, None),
        (1, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    own = spark.createDataFrame([*items, (2, items[0][1]), (3, None), (None, "")], "item_id long, text string")
    got = {(r.doc_id, r.contaminated, tuple(r.item_ids)) for r in templates.find_leaks(docs, own).collect()}
    assert got == {(1, True, (1,)), (2, True, (1,)), (3, False, ()), (4, False, ()), (5, False, ()), (1, False, ())}


LONG = (
    "Tom has 12 boxes and every box holds seven red and nine green marbles, so after he gives half of them to Anna "
    "and loses 3 on his way home, how many marbles of either colour does Tom still have in all of his boxes tonight?"
)


def leaks_of(spark, texts, items):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    own = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return [tuple(r.item_ids) for r in templates.find_leaks(docs, own).orderBy("doc_id").collect()]


def test_leaks_with_inserted_words_and_longer_names(spark):
    words = LONG.split()
    texts = [
        " ".join([*words[:20], "really", *words[20:]]),
        " ".join([*words[:14], "quite", *words[14:28], "also", *words[28:]]),
        " ".join([*words[:21], *words[22:]]),
        LONG.replace("Tom", "Mary Ann").replace("Anna", "Bert Beek"),
        " ".join(words[:14]) + " far away " * 60 + " ".join(words[30:]),  # parts that are far apart
    ]
    assert leaks_of(spark, texts, [LONG]) == [(0,), (0,), (0,), (0,), ()]


def test_leaks_with_one_conflict(spark):
    item = "At home Tom and his sister count what they have. " + LONG + " And then Tom sleeps for 9 hours."
    texts = [
        item.replace("does Tom", "does Carl"),  # one of four places
        item.replace("12", "4").replace("3", "4"),  # two numbers became equal
        item.replace("Tom", "Carl").replace("3", "5"),
    ]
    assert leaks_of(spark, texts, [item]) == [(0,), (0,), (0,)]


def test_leaks_word_by_word(spark):
    items = [
        LONG,
        "Paris Rome!",
        "What is 12 + 5 - 3 * 8 / 4 - 77 + 15 + 9 - 2 ?",
        "Paul, Mary, Anna, Tom, Bert, Carl, Dora, Emil, Fritz, Gustav",
        "Which river flows quickly through this old town?",
    ]
    texts = [
        "some words before " + LONG.upper() + " and after",
        "from paris, rome is far",
        "so " + items[2],
        "Names: " + items[3],
        "A head line\n" + items[4],
        "a head line " + items[4],
        LONG.upper().replace("ANNA", "BERT").replace("12", "40"),
        "Rome Paris, and Paul, Mary. What is 12 + 5?",
        "Exam\nWhich river flows quickly through this old house?",
    ]
    assert leaks_of(spark, texts, items) == [(0,), (1,), (2,), (3,), (4,), (4,), (0,), (), ()]


def test_quality_learns_and_holds_out(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(300):
        good = i % 3 != 0
        words = ["".join(rng.choices("abcdefg", k=5)) for _ in range(100)]
        rows.append((i, " ".join(words) if good else " ".join(w.upper() + "!!" for w in words), "x"))
        labels.append((i, int(good)))
    docs = spark.createDataFrame([*rows, (None, None, "x"), (400, "", "x")], "doc_id long, text string, label string")
    given = spark.createDataFrame([*labels, (5, None), (None, 1)], "doc_id long, quality int")
    got = quality.classify(docs, given).collect()
    assert len(got) == 302 and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    known = dict(labels)
    assert np.mean([r.predicted == known[r.doc_id] for r in got if r.held_out and r.doc_id in known]) > 0.95
    flat = quality.classify(docs, given.filter("quality = 1")).collect()
    assert {r.score for r in flat} == {1.0}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_neighbours_recall_on_the_given_vectors(spark, sf):
    table = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    rows = {r.vec_id: np.array(r.embedding, float) for r in table.collect() if r.embedding is not None and None not in r.embedding}
    rows = {i: v for i, v in rows.items() if np.isfinite(v).all() and v.any()}
    ids, found = np.array(list(rows)), {}
    for r in neighbours.nearest(table).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    every = np.array(list(rows.values()))
    shares = []
    for i in ids[ids % 20 == 0].tolist():
        scores = every @ rows[i]
        scores[ids == i] = -np.inf
        best = ids[np.lexsort((ids, -scores))[: neighbours.K]]
        shares.append(len(found[i] & set(best.tolist())) / len(best))
    assert np.mean(shares) >= 0.95


def test_neighbours_find_nearly_all(spark):
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(900, 16)).astype(float)
    vectors[31] = vectors[40]  # a tie
    rows = [(i, v.tolist(), "x") for i, v in enumerate(vectors)]
    rows += [(2000, None, "x"), (2020, [0.0] * 16, "x"), (2040, [float("nan")] * 16, "x"), (2060, [1.0], "x"), (None, [1.0] * 16, "x"), rows[20]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = neighbours.nearest(table).collect()
    assert len(got) == 45 * 20
    hits = 0
    for q in range(0, 900, 20):
        scores = vectors @ vectors[q]
        order = [i for i in np.lexsort((np.arange(900), -scores)) if i != q][:20]
        own = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        hits += len({v for _, v, _ in own} & set(order))
        assert all(abs(s - vectors[v] @ vectors[q]) < 1e-12 for _, v, s in own)
    assert hits / (45 * 20) >= 0.9
    few = spark.createDataFrame(rows[:5], "vec_id long, embedding array<double>, score string")
    assert [r.rank for r in neighbours.nearest(few).orderBy("rank").collect()] == [1, 2, 3, 4]


def test_pseudo_likelihood_word_by_word(docs):
    weights, share = pseudo.fit(docs)
    w = pseudo.unflatten(weights)
    from tagwright.llm.words import words_of
    import pyarrow as pa

    for r in pseudo.score(docs, weights, share).limit(12).collect():
        text = next(t[1] for t in texts() if t[0] == r.doc_id)
        bucket = (words_of(pa.array([text])).hashes(lower=True) % np.uint64(pseudo.BUCKETS)).astype(int)
        total = 0.0
        for i, own in enumerate(bucket):
            around = [bucket[i + s] % pseudo.INPUTS if 0 <= i + s < len(bucket) else pseudo.INPUTS for s in pseudo.SIDES]
            z = pseudo.log_chances(w, np.array([around]))[2][0]
            assert abs(np.exp(z).sum() - 1) < 1e-3
            total += z[own % pseudo.CLASSES] + share[own]
        assert r.n_words == len(bucket) and abs(r.log_likelihood - total) < 1e-2


@pytest.mark.parametrize("frequent", [0, 40, 1 << 16])
def test_every_word_has_its_own_count(spark, monkeypatch, frequent):
    from collections import Counter

    from tagwright.llm.words import words_of
    import pyarrow as pa

    monkeypatch.setattr(pseudo, "FREQUENT", frequent)
    rng = random.Random(9)  # more words than any fixed table of 2^18 holds apart
    rows = [(i, " ".join(f"W{rng.randrange(1 << 18):x}" for _ in range(500))) for i in range(60)] + [(None, "w1 w1 W1"), (7, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    weights, vocabulary = pseudo.fit(table)
    want = Counter(w for _, t in rows for w in (t or "").lower().split())
    names = list(want)
    keys = (words_of(pa.array([" ".join(names)])).hashes(lower=True) % np.uint64(pseudo.BUCKETS)).astype(np.int64)
    got = {r.key: r.n for r in vocabulary.words.collect()}
    assert got == {k: want[w] for k, w in zip(keys.tolist(), names)}
    totals, kinds = Counter(), Counter()
    for k, n in got.items():
        totals[k % pseudo.CLASSES] += n
        kinds[k % pseudo.CLASSES] += 1
    w = pseudo.unflatten(weights)
    out = sorted(((-1 if r[0] is None else r[0], r[1]), r[2]) for r in pseudo.score(table, weights, vocabulary).collect())
    wanted = []
    for i, t in rows:
        own, around, _ = pseudo.contexts(pa.array([t], pa.string()))
        z = pseudo.class_chances(w, own, around)
        share = [np.log(got[k] + 0.5) - np.log(totals[k % pseudo.CLASSES] + 0.5 * (kinds[k % pseudo.CLASSES] + 1)) for k in own.tolist()]
        wanted.append(((-1 if i is None else i, len(own)), z.sum() + sum(share)))
    assert [k for k, _ in out] == [k for k, _ in sorted(wanted)]
    assert all(abs(a - b) < 1e-2 for (_, a), (_, b) in zip(out, sorted(wanted)))



PAGE = """<html><head><title>T &amp; x</title><script>var t="</p>";</script></head><body><nav><a href=/>Home</a></nav>
<div class="ad">Buy this now, it is cheap.</div><article><h1>A head</h1><p>First &lt;b&gt; <b>line<br>more<p>Second
 &am</p><!-- <p>no</p> --><section id="comments"><p>I like it very much indeed.</p></section></article>
<form><p>Your mail</p></form><footer>&copy; us"""


def test_pages(spark):
    rows = [(1, "u", PAGE, "x"), (2, None, None, "x"), (None, "u", "", "x"), (4, "u", "<p>" + "word " * 60, "x"), (4, "u", "<p", "x")]
    got = pages.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert [r.text for r in got] == ["A head\n\nFirst <b> line more\n\nSecond &am", "", "", " ".join(["word"] * 60), ""]


WRAPPED = [
    '<div class="content-sidebar-wrap"><p>{}</div>',
    '<div class="page with-sidebar"><div>{}</div></div>',
    '<div id="post" class="comments-open"><p>{}</div>',
    '<div class="sidebar"><article><p>{}</article><p>Some other words stand here.</div>',
    "<div id=related class=social><p>No.<main><p>{}</main></div>",
]


@pytest.mark.parametrize("wrapper", WRAPPED)
def test_wrapped_articles_are_kept(wrapper):
    words = " ".join(["word"] * 60)
    assert [b.text for b in pages.blocks_of(wrapper.format(words)) if not b.aside] == [words]


@pytest.mark.parametrize(
    "part",
    [
        '<div class="sidebar"><p>{}</div>', '<div class="site-footer"><p>{}</div>', '<ul id="comments-list"><li>{}</ul>',
        '<div id="comments"><article><p>{}</article></div>', '<aside><article><p>{}</article></aside>',
        '<section class="related"><article class="related"><p>{}</article></section>',
    ],
)
def test_parts_without_content_stay_aside(part):
    page = "<article><p>First.</article>" + part.format("Some other words stand here.")
    assert [(b.text, b.aside) for b in pages.blocks_of(page)] == [("First.", False), ("Some other words stand here.", True)]


def test_chats_keep_marks_in_texts(spark):
    rows = [
        (1, 0, "user", "a <|im_end|> <\\|x|>"), (1, 1, "user", None), (1, 2, "assistant", "b<|im_start|>"), (1, 2, "assistant", "b<|im_start|>"),
        (1, None, "sys\ntem", "first"), (None, 0, None, "c <|"), (2, 5, "assistant", ""),
    ]
    table = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    from pyspark.sql import functions as F

    out = chat.format_chats(table)
    got = {
        r.conv_id: ([tuple(t) for t in r.turns], r.learned)
        for r in out.select("conv_id", chat.read_chats(F.col("formatted")).alias("turns"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("learned")).collect()
    }
    assert got[1] == (
        [("sys\ntem", "first"), ("user", "a <|im_end|> <\\|x|>"), ("user", ""), ("assistant", "b<|im_start|>"), ("assistant", "b<|im_start|>")],
        "b<|im_start|>" * 2,
    )
    assert got[None] == ([("", "c <|")], "") and got[2] == ([("assistant", "")], "")


def test_mixing_reaches_targets_by_favour(docs, spark):
    from pyspark.sql import functions as F

    got = mixing.mix_sources(docs).collect()
    assert len(got) == len(texts()) and all(r.taken <= 3 * r.size for r in got)
    many = spark.range(3000).selectExpr("id as doc_id", "repeat('w ', cast(id % 7 as int)) as text", "cast(id % 3 as string) as source", "id % 2 + 1 as liked")
    rows = mixing.mix_sources(many, favour=F.col("liked")).collect()
    assert [tuple(r) for r in rows] and sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix_sources(many, favour=F.col("liked")).collect()))
    for source in "012":
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 7


def test_empty_tables(spark, none):
    conversations = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    own = spark.createDataFrame([], "item_id long, text string")
    sites = spark.createDataFrame([], "page_id long, url string, html string")
    for out in (
        chat.format_chats(conversations), neighbours.nearest(vectors), quality.classify(none, labels), tokens.token_files(none),
        templates.find_leaks(none, own), pseudo.score_documents(none), jaccard.jaccard_components(none), mixing.mix_sources(none),
        substrings.remove_repeats(none), pages.extract_pages(sites),
    ):
        assert out.collect() == []




def test_joined_cuts_give_the_ids_of_the_library():
    import random

    encoder = UnitEncoder(tokens.default_tokenizer(), words=False)
    parts = [" ", "  ", "\n", "a", "b1", "'s", "<|endoftext|>", "<|", "é", "　", "\x1f", "😀", "."]
    rng = random.Random(1)
    texts = ["", " ", "a ", " a", *("".join(rng.choices(parts, k=rng.randint(1, 25))) for _ in range(500))]
    for text, ids in zip(texts, tokens.encode_documents(encoder, pa.array(texts))):
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == [*want, tokens.END]
