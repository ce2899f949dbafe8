"""Stages of the pipeline against plain versions, on rows without ids and ids with several texts."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tagwright.llm import mixing, tokens
from tests.llm.test_llm import grams

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of() -> list[tuple]:
    rng = random.Random(12)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choices(words, k=60)) for _ in range(14)]
    near = [t + " more" for t in base]
    rows = [(None, t) for t in base[:6]]  # unrelated texts without an id
    rows += [(None, near[0]), (5, near[1]), (5, base[7]), (5, base[8])]  # one id, several texts
    rows += [(6, near[7]), (7, base[9]), (8, base[9]), (9, near[9]), (10, base[10]), (10, base[10])]
    rows += [(11, ""), (12, None), (None, None), (None, ""), (None, None), (11, ""), (13, "one two"), (14, "ONE two")]
    return [(i, t, "en", "s", len(t or "")) for i, t in rows]


def plain_near_copies(rows: list[tuple]) -> list[tuple]:
    """Texts of each group, by comparing every pair."""
    sets = [grams(r[1], corpus_pipeline.NEAR_WORDS) for r in rows]
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            equal = rows[i][:2] == rows[j][:2]
            near = a and b and 100 * len(a & b) >= corpus_pipeline.NEAR_PERCENT * len(a | b)
            if equal or near:
                label = [label[j] if x == label[i] else x for x in label]
    return [[rows[i] for i in range(len(rows)) if label[i] == x] for x in sorted(set(label))]


def test_near_copies_keep_one_row_of_each_group(spark):
    rows = rows_of()
    got = [tuple(r) for r in corpus_pipeline.keep_one_of_near_copies(spark, spark.createDataFrame(rows, SCHEMA), "").collect()]
    groups = plain_near_copies(rows)
    least = [min(-1 if r[0] is None else r[0] for r in g) for g in groups]
    assert len(got) == len(groups)
    for group, smallest in zip(groups, least):
        kept = [r for r in got if r in group]
        assert len(kept) == 1 and (-1 if kept[0][0] is None else kept[0][0]) == smallest


ITEM = "The train with Anna leaves at 12 km per 3 hours and Anna waits for 12 minutes at home today."


def count(rows) -> Counter:
    return Counter(tuple(r) for r in rows)


def test_contaminated_rows_are_dropped(spark, tmp_path):
    words = ITEM.split()
    long = ITEM[:-1] + " until her old friend Tom comes by with 5 red apples and some bread for the long way back."
    far = long.split()
    leaks = ["before " + ITEM + " after", ITEM.replace("Anna", "Bert").replace("12", "40"), ITEM.upper(), long]
    leaks += [" ".join([*far[:19], "really", *far[19:]])]
    clean = ["The train leaves.", "", None, " ".join(reversed(words)), "no item here at all, only words"]
    spark.createDataFrame([(1, ITEM), (2, long), (None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(leaks + clean)]
    rows += [(None, t, "en", "s", 1) for t in leaks + clean] + [(0, clean[4], "en", "s", 1), rows[5], rows[0]]
    got = corpus_pipeline.drop_contaminated(spark, spark.createDataFrame(rows, SCHEMA), str(tmp_path)).collect()
    assert count(got) == count(r for r in rows if r[1] in clean)


def mixable() -> list[tuple]:
    """A half of the rows has no id, some ids have several texts, some rows are repeated."""
    rng = random.Random(13)
    rows = [
        (i if i % 2 else None, " ".join(["w"] * rng.randrange(8)) + f" t{i}", "en", rng.choice(["a", "b", "c", None]), i)
        for i in range(400)
    ]
    rows += [(500, None, "en", "a", 0), (500, "", "en", "a", 0), (7, "seven", "en", "a", 0), (7, "also seven", "en", "b", 0)]
    return rows + rows[:60] * 3 + [(None, "same words", "en", "b", 1)] * 200


def test_mix_takes_each_row_as_often_as_it_is_due(spark):
    rows = mixable()
    docs = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], f"{SCHEMA}, n long")
    mixed = mixing.mix_sources(docs, keep="n").collect()
    want = Counter({rows[r.kept]: 0 for r in mixed})
    for r in mixed:
        want[rows[r.kept]] += r.copies
    got = corpus_pipeline.mix_to_targets(spark, docs.drop("n"), "").collect()
    assert count(got) == +want
    for source in ("a", "b", "c", None):
        own = [r for r in mixed if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 10


@pytest.mark.parametrize("graded", [False, True])
def test_mixes_agree_however_rows_are_partitioned(spark, graded):
    rows = mixable()
    favour = F.length(F.col("n_chars").cast("string")) if graded else None
    mixes = []
    for seed, parts in ((1, 1), (2, 7), (3, 3)):
        random.Random(seed).shuffle(rows)
        docs = spark.createDataFrame(rows, SCHEMA).repartition(parts)
        mixes.append(count(mixing.mix_sources(docs, favour=favour).drop("kept").collect()))
    assert mixes[0] == mixes[1] == mixes[2]
    for source in ("a", "b", "c", None):
        own = [r for r in mixes[0].elements() if r[1] == source]
        assert abs(sum(r[6] for r in own) - own[0][4]) <= 10 and all(r[5] <= mixing.MAX_COPIES for r in own)


def test_a_higher_favour_gives_more_copies(spark):
    docs = spark.range(6000).selectExpr("id as doc_id", "'w w' as text", "cast(id % 3 as string) as source", "id % 2 + 1 as grade")
    mixed = mixing.mix_sources(docs, favour=F.col("grade"), keep="doc_id").collect()
    for source in "012":
        own = [r for r in mixed if r.source == source]
        low, high = (sum(r.copies for r in own if r.doc_id % 2 == g) for g in (0, 1))
        assert abs(sum(r.taken for r in own) - own[0].target) <= 4
        assert high > 1.8 * low or own[0].target == 3 * own[0].source_size or max(r.copies for r in own) == 3


def test_stages_leave_columns_of_any_name_alone(spark, tmp_path):
    names = ["row", "row_", "node", "id", "key", "group", "leak", "taken", "often", "copy", "kept", "size", "copies", "target", "Row", "twin"]
    names = [n for n in names if n != "Row"] + ["part", "__id", "__node", "__copy", "__size", "__key", "component_id", "label"]
    schema = SCHEMA + "".join(f", {n} string" for n in names)
    rows = [(*r, *[f"{n}{i}" for n in names]) for i, r in enumerate(rows_of())]
    docs = spark.createDataFrame(rows, schema)
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    labels = [(r[0], i % 2) for i, r in enumerate(rows) if r[0] is not None]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        assert {tuple(r) for r in out.collect()} <= set(rows)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == len(rows)


def test_quality_keeps_what_is_predicted_good(spark, tmp_path):
    rng = random.Random(14)
    rows, labels = [], []
    for i in range(200):
        words = " ".join("".join(rng.choices("abcdefg", k=5)) for _ in range(60))
        rows.append((i, words if i % 3 else words.upper().replace(" ", "!! "), "en", "s", i))
        labels.append((i, int(i % 3 != 0)))
    rows += [(None, rows[1][1], "en", "s", 0), (None, rows[0][1], "en", "s", 1), rows[4], rows[3]]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.keep_quality(spark, spark.createDataFrame(rows, SCHEMA), str(tmp_path)).collect()
    assert count(got) == count(r for r in rows if "!!" not in r[1])


def test_run_row_by_row(spark, tmp_path):
    from tokenizers import Tokenizer

    rng = random.Random(15)
    rows, labels = [], []
    for i in range(150):
        words = " ".join("".join(rng.choices("abcdefg", k=5)) for _ in range(60))
        text = words if i % 3 else words.upper().replace(" ", "!! ")
        rows.append((i, f"{text} {ITEM}" if i % 10 == 1 else text, "en", rng.choice("abc"), i))
        labels.append((i, int(i % 3 != 0)))
    good = [r for r in rows if r[0] % 3]
    more = [(200 + i, r[1] + " more", "en", "a", 0) for i, r in enumerate(good[:20])]  # near copies
    more += [(None, r[1][30:], "en", "b", 0) for r in good[20:24]]  # near copies without an id, which stay
    more += [good[3], good[5]]
    spark.createDataFrame(rows + more, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    left = [min(g, key=lambda r: -1 if r[0] is None else r[0]) for g in plain_near_copies([r for r in rows + more if "!!" not in r[1]])]
    left = [r for r in left if ITEM not in r[1]]
    frame = spark.createDataFrame([(*r, n) for n, r in enumerate(left)], f"{SCHEMA}, n long")
    due = {r.kept: r.copies for r in mixing.mix_sources(frame, keep="n").collect()}
    tokenizer = Tokenizer.from_file(tokens.default_tokenizer())
    want = Counter()
    for n, r in enumerate(left):
        ids = np.array(tokenizer.encode(r[1], add_special_tokens=False).ids + [tokens.END], "<u4")
        want[(r[0], len(ids), zlib.crc32(ids.tobytes()))] += due[n]
    got = Counter((r[0], r[2], r[3]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert got == +want
