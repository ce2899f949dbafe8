"""Masked pseudo-likelihood of documents by a bidirectional window network.

Every word is predicted from the two words on each side, itself hidden. The
network gives the word's class (one of ``CLASSES``, by hash); inside its class a
word has its share of the corpus counts. The sum of the conditional
log-probabilities of all words scores the document.

Counts and network come from all documents: every distinct word has its count in
a stored vocabulary table, which grows with the corpus, and in each of ``ROUNDS``
rounds every task runs gradient descent over all its texts from the common
weights, which are then averaged by the words seen. A round trains on every
``ROUNDS``-th word, so that all words are seen once. Scoring looks the at most
``FREQUENT`` words of largest count up in each task and joins the vocabulary to
all others; how many are looked up changes the cost and not the result.

Words are told apart by 62-bit keys: among 100 million words, the chance that any
two share one is about 1 in 900. The network itself has a fixed size: it sees the
words around by ``INPUTS`` codes.

Defined results: words are lower-cased (A-Z); a null or empty text has 0 words,
sum 0 and no mean; beyond a text's ends stands a mark of its own; repeated rows
get the same score; a null id is kept; columns of other names play no part; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tagwright.llm.words import chunks, words_of
from tagwright.session import write_shared

# Keys of words, not places of a table.
BUCKETS = 1 << 62
FREQUENT = 1 << 16
CLASSES = 64
INPUTS = 1024
EMBED = 8
HIDDEN = 24
ROUNDS = 2
BATCH = 4096
RATE = 0.5
SIDES = (-2, -1, 1, 2)

SHAPES = {
    "embed": (INPUTS + 1, EMBED),
    "inner": (len(SIDES) * EMBED, HIDDEN),
    "inner0": (HIDDEN,),
    "outer": (HIDDEN, CLASSES),
    "outer0": (CLASSES,),
}


def start_weights(class_counts: np.ndarray) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(11)
    w = {k: rng.normal(0, 1 / np.sqrt(s[0]) if k != "embed" else 0.3, s).astype(np.float32) for k, s in SHAPES.items()}
    w["inner0"][:] = 0
    w["outer"] *= 0.1
    w["outer0"][:] = np.log((class_counts + 1) / (class_counts + 1).sum())
    return w


def contexts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Key of each word of a chunk, the inputs around it, and the first word
    of each text."""
    words = words_of(texts)
    bucket = (words.hashes(lower=True) % np.uint64(BUCKETS)).astype(np.int64)
    text = words.text_of()
    around = np.full((len(bucket), len(SIDES)), INPUTS, dtype=np.int64)
    for column, side in enumerate(SIDES):
        here = slice(max(0, -side), len(bucket) - max(0, side))
        there = slice(max(0, side), len(bucket) - max(0, -side))
        if here.stop > here.start:
            same = text[here] == text[there]
            around[here, column] = np.where(same, bucket[there] % INPUTS, INPUTS)
    return bucket, around, words.first


def log_chances(w: dict[str, np.ndarray], around: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, hidden layer and class log-probabilities of each row of ``around``."""
    x = w["embed"][around].reshape(len(around), -1)
    h = np.tanh(x @ w["inner"] + w["inner0"])
    z = h @ w["outer"] + w["outer0"]
    z -= z.max(axis=1, keepdims=True)
    z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
    return x, h, z


def step(w: dict[str, np.ndarray], around: np.ndarray, classes: np.ndarray, rate: float) -> None:
    n = len(classes)
    x, h, z = log_chances(w, around)
    d = np.exp(z)
    d[np.arange(n), classes] -= 1
    d /= n
    d_h = (d @ w["outer"].T) * (1 - h**2)
    d_x = (d_h @ w["inner"].T).reshape(-1, EMBED)
    w["outer"] -= rate * (h.T @ d)
    w["outer0"] -= rate * d.sum(axis=0)
    w["inner"] -= rate * (x.T @ d_h)
    w["inner0"] -= rate * d_h.sum(axis=0)
    flat = around.ravel()
    for k in range(EMBED):
        w["embed"][:, k] -= rate * np.bincount(flat, d_x[:, k], INPUTS + 1)


def flatten(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in SHAPES])


def unflatten(values: np.ndarray) -> dict[str, np.ndarray]:
    w, at = {}, 0
    for k, shape in SHAPES.items():
        size = int(np.prod(shape))
        w[k] = values[at : at + size].reshape(shape).astype(np.float32)
        at += size
    return w


def train_round(texts: DataFrame, weights: np.ndarray, number: int) -> np.ndarray:
    """Weights after every task has trained on its texts, averaged by words."""
    sent = texts.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, seen = unflatten(sent.value), 0
        for chunk in chunks(batches, "text"):
            bucket, around, _ = contexts(chunk.column("text"))
            own = np.arange(number, len(bucket), ROUNDS)
            for at in range(0, len(own), BATCH):
                rows = own[at : at + BATCH]
                # A short batch takes a short step.
                step(w, around[rows], bucket[rows] % CLASSES, RATE * len(rows) / BATCH)
                seen += len(rows)
        if seen:
            values = flatten(w).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(values))), pa.array(values * seen), pa.array(np.full(len(values), seen))], ["i", "value", "seen"]
            )

    trained = texts.mapInArrow(run, "i long, value double, seen long")
    averaged = trained.groupBy("i").agg((F.sum("value") / F.sum("seen")).alias("value")).toArrow()
    out = weights.copy()
    out[np.asarray(averaged["i"])] = np.asarray(averaged["value"])
    return out


class Vocabulary:
    """The stored table ``words`` (key, n) of all words, its frequent words, and
    what the shares of a class are of. ``vocabulary[key]`` is a word's log share."""

    def __init__(self, words: DataFrame):
        self.words = words
        by_class = words.groupBy((F.col("key") % CLASSES).alias("class")).agg(F.sum("n").alias("n"), F.count("n").alias("words")).toArrow()
        own = np.asarray(by_class["class"]).astype(np.int64)
        self.totals, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
        self.totals[own], kinds[own] = np.asarray(by_class["n"]), np.asarray(by_class["words"])
        # One more word for each class: what the table does not have.
        self.whole = np.log(self.totals + 0.5 * (kinds + 1))
        sizes = words.groupBy("n").agg(F.count("key").alias("words")).toArrow()
        order = np.argsort(-np.asarray(sizes["n"]))
        fits = np.cumsum(np.asarray(sizes["words"])[order]) <= FREQUENT
        least = np.asarray(sizes["n"])[order][fits]
        frequent = words.filter(F.col("n") >= int(least[-1]) if len(least) else F.lit(False)).toArrow()
        order = np.argsort(np.asarray(frequent["key"]))
        self.keys, self.counts = np.asarray(frequent["key"])[order], np.asarray(frequent["n"])[order]

    def __getitem__(self, key: int) -> float:
        at = int(np.searchsorted(self.keys, key))
        if at < len(self.keys) and self.keys[at] == key:
            n = int(self.counts[at])
        else:
            n = next((r.n for r in self.words.filter(F.col("key") == int(key)).collect()), 0)
        return float(np.log(n + 0.5) - self.whole[int(key) % CLASSES])


def count_words(texts: DataFrame) -> DataFrame:
    """The vocabulary table: key, n of each distinct word."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, "text"):
            keys = words_of(chunk.column("text")).hashes(lower=True) % np.uint64(BUCKETS)
            keys, n = np.unique(keys.astype(np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["key", "n"])

    counted = texts.select("text").mapInArrow(run, "key long, n long")
    return write_shared(counted.groupBy("key").agg(F.sum("n").alias("n")))


def fit(docs: DataFrame) -> tuple[np.ndarray, Vocabulary]:
    """Network weights, and the vocabulary with the log share of each word inside its class."""
    texts = docs.select("text")
    vocabulary = Vocabulary(count_words(texts))
    weights = flatten(start_weights(vocabulary.totals)).astype(np.float64)
    for number in range(ROUNDS):
        weights = train_round(texts, weights, number)
    return weights, vocabulary


def class_chances(w: dict[str, np.ndarray], keys: np.ndarray, around: np.ndarray) -> np.ndarray:
    out = np.empty(len(keys))
    for at in range(0, len(keys), BATCH):
        own = keys[at : at + BATCH]
        z = log_chances(w, around[at : at + BATCH])[2]
        out[at : at + BATCH] = z[np.arange(len(own)), own % CLASSES]
    return out


def score(docs: DataFrame, weights: np.ndarray, vocabulary: Vocabulary) -> DataFrame:
    model = docs.sparkSession.sparkContext.broadcast((weights, vocabulary.keys, np.log(vocabulary.counts + 0.5), vocabulary.whole))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, frequent, logs, whole = model.value
        w, row = unflatten(values), TaskContext.get().partitionId() << 40
        for chunk in chunks(batches, "text"):
            keys, around, first = contexts(chunk.column("text"))
            chance = class_chances(w, keys, around) - whole[keys % CLASSES]
            rare = np.ones(len(keys), dtype=bool)
            if len(frequent):
                at = np.minimum(np.searchsorted(frequent, keys), len(frequent) - 1)
                rare = frequent[at] != keys
                chance += np.where(rare, 0, logs[at])
            sums = np.append(0, np.cumsum(chance))
            cuts = np.append(0, np.cumsum(rare))[first].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row + np.arange(chunk.num_rows)),
                    chunk.column("doc_id"),
                    pa.array(np.diff(first)),
                    pa.array(sums[first[1:]] - sums[first[:-1]]),
                    pa.ListArray.from_arrays(pa.array(cuts), pa.array(keys[rare])),
                ],
                ["row", "doc_id", "n_words", "known", "rare"],
            )
            row += chunk.num_rows

    rows = docs.select("doc_id", "text")
    schema = f"row long, doc_id {dict(rows.dtypes)['doc_id']}, n_words long, known double, rare array<long>"
    # Written once: the numbers of rows must be the same on both sides of the join.
    known = write_shared(rows.mapInArrow(run, schema))
    rare = known.select("row", F.explode("rare").alias("key")).join(vocabulary.words, "key", "left")
    rare = rare.groupBy("row").agg(F.sum(F.log(F.coalesce("n", F.lit(0)) + 0.5)).alias("joined"))
    total = F.col("known") + F.coalesce("joined", F.lit(0.0))
    return known.drop("rare").join(rare, "row", "left").select("doc_id", "n_words", total.alias("log_likelihood"))


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, log_likelihood, mean_log_likelihood of each row of ``docs``
    (doc_id, text), by a network trained on the same texts."""
    mean = F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words"))
    return score(docs, *fit(docs)).withColumn("mean_log_likelihood", mean)
