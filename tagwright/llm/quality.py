"""Quality classifier by attention over passages (multiple-instance learning).

A document is a bag of passages of ``PASSAGE`` words. Each passage is described
by word and character statistics and encoded; gated attention weights, learned
from document labels alone, say which passages speak for the document, and the
weighted passage representation gives the score.

Training takes at most ``TRAIN_DOCS`` labelled documents, those with the smallest
hash of the id, and ``TRAIN_PASSAGES`` passages spread evenly over each (both
bounds are parameters); it runs in numpy on the driver with a fixed seed. Scoring
reads every passage of every text.

Defined results: a null or empty text is one passage without words; labels of
one id are averaged; null labels and ids don't train; without labels of both
kinds every score is the share of label 1 (0.5 without labels); repeated rows get
the same score; columns of other names play no part; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tagwright.llm.words import SPACE, chunks, words_of

PASSAGE = 64
TRAIN_DOCS = 4000
TRAIN_PASSAGES = 64
THRESHOLD = 0.3
HIDDEN = 16

FEATURES = (
    "word length", "capitals", "digits", "punctuation", "symbols", "sentence ends", "commas", "words without letters",
    "word again", "word before last again", "words seen in the passage", "short words", "long words", "capital words",
    "words with much punctuation", "line breaks", "size",
)

_code = np.arange(256)
_UPPER = (_code >= 65) & (_code <= 90)
_DIGIT = (_code >= 48) & (_code <= 57)
_LETTER = _UPPER | ((_code >= 97) & (_code <= 122)) | (_code >= 128)
_PUNCT = ~(_LETTER | _DIGIT | SPACE)
_SYMBOL = np.isin(_code, [ord(c) for c in "#$%&*|<>{}[]=~^@\\_+/"])


def passages_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of each passage of a chunk, and the first passage of each text."""
    words = words_of(texts)
    counts = np.diff(words.first)
    per_text = np.maximum(1, -(-counts // PASSAGE))
    first = np.append(0, np.cumsum(per_text))
    features = np.zeros((first[-1], len(FEATURES)), dtype=np.float32)
    if not len(words.starts):
        return features, first
    data, starts, ends = words.data, words.starts, words.ends

    def per_word(table: np.ndarray) -> np.ndarray:
        return np.add.reduceat(table[data], starts, dtype=np.int32)

    length = ends - starts
    upper, digit, letter, punct, symbol = map(per_word, (_UPPER, _DIGIT, _LETTER, _PUNCT, _SYMBOL))
    last = data[ends - 1]
    hashes = words.hashes(lower=True)
    text = words.text_of()
    passage = first[text] + (np.arange(len(starts)) - words.first[text]) // PASSAGE
    again = np.zeros(len(starts), dtype=bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    skip = np.zeros(len(starts), dtype=bool)
    skip[2:] = (hashes[2:] == hashes[:-2]) & (text[2:] == text[:-2])
    order = np.lexsort((hashes, passage))
    seen = np.zeros(len(starts), dtype=bool)
    seen[order[1:]] = (hashes[order[1:]] == hashes[order[:-1]]) & (passage[order[1:]] == passage[order[:-1]])
    breaks = np.zeros(len(starts), dtype=bool)
    inner = ends < len(data)
    breaks[inner] = data[ends[inner]] == 10
    heads = np.flatnonzero(np.append(True, passage[1:] != passage[:-1]))
    at = passage[heads]
    n_words = np.add.reduceat(np.ones(len(starts), np.float64), heads)

    def total(values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values.astype(np.float64), heads)

    n_bytes = total(length)
    columns = [
        n_bytes / n_words / 10,
        total(upper) / n_bytes,
        total(digit) / n_bytes,
        total(punct) / n_bytes,
        total(symbol) / n_bytes,
        *(
            total(flag) / n_words
            for flag in (
                np.isin(last, [33, 46, 63]), last == 44, letter == 0, again, skip, seen, length <= 3, length > 12,
                (upper > 0) & (upper >= letter), punct >= 3, breaks,
            )
        ),
        np.log1p(n_words) / 4,
    ]
    features[at] = np.stack(columns, axis=1)
    return features, first


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    base: float | None = None

    def scores(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        if self.base is not None:
            return np.full(len(first) - 1, self.base)
        return forward(self.weights, (features - self.mean) / self.scale, first)["score"]


def forward(w: dict[str, np.ndarray], x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    starts, sizes = first[:-1], np.diff(first)
    h = np.tanh(x @ w["encode"] + w["encode0"])
    view, gate = np.tanh(h @ w["view"]), 1 / (1 + np.exp(-(h @ w["gate"])))
    energy = (view * gate) @ w["attend"]
    energy -= np.repeat(np.maximum.reduceat(energy, starts), sizes)
    attention = np.exp(energy)
    attention /= np.repeat(np.add.reduceat(attention, starts), sizes)
    z = np.add.reduceat(h * attention[:, None], starts, axis=0)
    score = 1 / (1 + np.exp(-np.clip(z @ w["out"] + w["out0"], -30, 30)))
    return {"h": h, "view": view, "gate": gate, "attention": attention, "z": z, "score": score}


def gradients(w, x, first, label) -> dict[str, np.ndarray]:
    """Of the mean cross entropy."""
    starts, sizes = first[:-1], np.diff(first)
    f = forward(w, x, first)
    d_logit = (f["score"] - label) / len(label)
    d_z = np.repeat(d_logit[:, None] * w["out"], sizes, axis=0)
    d_attention = (d_z * f["h"]).sum(axis=1)
    mean = np.repeat(np.add.reduceat(f["attention"] * d_attention, starts), sizes)
    d_energy = f["attention"] * (d_attention - mean)
    d_both = d_energy[:, None] * w["attend"]
    d_view = d_both * f["gate"] * (1 - f["view"] ** 2)
    d_gate = d_both * f["view"] * f["gate"] * (1 - f["gate"])
    d_h = d_z * f["attention"][:, None] + d_view @ w["view"].T + d_gate @ w["gate"].T
    d_a = d_h * (1 - f["h"] ** 2)
    return {
        "encode": x.T @ d_a,
        "encode0": d_a.sum(axis=0),
        "view": f["h"].T @ d_view,
        "gate": f["h"].T @ d_gate,
        "attend": (f["view"] * f["gate"]).T @ d_energy,
        "out": f["z"].T @ d_logit,
        "out0": d_logit.sum(keepdims=True),
    }


def train(bags: list[np.ndarray], labels: np.ndarray, epochs: int = 40, batch: int = 256, rate: float = 0.01) -> Model:
    if not len(bags) or labels.min() >= 0.5 or labels.max() < 0.5:
        return Model(np.zeros(1), np.ones(1), {}, float(labels.mean()) if len(bags) else 0.5)
    rng = np.random.default_rng(7)
    stacked = np.concatenate(bags).astype(np.float64)
    mean, scale = stacked.mean(axis=0), stacked.std(axis=0) + 1e-3
    bags = [(bag - mean) / scale for bag in bags]
    d = len(FEATURES)
    shapes = {
        "encode": (d, HIDDEN), "encode0": (HIDDEN,), "view": (HIDDEN, 8), "gate": (HIDDEN, 8), "attend": (8,),
        "out": (HIDDEN,), "out0": (1,),
    }
    w = {k: rng.normal(0, 0.3, s) if not k.endswith("0") else np.zeros(s) for k, s in shapes.items()}
    m = {k: np.zeros(s) for k, s in shapes.items()}
    v = {k: np.zeros(s) for k, s in shapes.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(bags), batch):
            own = order[at : at + batch]
            first = np.append(0, np.cumsum([len(bags[i]) for i in own]))
            g = gradients(w, np.concatenate([bags[i] for i in own]), first, labels[own])
            step += 1
            for k in w:
                slope = g[k] + 1e-4 * w[k]
                m[k] = 0.9 * m[k] + 0.1 * slope
                v[k] = 0.999 * v[k] + 0.001 * slope**2
                w[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, w)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS, train_passages: int = TRAIN_PASSAGES) -> Model:
    """A model from ``labels`` (doc_id, quality) of documents that are not held out."""
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("id"))
        .agg(F.avg(F.col("quality").cast("double")).alias("label"))
        .join(docs.select(F.col("doc_id").alias("id")).distinct(), "id", "left_semi")
        .orderBy(F.xxhash64("id"), "id")
        .limit(train_docs)
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, "text"):
            features, first = passages_of(chunk.column("text"))
            bags = []
            for a, b in zip(first, first[1:]):
                spread = np.unique(np.linspace(a, b - 1, train_passages).astype(np.int64)) if b - a > train_passages else np.arange(a, b)
                bags.append(features[spread].tobytes())
            yield pa.RecordBatch.from_arrays([chunk.column("id"), chunk.column("label"), pa.array(bags)], ["id", "label", "bag"])

    rows = docs.select(F.col("doc_id").alias("id"), "text").join(known, "id").select("id", "label", "text")
    kind = dict(rows.dtypes)["id"]
    sample = rows.mapInArrow(run, f"id {kind}, label double, bag binary").toArrow().sort_by([("id", "ascending"), ("bag", "ascending")])
    bags = [np.frombuffer(b, np.float32).reshape(-1, len(FEATURES)) for b in sample["bag"].to_pylist()]
    return train(bags, np.asarray(sample["label"], dtype=np.float64))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, text_key, score) of each row of ``docs`` (doc_id, text)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, "text"):
            scores = model.scores(*passages_of(chunk.column("text")))
            yield pa.RecordBatch.from_arrays([*chunk.select(["doc_id", "text_key"]).columns, pa.array(scores)], ["doc_id", "text_key", "score"])

    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, text_key long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, text_key, held_out, score, predicted of each row of ``docs``."""
    return score(docs, fit(docs, labels)).select(
        "doc_id",
        "text_key",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``, all columns."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, "text"):
            yield chunk.filter(pa.array(model.scores(*passages_of(chunk.column("text"))) >= threshold))

    return docs.mapInArrow(run, docs.schema)
