"""Ids of texts by a tokenizer that never looks past white space.

Such a tokenizer gives a text the ids of its words, one after the other, so each
distinct word is encoded once and kept. New words of letters, digits and ASCII
punctuation only are cut further, into the runs that the tokenizer's own split
makes of them (each of which it encodes by itself); new runs are joined by spaces
for one call. All other words (marks, contractions, strings of special tokens)
are encoded as they are.

What is kept is bounded in bytes and not in words: beyond ``KEPT_BYTES`` the
table starts anew, and words longer than ``LONGEST`` are never kept.
"""

from __future__ import annotations

import re

import numpy as np

KEPT_BYTES = 96 << 20
LONGEST = 64
_ENTRY = 200  # bytes of a kept word beside its characters, about

# Letters with one form in every normal form, single digits, and punctuation
# other than the apostrophe, which begins contractions.
_RUNS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]|[!-&(-/:-@\[-`{-~]+")
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_SEPARATORS = "\x1c\x1d\x1e\x1f"  # str.split() takes these for white space


class _Slots(dict):
    """Numbers of words, in order of appearance; ``new`` are those to be encoded.
    A long word gets a number each time."""

    def __init__(self):
        self.new: list[str] = []
        self.n = 0

    def __missing__(self, key: str) -> int:
        slot = self.n
        self.n += 1
        self.new.append(key)
        if len(key) <= LONGEST:
            self[key] = slot
        return slot


class WordEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.clear()

    def clear(self) -> None:
        self.slot, self.runs = _Slots(), {}
        self.starts, self.counts, self.table = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)
        self.bytes = 0

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def cut(self, word: str) -> list[str]:
        """The runs of a word, or none if it is to be encoded as it is."""
        runs = _RUNS.findall(word)
        if sum(map(len, runs)) != len(word) or any(s in word for s in self.special):
            return []
        return runs

    def learn(self, runs: list[str]) -> None:
        """Encode runs, joined where the answer shows which ids are whose."""
        encoded = self.tokenizer.encode(" ".join(runs), add_special_tokens=False)
        words = np.array(encoded.word_ids, dtype=np.int64) if all(w is not None for w in encoded.word_ids) else None
        if words is None or not len(words) or words[-1] != len(runs) - 1 or len(np.unique(words)) != len(runs):
            self.runs.update(zip(runs, self.ids(runs)))
            return
        cuts, ids = np.searchsorted(words, np.arange(len(runs) + 1)).tolist(), encoded.ids
        self.runs.update((run, ids[a:b]) for run, a, b in zip(runs, cuts, cuts[1:]))

    def add(self) -> None:
        words, self.slot.new = self.slot.new, []
        cuts = [self.cut(w) if len(w) <= LONGEST else [] for w in words]
        new = [r for r in dict.fromkeys(r for runs in cuts for r in runs) if r not in self.runs]
        for at in range(0, len(new), 4096):
            self.learn(new[at : at + 4096])
        whole = iter(self.ids([w for w, runs in zip(words, cuts) if not runs]))
        found, sizes, known = [], [], self.runs
        for runs in cuts:
            before = len(found)
            if runs:
                for run in runs:
                    found += known[run]
            else:
                found += next(whole)
            sizes.append(len(found) - before)
        counts = np.array(sizes, dtype=np.int64)
        ends = len(self.table) + np.cumsum(counts)
        self.starts, self.counts = np.append(self.starts, ends - counts), np.append(self.counts, counts)
        self.table = np.append(self.table, np.array(found, dtype=np.int32))
        self.bytes += sum(map(len, words)) + _ENTRY * len(words) + 4 * len(found)
        self.bytes += sum(map(len, new)) + _ENTRY * len(new)

    def words(self, text: str) -> list[str]:
        return _WORDS.findall(text) if any(c in text for c in _SEPARATORS) else text.split()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if self.bytes > KEPT_BYTES:
            self.clear()
        words = [self.words(t) for t in texts]
        slots = [np.fromiter(map(self.slot.__getitem__, own), np.int64, len(own)) for own in words]
        if self.slot.new:
            self.add()
        out = []
        for own in slots:
            n = self.counts.take(own)
            ends = np.cumsum(n)
            total = int(ends[-1]) if len(ends) else 0
            out.append(self.table.take(np.arange(total) + np.repeat(self.starts.take(own) - (ends - n), n)))
        return out


_kept: dict[str, WordEncoder] = {}


def encoder_of(path: str) -> WordEncoder:
    """The encoder of this worker process, with the words that its tasks have met."""
    if path not in _kept:
        _kept.clear()
        _kept[path] = WordEncoder(path)
    return _kept[path]
