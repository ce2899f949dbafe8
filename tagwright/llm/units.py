"""Token ids of whole texts, each distinct unit encoded once.

A unit is a stretch of text that the tokenizer's own split never joins with its
neighbours, so that a text's ids are those of its units in order. Units are found
in the bytes of a chunk of texts by a few array operations; they are known by
64-bit hashes, and what is kept of one is its hash and its ids, whatever its
length: about 25 bytes, bounded by ``KEPT_BYTES`` for a worker process, beyond
which the table starts anew. New units go to the tokenizer joined in one text,
and its ids are dealt back by the bytes they stand for; where these do not add
up, each unit is encoded by itself.

Two splits are known. ``byte_level``: runs of letters, digits, or other signs,
each with one space before it, and white space. ``words``: white space is
dropped, case is lowered, digits stand alone. Cuts are made between ASCII signs
and Latin-1 letters only: a stretch without white space that holds anything else
(other scripts, combining marks, control characters, an apostrophe, which begins
contractions) is one unit. Texts with a special token's string, and for
``byte_level`` those with white space beyond ASCII, are encoded as a whole.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa

from tagwright.llm.words import SPACE, buffer_of, mix, powers_of

KEPT_BYTES = 64 << 20
JOINED = 4_096  # new units in one call of the tokenizer

_LETTER, _DIGIT, _SIGN, _OTHER, _WHITE = 1, 2, 3, 4, 5
_CLASS = np.full(256, _OTHER, dtype=np.uint8)
_CLASS[33:127] = _SIGN
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_CLASS[39] = _OTHER
_CLASS[SPACE] = _WHITE

_RANDOM = np.random.Generator(np.random.PCG64(20250921))
_VALUE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _VALUE.copy()
_FOLDED[65:91] = _VALUE[97:123]
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)

# White space beyond ASCII, as UTF-8.
_WIDE_SPACE = re.compile(
    rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80"
)


def classes(data: np.ndarray) -> np.ndarray:
    """The class of each byte; both bytes of a Latin-1 letter are letters."""
    kind = _CLASS[data]
    head = np.flatnonzero(data[:-1] == 0xC3)
    tail = data[head + 1]
    head = head[(tail >= 0x80) & (tail <= 0xBF) & (tail != 0x97) & (tail != 0xB7)]
    kind[head] = kind[head + 1] = _LETTER
    return kind


class Cuts:
    """Units of a chunk: bytes ``starts[i]`` to ``ends[i]``; ``first`` is the first
    unit of each text, ``plain`` tells units without other signs."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, words: bool):
        n = len(data)
        kind = classes(data)
        white = kind == _WHITE
        text_start = np.zeros(n + 1, bool)
        text_start[offsets] = True
        after_white = np.append(True, white[:-1]) | text_start[:n]
        begins = ~white & after_white  # of stretches without white space
        stretch = np.flatnonzero(begins)
        other = kind == _OTHER
        changes = np.append(True, kind[1:] != kind[:-1])
        if words:
            changes |= kind == _DIGIT
        if other.any():
            mixed = np.logical_or.reduceat(other, stretch)
            ends = np.append(stretch[1:], n)[mixed]
            edge = np.zeros(n + 1, np.int8)
            edge[stretch[mixed]] = 1
            edge[ends] -= 1
            inside = np.cumsum(edge[:n], dtype=np.int8).view(bool)
            changes &= ~inside
        else:
            inside = None
        if words:
            cut = ~white & (begins | changes)
        else:
            next_black = np.append(~white[1:], False) & ~text_start[1:]
            spaced = np.append(False, data[:-1] == 32) & ~text_start[:n]
            cut = np.where(white, next_black | ~after_white | text_start[:n], (begins | changes) & ~spaced)
        self.data, self.starts = data, np.flatnonzero(cut)
        bounds = np.append(self.starts, n)
        self.ends = bounds[1:].copy()
        if words:  # without the white space behind
            black_ends = np.flatnonzero(~white & np.append(white[1:] | text_start[1:n], True)) + 1
            self.ends = np.minimum(self.ends, black_ends[np.searchsorted(black_ends, self.starts, "right")])
        self.first = np.searchsorted(self.starts, offsets)
        value = (_FOLDED if words else _VALUE)[data]
        if words:
            value[white] = 0
            if inside is not None:
                value[inside] = np.where(white[inside], np.uint64(0), _VALUE[data[inside]])
        value *= powers_of(_BASE, n)
        self.hashes = mix(np.add.reduceat(value, self.starts) * powers_of(_BASE_INVERSE, n)[self.starts])
        at = np.minimum(self.starts + (data[self.starts] == 32), n - 1)
        self.plain = (kind[at] < _OTHER) if inside is None else (kind[at] < _OTHER) & ~inside[at]

    def unit(self, i: int) -> str:
        return self.data[self.starts[i] : self.ends[i]].tobytes().decode()

    def joined(self, units: np.ndarray, gap: int, gapped: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of units one after the other, the ``gapped`` ones behind a gap;
        where each begins and ends in them."""
        size = self.ends[units] - self.starts[units]
        end = np.cumsum(size + gapped)
        start = end - size
        out = np.full(int(end[-1]), gap, np.uint8)
        at = np.arange(int(size.sum()))
        skipped = np.cumsum(size) - size
        out[at + np.repeat(start - skipped, size)] = self.data[at + np.repeat(self.starts[units] - skipped, size)]
        return out, start, end


class UnitEncoder:
    """Ids of texts by one tokenizer; ``words`` tells its split."""

    def __init__(self, path: str, words: bool):
        from tokenizers import Tokenizer

        self.tokenizer, self.words = Tokenizer.from_file(path), words
        special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile(b"|".join(map(re.escape, special))) if special else None
        vocabulary = self.tokenizer.get_vocab()
        # Tokens are written with one character for each byte.
        self.n_bytes = np.zeros(1 + max(vocabulary.values()), np.int64)
        self.n_bytes[list(vocabulary.values())] = [len(t.removesuffix("</w>") if words else t) for t in vocabulary]
        self.kind = np.uint16 if len(self.n_bytes) <= 1 << 16 else np.uint32
        self.clear()

    def clear(self) -> None:
        """Forget all units."""
        self.known = np.empty(0, np.uint64)
        self.starts, self.counts, self.table = np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, self.kind)

    def kept_bytes(self) -> int:
        return self.known.nbytes + self.starts.nbytes + self.counts.nbytes + self.table.nbytes

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_units(self, cuts: Cuts, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places in ``units`` in the order of coding, number of ids of each, the ids."""
        plain = cuts.plain[units]
        order, sizes, found = [], [], []
        alone = [np.flatnonzero(~plain)]
        joinable = np.flatnonzero(plain)
        # In bytes, as no id stands for it or as a token of its own before a unit
        # that does not begin with a space.
        gap = 32 if self.words else 10
        groups = [joinable[i : i + JOINED] for i in range(0, len(joinable), JOINED)]
        gapped = [np.ones(len(g), np.int64) if self.words else (cuts.data[cuts.starts[units[g]]] != 32).astype(np.int64) for g in groups]
        joined = [cuts.joined(units[g], gap, own) for g, own in zip(groups, gapped)]
        for group, own, (_, start, end), ids in zip(groups, gapped, joined, self.ids([j[0].tobytes().decode() for j in joined])):
            ids = np.array(ids, np.int64)
            if self.words:  # no id stands for a gap
                end = np.cumsum(end - start)
                start = np.append(0, end[:-1])
            stops = np.append(0, np.cumsum(self.n_bytes[ids]))
            first, last = np.searchsorted(stops, start), np.searchsorted(stops, end)
            if stops[-1] != end[-1] or (stops[first] != start).any() or (stops[last] != end).any():
                alone.append(group)  # an id across a cut
                continue
            n = last - first
            order.append(group)
            sizes.append(n)
            found.append(ids[np.arange(int(n.sum())) + np.repeat(first - (np.cumsum(n) - n), n)])
        rest = np.concatenate(alone)
        own = self.ids([cuts.unit(i) for i in units[rest].tolist()])
        order.append(rest)
        sizes.append(np.array([len(i) for i in own], np.int64))
        found += [np.array(i, np.int64) for i in own]
        return np.concatenate(order), np.concatenate(sizes), np.concatenate(found) if found else np.empty(0, np.int64)

    def learn(self, cuts: Cuts, hashes: np.ndarray, units: np.ndarray) -> None:
        """Encode units and keep their ids under their hashes, which rise."""
        order, sizes, ids = self.encode_units(cuts, units)
        starts, counts = np.empty(len(units), np.int32), np.empty(len(units), np.int32)
        starts[order], counts[order] = len(self.table) + np.cumsum(sizes) - sizes, sizes
        at = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, at, hashes)
        self.starts, self.counts = np.insert(self.starts, at, starts), np.insert(self.counts, at, counts)
        self.table = np.append(self.table, ids.astype(self.kind))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, where each text's begin and the
        last one's end). A null is an empty text."""
        data, offsets = buffer_of(texts)
        whole = self.whole_texts(data, offsets)
        if whole.size:
            rest = np.ones(len(texts), bool)
            rest[whole] = False
            own = [np.array(i, self.kind) for i in self.ids([texts[i].as_py() for i in whole.tolist()])]
            ids, bounds = self.encode(pa.array(texts).filter(pa.array(rest)))
            parts = [ids[a:b] for a, b in zip(bounds, bounds[1:])]
            each, kept, alone = [], iter(parts), iter(own)
            for there in rest.tolist():
                each.append(next(kept) if there else next(alone))
            return np.concatenate(each), np.cumsum([0] + [len(e) for e in each])
        if not len(data) or SPACE[data].all() and self.words:
            return np.empty(0, self.kind), np.zeros(len(offsets), np.int64)
        if self.kept_bytes() > KEPT_BYTES:
            self.clear()
        cuts = Cuts(data, offsets, self.words)
        order = np.argsort(cuts.hashes)
        rising = cuts.hashes[order]
        head = np.append(True, rising[1:] != rising[:-1])
        hashes, places, group = rising[head], order[head], np.cumsum(head) - 1
        at = np.searchsorted(self.known, hashes)
        new = np.append(self.known, np.uint64(0))[at] != hashes
        new |= at == len(self.known)
        if new.any():
            self.learn(cuts, hashes[new], places[new])
            at = np.searchsorted(self.known, hashes)
        slots = np.empty(len(order), np.int64)
        slots[order] = at[group]
        n = self.counts.take(slots).astype(np.int64)
        ends = np.cumsum(n)
        ids = self.table.take(np.arange(ends[-1]) + np.repeat(self.starts.take(slots) - (ends - n), n))
        return ids, np.append(0, ends)[cuts.first]

    def whole_texts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Texts that are not cut."""
        raw = memoryview(data)
        found = [m.start() for m in self.special.finditer(raw)] if self.special else []
        if not self.words:
            found += [m.start() for m in _WIDE_SPACE.finditer(raw)]
        return np.unique(np.searchsorted(offsets, found, "right") - 1)


_encoders: dict[tuple[str, bool], UnitEncoder] = {}


def encoder_of(path: str, words: bool) -> UnitEncoder:
    """The encoder of this worker process, with the units that its tasks have met."""
    if (path, words) not in _encoders:
        _encoders.clear()
        _encoders[path, words] = UnitEncoder(path, words)
    return _encoders[path, words]
