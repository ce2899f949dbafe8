"""An adaptive context-mixing range coder for token ids below 65,536.

Ids are coded in blocks that start from an empty model. Per id, tables predict
the next id from the last two ids (order 2) and the last one (order 1), and a
table of recent ids is addressed by the id's low byte (order 0). What is range
coded is which prediction holds: 2, 1, 0 or none; an order-0 hit adds its low
byte, a miss both bytes. The probabilities of the four outcomes are a mix of
three adaptive models (over all, by the order-1 and by the order-2 table's
confidence), weighted by how well each has predicted.

Many blocks advance together, one id per step, so every step is a few array
operations over the blocks. All arithmetic is in integers: encoder and decoder
agree on any machine.
"""

from __future__ import annotations

import numpy as np

BLOCK = 2048  # ids in a block
LANES = 4096  # blocks that advance together

_T1, _T2 = 512, 1024
_TOP, _BOT = np.uint32(1 << 24), np.uint32(1 << 16)

# Four numbers of 16 bits lie in one of 64, one for each outcome, so that a single
# operation works on all four; values stay low enough never to reach a neighbour.
_ONES = np.uint64(0x0001000100010001)
_LOW7, _LOW12 = _ONES * np.uint64(0x7F), _ONES * np.uint64(0xFFF)
_RAISE = np.uint64(127) << np.arange(0, 64, 16, dtype=np.uint64)
_SHIFT = np.arange(0, 64, 16, dtype=np.uint64)
_FIELD = np.uint64(0xFFFF)
_WEIGH_EVERY = 16
_SLICE = 256
# Confidence of a prediction after a miss (0-3) and after a hit (4-7), in bits 16-17.
_NEXT = np.array([0, 0, 0, 1, 1, 2, 3, 3]) << 16


class _Model:
    """State of all lanes: predictions, their confidence, and the mix."""

    def __init__(self, lanes: int):
        self.base1, self.base2 = np.arange(lanes) * _T1, np.arange(lanes) * _T2
        self.base0, self.rows4 = np.arange(lanes) * 256, np.arange(lanes) * 4
        self.table1 = np.zeros(lanes * _T1, dtype=np.int32)  # id, confidence in bits 16-17
        self.table2 = np.zeros(lanes * _T2, dtype=np.int32)
        self.recent = np.zeros(lanes * 256, dtype=np.int32)
        even = _ONES * np.uint64(1000)
        self.chance0 = np.full(lanes, even)
        self.chance1, self.chance2 = np.full(lanes * 4, even), np.full(lanes * 4, even)
        self.success = np.full((3, lanes), 1000, dtype=np.uint64)
        self.weight = np.full((3, lanes), 5, dtype=np.uint64)
        self.weight[0] = 6
        self.last = np.zeros(lanes, dtype=np.int64)
        self.before = np.zeros(lanes, dtype=np.int64)
        self.step = 0

    def look(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Predict for the first ``n`` lanes; frequencies of the four outcomes,
        and their sums up to each, packed."""
        self.n = n
        last = self.last[:n]
        self.at1 = self.base1[:n] + ((last * 40503 >> 4) & (_T1 - 1))
        self.at2 = self.base2[:n] + ((last * 40503 + self.before[:n] * 30011 >> 5) & (_T2 - 1))
        entry1, entry2 = self.table1.take(self.at1), self.table2.take(self.at2)
        self.id1, self.id2 = entry1 & 0xFFFF, entry2 & 0xFFFF
        self.sure1, self.sure2 = entry1 >> 16, entry2 >> 16
        self.row1, self.row2 = self.rows4[:n] + self.sure1, self.rows4[:n] + self.sure2
        self.own = self.chance0[:n], self.chance1.take(self.row1), self.chance2.take(self.row2)
        weight = self.weight[:, :n]
        mixed = self.own[0] * weight[0] + self.own[1] * weight[1] + self.own[2] * weight[2]
        frequency = ((mixed >> np.uint64(4)) & _LOW12) + _ONES
        return frequency, frequency * _ONES

    def learn(self, outcome: np.ndarray, ids: np.ndarray) -> None:
        n = self.n
        raised = _RAISE.take(outcome)
        if self.step % _WEIGH_EVERY == 0:
            shift = _SHIFT.take(outcome)
            success, weight = self.success[:, :n], self.weight[:, :n]
            for i in range(3):
                success[i] += ((self.own[i] >> shift) & _FIELD) - (success[i] >> np.uint64(3))
            total = success.sum(axis=0) + np.uint64(1)
            weight[1:] = success[1:] * np.uint64(16) // total
            weight[0] = np.uint64(16) - weight[1] - weight[2]
        self.step += 1
        own0, own1, own2 = (own - ((own >> np.uint64(5)) & _LOW7) + raised for own in self.own)
        self.chance0[:n] = own0
        self.chance1[self.row1] = own1
        self.chance2[self.row2] = own2
        self.table1[self.at1] = ids | _NEXT.take(self.sure1 + (self.id1 == ids) * 4)
        self.table2[self.at2] = ids | _NEXT.take(self.sure2 + (self.id2 == ids) * 4)
        self.recent[self.base0[:n] + (ids & 255)] = ids
        self.before[:n] = self.last[:n]
        self.last[:n] = ids


def _lengths(sizes: list[int]) -> np.ndarray:
    if any(b > a for a, b in zip(sizes, sizes[1:])):
        raise ValueError("blocks must come by falling size")
    return np.asarray(sizes)


def encode(blocks: list[np.ndarray]) -> list[tuple[bytes, bytes]]:
    """(range coded outcomes, bytes that follow them) of each block of ids."""
    if not blocks:
        return []
    sizes = _lengths([len(b) for b in blocks])
    steps, lanes = int(sizes[0]), len(blocks)
    ids = np.zeros((steps, lanes), dtype=np.uint16)
    for lane, block in enumerate(blocks):
        ids[: len(block), lane] = block
    outcomes = np.zeros((steps, lanes), dtype=np.int8)
    model = _Model(lanes)
    low, span = np.zeros(lanes, np.uint32), np.full(lanes, 0xFFFFFFFF, np.uint32)
    out, at = np.zeros((lanes, 2 * steps + 16), np.uint8), np.zeros(lanes, np.int64)
    for step in range(steps):
        n = int(np.searchsorted(-sizes, -step, "left")) if sizes[-1] <= step else lanes
        frequency, sums = model.look(n)
        own = ids[step, :n].astype(np.int64)
        outcome = 3 - (model.recent.take(model.base0[:n] + (own & 255)) == own)
        np.copyto(outcome, 1, where=model.id1 == own)
        np.copyto(outcome, 0, where=model.id2 == own)
        outcomes[step, :n] = outcome
        shift = _SHIFT.take(outcome)
        picked = (frequency >> shift) & _FIELD
        below = ((sums >> shift) & _FIELD) - picked
        unit = span[:n] // (sums >> np.uint64(48)).astype(np.uint32)
        low[:n] += unit * below.astype(np.uint32)
        span[:n] = unit * picked.astype(np.uint32)
        _emit(low, span, n, out, at)
        model.learn(outcome, own)
    for _ in range(4):
        out[np.arange(lanes), at] = low >> np.uint32(24)
        at += 1
        low <<= np.uint32(8)
    coded = []
    for first in range(0, lanes, _SLICE):  # a part of the lanes at a time, for memory
        some = slice(first, first + _SLICE)
        missed = outcomes[:, some].T
        inside = np.arange(steps)[None, :] < sizes[some, None]
        mask = np.stack([(missed >= 2) & inside, (missed == 3) & inside], axis=2)
        own = np.ascontiguousarray(ids[:, some].T)
        literal = np.stack([own & 255, own >> 8], axis=2).astype(np.uint8)[mask]
        cuts = np.append(0, np.cumsum(mask.reshape(len(mask), -1).sum(axis=1))).tolist()
        coded += [
            (out[first + i, : at[first + i]].tobytes(), literal[x:y].tobytes()) for i, (x, y) in enumerate(zip(cuts, cuts[1:]))
        ]
    return coded


def _settled(low: np.ndarray, span: np.ndarray, n: int) -> np.ndarray:
    """Lanes whose first byte can go; a span that became too small is cut first."""
    ready = (low[:n] ^ (low[:n] + span[:n])) < _TOP
    small = np.flatnonzero(~ready & (span[:n] < _BOT))
    span[small] = (np.uint32(0) - low[small]) & (_BOT - np.uint32(1))
    ready[small] = True
    return np.flatnonzero(ready)


def _emit(low, span, n, out, at) -> None:
    lanes = _settled(low, span, n)
    while len(lanes):
        out[lanes, at[lanes]] = low[lanes] >> np.uint32(24)
        at[lanes] += 1
        low[lanes] <<= np.uint32(8)
        span[lanes] <<= np.uint32(8)
        own_low, own_span = low[lanes], span[lanes]
        again = _settled(own_low, own_span, len(lanes))
        span[lanes] = own_span
        lanes = lanes[again]


def decode(coded: list[tuple[bytes, bytes]], sizes: list[int]) -> list[np.ndarray]:
    """The ids of each block, from what ``encode`` gave and their numbers."""
    if not coded:
        return []
    sizes = _lengths(sizes)
    steps, lanes = int(sizes[0]), len(coded)
    stream = _padded([c for c, _ in coded], 8)
    literal = _padded([b for _, b in coded], 4)
    model = _Model(lanes)
    low, span = np.zeros(lanes, np.uint32), np.full(lanes, 0xFFFFFFFF, np.uint32)
    code = np.zeros(lanes, np.uint32)
    for i in range(4):
        code = code << np.uint32(8) | stream[:, i]
    # Places of the next bytes in the flattened tables.
    at, lit_at = np.arange(lanes) * stream.shape[1] + 4, np.arange(lanes) * literal.shape[1]
    ids = np.zeros((steps, lanes), dtype=np.uint16)
    for step in range(steps):
        n = int(np.searchsorted(-sizes, -step, "left")) if sizes[-1] <= step else lanes
        frequency, sums = model.look(n)
        unit = span[:n] // (sums >> np.uint64(48)).astype(np.uint32)
        value = ((code[:n] - low[:n]) // unit).astype(np.uint64)
        outcome = (value >= sums & _FIELD).astype(np.int64)
        for field in _SHIFT[1:3]:
            outcome += value >= ((sums >> field) & _FIELD)
        shift = _SHIFT.take(outcome)
        picked = (frequency >> shift) & _FIELD
        below = ((sums >> shift) & _FIELD) - picked
        low[:n] += unit * below.astype(np.uint32)
        span[:n] = unit * picked.astype(np.uint32)
        first = literal.take(lit_at[:n]).astype(np.int32)
        second = literal.take(lit_at[:n] + 1).astype(np.int32)
        own = np.where(outcome == 0, model.id2, model.id1)
        near = outcome == 2
        own = np.where(near, model.recent.take(model.base0[:n] + first), own)
        own = np.where(outcome == 3, first | second << 8, own)
        lit_at[:n] += np.maximum(outcome - 1, 0)
        ids[step, :n] = own
        lanes_left = _settled(low, span, n)
        while len(lanes_left):
            code[lanes_left] = code[lanes_left] << np.uint32(8) | stream.take(at[lanes_left])
            at[lanes_left] += 1
            low[lanes_left] <<= np.uint32(8)
            span[lanes_left] <<= np.uint32(8)
            own_low, own_span = low[lanes_left], span[lanes_left]
            again = _settled(own_low, own_span, len(lanes_left))
            span[lanes_left] = own_span
            lanes_left = lanes_left[again]
        model.learn(outcome, own)
    return [ids[:size, lane] for lane, size in enumerate(sizes)]


def _padded(rows: list[bytes], extra: int) -> np.ndarray:
    sizes = np.array([len(r) for r in rows])
    table = np.zeros((len(rows), int(sizes.max(initial=0)) + extra), dtype=np.uint8)
    table[np.arange(table.shape[1])[None, :] < sizes[:, None]] = np.frombuffer(b"".join(rows), dtype=np.uint8)
    return table
