"""Adaptive context-mixing range coder for sequences of token ids below 65536.

Blocks start afresh and are coded independently of each other. Within a block order 2 predicts
the next id by the last two and order 1 by the last one: each gives the id that followed last
time, with a counter of how often that held. A symbol says which prediction is right, or that
none is; then the id itself follows by the order-0 frequencies, which are counted over all
blocks of a batch and kept with them. The symbol's distribution is mixed from two adaptive
tables, one seen through the counters of both predictions and one through the last two symbols;
at every fourth id a
weight moves towards the table that has given the right symbol more. Both distributions have a
power of two as their sum, so that symbol and id take one step of the range coder together. It
writes 16 bits at a time; carries are added to the written words at the end.

All blocks of a batch are coded side by side: every operation below is on one number per block.
Blocks that are shorter than the first repeat their last id once, which decoding drops.
"""

from __future__ import annotations

import numpy as np

SURE = 3  # largest value of a counter, in the lower two bits of a prediction
#: What a counter from 0 to 3 gains: if its prediction was wrong, then if it was right. A wrong one
#: below 2 gives way to the id.
STEPS = np.array([0, 0, -1, -2, 1, 1, 1, 0], np.int32)
HASH1, HASH2 = 8, 9  # bits of the tables of predictions
WEIGHT, OFTEN = 16, 4  # sum of the two weights; they move at every fourth id
RATE_A, RATE_B = 5, 4  # the tables of distributions move by 1/32 and 1/16 of the way

# A distribution of three symbols is two running sums of 16 bits, in the halves of a number.
ONE = 0xFFFF
HALVES = ONE << 32 | ONE
SYMBOL_BITS, ID_BITS = 12, 18
SYMBOLS, IDS = 1 << SYMBOL_BITS, 1 << ID_BITS
BITS = SYMBOL_BITS + ID_BITS
NO_ID = 1 << 16  # stands for the id where a prediction was right
OWN = (1 << 32) - 1  # the half of a number in the table of ids that has an own frequency
# The width of the range is from 2**40 to 2**56; the range reaches up to 2**57.
FLOOR, WIDEST = 1 << 40, 1 << 56


def frequencies(ids: np.ndarray) -> np.ndarray:
    """Order-0 frequency of each of the 65536 ids, ``IDS`` in all; 0 for those that do not occur."""
    counts = np.bincount(ids, minlength=1 << 16)
    there = (counts > 0).astype(np.int64)
    out = there + counts * (IDS - there.sum()) // max(1, len(ids))
    out[counts.argmax()] += IDS - out.sum()
    return out


def _both(first: float, second: float) -> int:
    """A distribution by the probabilities of its first two symbols."""
    return int(first * ONE) | int((first + second) * ONE) << 32


def _at_first() -> np.ndarray:
    """Where the distributions by counters start: the surer a prediction, the likelier it is."""
    out = []
    for context in range(32):
        sure2, sure1, agree = context >> 3, context >> 1 & 3, context & 1
        first = (0.1, 0.4, 0.6, 0.8)[sure2]
        out.append(_both(first, (1 - first) * (0.02 if agree else (0.1, 0.3, 0.5, 0.7)[sure1])))
    return np.array(out, np.int64)


def _moves(rate: int) -> tuple[int, int, np.ndarray]:
    """Shift, mask and increments per symbol that move both sums towards a symbol."""
    step = ONE >> rate
    return rate, step << 32 | step, np.array([step << 32 | step, step << 32, 0], np.int64)


class _Models:
    """State of all blocks: predictions with counters, distributions of the symbols, weights."""

    def __init__(self, lanes: int):
        row = np.arange(lanes)
        self.row1, self.row2 = row << HASH1, row << HASH2
        self.row_a, self.row_b = row << 5, row << 4
        self.row_bounds = row
        self.bounds = np.zeros((4, lanes), np.int64)
        self.bounds[3] = SYMBOLS
        self.guess1 = np.zeros(lanes << HASH1, np.int32)
        self.guess2 = np.zeros(lanes << HASH2, np.int32)
        self.by_sure = np.tile(_at_first(), lanes)
        self.by_past = np.full(lanes << 4, _both(0.2, 0.1), np.int64)
        self.moves_a, self.moves_b = _moves(RATE_A), _moves(RATE_B)
        self.last = np.zeros(lanes, np.int32)
        self.mark = np.zeros(lanes, np.int32)  # hash of the id before the last
        self.past = np.zeros(lanes, np.int64)
        self.weight = np.full(lanes, WEIGHT // 2, np.int64)
        self.seen = 0
        # Every step writes to the same few arrays, which stay in the cache.
        self.at1, self.at2, self.in_a, self.in_b = np.zeros((4, lanes), np.int64)
        self.v1, self.v2, self.p1, self.p2, self.c1, self.c2 = np.zeros((6, lanes), np.int32)
        self.a, self.b, self.more = np.zeros((3, lanes), np.int64)
        self.long, self.long2, self.short = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64), np.zeros(lanes, np.int32)

    def predict(self) -> tuple[np.ndarray, np.ndarray]:
        """Sums of the mixed frequencies up to the first and up to the second symbol.

        They are rows of ``bounds``, which the next call overwrites as all that is kept here.
        """
        hashed, short = self.p1, self.short
        np.multiply(self.last, np.int32(10007), out=hashed)
        np.right_shift(hashed, 3, out=short)
        short &= (1 << HASH1) - 1
        np.add(self.row1, short, out=self.at1)
        hashed += self.mark
        hashed >>= 4
        hashed &= (1 << HASH2) - 1
        np.add(self.row2, hashed, out=self.at2)
        np.multiply(self.last, np.int32(3001), out=self.mark)
        # All places are within the tables; clipping is what writes to ``out`` without a copy.
        for table, at, value, guess, counter in (
            (self.guess1, self.at1, self.v1, self.p1, self.c1),
            (self.guess2, self.at2, self.v2, self.p2, self.c2),
        ):
            table.take(at, out=value, mode="clip")
            np.right_shift(value, 2, out=guess)
            np.bitwise_and(value, SURE, out=counter)
        np.left_shift(self.c2, 2, out=short)
        short |= self.c1
        short <<= 1
        short |= self.p1 == self.p2
        np.add(self.row_a, short, out=self.in_a)
        np.add(self.row_b, self.past, out=self.in_b)
        self.by_sure.take(self.in_a, out=self.a, mode="clip")
        self.by_past.take(self.in_b, out=self.b, mode="clip")
        np.subtract(self.a, self.b, out=self.more)
        scaled = np.multiply(self.more, self.weight, out=self.long)
        scaled += np.left_shift(self.b, 4, out=self.long2)
        scaled >>= 4
        scaled &= HALVES
        scaled *= SYMBOLS - 3
        scaled >>= 16
        _, upto1, upto2, _ = self.bounds
        np.bitwise_and(scaled, SYMBOLS - 1, out=upto1)
        upto1 += 1
        np.right_shift(scaled, 32, out=upto2)
        upto2 += 2
        return upto1, upto2

    def span(self, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sum of the mixed frequencies below each symbol, and its own."""
        at = np.multiply(symbol, len(self.row_bounds), out=self.long)
        at += self.row_bounds
        lower = self.bounds.take(at)
        at += len(self.row_bounds)
        own = self.bounds.take(at)
        own -= lower
        return lower, own

    def update(self, ids: np.ndarray, held1: np.ndarray, held2: np.ndarray, symbol: np.ndarray) -> None:
        moved = self.long
        for table, rows, had, (rate, mask, steps) in (
            (self.by_sure, self.in_a, self.a, self.moves_a),
            (self.by_past, self.in_b, self.b, self.moves_b),
        ):
            np.right_shift(had, rate, out=moved)
            moved &= mask
            np.subtract(had, moved, out=moved)
            moved += steps.take(symbol, out=self.long2, mode="clip")
            table[rows] = moved
        self.seen += 1
        if self.seen % OFTEN == 0:
            upto1, upto2 = self.more << 32 >> 32, self.more >> 32
            gain = np.where(held2, upto1, np.where(held1, upto2 - upto1, -upto2))
            moved = self.weight + np.where(gain > 0, 1, -1)
            self.weight = np.minimum(np.maximum(moved, 1), WEIGHT - 1)
        fresh = np.left_shift(ids, 2, out=self.short)
        for table, rows, value, counter, held in (
            (self.guess1, self.at1, self.v1, self.c1, held1),
            (self.guess2, self.at2, self.v2, self.c2, held2),
        ):
            doubted = counter < 2
            doubted &= ~held
            counter += np.multiply(held, np.int32(SURE + 1))
            value += STEPS.take(counter)
            np.copyto(value, fresh, where=doubted)
            table[rows] = value
        self.past <<= 2
        self.past &= 15
        self.past += symbol
        self.last = ids


def _id_table(order0: np.ndarray) -> np.ndarray:
    """Sum of the frequencies below each id, and in the lower 32 bits its own; the whole range for ``NO_ID``."""
    below = np.concatenate(([0], np.cumsum(order0)[:-1], [0])).astype(np.int64)
    return below << 32 | np.concatenate((order0, [IDS])).astype(np.int64)


def _columns(ids: np.ndarray, lengths: list[int]) -> np.ndarray:
    """A column per block; those that are shorter than the first repeat their last id."""
    lanes, steps = len(lengths), max(lengths)
    longer = lengths.count(steps)
    out = np.empty((steps, lanes), np.int32)
    out[:, :longer] = ids[: longer * steps].reshape(longer, steps).T
    if longer < lanes:
        out[: steps - 1, longer:] = ids[longer * steps :].reshape(lanes - longer, steps - 1).T
        out[steps - 1, longer:] = out[steps - 2, longer:]
    return out


def block_lengths(n: int, block: int) -> list[int]:
    """Lengths of blocks, at most ``block``, that differ by one at most, longer ones first."""
    count = max(1, -(-n // block))
    return [n // count + (i < n % count) for i in range(count)]


def encode(ids: np.ndarray, lengths: list[int], order0: np.ndarray) -> list[bytes]:
    """Code consecutive blocks of ids; ``lengths`` as ``block_lengths`` gives them."""
    ids = np.asarray(ids, np.int32)
    if len(ids) and (ids.min() < 0 or ids.max() >= 1 << 16):
        raise ValueError("ids must be from 0 to 65535")
    rows = _columns(ids, lengths)
    steps, lanes = rows.shape
    # A step writes two words at most, and four are left in the end.
    room = 2 * steps + 4
    words = np.empty(lanes * room, np.uint32)
    starts = np.arange(lanes) * room
    at = starts.copy()
    low, width = np.zeros(lanes, np.int64), np.full(lanes, WIDEST)
    id_table = _id_table(order0)
    models = _Models(lanes)
    for now in rows:
        models.predict()
        held1, held2 = models.p1 == now, models.p2 == now
        symbol = ((2 - held1.view(np.int8)) * ~held2).astype(np.int64)
        lower, own = models.span(symbol)
        key = np.where(held1 | held2, NO_ID, now)
        part = id_table.take(key)
        unit = width >> BITS
        lower <<= ID_BITS
        lower += own * (part >> 32)
        lower *= unit
        low += lower
        part &= OWN
        part *= own
        width = np.multiply(unit, part, out=unit)
        models.update(now, held1, held2, symbol)
        # A word that is not certain yet is overwritten by the next step; a second one seldom is certain.
        words[at] = low >> 40
        out = width < FLOOR
        twice = out.astype(np.int64)
        at += twice
        twice <<= 4
        low &= np.where(out, FLOOR - 1, -1)
        low <<= twice
        width <<= twice
        if width.min() < FLOOR:
            which = np.flatnonzero(width < FLOOR)
            had = low[which]
            words[at[which]] = had >> 40
            at[which] += 1
            low[which] = (had & FLOOR - 1) << 16
            width[which] <<= 16
    for i, left in enumerate((low >> 40, low >> 24 & ONE, low >> 8 & ONE, low << 8 & ONE)):
        words[at + i] = left
    at += 4
    flat = np.concatenate([words[i:j] for i, j in zip(starts.tolist(), at.tolist(), strict=True)])
    ends = np.cumsum(at - starts)
    carry = np.flatnonzero(flat >> 16)
    while len(carry):
        flat[carry] &= ONE
        flat[carry - 1] += 1
        carry = carry[flat[carry - 1] >> 16 > 0] - 1
    data = flat.astype("<u2").tobytes()
    return [data[2 * begin : 2 * end] for begin, end in zip([0, *ends.tolist()], ends.tolist(), strict=False)]


def decode(blocks: list[bytes], lengths: list[int], order0: np.ndarray) -> np.ndarray:
    """The ids that ``encode`` was given."""
    lanes, steps = len(lengths), max(lengths)
    room = max(len(b) for b in blocks) // 2 + 8
    words = np.zeros((lanes, room), np.uint64)
    for i, b in enumerate(blocks):
        part = np.frombuffer(b, "<u2")
        words[i, : len(part)] = part
    # What is left of the code, with eight bits more than the range has.
    code = words[:, 0] << 48 | words[:, 1] << 32 | words[:, 2] << 16 | words[:, 3]
    words = words.astype(np.uint16).reshape(-1)
    at = np.arange(lanes) * room + 4
    out = np.zeros((steps, lanes), np.int32)
    width = np.full(lanes, WIDEST)
    id_table = _id_table(order0)
    slots = np.repeat(np.arange(1 << 16, dtype=np.uint16), order0)
    models = _Models(lanes)
    for t in range(steps):
        upto1, upto2 = models.predict()
        unit = width >> BITS
        point = ((code >> np.uint64(8)) // unit.view(np.uint64)).view(np.int64)
        np.minimum(point, (1 << BITS) - 1, out=point)
        part = point >> ID_BITS
        is_first, new = part < upto1, part >= upto2
        symbol = (1 - is_first.view(np.int8) + new.view(np.int8)).astype(np.int64)
        lower, own = models.span(symbol)
        lower <<= ID_BITS
        point -= lower
        found = slots.take((point / own).astype(np.int64))
        now = np.where(new, found, np.where(is_first, models.p2, models.p1))
        part = id_table.take(np.where(new, now, NO_ID))
        lower += own * (part >> 32)
        lower *= unit
        lower <<= 8
        code -= lower.view(np.uint64)
        part &= OWN
        part *= own
        width = np.multiply(unit, part, out=unit)
        out[t] = now
        held1, held2 = models.p1 == now, models.p2 == now
        models.update(now, held1, held2, symbol)
        more = width < FLOOR
        twice = more.astype(np.int64)
        code = np.where(more, code << np.uint64(16) | words.take(at), code)
        at += twice
        twice <<= 4
        width <<= twice
        if width.min() < FLOOR:
            which = np.flatnonzero(width < FLOOR)
            code[which] = code[which] << np.uint64(16) | words[at[which]]
            at[which] += 1
            width[which] <<= 16
    out = out.T
    return np.concatenate([out[i, :n] for i, n in enumerate(lengths)])
