"""Lossless coding of token ids: adaptive context mixing drives a range coder.

A block is coded on its own: its model starts empty and its checksums stand in its header. The
ids of a block are dealt to lanes, each a contiguous part with a range coder of its own, and all
lanes advance one id at a time as NumPy vectors. The lanes share the block's model, which is
updated after every step with what all of them have coded.

For each id two predictions are made: the id that followed the last two ids (order 2) and the
id that followed the last one (order 1), each with a confidence. The hit rates by confidence are
mixed in the logistic domain with weights that learn from every step; the mix is the
probability of the order-2 prediction, and the order-1 prediction gets its share of the rest.
An id that neither predicted is coded with order-0 frequencies. All of it is integer
arithmetic, so a block reads the same on any machine.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"IDCM1"
HEADER = struct.Struct("<5sIIII")  # magic, ids, vocabulary, lanes, crc of the ids
CHECK = struct.Struct("<I")  # crc of all other bytes
LANES = 4096
LANE_IDS = 256
TABLE_BITS = 18
SURE_BITS = 4
SURE = 1 << SURE_BITS
MODE_BITS = 12
ORDER0_BITS = 19
REBUILD = 16
LEARN = 4

U = np.uint64
TOP, LOW_LIMIT = U(1 << 48), U(1 << 40)


def _stretch_table() -> np.ndarray:
    """ln(p / (1 - p)) in 1/256ths, by probability in 1/4096ths."""
    p = (np.arange(4096) + 0.5) / 4096
    return np.rint(np.log(p / (1 - p)) * 256).astype(np.int64)


def _squash_table() -> np.ndarray:
    """Probability in 1/4096ths, by stretched value in 1/256ths from -2047 to 2047."""
    x = np.arange(-2047, 2048) / 256
    return np.clip(np.rint(4096 / (1 + np.exp(-x))), 1, 4000).astype(np.int64)


STRETCH, SQUASH = _stretch_table(), _squash_table()


class Model:
    """What both sides know about the ids of a block so far.

    A guess and its confidence share one number in the tables of order 1 and 2. A situation is
    whether the guesses agree, the confidence of order 2 and that of order 1; a slot is one of
    the three ways out of it: order 2 hit, order 1 hit, neither.
    """

    def __init__(self, vocabulary: int, decodes: bool) -> None:
        self.vocabulary, self.decodes = vocabulary, decodes
        self.order1 = np.zeros(vocabulary, np.int32)
        self.order2 = np.zeros(1 << TABLE_BITS, np.int32)
        # Hits and tries of order 2 and 1 by confidence; the start favours high confidence.
        self.hits = np.stack([np.arange(SURE) + 1] * 2).astype(np.int64)
        self.tries = np.full((2, SURE), SURE + 2, np.int64)
        # Weights (1/65536) of the two stretched rates, by whether the guesses agree.
        self.weights = np.array([[40000, 10000], [40000, 40000]], np.int64)
        self.raw = np.ones(vocabulary, np.uint64)  # 16 for each id that no guess hit, and 1
        self.raw_sum = vocabulary
        self.names = np.arange(vocabulary, dtype=np.uint16 if vocabulary <= 1 << 16 else np.int32)
        self.waiting: list[np.ndarray] = []
        self.slots: list[np.ndarray] = []
        self.starts, self.sizes = np.zeros((2, 2 * SURE * SURE * 3), U)
        self.step = 0
        self._rebuild()
        self._mix()

    def _rebuild(self) -> None:
        """Order-0 frequencies out of 2^19; every id keeps one at least."""
        if self.waiting:
            ids = np.concatenate(self.waiting)
            self.raw += np.bincount(ids, minlength=self.vocabulary).view(U) << U(4)
            self.raw_sum += 16 * len(ids)
            self.waiting = []
        size = self.raw * U((1 << ORDER0_BITS) - self.vocabulary)
        size //= U(self.raw_sum)
        size += U(1)
        ends = np.cumsum(size)
        starts = (ends - size) << U(32)
        size[-1] += U(1 << ORDER0_BITS) - ends[-1]
        self.order0 = starts | size
        if self.decodes:
            self.id_at = np.repeat(self.names, size.view(np.int64))

    def frequencies(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the order-0 ranges of ids begin and how large they are, out of 2^19."""
        both = self.order0[ids]
        return both >> U(32), both & U((1 << 32) - 1)

    def _mix(self) -> None:
        """For every situation where its slots begin and how large they are, out of 2^12."""
        rate = np.minimum(self.hits * 4096 // self.tries, 4095)
        self.stretched = STRETCH[rate]
        dot = (self.weights[:, :1, None] * self.stretched[0][:, None]
               + self.weights[:, 1:, None] * self.stretched[1]) >> 16
        self.p2 = SQUASH[np.minimum(np.maximum(dot, -2047), 2047) + 2047]
        rest = 4096 - self.p2
        share = (rest * np.minimum(np.maximum(rate[1], 64), 4000)) >> 12
        np.maximum(share[0], 1, out=share[0])
        share[1] = 0
        starts, sizes = (x.reshape(2, SURE, SURE, 3) for x in (self.starts, self.sizes))
        starts[..., 1] = sizes[..., 0] = self.p2
        sizes[..., 1] = share
        starts[..., 2] = self.p2 + share
        sizes[..., 2] = rest - share

    def predict(self, last: np.ndarray, before: np.ndarray) -> None:
        """Set the two guesses (order 2, order 1) and the first slot of each lane's situation."""
        self.at1 = last
        self.at2 = ((last * 0x2F0B4C47 + before * 0x1F35A3B1) >> 7) & ((1 << TABLE_BITS) - 1)
        self.entries = np.empty((2, len(last)), np.int32)
        self.order2.take(self.at2, out=self.entries[0], mode="clip")
        self.order1.take(last, out=self.entries[1], mode="clip")
        self.guesses, self.sure = self.entries >> SURE_BITS, self.entries & SURE - 1
        agree = self.guesses[0] == self.guesses[1]
        self.slot = (self.sure[0] * np.int32(3 * SURE) + self.sure[1] * np.int32(3)
                     + agree * np.int32(3 * SURE * SURE)).astype(np.int64)

    def update(self, ids: np.ndarray, hits: np.ndarray, slots: np.ndarray,
               order0: np.ndarray) -> None:
        """Learn from the ids of this step, the guesses that hit them and the slots they took.

        ``order0`` are the ids that no guess hit. A hit makes a guess surer; a miss halves its
        confidence, and a guess with none left gives way to the id.
        """
        surer = np.minimum(self.entries + 1, self.entries | SURE - 1)
        less = self.entries - ((self.sure + 1) >> 1)
        new = np.where(hits, surer, np.where(self.sure > 1, less, ids << SURE_BITS | 1))
        self.order2[self.at2] = new[0]
        self.order1[self.at1] = new[1]
        self.slots.append(slots)
        if len(order0):
            self.waiting.append(order0)
        self.step += 1
        if self.step % LEARN == 0 or self.step < LEARN:
            self._learn()
        if self.step % REBUILD == 0 or self.step in (1, 2, 4, 8):
            self._rebuild()

    def _learn(self) -> None:
        """Move the hit rates and the weights by what happened since the last time."""
        ways = np.bincount(np.concatenate(self.slots), minlength=len(self.starts)) \
            .reshape(2, SURE, SURE, 3)
        self.slots = []
        seen, good2 = ways.sum(3), ways[..., 0]
        # Where the guesses agree, a hit is one of both.
        good1 = ways[0, ..., 1] + ways[1, ..., 0]
        self.tries[0] += seen.sum((0, 2))
        self.tries[1] += seen.sum((0, 1))
        self.hits[0] += good2.sum((0, 2))
        self.hits[1] += good1.sum(0)
        error = (good2 << 12) - seen * self.p2
        n = 8 * np.maximum(seen.sum((1, 2)), 1)
        self.weights[:, 0] += (error.sum(2) @ self.stretched[0]) // n
        self.weights[:, 1] += (error.sum(1) @ self.stretched[1]) // n
        self.weights = np.minimum(np.maximum(self.weights, -200_000), 200_000)
        self._mix()


class _Lanes:
    """One range coder for each lane, in 64-bit registers; words of 16 bits go out or come in."""

    def __init__(self, lanes: int) -> None:
        self.low = np.zeros(lanes, U)
        self.range = np.full(lanes, (1 << 64) - 1, U)

    def settle(self, n: int) -> None:
        """Shift out the top words that no later id can change, in the first ``n`` lanes."""
        low, rng = self.low[:n], self.range[:n]
        settled = (low ^ (low + rng)) < TOP
        lanes = np.flatnonzero(settled | (rng < LOW_LIMIT))
        low, rng, settled = low[lanes], rng[lanes], settled[lanes]
        while len(lanes):
            # Too narrow, yet across a border: give up the part beyond the border.
            across = np.flatnonzero(~settled)
            rng[across] = (~low[across] + U(1)) & (LOW_LIMIT - U(1))
            self.shift(lanes, low)
            low, rng = low << U(16), rng << U(16)
            self.low[lanes], self.range[lanes] = low, rng
            settled = (low ^ (low + rng)) < TOP
            more = np.flatnonzero(settled | (rng < LOW_LIMIT))
            lanes, low, rng, settled = lanes[more], low[more], rng[more], settled[more]


class _Writer(_Lanes):
    def __init__(self, lanes: int, ids: int) -> None:
        super().__init__(lanes)
        # A row holds one word of every lane: lanes fill at about one pace, so few rows are in use.
        self.words = np.zeros((4 * ids + 8, lanes), "<u2")
        self.flat, self.at = self.words.reshape(-1), np.arange(lanes)

    def shift(self, lanes: np.ndarray, low: np.ndarray) -> None:
        at = self.at[lanes]
        self.flat[at] = low >> U(48)
        self.at[lanes] = at + len(self.low)

    def finish(self) -> bytes:
        every = np.arange(len(self.low))
        for k in (0, 16, 32, 48):
            self.shift(every, self.low << U(k))
        used = self.at // len(self.low)
        words = np.ascontiguousarray(self.words[:used.max()].T)
        return used.astype("<u4").tobytes() + words[np.arange(words.shape[1]) < used[:, None]].tobytes()


class _Reader(_Lanes):
    """``above`` is how far the code lies above ``low``."""

    def __init__(self, lanes: int, data: bytes) -> None:
        super().__init__(lanes)
        used = np.frombuffer(data, "<u4", lanes).astype(np.int64)
        self.words = np.frombuffer(data, "<u2", offset=4 * lanes)
        self.at = np.cumsum(used) - used
        self.above = np.zeros(lanes, U)
        for _ in range(4):
            self.shift(np.arange(lanes), self.low)

    def shift(self, lanes: np.ndarray, low: np.ndarray) -> None:
        at = self.at[lanes]
        self.above[lanes] = (self.above[lanes] << U(16)) | self.words[at]
        self.at[lanes] = at + 1


def _layout(ids: int) -> tuple[int, int]:
    """Lanes, and the ids of a lane; only the last lane may be shorter."""
    lanes = int(np.clip(ids // LANE_IDS, 1, LANES))
    length = -(-ids // lanes)
    return -(-ids // length) if ids else 0, length


def encode_block(ids: np.ndarray, vocabulary: int) -> bytes:
    """The bytes of a block. ``ids`` are below ``vocabulary``, itself at most 2^19."""
    ids = np.asarray(ids, np.int64)
    if not 1 <= vocabulary <= 1 << (ORDER0_BITS - 1):
        raise ValueError("vocabulary too large for the order-0 frequencies")
    if len(ids) and not 0 <= int(ids.min()) <= int(ids.max()) < vocabulary:
        raise ValueError("an id lies outside the vocabulary")
    lanes, length = _layout(len(ids))
    body = b""
    if lanes:
        model, coder = Model(vocabulary, False), _Writer(lanes, length)
        flat = np.zeros(lanes * length, np.int32)
        flat[:len(ids)] = ids
        grid = np.ascontiguousarray(flat.reshape(lanes, length).T)  # a step is a row
        short = len(ids) - (lanes - 1) * length
        last = before = np.zeros(lanes, np.int64)
        for step in range(length):
            n = lanes if step < short else lanes - 1
            now = grid[step, :n]
            model.predict(last[:n], before[:n])
            hits = model.guesses == now
            # A way out of the situation: 0, 1 or 2 for order 2, order 1 or neither.
            way = 2 - np.maximum(hits[0].view(np.int8) << 1, hits[1].view(np.int8))
            slot = model.slot + way
            unit = coder.range[:n] >> U(MODE_BITS)
            coder.low[:n] += unit * model.starts.take(slot)
            np.multiply(unit, model.sizes.take(slot), out=coder.range[:n])
            plain = np.flatnonzero(way == 2)
            rest = now[plain].astype(np.int64)
            unit = coder.range[plain] >> U(ORDER0_BITS)
            start, size = model.frequencies(rest)
            coder.low[plain] += unit * start
            coder.range[plain] = unit * size
            coder.settle(n)
            model.update(now, hits, slot, rest)
            last, before = now.astype(np.int64), last
        body = coder.finish()
    head = HEADER.pack(MAGIC, len(ids), vocabulary, lanes, zlib.crc32(ids.astype("<u4").tobytes()))
    return head + CHECK.pack(zlib.crc32(head + body)) + body


def decode_block(data: bytes) -> np.ndarray:
    """The ids of a block; raises ValueError if it is damaged."""
    first = HEADER.size + CHECK.size
    if len(data) < first:
        raise ValueError("not a block of ids")
    head, body = data[:HEADER.size], data[first:]
    magic, count, vocabulary, lanes, ids_crc = HEADER.unpack(head)
    if magic != MAGIC or CHECK.unpack_from(data, HEADER.size)[0] != zlib.crc32(head + body):
        raise ValueError("damaged block of ids")
    if not lanes:
        return np.zeros(0, np.int64)
    length = _layout(count)[1]
    model, coder = Model(vocabulary, True), _Reader(lanes, body)
    grid = np.zeros((length, lanes), np.int64)
    short = count - (lanes - 1) * length
    last = before = np.zeros(lanes, np.int64)
    for step in range(length):
        n = lanes if step < short else lanes - 1
        model.predict(last[:n], before[:n])
        above, unit = coder.above[:n], coder.range[:n] >> U(MODE_BITS)
        way = ((above >= unit * model.starts[1:].take(model.slot)).view(np.int8)
               + (above >= unit * model.starts[2:].take(model.slot)))
        slot = model.slot + way
        begun = unit * model.starts.take(slot)
        coder.low[:n] += begun
        above -= begun
        np.multiply(unit, model.sizes.take(slot), out=coder.range[:n])
        now = np.where(way == 0, model.guesses[0], model.guesses[1])
        plain = np.flatnonzero(way == 2)
        unit = coder.range[plain] >> U(ORDER0_BITS)
        above = coder.above[plain]
        target = np.minimum(above // unit, U((1 << ORDER0_BITS) - 1)).view(np.int64)
        rest = model.id_at[target].astype(np.int64)
        start, size = model.frequencies(rest)
        begun = unit * start
        coder.low[plain] += begun
        coder.above[plain] = above - begun
        coder.range[plain] = unit * size
        now[plain] = rest
        coder.settle(n)
        model.update(now, model.guesses == now, slot, rest)
        grid[step, :n] = now
        last, before = now.astype(np.int64), last
    ids = grid.T.reshape(-1)[:count]
    if zlib.crc32(ids.astype("<u4").tobytes()) != ids_crc:
        raise ValueError("damaged block of ids")
    return ids
