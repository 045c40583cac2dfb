"""An adaptive range coder for blocks of token ids, by mixed predictions of orders 0 to 2.

A block's model starts from nothing: it knows only the sorted distinct ids of the block, which its head lists, and works on
their places in that list.  The interval of an id is a mixture of three predictions:

* order 0: the frequencies of the ids so far;
* order 1 and 2: the id that last proved right after the one or the two ids before, with a confidence of up to 3.

The shares of the two single predictions are learned for each pair of confidences, apart for predictions that agree,
by how often they were right.  All arithmetic is in integers, so that every machine decodes what another encoded.

The model learns a stretch of ids at a time, and stands still inside it; stretches grow from FIRST to MOST ids.  So the intervals
of a stretch are found, and the stretch is learned, in arrays of ids by blocks; only the coder itself, and in
decoding the search for the id, go one id at a time.  Blocks do not depend on each other, and so hundreds of them are coded side by
side: such a step goes over one id of each block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

FIRST, MOST = 512, 1024  # ids of the first and of the longest stretch
ROWS, LEARNT = 64, 32  # ids of each block that are looked at, and learned, in one array
LANES = 256  # blocks whose ids are, so that their models stay in the cache of a core
SHARES = 11  # bits of the shares
GAIN = 32  # weight of one occurrence against that of an id not seen yet
HASH = 10  # bits of the order-2 table
STATES = 32  # agreement, confidence of order 2 and of order 1
_LOW = np.uint64(32)
_FULL = np.uint64(1) << _LOW
# By hit << 2 | confidence: the next confidence, and 4 if the prediction changes.
_NEXT = np.array([5, 5, 1, 2, 1, 2, 3, 3], dtype=np.int32)
_TRIES = 8  # that a state counts for before it was seen


def _prior() -> np.ndarray:
    """By order and state: how many of _TRIES were right."""
    out = np.zeros((2, 2, 4, 4), dtype=np.int64)
    alone, first, second, both = [0, 2, 4, 5], [0, 1, 1, 2], [0, 3, 4, 5], [0, 4, 6, 7]
    out[0, 0], out[1, 0] = np.array(first)[None, :], np.array(second)[:, None]
    out[0, 0, 0] = alone
    out[1, 1] = np.maximum(np.array(both)[:, None], np.array(alone)[None, :])
    return out.reshape(2, STATES)


def stretches(longest: int) -> Iterator[tuple[int, int]]:
    lo, size = 0, FIRST
    while lo < longest:
        yield lo, min(lo + size, longest)
        lo, size = lo + size, min(MOST, lo + size)


class _Mixture:
    """The models of many blocks; blocks lie by falling length, so that those still going on are the first ``live``.

    Arrays of two rows hold what belongs to order 1 and to order 2.
    """

    def __init__(self, alphabets: np.ndarray, decoding: bool):
        n, stride = len(alphabets), int(alphabets.max(initial=1)) + 1
        self.n, self.stride, self.sizes = n, stride, alphabets.astype(np.int64)
        self.row = np.arange(n) * stride
        # of the order-0 intervals of each block: two places for each id, 2^10 at least
        bits = np.maximum(10, 1 + np.ceil(np.log2(np.maximum(1, self.sizes))).astype(np.int32)).astype(np.int32)
        self.wide = int(bits.max(initial=0)) + SHARES > 30  # blocks of very many different ids
        self.kind = np.int64 if self.wide else np.int32
        self.bits, self.total = bits.astype(self.kind), (bits + SHARES).astype(np.uint64)
        self.sign = 63 if self.wide else 31
        self.half = 16 if int(bits.max(initial=0)) < 16 else 32  # bits of a width
        self.counts = (np.arange(stride) < self.sizes[:, None]).astype(np.int64).reshape(-1)
        self.bounds = np.zeros(n * stride, dtype=np.uint32 if self.half == 16 else np.int64)  # start and width of each id
        self.slot = np.concatenate(([0], np.cumsum(1 << bits.astype(np.int64))))
        self.ids = np.zeros(self.slot[-1] if decoding else 0, dtype=np.uint16 if stride <= 1 << 16 else np.int32)  # at each place of an interval
        self.table = np.zeros(n * stride + (n << HASH), dtype=np.uint16 if stride <= 1 << 14 else np.int32)  # prediction << 2 | confidence
        self.hashed = n * stride + (np.arange(n) << HASH)
        self.state = np.arange(n) * STATES
        self.right, self.tries = np.repeat(_prior()[:, None, :], n, axis=1).reshape(2, -1), np.full(n * STATES, _TRIES, dtype=np.int64)
        self.shares = np.zeros(n * STATES, dtype=np.int32)  # of order 2 and, in the low bits, of order 1

    def freeze(self, live: int) -> None:
        """Intervals and shares for the next stretch."""
        # in SHARES bits; each at least one unit, and order 0 at least 32
        first, second = 1 + self.right * ((1 << SHARES) - 34) // self.tries
        self.shares[:] = second << SHARES | first
        total = np.cumsum(self.counts.reshape(-1, self.stride)[:live], axis=1, dtype=np.float64)
        size, most = self.sizes[:live, None], (1 << self.bits[:live].astype(np.int64))[:, None]
        place = np.arange(1, self.stride + 1)
        # a product of two doubles is the same on every machine
        total *= (most - size) / total[:, -1:]
        ends = total.astype(np.int32)
        ends += np.minimum(place, size).astype(np.int32)
        np.copyto(ends, most.astype(np.int32), where=place >= size)
        width = np.diff(ends, axis=1, prepend=np.int32(0))
        self.bounds.reshape(-1, self.stride)[:live] = (ends - width).astype(self.bounds.dtype) << self.half | width
        if len(self.ids):
            every = np.broadcast_to(np.arange(self.stride, dtype=self.ids.dtype), width.shape)
            self.ids[: self.slot[live]] = np.repeat(every.reshape(-1), width.reshape(-1))

    def context(self, last: np.ndarray, before: np.ndarray, lanes: slice) -> None:
        """Predictions after ids, for one id of each block in ``lanes`` or for rows of such."""
        at = np.empty((2, *last.shape), dtype=np.int64)
        np.add(self.row[lanes], last, out=at[0])
        np.add(self.hashed[lanes], (before * 613 + last) & ((1 << HASH) - 1), out=at[1])
        entry = self.table.take(at)
        self.at, self.p, self.sure = at, (entry >> 2).astype(np.int32), entry & 3
        apart = self.p[0] - self.p[1]
        self.agreed = ~((apart | -apart) >> 31)  # all bits set where both predictions are the same
        of = (self.agreed & 16) + (self.sure[1] << 2) + self.sure[0]
        self.of = self.state[lanes] + of

    def weigh(self, lanes: slice) -> None:
        shares, bits = self.shares.take(self.of).astype(self.kind, copy=False), self.bits[lanes]
        first, second = shares & ((1 << SHARES) - 1), shares >> SHARES
        self.w0 = (1 << SHARES) - first - second
        self.mass = np.empty((2, *first.shape), dtype=self.kind)
        np.left_shift(first, bits, out=self.mass[0])
        np.left_shift(second, bits, out=self.mass[1])

    def plain(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and width of order-0 intervals."""
        bounds = self.bounds.take(at)
        start, width = bounds >> self.half, bounds & self.bounds.dtype.type((1 << self.half) - 1)
        if self.half == 16 and not self.wide:
            return start.view(np.int32), width.view(np.int32)
        return start.astype(self.kind), width.astype(self.kind)

    def interval(self, x: np.ndarray, lanes: slice) -> tuple[np.ndarray, np.ndarray]:
        """Start and width of ids in the mixture."""
        start, width = self.plain(self.row[lanes] + x)
        past = self.p - x.astype(np.int32, copy=False)
        below, same = self.mass & (past >> 31), self.mass & ~((past | -past) >> 31)
        start *= self.w0
        start += below[0]
        start += below[1]
        width *= self.w0
        width += same[0]
        width += same[1]
        return start, width

    def find(self, point: np.ndarray, lanes: slice) -> np.ndarray:
        """The ids whose intervals hold the points."""
        p, mass = self.p, self.mass
        start, width = self.plain(self.row[lanes] + p)
        start *= self.w0
        order = (p[0] - p[1]) >> 31  # all bits set where the prediction of order 1 comes first
        start[0] += mass[1] & ~(order | self.agreed)
        start[1] += mass[0] & order
        width *= self.w0
        width += mass
        width[1] += mass[0] & self.agreed
        past = point - start
        inside = (past >= 0) & (past < width)
        mass = mass & ~(past >> self.sign)
        # doubles are exact here; places beyond the end are those of points inside
        rest = ((point - mass[0] - mass[1]) / self.w0).astype(np.int64)
        x = self.ids.take(self.slot[lanes] + rest, mode="clip").astype(np.int32)
        np.copyto(x, p[0], where=inside[0])
        np.copyto(x, p[1], where=inside[1])
        return x

    def learn(self, places: np.ndarray, lo: int, hi: int, live: int) -> None:
        """Learn ids lo to hi; ``places`` has two more rows before the first id."""
        # tries in the low bits, those that orders 1 and 2 got right in doubles above; whole numbers below 2^53
        kinds = np.array([1, 1 + 2.0**16, 1 + 2.0**32])
        for first in range(0, live, LANES):
            lanes = slice(first, min(live, first + LANES))
            states = slice(first * STATES, lanes.stop * STATES)
            for a in range(lo, hi, LEARNT):
                b = min(hi, a + LEARNT)
                x = places[a + 2 : b + 2, lanes].astype(np.int32)
                self.context(places[a + 1 : b + 1, lanes], places[a:b, lanes], lanes)
                hit = self.p == x
                new = _NEXT[(hit.view(np.uint8) << 2) + self.sure]
                # of several of one context the last one stays
                self.table[self.at] = ((np.where(new & 4, x, self.p) << 2) + (new & 3)).astype(self.table.dtype)
                hit[0] &= ~hit[1]
                weights = kinds.take(hit[0] + 2 * hit[1].view(np.uint8))
                seen = np.bincount((self.of - states.start).reshape(-1), weights.reshape(-1), states.stop - states.start).astype(np.int64)
                self.tries[states] += seen & 0xFFFF
                self.right[0, states] += seen >> 16 & 0xFFFF
                self.right[1, states] += seen >> 32
        seen = np.bincount((places[lo + 2 : hi + 2, :live] + self.row[:live]).reshape(-1), minlength=live * self.stride)
        self.counts[: live * self.stride] += GAIN * seen[: live * self.stride]


def _live(lengths: np.ndarray) -> np.ndarray:
    """For each step, how many blocks (by falling length) have an id there."""
    return np.searchsorted(-lengths, -np.arange(int(lengths.max(initial=0))), side="left")


def _alphabet(ids: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct ids, and the place of each id among them; ``place`` is scratch space."""
    found = np.sort(ids, kind="stable")  # of ids of 16 bits by radix
    found = found[np.concatenate(([True], found[1:] != found[:-1]))[: len(found)]].astype(np.int64)
    if not len(ids) or found[0] < 0 or found[-1] >= len(place):
        return found, np.searchsorted(found, ids)
    place[found] = np.arange(len(found))
    return found, place.take(ids)


def encode(blocks: list[np.ndarray]) -> list[tuple[np.ndarray, bytes]]:
    """The sorted distinct ids of each block and its coded ids."""
    order = sorted(range(len(blocks)), key=lambda k: -len(blocks[k]))
    lengths = np.array([len(blocks[k]) for k in order], dtype=np.int64)
    longest, n = int(lengths.max(initial=0)), len(order)
    alphabets: list[np.ndarray] = []
    lanes, scratch = np.zeros((n, longest + 2), dtype=np.int32), np.zeros(1 << 17, dtype=np.int32)
    for lane, k in enumerate(order):
        ids, where = _alphabet(blocks[k], scratch)
        alphabets.append(ids)
        lanes[lane, 2 : len(where) + 2] = where
    places = np.ascontiguousarray(lanes.T)
    del lanes
    mixture = _Mixture(np.array([len(a) for a in alphabets], dtype=np.int64), decoding=False)
    low, span = np.zeros(n, dtype=np.uint64), np.full(n, np.iinfo(np.uint64).max, dtype=np.uint64)
    words = np.zeros(n * (longest + 3), dtype=np.uint32)
    begin = np.arange(n) * (longest + 3)
    used = begin.copy()  # place of the next word of each block

    def carry(lanes: np.ndarray) -> None:
        at = used[lanes] - 1
        while len(lanes):
            words[at] += np.uint32(1)
            more = words[at] == 0
            lanes, at = lanes[more], at[more] - 1

    def put(lanes: np.ndarray) -> None:
        at, value = used[lanes], low[lanes]
        words[at] = value >> _LOW
        used[lanes] = at + 1
        low[lanes] = value << _LOW

    living = _live(lengths).tolist()
    for lo, hi in stretches(longest):
        mixture.freeze(living[lo])
        for a in range(lo, hi, ROWS):
            b, most = min(hi, a + ROWS), living[a]
            starts, widths = np.empty((2, b - a, most), dtype=np.uint64)
            for first in range(0, most, LANES):
                lanes = slice(first, min(most, first + LANES))
                mixture.context(places[a + 1 : b + 1, lanes], places[a:b, lanes], lanes)
                mixture.weigh(lanes)
                starts[:, lanes], widths[:, lanes] = mixture.interval(places[a + 2 : b + 2, lanes], lanes)
            for live, start, width in zip(living[a:b], starts, widths, strict=True):
                own, wide = low[:live], span[:live]
                unit = wide >> mixture.total[:live]
                up = unit * start[:live]
                own += up
                over = (own < up).nonzero()[0]
                np.multiply(unit, width[:live], out=wide)
                if len(over):
                    carry(over)
                short = (wide < _FULL).nonzero()[0]
                if len(short):
                    put(short)
                    wide[short] <<= _LOW
        if hi < longest:
            mixture.learn(places, lo, hi, living[hi])
    every = np.arange(n)
    put(every)
    put(every)
    out: list[tuple[np.ndarray, bytes]] = [(np.zeros(0, dtype=np.int64), b"")] * n
    for lane, k in enumerate(order):
        out[k] = alphabets[lane], words[begin[lane] : used[lane]].astype("<u4").tobytes()
    return out


def decode(coded: list[tuple[np.ndarray, int, bytes]]) -> list[np.ndarray]:
    """Blocks from their sorted distinct ids, lengths and coded ids; bytes that no encoder wrote give some ids or other."""
    order = sorted(range(len(coded)), key=lambda k: -coded[k][1])
    lengths = np.array([coded[k][1] for k in order], dtype=np.int64)
    longest, n = int(lengths.max(initial=0)), len(order)
    mixture = _Mixture(np.array([len(coded[k][0]) for k in order], dtype=np.int64), decoding=True)
    streams = [np.frombuffer(coded[k][2], dtype="<u4") for k in order]
    bounds = np.concatenate(([0], np.cumsum([len(s) for s in streams], dtype=np.int64)))
    flat = np.concatenate([*streams, np.zeros(2, dtype="<u4")]).astype(np.uint64)
    at = bounds[:-1] + 2
    code = (flat[bounds[:-1]] << _LOW) | flat[bounds[:-1] + 1]
    span = np.full(n, np.iinfo(np.uint64).max, dtype=np.uint64)
    top = (np.uint64(1) << mixture.total) - np.uint64(1)
    places = np.zeros((longest + 2, n), dtype=np.int32)
    last, before = np.zeros(n, dtype=np.int32), np.zeros(n, dtype=np.int32)
    living = _live(lengths).tolist()
    for lo, hi in stretches(longest):
        mixture.freeze(living[lo])
        for t in range(lo, hi):
            live = living[t]
            lanes = slice(live)
            mixture.context(last[:live], before[:live], lanes)
            mixture.weigh(lanes)
            own, wide = code[:live], span[:live]
            unit = wide >> mixture.total[:live]
            x = mixture.find(np.minimum(own // unit, top[:live]).astype(mixture.kind), lanes)
            start, width = mixture.interval(x, lanes)
            own -= unit * start.astype(np.uint64)
            np.multiply(unit, width.astype(np.uint64), out=wide)
            short = (wide < _FULL).nonzero()[0]
            if len(short):
                code[short] = (code[short] << _LOW) | flat.take(at[short], mode="clip")  # beyond its own words only if they are damaged
                at[short] += 1
                span[short] <<= _LOW
            places[t + 2, :live] = x
            last, before = x, last
        if hi < longest:
            mixture.learn(places, lo, hi, living[hi])
    found = np.ascontiguousarray(places.T)
    out: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * n
    for lane, k in enumerate(order):
        out[k] = coded[k][0][found[lane, 2 : lengths[lane] + 2]] if lengths[lane] else out[k]
    return out
