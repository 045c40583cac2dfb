"""Byte-pair merging by rank: every sequence of a batch merges at once.

Short sequences lie in the rows of matrices, where one merge costs a few numbers; long ones in ragged arrays, where a
round goes over all symbols but merges a pair at all its places.
"""

from __future__ import annotations

import numpy as np

NONE = np.int32(-1)
FAR = np.int32(2**31 - 1)
FREE, RANK = np.int64(1 << 62), 24  # a slot without a pair; bits of a rank in a slot
GONE = np.int32(-(2**31))  # no symbol: the place of one that was merged into its neighbour, or beyond the end
SHORT = 32  # symbols of a sequence that is merged as a row of a matrix
ROWS = 4096  # rows of a matrix, at most


class Pairs:
    """(left symbol, right symbol) -> (rank, merged symbol), as an open-addressing table in arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray):
        keys = (np.asarray(left, np.uint64) << np.uint64(32)) | np.asarray(right, np.uint64)
        self.bits = max(4, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.key = np.full(1 << self.bits, 2**64 - 1, dtype=np.uint64)
        self.rank = np.full(1 << self.bits, FAR, dtype=np.int32)
        self.merged = np.full(1 << self.bits, NONE, dtype=np.int32)
        todo, slot, self.probes = np.arange(len(keys)), self._slot(keys), 0
        rank, merged = np.asarray(rank, np.int32), np.asarray(merged, np.int32)
        while len(todo):  # each round seats at most one key a slot, the others move on by one
            at = slot[todo]
            free = self.key[at] == np.uint64(2**64 - 1)
            _, first = np.unique(np.where(free, at, -1 - np.arange(len(at))), return_index=True)
            seat = np.zeros(len(todo), dtype=bool)
            seat[first] = True
            seat &= free
            self.key[at[seat]], self.rank[at[seat]], self.merged[at[seat]] = keys[todo[seat]], rank[todo[seat]], merged[todo[seat]]
            todo = todo[~seat]
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            self.probes += 1
        # where symbols have 16 bits, and a rank tells what is merged, a slot is one number: the symbols and the rank
        self.entry, most = None, int(max(np.max(left, initial=0), np.max(right, initial=0)))
        if most < 1 << 16 and rank.min(initial=0) >= 0 and rank.max(initial=0) < 1 << RANK:
            self.by_rank = np.full(int(rank.max(initial=0)) + 1, NONE, dtype=np.int32)
            self.by_rank[rank] = merged
            if (self.by_rank[rank] == merged).all():
                used = self.rank != FAR
                self.entry = np.full(1 << self.bits, FREE, dtype=np.int64)
                key = self.key[used].astype(np.int64)
                self.entry[used] = (key >> 32 << 16 | key & 0xFFFF) << RANK | self.rank[used]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of each pair; FAR and NONE where there is none (also for negative symbols)."""
        keys = (left.astype(np.int64).astype(np.uint64) << np.uint64(32)) | (right.astype(np.int64).astype(np.uint64) & np.uint64(0xFFFFFFFF))
        slot = self._slot(keys)
        rank, merged = self.rank[slot], self.merged[slot]
        odd = np.flatnonzero(self.key[slot] != keys)
        rank[odd], merged[odd] = FAR, NONE
        odd = odd[self.key[slot[odd]] != np.uint64(2**64 - 1)]
        for _ in range(self.probes):
            if not len(odd):
                break
            slot[odd] = (slot[odd] + 1) & ((1 << self.bits) - 1)
            hit = self.key[slot[odd]] == keys[odd]
            rank[odd[hit]], merged[odd[hit]] = self.rank[slot[odd[hit]]], self.merged[slot[odd[hit]]]
            odd = odd[~hit & (self.key[slot[odd]] != np.uint64(2**64 - 1))]
        return rank, merged

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``find`` for tables with ``entry``: the ranks alone."""
        left, right = left.astype(np.int64), right.astype(np.int64)
        slot = self._slot(((left << 32) | right).view(np.uint64))
        key = (left << 16) | right  # below zero if a symbol is
        found = self.entry.take(slot)
        rank = (found & ((1 << RANK) - 1)).astype(np.int32)
        odd = np.flatnonzero(found >> RANK != key)
        rank[odd] = FAR
        odd = odd[found[odd] != FREE]
        for _ in range(self.probes):
            if not len(odd):
                break
            slot[odd] = (slot[odd] + 1) & ((1 << self.bits) - 1)
            found = self.entry.take(slot[odd])
            hit = found >> RANK == key[odd]
            rank[odd[hit]] = found[hit] & ((1 << RANK) - 1)
            odd = odd[~hit & (found != FREE)]
        return rank


def merge(symbols: np.ndarray, lengths: np.ndarray, pairs: Pairs) -> tuple[np.ndarray, np.ndarray]:
    """Merge all sequences until none has a known pair left, one pair at a time, lowest rank and leftmost first.

    Negative symbols never merge.  Returns the symbols left and the length of each sequence.
    """
    if pairs.entry is None:
        return _merge_ragged(symbols, lengths, pairs)
    lengths, symbols = np.asarray(lengths, dtype=np.int64), symbols.astype(np.int32, copy=False)
    bounds = np.concatenate(([0], np.cumsum(lengths)))
    order = np.argsort(np.minimum(lengths, SHORT + 1).astype(np.uint8), kind="stable")  # rows of a matrix are of like lengths
    some, few = int((lengths == 0).sum()), int((lengths <= SHORT).sum())
    left, sizes = [np.zeros(0, dtype=np.int32)], np.zeros(len(lengths), dtype=np.int64)
    for lo in range(some, few, ROWS):
        rows = order[lo : min(few, lo + ROWS)]
        ids, sizes[rows] = _merge_rows(symbols, bounds[rows], lengths[rows], pairs)
        left.append(ids)
    if few < len(order):
        rows = order[few:]
        which = np.repeat(lengths > SHORT, lengths)
        ids, sizes[rows] = _merge_ragged(symbols[which], lengths[rows], pairs)
        left.append(ids)
    out = np.empty(int(sizes.sum()), dtype=np.int32)
    found, ends = sizes[order], np.cumsum(sizes)
    before = np.cumsum(found) - found
    out[np.repeat((ends - sizes)[order] - before, found) + np.arange(len(out))] = np.concatenate(left)
    return out, sizes


def _merge_rows(symbols: np.ndarray, first: np.ndarray, lengths: np.ndarray, pairs: Pairs) -> tuple[np.ndarray, np.ndarray]:
    """``merge`` for sequences that begin at the places ``first`` of ``symbols``: a merge in each row at a time."""
    n, wide = len(first), int(lengths.max()) + 1  # the last column is beyond the end of every sequence
    column = np.arange(wide)
    at = first[:, None] + column
    sym = symbols.take(at, mode="clip")
    sym[column >= lengths[:, None]] = GONE
    place = np.arange(n * wide).reshape(n, wide)
    after, before = place + 1, place - 1
    after[np.arange(n), lengths - 1] = before[:, 0] = place[:, -1]
    sym, after, before = sym.reshape(-1), after.reshape(-1), before.reshape(-1)
    rank = np.full(n * wide, FAR, dtype=np.int32)
    known = np.flatnonzero((sym[:-1] >= 0) & (sym[1:] >= 0))
    rank[known] = pairs.ranks(sym[known], sym[known + 1])
    rank = rank.reshape(n, wide)
    rows = place[:, 0]  # the first place of each row of ``rank``, which loses rows that are done
    while True:
        best, own = rank.argmin(axis=1), np.arange(0, len(rows) * wide, wide)
        low = rank.reshape(-1).take(own + best)
        live = np.flatnonzero(low != FAR)
        if not len(live):
            break
        low, best = low.take(live), best.take(live)
        if len(live) < len(rows) * 3 // 4:
            rank, rows = rank.take(live, axis=0), rows.take(live)
            base, own = rows, own[: len(rows)]
        else:
            base, own = rows.take(live), own.take(live)
        shift = base - own
        here = base + best
        gone = after.take(here)
        behind, ahead = before.take(here), after.take(gone)
        made = pairs.by_rank.take(low)
        sym[here], sym[gone] = made, GONE
        after[here], before[ahead] = ahead, here
        flat = rank.reshape(-1)
        flat[gone - shift] = FAR
        flat[behind - shift] = pairs.ranks(sym.take(behind), made)
        flat[here - shift] = pairs.ranks(made, sym.take(ahead))
    kept = sym != GONE
    return sym[kept], kept.reshape(n, wide).sum(axis=1)


def _merge_ragged(symbols: np.ndarray, lengths: np.ndarray, pairs: Pairs) -> tuple[np.ndarray, np.ndarray]:
    """``merge`` for sequences of any length.

    In each round every sequence merges its pair of lowest rank, at all its places from left to right, unless that
    makes a pair of the same or a lower rank; then only the leftmost place is merged.  That is the order in which
    one merge at a time, lowest rank and leftmost first, would go.
    """
    n = len(lengths)
    owner = np.repeat(np.arange(n), lengths)
    sym = symbols.astype(np.int32, copy=True)
    done_sym: list[np.ndarray] = []
    done_owner: list[np.ndarray] = []
    rank, to = _links(sym, owner, pairs)
    while len(sym):
        first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        size = np.diff(np.concatenate((first, [len(sym)])))
        low = np.minimum.reduceat(rank, first)
        ended = np.repeat(low == FAR, size)
        if ended.any():
            done_sym.append(sym[ended])
            done_owner.append(owner[ended])
            sym, owner, rank, to = sym[~ended], owner[~ended], rank[~ended], to[~ended]
            size, low = size[low != FAR], low[low != FAR]
            if not len(sym):
                break
        hits = np.flatnonzero(rank == np.repeat(low, size))
        whose = owner[hits]
        leads = np.concatenate(([True], whose[1:] != whose[:-1]))
        if leads.all():
            state = _apply(sym, owner, rank, to, hits, pairs)[:4]
        else:
            run = np.concatenate(([True], (hits[1:] != hits[:-1] + 1) | leads[1:]))
            start = np.flatnonzero(run)
            place = np.arange(len(hits)) - np.repeat(start, np.diff(np.concatenate((start, [len(hits)]))))
            chosen = hits[place % 2 == 0]
            state = _apply(sym, owner, rank, to, chosen, pairs)
            fresh = state[4]  # places whose rank is new
            bound = np.zeros(n, dtype=np.int32)
            bound[whose[leads]] = rank[hits[leads]]
            bad = np.zeros(n, dtype=bool)
            bad[state[1][fresh[state[2][fresh] <= bound[state[1][fresh]]]]] = True
            # between two merges, the first one stands beside the symbol that the second is about to take
            ahead = chosen[chosen + 2 < len(sym)]
            ahead = ahead[(owner[ahead + 2] == owner[ahead]) & (sym[ahead + 2] >= 0)]
            bad[owner[ahead[pairs.find(to[ahead], sym[ahead + 2])[0] <= bound[owner[ahead]]]]] = True
            if bad.any():
                state = _apply(sym, owner, rank, to, hits[(place % 2 == 0) & (leads | ~bad[whose])], pairs)
            state = state[:4]
        sym, owner, rank, to = state
    if not done_sym:
        return sym, np.bincount(owner, minlength=n) if len(owner) else np.zeros(n, dtype=np.int64)
    sym, owner = np.concatenate(done_sym), np.concatenate(done_owner)
    return sym[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=n)


def _links(sym: np.ndarray, owner: np.ndarray, pairs: Pairs) -> tuple[np.ndarray, np.ndarray]:
    """Rank and result of merging each symbol with its right neighbour."""
    rank, to = np.full(len(sym), FAR, dtype=np.int32), np.full(len(sym), NONE, dtype=np.int32)
    _renew(sym, owner, rank, to, np.arange(max(0, len(sym) - 1)), pairs)
    return rank, to


def _renew(sym, owner, rank, to, at, pairs) -> None:
    rank[at], to[at] = FAR, NONE
    at = at[at < len(sym) - 1]
    at = at[(owner[at] == owner[at + 1]) & (sym[at] >= 0) & (sym[at + 1] >= 0)]
    rank[at], to[at] = pairs.find(sym[at], sym[at + 1])


def _apply(sym, owner, rank, to, at, pairs):
    """Merge the symbols at the places ``at`` with their right neighbours; the last item: places with a new rank."""
    sym, rank, to = sym.copy(), rank.copy(), to.copy()
    sym[at] = to[at]
    keep = np.ones(len(sym), dtype=bool)
    keep[at + 1] = False
    now = at - np.arange(len(at))  # the places after the right neighbours are gone
    sym, owner, rank, to = sym[keep], owner[keep], rank[keep], to[keep]
    new = np.zeros(len(sym), dtype=bool)
    new[now] = True
    new[np.maximum(now - 1, 0)] = True
    fresh = np.flatnonzero(new)
    _renew(sym, owner, rank, to, fresh, pairs)
    return sym, owner, rank, to, fresh
