"""Canonical length-limited Huffman codes over token ids, in numpy."""

from __future__ import annotations

import numpy as np


def code_lengths(counts: np.ndarray, most: int) -> np.ndarray:
    """Code length per symbol (0 where the count is 0), none over ``most`` bits, least in total.

    Package-merge: on each of ``most`` levels the packages (pairs of the level
    before) are merged with the symbols in order of weight; walking back, the
    first symbols that a level takes get one bit more.
    """
    used = np.flatnonzero(counts)
    n = len(used)
    lengths = np.zeros(len(counts), np.int64)
    if n <= 1:
        lengths[used] = 1
        return lengths
    if n > 1 << most:
        raise ValueError(f"{n} symbols do not fit codes of {most} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.int64)
    merged, levels = weights, [np.ones(n, bool)]
    for _ in range(most - 1):
        packages = merged[0 : len(merged) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weights, packages])
        at = np.argsort(both, kind="stable")
        merged = both[at]
        levels.append(at < n)
    take, extra = 2 * n - 2, np.zeros(n + 1, np.int64)
    for is_symbol in reversed(levels):
        symbols = int(is_symbol[:take].sum())
        extra[symbols] += 1
        take = 2 * (take - symbols)
    lengths[order] = np.cumsum(extra[::-1])[::-1][1:]
    return lengths


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, symbol), as unsigned numbers."""
    codes = np.zeros(len(lengths), np.uint64)
    code = last = 0
    used = np.flatnonzero(lengths)
    for s in used[np.argsort(lengths[used], kind="stable")].tolist():
        code <<= int(lengths[s]) - last
        last = int(lengths[s])
        codes[s] = code
        code += 1
    return codes


class Coder:
    """Packs ids to bits, and reads them back by one table look-up per id."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = np.asarray(lengths, np.int64)
        self.codes = canonical(self.lengths)
        self.width = int(self.lengths.max(initial=1))
        self.short = self.lengths.astype(np.uint8)
        self.aligned = np.where(self.lengths > 0, self.codes << ((64 - self.lengths) & 63).astype(np.uint64), np.uint64(0))
        used = np.flatnonzero(self.lengths)
        spans = 1 << (self.width - self.lengths[used])
        at = np.argsort(self.codes[used] << (self.width - self.lengths[used]).astype(np.uint64))
        self.symbol = np.zeros(1 << self.width, np.int32)
        self.bits = np.ones(1 << self.width, np.int64)
        filled = int(spans.sum())
        self.symbol[:filled] = np.repeat(used[at], spans[at])
        self.bits[:filled] = np.repeat(self.lengths[used[at]], spans[at])

    def pack(self, ids: np.ndarray, every: int) -> tuple[bytes, np.ndarray]:
        """(bits, bit offset of each ``every``-th id); the bits end with a spare word."""
        n = self.short[ids]
        ends = np.cumsum(n, dtype=np.int64)
        at = ends - n
        words = np.zeros((int(ends[-1]) >> 6) + 2 if len(ids) else 1, np.uint64)
        if len(ids):
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            first = np.flatnonzero(np.diff(word, prepend=-1))
            words[word[first]] = np.add.reduceat(self.aligned[ids] >> bit, first)
            last = np.append(first[1:], len(ids)) - 1  # only a word's last code can run over into the next one
            words[word[last] + 1] += (self.aligned[ids[last]] << np.uint64(1)) << (np.uint64(63) - bit[last])
        return words.astype(">u8").tobytes(), at[::every].copy()

    def unpack(self, data: bytes, checkpoints: np.ndarray, n: int, every: int) -> np.ndarray:
        """The ``n`` ids of a block; all stretches between checkpoints are read side by side."""
        words = np.frombuffer(data, ">u8").astype(np.uint64)
        out = np.empty((every, len(checkpoints)), np.int32)
        at, last, top = checkpoints.astype(np.int64), (len(words) - 1) * 64 - 1, np.uint64(64 - self.width)
        for k in range(min(every, n)):
            word, shift = at >> 6, (at & 63).astype(np.uint64)
            v = (words[word] << shift) | ((words[word + 1] >> np.uint64(1)) >> (np.uint64(63) - shift))
            v = (v >> top).astype(np.int64)
            out[k] = self.symbol[v]
            at = np.minimum(at + self.bits[v], last)  # the last stretch may be shorter
        return out.T.ravel()[:n]
