"""A run-length index of a few strings: sorted suffixes kept at the ends of the runs of their Burrows-Wheeler transform."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_BYTES = 8  # of a first sort key, and of the zeros after each string


@dataclass
class RunIndex:
    """Samples where runs of the transform begin and end, with the length of the match to the suffix next to them.

    heads: text positions of the first suffix of every run, and how far each agrees with the suffix before it in order.
    tails: the same for the last suffix of every run and the one after it.
    """

    size: int
    heads: np.ndarray
    head_match: np.ndarray
    tails: np.ndarray
    tail_match: np.ndarray

    def matching_statistics(self) -> np.ndarray:
        """For every position how long its suffix occurs elsewhere too, streamed from sample to sample.

        Inside a run the neighbours of position i - 1 stay those of i moved by one, so a match found at a sample gets
        one shorter with every position until the next sample: the longest that still reaches is the answer.
        """
        out = np.zeros(self.size, np.int64)
        for at, match in ((self.heads, self.head_match), (self.tails, self.tail_match)):
            reach = np.zeros(self.size, np.int64)
            reach[at] = at + match
            np.maximum(out, np.maximum.accumulate(reach) - np.arange(self.size), out=out)
        return out


def build(strings: list[bytes], least: int = 0) -> tuple[RunIndex, np.ndarray]:
    """The index, and where each string begins. No match goes beyond a string's end.

    Samples that match less than ``least`` bytes may be left out, which leaves longer statistics as they are.
    """
    lengths = np.array([len(s) for s in strings], np.int64)
    begin = np.cumsum(lengths + _BYTES) - lengths - _BYTES
    gap = bytes(_BYTES)
    raw = gap.join(strings) + gap * 2
    size = int(lengths.sum() + _BYTES * len(strings))
    text = np.frombuffer(raw, np.uint8)
    left = np.maximum(np.repeat(begin + lengths, lengths + _BYTES) - np.arange(size), 0)  # bytes up to the string's end
    places = np.flatnonzero(left)
    key = np.ndarray((size,), ">u8", raw, strides=(1,))[places].astype(np.uint64)
    by_key = np.argsort(key)  # the order of equal suffixes does not matter
    order, key = places[by_key], key[by_key]
    new = np.ones(len(order), bool)  # whether a suffix differs from the one before it, as far as it is sorted
    new[1:] = key[1:] != key[:-1]
    rank = np.zeros(size, np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    levels, step, longest = [(_BYTES, rank)], _BYTES, int(lengths.max(initial=0))
    parts = 3 if size + 2 < 1 << 21 else 2  # ranks that one sort key holds
    while step < longest:
        known, step = step, step * parts
        # Only suffixes that still share their rank are sorted again.
        tied = ~new
        tied[:-1] |= ~new[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        some = order[at]
        room = left[some]
        second = rank[some].astype(np.int64)
        for part in range(1, parts):
            ahead = np.minimum(some + part * known, size - 1)
            second = second * (size + 2) + np.where(room > part * known, rank[ahead] + 1, 0)
        inner = np.argsort(second)
        order[at], second = some[inner], second[inner]
        new[at[1:]] |= second[1:] != second[:-1]
        rank = rank.copy()
        rank[order[at]] = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))[at]
        levels.append((step, rank))

    before = text[order - 1]  # of the first byte of all, the zeros at the end
    edge = np.ones(len(order), bool)
    edge[1:] = (before[1:] != before[:-1]) | (before[1:] == 0)
    heads = np.flatnonzero(edge)
    heads = heads[heads > 0]
    first, last = order[heads], order[heads - 1]
    for length, of in levels:
        if length <= least:
            same = of[first] == of[last]
            first, last = first[same], last[same]

    rest = np.minimum(left[first], left[last])
    x, y, match = first.copy(), last.copy(), np.zeros(len(first), np.int64)
    for length, of in reversed(levels):  # how far they agree, from equal ranks of ever shorter prefixes
        while True:
            same = (match < rest) & (of[np.minimum(x, size - 1)] == of[np.minimum(y, size - 1)])
            if not same.any():
                break
            match += length * same
            x, y = x + length * same, y + length * same
    for _ in range(_BYTES):  # bytes below the shortest prefix
        same = (match < rest) & (text[np.minimum(x, size)] == text[np.minimum(y, size)])
        match += same
        x, y = x + same, y + same
    match = np.minimum(match, rest)
    return RunIndex(size, first, match, last, match), begin
