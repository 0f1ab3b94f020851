"""Elias-Fano sequences over memory-mapped words: monotone numbers in about 2 + log2(universe / n) bits each.

A number's low bits are packed; its high part is coded in unary in a bit vector. All queries take arrays. Samples lead to
the word that holds a wanted bit or to one before it; from there the word is found by halving over counts of bits, so that
long runs cost no more than their logarithm.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
SAMPLE = 8


def _places() -> np.ndarray:
    """At [x * SAMPLE + r]: the place of the r-th set bit of a 16-bit number x; 16 if it has no more."""
    left = np.arange(1 << 16, dtype=np.uint32)
    out = np.full((1 << 16, SAMPLE), 16, np.uint8)
    for r in range(SAMPLE):
        some = left > 0
        out[some, r] = np.bitwise_count((left[some] & (~left[some] + np.uint32(1))) - np.uint32(1))
        left &= left - np.uint32(1)
    return out.reshape(-1)


#: A table made from its rule: half a megabyte, so that it stays in a cache.
PLACES = _places()


def _read(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64 bits from any bit position. The words end with two spare ones."""
    word, off = (at >> U(6)).astype(np.int64), at & U(63)
    return (words[word] >> off) | ((words[word + 1] << U(1)) << (U(63) - off))


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Numbers of ``width`` bits, one behind the other."""
    n = len(values)
    words = np.zeros(n * width // 64 + 3, U)
    if width and n:
        at = np.arange(n, dtype=U) * U(width)
        word, off = (at >> U(6)).astype(np.int64), at & U(63)
        np.bitwise_or.at(words, word, values << off)
        over = off + U(width) > U(64)
        np.bitwise_or.at(words, word[over] + 1, values[over] >> (U(64) - off[over]))
    return words


class EliasFano:
    """``find`` gives the place of a number or -1, ``get`` the number at a place, ``step`` that and how much more the next one is."""

    def __init__(self, n: int, width: int, buckets: int, low: np.ndarray, high: np.ndarray, zeros: np.ndarray, ones: np.ndarray, before: np.ndarray):
        self.n, self.width, self.buckets = n, width, buckets
        self.low, self.high, self.zeros, self.ones, self.before = low, high, zeros, ones, before

    @staticmethod
    def arrays(values: np.ndarray, universe: int, use: str = "find get") -> tuple[list[int], list[np.ndarray]]:
        """Header numbers and word arrays of a sorted sequence of numbers below ``universe``, with samples for its use."""
        n = len(values)
        width = max(0, int(universe // max(n, 1)).bit_length() - 1)
        values = values.astype(U)
        low = _pack(values & U((1 << width) - 1), width)
        place = (values >> U(width)) + np.arange(n, dtype=U)
        buckets = (universe >> width) + 1
        bits = np.zeros(((n + buckets + 1) // 64 + 3) * 64, np.uint8)
        bits[place.astype(np.int64)] = 1
        kind = np.uint32 if len(bits) < 2**32 else U
        none = np.zeros(0, kind)
        zeros = np.flatnonzero(bits[: n + buckets + 1] == 0)[::SAMPLE].astype(kind) if "find" in use else none
        ones = place[::SAMPLE].astype(kind) if "get" in use else none
        high = np.packbits(bits, bitorder="little").view(U)
        held = np.bitwise_count(high).astype(kind)
        return [n, width, int(buckets)], [low, high, zeros, ones, (np.cumsum(held, dtype=kind) - held)]

    def _word(self, k: np.ndarray, first: np.ndarray, last: np.ndarray, invert: bool) -> tuple[np.ndarray, np.ndarray]:
        """The word between two that holds the k-th bit, and the number of such bits before it."""

        def count(word: np.ndarray) -> np.ndarray:
            ones = self.before[word].astype(np.int64)
            return (word << 6) - ones if invert else ones

        for _ in range(int((last - first).max()).bit_length()):
            middle = (first + last + 1) >> 1
            fits = count(middle) <= k
            first, last = np.where(fits, middle, first), np.where(fits, last, np.maximum(middle - 1, first))
        return first, count(first)

    def _select(self, k: np.ndarray, invert: bool) -> np.ndarray:
        """The position of the k-th bit that is set (or not set, if ``invert``)."""
        samples = self.zeros if invert else self.ones
        sample = (k // U(SAMPLE)).astype(np.int64)
        at = samples[sample].astype(U)
        left = (k % U(SAMPLE)).astype(np.int64)
        window = _read(self.high, at)
        window = ~window if invert else window
        far = np.flatnonzero(np.bitwise_count(window) <= left)
        if len(far):
            after = sample[far] + 1
            last = np.where(after < len(samples), samples[np.minimum(after, len(samples) - 1)] >> 6, len(self.high) - 1).astype(np.int64)
            word, counted = self._word(k[far].astype(np.int64), (at[far] >> U(6)).astype(np.int64), last, invert)
            at[far], left[far] = word.astype(U) << U(6), k[far].astype(np.int64) - counted
            window[far] = ~self.high[word] if invert else self.high[word]
        # Sixteen bits at a time; mostly the first are enough.
        out, to = np.zeros(len(k), U), None
        while len(window):
            part = (window & U(0xFFFF)).astype(np.int64)
            held = np.bitwise_count(part.astype(np.uint16)).astype(np.int64)
            found = at + PLACES[part * SAMPLE + np.minimum(left, SAMPLE - 1)]
            here = held > left
            # More than a sample's bits before it in one part: its lower half falls away first.
            crowded = np.flatnonzero(here & (left >= SAMPLE))
            if len(crowded):
                lower = np.bitwise_count((part[crowded] & 0xFF).astype(np.uint8)).astype(np.int64)
                upper = left[crowded] >= lower
                half = np.where(upper, part[crowded] >> 8, part[crowded] & 0xFF)
                found[crowded] = at[crowded] + np.where(upper, U(8), U(0)) + PLACES[half * SAMPLE + left[crowded] - np.where(upper, lower, 0)]
            if to is None:
                out = found
                to = np.flatnonzero(~here)
                on = to
            else:
                out[to[here]] = found[here]
                on = np.flatnonzero(~here)
                to = to[on]
            window, left, at = window[on] >> U(16), left[on] - held[on], at[on] + U(16)
        return out

    def _low(self, places: np.ndarray) -> np.ndarray:
        return _read(self.low, places * U(self.width)) & U((1 << self.width) - 1) if self.width else np.zeros(len(places), U)

    def get(self, places: np.ndarray) -> np.ndarray:
        places = places.astype(U)
        top = self._select(places, False) - places
        return (top << U(self.width)) | self._low(places)

    def step(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The numbers at some places, none of them the last, and by how much the next ones are larger."""
        places = places.astype(U)
        at = self._select(places, False)
        number = ((at - places) << U(self.width)) | self._low(places)
        window = _read(self.high, at + U(1))
        after = at + U(1) + np.bitwise_count((window & (~window + U(1))) - U(1))
        far = np.flatnonzero(window == 0)
        if len(far):
            after[far] = self._select(places[far] + U(1), False)
        following = ((after - places - U(1)) << U(self.width)) | self._low(places + U(1))
        return number, following - number

    def find(self, values: np.ndarray) -> np.ndarray:
        """The place of each number; -1 if it is not there. Among numbers with one high part, by halving."""
        out = np.full(len(values), -1, np.int64)
        if not self.n or not len(values):
            return out
        values = values.astype(U)
        bucket = values >> U(self.width)
        # A bucket's numbers lie between the zero before it and its own; buckets beyond the last number have none.
        at = np.flatnonzero(bucket < U(self.buckets))
        bucket = bucket[at]
        low = np.zeros(len(at), U)
        later = bucket > 0
        low[later] = self._select(bucket[later] - U(1), True) + U(1) - bucket[later]
        # Most buckets hold one number or none: the two bits behind the first zero tell.
        end = low + bucket
        following = _read(self.high, end)
        short = (following & U(3)) != U(3)
        high = low + (following & U(1))
        if not short.all():
            long = ~short
            high[long] = self._select(bucket[long], True) - bucket[long]
        want = values[at] & U((1 << self.width) - 1)
        some = high > low
        at, low, high, want = at[some], low[some], high[some], want[some]
        while len(at):
            middle = (low + high) >> U(1)
            found = self._low(middle)
            hit = found == want
            out[at[hit]] = middle[hit].astype(np.int64)
            less = found < want
            low, high = np.where(less, middle + U(1), low), np.where(less, high, middle)
            on = ~hit & (low < high)
            at, low, high, want = at[on], low[on], high[on], want[on]
        return out
